"""End-to-end jobs and the run report."""

from ordo.plans.report import append_report, report_summary, run_report
from ordo.plans.sort_file import generate_file, merge_files, sort_file, split_and_sort

__all__ = [
    "append_report", "report_summary", "run_report", "generate_file", "merge_files", "sort_file",
    "split_and_sort",
]
