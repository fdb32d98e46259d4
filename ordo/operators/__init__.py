"""DataFrame -> DataFrame operators: parse, sort, merge, position, validate, profile."""

from ordo.operators.parse import parse_lines, parse_with_reason, reject_summary, rejected_lines, valid_lines
from ordo.operators.position import position_in_files, with_position
from ordo.operators.profile import count_conservation, input_stats, run_profile
from ordo.operators.sort import first_lines, merge_runs, sort_lines, sort_parsed, sorted_runs, top_lines
from ordo.operators.validate import (
    bag_equal, check_sorted, format_check, order_equal, size_in_window, sorted_summary,
)

__all__ = [
    "parse_lines", "parse_with_reason", "reject_summary", "rejected_lines", "valid_lines",
    "position_in_files", "with_position", "count_conservation", "input_stats", "run_profile",
    "first_lines", "merge_runs", "sort_lines", "sort_parsed", "sorted_runs", "top_lines",
    "bag_equal", "check_sorted", "format_check", "order_equal", "size_in_window", "sorted_summary",
]
