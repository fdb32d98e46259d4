"""Sources and sinks: text lines, sorted runs, the line generator."""

from ordo.sources.generator import PHRASES, generate_lines, generate_sized, rows_for_size
from ordo.sources.text import read_in_file_order, read_lines, read_runs, with_scan_order, write_lines

__all__ = [
    "PHRASES", "generate_lines", "generate_sized", "rows_for_size", "read_in_file_order",
    "read_lines", "read_runs", "with_scan_order", "write_lines",
]
