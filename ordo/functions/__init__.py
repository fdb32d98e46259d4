"""Column expressions (no Python UDFs): line parsing and sort keys."""

from ordo.functions.keys import (
    binary_text_key, bind_keys, bound_order, key_columns_of_line, text_keys,
)
from ordo.functions.lines import (
    line_of, memory_estimate, number_of_valid, parse_number, reject_reason, text_slice,
    utf16_length, well_formed,
)

__all__ = [
    "binary_text_key", "bind_keys", "bound_order", "key_columns_of_line", "text_keys", "line_of", "memory_estimate",
    "number_of_valid", "parse_number", "reject_reason", "text_slice", "utf16_length", "well_formed",
]
