"""Sort keys.

Order is text ascending by *ordinal* comparison (UTF-16 code units, case
sensitive), then number ascending, then the whole line as a deterministic
tie-break for rows that compare equal on (text, number).

Spark compares strings by code point (UTF-8 bytes). That differs from UTF-16
code-unit order only where a character above U+FFFF meets one in
U+E000..U+FFFF. The ordinal key is therefore two columns:

* ``_tkey``: the text up to (not including) its first character >= U+E000,
  followed by the sentinel U+E000 when such a character exists; for all other
  texts (every ASCII text, in particular) it is the text itself;
* ``_tkey2``: ``encode(text, 'UTF-16BE')`` for texts that got the sentinel,
  null otherwise.

Comparing (``_tkey``, ``_tkey2``) equals ordinal comparison of the texts: a
difference before the first character >= U+E000 is decided identically by
both orders; a text with such a character sorts after any text that has a
smaller character (or ends) there, in both orders; two texts with equal
prefixes and a sentinel tie on ``_tkey`` and are decided by their UTF-16
bytes. ASCII rows pay two length computations, not a re-encoding.

``order="utf8"`` sorts by code point order (``text``), which equals ordinal
order whenever no character above U+FFFF occurs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordo.functions.lines import _col, delimiter_pos, number_of_valid, parse_number, text_slice

ORDERS = ("ordinal", "utf8")

# First character whose UTF-16 order differs from code point
# order, and the pattern of the prefix before it.
HIGH_START = "\ue000"
LOW_PREFIX = r"\A[^\x{E000}-\x{10FFFF}]*"
HIGH_CHAR = r"[\x{E000}-\x{10FFFF}]"

TKEY = "_tkey"
TKEY2 = "_tkey2"
NKEY = "_nkey"


def text_keys(text: Column | str, order: str = "ordinal") -> list[Column]:
    t = _col(text)
    if order == "utf8":
        return [t]
    if order != "ordinal":
        raise ValueError(f"order must be one of {ORDERS}, got {order!r}")
    # ASCII texts stop at the length check; other texts pay one regex find,
    # and only the rare ones with a character >= U+E000 build the prefix.
    special = (F.octet_length(t) != F.length(t)) & t.rlike(HIGH_CHAR)
    key1 = F.when(special, F.concat(F.regexp_extract(t, LOW_PREFIX, 0), F.lit(HIGH_START))).otherwise(t)
    key2 = F.when(special, F.encode(t, "UTF-16BE"))
    return [key1, key2]


def binary_text_key(text: Column | str, order: str = "ordinal") -> Column:
    """The text keys as one binary column whose byte order is the text order.

    ``_tkey`` as UTF-8 bytes, followed by ``_tkey2`` where it exists. Byte
    order of UTF-8 is code point order, which orders ``_tkey``; two keys that
    tie on ``_tkey`` either both have the sentinel (U+E000, bytes EE 80 80)
    and are decided by the UTF-16 bytes after it, or neither has ``_tkey2``.
    A text without the sentinel has no byte at or above EE where the other
    has it, so appending never changes a comparison ``_tkey`` decides. One
    column instead of two is cheaper to move to Python workers."""
    keys = text_keys(text, order)
    k1 = keys[0].cast("binary")
    if order == "utf8":
        return k1
    return F.when(keys[1].isNull(), k1).otherwise(F.concat(k1, keys[1]))


def key_columns_of_line(line: Column | str, order: str = "ordinal") -> list[Column]:
    """Full sort key (text keys, number, line) of a line known to be valid."""
    v = _col(line)
    return text_keys(text_slice(v), order) + [number_of_valid(v), v]


def range_keys_of_line(line: Column | str, order: str = "ordinal") -> list[Column]:
    """A shorter key with the order of the full one: the line itself gives way to
    its head up to the character after the dot.

    Lines with equal texts and numbers differ only there: in the number's
    spelling, whose first difference lies at or before the dot, and in whether a
    space follows the dot (a text never begins with the space that was dropped,
    so the next character decides). Sampled range keys then hold a text once."""
    v = _col(line)
    head = F.substring(v, F.lit(1), delimiter_pos(v) + 1)
    return text_keys(text_slice(v), order) + [number_of_valid(v), head]


def key_names(order: str = "ordinal") -> list[str]:
    return [TKEY, TKEY2] if order == "ordinal" else [TKEY]


def bind_keys(df: DataFrame, line: str = "line", order: str = "ordinal",
              guarded: bool = False) -> DataFrame:
    """Project the sort keys of ``line`` as columns, so a sort evaluates them
    once per row instead of once per comparison. ``guarded`` binds the
    number through the full guard (null for a line that does not parse), for
    lines not yet validated."""
    keys = key_columns_of_line(line, order)
    if guarded:
        keys[-2] = parse_number(line)
    names = key_names(order) + [NKEY]
    return df.select("*", *[k.alias(n) for k, n in zip(keys, names)])


def bound_order(line: str = "line", order: str = "ordinal") -> list[Column]:
    return [F.col(n) for n in key_names(order)] + [F.col(NKEY), F.col(line)]


def bound_key_names(order: str = "ordinal") -> list[str]:
    return key_names(order) + [NKEY]
