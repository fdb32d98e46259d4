"""Known range cuts: which range a line belongs to, as a column expression.

``n`` ranges are cut by ``n - 1`` keys of a sample, in order. A row's range is the
number of cuts at or below its key, found by a binary search; the cuts are one
array literal. A key that is several cuts at
once (a line repeated in bulk) owns the ranges between them: its rows, which are
interchangeable, are dealt over these by their position.

Unlike a range exchange this needs no pass over the input to find the cuts.
"""

from __future__ import annotations

import base64
import json
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordo.functions.keys import range_keys_of_line
from ordo.functions.lines import parse_number

KEY_TYPES = {"ordinal": ("string", "binary", "bigint", "string"), "utf8": ("string", "bigint", "string")}
TREE = 63       # cuts compared one by one
DEAL_BITS = 8   # rows of a repeated line go to its ranges in blocks of 2^DEAL_BITS


@dataclass(frozen=True)
class Splitters:
    cuts: tuple[str, ...]   # keys as JSON, ascending, repeats kept
    order: str
    ranges: int


def _key(line: str, order: str) -> Column:
    keys = range_keys_of_line(line, order)
    return F.struct(*[k.cast(t).alias(f"k{i}") for i, (k, t) in enumerate(zip(keys, KEY_TYPES[order]))])


def sample_keys(sample: DataFrame, order: str = "ordinal", line: str = "line") -> list[tuple]:
    """The keys of the valid lines of a (bounded) sample, in order, on the driver."""
    rows = sample.where(parse_number(line).isNotNull()).select(_key(line, order).alias("k")).select("k.*").toArrow()
    keys = list(zip(*(c.to_pylist() for c in rows.columns))) if rows.num_rows else []
    plain = lambda v: (v is not None, v.encode() if isinstance(v, str) else v)  # noqa: E731  nulls first, texts by their bytes
    return sorted(keys, key=lambda k: tuple(map(plain, k)))


def pick_splitters(keys: list[tuple], ranges: int, order: str = "ordinal") -> Splitters:
    """Evenly spaced ones of sorted sample keys (a small sample gives a cut twice)."""
    def as_json(key):
        told = {f"k{i}": base64.b64encode(v).decode() if isinstance(v, bytes) else v for i, v in enumerate(key) if v is not None}
        return json.dumps(told)
    cuts = [keys[i * len(keys) // ranges] for i in range(1, ranges)] if keys else []
    return Splitters(tuple(map(as_json, cuts)), order, ranges)


def _tree(cuts: Column, places: list[int]) -> Column:
    """How many of the cuts at ``places`` (ascending) are at or below the key, as the
    place of the last of them (0: none), by balanced comparisons."""
    def search(low: int, high: int) -> Column:
        if low == high:
            return F.lit(places[low - 1] if low else 0)
        middle = (low + high + 1) // 2
        return F.when(F.get(cuts, F.lit(places[middle - 1] - 1)) <= F.col("_key"), search(middle, high)).otherwise(search(low, middle - 1))
    return search(0, len(places))


def range_of(line: str, splitters: Splitters) -> tuple[Column, Column, Column]:
    """``(key, at, range)``: the key to bind as ``_key``; from it the number of cuts
    at or below, to bind as ``_at``; from both the range.

    The search starts with a tree of at most TREE comparisons, which Spark
    compiles; a fold over powers of two goes on between two of its cuts."""
    n, order = len(splitters.cuts), splitters.order
    if n == 0:
        return _key(line, order), F.lit(0), F.lit(0)
    ddl = ", ".join(f"k{i}: {t}" for i, t in enumerate(KEY_TYPES[order]))
    cuts = F.from_json(F.lit("[" + ",".join(splitters.cuts) + "]"), f"array<struct<{ddl}>>")
    stride = -(-n // TREE)
    at = _tree(cuts, list(range(stride, n + 1, stride)))
    if stride > 1:
        steps = F.array(*[F.lit(1 << b) for b in reversed(range((stride - 1).bit_length()))])
        at = F.aggregate(steps, at, lambda low, step: F.when(
            (low + step <= n) & (F.get(cuts, low + step - 1) <= F.col("_key")), low + step).otherwise(low))
    if len(set(splitters.cuts)) == n:
        return _key(line, order), at, F.col("_at")
    firsts = [0] * n
    for i in range(1, n):
        firsts[i] = firsts[i - 1] if splitters.cuts[i] == splitters.cuts[i - 1] else i
    first = F.get(F.from_json(F.lit(json.dumps(firsts)), "array<int>"), F.col("_at") - 1)
    dealt = first + F.pmod(F.shiftright(F.monotonically_increasing_id(), DEAL_BITS), F.col("_at") - first + 1).cast("int")
    equal = (F.col("_at") > 0) & (F.get(cuts, F.col("_at") - 1) == F.col("_key"))
    return _key(line, order), at, F.when(equal, dealt).otherwise(F.col("_at"))


def to_ranges(lines: DataFrame, splitters: Splitters, validate: bool = False) -> DataFrame:
    """``line`` in ``splitters.ranges`` partitions, in order of their keys. A null
    line stands for one that is out already and goes anywhere. With ``validate`` a line
    whose key has no number is out, too, and becomes null: the sample knows only valid
    lines, so its cuts do not part the others (prose that ends at its first dot has an empty text)."""
    key, at, number = range_of("line", splitters)
    placed = lines.select("line", key.alias("_key")).select("line", "_key", at.alias("_at"))
    counts = F.col(f"_key.k{len(KEY_TYPES[splitters.order]) - 2}").isNotNull()   # the number
    placed = placed.select(F.when(counts, F.col("line")).alias("line") if validate else "line", number.alias("_range"))
    anywhere = F.pmod(F.shiftright(F.monotonically_increasing_id(), DEAL_BITS), F.lit(splitters.ranges)).cast("int")
    placed = placed.select("line", F.when(F.col("line").isNull(), anywhere).otherwise(F.col("_range")).alias("_range"))
    return placed.repartitionById(splitters.ranges, "_range").select("line")
