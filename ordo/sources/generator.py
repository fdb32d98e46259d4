"""Reproducible random ``NUMBER. TEXT`` lines, optionally sized.

Each line is a pure function of its row id and the seed (hashes, not a
per-partition random stream), so the same seed gives the same lines with any
partition count, and any id range can be regenerated on its own. That is what
makes the sized variant exact without writing anything twice: the row count
whose bytes first reach the target is found from block byte-sums, narrowing
one block at a time, then exactly that many lines are generated.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The phrase list and the number range [0, 2147483647).
PHRASES = (
    "Apple", "Banana is yellow", "Cherry is the best", "Something something something",
    "Avocado", "Zero", "This is a very long string to test memory allocation",
    "Short", "A", "Zebra", "123 test 321",
)
NUMBER_BOUND = 2147483647
# Derived: mean phrase length 14.0, mean decimal digits of the number 9.48,
# plus ". " and the newline.
MEAN_LINE_BYTES = 26.48
_NARROW_BLOCKS = 1024
_FINAL_BLOCK_ROWS = 4096
# Bytes of output per generating task when the partition count is not given.
PARTITION_BYTES = 256 << 20


def _partitions(spark: SparkSession, n_bytes: float, partitions: int | None) -> int:
    if partitions:
        return partitions
    return max(spark.sparkContext.defaultParallelism, math.ceil(n_bytes / PARTITION_BYTES))


def _line(id_col: Column, seed: int) -> Column:
    number = F.pmod(F.xxhash64(F.lit(seed), id_col), F.lit(NUMBER_BOUND))
    pick = F.pmod(F.xxhash64(F.lit(seed + 1), id_col), F.lit(len(PHRASES))) + 1
    phrase = F.element_at(F.array(*[F.lit(p) for p in PHRASES]), pick.cast("int"))
    return F.concat(number.cast("string"), F.lit(". "), phrase)


def _bytes_on_disk(id_col: Column, line: Column, blank_every: int | None) -> Column:
    size = F.octet_length(line) + F.lit(1)
    if blank_every:
        size = size + F.when(F.pmod(id_col, F.lit(blank_every)) == blank_every - 1, 1).otherwise(0)
    return size.cast("long")


def generate_lines(spark: SparkSession, n_lines: int, seed: int = 42, partitions: int | None = None,
                   start: int = 0, blank_every: int | None = None) -> DataFrame:
    """``line`` for row ids ``[start, start + n_lines)``.

    ``blank_every=k`` ends every k-th line with an extra newline, so the
    written file holds one blank line per k lines (as the reference file has
    one per producer batch)."""
    parts = _partitions(spark, n_lines * MEAN_LINE_BYTES, partitions)
    ids = spark.range(start, start + n_lines, 1, parts)
    line = _line(F.col("id"), seed)
    if blank_every:
        line = F.when(F.pmod("id", F.lit(blank_every)) == blank_every - 1, F.concat(line, F.lit("\n"))).otherwise(line)
    return ids.select(line.alias("line"))


def rows_for_size(spark: SparkSession, target_bytes: int, seed: int = 42,
                  blank_every: int | None = None, partitions: int | None = None) -> int:
    """The smallest row count whose lines take at least ``target_bytes``
    on disk (LF line ends). The file then overshoots by less than one line."""
    if target_bytes <= 0:
        return 0
    lo, need = 0, target_bytes
    span = int(math.ceil(target_bytes / MEAN_LINE_BYTES * 1.02)) + 1000
    while True:
        width = max(1, math.ceil(span / _NARROW_BLOCKS))
        parts = _partitions(spark, span * MEAN_LINE_BYTES, partitions)  # of this pass, not of the whole target
        ids = spark.range(lo, lo + span, 1, parts if span > _FINAL_BLOCK_ROWS else 1)
        size = _bytes_on_disk(F.col("id"), _line(F.col("id"), seed), blank_every)
        if span <= _FINAL_BLOCK_ROWS:  # a few thousand small numbers
            sizes = [r[0] for r in ids.orderBy("id").select(size).collect()]
            acc = 0
            for i, s in enumerate(sizes):
                acc += s
                if acc >= need:
                    return lo + i + 1
            lo, need, span = lo + span, need - acc, span * 2
            continue
        blocks = (
            ids.groupBy(F.floor((F.col("id") - lo) / width).alias("b"))
            .agg(F.sum(size).alias("s"))
            .collect()  # at most _NARROW_BLOCKS rows
        )
        acc = 0
        for b, s in sorted((r["b"], r["s"]) for r in blocks):
            if acc + s >= need:
                lo, need = lo + b * width, need - acc
                span = min(width, span - b * width)
                break
            acc += s
        else:  # the estimate fell short: continue after the range
            lo, need = lo + span, need - acc
            span = max(span // 2, 1000)


def generate_sized(spark: SparkSession, target_bytes: int, seed: int = 42,
                   partitions: int | None = None, blank_every: int | None = None) -> DataFrame:
    """S6+S7: lines whose written size is in ``[target, target + one line)``."""
    n = rows_for_size(spark, target_bytes, seed, blank_every, partitions)
    return generate_lines(spark, n, seed, partitions, blank_every=blank_every)
