"""V1-V7: checks a user runs after a sort.

V1 (sortedness) needs adjacent pairs in file order. Rows of one file split
are read by one task in file order, so adjacent pairs are compared inside
each scan partition by ``mapInArrow`` (Arrow compute kernels): one pass, no shuffle, one summary row
per split. Boundaries between splits of a file, and between files for a total
order, are then compared on those small summaries.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ordo.functions.keys import binary_text_key
from ordo.functions.lines import number_of_valid, parse_number, text_slice, well_formed
from ordo.sources.text import file_index, file_order, read_in_file_order

# Ship this module's functions to Python workers by value, so executors need
# no installed copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

SPLIT_SUMMARY_SCHEMA = (
    "file_id long, block_start long, n long, violations long, "
    "first_k binary, first_n long, last_k binary, last_n long"
)


_SUMMARY_ARROW = pa.schema([
    ("file_id", pa.int64()), ("block_start", pa.int64()),
    ("n", pa.int64()), ("violations", pa.int64()),
    ("first_k", pa.binary()), ("first_n", pa.int64()),
    ("last_k", pa.binary()), ("last_n", pa.int64()),
])


def _keyed_scan(spark: SparkSession, paths, order: str, replace_invalid: bool) -> DataFrame:
    scan = read_in_file_order(spark, paths, replace_invalid).where(parse_number("value").isNotNull())
    return scan.select(
        F.xxhash64("file_path").alias("file_id"), "block_start",
        binary_text_key(text_slice("value"), order).alias("k"), number_of_valid("value").alias("n"),
    )


def _split_summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per scan partition: count adjacent pairs out of (text, number) order
    within each split; carry the open split across Arrow batches. Pair
    comparisons run as Arrow compute kernels; Python only visits the few
    split boundaries of a batch."""
    out: list[list] = []
    open_split: list | None = None  # [split id, n, violations, first key, last key]

    for rb in batches:
        rows = rb.num_rows
        if rows == 0:
            continue
        fn, bs = rb.column("file_id"), rb.column("block_start")
        k, n = rb.column("k"), rb.column("n")
        if rows > 1:
            def pair(op, col):
                return op(col.slice(0, rows - 1), col.slice(1))
            same = pc.and_(pair(pc.equal, fn), pair(pc.equal, bs))
            out_of_order = pc.or_(
                pair(pc.greater, k),
                pc.and_(pair(pc.equal, k), pair(pc.greater, n)),
            )
            same_np = same.to_numpy(zero_copy_only=False).astype(bool)
            bad = (pc.and_(same, out_of_order).to_numpy(zero_copy_only=False)).astype(np.int64)
        else:
            same_np = np.zeros(0, dtype=bool)
            bad = np.zeros(0, dtype=np.int64)
        starts = np.concatenate([[0], np.flatnonzero(~same_np) + 1]).astype(np.int64)
        ends = np.append(starts[1:], rows)
        cum = np.concatenate([[0], np.cumsum(bad)])
        for s, e in zip(starts.tolist(), ends.tolist()):
            sid = (fn[s].as_py(), bs[s].as_py())
            first = (k[s].as_py(), n[s].as_py())
            last = (k[e - 1].as_py(), n[e - 1].as_py())
            viol = int(cum[e - 1] - cum[s])  # pairs (i, i+1) for i in [s, e-2]
            if open_split is not None and open_split[0] == sid:
                viol += int(open_split[4] > first)
                open_split[1] += e - s
                open_split[2] += viol
                open_split[4] = last
            else:
                if open_split is not None:
                    out.append(open_split)
                open_split = [sid, e - s, viol, first, last]
    if open_split is not None:
        out.append(open_split)
    names = [c.split()[0] for c in SPLIT_SUMMARY_SCHEMA.split(", ")]
    rows_out = [
        dict(zip(names, (sid[0], sid[1], cnt, viol, f[0], f[1], l[0], l[1])))
        for sid, cnt, viol, f, l in out
    ]
    yield pa.RecordBatch.from_pylist(rows_out, schema=_SUMMARY_ARROW)


def _key(prefix: str) -> Column:
    return F.struct(F.col(f"{prefix}_k"), F.col(f"{prefix}_n"))


def _file_names(spark: SparkSession, paths) -> DataFrame:
    """``file_id, file_name`` per input file, from the file listing alone (the
    binary-file source reads no content when ``content`` is not selected)."""
    from ordo.sources.text import _paths

    # the hash must be of the same spelling as the text scan's: both take the metadata column
    listing = spark.read.format("binaryFile").load(_paths(paths))
    return listing.select(
        F.xxhash64("_metadata.file_path").alias("file_id"), F.col("_metadata.file_name").alias("file_name")
    )


def check_sorted(spark: SparkSession, paths, order: str = "ordinal", replace_invalid: bool = False) -> DataFrame:
    """V1 (+A3): per file ``file_name, file_index, n, violations, follows_previous``.

    ``violations`` counts adjacent pairs within the file that are out of
    (text, number) order (lines equal on both may come in any order).
    ``follows_previous`` is false when the file's first row sorts before the
    previous file's last row (files ordered by part number, then name), which
    breaks a total order across files. ``replace_invalid`` compares texts with U+FFFD in
    place of bytes that are not UTF-8. Rows carry a 64-bit hash of their file
    path, not its name; names join back on the per-file table."""
    splits = _keyed_scan(spark, paths, order, replace_invalid).mapInArrow(_split_summaries, SPLIT_SUMMARY_SCHEMA)
    # Small tables from here on: one row per split, then one per file.
    w_split = Window.partitionBy("file_id").orderBy("block_start")
    splits = splits.withColumn(
        "boundary_bad",
        F.coalesce(F.lag(_key("last")).over(w_split) > _key("first"), F.lit(False)).cast("long"),
    )
    files = splits.groupBy("file_id").agg(
        F.sum("n").alias("n"),
        (F.sum("violations") + F.sum("boundary_bad")).alias("violations"),
        F.min(F.struct("block_start", _key("first").alias("k")))["k"].alias("first_key"),
        F.max(F.struct("block_start", _key("last").alias("k")))["k"].alias("last_key"),
    ).join(_file_names(spark, paths), "file_id", "left")  # a summary without a name stays, and fails the check
    w_file = Window.orderBy(*file_order("file_name"))
    return files.select(
        "file_name", file_index("file_name").alias("file_index"), "n", "violations",
        F.coalesce(F.lag("last_key").over(w_file) <= F.col("first_key"), F.lit(True)).alias("follows_previous"),
    )


def sorted_summary(checked: DataFrame) -> DataFrame:
    """One row: ``files, n, violations, total_order`` over ``check_sorted``.

    ``total_order`` is true only if at least one file was read, every file is
    known by name, no file has a violation and each follows the one before."""
    return checked.agg(
        F.count(F.lit(1)).alias("files"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("n"),
        F.coalesce(F.sum("violations"), F.lit(0)).alias("violations"),
        F.coalesce(F.bool_and(F.col("follows_previous") & (F.col("violations") == 0) & F.col("file_name").isNotNull()),
                   F.lit(False)).alias("total_order"),
    )


POSITION_BLOCK = 1 << 16   # positions under one digest


def order_equal(actual: DataFrame, expected: DataFrame, block: int = POSITION_BLOCK) -> DataFrame:
    """V2: compare two ``(pos, line)`` results; one row ``n_actual, n_expected,
    mismatches``.

    Each side is first summed up by blocks of positions: rows, and the exact sum of
    128 bits of hashes of (pos, line), by map-side aggregation; no row is
    shuffled. Rows meet (joined by position) only in blocks whose sums differ. Both
    sides are read a second time for these blocks, so they should be files or
    checkpoints, not plans that sort again."""
    def sums(df: DataFrame, side: str) -> DataFrame:
        digest = lambda seed: F.sum(F.xxhash64(F.lit(seed), "pos", "line").cast("decimal(38,0)"))
        return df.groupBy(F.floor(F.col("pos") / block).alias("b")).agg(
            F.count(F.lit(1)).alias(f"n_{side}"), F.struct(F.count(F.lit(1)), digest(1), digest(2)).alias(side))

    both = sums(actual, "a").join(sums(expected, "e"), "b", "full_outer")
    differ = both.where(~F.equal_null(F.col("a"), F.col("e"))).select("b")
    rows = lambda df, name: df.withColumn("b", F.floor(F.col("pos") / block)).join(
        differ, "b", "left_semi").select("pos", F.col("line").alias(name))
    wrong = rows(actual, "x").join(rows(expected, "y"), "pos", "full_outer").agg(
        F.count_if(~F.equal_null(F.col("x"), F.col("y"))).alias("mismatches"))
    counts = both.agg(F.coalesce(F.sum("n_a"), F.lit(0)).alias("n_actual"), F.coalesce(F.sum("n_e"), F.lit(0)).alias("n_expected"))
    return counts.join(wrong)  # one-row tables


def format_check(df: DataFrame, line: str = "line") -> DataFrame:
    """V3: ``ok, n``: lines that do / do not have the strict generated format."""
    return df.groupBy(well_formed(line).alias("ok")).agg(F.count(F.lit(1)).alias("n"))


def size_in_window(size_bytes: Column, target_bytes: int, slack_bytes: int = 500 * 1024) -> Column:
    """V4: ``target <= size < target + slack``."""
    return (size_bytes >= F.lit(target_bytes)) & (size_bytes < F.lit(target_bytes + slack_bytes))


def bag_fingerprint(df: DataFrame, line: str = "line") -> DataFrame:
    """Row count and an order-free fingerprint of a bag of lines (exact decimal
    sum of 64-bit hashes: no overflow at any row count)."""
    return df.agg(
        F.count(F.lit(1)).alias("n"),
        F.coalesce(F.sum(F.xxhash64(line).cast("decimal(38,0)")), F.lit(0).cast("decimal(38,0)")).alias("h"),
    )


def bag_equal(left: DataFrame, right: DataFrame, line: str = "line") -> DataFrame:
    """V7: ``rows_in, rows_out, same``: same count and same multiset
    fingerprint (a lost, added or duplicated line changes it)."""
    both = bag_fingerprint(left, line).withColumn("side", F.lit(0)).unionByName(
        bag_fingerprint(right, line).withColumn("side", F.lit(1))
    )
    pick = lambda c, side: F.max(F.when(F.col("side") == side, F.col(c)))
    return both.agg(
        pick("n", 0).alias("rows_in"), pick("n", 1).alias("rows_out"),
        pick("h", 0).alias("_hi"), pick("h", 1).alias("_ho"),
    ).select(
        "rows_in", "rows_out",
        ((F.col("rows_in") == F.col("rows_out")) & (F.col("_hi") == F.col("_ho"))).alias("same"),
    )
