"""Ordinal position of every row of a sorted result, without moving all
rows to one task (no unpartitioned ``row_number``).

A sorted result is a sequence of ordered partitions (or ordered file splits).
Count rows per partition (one small row each), prefix-sum those counts over
the small table, and add each partition's offset to the row's index within
the partition. The per-partition table is small (one row per partition) and is
broadcast, so rows stay in the tasks that read them: left to its estimates, which
for the counts are those of the rows, Spark shuffles and sorts all rows by partition.

The counts and the rows must come from the same execution: a sort may cut
differently when it runs again. Hence the sorted result is written first, once, as
Parquet in the shared folder: every row with its place in its partition, which
is all the read-back needs. Only that column is read to count, and no row is
shuffled or checkpointed. The folder goes when the application ends.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ordo.session import scratch_path, shared_dir

PLACE_BITS = 33   # of monotonically_increasing_id: the row within its partition


def _offsets(groups: DataFrame, group_cols: list[str], order_by) -> DataFrame:
    """Rows before each group (``_n`` rows each): a prefix sum over a small table,
    materialised so that the rows are not counted again where it is joined."""
    w = Window.orderBy(*order_by).rowsBetween(Window.unboundedPreceding, -1)
    return groups.select(*group_cols, "_first", F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_offset")).checkpoint(eager=True)


def _attach_offsets(df: DataFrame, group_cols: list[str], row_col: str, order_by=None) -> DataFrame:
    groups = df.groupBy(*group_cols).agg(
        F.count(F.lit(1)).alias("_n"), F.min(row_col).alias("_first")
    )
    return df.join(F.broadcast(_offsets(groups, group_cols, order_by or group_cols)), group_cols).withColumn(
        "pos", F.col("_offset") + (F.col(row_col) - F.col("_first")) + F.lit(1)
    ).drop("_offset", "_first")


def with_position(sorted_df: DataFrame, name: str = "pos") -> DataFrame:
    """Add a 1-based ``pos`` to a range-partitioned, partition-sorted result
    (for example the output of ``sort_lines``)."""
    spark = sorted_df.sparkSession
    path = scratch_path(spark, "positions")
    placed = sorted_df.select(F.struct("*").alias("_row"), F.monotonically_increasing_id().alias("_place"))
    placed.write.parquet(path)
    rows = spark.read.schema(placed.schema).parquet(path).withColumn("_part", F.shiftright("_place", PLACE_BITS))
    out = _attach_offsets(rows, ["_part"], "_place")
    return out.select("_row.*", F.col("pos").alias(name))


def position_in_files(ordered: DataFrame, name: str = "pos") -> DataFrame:
    """Add ``pos`` to a scan carrying the order columns of
    ``sources.text.with_scan_order`` (sorted output read back from files)."""
    from ordo.sources.text import path_order

    shared_dir(ordered.sparkSession)
    out = _attach_offsets(
        ordered, ["file_path", "block_start"], "row_in_split",
        order_by=path_order() + [F.col("block_start")],
    )
    return out.withColumnRenamed("pos", name) if name != "pos" else out
