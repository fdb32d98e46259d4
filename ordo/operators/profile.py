"""A1, A3, A4: volumes and per-run profiles.

All are aggregates with map-side partial aggregation: each task sends one
small row per group, so nothing large crosses the shuffle.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ordo.functions.keys import binary_text_key
from ordo.functions.lines import memory_estimate, number_of_valid, parse_number, text_slice

# Ship this module's functions to Python workers by value, so executors need
# no installed copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def input_stats(spark: SparkSession, paths) -> DataFrame:
    """A1 (+ counts for A2/A3) in one scan: ``files, input_bytes, rows_in,
    rows_valid, rows_rejected``. File sizes come from the scan's file
    metadata, counted once per file (empty files add 0)."""
    from ordo.sources.text import _paths

    scan = spark.read.text(_paths(paths)).select(
        F.col("_metadata.file_path").alias("f"),
        F.col("_metadata.file_size").alias("size"),
        parse_number("value").isNotNull().alias("ok"),
    )
    per_file = scan.groupBy("f", "size").agg(
        F.count(F.lit(1)).alias("n"), F.count_if("ok").alias("v")
    )
    return per_file.agg(
        F.count(F.lit(1)).alias("files"),
        F.coalesce(F.sum("size"), F.lit(0)).alias("input_bytes"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows_in"),
        F.coalesce(F.sum("v"), F.lit(0)).alias("rows_valid"),
        F.coalesce(F.sum(F.col("n") - F.col("v")), F.lit(0)).alias("rows_rejected"),
    )


def _batch_ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The first and last row of every run in every batch, by Arrow's sort."""
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = pa.Table.from_batches([batch])
        names = rows.schema.names
        rows = rows.take(pc.sort_indices(rows, sort_keys=[(n, "ascending") for n in names])).combine_chunks()
        run = pc.fill_null(pc.dictionary_encode(rows["run_id"].combine_chunks()).indices, -1).to_numpy()
        starts = np.flatnonzero(np.r_[True, run[1:] != run[:-1]])
        last = np.r_[starts[1:], len(run)] - 1
        for at, is_last in ((starts, False), (last, True)):
            some = rows.take(pa.array(at))
            yield from some.append_column("last", pa.array([is_last] * len(at))).to_batches()


def _ends(runs: DataFrame, order: str) -> DataFrame:
    """``run_id, min_line, max_line`` by (text, number, line). Each task reduces its
    Arrow batches to one first and one last line per run; only these are ranked."""
    keyed = runs.select("run_id", binary_text_key(text_slice("line"), order).alias("k"), number_of_valid("line").alias("n"), "line")
    kind = keyed.schema["run_id"].dataType.simpleString()
    few = keyed.mapInArrow(_batch_ends, f"run_id {kind}, k binary, n bigint, line string, last boolean")

    def best(last: bool, name: str) -> DataFrame:
        way = F.desc if last else F.asc
        rank = F.row_number().over(Window.partitionBy("run_id").orderBy(way("k"), way("n"), way("line")))
        return few.where(F.col("last") == last).select("run_id", F.col("line").alias(name), rank.alias("rank")).where("rank = 1").drop("rank")

    low, high = best(False, "min_line"), best(True, "max_line")
    return low.join(high, F.equal_null(low["run_id"], high["run_id"])).select(low["run_id"], "min_line", "max_line")


def run_profile(runs: DataFrame, run: str = "run_id", line: str = "line",
                word: str = "Apple", order: str = "ordinal") -> DataFrame:
    """A4 (+V5, V6, P9, F14): per run ``run_id, n, est_bytes, min_line,
    max_line, has_word, avg_bytes``; min/max by the sort order (text, number,
    line); ``avg_bytes`` is a safe ratio (null for an empty run).

    Counts and sums are hash aggregates of fixed-size values. A minimum of strings would
    make Spark sort all rows by run; the first and last lines are reduced batch by
    batch instead (``_ends``), which for sorted runs leaves two lines a batch."""
    r = F.col(run).alias("run_id")
    prof = runs.groupBy(r).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(memory_estimate(line)).alias("est_bytes"),
        F.max(F.col(line).contains(word).cast("int")).cast("boolean").alias("has_word"),
    )
    ends = _ends(runs.select(r, F.col(line).alias("line")), order)
    both = prof.join(ends, F.equal_null(prof["run_id"], ends["run_id"]), "left").select(
        prof["run_id"], "n", "est_bytes", "min_line", "max_line", "has_word")
    return both.withColumn("avg_bytes", F.try_divide(F.col("est_bytes").cast("double"), F.col("n")))


def run_sizes(manifest: DataFrame, files: DataFrame) -> DataFrame:
    """V5: one row ``runs, empty_runs, max_run_bytes`` (by the estimate) from what
    the writing tasks recorded and the listing of the files that have content
    (``sources.text.run_files``). A run that is empty on disk, or whose file is
    lost, counts as empty; so does a file that no task recorded."""
    both = manifest.select("run_id", "n", "est_bytes").join(files.select("run_id", "bytes"), "run_id", "full_outer")
    whole = (F.coalesce("n", F.lit(0)) > 0) & F.col("bytes").isNotNull()
    return both.agg(F.count(F.lit(1)).alias("runs"), F.count_if(~whole).alias("empty_runs"),
                    F.coalesce(F.max("est_bytes"), F.lit(0)).cast("bigint").alias("max_run_bytes"))


def count_conservation(before: DataFrame, runs: DataFrame, run: str = "run_id") -> DataFrame:
    """A3: ``rows_in, rows_in_runs, runs, conserved``."""
    per_run = runs.groupBy(run).agg(F.count(F.lit(1)).alias("n"))
    both = before.agg(F.count(F.lit(1)).alias("n")).select(
        F.lit(0).alias("side"), "n", F.lit(None).cast("long").alias("runs")
    ).unionByName(
        per_run.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count(F.lit(1)).alias("runs"))
        .select(F.lit(1).alias("side"), "n", "runs")
    )
    return both.agg(
        F.max(F.when(F.col("side") == 0, F.col("n"))).alias("rows_in"),
        F.max(F.when(F.col("side") == 1, F.col("n"))).alias("rows_in_runs"),
        F.max("runs").alias("runs"),
    ).withColumn("conserved", F.col("rows_in") == F.col("rows_in_runs"))
