"""The run report.

One row per run: ``label, rows_in, rows_out, rows_rejected, input_bytes,
elapsed_s, mb_per_s``. ``rows_out`` is observed on the written result (above
the sort: the sampling pass of the range exchange would count input twice
below it); the input counts come from one separate aggregate over the input.
Peak memory and per-thread times belong to Spark's executor metrics and
event log, not to this table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

REPORT_SCHEMA = (
    "label string, rows_in long, rows_out long, rows_rejected long, "
    "input_bytes long, elapsed_s double, mb_per_s double"
)


def run_report(spark: SparkSession, label: str, rows_in: int, rows_out: int, rows_rejected: int,
               input_bytes: int, elapsed_s: float) -> DataFrame:
    """A2: the one-row report (MB = 2^20 bytes, as the reference reports)."""
    mbps = (input_bytes / 1048576.0) / elapsed_s if elapsed_s > 0 else None
    return spark.createDataFrame(
        [(label, rows_in, rows_out, rows_rejected, input_bytes, float(elapsed_s), mbps)], REPORT_SCHEMA
    )


def append_report(report: DataFrame, path: str) -> None:
    """Append the report as JSON lines to a shared folder."""
    report.coalesce(1).write.mode("append").json(path)


def report_summary(spark: SparkSession, path: str) -> DataFrame:
    """One row per label over all appended reports."""
    reports = spark.read.schema(REPORT_SCHEMA).json(path)
    return reports.groupBy("label").agg(
        F.count(F.lit(1)).alias("runs"),
        F.sum("rows_in").alias("rows_in"),
        F.sum("rows_out").alias("rows_out"),
        F.sum("rows_rejected").alias("rows_rejected"),
        F.avg("elapsed_s").alias("avg_elapsed_s"),
        F.min("elapsed_s").alias("best_elapsed_s"),
        F.avg("mb_per_s").alias("avg_mb_per_s"),
    )
