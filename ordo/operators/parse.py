"""Turn raw lines into typed rows and set malformed lines aside.

All of it is one narrow projection (plus a filter) over the scan: no shuffle,
no Python. ``value`` is the column name ``spark.read.text`` produces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordo.functions.lines import parse_number, reject_reason, text_slice

PARSED_COLUMNS = ("number", "text", "line")


def parse_with_reason(df: DataFrame, value: str = "value") -> DataFrame:
    """Every input line with ``number, text, line, reason``; ``reason`` is null
    for a valid line and number/text are null for a rejected one."""
    v = F.col(value)
    number = parse_number(v)
    return df.select(
        number.alias("number"),
        F.when(number.isNotNull(), text_slice(v)).alias("text"),
        v.alias("line"),
        reject_reason(v, number).alias("reason"),
    )


def parse_lines(df: DataFrame, value: str = "value") -> DataFrame:
    """Valid rows only (P1 + P6): ``number bigint, text string, line string``."""
    v = F.col(value)
    number = parse_number(v)
    return (
        df.select(number.alias("number"), v.alias("line"))
        .where(F.col("number").isNotNull())
        .select("number", text_slice("line").alias("text"), "line")
    )


def valid_lines(df: DataFrame, value: str = "value") -> DataFrame:
    """Valid lines only, as a single ``line`` column (what the sort shuffles)."""
    return df.where(parse_number(value).isNotNull()).select(F.col(value).alias("line"))


def rejected_lines(df: DataFrame, value: str = "value") -> DataFrame:
    """P10: the complement of P6, ``line, reason``."""
    v = F.col(value)
    return df.select(v.alias("line"), reject_reason(v).alias("reason")).where(
        F.col("reason").isNotNull()
    )


def reject_summary(df: DataFrame, value: str = "value") -> DataFrame:
    """Count of lines per outcome: ``reason`` (``valid`` for kept lines), ``n``.
    A global aggregate with map-side partial counts: a handful of rows shuffle."""
    return (
        df.select(F.coalesce(reject_reason(value), F.lit("valid")).alias("reason"))
        .groupBy("reason")
        .agg(F.count(F.lit(1)).alias("n"))
    )
