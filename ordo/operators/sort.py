"""Total sort, sorted runs, merge of runs, preview.

Plan of a total sort of files (``sort_lines`` with splitters)::

    scan -> line or null -> Project range (binary search in the cuts), null without a number
         -> Exchange repartitionById -> Project keys (number through the guard)
         -> CollectMetrics -> filter number not null -> Sort (within partition) -> Project line

* Only ``line`` and its range cross the shuffle. The keys are recomputed from
  the line after the exchange: carrying them instead nearly doubled the
  compressed shuffle (365 MB to 685 MB per 512 MB of lines, measured), and on
  a cluster the shuffle is the scarcer resource.
* The cuts are whole keys (text key, number, head of the line; the text once),
  so ties on text are cut by number, and a single line repeated in bulk (one
  value may hold a third of all rows) is as many cuts as its share: its rows
  are dealt over the ranges between them (``functions.splitters``).
* Without splitters the range partitioner samples the same key, and a salt (the row's
  position in its input partition in blocks of 65,536) cuts repeated lines.
  It is reproduced on a task retry when the input's row order is (file scans and
  narrow transformations of them), like the dealing above; sort
  the output of a shuffle only after writing or ``checkpoint()``-ing it.
* Keys are bound in a projection below the sort, so each row computes its
  keys once, not once per comparison.
* A leading 64-bit key (``functions.prefix``) lets rows of frequent texts be
  ordered by Spark's sort prefix alone instead of reading both rows on every
  comparison; it is built from a small sample and never changes the order.
* The output partitions are in key order: partition files written in name
  order concatenate to the total order.
"""

from __future__ import annotations

import uuid

from pyspark import Accumulator
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ordo.functions.keys import (
    NKEY, TKEY, TKEY2, bind_keys, bound_key_names, bound_order, key_columns_of_line, range_keys_of_line,
)
from ordo.functions.lines import memory_estimate, number_of_valid, parse_number, text_slice
from ordo.functions.prefix import LeadPlan, lead_key, sample_plan
from ordo.functions.cuts import cut_runs
from ordo.functions.splitters import Splitters, to_ranges

LEAD = "_lead"
RUN = "run"

SALT = "_salt"
SALT_BLOCK_BITS = 16


def _only_valid(df: DataFrame, line: str, validate: bool) -> DataFrame:
    out = df.select(F.col(line).alias("line"))
    if validate:
        out = out.where(parse_number("line").isNotNull())
    return out


def range_partition(
    lines: DataFrame,
    order: str = "ordinal",
    partitions: int | None = None,
    salt: bool = True,
) -> DataFrame:
    """Range-partition a ``line`` column by the full sort key.

    ``partitions=None`` uses ``spark.sql.shuffle.partitions`` and lets AQE
    merge adjacent small ranges (which keeps the order)."""
    keys: list[Column] = range_keys_of_line("line", order)
    if salt:
        # Row position in blocks of 2^16 rows: every (line, salt) group has at
        # most 65,536 rows whatever the input partitioning, and the value stays
        # constant over long runs, so it costs almost nothing in the compressed
        # shuffle (a per-row id made it 25% larger, measured).
        lines = lines.select("line", F.shiftright(F.monotonically_increasing_id(), SALT_BLOCK_BITS).alias(SALT))
        keys = keys + [F.col(SALT)]
    if partitions:
        out = lines.repartitionByRange(partitions, *keys)
    else:
        out = lines.repartitionByRange(*keys)
    return out.select("line")


def lead_plan(sample: DataFrame, order: str = "ordinal") -> LeadPlan | None:
    """The frequent-text dictionary of the leading key, counted over all of a
    (small) ``sample`` of lines."""
    keys = key_columns_of_line("line", order)
    plain = keys[1].isNull() if order == "ordinal" else F.lit(True)
    valid = F.when(parse_number("line").isNotNull(), number_of_valid("line"))
    return sample_plan(sample, keys[0], valid, plain)


def sort_within(lines: DataFrame, order: str = "ordinal", keep_keys: bool = False,
                plan: LeadPlan | None = None) -> DataFrame:
    """Sort each partition by (lead, text keys, number, line) with bound keys."""
    return _sort_bound(bind_keys(lines, "line", order), order, keep_keys, plan)


def _sort_bound(bound: DataFrame, order: str, keep_keys: bool = False,
                plan: LeadPlan | None = None, first: list[str] | None = None) -> DataFrame:
    sort_cols = bound_order("line", order)
    if plan is not None:
        plain = F.col(TKEY2).isNull() if order == "ordinal" else F.lit(True)
        bound = bound.withColumn(LEAD, lead_key(plan, F.col(TKEY), F.col(NKEY), plain))
        sort_cols = [F.col(LEAD)] + sort_cols
    out = bound.sortWithinPartitions(*(first or []), *sort_cols)
    drop = bound_key_names(order) + ([LEAD] if plan is not None else [])
    return out if keep_keys else out.drop(*drop)


def sort_lines(
    df: DataFrame,
    line: str = "line",
    order: str = "ordinal",
    partitions: int | None = None,
    salt: bool = True,
    validate: bool = True,
    plan: LeadPlan | None = None,
    splitters: Splitters | None = None,
    counted: Observation | None = None,
) -> DataFrame:
    """O2: total sort. Returns ``line`` in range-partitioned, sorted partitions.

    With ``splitters`` (known cuts, from a sample of the input) rows go straight
    to their ranges and the input is read once. Without them Spark's range
    exchange samples: it reads the input once more. ``plan`` is the leading key.

    ``validate`` drops lines that do not parse (P6): lines without a dot become
    null before the shuffle (a cheap ``instr``), the exact guard runs once
    per row after it, as the number key itself. An ``observe`` (which
    Catalyst does not push filters through) sits between the key projection
    and the filter on that key. Without it the filter would move below the
    projection, which evaluates the number twice (15% of the key work,
    measured), and below the exchange (12% of the sort time
    on 512 MB, measured). It counts ``rows_in`` into ``counted``: above the
    exchange, in the last stage, whose tasks count once however often they or
    map tasks are tried. Lines out already cross as nulls to be counted there; without
    ``counted`` those without a dot stay behind. With ``splitters``, whose keys hold the
    number (unguarded), lines without one cross as nulls, too. Pass ``validate=False`` when the input is
    known to be valid (for example the output of ``parse_lines``)."""
    lines = df.select(F.col(line).alias("line"))
    if validate and counted is not None:
        lines = lines.select(F.when(F.instr("line", ".") > 0, F.col("line")).alias("line"))
    elif validate:
        lines = lines.where(F.instr("line", ".") > 0)
    parts = to_ranges(lines, splitters, validate) if splitters else range_partition(lines, order, partitions, salt)
    if not validate:
        return sort_within(parts, order, plan=plan)
    # Keys with the guarded number, then the count, then the filter on that
    # number: the guard and the number key are one evaluation per row.
    bound = bind_keys(parts, "line", order, guarded=True)
    seen = counted if counted is not None else f"ordo_sort_{uuid.uuid4().hex}"
    bound = bound.observe(seen, F.count(F.lit(1)).alias("rows_in"))
    return _sort_bound(bound.where(F.col(NKEY).isNotNull()), order, plan=plan)


def sort_parsed(df: DataFrame, order: str = "ordinal", partitions: int | None = None) -> DataFrame:
    """O2 on parsed rows (``number, text, line``): the same plan, parsed columns out."""
    out = sort_lines(df, "line", order, partitions, validate=False)
    return out.select(
        F.substring_index("line", ".", 1).try_cast("bigint").alias("number"),
        text_slice("line").alias("text"),
        "line",
    )


def sorted_runs(df: DataFrame, line: str = "line", order: str = "ordinal", validate: bool = True,
                plan: LeadPlan | None = None, run_bytes: int | None = None, entries: Accumulator | None = None) -> DataFrame:
    """O3: sorted runs of bounded size, no shuffle.

    A run is a stretch of one input split in reading order. With ``run_bytes`` it
    ends where the next line would take its memory estimate (P9) over that limit, so
    a run exceeds it only if it is a single line; without, it is the whole split.
    Returns ``run_id`` (of the split), ``run`` (within it, from 0) and ``line``,
    the runs of a split one after the other, each sorted; ``entries`` then hold
    ``(run_id, run, rows, estimate)`` of each once they are written. Lines that do not parse
    take no part in the estimate. As in ``sort_lines``, the guard is the number key, evaluated
    once per row (the ``observe`` keeps Catalyst from copying it into a filter
    below the key projection)."""
    lines = df.select(F.spark_partition_id().alias("run_id"), F.col(line).alias("line"))
    if validate:
        lines = lines.where(F.instr("line", ".") > 0)
    bound = bind_keys(lines, "line", order, guarded=validate)
    if validate:
        bound = bound.observe(f"ordo_runs_{uuid.uuid4().hex}", F.count(F.lit(1)).alias("rows_with_dot"))
        bound = bound.where(F.col(NKEY).isNotNull())
    run = cut_runs(run_bytes, entries)(memory_estimate("line")) if run_bytes else F.lit(0).cast("bigint")
    return _sort_bound(bound.withColumn(RUN, run), order, plan=plan, first=[RUN]).select("run_id", "run", "line")


def merge_runs(runs: DataFrame, line: str = "line", order: str = "ordinal", partitions: int | None = None,
               validate: bool = True, plan: LeadPlan | None = None, splitters: Splitters | None = None) -> DataFrame:
    """Merge any number of runs (bag union) into one total order.

    One shuffle whatever the run count: there is no fan-in limit and no merge
    pass. ``splitters`` are quantiles of the runs (``sources.sampling`` reads them
    off sorted files); every run is then read once, and a range meets its
    pieces in order, which Spark's sort merges as they are. Inputs need not be sorted."""
    return sort_lines(runs, line, order, partitions, validate=validate, plan=plan, splitters=splitters)


def top_lines(df: DataFrame, n: int = 10, line: str = "line", order: str = "ordinal",
              validate: bool = True) -> DataFrame:
    """The first ``n`` lines of the sorted result without a full sort.

    Plans as ``TakeOrderedAndProject``: each task keeps an ``n``-row heap, the
    driver merges one heap per task."""
    lines = bind_keys(_only_valid(df, line, validate), "line", order)
    return lines.orderBy(*bound_order("line", order)).limit(n).select("line")


def first_lines(df: DataFrame, n: int = 10, value: str = "value") -> DataFrame:
    """The first ``n`` lines in reading order (a ``limit``, no sort)."""
    return df.select(F.col(value).alias("line")).limit(n)


__all__ = [
    "range_partition", "sort_within", "sort_lines", "sort_parsed", "sorted_runs",
    "merge_runs", "top_lines", "first_lines", "TKEY", "NKEY",
]
