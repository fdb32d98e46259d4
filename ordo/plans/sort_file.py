"""Entry points a user runs: sort files, cut and merge runs, generate a file.

* ``sort_file``: sample a few byte ranges for the cuts -> read -> send lines to
  their ranges -> sort -> write, and a report. Output is a folder of part files
  whose name order is the total order (concatenate them for one file; producing
  one file from one task is deliberately not offered).
* ``split_and_sort`` / ``merge_files``: the two phases as separate jobs. Runs
  are stretches of the input sorted in place (no shuffle); merging is one shuffle
  for any number of runs. Inputs are never deleted.
* ``generate_file``: a reproducible file of (at least) a target size.
"""

from __future__ import annotations

import math
import re
import time
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ordo.functions.cuts import run_entries
from ordo.functions.prefix import LeadPlan, plan_from_sample
from ordo.functions.splitters import Splitters, pick_splitters, sample_keys
from ordo.operators.sort import merge_runs, sort_lines, sorted_runs
from ordo.plans.report import append_report, run_report
from ordo.session import derived_session
from ordo.sources.generator import generate_sized
from ordo.sources.sampling import sample_lines
from ordo.sources.text import input_bytes, read_lines, write_lines, write_manifest, write_runs

# Sizes of a sort, all documented parameters without switches:
# a sorted output partition holds RANGE_BYTES of input (less where that is under one
# range per core), and more only where a core would get over RANGES_PER_CORE of them.
# It holds at most TARGET_PARTITION_BYTES of input and at
# most SPILLS + 1 times what one task's share of execution memory sorts without
# spilling. Sorting keeps each row as an UnsafeRow plus its keys and a
# pointer/prefix pair: measured 7x the input bytes for 26-byte lines (peak
# execution memory 448 MB for a 64 MB partition), so 8x is used.
RANGE_BYTES = 16 << 20
RANGES_PER_CORE = 32
TARGET_PARTITION_BYTES = 1 << 30
SORT_EXPANSION = 8
SPILLS = 1
# A map task writes one block per range; input splits are made large enough that
# a block holds this much, so a sort of many ranges does not drown in tiny reads.
MIN_BLOCK_BYTES = 64 << 10

_UNITS = {"": 1, "k": 1 << 10, "m": 1 << 20, "g": 1 << 30, "t": 1 << 40}


def _size_conf(value: str, default_unit: str = "m") -> int:
    """Parse a Spark size setting (``8g``, ``512m``, ``134217728b``); a bare
    number takes ``default_unit`` (MiB for memory settings, bytes for others)."""
    m = re.fullmatch(r"\s*(\d+(?:\.\d+)?)\s*([kmgt]?)(i?b)?\s*", value.lower())
    if not m:
        raise ValueError(f"not a size: {value!r}")
    num, unit, suffix = m.groups()
    if not unit and not suffix:
        unit = default_unit
    return int(float(num) * _UNITS[unit])


def task_sort_memory(spark: SparkSession) -> int:
    """Execution memory one task can expect: (heap - 300 MB reserved) x
    ``spark.memory.fraction`` / task slots per JVM (driver heap in local mode)."""
    conf = spark.sparkContext.getConf()
    local = conf.get("spark.master", "").startswith("local")
    heap = _size_conf(conf.get("spark.driver.memory" if local else "spark.executor.memory", "1g"))
    slots = spark.sparkContext.defaultParallelism if local else int(conf.get("spark.executor.cores", "1"))
    usable = (heap - (300 << 20)) * float(conf.get("spark.memory.fraction", "0.6"))
    return max(1 << 20, int(usable / max(1, slots)))


@dataclass(frozen=True)
class SortSizes:
    partitions: int           # ranges
    split_bytes: int          # input bytes per map task, at most


def sort_sizes(size: int, memory: int, cores: int, split_bytes: int,
               target_bytes: int = TARGET_PARTITION_BYTES, partitions: int | None = None) -> SortSizes:
    """Sizes for sorting ``size`` bytes with ``memory`` bytes of execution memory
    per task: ranges of RANGE_BYTES, larger where there would be over RANGES_PER_CORE of
    them, but of at most ``target_bytes`` and such that they spill at most SPILLS times
    (one per core at least), and input splits of ``split_bytes`` or as large as
    blocks of MIN_BLOCK_BYTES ask."""
    wanted = max(RANGE_BYTES, math.ceil(size / (cores * RANGES_PER_CORE)))
    per_range = max(1, min(target_bytes, wanted, (SPILLS + 1) * memory // SORT_EXPANSION))
    n = partitions or max(cores, math.ceil(size / per_range))
    return SortSizes(n, max(split_bytes, min(n * MIN_BLOCK_BYTES, size // cores)))


def _split_setting(spark: SparkSession) -> int:
    return _size_conf(spark.conf.get("spark.sql.files.maxPartitionBytes", "128m"), default_unit="")


def _scanned(spark: SparkSession, inputs, target_bytes: int, size: int, partitions: int | None, order: str,
             lead: bool, replace_invalid: bool) -> tuple[DataFrame, Splitters, LeadPlan | None]:
    """The lines of ``inputs``, read in splits of the sort's size (the caller's
    session stays as it is), with cuts and leading key from one sample of them."""
    sizes = sort_sizes(size, task_sort_memory(spark), spark.sparkContext.defaultParallelism, _split_setting(spark),
                       target_bytes, partitions)
    own = derived_session(spark, {"spark.sql.files.maxPartitionBytes": str(sizes.split_bytes)})
    keys = _sampled(spark, inputs, sizes.partitions, order)
    return read_lines(own, inputs, replace_invalid), pick_splitters(keys, sizes.partitions, order), _lead(keys, order) if lead else None


def _sampled(spark: SparkSession, inputs, ranges: int, order: str) -> list[tuple]:
    lines = sample_lines(spark, inputs if isinstance(inputs, str) else list(inputs), ranges).lines
    return sample_keys(spark.createDataFrame(pa.table({"line": pa.array(lines, pa.string())})), order)


def _lead(keys: list[tuple], order: str) -> LeadPlan | None:
    """Texts that need the UTF-16 key (the second one) are not for the leading key."""
    return plan_from_sample([(k[0], k[-2]) for k in keys if order != "ordinal" or k[1] is None])


def sort_file(spark: SparkSession, inputs, output_dir: str, order: str = "ordinal",
              partitions: int | None = None, label: str = "sort", report_path: str | None = None,
              line_sep: str | None = None, compression: str | None = None, lead: bool = True,
              target_partition_bytes: int = TARGET_PARTITION_BYTES, replace_invalid: bool = False,
              with_stats: bool = True) -> DataFrame:
    """Sort the valid lines of ``inputs`` into ``output_dir``; return the A2 report.

    ``partitions`` and the input split size follow from the input size (file-system
    metadata) by ``sort_sizes``; the cuts between ranges, and the leading sort key
    (``lead``), from a sample of a few byte ranges. The input is read once, and
    the plan is the same at every size. ``rows_in``, ``rows_out`` and ``rows_rejected`` are observed in
    that one job. ``with_stats=False`` leaves rejected lines behind before the shuffle and
    ``rows_in`` and ``rows_rejected`` null. ``replace_invalid`` turns bytes that
    are not UTF-8 into U+FFFD; otherwise they pass through unchanged."""
    t0 = time.perf_counter()
    size = input_bytes(spark, inputs)
    lines, cuts, plan = _scanned(spark, inputs, target_partition_bytes, size, partitions, order, lead, replace_invalid)
    seen, kept = Observation(f"rows_in_{label}"), Observation(f"rows_out_{label}")
    sorted_ = sort_lines(lines, "value", order, splitters=cuts, plan=plan, counted=seen if with_stats else None)
    write_lines(sorted_.observe(kept, F.count(F.lit(1)).alias("rows_out")), output_dir,
                line_sep=line_sep, compression=compression)
    elapsed = time.perf_counter() - t0
    rows_out = int(kept.get["rows_out"])
    rows_in = int(seen.get["rows_in"]) if with_stats else None
    report = run_report(spark, label, rows_in, rows_out, rows_in - rows_out if with_stats else None, size, elapsed)
    if report_path:
        append_report(report, report_path)
    return report


def split_and_sort(spark: SparkSession, inputs, runs_dir: str, max_run_bytes: int | None = None,
                   order: str = "ordinal", lead: bool = True, replace_invalid: bool = False) -> DataFrame:
    """Phase 1: write sorted runs, each a file ``run=K/part-N...`` of lines that follow
    each other in the input and whose memory estimates (P9) sum to at most
    ``max_run_bytes`` (a longer single line is a run). Returns the manifest,
    ``run_id`` (``run=K/part-N``), ``n, est_bytes``, which the writing tasks
    record and ``runs_dir`` keeps (``read_manifest``).

    By default a run is as large as one task can sort in its execution memory
    (and no larger than ``spark.sql.files.maxPartitionBytes``), the Spark
    counterpart of a chunk size given as a memory budget."""
    if max_run_bytes is None:
        max_run_bytes = max(1 << 20, min(_split_setting(spark), task_sort_memory(spark) // SORT_EXPANSION))
    own = derived_session(spark, {"spark.sql.files.maxPartitionBytes": str(int(max_run_bytes))})
    plan = _lead(_sampled(spark, inputs, 1, order), order) if lead else None
    entries = run_entries(spark)
    runs = sorted_runs(read_lines(own, inputs, replace_invalid), "value", order, plan=plan,
                       run_bytes=int(max_run_bytes), entries=entries)
    write_runs(runs, runs_dir)
    return write_manifest(spark, runs_dir, entries.value)


def merge_files(spark: SparkSession, run_paths, output_dir: str, order: str = "ordinal",
                partitions: int | None = None, lead: bool = True,
                target_partition_bytes: int = TARGET_PARTITION_BYTES, replace_invalid: bool = False) -> None:
    """Phase 2: merge run files (sorted or not, any number) into ``output_dir``. The
    cuts are lines at even byte distances of the runs: quantiles, as runs are
    sorted. The runs are read once."""
    size = input_bytes(spark, run_paths)
    lines, cuts, plan = _scanned(spark, run_paths, target_partition_bytes, size, partitions, order, lead, replace_invalid)
    write_lines(merge_runs(lines, "value", order, plan=plan, splitters=cuts), output_dir)


def generate_file(spark: SparkSession, path: str, size_bytes: int, seed: int = 42,
                  partitions: int | None = None, blank_every: int | None = None) -> None:
    """Write a folder of generated lines taking ``size_bytes`` (plus less than
    one line) on disk."""
    write_lines(generate_sized(spark, size_bytes, seed, partitions, blank_every), path)
