"""Cutting rows into runs in reading order, by a running sum of their sizes."""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Accumulator, AccumulatorParam, TaskContext, cloudpickle
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

# Ship the function to Python workers by value: executors need no installed copy.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _cut(sizes: np.ndarray, limit: int, held: int, run: int) -> tuple[np.ndarray, int, int]:
    """Run number of each row after ``held`` bytes of ``run``; what is then held."""
    out = np.empty(len(sizes), np.int64)
    ends = np.cumsum(sizes)
    at, before = 0, -held
    while at < len(sizes):
        # rows that fit into the open run
        end = int(np.searchsorted(ends, before + limit, side="right"))
        if end == at and not held:
            end = at + 1  # a single row over the limit is a run
        out[at:end] = run
        if end < len(sizes):
            run, held, before = run + 1, 0, int(ends[end - 1]) if end else 0
        else:
            held = int(ends[-1]) - before
        at = end
    return out, held, run


class _Entries(AccumulatorParam):
    """Lists that tasks add entries to."""

    def zero(self, value):
        return []

    def addInPlace(self, a, b):
        return a + b


def run_entries(spark: SparkSession) -> Accumulator:
    """Where tasks record their runs: ``(split, run, rows, bytes)``, one entry per
    run. Of a write's tasks each counts once, however often it is tried."""
    return spark.sparkContext.accumulator([], _Entries())


def cut_runs(limit: int, entries: Accumulator | None = None) -> Callable[[Column], Column]:
    """An Arrow function of a size column: the run of each row of a partition. Only
    the sizes travel to Python; the open run is kept from batch to batch."""

    def number(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        held, run, done = 0, 0, []   # done: rows and bytes per run
        for sizes in batches:
            sizes = sizes.to_numpy(zero_copy_only=False)
            out, held, run = _cut(sizes, limit, held, run)
            if len(out):
                done += [[0, 0] for _ in range(run + 1 - len(done))]
                rows = np.bincount(out - out[0])
                total = np.bincount(out - out[0], weights=sizes)
                for i in range(len(rows)):
                    done[out[0] + i][0] += int(rows[i])
                    done[out[0] + i][1] += int(total[i])
            yield pa.array(out)
        if entries is not None:
            split = TaskContext.get().partitionId()
            entries.add([(split, r, n, b) for r, (n, b) in enumerate(done)])

    number.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(number, "bigint")
