"""Partition sizing from file-system metadata and task memory."""

import os
import subprocess
import sys

from ordo.plans.sort_file import (
    MIN_BLOCK_BYTES, SORT_EXPANSION, SPILLS, _size_conf, sort_file, sort_sizes, split_and_sort,
)
from ordo.sources.text import input_bytes


def test_size_settings():
    assert _size_conf("16g") == 16 << 30
    assert _size_conf("4096m") == 4 << 30
    assert _size_conf("512") == 512 << 20
    assert _size_conf("134217728b", "") == 134217728
    assert _size_conf("134217728", "") == 134217728
    assert _size_conf("64MiB") == 64 << 20


def test_input_bytes_from_metadata(spark, text_file, tmp_path):
    a = text_file(["1. a"] * 100)
    b = text_file(["2. b"] * 10)
    assert input_bytes(spark, [a, b]) == os.path.getsize(a) + os.path.getsize(b)
    assert input_bytes(spark, str(tmp_path / "*.txt")) == os.path.getsize(a) + os.path.getsize(b)


GB = 1 << 30


def test_sizes_at_100_tb():
    """Executors of 16 GB with 4 cores: 2.4 GB of execution memory per task."""
    size, memory = 100 << 40, int(2.4 * GB)
    s = sort_sizes(size, memory, 4000, 128 << 20)
    maps = -(-size // s.split_bytes)
    assert size / (maps * s.partitions) >= 0.99 * MIN_BLOCK_BYTES        # bytes per shuffle block
    assert size / s.partitions * SORT_EXPANSION <= (SPILLS + 1) * memory  # spills per task


def test_sizes_are_smooth():
    """No size at which the rule changes: partitions grow with the input."""
    last = 0
    for mb in (1, 10, 63, 64, 65, 1000, 10_000, 1_000_000):
        s = sort_sizes(mb << 20, 2 * GB, 8, 128 << 20)
        assert s.partitions >= last and s.split_bytes >= 128 << 20
        last = s.partitions
    assert sort_sizes(GB, 2 * GB, 8, 128 << 20, partitions=1000).partitions == 1000


def test_ranges_stay_small_as_the_input_grows():
    """12 cores, 1.4 GB for each: a range of 1 GB of lines is no larger than one of 6 GB."""
    for mb in (52, 520, 3120, 10_000):
        s = sort_sizes(mb << 20, int(1.4 * GB), 12, 128 << 20)
        assert (mb << 20) / s.partitions <= 32 << 20
    for mb in (20_000, 1_000_000):  # then larger ones, not any number of them
        s = sort_sizes(mb << 20, int(1.4 * GB), 12, 128 << 20)
        assert s.partitions <= max(12 * 32, -(-(mb << 20) * SORT_EXPANSION // ((SPILLS + 1) * int(1.4 * GB))) + 1)


def test_jobs_leave_the_session_as_it_is(spark, text_file, tmp_path):
    before = dict(spark.conf.getAll)
    p = text_file(["2. b", "1. a"] * 50)
    split_and_sort(spark, p, str(tmp_path / "runs"), max_run_bytes=64)
    sort_file(spark, p, str(tmp_path / "out"))
    assert dict(spark.conf.getAll) == before


LONG_LINES = """
import random, sys
from pyspark.sql import SparkSession
from pyspark.sql import functions as F
spark = (SparkSession.builder.master("local[4]").config("spark.ui.enabled", "false").config("spark.driver.memory", "2g")
         .config("spark.driver.maxResultSize", "24m").config("spark.checkpoint.dir", sys.argv[1] + "/ckpt").getOrCreate())
from ordo.plans.sort_file import sort_file
from ordo.operators.validate import check_sorted, sorted_summary
lines = spark.range(40000, numPartitions=8).select(F.concat(F.col("id").cast("string"), F.lit(". "), F.rpad(
    F.md5(F.col("id").cast("string")), 8000, "x")).alias("value"))
lines.write.text(sys.argv[1] + "/in")
sort_file(spark, sys.argv[1] + "/in", sys.argv[1] + "/out", partitions=8)
r = sorted_summary(check_sorted(spark, sys.argv[1] + "/out")).first()
assert r["n"] == 40000 and r["total_order"], r
"""


def test_long_lines_fit_the_driver(tmp_path):
    """The sampled lines of 8,000-character lines stay under a 24 MB result limit."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    subprocess.run([sys.executable, "-c", LONG_LINES, str(tmp_path)], check=True, cwd=root, timeout=300)
