"""Generated lines (reference generator fixtures)."""

import os

from ordo.functions.lines import well_formed
from ordo.plans.sort_file import generate_file
from ordo.sources.generator import PHRASES, generate_lines, rows_for_size


def folder_bytes(path):
    return sum(os.path.getsize(os.path.join(path, f)) for f in os.listdir(path) if f.startswith("part-"))


def test_size_window_10_mib(spark, tmp_path):
    target = 10 * 1024 * 1024
    out = str(tmp_path / "gen")
    generate_file(spark, out, target, partitions=2)
    size = folder_bytes(out)
    assert target <= size < target + 500 * 1024
    assert size < target + 64  # exact: overshoot under one line


def test_format_of_first_lines(spark):
    df = generate_lines(spark, 1000, seed=3, partitions=1)
    rows = df.select("line", well_formed("line").alias("ok")).limit(10).collect()
    for r in rows:
        dot = r["line"].index(". ")
        assert dot > 0 and r["ok"]
        n = int(r["line"][:dot])
        assert 0 <= n < 2147483647
        assert r["line"][dot + 2:] in PHRASES


def test_reproducible_across_partitioning(spark):
    a = [r["line"] for r in generate_lines(spark, 5000, seed=11, partitions=1).collect()]
    b = [r["line"] for r in generate_lines(spark, 5000, seed=11, partitions=7).collect()]
    c = [r["line"] for r in generate_lines(spark, 5000, seed=12, partitions=7).collect()]
    assert a == b and a != c


def test_blank_every(spark, tmp_path):
    out = str(tmp_path / "blank")
    n = rows_for_size(spark, 50_000, blank_every=100)
    generate_file(spark, out, 50_000, blank_every=100)
    text = spark.read.text(out)
    assert text.where("value = ''").count() == n // 100
    assert 50_000 <= folder_bytes(out) < 50_000 + 64


def test_all_phrases_used(spark):
    seen = {r["line"].split(". ", 1)[1] for r in generate_lines(spark, 2000).collect()}
    assert seen == set(PHRASES)


def test_sorted_generated_lines_are_balanced(spark):
    """11 phrases: the whole key (text, number, line) lets ranges cut inside a
    phrase, so partitions are even in rows."""
    from pyspark.sql import functions as F

    from ordo.operators.sort import sort_lines

    n = 200_000
    out = sort_lines(generate_lines(spark, n, seed=9), partitions=8)
    sizes = [r["c"] for r in out.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("c")).collect()]
    assert sum(sizes) == n and len(sizes) == 8
    assert max(sizes) < 1.3 * n / 8 and min(sizes) > 0.7 * n / 8
