"""Text files in and out (run-scan fixtures, bytes, order on disk)."""

import os

import pytest
from pyspark.errors import AnalysisException

from ordo.operators.parse import parse_lines
from ordo.plans.sort_file import sort_file
from ordo.sources.text import read_in_file_order, read_lines, read_runs, write_lines


def valid_in_file_order(spark, path):
    from ordo.sources.text import path_order

    scan = read_in_file_order(spark, path).orderBy(*path_order(), "block_start", "row_in_split")
    return [(r["number"], r["text"]) for r in parse_lines(scan).collect()]


def test_valid_data_in_file_order(spark, text_file):
    p = text_file(["1. Apple", "10. Banana", "2. Cherry"])
    assert valid_in_file_order(spark, p) == [(1, "Apple"), (10, "Banana"), (2, "Cherry")]


def test_dirty_data(spark, text_file):
    p = text_file(["1. First", "", "   ", "InvalidLine", "123 NoDot", ". NoNumber", "2. Second"])
    assert valid_in_file_order(spark, p) == [(1, "First"), (2, "Second")]


def test_empty_file(spark, text_file):
    p = text_file(b"")
    assert read_lines(spark, p).count() == 0
    assert parse_lines(read_lines(spark, p)).count() == 0


def test_only_garbage(spark, text_file):
    p = text_file(["Bad1", "Bad2", "   "])
    assert parse_lines(read_lines(spark, p)).count() == 0


def test_small_split_size(spark, text_file):
    p = text_file(["1. LongStringData", "2. Data"])
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8")
    try:
        assert sorted(valid_in_file_order(spark, p)) == [(1, "LongStringData"), (2, "Data")]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_missing_file(spark, tmp_path):
    with pytest.raises(AnalysisException):
        read_lines(spark, str(tmp_path / "nope.txt")).count()


def test_bytes_bom_line_ends_bad_utf8(spark, text_file):
    p = text_file(b"\xef\xbb\xbf3. bom\n1. lf\r2. cr\r\n4. crlf\n5. \xff\n")
    got = sorted(r["line"] for r in read_lines(spark, p).withColumnRenamed("value", "line").collect())
    assert got[:4] == ["1. lf", "2. cr", "3. bom", "4. crlf"]
    assert len(got) == 5


def test_run_scan_keeps_run_name(spark, text_file):
    a = text_file(["1. a"], "run_a.txt")
    b = text_file(["2. b", "junk"], "run_b.txt")
    runs = {(r["run"].rsplit("/", 1)[1], r["value"]) for r in read_runs(spark, [a, b]).collect()}
    assert runs == {("run_a.txt", "1. a"), ("run_b.txt", "2. b"), ("run_b.txt", "junk")}


def test_sorted_output_files_concatenate_to_total_order(spark, text_file, tmp_path):
    lines = [f"{i % 97}. {t}" for i, t in enumerate(["pear", "Apple", "fig", "apple", ""] * 400)]
    p = text_file(lines)
    out = str(tmp_path / "sorted")
    rep = sort_file(spark, p, out, partitions=6, with_stats=True).first()
    parts = sorted(f for f in os.listdir(out) if f.startswith("part-"))
    assert len(parts) > 1
    concat = []
    for f in parts:
        with open(os.path.join(out, f), encoding="utf-8") as fh:
            concat += fh.read().splitlines()
    from oracle import oracle_key
    assert concat == sorted(lines, key=oracle_key)
    assert rep["rows_in"] == rep["rows_out"] == len(lines)
    assert rep["input_bytes"] == os.path.getsize(p)


def test_crlf_output(spark, lines_df, tmp_path):
    out = str(tmp_path / "crlf")
    write_lines(lines_df(["1. a", "2. b"]).withColumnRenamed("value", "line").coalesce(1), out, line_sep="\r\n")
    part = [f for f in os.listdir(out) if f.startswith("part-")][0]
    assert open(os.path.join(out, part), "rb").read() == b"1. a\r\n2. b\r\n"
