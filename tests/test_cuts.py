"""Known cuts from a sample of byte ranges: the sort reads its input once."""

import gzip
import os
import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from joblog import job_log
from oracle import oracle_key
from ordo.functions import splitters as sp
from ordo.operators.position import with_position
from ordo.operators.profile import run_profile
from ordo.operators.sort import sort_lines
from ordo.operators.validate import check_sorted, order_equal, sorted_summary
from ordo.plans.sort_file import generate_file, sort_file
from ordo.sources import sampling
from ordo.sources.sampling import sample_lines
from ordo.sources.text import input_bytes, read_lines

TEXTS = ["", "A", "Apple", "apple", "é", "ﬁ", "\U0001F600", "a\U0001F600", "a\x00", "x", "zz"]
LINES = st.lists(st.tuples(st.integers(-3, 3), st.sampled_from(TEXTS), st.sampled_from(["{}. {}", "{}.{}", "+{}. {}", " {} .{}", "x{}.{}"])),
                 max_size=60)


def utf8_key(line):
    k = oracle_key(line)
    return (k[0].decode("utf-16-be").encode(), *k[1:])


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=LINES, sampled=LINES, ranges=st.integers(1, 9), tree=st.sampled_from([1, 2, 63]), order=st.sampled_from(["ordinal", "utf8"]))
def test_any_cuts_keep_the_order(lines_df, rows, sampled, ranges, tree, order):
    make = lambda some: [f.format(n, t).replace("+-", "-") for n, t, f in some]
    lines = make(rows)
    key = oracle_key if order == "ordinal" else utf8_key
    valid = sorted((x for x in lines if not x.startswith("x")), key=key)
    before, sp.TREE = sp.TREE, tree
    try:
        keys = sp.sample_keys(lines_df([x for x in make(sampled)]).withColumnRenamed("value", "line"), order)
        cuts = sp.pick_splitters(keys, ranges, order)
        got = [r["line"] for r in sort_lines(lines_df(lines), "value", order, splitters=cuts).collect()]
    finally:
        sp.TREE = before
    assert sorted(got) == sorted(valid) and [key(x)[:2] for x in got] == [key(x)[:2] for x in valid]


def test_cuts_are_balanced_and_deal_repeats(spark):
    """A third of all rows are one line: it is several cuts, and its rows go to all ranges between them."""
    lines = ["5. same"] * 30_000 + [f"{i}. {'abcdefgh'[i % 8]}z" for i in range(60_000)]
    random.Random(1).shuffle(lines)
    df = spark.createDataFrame([(x,) for x in lines], "line string")
    keys = sp.sample_keys(df.sample(0.05, seed=3))
    for ranges in (4, 12, 200):
        cuts = sp.pick_splitters(keys, ranges)
        parts = sp.to_ranges(df, cuts).rdd.glom().map(len).collect()
        assert len(parts) == ranges and max(parts) < 3 * len(lines) / ranges + 260


def test_sort_reads_its_input_once(spark, tmp_path):
    """Four megabytes: the rows of one pass, and under 1% more (the listing; sampled bytes are no rows)."""
    src = str(tmp_path / "in")
    generate_file(spark, src, 4 << 20, blank_every=3)  # a third are rejected
    rows = read_lines(spark, src).count()
    with job_log(spark) as log:
        report = sort_file(spark, src, str(tmp_path / "out")).first()
    assert rows <= log.records <= 1.01 * rows
    assert report["rows_in"] == rows and report["rows_rejected"] > 0.2 * rows
    assert report["rows_out"] == rows - report["rows_rejected"] == read_lines(spark, str(tmp_path / "out")).count()
    plan = sort_lines(read_lines(spark, src), "value", splitters=sp.Splitters((), "ordinal", 3))._jdf.queryExecution().toString()
    assert "rangepartitioning" not in plan


def test_long_lines_are_read_once(spark, tmp_path):
    src = str(tmp_path / "in.txt")
    lines = [f"{i}. {'abcdefg'[i % 7] * 400}" for i in range(5000)]
    open(src, "w").write("\n".join(lines))
    with job_log(spark) as log:
        sort_file(spark, src, str(tmp_path / "out"), partitions=5)
    assert len(lines) <= log.records <= 1.01 * len(lines)
    got = [x for f in sorted(os.listdir(tmp_path / "out")) if f.startswith("part-") for x in open(tmp_path / "out" / f).read().splitlines()]
    assert got == sorted(lines, key=oracle_key)


@pytest.mark.parametrize("end", ["\n", "\r\n", "\r"])
def test_sampled_lines_are_lines(spark, tmp_path, monkeypatch, end):
    monkeypatch.setattr(sampling, "WINDOW", (64, 64))
    r = random.Random(2)
    lines = [f"{r.randint(0, 10 ** r.randint(1, 18))}. {'é' * r.randint(0, 30)}" for _ in range(3000)]
    for i in range(3):
        (tmp_path / f"p{i}.txt").write_bytes((end.join(lines[i * 1000:i * 1000 + 1000]) + (end if i else "")).encode())
    (tmp_path / "empty.txt").write_text("")
    got = sample_lines(spark, str(tmp_path), 50)
    assert set(got.lines) <= set(lines) and len(got.lines) >= 500
    assert abs(got.mean_bytes - input_bytes(spark, str(tmp_path)) / 3000) < 8


def test_odd_files(spark, tmp_path):
    def one(data, name="x.txt"):
        folder = tmp_path / name
        folder.mkdir()
        (folder / name).write_bytes(data)
        return sample_lines(spark, str(folder), 4)
    assert one(b"", "a.txt").lines == []
    assert one(b"\xef\xbb\xbf1. a", "b.txt").lines == ["1. a"]
    assert one(b"1. \xff\n2. b\n", "c.txt").lines == ["2. b"]
    long = b"1. " + b"y" * 100_000
    assert one(long, "d.txt").lines == [long.decode()]
    assert one(b"1. a\n" * 10 + long + b"\n" + b"2. b\n" * 10, "e.txt").mean_bytes > 1
    beyond = one(b"3. " + b"y" * (3 << 20), "f.txt")
    assert beyond.lines == [] and beyond.mean_bytes == sampling.LONG_LINE
    assert set(one(gzip.compress(b"".join(b"%d. zipped\n" % i for i in range(9000))), "g.txt.gz").lines) <= {f"{i}. zipped" for i in range(9000)}


def test_positions_are_written_not_checkpointed(spark, lines_df):
    lines = [f"{i * 31 % 997}. {'ab'[i % 2]}" for i in range(2000)]
    df = with_position(sort_lines(lines_df(lines), "value", partitions=6))
    plan = df._jdf.queryExecution().toString()
    assert "FileScan parquet" in plan and "Scan ExistingRDD[line" not in plan
    got = [(r["pos"], r["line"]) for r in df.orderBy("pos").collect()]
    assert got == list(enumerate(sorted(lines, key=oracle_key), 1))
    assert with_position(sort_lines(lines_df([]), "value"), "place").columns == ["line", "place"]


def test_order_equal_joins_only_blocks_that_differ(spark):
    a = spark.range(10_000).selectExpr("id + 1 AS pos", "concat(id % 77, '. x') AS line")
    swapped = a.selectExpr("CASE pos WHEN 5000 THEN 5001 WHEN 5001 THEN 5000 ELSE pos END AS pos", "line")
    row = lambda x, y: tuple(order_equal(x, y, block=128).first())
    assert row(a, a) == (10_000, 10_000, 0) and row(a, swapped) == (10_000, 10_000, 2)
    assert row(a, a.where("pos <= 9990")) == (10_000, 9_990, 10) and row(a.where("false"), a.where("false")) == (0, 0, 0)
    assert row(a.withColumn("line", a.line.substr(1, 99)), a) == (10_000, 10_000, 0)
    nulls = a.selectExpr("pos", "CASE WHEN pos <> 3 THEN line END AS line")
    assert row(nulls, nulls) == (10_000, 10_000, 0) and row(nulls, a) == (10_000, 10_000, 1)


def test_profile_sorts_no_rows(spark):
    rows = [(f"r{i % 3}" if i % 10 else None, f"{i * 37 % 501}. {t}") for i in range(3000) for t in ["Apple", "\U0001F600", "ﬁ"][i % 3:i % 3 + 1]]
    df = spark.createDataFrame(rows, "run_id string, line string").repartition(5)
    prof = run_profile(df)
    assert "SortAggregate" not in prof._jdf.queryExecution().executedPlan().toString()
    got = {r["run_id"]: r for r in prof.collect()}
    for run in {r for r, _ in rows}:
        lines = sorted((x for r, x in rows if r == run), key=oracle_key)
        p = got[run]
        assert (p["n"], p["min_line"], p["max_line"]) == (len(lines), lines[0], lines[-1])
        assert p["est_bytes"] == sum(len(x.encode("utf-16-le")) + 20 for x in lines)
        assert p["has_word"] == any("Apple" in x for x in lines) and p["avg_bytes"] == p["est_bytes"] / p["n"]
    assert len(got) == 4 and run_profile(df.where("false")).count() == 0


def test_rejected_lines_do_not_pile_up(spark, tmp_path):
    """Half of all lines are prose that ends at its dot: no range gets their texts, all are counted."""
    good = [f"{i}. text {i % 97}" for i in range(6000)]
    bad = [f"A sentence numbered {i} that ends here." for i in range(4000)] + [f"{i}x. text {i}" for i in range(1500)] + ["99999999999999999999."] * 500
    both = good + bad
    random.Random(5).shuffle(both)
    (tmp_path / "in.txt").write_text("".join(x + "\n" for x in both))
    for order in ("ordinal", "utf8"):
        df = spark.createDataFrame([(x,) for x in both], "line string")
        cuts = sp.pick_splitters(sp.sample_keys(df.sample(0.2, seed=3), order), 6, order)
        parts = sp.to_ranges(df, cuts, validate=True).rdd.glom().map(lambda rows: (len(rows), sum(len(r[0] or "") for r in rows))).collect()
        assert sum(n for n, _ in parts) == len(both) and sum(b for _, b in parts) == sum(map(len, good))
        assert max(n for n, _ in parts) < 1.6 * len(both) / 6 and max(b for _, b in parts) < 1.6 * sum(map(len, good)) / 6
        out = str(tmp_path / order)
        report = sort_file(spark, str(tmp_path / "in.txt"), out, order, partitions=6).first()
        assert (report["rows_in"], report["rows_out"], report["rows_rejected"]) == (len(both), len(good), len(bad))
        assert sorted(r["value"] for r in read_lines(spark, out).collect()) == sorted(good)
        got = sorted_summary(check_sorted(spark, out, order)).first()
        assert got["n"] == len(good) and got["total_order"]
