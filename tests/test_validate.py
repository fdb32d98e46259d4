"""V1-V7, A1-A4, X1."""

import os

from ordo.operators.parse import parse_lines
from ordo.operators.position import position_in_files, with_position
from ordo.operators.profile import count_conservation, input_stats, run_profile
from ordo.operators.sort import sort_lines
from ordo.operators.validate import (
    bag_equal, check_sorted, format_check, order_equal, sorted_summary,
)
from ordo.plans.sort_file import sort_file
from ordo.sources.text import read_in_file_order


def write_run(dirpath, name, lines):
    os.makedirs(dirpath, exist_ok=True)
    with open(os.path.join(dirpath, name), "w") as fh:
        fh.write("".join(x + "\n" for x in lines))


def test_sortedness_good_and_planted_inversion(spark, tmp_path):
    d = str(tmp_path / "runs")
    write_run(d, "part-00000.txt", [f"{i}. a" for i in range(500)])
    write_run(d, "part-00001.txt", [f"{i}. b" for i in range(300)] + ["1. b"] + [f"{i}. c" for i in range(5)])
    write_run(d, "part-00002.txt", ["0. a"])  # sorted itself, but breaks the total order
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1k")  # many splits per file
    try:
        res = {r["file_name"]: r for r in check_sorted(spark, d).collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert res["part-00000.txt"]["violations"] == 0 and res["part-00000.txt"]["n"] == 500
    assert res["part-00001.txt"]["violations"] == 1 and res["part-00001.txt"]["follows_previous"]
    assert res["part-00002.txt"]["violations"] == 0 and not res["part-00002.txt"]["follows_previous"]
    s = sorted_summary(check_sorted(spark, d)).first()
    assert (s["files"], s["n"], s["violations"], s["total_order"]) == (3, 807, 1, False)


def test_sortedness_uses_utf16_order(spark, tmp_path):
    # U+1F600 is D83D DE00 in UTF-16 and sorts before U+FB01 there, but after
    # it by code point: only an ordinal check sees the second file as wrong.
    d = str(tmp_path / "runs")
    write_run(d, "part-00000.txt", ["5. \U0001F600", "1. ﬁ", "2. ﬁx"])
    write_run(d, "part-00001.txt", ["1. ﬁy", "0. ﬁy", "3. \U0001F600"])
    res = {r["file_name"]: r for r in check_sorted(spark, d).collect()}
    assert res["part-00000.txt"]["violations"] == 0
    assert res["part-00001.txt"]["violations"] == 2 and res["part-00001.txt"]["follows_previous"]
    utf8 = {r["file_name"]: r for r in check_sorted(spark, d, order="utf8").collect()}
    assert utf8["part-00000.txt"]["violations"] == 1
    assert utf8["part-00001.txt"]["violations"] == 1 and utf8["part-00001.txt"]["follows_previous"]


def test_sortedness_of_real_sort_output(spark, text_file, tmp_path):
    lines = [f"{(i * 7919) % 1000}. {w}" for i, w in enumerate(["x", "Y", "é", "\U0001F600", "ﬁ"] * 600)]
    out = str(tmp_path / "sorted")
    sort_file(spark, text_file(lines), out, with_stats=False)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2k")
    try:
        s = sorted_summary(check_sorted(spark, out)).first()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert s["n"] == 3000 and s["violations"] == 0 and s["total_order"]


def test_positions_match_enumeration(spark, lines_df, tmp_path, text_file):
    from oracle import oracle_key

    lines = [f"{i % 13}. {t}" for i, t in enumerate(["b", "a", "c", "a"] * 250)]
    expected = sorted(lines, key=oracle_key)
    pos = with_position(sort_lines(lines_df(lines), "value", partitions=5))
    assert sorted((r["pos"], r["line"]) for r in pos.collect()) == list(enumerate(expected, 1))
    out = str(tmp_path / "s")
    sort_file(spark, text_file(lines), out, with_stats=False)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1k")
    try:
        pf = position_in_files(read_in_file_order(spark, out))
        got = sorted((r["pos"], r["value"]) for r in pf.collect())
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert got == list(enumerate(expected, 1))


def test_order_equal(spark):
    a = spark.createDataFrame([(1, "1. a"), (2, "2. a")], "pos long, line string")
    b = spark.createDataFrame([(1, "1. a"), (2, "3. a"), (3, "4. a")], "pos long, line string")
    r = order_equal(a, b).first()
    assert (r["n_actual"], r["n_expected"], r["mismatches"]) == (2, 3, 2)
    assert order_equal(a, a).first()["mismatches"] == 0


def test_bag_equal_finds_lost_and_duplicated(lines_df):
    base = lines_df(["1. a", "2. b", "3. c"])
    assert bag_equal(base, lines_df(["3. c", "1. a", "2. b"]), "value").first()["same"]
    lost = bag_equal(base, lines_df(["1. a", "2. b"]), "value").first()
    assert not lost["same"] and (lost["rows_in"], lost["rows_out"]) == (3, 2)
    dup = bag_equal(base, lines_df(["1. a", "1. a", "2. b"]), "value").first()
    assert not dup["same"] and dup["rows_out"] == 3


def test_format_check(lines_df):
    df = lines_df(["1. ok", "1.bad", "x. bad", "2. ", "3. fine"])
    got = {r["ok"]: r["n"] for r in format_check(df, "value").collect()}
    assert got == {True: 2, False: 3}


def test_input_stats_and_conservation(spark, text_file):
    p = text_file(["1. a", "junk", "", "2. b"])
    s = input_stats(spark, p).first()
    assert (s["files"], s["rows_in"], s["rows_valid"], s["rows_rejected"]) == (1, 4, 2, 2)
    assert s["input_bytes"] == os.path.getsize(p)
    scan = spark.read.text(p)
    valid = parse_lines(scan).selectExpr("1 AS run_id", "line")
    c = count_conservation(scan.where("value <> '' AND value <> 'junk'"), valid).first()
    assert c["conserved"] and c["rows_in_runs"] == 2


def test_run_profile(lines_df):
    df = lines_df(["2. Apple", "1. Banana", "1. Apple", "9. Cherry"]).selectExpr(
        "CASE WHEN value LIKE '%Cherry' THEN 1 ELSE 0 END AS run_id", "value AS line")
    got = {r["run_id"]: r for r in run_profile(df).collect()}
    assert (got[0]["n"], got[0]["min_line"], got[0]["max_line"], got[0]["has_word"]) == (3, "1. Apple", "1. Banana", True)
    assert got[0]["est_bytes"] == sum(2 * len(x) + 20 for x in ["2. Apple", "1. Banana", "1. Apple"])
    assert got[1]["has_word"] is False


def test_positions_move_no_rows(spark, tmp_path, lines_df):
    """Whatever Spark estimates: the table of offsets is broadcast, rows are neither shuffled nor sorted for it."""
    for k in range(3):
        write_run(str(tmp_path / "s"), f"part-0000{k}.txt", [f"{i}. {'abc'[k]}" for i in range(50)])
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for placed in (position_in_files(read_in_file_order(spark, str(tmp_path / "s"))),
                       with_position(sort_lines(lines_df([f"{i}. a" for i in range(50)]), "value", partitions=3))):
            assert sorted(r["pos"] for r in placed.collect()) == list(range(1, placed.count() + 1))
            plan = placed._jdf.queryExecution().executedPlan().toString()
            assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan and "hashpartitioning" not in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
