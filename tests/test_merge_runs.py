"""Sorted runs and their merge (reference fixtures)."""

import os

import numpy as np
from joblog import job_log
from oracle import oracle_key
from ordo.functions.cuts import _cut
from ordo.operators.profile import run_sizes
from ordo.operators.sort import merge_runs, sorted_runs
from ordo.plans import catalog
from ordo.plans.sort_file import merge_files, split_and_sort
from ordo.sources.text import read_manifest, read_runs, run_files, write_lines


def run_files_of(runs_dir):
    return sorted(os.path.join(d, f) for d, _, names in os.walk(runs_dir) for f in names if f.startswith("part-") and "_manifest" not in d)


def merged(spark, text_file, runs):
    paths = [text_file(r) for r in runs]
    return [r["line"] for r in merge_runs(read_runs(spark, paths), "value").collect()]


def test_single_pass(spark, text_file):
    runs = [["10. Apple", "30. Cherry"], ["2. Banana", "100. Zebra"], ["1. Avocado"]]
    assert merged(spark, text_file, runs) == ["10. Apple", "1. Avocado", "2. Banana", "30. Cherry", "100. Zebra"]


def test_many_runs(spark, text_file):
    runs = [["4. D"], ["1. A"], ["3. C"], ["2. B"]]
    assert merged(spark, text_file, runs) == ["1. A", "2. B", "3. C", "4. D"]


def test_equal_text(spark, text_file):
    runs = [["10. Apple", "20. Apple"], ["2. Apple", "5. Apple"]]
    assert merged(spark, text_file, runs) == ["2. Apple", "5. Apple", "10. Apple", "20. Apple"]


def test_inputs_kept(spark, text_file, tmp_path):
    paths = [text_file(["2. b"]), text_file(["1. a"])]
    out = str(tmp_path / "merged")
    merge_files(spark, paths, out)
    assert all(os.path.exists(p) for p in paths)
    assert spark.read.text(out).count() == 2


def test_runs_small_input(spark, text_file, tmp_path):
    p = text_file(["100. Apple", "1. Banana", "50. Cherry", "2. Apple", "10. Banana"])
    runs_dir = str(tmp_path / "runs")
    per_run = split_and_sort(spark, p, runs_dir, max_run_bytes=1 << 20).collect()
    assert len(per_run) >= 1 and all(r["n"] > 0 for r in per_run)
    for f in run_files_of(runs_dir):
        lines = open(f).read().splitlines()
        assert lines == sorted(lines, key=oracle_key)
    assert any("Apple" in open(f).read() for f in run_files_of(runs_dir))


def test_runs_large_input_bounded(spark, text_file, tmp_path):
    lines = [f"{i}. TestStringData" for i in range(60_000)]
    p = text_file(lines)
    runs_dir = str(tmp_path / "runs")
    per_run = split_and_sort(spark, p, runs_dir, max_run_bytes=256 * 1024).collect()
    assert len(per_run) > 1
    assert sum(r["n"] for r in per_run) == 60_000
    total = []
    for f in run_files_of(runs_dir):
        run = open(f).read().splitlines()
        assert run == sorted(run, key=oracle_key)
        total += run
    assert sorted(total) == sorted(lines)


def test_runs_empty_input(spark, text_file, tmp_path):
    p = text_file(b"")
    runs_dir = str(tmp_path / "runs")
    assert split_and_sort(spark, p, runs_dir).count() == 0


def test_sorted_runs_no_shuffle(spark, lines_df):
    runs = sorted_runs(lines_df(["2. b", "1. a"]).coalesce(1), "value")
    plan = runs._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    assert [r["line"] for r in runs.collect()] == ["1. a", "2. b"]


def test_runs_are_cut_by_the_memory_estimate(spark, tmp_path):
    """Lines whose bytes and estimates differ by far: short ASCII and long non-ASCII texts."""
    lines = [f"{i}. {'x' if i % 3 else '中文' * 40}" for i in range(5000)]
    (tmp_path / "in.txt").write_text("".join(x + "\n" for x in lines), encoding="utf-8")
    estimate = lambda x: 2 * len(x) + 20
    for limit in (10_000, 64):
        runs_dir = str(tmp_path / f"runs{limit}")
        recorded = {r["run_id"]: (r["n"], r["est_bytes"]) for r in split_and_sort(spark, str(tmp_path / "in.txt"), runs_dir, limit).collect()}
        files = run_files_of(runs_dir)
        seen, found = [], {}
        for f in files:
            run = open(f, encoding="utf-8").read().splitlines()
            assert run == sorted(run, key=oracle_key)
            assert sum(map(estimate, run)) <= limit or len(run) == 1
            found[os.path.basename(os.path.dirname(f)) + "/" + os.path.basename(f)[:10]] = (len(run), sum(map(estimate, run)))
            seen += run
        assert sorted(seen) == sorted(lines) and recorded == found


def test_cuts_in_reading_order():
    sizes = np.array([5, 5, 5, 30, 1, 1, 9, 10, 11, 2])
    out, held, run = _cut(sizes, 10, 0, 0)
    assert out.tolist() == [0, 0, 1, 2, 3, 3, 4, 5, 6, 7] and (held, run) == (2, 7)
    for at in range(1, 10):  # the same, over any two batches
        a, held, run = _cut(sizes[:at], 10, 0, 0)
        b, held, run = _cut(sizes[at:], 10, held, run)
        assert [*a, *b] == out.tolist() and (held, run) == (2, 7)


def test_merge_reads_runs_once_and_samples_no_range(spark, tmp_path):
    runs_dir = str(tmp_path / "runs")
    lines = [f"{i * 7919 % 10007}. {['Apple', 'pear', 'fig'][i % 3]}" for i in range(20_000)]
    (tmp_path / "in.txt").write_text("".join(x + "\n" for x in lines))
    split_and_sort(spark, str(tmp_path / "in.txt"), runs_dir, 100_000)
    with job_log(spark) as log:
        merge_files(spark, runs_dir, str(tmp_path / "out"), partitions=7)
    assert len(lines) <= log.records <= len(lines) + 2 * len(run_files_of(runs_dir))  # and the listing of the files
    got = [x for f in run_files_of(str(tmp_path / "out")) for x in open(f).read().splitlines()]
    assert got == sorted(lines, key=oracle_key)
    sizes = [len(open(f).read().splitlines()) for f in run_files_of(str(tmp_path / "out"))]
    assert len(sizes) == 7 and max(sizes) < 2 * len(lines) / 7


def test_merge_of_a_repeated_line(spark, tmp_path):
    """One line holds a third of all rows: its cuts are several, and no range gets it all."""
    lines = sorted(["5. same"] * 20_000 + [f"{i}. {'a' if i % 2 else 'z'}" for i in range(40_000)], key=oracle_key)
    for r in range(4):
        (tmp_path / f"run{r}.txt").write_text("".join(x + "\n" for x in lines[r::4]))
    merge_files(spark, str(tmp_path / "run*.txt"), str(tmp_path / "out"), partitions=12)
    parts = [open(f).read().splitlines() for f in run_files_of(str(tmp_path / "out"))]
    assert [x for p in parts for x in p] == lines and max(map(len, parts)) < 2 * len(lines) / 12


def test_lost_and_emptied_runs_are_found(spark, tmp_path):
    runs_dir = str(tmp_path / "runs")
    (tmp_path / "in.txt").write_text("".join(f"{i}. text\n" for i in range(3000)))
    recorded = split_and_sort(spark, str(tmp_path / "in.txt"), runs_dir, 20_000)
    whole = run_sizes(recorded, run_files(spark, runs_dir)).first()
    assert whole["empty_runs"] == 0 and whole["runs"] == recorded.count() > 3 and whole["max_run_bytes"] <= 20_000
    files = run_files_of(runs_dir)
    os.remove(files[0])
    open(files[1], "w").close()
    assert run_sizes(read_manifest(spark, runs_dir), run_files(spark, runs_dir)).first()["empty_runs"] == 2
    (tmp_path / "runs" / "run=0" / "part-00099-x.txt").write_text("1. a\n")  # a file that no task recorded
    assert run_sizes(read_manifest(spark, runs_dir), run_files(spark, runs_dir)).first()["empty_runs"] == 3


def test_many_runs_grow_in_number(spark, tmp_path, monkeypatch):
    """A run holds a bounded number of rows, also where all rows are of one supplier."""
    spark.range(5000).selectExpr("id AS l_orderkey", "1L AS l_suppkey", "'N' AS l_returnflag", "'O' AS l_linestatus").write.parquet(
        str(tmp_path / "lineitem.parquet"))
    written = []
    monkeypatch.setattr(catalog, "RUN_ROWS", 100, raising=False)
    monkeypatch.setattr(catalog, "write_lines", lambda df, path: (written.append(path), write_lines(df, path)))
    got = catalog.q_merge_many_runs(spark, str(tmp_path)).collect()
    assert sorted(got) == [(i + 1, f"{i}. NO") for i in range(5000)]
    sizes = [len(open(f).read().splitlines()) for f in run_files_of(written[0])]
    assert len(sizes) >= 40 and max(sizes) <= 200
