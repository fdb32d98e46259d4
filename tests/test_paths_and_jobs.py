"""Paths with odd names, equal file names in several folders, jobs, bad bytes."""

import os
import re

import pytest

from oracle import oracle_key
from ordo import jobs
from ordo.operators.position import position_in_files
from ordo.operators.sort import first_lines
from ordo.operators.validate import check_sorted, sorted_summary
from ordo.session import derived_session
from ordo.sources.text import head_of_output, read_in_file_order, read_lines, read_runs, run_files


@pytest.mark.parametrize("name", ["plain", "a b", "a%20c", "a#c", "100%", "ü x"])
def test_check_finds_inversions_in_any_folder(spark, tmp_path, name):
    folder = tmp_path / name
    folder.mkdir()
    (folder / "part-00000-x.txt").write_text("2. B\n1. A\n5. Z\n3. C\n")
    got = sorted_summary(check_sorted(spark, str(folder))).first()
    assert (got["files"], got["n"], got["violations"], got["total_order"]) == (1, 4, 2, False)
    (folder / "part-00000-x.txt").write_text("1. A\n2. B\n3. C\n5. Z\n")
    got = sorted_summary(check_sorted(spark, str(folder))).first()
    assert (got["files"], got["n"], got["violations"], got["total_order"]) == (1, 4, 0, True)


def test_nothing_read_is_no_order(spark, tmp_path):
    (tmp_path / "part-00000.txt").write_text("")
    got = sorted_summary(check_sorted(spark, str(tmp_path))).first()
    assert got["files"] == 0 and got["total_order"] is False


def test_positions_and_runs_with_equal_names(spark, tmp_path):
    for f, lines in (("a", "1. a\n2. b\n3. c\n"), ("b", "4. d\n5. e\n6. f\n")):
        (tmp_path / f).mkdir()
        (tmp_path / f / "part-00000.txt").write_text(lines)
    paths = [str(tmp_path / "a"), str(tmp_path / "b")]
    own = derived_session(spark, {"spark.sql.files.maxPartitionBytes": "16", "spark.sql.files.openCostInBytes": "1"})
    got = position_in_files(read_in_file_order(own, paths)).collect()
    assert sorted((r["pos"], r["value"]) for r in got) == list(enumerate(
        ["1. a", "2. b", "3. c", "4. d", "5. e", "6. f"], 1))
    runs = read_runs(spark, paths)
    assert runs.select("run").distinct().count() == 2
    assert sorted((r["run"].rsplit("/", 2)[1], r["bytes"]) for r in run_files(spark, paths).collect()) == [("a", 15), ("b", 15)]


def test_invalid_utf8(spark, text_file):
    p = text_file(b"1. ok\n2. \xff\xfe bad\n3. caf\xc3\xa9 \xe2\x82\n")
    assert [bytes(r["b"]) for r in read_lines(spark, p).selectExpr("cast(value AS binary) b").collect()] == [
        b"1. ok", b"2. \xff\xfe bad", b"3. caf\xc3\xa9 \xe2\x82"]
    got = [r["value"] for r in read_lines(spark, p, replace_invalid=True).collect()]
    assert got == ["1. ok", "2. �� bad", "3. café �"]


def test_invalid_utf8_in_every_job(spark, tmp_path, capsys):
    """Bytes that are not UTF-8, long malformed sequences among them, become U+FFFD in
    sorted files, runs and merges exactly as the decoder of the platform does it."""
    bad = [b"7. \xff\xfe bad", b"3. caf\xc3\xa9 \xe2\x82", b"5. " + b"\xf0\x9f" * 5000, b"2. \xed\xa0\x80\xc0\xaf",
           b"9. \xf4\x90\x80\x80 z", b"1. ok", b"4. \x80" * 3, b"6. " + b"\xe2\x82" * 700 + b"\xac"]
    raw = str(tmp_path / "raw.txt")
    open(raw, "wb").write(b"\n".join(bad) + b"\n")
    want = sorted((x.decode("utf-8", "replace") for x in bad), key=oracle_key)

    def written(folder):
        return [x for d, _, fs in sorted(os.walk(folder)) for f in sorted(fs) if f.startswith("part-") and "_manifest" not in d
                for x in open(os.path.join(d, f), "rb").read().decode("utf-8").splitlines()]
    job = lambda *a: jobs.run(spark, jobs.arguments([*a, "--replace-invalid"]))
    out, runs, merged = (str(tmp_path / x) for x in ("out", "runs", "merged"))
    assert job("sort", "--input", raw, "--output", out) == 0 and written(out) == want
    assert job("split", "--input", raw, "--output", runs, "--chunk-megabytes", "0.0001") == 0
    assert sorted(written(runs)) == sorted(want) and "rows 8" in capsys.readouterr().out
    assert job("merge", "--input", runs, "--output", merged) == 0 and written(merged) == want
    assert job("check", "--input", merged) == 0
    # left alone, the bytes pass through
    assert jobs.run(spark, jobs.arguments(["sort", "--input", raw, "--output", out + "2"])) == 0
    assert sorted(x for f in os.listdir(out + "2") if f.startswith("part-")
                  for x in open(os.path.join(out + "2", f), "rb").read().split(b"\n") if x) == sorted(bad)


def test_first_lines(spark, text_file):
    p = text_file([f"{i}. x" for i in range(100)])
    got = [r["line"] for r in first_lines(read_lines(spark, p), 7).collect()]
    assert len(got) == 7 and set(got) <= {f"{i}. x" for i in range(100)}


def test_jobs(spark, tmp_path, capsys):
    raw, out = str(tmp_path / "raw"), str(tmp_path / "out")
    assert jobs.run(spark, jobs.arguments(["generate", "--output", raw, "--megabytes", "0.05"])) == 0
    assert jobs.run(spark, jobs.arguments(["sort", "--input", raw, "--output", out, "--head", "3"])) == 0
    printed = capsys.readouterr().out.splitlines()
    lines = [x for f in os.listdir(raw) if f.startswith("part-") for x in open(os.path.join(raw, f)).read().splitlines()]
    assert printed[1:] == sorted(lines, key=oracle_key)[:3]
    assert [r["value"] for r in head_of_output(spark, out, 3).collect()] == printed[1:]
    assert jobs.run(spark, jobs.arguments(["check", "--input", out])) == 0
    assert jobs.run(spark, jobs.arguments(["check", "--input", raw])) == 1
    with pytest.raises(SystemExit):
        jobs.arguments(["sort", "--output", out])


def test_plan_is_the_same_at_every_size(spark, tmp_path):
    from ordo.operators.sort import sort_lines
    from ordo.sources.generator import generate_lines

    def nodes(n):
        path = str(tmp_path / f"lines{n}")
        generate_lines(spark, n).withColumnRenamed("line", "value").write.text(path)
        plan = sort_lines(read_lines(spark, path), "value", partitions=4)._jdf.queryExecution().executedPlan().toString()
        return [re.search(r"[A-Z]\w+", x)[0] for x in plan.splitlines() if x.strip()], "_lead" in plan
    assert nodes(2_000) == nodes(300_000)
