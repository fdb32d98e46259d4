"""A2/S8/S9 report, the streaming run writer, and the driver contract."""

import glob
import json
import os

from oracle import oracle_key
from ordo.plans.report import report_summary
from ordo.plans.sort_file import merge_files, sort_file
from ordo.streaming import stream_sorted_runs


def test_report_append_and_summary(spark, text_file, tmp_path):
    p = text_file(["2. b", "x", "1. a"])
    reports = str(tmp_path / "reports")
    for i in range(2):
        sort_file(spark, p, str(tmp_path / f"out{i}"), label="small", report_path=reports, with_stats=True)
    s = report_summary(spark, reports).first()
    assert (s["label"], s["runs"], s["rows_in"], s["rows_out"], s["rows_rejected"]) == ("small", 2, 6, 4, 2)
    assert s["avg_mb_per_s"] > 0


def test_stream_runs_then_merge(spark, tmp_path):
    inbox = tmp_path / "inbox"
    inbox.mkdir()
    lines = [f"{i}. {w}" for i, w in enumerate(["b", "a", "c"] * 50)] + ["junk", ""]
    for k in range(3):
        (inbox / f"f{k}.txt").write_text("".join(x + "\n" for x in lines[k::3]))
    runs, rejects = str(tmp_path / "runs"), str(tmp_path / "rejects")
    q = stream_sorted_runs(spark, str(inbox), runs, rejects, checkpoint=str(tmp_path / "ckpt"),
                           max_files_per_trigger=1)
    q.awaitTermination(120)
    batches = [d for d in os.listdir(runs) if d.startswith("batch=")]
    assert len(batches) == 3
    assert spark.read.parquet(rejects).count() == 2
    out = str(tmp_path / "merged")
    merge_files(spark, runs, out)
    got = []
    for f in sorted(os.listdir(out)):
        if f.startswith("part-"):
            got += open(os.path.join(out, f)).read().splitlines()
    assert got == sorted([x for x in lines if x not in ("junk", "")], key=oracle_key)


def test_entry_and_registry(spark):
    import __spark_entry__ as E

    df = E.entry(spark)
    assert df.columns == ["pos", "line"]
    assert df.count() > 0
    q, sql = E.queries(), E.oracle_sql()
    assert set(sql) <= set(q)
    assert len(q) >= 15


def test_report_of_mostly_rejected_lines(spark, tmp_path):
    """Prose lines that end at their only dot: counted in the report, and no task of the sort reads them all."""
    from ordo.plans.catalog import q_run_report

    folder = spark.sparkContext.getConf().get("spark.eventLog.dir").removeprefix("file:")
    bus = spark.sparkContext._jsc.sc().listenerBus()

    def shuffled():
        bus.waitUntilEmpty()
        stages = {}
        for path in glob.glob(os.path.join(folder, "**"), recursive=True):
            if os.path.isfile(path):
                for line in open(path, errors="replace"):
                    if '"SparkListenerTaskEnd"' in line:
                        task = json.loads(line)
                        read = task["Task Metrics"]["Shuffle Read Metrics"]
                        stages.setdefault(task["Stage ID"], []).append(read["Local Bytes Read"] + read["Remote Bytes Read"])
        return stages

    spark.range(4000, numPartitions=4).selectExpr(
        "id AS doc_id", "concat_ws(' ', sha2(string(id), 512), sha2(string(-id), 512)) || '.' AS text").write.parquet(
        str(tmp_path / "documents.parquet"))
    before = set(shuffled())
    r = q_run_report(spark, str(tmp_path)).first()
    assert (r["label"], r["rows_in"], r["rows_out"], r["rows_rejected"]) == ("documents", 8000, 4000, 4000)
    sort = max((v for k, v in shuffled().items() if k not in before), key=sum)
    assert len(sort) > 1 and max(sort) < 1.8 * sum(sort) / len(sort), sort
