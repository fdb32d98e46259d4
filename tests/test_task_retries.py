"""Counts of a sort whose tasks all fail at the first attempt, after their last row."""

import json
import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

# a session of its own: the shared one gives a task one attempt only
SCRIPT = """
import importlib, json, sys
from pyspark import TaskContext
from pyspark.sql import SparkSession

source, out, scratch = sys.argv[1:]
spark = SparkSession.builder.master("local[2,4]").config("spark.ui.enabled", "false").config(
    "spark.checkpoint.dir", scratch).getOrCreate()
spark.sparkContext.setLogLevel("OFF")
job = importlib.import_module("ordo.plans.sort_file")
write = job.write_lines

def fails_first(batches):
    yield from batches
    if TaskContext.get().attemptNumber() == 0:
        raise RuntimeError("planned")

job.write_lines = lambda df, *args, **named: write(df.mapInArrow(fails_first, df.schema), *args, **named)
print(json.dumps(job.sort_file(spark, source, out, partitions=3).first().asDict(), default=str))
"""


def test_counts_when_every_task_fails_once(tmp_path):
    lines = [f"{i * 7 % 901}. text {i % 13}" for i in range(3000)] + ["no number here", "x. y", ""] * 200
    source = tmp_path / "in.txt"
    source.write_text("\n".join(lines) + "\n")
    made = subprocess.run([sys.executable, "-c", SCRIPT, str(source), str(tmp_path / "out"), str(tmp_path / "scratch")],
                          capture_output=True, text=True, timeout=300, env={**os.environ, "PYTHONPATH": ROOT})
    assert made.returncode == 0, made.stderr[-2000:]
    report = json.loads(made.stdout.splitlines()[-1])
    assert (report["rows_in"], report["rows_out"], report["rows_rejected"]) == (3600, 3000, 600)
    written = [x for p in sorted((tmp_path / "out").glob("part-*")) for x in p.read_text().splitlines()]
    assert written == sorted(lines[:3000], key=lambda x: (x.split(". ", 1)[1], int(x.split(".")[0])))
