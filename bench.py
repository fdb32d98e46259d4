"""Benchmark: the reference's one query (sort a whole text file) plus the
operators around it, at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``.

Setup (writing the input text files) is not timed. Each query runs twice and
the faster run counts (the first also warms the JIT). Prints one JSON line.

Queries:
  sort_lineitem   sort_file over the lineitem lines (text in, text out)
  sort_generated  sort_file over a generated file of the reference's 11
                  phrases ($BENCH_GEN_MB MiB, default 256; the reference's
                  own benchmark sorts such a file)
  top10           preview of the first 10 lines of the order (no full sort)
  merge_runs      split the lineitem file into sorted runs, merge them
  check_sorted    sortedness + total order check of the sorted output
  parse_documents reject summary over every line of the documents table
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402

from ordo.operators.parse import reject_summary  # noqa: E402
from ordo.operators.sort import top_lines  # noqa: E402
from ordo.operators.validate import check_sorted, sorted_summary  # noqa: E402
from ordo.plans.catalog import document_lines, lineitem_lines  # noqa: E402
from ordo.plans.sort_file import generate_file, merge_files, sort_file, split_and_sort  # noqa: E402
from ordo.session import shared_dir  # noqa: E402
from ordo.sources.text import read_lines, write_lines  # noqa: E402


def folder_bytes(path: str) -> int:
    return sum(os.path.getsize(os.path.join(path, f)) for f in os.listdir(path) if f.startswith("part-"))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    work = tempfile.mkdtemp(prefix="ordo-bench-")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("ordo-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.files.openCostInBytes", str(256 * 1024))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    shared_dir(spark)  # spark.checkpoint.dir from the session; a local folder only if unset

    # ---- setup (untimed): input text files
    li_txt = os.path.join(work, "lineitem.txt")
    write_lines(lineitem_lines(spark, sf_dir), li_txt)
    li_bytes = folder_bytes(li_txt)
    gen_mb = float(os.environ.get("BENCH_GEN_MB", "256"))
    gen_txt = os.path.join(work, "generated.txt")
    t0 = time.perf_counter()
    generate_file(spark, gen_txt, int(gen_mb * 2**20), seed=42, blank_every=2500)
    gen_s = time.perf_counter() - t0
    gen_bytes = folder_bytes(gen_txt)

    queries: dict[str, float] = {}
    extra: dict[str, float] = {"generate_sec": round(gen_s, 3)}
    run = [0]

    def timed(name, fn, repeat=2):
        best = None
        for _ in range(repeat):
            run[0] += 1
            t = time.perf_counter()
            fn(run[0])
            dt = time.perf_counter() - t
            best = dt if best is None else min(best, dt)
        queries[name] = round(best, 3)

    out = lambda tag, i: os.path.join(work, f"{tag}-{i}")

    timed("sort_lineitem", lambda i: sort_file(spark, li_txt, out("li-sorted", i)))
    last = {}

    def sort_gen(i):
        last["gen"] = out("gen-sorted", i)
        sort_file(spark, gen_txt, last["gen"])
    timed("sort_generated", sort_gen)
    timed("top10", lambda i: top_lines(read_lines(spark, li_txt), 10, line="value").collect())

    def merge(i):
        runs = out("runs", i)
        split_and_sort(spark, li_txt, runs, max_run_bytes=max(li_bytes // 16, 64 * 1024))
        merge_files(spark, runs, out("merged", i))
    timed("merge_runs", merge)

    sorted_dir = last["gen"]

    def check(i):
        s = sorted_summary(check_sorted(spark, sorted_dir)).first()
        assert s["violations"] == 0 and s["total_order"], s
    timed("check_sorted", check)
    timed("parse_documents", lambda i: reject_summary(document_lines(spark, sf_dir), "line").collect())

    mb = 2**20
    extra.update({
        "lineitem_mb": round(li_bytes / mb, 2),
        "generated_mb": round(gen_bytes / mb, 2),
        "sort_lineitem_mb_per_s": round(li_bytes / mb / queries["sort_lineitem"], 2),
        "sort_generated_mb_per_s": round(gen_bytes / mb / queries["sort_generated"], 2),
        "cpus": cpus,
    })
    total = round(sum(queries.values()), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(json.dumps({"metric": "total_query_sec", "value": total, "unit": "sec",
                      "queries": queries, "sf": sf, **extra}))
    spark.stop()


if __name__ == "__main__":
    main()
