"""Command line for ``spark-submit``: sort, split, merge, generate and check text files.

    spark-submit ordo/jobs.py sort --input IN [IN ...] --output OUT [--order utf8] [--report FOLDER] [--head 10]
    spark-submit ordo/jobs.py split --input IN [IN ...] --output RUNS [--chunk-megabytes 200]
    spark-submit ordo/jobs.py merge --input RUNS [RUNS ...] --output OUT
    spark-submit ordo/jobs.py generate --output OUT --megabytes 256 [--seed 42]
    spark-submit ordo/jobs.py check --input OUT

``--chunk-megabytes`` is the memory estimate that one run may take, and
``--target-megabytes`` the input that one output file may hold. ``--replace-invalid``
turns bytes that are not UTF-8 into U+FFFD. ``check`` ends with status 1 unless the files are in total order.
"""

from __future__ import annotations

import argparse
import os
import sys

if __package__ in (None, ""):  # run as a file
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from ordo.operators.validate import check_sorted, sorted_summary  # noqa: E402
from ordo.plans.sort_file import TARGET_PARTITION_BYTES, generate_file, merge_files, sort_file, split_and_sort  # noqa: E402
from ordo.sources.text import head_of_output  # noqa: E402


def arguments(argv: list[str] | None = None) -> argparse.Namespace:
    top = argparse.ArgumentParser(prog="ordo", description="Sort, generate and check NUMBER. TEXT files.")
    jobs = top.add_subparsers(dest="job", required=True)
    sort = jobs.add_parser("sort", help="sort the valid lines of the inputs")
    sort.add_argument("--input", nargs="+", required=True)
    sort.add_argument("--output", required=True)
    sort.add_argument("--order", choices=("ordinal", "utf8"), default="ordinal")
    sort.add_argument("--partitions", type=int)
    sort.add_argument("--report", help="folder to append the run report to")
    sort.add_argument("--head", type=int, default=10, help="lines of the result to print")
    split = jobs.add_parser("split", help="write sorted runs of bounded size")
    split.add_argument("--chunk-megabytes", type=float, help="memory estimate of a run, at most")
    merge = jobs.add_parser("merge", help="merge runs into one total order")
    for job in (split, merge):
        job.add_argument("--input", nargs="+", required=True)
        job.add_argument("--output", required=True)
        job.add_argument("--order", choices=("ordinal", "utf8"), default="ordinal")
    for job in (sort, merge):
        job.add_argument("--target-megabytes", type=float, default=TARGET_PARTITION_BYTES / 2**20)
    generate = jobs.add_parser("generate", help="write random lines")
    generate.add_argument("--output", required=True)
    generate.add_argument("--megabytes", type=float, required=True)
    generate.add_argument("--seed", type=int, default=42)
    check = jobs.add_parser("check", help="check that files are in total order")
    check.add_argument("--input", nargs="+", required=True)
    check.add_argument("--order", choices=("ordinal", "utf8"), default="ordinal")
    for job in (sort, split, merge, check):
        job.add_argument("--replace-invalid", action="store_true")
    return top.parse_args(argv)


def run(spark: SparkSession, args: argparse.Namespace) -> int:
    if args.job == "sort":
        report = sort_file(spark, args.input, args.output, args.order, args.partitions, report_path=args.report,
                           target_partition_bytes=int(args.target_megabytes * 2**20), replace_invalid=args.replace_invalid).first()
        print(f"rows in {report['rows_in']}, out {report['rows_out']}, rejected {report['rows_rejected']}")
        for row in head_of_output(spark, args.output, args.head).collect():
            print(row["value"])
        return 0
    if args.job == "split":
        limit = None if args.chunk_megabytes is None else max(1, int(args.chunk_megabytes * 2**20))
        runs = split_and_sort(spark, args.input, args.output, limit, args.order, replace_invalid=args.replace_invalid)
        total = runs.agg(F.count("n").alias("runs"), F.sum("n").alias("rows"), F.max("est_bytes").alias("largest")).first()
        print(f"runs {total['runs']}, rows {total['rows'] or 0}, largest estimate {total['largest'] or 0}")
        return 0
    if args.job == "merge":
        merge_files(spark, args.input, args.output, args.order, target_partition_bytes=int(args.target_megabytes * 2**20),
                    replace_invalid=args.replace_invalid)
        return 0
    if args.job == "generate":
        generate_file(spark, args.output, int(args.megabytes * 2**20), args.seed)
        return 0
    found = sorted_summary(check_sorted(spark, args.input, args.order, args.replace_invalid)).first()
    print(f"files {found['files']}, rows {found['n']}, violations {found['violations']}, total order {found['total_order']}")
    return 0 if found["total_order"] else 1


def main() -> None:
    args = arguments()
    spark = SparkSession.builder.appName(f"ordo-{args.job}").getOrCreate()
    try:
        status = run(spark, args)
    finally:
        spark.stop()
    sys.exit(status)


if __name__ == "__main__":
    main()
