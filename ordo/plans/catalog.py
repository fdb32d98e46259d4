"""Registered queries: lines built from the driver tables, each run through
one operator (or a chain), with the equivalent DuckDB SQL as an oracle.

Every query reads whole tables and every line of every text. Sorted results
carry ``pos`` (1-based ordinal position, computed without a single-task
window) so that an order-insensitive comparison still checks the order.

Line builders (the same rule on both sides):

* part        ``p_partkey. p_name``            (heavy text ties)
* supplier    ``s_suppkey. s_name``
* customer    ``c_custkey. c_name``
* events      ``user_id. event_type``          (many identical lines)
* lineitem    ``l_orderkey. l_returnflag l_linestatus`` (the bench table)
* orders      ``o_orderkey. o_orderpriority``
* documents   every line of every text twice: numbered ``doc_id. line`` and
  raw (raw prose lines are rejected, blank ones for their own reason)
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ordo.functions.keys import bind_keys, bound_order
from ordo.functions.lines import line_of, well_formed
from ordo.operators.parse import parse_lines, reject_summary
from ordo.operators.position import position_in_files, with_position
from ordo.operators.profile import count_conservation, run_profile, run_sizes
from ordo.operators.sort import first_lines, sort_lines, sort_within, top_lines
from ordo.operators.validate import (
    bag_equal, check_sorted, format_check, order_equal, size_in_window, sorted_summary,
)
from ordo.plans.report import report_summary
from ordo.plans.sort_file import generate_file, merge_files, sort_file, split_and_sort
from ordo.session import scratch_path
from ordo.sources.generator import NUMBER_BOUND, PHRASES, generate_lines, rows_for_size
from ordo.sources.text import head_of_output, read_in_file_order, read_lines, read_runs, run_files, write_lines


# The many-run merge: runs at least, and rows of one run (about 230 MB to sort; lines of 14 bytes).
RUNS = 40
RUN_ROWS = 1 << 21


# ---------------------------------------------------------------- lines (Spark)

def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _keyed_lines(spark, sf_dir, table, key, text) -> DataFrame:
    t = _table(spark, sf_dir, table)
    return t.select(line_of(F.col(key), F.col(text)).alias("line"))


def part_lines(spark, sf_dir):
    return _keyed_lines(spark, sf_dir, "part", "p_partkey", "p_name")


def supplier_lines(spark, sf_dir):
    return _keyed_lines(spark, sf_dir, "supplier", "s_suppkey", "s_name")


def customer_lines(spark, sf_dir):
    return _keyed_lines(spark, sf_dir, "customer", "c_custkey", "c_name")


def event_lines(spark, sf_dir):
    return _keyed_lines(spark, sf_dir, "events", "user_id", "event_type")


def orders_lines(spark, sf_dir):
    return _keyed_lines(spark, sf_dir, "orders", "o_orderkey", "o_orderpriority")


def lineitem_lines(spark, sf_dir):
    t = _table(spark, sf_dir, "lineitem")
    return t.select(
        line_of(F.col("l_orderkey"), F.concat("l_returnflag", "l_linestatus")).alias("line")
    )


def document_lines(spark, sf_dir):
    """Numbered and raw copies of every line of every document."""
    d = _table(spark, sf_dir, "documents").select(
        "doc_id", F.explode(F.split("text", "\n")).alias("l")
    )
    return d.select(line_of(F.col("doc_id"), F.col("l")).alias("line")).unionByName(
        d.select(F.col("l").alias("line"))
    )


def _through_files(spark: SparkSession, lines: DataFrame, name: str) -> DataFrame:
    """Write lines as a text file in the shared folder and scan it back."""
    path = scratch_path(spark, name)
    write_lines(lines, path)
    return read_lines(spark, path)


def _positioned(sorted_lines: DataFrame) -> DataFrame:
    return with_position(sorted_lines).select("pos", "line")


def _merged(spark: SparkSession, runs) -> DataFrame:
    """The merge of run files (cut at their quantiles), read back with positions."""
    out = scratch_path(spark, "merged")
    merge_files(spark, runs, out)
    return position_in_files(read_in_file_order(spark, out)).select("pos", F.col("value").alias("line"))


# ---------------------------------------------------------------- queries

def q_sort_part_lines(spark, sf_dir):
    """Flagship: S1, P1, P6-P8, O1, O2, X1."""
    scan = _through_files(spark, part_lines(spark, sf_dir), "part-lines")
    return _positioned(sort_lines(scan, "value"))


def q_sort_events(spark, sf_dir):
    """Bulk duplicates and text ties."""
    return _positioned(sort_lines(event_lines(spark, sf_dir)))


def q_sort_lineitem(spark, sf_dir):
    """O2 on the bench table."""
    return _positioned(sort_lines(lineitem_lines(spark, sf_dir)))


def q_sort_documents(spark, sf_dir):
    """O2 with long, non-ASCII texts and rejected raw lines mixed in."""
    return _positioned(sort_lines(document_lines(spark, sf_dir)))


def q_parse_documents(spark, sf_dir):
    """Typed rows of the valid lines."""
    return parse_lines(document_lines(spark, sf_dir), "line")


def all_kinds_of_lines(spark, sf_dir):
    """Document lines, the spaces alone of every document line, and line breaks
    with nothing between them: valid, empty, blank and malformed lines."""
    docs = document_lines(spark, sf_dir)
    return docs.unionByName(docs.select(F.regexp_replace("line", "[^ ]", "").alias("line")))


def q_reject_reasons(spark, sf_dir):
    """How many lines were kept or rejected, by reason (all five)."""
    return reject_summary(all_kinds_of_lines(spark, sf_dir), "line")


def q_first_lines(spark, sf_dir):
    """The first 25 lines in reading order. Which they are depends on the
    scan; that there are 25 and that each is a line of the table does not."""
    scan = _through_files(spark, orders_lines(spark, sf_dir), "first-lines")
    first = first_lines(scan, 25)
    known = first.join(orders_lines(spark, sf_dir).distinct(), "line", "left_semi")
    return first.agg(F.count(F.lit(1)).alias("n")).join(known.agg(F.count(F.lit(1)).alias("n_known")))


def q_output_head(spark, sf_dir):
    """O6 on files: the first ten lines of a written sort."""
    src, out = scratch_path(spark, "head-src"), scratch_path(spark, "head-sorted")
    write_lines(orders_lines(spark, sf_dir), src)
    sort_file(spark, src, out)
    return head_of_output(spark, out, 10).select(F.col("value").alias("line"))


def q_top10_lines(spark, sf_dir):
    """First ten of the order without a full sort."""
    top = top_lines(orders_lines(spark, sf_dir), 10)
    # ten rows: numbering them in one task is bounded by the limit itself
    k = bind_keys(top, "line")
    return k.select(F.row_number().over(Window.orderBy(*bound_order("line"))).cast("bigint").alias("pos"), "line")


def q_merge_runs(spark, sf_dir):
    """Three tables as three sorted run files, merged."""
    runs_dir = scratch_path(spark, "runs3")
    for name, lines in (("part", part_lines), ("supplier", supplier_lines), ("customer", customer_lines)):
        write_lines(sort_within(lines(spark, sf_dir)), f"{runs_dir}/{name}")  # part-00000... in each of them
    return _merged(spark, [f"{runs_dir}/{n}" for n in ("part", "supplier", "customer")])


def q_merge_many_runs(spark, sf_dir):
    """40 sorted runs (more than one merge pass of fan-in 15 would take); more
    where a run would have over RUN_ROWS rows."""
    runs_dir = scratch_path(spark, "runs40")
    li = _table(spark, sf_dir, "lineitem")
    li = li.repartition(max(RUNS, math.ceil(li.count() / RUN_ROWS)), "l_suppkey", "l_orderkey")
    lines = li.select(line_of(F.col("l_orderkey"), F.concat("l_returnflag", "l_linestatus")).alias("line"))
    write_lines(sort_within(lines), runs_dir)
    return _merged(spark, runs_dir)


def q_run_profile(spark, sf_dir):
    """O3 runs keyed by brand, A4 profile (P9 estimate, V5 size, V6 word)."""
    t = _table(spark, sf_dir, "part")
    runs = t.select(F.col("p_brand").alias("run_id"), line_of(F.col("p_partkey"), F.col("p_name")).alias("line"))
    return run_profile(runs, "run_id", "line", word="red")


def q_sorted_runs(spark, sf_dir):
    """O3 + A3 + V1 + V5: runs written and read back: every row is there, as the
    manifest says; each run is sorted, there are several, all files are there, and
    none exceeds the limit of the memory estimate (P9)."""
    src, out = scratch_path(spark, "li-lines"), scratch_path(spark, "li-runs")
    write_lines(lineitem_lines(spark, sf_dir), src)
    limit = 64 * 1024
    recorded = split_and_sort(spark, src, out, max_run_bytes=limit)
    kept = count_conservation(read_lines(spark, src), read_runs(spark, out), "run").select("rows_in", "rows_in_runs", "conserved")
    sizes = run_sizes(recorded, run_files(spark, out)).select((F.col("runs") > 1).alias("several"), "empty_runs",
                                                              (F.col("max_run_bytes") <= limit).alias("within_limit"))
    total = recorded.agg(F.sum("n").alias("rows_recorded"))
    order = sorted_summary(check_sorted(spark, out)).select("violations")
    return kept.join(sizes).join(total).join(order)  # four one-row tables


def q_sorted_check(spark, sf_dir):
    """V1 + A3 on a written total sort: no inversion within or across files."""
    src = scratch_path(spark, "li-src")
    write_lines(lineitem_lines(spark, sf_dir), src)
    out = scratch_path(spark, "li-sorted")
    sort_file(spark, src, out)
    return sorted_summary(check_sorted(spark, out)).select("n", "violations", "total_order")


def q_sorted_positions(spark, sf_dir):
    """X1 on files: positions of a written sort read back in file order."""
    src = scratch_path(spark, "ev-src")
    write_lines(event_lines(spark, sf_dir), src)
    out = scratch_path(spark, "ev-sorted")
    sort_file(spark, src, out)
    return position_in_files(read_in_file_order(spark, out)).select("pos", F.col("value").alias("line"))


def q_bag_equality(spark, sf_dir):
    """V7: the written sort holds exactly the valid input lines."""
    src, out = scratch_path(spark, "bag-src"), scratch_path(spark, "bag-sorted")
    write_lines(document_lines(spark, sf_dir), src)
    sort_file(spark, src, out)
    valid = parse_lines(document_lines(spark, sf_dir), "line").select("line")
    return bag_equal(valid, read_lines(spark, out).withColumnRenamed("value", "line"))


def q_format_check(spark, sf_dir):
    """V3: strict format of numbered and raw document lines."""
    return format_check(document_lines(spark, sf_dir))


def q_run_report(spark, sf_dir):
    """A1, A2 (+S8): sort a file and report counts and bytes."""
    src = scratch_path(spark, "doc-src")
    write_lines(document_lines(spark, sf_dir), src)
    rep = sort_file(spark, src, scratch_path(spark, "doc-sorted"), label="documents")
    return rep.select("label", "rows_in", "rows_out", "rows_rejected", "input_bytes")


def q_report_summary(spark, sf_dir):
    """Two sorts append their reports; the summary reads them back."""
    src = scratch_path(spark, "ord-src")
    write_lines(orders_lines(spark, sf_dir), src)
    reports = scratch_path(spark, "reports")
    for i in range(2):
        sort_file(spark, src, scratch_path(spark, f"ord-sorted{i}"), label="orders", report_path=reports)
    return report_summary(spark, reports).select("label", "runs", "rows_in", "rows_out", "rows_rejected")


def q_order_equal(spark, sf_dir):
    """V2: the merge of 40 runs equals the direct sort, position by position."""
    direct = _positioned(sort_lines(lineitem_lines(spark, sf_dir)))
    merged = q_merge_many_runs(spark, sf_dir)
    return order_equal(merged, direct)


def q_stream_merge(spark, sf_dir):
    """Streaming phase 1 (files arriving -> sorted runs), then the batch merge."""
    from ordo.streaming import stream_sorted_runs

    inbox = scratch_path(spark, "inbox")
    write_lines(part_lines(spark, sf_dir).unionByName(supplier_lines(spark, sf_dir)), inbox)
    runs = scratch_path(spark, "stream-runs")
    query = stream_sorted_runs(spark, inbox, runs, checkpoint=scratch_path(spark, "stream-ckpt"),
                               max_files_per_trigger=2)
    query.awaitTermination()
    return _merged(spark, runs)


def q_generate_lines(spark, sf_dir):
    """Generate as many bytes as the lineitem lines take; one
    row ``target_bytes, format_ok, size_ok``."""
    target = lineitem_lines(spark, sf_dir).agg(
        F.sum(F.octet_length("line") + 1).alias("b")
    ).first()["b"]
    path = scratch_path(spark, "generated")
    generate_file(spark, path, int(target))
    scan = spark.read.text(path)
    files = scan.select(
        F.col("_metadata.file_path").alias("f"), F.col("_metadata.file_size").alias("s"), "value"
    ).groupBy("f", "s").agg(F.count_if(~well_formed("value")).alias("bad"))
    window = files.agg(
        F.lit(int(target)).cast("bigint").alias("target_bytes"),
        (F.sum("bad") == 0).alias("format_ok"),
        size_in_window(F.sum("s"), int(target)).alias("size_ok"),
    )
    # a line is a pure function of its id: the written file and the same ids again hold the same bag
    n = rows_for_size(spark, int(target))
    same = bag_equal(generate_lines(spark, n, partitions=3), spark.read.text(path).withColumnRenamed("value", "line"))
    parsed = parse_lines(spark.read.text(path), "value")
    members = parsed.agg(
        F.count_if(~F.col("text").isin(*PHRASES)).alias("other_phrases"),
        F.count_distinct("text").alias("phrases"),
        ((F.min("number") >= 0) & (F.max("number") < NUMBER_BOUND)).alias("numbers_ok"),
        (F.max("number") - F.min("number") > 0.99 * NUMBER_BOUND).alias("numbers_spread"))
    return window.join(members).join(same.select(F.col("same").alias("reproducible")))  # one-row tables


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "sort_part_lines": q_sort_part_lines,
    "sort_events": q_sort_events,
    "sort_lineitem": q_sort_lineitem,
    "sort_documents": q_sort_documents,
    "parse_documents": q_parse_documents,
    "reject_reasons": q_reject_reasons,
    "top10_lines": q_top10_lines,
    "first_lines": q_first_lines,
    "output_head": q_output_head,
    "merge_runs": q_merge_runs,
    "merge_many_runs": q_merge_many_runs,
    "run_profile": q_run_profile,
    "sorted_runs": q_sorted_runs,
    "sorted_check": q_sorted_check,
    "sorted_positions": q_sorted_positions,
    "bag_equality": q_bag_equality,
    "format_check": q_format_check,
    "run_report": q_run_report,
    "generate_lines": q_generate_lines,
    "report_summary": q_report_summary,
    "order_equal": q_order_equal,
    "stream_merge": q_stream_merge,
}


# ---------------------------------------------------------------- oracle SQL

_GUARD = r"[\t-\r ]*[+-]?[0-9]+[\t-\r ]*"
# Fixed value: the Unicode White_Space characters (what Java's (?U)\s and a
# whitespace-only check match); RE2's \s alone is ASCII and lacks \v.
_WHITE_SPACE = (
    r"[\t\n\x{0b}\f\r \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}"
    r"\x{202f}\x{205f}\x{3000}]"
)


def _sql_lines(table: str, key: str, text: str) -> str:
    return f"SELECT CAST({key} AS VARCHAR) || '. ' || {text} AS line FROM {table}"


SQL_LINES = {
    "part": _sql_lines("part", "p_partkey", "p_name"),
    "supplier": _sql_lines("supplier", "s_suppkey", "s_name"),
    "customer": _sql_lines("customer", "c_custkey", "c_name"),
    "events": _sql_lines("events", "user_id", "event_type"),
    "orders": _sql_lines("orders", "o_orderkey", "o_orderpriority"),
    "lineitem": _sql_lines("lineitem", "l_orderkey", "l_returnflag || l_linestatus"),
    "documents": (
        "SELECT CAST(doc_id AS VARCHAR) || '. ' || l AS line FROM "
        "(SELECT doc_id, unnest(string_split(text, chr(10))) AS l FROM documents) "
        "UNION ALL SELECT unnest(string_split(text, chr(10))) AS line FROM documents"
    ),
}


SQL_ALL_KINDS = (f"{SQL_LINES['documents']} UNION ALL "
                 f"SELECT regexp_replace(line, '[^ ]', '', 'g') AS line FROM ({SQL_LINES['documents']})")


def _sql_parsed(lines_sql: str) -> str:
    """``line, number, text`` for every line (number null when rejected)."""
    return f"""
    SELECT line,
           CASE WHEN dot > 0 AND regexp_full_match(substr(line, 1, dot - 1), '{_GUARD}')
                THEN try_cast(trim(substr(line, 1, dot - 1), chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || ' ') AS BIGINT)
           END AS number,
           CASE WHEN substr(line, dot + 1, 1) = ' ' THEN substr(line, dot + 2) ELSE substr(line, dot + 1) END AS text
    FROM (SELECT line, instr(line, '.') AS dot FROM ({lines_sql}))"""


def _sql_sorted(lines_sql: str) -> str:
    return f"""
    SELECT row_number() OVER (ORDER BY text, number, line) AS pos, line
    FROM ({_sql_parsed(lines_sql)}) WHERE number IS NOT NULL"""


def _sql_reason(lines_sql: str) -> str:
    return f"""
    SELECT CASE WHEN number IS NOT NULL THEN 'valid'
                WHEN line = '' THEN 'empty'
                WHEN regexp_full_match(line, '{_WHITE_SPACE}+') THEN 'blank'
                WHEN instr(line, '.') = 0 THEN 'no_delimiter'
                ELSE 'bad_number' END AS reason
    FROM ({_sql_parsed(lines_sql)})"""


ORACLE_SQL: dict[str, str] = {
    "sort_part_lines": _sql_sorted(SQL_LINES["part"]),
    "sort_events": _sql_sorted(SQL_LINES["events"]),
    "sort_lineitem": _sql_sorted(SQL_LINES["lineitem"]),
    "sort_documents": _sql_sorted(SQL_LINES["documents"]),
    "parse_documents": f"SELECT number, text, line FROM ({_sql_parsed(SQL_LINES['documents'])}) WHERE number IS NOT NULL",
    "reject_reasons": f"SELECT reason, count(*) AS n FROM ({_sql_reason(SQL_ALL_KINDS)}) GROUP BY reason",
    "first_lines": "SELECT least(25, count(*)) AS n, least(25, count(*)) AS n_known FROM orders",
    "output_head": f"SELECT line FROM ({_sql_sorted(SQL_LINES['orders'])}) WHERE pos <= 10",
    "top10_lines": f"SELECT pos, line FROM ({_sql_sorted(SQL_LINES['orders'])}) WHERE pos <= 10",
    "merge_runs": _sql_sorted(
        f"{SQL_LINES['part']} UNION ALL {SQL_LINES['supplier']} UNION ALL {SQL_LINES['customer']}"
    ),
    "merge_many_runs": _sql_sorted(SQL_LINES["lineitem"]),
    "run_profile": f"""
        SELECT run_id, count(*) AS n, CAST(sum(2 * length(line) + 20) AS BIGINT) AS est_bytes,
               arg_min(line, {{'t': text, 'n': number, 'l': line}}) AS min_line,
               arg_max(line, {{'t': text, 'n': number, 'l': line}}) AS max_line,
               bool_or(contains(line, 'red')) AS has_word,
               CAST(sum(2 * length(line) + 20) AS DOUBLE) / count(*) AS avg_bytes
        FROM (SELECT p_brand AS run_id, CAST(p_partkey AS VARCHAR) || '. ' || p_name AS line,
                     p_partkey AS number, p_name AS text FROM part)
        GROUP BY run_id""",
    "sorted_runs": """
        SELECT count(*) AS rows_in, count(*) AS rows_in_runs, true AS conserved, true AS several,
               CAST(0 AS BIGINT) AS empty_runs, true AS within_limit, count(*) AS rows_recorded,
               CAST(0 AS BIGINT) AS violations FROM lineitem""",
    "sorted_check": "SELECT count(*) AS n, CAST(0 AS BIGINT) AS violations, true AS total_order FROM lineitem",
    "sorted_positions": _sql_sorted(SQL_LINES["events"]),
    "bag_equality": f"""
        SELECT count(*) AS rows_in, count(*) AS rows_out, true AS same
        FROM ({_sql_parsed(SQL_LINES['documents'])}) WHERE number IS NOT NULL""",
    "format_check": f"""
        SELECT ok, count(*) AS n FROM (
          SELECT (sep > 1
                  AND regexp_full_match(substr(line, 1, sep - 1), '{_GUARD}')
                  AND try_cast(trim(substr(line, 1, sep - 1), chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || ' ') AS BIGINT) IS NOT NULL
                  AND length(line) > sep + 1) AS ok
          FROM (SELECT line, instr(line, '. ') AS sep FROM ({SQL_LINES['documents']})))
        GROUP BY ok""",
    "run_report": f"""
        SELECT 'documents' AS label, count(*) AS rows_in,
               count(number) AS rows_out, count(*) - count(number) AS rows_rejected,
               CAST(sum(strlen(line) + 1) AS BIGINT) AS input_bytes
        FROM ({_sql_parsed(SQL_LINES['documents'])})""",
    "report_summary": """
        SELECT 'orders' AS label, CAST(2 AS BIGINT) AS runs, 2 * count(*) AS rows_in,
               2 * count(*) AS rows_out, CAST(0 AS BIGINT) AS rows_rejected FROM orders""",
    "order_equal": """
        SELECT count(*) AS n_actual, count(*) AS n_expected, CAST(0 AS BIGINT) AS mismatches FROM lineitem""",
    "stream_merge": _sql_sorted(f"{SQL_LINES['part']} UNION ALL {SQL_LINES['supplier']}"),
    "generate_lines": f"""
        SELECT CAST(sum(strlen(line) + 1) AS BIGINT) AS target_bytes, true AS format_ok, true AS size_ok,
               CAST(0 AS BIGINT) AS other_phrases, CAST(11 AS BIGINT) AS phrases, true AS numbers_ok,
               true AS numbers_spread, true AS reproducible
        FROM ({SQL_LINES['lineitem']})""",
}
