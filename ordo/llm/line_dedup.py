"""Line dedup by distinct-site spread (DataFrame only).

A line that stands on many sites is boilerplate. Per line hash, a HyperLogLog
sketch of its sites is built by map-side partial aggregation and merged by the
shuffle, so a line on a third of all documents costs one small sketch per map
task. The estimate decides alone only outside a band around the threshold;
lines inside it get an exact distinct count. Then the boilerplate lines go.

They leave every document, whatever share of it they are. With ``keep_copies``
(for a pipeline that groups whole copies later) a copied page stays whole for the
document-level stage: more than ``max_share`` of its characters stand in such
lines, and its lines also stand in another row, all of them or all but one small
line on either side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordo.llm.tables import materialize

MIN_SITES = 10     # a line on this many distinct sites is boilerplate
LG_K = 12          # sketch of 2^12 registers: 1.6 % standard error
BAND = 0.15        # estimates within 15 % of the threshold are counted exactly
MAX_SHARE = 0.5    # a copy that would lose more than this share of its characters stays whole
EDIT = 0.2         # of a document's characters in a line that its copy may not have


def _lines(text: str):
    return F.split(F.col(text), "\n")


def _line_hash(line):
    """Hash of a line without outer spaces; null for a line that is then empty."""
    t = F.trim(line)
    return F.when(F.length(t) > 0, F.xxhash64(t))


def spread_lines(lines: DataFrame, min_sites: int = MIN_SITES, lg_k: int = LG_K, band: float = BAND) -> DataFrame:
    """``line_hash`` of the lines on at least ``min_sites`` distinct sites.

    ``lines`` has ``site`` (string, null is a site of its own) and
    ``line_hash``. The sketch rules out or accepts outside the band; lines in
    it are counted exactly, by distinct (line, site) pairs."""
    site = F.coalesce(F.concat(F.lit("="), F.col("site")), F.lit("null"))
    lines = lines.select("line_hash", site.alias("site"))
    sketches = lines.groupBy("line_hash").agg(F.hll_sketch_estimate(F.hll_sketch_agg("site", lg_k)).alias("sites"))
    sketches = materialize(sketches.filter(F.col("sites") >= min_sites * (1 - band)), "line-spread")
    sure = sketches.filter(F.col("sites") > min_sites * (1 + band)).select("line_hash")
    near = sketches.filter(F.col("sites") <= min_sites * (1 + band)).select("line_hash")
    exact = lines.join(near, "line_hash", "left_semi").distinct().groupBy("line_hash").agg(
        F.count(F.lit(1)).alias("n")).filter(F.col("n") >= min_sites).select("line_hash")
    return sure.unionByName(exact)


def _copies(held: DataFrame, max_share: float, edit: float = EDIT) -> DataFrame:
    """``k1, k2`` of the documents of ``held`` (one per row, with ``lines``, ``share``
    of their characters in spread lines) whose lines another row has too. A row is
    posted under the sum of its line hashes, and without each line of at most
    ``edit`` of its characters; one posting that two rows have makes both copies."""
    # a copy that is itself over max_share has its match above this share
    near = held.filter(F.col("share") > (max_share - edit) * (1 - edit))
    number = "decimal(38,0)"
    total = F.aggregate("lines", F.lit(0).cast(number), lambda n, x: (n + x["h"]).cast(number))
    chars = F.aggregate("lines", F.lit(0).cast("long"), lambda n, x: n + x["n"])
    none = F.array(F.struct(F.lit(None).cast("long").alias("h"), F.lit(0).alias("n")))
    without = near.select("k1", "k2", F.size("lines").alias("size"), total.alias("total"), chars.alias("chars"),
                          F.explode(F.concat(none, F.array_distinct("lines"))).alias("x"))
    without = without.filter(F.col("x.n") <= edit * F.col("chars"))
    posted = materialize(without.select(
        "k1", "k2", (F.col("size") - F.col("x.h").isNotNull().cast("int")).alias("size"),
        (F.col("total") - F.coalesce("x.h", F.lit(0))).cast(number).alias("total")), "line-copies")
    same = ["size", "total"]
    # written first: the join then shuffles both sides anew, and Spark can split a posting of many copies
    shared = materialize(posted.groupBy(*same).agg(F.count(F.lit(1)).alias("rows")).filter("rows > 1").select(*same), "line-shared")
    return posted.join(shared, same, "left_semi").select("k1", "k2").distinct()


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text: str = "text", site: str = "source",
                min_sites: int = MIN_SITES, lg_k: int = LG_K, band: float = BAND,
                max_share: float = MAX_SHARE, keep_copies: bool = False) -> DataFrame:
    """``row`` (the input row as a struct), ``n_lines``, ``n_removed`` and
    ``clean_text``. ``keep_copies`` leaves copied pages whole (see above).

    Null text: no lines, text stays null. An empty text is one empty line. Lines without a
    character other than spaces are never removed. Texts of any length are taken
    whole. Repeated rows are treated alike; repeated lines of one document all go.
    Columns of ``docs`` travel in a struct, so no name of theirs clashes. An empty
    table gives no rows."""
    # a document is known by its id and its text, so null and repeated ids are no special case
    keys = [F.coalesce(F.col(id_col).cast("string"), F.lit("null")).alias("k1"),
            F.coalesce(F.xxhash64(F.col(text)), F.lit(0)).alias("k2")]
    hashes = F.array_compact(F.array_distinct(F.transform(_lines(text), _line_hash)))
    held = materialize(docs.select(*keys, F.col(site).cast("string").alias("site"), hashes.alias("hashes"))
                       .filter(F.size("hashes") > 0), "line-hashes")
    lines = held.select("k1", "k2", "site", F.explode("hashes").alias("line_hash"))
    spread = spread_lines(lines.select("site", "line_hash"), min_sites, lg_k, band)
    found = lines.join(spread, "line_hash", "left_semi").groupBy("k1", "k2").agg(
        F.collect_set("line_hash").alias("found"))  # at most the lines of one document
    spare = lambda line: ~F.coalesce(F.array_contains("found", _line_hash(line)), F.lit(False))
    chars = lambda a: F.aggregate(a, F.lit(0).cast("long"), lambda n, x: n + F.length(x))
    rest, every = F.filter(_lines(text), spare), _lines(text)
    found = found.withColumn("copy", F.lit(False))
    if keep_copies:
        line = F.transform(every, lambda x: F.struct(_line_hash(x).alias("h"), F.length(F.trim(x)).alias("n")))
        share = 1 - F.try_divide(chars(rest), chars(every))
        parted = docs.select(*keys, text).join(found, ["k1", "k2"]).select(
            "k1", "k2", F.filter(line, lambda x: x["h"].isNotNull()).alias("lines"), share.alias("share"))
        copies = _copies(parted, max_share).withColumn("copied", F.lit(True))
        found = found.drop("copy").join(copies, ["k1", "k2"], "left").select(
            "k1", "k2", "found", F.coalesce("copied", F.lit(False)).alias("copy"))
    rows = docs.select(F.struct("*").alias("row"), F.col(text).alias("text"), *keys)
    rows = rows.join(found, ["k1", "k2"], "left")
    parted = rows.select("row", "text", "copy", _lines("text").alias("all"),
                         F.when(F.col("found").isNotNull(), F.filter(_lines("text"), spare)).alias("rest"))
    over = chars(F.col("rest")) < (1 - max_share) * chars(F.col("all"))
    whole = F.col("rest").isNull() | (F.col("copy") & over)
    n_all = F.coalesce(F.size("all"), F.lit(0)).cast("long")
    return parted.select(
        "row", F.greatest(n_all, F.lit(0)).alias("n_lines"),
        F.when(whole, F.lit(0)).otherwise(n_all - F.size("rest")).cast("long").alias("n_removed"),
        F.when(whole, F.col("text")).otherwise(F.array_join("rest", "\n")).alias("clean_text"))
