"""Mixing sources to target weights by weighted fair queueing (DataFrame only).

Every document of a source is shuffled by the MD5 of its id. A source's
documents form a queue that may be passed ``max_repeat`` times; the copy whose
tokens end at position ``c`` of the queue has the virtual finish time
``c / target``. All queues are merged in the order of that time and the merge
stops where the total budget is used up, so every source is drained at the
rate of its target.

Both running sums (within a source, and over the merge) are two-level prefix
sums: totals per bin, offsets over the bins, sums within a bin. Bins of the
queue come from the leading hex digits of the hash, bins of the merge from the
finish time; their number follows the number of documents, so a bin holds some
65,536 of them and no task holds a whole source, however large. Rows alike in
id, source, key and size are one group with a count until their copies get keys
of their own, which spread them over the bins, so no task holds such a group either.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ordo.llm.tables import materialize, release

WORD = r"[^\x20\x09-\x0D]+"

WEIGHTS = (5, 2, 1)      # weights of the sources in their order, repeating
BUDGET_RATIO = 1.5       # words in the mix per word in the corpus
MAX_REPEAT = 2           # a document is used at most this often
BIN_ROWS = 65_536        # rows that a bin of either running sum holds, roughly
LEAST_BIN_DIGITS = 3     # 16^3 bins at least
HASH_BINS = 4096         # parts in which the rows of a group are numbered
SAME = ["doc_id", "source", "key", "size"]  # a group: rows that the plan cannot tell apart


def word_count(text: str):
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def _shuffle_key(id_col: str, text: str):
    """MD5 of the id (of the text where there is no id): the same on each run."""
    return F.md5(F.coalesce(F.col(id_col).cast("string"), F.concat(F.lit(":"), F.col(text)), F.lit("")))


def bin_digits(rows: int) -> int:
    """Hex digits of the hash that name a bin of a queue, so that 16 to this
    power bins hold about BIN_ROWS of ``rows`` each (within a factor of 4)."""
    return max(LEAST_BIN_DIGITS, round(math.log(max(rows, 1) / BIN_ROWS, 16)))


def source_targets(sizes: DataFrame, weights=WEIGHTS, budget_ratio: float = BUDGET_RATIO,
                   max_repeat: int = MAX_REPEAT) -> DataFrame:
    """``source, source_size, target`` from rows ``source, size``.

    Sources in code point order (null last) take the weights in turn and share
    the budget by weight; a target stops at ``max_repeat`` times its source,
    the excess goes to the others by weight until none is above. That is one
    water level: target = min(cap, weight x level), where the level is the
    largest of (budget - caps below) / (weights from here) along the sources
    ordered by cap / weight. One row per source, so these windows are small."""
    per = sizes.groupBy("source").agg(F.sum("size").cast("long").alias("source_size"))
    everything = Window.partitionBy(F.lit(0))
    n = F.row_number().over(everything.orderBy(F.col("source").asc_nulls_last())) - 1
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (n % len(weights) + 1).cast("int"))
    per = per.withColumn("weight", w).withColumn("cap", (F.col("source_size") * max_repeat).cast("double"))
    fill = everything.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = fill.rowsBetween(Window.unboundedPreceding, -1)
    after = fill.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    budget = F.sum("source_size").over(everything) * F.lit(float(budget_ratio))
    level = (budget - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("weight").over(after)
    return per.withColumn("level", level).select(
        "source", "source_size",
        F.least("cap", F.col("weight") * F.max("level").over(everything)).alias("target"))


def _sized(docs: DataFrame, id_col: str, text: str, source: str, *more) -> DataFrame:
    return materialize(docs.select(
        F.col(id_col).alias("doc_id"), F.col(source).alias("source"),
        _shuffle_key(id_col, text).alias("key"), word_count(text).alias("size"), *more), "mix-sizes")


def _groups(sized: DataFrame) -> DataFrame:
    return materialize(sized.groupBy(*SAME).agg(F.count(F.lit(1)).alias("rows")), "mix-groups")


def _copies(groups: DataFrame) -> DataFrame:
    """The rows of each group again, numbered by ``copy``; the first keeps the
    group's key, the others get keys of their own. Groups of more than BIN_ROWS
    are numbered block by block, so no task makes a large group alone."""
    last = F.col("rows")
    few = groups.filter(last <= BIN_ROWS).withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), last)))
    blocks = groups.filter(last > BIN_ROWS).withColumn("block", F.explode(F.sequence(
        F.lit(0).cast("long"), F.floor((last - 1) / BIN_ROWS)))).repartition("key", "block")
    first = F.col("block") * BIN_ROWS
    many = blocks.withColumn("copy", F.explode(F.sequence(first + 1, F.least(first + BIN_ROWS, last)))).drop("block")
    own = F.when(F.col("copy") == 1, F.col("key")).otherwise(F.md5(F.concat_ws(":", "key", "copy")))
    return few.unionByName(many).drop("rows").withColumn("group_key", F.col("key")).withColumn("key", own)


def plan_mix(docs: DataFrame, id_col: str = "doc_id", text: str = "text", source: str = "source",
             weights=WEIGHTS, budget_ratio: float = BUDGET_RATIO, max_repeat: int = MAX_REPEAT) -> DataFrame:
    """One row per document: ``doc_id, source, group_key, key, size, source_size,
    target, copies`` (how often the mix uses it).

    Null ids are shuffled by their text, a null source is a source of its own,
    a null or empty text has size 0, repeated rows are separate documents (the
    second and later ones are shuffled by key and number), an
    empty table gives an empty mix. Documents without words take no budget and
    are passed through by the merge like others (their copies add nothing)."""
    sized = _sized(docs, id_col, text, source)
    groups = _groups(sized)
    release(sized)
    return _plan(groups, weights, budget_ratio, max_repeat)


def _plan(groups: DataFrame, weights=WEIGHTS, budget_ratio: float = BUDGET_RATIO,
          max_repeat: int = MAX_REPEAT) -> DataFrame:
    digits = bin_digits(groups.agg(F.sum("rows")).first()[0] or 0)
    sized = _copies(groups).withColumn("bin", F.substring("key", 1, digits))
    words = groups.select("source", (F.col("size") * F.col("rows")).alias("size"))
    targets = source_targets(words, weights, budget_ratio, max_repeat)

    # running sum of each source, in the order of the hash
    by_source = Window.partitionBy("source").orderBy("bin")
    offsets = sized.groupBy("source", "bin").agg(F.sum("size").alias("bin_size")).select(
        F.col("source").alias("o_source"), F.col("bin").alias("o_bin"),
        (F.sum("bin_size").over(by_source) - F.col("bin_size")).alias("offset"))
    in_bin = Window.partitionBy("source", "bin").orderBy("key", "doc_id", "size", "copy")
    queue = sized.withColumn("in_bin", F.sum("size").over(in_bin.rowsBetween(Window.unboundedPreceding, 0)))
    queue = queue.join(offsets, queue["source"].eqNullSafe(offsets["o_source"])
                       & (queue["bin"] == offsets["o_bin"])).drop("o_source", "o_bin")
    t = targets.withColumnRenamed("source", "t_source")
    queue = queue.join(t, queue["source"].eqNullSafe(t["t_source"])).drop("t_source")

    # one row per possible use; virtual finish time; merge bins (of wordless sources, before all others: by hash)
    uses = queue.withColumn("pass", F.explode(F.array(*[F.lit(i) for i in range(max_repeat)])))
    end = F.col("pass") * F.col("source_size") + F.col("offset") + F.col("in_bin")
    uses = uses.withColumn("finish", F.when(F.col("target") > 0, end / F.col("target")).otherwise(F.lit(0.0)))
    wordless = -1 - F.conv("bin", 16, 10).cast("long")
    uses = materialize(uses.withColumn("slot", F.when(
        F.col("target") > 0, F.floor(F.col("finish") * 16 ** digits)).otherwise(wordless)), "mix-uses")
    slots = Window.partitionBy(F.lit(0)).orderBy("slot")  # the running sum over bins, not rows
    totals = uses.groupBy("slot").agg(F.sum("size").alias("slot_size")).select(
        F.col("slot").alias("o_slot"), (F.sum("slot_size").over(slots) - F.col("slot_size")).alias("merged"))
    budget = targets.agg(F.coalesce(F.sum("source_size") * F.lit(float(budget_ratio)), F.lit(0.0)).alias("budget"))
    in_slot = Window.partitionBy("slot").orderBy("finish", "key", "doc_id", "size", "pass", "copy")
    merged = uses.withColumn("in_slot", F.sum("size").over(in_slot.rowsBetween(Window.unboundedPreceding, 0)))
    merged = merged.join(totals, merged["slot"] == totals["o_slot"]).join(F.broadcast(budget))  # one row
    taken = F.col("merged") + F.col("in_slot") <= F.col("budget")
    return merged.groupBy("doc_id", "source", "group_key", "key", "size", "copy", "source_size", "target").agg(
        F.count_if(taken).alias("copies")).drop("copy")


def mix_sources(docs: DataFrame, id_col: str = "doc_id", text: str = "text", source: str = "source",
                **parameters) -> DataFrame:
    """The mix itself: the rows of ``docs``, each as often as the plan uses it,
    in no order (``plan_mix`` has the numbers).

    Rows that agree in id, source, size and key share their uses evenly, the odd ones
    by a hash of all columns (but maps and variants, which have none), so that
    reruns agree. Rows alike in that hash too are interchangeable; where there are more
    than BIN_ROWS, they are told apart by their place in ``docs``, which then has to be a table
    that gives its rows in the same order when read again, as files do. Nulls,
    empty and very long texts (counted whole) and empty tables are as in ``plan_mix``;
    clashing column names cannot arise."""
    # the caller's columns travel in one struct, so their names cannot clash
    held = docs.select(F.struct("*").alias("row"), F.monotonically_increasing_id().alias("at"))
    hashed = [F.col("row").getField(f.name) for f in docs.schema if not re.search(r"\b(map<|variant)", f.dataType.simpleString())]
    content = F.concat_ws(":", F.hex(F.xxhash64(*hashed)), F.hex(F.xxhash64(F.lit(1), *hashed)))
    held = held.select("row", "at", content.alias("content"), *[
        F.col("row").getField(c).alias(f"in_{n}") for n, c in (("id", id_col), ("text", text), ("source", source))])
    sized = _sized(held, "in_id", "in_text", "in_source", "content", "at")
    groups = _groups(sized)
    group = F.md5(F.concat_ws(":", "key", "size", F.isnull("doc_id"), F.isnull("source"), F.col("source").cast("string")))
    plan = _plan(groups, **parameters).withColumn("key", F.col("group_key"))
    uses = plan.select(group.alias("group"), "copies").groupBy("group").agg(
        F.sum("copies").alias("uses"), F.count(F.lit(1)).alias("rows"))

    # number the rows of a group by content: offsets of hash bins, of contents in a bin, of rows of one content
    pieces = max(1, math.ceil((groups.agg(F.max("rows")).first()[0] or 0) / BIN_ROWS))
    piece = F.pmod("at", F.lit(pieces)).alias("piece")
    alike = sized.select(group.alias("group"), "key", "content", piece).groupBy("group", "key", "content", "piece").agg(
        F.count(F.lit(1)).alias("n")).withColumn("hash_bin", F.pmod(F.xxhash64("content"), F.lit(HASH_BINS)))
    in_bin = Window.partitionBy("group", "hash_bin").orderBy("content", "piece")
    alike = alike.withColumn("before", F.sum("n").over(in_bin.rowsBetween(Window.unboundedPreceding, 0)) - F.col("n"))
    in_group = Window.partitionBy("group").orderBy("hash_bin")  # HASH_BINS rows at most
    bins = alike.groupBy("group", "hash_bin").agg(F.sum("n").alias("bin_n"))
    bins = bins.withColumn("bin_before", F.sum("bin_n").over(in_group) - F.col("bin_n")).join(uses, "group").filter("uses > 0")
    numbered = alike.join(bins, ["group", "hash_bin"]).select(
        "key", "content", "piece", (F.col("before") + F.col("bin_before")).alias("first"), "uses", "rows")

    keyed = held.select("row", _shuffle_key("in_id", "in_text").alias("key"), "content", piece)
    rows = keyed.join(numbered, ["key", "content", "piece"])
    n = F.col("first") + F.row_number().over(Window.partitionBy("key", "content", "piece").orderBy("content"))
    share = F.floor((F.col("uses") + F.col("rows") - F.col("n")) / F.col("rows")).cast("int")
    return rows.withColumn("n", n).select("row", F.explode(F.array_repeat(F.lit(1), share))).select("row.*")
