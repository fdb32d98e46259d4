"""An exact 64-bit leading sort key for texts that repeat a lot.

Spark's sort compares an 8-byte prefix of the first sort key and only reads
the rows when prefixes tie. When few texts cover many rows (one text may
hold a third of all rows), the text prefix ties almost always and nearly
every comparison reads both rows from memory. ``lead_key`` gives such rows a
prefix that also carries their number, so their comparisons stay in the
prefix array.

From a small sample: ``texts`` = the most frequent text keys, sorted; the
number range. For a row with text key ``k`` let ``u`` = number of dictionary
texts <= ``k`` (a balanced CASE tree of string comparisons, about log2(64)
of them). Then

    lead = (2u - 1) << 48 | q(number)   if u >= 1 and texts[u] == k  (frequent)
    lead = (2u) << 48                   otherwise (the gap after texts[u])

with ``q`` a monotone map of int64 into [0, 2^47]. Sorting by
(lead, text keys, number, line) equals sorting by (text keys, number, line)
for every input: ``lead`` is non-decreasing along that order, and ties fall
through to the full key. The dictionary only decides how often the prefix
settles a comparison, never the order.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_TEXTS = 64          # dictionary size
MIN_SHARE = 0.002       # a text must hold at least this share of the sample
MAX_TEXT_BYTES = 256    # longer texts stay out of the literals of the CASE tree
_Q_BITS = 47
_SLOT_SHIFT = 48


@dataclass(frozen=True)
class LeadPlan:
    texts: tuple[str, ...]  # sorted by the text key order (string order of the key)
    lo: int
    hi: int
    shift: int


def plan_from_counts(counts: list[tuple[str, int]], total: int, lo: int, hi: int,
                     max_texts: int = MAX_TEXTS, min_share: float = MIN_SHARE) -> LeadPlan | None:
    """The plan for ``(text key, rows)`` of a sample of ``total`` rows with
    numbers from ``lo`` to ``hi``."""
    need = max(2, int(min_share * total))
    frequent = sorted((c for c in counts if c[1] >= need), key=lambda c: (-c[1], c[0]))[:max_texts]
    if not frequent:
        return None
    shift = max(0, (hi - lo).bit_length() - _Q_BITS)
    return LeadPlan(tuple(sorted((k for k, _ in frequent), key=lambda s: s.encode("utf-8"))), lo, hi, shift)


def plan_from_sample(rows: list[tuple[str, int]]) -> LeadPlan | None:
    """The plan for plain ``(text_key, number)`` rows (text keys of rows that need
    the UTF-16 tie key are excluded by the caller)."""
    if not rows:
        return None
    counts = Counter(k for k, _ in rows if len(k.encode("utf-8")) <= MAX_TEXT_BYTES)
    nums = [n for _, n in rows]
    return plan_from_counts(list(counts.items()), len(rows), min(nums), max(nums))


def sample_plan(sample: DataFrame, text_key: Column, number: Column, plain: Column,
                max_texts: int = MAX_TEXTS) -> LeadPlan | None:
    """Build the plan from all rows of ``sample``. Spark counts; the driver receives
    at most ``max_texts`` texts of at most MAX_TEXT_BYTES."""
    keyed = sample.select(text_key.alias("k"), number.alias("n"), plain.alias("p")).where(
        F.col("n").isNotNull() & F.col("p") & (F.octet_length("k") <= MAX_TEXT_BYTES))
    counts = keyed.groupBy("k").agg(F.count(F.lit(1)).alias("c"), F.min("n").alias("lo"), F.max("n").alias("hi"))
    top = counts.orderBy(F.desc("c"), "k").limit(max_texts)
    rows = top.agg(F.collect_list(F.struct("k", "c")).alias("top"), F.min("lo").alias("lo"), F.max("hi").alias("hi")).first()
    if not rows["top"]:
        return None
    # a share of the frequent rows is a smaller total than all sampled rows: the dictionary may only grow
    total = sum(r["c"] for r in rows["top"])
    return plan_from_counts([(r["k"], r["c"]) for r in rows["top"]], total, rows["lo"], rows["hi"], max_texts)


def _upper_bound(k: Column, texts: tuple[str, ...], lo: int, hi: int) -> Column:
    """Number of ``texts`` (1-based slice lo..hi) that are <= k, as a CASE tree."""
    if lo > hi:
        return F.lit(lo - 1)
    mid = (lo + hi) // 2
    return F.when(k < F.lit(texts[mid - 1]), _upper_bound(k, texts, lo, mid - 1)).otherwise(
        _upper_bound(k, texts, mid + 1, hi)
    )


def lead_key(plan: LeadPlan | None, text_key: Column, number: Column, plain: Column) -> Column:
    """The leading sort key; ``plain`` is true when ``text_key`` alone orders
    the text (no UTF-16 tie key needed)."""
    if plan is None:
        return F.lit(0).cast("bigint")
    u = _upper_bound(text_key, plan.texts, 1, len(plan.texts))
    at_u = F.element_at(F.array(*[F.lit(t) for t in plan.texts]), F.greatest(u, F.lit(1)))
    frequent = (u >= 1) & (at_u == text_key) & plain
    clamped = F.greatest(F.least(number, F.lit(plan.hi)), F.lit(plan.lo))
    q = F.shiftright(clamped, plan.shift) - F.lit(plan.lo >> plan.shift)
    odd = F.shiftleft((u * 2 - 1).cast("bigint"), _SLOT_SHIFT) + q
    even = F.shiftleft((u * 2).cast("bigint"), _SLOT_SHIFT)
    return F.when(frequent, odd).otherwise(even)
