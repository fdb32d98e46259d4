"""The leading 64-bit sort key must never change the order."""

import random

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from oracle import oracle_key
from ordo.functions.prefix import LeadPlan, plan_from_sample
from ordo.operators.sort import sort_within

TEXTS = ["", "A", "Apple", "Apple pie", "Banana", "Zebra", "apple", "é", "ﬁ", "\U0001F600", "a\U0001F600",
         "a\x00", "a", "", "xy"]
NUMS = st.one_of(st.integers(-2**63, 2**63 - 1), st.integers(-3, 3), st.sampled_from([-2**63, 2**63 - 1, 0]))


def sorted_with_plan(lines_df, lines, plan, order="ordinal"):
    df = lines_df(lines).withColumnRenamed("value", "line").coalesce(1)
    return [r["line"] for r in sort_within(df, order, plan=plan).collect()]


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=st.lists(st.tuples(NUMS, st.sampled_from(TEXTS)), max_size=80),
       dictionary=st.lists(st.sampled_from([t for t in TEXTS if not any(ord(c) >= 0xE000 for c in t)]),
                           unique=True, max_size=8),
       lo=NUMS, span_bits=st.integers(0, 64))
def test_any_plan_keeps_the_order(lines_df, rows, dictionary, lo, span_bits):
    hi = min(lo + (1 << span_bits) - 1, 2**63 - 1)
    shift = max(0, (hi - lo).bit_length() - 47)
    plan = LeadPlan(tuple(sorted(dictionary, key=lambda s: s.encode("utf-8"))), lo, hi, shift) if dictionary else None
    lines = [f"{n}. {t}" for n, t in rows]
    assert sorted_with_plan(lines_df, lines, plan) == sorted(lines, key=oracle_key)


def test_plan_from_sample_picks_frequent_texts():
    rows = [("Apple", i) for i in range(500)] + [("Zebra", -i) for i in range(300)] + [("rare", 1)]
    plan = plan_from_sample(rows)
    assert plan.texts == ("Apple", "Zebra")
    assert (plan.lo, plan.hi, plan.shift) == (-299, 499, 0)
    assert plan_from_sample([]) is None
    assert plan_from_sample([("a", 1), ("b", 2)]) is None


def test_generated_like_data_with_sampled_plan(spark):
    from pyspark.sql import functions as F

    from ordo.operators.sort import lead_plan, sort_lines
    from ordo.sources.generator import generate_lines

    df = generate_lines(spark, 30_000, seed=5)
    lead = lead_plan(df)
    assert lead is not None
    got = [r["line"] for r in sort_lines(df, partitions=4, plan=lead).collect()]
    assert got == sorted((r["line"] for r in df.collect()), key=oracle_key)
    plan = sort_lines(df, partitions=4, plan=lead)._jdf.queryExecution().executedPlan().toString()
    assert "_lead" in plan


def test_utf8_order_with_plan(lines_df):
    rnd = random.Random(3)
    lines = [f"{rnd.randint(-9, 9)}. {rnd.choice(TEXTS)}" for _ in range(400)]
    plan = plan_from_sample([(t, 0) for t in TEXTS[:6]] * 10)
    got = sorted_with_plan(lines_df, lines, plan, order="utf8")

    def utf8_key(line):
        k = oracle_key(line)
        d = line.index(".")
        t = line[d + 1:]
        t = t[1:] if t.startswith(" ") else t
        return (t.encode("utf-8"), k[1], line.encode("utf-8"))
    assert got == sorted(lines, key=utf8_key)


def test_long_texts_stay_out_of_the_dictionary():
    long_text = "x" * 300
    plan = plan_from_sample([(long_text, i) for i in range(100)] + [("short", i) for i in range(100)])
    assert plan.texts == ("short",)
