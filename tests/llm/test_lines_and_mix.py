"""Line dedup and source mixing."""

from collections import Counter
import hashlib
import re

import pytest
from plain import WORD, prose
from pyspark.sql import functions as F

from ordo.llm import mixing
from ordo.llm.line_dedup import dedup_lines, spread_lines
from ordo.llm.mixing import mix_sources, plan_mix, source_targets


def plain_dedup(rows, min_sites):
    sites = {}
    for _, t, s in rows:
        for line in (t or "").split("\n") if t is not None else []:
            if line.strip(" "):
                sites.setdefault(line.strip(" "), set()).add(s)
    out = []
    for d, t, s in rows:
        if t is None:
            out.append((d, 0, 0, None))
            continue
        lines = t.split("\n")
        rest = [x for x in lines if len(sites.get(x.strip(" "), ())) < min_sites]
        out.append((d, len(lines), len(lines) - len(rest), "\n".join(rest)))
    return out


def key(r):
    return tuple((x is not None, x) for x in r)


def test_lines_against_plain(make_docs):
    rows = []
    for i in range(60):
        lines = prose(i, 90).split("\n")
        if i % 2 == 0:
            lines.insert(1, "Subscribe to our newsletter today.")
        if i % 5 == 0:
            lines += ["  All rights reserved. ", "All rights reserved."]
        if i % 30 == 0:
            lines = ["Subscribe to our newsletter today."] * 3 + ["x"]
        rows.append((i, "\n".join(lines), f"s{i % 7}" if i % 11 else None))
    for sites in (2, 6, 7, 8, 9):
        got = dedup_lines(make_docs(rows), min_sites=sites).selectExpr("row.doc_id", "n_lines", "n_removed", "clean_text").collect()
        assert sorted(map(key, map(tuple, got))) == sorted(map(key, plain_dedup(rows, sites)))


def test_spread_is_exact_near_the_threshold(spark):
    """300 sites per line at a threshold of 300: far beyond what a sketch counts exactly."""
    lines = [(f"site{i}", h) for h in (1, 2, 3, 4) for i in range({1: 299, 2: 300, 3: 301, 4: 900}[h])]
    df = spark.createDataFrame(lines, "site string, line_hash bigint")
    for lg_k in (4, 12):  # a coarse sketch needs a wide band
        got = {r["line_hash"] for r in spread_lines(df, 300, lg_k, 0.95 if lg_k == 4 else 0.15).collect()}
        assert got == {2, 3, 4}


def test_only_copies_stay_whole(make_docs):
    """Short pages lose boilerplate that is most of them; copies of a page stay, also with an edited line."""
    sold = [f"Line {i} of a page that was copied to many sites." for i in range(8)]
    foot = "All rights reserved, as on any other site."
    rows = [(i, "\n".join(sold), f"s{i}") for i in range(12)]                               # copies of one page
    rows += [(20, "\n".join(sold[:3] + ["Edited here only."] + sold[4:]), "s20")]
    rows += [(100 + i, f"{foot}\nOwn {i} {i * 7919} {prose(i, 3)}", f"t{i}") for i in range(12)]   # pages with a long foot
    rows += [(200, "\n".join([foot] * 3 + ["Only text"]), "t1"), (201, foot, "t2")]
    got = {r["doc_id"]: (r["n_removed"], r["clean_text"]) for r in
           dedup_lines(make_docs(rows), min_sites=10, keep_copies=True).selectExpr("row.doc_id", "n_removed", "clean_text").collect()}
    for d, t, _ in rows:
        lines = t.split("\n")
        want = [x for x in lines if x != foot]
        assert got[d] == (len(lines) - len(want), "\n".join(want)), d
    plain = {d: (n, t) for d, _, n, t in plain_dedup(rows, 10)}
    got = {r["doc_id"]: (r["n_removed"], r["clean_text"]) for r in
           dedup_lines(make_docs(rows), min_sites=10).selectExpr("row.doc_id", "n_removed", "clean_text").collect()}
    assert got == plain and plain[3] == (8, "") and plain[201] == (1, "")  # without it, from every document


def test_dotted_and_ticked_names(spark):
    df = spark.createDataFrame([(1, "a\nb", "s", 5, 6)], "doc_id bigint, text string, source string, `a.b` int, `c``d` int")
    assert dedup_lines(df).select("row.*").first().asDict() == df.first().asDict()
    assert mix_sources(df).columns == df.columns

def test_lines_messy_and_empty(messy, make_docs):
    docs, rows = messy
    got = dedup_lines(docs, min_sites=2).select("row.doc_id", "n_lines", "n_removed", "clean_text", "row.key").collect()
    assert len(got) == len(rows) and all(r["key"] == "x" for r in got)
    assert [r["clean_text"] for r in got if r["n_lines"] == 0] == [None, None]
    assert dedup_lines(make_docs([])).count() == 0


def test_no_python_in_native_plans(messy):
    docs, _ = messy
    for df in (dedup_lines(docs), dedup_lines(docs, keep_copies=True), plan_mix(docs), mix_sources(docs)):
        assert not re.search("Python|Arrow|Pandas", df._jdf.queryExecution().toString())


# ------------------------------------------------------------------ mixing

def plain_targets(sizes):
    order = sorted(s for s in sizes if s is not None) + ([None] if None in sizes else [])
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    target, open_, budget = {}, set(order), 1.5 * sum(sizes.values())
    while True:
        level = (budget - sum(target.values())) / max(sum(weight[s] for s in open_), 1e-9)
        over = {s for s in open_ if weight[s] * level > 2 * sizes[s]}
        if not over:
            return target | {s: weight[s] * level for s in open_}
        target |= {s: 2.0 * sizes[s] for s in over}
        open_ -= over


def test_targets_against_plain(spark):
    for sizes in ({"a": 100, "b": 100, "c": 100}, {"a": 5, "b": 1000, None: 70, "Z": 9}, {"x": 10},
                  {f"s{i}": (i * 37) % 101 + 1 for i in range(20)} | {"s0": 3000}):
        got = source_targets(spark.createDataFrame([(s, n) for s, n in sizes.items()], "source string, size bigint")).collect()
        want = plain_targets(sizes)
        assert {r["source"] for r in got} == set(want)
        for r in got:
            assert r["target"] == pytest.approx(want[r["source"]]) and r["source_size"] == sizes[r["source"]]


def test_mix_against_plain(make_docs):
    rows = [(i, prose(i, 5 + (i * 13) % 90), ("a", "b", "c", None)[min(3, (i * i) % 7)]) for i in range(150)]
    docs = make_docs(rows)
    got = {r["doc_id"]: r for r in plan_mix(docs).collect()}
    size = {d: len(WORD.findall(t)) for d, t, _ in rows}
    target = plain_targets({s: sum(size[d] for d, _, x in rows if x == s) for s in {r[2] for r in rows}})
    uses = []
    for s in target:
        end = 0
        for n in (0, 1):
            for d in sorted((d for d, _, x in rows if x == s), key=lambda d: hashlib.md5(str(d).encode()).hexdigest()):
                end += size[d]
                uses.append((end / target[s], hashlib.md5(str(d).encode()).hexdigest(), d, n))
    total, copies, budget = 0, dict.fromkeys(size, 0), 1.5 * sum(size.values())
    for _, _, d, _ in sorted(uses):
        total += size[d]
        copies[d] += total <= budget
    assert {d: r["copies"] for d, r in got.items()} == copies
    for s in target:
        taken = sum(r["copies"] * r["size"] for r in got.values() if r["source"] == s)
        assert abs(taken - target[s]) <= 2 * max(size.values())
    again = {r["doc_id"]: r["copies"] for r in plan_mix(docs.repartition(7)).collect()}
    assert again == copies
    mixed = mix_sources(docs)
    assert mixed.columns == docs.columns
    assert {r["doc_id"]: r["count"] for r in mixed.groupBy("doc_id").count().collect()} == {d: c for d, c in copies.items() if c}


def test_mix_messy_and_empty(messy, make_docs):
    docs, rows = messy
    got = plan_mix(docs).collect()
    assert len(got) == len(rows) and all(0 <= r["copies"] <= 2 for r in got)
    assert mix_sources(docs).count() == sum(r["copies"] for r in got)
    assert plan_mix(make_docs([])).count() == 0 and mix_sources(make_docs([])).count() == 0
    wordless = make_docs([(1, "", "a"), (2, None, "a"), (None, None, None)])
    assert [r["size"] for r in plan_mix(wordless).collect()] == [0, 0, 0]
    assert docs.select(F.col("key")).first()["key"] == "x"


def test_mix_does_not_depend_on_its_bins(spark, make_docs, monkeypatch):
    docs = make_docs([(i, prose(i, 1 + (i * 13) % 60), "ab"[i % 2]) for i in range(120)])
    plan = lambda: {r["doc_id"]: r["copies"] for r in plan_mix(docs).collect()}
    want = plan()
    for least, rows in ((1, 65_536), (1, 4), (5, 65_536)):
        monkeypatch.setattr(mixing, "LEAST_BIN_DIGITS", least)
        monkeypatch.setattr(mixing, "BIN_ROWS", rows)
        assert plan() == want
    monkeypatch.undo()
    assert [mixing.bin_digits(n) for n in (0, 10 ** 6, 10 ** 9, 10 ** 11)] == [3, 3, 3, 5]


def test_rows_alike_but_for_other_columns_mix_alike_on_reruns(spark):
    rows = [(1, f"{c} words here", "a", f"u{c}", {"k": c}) for c in "abcdefg"] + [(2, "more words", "b", "v", None)] * 5
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string, `u.rl` string, tags map<string,string>")
    seen = lambda df: sorted(map(str, mix_sources(df).drop("tags").collect()))
    want = seen(docs)
    assert want and all(seen(docs.repartition(n)) == want for n in (1, 3, 5))


def test_a_large_group_of_equal_rows_is_split(spark, make_docs, monkeypatch):
    """A third of all rows without id, with one text: their copies lie in many bins,
    the plan is the same whatever the bins, and the mix keeps the uses of each group."""
    rows = [(i, prose(i, 5 + i % 40), "ab"[i % 2]) for i in range(200)] + [(None, "the same few words", "a")] * 100 + [(7, "", "z")] * 30
    docs = make_docs(rows).repartition(3)
    plan = lambda: Counter((r["doc_id"], r["size"], r["source_size"], r["target"], r["copies"]) for r in plan_mix(docs).collect())
    want = plan()
    assert sum(want.values()) == len(rows)
    keys = [r["key"] for r in plan_mix(docs).filter("doc_id IS NULL").collect()]
    assert len(set(keys)) == 100
    monkeypatch.setattr(mixing, "BIN_ROWS", 16)  # groups become blocks, rows alike become pieces
    monkeypatch.setattr(mixing, "LEAST_BIN_DIGITS", 1)
    assert plan() == want
    uses = Counter()
    for (doc_id, size, _, _, copies), n in want.items():
        uses[doc_id, size] += copies * n
    mixed = mix_sources(docs).collect()
    assert Counter((r["doc_id"], len(WORD.findall(r["text"]))) for r in mixed) == +uses
    per_row = Counter(r["text"] for r in mixed)["the same few words"]
    assert 0 < per_row <= 200


def test_mix_with_repeated_rows_equals_its_sql(make_docs, tmp_path, spark):
    import duckdb

    from ordo.llm.queries import ORACLE_SQL, op9_source_mix
    rows = [(i % 90, prose(i % 7, 5 + i % 30), ("a", "b", None)[i % 3]) for i in range(300)] + [(None, "no id here", "c")] * 40
    make_docs(rows).write.parquet(f"{tmp_path}/documents.parquet")
    duckdb.sql(f"CREATE OR REPLACE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    columns = ["doc_id", "size", "source_size", "target", "taken"]
    want = Counter(tuple(r) for r in duckdb.sql(ORACLE_SQL["op9_source_mix"]).select(*columns).fetchall())
    assert Counter(tuple(r) for r in op9_source_mix(spark, str(tmp_path)).select(*columns).collect()) == want
