"""Near-duplicates against brute force on all pairs."""

import random
import re

from plain import links_brute, prose, shingles

from ordo.llm.components import components
from ordo.llm.minhash_dedup import near_duplicates


def plain_components(ids, links):
    low = {i: i for i in ids}
    changed = True
    while changed:
        changed = False
        for a, b in links:
            m = min(low[a], low[b])
            if low[a] != m or low[b] != m:
                low[a] = low[b] = m
                changed = True
    return low


def test_components_of_chains_stars_and_loops(spark):
    links = [(i, i + 1) for i in range(1, 40)] + [(100, i) for i in range(101, 160)] + [(7, 7), (200, 201), (201, 200), (-5, 300)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    ids = {x for p in links for x in p}
    want = {i: c for i, c in plain_components(ids, links).items() if any(i in p and p[0] != p[1] for p in links)}
    assert got == want


def test_components_of_no_links(spark):
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_against_all_pairs(make_docs):
    r = random.Random(4)
    texts = []
    for g in range(12):
        base = prose(g, r.randint(30, 300)).split()
        for _ in range(r.randint(1, 9)):
            w = list(base)
            for _ in range(r.randint(0, max(1, len(w) // 22))):  # around the threshold
                w[r.randrange(len(w))] = f"edit{r.randrange(10**6)}"
            texts.append(" ".join(w))
    texts += ["one two three", "ONE two  three", "one two", "", None, "one two three four"]
    rows = [(i * 3 + 1, t, "s") for i, t in enumerate(texts)]
    got = {x["id"]: x for x in near_duplicates(make_docs(rows), k=4).collect()}
    low = plain_components([i for i, _, _ in rows], links_brute({i: t for i, t, _ in rows}, 4))
    assert {i: x["component_id"] for i, x in got.items()} == low
    assert all(x["kept"] == (low[i] == i) and x["n_shingles"] == len(shingles(t, 4))
               for (i, t, _) in rows for x in [got[i]])
    assert len(set(low.values())) < len(low) - 10  # there was something to find


def test_large_group_of_near_copies(make_docs):
    base = prose(3, 150).split()
    rows = []
    for i in range(150):
        w = list(base)
        w[(7 * i) % len(w)] = f"own{i}"
        rows.append((i, " ".join(w), "s"))
    got = near_duplicates(make_docs(rows), k=5).collect()
    low = plain_components(range(150), links_brute({i: t for i, t, _ in rows}, 5))
    assert {x["id"]: x["component_id"] for x in got} == low


def test_ids_with_several_texts_join_their_groups(make_docs):
    texts = {1: [prose(1, 90)], 2: [prose(1, 90), prose(2, 90)], 3: [prose(2, 90)], 4: [prose(3, 90), prose(2, 90) + " end"], 5: [prose(4, 90)]}
    got = near_duplicates(make_docs([(i, t, "s") for i, ts in texts.items() for t in ts]), k=5).collect()
    assert sorted((x["id"], x["component_id"]) for x in got) == [(1, 1), (2, 1), (2, 1), (3, 1), (4, 1), (4, 1), (5, 5)]


def test_messy(messy):
    docs, rows = messy
    got = near_duplicates(docs, k=5).collect()
    assert len(got) == len(rows)
    by = {}
    for x in got:
        by.setdefault(x["id"], []).append(x)
    assert [x["component_id"] for x in by[2]] == [1, 1] and by[7][0]["component_id"] == 6
    assert all(x["component_id"] is None and x["kept"] for x in by[None])
    assert all(by[i][0]["n_shingles"] == 0 and by[i][0]["kept"] for i in (3, 4, 5))


def test_empty(make_docs):
    assert near_duplicates(make_docs([])).count() == 0


def test_words_are_ascii_space_separated():
    assert re.findall(r"[^\x20\x09-\x0D]+", "a b c") == ["a b", "c"] and len(shingles("a b c", 2)) == 1
