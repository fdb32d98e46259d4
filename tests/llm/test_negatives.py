"""Hard negatives against all scores."""

import numpy as np
import pytest

from ordo.llm import hard_negatives as hn


def plain(rows, every=100):
    """Rows of (id, vector, label), by all scores in whole numbers."""
    kept = []
    for i, v, label in rows:
        if label is None or v is None or any(x is None or not np.isfinite(x) for x in v):
            continue
        if i is not None and i % 7 == 0:
            label = (label + 1) % 10
        kept.append((i, [int(np.floor(256 * x)) for x in v], label))
    out = []
    last = float("inf")
    for a, (i, v, label) in enumerate(kept):
        if i is None or i % every:
            continue
        scored = sorted((-sum(x * y for x, y in zip(v, w)), last if j is None else j, l == label)
                        for b, (j, w, l) in enumerate(kept) if b != a and len(v) == len(w))
        for p, name, same in [x for x in scored if x[2]][:5]:
            fits = [x for x in scored if not x[2] and 80 * -p <= 100 * -x[0] <= 100 * -p][:5]
            out += [(i, None if name == last else name, n + 1, None if x[1] == last else x[1], -p, -x[0]) for n, x in enumerate(fits)]
    return sorted(out, key=str)


def run(spark, rows, **own):
    df = spark.createDataFrame([(*r, "x", "y", 3) for r in rows], "vec_id bigint, embedding array<double>, label int, "
                               "row string, `dim.` string, centre int")
    return sorted((tuple(r) for r in hn.hard_negatives(df, **own).collect()), key=str)


@pytest.fixture
def small(monkeypatch):
    """Many blocks, lists, centres and stripes on little data."""
    for name, value in (("BLOCK", 60), ("MEMBERS", 3), ("STRIPE", 8), ("SLICE", 16)):
        monkeypatch.setattr(hn, name, value)


def clustered(n, dim, seed=1, spread=0.3):
    r = np.random.default_rng(seed)
    centre = r.standard_normal((10, dim))
    label = r.integers(0, 10, n)
    v = centre[label] + spread * r.standard_normal((n, dim)) * r.choice([0.5, 1, 4], n)[:, None]
    return [(i, [float(x) for x in v[i]], int(label[i])) for i in range(n)]


@pytest.mark.parametrize("dim,spread", [(16, 0.3), (6, 1.5), (1, 0.5)])
def test_against_all_scores(spark, small, dim, spread):
    rows = clustered(900, dim, spread=spread)
    got = run(spark, rows, anchor_every=4)  # 225 anchors: several centres
    assert got == plain(rows, 4) and len(got) > 500


def test_ties_nulls_and_repeats(spark, small):
    rows = [(i, [1.0, 0.5], i % 2) for i in range(60)]                      # equal scores: smaller ids first
    rows += [(i, [1.0, 0.45], 1 - i % 2) for i in range(200, 260)] * 2       # repeated rows
    rows += [(100, [2.0, -3.0], 4), (100, [1.0, 1.0], 4), (100, [0.0, 0.0], 4), (None, [1.0, 0.5], 0), (None, [1.0, 0.4], 1)]
    rows += [(300, None, 1), (400, [None, 1.0], 1), (500, [float("nan"), 1.0], 1), (600, [float("inf"), 0.0], 1),
             (700, [1.0, 0.5], None), (800, [1.0], 1), (801, [1.1], 1), (802, [0.9], 2), (900, [], 1), (901, [], 1), (902, [], 2),
             (1000, [-1.0, -1.0], 9), (1001, [0.9, 0.9], 9)]
    assert run(spark, rows) == plain(rows)
    assert run(spark, rows, anchor_every=3) == plain(rows, 3)


def test_empty_and_without_anchors(spark):
    assert run(spark, []) == [] and run(spark, [(1, [1.0], 1), (2, [1.0], 2)]) == []
    assert run(spark, [(100, [1.0], 1)]) == []


def test_large_components(spark, small):
    """Scores beyond 2^53 are exact; rows whose scores would not fit take no part."""
    r = np.random.default_rng(2)
    rows = [(i, [float(x) for x in r.integers(200_000, 400_000, 3)], i % 2) for i in range(200)]
    assert run(spark, rows) == plain(rows)
    assert run(spark, rows + [(201, [1e30, 1.0, 1.0], 1), (202, [-1e300, 1e300, 0.0], 0)]) == plain(rows)


def test_walk_stops_early():
    """A member far from the other candidates does not walk the whole list."""
    r = np.random.default_rng(3)
    near = r.standard_normal((50, 8)) * 0.01 + np.eye(8)[0]
    far = r.standard_normal((5000, 8)) * 0.01 - np.eye(8)[0]
    v = np.floor(256 * np.concatenate([near, far])).astype(np.int64)
    shared = hn.SharedList(v[:3].astype(float), v.astype(float))
    score = v[:3] @ v[shared.order].T
    for at in (0, 10, 49, 50, 51, 1000):
        assert (score[:, at:].max(axis=1) <= shared.reach(at)).all()
    assert (shared.reach(60) < np.sort(score, axis=1)[:, -6]).all()


def test_bounds_hold():
    r = np.random.default_rng(4)
    for dim in (1, 2, 5, 30):
        u, v = r.standard_normal((40, dim)) * 100, r.standard_normal((500, dim)) * r.choice([1, 1000], 500)[:, None]
        u[3], v[7] = 0, 0
        for members in (u, u[:1], u[3:4], np.concatenate([u[:1], -u[:1]])):
            shared = hn.SharedList(members, v)
            score = members @ v[shared.order].T
            assert all((score[:, at:].max(axis=1) <= shared.reach(at)).all() for at in range(0, 500, 7))
