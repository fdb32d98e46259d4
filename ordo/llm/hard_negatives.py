"""Hard negatives by shared lists of angular upper bounds (after MAXIMUS).

Scores are inner products of integer vectors. Anchors are clustered by direction
(k-means, fitted on a bounded sample). In a block of candidates every cluster of
anchors sorts the candidates once by an upper bound that holds for all members:
if ``a`` is a candidate's angle to the cluster's centre and ``r`` the largest of
any member, no member's score exceeds |member| |candidate| cos(max(0, a - r)).
Each member walks this one list and stops where the bound falls below the score
it still needs: the rest is certified not to matter.

The same bound holds for whole groups of candidates (those nearest to one
centre): an anchor goes only to the groups that may hold a score it needs.
Three visits find everything exactly: an anchor's positives in its own group,
which gives each anchor a score to beat; positives in the other groups that may
beat it; then negatives in the groups that reach the smallest score its windows
admit. A visit sends each candidate once to its block (once per 65,536 anchors)
and anchors to the blocks they visit, so a block and its anchors are bounded.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ordo.llm.tables import materialize, release, ship

SCALE = 256
SHIFT_LABEL, LABELS = 7, 10   # ids divisible by 7 take the next of 10 labels
ANCHOR_EVERY = 100
POSITIVES = NEGATIVES = 5
LOW, HIGH = 80, 100           # window of a negative's score in percent of its positive's

BLOCK = 4096                  # candidates in a block, on average
MEMBERS = 256                 # anchors that share one list, on average
STRIPE = 65_536               # anchors that one task takes to a block, at most on average
CENTRES = 1024                # at most; one per 64 anchors below that
SAMPLE_ROWS, SAMPLE_VALUES = 8192, 1 << 20  # anchors that the centres are fitted on
SLICE = 512                   # candidates scored at a time
NORM_LIMIT = float(1 << 55)   # sums of squares below: scores, and 80 times them, fit 64 bits


# ------------------------------------------------------------- inside a task

def fit_centres(vectors: np.ndarray, count: int, rounds: int = 8) -> np.ndarray:
    """Unit centres of ``count`` clusters of directions (spherical k-means)."""
    unit = directions(vectors)
    centres = unit[np.random.default_rng(12).permutation(len(unit))[:count]].copy()
    for _ in range(rounds):
        own = np.argmax(unit @ centres.T, axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, own, unit)
        norm = np.sqrt((sums * sums).sum(axis=1))
        centres = np.where(norm[:, None] > 0, sums / np.where(norm > 0, norm, 1)[:, None], centres)
    return centres


def directions(vectors: np.ndarray) -> np.ndarray:
    norm = np.sqrt((vectors * vectors).sum(axis=1, keepdims=True))
    return vectors / np.where(norm > 0, norm, 1)


def angles(cosines: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(cosines, -1, 1))


def upper_bounds(norms: np.ndarray, angle: np.ndarray, radius) -> np.ndarray:
    """No vector within ``radius`` of the centre has a larger inner product per
    unit of its length with a vector of that norm and angle. The allowance
    covers the rounding of the angles."""
    return norms * np.minimum(1.0, np.cos(np.clip(angle - radius, 0, np.pi)) + 1e-6)


def first_of_groups(group: np.ndarray, score: np.ndarray, name: np.ndarray, k: int) -> np.ndarray:
    """Indices of the first ``k`` of each group: largest score, then smallest name."""
    order = np.lexsort((name, -score, group))
    g = group[order]
    start = np.flatnonzero(np.r_[True, g[1:] != g[:-1]]) if len(g) else np.zeros(0, np.int64)
    rank = np.arange(len(g)) - np.repeat(start, np.diff(np.r_[start, len(g)]))
    return order[rank < k]


class SharedList:
    """Candidates of one block in the order of their bounds for one cluster."""

    def __init__(self, members: np.ndarray, rows: np.ndarray):
        norms = np.sqrt((rows * rows).sum(axis=1))
        unit = directions(members)
        middle = unit.sum(axis=0)
        size = np.sqrt((middle * middle).sum())
        # members that cancel out have no middle: then no angle is known to be too large
        centre, radius = (middle / size, None) if size > 0 else (middle, np.pi)
        if radius is None:
            real = (members != 0).any(axis=1)
            radius = angles(unit[real] @ centre).max() if real.any() else 0.0
        bound = upper_bounds(norms, angles(directions(rows) @ centre), radius)
        self.order = np.argsort(-bound, kind="stable")
        self.bound = bound[self.order]
        self.member_norms = np.sqrt((members * members).sum(axis=1))

    def reach(self, at: int) -> np.ndarray:
        """Upper bound of every member's scores from ``at`` on, with an allowance
        of half a unit (scores are integers)."""
        return self.member_norms * self.bound[at] * (1 + 1e-9) + 0.5


def walk(members: dict, block: dict, k: int, same_label: bool) -> tuple[np.ndarray, ...]:
    """For each member and slot the first ``k`` of the block's rows whose score
    lies in the slot's window: (member, slot, row of the block, score)."""
    wanted = members["low"].copy()   # [member, slot]: the score still needed
    high, slots = members["high"], members["high"].shape[1]
    u, v = members["v"], block["v"]
    shared = SharedList(u.astype(np.float64), v.astype(np.float64))
    exact = np.float64 if shared.member_norms.max() * np.sqrt((v.astype(np.float64) ** 2).sum(axis=1)).max() < 2 ** 52 else np.int64
    u = u.astype(exact)
    found = [np.zeros(0, np.int64) for _ in range(4)]   # group, score, name, row
    alive = np.arange(len(u))
    at = 0
    while at < len(v):
        alive = alive[shared.reach(at)[alive] >= wanted[alive].min(axis=1)]
        if not len(alive):
            break
        rows = shared.order[at:at + SLICE]
        at += SLICE
        score = (u[alive] @ v[rows].T.astype(exact)).astype(np.int64)
        fits = (members["label"][alive][:, None] == block["label"][rows][None, :]) == same_label
        fits &= members["row"][alive][:, None] != block["row"][rows][None, :]
        new = []
        for slot in range(slots):
            m, r = np.nonzero(fits & (score >= wanted[alive, slot][:, None]) & (score <= high[alive, slot][:, None]))
            new.append((alive[m] * slots + slot, score[m, r], block["name"][rows[r]], rows[r]))
        found = [np.concatenate([f, *parts]) for f, parts in zip(found, zip(*new))]
        best = first_of_groups(found[0], found[1], found[2], k)
        found = [f[best] for f in found]
        group, last, count = np.unique(found[0][::-1], return_index=True, return_counts=True)
        full = group[count == k]
        kth = found[1][::-1][last[count == k]]
        wanted[full // slots, full % slots] = kth
    return found[0] // slots, found[0] % slots, found[3], found[1]


# ------------------------------------------------------------- tables

_NO_NAME = (1 << 63) - 1   # a null id comes last among equal scores


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    flat = column.combine_chunks().flatten() if isinstance(column, pa.ChunkedArray) else column.flatten()
    return flat.to_numpy(zero_copy_only=False).reshape(len(column), len(flat) // max(1, len(column)))


def _by_length(lengths: np.ndarray):
    for d in np.unique(lengths):
        yield int(d), np.flatnonzero(lengths == d)


def integer_rows(vectors: DataFrame, id_col: str, vector: str, label: str) -> DataFrame:
    """``id, label, v, dim`` of the rows that take part."""
    x = F.transform(F.col(vector).cast("array<double>"), lambda c: c * float(SCALE))
    fits = lambda c: F.coalesce(F.abs(c) < float(1 << 28), F.lit(False))  # noqa: E731  false for NaN too
    ok = vectors.filter(F.col(label).isNotNull() & F.col(vector).isNotNull() & F.forall(x, lambda c: fits(c) & ~F.isnan(c)))
    v = F.transform(x, lambda c: F.when(fits(c), F.floor(c)).cast("int"))
    name = F.col(id_col).cast("bigint")
    moved = F.when(name % SHIFT_LABEL == 0, (F.col(label) + 1) % LABELS).otherwise(F.col(label))
    out = ok.select(name.alias("id"), moved.cast("bigint").alias("label"), v.alias("v"), F.size(v).alias("dim"))
    square = F.aggregate("v", F.lit(0.0), lambda n, c: n + c.cast("double") * c)
    return out.filter(square < NORM_LIMIT)


def _grouped(rows: DataFrame, anchors: DataFrame, anchor_count: int) -> tuple[DataFrame, np.ndarray]:
    """``rows`` with ``centre`` (-1: none fits their length), ``norm`` and
    ``angle`` to it, and the centres."""
    width = anchors.agg(F.max("dim")).first()[0] or 1
    sample = anchors.filter(F.col("dim") == width).orderBy(F.xxhash64("row")).limit(
        max(1, min(SAMPLE_ROWS, SAMPLE_VALUES // width))).select("v").toArrow()  # bounded
    count = max(1, min(CENTRES, anchor_count // 64, SAMPLE_VALUES // width, sample.num_rows))
    centres = fit_centres(_matrix(sample["v"]).astype(np.float64), count) if sample.num_rows else np.zeros((1, width))

    def assign(batches):
        for batch in batches:
            dims = batch.column(batch.schema.get_field_index("dim")).to_numpy()
            v = batch.column(batch.schema.get_field_index("v"))
            centre, norm, angle = np.full(len(dims), -1), np.zeros(len(dims)), np.full(len(dims), np.pi)
            for d, at in _by_length(dims):
                m = _matrix(v.take(pa.array(at))).astype(np.float64)
                norm[at] = np.sqrt((m * m).sum(axis=1))
                if d == centres.shape[1]:
                    cos = directions(m) @ centres.T
                    centre[at] = np.argmax(cos, axis=1)
                    angle[at] = angles(cos.max(axis=1))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(centre, pa.int32()), pa.array(norm), pa.array(angle)],
                [*batch.schema.names, "centre", "norm", "angle"])

    schema = "row bigint, id bigint, label bigint, v array<int>, dim int, centre int, norm double, angle double"
    return ship(rows.select("row", "id", "label", "v", "dim")).mapInArrow(assign, schema), centres


def _visit(candidates: DataFrame, asking: DataFrame, centres: np.ndarray, reach: dict, stripes: int,
           same_label: bool, k: int, own: bool | None) -> DataFrame:
    """``row, slot, id, score``: the first ``k`` candidates of every block visited.

    ``asking``: rows with ``low, high`` (arrays of windows). ``own``: only the
    group of their own centre, or (False) only the others, or (None) all. A group
    is visited if its bound reaches the smallest score needed."""

    def route(batches):
        groups = np.array(sorted(c for c in reach if c >= 0), np.int64)
        far = np.array([reach[c][1] for c in groups])
        long = np.array([reach[c][0] for c in groups])
        for batch in batches:
            at = {n: batch.column(i) for i, n in enumerate(batch.schema.names)}
            dims, centre = at["dim"].to_numpy(), at["centre"].to_numpy()
            norm = at["norm"].to_numpy()
            need = np.array([min(x) for x in at["low"].to_pylist()], np.float64)
            lists: list = [None] * len(dims)
            for d, rows in _by_length(dims):
                if d != centres.shape[1]:
                    for r in rows:
                        lists[r] = [] if own is False else [-1]
                    continue
                unit = directions(_matrix(at["v"].take(pa.array(rows))).astype(np.float64))
                if len(groups):
                    bound = upper_bounds(long[None, :], angles(unit @ centres[groups].T), far[None, :])
                    may = bound * norm[rows][:, None] * (1 + 1e-9) + 0.5 >= need[rows][:, None]
                    if own is not None:
                        may &= (groups[None, :] == centre[rows][:, None]) == own
                for i, r in enumerate(rows):
                    lists[r] = groups[may[i]].tolist() if len(groups) else []
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(lists, pa.list_(pa.int32()))],
                                             [*batch.schema.names, "goes"])

    names = "row bigint, label bigint, v array<int>, dim int, centre int, norm double, low array<bigint>, high array<bigint>"
    parts = F.create_map(*[x for c in sorted(reach) for x in (F.lit(c), F.lit(reach[c][2]))])  # at most CENTRES + 1
    routed = asking.select("row", "label", "v", "dim", "centre", "norm", "low", "high").mapInArrow(route, names + ", goes array<int>")
    routed = routed.select("row", "label", "v", "dim", F.col("centre").alias("own"), "low", "high", F.explode("goes").alias("centre"))
    routed = routed.select("*", F.explode(F.sequence(F.lit(0), F.element_at(parts, F.col("centre")) - 1)).alias("part"),
                           F.pmod(F.xxhash64("row"), F.lit(stripes)).cast("int").alias("stripe"))
    block = F.pmod(F.xxhash64("row"), F.element_at(parts, F.col("centre"))).cast("int")
    held = candidates.select("row", F.coalesce("id", F.lit(_NO_NAME)).alias("name"), "label", "v", "dim", "centre",
                             block.alias("part"), F.explode(F.sequence(F.lit(0), F.lit(stripes - 1))).alias("stripe"))
    out_names = ["row", "slot", "name", "score"]

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out = [np.zeros(0, np.int64) for _ in out_names]
        if left.num_rows and right.num_rows:
            block = {"v": _matrix(left["v"]), **{n: left[n].to_numpy() for n in ("row", "name", "label")}}
            rows, own_centre = right["row"].to_numpy(), right["own"].to_numpy()
            order = np.lexsort((rows, own_centre))
            # clusters: anchors of one centre, in lists of at most MEMBERS
            cuts = np.flatnonzero(np.r_[True, np.diff(own_centre[order]) != 0])
            ends = np.r_[cuts[1:], len(order)]
            clusters = [order[i:min(i + MEMBERS, e)] for s, e in zip(cuts, ends) for i in range(s, e, MEMBERS)]
            for at in clusters:
                some = right.take(pa.array(at))
                members = {"v": _matrix(some["v"]), "row": rows[at], "label": some["label"].to_numpy(),
                           "low": _matrix(some["low"]), "high": _matrix(some["high"])}
                member, slot, found, score = walk(members, block, k, same_label)
                for i, x in enumerate((rows[at][member], slot, block["name"][found], score)):
                    out[i] = np.concatenate([out[i], x])
        return pa.table([pa.array(x, pa.int64()) for x in out], out_names)

    key = ["dim", "centre", "part", "stripe"]
    return held.groupBy(*key).cogroup(routed.groupBy(*key)).applyInArrow(
        run, ", ".join(f"{n} bigint" for n in out_names))


def _best(found: DataFrame, k: int) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy("row", "slot").orderBy(F.desc("score"), "name"))
    return found.withColumn("rank", rank.cast("int")).filter(F.col("rank") <= k)


def hard_negatives(vectors: DataFrame, id_col: str = "vec_id", vector: str = "embedding", label: str = "label",
                   anchor_every: int = ANCHOR_EVERY) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``:
    for every anchor (id divisible by ``anchor_every``) and each of its first
    POSITIVES other rows of its label the first NEGATIVES rows of other labels whose
    score lies within LOW to HIGH percent of the positive's.

    Rows with a null label, a null vector, or a null or non-finite component take
    no part; nor do those whose integer squares sum to 2^55 or more (such scores
    would not fit). Only vectors of equal length are compared; empty ones score 0.
    Rows, not ids, are told apart: repeated ids and repeated rows all take part, as
    anchors too. A null id is no anchor and comes last among equal scores. Other
    columns are not read. An empty table, or one without anchors, gives no rows."""
    rows = integer_rows(vectors, id_col, vector, label)
    rows = materialize(rows.withColumn("row", F.monotonically_increasing_id()), "negatives-rows")
    is_anchor = F.coalesce(F.col("id") % anchor_every == 0, F.lit(False))
    anchors = rows.filter(is_anchor)
    count = anchors.count()
    grouped, centres = _grouped(rows, anchors, count)
    grouped = materialize(grouped, "negatives-grouped")
    release(rows)
    stripes = max(1, -(-count // STRIPE))
    # one row per centre: largest norm and angle, and how many blocks its candidates take
    reach = {r["centre"]: (r["norm"], r["angle"], max(1, -(-r["n"] // BLOCK))) for r in grouped.groupBy("centre").agg(
        F.max("norm").alias("norm"), F.max("angle").alias("angle"), F.count(F.lit(1)).alias("n")).collect()} or {-1: (0.0, 0.0, 1)}
    anchors = grouped.filter(is_anchor)
    any_score = F.lit(-(1 << 62)).cast("bigint")
    top = F.lit(1 << 62).cast("bigint")

    def visit(asking, same_label, k, own):
        return _visit(grouped, asking, centres, reach, stripes, same_label, k, own)

    # positives: at home first, then wherever the fifth best may still be beaten
    asked = anchors.select("*", F.array(any_score).alias("low"), F.array(top).alias("high"))
    home = materialize(_best(visit(asked, True, POSITIVES, True), POSITIVES), "negatives-home")
    beat = home.filter(F.col("rank") == POSITIVES).select("row", F.col("score").alias("beat"))
    asked = anchors.join(beat, "row", "left").select(
        "*", F.array(F.coalesce("beat", any_score)).alias("low"), F.array(top).alias("high"))
    away = visit(asked, True, POSITIVES, False)
    positives = materialize(_best(home.select("row", "slot", "name", "score").unionByName(away), POSITIVES),
                            "negatives-positives")
    release(home)

    # negatives: one window per positive; ceil(80 p / 100) for p >= 0, none below
    windows = positives.filter(F.col("score") >= 0).select("row", (F.col("rank") - 1).alias("slot"), F.col("score").alias("p"))
    low = F.expr(f"({LOW} * p + {HIGH - 1}) div {HIGH}")
    pairs = windows.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("slot", low.alias("low"), F.col("p").alias("high")))).alias("w"))
    # at most POSITIVES windows; missing ones are filled with an empty window
    spare = F.array_repeat(top, POSITIVES - F.size("w"))
    asked = anchors.join(pairs, "row").select(
        *anchors.columns, F.concat(F.col("w.low"), spare).alias("low"),
        F.concat(F.col("w.high"), F.transform(spare, lambda x: -x)).alias("high"))
    negatives = _best(visit(asked, False, NEGATIVES, None), NEGATIVES)
    name = lambda c: F.when(F.col(c) != _NO_NAME, F.col(c))
    p = positives.select("row", (F.col("rank") - 1).cast("bigint").alias("slot"), name("name").alias("positive_id"),
                         F.col("score").alias("positive_score"))
    return negatives.join(p, ["row", "slot"]).join(anchors.select("row", F.col("id").alias("anchor_id")), "row").select(
        "anchor_id", "positive_id", "rank", name("name").alias("negative_id"), "positive_score",
        F.col("score").alias("negative_score"))
