"""MinHash near-dedup by an inverted join on signature coordinates.

1. Signatures. A document's words make a set of shingles; coordinate i of its
   signature is the minimum of the i-th hash over the set. Two documents agree
   in a coordinate with the probability of their Jaccard similarity.
2. Texts with the same set are one class from here on (found by a 128-bit
   digest of the set): a group of exact copies costs one posting.
3. Posting. A class is posted under its coordinate-value pairs, except
     - pairs that no other class has, and classes left with fewer than the
       match threshold t (they cannot reach it),
     - the t - 1 most frequent of its K pairs: the prefix principle. Classes
       that agree in t coordinates agree in one of the others, so the longest
       lists are skipped when lists are merged and are consulted only when the
       collisions of a candidate are counted on the whole signatures.
4. Merging. Within a list, every class meets a few pivots of the list rather
   than every other member. Candidates with at least t collisions are checked
   on the full shingle sets, and links join components. A second merge then
   looks only for pairs whose components still differ, among the classes of
   lists that hold several components. They are found by the prefix principle on
   the shingles themselves, which for given sizes is exact: an edited copy that
   no pivot reached has shingles of its own before those of the original. Pairs
   inside a component could add no reachability, so no group is expanded into all
   its pairs, and no link between components is lost.

With K = 32 and t = 15 two texts of similarity 0.8 fail to become candidates
with probability 5e-6 (binomial), and less above.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordo.llm.components import components
from ordo.llm.tables import materialize, release, ship
from ordo.llm.words import blocks, mix, shingle_sets

COORDINATES = 32      # K
MATCHES = 15          # t: collisions that make a candidate
SIMILARITY_PERCENT = 80
HASH_PIVOTS = 2       # pivots of a posting list by hash, besides its two most central classes

_SEEDS = mix(np.arange(1, COORDINATES + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_HEAD = {"n_shingles": "bigint", "digest_a": "bigint", "digest_b": "bigint"}


def signature(shingles: np.ndarray) -> np.ndarray:
    """The K minima of a non-empty set, mixed with their coordinate number so
    that a value alone names the coordinate-value pair."""
    low = np.array([(shingles * (s | np.uint64(1)) ^ s).min() for s in _SEEDS], np.uint64)
    return mix(low ^ _SEEDS)


def _signatures(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, offsets, data in blocks(batch.column(1)):
                sets = shingle_sets(offsets, data, k)
                head = np.array([(len(s), int(s.sum(dtype=np.uint64).view(np.int64)),
                                  int(np.bitwise_xor.reduce(mix(s)).view(np.int64)) if len(s) else 0)
                                 for s in sets], np.int64).reshape(-1, 3)
                pairs = [signature(s).view(np.int64) if len(s) else None for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(row, len(sets)), *(pa.array(head[:, i]) for i in range(3)),
                     pa.array(pairs, pa.list_(pa.int64()))], ["id", *_HEAD, "pairs"])
    return run


def _sets(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, offsets, data in blocks(batch.column(1)):
                sets = shingle_sets(offsets, data, k)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(row, len(sets)),
                     pa.array([s.tobytes() for s in sets], pa.binary())], ["id", "shingles"])
    return run


def _similar(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3)):
                p, q = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
                both = len(p) + len(q) - len(np.union1d(p, q))
                keep.append(100 * both >= percent * (len(p) + len(q) - both) and both > 0)
            mask = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(mask), batch.column(1).filter(mask)], ["a", "b"])
    return run


def _flat(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(batch.num_rows):
            s = np.frombuffer(batch.column(1)[i].as_buffer(), np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(s), batch.column(0)[i].as_py(), np.int64)), pa.array(s)], ["id", "shingle"])


def _rare_postings(sets: DataFrame, parts: DataFrame, percent: int) -> DataFrame:
    """``id, part, size, shingle, at`` for the sets of ``parts`` (id, part): the
    shingles that decide. A set's shingles stand in the order of their frequency
    (``at`` counts from 0); two sets with an overlap of o have one of their first
    size - o + 1 in common, whatever set it is. Shingles of one set only take
    their places but are not posted."""
    among = sets.join(parts.select("id"), "id", "left_semi").dropDuplicates(["id", "shingles"])
    flat = among.mapInArrow(_flat, "id bigint, shingle bigint")
    shared = flat.groupBy("shingle").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    ranked = flat.join(shared, "shingle").groupBy("id").agg(F.sort_array(F.collect_list(F.struct("n", "shingle"))).alias("l"))
    size = among.groupBy("id").agg(F.max(F.octet_length("shingles") / 8).cast("int").alias("size"))
    own = F.col("size") - F.size("l")
    decide = F.col("size") - F.ceil(F.col("size") * percent / 100).cast("int") + 1 - own
    posted = ranked.join(size, "id").filter(decide > 0).select(
        "id", "size", own.alias("own"), F.posexplode(F.slice(F.col("l"), F.lit(1), decide)).alias("at", "s"))
    return posted.join(parts, "id").select("id", "part", "size", F.col("s.shingle").alias("shingle"),
                                           (F.col("own") + F.col("at")).alias("at"))


def _linked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Those of ``pairs`` (a, b) whose full sets are similar enough. Pairs are
    dealt out evenly by the larger id, which few pairs share."""
    x = sets.withColumnsRenamed({"id": "a", "shingles": "x"})
    y = sets.withColumnsRenamed({"id": "b", "shingles": "y"})
    full = pairs.join(y, "b").join(x, "a").select("a", "b", "x", "y")
    return full.mapInArrow(_similar(percent), "a bigint, b bigint")


def _collisions(pairs: DataFrame, signed: DataFrame, matches: int, percent: int) -> DataFrame:
    """Those of ``pairs`` that agree in at least ``matches`` coordinates and whose
    set sizes allow the similarity at all."""
    x = signed.select(F.col("id").alias("a"), F.col("pairs").alias("x"), F.col("n_shingles").alias("m"))
    y = signed.select(F.col("id").alias("b"), F.col("pairs").alias("y"), F.col("n_shingles").alias("n"))
    same = F.aggregate(F.zip_with("x", "y", lambda p, q: (p == q).cast("int")), F.lit(0), lambda n, m: n + m)
    sizes = 100 * F.least("m", "n") >= percent * F.greatest("m", "n")
    return pairs.join(y, "b").join(x, "a").filter(sizes & (same >= matches)).select("a", "b")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text: str = "text", k: int = 5,
                    similarity_percent: int = SIMILARITY_PERCENT, matches: int = MATCHES) -> DataFrame:
    """``id, n_shingles, component_id, kept``: one row per input row.

    Documents are linked if 100 x |intersection| >= similarity_percent x
    |union| of their sets of ``k``-word shingles; ``component_id`` is the
    smallest id reachable, ``kept`` marks it.

    A text without words (null, empty, spaces) has an empty set, is linked with
    nothing and kept. Rows with a null id are not linked either: component null,
    kept. Rows that share an id are one node: linked by any of their texts.
    An empty table gives no rows. Texts of any length are taken whole; ``id_col`` holds
    whole numbers; other columns are not read."""
    src = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text).cast("string").alias("text"))
    head = ", ".join(f"{c} {t}" for c, t in _HEAD.items())
    signed = materialize(ship(src).mapInArrow(_signatures(k), f"id bigint, {head}, pairs array<bigint>"), "signatures")
    filled = signed.filter("id is not null and n_shingles > 0")

    # classes of equal sets; the smallest id stands for the class
    digest = ["n_shingles", "digest_a", "digest_b"]
    classes = materialize(filled.groupBy(*digest).agg(F.min("id").alias("low")), "classes")  # so that a large class can be split
    member = filled.join(classes, digest).select("id", "low")
    several = member.groupBy("id").agg(F.min("low").alias("b"), F.max("low").alias("c")).filter("b < c")
    same_id = member.join(several, "id").select(F.col("low").alias("a"), "b")  # an id with several texts
    reps = filled.join(classes.withColumnRenamed("low", "id"), [*digest, "id"], "left_semi").select("id", "n_shingles", "pairs")
    reps = materialize(reps.dropDuplicates(["id", "pairs"]), "class-signatures")

    # postings: pairs that two classes share, without each class's t - 1 most frequent ones
    every = reps.select("id", F.explode("pairs").alias("pair"))
    shared = every.groupBy("pair").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    lists = every.join(shared, "pair").groupBy("id").agg(F.sort_array(F.collect_list(F.struct("n", "pair"))).alias("l"))
    central = F.aggregate("l", F.lit(0).cast("long"), lambda total, p: total + p["n"])
    lists = lists.filter(F.size("l") >= matches).select(
        "id", central.alias("central"), F.size("l").alias("wide"),
        F.explode(F.slice(F.col("l"), F.lit(1), F.size("l") - (matches - 1))).alias("p"))
    postings = materialize(lists.select("id", "central", "wide", F.col("p.pair").alias("pair")), "postings")

    # first merge: every class with a few pivots of each of its lists: the most central ones, which
    # share their pairs with the most others (an original does, its edited copies share fewer), and two by hash
    pivots = postings.groupBy("pair").agg(F.array_distinct(F.array(
        F.max_by("id", F.struct("central", -F.col("id"))), F.max_by("id", F.struct("wide", -F.col("id"))),
        *[F.min_by("id", F.xxhash64(F.col("id"), F.lit(i))) for i in range(HASH_PIVOTS)])).alias("p"))
    met = postings.join(pivots, "pair").select("id", F.explode("p").alias("p")).filter("id != p")
    first = met.select(F.greatest("id", "p").alias("b"), F.least("id", "p").alias("a")).distinct()
    first = materialize(_collisions(first, reps, matches, similarity_percent), "candidates")
    wanted = postings.select("id").distinct()  # classes that share lists with others
    texts = src.filter("id is not null").join(wanted, "id", "left_semi")
    sets = materialize(texts.mapInArrow(_sets(k), "id bigint, shingles binary"), "shingle-sets")
    links = materialize(_linked(first, sets, similarity_percent), "links-1")

    # second merge: pairs of one list whose components still differ
    parts = materialize(components(links), "components-1")
    placed = postings.join(parts.withColumnRenamed("node", "id"), "id", "left").select(
        "id", "pair", F.coalesce("component", "id").alias("part"))
    several_parts = placed.groupBy("pair").agg(F.min("part").alias("p"), F.max("part").alias("q")).filter("p < q")
    mixed = materialize(placed.join(several_parts.select("pair"), "pair", "left_semi").select("id", "part").distinct(), "mixed")
    rare = materialize(_rare_postings(sets, mixed, similarity_percent), "rare-postings")
    tally = rare.groupBy("shingle", "part").agg(F.count(F.lit(1)).alias("n")).groupBy("shingle").agg(
        F.max_by("part", F.struct("n", "part")).alias("most"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    held = rare.join(tally.select("shingle", "most"), "shingle")
    x = held.select("shingle", F.col("id").alias("p"), F.col("part").alias("part_p"), F.col("size").alias("m"), F.col("at").alias("i"))
    y = held.filter("part != most").select(  # any two parts have a member outside the largest
        "shingle", F.col("id").alias("q"), F.col("part").alias("part_q"), F.col("size").alias("n"), F.col("at").alias("j"))
    overlap = F.ceil((F.col("m") + F.col("n")) * similarity_percent / (100 + similarity_percent))
    decides = (F.col("i") <= F.col("m") - overlap) & (F.col("j") <= F.col("n") - overlap)
    rest = x.join(y, (x["shingle"] == y["shingle"]) & (F.col("part_p") != F.col("part_q")) & decides)
    rest = rest.select(F.least("p", "q").alias("a"), F.greatest("p", "q").alias("b")).distinct()
    rest = rest.join(first, ["a", "b"], "left_anti")
    more = _linked(_collisions(rest, reps, matches, similarity_percent), sets, similarity_percent)

    # components of components: few links are left; copies follow their class
    roots = components(more.unionByName(same_id).join(parts.withColumnsRenamed({"node": "a", "component": "part_a"}), "a", "left").join(
        parts.withColumnsRenamed({"node": "b", "component": "part_b"}), "b", "left").select(
        F.coalesce("part_a", "a").alias("a"), F.coalesce("part_b", "b").alias("b")))
    place = member.join(parts.withColumnRenamed("node", "low"), "low", "left").select(
        "id", F.coalesce("component", "low").alias("part")).join(
        roots.withColumnsRenamed({"node": "part", "component": "root"}), "part", "left")
    place = place.groupBy("id").agg(F.min(F.coalesce("root", "part")).alias("component"))
    component = F.coalesce("component", "id")
    out = materialize(signed.select("id", "n_shingles").join(place, "id", "left").select(
        "id", "n_shingles", component.alias("component_id"),
        F.coalesce(component == F.col("id"), F.lit(True)).alias("kept")), "groups")
    release(signed, classes, reps, postings, first, sets, links, parts, mixed, rare)
    return out
