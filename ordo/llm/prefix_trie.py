"""The trie of conversation prefixes, from double arrays.

A node is a distinct sequence of first turns; conversations that agree so far
share it. Conversations are rebuilt first (some of their opening turns come from
the first conversation of their block of 20), and equal ones become one class
with a count. A prefix with more than SHARD_TURNS turns of classes below it is an
upper node; below the upper nodes the trie falls apart into shards of bounded
size. A task packs a bin of shards into one double array: turns get dense
numbers, a node's children stand at BASE[node] + number, and CHECK holds the
parent of a slot. Following the arrays gives every class its nodes, and a pass
from the deepest nodes up sums the subtrees. Upper nodes are merged globally:
members by one aggregate; sums of subtrees by adding, for each class, what the
nodes it owns (as their smallest member) hold from each depth on.

Turns are known by SHA-256 and prefixes by a 128-bit chain of these, so equal
keys mean equal turns. A conversation is streamed by one task in constant
memory; a class of any size costs one row per 4,096 ids.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ordo.llm.tables import materialize, release, ship

BLOCK = 20              # conversations that may share the opening of the first of them
HEADS = 4               # a conversation takes crc32(id) % HEADS turns of it
SHARD_TURNS = 20_000    # turns of distinct conversations in a shard, at most, and in a bin, on average
TRIES = 64              # places tried for a node's children before they go to the end
CHUNK_BITS = 12         # ids of a class are joined in ranges of 2^CHUNK_BITS

ROOT = bytes(16)
EMPTY = hashlib.sha256(b"").hexdigest()
_WORDS = r"[^\x20\x09-\x0D]+"


# ------------------------------------------------------------- double arrays

class DoubleArray:
    """BASE and CHECK over dense child numbers. Slot 0 is the root."""

    def __init__(self, room: int = 1024):
        self.base = np.zeros(room, np.int64)
        self.check = np.full(room, -1, np.int64)   # parent; -1: free
        self.check[0] = 0
        self.free, self.end = 1, 1                 # first slot that may be free; all from ``end`` on are

    def _room(self, last: int) -> None:
        if last >= len(self.check):
            more = max(last + 1, 2 * len(self.check))
            self.base = np.concatenate([self.base, np.zeros(more - len(self.base), np.int64)])
            self.check = np.concatenate([self.check, np.full(more - len(self.check), -1, np.int64)])

    def add(self, node: int, numbers: np.ndarray) -> None:
        """Give ``node`` its children (ascending numbers, all at once)."""
        first, span = int(numbers[0]), int(numbers[-1] - numbers[0])
        self._room(self.end + span)
        while self.check[self.free] >= 0:
            self.free += 1
        at = self.free
        if len(numbers) > 1:
            for _ in range(TRIES):
                if at >= self.end or (self.check[at - first + numbers] < 0).all():
                    break
                at += 1
                while at < self.end and self.check[at] >= 0:
                    at += 1
            else:
                at = self.end
            self._room(at + span)
        self.base[node] = at - first     # may be negative: the slots are not
        self.check[at - first + numbers] = node
        self.end = max(self.end, at + span + 1)

    def follow(self, nodes: np.ndarray, numbers: np.ndarray) -> np.ndarray:
        """The children of ``nodes`` by ``numbers``; -1 where there is none."""
        slot = self.base[nodes] + numbers
        inside = (slot > 0) & (slot < len(self.check))
        return np.where(inside & (self.check[np.where(inside, slot, 0)] == nodes), slot, -1)


def packed_paths(starts: np.ndarray, lengths: np.ndarray, numbers: np.ndarray) -> tuple[DoubleArray, np.ndarray]:
    """The double array of all paths (path ``i`` is ``numbers[starts[i]:][:lengths[i]]``),
    built level by level, and the slot of every path element."""
    trie, slots = DoubleArray(), np.zeros(len(numbers), np.int64)
    state = np.zeros(len(starts), np.int64)
    active = np.argsort(-lengths, kind="stable")
    many, level = int(numbers.max()) + 1, 0
    while len(active := active[:np.searchsorted(-lengths[active], -level, side="left")]):
        at, now = starts[active] + level, state[active]
        parents, children = np.divmod(np.unique(now * many + numbers[at]), many)
        cuts = np.flatnonzero(np.r_[True, np.diff(parents) != 0])
        for low, high in zip(cuts, np.r_[cuts[1:], len(parents)]):
            trie.add(int(parents[low]), children[low:high])
        state[active] = slots[at] = trie.follow(now, numbers[at])
        level += 1
    return trie, slots


_NODE = [("conv_id", "bigint", pa.int64()), ("depth", "bigint", pa.int64()), ("parent_conv_id", "bigint", pa.int64()),
         ("parent_key", "binary", pa.binary()), ("n_convs", "bigint", pa.int64()), ("n_children", "bigint", pa.int64()),
         ("n_leaves", "bigint", pa.int64()), ("saved_tokens", "bigint", pa.int64()), ("ends_sha256", "string", pa.string())]
_NODE_DDL = ", ".join(f"{n} {t}" for n, t, _ in _NODE)


def bin_nodes(rows: pa.Table) -> pa.Table:
    """All nodes of one bin of shards. ``rows``: one per turn of a class, ``root``
    (key of the shard), ``c, d, sha, words, n``, ``ends`` at its last turn and
    ``parent`` at its first one here."""
    rows = rows.sort_by([("c", "ascending"), ("d", "ascending")])
    c, d, n, words = (rows[x].to_numpy() for x in ("c", "d", "n", "words"))
    first = np.r_[True, c[1:] != c[:-1]]
    starts = np.flatnonzero(first)
    lengths = np.diff(np.r_[starts, len(c)])
    root = pc.dictionary_encode(rows["root"].combine_chunks()).indices.to_numpy() + 1
    turn = pc.dictionary_encode(rows["sha"].combine_chunks()).indices.to_numpy() + 1
    trie, slots = packed_paths(starts, lengths, np.where(first, root, root.max() + turn).astype(np.int64))

    size = len(trie.check)
    conv = np.full(size, np.iinfo(np.int64).max)
    np.minimum.at(conv, slots, c)
    members, depth, own = (np.zeros(size, np.int64) for _ in range(3))
    np.add.at(members, slots, n)
    depth[slots], own[slots] = d, words
    nodes = np.unique(slots)
    parent = trie.check
    children = np.bincount(parent[nodes], minlength=size)
    saved, leaves = (members - 1) * own, np.zeros(size, np.int64)
    leaves[nodes] = children[nodes] == 0
    below = nodes[np.argsort(-depth[nodes], kind="stable")]
    for level in np.split(below, np.flatnonzero(np.diff(depth[below])) + 1):  # deepest first
        inner = level[parent[level] > 0]
        np.add.at(saved, parent[inner], saved[inner])
        np.add.at(leaves, parent[inner], leaves[inner])
    last = np.r_[starts[1:], len(c)] - 1
    ends = dict(zip(slots[last].tolist(), rows["ends"].take(pa.array(last)).to_pylist()))
    above = dict(zip(slots[starts].tolist(), rows["parent"].take(pa.array(starts)).to_pylist()))
    top = parent[nodes] == 0
    names = nodes.tolist()
    columns = [conv[nodes], depth[nodes], pa.array(conv[parent[nodes]], pa.int64(), mask=top),
               [above[x] if t else None for x, t in zip(names, top)], members[nodes], children[nodes], leaves[nodes],
               saved[nodes], [ends.get(x, EMPTY) for x in names]]
    return pa.table([pa.array(x, t) for x, (_, _, t) in zip(columns, _NODE)], [x[0] for x in _NODE])


# ------------------------------------------------------------- streams

def _chain(batches):
    """Rows ordered by (c, d): the key of every prefix and of the one before it."""
    conv, key = None, ROOT
    for batch in batches:
        keys, parents = [], []
        for c, sha in zip(batch.column(0).to_pylist(), batch.column(3).to_pylist()):
            if c != conv:
                conv, key = c, ROOT
            parents.append(key)
            key = hashlib.blake2b(key + sha, digest_size=16).digest()
            keys.append(key)
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(keys, pa.binary()), pa.array(parents, pa.binary())],
                                         [*batch.schema.names, "key", "parent"])


_CLASS_NAMES = ["key", "len", "c", "n", "ends"]


def _class_digests(batches):
    """Rows ordered by (key, chunk) of ids joined by commas: one row per key, its
    smallest id, its number of ids and the digest of all of them."""
    held = None  # key, len, first id, count, hash

    def row(x):
        return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(
            (*x[:4], x[4].hexdigest()), (pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.string()))], _CLASS_NAMES)

    for batch in batches:
        done = []
        for key, length, low, n, ids in zip(*(col.to_pylist() for col in batch.columns)):
            if held is not None and held[0] == key:
                held[4].update(b",")
                held[3] += n
            else:
                if held is not None:
                    done.append(row(held))
                held = [key, length, low, n, hashlib.sha256()]
            held[4].update(ids.encode())
        if done:
            yield pa.Table.from_batches(done).combine_chunks().to_batches()[0]
    if held is not None:
        yield row(held)


# ------------------------------------------------------------- tables

def _turns(conversations: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """``c, pos, sha, words``: turns in order, positions from 1."""
    r, t = (F.coalesce(F.col(x).cast("string"), F.lit("")) for x in (role, text))
    sha = F.unhex(F.sha2(F.concat(F.octet_length(r).cast("string"), F.lit(":"), r, t), 256))
    rows = conversations.filter(F.col(conv).isNotNull()).select(
        F.col(conv).cast("bigint").alias("c"), F.col(turn).alias("turn"), sha.alias("sha"),
        F.regexp_count(t, F.lit(_WORDS)).cast("bigint").alias("words"))
    order = Window.partitionBy("c").orderBy(F.asc_nulls_first("turn"), "sha")
    return rows.select("c", F.row_number().over(order).cast("bigint").alias("pos"), "sha", "words")


def _rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``c, d, len, sha, words`` of the rebuilt conversations, and ``c, len`` of all."""
    heads = turns.filter((F.col("c") % BLOCK == 0) & (F.col("pos") < HEADS)).groupBy(F.col("c").alias("b")).agg(
        F.array_sort(F.collect_list(F.struct("pos", "sha", "words"))).alias("head"))  # fewer than HEADS turns
    convs = turns.groupBy("c").agg(F.count(F.lit(1)).alias("n")).withColumn("b", F.col("c") - F.col("c") % BLOCK)
    h = (F.crc32(F.col("c").cast("string").cast("binary")) % HEADS).cast("int")
    convs = convs.join(heads, "b", "left").select("c", "n", h.alias("h"), F.coalesce(F.slice("head", 1, h), F.array().cast(
        "array<struct<pos:bigint,sha:binary,words:bigint>>")).alias("head"))
    convs = convs.select("*", (F.size("head") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).cast("bigint").alias("len"))
    convs = materialize(convs, "trie-convs")
    own = turns.join(convs.select("c", "h", F.size("head").alias("given"), "len"), "c").filter("pos > h").select(
        "c", (F.col("given") + F.col("pos") - F.col("h")).alias("d"), "len", "sha", "words")
    given = convs.select("c", "len", F.posexplode("head").alias("at", "x")).select(
        "c", (F.col("at") + 1).cast("bigint").alias("d"), "len", "x.sha", "x.words")
    return own.unionByName(given), convs


def _classes(members: DataFrame) -> DataFrame:
    """``key, len, c`` (smallest id), ``n, ends`` of equal conversations, from
    ``key, len, c`` of all."""
    parts = members.groupBy("key", "len", F.shiftright("c", CHUNK_BITS).alias("chunk")).agg(
        F.array_sort(F.collect_list("c")).alias("ids"))  # at most 2^CHUNK_BITS
    parts = parts.repartition("key").sortWithinPartitions("key", "chunk").select(
        "key", "len", F.col("ids")[0].alias("low"), F.size("ids").cast("bigint").alias("n"),
        F.array_join(F.transform("ids", lambda x: x.cast("string")), ",").alias("ids"))
    return parts.mapInArrow(_class_digests, "key binary, len bigint, c bigint, n bigint, ends string")


def prefix_trie(conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
                text: str = "text", shard_turns: int = SHARD_TURNS) -> DataFrame:
    """One row per node: ``conv_id`` (smallest member), ``depth, parent_conv_id``
    (null at the root), ``n_convs, n_children, n_leaves, saved_tokens, ends_sha256``.

    Turns follow ``turn``, null first; turns of one conversation with equal
    ``turn`` follow the SHA-256 of role and text, and repeated rows are turns of
    their own. A null role or text is empty. Rows without a conversation id belong to no
    conversation. Texts of any length count by their digest and their words.
    Other columns are not read. An empty table gives no rows."""
    turns = materialize(_turns(ship(conversations), conv, turn, role, text), "trie-turns")
    rebuilt, convs = _rebuilt(turns)
    rebuilt = rebuilt.select("c", "d", "len", "sha", "words").repartition("c").sortWithinPartitions("c", "d")
    paths = materialize(rebuilt.mapInArrow(
        _chain, "c bigint, d bigint, len bigint, sha binary, words bigint, key binary, parent binary"), "trie-paths")
    release(turns)
    root_key = F.lit(ROOT)
    members = paths.filter("d = len").select("key", "len", "c").unionByName(
        convs.filter("len = 0").select(root_key.alias("key"), "len", "c"))
    classes = materialize(_classes(members), "trie-classes")
    distinct = materialize(paths.join(classes.select("c", "n", "ends"), "c").withColumn(
        "ends", F.when(F.col("d") == F.col("len"), F.col("ends"))), "trie-distinct")
    release(paths)

    # prefixes with too much below them; the part of a class above its first other prefix is short of them
    heavy = materialize(distinct.groupBy("key").agg(F.sum(F.col("len") - F.col("d") + 1).alias("turns")).filter(
        F.col("turns") > shard_turns).select("key", F.lit(True).alias("heavy")), "trie-heavy")
    whole = Window.partitionBy("c")
    marked = distinct.join(heavy, "key", "left").withColumn("upper", F.coalesce(F.sum(F.col("heavy").cast("int")).over(whole), F.lit(0)))
    lower = marked.filter(F.col("d") > F.col("upper"))
    shard = F.max(F.when(F.col("d") == F.col("upper") + 1, F.col("key"))).over(whole)
    bins = max(1, -(-distinct.count() // shard_turns))
    lower = lower.withColumn("root", shard).withColumn("bin", F.pmod(F.xxhash64("root"), F.lit(bins)))
    nodes = materialize(lower.select("bin", "root", "c", "d", "sha", "words", "n", "ends", "parent").groupBy("bin").applyInArrow(
        bin_nodes, _NODE_DDL), "trie-nodes")

    out = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    upper = materialize(distinct.join(heavy, "key", "left_semi").select("c", "d", "key", "parent", "words", "n", "ends"), "trie-upper")
    release(distinct, heavy)
    tops = nodes.filter(F.col("parent_key").isNotNull()).select("conv_id", "depth", "parent_key", "n_leaves", "saved_tokens")
    merged = upper.groupBy("key").agg(
        F.min("c").alias("conv_id"), F.max("d").alias("depth"), F.max("parent").alias("parent_key"),
        F.sum("n").alias("n_convs"), F.max("words").alias("words"), F.max("ends").alias("ends"))
    merged = materialize(merged.withColumn("own", (F.col("n_convs") - 1) * F.col("words")), "trie-merged")

    # per class, the sums of what it owns from each depth on; a node's subtree is owned by its members
    held = upper.join(merged.select("key", "conv_id", "own"), "key").select(
        "c", "d", "key", F.when(F.col("c") == F.col("conv_id"), F.col("own")).otherwise(0).alias("saved"), F.lit(0).cast("bigint").alias("leaves"))
    held = held.unionByName(tops.select(F.col("conv_id").alias("c"), F.col("depth").alias("d"), F.lit(None).cast("binary").alias("key"),
                                        F.col("saved_tokens").alias("saved"), F.col("n_leaves").alias("leaves")))
    deeper = Window.partitionBy("c").orderBy(F.desc("d")).rowsBetween(Window.unboundedPreceding, 0)
    sums = held.select("key", F.sum("saved").over(deeper).alias("saved"), F.sum("leaves").over(deeper).alias("leaves")).filter(
        F.col("key").isNotNull()).groupBy("key").agg(F.sum("saved").alias("saved_tokens"), F.sum("leaves").alias("n_leaves"))

    children = tops.select(F.col("parent_key").alias("key")).unionByName(merged.select(F.col("parent_key").alias("key"))).groupBy(
        "key").agg(F.count(F.lit(1)).alias("n_children"))
    total = lambda df, saved, leaves: df.agg(F.sum(saved).alias("s"), F.sum(leaves).alias("l"))
    below = total(tops.select(F.col("saved_tokens").alias("s"), F.col("n_leaves").alias("l")).unionByName(
        merged.select(F.col("own").alias("s"), F.lit(0).cast("bigint").alias("l"))), "s", "l")
    ends_here = classes.filter(F.col("key") == root_key).select(F.col("ends").alias("e")).agg(F.max("e").alias("e"))
    depth_1 = children.filter(F.col("key") == root_key).agg(F.coalesce(F.max("n_children"), F.lit(0)).cast("bigint").alias("n_children"))
    root = convs.agg(F.min("c").alias("conv_id"), F.count(F.lit(1)).alias("n_convs")).filter("n_convs > 0")
    root = root.join(below).join(ends_here).join(depth_1).select(  # tables of one row
        "conv_id", F.lit(0).cast("bigint").alias("depth"), F.lit(None).cast("bigint").alias("parent_conv_id"), "n_convs",
        "n_children", F.when(F.col("n_children") == 0, F.lit(1).cast("bigint")).otherwise(F.col("l")).alias("n_leaves"),
        F.coalesce("s", F.lit(0).cast("bigint")).alias("saved_tokens"), F.coalesce("e", F.lit(EMPTY)).alias("ends_sha256"))

    above = merged.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("above")).unionByName(
        root.select(root_key.alias("parent_key"), F.col("conv_id").alias("above")))
    uppers = merged.join(sums, "key").join(children, "key").join(above, "parent_key").select(
        "conv_id", "depth", F.col("above").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends", F.lit(EMPTY)).alias("ends_sha256"))
    lowers = nodes.join(above, "parent_key", "left").withColumn("parent_conv_id", F.coalesce("parent_conv_id", "above"))
    return root.select(*out).unionByName(uppers.select(*out)).unionByName(lowers.select(*out))
