"""Exact removal of repeated 200-byte strings by bucket refinement.

A full suffix array of the corpus would move every suffix of every text. Here
only the depth that matters (200 bytes) is sorted out, and only for the
suffixes that can still be in a bucket with others:

Bucket identifiers. The suffixes of a text start in buckets by their first
q = 25 bytes. A bucket of depth 2h is named by the bucket of depth h at the
position and the one at the offset h further on, so the identifiers of 25 give
those of 50, these those of 100 and these those of 200; every round reuses the
identifiers of the round before. Identifiers are 64-bit hashes of what they
name, so texts need no common numbering.

Refinement. Every 200-byte window has one anchor, its least q-gram (the
leftmost of equals), and equal windows have the same anchor at the same place.
  level 0  anchors are sorted into buckets by q-gram; a bucket of one is done;
  level 1  the windows of one anchor start in one run of positions. A run is
           named by the identifiers of its first and last window, which cover
           it; runs that occur twice are repeated as a whole;
  level 2  what is left, with one representative of each repeated run of its
           bucket, is cut into cells of 16 windows, sorted into buckets by the
           185 bytes that all windows of a cell share; cells that occur twice
           are repeated as a whole, a bucket of one is done;
  level 3  the windows of what is left again, by the bytes they add.
Each level is a Spark grouping with map-side counts, so the bucket of a string
on a third of all documents costs one row per map task. The rows shrink from
about one per 88 bytes at level 0 to the surroundings of edits at level 3.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordo.llm.tables import materialize, release, ship
from ordo.llm.words import BYTE_VALUE, _power_tables, blocks, mix, text_buffers

LENGTH = 200                 # a string this long that starts twice is removed
GRAM = LENGTH // 8           # q: depth of the initial buckets
CELL = 16                    # windows of a cell
SHARED = LENGTH - CELL + 1   # bytes that all windows of a cell share
BLOCK = 1 << 18              # bytes handled at once: keeps the arrays in cache
_C = np.uint64(0xD1B54A32D192ED03)


def _pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Identifier of the concatenation from those of its halves."""
    return mix(a * _C + b)


def gram_buckets(data: np.ndarray) -> np.ndarray:
    """Identifier of depth GRAM for every position that has one."""
    n = len(data) - GRAM + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    power, inverse = _power_tables(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(BYTE_VALUE[data] * power[:-1], out=sums[1:])
    return mix((sums[GRAM:] - sums[:n]) * inverse[:n])


def refine(ids: np.ndarray, depth: int) -> np.ndarray:
    """Identifiers of depth 2 x ``depth`` from those of ``depth``."""
    return _pair(ids[:-depth], ids[depth:]) if len(ids) > depth else np.zeros(0, np.uint64)


def window_buckets(grams: np.ndarray) -> np.ndarray:
    ids, depth = grams, GRAM
    while depth < LENGTH:
        ids, depth = refine(ids, depth), 2 * depth
    return ids


def anchors(grams: np.ndarray) -> np.ndarray:
    """Position of the least q-gram of every window (leftmost of equals)."""
    w = LENGTH - GRAM + 1
    n = len(grams) - w + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    key = (grams & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(grams), dtype=np.uint64)
    padded = np.full(-(-len(key) // w) * w, np.uint64(0xFFFFFFFFFFFFFFFF))
    padded[:len(key)] = key
    rows = padded.reshape(-1, w)
    ahead = np.minimum.accumulate(rows, axis=1).ravel()
    back = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return (np.minimum(back[:n], ahead[w - 1:w - 1 + n]) & np.uint64(0xFFFFFFFF)).astype(np.int64)


def window_runs(offsets: np.ndarray, data: np.ndarray) -> dict[str, np.ndarray]:
    """The runs of windows of one block: row, anchor ``x``, ``first`` and
    ``last`` window (positions in the row), level-0 ``bucket`` and run ``name``."""
    grams = gram_buckets(data)
    at = anchors(grams)
    ids = window_buckets(grams)
    start = np.arange(len(at))
    row = np.searchsorted(offsets, start, side="right") - 1
    inside = start + LENGTH <= offsets[np.minimum(row + 1, len(offsets) - 1)]
    start, at, row = start[inside], at[inside], row[inside]
    new = np.ones(len(start), bool)
    new[1:] = (at[1:] != at[:-1]) | (row[1:] != row[:-1])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(start)) - 1 if len(first) else first
    a, b, x, r = start[first], start[last], at[first], row[first]
    span = (b - a).astype(np.uint64)
    return {"row": r, "x": x - offsets[r], "first": a - offsets[r], "last": b - offsets[r],
            "bucket": grams[x], "name": _pair(_pair(ids[a], ids[b]), span + ((x - a).astype(np.uint64) << np.uint64(32)))}


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        k1, k2 = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
        for at, offsets, data in blocks(batch.column(2), BLOCK):
            r = window_runs(offsets, data)
            rows = r["row"] + at
            yield pa.RecordBatch.from_arrays(
                [pa.array(k1[rows]), pa.array(k2[rows]), *(pa.array(r[c].astype(np.int32)) for c in ("x", "first", "last")),
                 pa.array(r["bucket"].view(np.int64)), pa.array(r["name"].view(np.int64))],
                ["k1", "k2", "x", "first", "last", "bucket", "name"])


def _cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each text with its open runs: their cells. Windows ``start`` to
    ``last`` of a cell share the bytes from ``p`` on, named ``shared``, and differ
    in how many of the up to 15 bytes before (``left``) and after (``right``)
    they add."""
    names = ["k1", "k2", "shared", "start", "last", "p", "left", "right"]
    for batch in batches:
        for i in range(batch.num_rows):
            _, data = text_buffers(batch.column(2).slice(i, 1))
            hundred = refine(refine(gram_buckets(data), GRAM), 2 * GRAM)
            runs = batch.column(3)[i].values
            x, first, last = (runs.field(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in range(3))
            low, high = (x - last) // CELL, (x - first) // CELL
            many = high - low + 1
            of = np.repeat(np.arange(len(x)), many)
            cell = np.arange(len(of)) - np.repeat(np.cumsum(many) - many, many) + low[of]
            p = x[of] - cell * CELL
            a, b = np.maximum(first[of], p - CELL + 1), np.minimum(last[of], p)
            e = p + SHARED
            raw = data.tobytes()
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(p), batch.column(0)[i].as_py(), np.int64)),
                 pa.array(np.full(len(p), batch.column(1)[i].as_py(), np.int64)),
                 pa.array(_pair(hundred[p], hundred[e - 4 * GRAM]).view(np.int64)),
                 *(pa.array(v.astype(np.int32)) for v in (a, b, p)),
                 pa.array([raw[s:t] for s, t in zip(a.tolist(), p.tolist())], pa.binary()),
                 pa.array([raw[s:t + LENGTH] for s, t in zip(e.tolist(), b.tolist())], pa.binary())], names)


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts and their spans to texts without them."""
    for batch in batches:
        for i in range(batch.num_rows):
            _, data = text_buffers(batch.column(1).slice(i, 1))
            gone = np.zeros(len(data) + 1, np.int32)
            spans = batch.column(2)[i].values
            if spans is not None and len(spans):
                np.add.at(gone, spans.field(0).to_numpy(), 1)
                np.add.at(gone, spans.field(1).to_numpy(), -1)
            out = np.cumsum(gone)[:-1] > 0
            edge = np.flatnonzero(np.diff(np.concatenate([[False], out, [False]]).astype(np.int8)))
            runs = [{"start": int(a), "end": int(b)} for a, b in zip(edge[::2], edge[1::2])]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(i, 1), pa.array([len(data)], pa.int64()), pa.array([runs], _SPANS),
                 pa.array([data[~out].tobytes()], pa.binary())], ["id", "n_bytes", "removed", "kept"])


_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def _sort_out(rows: DataFrame, bucket: str, columns: list[str]) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(table of names, rows that occur twice as a whole, one representative of
    each name in the buckets where some other name occurs once)."""
    named = materialize(rows.groupBy(bucket, "name").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct(*columns)).alias("r")), "names")
    whole = rows.join(named.filter("n > 1").select(bucket, "name"), [bucket, "name"], "left_semi")
    mixed = named.groupBy(bucket).agg(F.count(F.lit(1)).alias("m"), F.min("n").alias("n")).filter("m > 1 and n = 1")
    mixed = materialize(mixed.select(bucket), "mixed-buckets")  # as at level 0: a hot bucket can be split
    return named, whole, named.join(mixed, bucket, "left_semi").select(bucket, "r.*")


def repeated_spans(texts: DataFrame) -> DataFrame:
    """``k1, k2, spans`` (array of start, end in bytes, overlapping) for the
    texts (``k1, k2, text``) that have repeated strings."""
    runs = materialize(ship(texts).mapInArrow(
        _runs, "k1 bigint, k2 bigint, x int, first int, last int, bucket bigint, name bigint"), "runs")
    # level 0
    shared = runs.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("bucket")
    shared = materialize(shared, "buckets")  # the join below then shuffles both sides and can split a hot bucket
    live = materialize(runs.join(shared, "bucket", "left_semi"), "live-runs")
    release(runs, shared)
    # level 1
    names, whole, opened = _sort_out(live, "bucket", ["k1", "k2", "x", "first", "last"])
    end = (F.col("last") + LENGTH).alias("end")
    done = materialize(whole.select("k1", "k2", F.col("first").alias("start"), end), "whole-runs")
    release(live)
    # level 2
    lists = opened.groupBy("k1", "k2").agg(F.collect_list(F.struct("x", "first", "last")).alias("runs"))
    cells = texts.join(lists, ["k1", "k2"]).select("k1", "k2", "text", "runs").mapInArrow(
        _cells, "k1 bigint, k2 bigint, shared bigint, start int, last int, p int, left binary, right binary")
    sides = F.xxhash64("left", "right", F.col("p") - F.col("start"), F.col("last") - F.col("p"))
    cells = materialize(cells.withColumn("name", sides), "cells")
    release(names)
    names, whole, opened = _sort_out(cells, "shared", ["k1", "k2", "start", "last", "p", "left", "right"])
    more = materialize(whole.select("k1", "k2", "start", end), "whole-cells")
    release(cells)
    # level 3: a window is the shared bytes, the last i on the left and the first 15 - i on the right
    windows = opened.select("*", F.explode(F.sequence(F.col("p") - F.col("last"), F.col("p") - F.col("start"))).alias("i"))
    window = F.expr(f"xxhash64(i, substring(left, length(left) - i + 1, i), substring(right, 1, {CELL - 1} - i))")
    windows = materialize(windows.select("k1", "k2", (F.col("p") - F.col("i")).alias("start"), "shared",
                                         window.alias("window")), "windows")
    release(names)
    twice = windows.groupBy("shared", "window").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    single = windows.join(twice.select("shared", "window"), ["shared", "window"], "left_semi").select(
        "k1", "k2", "start", (F.col("start") + LENGTH).alias("end"))
    # rows that share a key are one text, whose spans count once
    found = done.unionByName(more).unionByName(single).distinct()
    spans = materialize(found.groupBy("k1", "k2").agg(F.collect_list(F.struct("start", "end")).alias("spans")), "spans")
    release(done, more, windows)
    return spans


def dedup_substrings(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """``id, n_bytes, removed`` (maximal spans of removed bytes) and ``kept``
    (the remaining bytes) for every row of ``docs``.

    A byte goes if a 200-byte string over it starts anywhere else in the input,
    in the same text too; strings are judged on the input. Nothing crosses
    texts. A null text is empty. Repeated rows are copies of each other (all of
    200 bytes and more goes); null ids are allowed, an empty table gives no rows. Texts
    of any length are taken whole, each by one task. ``id_col`` holds whole numbers;
    other columns are not read."""
    # a text is known by its id and hash; rows that agree in both are copies
    keys = [F.coalesce(F.col(id_col).cast("bigint"), F.lit(-1)).alias("k1"),
            F.coalesce(F.xxhash64(F.col(text)), F.lit(0)).alias("k2")]
    texts = docs.select(*keys, F.col(text).cast("string").alias("text"))
    spans = repeated_spans(texts.filter(F.octet_length("text") >= LENGTH))
    rows = docs.select(F.col(id_col).alias("id"), F.col(text).cast("string").alias("text"), *keys)
    kind = rows.schema["id"].dataType.simpleString()
    none = F.array().cast("array<struct<start:int,end:int>>")
    return rows.join(spans, ["k1", "k2"], "left").select("id", "text", F.coalesce("spans", none).alias("spans")).mapInArrow(
        _cut, f"id {kind}, n_bytes bigint, removed array<struct<start:bigint,end:bigint>>, kept binary")
