"""Packing documents into token sequences along a space-filling curve.

Neighbours in a sequence should be alike. A document becomes a vector of hashed
word counts, that is projected on a few fixed random directions, and the cell
of the projection on a Hilbert curve is its sort key: documents close on the
curve are close in the projection. Spark range-sorts the documents by the key;
each range task encodes its documents in curve order and lays the ids end to
end into sequences of ``length`` ids, cutting a document only where a sequence
is full. What is left at the end of a range is cut into sequences whose lengths
are powers of two, which need no padding: nothing is padded at all.

Python holds one open sequence and one Arrow batch; a range is a stream.
The documents with their keys are written to the shared folder first, because
the range exchange reads its input twice.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordo.llm.tables import materialize, ship
from ordo.llm.words import TO_LOWER, blocks, mix, word_bounds

LENGTH = 2048            # ids of a full sequence
END = 1                  # id that closes every document
BUCKETS = 256            # hashed word counts of a document
DIMS, BITS = 6, 10       # projected dimensions and bits of each in the key (60 bits)
SEED = 11
CHUNKS_REMEMBERED = 1_200_000  # encodings kept by one Python worker (some 250 MB),
CHUNK_CHARS = 32               # of chunks of at most this many characters
LEARNT_WORDS = 4096            # new words that the library gets in one text
ENCODED_TEXTS = 256          # texts encoded at a time

_SEQUENCES = 1 << 32     # sequences of one range
# a word of Latin letters (to U+024F, but for the one whose small form is two characters), punctuation after it
_WORD = re.compile(r"([A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u024f]+)([.,;:!?]*)")


def projection() -> np.ndarray:
    return np.random.default_rng(SEED).standard_normal((BUCKETS, DIMS))


def word_vectors(offsets: np.ndarray, data: np.ndarray) -> np.ndarray:
    """Unit vectors of signed, dampened hashed counts of words (of their first
    eight bytes, A-Z as small letters); zero without words."""
    data = np.concatenate([TO_LOWER[data], np.zeros(8, np.uint8)])
    starts, ends, row = word_bounds(offsets, data[:-8])
    heads = np.lib.stride_tricks.as_strided(data, (len(data) - 8, 8), (1, 1))[starts].view("<u8").reshape(-1)
    spare = 8 * (8 - np.minimum(ends - starts, 8)).astype(np.uint64)
    h = mix(heads << spare)
    bucket = (h % np.uint64(BUCKETS)).astype(np.int64)
    sign = np.where(h >> np.uint64(63), 1.0, -1.0)
    rows = len(offsets) - 1
    counts = np.bincount(row * BUCKETS + bucket, weights=sign, minlength=rows * BUCKETS).reshape(rows, BUCKETS)
    v = np.sign(counts) * np.log1p(np.abs(counts))
    norm = np.sqrt((v * v).sum(axis=1, keepdims=True))
    return v / np.where(norm > 0, norm, 1)


def cells(vectors: np.ndarray) -> np.ndarray:
    """Cell numbers (0 to 2^BITS - 1) of the projections, which lie around 0 with
    a spread of 1; the logistic curve takes them into the unit cube."""
    unit = 1 / (1 + np.exp(-1.7 * (vectors @ projection())))
    return np.minimum((unit * (1 << BITS)).astype(np.int64), (1 << BITS) - 1)


def hilbert_keys(cell: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Position on the Hilbert curve of every row of cell numbers.

    The axes are turned into the transposed index by undoing, from the highest
    bit down, the reflections and exchanges of axes of each sub-cube, and then
    taking the Gray code off (Skilling, "Programming the Hilbert curve", 2004)."""
    x = cell.T.astype(np.int64).copy()
    dims = len(x)
    for b in range(bits - 1, 0, -1):
        low = (1 << b) - 1
        for i in range(dims):
            reflect = (x[i] >> b) & 1 == 1
            swap = np.where(reflect, 0, (x[0] ^ x[i]) & low)
            x[0] ^= np.where(reflect, low, swap)
            x[i] ^= swap
    for i in range(1, dims):
        x[i] ^= x[i - 1]
    gray = np.zeros_like(x[0])
    for b in range(bits - 1, 0, -1):
        gray ^= np.where((x[-1] >> b) & 1 == 1, (1 << b) - 1, 0)
    x ^= gray
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(dims):
            key = key << 1 | (x[i] >> b) & 1
    return key


def curve_keys(texts: pa.Array) -> np.ndarray:
    keys = [hilbert_keys(cells(word_vectors(offsets, data))) for _, offsets, data in blocks(texts)]
    return np.concatenate(keys) if keys else np.zeros(0, np.int64)


class ChunkEncoder:
    """Ids by the tokenizers library, chunk by chunk.

    The vocabulary's words never hold white space, so a text may be cut at spaces
    and line feeds without changing its ids. Chunks repeat, and their ids are
    remembered. A new chunk of Latin letters is one word, in small letters to the
    normaliser, and punctuation after it is another: such words go to the library
    in one text, and each ends with the token that closes a word. All other chunks
    go to it as they are."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        steps = [s["type"] for s in (spec["normalizer"] or {}).get("normalizers", [])]
        split = next((p for p in (spec["pre_tokenizer"] or {}).get("pretokenizers", []) if p["type"] == "Split"), None)
        # words of letters, of one digit or of other characters but white space; all else is removed
        whole_words = split is not None and split["behavior"] == "Removed" and split["pattern"].get("Regex", "").endswith(
            r"|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
        plain = not any(set(t["content"]) & {" ", "\n"} or t["lstrip"] or t["rstrip"] or t["single_word"] or t["content"].isalpha()
                        for t in spec["added_tokens"])
        suffix = spec["model"].get("end_of_word_suffix")
        self.cut = steps == ["NFC", "Replace", "Lowercase"] and whole_words and plain and bool(suffix)
        vocab = spec["model"]["vocab"]
        self.closes = np.zeros(max(vocab.values()) + 1, bool)
        if self.cut:
            self.closes[[i for t, i in vocab.items() if t.endswith(suffix)]] = True
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        self.coder = Tokenizer.from_file(path)
        self.coder.no_truncation()
        self.coder.no_padding()
        self.known: dict[str, bytes] = {}

    def _ids(self, text: str) -> np.ndarray:
        return np.array(self.coder.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")

    def _words(self, words: list[str]) -> None:
        """Remember words of small Latin letters."""
        for at in range(0, len(words), LEARNT_WORDS):
            some = words[at:at + LEARNT_WORDS]
            ids = self._ids(" ".join(some))
            data, ends = ids.tobytes(), (4 * np.flatnonzero(self.closes[ids]) + 4).tolist()
            self.known.update((w, data[low:high]) for w, low, high in zip(some, [0, *ends[:-1]], ends, strict=True))

    def _learn(self, chunks: list[str]) -> None:
        known, parts, others = self.known, [], []
        for c in chunks:
            word = _WORD.fullmatch(c)
            if word:
                parts.append((c, word[1].lower(), word[2]))
            else:
                others.append(c)
        others += {tail for _, _, tail in parts}.difference(known, others)
        for c, e in zip(others, self.coder.encode_batch_fast(others, add_special_tokens=False)):
            known[c] = np.array(e.ids, "<u4").tobytes()
        self._words(list({word for _, word, _ in parts}.difference(known)))
        known.update([(c, known[word] + known[tail]) for c, word, tail in parts])

    def _encode(self, texts: list[str]) -> Iterator[bytes]:
        if not self.cut:
            yield from (self._ids(t).tobytes() for t in texts)
            return
        if len(self.known) > CHUNKS_REMEMBERED:
            self.known.clear()
        parts = [t.replace("\n", " ").split(" ") for t in texts]
        new = list(set().union(*parts).difference(self.known))
        self._learn(new)
        for p in parts:
            yield b"".join(map(self.known.__getitem__, p))
        for chunk in new:
            if len(chunk) > CHUNK_CHARS:
                del self.known[chunk]

    def encode(self, texts: list[str], closing: bytes = b"") -> Iterator[np.ndarray]:
        """Ids of each text and then those of ``closing`` (32-bit, little-endian).
        Vocabularies of another kind are encoded as whole texts."""
        for at in range(0, len(texts), ENCODED_TEXTS):
            some = texts[at:at + ENCODED_TEXTS]
            once = list(dict.fromkeys(some))  # copies lie side by side on the curve
            found = {t: ids + closing for t, ids in zip(once, self._encode(once), strict=True)}
            for t in some:
                yield np.frombuffer(found[t], "<u4")


_loaded: dict[str, ChunkEncoder] = {}


def encoder(path: str) -> ChunkEncoder:
    if path not in _loaded:
        _loaded[path] = ChunkEncoder(path)
    return _loaded[path]


class OpenSequences:
    """Lays documents end to end. ``add`` and ``close`` return finished pieces
    (document, start, ids, ids of the document, sequence, offset)."""

    def __init__(self, length: int):
        self.length, self.sequence, self.filled = length, 0, 0
        self.open: list[tuple] = []

    def add(self, document, ids: np.ndarray) -> list[tuple]:
        done, start = [], 0
        while start < len(ids):
            part = ids[start:start + self.length - self.filled]
            self.open.append((document, start, part, len(ids), self.sequence, self.filled))
            start += len(part)
            self.filled += len(part)
            if self.filled == self.length:
                done += self.open
                self.open, self.filled, self.sequence = [], 0, self.sequence + 1
        return done

    def close(self) -> list[tuple]:
        """The last ids, in sequences of falling powers of two."""
        ends, at = [], 0
        for bit in reversed(range(self.filled.bit_length())):
            if self.filled >> bit & 1:
                ends.append((at, at + (1 << bit)))
                at += 1 << bit
        done = []
        for document, start, part, total, sequence, offset in self.open:
            for i, (low, high) in enumerate(ends):
                a, b = max(low, offset), min(high, offset + len(part))
                if a < b:
                    done.append((document, start + a - offset, part[a - offset:b - offset], total, sequence + i, a - low))
        self.open, self.filled, self.sequence = [], 0, self.sequence + len(ends)
        return done


def pack_documents(docs: DataFrame, path: str, id_col: str = "doc_id", text: str = "text", length: int = LENGTH,
                   end: int = END, with_ids: bool = False) -> DataFrame:
    """One row per piece of a document in a sequence: ``id, start`` (ids of the
    document before the piece), ``length, ids_crc32, doc_tokens, sequence_id,
    offset`` (ids of the sequence before it) and, ``with_ids``, the ``ids``.

    Every id of every row lies in exactly one piece. A null text is empty: its only
    id is ``end``, like that of an empty text. Very long texts run through as many
    sequences as they fill. Null and repeated ids need no care: rows are
    packed, not ids; rows that agree in everything may stand in either order. Other
    columns of ``docs``, whatever their names, are left out. An empty table gives no
    rows. Sequence numbers are unique, but which they are depends on the sampled
    range bounds. ``path`` must name the vocabulary file on every executor."""
    src = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    kind = src.schema["id"].dataType

    key = F.arrow_udf(lambda t: pa.array(curve_keys(t)), "bigint")
    ranged = materialize(ship(src).select("*", key("text").alias("key")), "packing")
    salt = F.shiftright(F.monotonically_increasing_id(), 10)  # of the written table; cuts equal rows apart
    order = ["key", "id", "hash"]
    ranged = ranged.select("*", F.xxhash64("text").alias("hash"), salt.alias("salt"))
    ranged = ranged.repartitionByRange(*order, "salt").sortWithinPartitions(*order)

    fields = [("start", "bigint", pa.int64()), ("length", "bigint", pa.int64()), ("ids_crc32", "bigint", pa.int64()),
              ("doc_tokens", "bigint", pa.int64()), ("sequence_id", "bigint", pa.int64()), ("offset", "bigint", pa.int64())]

    def rows(pieces: list[tuple], part: int, id_type: pa.DataType) -> pa.RecordBatch:
        document, start, ids, total, sequence, offset = zip(*pieces)
        columns = [pa.array(document, id_type), pa.array(start, pa.int64()), pa.array([len(i) for i in ids], pa.int64()),
                   pa.array([zlib.crc32(i) for i in ids], pa.int64()), pa.array(total, pa.int64()),
                   pa.array([part * _SEQUENCES + s for s in sequence], pa.int64()), pa.array(offset, pa.int64())]
        names = ["id", *(f[0] for f in fields)]
        if with_ids:
            columns.append(pa.array([i.astype(np.int64) for i in ids], pa.list_(pa.int64())))
            names.append("ids")
        return pa.RecordBatch.from_arrays(columns, names)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, laid, closing = encoder(path), OpenSequences(length), np.array([end], "<u4").tobytes()
        part, id_type = 0, pa.null()
        for batch in batches:
            if not batch.num_rows:
                continue
            part, id_type = batch.column(2)[0].as_py(), batch.column(0).type
            for at in range(0, batch.num_rows, ENCODED_TEXTS):
                some = batch.slice(at, ENCODED_TEXTS)
                pieces = []
                for document, ids in zip(some.column(0).to_pylist(), coder.encode(some.column(1).to_pylist(), closing)):
                    pieces += laid.add(document, ids)
                if pieces:
                    yield rows(pieces, part, id_type)
        if last := laid.close():
            yield rows(last, part, id_type)

    schema = ", ".join([f"id {kind.simpleString()}", *(f"{n} {t}" for n, t, _ in fields), *(["ids array<bigint>"] if with_ids else [])])
    return ranged.select("id", "text", F.spark_partition_id().alias("part")).mapInArrow(pack, schema)
