"""Quality classifier by attention-based multiple-instance learning.

A document is a bag of passages (runs of PASSAGE_WORDS words) and carries one
label. Every passage of the whole text is encoded; a gated attention unit
(Ilse et al., "Attention-based Deep Multiple Instance Learning", 2018) learns
from the document labels how much each passage matters, and the document's
score is read off the weighted mean of its passage representations:

    h_k = tanh(E x_k + e)           a_k = softmax_k(w . (tanh(V h_k) * sigmoid(U h_k)))
    score = sigmoid(c . sum_k a_k h_k + d)

The model is fitted by the driver on a bounded sample of labelled documents
(``fit_rows`` documents of at most ``fit_bytes`` bytes; the bounds are
parameters) whose passages Spark encodes. All documents are scored by Spark.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf
from pyspark.sql.types import BinaryType, DoubleType

from ordo.llm.tables import ship
from ordo.llm.words import IS_SPACE, blocks, mix, span_hashes, window_hashes, word_bounds

PASSAGE_WORDS = 64
BUCKETS = 256          # hashed words of a passage
STYLE = 12             # measures of its form
HIDDEN = 32
ATTENTION = 16
FIT_ROWS = 2500        # labelled documents the model is fitted on, at most
FIT_BYTES = 32768      # bytes of a document in that sample, at most
EPOCHS, BATCH, RATE = 40, 64, 0.01
HELD_OUT = 5           # a fifth of the ids, by CRC-32, is never learnt from
ACCEPT = 0.3           # score from which a document is accepted

_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_LETTER = _UPPER.copy()
_LETTER[97:123] = _LETTER[128:] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_STOP = np.zeros(256, bool)
_STOP[[ord(c) for c in ".,;:?'\"()-"]] = True
_MARK = ~(_LETTER | _DIGIT | _STOP | IS_SPACE)


def encode_passages(offsets: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(features [passages, BUCKETS + STYLE], passages per row). A text without
    words is one passage of zeros."""
    rows = len(offsets) - 1
    starts, ends, row = word_bounds(offsets, data)
    words = span_hashes(data, starts, ends)
    cut = np.searchsorted(row, np.arange(rows + 1))
    n_words = np.diff(cut)
    per_row = np.maximum(1, -(-n_words // PASSAGE_WORDS))
    base = np.concatenate([[0], np.cumsum(per_row)])
    passage = base[row] + (np.arange(len(row)) - cut[row]) // PASSAGE_WORDS
    n = int(base[-1])
    count = np.bincount(passage, minlength=n).astype(np.float32)
    safe = np.maximum(count, 1)

    x = np.zeros((n, BUCKETS + STYLE), np.float32)
    bucket = (words >> np.uint64(20)).astype(np.int64) % BUCKETS
    sign = np.where(words & np.uint64(1), 1.0, -1.0)
    x[:, :BUCKETS] = np.bincount(passage * BUCKETS + bucket, weights=sign, minlength=n * BUCKETS).reshape(n, BUCKETS)
    x[:, :BUCKETS] /= np.sqrt(safe)[:, None] * 4

    def share_of_chars(kind: np.ndarray) -> np.ndarray:
        s = np.concatenate([[0], np.cumsum(kind[data])])
        return s[ends] - s[starts]

    def mean(per_word: np.ndarray) -> np.ndarray:
        return np.bincount(passage, weights=per_word, minlength=n) / safe

    length = (ends - starts).astype(float)
    letters = share_of_chars(_LETTER)
    same = np.zeros(len(words))
    same[1:] = (words[1:] == words[:-1]) & (row[1:] == row[:-1])
    # words of a passage, and 5-word windows of the document, that were there before
    key = mix(words ^ mix(passage.astype(np.uint64)))
    again = np.ones(len(words))
    again[np.unique(key, return_index=True)[1]] = 0
    windows = window_hashes(words, 5)
    repeat = np.zeros(len(words))
    inside = row[4:] == row[:len(windows)] if len(windows) else np.zeros(0, bool)
    wkey = mix(windows ^ mix(row[:len(windows)].astype(np.uint64)))
    seen = np.ones(len(windows))
    if len(windows):
        seen[np.unique(wkey, return_index=True)[1]] = 0
        repeat[:len(windows)] = seen * inside
    last, before = data[ends - 1] if len(ends) else data[:0], data[np.maximum(ends - 2, 0)] if len(ends) else data[:0]
    run_end = (length >= 2) & ~(_LETTER[last] | _DIGIT[last]) & ~(_LETTER[before] | _DIGIT[before])
    style = [mean(share_of_chars(_UPPER) / np.maximum(letters, 1)), mean(share_of_chars(_DIGIT) / length),
             mean(share_of_chars(_MARK) / length), mean(np.minimum(length, 30)) / 10, mean(letters == 0), mean(same),
             mean(again), mean(repeat), mean(run_end), mean(_STOP[last] if len(ends) else length),
             count / PASSAGE_WORDS, (count == 0)]
    x[:, BUCKETS:] = np.stack(style, axis=1)
    return x, per_row


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -60, 60)))


class GatedAttention:
    """The model; ``fit`` learns it, ``score`` applies it. All arrays float32."""

    def __init__(self, features: int = BUCKETS + STYLE, seed: int = 7):
        r = np.random.default_rng(seed)
        init = lambda a, b: (r.standard_normal((a, b)) / np.sqrt(a)).astype(np.float32)
        self.p = {"E": init(features, HIDDEN), "e": np.zeros(HIDDEN, np.float32), "V": init(HIDDEN, ATTENTION),
                  "U": init(HIDDEN, ATTENTION), "w": init(ATTENTION, 1)[:, 0], "c": init(HIDDEN, 1)[:, 0],
                  "d": np.zeros(1, np.float32)}

    def forward(self, x: np.ndarray, per_row: np.ndarray) -> dict[str, np.ndarray]:
        p, first = self.p, np.concatenate([[0], np.cumsum(per_row)[:-1]])
        of = np.repeat(np.arange(len(per_row)), per_row)
        h = np.tanh(x @ p["E"] + p["e"])
        t, s = np.tanh(h @ p["V"]), _sigmoid(h @ p["U"])
        logit = (t * s) @ p["w"]
        a = np.exp(logit - np.maximum.reduceat(logit, first)[of])
        a /= np.add.reduceat(a, first)[of]
        z = np.add.reduceat(a[:, None] * h, first, axis=0)
        return {"h": h, "t": t, "s": s, "a": a, "z": z, "of": of, "score": _sigmoid(z @ p["c"] + p["d"][0])}

    def score(self, x: np.ndarray, per_row: np.ndarray) -> np.ndarray:
        return self.forward(x, per_row)["score"]

    def gradients(self, x: np.ndarray, per_row: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        p, f = self.p, self.forward(x, per_row)
        h, t, s, a, z, of = (f[k] for k in ("h", "t", "s", "a", "z", "of"))
        g = (f["score"] - y) / len(y)                       # of the cross-entropy, by the last sum
        gz = (g[:, None] * p["c"])[of]                      # by z, for each passage of the row
        ga = ((h - z[of]) * gz).sum(axis=1) * a             # by the attention logit
        gt, gs = ga[:, None] * p["w"] * s * (1 - t * t), ga[:, None] * p["w"] * t * s * (1 - s)
        gh = a[:, None] * gz + gt @ p["V"].T + gs @ p["U"].T
        gx = gh * (1 - h * h)
        return {"E": x.T @ gx, "e": gx.sum(axis=0), "V": h.T @ gt, "U": h.T @ gs, "w": ((t * s) * ga[:, None]).sum(axis=0),
                "c": z.T @ g, "d": np.array([g.sum()])}

    def fit(self, bags: list[np.ndarray], labels: np.ndarray, epochs: int = EPOCHS, seed: int = 11) -> GatedAttention:
        r = np.random.default_rng(seed)
        m, v, step = {k: 0.0 for k in self.p}, {k: 0.0 for k in self.p}, 0
        for epoch in range(epochs):
            rate = RATE * (1 - epoch / epochs)
            order = r.permutation(len(bags))
            for at in range(0, len(bags), BATCH):
                pick = order[at:at + BATCH]
                g = self.gradients(np.concatenate([bags[i] for i in pick]), np.array([len(bags[i]) for i in pick]),
                                   labels[pick])
                step += 1
                for k, w in self.p.items():
                    d = g[k] + (1e-4 * w if k in "EVU" else 0)
                    m[k] = 0.9 * m[k] + 0.1 * d
                    v[k] = 0.999 * v[k] + 0.001 * d * d
                    w -= (rate * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(v[k] / (1 - 0.999 ** step)) + 1e-8)).astype(np.float32)
        return self


@arrow_udf(BinaryType())
def _encoded(texts: pa.Array) -> pa.Array:
    out = []
    for _, offsets, data in blocks(texts):
        x, per_row = encode_passages(offsets, data)
        out += [b.tobytes() for b in np.split(x, np.cumsum(per_row)[:-1])]
    return pa.array(out, pa.binary())


def held_out(id_col: str):
    """The rows that no fit may see."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % HELD_OUT == 0, F.lit(False))


def fit_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text",
                label: str = "quality", fit_rows: int = FIT_ROWS, fit_bytes: int = FIT_BYTES) -> GatedAttention | None:
    """Model of ``label`` (0/1) from at most ``fit_rows`` labelled documents,
    taken in the order of a hash of their ids; None without any. Only ids that have
    a document with a text of at most ``fit_bytes`` bytes are chosen from.

    Rows without an id, a label or a text are not learnt from; an id with two
    labels counts with the smaller one."""
    ship(docs)
    known = labels.select(F.col(id_col).cast("bigint").alias("id"), F.col(label).cast("int").alias("y"))
    known = known.filter("id is not null and y in (0, 1)").groupBy("id").agg(F.min("y").alias("y"))
    texts = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text).cast("string").alias("text"))
    texts = texts.filter(F.octet_length("text") <= fit_bytes)
    known = known.filter(~held_out("id")).join(texts.select("id"), "id", "left_semi")
    chosen = known.orderBy(F.xxhash64("id"), "id").limit(fit_rows)  # proven bound: broadcast
    sample = texts.join(F.broadcast(chosen), "id").orderBy(F.xxhash64("id"), "id", F.xxhash64("text")).limit(fit_rows)
    rows = sample.select("y", _encoded("text").alias("x")).collect()  # at most fit_rows texts of fit_bytes
    if not rows:
        return None
    bags = [np.frombuffer(r["x"], np.float32).reshape(-1, BUCKETS + STYLE) for r in rows]
    return GatedAttention().fit(bags, np.array([r["y"] for r in rows], np.float32))


def quality_score(model: GatedAttention | None, text: str = "text"):
    """Column: score in [0, 1] of every whole text. Null and empty texts score
    like a document without words; without a model every score is 0.5."""
    if model is None:
        return F.lit(0.5)

    @arrow_udf(DoubleType())
    def score(texts: pa.Array) -> pa.Array:
        out = [np.zeros(0)]
        for _, offsets, data in blocks(texts):
            out.append(model.score(*encode_passages(offsets, data)).astype(np.float64))
        return pa.array(np.concatenate(out))

    return score(F.col(text).cast("string"))


def score_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text",
                  accept: float = ACCEPT, **fit) -> DataFrame:
    """``id, held_out, score, predicted`` for every row of ``docs``: null and
    repeated ids are scored like others, an empty table gives no rows."""
    model = fit_quality(docs, labels, id_col, text, **fit)
    scored = docs.select(F.col(id_col).alias("id"), held_out(id_col).alias("held_out"),
                         quality_score(model, text).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= accept).cast("int"))
