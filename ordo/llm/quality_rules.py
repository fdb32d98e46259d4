"""Quality rules by weak supervision: rules vote or abstain, expectation
maximisation estimates how accurate each rule is, and a document is judged by
the posterior probability that it is good instead of having to pass every rule.

Spark measures every whole text and turns the measures into votes; what EM
needs from the corpus is only how often each vote pattern occurs. There are at
most 3^rules patterns however many documents, and their counts cover all
documents. EM runs on those counts and the posterior per pattern joins back.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordo.llm.tables import materialize, ship
from ordo.llm.words import IS_SPACE, blocks, mix, span_hashes, window_hashes, word_bounds

KEEP_POSTERIOR = 0.5
WINDOW = 5             # words in a window for repeated passages
EM_ROUNDS = 50
PRIOR_GOOD = 0.8       # start of the share of good documents
PRIOR_ACCURACY = 0.8   # accuracy of the pseudo-votes
PRIOR_VOTES = 5.0      # pseudo-votes per rule and class

# Frequent function words of English, French, Spanish, German.
FUNCTION_WORDS = (
    "the of and to in is that it for with on as was by this are be "
    "de la le les et en un une des du que qui est pour dans sur "
    "el los las y del se por con su una "
    "der die das und den von zu mit sich ist im dem nicht für"
)

MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines",
            "n_distinct_words", "n_upper", "n_letters", "n_letterless_words", "n_function_words",
            "n_run_end_words", "n_ended_lines"]

# name: (votes bad where true, votes good where true), as SQL over the measures; abstains otherwise.
# Most rules can only tell junk: a text without their fault is no evidence for quality.
RULES: dict[str, tuple[str, str]] = {
    "word_length": ("word_chars < 2.5 * n_words or word_chars > 15 * n_words", "false"),
    "symbols": ("n_symbols > 0.1 * n_words", "false"),
    "punctuation_runs": ("n_run_end_words > 0.2 * n_words", "false"),
    "capitals": ("n_upper > 0.3 * n_letters", "false"),
    "repeated_lines": ("n_dup_lines > 0.3 * n_lines", "false"),
    "repeated_passages": ("n_repeat_words > 0.15 * n_words", "false"),
    "distinct_words": ("n_distinct_words < 0.6 * n_words and n_distinct_words < 3 * sqrt(n_words)",
                       "n_distinct_words > 5 * sqrt(n_words)"),
    "letters": ("n_letterless_words > 0.15 * n_words and n_letterless_words >= 5", "false"),
    "function_words": ("n_function_words < 0.03 * n_words and n_words >= 20",
                       "n_function_words > 0.05 * n_words"),
    "sentence_ends": ("n_ended_lines < 0.1 * n_lines and n_words >= 20", "n_ended_lines > 0.8 * n_lines"),
}

_SYMBOL = np.zeros(256, bool)
_SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = _LETTER[128:] = True
_ENDS = np.zeros(256, bool)
_ENDS[[ord(c) for c in ".!?:;\"'"]] = True


def _hash_words(words: list[str]) -> np.ndarray:
    texts = pa.array(words)
    (_, offsets, data), = blocks(texts)
    return span_hashes(data, *word_bounds(offsets, data)[:2])


_FUNCTION_HASHES = np.sort(_hash_words(FUNCTION_WORDS.split()))


def _repeated(windows: np.ndarray, k: int) -> int:
    """Words covered by windows that occur twice or more."""
    if len(windows) < 2:
        return 0
    order = np.argsort(windows, kind="stable")
    s = windows[order]
    same = s[1:] == s[:-1]
    if not same.any():
        return 0
    hit = np.zeros(len(s), bool)
    hit[1:] |= same
    hit[:-1] |= same
    step = np.zeros(len(windows) + k, np.int64)
    at = order[hit]
    np.add.at(step, at, 1)
    np.add.at(step, at + k, -1)
    return int(np.count_nonzero(np.cumsum(step) > 0))


def _line_measures(offsets: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per row: lines with a word, those equal to an earlier line, those that
    end like a sentence."""
    n = len(offsets) - 1
    ends = np.union1d(np.flatnonzero(data == 10), offsets[1:])       # a line ends at \n or with its text
    starts = np.concatenate([[0], ends[:-1]])
    word_sum = np.concatenate([[0], np.cumsum(~IS_SPACE[data])])
    has = (word_sum[ends] > word_sum[starts]) & (ends > starts)
    starts, ends = starts[has], ends[has]
    starts = starts + (data[starts] == 10)  # the \n that ends the line before belongs to no line
    row = np.searchsorted(offsets, starts, side="right") - 1
    key = mix(span_hashes(data, starts, ends) ^ mix((row + 1).astype(np.uint64)))
    _, first = np.unique(key, return_index=True)
    dup = np.ones(len(key), bool)
    dup[first] = False
    # last character of the line's last word
    pos = np.where(IS_SPACE[data], -1, np.arange(len(data)))
    last = np.maximum.accumulate(pos)[ends - 1] if len(ends) else ends
    ended = _ENDS[data[last]] if len(ends) else dup
    count = lambda which: np.bincount(row[which], minlength=n)
    return np.bincount(row, minlength=n), count(dup), count(ended)


def measure_block(offsets: np.ndarray, data: np.ndarray) -> dict[str, np.ndarray]:
    """The measures of every row of one block."""
    n = len(offsets) - 1
    starts, ends, row = word_bounds(offsets, data)
    words = span_hashes(data, starts, ends)
    windows = window_hashes(words, WINDOW)
    cut = np.searchsorted(row, np.arange(n + 1))

    def total(mask: np.ndarray) -> np.ndarray:
        s = np.concatenate([[0], np.cumsum(mask)])
        return s[offsets[1:]] - s[offsets[:-1]]

    def per_word(mask: np.ndarray) -> np.ndarray:
        return np.bincount(row[mask], minlength=n)

    letters = np.concatenate([[0], np.cumsum(_LETTER[data])])
    is_letter = _LETTER[data]
    digit = (data >= 48) & (data <= 57)
    plain = is_letter | digit
    long_enough = ends - starts >= 2
    run_end = long_enough & ~plain[ends - 1] & ~plain[np.maximum(ends - 2, 0)] if len(ends) else long_enough
    n_lines, dup_lines, ended = _line_measures(offsets, data)
    out = {
        "n_words": np.diff(cut), "word_chars": total(~IS_SPACE[data] & ((data & 0xC0) != 0x80)),
        "n_symbols": total(_SYMBOL[data]), "n_dup_lines": dup_lines,
        "n_repeat_words": np.array([_repeated(windows[a:max(b - WINDOW + 1, a)], WINDOW)
                                    for a, b in zip(cut[:-1], cut[1:])], np.int64),
        "n_lines": n_lines,
        "n_distinct_words": np.array([len(np.unique(words[a:b])) for a, b in zip(cut[:-1], cut[1:])], np.int64),
        "n_upper": total(_UPPER[data]), "n_letters": total(is_letter & ((data & 0xC0) != 0x80)),
        "n_letterless_words": per_word(letters[ends] == letters[starts]),
        "n_function_words": per_word(np.isin(words, _FUNCTION_HASHES)),
        "n_run_end_words": per_word(run_end), "n_ended_lines": ended,
    }
    return {k: v.astype(np.int64) for k, v in out.items()}


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row, offsets, data in blocks(batch.column(1)):
            m = measure_block(offsets, data)
            ids = batch.column(0).slice(row, len(offsets) - 1)
            yield pa.RecordBatch.from_arrays([ids, *(pa.array(m[c]) for c in MEASURES)], ["id", *MEASURES])


def measure_texts(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """``id`` and MEASURES of every whole text, one row per input row."""
    src = docs.select(F.col(id_col).alias("id"), F.col(text).cast("string").alias("text"))
    kind = src.schema["id"].dataType.simpleString()
    return ship(src).mapInArrow(_measure, f"id {kind}, " + ", ".join(f"{c} bigint" for c in MEASURES))


def fit_votes(votes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """EM over vote patterns (rows; 1 good, 0 bad, -1 abstains) that occur
    ``counts`` times: (posterior of good per pattern, rates, share of good).

    ``rates[class, rule, vote]`` is how often a rule votes so on bad and on good
    texts: its accuracy on either, and how telling an abstention is. EM starts
    from the share of good votes among the votes cast. Pseudo-votes of rules
    that are right with PRIOR_ACCURACY keep the classes from trading places."""
    says = np.stack([votes == v for v in (0, 1, -1)], axis=2).astype(float)  # pattern, rule, vote
    right, wrong = PRIOR_ACCURACY, 1 - PRIOR_ACCURACY
    pseudo = PRIOR_VOTES * np.array([[right, wrong, 1.0], [wrong, right, 1.0]]) / 2
    cast = says[:, :, :2].sum(axis=(1, 2))
    post = np.where(cast > 0, says[:, :, 1].sum(axis=1) / np.maximum(cast, 1), PRIOR_GOOD)
    rates, share = np.zeros((2, votes.shape[1], 3)), PRIOR_GOOD
    for _ in range(EM_ROUNDS):
        weight = np.stack([counts * (1 - post), counts * post])
        rates = np.einsum("cp,prv->crv", weight, says) + pseudo[:, None, :]
        rates /= rates.sum(axis=2, keepdims=True)
        share = (weight[1].sum() + PRIOR_GOOD * PRIOR_VOTES) / (counts.sum() + PRIOR_VOTES)
        bad, good = np.einsum("prv,crv->cp", says, np.log(rates))
        post = 1 / (1 + np.exp(np.clip(bad - good + np.log(1 - share) - np.log(share), -700, 700)))
    return post, rates, float(share)


def judge_texts(docs: DataFrame, id_col: str = "doc_id", text: str = "text",
                keep_posterior: float = KEEP_POSTERIOR) -> DataFrame:
    """``id``, MEASURES, ``votes``, ``posterior``, ``base_failed``, ``kept``.

    Null and empty texts have no words: they fail the base rules. Null or
    repeated ids are judged like any row; an empty table gives no rows."""
    vote = [F.when(F.expr(bad), F.lit(0)).when(F.expr(good), F.lit(1)).otherwise(F.lit(-1))
            for bad, good in RULES.values()]
    measured = materialize(measure_texts(docs, id_col, text).withColumn(
        "votes", F.concat_ws(" ", *[v.cast("string") for v in vote])), "quality-votes")
    patterns = measured.groupBy("votes").count().collect()  # at most 3^len(RULES) rows
    patterns.sort(key=lambda r: r["votes"])
    votes = np.array([[int(v) for v in r["votes"].split()] for r in patterns]).reshape(-1, len(RULES))
    post, _, _ = fit_votes(votes, np.array([r["count"] for r in patterns], float))
    table = docs.sparkSession.createDataFrame(
        [(r["votes"], float(p)) for r, p in zip(patterns, post)], "v string, posterior double")
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return measured.join(table, F.col("votes") == F.col("v"), "left").drop("v").withColumn(
        "base_failed", failed).withColumn(
        "kept", ~F.col("base_failed") & (F.col("posterior") >= keep_posterior))
