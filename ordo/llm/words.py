"""Words and word windows of whole Arrow batches as numpy arrays.

A word is a maximal run of bytes other than 0x20 and 0x09-0x0D. UTF-8
continuation bytes are never among these, so byte runs are character runs. All
functions work on one batch of texts; ``blocks`` cuts a batch into pieces of
bounded bytes first (a single longer text is a piece of its own).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 1 << 20
_U = np.uint64
_BASE = _U(0x9E3779B97F4A7C15)      # odd, hence invertible modulo 2^64
_BASE_INVERSE = _U(pow(0x9E3779B97F4A7C15, -1, 1 << 64))

IS_SPACE = np.zeros(256, bool)
IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True
TO_LOWER = np.arange(256, dtype=np.uint8)
TO_LOWER[65:91] += 32

_powers = [np.ones(1, _U), np.ones(1, _U)]


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64: every output bit depends on every input bit."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


BYTE_VALUE = mix(np.arange(1, 257, dtype=_U))


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, at least ``n`` of each."""
    if len(_powers[0]) < n:
        size = max(n, BLOCK_BYTES + 1)
        for i, base in enumerate((_BASE, _BASE_INVERSE)):
            p = np.full(size, base, _U)
            p[0] = 1
            _powers[i] = np.multiply.accumulate(p)
    return _powers[0][:n], _powers[1][:n]


def text_buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(offsets, bytes) of a string array; a null is an empty text."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_string()).fill_null("")
    if len(texts) == 0:
        return np.zeros(1, np.int64), np.zeros(0, np.uint8)
    _, offsets, data = texts.buffers()
    o = np.frombuffer(offsets, np.int64)[texts.offset:texts.offset + len(texts) + 1]
    d = np.frombuffer(data, np.uint8)[o[0]:o[-1]] if data is not None and o[-1] > o[0] else np.zeros(0, np.uint8)
    return o - o[0], d


def blocks(texts: pa.Array, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, offsets, bytes) of consecutive pieces of the batch."""
    offsets, data = text_buffers(texts)
    row, n = 0, len(offsets) - 1
    while row < n:
        end = int(np.searchsorted(offsets, offsets[row] + limit, side="right")) - 1
        end = min(max(end, row + 1), n)
        yield row, offsets[row:end + 1] - offsets[row], data[offsets[row]:offsets[end]]
        row = end


def word_bounds(offsets: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, row) of every word; ``offsets`` cuts words like a space."""
    inside = ~IS_SPACE[data]
    first = np.zeros(len(data) + 1, bool)
    first[offsets] = True
    before = np.empty(len(data), bool)
    after = np.empty(len(data), bool)
    if len(data):
        before[0], before[1:] = False, inside[:-1]
        after[-1], after[:-1] = False, inside[1:]
    starts = np.flatnonzero(inside & (~before | first[:-1]))
    ends = np.flatnonzero(inside & (~after | first[1:])) + 1
    return starts, ends, np.searchsorted(offsets, starts, side="right") - 1


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each byte span, equal for equal bytes wherever they stand."""
    power, inverse = _power_tables(len(data) + 1)
    sums = np.zeros(len(data) + 1, _U)
    np.cumsum(BYTE_VALUE[data] * power[:-1], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * inverse[starts])


def window_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """Hash of the ``k`` words from each position on (``len(words) - k + 1``)."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, _U)
    h = words[:n].copy()
    for j in range(1, k):
        h = mix(h * _BASE + words[j:j + n])
    return h


def shingle_sets(offsets: np.ndarray, data: np.ndarray, k: int) -> list[np.ndarray]:
    """Per row, the sorted distinct hashes of its ``k``-word shingles (letters
    A-Z lower-cased). A row of fewer words has its whole sequence as its only
    shingle, a row without words an empty set."""
    data = TO_LOWER[data]
    starts, ends, row = word_bounds(offsets, data)
    words = span_hashes(data, starts, ends)
    windows = window_hashes(words, k)
    cut = np.searchsorted(row, np.arange(len(offsets)))
    out = []
    for a, b in zip(cut[:-1], cut[1:]):
        if b - a >= k:
            out.append(np.unique(windows[a:b - k + 1]))
        elif b > a:
            h = words[a:a + 1]
            for j in range(a + 1, b):
                h = mix(h * _BASE + words[j:j + 1])
            out.append(mix(h + _U(b - a)))
        else:
            out.append(np.zeros(0, _U))
    return out
