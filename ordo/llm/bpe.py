"""BPE encoding and decoding with per-prefix dynamic programming.

Encoding a word never merges anything. For every prefix of a word exactly one
token can be the last token of that prefix's encoding, so encoding fills a
table from left to right: among the vocabulary entries that end at a position
(read off the automaton of all entries: the node reached and its suffix links)
it takes the one whose pair with the last token of the shorter prefix is
compatible, that is, the pair encodes to itself. Back-pointers from the end
give the ids. Pair compatibility depends on the two tokens only and is
remembered per Python worker, like the encodings of words; both memories are
emptied when they reach a stated size, which changes no result.

The vocabulary file is that of the tokenizers library (its path is a
parameter); text is normalised and split into words as the file says. Which
characters are letters or numbers, and what their small forms are, differs between versions of
Unicode: texts of scripts that no version has changed are split here, others by
the normaliser and word splitter that the library makes from the file. Encoding is the same.
"""

from __future__ import annotations

import hashlib
import json
import unicodedata
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ordo.llm.tables import ship

WORDS_REMEMBERED = 250_000   # encodings of words kept by one Python worker,
WORD_CHARS = 64              # of words of at most this many characters
PAIRS_REMEMBERED = 500_000
OUTPUT_ROWS = 512            # rows in one output batch: bounds memory with long texts

# Characters whose kind, small form and composition are the same in all versions: Latin and IPA without
# marks, Greek but for sigmas at the end, Cyrillic, general punctuation, kana, unified ideographs, Hangul syllables.
_SETTLED = regex.compile(
    r"[\t\n\r\x20-\x7e\u00a0-\u02af\u0391-\u03a1\u03a3-\u03c1\u03c3-\u03c9\u0400-\u0482\u048a-\u04ff\u2010-\u2027\u2030-\u205e"
    r"\u3041-\u3096\u30a1-\u30fa\u4e00-\u9fa5\uac00-\ud7a3]*")
_END = 0x10000               # offset of the symbols that end a word, out of the file's own alphabet


def _byte_symbols() -> list[str]:
    """The printable stand-in of every byte in byte-level vocabularies: printable
    Latin-1 characters stand for themselves, the others follow from U+0100 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    spare = iter(range(0x100, 0x200))
    return [chr(b) if b in own else chr(next(spare)) for b in range(256)]


class BytePairEncoding:
    """Encoder and decoder for one vocabulary file with word-end symbols."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.suffix = model["end_of_word_suffix"]
        self.token_of = {i: t for t, i in model["vocab"].items()}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.token_of.update({i: t for t, i in self.special.items()})
        self.special_pattern = regex.compile("|".join(map(regex.escape, self.special))) if self.special else None
        split = next(p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.words = regex.compile(split["pattern"]["Regex"])
        steps = [s["type"] for s in spec["normalizer"]["normalizers"]]
        if steps != ["NFC", "Replace", "Lowercase"] or split["behavior"] != "Removed" or spec["decoder"]:
            raise ValueError(f"not a vocabulary of the supported kind: {path}")
        self.symbols = _byte_symbols()
        self.library = Tokenizer.from_file(path)
        self.byte_of = {s: b for b, s in enumerate(self.symbols)}

        vocab = model["vocab"]
        self.rank: dict[tuple[int, int], int] = {}
        self.parts: dict[int, tuple[int, int]] = {}
        for rank, merge in enumerate(model["merges"]):
            left, right = merge.split(" ") if isinstance(merge, str) else merge
            pair, made = (vocab[left], vocab[right]), vocab[left + right]
            self.rank[pair] = rank
            self.parts.setdefault(made, pair)
        self.made_at = {t: self.rank[p] for t, p in self.parts.items()}
        self.automaton = ahocorasick.Automaton()
        for token, i in vocab.items():
            if i in self.parts or len(token.removesuffix(self.suffix)) == 1:
                key = self._key(token)
                self.automaton.add_word(key, (i, len(key)))
        self.automaton.make_automaton()
        self.compatible: dict[int, bool] = {}  # by left << 32 | right
        self.known: dict[str, tuple[int, ...]] = {}

    def _key(self, token: str) -> str:
        """Token as automaton symbols: its last one differs if it ends a word."""
        if token.endswith(self.suffix) and len(token) > len(self.suffix):
            body = token[:-len(self.suffix)]
            return body[:-1] + chr(ord(body[-1]) + _END)
        return token

    def _pair(self, left: int, right: int) -> bool:
        """Does the text of the pair encode to just this pair? Only if no merge
        across the border comes before the merges that make the two tokens. The
        tokens on the border are taken apart, the later made one first; a border
        merge that would then still come earlier spoils the pair."""
        seen = self.compatible.get(left << 32 | right)
        if seen is None:
            a, b, bound = left, right, len(self.rank)
            seen = True
            while True:
                merge = self.rank.get((a, b))
                if merge is not None and merge < bound:
                    seen = False
                    break
                made_a, made_b = self.made_at.get(a, -1), self.made_at.get(b, -1)
                if made_a < 0 and made_b < 0:
                    break
                # before the later of the two merges was made, its inner part stood at the border;
                # of equal merges the left one is made first
                if made_a > made_b:
                    bound, a = made_a, self.parts[a][1]
                else:
                    bound, b = made_b + 1, self.parts[b][0]
            if len(self.compatible) >= PAIRS_REMEMBERED:
                self.compatible.clear()
            self.compatible[left << 32 | right] = seen
        return seen

    def encode_word(self, word: str) -> tuple[int, ...]:
        """Ids of one word (already normalised), by the prefix table."""
        symbols = word.encode().decode("latin-1").translate(self.symbols)
        symbols = symbols[:-1] + chr(ord(symbols[-1]) + _END)
        last = [-1] * (len(symbols) + 1)     # last token of each prefix; -1: no encoding ends here
        back = [0] * (len(symbols) + 1)
        pair = self.compatible
        for end, (token, size) in self.automaton.iter(symbols):
            end += 1
            if last[end] >= 0:
                continue
            start = end - size
            if start:
                before = last[start]
                if before < 0:
                    continue
                ok = pair.get(before << 32 | token)
                if not (self._pair(before, token) if ok is None else ok):
                    continue
            last[end], back[end] = token, start
        out, at = [], len(symbols)
        while at:
            out.append(last[at])
            at = back[at]
        return tuple(reversed(out))

    def split(self, text: str) -> list[str]:
        """Words of a text without special tokens, normalised."""
        if not _SETTLED.fullmatch(text):
            pieces = self.library.pre_tokenizer.pre_tokenize_str(self.library.normalizer.normalize_str(text))
            return [bytes(map(self.byte_of.__getitem__, p)).decode() for p, _ in pieces]
        text = unicodedata.normalize("NFC", text)
        # one character at a time: a capital sigma has no special form at the end of a word
        return self.words.findall(text.replace("Σ", "σ").lower())

    def _word_ids(self, word: str) -> tuple[int, ...]:
        ids = self.known.get(word)
        if ids is None:
            ids = self.encode_word(word)
            if len(word) <= WORD_CHARS:
                if len(self.known) >= WORDS_REMEMBERED:
                    self.known.clear()
                self.known[word] = ids
        return ids

    def encode(self, text: str | None) -> list[int]:
        ids: list[int] = []
        at, known = 0, self.known
        for m in [*(self.special_pattern.finditer(text or "") if self.special_pattern else ()), None]:
            piece = (text or "")[at:m.start() if m else None]
            for word in self.split(piece):
                ids += known.get(word) or self._word_ids(word)
            if m:
                ids.append(self.special[m[0]])
                at = m.end()
        return ids

    def decode(self, ids: list[int]) -> str:
        """Without a decoder in the file, tokens are joined by one space; ids
        that are not in the vocabulary are left out."""
        return " ".join([t for t in map(self.token_of.get, ids) if t is not None])


_loaded: dict[str, BytePairEncoding] = {}


def load(path: str) -> BytePairEncoding:
    """The encoder of a file, read once per Python worker."""
    if path not in _loaded:
        _loaded[path] = BytePairEncoding(path)
    return _loaded[path]


def _sha256(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


# output column: its type and how it follows from the ids and the encoder
OUTPUTS = {
    "ids": ("array<int>", pa.list_(pa.int32()), lambda ids, coder: ids),
    "decoded": ("string", pa.string(), lambda ids, coder: coder.decode(ids)),
    "n_tokens": ("bigint", pa.int64(), lambda ids, coder: len(ids)),
    "ids_sha256": ("string", pa.string(), lambda ids, coder: _sha256(" ".join(map(str, ids)))),
    "decoded_sha256": ("string", pa.string(), lambda ids, coder: _sha256(coder.decode(ids))),
}


def encode_texts(docs: DataFrame, path: str, id_col: str = "doc_id", text: str = "text",
                 outputs: tuple[str, ...] = ("ids", "decoded")) -> DataFrame:
    """``id`` and the chosen OUTPUTS of every whole text, one row per input row.

    A null text counts as empty and has no ids; null and repeated ids and an
    empty table need no care. Texts of any length are encoded whole; other columns are not read. ``path`` must name the file on every executor."""
    src = docs.select(F.col(id_col).alias("id"), F.col(text).cast("string").alias("text"))
    kind = src.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = load(path)
        for batch in batches:
            for at in range(0, batch.num_rows, OUTPUT_ROWS):
                part = batch.slice(at, OUTPUT_ROWS)
                values: dict[str, list] = {c: [] for c in outputs}
                for t in part.column(1):
                    ids = coder.encode(t.as_py())
                    for c, v in values.items():
                        v.append(OUTPUTS[c][2](ids, coder))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), *(pa.array(v, OUTPUTS[c][1]) for c, v in values.items())], ["id", *outputs])

    return ship(src).mapInArrow(run, f"id {kind}, " + ", ".join(f"{c} {OUTPUTS[c][0]}" for c in outputs))
