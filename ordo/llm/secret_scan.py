"""Secret scan: keywords, then anchored patterns, then embedded checksums.

One Aho-Corasick pass over a text finds the places where a keyword of any kind
starts. Regular expressions are tried only there, anchored, so their cost
follows the hits and not the length of the text. Tokens that carry a checksum
(the last six base-62 digits are the CRC-32 of the part before) must satisfy
it; what merely looks like one is dropped. Long hexadecimal runs have no
keyword; they are found by a character-class scan.

Spans are code point offsets, end exclusive.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordo.llm.tables import ship

# The base kinds in the order in which they are listed, then those the method adds.
KINDS = ("assign", "access", "hex", "github", "npm", "jwt", "private_key", "slack", "google")

ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
GITHUB = re.compile(r"gh[pousr]_([A-Za-z0-9]{30})([A-Za-z0-9]{6})(?![A-Za-z0-9])")
NPM = re.compile(r"npm_([A-Za-z0-9]{30})([A-Za-z0-9]{6})(?![A-Za-z0-9])")
JWT = re.compile(r"eyJ[A-Za-z0-9_-]{10,}+\.eyJ[A-Za-z0-9_-]{10,}+\.[A-Za-z0-9_-]{20,}+")
PRIVATE_KEY = re.compile(r"-----BEGIN (?:[A-Z0-9]+ )*PRIVATE KEY-----[A-Za-z0-9+/=\s]+-----END (?:[A-Z0-9]+ )*PRIVATE KEY-----")
SLACK = re.compile(r"xox[abprs]-[0-9]{8,}-[A-Za-z0-9-]{16,}")
GOOGLE = re.compile(r"AIza[A-Za-z0-9_-]{35}(?![A-Za-z0-9_-])")
BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"


def base62_crc32(payload: str) -> str:
    """The six digits that such a token ends with."""
    n, out = zlib.crc32(payload.encode()), ""
    for _ in range(6):
        n, d = divmod(n, 62)
        out = BASE62[d] + out
    return out


def _checksum(m: re.Match) -> bool:
    return base62_crc32(m[1]) == m[2]


def _always(m: re.Match) -> bool:
    return True


# kind: keywords (lower case), pattern, test of a match
RULES = {
    "assign": (("password", "passwd", "secret", "token", "apikey", "api_key"), ASSIGN, lambda m: len(m[2]) >= 8),
    "access": (("akia",), ACCESS, lambda m: len(m[0]) >= 16),
    "github": (("ghp_", "gho_", "ghu_", "ghs_", "ghr_"), GITHUB, _checksum),
    "npm": (("npm_",), NPM, _checksum),
    "jwt": (("eyj",), JWT, _always),
    "private_key": (("-----begin ",), PRIVATE_KEY, _always),
    "slack": (("xoxa-", "xoxb-", "xoxp-", "xoxr-", "xoxs-"), SLACK, _always),
    "google": (("aiza",), GOOGLE, _always),
}

# kinds whose keyword may stand many times in one run: all of the run, with what follows it, decides
RUNS = {"jwt": re.compile(r"[A-Za-z0-9_-]+")}

_TO_LOWER = {c: c + 32 for c in range(65, 91)}
_automaton = None


def _keywords() -> ahocorasick.Automaton:
    global _automaton
    if _automaton is None:
        a = ahocorasick.Automaton()
        for kind, (words, _, _) in RULES.items():
            for w in words:
                a.add_word(w, (kind, len(w)))
        a.make_automaton()
        _automaton = a
    return _automaton


def _lower(text: str) -> str:
    """A-Z lower-cased; every other character keeps its place. ``str.lower`` may
    also change others, which at worst gives a hit that the pattern refuses."""
    low = text.lower()
    return low if len(low) == len(text) else text.translate(_TO_LOWER)


def find_secrets(text: str | None) -> list[tuple[str, int, int]]:
    """All (kind, start, end) of a text, by start, then kind. Per kind the
    matches are the leftmost non-overlapping ones of its pattern; a match that
    fails its test still uses up its characters."""
    if not text:
        return []
    found, free = [], {}
    # hits come in the order of their ends; the pattern needs them by start, per kind
    hits = sorted((end - size + 1, kind) for end, (kind, size) in _keywords().iter(_lower(text)))
    for start, kind in hits:
        if start < free.get(kind, 0):
            continue
        _, pattern, test = RULES[kind]
        m = pattern.match(text, start)
        if not m and kind in RUNS:
            # no later start in this run of characters can match either
            run = RUNS[kind].match(text, start)
            free[kind] = run.end() if run else start + 1
        if m:
            free[kind] = m.end()
            if test(m):
                found.append((kind, start, m.end()))
    found += [("hex", m.start(), m.end()) for m in HEX.finditer(text)]
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0])))


_SPAN = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        spans = [[{"kind": k, "start": a, "end": b} for k, a, b in find_secrets(t.as_py())] for t in batch.column(1)]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(spans, _SPAN)], ["id", "spans"])


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """``id`` and ``spans`` (array of kind, start, end) of every whole text, one
    row per input row. Null and empty texts have no spans; null and repeated ids
    and an empty table need no care. Texts of any length are scanned whole, in time
    in proportion to it; other columns are not read."""
    src = docs.select(F.col(id_col).alias("id"), F.col(text).cast("string").alias("text"))
    kind = src.schema["id"].dataType.simpleString()
    return ship(src).mapInArrow(_scan, f"id {kind}, spans array<struct<kind:string,start:bigint,end:bigint>>")


def span_digest(spans):
    """``kind:start:end`` of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

