"""BPE, quality rules, secrets and repeated substrings against plain versions."""

import hashlib
import random
import re
import time

import numpy as np
import public_tokenizers
import pyarrow as pa
from plain import WORD, prose
from tokenizers import Tokenizer

from ordo.llm import bpe, quality_rules, secret_scan
from ordo.llm.queries import VOCABULARY
from ordo.llm.substring_dedup import dedup_substrings
from ordo.llm.words import blocks

PATH = public_tokenizers.path(VOCABULARY)


# ------------------------------------------------------------------ BPE

def test_bpe_equals_the_library():
    coder, lib = bpe.BytePairEncoding(PATH), Tokenizer.from_file(PATH)
    r = random.Random(3)
    parts = ["the", "ing", "a", "Σ", "ΑΣ", "İ", "ß", "<|endoftext|>", "<|startoftext|>", "'s", "'LL", "1", "23", "é", "é",
             "K", "日本", "​", "\x85", "\x1c", " ", "😀", "!!", "$$$", "-", "\n", "\xa0", "ǅ", "ﬁ", "\0", "٣", "Ⅷ", "</w>"]
    texts = ["", prose(1, 3000)] + ["".join(r.choice(parts) for _ in range(r.randint(0, 15))) for _ in range(3000)]
    texts += ["".join(r.choice("etaoinshr") for _ in range(r.randint(1, 80))) for _ in range(1500)]
    for t in texts:
        want = lib.encode(t, add_special_tokens=False).ids
        assert coder.encode(t) == want, t
        assert coder.decode(want) == lib.decode(want, skip_special_tokens=False)


def test_bpe_memory_limits_change_nothing(monkeypatch):
    want = bpe.BytePairEncoding(PATH).encode(prose(5, 500))
    monkeypatch.setattr(bpe, "WORDS_REMEMBERED", 3)
    monkeypatch.setattr(bpe, "PAIRS_REMEMBERED", 5)
    assert bpe.BytePairEncoding(PATH).encode(prose(5, 500)) == want


def test_bpe_messy_and_empty(messy, make_docs):
    docs, rows = messy
    lib = Tokenizer.from_file(PATH)
    got = bpe.encode_texts(docs, PATH, outputs=tuple(bpe.OUTPUTS)).collect()
    key = lambda x: (x[0] is not None, x[0], x[1])
    want = [(d, lib.encode(t or "", add_special_tokens=False).ids) for d, t, _ in rows]
    assert sorted(((r["id"], list(r["ids"])) for r in got), key=key) == sorted(want, key=key)
    for r in got:
        assert r["n_tokens"] == len(r["ids"]) and r["decoded"] == lib.decode(r["ids"], skip_special_tokens=False)
        assert r["ids_sha256"] == hashlib.sha256(" ".join(map(str, r["ids"])).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(r["decoded"].encode()).hexdigest()
    assert bpe.encode_texts(make_docs([]), PATH).count() == 0


# ------------------------------------------------------------------ quality rules

def plain_measures(t):
    t = t or ""
    w, lines, seen, dup = WORD.findall(t), t.split("\n"), set(), 0
    for x in lines:
        if WORD.search(x):
            dup += x in seen
            seen.add(x)
    at = {}
    for i in range(len(w) - 4):
        at.setdefault(tuple(w[i:i + 5]), []).append(i)
    covered = {j for v in at.values() if len(v) > 1 for i in v for j in range(i, i + 5)}
    return {"n_words": len(w), "word_chars": sum(map(len, w)), "n_symbols": len(re.findall(r"[#*$%&|<>]", t)),
            "n_dup_lines": dup, "n_repeat_words": len(covered), "n_distinct_words": len(set(w))}


def test_measures_against_plain():
    r = random.Random(1)
    parts = ["a", "b", " ", "\n", "é", "#", "a b c d e ", "\n\n", ".", "\t", "x\n", "\x85", "日"]
    texts = [None, "", "\n", "\na", "a\n", "\na\na", prose(2, 400)]
    texts += ["".join(r.choice(parts) for _ in range(r.randint(0, 60))) for _ in range(1500)]
    for limit in (40, 1 << 20):
        got = []
        for _, offsets, data in blocks(pa.array(texts), limit):
            m = quality_rules.measure_block(offsets, data)
            got += [{k: int(v[i]) for k, v in m.items()} for i in range(len(offsets) - 1)]
        assert len(got) == len(texts)
        for t, g in zip(texts, got):
            want = plain_measures(t)
            assert {k: g[k] for k in want} == want, t


def test_em_finds_accuracies():
    r = np.random.default_rng(0)
    truth = r.random(20_000) < 0.8
    votes = np.stack([np.where(r.random(20_000) < 0.3, -1, np.where(r.random(20_000) < a, truth, ~truth)) for a in
                      (0.95, 0.9, 0.85, 0.7, 0.6)], axis=1)
    patterns, counts = np.unique(votes, axis=0, return_counts=True)
    post, rates, share = quality_rules.fit_votes(patterns, counts.astype(float))
    accuracy = rates[1, :, 1] / rates[1, :, :2].sum(axis=1)
    assert np.all(np.diff(accuracy[:4]) < 0) and abs(share - 0.8) < 0.05
    of = {tuple(p): x for p, x in zip(patterns, post)}
    assert np.mean([(of[tuple(v)] >= 0.5) == t for v, t in zip(votes, truth)]) > 0.93


def test_rules_keep_prose_and_refuse_junk(make_docs):
    good = [(i, prose(i, 60 + i), "a") for i in range(40)]
    junk = [(100 + i, " | ".join(f"item{j * 7 + i}" for j in range(80)), "a") for i in range(8)]
    junk += [(200 + i, " ".join(w.upper() + "!!" for w in prose(i, 80).split()), "a") for i in range(8)]
    junk += [(300 + i, "spam " * 50, "a") for i in range(4)]
    got = {r["id"]: r for r in quality_rules.judge_texts(make_docs(good + junk)).collect()}
    assert all(got[d]["kept"] for d, _, _ in good) and not any(got[d]["kept"] for d, _, _ in junk)


def test_rules_messy_and_empty(messy, make_docs):
    docs, rows = messy
    got = quality_rules.judge_texts(docs).collect()
    assert len(got) == len(rows)
    for r in got:
        failed = r["n_words"] < 10 or 100 * r["n_repeat_words"] > 20 * r["n_words"]
        assert r["base_failed"] == failed and not (failed and r["kept"]) and 0 <= r["posterior"] <= 1
    assert quality_rules.judge_texts(make_docs([])).count() == 0


# ------------------------------------------------------------------ secrets

def plain_secrets(t):
    ci = "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in "(password|passwd|secret|token|api_?key)")
    out = [("assign", m.start(), m.end()) for m in re.finditer(
        ci + r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", t or "") if len(m[2]) >= 8]
    out += [("access", m.start(), m.end()) for m in re.finditer("AKIA[A-Z0-9]+", t or "") if len(m[0]) >= 16]
    out += [("hex", m.start(), m.end()) for m in re.finditer("[0-9a-f]+", t or "") if len(m[0]) >= 32]
    return sorted(out, key=lambda s: (s[1], secret_scan.KINDS.index(s[0])))


def test_secrets_against_plain():
    r = random.Random(2)
    parts = ["password", "PassWD", "secret", "toKen", "ſecret", "api_key", "APIKEY", "AKIA", "=", ":", " ", '"', "'", "abcdefgh",
             "x", "0123456789abcdef", "İ", "é", "AKIA1234567890ABCD", "\n", "toKen"]
    for t in [None, ""] + ["".join(r.choice(parts) for _ in range(r.randint(0, 40))) for _ in range(6000)]:
        assert [s for s in secret_scan.find_secrets(t) if s[0] in secret_scan.KINDS[:3]] == plain_secrets(t), t


def test_checksums():
    body = "abcdefghij0123456789ABCDEFGHIJ"
    good = "ghp_" + body + secret_scan.base62_crc32(body)
    assert [k for k, _, _ in secret_scan.find_secrets(f"x {good} y")] == ["github"]
    assert secret_scan.find_secrets(f"x {good[:-1]}{'0' if good[-1] != '0' else '1'} y") == []


def test_secrets_messy_and_empty(messy, make_docs):
    docs, rows = messy
    assert scan_count(docs) == len(rows) and scan_count(make_docs([])) == 0
    long = make_docs([(1, "é" * 100_000 + " token = abcdefgh12", "a")])
    assert [tuple(s) for s in secret_scan.scan_secrets(long).first()["spans"]] == [("assign", 100_001, 100_019)]


def scan_count(docs):
    return secret_scan.scan_secrets(docs).count()


# ------------------------------------------------------------------ repeated substrings

def plain_cut(texts, length=200):
    seen = {}
    raw = [(t or "").encode() for t in texts]
    for n, b in enumerate(raw):
        for i in range(len(b) - length + 1):
            seen.setdefault(b[i:i + length], []).append((n, i))
    gone = [bytearray(len(b)) for b in raw]
    for places in seen.values():
        if len(places) > 1:
            for n, i in places:
                gone[n][i:i + length] = b"\1" * length
    return [(len(b), bytes(c for c, g in zip(b, gone[n]) if not g), [m.span() for m in re.finditer(b"\1+", bytes(gone[n]))])
            for n, b in enumerate(raw)]


def test_substrings_against_plain(make_docs):
    r = random.Random(8)
    base = [prose(i, 300) for i in range(6)]
    texts = list(base)
    for i in range(40):
        b = r.choice(base)
        at, n = r.randrange(len(b) - 450), r.choice((150, 199, 200, 201, 215, 260, 420))
        texts.append(prose(100 + i, r.randint(0, 40)) + b[at:at + n] + prose(200 + i, r.randint(0, 40)))
    for i in range(12):  # copies with edits
        b = list(r.choice(base))
        for _ in range(r.randint(1, 6)):
            b[r.randrange(len(b))] = r.choice("XYZé")
        texts.append("".join(b))
    texts += ["ab" * 300, "a" * 199, "a" * 200, "a" * 201, "abcdefg" * 28 + "abcd", "é" * 101, "", None, "short", base[0], base[0]]
    got = {r_["id"]: r_ for r_ in dedup_substrings(make_docs([(i, t, "s") for i, t in enumerate(texts)])).collect()}
    for i, (n, kept, spans) in enumerate(plain_cut(texts)):
        assert (got[i]["n_bytes"], bytes(got[i]["kept"]), [tuple(s) for s in got[i]["removed"]]) == (n, kept, spans), i


def test_substrings_messy_and_empty(messy, make_docs):
    docs, rows = messy
    got = sorted(((r["n_bytes"], bytes(r["kept"])) for r in dedup_substrings(docs).collect()))
    small = [t if t is None or len(t) < 100_000 else None for _, t, _ in rows]
    want = [(n, kept) for (n, kept, _), t in zip(plain_cut(small), small) if t is not None]
    assert len(got) == len(rows) and not [w for w in want if w not in got]
    assert dedup_substrings(make_docs([])).count() == 0


def test_bpe_on_every_code_point():
    """Letters and numbers of every script, also those that newer versions of Unicode added."""
    coder, library = bpe.load(public_tokenizers.path(VOCABULARY)), Tokenizer.from_file(public_tokenizers.path(VOCABULARY))
    library.no_truncation()
    points = [c for c in range(0x20, 0x323B0) if not 0xD800 <= c < 0xE000]
    texts = [" ".join(f"x{chr(c)}y1" for c in points[i:i + 200]) for i in range(0, len(points), 200)]
    r = random.Random(8)
    for pool in (points, range(0x20, 0x300), range(0x300, 0x600), (0x41, 0x3A3, 0x3C2, 0x301, 0x130, 0x20, 0x27, 0x73, 0x12550, 0x1C89)):
        texts += ["".join(chr(r.choice(pool)) for _ in range(8)) for _ in range(5000)]
    for text in texts:
        assert coder.encode(text) == library.encode(text, add_special_tokens=False).ids, [hex(ord(c)) for c in text[:9]]


def test_long_words_are_not_remembered():
    coder = bpe.BytePairEncoding(public_tokenizers.path(VOCABULARY))
    coder.encode("short " + "ab" * 50_000 + " words")
    assert sorted(coder.known) == ["short", "words"]


def test_secrets_in_linear_time():
    """A megabyte of token beginnings, with and without a token at its end."""
    start = time.perf_counter()
    assert secret_scan.find_secrets("eyJ" * 350_000) == []
    assert secret_scan.find_secrets("eyJ" * 350_000 + ".eyJ" * 100_000) == []
    token = "eyJ" + "a" * 12 + ".eyJ" + "b" * 12 + "." + "c" * 24
    text = ("eyJ" * 10 + " ") * 30_000 + token + " " + "eyJeyJ" * 5 + "." + token
    found = [s for s in secret_scan.find_secrets(text) if s[0] == "jwt"]
    assert found == [("jwt", m.start(), m.end()) for m in secret_scan.JWT.finditer(text)] and len(found) == 2
    assert time.perf_counter() - start < 5


def test_substrings_of_many_copies_without_id(spark):
    """20,000 rows that agree in everything: their spans count once."""
    text = prose(3, 400)
    df = spark.range(20_000).selectExpr("cast(null as bigint) doc_id", f"'{text}' text")
    got = dedup_substrings(df).selectExpr("size(removed) s", "length(kept) k").distinct().collect()
    assert [(r["s"], r["k"]) for r in got] == [(1, 0)]
