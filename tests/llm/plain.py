"""Plain versions that several tests compare with."""

import random
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
WORDS = "the of and to in is that it for with river stone cloud garden window letter market summer silver quiet".split()
CLASHING = ("id", "row", "n", "size", "key", "bin", "rows", "uses", "k1", "k2", "score", "found", "hashes", "pairs", "label", "spans")


def prose(seed: int, n: int) -> str:
    """Clean sentences of n words, different for each seed."""
    r = random.Random(seed)
    words = [r.choice(WORDS) + (r.choice("abcdefgh") * r.randint(0, 2)) for _ in range(n)]
    out = []
    for i in range(0, n, 12):
        s = " ".join(words[i:i + 12])
        out.append(s[:1].upper() + s[1:] + ".")
    return "\n".join(" ".join(out[i:i + 3]) for i in range(0, len(out), 3))


def ascii_lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def shingles(text, k):
    w = WORD.findall(ascii_lower(text or ""))
    return {tuple(w)} - {()} if len(w) < k else {tuple(w[i:i + k]) for i in range(len(w) - k + 1)}


def links_brute(texts, k):
    sets = {i: shingles(t, k) for i, t in texts.items()}
    ids = sorted(sets)
    return [(a, b) for n, a in enumerate(ids) for b in ids[n + 1:]
            if sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
