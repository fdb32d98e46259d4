"""Packing along the Hilbert curve."""

import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from plain import prose
from tokenizers import Tokenizer

from ordo.llm import packing

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(PATH)
    t.no_truncation()
    t.no_padding()
    return lambda text: t.encode(text or "", add_special_tokens=False).ids


def held(rows, texts, library, length):
    """Every id once, sequences without gaps, and full or a power of two."""
    want = sorted((d is not None, d, zlib.crc32(np.array(library(t) + [1], "<u4").tobytes())) for d, t in texts)
    sequences = defaultdict(list)
    for r in rows:
        assert r["length"] == len(r["ids"]) > 0 and r["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4").tobytes())
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in sequences.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at <= length and at & (at - 1) == 0
    # pieces of rows that share an id are told apart by their place: documents lie end to end
    order = sorted(rows, key=lambda r: (r["sequence_id"], r["offset"]))
    got, ids = [], []
    for r in order:
        assert r["start"] == len(ids)
        ids += r["ids"]
        if len(ids) == r["doc_tokens"]:
            got.append((r["id"] is not None, r["id"], zlib.crc32(np.array(ids, "<u4").tobytes())))
            ids = []
    assert not ids and sorted(got, key=str) == sorted(want, key=str)


@pytest.mark.parametrize("length", [2048, 64])
def test_every_id_once(messy, library, length):
    docs, rows = messy
    got = packing.pack_documents(docs, PATH, length=length, with_ids=True).collect()
    held(got, [(d, t) for d, t, _ in rows], library, length)


def test_table_of_copies(make_docs, library):
    rows = [(i % 5, prose(7, 40), "a") for i in range(300)] + [(i, None, "a") for i in range(100)]
    got = packing.pack_documents(make_docs(rows).repartition(7), PATH, with_ids=True).collect()
    held(got, [(d, t) for d, t, _ in rows], library, 2048)
    assert packing.pack_documents(make_docs([]), PATH).count() == 0


def test_text_ids(spark, library):
    df = spark.createDataFrame([("a", "One two three", 1), (None, "four", 2), ("b", "", 3)], "doc_id string, text string, `k.e y` int")
    got = packing.pack_documents(df, PATH, with_ids=True).collect()
    held(got, [("a", "One two three"), (None, "four"), ("b", "")], library, 2048)


def test_encoder_equals_the_library(library, monkeypatch):
    monkeypatch.setattr(packing, "CHUNKS_REMEMBERED", 50)
    texts = [prose(i, 30 + i) for i in range(300)] + [
        "", " ", "\n\n a  b\t c d e\u0085f", "é ́e ́", "<|endoftext|> x<|startoftext|>y <|endoftext|>",
        "it's WE'LL I’m x's", "a" * 5000, "Σσς İİ", "123 4a5 中文 \U0001f600!", "x \x1c y \x0b z\r\nw",
        "한글 한 क्ष", "l'été ÉTÉ"]
    got = list(packing.ChunkEncoder(PATH).encode(texts))
    assert all(g.tolist() == library(t) for g, t in zip(got, texts)) and len(got) == len(texts)


def test_unknown_kind_is_encoded_whole(tmp_path):
    from tokenizers import models, pre_tokenizers

    t = Tokenizer(models.BPE({"a": 0, "b": 1, " ": 2, "a ": 3}, [("a", " ")]))
    t.pre_tokenizer = pre_tokenizers.Split("b", "isolated")
    t.save(str(tmp_path / "v.json"))
    coder = packing.ChunkEncoder(str(tmp_path / "v.json"))
    assert not coder.cut and [x.tolist() for x in coder.encode(["a a", "a b"])] == [[3, 0], [3, 1]]


def test_curve_visits_neighbours():
    """All cells of a small cube, in the order of their keys: each step is one cell along one axis."""
    for dims, bits in ((2, 4), (3, 3), (6, 2)):
        grid = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims, indexing="ij"), -1).reshape(-1, dims)
        keys = packing.hilbert_keys(grid, bits)
        assert sorted(keys) == list(range(len(grid)))
        assert (np.abs(np.diff(grid[np.argsort(keys)], axis=0)).sum(axis=1) == 1).all()


def test_near_copies_lie_close(make_docs):
    rows = [(i, prose(i // 2, 300) + (" and one more" if i % 2 else ""), "a") for i in range(200)]
    got = packing.pack_documents(make_docs(rows).coalesce(1), PATH).filter("start = 0").orderBy("sequence_id", "offset").collect()
    place = {r["id"]: n for n, r in enumerate(got)}
    close = [abs(place[2 * i] - place[2 * i + 1]) for i in range(100)]
    assert np.median(close) <= 5  # 66 apart if they lay at random
