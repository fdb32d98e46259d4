import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from plain import CLASHING, prose  # noqa: E402

@pytest.fixture(scope="session")
def make_docs(spark):
    """DataFrame like ``documents`` from (doc_id, text, source), with further
    columns whose names operators use inside."""
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint, " + \
        ", ".join(f"`{c}` string" for c in CLASHING)

    def make(rows):
        return spark.createDataFrame(
            [(d, t, "en", s, None if t is None else len(t), *["x"] * len(CLASHING)) for d, t, s in rows], schema)
    return make


@pytest.fixture(scope="session")
def messy(make_docs):
    """Nulls in every column, empty and very long texts, repeated rows, ties."""
    long = prose(99, 40_000)
    rows = [(1, prose(1, 120), "a"), (2, prose(1, 120), "b"), (2, prose(1, 120), "b"), (3, None, "a"), (4, "", None),
            (5, "  \n\t ", "b"), (None, prose(5, 80), "a"), (None, None, None), (6, long, "a"), (7, long + " tail", "b"),
            (8, "word", "c"), (9, prose(9, 200), None), (10, "é" * 300, "a"), (11, "\n".join(["same line here"] * 50), "c")]
    return make_docs(rows), rows
