"""The corpus pipeline: ``documents`` to token ids, in five stages.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame that is
written as Parquet to the shared folder and reread as the next stage's
``docs``. All stages but the last return the columns of ``documents``.

1. quality      documents that the quality classifier rejects go
2. lines        boilerplate lines leave the texts; every document stays
3. near_dups    one document of each group of near-duplicates stays
4. mix          documents as often as the mix of sources uses them
5. tokens       token ids, with their count and digests
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ordo.llm import bpe
from ordo.llm.line_dedup import dedup_lines
from ordo.llm.minhash_dedup import near_duplicates
from ordo.llm.mixing import mix_sources
from ordo.llm.quality_mil import ACCEPT, fit_quality, quality_score
from ordo.llm.tables import materialize, release, table

VOCABULARY = "word_bpe_49k.json"


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the classifier accepts, as they are. Null and empty texts get the
    score of a text without words; repeated rows are judged alike; an empty table
    gives no rows; column names cannot clash."""
    model = fit_quality(docs, table(spark, sf_dir, "labels"))
    row = F.struct("*").alias("row")  # clashing names cannot arise
    scored = docs.select(row, quality_score(model).alias("score"))
    return scored.filter(F.col("score") >= ACCEPT).select("row.*")


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The text without boilerplate lines; ``n_chars`` follows where a text changed. A
    copied page stays whole for the next stage, which keeps one of its copies. Null
    texts stay null; other columns keep their names and values."""
    cleaned = dedup_lines(docs, keep_copies=True)
    changed = F.col("n_removed") > 0
    new = {"text": F.when(changed, F.col("clean_text")).otherwise(F.col("row.text")),
           "n_chars": F.when(changed, F.length("clean_text").cast("long")).otherwise(F.col("row.n_chars"))}
    return cleaned.select(*[new.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])


def near_dups(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Five-word shingles, similarity 0.8. Every row is a node of its own, also
    where ids are null or repeat; of a group the row with the smallest id stays
    (null ids last), of rows with that id the first as written here."""
    rows = materialize(docs.select(F.struct("*").alias("row"),  # written: the numbers must not change
                                   F.monotonically_increasing_id().alias("id")), "numbered")
    found = near_duplicates(rows.select("id", F.col("row.text").alias("text")), k=5, id_col="id")
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "id")
    of = rows.select("id", F.col("row.doc_id").alias("doc_id"))
    stay = found.select("id", "component_id").join(of, "id").groupBy("component_id").agg(F.min_by("id", order).alias("id"))
    return rows.join(stay.select("id"), "id", "left_semi").select("row.*")


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows as often as the mix uses them, as they are; rows without words follow
    their place in the mix. An empty table gives no rows."""
    return mix_sources(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The ids themselves, their count, and digests of ids and decoded text."""
    return bpe.encode_texts(docs, public_tokenizers.path(VOCABULARY),
                            outputs=("n_tokens", "ids", "ids_sha256", "decoded_sha256")).withColumnRenamed("id", "doc_id")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality), ("lines", lines), ("near_dups", near_dups), ("mix", mix), ("tokens", tokens),
]

# SQL cannot express the fitted classifier; tests hold each stage against a plain version instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = table(spark, sf_dir, "documents"), []
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
        release(*before)  # a stage's input goes when its output is written
        before = [docs]
    return STAGES[-1][1](spark, docs, sf_dir)
