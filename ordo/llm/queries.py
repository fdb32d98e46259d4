"""Registered queries of the training-data operators and their SQL oracles."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ordo.llm import bpe
from ordo.llm.ann import nearest
from ordo.llm.hard_negatives import hard_negatives
from ordo.llm.html_extract import extract_main_text
from ordo.llm.line_dedup import dedup_lines
from ordo.llm.minhash_dedup import near_duplicates
from ordo.llm.mixing import plan_mix
from ordo.llm.packing import pack_documents
from ordo.llm.prefix_trie import prefix_trie
from ordo.llm.quality_mil import score_quality
from ordo.llm.quality_rules import judge_texts
from ordo.llm.secret_scan import scan_secrets, span_digest
from ordo.llm.substring_dedup import dedup_substrings
from ordo.llm.tables import table

VOCABULARY = "word_bpe_49k.json"


def op1_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate groups of all documents (4-word shingles, similarity 0.8)."""
    found = near_duplicates(table(spark, sf_dir, "documents"), k=4)
    return found.withColumnRenamed("id", "doc_id")


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Boilerplate lines (on 10 or more sources) removed from every document."""
    return dedup_lines(table(spark, sf_dir, "documents")).selectExpr(
        "row.doc_id AS doc_id", "n_lines", "n_removed", "clean_text AS text")


def op3_quality_mil(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return score_quality(docs, labels).withColumnRenamed("id", "doc_id")


def op4_bpe(spark: SparkSession, sf_dir: str, vocabulary: str | None = None) -> DataFrame:
    """Token ids of every document and their decoded text, as digests."""
    path = vocabulary or public_tokenizers.path(VOCABULARY)
    return bpe.encode_texts(table(spark, sf_dir, "documents"), path,
                            outputs=("n_tokens", "ids_sha256", "decoded_sha256")).withColumnRenamed("id", "doc_id")


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measures of every document and the verdict of the voting rules."""
    return judge_texts(table(spark, sf_dir, "documents")).select(
        F.col("id").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "posterior")


def op6_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    found = extract_main_text(table(spark, sf_dir, "pages"))
    return found.select("row.page_id", "row.url", F.col("main_text").alias("text"),
                        F.length("main_text").cast("long").alias("n_chars"))


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the 200-byte strings that occur twice."""
    found = dedup_substrings(table(spark, sf_dir, "documents"))
    gone = F.aggregate("removed", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return found.select(F.col("id").alias("doc_id"), "n_bytes", gone.alias("n_removed"),
                        F.size("removed").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every document, counted and digested."""
    found = scan_secrets(table(spark, sf_dir, "documents"))
    kinds = {"n_assign": "assign", "n_access": "access", "n_hex": "hex"}
    base = F.filter("spans", lambda s: s["kind"].isin(*kinds.values()))
    return found.select(
        F.col("id").alias("doc_id"),
        *[F.expr(f"cast(size(filter(spans, s -> s.kind = '{k}')) as bigint)").alias(n) for n, k in kinds.items()],
        F.sha2(span_digest(base), 256).alias("base_sha256"), span_digest(F.col("spans")).alias("spans"))


def op9_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mix of all sources: words taken of every document."""
    return plan_mix(table(spark, sf_dir, "documents")).selectExpr(
        "doc_id", "size", "source_size", "target", "size * copies AS taken")


def op10_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five nearest vectors of every vector whose id is divisible by 50."""
    vectors = table(spark, sf_dir, "embeddings")
    return nearest(vectors, vectors.filter("vec_id % 50 = 0"), k=5)


def op11_hilbert_packing(spark: SparkSession, sf_dir: str, vocabulary: str | None = None) -> DataFrame:
    """The pieces of all documents in sequences of 2,048 token ids."""
    path = vocabulary or public_tokenizers.path(VOCABULARY)
    return pack_documents(table(spark, sf_dir, "documents"), path).withColumnRenamed("id", "doc_id")


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every vector whose id is divisible by 100."""
    return hard_negatives(table(spark, sf_dir, "embeddings"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All nodes of the trie of rebuilt conversations."""
    return prefix_trie(table(spark, sf_dir, "conversations"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_minhash_dedup": op1_minhash_dedup,
    "op2_line_dedup": op2_line_dedup,
    "op3_quality_mil": op3_quality_mil,
    "op4_bpe": op4_bpe,
    "op5_quality_rules": op5_quality_rules,
    "op6_html_extract": op6_html_extract,
    "op7_substring_dedup": op7_substring_dedup,
    "op8_secret_scan": op8_secret_scan,
    "op9_source_mix": op9_source_mix,
    "op10_nearest": op10_nearest,
    "op11_hilbert_packing": op11_hilbert_packing,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_prefix_trie": op13_prefix_trie,
}

# CRC-32 of an ASCII text: a byte is taken in, then eight bits are shifted out
_SQL_CRC32 = """xor(4294967295, list_reduce(
    list_prepend(CAST(4294967295 AS BIGINT), flatten(list_transform(
        string_split({text}, ''), lambda x: list_prepend(CAST(ascii(x) AS BIGINT), list_value(-1, -1, -1, -1, -1, -1, -1, -1))))),
    lambda crc, x: CASE WHEN x >= 0 THEN xor(crc, x)
                        WHEN crc & 1 = 1 THEN xor(crc >> 1, 3988292384) ELSE crc >> 1 END))"""

_DISTINCT_LINES = """
    SELECT DISTINCT doc_id, source, trim(line) AS line
    FROM (SELECT doc_id, source, unnest(string_split(text, chr(10))) AS line FROM documents)
    WHERE length(trim(line)) > 0"""

ORACLE_SQL: dict[str, str] = {
    "op2_line_dedup": f"""
    WITH spread AS (
      SELECT line FROM ({_DISTINCT_LINES}) GROUP BY line
      HAVING count(DISTINCT coalesce('=' || source, 'null')) >= 10),
    lines AS (
      SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
             generate_subscripts(string_split(text, chr(10)), 1) AS n FROM documents),
    marked AS (
      SELECT l.doc_id, l.n, l.line, s.line IS NOT NULL AS hit
      FROM lines l LEFT JOIN spread s ON trim(l.line) = s.line),
    per AS (
      SELECT doc_id, count(*) AS n_lines, count(*) FILTER (hit) AS hits,
             coalesce(string_agg(line, chr(10) ORDER BY n) FILTER (NOT hit), '') AS rest
      FROM marked GROUP BY doc_id)
    SELECT d.doc_id, coalesce(n_lines, 0) AS n_lines,
           coalesce(hits, 0) AS n_removed,
           CASE WHEN hits > 0 THEN rest ELSE d.text END AS text
    FROM documents d LEFT JOIN per USING (doc_id)""",
    "op9_source_mix": r"""
    WITH counted AS (
      SELECT doc_id, source, md5(coalesce(CAST(doc_id AS VARCHAR), ':' || text, '')) AS key,
             CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size
      FROM documents),
    numbered AS (
      SELECT *, row_number() OVER (PARTITION BY doc_id, source, key, size) AS copy FROM counted),
    sized AS (
      SELECT doc_id, source, size, CASE WHEN copy = 1 THEN key ELSE md5(key || ':' || copy) END AS key
      FROM numbered),
    per AS (
      SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
             CAST([5, 2, 1][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS DOUBLE) AS weight
      FROM sized GROUP BY source),
    levels AS (
      SELECT *, (sum(source_size) OVER () * 1.5::DOUBLE
                 - coalesce(sum(2 * source_size) OVER (f ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
                / sum(weight) OVER (f ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
      FROM per WINDOW f AS (ORDER BY CAST(2 * source_size AS DOUBLE) / weight, source NULLS LAST)),
    targets AS (
      SELECT source, source_size, least(CAST(2 * source_size AS DOUBLE), weight * max(level) OVER ()) AS target
      FROM levels),
    uses AS (
      SELECT s.*, t.source_size, t.target, p.pass,
             (p.pass * t.source_size + sum(s.size) OVER (PARTITION BY s.source, p.pass ORDER BY key, doc_id, size
              ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) / t.target AS finish
      FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source, (VALUES (0), (1)) p(pass)),
    merged AS (
      SELECT *, sum(size) OVER (ORDER BY finish, key, doc_id, size, pass
                                ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
                <= 1.5::DOUBLE * (SELECT sum(source_size) FROM targets) AS taken
      FROM uses)
    SELECT doc_id, size, source_size, target, CAST(sum(CASE WHEN taken THEN size ELSE 0 END) AS BIGINT) AS taken
    FROM merged GROUP BY doc_id, source, key, size, source_size, target""",
    "op12_hard_negatives": """
    WITH parts AS (
      SELECT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
             list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
      FROM embeddings
      WHERE label IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    scores AS (
      SELECT a.id AS anchor_id, b.id, a.label = b.label AS same, CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
      FROM parts a JOIN parts b ON a.id <> b.id AND len(a.v) = len(b.v) WHERE a.id % 100 = 0),
    positives AS (
      SELECT anchor_id, id AS positive_id, score AS positive_score FROM scores WHERE same
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
    SELECT anchor_id, positive_id,
           CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id) AS INTEGER) AS rank,
           id AS negative_id, positive_score, score AS negative_score
    FROM positives JOIN scores USING (anchor_id)
    WHERE NOT same AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
    QUALIFY rank <= 5""",
    "op13_prefix_trie": rf"""
    WITH told AS (
      SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text, turn
      FROM conversations WHERE conv_id IS NOT NULL),
    turns AS (
      SELECT c, md5(key) AS k, len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS words,
             row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, sha256(key)) AS pos
      FROM (SELECT *, strlen(role) || ':' || role || text AS key FROM told)),
    own AS (SELECT c, count(*) AS n, {_SQL_CRC32.format(text="CAST(c AS VARCHAR)")} % 4 AS h FROM turns GROUP BY c),
    given AS (
      SELECT own.c, t.pos AS d, t.k, t.words FROM own JOIN turns t ON t.c = own.c - own.c % 20 AND t.pos <= h),
    convs AS (
      SELECT own.c, n, h, count(given.c) AS given FROM own LEFT JOIN given ON given.c = own.c GROUP BY ALL),
    rebuilt AS (
      SELECT * FROM given UNION ALL
      SELECT c, given + pos - h, k, words FROM turns JOIN convs USING (c) WHERE pos > h),
    paths AS (
      SELECT c, d, words, string_agg(k, '') OVER (PARTITION BY c ORDER BY d) AS path FROM rebuilt
      UNION ALL SELECT c, 0, 0, '' FROM convs),
    nodes AS (
      SELECT path, d, min(c) AS conv_id, count(*) AS n_convs, (count(*) - 1) * any_value(words) AS saved
      FROM paths GROUP BY path, d),
    kids AS (
      SELECT substr(path, 1, 32 * (d - 1)) AS path, count(*) AS n_children FROM nodes WHERE d > 0 GROUP BY 1),
    below AS (
      SELECT substr(path, 1, 32 * a) AS path, sum(saved) AS saved_tokens, count(*) FILTER (n_children IS NULL) AS n_leaves
      FROM (SELECT n.*, k.n_children, unnest(range(0, d + 1)) AS a FROM nodes n LEFT JOIN kids k USING (path)) GROUP BY 1),
    ends AS (
      SELECT path, sha256(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c)) AS ends_sha256
      FROM (SELECT c, arg_max(path, d) AS path FROM paths GROUP BY c) GROUP BY path)
    SELECT n.conv_id, CAST(n.d AS BIGINT) AS depth, p.conv_id AS parent_conv_id, n.n_convs,
           coalesce(n_children, 0) AS n_children, n_leaves, CAST(saved_tokens AS BIGINT) AS saved_tokens,
           coalesce(ends_sha256, sha256('')) AS ends_sha256
    FROM nodes n JOIN below USING (path) LEFT JOIN kids USING (path) LEFT JOIN ends USING (path)
    LEFT JOIN nodes p ON n.d > 0 AND p.path = substr(n.path, 1, 32 * (n.d - 1))""",
}
