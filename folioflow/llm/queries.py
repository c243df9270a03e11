"""One registered query per operator, over its whole table.

Every callable takes ``(spark, sf_dir)``.  ``ORACLE_SQL`` holds the DuckDB
SQL of those that SQL can express; the others are tested against brute-force
versions in ``tests/llm``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from folioflow.llm.block_naming import LOWER, UPPER, exact_groups
from folioflow.llm.html_text import extract_text
from folioflow.llm.jaccard_join import jaccard_components
from folioflow.llm.language import identify_language
from folioflow.llm.lm_difference import score_documents
from folioflow.llm.packing import pack
from folioflow.llm.personal_data import find_personal_data
from folioflow.llm.prefix_hash import fingerprints
from folioflow.llm.repetition import repetition_quality
from folioflow.llm.secrets import find_secrets
from folioflow.llm.sentence_pieces import encode_pieces
from folioflow.llm.token_alignment import align_tokens
from folioflow.llm.whitening import whiten


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(_table(spark, sf_dir, "documents"))


def op2_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_personal_data(_table(spark, sf_dir, "documents"))


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(_table(spark, sf_dir, "documents"))


def op4_lm_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Target: the documents labelled as of good quality."""
    good = _table(spark, sf_dir, "labels").where("quality = 1").select("doc_id")
    return score_documents(_table(spark, sf_dir, "documents"), good)


def op5_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_text(_table(spark, sf_dir, "pages"))


def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_secrets(_table(spark, sf_dir, "documents"))


def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(_table(spark, sf_dir, "documents"))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repetition_quality(_table(spark, sf_dir, "documents"))


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify_language(_table(spark, sf_dir, "documents"))


def op10_sentence_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_pieces(_table(spark, sf_dir, "documents"))


def op11_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(_table(spark, sf_dir, "documents"))


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align_tokens(_table(spark, sf_dir, "documents"))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(_table(spark, sf_dir, "embeddings"))


QUERIES = {
    "op1_fingerprints": op1_fingerprints,
    "op2_personal_data": op2_personal_data,
    "op3_packing": op3_packing,
    "op4_lm_difference": op4_lm_difference,
    "op5_html_text": op5_html_text,
    "op6_secrets": op6_secrets,
    "op7_jaccard_join": op7_jaccard_join,
    "op8_quality": op8_quality,
    "op9_language": op9_language,
    "op10_sentence_pieces": op10_sentence_pieces,
    "op11_exact_dedup": op11_exact_dedup,
    "op12_token_alignment": op12_token_alignment,
    "op13_whitening": op13_whitening,
}

ORACLE_SQL: dict[str, str] = {
    "op11_exact_dedup": f"""
WITH d AS (SELECT doc_id, translate(coalesce(text, ''), '{UPPER}', '{LOWER}') AS t FROM documents)
SELECT doc_id, max(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
  row_number() OVER (PARTITION BY t ORDER BY doc_id DESC NULLS LAST) = 1 AS kept, sha256(t) AS text_sha256
FROM d""",
    # shingles as text, all pairs that share one, and everything reachable by links
    "op7_jaccard_join": f"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents
), s AS (
  SELECT DISTINCT doc_id, array_to_string(w[i : i + 4], ' ') AS shingle
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM d WHERE len(w) > 0)
), n AS (
  SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), shared AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS hits FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY 1, 2
), links AS (
  SELECT x, y FROM shared JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * hits >= 80 * (a.n + b.n - hits)
), edges AS (
  SELECT x, y FROM links UNION ALL SELECT y, x FROM links
), reach AS (
  SELECT doc_id, doc_id AS other FROM d UNION SELECT reach.doc_id, edges.y FROM reach JOIN edges ON reach.other = edges.x
)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, r.component_id
FROM d LEFT JOIN n ON n.doc_id = d.doc_id JOIN (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id) r ON r.doc_id = d.doc_id""",
}
