"""A corpus pipeline: five stages over ``documents``, each written and reread.

``STAGES`` lists (name, function); a function takes ``(spark, docs, sf_dir)``
and returns a DataFrame.  The first four return the columns of ``documents``:

1. language ID: rows without an identified language go;
2. quality rules: rows that the repetition rules reject go;
3. n-gram Jaccard join: one row of each near-duplicate component stays;
4. secret scan: secrets are replaced in the text;
5. packing: one row for each piece of each document.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from folioflow.llm.jaccard_join import keep_one
from folioflow.llm.language import keep_identified
from folioflow.llm.packing import pack
from folioflow.llm.repetition import keep_quality
from folioflow.llm.secrets import redact_secrets
from folioflow.session import scratch_path


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_identified(docs)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_quality(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_one(docs)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return redact_secrets(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack(docs)


STAGES = [
    ("language_id", language_id),
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("secret_scan", secret_scan),
    ("packing", packing),
]

# Models and packing plans are not SQL; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written as Parquet and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
