"""Registered queries on what may land beside the usual pages: unknown keys, retried pages, requests still to make."""

from __future__ import annotations

import contextlib
import io
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from folioflow.options import JobOptions
from folioflow.plans import feeds
from folioflow.plans.feeds import RUN_DATE, RUN_TIMESTAMP
from folioflow.plans.jobs import extract_job, read_transformed_day, transform_job, with_every_key
from folioflow.plans.queries import CONV_C, MANIFEST_BASE_URL
from folioflow.plans.registry import register
from folioflow.session import scratch_path
from folioflow.sources.daily import read_tree
from folioflow.sources.manifest import followup_requests
from folioflow.sources.pages import parse_pages, read_pages, repeated_pages
from folioflow.sources.records import read_records, unknown_keys


def _options(spark: SparkSession, label: str) -> JobOptions:
    return JobOptions(root=scratch_path(spark, label), run_timestamp=RUN_TIMESTAMP, all_pages=True, index_mode="column")


# ------------------------------------------------------------------ keys outside the schema


def _land_extra(spark: SparkSession, sf_dir: str, landing: str) -> None:
    """Pages whose records have more keys: a number for users, a text on even turns, an object on every fifth turn."""
    turn = F.col("turn").cast("bigint")
    extra = {
        "rating": F.when(F.col("role") == "user", turn),
        "note": F.when(turn % 2 == 0, F.col("text")),
        "flags": F.when(turn % 5 == 0, F.struct(F.lit(True).alias("first"), turn.alias("at"))),
    }
    bodies = feeds.conversation_pages(spark, sf_dir, index_in_body=True, extra=extra)
    bodies.select(F.col("body").alias("value")).write.text(landing)


@register(
    "unknown_keys",
    """
SELECT CAST(conv_id AS VARCHAR) AS index, key, kind, count(*) AS records FROM (
  SELECT conv_id, 'rating' AS key, 'BIGINT' AS kind FROM conversations WHERE role = 'user'
  UNION ALL SELECT conv_id, 'note', 'STRING' FROM conversations WHERE turn % 2 = 0
  UNION ALL SELECT conv_id, 'flags', 'OBJECT<at: BIGINT, first: BOOLEAN>' FROM conversations WHERE turn % 5 = 0
) GROUP BY 1, 2, 3""",
)
def q_unknown_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys of the landed records that the fixed schema does not have."""
    landing = f"{scratch_path(spark, 'unknown-keys')}/landing"
    _land_extra(spark, sf_dir, landing)
    return unknown_keys(read_records(spark, landing, multi_line=False))


@register(
    "extra_columns",
    """
SELECT CAST(conv_id AS VARCHAR) AS index, 'T' || CAST(turn AS VARCHAR) AS cod, CAST(length(text) AS DOUBLE) / 100 AS part,
  CASE WHEN turn % 5 = 0 THEN '{"at":' || turn || ',"first":true}' END AS flags,
  CASE WHEN turn % 2 = 0 THEN text END AS note,
  CASE WHEN role = 'user' THEN CAST(turn AS VARCHAR) END AS rating, '25' AS day
FROM conversations""",
)
def q_extra_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every key that the records have becomes a column of the raw day."""
    opts = _options(spark, "extra-columns")
    landing = f"{opts.root}/landing"
    _land_extra(spark, sf_dir, landing)
    opts = with_every_key(spark, landing, opts, multi_line=False)
    extract_job(spark, landing, opts, multi_line=False)
    return read_tree(spark, opts.raw_path, opts.raw_schema).select("index", "cod", "part", "flags", "note", "rating", "day")


# ------------------------------------------------------------------ pages landed again


def _land_again(spark: SparkSession, sf_dir: str, landing: str) -> list[str]:
    """Two fetches: of every third conversation the second repeats the pages as they were, of every other third it
    repeats page 1, which the first fetch got with wrong quantities."""
    conv = F.col("index").cast("bigint") % 3
    bodies = feeds.conversation_pages(spark, sf_dir, index_in_body=True)
    first_page = F.get_json_object("body", "$.page.pageNumber") == "1"
    wrong = F.regexp_replace("body", '"part":"[^"]*"', '"part":"9,99"')
    early = F.when((conv == 1) & first_page, wrong).otherwise(F.col("body"))
    bodies.select(early.alias("value")).write.text(f"{landing}/fetch=1")
    bodies.where((conv == 0) | ((conv == 1) & first_page)).select(F.col("body").alias("value")).write.text(f"{landing}/fetch=2")
    return [f"{landing}/fetch=1", f"{landing}/fetch=2"]


@register(
    "repeated_pages",
    """
SELECT CAST(conv_id AS VARCHAR) AS index, page_number, CAST(2 AS BIGINT) AS copies,
  CASE WHEN conv_id % 3 = 0 THEN 1 ELSE 2 END::BIGINT AS versions, conv_id % 3 = 1 AS conflict
FROM (SELECT DISTINCT conv_id, turn // 3 + 1 AS page_number FROM conversations)
WHERE conv_id % 3 = 0 OR (conv_id % 3 = 1 AND page_number = 1)""",
)
def q_repeated_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages that a retry landed again, and those whose bodies differ."""
    landing = f"{scratch_path(spark, 'again')}/landing"
    return repeated_pages(read_pages(spark, _land_again(spark, sf_dir, landing), multi_line=False))


@register(
    "landed_twice",
    f"""
WITH {CONV_C}
SELECT CAST(conv_id AS VARCHAR) AS index, role AS acao, count(*) AS qtd_codigo,
  CAST(sum(len) AS DOUBLE) / 100 AS participacao,
  CAST(sum(len * 1000) AS BIGINT) AS qtd_teorica_total,
  '2025-07-25' AS data, '2025' AS year, '07' AS month, '25' AS day
FROM c GROUP BY conv_id, role""",
)
def q_landed_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The portfolio of a landing with retries is that of the pages landed once, by their last copy."""
    opts = _options(spark, "landed-twice")
    extract_job(spark, _land_again(spark, sf_dir, f"{opts.root}/landing"), opts, multi_line=False)
    transform_job(spark, opts)
    return read_transformed_day(spark, opts, RUN_DATE)


# ------------------------------------------------------------------ roots and the command line

_PORTFOLIO_OF_CONVERSATIONS = f"""
WITH {CONV_C}
SELECT CAST(conv_id AS VARCHAR) AS index, role AS acao, count(*) AS qtd_codigo,
  CAST(sum(len) AS DOUBLE) / 100 AS participacao,
  CAST(sum(len * 1000) AS BIGINT) AS qtd_teorica_total,
  '2025-07-25' AS data, '2025' AS year, '07' AS month, '25' AS day
FROM c GROUP BY conv_id, role"""


def _land(spark: SparkSession, sf_dir: str, landing: str) -> None:
    feeds.conversation_pages(spark, sf_dir, index_in_body=True).select(F.col("body").alias("value")).write.text(landing)


@register("mounted_root_job", _PORTFOLIO_OF_CONVERSATIONS)
def q_mounted_root_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Extract and transform under a root that is no ``file:`` URI: a mount of Hadoop's view file system, which only Spark opens."""
    place = scratch_path(spark, "mounted")
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    conf.set("fs.viewfs.mounttable.feeds.link./jobs", place if ":" in place else f"file:{place}")
    _land(spark, sf_dir, f"{place}/landing")  # makes the folder behind the mount
    opts = replace(_options(spark, "unused"), root="viewfs://feeds/jobs")
    extract_job(spark, f"{opts.root}/landing", opts, multi_line=False)
    transform_job(spark, opts)
    return read_transformed_day(spark, opts, RUN_DATE)


@register("command_line_job", _PORTFOLIO_OF_CONVERSATIONS)
def q_command_line_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same run by the command line's options alone."""
    from folioflow.__main__ import main

    opts = _options(spark, "command-line")
    landing = f"{opts.root}/landing"
    _land(spark, sf_dir, landing)
    flags = ["--root", opts.root, "--landing", landing, "--json-lines", "--all-pages", "--index-mode", "column"]
    with contextlib.redirect_stdout(io.StringIO()):  # its line of counts
        main(["all", *flags, "--run-timestamp", RUN_TIMESTAMP.isoformat()])
    return read_transformed_day(spark, opts, RUN_DATE)


# ------------------------------------------------------------------ requests still to make

_REQUEST = "json_object('pageNumber', page_number, 'pageSize', 1200, 'language', 'pt-br', 'index', index)::VARCHAR"


@register(
    "followup_requests",
    f"""
WITH p AS (
  SELECT CAST(conv_id AS VARCHAR) AS index, conv_id, turn // 3 + 1 AS page_number,
    (turn >= 3 AND any_value(role) FILTER (WHERE true) = 'user') OR (turn < 3 AND conv_id % 7 = 0) AS lost
  FROM conversations WHERE turn % 3 = 0 GROUP BY conv_id, turn
), w AS (
  SELECT index, page_number FROM p WHERE lost AND conv_id % 7 <> 0
  UNION ALL SELECT index, 1 FROM p WHERE conv_id % 7 = 0 GROUP BY index HAVING bool_or(NOT lost)
)
SELECT index, 'pt-br' AS language, CAST(1200 AS BIGINT) AS page_size, CAST(page_number AS BIGINT) AS page_number,
  {_REQUEST} AS params_json, '{MANIFEST_BASE_URL}/' || to_base64(encode({_REQUEST})) AS url
FROM w""",
)
def q_followup_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests for the pages that the landed ones still lack: 2..totalPages, or page 1 itself."""
    pages = parse_pages(feeds.conversation_pages(spark, sf_dir, drop_some=True), body="body", index="index")
    lost: Column = (F.col("page_number") == 1) & (F.col("index").cast("bigint") % 7 == 0)
    return followup_requests(pages.where(~lost), MANIFEST_BASE_URL, language="pt-br", page_size=1200)
