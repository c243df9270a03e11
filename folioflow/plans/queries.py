"""Registered queries over the shared test tables, each with its SQL oracle.

Every query reads whole tables (no id subsets, no row caps) and runs the
library's operators on a feed derived from them (:mod:`folioflow.plans.feeds`).
The oracle (DuckDB SQL) computes the expected result from the *original*
columns.  Column names are the same on both sides.

Queries that write (sinks, jobs) put their files under a fresh path in
the session's shared checkpoint folder.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

from folioflow.functions.dates import partition_columns, iso_date_text, compact_date_text
from folioflow.functions.numbers import group_thousands, parse_number_compat, parse_number_ptbr
from folioflow.functions.text import clean_text
from folioflow.operators.aggregate import portfolio_by_asset
from folioflow.operators.clean import clean_columns, conform
from folioflow.operators.flatten import add_run_metadata, flatten_results
from folioflow.operators.present import top_rows
from folioflow.operators.quality import (
    check_columns_absent,
    check_columns_present,
    check_duplicates,
    check_group_cardinality,
    check_negatives,
    check_not_empty,
    check_nulls,
    distinct_values,
    dtypes_report,
    duplicate_count,
    negative_count,
    null_counts,
    quality_report,
    summary_stats,
    transformed_quality,
    union_all,
)
from folioflow.operators.reconcile import reconcile
from folioflow.options import JobOptions
from folioflow.plans import feeds
from folioflow.plans.feeds import RUN_DATE, RUN_TIMESTAMP, cents, table
from folioflow.plans.registry import register
from folioflow.plans.jobs import backfill_transform, extract_job, read_transformed_day, transform_job
from folioflow.schemas import PARTITION_COLUMNS, PORTFOLIO, RAW
from folioflow.session import scratch_path
from folioflow.sinks.audit import read_audit
from folioflow.sinks.catalog import publish_table
from folioflow.sinks.csv import read_csv, write_csv
from folioflow.sinks.daily import EmptyOutput, write_daily
from folioflow.sources.daily import read_days, read_tree
from folioflow.sources.manifest import request_manifest
from folioflow.sources.pages import (
    consolidated_counts,
    missing_pages,
    parse_pages,
    read_pages,
    select_pages,
    unnumbered_pages,
    usable,
)
from folioflow.streaming.landing import landing_stream

# Request endpoint used by the manifest query (any base works; the token is the contract).
MANIFEST_BASE_URL = "https://feed.example/portfolio"

RAW_TEXT_COLUMNS = ("segment", "cod", "asset", "type", "part", "partAcum", "theoricalQty")


# ------------------------------------------------------------------ SQL snippets
# ``lineitem`` feed as the oracle sees it: original values, NULL where the
# feed injected 'None' or junk.

_CENTS_TEXT = "CAST({c} // 100 AS VARCHAR) || ',' || lpad(CAST({c} % 100 AS VARCHAR), 2, '0')"

LINEITEM_F = """
f AS (
  SELECT
    l_orderkey,
    l_linenumber,
    CASE WHEN l_returnflag = 'N' THEN NULL ELSE l_linestatus END AS segment,
    CASE WHEN l_linenumber = 2 AND l_returnflag = 'R' THEN NULL ELSE CAST(l_partkey AS VARCHAR) END AS cod,
    CASE WHEN l_linenumber = 7 THEN NULL
         WHEN l_linenumber = 5 THEN 'Lote ' || l_returnflag
         ELSE 'Supplier#' || CAST(l_suppkey AS VARCHAR) END AS asset,
    l_returnflag || '  ' || l_linestatus AS type,
    CASE WHEN l_linenumber = 5 THEN NULL ELSE CAST(round(l_discount * 100) AS BIGINT) END AS part_cents,
    CAST(round(l_tax * 100) AS BIGINT) AS tax_cents,
    CASE WHEN l_linenumber = 6 AND l_linestatus = 'O' THEN NULL
         ELSE CAST(round(l_extendedprice * 100) AS BIGINT) END AS qty
  FROM lineitem
)"""

PORTFOLIO_SQL = """
SELECT asset AS acao,
       count(cod) AS qtd_codigo,
       CAST(coalesce(sum(part_cents), 0) AS DOUBLE) / 100 AS participacao,
       CAST(coalesce(sum(qty), 0) AS BIGINT) AS qtd_teorica_total,
       '2025-07-25' AS data
FROM f WHERE asset IS NOT NULL GROUP BY asset"""

CONV_C = """
c AS (
  SELECT conv_id, turn, role, text, length(text) AS len,
         count(*) OVER (PARTITION BY conv_id) AS n
  FROM conversations
)"""


def _lineitem_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_columns(feeds.lineitem_feed(spark, sf_dir))


def _lineitem_portfolio(spark: SparkSession, sf_dir: str) -> DataFrame:
    return portfolio_by_asset(_lineitem_raw(spark, sf_dir), RUN_DATE)


def _conversation_pages(spark: SparkSession, sf_dir: str, drop_some: bool = False) -> DataFrame:
    return parse_pages(feeds.conversation_pages(spark, sf_dir, drop_some=drop_some), body="body", index="index")


# ------------------------------------------------------------------ aggregation


@register("portfolio_by_asset", f"WITH {LINEITEM_F} {PORTFOLIO_SQL}")
def q_portfolio_by_asset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flagship: pt-BR feed → parse/clean → group by asset."""
    return _lineitem_portfolio(spark, sf_dir)


@register(
    "portfolio_by_day_asset",
    """
SELECT strftime(ts, '%Y') AS year, strftime(ts, '%m') AS month, strftime(ts, '%d') AS day,
       event_type AS acao,
       count(user_id) AS qtd_codigo,
       CAST(sum(CAST(round(value * 100) AS BIGINT)) AS DOUBLE) / 100 AS participacao,
       CAST(sum(event_id) AS BIGINT) AS qtd_teorica_total,
       '2025-07-25' AS data
FROM events GROUP BY 1, 2, 3, 4""",
)
def q_portfolio_by_day_asset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G2 range form: raw days written from events, backfilled in one job, read back."""
    opts = JobOptions(root=scratch_path(spark, "by-day"), run_timestamp=RUN_TIMESTAMP)
    ev = clean_columns(feeds.events_feed(spark, sf_dir)).withColumn("extraction_date", F.col("event_date"))
    write_daily(conform(ev, RAW), opts.raw_path, date_col="extraction_date")
    backfill_transform(spark, opts)
    out = read_tree(spark, opts.transformed_path, PORTFOLIO)
    return out.select(*PARTITION_COLUMNS, "acao", "qtd_codigo", "participacao", "qtd_teorica_total", "data")


@register("portfolio_from_stored_raw", f"WITH {LINEITEM_F} {PORTFOLIO_SQL}")
def q_portfolio_from_stored_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The production path on the largest table: the cleaned feed stored as a raw day,
    then the transform job reads that day back (pruned scan) and writes the portfolio."""
    opts = JobOptions(root=scratch_path(spark, "stored-raw"), run_timestamp=RUN_TIMESTAMP)
    raw = add_run_metadata(_lineitem_raw(spark, sf_dir), RUN_TIMESTAMP)
    write_daily(conform(raw, RAW), opts.raw_path, RUN_DATE)
    transform_job(spark, opts)
    return read_transformed_day(spark, opts, RUN_DATE).select(*PORTFOLIO.fieldNames())


# ------------------------------------------------------------------ scalar parsing / cleaning


@register(
    "parse_number_compat",
    f"""
WITH t AS (
  SELECT l_orderkey, l_linenumber,
    CAST(round(l_discount * 100) AS BIGINT) AS dc,
    CAST(round(l_extendedprice * 100) AS BIGINT) AS pc,
    l_returnflag, l_quantity
  FROM lineitem
), s AS (
  SELECT l_orderkey, l_linenumber,
    {_CENTS_TEXT.format(c="dc")} AS t_disc,
    replace(format('{{:,}}', pc), ',', '.') AS t_grouped,
    'R$ ' || {_CENTS_TEXT.format(c="pc")} AS t_money,
    l_returnflag || CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS t_bad,
    '-' || {_CENTS_TEXT.format(c="dc")} AS t_neg
  FROM t
)
SELECT l_orderkey, l_linenumber,
  TRY_CAST(replace(regexp_replace(t_disc, '[^0-9,.\\-]', '', 'g'), ',', '.') AS DOUBLE) AS discount,
  TRY_CAST(replace(regexp_replace(t_grouped, '[^0-9,.\\-]', '', 'g'), ',', '.') AS DOUBLE) AS grouped_cents,
  TRY_CAST(replace(regexp_replace(t_money, '[^0-9,.\\-]', '', 'g'), ',', '.') AS DOUBLE) AS money,
  TRY_CAST(replace(regexp_replace(t_bad, '[^0-9,.\\-]', '', 'g'), ',', '.') AS DOUBLE) AS junk,
  TRY_CAST(replace(regexp_replace(t_neg, '[^0-9,.\\-]', '', 'g'), ',', '.') AS DOUBLE) AS negative
FROM s""",
)
def q_parse_number_compat(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = feeds.dealt_table(spark, sf_dir, "lineitem")
    disc = feeds._comma_cents(cents("l_discount"))
    texts = {
        "discount": disc,
        "grouped_cents": group_thousands(cents("l_extendedprice")),
        "money": F.concat(F.lit("R$ "), feeds._comma_cents(cents("l_extendedprice"))),
        "junk": F.concat(
            F.col("l_returnflag"),
            F.col("l_quantity").cast("bigint").cast("string"),
            F.lit("-"),
            F.col("l_linenumber").cast("string"),
        ),
        "negative": F.concat(F.lit("-"), disc),
    }
    return li.select("l_orderkey", "l_linenumber", *[parse_number_compat(t).alias(n) for n, t in texts.items()])


@register(
    "parse_number_ptbr",
    """
SELECT l_orderkey, l_linenumber,
  CAST(CAST(round(l_extendedprice * 100) AS BIGINT) AS DOUBLE) / 100 AS price,
  -(CAST(CAST(round(l_extendedprice * 100) AS BIGINT) AS DOUBLE) / 100) AS negative_price,
  CAST(round(l_extendedprice * 100) AS BIGINT) AS price_cents,
  CAST(CAST(round(l_discount * 100) AS BIGINT) AS DOUBLE) / 100 AS discount,
  l_quantity AS quantity,
  CAST(NULL AS DOUBLE) AS junk
FROM lineitem""",
)
def q_parse_number_ptbr(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = feeds.dealt_table(spark, sf_dir, "lineitem")
    pc = cents("l_extendedprice")
    grouped_money = F.concat(
        group_thousands((pc / 100).cast("bigint")), F.lit(","), F.lpad((pc % 100).cast("string"), 2, "0")
    )
    return li.select(
        "l_orderkey",
        "l_linenumber",
        parse_number_ptbr(grouped_money).cast("double").alias("price"),
        parse_number_ptbr(F.concat(F.lit("-"), grouped_money)).cast("double").alias("negative_price"),
        parse_number_ptbr(group_thousands(pc)).cast("bigint").alias("price_cents"),
        parse_number_ptbr(feeds._comma_cents(cents("l_discount"))).cast("double").alias("discount"),
        parse_number_ptbr(F.col("l_quantity").cast("string")).cast("double").alias("quantity"),
        parse_number_ptbr(F.concat("l_returnflag", "l_linestatus")).cast("double").alias("junk"),
    )


@register(
    "clean_strings",
    """
SELECT c_custkey, c_name AS name,
  CASE c_nationkey WHEN 3 THEN NULL WHEN 4 THEN 'none' WHEN 5 THEN '' ELSE c_mktsegment END AS segment
FROM customer""",
)
def q_clean_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    nk = F.col("c_nationkey")
    dirty_segment = (
        F.when(nk == 3, F.lit(" None "))
        .when(nk == 4, F.lit("none"))
        .when(nk == 5, F.lit(""))
        .otherwise(F.concat(F.lit("\t"), F.col("c_mktsegment"), F.lit("  ")))
    )
    dirty_name = F.concat(F.lit(feeds.NBSP), F.col("c_name"), F.lit("\n"))
    return c.select("c_custkey", clean_text(dirty_name).alias("name"), clean_text(dirty_segment).alias("segment"))


@register(
    "clean_table",
    f"""
WITH {LINEITEM_F}
SELECT l_orderkey, l_linenumber, segment, cod, asset, type,
  CAST(part_cents AS DOUBLE) / 100 AS part,
  {_CENTS_TEXT.format(c="tax_cents")} AS partAcum,
  CAST(qty AS DOUBLE) AS theoricalQty
FROM f""",
)
def q_clean_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _lineitem_raw(spark, sf_dir).select("l_orderkey", "l_linenumber", *RAW_TEXT_COLUMNS)


# ------------------------------------------------------------------ pages

_PAGE_ROW_SQL = f"""
  CAST(conv_id AS VARCHAR) AS index,
  turn // 3 + 1 AS page_number,
  '2024-01-01' AS data_date,
  replace(format('{{:,}}', n * 1000), ',', '.') AS total_theoretical_qty,
  CAST(n AS VARCHAR) || ',0' AS reductor,
  text AS segment,
  'T' || CAST(turn AS VARCHAR) AS cod,
  ' ' || role || ' ' AS asset,
  upper(substr(role, 1, 2)) || '  NM' AS type,
  {_CENTS_TEXT.format(c="len")} AS part,
  CAST(NULL AS VARCHAR) AS partAcum,
  replace(format('{{:,}}', len * 1000), ',', '.') AS theoricalQty"""


@register("flatten_pages", f"WITH {CONV_C} SELECT {_PAGE_ROW_SQL} FROM c")
def q_flatten_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = usable(_conversation_pages(spark, sf_dir))
    return flatten_results(pages)


@register(
    "first_page_only",
    """
SELECT CAST(conv_id AS VARCHAR) AS index, turn // 3 + 1 AS page_number,
  'T' || CAST(turn AS VARCHAR) AS cod, ' ' || role || ' ' AS asset
FROM conversations WHERE turn < 3""",
)
def q_first_page_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = select_pages(_conversation_pages(spark, sf_dir), all_pages=False)
    return flatten_results(pages).select("index", "page_number", "cod", "asset")


@register(
    "consolidated_count",
    """
SELECT CAST(conv_id AS VARCHAR) AS index,
  count(*) AS total_records,
  count(DISTINCT turn // 3) AS pages_landed,
  CAST(ceil(count(*) / 3) AS BIGINT) AS total_pages
FROM conversations GROUP BY conv_id""",
)
def q_consolidated_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return consolidated_counts(_conversation_pages(spark, sf_dir), all_pages=True)


@register(
    "missing_pages",
    """
SELECT CAST(conv_id AS VARCHAR) AS index, turn // 3 + 1 AS page_number
FROM conversations WHERE turn >= 3 AND turn % 3 = 0 AND role = 'user'""",
)
def q_missing_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return missing_pages(_conversation_pages(spark, sf_dir, drop_some=True))


@register(
    "page_request_manifest",
    f"""
WITH r AS (
  SELECT c_name,
    CASE WHEN c_nationkey < 12 THEN 'pt-br' ELSE 'en-us' END AS lang,
    unnest(range(1, c_nationkey // 5 + 2)) AS p
  FROM customer
)
SELECT c_name AS index, lang AS language, CAST(1200 AS BIGINT) AS page_size, p AS page_number,
  json_object('pageNumber', p, 'pageSize', 1200, 'language', lang, 'index', c_name)::VARCHAR AS params_json,
  '{MANIFEST_BASE_URL}/' || to_base64(encode(json_object('pageNumber', p, 'pageSize', 1200, 'language', lang, 'index', c_name)::VARCHAR)) AS url
FROM r""",
)
def q_page_request_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    req = c.select(
        F.col("c_name").alias("index"),
        F.when(F.col("c_nationkey") < 12, F.lit("pt-br")).otherwise(F.lit("en-us")).alias("language"),
        F.lit(1200).alias("page_size"),
        (F.floor(F.col("c_nationkey") / 5) + 1).alias("total_pages"),
    )
    return request_manifest(req, MANIFEST_BASE_URL)


@register(
    "json_props",
    "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events",
)
def q_json_props(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    return ev.select("event_id", F.from_json("props", "k bigint")["k"].alias("k"))


# ------------------------------------------------------------------ run metadata, partitions


@register(
    "run_metadata",
    """
SELECT o_orderkey,
  DATE '2025-07-25' AS extraction_date,
  TIMESTAMP '2025-07-25 14:32:40' AS extraction_timestamp,
  '2025-07-25' AS data,
  strftime(o_orderdate, '%Y-%m-%d') AS order_day,
  strftime(o_orderdate, '%Y%m%d') AS order_day_compact
FROM orders""",
)
def q_run_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    out = add_run_metadata(o, RUN_TIMESTAMP)
    return out.select(
        "o_orderkey",
        "extraction_date",
        "extraction_timestamp",
        iso_date_text(F.col("extraction_date")).alias("data"),
        iso_date_text(F.col("o_orderdate")).alias("order_day"),
        compact_date_text(F.col("o_orderdate")).alias("order_day_compact"),
    )


@register(
    "partition_columns",
    """
SELECT o_orderkey, strftime(o_orderdate, '%Y') AS year, strftime(o_orderdate, '%m') AS month,
  strftime(o_orderdate, '%d') AS day
FROM orders""",
)
def q_partition_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return o.select("o_orderkey", *[c.alias(n) for n, c in partition_columns(F.to_date("o_orderdate")).items()])


# ------------------------------------------------------------------ sinks and daily reads

ORDERS_DAILY = StructType(
    [
        StructField("o_orderkey", LongType()),
        StructField("o_custkey", LongType()),
        StructField("o_orderstatus", StringType()),
        StructField("o_totalprice", DoubleType()),
        StructField("o_orderpriority", StringType()),
    ]
)

_ORDERS_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority"]


def _write_orders(spark: SparkSession, sf_dir: str, path: str):
    return write_daily(feeds.orders_daily(spark, sf_dir).select(*_ORDERS_COLS, "o_day"), path, date_col="o_day")


@register(
    "daily_roundtrip",
    """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority,
  strftime(o_orderdate, '%Y') AS year, strftime(o_orderdate, '%m') AS month, strftime(o_orderdate, '%d') AS day
FROM orders WHERE o_orderdate >= TIMESTAMP '1997-05-01' AND o_orderdate < TIMESTAMP '1997-06-01'""",
)
def q_daily_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "orders-daily")
    _write_orders(spark, sf_dir, path)
    return read_days(spark, path, "1997-05-01", "1997-05-31", ORDERS_DAILY)


@register(
    "daily_overwrite",
    """
WITH o AS (
  SELECT *, o_orderdate >= TIMESTAMP '1997-05-01' AND o_orderdate < TIMESTAMP '1997-06-01' AS may
  FROM orders
), replaced AS (
  SELECT DISTINCT o_orderdate FROM o WHERE may AND o_orderstatus = 'F'
)
SELECT o_orderkey, o_orderstatus,
  CASE WHEN r.o_orderdate IS NOT NULL THEN o_totalprice * 2 ELSE o_totalprice END AS o_totalprice,
  strftime(o.o_orderdate, '%Y') AS year, strftime(o.o_orderdate, '%m') AS month, strftime(o.o_orderdate, '%d') AS day
FROM o LEFT JOIN replaced r ON o.o_orderdate = r.o_orderdate
WHERE r.o_orderdate IS NULL OR o_orderstatus = 'F'""",
)
def q_daily_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rewrite May 1997 with only its F orders at double price: only days that get rows are replaced."""
    path = scratch_path(spark, "orders-overwrite")
    _write_orders(spark, sf_dir, path)
    daily = feeds.orders_daily(spark, sf_dir)
    may = F.col("o_day").between(F.lit(dt.date(1997, 5, 1)), F.lit(dt.date(1997, 5, 31)))
    redo = daily.where(may & (F.col("o_orderstatus") == "F")).withColumn("o_totalprice", F.col("o_totalprice") * 2)
    write_daily(redo.select(*_ORDERS_COLS, "o_day"), path, date_col="o_day")
    try:  # an empty rewrite of another day must leave it intact
        write_daily(daily.where(F.lit(False)).select(*_ORDERS_COLS, "o_day"), path, dt.date(1997, 6, 1))
    except EmptyOutput:
        pass
    return read_tree(spark, path, ORDERS_DAILY).select(
        "o_orderkey", "o_orderstatus", "o_totalprice", *PARTITION_COLUMNS
    )


@register(
    "csv_roundtrip",
    """
SELECT c_custkey, CASE c_custkey % 7 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN '  ' || c_name || ' '
    WHEN 3 THEN 'a "' || c_name || '", b' WHEN 4 THEN c_name || chr(10) || 'second line' WHEN 5 THEN c_name || '\\"x' ELSE c_name END AS c_name,
  c_nationkey, c_acctbal, c_mktsegment
FROM customer""".replace("\\\\", "\\"),
)
def q_csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text with padding, quotes, commas, line ends, a backslash, nothing, and NULL comes back as it was."""
    name, kind = F.col("c_name"), F.col("c_custkey") % 7
    text = (
        F.when(kind == 0, F.lit(None).cast("string"))
        .when(kind == 1, F.lit(""))
        .when(kind == 2, F.concat(F.lit("  "), name, F.lit(" ")))
        .when(kind == 3, F.concat(F.lit('a "'), name, F.lit('", b')))
        .when(kind == 4, F.concat(name, F.lit("\nsecond line")))
        .when(kind == 5, F.concat(name, F.lit('\\"x')))
        .otherwise(name)
    )
    c = table(spark, sf_dir, "customer").withColumn("c_name", text)
    path = scratch_path(spark, "customer-csv")
    write_csv(c, path)
    schema = StructType(
        [
            StructField("c_custkey", LongType()),
            StructField("c_name", StringType()),
            StructField("c_nationkey", IntegerType()),
            StructField("c_acctbal", DoubleType()),
            StructField("c_mktsegment", StringType()),
        ]
    )
    return read_csv(spark, path, schema)


@register(
    "write_audit",
    """
SELECT 'portfolio-feed' AS source, 'orders' AS target, CAST(o_orderdate AS DATE) AS partition_date,
  TIMESTAMP '2025-07-25 14:32:40' AS run_timestamp, count(*) AS record_count, '1.0' AS schema_version
FROM orders GROUP BY 3""",
)
def q_write_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One audit row per day of a write over all days, every column."""
    from folioflow.options import RAW_SOURCE
    from folioflow.sinks.audit import append_range_audit

    root = scratch_path(spark, "audit")
    result = _write_orders(spark, sf_dir, f"{root}/orders")
    append_range_audit(spark, f"{root}/_audit", result, RAW_SOURCE, RUN_TIMESTAMP, ORDERS_DAILY)
    return read_audit(spark, f"{root}/_audit").withColumn("target", F.substring_index("target", "/", -1))


@register(
    "table_publish",
    """
SELECT strftime(o_orderdate, '%Y') AS year, strftime(o_orderdate, '%m') AS month,
  strftime(o_orderdate, '%d') AS day, count(*) AS n
FROM orders GROUP BY 1, 2, 3""",
)
def q_table_publish(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "orders-table")
    _write_orders(spark, sf_dir, path)
    name = "folioflow_scratch.orders_" + path.rsplit("-", 1)[-1][:12]
    t = publish_table(spark, name, path, ORDERS_DAILY, database_location=scratch_path(spark, "catalog"))
    return t.groupBy(*PARTITION_COLUMNS).agg(F.count(F.lit(1)).alias("n"))


# ------------------------------------------------------------------ checks


@register(
    "reconcile",
    f"""
WITH {LINEITEM_F},
stale AS (
  SELECT * FROM f
  WHERE NOT ((l_linenumber = 4 AND type LIKE 'A%') OR (l_linenumber = 5 AND type LIKE 'R%'))
),
e AS (
  SELECT asset AS acao, count(cod) AS expected_qtd_codigo,
    CAST(coalesce(sum(part_cents), 0) AS DOUBLE) / 100 AS expected_participacao,
    CAST(coalesce(sum(qty), 0) AS BIGINT) AS expected_qtd_teorica_total
  FROM f WHERE asset IS NOT NULL GROUP BY asset
),
a AS (
  SELECT asset AS acao, count(cod) AS actual_qtd_codigo,
    CAST(coalesce(sum(part_cents), 0) AS DOUBLE) / 100 AS actual_participacao,
    CAST(coalesce(sum(qty), 0) AS BIGINT) AS actual_qtd_teorica_total
  FROM stale WHERE asset IS NOT NULL GROUP BY asset
),
j AS (
  SELECT coalesce(e.acao, a.acao) AS acao,
    expected_qtd_codigo, expected_participacao, expected_qtd_teorica_total,
    actual_qtd_codigo, actual_participacao, actual_qtd_teorica_total,
    expected_qtd_codigo IS NOT DISTINCT FROM actual_qtd_codigo AS count_ok,
    coalesce(abs(expected_participacao - actual_participacao) <= 0.01, false) AS participacao_ok,
    expected_qtd_teorica_total IS NOT DISTINCT FROM actual_qtd_teorica_total AS quantity_ok
  FROM e FULL OUTER JOIN a ON e.acao = a.acao
)
SELECT * FROM j WHERE NOT (count_ok AND participacao_ok AND quantity_ok)""",
)
def q_reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    stale = portfolio_by_asset(clean_columns(feeds.lineitem_stale_feed(spark, sf_dir)), RUN_DATE)
    return reconcile(_lineitem_raw(spark, sf_dir), stale, tolerance=0.01)


@register(
    "null_counts",
    f"""
WITH {LINEITEM_F}
SELECT 'segment' AS column_name, count(*) - count(segment) AS null_count FROM f
UNION ALL SELECT 'cod', count(*) - count(cod) FROM f
UNION ALL SELECT 'asset', count(*) - count(asset) FROM f
UNION ALL SELECT 'type', count(*) - count(type) FROM f
UNION ALL SELECT 'part', count(*) - count(part_cents) FROM f
UNION ALL SELECT 'partAcum', count(*) - count(tax_cents) FROM f
UNION ALL SELECT 'theoricalQty', count(*) - count(qty) FROM f""",
)
def q_null_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return null_counts(_lineitem_raw(spark, sf_dir), list(RAW_TEXT_COLUMNS))


@register(
    "duplicate_codes",
    f"""
WITH {LINEITEM_F}
SELECT CAST(count(*) - count(DISTINCT cod) - CASE WHEN count(*) > count(cod) THEN 1 ELSE 0 END AS BIGINT) AS duplicates
FROM f""",
)
def q_duplicate_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return duplicate_count(_lineitem_raw(spark, sf_dir), "cod")


@register(
    "negative_parts",
    "SELECT count(*) FILTER (WHERE c_acctbal < 0) AS negatives FROM customer",
)
def q_negative_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    feed = c.select(feeds._comma_cents(cents("c_acctbal")).alias("part"))
    return negative_count(clean_columns(feed), "part")


@register(
    "group_cardinality",
    f"""
WITH {LINEITEM_F}
SELECT 'group_cardinality' AS "check", 'asset' AS column_name,
  CAST((SELECT count(*) FROM (SELECT asset FROM f WHERE asset IS NOT NULL GROUP BY asset)) AS DOUBLE) AS value,
  (SELECT count(*) FROM (SELECT asset FROM f WHERE asset IS NOT NULL GROUP BY asset)) = count(DISTINCT asset) AS passed
FROM f""",
)
def q_group_cardinality(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = _lineitem_raw(spark, sf_dir)
    return check_group_cardinality(raw, portfolio_by_asset(raw, RUN_DATE))


@register("distinct_values", "SELECT DISTINCT event_type FROM events")
def q_distinct_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return distinct_values(table(spark, sf_dir, "events"), "event_type")


@register(
    "summary_stats",
    f"""
WITH {LINEITEM_F},
m AS (SELECT max(part_cents) AS mx FROM f)
SELECT count(*) AS row_count,
  CAST(9 AS BIGINT) AS column_count,
  CAST(round(CAST(sum(part_cents) AS DECIMAL(38, 0)) / count(part_cents) / 100, 9) AS DOUBLE) AS mean_value,
  CAST(max(part_cents) AS DOUBLE) / 100 AS max_value,
  (SELECT min(cod) FROM f, m WHERE part_cents = mx AND cod IS NOT NULL) AS argmax_label,
  CAST(sum(part_cents) AS DOUBLE) / 100 AS total_value,
  CAST(sum(qty) AS BIGINT) AS total_quantity,
  format('{{:,.3f}}', CAST(sum(part_cents) AS DOUBLE) / 100) AS total_value_text,
  format('{{:,}}', CAST(sum(qty) AS BIGINT)) AS total_quantity_text
FROM f""",
)
def q_summary_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summary_stats(_lineitem_raw(spark, sf_dir))


@register(
    "schema_checks",
    f"""
WITH {LINEITEM_F}
SELECT 'not_empty' AS "check", CAST(NULL AS VARCHAR) AS column_name,
  CAST(least(count(*), 1) AS DOUBLE) AS value, count(*) > 0 AS passed
FROM lineitem WHERE l_linenumber <> 7
UNION ALL SELECT 'columns_present', 'acao', 1.0, true
UNION ALL SELECT 'columns_present', 'qtd_codigo', 1.0, true
UNION ALL SELECT 'columns_present', 'participacao', 1.0, true
UNION ALL SELECT 'columns_present', 'qtd_teorica_total', 1.0, true
UNION ALL SELECT 'columns_present', 'data', 1.0, true
UNION ALL SELECT 'columns_absent', 'segment', 0.0, true
UNION ALL SELECT 'columns_absent', 'type', 0.0, true
UNION ALL SELECT 'columns_absent', 'partAcum', 0.0, true
UNION ALL SELECT 'columns_present', unnest(['acao', 'qtd_codigo', 'participacao', 'qtd_teorica_total', 'data']), 0.0, false
UNION ALL SELECT 'columns_absent', unnest(['segment', 'type', 'partAcum']), 1.0, false
UNION ALL SELECT 'no_nulls', 'cod', CAST(count(*) - count(cod) AS DOUBLE), count(*) = count(cod) FROM f
UNION ALL SELECT 'no_nulls', 'issuer', NULL, false
UNION ALL SELECT 'no_duplicates', 'issuer', NULL, false
UNION ALL SELECT 'no_negatives', 'issuer', NULL, true""",
)
def q_schema_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """On a frame that passes, then on one that fails (raw rows), with columns that are absent."""
    raw = _lineitem_raw(spark, sf_dir)
    result = portfolio_by_asset(raw, RUN_DATE)
    failing = [check_columns_present(raw), check_columns_absent(raw), check_nulls(raw, ("cod", "issuer"))]
    absent = [check_duplicates(raw, "issuer"), check_negatives(raw, "issuer")]
    return union_all([check_not_empty(result), check_columns_present(result), check_columns_absent(result), *failing, *absent])


@register("top_rows", f"WITH {LINEITEM_F} SELECT * FROM ({PORTFOLIO_SQL}) ORDER BY acao LIMIT 3")
def q_top_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_rows(_lineitem_portfolio(spark, sf_dir), 3)


@register(
    "quality_report",
    f"""
WITH {LINEITEM_F},
p AS ({PORTFOLIO_SQL}),
dup AS (SELECT count(*) - count(DISTINCT cod) - CASE WHEN count(*) > count(cod) THEN 1 ELSE 0 END AS d FROM f)
SELECT 'not_empty' AS "check", CAST(NULL AS VARCHAR) AS column_name, CAST(least(count(*), 1) AS DOUBLE) AS value, count(*) > 0 AS passed FROM p
UNION ALL SELECT 'columns_present', 'acao', 1.0, true
UNION ALL SELECT 'columns_present', 'qtd_codigo', 1.0, true
UNION ALL SELECT 'columns_present', 'participacao', 1.0, true
UNION ALL SELECT 'columns_present', 'qtd_teorica_total', 1.0, true
UNION ALL SELECT 'columns_present', 'data', 1.0, true
UNION ALL SELECT 'columns_absent', 'segment', 0.0, true
UNION ALL SELECT 'columns_absent', 'type', 0.0, true
UNION ALL SELECT 'columns_absent', 'partAcum', 0.0, true
UNION ALL SELECT 'group_cardinality', 'asset', CAST(count(*) AS DOUBLE), count(*) = (SELECT count(DISTINCT asset) FROM f) FROM p
UNION ALL SELECT 'reconcile', 'acao', 0.0, true
UNION ALL SELECT 'constant_date', 'data', CAST(count(DISTINCT data) AS DOUBLE), count(DISTINCT data) = 1 AND min(data) = '2025-07-25' FROM p
UNION ALL SELECT 'no_nulls', 'cod', CAST(count(*) - count(cod) AS DOUBLE), count(*) = count(cod) FROM f
UNION ALL SELECT 'no_nulls', 'asset', CAST(count(*) - count(asset) AS DOUBLE), count(*) = count(asset) FROM f
UNION ALL SELECT 'no_duplicates', 'cod', CAST(d AS DOUBLE), d = 0 FROM dup
UNION ALL SELECT 'no_negatives', 'part', CAST(count(*) FILTER (WHERE part_cents < 0) AS DOUBLE), count(*) FILTER (WHERE part_cents < 0) = 0 FROM f
UNION ALL SELECT 'total', 'part', CAST(coalesce(sum(part_cents), 0) AS DOUBLE) / 100, true FROM f""",
)
def q_quality_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = _lineitem_raw(spark, sf_dir)
    return quality_report(raw, portfolio_by_asset(raw, RUN_DATE), RUN_DATE)


# ------------------------------------------------------------------ jobs (G1, G2, G3) and streaming

_RAW_FROM_CONV_SQL = """
  CAST(conv_id AS VARCHAR) AS index,
  text AS segment,
  'T' || CAST(turn AS VARCHAR) AS cod,
  role AS asset,
  upper(substr(role, 1, 2)) || '  NM' AS type,
  CAST(len AS DOUBLE) / 100 AS part,
  CAST(NULL AS VARCHAR) AS partAcum,
  CAST(len * 1000 AS DOUBLE) AS theoricalQty,
  DATE '2025-07-25' AS extraction_date,
  TIMESTAMP '2025-07-25 14:32:40' AS extraction_timestamp,
  {data_date} AS data_date,
  replace(format('{{:,}}', n * 1000), ',', '.') AS total_theoretical_qty,
  CAST(n AS VARCHAR) || ',0' AS reductor"""


def _land_pages(spark: SparkSession, sf_dir: str, landing: str) -> None:
    """Land the responses as JSON Lines, one response per line with its index beside it."""
    bodies = feeds.conversation_pages(spark, sf_dir, index_in_body=True)
    bodies.select(F.col("body").alias("value")).write.mode("overwrite").text(landing)


def _conversation_job_options(spark: SparkSession) -> JobOptions:
    return JobOptions(
        root=scratch_path(spark, "conv-job"),
        run_timestamp=RUN_TIMESTAMP,
        all_pages=True,
        index_mode="column",
    )


@register(
    "extract_job",
    f"WITH {CONV_C} SELECT {_RAW_FROM_CONV_SQL.format(data_date=chr(39) + '2024-01-01' + chr(39))}, "
    "'2025' AS year, '07' AS month, '25' AS day FROM c",
)
def q_extract_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G1 end to end: landed JSON pages → raw daily partition (index kept as a column) → read back."""
    opts = _conversation_job_options(spark)
    landing = f"{opts.root}/landing"
    _land_pages(spark, sf_dir, landing)
    extract_job(spark, landing, opts, multi_line=False)
    return read_tree(spark, opts.raw_path, opts.raw_schema, opts.leading_partitions)


@register(
    "transform_job",
    f"""
WITH {CONV_C}
SELECT CAST(conv_id AS VARCHAR) AS index, role AS acao, count(*) AS qtd_codigo,
  CAST(sum(len) AS DOUBLE) / 100 AS participacao,
  CAST(sum(len * 1000) AS BIGINT) AS qtd_teorica_total,
  '2025-07-25' AS data, '2025' AS year, '07' AS month, '25' AS day
FROM c GROUP BY conv_id, role""",
)
def q_transform_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Extract then transform the run date (per index), read the transformed partition back."""
    opts = _conversation_job_options(spark)
    landing = f"{opts.root}/landing"
    _land_pages(spark, sf_dir, landing)
    extract_job(spark, landing, opts, multi_line=False)
    transform_job(spark, opts)
    return read_transformed_day(spark, opts, RUN_DATE)


@register(
    "landing_stream",
    f"WITH {CONV_C} SELECT {_RAW_FROM_CONV_SQL.format(data_date=chr(39) + '2024-01-01' + chr(39))}, "
    "'2025' AS year, '07' AS month, '25' AS day FROM c",
)
def q_landing_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same landing through the file stream (availableNow): the same rows as the extract job."""
    opts = _conversation_job_options(spark)
    landing = f"{opts.root}/landing"
    _land_pages(spark, sf_dir, landing)
    landing_stream(spark, landing, opts, multi_line=False)
    return read_tree(spark, opts.raw_path, opts.raw_schema, opts.leading_partitions)


# ------------------------------------------------------------------ values and pages outside the usual feed


@register(
    "sum_precision",
    """
SELECT CAST(l_orderkey AS VARCHAR) AS acao, count(*) AS qtd_codigo,
  CAST(CAST(sum(l_partkey % 100000) AS DECIMAL(38, 0)) AS DOUBLE) / 10000000 AS participacao,
  CAST(sum((l_suppkey % 9 + 1) * 10000000000000000) AS BIGINT) AS qtd_teorica_total,
  '2025-07-25' AS data
FROM lineitem GROUP BY l_orderkey""",
)
def q_sum_precision(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values of seven decimals, and values of 1e16 and more: none is rounded or dropped before summing."""
    li = feeds.dealt_table(spark, sf_dir, "lineitem")
    raw = li.select(
        F.col("l_orderkey").cast("string").alias("asset"),
        F.col("l_partkey").cast("string").alias("cod"),
        ((F.col("l_partkey") % 100000).cast("double") / 10000000).alias("part"),
        ((F.col("l_suppkey") % 9 + 1).cast("double") * 1e16).alias("theoricalQty"),
    )
    return portfolio_by_asset(clean_columns(raw), RUN_DATE)


@register(
    "json_number_tokens",
    """
SELECT l_orderkey AS index, l_linenumber AS line,
  CASE WHEN l_linenumber % 2 = 0 THEN CAST(l_partkey AS DOUBLE) / 1000 ELSE CAST(l_partkey * 1000 AS DOUBLE) END AS part,
  CASE WHEN l_linenumber % 3 = 0 THEN CAST(l_suppkey AS DOUBLE) * 10000000000000000 ELSE CAST(l_suppkey AS DOUBLE) / 10000 END AS theoricalQty
FROM (SELECT CAST(l_orderkey AS VARCHAR) AS l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem)""",
)
def q_json_number_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bodies with JSON numbers (of three decimals, of four, very large) beside pt-BR text: each keeps its value."""
    li = feeds.dealt_table(spark, sf_dir, "lineitem")
    three = F.concat((F.col("l_partkey") / 1000).cast("bigint").cast("string"), F.lit("."), F.lpad((F.col("l_partkey") % 1000).cast("string"), 3, "0"))
    four = F.concat((F.col("l_suppkey") / 10000).cast("bigint").cast("string"), F.lit("."), F.lpad((F.col("l_suppkey") % 10000).cast("string"), 4, "0"))
    part = F.when(F.col("l_linenumber") % 2 == 0, three).otherwise(  # a number, else grouped text
        F.concat(F.lit('"'), group_thousands(F.col("l_partkey") * 1000), F.lit('"'))
    )
    qty = F.when(F.col("l_linenumber") % 3 == 0, (F.col("l_suppkey").cast("decimal(20,0)") * 10000000000000000).cast("decimal(38,0)").cast("string")).otherwise(four)
    body = F.concat(
        F.lit('{"page":{"pageNumber":1,"totalPages":1},"results":[{"cod":"'), F.col("l_linenumber").cast("string"),
        F.lit('","part":'), part, F.lit(',"theoricalQty":'), qty, F.lit("}]}"),
    )
    pages = parse_pages(li.select(F.col("l_orderkey").cast("string").alias("index"), body.alias("body")), index="index")
    rows = clean_columns(flatten_results(select_pages(pages, all_pages=False), header_from_first_page=False))
    return rows.select("index", F.col("cod").cast("int").alias("line"), "part", "theoricalQty")


def _odd_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The conversation pages, page 1 of every third conversation without its ``results``."""
    pages = _conversation_pages(spark, sf_dir)
    bare = (F.col("page_number") == 1) & (F.col("index").cast("bigint") % 3 == 0)
    return pages.withColumn("results", F.when(~bare, F.col("results")))


_ODD_C = f"""WITH {CONV_C}, u AS (SELECT * FROM c WHERE NOT (turn < 3 AND conv_id % 3 = 0))"""


@register("first_page_without_results", f"{_ODD_C} SELECT {_PAGE_ROW_SQL} FROM u")
def q_first_page_without_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page 1 without ``results`` has no rows; its header and page count still serve the other pages."""
    return flatten_results(select_pages(_odd_pages(spark, sf_dir), all_pages=True))


@register(
    "written_counts",
    f"""{_ODD_C}
SELECT a.index, coalesce(b.total_records, 0) AS total_records, a.pages_landed, a.total_pages FROM
  (SELECT CAST(conv_id AS VARCHAR) AS index, count(DISTINCT turn // 3) AS pages_landed,
     CAST(ceil(count(*) / 3) AS BIGINT) AS total_pages FROM c GROUP BY conv_id) a
  LEFT JOIN (SELECT CAST(conv_id AS VARCHAR) AS index, count(*) AS total_records FROM u GROUP BY conv_id) b ON a.index = b.index""",
)
def q_written_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The counts of a run are those of the rows it writes."""
    return consolidated_counts(_odd_pages(spark, sf_dir))


@register(
    "selected_index",
    """
SELECT 'T' || CAST(turn AS VARCHAR) AS cod, role AS asset, CAST(length(text) AS DOUBLE) / 100 AS part, '2025' AS year
FROM conversations WHERE conv_id = (SELECT min(conv_id) FROM conversations)""",
)
def q_selected_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A landing of many indices, a layout without an index: the run takes its own index only."""
    first = table(spark, sf_dir, "conversations").agg(F.min("conv_id").cast("string").alias("i")).first()["i"]
    opts = JobOptions(root=scratch_path(spark, "one-index"), run_timestamp=RUN_TIMESTAMP, all_pages=True, index=first)
    landing = f"{opts.root}/landing"
    _land_pages(spark, sf_dir, landing)
    extract_job(spark, landing, opts, multi_line=False)
    return read_tree(spark, opts.raw_path).select("cod", "asset", "part", "year")


@register(
    "unnumbered_pages",
    """
SELECT CAST(conv_id AS VARCHAR) AS index, count(*) AS total_records
FROM conversations WHERE conv_id % 2 = 0 GROUP BY conv_id, turn // 3""",
)
def q_unnumbered_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON Lines bodies without a page number are reported (never numbered after their file)."""
    bodies = feeds.conversation_pages(spark, sf_dir, index_in_body=True)
    record_count = F.size(F.from_json("body", "results array<string>")["results"])
    line = F.when(
        F.col("index").cast("bigint") % 2 == 0,
        F.concat(F.lit('{"index":"'), F.col("index"), F.lit('","page":{"totalRecords":'), record_count.cast("string"), F.lit('},"results":[]}')),
    ).otherwise(F.col("body"))
    landing = f"{scratch_path(spark, 'unnumbered')}/landing"
    bodies.select(line.alias("value")).write.text(landing)
    return unnumbered_pages(read_pages(spark, landing, multi_line=False))


@register("dtypes_report", """
SELECT unnest(['acao', 'qtd_codigo', 'participacao', 'qtd_teorica_total', 'data']) AS column_name,
  unnest(['string', 'bigint', 'double', 'bigint', 'string']) AS dtype
FROM (SELECT count(*) AS n FROM lineitem) WHERE n > 0""")
def q_dtypes_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dtypes_report(_lineitem_portfolio(spark, sf_dir))


@register(
    "transformed_quality",
    f"""
WITH {LINEITEM_F}, p AS ({PORTFOLIO_SQL})
SELECT 'no_nulls' AS "check", 'acao' AS column_name, CAST(count(*) - count(acao) AS DOUBLE) AS value, count(*) = count(acao) AS passed FROM p
UNION ALL SELECT 'no_nulls', 'qtd_codigo', CAST(count(*) - count(qtd_codigo) AS DOUBLE), count(*) = count(qtd_codigo) FROM p
UNION ALL SELECT 'no_nulls', 'participacao', CAST(count(*) - count(participacao) AS DOUBLE), count(*) = count(participacao) FROM p
UNION ALL SELECT 'no_nulls', 'qtd_teorica_total', CAST(count(*) - count(qtd_teorica_total) AS DOUBLE), count(*) = count(qtd_teorica_total) FROM p
UNION ALL SELECT 'no_nulls', 'data', CAST(count(*) - count(data) AS DOUBLE), count(*) = count(data) FROM p
UNION ALL SELECT 'total', 'participacao', CAST(sum(part_cents) AS DOUBLE) / 100, true FROM f WHERE asset IS NOT NULL
UNION ALL SELECT 'total', 'qtd_teorica_total', CAST(sum(qty) AS DOUBLE), true FROM f WHERE asset IS NOT NULL
UNION ALL SELECT 'columns_present', unnest(['acao', 'qtd_codigo', 'participacao', 'qtd_teorica_total', 'data']), 1.0, true""",
)
def q_transformed_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transformed_quality(_lineitem_portfolio(spark, sf_dir))
