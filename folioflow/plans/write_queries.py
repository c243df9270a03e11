"""Registered queries on writes: footer counts, checks that gate a write, changed days, partitions of one write."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioflow.functions.dates import partition_columns
from folioflow.operators.aggregate import portfolio_by_asset
from folioflow.operators.clean import clean_columns, conform
from folioflow.operators.quality import union_all
from folioflow.operators.reconcile import reconcile
from folioflow.options import JobOptions
from folioflow.plans import feeds
from folioflow.plans.feeds import RUN_DATE, RUN_TIMESTAMP
from folioflow.plans.jobs import audit_rows, backfill_changed, backfill_transform
from folioflow.plans.queries import LINEITEM_F, ORDERS_DAILY, PORTFOLIO_SQL, _lineitem_portfolio, _lineitem_raw, _write_orders
from folioflow.plans.registry import ORACLE_SQL, register
from folioflow.schemas import PARTITION_COLUMNS, PORTFOLIO, RAW
from folioflow.session import scratch_path
from folioflow.sinks.bucketed import create_bucketed, write_bucketed
from folioflow.sinks.catalog import publish_table
from folioflow.sinks.daily import write_daily
from folioflow.sinks.gate import ChecksFailed, RowRule, check_rows, portfolio_measures, write_checked
from folioflow.sources.daily import read_day, read_tree
from folioflow.sources.footers import footer_counts, footer_null_counts

BUCKETS = 8  # of the bucketed queries, at least
BUCKET_ROWS = 500_000  # rows of a bucket beyond that, on average

# ------------------------------------------------------------------ counts out of footers


@register(
    "footer_counts",
    """
SELECT strftime(o_orderdate, '%Y') AS year, strftime(o_orderdate, '%m') AS month, strftime(o_orderdate, '%d') AS day,
  count(*) AS record_count
FROM orders GROUP BY 1, 2, 3""",
)
def q_footer_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of every day of a tree, read from the footers alone."""
    path = scratch_path(spark, "footer-orders")
    _write_orders(spark, sf_dir, path)
    return footer_counts(spark, path, ORDERS_DAILY)


_RAW_COLUMNS = RAW.fieldNames()


@register(
    "footer_null_counts",
    f"""
WITH {LINEITEM_F}
SELECT unnest({_RAW_COLUMNS!r}) AS column_name,
  unnest([count(*) - count(segment), count(*) - count(cod), count(*) - count(asset), count(*) - count(type), count(*) - count(part_cents),
    count(*) - count(tax_cents), count(*) - count(qty), count(*), count(*), count(*), count(*), count(*)]) AS null_count
FROM f""",
)
def q_footer_null_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """NULLs of every column of a stored raw day, read from the footers alone."""
    path = scratch_path(spark, "footer-raw")
    write_daily(conform(_lineitem_raw(spark, sf_dir), RAW), path, RUN_DATE)
    return footer_null_counts(spark, path)


# ------------------------------------------------------------------ checks while writing (Q1, Q7, Q9, Q10 in G1, G2)


@register(
    "checked_write",
    f"""
WITH {LINEITEM_F}, p AS ({PORTFOLIO_SQL})
SELECT 'first' AS write, 'not_empty' AS "check", NULL AS column_name, CAST(count(*) AS DOUBLE) AS value, count(*) > 0 AS passed FROM p
UNION ALL SELECT 'first', 'no_nulls', 'acao', 0.0, true
UNION ALL SELECT 'first', 'no_nulls', 'participacao', 0.0, true
UNION ALL SELECT 'first', 'no_negatives', 'participacao', 0.0, true
UNION ALL SELECT 'first', 'total', 'participacao', CAST(sum(part_cents) AS DOUBLE) / 100, true FROM f WHERE asset IS NOT NULL
UNION ALL SELECT 'second', 'not_empty', NULL, CAST(count(*) AS DOUBLE), true FROM p
UNION ALL SELECT 'second', 'no_nulls', 'acao', 0.0, true
UNION ALL SELECT 'second', 'no_nulls', 'participacao', 0.0, true
UNION ALL SELECT 'second', 'no_negatives', 'participacao', CAST(count(*) AS DOUBLE), false FROM p WHERE participacao > 1
UNION ALL SELECT 'second', 'total', 'participacao', CAST(sum(CASE WHEN t > 100 THEN -t ELSE t END) AS DOUBLE) / 100, true
  FROM (SELECT coalesce(sum(part_cents), 0) AS t FROM f WHERE asset IS NOT NULL GROUP BY asset)""",
)
def q_checked_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The checks of a portfolio write that passes, and of one that is stopped by negative participations."""
    path = scratch_path(spark, "checked")
    good = _lineitem_portfolio(spark, sf_dir)
    first = write_checked(good, path, RUN_DATE, measures=portfolio_measures())[1]
    try:
        write_checked(_spoiled(good), path, RUN_DATE, measures=portfolio_measures())
        second = ()
    except ChecksFailed as stopped:
        second = stopped.results
    named = [check_rows(spark, r).withColumn("write", F.lit(n)) for n, r in (("first", first), ("second", second))]
    return union_all(named).select("write", "check", "column_name", "value", "passed")


def _spoiled(portfolio: DataFrame) -> DataFrame:
    p = F.col("participacao")
    return portfolio.withColumn("participacao", F.when(p > 1, -p).otherwise(p))


@register("stopped_write", f"WITH {LINEITEM_F}, p AS ({PORTFOLIO_SQL}) SELECT p.*, '2025' AS year, '07' AS month, '25' AS day FROM p")
def q_stopped_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A day after two writes that were stopped (by a measure, by a row rule) is the day before them."""
    path = scratch_path(spark, "stopped")
    good = _lineitem_portfolio(spark, sf_dir)
    write_daily(good, path, RUN_DATE)
    rule = RowRule("participation is not negative", F.col("participacao") < 0)
    for how in ({"measures": portfolio_measures()}, {"rules": (rule,)}):
        try:
            write_checked(_spoiled(good), path, RUN_DATE, **how)
        except ChecksFailed:
            continue
        raise AssertionError(f"not stopped by {how}")
    return read_day(spark, path, RUN_DATE, PORTFOLIO)


# ------------------------------------------------------------------ days that changed


def _raw_by_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events feed as a raw tree, a day for each event date."""
    return conform(clean_columns(feeds.events_feed(spark, sf_dir)), RAW, keep=("event_date",))


_EVENTS = """
e AS (
  SELECT event_type, user_id, CAST(round(value * 100) AS BIGINT) AS cents, event_id, CAST(ts AS DATE) AS d,
    CAST(ts AS DATE) = (SELECT max(CAST(ts AS DATE)) FROM events) AS last
  FROM events
)"""


@register(
    "changed_days",
    f"""
WITH {_EVENTS}
SELECT event_type AS acao, count(user_id) * CASE WHEN last THEN 2 ELSE 1 END AS qtd_codigo,
  CAST(coalesce(sum(cents), 0) * CASE WHEN last THEN 2 ELSE 1 END AS DOUBLE) / 100 AS participacao,
  CAST(sum(event_id) * CASE WHEN last THEN 2 ELSE 1 END AS BIGINT) AS qtd_teorica_total, '2025-07-25' AS data,
  strftime(d, '%Y') AS year, strftime(d, '%m') AS month, strftime(d, '%d') AS day
FROM e GROUP BY event_type, d, last""",
)
def q_changed_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A tree transformed whole, one raw day written again (twice its rows): only that day is transformed again."""
    opts, _ = _changed(spark, sf_dir)
    return read_tree(spark, opts.transformed_path, PORTFOLIO)


@register(
    "changed_days_audit",
    f"""
WITH {_EVENTS}
SELECT d AS partition_date, n * runs AS record_count, runs
FROM (SELECT d, count(DISTINCT event_type) AS n, CASE WHEN last THEN 2 ELSE 1 END AS runs FROM e GROUP BY d, last)""",
)
def q_changed_days_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The audit shows which days each run wrote: all of them, then the changed one."""
    opts, runs = _changed(spark, sf_dir)
    assert runs == 2
    rows = audit_rows(spark, opts).groupBy("partition_date")
    return rows.agg(F.sum("record_count").alias("record_count"), F.count(F.lit(1)).alias("runs"))


def _changed(spark: SparkSession, sf_dir: str) -> tuple[JobOptions, int]:
    opts = JobOptions(root=scratch_path(spark, "changed"), run_timestamp=RUN_TIMESTAMP)
    raw = _raw_by_day(spark, sf_dir)
    write_daily(raw, opts.raw_path, date_col="event_date", drop_date_col=True)
    backfill_transform(spark, opts)
    last = raw.agg(F.max("event_date").alias("d")).first()["d"]
    again = raw.where(F.col("event_date") == F.lit(last))
    write_daily(again.union(again), opts.raw_path, date_col="event_date", drop_date_col=True)
    runs = 1 + (backfill_changed(spark, opts) is not None)
    assert backfill_changed(spark, opts) is None  # nothing is left to do
    return opts, runs


# ------------------------------------------------------------------ partitions of one write


@register(
    "publish_written_days",
    """
SELECT strftime(o_orderdate, '%Y') AS year, strftime(o_orderdate, '%m') AS month, strftime(o_orderdate, '%d') AS day, count(*) AS n
FROM orders WHERE o_orderdate >= TIMESTAMP '1997-01-01' AND o_orderdate < TIMESTAMP '1998-01-01' GROUP BY 1, 2, 3""",
)
def q_publish_written_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table that gets the partitions of each write as it reports them, without listing the tree."""
    path = scratch_path(spark, "written-days")
    name = "folioflow_scratch.written_" + path.rsplit("-", 1)[-1][:12]
    home = scratch_path(spark, "catalog")
    orders = feeds.orders_daily(spark, sf_dir).where(F.col("o_day").between(F.lit(dt.date(1997, 1, 1)), F.lit(dt.date(1997, 12, 31))))
    table = None
    for half in (F.month("o_day") <= 6, F.month("o_day") > 6):
        written = write_daily(orders.where(half), path, date_col="o_day", drop_date_col=True)
        table = publish_table(spark, name, path, ORDERS_DAILY, database_location=home, days=written.days)
    return table.groupBy(*PARTITION_COLUMNS).agg(F.count(F.lit(1)).alias("n"))


# ------------------------------------------------------------------ a layout that saves the shuffle


def _buckets(spark: SparkSession, sf_dir: str) -> int:
    """Buckets by the number of rows (which is in the footers), so a bucket does not grow with the table."""
    return max(BUCKETS, -(-feeds.table(spark, sf_dir, "lineitem").count() // BUCKET_ROWS))


def _bucketed_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cleaned feed as a raw day of a table bucketed by asset."""
    path = scratch_path(spark, "bucketed-raw")
    name = "folioflow_scratch_b.raw_" + path.rsplit("-", 1)[-1][:12]
    create_bucketed(spark, name, path, RAW, "asset", _buckets(spark, sf_dir))
    write_bucketed(conform(_lineitem_raw(spark, sf_dir), RAW).withColumns(partition_columns(F.lit(RUN_DATE))), name)
    return spark.table(name)


@register("bucketed_portfolio", f"WITH {LINEITEM_F} {PORTFOLIO_SQL}")
def q_bucketed_portfolio(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The portfolio of a raw day that lies by asset: no shuffle after the scan."""
    return portfolio_by_asset(_bucketed_raw(spark, sf_dir), RUN_DATE)


@register("bucketed_reconcile", ORACLE_SQL["reconcile"])
def q_bucketed_reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stored portfolio against its raw rows, both by asset: neither the aggregation nor the join shuffles."""
    path = scratch_path(spark, "bucketed-portfolio")
    name = "folioflow_scratch_b.portfolio_" + path.rsplit("-", 1)[-1][:12]
    stale = portfolio_by_asset(clean_columns(feeds.lineitem_stale_feed(spark, sf_dir)), RUN_DATE)
    create_bucketed(spark, name, path, PORTFOLIO, "acao", _buckets(spark, sf_dir))
    write_bucketed(stale.withColumns(partition_columns(F.lit(RUN_DATE))), name)
    return reconcile(_bucketed_raw(spark, sf_dir), spark.table(name), tolerance=0.01)
