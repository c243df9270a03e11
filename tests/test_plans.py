"""Physical-plan properties that matter at scale: pruning, partial aggregation, no cartesian joins."""

from __future__ import annotations

import datetime as dt
import json

from pyspark.sql import functions as F

from folioflow.operators import portfolio_by_asset, quality_report
from folioflow.schemas import RAW
from folioflow.sinks import write_daily
from folioflow.sources import parse_pages, read_day, select_pages
from folioflow.operators import flatten_results
from tests.conftest import page_body, record

RUN = dt.datetime(2025, 7, 25, 14, 32, 40)


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _optimized(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def _skewed_raw(spark, n=30000):
    """One asset holds a third of the rows (the rest spread over 1000 assets)."""
    return spark.range(0, n, 1, 8).select(
        F.lit(None).cast("string").alias("segment"),
        F.concat(F.lit("C"), (F.col("id") % 97).cast("string")).alias("cod"),
        F.when(F.col("id") % 3 == 0, F.lit("HOT")).otherwise(F.concat(F.lit("A"), (F.col("id") % 1000).cast("string"))).alias(
            "asset"
        ),
        F.lit("ON").alias("type"),
        (F.col("id") % 7 / 100).cast("double").alias("part"),
        F.lit(None).cast("string").alias("partAcum"),
        (F.col("id") % 11).cast("double").alias("theoricalQty"),
        F.lit(RUN.date()).alias("extraction_date"),
        F.lit(RUN).cast("timestamp_ntz").alias("extraction_timestamp"),
        F.lit(None).cast("string").alias("data_date"),
        F.lit(None).cast("string").alias("total_theoretical_qty"),
        F.lit(None).cast("string").alias("reductor"),
    )


def test_transform_reads_only_needed_columns_of_one_day(spark, scratch):
    root = scratch("plan")
    write_daily(_skewed_raw(spark, 3000), root, "2025-07-24")
    write_daily(_skewed_raw(spark, 3000), root, "2025-07-25")
    result = portfolio_by_asset(read_day(spark, root, "2025-07-25", RAW), RUN.date())
    plan = _plan(result)
    files = read_day(spark, root, "2025-07-25", RAW).inputFiles()
    assert files and all("/day=25/" in f for f in files)  # the file index is opened on the day's directory
    read_schema = plan[plan.index("ReadSchema") :].split("\n")[0] if "ReadSchema" in plan else plan
    for unused in ("segment", "partAcum", "extraction_timestamp", "reductor"):
        assert unused not in read_schema, read_schema
    assert result.count() == 1 + 1000


def test_hot_asset_is_reduced_before_the_shuffle(spark):
    raw = _skewed_raw(spark)
    result = portfolio_by_asset(raw, RUN.date())
    plan = _plan(result)
    # partial aggregate below the exchange: the hot key is combined per task
    assert "partial_count" in plan and "Exchange hashpartitioning(asset" in plan
    hot = result.where("acao = 'HOT'").first()
    assert hot.qtd_codigo == 10000
    # exact decimal sums: parts are i%7/100 over ids 0,3,6,...
    want = sum((i % 7) for i in range(0, 30000, 3)) / 100
    assert abs(hot.participacao - want) < 1e-9


def test_quality_report_has_no_cartesian_or_nested_loop_join(spark):
    raw = _skewed_raw(spark, 3000)
    report = quality_report(raw, portfolio_by_asset(raw, RUN.date()), RUN.date())
    plan = _plan(report)
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    rows = {(r.check, r.column_name): r.passed for r in report.collect()}
    assert rows[("reconcile", "acao")] and rows[("group_cardinality", "asset")]
    assert not rows[("no_duplicates", "cod")]


def test_json_bodies_are_parsed_once(spark):
    bodies = spark.createDataFrame(
        [("IBOV", json.dumps(page_body(n, 2, [record(n)]))) for n in (1, 2)], "index string, body string"
    )
    rows = flatten_results(select_pages(parse_pages(bodies), all_pages=True))
    optimized = _optimized(rows)
    # the header frame is stored; the pages' own side parses once and is not shuffled
    assert optimized.count("from_json(") == 1, optimized
    assert "Exchange hashpartitioning" not in _plan(rows)
    assert rows.count() == 2


def test_page_one_needs_no_join(spark):
    bodies = spark.createDataFrame([("IBOV", json.dumps(page_body(1, 2, [record(1)])))], "index string, body string")
    rows = flatten_results(select_pages(parse_pages(bodies), all_pages=False), header_from_first_page=False)
    assert "Join" not in _plan(rows) and "Exchange" not in _plan(rows)
    assert rows.count() == 1


def test_many_headers_are_joined_by_a_split_key(spark, monkeypatch):
    from folioflow.operators import flatten

    monkeypatch.setattr(flatten, "BROADCAST_HEADERS", 0)
    bodies = spark.createDataFrame([("IBOV", json.dumps(page_body(n, 90, [record(n)]))) for n in range(1, 91)], "index string, body string")
    rows = flatten_results(select_pages(parse_pages(bodies), all_pages=True))
    assert "page_bucket" in _optimized(rows)
    assert rows.count() == 90


def test_one_day_is_not_hashed_on_its_date(spark, scratch):
    from pyspark.sql import functions as F  # noqa: PLC0415

    root = scratch("one-day")
    key = "spark.sql.adaptive.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "false")
    try:
        write_daily(spark.range(0, 100_000, 1, 8).select("id", F.sha2(F.col("id").cast("string"), 256).alias("payload")), root, "2025-07-25")
    finally:
        spark.conf.set(key, before)
    import os

    day = os.path.join(root, "year=2025", "month=07", "day=25")
    assert len([f for f in os.listdir(day) if f.endswith(".parquet")]) > 1  # dealt to several tasks even without adaptive execution


def test_no_python_udfs_in_registered_plans(spark):
    import __spark_entry__ as entry

    for name in ("portfolio_by_asset", "clean_table", "quality_report", "reconcile", "flatten_pages"):
        plan = _plan(entry.queries()[name](spark, "/root/testdata/sf0.001"))
        assert "PythonUDF" not in plan and "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan, name


def test_hot_day_is_written_by_several_tasks(spark, scratch):
    """A day holding most rows is split by the rebalance, not written by one task."""
    import os

    root = scratch("hot-day")
    df = spark.range(0, 200_000, 1, 8).select(
        F.col("id"),
        F.when(F.col("id") % 10 < 8, F.lit(dt.date(2025, 7, 25)))
        .otherwise(F.date_add(F.lit(dt.date(2025, 7, 1)), (F.col("id") % 20).cast("int")))
        .alias("d"),
        F.sha2(F.col("id").cast("string"), 256).alias("payload"),
    )
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, "512KB")
    try:
        res = write_daily(df, root, date_col="d")
    finally:
        spark.conf.set(key, before)
    assert res.record_count == 200_000
    hot = os.path.join(root, "year=2025", "month=07", "day=25")
    files = [f for f in os.listdir(hot) if f.endswith(".parquet")]
    assert len(files) > 1, files
