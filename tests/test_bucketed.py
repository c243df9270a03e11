"""Tables bucketed by asset: results, days, and plans without a shuffle."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from folioflow.operators import portfolio_by_asset, reconcile
from folioflow.operators.clean import conform
from folioflow.schemas import PARTITION_COLUMNS, PORTFOLIO, RAW
from folioflow.sinks import bucket_sizes, create_bucketed, write_bucketed

RUN = "2025-07-25"


def raw(spark, rows):
    """(asset, cod, part, day) as raw rows with their partition columns."""
    full = [("s", c, a, "t", p, None, 1.0, None, None, None, None, None, "2025", "07", d) for a, c, p, d in rows]
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in RAW.fields) + ", year string, month string, day string"
    return spark.createDataFrame(full, schema)


def hash_exchanges(df):
    plan = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    return re.findall(r"Exchange hashpartitioning\([^)]*\)", plan)


@pytest.fixture()
def tables(spark, scratch):
    def make(schema, key, buckets=4):
        path = scratch("bucketed")
        name = f"default.b_{abs(hash(path))}"
        create_bucketed(spark, name, f"file:{path}/t", schema, key, buckets)
        return name

    return make


def test_aggregation_and_backfill_shuffle_nothing(spark, tables):
    name = tables(RAW, "asset")
    rows = [(f"A{i % 5}" if i % 11 else None, f"C{i}", float(i), f"{i % 3 + 1:02d}") for i in range(200)]
    write_bucketed(raw(spark, rows), name)
    table = spark.table(name)
    one, days = portfolio_by_asset(table, RUN), portfolio_by_asset(table, RUN, by=PARTITION_COLUMNS)
    assert hash_exchanges(one) == [] and hash_exchanges(days) == []
    for got, want in ((one, portfolio_by_asset(raw(spark, rows), RUN)), (days, portfolio_by_asset(raw(spark, rows), RUN, by=PARTITION_COLUMNS))):
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    assert sum(r["rows"] for r in bucket_sizes(spark, name).collect()) == 200


def test_reconcile_shuffles_nothing(spark, tables):
    source, stored = tables(RAW, "asset"), tables(PORTFOLIO, "acao")
    rows = [(f"A{i % 7}", f"C{i}", 1.0, "25") for i in range(70)]
    write_bucketed(raw(spark, rows), source)
    part = lambda df: df.withColumns({"year": F.lit("2025"), "month": F.lit("07"), "day": F.lit("25")})
    write_bucketed(part(portfolio_by_asset(raw(spark, rows[:-1]), RUN)), stored)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = reconcile(spark.table(source), spark.table(stored))
        assert hash_exchanges(found) == []
        assert [r["acao"] for r in found.collect()] == ["A6"]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_a_write_replaces_its_days_alone(spark, tables):
    name = tables(RAW, "asset")
    write_bucketed(raw(spark, [("A", "C1", 1.0, "01"), ("A", "C2", 2.0, "02")]), name)
    write_bucketed(raw(spark, [("B", "C3", 3.0, "02"), ("B", "C4", 4.0, "03")]), name)
    assert {(r["day"], r["cod"]) for r in spark.table(name).collect()} == {("01", "C1"), ("02", "C3"), ("03", "C4")}


def test_a_table_without_buckets_is_refused(spark, scratch):
    name = f"default.plain_{abs(hash(scratch('p')))}"
    spark.sql(f"CREATE TABLE {name} (asset string) USING parquet")
    with pytest.raises(ValueError):
        write_bucketed(spark.createDataFrame([("A",)], "asset string"), name)
    spark.sql(f"DROP TABLE {name}")


def test_a_hot_asset_is_written_by_several_tasks(spark, tables):
    name = tables(RAW, "asset")
    rows = spark.range(40_000, numPartitions=8).select(F.lit("HOT").alias("asset"), F.col("id").cast("string").alias("cod"))
    full = conform(rows, RAW, keep=()).withColumns({"year": F.lit("2025"), "month": F.lit("07"), "day": F.lit("25")})
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "32KB")
    try:
        write_bucketed(full, name)
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    table = spark.table(name)
    assert len(table.inputFiles()) > 1
    one = portfolio_by_asset(table, RUN)
    assert hash_exchanges(one) == [] and [(r["acao"], r["qtd_codigo"]) for r in one.collect()] == [("HOT", 40_000)]
