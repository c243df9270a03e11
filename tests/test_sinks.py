"""Daily sinks: one-day overwrite, empty guard, audit, catalog table, CSV, daily reads."""

from __future__ import annotations

import datetime as dt
import os

import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from folioflow.schemas import RAW
from folioflow.sinks import EmptyOutput, append_audit, publish_table, read_audit, read_csv, write_csv, write_daily
from folioflow.sources import PartitionNotFound, read_day, read_days, read_tree

RUN = dt.datetime(2025, 7, 25, 14, 32, 40)


def _raw(spark, asset, n):
    rows = [(None, f"C{i}", asset, "ON", 1.0, None, 10.0, RUN.date(), RUN, None, None, None) for i in range(n)]
    return spark.createDataFrame(rows, RAW)


def test_overwrite_replaces_only_that_day(spark, scratch):
    root = scratch("raw")
    write_daily(_raw(spark, "A", 3), root, "2024-01-15")
    write_daily(_raw(spark, "B", 2), root, "2024-01-16")
    write_daily(_raw(spark, "C", 4), root, "2024-01-15")  # re-run of the 15th
    days = {
        (r.year, r.month, r.day): r.n
        for r in read_tree(spark, root).groupBy("year", "month", "day").agg(F.count(F.lit(1)).alias("n")).collect()
    }
    assert days == {("2024", "01", "15"): 4, ("2024", "01", "16"): 2}
    assert {r.asset for r in read_day(spark, root, "2024-01-15").collect()} == {"C"}
    assert os.path.isdir(os.path.join(root, "year=2024", "month=01", "day=15"))


def test_empty_write_keeps_existing_day(spark, scratch):
    root = scratch("raw")
    write_daily(_raw(spark, "A", 3), root, "2024-01-15")
    with pytest.raises(EmptyOutput):
        write_daily(_raw(spark, "A", 3).where(F.lit(False)), root, "2024-01-15")
    assert read_day(spark, root, "2024-01-15").count() == 3


def test_write_result_counts_rows(spark, scratch):
    root = scratch("raw")
    res = write_daily(_raw(spark, "A", 7), root, dt.date(2024, 2, 1))
    assert res.record_count == 7 and res.partition_date == dt.date(2024, 2, 1) and res.ok


def test_the_columns_of_a_literal_day_are_constants_beyond_the_rebalance(spark, scratch, monkeypatch):
    plans = []
    parquet = DataFrameWriter.parquet

    def kept(writer, path, *args, **kw):
        plans.append(writer._df._jdf.queryExecution().optimizedPlan().toString().splitlines())
        return parquet(writer, path, *args, **kw)

    monkeypatch.setattr(DataFrameWriter, "parquet", kept)
    out, rows = scratch("constant"), spark.range(50)
    assert write_daily(rows, f"file:{out}", "2025-07-25").record_count == 50
    # a writer sorts (holds) the rows of a task by partition columns that it does not know to be constants
    [plan] = plans
    assert plan[0].startswith("Project") and all(f"{v} AS {k}#" in plan[0] for k, v in (("year", "2025"), ("month", "07"), ("day", "25")))
    assert any("RebalancePartitions" in line for line in plan[1:])
    assert read_day(spark, f"file:{out}", "2025-07-25", schema=rows.schema).count() == 50


def test_multi_day_write_from_column(spark, scratch):
    root = scratch("raw")
    df = spark.range(10).select(
        F.col("id"), F.date_add(F.lit(dt.date(2024, 1, 30)), (F.col("id") % 3).cast("int")).alias("d")
    )
    write_daily(df, root, date_col="d")
    got = read_days(spark, root, "2024-01-31", "2024-02-01", schema=df.select("id").schema)
    assert sorted(r.id for r in got.collect()) == [1, 2, 4, 5, 7, 8]


def test_read_day_missing(spark, scratch):
    root = scratch("raw")
    with pytest.raises(PartitionNotFound):
        read_day(spark, root + "/nothing-here", "2024-01-15")
    write_daily(_raw(spark, "A", 1), root, "2024-01-15")
    with pytest.raises(PartitionNotFound):
        read_day(spark, root, "2024-01-16")


def test_day_read_is_pruned(spark, scratch):
    root = scratch("raw")
    write_daily(_raw(spark, "A", 1), root, "2024-01-15")
    write_daily(_raw(spark, "B", 1), root, "2024-01-16")
    files = read_day(spark, root, "2024-01-15").inputFiles()
    assert files and all("year=2024/month=01/day=15" in f for f in files)


def test_audit_appends(spark, scratch):
    root = scratch("audit")
    res = write_daily(_raw(spark, "A", 5), f"{root}/raw", "2024-01-15")
    append_audit(spark, f"{root}/_audit", res, "portfolio-feed", RUN)
    append_audit(spark, f"{root}/_audit", res, "portfolio-feed", RUN)
    rows = read_audit(spark, f"{root}/_audit").collect()
    assert len(rows) == 2
    assert (rows[0].record_count, rows[0].schema_version, rows[0].partition_date) == (5, "1.0", dt.date(2024, 1, 15))


def test_publish_table(spark, scratch):
    root = scratch("tbl")
    write_daily(_raw(spark, "A", 2), root, "2024-01-15")
    write_daily(_raw(spark, "B", 3), root, "2024-01-16")
    name = "folioflow_test.raw_daily_" + os.path.basename(root).replace("-", "_")[-12:]
    t = publish_table(spark, name, root, database_location=scratch("catalog"))
    assert t.where("day = '16'").count() == 3
    assert dict(t.dtypes)["month"] == "string"


def test_republish_to_another_place_returns_its_rows(spark, scratch):
    one, two, name = scratch("raw"), scratch("raw"), "folioflow_test.moved_" + scratch("x").rsplit("-", 1)[-1][:12]
    write_daily(_raw(spark, "A", 1), one, "2024-01-15")
    write_daily(_raw(spark, "B", 5), two, "2024-01-15")
    assert publish_table(spark, name, one, database_location=scratch("catalog")).count() == 1
    assert publish_table(spark, name, two).count() == 5
    assert publish_table(spark, name, two).count() == 5
    assert read_tree(spark, one).count() == 1  # the first tree's files are left alone


def test_null_keys_fail_the_write(spark, scratch):
    df = spark.createDataFrame([(1, dt.date(2024, 1, 15)), (2, None)], "id long, d date")
    with pytest.raises(Exception, match="NULL day"):
        write_daily(df, scratch("raw"), date_col="d")
    df = spark.createDataFrame([(1, "a"), (2, None)], "id long, index string")
    with pytest.raises(Exception, match="NULL index"):
        write_daily(df, scratch("raw"), "2024-01-15", leading=("index",))


def test_open_and_bounded_ranges(spark, scratch):
    root = scratch("raw")
    for day in ("2023-12-31", "2024-01-15", "2025-02-01"):
        write_daily(_raw(spark, "A", 1), root, day)
    from folioflow.sources import read_days

    count = lambda a, b: read_days(spark, root, a, b).count()
    assert (count(None, None), count("2024-01-01", None), count(None, "2024-01-15"), count("2024-01-15", "2024-12-31")) == (3, 2, 2, 1)


def test_csv_roundtrip(spark, scratch):
    path = scratch("csv") + "/out"
    rows = [("A, B", 1.25, 3), ("C", None, 4), (" pad ", 0.0, 5), ('say "x"', 0.0, 6), ("two\nlines", 0.0, 7), ("", 0.0, 8), (None, 0.0, 9), ("back\\slash", 0.0, 10)]
    df = spark.createDataFrame(rows, "a string, b double, c long")
    write_csv(df, path)
    back = read_csv(spark, path, df.schema)
    assert sorted((tuple(r) for r in back.collect()), key=lambda r: r[2]) == rows


def _legacy_day(folder, day, null_segment, unit="ns"):
    """A raw day as the earlier pandas pipeline wrote it (one file, NULL-typed all-NULL columns)."""
    import pandas as pd

    path = os.path.join(folder, f"year={day[:4]}", f"month={day[5:7]}", f"day={day[8:]}")
    os.makedirs(path, exist_ok=True)
    ts = pd.Series([dt.datetime(2025, 7, 25, 14, 32, 40, 123456)] * 2).astype(f"datetime64[{unit}]")
    pd.DataFrame(
        {
            "segment": [None, None] if null_segment else ["N1", None],
            "cod": ["ALOS3", "PETR4"],
            "asset": ["ALLOS", "PETROBRAS"],
            "type": ["ON  NM", "PN"],
            "part": [0.49, 8.75],
            "partAcum": [None, None],
            "theoricalQty": [476976044.0, float("nan")],
            "extraction_date": [dt.date(2025, 7, 25)] * 2,
            "extraction_timestamp": ts,
            "data_date": ["25/07/25"] * 2,
            "total_theoretical_qty": ["1"] * 2,
            "reductor": ["2"] * 2,
        }
    ).to_parquet(os.path.join(path, f"legacy_{day.replace('-', '')}.parquet"), index=False, engine="pyarrow")


def test_migrate_legacy_tree(spark, scratch):
    from folioflow.sources import migrate_legacy_raw

    legacy = scratch("legacy")
    _legacy_day(legacy, "2025-07-24", null_segment=True)
    _legacy_day(legacy, "2025-07-25", null_segment=False, unit="us")
    target = scratch("migrated")
    res = migrate_legacy_raw(spark, legacy, target)
    assert res.record_count == 4
    rows = read_tree(spark, target).orderBy("day", "cod").collect()
    assert [(r.day, r.cod, r.segment) for r in rows] == [
        ("24", "ALOS3", None),
        ("24", "PETR4", None),
        ("25", "ALOS3", "N1"),
        ("25", "PETR4", None),
    ]
    assert {r.extraction_timestamp for r in rows} == {dt.datetime(2025, 7, 25, 14, 32, 40, 123456)}
    assert rows[1].theoricalQty is None  # NaN in pandas → NULL


def test_rewriting_a_day_from_itself_is_safe(spark, scratch):
    """Dynamic overwrite stages the output, so a day rewritten from its own rows survives."""
    root = scratch("raw")
    write_daily(_raw(spark, "A", 5), root, "2024-01-15")
    write_daily(_raw(spark, "B", 2), root, "2024-01-16")
    day = read_day(spark, root, "2024-01-15")
    write_daily(day.drop("year", "month", "day").withColumn("asset", F.lit("A2")), root, "2024-01-15")
    assert [r.asset for r in read_day(spark, root, "2024-01-15").collect()] == ["A2"] * 5
    assert read_day(spark, root, "2024-01-16").count() == 2


def test_legacy_units_are_found_in_one_job_whatever_the_days(spark, scratch):
    from folioflow.sources import read_legacy_tree, row_based_session
    from folioflow.sources.legacy import microsecond_files

    legacy = scratch("legacy")
    days = [f"2025-06-{d:02d}" for d in range(1, 21)]
    for k, day in enumerate(days):  # the writers take turns
        _legacy_day(legacy, day, null_segment=k % 3 == 0, unit="us" if k % 2 else "ns")
    session = row_based_session(spark)
    found = microsecond_files(session, legacy)
    assert sorted(r["file"].split("day=")[1][:2] for r in found.collect()) == [d[-2:] for d in days[1::2]]
    rows = read_legacy_tree(session, legacy)
    assert rows._jdf.queryExecution().executedPlan().toString().count("FileScan parquet") == 1
    assert {r.extraction_timestamp for r in rows.collect()} == {dt.datetime(2025, 7, 25, 14, 32, 40, 123456)} and rows.count() == 40


def test_a_damaged_legacy_file_fails_the_migration(spark, scratch):
    from folioflow.sources import migrate_legacy_raw

    legacy = scratch("legacy")
    _legacy_day(legacy, "2025-07-24", null_segment=True)
    with open(os.path.join(legacy, "year=2025", "month=07", "day=24", "other.parquet"), "wb") as f:
        f.write(b"PAR1 this is no parquet file PAR1")
    with pytest.raises(Exception):
        migrate_legacy_raw(spark, legacy, scratch("migrated"))
