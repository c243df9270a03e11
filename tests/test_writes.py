"""Footer counts, checks while writing, changed days, partitions of one write."""

from __future__ import annotations

import datetime as dt
import os
import time

import pytest
from pyspark.sql import functions as F

from folioflow import JobOptions
from folioflow.__main__ import main
from folioflow.plans import backfill_changed, backfill_transform, changed_days, extract_job, publish, transform_job
from folioflow.schemas import PORTFOLIO, RAW
from folioflow.sinks import (
    ChecksFailed,
    EmptyOutput,
    RowRule,
    append_range_audit,
    portfolio_measures,
    publish_table,
    raw_measures,
    read_audit,
    write_checked,
    write_daily,
)
from folioflow.sinks.gate import Measure, no_nulls, not_empty, total_within
from folioflow.sources import day_files, footer_counts, footer_null_counts, read_day, read_tree
from tests.conftest import land, page_body, record

RUN = dt.datetime(2025, 7, 25, 14, 32, 40)
DAY = dt.date(2025, 7, 25)


def portfolio(spark, rows):
    return spark.createDataFrame(rows, PORTFOLIO)


ROWS = [("A", 1, 60.0, 10, "2025-07-25"), ("B", 2, 40.0, 20, "2025-07-25")]


# ---------------------------------------------------------------- footers


def test_footer_counts_read_no_data(spark, scratch):
    path = f"file:{scratch('tree')}"
    df = spark.range(500).select(
        F.date_add(F.lit(DAY), (F.col("id") % 5).cast("int")).alias("d"), F.when(F.col("id") % 2 == 0, F.col("id")).alias("v"), F.lit(None).cast("string").alias("none")
    )
    written = write_daily(df, path, date_col="d", drop_date_col=True)
    schema = df.select("v", "none").schema
    counts = footer_counts(spark, path, schema)
    plan = counts._jdf.queryExecution().executedPlan().toString()
    assert "PushedAggregation: [COUNT(*)]" in plan and "PushedGroupBy: [year, month, day]" in plan
    assert [tuple(r) for r in counts.orderBy("day").collect()] == [("2025", "07", str(d), 100) for d in range(25, 30)]
    some = footer_counts(spark, path, schema, days=list(written.days[:2]))
    assert sorted(r["day"] for r in some.collect()) == ["25", "26"]
    nulls = footer_null_counts(spark, path, schema)
    plan = nulls._jdf.queryExecution().executedPlan().toString()
    assert "PushedAggregation: [COUNT(*), COUNT(v), COUNT(none)]" in plan
    assert {tuple(r) for r in nulls.collect()} == {("v", 250), ("none", 500)}


def test_footers_agree_with_rows_by_index(spark, scratch):
    path = f"file:{scratch('tree')}"
    df = spark.createDataFrame([("A", 1), ("A", 2), ("B/é x", 3)], "index string, v long")
    written = write_daily(df, path, DAY, leading=("index",))
    assert {d[0] for d in written.days} == {"A", "B/é x"} and {d[1:] for d in written.days} == {("2025", "07", "25")}
    schema = df.select("v").schema
    assert {tuple(r) for r in footer_counts(spark, path, schema, ("index",)).collect()} == {("A", "2025", "07", "25", 2), ("B/é x", "2025", "07", "25", 1)}


def test_range_audit_names_the_days_of_this_write_alone(spark, scratch):
    root = f"file:{scratch('audit')}"
    days = lambda n: spark.range(n).select((F.col("id")).alias("v"), F.date_add(F.lit(DAY), (F.col("id") % 3).cast("int")).alias("d"))
    write_daily(days(30), f"{root}/t", date_col="d", drop_date_col=True)
    second = write_daily(days(7).where("d > '2025-07-25'"), f"{root}/t", date_col="d", drop_date_col=True)
    append_range_audit(spark, f"{root}/a", second, "s", RUN, days(1).select("v").schema)
    got = {(r["partition_date"], r["record_count"]) for r in read_audit(spark, f"{root}/a").collect()}
    assert got == {(dt.date(2025, 7, 26), 2), (dt.date(2025, 7, 27), 2)}


# ---------------------------------------------------------------- checks while writing


def test_a_failing_measure_leaves_the_old_day(spark, scratch):
    path = f"file:{scratch('checked')}"
    written, results = write_checked(portfolio(spark, ROWS), path, DAY, measures=portfolio_measures(0.01))
    assert written.record_count == 2 and all(r.passed for r in results) and results[-1].value == 100.0
    worse = [("A", 1, -60.0, 10, "x"), (None, 2, 40.0, 20, "x")]
    with pytest.raises(ChecksFailed) as stopped:
        write_checked(portfolio(spark, worse), path, DAY, measures=portfolio_measures(0.01))
    failed = {(r.check, r.column_name): r.value for r in stopped.value.results if not r.passed}
    assert failed == {("no_nulls", "acao"): 1.0, ("no_negatives", "participacao"): 1.0, ("total", "participacao"): -20.0}
    assert "no_negatives(participacao) = 1.0" in str(stopped.value)
    assert sorted(r["acao"] for r in read_day(spark, path, DAY, PORTFOLIO).collect()) == ["A", "B"]


def test_a_broken_row_rule_leaves_the_old_day_and_no_file(spark, scratch):
    folder = scratch("rules")
    path = f"file:{folder}"
    rule = RowRule("known asset", ~F.col("acao").isin("A", "B"))
    write_checked(portfolio(spark, ROWS), path, DAY, rules=(rule,))
    before = sorted(f for _, _, names in os.walk(folder) for f in names)
    with pytest.raises(ChecksFailed, match="known asset"):
        write_checked(portfolio(spark, [*ROWS, ("C", 1, 1.0, 1, "x")]), path, DAY, rules=(rule,))
    assert sorted(f for _, _, names in os.walk(folder) for f in names) == before
    write_checked(portfolio(spark, [*ROWS, (None, 1, 1.0, 1, "x")]), path, DAY, rules=(rule,))  # NULL breaks no rule


def test_other_failures_and_empty_results_pass_through(spark, scratch):
    path = f"file:{scratch('other')}"
    with pytest.raises(EmptyOutput):
        write_checked(portfolio(spark, []), path, DAY)
    with pytest.raises(ChecksFailed):
        write_checked(portfolio(spark, []), path, DAY, measures=(not_empty(),))
    with pytest.raises(ChecksFailed) as stopped:
        write_checked(portfolio(spark, []), path, DAY, measures=(total_within("participacao", 100.0, 1.0),))
    assert stopped.value.results[0].value in (None, 0.0)
    boom = portfolio(spark, ROWS).withColumn("acao", F.raise_error(F.lit("something else")).cast("string"))
    with pytest.raises(Exception, match="something else"):
        write_checked(boom, path, DAY, measures=(no_nulls("acao"),))


def test_the_source_is_read_once(spark, scratch):
    """The measures and the write see one evaluation of the plan."""
    calls = spark.sparkContext.accumulator(0)

    def seen(batches):
        for b in batches:
            calls.add(b.num_rows)
            yield b

    df = portfolio(spark, ROWS).mapInArrow(seen, PORTFOLIO)
    write_checked(df, f"file:{scratch('once')}", DAY, measures=(*portfolio_measures(), Measure("rows", None, F.count(F.lit(1)), lambda n: n == 2)))
    assert calls.value == 2


def test_jobs_stop_at_their_checks(spark, scratch):
    folder, root = scratch("landing"), scratch("job")
    opts = JobOptions(root=f"file:{root}", run_timestamp=RUN, index="IBOV")
    land(folder, "page-0001.json", page_body(1, 1, [record(0, part="60,0"), record(1, part="40,0")]))
    extract_job(spark, folder, opts, measures=raw_measures(0.01))
    transform_job(spark, opts, measures=portfolio_measures(0.01))
    bad = scratch("landing")
    land(bad, "page-0001.json", page_body(1, 1, [record(0, part="-60,0"), record(1, cod="None")]))
    for how in ({"measures": raw_measures(0.01)}, {"rules": (RowRule("no negative part", F.col("part") < 0),)}):
        with pytest.raises(ChecksFailed):
            extract_job(spark, bad, opts, **how)
    assert read_day(spark, opts.raw_path, DAY).agg(F.sum("part")).first()[0] == 100.0
    extract_job(spark, bad, opts)
    audits = read_audit(spark, opts.audit_path).count()
    with pytest.raises(ChecksFailed):
        transform_job(spark, opts, measures=portfolio_measures(0.01))
    assert read_audit(spark, opts.audit_path).count() == audits
    assert read_day(spark, opts.transformed_path, DAY, PORTFOLIO).agg(F.sum("participacao")).first()[0] == 100.0


# ---------------------------------------------------------------- changed days


def test_only_changed_days_are_transformed(spark, scratch):
    opts = JobOptions(root=f"file:{scratch('job')}", run_timestamp=RUN)
    raw = lambda part: spark.createDataFrame([("s", "C1", "A", "t", part, None, 1.0, None, None, None, None, None)], RAW)
    for d in ("2025-07-23", "2025-07-24", "2025-07-25"):
        write_daily(raw(1.0), opts.raw_path, d)
    assert [d[-1] for d in changed_days(spark, opts)] == ["23", "24", "25"]
    backfill_transform(spark, opts, "2025-07-23", "2025-07-24")
    assert [d[-1] for d in changed_days(spark, opts)] == ["25"]
    time.sleep(0.02)
    write_daily(raw(5.0), opts.raw_path, "2025-07-23")
    written = backfill_changed(spark, opts)
    assert written.record_count == 2 and [d[-1] for d in written.days] == ["23", "25"]
    got = {r["day"]: r["participacao"] for r in read_tree(spark, opts.transformed_path, PORTFOLIO).collect()}
    assert got == {"23": 5.0, "24": 1.0, "25": 1.0}
    assert backfill_changed(spark, opts) is None
    assert {r["day"] for r in day_files(spark, opts.raw_path).collect()} == {"23", "24", "25"}


def test_nothing_extracted_nothing_changed(spark, scratch):
    opts = JobOptions(root=f"file:{scratch('job')}", run_timestamp=RUN)
    assert changed_days(spark, opts) == [] and backfill_changed(spark, opts) is None


def test_commands_with_checks_and_changed_days(spark, scratch, capsys):
    folder, root = scratch("landing"), scratch("job")
    flags = ["--root", f"file:{root}", "--landing", folder, "--index", "IBOV", "--run-timestamp", RUN.isoformat()]
    land(folder, "page-0001.json", page_body(1, 1, [record(0), record(1)]))
    assert main(["all", *flags, "--checks"])["portfolio_rows"] == 1
    assert main(["backfill", *flags, "--changed"])["days"] == 0
    land(folder, "page-0001.json", page_body(1, 1, [record(0, part="-1,0")]))
    with pytest.raises(ChecksFailed):
        main(["extract", *flags, "--checks"])
    time.sleep(0.02)
    main(["extract", *flags])
    out = main(["backfill", *flags, "--changed"])
    assert (out["days"], out["portfolio_rows"]) == (1, 1)


# ---------------------------------------------------------------- partitions of one write


def test_publish_adds_the_days_of_a_write_without_listing(spark, scratch):
    root = scratch("job")
    opts = JobOptions(root=f"file:{root}", run_timestamp=RUN)
    raw = spark.createDataFrame([("s", "C1", "A", "t", 1.0, None, 1.0, None, None, None, None, None)], RAW)
    name = f"db_{abs(hash(root))}.raw"
    first = write_daily(raw, opts.raw_path, "2025-07-23")
    publish(spark, opts, name, written=first)
    write_daily(raw, opts.raw_path, "2025-07-24")  # not published
    third = write_daily(raw, opts.raw_path, "2025-07-25")
    publish(spark, opts, name, written=third)
    publish(spark, opts, name, written=third)  # again: no harm
    listed = sorted(r[0] for r in spark.sql(f"SHOW PARTITIONS {name}").collect())
    assert listed == ["year=2025/month=07/day=23", "year=2025/month=07/day=25"]
    assert publish(spark, opts, name).count() == 3  # the whole tree


def test_partition_values_are_quoted(spark, scratch):
    path = f"file:{scratch('quoted')}"
    df = spark.createDataFrame([("it's", 1), ("b\\c", 2)], "index string, v long")
    name = f"default.quoted_{abs(hash(path))}"
    for part in ("it's", "b\\c"):
        written = write_daily(df.where(F.col("index") == part), path, DAY, leading=("index",))
        table = publish_table(spark, name, path, df.select("v").schema, ("index",), days=written.days)
    assert sorted((r["index"], r["v"]) for r in table.collect()) == [("b\\c", 2), ("it's", 1)]
    spark.sql(f"DROP TABLE {name}")
