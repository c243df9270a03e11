"""Jobs end to end: extract, transform, pipeline, backfill, publish, streaming ingest."""

from __future__ import annotations

import datetime as dt
import json

import pytest

from folioflow.options import JobOptions
from folioflow.plans import backfill_transform, extract_job, publish, read_transformed_day, run_all, transform_job
from folioflow.sinks import EmptyOutput, read_audit
from folioflow.sources import PartitionNotFound, read_day, read_tree
from folioflow.streaming import landing_stream
from tests.conftest import land, page_body, record, three_pages

RUN = dt.datetime(2025, 7, 25, 14, 32, 40)


def _opts(root, **kw):
    return JobOptions(root=root, run_timestamp=RUN, **kw)


def _land_three(folder):
    for n, recs in three_pages():
        land(folder, f"page-{n:04d}.json", page_body(n, 3, recs))


def test_extract_then_transform(spark, scratch):
    root = scratch("job")
    _land_three(f"{root}/landing")
    opts = _opts(root, all_pages=True)
    report, written = run_all(spark, f"{root}/landing", opts)
    assert report.write.record_count == 134
    assert report.missing_pages.count() == 0
    raw = read_day(spark, opts.raw_path, RUN.date())
    assert raw.count() == 134
    out = read_transformed_day(spark, opts, RUN.date())
    assert written.record_count == out.count() == 67
    row = out.where("acao = 'ASSET 0'").first()
    assert (row.qtd_codigo, row.participacao, row.qtd_teorica_total, row.data) == (2, 0.98, 953952088, "2025-07-25")
    audit = read_audit(spark, opts.audit_path).collect()
    assert sorted(r.record_count for r in audit) == [67, 134]


def test_extract_reports_unparsed_numbers(spark, scratch):
    root = scratch("job")
    recs = [record(1), record(2, part="n/d"), record(3, theoricalQty="None"), record(4, part="1,2,3")]
    land(f"{root}/landing", "page-0001.json", page_body(1, 1, recs))
    report = extract_job(spark, f"{root}/landing", _opts(root))
    got = {r.column_name: r.unparsed for r in report.unparsed_numbers.collect()}
    assert got == {"part": 2, "theoricalQty": 0}


def test_first_page_only_by_default(spark, scratch):
    root = scratch("job")
    _land_three(f"{root}/landing")
    report = extract_job(spark, f"{root}/landing", _opts(root))
    assert report.write.record_count == 50


def test_transform_with_source_and_target_dates(spark, scratch):
    root = scratch("job")
    _land_three(f"{root}/landing")
    opts = _opts(root, all_pages=True)
    extract_job(spark, f"{root}/landing", opts, partition_day="2025-07-20")
    transform_job(spark, opts, source_date="2025-07-20", target_date="2025-07-21")
    out = read_transformed_day(spark, opts, "2025-07-21")
    assert out.count() == 67
    assert {r.data for r in out.select("data").distinct().collect()} == {"2025-07-25"}
    with pytest.raises(PartitionNotFound):
        transform_job(spark, opts, source_date="2025-07-22")


def test_nothing_landed_usable_fails_and_keeps_data(spark, scratch):
    root = scratch("job")
    _land_three(f"{root}/landing")
    opts = _opts(root, all_pages=True)
    extract_job(spark, f"{root}/landing", opts)
    land(f"{root}/landing2", "page-0002.json", page_body(2, 3, [record(1)]))  # no page 1
    with pytest.raises(EmptyOutput):
        extract_job(spark, f"{root}/landing2", opts)
    assert read_day(spark, opts.raw_path, RUN.date()).count() == 134


def test_two_indices_partitioned_by_index(spark, scratch):
    root = scratch("job")
    for idx in ("IBOV", "SMLL"):
        lines = "\n".join(json.dumps(page_body(n, 3, recs)) for n, recs in three_pages())
        land(f"{root}/landing", f"index={idx}/pages.json", lines)
    opts = _opts(root, all_pages=True, index_mode="partition")
    extract_job(spark, f"{root}/landing", opts, multi_line=False)
    transform_job(spark, opts)
    out = read_transformed_day(spark, opts, RUN.date())
    assert {r["index"]: r.n for r in out.groupBy("index").count().withColumnRenamed("count", "n").collect()} == {
        "IBOV": 67,
        "SMLL": 67,
    }


def test_two_indices_as_column(spark, scratch):
    root = scratch("job")
    for idx in ("IBOV", "SMLL"):
        lines = "\n".join(json.dumps(page_body(n, 3, recs)) for n, recs in three_pages())
        land(f"{root}/landing", f"index={idx}/pages.json", lines)
    opts = _opts(root, all_pages=True, index_mode="column")
    extract_job(spark, f"{root}/landing", opts, multi_line=False)
    transform_job(spark, opts)
    out = read_transformed_day(spark, opts, RUN.date())
    assert out.columns[0] == "index"
    assert {r["index"]: r.n for r in out.groupBy("index").count().withColumnRenamed("count", "n").collect()} == {
        "IBOV": 67,
        "SMLL": 67,
    }
    import os

    assert not any(name.startswith("index=") for name in os.listdir(opts.raw_path))


def test_backfill_range(spark, scratch):
    root = scratch("job")
    _land_three(f"{root}/landing")
    opts = _opts(root, all_pages=True)
    for day in ("2025-07-20", "2025-07-21", "2025-07-23"):
        extract_job(spark, f"{root}/landing", opts, partition_day=day)
    res = backfill_transform(spark, opts, "2025-07-20", "2025-07-22")
    assert res.record_count == 2 * 67
    days = {(r.day) for r in read_tree(spark, opts.transformed_path).select("day").distinct().collect()}
    assert days == {"20", "21"}


def test_publish_registers_partitions(spark, scratch):
    root = scratch("job")
    _land_three(f"{root}/landing")
    opts = _opts(root, all_pages=True)
    extract_job(spark, f"{root}/landing", opts)
    t = publish(spark, opts, "folioflow_jobs.raw_" + root.rsplit("-", 1)[-1][:10])
    assert t.count() == 134


def test_landing_stream_gives_the_rows_of_the_extract(spark, scratch):
    root = scratch("stream")
    _land_three(f"{root}/landing")
    opts = _opts(root, all_pages=True)
    assert landing_stream(spark, f"{root}/landing", opts).write.record_count == 134
    # a page beyond totalPages is staged but not used, and the day is replaced, not doubled
    land(f"{root}/landing", "page-0009.json", page_body(9, 9, [record(500)]))
    landing_stream(spark, f"{root}/landing", opts)
    assert read_tree(spark, opts.raw_path).count() == 134
    # page 1 alone is the default of both
    other = _opts(scratch("stream"))
    assert landing_stream(spark, f"{root}/landing", other).write.record_count == 50


def test_stream_then_batch_on_one_root(spark, scratch):
    root = scratch("stream")
    _land_three(f"{root}/landing")
    opts = _opts(root, all_pages=True)
    landing_stream(spark, f"{root}/landing", opts)
    extract_job(spark, f"{root}/landing", opts, partition_day="2025-07-26")
    assert read_tree(spark, opts.raw_path).count() == 268
    assert read_day(spark, opts.raw_path, "2025-07-25").count() == read_day(spark, opts.raw_path, "2025-07-26").count() == 134


def test_one_index_is_taken_from_a_landing_of_several(spark, scratch):
    root = scratch("job")
    for idx in ("IBOV", "SMLL"):
        land(f"{root}/landing/index={idx}", "page-0001.json", page_body(1, 1, [record(1 if idx == "IBOV" else 2)]))
    opts = _opts(root, index="SMLL")
    assert extract_job(spark, f"{root}/landing", opts).write.record_count == 1
    assert [r.cod for r in read_day(spark, opts.raw_path, RUN.date()).collect()] == ["C002"]


def test_losses_are_reported(spark, scratch):
    root = scratch("job")
    lines = [page_body(1, 3, [record(1)]), {"page": {"totalPages": 1}, "results": [record(2)]}, page_body(2, 3, [record(3, part="n/d")])]
    land(f"{root}/landing", "part-00007.jsonl", "\n".join(json.dumps(x) for x in lines))
    report = extract_job(spark, f"{root}/landing", _opts(root, all_pages=True), multi_line=False)
    assert report.write.record_count == 2
    assert report.losses() == {
        "missing_pages": 1, "missing_first_pages": 0, "unnumbered_pages": 1, "unparsed_part": 1, "unparsed_theoricalQty": 0
    }
    one = extract_job(spark, f"{root}/landing", _opts(scratch("job")), multi_line=False)
    assert one.write.record_count == 1 and one.losses()["missing_pages"] == 0
    assert {r.total_records for r in one.counts.collect()} == {1}


def test_all_uses_one_day(spark, scratch):
    from folioflow.__main__ import main

    root = scratch("cli")
    _land_three(f"{root}/landing")
    out = main(["all", "--landing", f"{root}/landing", "--all-pages", "--day", "2025-07-24", "--root", root, "--run-timestamp", RUN.isoformat()])
    assert (out["raw_records"], out["portfolio_rows"]) == (134, 67)
    assert read_transformed_day(spark, _opts(root), "2025-07-24").count() == 67


def test_manifest_command(spark, scratch):
    from folioflow.__main__ import main

    root = scratch("cli")
    args = ["manifest", "--base-url", "https://h/x", "--total-pages", "3", "--all-pages", "--page-size", "50", "--language", "en-us", "--index", "SMLL"]
    out = main([*args, "--root", root])
    rows = spark.read.parquet(out["path"]).orderBy("page_number").collect()
    assert out["requests"] == 3 and [r.page_number for r in rows] == [1, 2, 3]
    assert {(r["index"], r.language, r.page_size) for r in rows} == {("SMLL", "en-us", 50)}


def test_backfill_audits_every_day(spark, scratch):
    root = scratch("job")
    _land_three(f"{root}/landing")
    opts = _opts(root, all_pages=True)
    for day in ("2025-07-20", "2025-07-21"):
        extract_job(spark, f"{root}/landing", opts, partition_day=day)
    backfill_transform(spark, opts)
    rows = [r for r in read_audit(spark, opts.audit_path).collect() if r.target == opts.transformed_path]
    assert sorted((str(r.partition_date), r.record_count) for r in rows) == [("2025-07-20", 67), ("2025-07-21", 67)]


def test_command_line(spark, scratch):
    from folioflow.__main__ import main

    root = scratch("cli")
    _land_three(f"{root}/landing")
    common = ["--root", root, "--run-timestamp", RUN.isoformat()]
    out = main(["all", "--landing", f"{root}/landing", "--all-pages", *common])
    assert (out["raw_records"], out["missing_pages"], out["portfolio_rows"]) == (134, 0, 67)
    out = main(["backfill", "--start", "2025-07-01", "--end", "2025-07-31", *common])
    assert out["portfolio_rows"] == 67
    out = main(["transform", "--source-date", "2025-07-25", "--target-date", "2025-07-26", *common])
    assert out["portfolio_rows"] == 67
    table = "folioflow_cli.raw_" + root.rsplit("-", 1)[-1][:10]
    out = main(["publish", "--table", table, *common])
    assert out["rows"] == 134


def test_landing_stream_index_from_directories(spark, scratch):
    root = scratch("stream")
    for idx in ("IBOV", "007"):
        for n, recs in three_pages():
            land(f"{root}/landing/index={idx}", f"page-{n:04d}.json", page_body(n, 3, recs))
    opts = _opts(root, all_pages=True, index_mode="column")
    landing_stream(spark, f"{root}/landing", opts)
    got = {r["index"]: r.n for r in read_tree(spark, opts.raw_path, opts.raw_schema).groupBy("index").count()
           .withColumnRenamed("count", "n").collect()}
    assert got == {"IBOV": 134, "007": 134}


def test_backfill_per_index_column(spark, scratch):
    root = scratch("job")
    for idx in ("IBOV", "SMLL"):
        lines = "\n".join(json.dumps({"index": idx, **page_body(n, 3, recs)}) for n, recs in three_pages())
        land(f"{root}/landing", f"{idx}.jsonl", lines)
    opts = _opts(root, all_pages=True, index_mode="column")
    for day in ("2025-07-20", "2025-07-21"):
        extract_job(spark, f"{root}/landing", opts, multi_line=False, partition_day=day)
    res = backfill_transform(spark, opts, "2025-07-20", "2025-07-21")
    assert res.record_count == 2 * 2 * 67
    out = read_tree(spark, opts.transformed_path, opts.portfolio_schema)
    got = {(r["index"], r.day): r.n for r in out.groupBy("index", "day").count().withColumnRenamed("count", "n").collect()}
    assert got == {("IBOV", "20"): 67, ("IBOV", "21"): 67, ("SMLL", "20"): 67, ("SMLL", "21"): 67}
