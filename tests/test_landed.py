"""What may land beside the usual pages: unknown keys, retried pages, pages still to fetch."""

from __future__ import annotations

import base64
import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from folioflow import JobOptions
from folioflow.__main__ import main
from folioflow.operators import flatten_results
from folioflow.plans import extract_job, transform_job, with_every_key
from folioflow.sources import (
    consolidated_counts,
    extra_keys,
    followup_requests,
    parse_pages,
    parse_records,
    read_pages,
    read_records,
    read_tree,
    repeated_pages,
    select_pages,
    single_copies,
    unknown_keys,
)
from folioflow.sources import pages as pages_module
from folioflow.streaming.landing import landing_stream
from tests.conftest import land, page_body, record

RUN = dt.datetime(2025, 7, 25, 14, 32, 40)


def options(root, **more):
    return JobOptions(root=f"file:{root}", all_pages=True, run_timestamp=RUN, index="IBOV", **more)


# ---------------------------------------------------------------- unknown keys


def kinds(df):
    return {(r["index"], r["key"]): (r["kind"], r["records"]) for r in df.collect()}


def test_unknown_keys_by_kind(spark, scratch):
    folder = scratch("landing")
    land(folder, "page-0001.json", page_body(1, 2, [record(0, n=1, t="x", o={"a": 1}, mix=1, none=None), record(1, n=2.5, mix="s", none=None)]))
    land(folder, "page-0002.json", page_body(2, 2, [record(2, l=[1, 2], b=True), record(3, Cod="other case")]))
    land(folder, "bad.json", "{ not json")
    got = kinds(unknown_keys(read_records(spark, folder, index="IBOV")))
    assert got == {
        ("IBOV", "n"): ("DECIMAL(21,1)", 2), ("IBOV", "t"): ("STRING", 1), ("IBOV", "o"): ("OBJECT<a: BIGINT>", 1), ("IBOV", "mix"): ("VARIANT", 2),
        ("IBOV", "none"): ("VOID", 2), ("IBOV", "l"): ("ARRAY<BIGINT>", 1), ("IBOV", "b"): ("BOOLEAN", 1), ("IBOV", "Cod"): ("STRING", 1),
    }


def test_records_that_are_no_objects_have_no_keys(spark):
    bodies = [("A", '{"results": [5, null, "x", [1], {"new": 1}]}'), ("A", '{"results": null}'), ("B", "no json"), (None, '{"results": [{"new": 2}, {"cod": "C"}]}')]
    df = spark.createDataFrame(bodies, "index string, body string")
    assert kinds(unknown_keys(parse_records(df))) == {("A", "new"): ("BIGINT", 1), (None, "new"): ("BIGINT", 1)}
    assert kinds(unknown_keys(parse_records(df), known=())) == {("A", "new"): ("BIGINT", 1), (None, "new"): ("BIGINT", 1), (None, "cod"): ("STRING", 1)}
    assert unknown_keys(parse_records(df.limit(0))).collect() == []


def test_every_key_becomes_a_column_but_clashing_ones(spark, scratch):
    folder, root = scratch("landing"), scratch("job")
    odd = {"rank": 7, "Note": "as is", "note": "lower", "deep": {"a": [1, None]}, "COD": "clash", "data_date": "clash", "year": "clash", " ": "blank", "x.y": 1.5}
    land(folder, "page-0001.json", page_body(1, 1, [record(0, **odd), record(1)]))
    assert extra_keys(read_records(spark, folder)) == ("Note", "deep", "rank", "x.y")
    opts = with_every_key(spark, folder, options(root))
    report = extract_job(spark, folder, opts)
    rows = {r["cod"]: r for r in read_tree(spark, opts.raw_path, opts.raw_schema).collect()}
    assert [rows["C000"][c] for c in ("Note", "deep", "rank", "x.y")] == ["as is", '{"a":[1,null]}', "7", "1.500000000000000000"]
    assert [rows["C001"][c] for c in ("Note", "deep", "rank", "x.y")] == [None] * 4
    # what clashes is not kept, and said so
    assert {r["key"] for r in report.unknown_keys.collect()} == {"note", "COD", "data_date", "year", " "}
    assert report.losses()["unknown_keys"] == 5
    # the transform reads the same day as ever
    assert transform_job(spark, opts).record_count == 1
    # a day written before the key came reads as NULL there
    extract_job(spark, folder, options(root), partition_day="2025-07-24")
    days = {r["day"]: r["n"] for r in read_tree(spark, opts.raw_path, opts.raw_schema).groupBy("day").agg(F.count("rank").alias("n")).collect()}
    assert days == {"24": 0, "25": 1}


def test_extra_columns_must_be_new_names():
    for bad in (("cod",), ("Asset",), ("index",), ("a", "A"), ("",), ("day",)):
        with pytest.raises(ValueError):
            JobOptions(root="file:/x", extra_columns=bad)


def test_keys_without_bound_are_refused(spark, monkeypatch):
    from folioflow.sources import records

    monkeypatch.setattr(records, "MAX_EXTRA_KEYS", 3)
    body = json.dumps({"results": [{f"k{i}": i} for i in range(4)]})
    with pytest.raises(ValueError):
        extra_keys(parse_records(spark.createDataFrame([("A", body)], "index string, body string")))


def test_stream_keeps_extra_columns(spark, scratch):
    folder, root = scratch("landing"), scratch("job")
    land(folder, "page-0001.json", page_body(1, 1, [record(0, rank=3)]))
    opts = options(root, extra_columns=("rank",))
    landing_stream(spark, f"file:{folder}", opts)
    assert [r["rank"] for r in read_tree(spark, opts.raw_path, opts.raw_schema).collect()] == ["3"]


# ---------------------------------------------------------------- pages landed again


def at(path, seconds):
    os.utime(path, (seconds, seconds))


def test_last_copy_of_a_page_is_used(spark, scratch):
    folder, root = scratch("landing"), scratch("job")
    old = land(folder, "a/page-0001.json", page_body(1, 2, [record(0, part="9,0"), record(1)]))
    new = land(folder, "b/page-0001.json", page_body(1, 2, [record(0, part="1,0")]))
    land(folder, "a/page-0002.json", page_body(2, 2, [record(2)]))
    land(folder, "b/page-0002.json", page_body(2, 2, [record(2)]))
    land(folder, "b/bad.json", "{ not json")
    at(new, 1_700_000_000)
    at(old, 1_600_000_000)
    opts = options(root)
    report = extract_job(spark, f"{folder}/*", opts)
    rows = {r["cod"]: r["part"] for r in read_tree(spark, opts.raw_path).collect()}
    assert rows == {"C000": 1.0, "C002": 0.49}
    assert report.write.record_count == 2
    got = {r["page_number"]: (r["copies"], r["versions"], r["conflict"]) for r in report.repeated_pages.collect()}
    assert got == {1: (2, 2, True), 2: (2, 1, False)}
    assert report.losses()["conflicting_pages"] == 1
    assert report.counts.first().total_records == 2


@pytest.mark.parametrize("bound", [0, 1000])
def test_equal_copies_in_one_file_and_pages_without_index(spark, scratch, monkeypatch, bound):
    monkeypatch.setattr(pages_module, "BROADCAST_REPEATS", bound)
    folder = scratch("landing")
    lines = []
    for index in ("A", None, "B"):
        more = {} if index is None else {"index": index}
        for n in (1, 2):
            line = json.dumps(more | page_body(n, 2, [record(n), record(n + 10)]))
            lines += [line] * (3 if index != "B" and n == 2 else 1)
    lines.append(json.dumps({"index": "A", "page": {}, "results": [record(99)]}))  # no number: stays
    lines += ["no json", "no json"]
    land(folder, "all.json", "\n".join(lines))
    pages = read_pages(spark, folder, multi_line=False)
    once = single_copies(pages)
    assert once.columns == pages.columns and once.count() == 6 + 1 + 2
    assert {(r["index"], r["page_number"]): (r["copies"], r["versions"]) for r in repeated_pages(pages).collect()} == {("A", 2): (3, 1), (None, 2): (3, 1)}
    assert flatten_results(select_pages(once, True)).count() == 12
    assert {r["index"]: r["total_records"] for r in consolidated_counts(once).collect()} == {"A": 4, None: 4, "B": 4}


def test_formatting_is_no_conflict(spark):
    body = page_body(1, 1, [record(0)])
    df = spark.createDataFrame([("A", json.dumps(body)), ("A", json.dumps(body, indent=3))], "index string, body string")
    pages = parse_pages(df, index="index")
    assert [r["conflict"] for r in repeated_pages(pages).collect()] == [False]
    assert single_copies(pages).count() == 1


def test_bodies_of_pages_landed_once_are_not_shuffled(spark, scratch):
    folder = scratch("landing")
    land(folder, "a/page-0001.json", page_body(1, 2, [record(0)]))
    land(folder, "b/page-0001.json", page_body(1, 2, [record(1)]))
    land(folder, "a/page-0002.json", page_body(2, 2, [record(2)]))
    once = single_copies(read_pages(spark, f"{folder}/*", index="IBOV"))
    plan = once._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan


# ---------------------------------------------------------------- pages still to fetch


def test_followup_requests(spark, scratch):
    folder = scratch("landing")
    land(folder, "index=A/page-0001.json", page_body(1, 4, [record(0)]))
    land(folder, "index=A/page-0003.json", page_body(3, 4, [record(1)]))
    land(folder, "index=A/page-0004.json", "{ broken")
    land(folder, "index=B/page-0002.json", page_body(2, 2, [record(2)]))
    land(folder, "index=C/page-0001.json", page_body(1, 1, [record(3)]))
    pages = read_pages(spark, folder)
    wanted = spark.createDataFrame([("A",), ("B",), ("C",), ("D",)], "index string")
    got = followup_requests(pages, "https://host/p/", language="pt-br", page_size=50, wanted=wanted).collect()
    assert sorted((r["index"], r["page_number"]) for r in got) == [("A", 2), ("A", 4), ("B", 1), ("D", 1)]
    for r in got:
        token = json.loads(base64.b64decode(r["url"].rsplit("/", 1)[1]))
        assert token == {"pageNumber": r["page_number"], "pageSize": 50, "language": "pt-br", "index": r["index"]}
    one_page = followup_requests(pages, "https://host/p", language="pt-br", page_size=50, all_pages=False).collect()
    assert sorted((r["index"], r["page_number"]) for r in one_page) == [("B", 1)]


def test_commands_run_until_nothing_is_asked_for(spark, scratch, capsys):
    folder, root = scratch("landing"), scratch("job")
    flags = ["--root", f"file:{root}", "--landing", folder, "--all-pages", "--index", "IBOV", "--run-timestamp", RUN.isoformat(), "--base-url", "https://host/p"]
    land(folder, "page-0002.json", page_body(2, 2, [record(1, rank=1)]))
    assert main(["manifest", *flags])["requests"] == 1
    land(folder, "page-0001.json", page_body(1, 3, [record(0)]))
    assert main(["manifest", *flags])["requests"] == 1  # page 3
    land(folder, "page-0003.json", page_body(3, 3, [record(2)]))
    assert main(["manifest", *flags])["requests"] == 0
    out = main(["extract", *flags, "--extra-columns", "*"])
    assert out["raw_records"] == 3 and out["extra_columns"] == ["rank"] and "unknown_keys" not in out
