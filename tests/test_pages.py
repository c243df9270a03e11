"""Landed response pages (F2): parsing, flattening, header, missing pages, corrupt input."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from folioflow.operators import flatten_results, to_raw
from folioflow.sources import (
    consolidated_counts,
    missing_first_pages,
    missing_pages,
    parse_pages,
    read_pages,
    request_manifest,
    select_pages,
    unnumbered_pages,
)
from tests.conftest import land, page_body, record, three_pages

RUN = dt.datetime(2025, 7, 25, 14, 32, 40)


def _land_three(folder, skip=()):
    for n, recs in three_pages():
        if n not in skip:
            land(folder, f"page-{n:04d}.json", page_body(n, 3, recs))


def test_three_pages_consolidate(spark, scratch):
    folder = scratch("landing")
    _land_three(folder)
    pages = read_pages(spark, folder, index="IBOV")
    assert select_pages(pages, all_pages=True).count() == 3
    rows = flatten_results(select_pages(pages, all_pages=True))
    assert rows.count() == 134
    counts = consolidated_counts(pages).first()
    assert (counts["index"], counts.total_records, counts.pages_landed, counts.total_pages) == ("IBOV", 134, 3, 3)
    # page 1 only (the default extract)
    assert flatten_results(select_pages(pages, all_pages=False)).count() == 50
    assert missing_pages(pages).count() == 0


def test_page_one_header_applies_to_all_rows(spark, scratch):
    folder = scratch("landing")
    _land_three(folder)
    pages = read_pages(spark, folder, index="IBOV")
    dates = {r.data_date for r in flatten_results(select_pages(pages, True)).select("data_date").collect()}
    assert dates == {"21/07/25"}


def test_missing_page_reported_and_rows_kept(spark, scratch):
    folder = scratch("landing")
    _land_three(folder, skip=(2,))
    pages = read_pages(spark, folder, index="IBOV")
    assert [tuple(r) for r in missing_pages(pages).collect()] == [("IBOV", 2)]
    assert flatten_results(select_pages(pages, True)).count() == 84


def test_pages_beyond_total_pages_are_left_out(spark, scratch):
    folder = scratch("landing")
    land(folder, "page-0001.json", page_body(1, 1, [record(1)]))  # says: one page
    land(folder, "page-0002.json", page_body(2, 1, [record(2)]))  # never requested
    pages = read_pages(spark, folder, index="IBOV")
    assert [r.cod for r in flatten_results(select_pages(pages, True)).collect()] == ["C001"]


def test_missing_first_page_gives_no_rows(spark, scratch):
    folder = scratch("landing")
    _land_three(folder, skip=(1,))
    pages = read_pages(spark, folder, index="IBOV")
    assert flatten_results(select_pages(pages, True)).count() == 0
    assert [r["index"] for r in missing_first_pages(pages).collect()] == ["IBOV"]


def test_odd_responses(spark, scratch):
    folder = scratch("landing")
    land(folder, "index=a/page-0001.json", page_body(1, 1, []))  # empty results
    land(folder, "index=b/page-0001.json", {"page": {"pageNumber": 1, "totalPages": 1}, "header": {}})  # no results key
    land(folder, "index=c/page-0001.json", page_body(1, None, [record(1)], header=False))  # no header, no totalPages
    land(folder, "index=d/page-0001.json", page_body(1, 1, [{"cod": "X1", "asset": " Y ", "part": 1.5}]))  # missing keys
    land(folder, "index=e/page-0001.json", "<html>not json</html>")  # not JSON
    pages = read_pages(spark, folder)
    by_dir = {}
    for r in pages.withColumn("f", F.lit(1)).collect():
        by_dir.setdefault(r.corrupt_record is not None, []).append(r)
    assert len(by_dir[True]) == 1
    assert pages.where("total_pages = 1").count() == 5  # absent totalPages → 1
    rows = to_raw(select_pages(pages, False), RUN, keep_index=True)
    got = sorted((r.cod, r.asset, r.part, r.data_date) for r in rows.collect())
    assert got == [("C001", "ASSET 0", 0.49, None), ("X1", "Y", 1.5, "21/07/25")]


def test_raw_rows_documented_record(spark, scratch):
    folder = scratch("landing")
    doc = {
        "segment": None,
        "cod": "ALOS3",
        "asset": "ALLOS",
        "type": "ON  ED  NM",
        "part": "0,490",
        "partAcum": None,
        "theoricalQty": "476.976.044",
    }
    land(folder, "page-0001.json", page_body(1, 1, [doc, doc]))
    raw = to_raw(read_pages(spark, folder, index="IBOV"), RUN)
    rows = raw.collect()
    assert len(rows) == 2
    r = rows[0]
    assert (r.cod, r.asset, r.type, r.part, r.theoricalQty, r.segment, r.partAcum) == (
        "ALOS3", "ALLOS", "ON  ED  NM", 0.49, 476976044.0, None, None
    )
    assert r.extraction_date == dt.date(2025, 7, 25)
    assert r.extraction_timestamp == RUN
    assert (r.data_date, r.total_theoretical_qty, r.reductor) == ("21/07/25", "95.000.000.000", "1.234,5")
    from folioflow.operators import portfolio_by_asset

    out = portfolio_by_asset(raw, RUN.date()).first()
    assert tuple(out) == ("ALLOS", 2, 0.98, 953952088, "2025-07-25")


def test_compat_mode_reproduces_old_behaviour(spark, scratch):
    folder = scratch("landing")
    land(folder, "page-0001.json", page_body(1, 1, [record(1)]))
    r = to_raw(read_pages(spark, folder, index="IBOV"), RUN, number_mode="compat").first()
    assert r.part == 0.49 and r.theoricalQty is None


def test_page_number_from_file_name(spark, scratch):
    folder = scratch("landing")
    body = {"page": {"totalPages": 2}, "results": [record(1)]}
    land(folder, "page-0001.json", body)
    land(folder, "page-0002.json", {"results": [record(2)]})
    pages = read_pages(spark, folder, index="X")
    assert sorted(r.page_number for r in pages.collect()) == [1, 2]
    assert missing_pages(pages).count() == 0
    # only that pattern counts: a date in a name is no page number
    land(folder, "x_20250725.json", {"results": [record(3)]})
    pages = read_pages(spark, folder, index="X")
    assert unnumbered_pages(pages).count() == 1
    assert flatten_results(select_pages(pages, True)).count() == 2


def test_pages_without_an_index_are_one_index(spark, scratch):
    folder = scratch("landing")
    _land_three(folder)
    pages = read_pages(spark, folder)
    assert flatten_results(select_pages(pages, True)).count() == 134
    assert missing_pages(pages).count() == 0 and missing_first_pages(pages).count() == 0


def test_number_tokens_keep_their_value(spark, scratch):
    import json

    folder = scratch("landing")
    tokens = [("2.857", 2.857), ("1.125", 1.125), ('"0,490"', 0.49), ("12", 12.0), ("1e20", 1e20), ("-3.5", -3.5), ("1.12e-7", 1.12e-7), ("null", None), ('"1.234"', 1234.0)]
    body = '{"page":{"pageNumber":1},"results":[%s]}' % ",".join('{"cod":"%d","part":%s}' % (i, t) for i, (t, _) in enumerate(tokens))
    assert json.loads(body)
    land(folder, "page-0001.json", body)
    for mode in ("ptbr", "enus"):
        rows = to_raw(read_pages(spark, folder, index="X"), RUN, number_mode=mode).collect()
        got = {int(r.cod): r.part for r in rows}
        for i, (t, want) in enumerate(tokens):
            if mode == "ptbr" or not t.startswith('"'):
                assert got[i] == want, (mode, t)


def test_a_page_count_out_of_range_raises(spark, scratch):
    folder = scratch("landing")
    land(folder, "page-0001.json", page_body(1, 10**12, [record(1)]))
    with pytest.raises(Exception, match="totalPages out of range"):
        missing_pages(read_pages(spark, folder, index="X")).collect()


def test_json_lines_and_index_directories(spark, scratch):
    import json

    folder = scratch("landing")
    for idx in ("IBOV", "SMLL", "007"):
        lines = "\n".join(json.dumps(page_body(n, 3, recs)) for n, recs in three_pages())
        land(folder, f"index={idx}/part-0.json", lines)
    pages = read_pages(spark, folder, multi_line=False)
    counts = {r["index"]: r.total_records for r in consolidated_counts(pages).collect()}
    assert counts == {"IBOV": 134, "SMLL": 134, "007": 134}


def test_parse_pages_from_text_column(spark):
    import json

    df = spark.createDataFrame(
        [("IBOV", json.dumps(page_body(1, 1, [record(1)]))), ("IBOV", "{broken")], "index string, body string"
    )
    pages = parse_pages(df)
    assert pages.where("corrupt_record IS NOT NULL").count() == 1
    assert flatten_results(select_pages(pages, False)).count() == 1


def test_request_manifest(spark):
    req = spark.createDataFrame([("IBOV", "pt-br", 1200, 3)], "index string, language string, page_size long, total_pages long")
    rows = request_manifest(req, "https://h/x/GetPortfolioDay").orderBy("page_number").collect()
    assert [r.page_number for r in rows] == [1, 2, 3]
    assert rows[0].url == (
        "https://h/x/GetPortfolioDay/"
        "eyJwYWdlTnVtYmVyIjoxLCJwYWdlU2l6ZSI6MTIwMCwibGFuZ3VhZ2UiOiJwdC1iciIsImluZGV4IjoiSUJPViJ9"
    )
    assert rows[1].params_json == '{"pageNumber":2,"pageSize":1200,"language":"pt-br","index":"IBOV"}'


def test_index_field_beside_the_response(spark, scratch):
    import json

    folder = scratch("landing")
    lines = []
    for idx in ("IBOV", "SMLL"):
        for n, recs in three_pages():
            lines.append(json.dumps({"index": idx, **page_body(n, 3, recs)}))
    land(folder, "responses.jsonl", "\n".join(lines))
    pages = read_pages(spark, folder, multi_line=False, index="unused")
    counts = {r["index"]: r.total_records for r in consolidated_counts(pages).collect()}
    assert counts == {"IBOV": 134, "SMLL": 134}
    assert missing_pages(pages).count() == 0


def test_duplicate_first_page_does_not_double_the_missing_report(spark, scratch):
    folder = scratch("landing")
    land(folder, "a/page-0001.json", page_body(1, 3, [record(1)]))
    land(folder, "b/page-0001.json", page_body(1, 3, [record(1)]))
    pages = read_pages(spark, f"{folder}/*/", index="IBOV")
    assert sorted(r.page_number for r in missing_pages(pages).collect()) == [2, 3]
