"""How feeds deal the rows of a table to tasks."""

from __future__ import annotations

from pyspark.sql import functions as F

from folioflow.operators import flatten
from folioflow.plans import feeds


def test_a_table_of_many_rows_is_dealt_to_more_tasks_than_cores(spark, scratch, monkeypatch):
    cores = spark.sparkContext.defaultParallelism
    folder = scratch("dealt")
    rows = spark.range(100 * cores).selectExpr("id AS conv_id", "0 AS turn", "'user' AS role", "'words' AS text")
    rows.coalesce(1).write.parquet(f"file:{folder}/conversations.parquet")
    monkeypatch.setattr(feeds, "ROWS_PER_TASK", 25)
    dealt = feeds.dealt_table(spark, f"file:{folder}", "conversations")
    assert dealt.rdd.getNumPartitions() == min(4 * cores, feeds.MOST_DEALT)
    assert "RoundRobin" not in dealt._jdf.queryExecution().executedPlan().toString()
    assert dealt.count() == 100 * cores
    pages = feeds.conversation_pages(spark, f"file:{folder}")
    assert pages.rdd.getNumPartitions() == min(4 * cores, feeds.MOST_DEALT)
    assert pages.count() == 100 * cores


def test_headers_are_repeated_by_page_count_alone(spark, monkeypatch):
    monkeypatch.setattr(flatten, "BROADCAST_HEADERS", 0)
    pages = [(i, p, 3 if i != "big" else 40, f"{i}-{p}") for i in ("a", "b", "big") for p in range(0, 45)]
    pages += [("big", None, 40, "big-none"), ("late", 2, 2, "late-2")]
    made = spark.createDataFrame(pages, "index string, page_number long, total_pages long, cod string").selectExpr(
        "index", "page_number", "total_pages",
        "named_struct('date', index || page_number, 'theoricalQty', '1', 'reductor', '2') AS header",
        "array(named_struct('cod', cod)) AS results",
    )
    got = {(r["index"], r["cod"], r["data_date"]) for r in flatten.flatten_results(made).collect()}
    want = {(i, f"{i}-{p}", f"{i}1") for i, last in (("a", 3), ("b", 3), ("big", 40)) for p in range(0, last + 1)}
    assert got == want
    monkeypatch.setattr(flatten, "BROADCAST_HEADERS", 20_000)
    assert {(r["index"], r["cod"], r["data_date"]) for r in flatten.flatten_results(made).collect()} == want


def test_header_of_few_pages_is_one_row(spark, monkeypatch):
    monkeypatch.setattr(flatten, "BROADCAST_HEADERS", 0)
    made = spark.range(500).selectExpr(
        "CAST(id AS STRING) AS index", "1L AS page_number", "2L AS total_pages",
        "named_struct('date', 'd', 'theoricalQty', '1', 'reductor', '2') AS header", "array(named_struct('cod', 'c')) AS results",
    )
    seen = []
    explode = flatten.F.explode

    def counted(c):
        seen.append(c)
        return explode(c)

    monkeypatch.setattr(flatten.F, "explode", counted)
    assert flatten.flatten_results(made).count() == 500
    monkeypatch.setattr(flatten.F, "explode", explode)
    assert made.withColumn("run_total_pages", F.col("total_pages")).select(explode(seen[0])).count() == 500


def _plan_without_broadcast(spark, make):
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")  # as for counts or headers beyond it
    try:
        return make()._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set(key, before)


def test_texts_are_not_sorted_to_learn_their_conversations_size(spark, scratch):
    folder = scratch("hashed")
    spark.range(90).selectExpr("id DIV 9 AS conv_id", "id % 9 AS turn", "'user' AS role", "'words' AS text").write.parquet(f"file:{folder}/conversations.parquet")
    plan = _plan_without_broadcast(spark, lambda: feeds.conversation_pages(spark, f"file:{folder}"))
    assert "ShuffledHashJoin" in plan and "SortMergeJoin" not in plan
    pages = feeds.conversation_pages(spark, f"file:{folder}")
    assert pages.where("get_json_object(body, '$.page.totalPages') = '3' AND get_json_object(body, '$.page.totalRecords') = '9'").count() == 30


def test_pages_are_not_sorted_to_get_their_header(spark, monkeypatch):
    monkeypatch.setattr(flatten, "BROADCAST_HEADERS", 0)
    made = spark.range(60).selectExpr(
        "CASE WHEN id < 57 THEN CAST(id DIV 3 AS STRING) END AS index", "id % 3 + 1 AS page_number", "3L AS total_pages",
        "named_struct('date', CAST(id AS STRING), 'theoricalQty', '1', 'reductor', '2') AS header", "array(named_struct('cod', 'c')) AS results",
    )
    plan = _plan_without_broadcast(spark, lambda: flatten.flatten_results(made))
    assert "ShuffledHashJoin" in plan and "SortMergeJoin" not in plan
    rows = [tuple(r) for r in flatten.flatten_results(made).select("index", "page_number", "data_date").collect()]
    assert sorted(rows, key=str) == sorted([(str(i // 3) if i < 57 else None, i % 3 + 1, str(i - i % 3)) for i in range(60)], key=str)
