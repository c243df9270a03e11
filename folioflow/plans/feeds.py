"""Portfolio feeds derived from the shared test tables.

The test tables hold no portfolio feed, so each registered query first
writes one the way the real feed looks - numbers as pt-BR text, padded
names, the literal ``'None'``, junk values, multi-page JSON responses -
from the table's own columns.  Every derivation is a plain projection
(or a bounded regrouping), so its cost grows with the table.  The SQL
oracles compute the expected values from the *original* columns, which
checks the parsing and cleaning independently.

Derivation rules (mirrored in the oracles):

``lineitem_feed``
    asset  NBSP + ``Supplier#<suppkey>`` + space/tab; ``' None '`` on line 7
           (dropped); ``'Lote <returnflag>'`` on line 5
    cod    ``' <partkey>'``; the text ``'None'`` on line 2 of flag R
    part   discount with a decimal comma; ``R$`` prefix on line 3, ``%``
           suffix on line 4, junk ``'-'`` on line 5 (so the Lote groups sum 0)
    theoricalQty  cents of the extended price, dot-grouped; junk on line 6
           of status O
    segment  ``' <linestatus> '``; ``'None'`` for flag N
    type   ``'<flag>  <status>'`` (inner spaces kept)
    partAcum  tax with a decimal comma (never cleaned)
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from folioflow.functions.numbers import group_thousands
from folioflow.sources.tables import read_table
from folioflow.schemas import PAGE, quoted

# Fixed run clock of the registered queries, so their output is reproducible.
RUN_TIMESTAMP = dt.datetime(2025, 7, 25, 14, 32, 40)
RUN_DATE = RUN_TIMESTAMP.date()

# Page size used to split conversations into response pages.
CONVERSATION_PAGE_SIZE = 3

# Rows that a task rewrites, and partitions up to which a shuffle is written
# straight to files (Spark's ``spark.shuffle.sort.bypassMergeThreshold``).
ROWS_PER_TASK = 50_000
MOST_DEALT = 200

NBSP = " "


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A shared test table."""
    return read_table(spark, f"{sf_dir.rstrip('/')}/{name}.parquet")


def _tasks(df: DataFrame) -> int:
    """Tasks that a table is dealt to, by its number of rows (which is in the footers)."""
    return max(df.sparkSession.sparkContext.defaultParallelism, min(-(-df.count() // ROWS_PER_TASK), MOST_DEALT))


def dealt_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A shared test table whose rows a feed rewrites at length, dealt to tasks of at most ``ROWS_PER_TASK`` rows.

    The test tables are single files of one row group.  Spark may plan several
    splits for such a file, but only the one that holds the row group's middle
    has rows, so the number of partitions says nothing; and what a split of
    compressed columns becomes as rows is many times its size.  A table of
    fewer files than tasks is dealt as a step of its own, by its first two
    columns (the key, and what tells its rows apart; columns that a query does
    not use are not read): dealing round robin would sort, so hold, all rows of a split.  Up to
    ``MOST_DEALT`` partitions the writing side of the shuffle holds no rows.
    """
    df = table(spark, sf_dir, name)
    tasks = _tasks(df)
    return df if len(df.inputFiles()) >= tasks else df.repartition(tasks, *[quoted(c) for c in df.columns[:2]])


def _comma_cents(cents: Column) -> Column:
    """Integer cents → ``'1234,05'`` (exact, no float formatting)."""
    sign = F.when(cents < 0, F.lit("-")).otherwise(F.lit(""))
    a = F.abs(cents)
    return F.concat(sign, (a / 100).cast("bigint").cast("string"), F.lit(","), F.lpad((a % 100).cast("string"), 2, "0"))


def cents(c: Column | str) -> Column:
    col = F.col(c) if isinstance(c, str) else c
    return F.round(col * 100).cast("bigint")


def lineitem_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed-looking text rows, one per lineitem (see module doc)."""
    li = dealt_table(spark, sf_dir, "lineitem")
    ln, flag, status = F.col("l_linenumber"), F.col("l_returnflag"), F.col("l_linestatus")
    disc = _comma_cents(cents("l_discount"))
    asset = (
        F.when(ln == 7, F.lit(" None "))
        .when(ln == 5, F.concat(F.lit("Lote "), flag))
        .otherwise(F.concat(F.lit(NBSP + "Supplier#"), F.col("l_suppkey").cast("string"), F.lit(" \t")))
    )
    cod = F.when((ln == 2) & (flag == "R"), F.lit("None")).otherwise(F.concat(F.lit(" "), F.col("l_partkey").cast("string")))
    part = (
        F.when(ln == 3, F.concat(F.lit("R$ "), disc))
        .when(ln == 4, F.concat(disc, F.lit("%")))
        .when(ln == 5, F.lit("-"))
        .otherwise(disc)
    )
    qty = F.when((ln == 6) & (status == "O"), F.lit("n/d")).otherwise(group_thousands(cents("l_extendedprice")))
    segment = F.when(flag == "N", F.lit("None")).otherwise(F.concat(F.lit(" "), status, F.lit(" ")))
    return li.select(
        "l_orderkey",
        "l_linenumber",
        segment.alias("segment"),
        cod.alias("cod"),
        asset.alias("asset"),
        F.concat(flag, F.lit("  "), status).alias("type"),
        part.alias("part"),
        _comma_cents(cents("l_tax")).alias("partAcum"),
        qty.alias("theoricalQty"),
    )


def lineitem_stale_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feed as an earlier, incomplete run saw it (for reconciliation).

    Lines 4 of flag A never arrived, nor any ``Lote R`` row.
    """
    feed = lineitem_feed(spark, sf_dir)
    lost = ((F.col("l_linenumber") == 4) & F.col("type").startswith("A")) | (
        (F.col("l_linenumber") == 5) & F.col("type").startswith("R")
    )
    return feed.where(~lost)


def events_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily feed from events: asset = event type, one day per event date."""
    ev = dealt_table(spark, sf_dir, "events")
    return ev.select(
        F.concat(F.lit(" "), F.col("event_type")).alias("asset"),
        F.col("user_id").cast("string").alias("cod"),
        _comma_cents(cents("value")).alias("part"),
        group_thousands(F.col("event_id")).alias("theoricalQty"),
        F.to_date("ts").alias("event_date"),
    )


def conversation_pages(
    spark: SparkSession,
    sf_dir: str,
    page_size: int = CONVERSATION_PAGE_SIZE,
    drop_some: bool = False,
    index_in_body: bool = False,
    extra: dict[str, Column] | None = None,
) -> DataFrame:
    """Response bodies (JSON text) built from conversations: one index per
    conversation, one page per ``page_size`` consecutive turns.

    Each page is a bounded group (at most ``page_size`` rows), so no
    conversation's size reaches a single task.  ``drop_some`` leaves out
    the pages after the first whose first turn was written by the user
    (simulates responses that never arrived).

    Record: segment = the whole text, cod = ``T<turn>``, asset = padded
    role, type = first two letters of the role upper-cased + ``'  NM'``,
    part = length/100 with a decimal comma, theoricalQty = length × 1000
    dot-grouped.  Header: date = 2024-01-01 + (page - 1) days, so only page
    1's header is right for the whole index.  ``index_in_body`` writes the
    index next to the response fields, as a fetcher landing one line per
    response would.  ``extra``: more keys of a record, left out where NULL.
    """
    conv = dealt_table(spark, sf_dir, "conversations")
    turns = conv.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n_turns"))
    length = F.length("text").cast("bigint")
    # hashed: the counts are a row for each conversation, the texts go by without being sorted, so held
    rows = conv.join(turns.hint("shuffle_hash"), "conv_id").select(
        "conv_id",
        "turn",
        "n_turns",
        (F.col("turn") / page_size).cast("bigint").alias("slot"),
        F.struct(
            F.col("turn").alias("_turn"),
            F.col("role").alias("_role"),
            F.col("text").alias("segment"),
            F.concat(F.lit("T"), F.col("turn").cast("string")).alias("cod"),
            F.concat(F.lit(" "), F.col("role"), F.lit(" ")).alias("asset"),
            F.concat(F.upper(F.substring("role", 1, 2)), F.lit("  NM")).alias("type"),
            _comma_cents(length).alias("part"),
            F.lit(None).cast("string").alias("partAcum"),
            group_thousands(length * 1000).alias("theoricalQty"),
            *[c.alias(k) for k, c in (extra or {}).items()],
        ).alias("rec"),
    )
    # a number of partitions by the rows: what a task holds while it sorts them into pages stays the same
    dealt = rows.repartition(_tasks(table(spark, sf_dir, "conversations")), "conv_id", "slot")
    pages = dealt.groupBy("conv_id", "slot").agg(
        F.max("n_turns").alias("n_turns"),
        F.sort_array(F.collect_list("rec")).alias("recs"),
    )
    if drop_some:
        pages = pages.where(~((F.col("slot") > 0) & (F.col("recs")[0]["_role"] == "user")))
    page_number = F.col("slot") + 1
    total_pages = F.ceil(F.col("n_turns") / page_size).cast("bigint")
    index = F.col("conv_id").cast("string")
    body = F.struct(
        *([index.alias("index")] if index_in_body else []),
        F.struct(
            page_number.alias("pageNumber"),
            F.lit(page_size).cast("bigint").alias("pageSize"),
            total_pages.alias("totalPages"),
            F.col("n_turns").alias("totalRecords"),
        ).alias("page"),
        F.struct(
            F.date_add(F.lit(dt.date(2024, 1, 1)), (F.col("slot")).cast("int")).cast("string").alias("date"),
            group_thousands(F.col("n_turns") * 1000).alias("theoricalQty"),
            F.concat(F.col("n_turns").cast("string"), F.lit(",0")).alias("reductor"),
        ).alias("header"),
        F.transform(
            "recs",
            lambda r: F.struct(*[r[n].alias(n) for n in (*PAGE["results"].dataType.elementType.fieldNames(), *(extra or {}))]),
        ).alias("results"),
    )
    return pages.select(index.alias("index"), F.to_json(body).alias("body"))


def orders_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as a daily table (the order date is the partition day)."""
    o = table(spark, sf_dir, "orders")
    return o.select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority", F.to_date("o_orderdate").alias("o_day")
    )
