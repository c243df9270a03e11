"""Pages → rows (P1), header onto rows (P2), run metadata."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import VariantType

from folioflow.functions.dates import timestamp_literal
from folioflow.schemas import quoted
from folioflow.session import shared_dir

# Raw columns taken from the response header.
HEADER_COLUMNS = {
    "data_date": "date",
    "total_theoretical_qty": "theoricalQty",
    "reductor": "reductor",
}

# Header rows (one per index, under 200 bytes) that may be broadcast.
BROADCAST_HEADERS = 20_000
# Beyond that, so many consecutive pages of an index share a join key with its
# header, over so many keys at most.
HEADER_PAGES = 16
HEADER_BUCKETS = 64


def token_text(v: Column) -> Column:
    """A JSON token's text: a string as it is, a number so that every number grammar reads its value.

    Whole numbers are plain digits, others have 18 decimals after a dot
    (neither can be taken for grouping).  A number that neither form holds
    keeps its own text, which no grammar reads: it is counted as unparsed.
    """
    kind = F.schema_of_variant(v)
    plain = F.try_variant_get(v, "$", "decimal(38,18)")
    whole = F.try_variant_get(v, "$", "decimal(38,0)")
    number = F.try_variant_get(v, "$", "double")
    text = (
        F.when(whole.cast("double") == number, whole.cast("string"))
        .when(plain.cast("double") == number, plain.cast("string"))
        .otherwise(v.cast("string"))
    )
    return F.when(kind.isin("STRING", "BOOLEAN"), F.try_variant_get(v, "$", "string")).when(kind != "VOID", text)


def _as_text(rows: DataFrame) -> DataFrame:
    """Result fields that were read with their token type, as text."""
    typed = [f.name for f in rows.schema.fields if isinstance(f.dataType, VariantType)]
    return rows.withColumns({c: token_text(F.col(quoted(c))) for c in typed}) if typed else rows


def run_headers(pages: DataFrame) -> DataFrame:
    """One header per index, taken from its page 1; indices without a page 1 get no row.

    Only page-1 rows enter the aggregate (the filter runs at the source), so
    it handles one row per index; of a page 1 landed twice the header that
    sorts first is taken, field by field the same row (``min_by``).
    """
    header = F.to_json("header")
    return (
        pages.where(F.col("page_number") == 1)
        .groupBy("index")
        .agg(
            *[F.min_by(F.col(f"header.{src}"), F.coalesce(header, F.lit(""))).alias(f"run_{src}") for src in HEADER_COLUMNS.values()],
            F.max("total_pages").alias("run_total_pages"),
        )
    )


def flatten_results(pages: DataFrame, header_from_first_page: bool = True) -> DataFrame:
    """Explode ``results`` into one row per record, header fields attached.

    NULL or empty ``results`` give no rows; a record missing a key gives
    NULL in that column.  With ``header_from_first_page`` every row of an
    index (NULL counts as one) gets its page 1 header, an index whose page 1
    did not land gives no rows (page 1 carries the page count and the
    header), and pages numbered beyond page 1's ``totalPages`` are left out
    (they are never requested).  Without it each page keeps its own header:
    the plan for page 1 alone, with no join at all.

    The header frame (one row per index) is built first and stored in the
    checkpoint folder.  Up to ``BROADCAST_HEADERS`` rows it is broadcast and
    no page is shuffled; a larger one is joined on (index, bucket of the
    page number), so the pages of a large index are spread.  A header is
    repeated for the buckets that its page count reaches, no more: one row
    for an index of few pages.  A task hashes its headers and lets the pages
    go by; a sort would hold all of them.
    """
    if not header_from_first_page:
        header = [F.col(f"header.{src}").alias(dst) for dst, src in HEADER_COLUMNS.items()]
        return _as_text(pages.select("index", "page_number", *header, F.inline("results")))
    shared_dir(pages.sparkSession)
    headers = run_headers(pages).withColumnRenamed("index", "run_index").checkpoint()
    same = F.col("index").eqNullSafe(F.col("run_index"))
    if headers.count() <= BROADCAST_HEADERS:
        joined = pages.join(F.broadcast(headers), same)
    else:
        last = F.least((F.greatest("run_total_pages", F.lit(1)) - 1) / HEADER_PAGES, F.lit(HEADER_BUCKETS - 1)).cast("int")
        spread = headers.withColumn("run_bucket", F.explode(F.sequence(F.lit(0), last)))
        # pages numbered below 1 go with page 1
        at = F.floor((F.greatest("page_number", F.lit(1)) - 1) / HEADER_PAGES)
        bucketed = pages.withColumn("page_bucket", F.when(F.col("page_number").isNotNull(), F.pmod(at, F.lit(HEADER_BUCKETS))).cast("int"))
        joined = bucketed.join(spread.hint("shuffle_hash"), same & (F.col("page_bucket") == F.col("run_bucket")))
    used = joined.where(F.col("page_number") <= F.greatest(F.col("run_total_pages"), F.lit(1)))
    header = [F.col(f"run_{src}").alias(dst) for dst, src in HEADER_COLUMNS.items()]
    return _as_text(used.select("index", "page_number", *header, F.inline("results")))


def add_run_metadata(df: DataFrame, run_timestamp: dt.datetime) -> DataFrame:
    """``extraction_date`` and ``extraction_timestamp`` from one bound clock read."""
    return df.withColumns(
        {
            "extraction_date": F.lit(run_timestamp.date()),
            "extraction_timestamp": timestamp_literal(run_timestamp),
        }
    )
