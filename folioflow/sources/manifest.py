"""The page-request manifest - one request URL per (index, language, page size, page) - and what is still to be fetched."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioflow.functions.requests import request_json, request_token, request_url
from folioflow.sources.pages import missing_first_pages, missing_pages, page_numbers


def _as_col(v: Column | str | int) -> Column:
    if isinstance(v, Column):
        return v
    return F.lit(v)


def request_manifest(
    requests: DataFrame,
    base_url: str,
    *,
    index: Column | str = "index",
    language: Column | str = "language",
    page_size: Column | str | int = "page_size",
    total_pages: Column | str | int = "total_pages",
) -> DataFrame:
    """Expand each request row into pages ``1..total_pages`` and build their URLs.

    Arguments naming a column are used as columns; other values are literals.
    """

    def pick(v: Column | str | int) -> Column:
        if isinstance(v, str) and v in requests.columns:
            return F.col(v)
        return _as_col(v)

    base = requests.select(
        pick(index).cast("string").alias("index"),
        pick(language).cast("string").alias("language"),
        pick(page_size).cast("long").alias("page_size"),
        F.explode(page_numbers(pick(total_pages).cast("long"))).alias(
            "page_number"
        ),
    )
    return _with_urls(base, base_url)


def _with_urls(base: DataFrame, base_url: str) -> DataFrame:
    """(``index``, ``language``, ``page_size``, ``page_number``) with the request of each row."""
    args = (F.col("page_number"), F.col("page_size"), F.col("language"), F.col("index"))
    return base.select(
        "index",
        "language",
        "page_size",
        "page_number",
        request_json(*args).alias("params_json"),
        request_url(base_url, request_token(*args)).alias("url"),
    )


def followup_requests(
    pages: DataFrame, base_url: str, *, language: str, page_size: int, all_pages: bool = True, wanted: DataFrame | None = None
) -> DataFrame:
    """What is still to be fetched, by what has landed: one request for each missing page.

    An index whose page 1 landed asks for the pages 2..totalPages that did
    not; one whose page 1 did not land asks for page 1 (its page count is
    not known before).  ``wanted``: a frame whose ``index`` column names the
    indices of the run, so that one of which nothing landed asks for page 1.
    """
    first = missing_first_pages(pages)
    if wanted is not None:
        landed = pages.select(F.col("index").alias("landed_index"))
        none = wanted.select(F.col("index").cast("string").alias("index")).distinct().join(landed, F.col("index").eqNullSafe(F.col("landed_index")), "left_anti")
        first = first.unionByName(none)
    missing = first.withColumn("page_number", F.lit(1).cast("long")).unionByName(missing_pages(pages, all_pages).select("index", "page_number"))
    base = missing.select("index", F.lit(language).alias("language"), F.lit(page_size).cast("long").alias("page_size"), "page_number")
    return _with_urls(base, base_url)
