"""Landed response pages (S1–S3) and page arithmetic (A3).

A *pages frame* has one row per landed response:

``index, page_number, page_size, total_pages, total_records, header, results, corrupt_record,
landed_at, body_hash``

It is built either from files (:func:`read_pages`, one JSON document per
file or JSON Lines) or from a text column holding response bodies
(:func:`parse_pages`).  Both end in :func:`normalise_pages`, so every
operator downstream is the same.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from folioflow.schemas import CORRUPT_COLUMN, landed_page
from folioflow.session import shared_dir

JSON_OPTIONS = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT_COLUMN}

# Page number from a landed file name such as ``page-0003.json`` (only for
# bodies without one, and only where a file is one response).
FILE_PAGE_NUMBER = r"^page-?([0-9]+)\.[A-Za-z.]+$"

# No index has more pages than this; a larger ``totalPages`` is bad input.
MAX_TOTAL_PAGES = 1_000_000

# Pages landed more than once (under 100 bytes each) that may be broadcast.
BROADCAST_REPEATS = 200_000


def read_pages(
    spark: SparkSession,
    path: str | list[str],
    *,
    multi_line: bool = True,
    index: str | None = None,
    extra: tuple[str, ...] = (),
) -> DataFrame:
    """Read landed response bodies; ``extra``: keys of the records that are read besides the fixed ones.

    ``multi_line=True``: one (possibly pretty-printed) JSON document per
    file; a file is never split, and small files are packed several to a
    task.  A page holds at most the API page size (1200 records), so no
    file is large.  ``multi_line=False``: JSON Lines, one response per
    line, split like any text file.

    A file that is not JSON becomes a row with ``corrupt_record`` set and
    no results.  The response body does not name its index; it comes from
    an ``index=`` directory level, or an ``index`` field landed beside the
    response fields, else from the ``index`` argument.  A body without a
    page number takes it from a file name like ``page-0003.json``, never in
    JSON Lines; pages left without one are in :func:`unnumbered_pages`.
    """
    # ``index`` is declared as text so a discovered ``index=007`` directory keeps
    # its zeros (an inferred partition type would make it the integer 7).
    schema = StructType(landed_page(extra).fields + [StructField("index", StringType())])
    reader = spark.read.schema(schema).options(**JSON_OPTIONS).option("multiLine", multi_line)
    df = reader.json(path)
    df = df.withColumns(
        {
            "_source_file": F.col("_metadata.file_name") if multi_line else F.lit(None).cast("string"),
            "_landed_at": F.col("_metadata.file_modification_time"),
        }
    )
    index_col = F.coalesce(F.col("index"), F.lit(index).cast("string"))
    return normalise_pages(df, index_col=index_col, file_col=F.col("_source_file"))


def parse_pages(df: DataFrame, body: str = "body", index: str | Column | None = None, extra: tuple[str, ...] = ()) -> DataFrame:
    """Response bodies held in a text column → pages frame (``from_json``).

    The parse goes through a one-element ``inline``: a filter on the
    parsed fields (page 1 only, usable pages...) cannot be pushed below a
    generator, so each body is parsed exactly once.  Through a plain
    projection the optimizer would substitute ``from_json`` into every
    pushed predicate and parse the same text several times.
    """
    parsed = df.select(
        *[c for c in df.columns if c != body],
        F.inline(F.array(F.from_json(F.col(body), landed_page(extra), JSON_OPTIONS))),
    )
    if index is None:
        index_col = F.col("index") if "index" in df.columns else F.lit(None).cast("string")
    else:
        index_col = F.col(index) if isinstance(index, str) else index
    file_col = F.col("_source_file") if "_source_file" in df.columns else F.lit(None).cast("string")
    return normalise_pages(parsed, index_col=index_col, file_col=file_col)


def page_number(body: Column, file_name: Column) -> Column:
    """The page number of a body, else that of its file's name."""
    return F.coalesce(body, F.nullif(F.regexp_extract(file_name, FILE_PAGE_NUMBER, 1), F.lit("")).try_cast("long"))


def normalise_pages(df: DataFrame, *, index_col: Column, file_col: Column) -> DataFrame:
    """Common shape; ``totalPages`` absent → 1, page number from the body or the file name."""
    return df.select(
        index_col.cast("string").alias("index"),
        page_number(F.col("page.pageNumber"), file_col).alias("page_number"),
        F.col("page.pageSize").alias("page_size"),
        F.coalesce(F.col("page.totalPages"), F.lit(1).cast("long")).alias("total_pages"),
        F.col("page.totalRecords").alias("total_records"),
        F.col("header"),
        F.col("results"),
        F.col(CORRUPT_COLUMN).alias("corrupt_record"),
        (F.col("_landed_at") if "_landed_at" in df.columns else F.lit(None)).cast("timestamp").alias("landed_at"),
        F.xxhash64(F.to_json(F.struct("page", "header", "results"))).alias("body_hash"),
    )


def parsed(pages: DataFrame) -> DataFrame:
    """Pages that parsed, with or without ``results``."""
    return pages.where(F.col("corrupt_record").isNull())


def usable(pages: DataFrame) -> DataFrame:
    """Pages that parsed and carry a ``results`` list (possibly empty)."""
    return parsed(pages).where(F.col("results").isNotNull())


def unnumbered_pages(pages: DataFrame) -> DataFrame:
    """Pages that parsed but have no page number: their rows belong to no place in the run and are not used."""
    return parsed(pages).where(F.col("page_number").isNull()).select("index", "total_records")


def select_pages(pages: DataFrame, all_pages: bool) -> DataFrame:
    """Page 1 only, or every landed page (UNION ALL in page order is implicit).

    A page without ``results`` stays: it has no rows, but page 1's header
    and page count hold for the whole index.
    """
    good = parsed(pages)
    return good.where(F.col("page_number").isNotNull()) if all_pages else good.where(F.col("page_number") == 1)


def _copies(pages: DataFrame) -> DataFrame:
    """Pages landed more than once: (``index``, ``page_number``, ``copies``, ``versions``, ``chosen``, ``chosen_at``, ``equal``).

    Only numbers, file times and body hashes are shuffled.  Of several copies
    the one landed last is used, of those the one with the smallest hash;
    ``equal`` copies are like it in both.
    """
    numbered = parsed(pages).where(F.col("page_number").isNotNull())
    versions = numbered.groupBy("index", "page_number", "body_hash", "landed_at").agg(F.count(F.lit(1)).alias("n"))
    last = F.max_by(F.struct("body_hash", "landed_at", "n"), F.struct("landed_at", -F.col("body_hash").cast("decimal(20,0)"))).alias("last")
    together = versions.groupBy("index", "page_number").agg(
        F.sum("n").alias("copies"), F.size(F.collect_set("body_hash")).cast("long").alias("versions"), last
    )
    return together.where("copies > 1").select(
        "index", "page_number", "copies", "versions", F.col("last.body_hash").alias("chosen"), F.col("last.landed_at").alias("chosen_at"), F.col("last.n").alias("equal")
    )


def repeated_pages(pages: DataFrame) -> DataFrame:
    """Pages that landed more than once (a retry): copies, different bodies among them, and whether they conflict."""
    return _copies(pages).select("index", "page_number", "copies", "versions", (F.col("versions") > 1).alias("conflict"))


def single_copies(pages: DataFrame) -> DataFrame:
    """The pages with one copy of each (index, page number), as each is asked for once.

    The repeated ones are few; up to BROADCAST_REPEATS of them (counted) are
    broadcast, so no body is shuffled.  Only where a page landed twice with
    the same file time and body are its copies brought together.  Pages
    without a number, and bodies that did not parse, stay as they are.
    """
    shared_dir(pages.sparkSession)
    again = _copies(pages).select(
        F.col("index").alias("again_index"), F.col("page_number").alias("again_number"), "chosen", "chosen_at", "equal"
    ).checkpoint()
    counts = again.agg(F.count(F.lit(1)).alias("n"), F.max("equal").alias("equal")).first()
    if not counts["n"]:
        return pages
    small = F.broadcast(again) if counts["n"] <= BROADCAST_REPEATS else again
    numbered = F.col("corrupt_record").isNull() & F.col("page_number").isNotNull()
    same = numbered & F.col("index").eqNullSafe(F.col("again_index")) & (F.col("page_number") == F.col("again_number"))
    marked = pages.join(small, same, "left")
    right = (F.col("body_hash") == F.col("chosen")) & F.col("landed_at").eqNullSafe(F.col("chosen_at"))
    kept = marked.where(F.col("again_number").isNull() | right)
    if counts["equal"] == 1:
        return kept.select(pages.columns)
    alone = kept.where(F.col("equal").isNull() | (F.col("equal") == 1)).select(pages.columns)
    alike = kept.where(F.col("equal") > 1).select(pages.columns)
    # equal bodies: any one of them; VARIANT fields cannot be grouped by, so they are chosen by key
    return alone.unionByName(alike.dropDuplicates(["index", "page_number"]))


def first_pages(pages: DataFrame) -> DataFrame:
    return parsed(pages).where(F.col("page_number") == 1)


def missing_first_pages(pages: DataFrame) -> DataFrame:
    """Indices that landed something but no parsed page 1 (fatal for that index); a NULL index counts as one."""
    landed = pages.select("index").distinct()
    first = first_pages(pages).select(F.col("index").alias("first_index"))
    return landed.join(first, F.col("index").eqNullSafe(F.col("first_index")), "left_anti")


def page_numbers(total: Column) -> Column:
    """``1..total`` (1 at least) as an array; a total beyond any real one raises instead of filling a task."""
    checked = F.when(
        total > MAX_TOTAL_PAGES, F.raise_error(F.concat(F.lit("totalPages out of range: "), total.cast("string")))
    ).otherwise(F.greatest(total, F.lit(1).cast("long")))
    return F.sequence(F.lit(1).cast("long"), checked.cast("long"))


def missing_pages(pages: DataFrame, all_pages: bool = True) -> DataFrame:
    """Pages 2..totalPages (from page 1) that did not arrive parsed.

    With ``all_pages=False`` only page 1 is requested, so nothing is missing.
    The page count is taken once per index (a page 1 landed twice does not
    double the report); the expected set has one row per page, not per
    record, and the anti join is keyed on (index, page) so no key is hot.
    """
    announced = first_pages(pages).groupBy("index").agg(F.max("total_pages").alias("total_pages"))
    total = F.col("total_pages") if all_pages else F.lit(1).cast("long")
    expected = announced.select("index", F.explode(page_numbers(total)).alias("page_number"))
    landed = parsed(pages).select(F.col("index").alias("landed_index"), F.col("page_number").alias("landed_page"))
    same = F.col("index").eqNullSafe(F.col("landed_index")) & (F.col("page_number") == F.col("landed_page"))
    return expected.join(landed, same, "left_anti")


def consolidated_counts(pages: DataFrame, all_pages: bool = True) -> DataFrame:
    """A3: records per index (what replaces ``totalRecords``), pages landed, pages announced.

    Counts the pages whose rows are used: those of an index with a page 1,
    numbered up to its ``totalPages``.
    """
    chosen = select_pages(pages, all_pages)
    # one row per (index, page number) comes out of the first aggregation, so
    # the second knows page 1's count without a join of the pages
    per_page = chosen.groupBy("index", "page_number").agg(
        F.sum(F.coalesce(F.size("results"), F.lit(0))).cast("long").alias("records"),
        F.count(F.lit(1)).alias("pages"),
        F.max("total_pages").alias("total_pages"),
    )
    first = per_page.where("page_number = 1").select(
        F.col("index").alias("first_index"), F.greatest("total_pages", F.lit(1)).alias("last_page"), F.col("total_pages").alias("announced")
    )
    used = per_page.join(first, F.col("index").eqNullSafe(F.col("first_index"))).where("page_number <= last_page")
    return used.groupBy("index").agg(
        F.sum("records").alias("total_records"), F.sum("pages").alias("pages_landed"), F.max("announced").alias("total_pages")
    )
