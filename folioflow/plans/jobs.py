"""Jobs the user runs (G1–G4): each is one lazy plan and one write.

The driver only ever sees counts (observed during the write) and the
schema; the data stays in the cluster from scan to sink.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, replace

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioflow.functions.dates import as_date, partition_date
from folioflow.operators.aggregate import portfolio_by_asset
from folioflow.operators.clean import to_raw, unparsed_numbers
from folioflow.operators.flatten import flatten_results
from folioflow.options import RAW_SOURCE, TRANSFORMED_SOURCE, JobOptions
from folioflow.schemas import PARTITION_COLUMNS, PORTFOLIO, RAW, RESULT, quoted, with_partitions
from folioflow.sinks.audit import append_audit, append_range_audit
from folioflow.sinks.catalog import publish_table
from folioflow.sinks.daily import WriteResult, write_daily
from folioflow.sinks.gate import Measure, RowRule, portfolio_measures, raw_measures, write_checked
from folioflow.sources.daily import read_day, read_days
from folioflow.sources.footers import day_directories, day_files
from folioflow.sources.manifest import followup_requests, request_manifest
from folioflow.sources.pages import (
    consolidated_counts,
    missing_first_pages,
    missing_pages,
    read_pages,
    repeated_pages,
    select_pages,
    single_copies,
    unnumbered_pages,
)
from folioflow.sources.records import extra_keys, read_records, unknown_keys


@dataclass(frozen=True)
class ExtractReport:
    write: WriteResult
    missing_pages: DataFrame  # pages 2..totalPages that did not arrive (lazy; empty when only page 1 is asked for)
    missing_first_pages: DataFrame  # indices with no page 1: their rows were not written (lazy)
    unnumbered_pages: DataFrame  # pages without a page number: their rows were not written (lazy)
    counts: DataFrame  # records and pages per index (lazy)
    unparsed_numbers: DataFrame  # per numeric column, text that parsed to NULL (lazy)
    repeated_pages: DataFrame  # pages landed more than once; one copy was written (lazy)
    unknown_keys: DataFrame | None = None  # keys of the records outside the schema and ``extra_columns``: not written (lazy)

    def losses(self) -> dict[str, int]:
        """Everything that landed or was announced and is not in the written rows."""
        unparsed = {f"unparsed_{r['column_name']}": r["unparsed"] for r in self.unparsed_numbers.collect()}  # a row per column
        rare = {"conflicting_pages": self.repeated_pages.where("conflict").count()}
        if self.unknown_keys is not None:
            rare["unknown_keys"] = self.unknown_keys.select("key").distinct().count()
        return {
            "missing_pages": self.missing_pages.count(),
            "missing_first_pages": self.missing_first_pages.count(),
            "unnumbered_pages": self.unnumbered_pages.count(),
            **{k: n for k, n in rare.items() if n},  # named only where there are any
            **unparsed,
        }


def run_pages(pages: DataFrame, opts: JobOptions) -> DataFrame:
    """The pages of this run: without an index in the layout, only those of ``opts.index``."""
    return pages if opts.keeps_index else pages.where(F.col("index") == opts.index)


def extract_frame(pages: DataFrame, opts: JobOptions) -> DataFrame:
    """Pages → raw rows of this run (no write)."""
    chosen = select_pages(run_pages(pages, opts), opts.all_pages)
    raw = to_raw(
        chosen, opts.run_timestamp, opts.number_mode,
        keep_index=opts.keeps_index, header_from_first_page=opts.all_pages, extra=opts.extra_columns,
    )
    if opts.index_mode == "column":
        raw = raw.select("index", *RAW.fieldNames(), *map(quoted, opts.extra_columns))
    return raw


def extract_job(
    spark: SparkSession,
    landing: str | list[str],
    opts: JobOptions,
    *,
    multi_line: bool = True,
    partition_day: dt.date | str | None = None,
    rules: tuple[RowRule, ...] = (),
    measures: tuple[Measure, ...] = (),
) -> ExtractReport:
    """G1: landed pages → raw daily partition (default: the run date), plus audit.

    An index whose page 1 did not land contributes no rows (page 1 carries
    the page count and the header), and is listed in the report.  If
    nothing at all is written, :class:`~folioflow.sinks.daily.EmptyOutput`
    is raised and the day's previous data is left in place.

    A page that landed more than once (a retry) is written once, by its last
    copy.  Keys of the records outside the schema are listed in the report;
    those in ``opts.extra_columns`` are kept as text.

    ``rules`` and ``measures`` are checked while writing and stop it
    (:class:`~folioflow.sinks.gate.ChecksFailed`): rules within the writing
    job, measures by one more copy of the rows in the checkpoint folder.
    """
    pages = read_pages(spark, landing, multi_line=multi_line, index=opts.index, extra=opts.extra_columns)
    records = run_pages(read_records(spark, landing, multi_line=multi_line, index=opts.index), opts)
    report = extract_pages(spark, pages, opts, partition_day=partition_day, rules=rules, measures=measures)
    known = (*RESULT.fieldNames(), *opts.extra_columns)
    return replace(report, unknown_keys=unknown_keys(records if opts.all_pages else records.where("page_number = 1"), known))


def with_every_key(spark: SparkSession, landing: str | list[str], opts: JobOptions, *, multi_line: bool = True) -> JobOptions:
    """``opts`` that keep every key of the landed records (one pass over the landing to find them)."""
    return replace(opts, extra_columns=extra_keys(run_pages(read_records(spark, landing, multi_line=multi_line, index=opts.index), opts)))


def extract_pages(
    spark: SparkSession,
    pages: DataFrame,
    opts: JobOptions,
    *,
    partition_day: dt.date | str | None = None,
    rules: tuple[RowRule, ...] = (),
    measures: tuple[Measure, ...] = (),
) -> ExtractReport:
    """:func:`extract_job` on a pages frame (without the report of unknown keys, which a pages frame no longer has)."""
    day = as_date(partition_day) if partition_day is not None else opts.run_date
    landed = run_pages(pages, opts)
    pages = single_copies(landed)
    raw = extract_frame(pages, opts)
    result = write_checked(raw, opts.raw_path, day, rules=rules, measures=measures, leading=opts.leading_partitions)[0]
    append_audit(spark, opts.audit_path, result, RAW_SOURCE, opts.run_timestamp)
    chosen = select_pages(pages, opts.all_pages)
    return ExtractReport(
        write=result,
        missing_pages=missing_pages(pages, opts.all_pages),
        missing_first_pages=missing_first_pages(pages),
        unnumbered_pages=unnumbered_pages(pages),
        counts=consolidated_counts(pages, opts.all_pages),
        unparsed_numbers=unparsed_numbers(flatten_results(chosen, opts.all_pages), opts.number_mode),
        repeated_pages=repeated_pages(landed if opts.all_pages else landed.where("page_number = 1")),
    )


def transform_frame(raw: DataFrame, opts: JobOptions, by: tuple[str, ...] = ()) -> DataFrame:
    return portfolio_by_asset(raw, opts.run_date, by=(*opts.group_keys, *by))


def transform_job(
    spark: SparkSession,
    opts: JobOptions,
    source_date: dt.date | str | None = None,
    target_date: dt.date | str | None = None,
    *,
    measures: tuple[Measure, ...] = (),
) -> WriteResult:
    """One raw day → portfolio → transformed partition ``target_date``, plus audit.

    ``measures``: checks taken while the portfolio is computed; if one fails
    (:class:`~folioflow.sinks.gate.ChecksFailed`) the day stays as it was and
    nothing is audited.

    ``source_date``/``target_date`` default to the run date; ``data`` is
    always the run date, independent of both.
    """
    source = as_date(source_date) if source_date is not None else opts.run_date
    target = as_date(target_date) if target_date is not None else opts.run_date
    raw = read_day(spark, opts.raw_path, source, opts.raw_schema, opts.leading_partitions)
    result = transform_frame(raw, opts)
    written = write_checked(result, opts.transformed_path, target, measures=measures, leading=opts.leading_partitions)[0]
    append_audit(spark, opts.audit_path, written, TRANSFORMED_SOURCE, opts.run_timestamp)
    return written


def backfill_transform(
    spark: SparkSession,
    opts: JobOptions,
    start: dt.date | str | None = None,
    end: dt.date | str | None = None,
) -> WriteResult:
    """G2 over a date range (open where a bound is None) in one job: group by (day, asset), each source day → same target day.

    The partition columns lead the grouping, so the result is already
    keyed by output directory; only days that have data are replaced.
    """
    raw = read_days(spark, opts.raw_path, start, end, opts.raw_schema, opts.leading_partitions)
    return _write_range(spark, raw, opts)


def _write_range(spark: SparkSession, raw: DataFrame, opts: JobOptions) -> WriteResult:
    """Raw rows of several days → their portfolio days, each audited by the footers of its files."""
    written = write_daily(
        transform_frame(raw, opts, by=PARTITION_COLUMNS).select(*opts.group_keys, *PARTITION_COLUMNS, *PORTFOLIO.fieldNames()),
        opts.transformed_path,
        date_col=partition_date(),
        leading=opts.leading_partitions,
    )
    append_range_audit(
        spark, opts.audit_path, written, TRANSFORMED_SOURCE, opts.run_timestamp, opts.portfolio_schema, opts.leading_partitions
    )
    return written


def changed_days(spark: SparkSession, opts: JobOptions) -> list[tuple[str, ...]]:
    """Raw days whose portfolio day is missing or older than one of the raw files; file names and times only."""
    keys = [*opts.leading_partitions, *PARTITION_COLUMNS]

    def last(path: str, name: str) -> DataFrame:
        try:
            files = day_files(spark, path, opts.leading_partitions)
        except AnalysisException as exc:
            if "PATH_NOT_FOUND" not in str(exc):
                raise
            return spark.createDataFrame([], ", ".join(f"{k} string" for k in keys) + f", {name} timestamp")
        return files.groupBy(*keys).agg(F.max("modified").alias(name))

    source, target = last(opts.raw_path, "read_from"), last(opts.transformed_path, "written")
    stale = source.join(target, keys, "left").where("written is null or read_from >= written")
    return sorted(tuple(r) for r in stale.select(*keys).collect())  # a row for each changed day


def backfill_changed(spark: SparkSession, opts: JobOptions) -> WriteResult | None:
    """G2, only where it is needed: the days of :func:`changed_days` are read, transformed and audited; None if there is none.

    A raw day without any asset has no portfolio day and is tried again each time.
    """
    days = changed_days(spark, opts)
    if not days:
        return None
    schema = with_partitions(opts.raw_schema, opts.leading_partitions)
    raw = spark.read.schema(schema).option("basePath", opts.raw_path).parquet(*day_directories(opts.raw_path, days, opts.leading_partitions))
    return _write_range(spark, raw, opts)


def run_all(
    spark: SparkSession,
    landing: str | list[str],
    opts: JobOptions,
    *,
    multi_line: bool = True,
    day: dt.date | str | None = None,
    checks: bool = False,
) -> tuple[ExtractReport, WriteResult]:
    """Extract into ``day`` (default: the run date), then transform that day; the first failure raises and stops.

    ``checks``: a failing check of the raw or the portfolio day is such a failure.
    """
    day = as_date(day) if day is not None else opts.run_date
    report = extract_job(spark, landing, opts, multi_line=multi_line, partition_day=day, measures=raw_measures() if checks else ())
    written = transform_job(spark, opts, day, day, measures=portfolio_measures() if checks else ())
    return report, written


def write_manifest(spark: SparkSession, opts: JobOptions, base_url: str, total_pages: int = 1) -> tuple[str, int]:
    """S4 as a job: the run's page requests (index, language and page size of ``opts``) under ``root/_manifest``."""
    one = spark.range(1).select(F.lit(opts.index).alias("index"), F.lit(opts.language).alias("language"))
    requests = request_manifest(one, base_url, page_size=opts.page_size, total_pages=total_pages if opts.all_pages else 1)
    path = f"{opts.root.rstrip('/')}/_manifest"
    requests.write.mode("overwrite").parquet(path)
    return path, spark.read.parquet(path).count()


def write_followups(
    spark: SparkSession, landing: str | list[str], opts: JobOptions, base_url: str, *, multi_line: bool = True
) -> tuple[str, int]:
    """S3 and S4 as a job: the requests that the landed pages still lack, under ``root/_manifest``; an empty one means that all has landed.

    The run fetches page 1 first and learns the page count from it, so this
    runs after each fetch until nothing is asked for.
    """
    pages = run_pages(read_pages(spark, landing, multi_line=multi_line, index=opts.index), opts)
    wanted = None if opts.keeps_index else spark.range(1).select(F.lit(opts.index).alias("index"))
    requests = followup_requests(
        pages, base_url, language=opts.language, page_size=opts.page_size, all_pages=opts.all_pages, wanted=wanted
    )
    path = f"{opts.root.rstrip('/')}/_manifest"
    requests.write.mode("overwrite").parquet(path)
    return path, spark.read.parquet(path).count()


def publish(
    spark: SparkSession, opts: JobOptions, table: str = "portfolio.raw_daily", written: WriteResult | None = None
) -> DataFrame:
    """Register the raw tree as an external partitioned table.

    A database that does not exist yet is created under the job root.
    ``written``: the write to publish; only its days are added to a table
    that is there already, instead of listing the whole tree.
    """
    return publish_table(
        spark,
        table,
        opts.raw_path,
        opts.raw_schema,
        opts.leading_partitions,
        database_location=f"{opts.root.rstrip('/')}/_catalog",
        days=None if written is None else written.days,
    )


def read_transformed_day(spark: SparkSession, opts: JobOptions, day: dt.date | str | None = None) -> DataFrame:
    return read_day(spark, opts.transformed_path, day, opts.portfolio_schema, opts.leading_partitions)


def audit_rows(spark: SparkSession, opts: JobOptions) -> DataFrame:
    from folioflow.sinks.audit import read_audit

    return read_audit(spark, opts.audit_path).orderBy(F.col("run_timestamp"))
