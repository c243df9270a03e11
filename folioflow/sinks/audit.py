"""K4: write audit - one row per write and day, appended to an audit table."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pyspark.sql.types import StructType

from folioflow.functions.dates import partition_date, timestamp_literal
from folioflow.options import SCHEMA_VERSION
from folioflow.schemas import AUDIT, PARTITION_COLUMNS
from folioflow.sinks.daily import WriteResult
from folioflow.sources.footers import footer_counts


def audit_frame(
    spark: SparkSession,
    result: WriteResult,
    source: str,
    run_timestamp: dt.datetime,
    schema_version: str = SCHEMA_VERSION,
    counts: DataFrame | None = None,
) -> DataFrame:
    """The audit rows of a write: one, counted by the write itself, or one per day of ``counts``.

    ``counts``: ``(year, month, day, record_count)`` of a write over several days.
    """
    if counts is not None:
        return counts.select(
            F.lit(source).alias("source"),
            F.lit(result.path).alias("target"),
            partition_date().alias("partition_date"),
            timestamp_literal(run_timestamp).alias("run_timestamp"),
            F.col("record_count").cast("long").alias("record_count"),
            F.lit(schema_version).alias("schema_version"),
        )
    row = (source, result.path, result.partition_date, run_timestamp, result.record_count, schema_version)
    return spark.createDataFrame([row], AUDIT)


def append_audit(
    spark: SparkSession,
    audit_path: str,
    result: WriteResult,
    source: str,
    run_timestamp: dt.datetime,
    schema_version: str = SCHEMA_VERSION,
    counts: DataFrame | None = None,
) -> DataFrame:
    frame = audit_frame(spark, result, source, run_timestamp, schema_version, counts)
    frame.coalesce(1).write.mode("append").parquet(audit_path)
    return frame


def append_range_audit(
    spark: SparkSession,
    audit_path: str,
    result: WriteResult,
    source: str,
    run_timestamp: dt.datetime,
    schema: StructType,
    leading: tuple[str, ...] = (),
    schema_version: str = SCHEMA_VERSION,
) -> DataFrame:
    """The audit of a write over several days, a row for each: the days come from the write itself, their rows from the footers.

    Nothing that was written is read again, whatever the range.
    """
    counts = footer_counts(spark, result.path, schema, leading, list(result.days))
    if leading:
        counts = counts.groupBy(*PARTITION_COLUMNS).agg(F.sum("record_count").alias("record_count"))
    return append_audit(spark, audit_path, result, source, run_timestamp, schema_version, counts)


def read_audit(spark: SparkSession, audit_path: str) -> DataFrame:
    return spark.read.schema(AUDIT).parquet(audit_path)
