"""Counts out of Parquet footers, and the files of a tree by their days: no data page is read.

Spark's V2 Parquet reader answers COUNT over whole partitions from the
footers.  The setting belongs to a session, so these frames run in one of
their own (same cluster, same catalog) and are meant to be collected or
written, not joined with frames of another session.

Only counts are asked for: a footer has no minimum or maximum of a column
that is NULL in a whole row group, and such a read fails.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from folioflow.schemas import PARTITION_COLUMNS, RAW, quoted, with_partitions


def footer_session(spark: SparkSession) -> SparkSession:
    """A session that reads Parquet by the V2 reader and pushes aggregates into it."""
    session = spark.newSession()
    session.conf.set("spark.sql.sources.useV1SourceList", "")
    session.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    session.conf.set("spark.sql.session.timeZone", spark.conf.get("spark.sql.session.timeZone"))
    return session


def day_directories(path: str, days: list[tuple[str, ...]], leading: tuple[str, ...] = ()) -> list[str]:
    """The directories of written days, given as values of (leading.., year, month, day)."""
    names = (*leading, *PARTITION_COLUMNS)
    return ["/".join([path.rstrip("/"), *(f"{n}={v}" for n, v in zip(names, day))]) for day in days]


def _tree(spark: SparkSession, path: str, schema: StructType, leading: tuple[str, ...], days: list[tuple[str, ...]] | None) -> DataFrame:
    reader = footer_session(spark).read.schema(with_partitions(schema, leading))
    if days is None:
        return reader.parquet(path)
    return reader.option("basePath", path).parquet(*day_directories(path, days, leading))


def footer_counts(
    spark: SparkSession,
    path: str,
    schema: StructType = RAW,
    leading: tuple[str, ...] = (),
    days: list[tuple[str, ...]] | None = None,
) -> DataFrame:
    """A2: rows of each day of a tree (or of the ``days`` given): ``(leading.., year, month, day, record_count)``."""
    keys = [*leading, *PARTITION_COLUMNS]
    return _tree(spark, path, schema, leading, days).groupBy(*keys).agg(F.count(F.lit(1)).alias("record_count"))


def footer_null_counts(
    spark: SparkSession,
    path: str,
    schema: StructType = RAW,
    leading: tuple[str, ...] = (),
    days: list[tuple[str, ...]] | None = None,
) -> DataFrame:
    """``(column_name, null_count)`` of every data column of a tree."""
    names = schema.fieldNames()
    rows = _tree(spark, path, schema, leading, days)
    wide = rows.agg(F.count(F.lit(1)).alias("n"), *[F.count(F.col(quoted(c))).alias(f"c{i}") for i, c in enumerate(names)])
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), (F.col("n") - F.col(f"c{i}")).alias("null_count")) for i, c in enumerate(names)])
    return wide.select(F.inline(pairs))


def day_files(spark: SparkSession, path: str, leading: tuple[str, ...] = ()) -> DataFrame:
    """The Parquet files of a tree: ``(leading.., year, month, day, path, modified)``; names and times only."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(path)
    keys = [F.regexp_extract("path", f"/{n}=([^/]*)/", 1).alias(n) for n in (*leading, *PARTITION_COLUMNS)]
    return files.select(*keys, "path", F.col("modificationTime").alias("modified"))
