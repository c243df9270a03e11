"""Reads of daily-partitioned Parquet trees."""

from __future__ import annotations

import datetime as dt

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from folioflow.functions.dates import as_date, partition_range_predicate, partition_values
from folioflow.schemas import RAW, with_partitions


class PartitionNotFound(LookupError):
    """The requested day has no data (the tree or the day is missing)."""


def read_tree(
    spark: SparkSession, path: str, schema: StructType = RAW, leading: tuple[str, ...] = ()
) -> DataFrame:
    """The whole tree, with partition discovery.

    The schema is declared (partition columns as text keep ``month=01``
    padded), so nothing is inferred and no footer is read up front.
    """
    return spark.read.schema(with_partitions(schema, leading)).parquet(path)


def _day_paths(path: str, day: dt.date | str | None, leading: tuple[str, ...]) -> str:
    """The day's directory (one per leading value)."""
    levels = [*(f"{c}=*" for c in leading), *(f"{k}={v}" for k, v in partition_values(day).items())]
    return "/".join([path.rstrip("/"), *levels])


def _read(spark: SparkSession, root: str, paths: str, schema: StructType, leading: tuple[str, ...], what: str) -> DataFrame:
    reader = spark.read.schema(with_partitions(schema, leading)).option("basePath", root)
    try:
        return reader.parquet(paths)
    except AnalysisException as exc:
        if "PATH_NOT_FOUND" in str(exc) or "Path does not exist" in str(exc):
            raise PartitionNotFound(f"no data for {what} under {root}") from exc
        raise


def read_day(
    spark: SparkSession,
    path: str,
    day: dt.date | str | None = None,
    schema: StructType = RAW,
    leading: tuple[str, ...] = (),
) -> DataFrame:
    """One day (default today): only its own directory is listed and read.

    A day without a directory raises :class:`PartitionNotFound`.
    """
    return _read(spark, path, _day_paths(path, day, leading), schema, leading, str(day or dt.date.today()))


def read_days(
    spark: SparkSession,
    path: str,
    start: dt.date | str | None = None,
    end: dt.date | str | None = None,
    schema: StructType = RAW,
    leading: tuple[str, ...] = (),
) -> DataFrame:
    """Days ``start..end`` inclusive, open where a bound is None (backfills), pruned by directory.

    With both bounds only the directories of their years are listed.
    """
    if start is None and end is None:
        return read_tree(spark, path, schema, leading)
    predicate = partition_range_predicate(start, end)
    if start is None or end is None:
        return read_tree(spark, path, schema, leading).where(predicate)
    years = ",".join(str(y).zfill(4) for y in range(as_date(start).year, as_date(end).year + 1))
    paths = "/".join([path.rstrip("/"), *(f"{c}=*" for c in leading), f"year={{{years}}}"])
    return _read(spark, path, paths, schema, leading, f"{start} to {end}").where(predicate)
