"""Daily-partitioned Parquet sink (K1, K2, K3, K7)."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from folioflow.functions.dates import as_date, partition_columns
from folioflow.schemas import PARTITION_COLUMNS


class EmptyOutput(RuntimeError):
    """Nothing to write: the existing data was left as it was."""


@dataclass(frozen=True)
class WriteResult:
    path: str
    record_count: int
    partition_date: dt.date | None
    # values of (leading.., year, month, day) of every directory that was replaced
    days: tuple[tuple[str, ...], ...] = ()

    @property
    def ok(self) -> bool:
        return self.record_count > 0


def with_partition_columns(df: DataFrame, day: dt.date | str | None = None, date_col: Column | str | None = None) -> DataFrame:
    """K7: ``year``, ``month``, ``day`` text from one date literal, or per row from ``date_col``."""
    if date_col is None:
        source = F.lit(as_date(day))
    else:
        source = _present(F.col(date_col) if isinstance(date_col, str) else date_col, "day")
    return df.withColumns(partition_columns(source))


def _present(c: Column, name: str) -> Column:
    """``c``; a NULL fails the write (its directory would be one that no read returns)."""
    return F.coalesce(c, F.raise_error(F.lit(f"NULL {name} in a partitioned write")))


def write_daily(
    df: DataFrame,
    path: str,
    day: dt.date | str | None = None,
    *,
    date_col: Column | str | None = None,
    leading: tuple[str, ...] = (),
    max_records_per_file: int = 5_000_000,
    raise_on_empty: bool = True,
    drop_date_col: bool = False,
) -> WriteResult:
    """Write ``df`` under ``path/[index=..]/year=YYYY/month=MM/day=DD``.

    * **Only the days present are replaced** (dynamic partition overwrite),
      so a re-run rewrites its own day and leaves every other day intact.
    * **Empty guard**: an empty input writes no partition, so the
      existing data of that day is untouched; the observed count then
      reports the failure.  The count is taken while writing (an
      ``Observation`` in the final stage), so there is no second pass; the
      days written come from the same observation (one entry a directory).
    * **NULL keys**: a NULL day or leading key fails the write.
    * **File sizing**: a ``rebalance`` lets adaptive execution merge small
      output partitions and split large ones.  For a literal day it has no
      key (rows are dealt round robin); with ``date_col`` it goes by the
      partition columns, and a day much larger than the rest becomes several
      files written by several tasks.
    * **No sort for a literal day**: its columns are added after the
      rebalance, where they are still constants; rows that are already dealt
      would be sorted by them, and a task would hold its file's rows.
    * Task retries and lost executors are handled by the file commit
      protocol: only committed task output is moved into place.
    """
    one_directory = date_col is None and not leading
    staged = df if one_directory else with_partition_columns(df, day, date_col)
    if drop_date_col and isinstance(date_col, str):
        staged = staged.drop(date_col)
    for name in leading:
        staged = staged.withColumn(name, _present(F.col(name), name))
    cols = [*leading, *PARTITION_COLUMNS]
    # One day of one directory needs no key: rows are dealt round robin into
    # files of the advisory size.  Else rows go by their directory.
    by = [] if one_directory else cols if date_col is not None else list(leading)
    directory = F.array(*(partition_columns(F.lit(as_date(day))).values() if one_directory else cols))
    observation = Observation()
    staged = staged.hint("rebalance", *by).observe(observation, F.count(F.lit(1)).alias("rows"), F.collect_set(directory).alias("days"))
    if one_directory:
        staged = with_partition_columns(staged, day)
    (
        staged.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("maxRecordsPerFile", max_records_per_file)
        .partitionBy(*cols)
        .parquet(path)
    )
    seen = observation.get
    result = WriteResult(
        path=path,
        record_count=int(seen.get("rows", 0) or 0),
        partition_date=as_date(day) if date_col is None else None,
        days=tuple(sorted(tuple(d) for d in seen.get("days") or ())),
    )
    if not result.ok and raise_on_empty:
        raise EmptyOutput(f"no rows to write to {path}; existing data left unchanged")
    return result
