"""Date helpers: run clock, partition columns, formats."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from folioflow.schemas import PARTITION_COLUMNS


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_date(value: dt.date | str | None) -> dt.date:
    """Python value → date; ``None`` means today (read once per call site)."""
    if value is None:
        return dt.date.today()
    if isinstance(value, dt.datetime):
        return value.date()
    if isinstance(value, dt.date):
        return value
    return dt.date.fromisoformat(str(value))


def date_literal(value: dt.date | str | None) -> Column:
    return F.lit(as_date(value))


def timestamp_literal(value: dt.datetime) -> Column:
    """A naive local run timestamp as TIMESTAMP_NTZ (no session-zone shift)."""
    return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")


def iso_date_text(c: Column | str) -> Column:
    """``YYYY-MM-DD`` text of a date column."""
    return F.date_format(_col(c), "yyyy-MM-dd")


def compact_date_text(c: Column | str) -> Column:
    """``YYYYMMDD`` text of a date column."""
    return F.date_format(_col(c), "yyyyMMdd")


def partition_columns(c: Column | str) -> dict[str, Column]:
    """``year``, zero-padded ``month`` and ``day`` as text, ready for ``withColumns``."""
    d = _col(c)
    return dict(zip(PARTITION_COLUMNS, (F.date_format(d, "yyyy"), F.date_format(d, "MM"), F.date_format(d, "dd"))))


def partition_values(day: dt.date | str | None) -> dict[str, str]:
    """Python-side partition values of one day (for pruning predicates)."""
    d = as_date(day)
    return {"year": f"{d.year:04d}", "month": f"{d.month:02d}", "day": f"{d.day:02d}"}


def partition_predicate(day: dt.date | str | None) -> Column:
    """``year = .. AND month = .. AND day = ..``: a literal predicate Spark prunes directories with."""
    cond = None
    for name, value in partition_values(day).items():
        term = F.col(name) == F.lit(value)
        cond = term if cond is None else cond & term
    return cond


def partition_range_predicate(start: dt.date | str | None, end: dt.date | str | None) -> Column:
    """Days ``start..end`` inclusive (None: no bound), as a prunable predicate on the partition columns.

    The plain bounds on ``year`` alone are those that a metastore can use.
    """
    key = F.concat(*[F.col(c) for c in PARTITION_COLUMNS])
    out = F.lit(True)
    if start is not None:
        lo = partition_values(start)
        out = out & (F.col("year") >= lo["year"]) & (key >= "".join(lo.values()))
    if end is not None:
        hi = partition_values(end)
        out = out & (F.col("year") <= hi["year"]) & (key <= "".join(hi.values()))
    return out


def partition_date(prefix: str = "") -> Column:
    """The partition columns back as a DATE."""
    return F.make_date(*[F.col(prefix + c).cast("int") for c in PARTITION_COLUMNS])
