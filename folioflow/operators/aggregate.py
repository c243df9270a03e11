"""The portfolio aggregation (A1) with its renames and date column."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioflow.functions.dates import as_date
from folioflow.functions.numbers import sum_double, sum_long, sums
from folioflow.schemas import REQUIRED_COLUMNS


class MissingColumns(ValueError):
    pass


def require_columns(df: DataFrame, required: tuple[str, ...] = REQUIRED_COLUMNS) -> None:
    """Schema-only check, no job."""
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise MissingColumns(f"required columns not found: {missing}")


def asset_groups(
    raw: DataFrame,
    by: tuple[str, ...] = (),
    extra: dict[str, Column] | None = None,
) -> DataFrame:
    """The aggregation behind the portfolio: one row per (``by``, asset), NULL asset included.

    ``extra`` adds more aggregates to the same pass (the quality report
    derives its raw-side metrics from them).  The plan is a partial
    HashAggregate per task, one exchange of at most (groups × tasks) rows,
    and a final HashAggregate: a hot asset is reduced map-side, so skew on
    the key does not reach the shuffle.
    """
    require_columns(raw)
    aggs = [
        F.count("cod").alias("qtd_codigo"),
        sum_double(sums("part")).alias("participacao"),
        sum_long(sums("theoricalQty")).alias("qtd_teorica_total"),
        F.count("asset").alias("_assets"),
    ]
    aggs += [c.alias(name) for name, c in (extra or {}).items()]
    return raw.groupBy(*by, "asset").agg(*aggs)


def finish_portfolio(groups: DataFrame, run_date: dt.date | str | None = None, by: tuple[str, ...] = ()) -> DataFrame:
    """Drop the NULL-asset group (zero ``count(asset)``), rename, add ``data``."""
    day = as_date(run_date).isoformat()
    return groups.where(F.col("_assets") > 0).select(
        *by,
        F.col("asset").alias("acao"),
        "qtd_codigo",
        "participacao",
        "qtd_teorica_total",
        F.lit(day).alias("data"),
    )


def portfolio_by_asset(
    raw: DataFrame,
    run_date: dt.date | str | None = None,
    by: tuple[str, ...] = (),
) -> DataFrame:
    """Group codes by asset: code count, summed participation, summed theoretical quantity.

    * rows without an asset are dropped (not a NULL group): the NULL group
      is removed *after* aggregating, by its zero ``count(asset)``.  A
      filter on the key would be pushed by the optimizer down to the scan
      (through any repartition), where the whole cleaning expression of
      ``asset`` would run before the work is spread; a filter on an
      aggregate value stays where it is;
    * ``qtd_codigo`` counts non-NULL codes, repeats included;
    * sums skip NULLs, and a group with nothing to sum gives 0;
    * sums run on exact decimals, so the totals do not depend on how rows
      are spread over tasks (re-runs and retries give identical output);
      values that no decimal holds exactly are added as doubles, none is
      rounded or dropped, and a quantity that no long holds raises;
    * ``data`` is the run date as ``YYYY-MM-DD`` (one bound value);
    * ``by`` adds leading keys (e.g. the partition columns for a backfill).
    """
    return finish_portfolio(asset_groups(raw, by), run_date, by)
