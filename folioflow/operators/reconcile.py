"""Reconcile a portfolio table against its source rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioflow.operators.aggregate import portfolio_by_asset


def reconcile(source: DataFrame, result: DataFrame, tolerance: float = 0.01, by: tuple[str, ...] = ()) -> DataFrame:
    """Assets whose stored aggregates disagree with a recomputation from ``source``.

    Checks: code count exact, participation within ``tolerance``, quantity
    exact.  A full outer join also catches assets present on one side only.
    Both sides have one row per (``by``, asset), so no join key is hot.
    An empty result means the table reconciles.
    """
    return reconcile_with(portfolio_by_asset(source, by=by), result, tolerance, by)


def reconcile_with(
    expected_portfolio: DataFrame, result: DataFrame, tolerance: float = 0.01, by: tuple[str, ...] = ()
) -> DataFrame:
    """:func:`reconcile` against an already recomputed portfolio."""
    expected = expected_portfolio.select(
        *by,
        F.col("acao"),
        F.col("qtd_codigo").alias("expected_qtd_codigo"),
        F.col("participacao").alias("expected_participacao"),
        F.col("qtd_teorica_total").alias("expected_qtd_teorica_total"),
    )
    actual = result.select(
        *by,
        F.col("acao"),
        F.col("qtd_codigo").alias("actual_qtd_codigo"),
        F.col("participacao").alias("actual_participacao"),
        F.col("qtd_teorica_total").alias("actual_qtd_teorica_total"),
    )
    joined = expected.join(actual, [*by, "acao"], "full_outer")
    count_ok = F.col("expected_qtd_codigo").eqNullSafe(F.col("actual_qtd_codigo"))
    part_ok = F.coalesce(
        F.abs(F.col("expected_participacao") - F.col("actual_participacao")) <= F.lit(tolerance), F.lit(False)
    )
    qty_ok = F.col("expected_qtd_teorica_total").eqNullSafe(F.col("actual_qtd_teorica_total"))
    return (
        joined.withColumns({"count_ok": count_ok, "participacao_ok": part_ok, "quantity_ok": qty_ok})
        .where(~(F.col("count_ok") & F.col("participacao_ok") & F.col("quantity_ok")))
    )


def check_reconcile(source: DataFrame, result: DataFrame, tolerance: float = 0.01) -> DataFrame:
    """Q5 as a check row: number of disagreeing assets."""
    n = reconcile(source, result, tolerance).agg(F.count(F.lit(1)).alias("n"))
    return n.select(
        F.lit("reconcile").alias("check"),
        F.lit("acao").alias("column_name"),
        F.col("n").cast("double").alias("value"),
        (F.col("n") == 0).alias("passed"),
    )
