"""Checks that are taken while writing, and a write that they can stop (Q1, Q7, Q9, Q10 in G1 and G2).

Two kinds, neither of which reads anything twice:

* a *row rule* fails on a single row.  It is part of the writing plan and
  fails the job at that row, before anything is committed.
* a *measure* is an aggregate (NULLs, a total, the number of rows).  All
  measures are observed while the result is stored once in the checkpoint
  folder; only if every one passes is that copy written to its place.

A write that is stopped leaves the days it would have replaced as they were.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from folioflow.functions.numbers import sum_double, sums
from folioflow.operators.quality import CHECK_SCHEMA
from folioflow.session import shared_dir
from folioflow.sinks.daily import WriteResult, write_daily

RULE_BROKEN = "row rule broken"


@dataclass(frozen=True)
class RowRule:
    """No row may make ``broken`` true (NULL is not true)."""

    name: str
    broken: Column


@dataclass(frozen=True)
class Measure:
    """An aggregate of all rows, and whether its value (a double, None if there is none) passes."""

    check: str
    column_name: str | None
    value: Column
    passes: Callable[[float | None], bool]


@dataclass(frozen=True)
class CheckResult:
    check: str
    column_name: str | None
    value: float | None
    passed: bool


class ChecksFailed(RuntimeError):
    """A check stopped the write; the existing data was left as it was."""

    def __init__(self, message: str, results: tuple[CheckResult, ...] = ()) -> None:
        super().__init__(message)
        self.results = results


def not_empty() -> Measure:
    """Q1."""
    return Measure("not_empty", None, F.count(F.lit(1)), lambda n: bool(n))


def no_nulls(column: str) -> Measure:
    """Q7."""
    return Measure("no_nulls", column, F.count_if(F.col(column).isNull()), lambda n: n == 0)


def no_negatives(column: str) -> Measure:
    """Q9."""
    return Measure("no_negatives", column, F.count_if(F.col(column) < 0), lambda n: n == 0)


def total_within(column: str, target: float = 100.0, tolerance: float | None = None) -> Measure:
    """Q10; without a tolerance the total is reported and passes."""
    ok = lambda t: tolerance is None or (t is not None and abs(t - target) <= tolerance)
    return Measure("total", column, sum_double(sums(column)), ok)


def portfolio_measures(tolerance: float | None = None) -> tuple[Measure, ...]:
    """What a portfolio day must hold to."""
    return (not_empty(), no_nulls("acao"), no_nulls("participacao"), no_negatives("participacao"), total_within("participacao", 100.0, tolerance))


def raw_measures(tolerance: float | None = None) -> tuple[Measure, ...]:
    """What a raw day must hold to."""
    return (not_empty(), no_nulls("cod"), no_nulls("asset"), no_negatives("part"), total_within("part", 100.0, tolerance))


def enforced(df: DataFrame, rules: tuple[RowRule, ...]) -> DataFrame:
    """``df``, whose job fails at the first row that breaks a rule."""
    for rule in rules:
        broken = F.coalesce(rule.broken, F.lit(False))
        df = df.where(F.when(broken, F.raise_error(F.lit(f"{RULE_BROKEN}: {rule.name}")).cast("boolean")).otherwise(F.lit(True)))
    return df


def measured(df: DataFrame, measures: tuple[Measure, ...]) -> tuple[DataFrame, tuple[CheckResult, ...]]:
    """``df`` stored in the checkpoint folder, and what was observed while storing it."""
    shared_dir(df.sparkSession)
    observation = Observation()
    values = [m.value.cast("double").alias(f"m{i}") for i, m in enumerate(measures)]
    stored = df.observe(observation, F.count(F.lit(1)).alias("rows"), *values).checkpoint(eager=True)
    seen = observation.get
    results = []
    for i, m in enumerate(measures):
        value = seen.get(f"m{i}")
        results.append(CheckResult(m.check, m.column_name, value, bool(m.passes(value))))
    return stored, tuple(results)


def write_checked(
    df: DataFrame,
    path: str,
    day: dt.date | str | None = None,
    *,
    measures: tuple[Measure, ...] = (),
    rules: tuple[RowRule, ...] = (),
    **options,
) -> tuple[WriteResult, tuple[CheckResult, ...]]:
    """:func:`~folioflow.sinks.daily.write_daily`, unless a check fails (:class:`ChecksFailed`)."""
    guarded = enforced(df, rules)
    results: tuple[CheckResult, ...] = ()
    try:
        if measures:
            guarded, results = measured(guarded, measures)
            failed = [r for r in results if not r.passed]
            if failed:
                names = ", ".join(f"{r.check}({r.column_name or '*'}) = {r.value}" for r in failed)
                raise ChecksFailed(f"{path} left unchanged: {names}", results)
        return write_daily(guarded, path, day, **options), results
    except PySparkException as exc:
        if RULE_BROKEN in str(exc):
            broken = next(r.name for r in rules if f"{RULE_BROKEN}: {r.name}" in str(exc))
            raise ChecksFailed(f"{path} left unchanged: a row breaks the rule {broken}") from exc
        raise


def check_rows(spark: SparkSession, results: tuple[CheckResult, ...]) -> DataFrame:
    """The results of a write's checks as ``(check, column_name, value, passed)`` rows."""
    return spark.createDataFrame([(r.check, r.column_name, r.value, r.passed) for r in results], CHECK_SCHEMA)
