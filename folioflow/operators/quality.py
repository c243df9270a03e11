"""Reusable data-quality checks (Q1–Q12) and the small aggregates behind them.

Every check is a distributed aggregation; nothing is collected to
compute it.  Checks that produce verdicts return rows of
``(check, column_name, value, passed)`` (:data:`CHECK_SCHEMA`), so a whole report is
a ``unionByName`` that can be appended to a table.  One-row frames are
combined by union + aggregate, never by a join.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, StringType, StructField, StructType

from folioflow.functions.dates import as_date
from folioflow.functions.numbers import add_sums, sum_double, sum_long, sums
from folioflow.schemas import DROPPED_COLUMNS, PORTFOLIO

CHECK_SCHEMA = StructType(
    [
        StructField("check", StringType()),
        StructField("column_name", StringType()),
        StructField("value", DoubleType()),
        StructField("passed", BooleanType()),
    ]
)


def _check(check: str, column: str | None, value: Column, passed: Column) -> list[Column]:
    return [
        F.lit(check).alias("check"),
        F.lit(column).cast("string").alias("column_name"),
        value.cast("double").alias("value"),
        passed.cast("boolean").alias("passed"),
    ]


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


def _merge_single_rows(frames: list[DataFrame]) -> DataFrame:
    """Several one-row frames with disjoint columns → one row (union + max, no join)."""
    names = [c for f in frames for c in f.columns]
    types = {n: t for f in frames for n, t in f.dtypes}
    typed = [
        f.select(*[F.col(n) if n in f.columns else F.lit(None).cast(types[n]).alias(n) for n in names])
        for f in frames
    ]
    return union_all(typed).agg(*[F.max(n).alias(n) for n in names])


# ---------------------------------------------------------------- aggregates


def row_count(df: DataFrame) -> DataFrame:
    """A2."""
    return df.agg(F.count(F.lit(1)).alias("row_count"))


def null_counts(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """NULL count of every column, one pass, long form ``(column_name, null_count)``."""
    columns = list(columns or df.columns)
    wide = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return wide.unpivot([], columns, "column_name", "null_count")


def duplicate_count(df: DataFrame, column: str) -> DataFrame:
    """Rows that repeat an earlier value of ``column`` (NULLs form one value).

    Two aggregations: per value (partial-aggregated, so a hot value is
    reduced per task before the shuffle), then a global sum.
    """
    per_value = df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    return per_value.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).cast("long").alias("duplicates"))


def negative_count(df: DataFrame, column: str) -> DataFrame:
    """F2 as a count: rows where ``column < 0``."""
    return df.agg(F.count_if(F.col(column) < 0).alias("negatives"))


def negative_rows(df: DataFrame, column: str) -> DataFrame:
    """the rows themselves."""
    return df.where(F.col(column) < 0)


def distinct_count(df: DataFrame, column: str) -> DataFrame:
    """A10: distinct non-NULL values."""
    return df.agg(F.count_distinct(column).alias("distinct_count"))


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    """A11."""
    return df.select(column).distinct()


def summary_stats(
    df: DataFrame,
    value: str = "part",
    label: str = "cod",
    quantity: str = "theoricalQty",
) -> DataFrame:
    """A4–A7, Q10, Q12 in one aggregation.

    ``argmax_label``: ``label`` of the row with the largest ``value``; ties
    go to the smallest non-NULL label (pandas' "first row" has no meaning
    on a distributed table).  Sums are exact decimals; the mean is rounded
    to 9 places so it does not depend on summation order.
    """
    v = F.col(value)
    lbl = F.col(label)
    order_key = F.when(
        v.isNotNull(), F.struct((-v).alias("neg"), lbl.isNull().alias("no_label"), lbl.alias("lbl"))
    )
    return df.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.lit(len(df.columns)).cast("long").alias("column_count"),
        F.when(F.count(v) > 0, F.round(sum_double(sums(value)) / F.count(v), 9)).alias("mean_value"),
        F.max(v).alias("max_value"),
        F.min_by(F.col(label), order_key).alias("argmax_label"),
        sum_double(sums(value)).alias("total_value"),
        sum_long(sums(quantity)).alias("total_quantity"),
    ).withColumns(
        {
            "total_value_text": F.format_number(F.col("total_value"), 3),
            "total_quantity_text": F.format_number(F.col("total_quantity"), 0),
        }
    )


# ---------------------------------------------------------------- checks


def _absent(df: DataFrame, name: str, column: str, passed: bool) -> DataFrame:
    """The check row of a column that the frame does not have."""
    return df.sparkSession.createDataFrame([(name, column, None, passed)], CHECK_SCHEMA)


def check_not_empty(df: DataFrame, name: str = "not_empty") -> DataFrame:
    """Q1 (one-row probe: ``limit 1`` under an aggregate)."""
    n = df.limit(1).agg(F.count(F.lit(1)).alias("n"))
    return n.select(*_check(name, None, F.col("n"), F.col("n") > 0))


def check_columns_present(df: DataFrame, expected: tuple[str, ...] = tuple(PORTFOLIO.fieldNames())) -> DataFrame:
    """Q2 (schema only)."""
    spark = df.sparkSession
    rows = [("columns_present", c, 1.0 if c in df.columns else 0.0, c in df.columns) for c in expected]
    return spark.createDataFrame(rows, CHECK_SCHEMA)


def check_columns_absent(df: DataFrame, unwanted: tuple[str, ...] = DROPPED_COLUMNS) -> DataFrame:
    """Q3 (schema only)."""
    spark = df.sparkSession
    rows = [("columns_absent", c, 0.0 if c not in df.columns else 1.0, c not in df.columns) for c in unwanted]
    return spark.createDataFrame(rows, CHECK_SCHEMA)


def dtypes_report(df: DataFrame) -> DataFrame:
    """Q11: ``(column_name, dtype)``."""
    return df.sparkSession.createDataFrame(df.dtypes, "column_name string, dtype string")


def check_group_cardinality(source: DataFrame, result: DataFrame, key: str = "asset") -> DataFrame:
    """Q4: result rows == distinct non-NULL keys in the source."""
    merged = _merge_single_rows(
        [source.agg(F.count_distinct(key).alias("expected")), result.agg(F.count(F.lit(1)).alias("actual"))]
    )
    return merged.select(*_check("group_cardinality", key, F.col("actual"), F.col("actual") == F.col("expected")))


def check_constant_date(result: DataFrame, expected: dt.date | str | None, column: str = "data") -> DataFrame:
    """Q6: the column holds exactly one value, the expected date text."""
    want = as_date(expected).isoformat()
    agg = result.agg(F.count_distinct(column).alias("n"), F.min(column).alias("v"))
    return agg.select(*_check("constant_date", column, F.col("n"), (F.col("n") == 1) & (F.col("v") == F.lit(want))))


def check_nulls(df: DataFrame, columns: tuple[str, ...] = ("cod", "asset")) -> DataFrame:
    """Q7: required columns have no NULLs; one that is absent fails."""
    absent = [c for c in columns if c not in df.columns]
    if absent:
        there = tuple(c for c in columns if c not in absent)
        failed = [_absent(df, "no_nulls", c, False) for c in absent]
        return union_all([check_nulls(df, there), *failed] if there else failed)
    return null_counts(df, list(columns)).select(
        F.lit("no_nulls").alias("check"),
        F.col("column_name"),
        F.col("null_count").cast("double").alias("value"),
        (F.col("null_count") == 0).alias("passed"),
    )


def check_duplicates(df: DataFrame, column: str = "cod") -> DataFrame:
    """Q8; fails on a frame without the column."""
    if column not in df.columns:
        return _absent(df, "no_duplicates", column, False)
    return duplicate_count(df, column).select(
        *_check("no_duplicates", column, F.col("duplicates"), F.col("duplicates") == 0)
    )


def check_negatives(df: DataFrame, column: str = "part") -> DataFrame:
    """Q9; nothing to check (passed, NULL value) on a frame without the optional column."""
    if column not in df.columns:
        return _absent(df, "no_negatives", column, True)
    return negative_count(df, column).select(
        *_check("no_negatives", column, F.col("negatives"), F.col("negatives") == 0)
    )


def check_total(df: DataFrame, column: str = "part", target: float = 100.0, tolerance: float | None = None) -> DataFrame:
    """Q10: the column's total; passes when within ``tolerance`` of ``target`` (always, if no tolerance).

    Nothing to check (passed, NULL value) on a frame without the column.
    """
    if column not in df.columns:
        return _absent(df, "total", column, True)
    total = df.agg(sum_double(sums(column)).alias("t"))
    ok = F.lit(True) if tolerance is None else F.abs(F.col("t") - F.lit(target)) <= F.lit(tolerance)
    return total.select(*_check("total", column, F.col("t"), ok))


def check_unparsed(df: DataFrame, text_col: str, number_col: str) -> DataFrame:
    """Silent parse loss: text present but the number is NULL."""
    n = df.agg(F.count_if(F.col(text_col).isNotNull() & F.col(number_col).isNull()).alias("n"))
    return n.select(*_check("unparsed_numbers", number_col, F.col("n"), F.col("n") == 0))


def _stack_checks(row: DataFrame, checks: list[tuple[str, str | None, Column, Column]]) -> DataFrame:
    """One metrics row → one check row per entry (a ``stack`` generator, no extra pass)."""
    args = []
    for name, column, value, passed in checks:
        args += [F.lit(name), F.lit(column).cast("string"), value.cast("double"), passed.cast("boolean")]
    return row.select(F.stack(F.lit(len(checks)), *args).alias("check", "column_name", "value", "passed"))


def transformed_quality(result: DataFrame) -> DataFrame:
    """Checks of a stored portfolio: NULLs of every column, totals of both measures, in one aggregation."""
    names = [c for c in PORTFOLIO.fieldNames() if c in result.columns]
    sums_of = {"participacao": "_participacao", "qtd_teorica_total": "_qtd_teorica_total"}
    row = result.agg(
        *[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in names],
        *[sum_double(sums(c)).alias(alias) for c, alias in sums_of.items() if c in names],
    )
    checks = [("no_nulls", c, F.col(f"null_{c}"), F.col(f"null_{c}") == 0) for c in names]
    checks += [("total", c, F.col(alias), F.lit(True)) for c, alias in sums_of.items() if c in names]
    return union_all([_stack_checks(row, checks), check_columns_present(result)])


def quality_report(
    raw: DataFrame,
    result: DataFrame,
    expected_date: dt.date | str | None,
    reconcile_tolerance: float = 0.01,
) -> DataFrame:
    """Every check of a transform run, as ``(check, column_name, value, passed)`` rows.

    Two passes over the raw rows, whatever the number of checks: one
    aggregation per asset, run now and checkpointed (it recomputes the
    portfolio for the reconciliation, and its groups are summed into the
    per-row metrics: NULLs, negatives, total, distinct assets), and one for
    duplicate codes; plus one aggregation over the (small) result.  The
    schema checks read no data.
    """
    from folioflow.operators.aggregate import asset_groups, finish_portfolio
    from folioflow.operators.reconcile import reconcile_with

    from folioflow.session import shared_dir

    want = as_date(expected_date).isoformat()
    # The recomputed portfolio and the raw metrics both come from one
    # per-asset aggregation.  Each consumer would otherwise get its own
    # column-pruned copy of it, so it is checkpointed (one row per asset)
    # into the shared checkpoint folder: the raw rows are aggregated once.
    shared_dir(raw.sparkSession)
    groups = asset_groups(
        raw,
        extra={
            "_rows": F.count(F.lit(1)),
            "_null_cod": F.count_if(F.col("cod").isNull()),
            "_negative": F.count_if(F.col("part") < 0),
            "_part_sum": sums("part"),
        },
    ).checkpoint(eager=True)
    raw_metrics = groups.agg(
        F.coalesce(F.sum("_null_cod"), F.lit(0)).alias("null_cod"),
        F.coalesce(F.sum(F.when(F.col("asset").isNull(), F.col("_rows"))), F.lit(0)).alias("null_asset"),
        F.coalesce(F.sum("_negative"), F.lit(0)).alias("negative_part"),
        sum_double(add_sums("_part_sum")).alias("total_part"),
        F.count_if(F.col("_assets") > 0).alias("distinct_asset"),
    )
    result_metrics = result.agg(
        F.count(F.lit(1)).alias("result_rows"),
        F.count_distinct("data").alias("dates"),
        F.min("data").alias("first_date"),
    )
    expected = finish_portfolio(groups, expected_date)
    mismatches = reconcile_with(expected, result, reconcile_tolerance).agg(F.count(F.lit(1)).alias("mismatches"))
    merged = _merge_single_rows([raw_metrics, result_metrics, duplicate_count(raw, "cod"), mismatches])
    c = F.col
    checks = _stack_checks(
        merged,
        [
            ("not_empty", None, F.least(c("result_rows"), F.lit(1)), c("result_rows") > 0),
            ("group_cardinality", "asset", c("result_rows"), c("result_rows") == c("distinct_asset")),
            ("reconcile", "acao", c("mismatches"), c("mismatches") == 0),
            ("constant_date", "data", c("dates"), (c("dates") == 1) & (c("first_date") == F.lit(want))),
            ("no_nulls", "cod", c("null_cod"), c("null_cod") == 0),
            ("no_nulls", "asset", c("null_asset"), c("null_asset") == 0),
            ("no_duplicates", "cod", c("duplicates"), c("duplicates") == 0),
            ("no_negatives", "part", c("negative_part"), c("negative_part") == 0),
            ("total", "part", c("total_part"), F.lit(True)),
        ],
    )
    return union_all([checks, check_columns_present(result), check_columns_absent(result)])
