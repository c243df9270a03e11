"""Portfolio aggregation: the six-row golden fixture (F1) and grouping cases."""

from __future__ import annotations

import datetime as dt

import pytest

from folioflow.operators import (
    MissingColumns,
    check_columns_absent,
    check_columns_present,
    check_constant_date,
    check_group_cardinality,
    check_not_empty,
    dtypes_report,
    ordered,
    portfolio_by_asset,
    reconcile,
    top_rows,
)
from folioflow.schemas import PORTFOLIO

F1_ROWS = [
    ("ABEV3", "AMBEV S/A", 2.85, 1234567, "N1", "ON", 2.85),
    ("ABEV3", "AMBEV S/A", 1.15, 523456, "N1", "ON", 4.00),
    ("PETR4", "PETROBRAS", 8.75, 987654, "NM", "PN", 12.75),
    ("PETR3", "PETROBRAS", 1.25, 234567, "NM", "ON", 14.00),
    ("VALE3", "VALE", 5.50, 1876543, "NM", "ON", 19.50),
    ("ITUB4", "ITAU UNIBANCO", 3.25, 1456789, "N1", "PN", 22.75),
]
F1_SCHEMA = "cod string, asset string, part double, theoricalQty long, segment string, type string, partAcum double"
RUN = dt.date(2025, 7, 25)


@pytest.fixture(scope="module")
def f1(spark):
    return spark.createDataFrame(F1_ROWS, F1_SCHEMA)


@pytest.fixture(scope="module")
def f1_result(f1):
    return portfolio_by_asset(f1, RUN)


def test_golden_rows(f1_result):
    got = [tuple(r) for r in ordered(f1_result).collect()]
    assert got == [
        ("AMBEV S/A", 2, 4.0, 1758023, "2025-07-25"),
        ("ITAU UNIBANCO", 1, 3.25, 1456789, "2025-07-25"),
        ("PETROBRAS", 2, 10.0, 1222221, "2025-07-25"),
        ("VALE", 1, 5.5, 1876543, "2025-07-25"),
    ]


def test_schema_and_totals(f1_result):
    assert [(f.name, f.dataType) for f in f1_result.schema] == [(f.name, f.dataType) for f in PORTFOLIO]
    tot = f1_result.groupBy().sum("participacao", "qtd_teorica_total").first()
    assert abs(tot[0] - 22.75) < 1e-9 and tot[1] == 6313576


def test_original_validations(f1, f1_result):
    """The original transform validations (Q1–Q6), as distributed checks."""
    checks = (
        check_not_empty(f1_result)
        .unionByName(check_columns_present(f1_result))
        .unionByName(check_columns_absent(f1_result))
        .unionByName(check_group_cardinality(f1, f1_result))
        .unionByName(check_constant_date(f1_result, RUN))
    )
    rows = checks.collect()
    assert len(rows) == 1 + 5 + 3 + 1 + 1
    assert all(r.passed for r in rows), rows
    assert reconcile(f1, f1_result).count() == 0


def test_reconcile_flags_differences(spark, f1, f1_result):
    def with_vale(row):
        return f1_result.where("acao <> 'VALE'").unionByName(spark.createDataFrame([row], PORTFOLIO))

    assert reconcile(f1, with_vale(("VALE", 1, 5.505, 1876543, "2025-07-25"))).count() == 0  # within 0.01
    off = reconcile(f1, with_vale(("VALE", 1, 5.6, 1876543, "2025-07-25"))).collect()
    assert [(r.acao, r.participacao_ok) for r in off] == [("VALE", False)]
    tampered2 = f1_result.where("acao <> 'VALE'").unionByName(
        spark.createDataFrame([("VALE", 2, 5.5, 1876543, "2025-07-25")], PORTFOLIO)
    )
    bad = reconcile(f1, tampered2).collect()
    assert [(r.acao, r.count_ok, r.participacao_ok, r.quantity_ok) for r in bad] == [("VALE", False, True, True)]
    missing = reconcile(f1, f1_result.where("acao <> 'VALE'")).collect()
    assert [(r.acao, r.actual_qtd_codigo) for r in missing] == [("VALE", None)]


def test_dtypes_report(f1_result):
    assert dict((r.column_name, r.dtype) for r in dtypes_report(f1_result).collect()) == {
        "acao": "string",
        "qtd_codigo": "bigint",
        "participacao": "double",
        "qtd_teorica_total": "bigint",
        "data": "string",
    }


def test_missing_required_columns(f1):
    with pytest.raises(MissingColumns, match="theoricalQty"):
        portfolio_by_asset(f1.drop("theoricalQty"), RUN)


def test_grouping_cases(spark):
    rows = [
        (None, "X1", 1.0, 10.0),  # NULL asset: dropped
        ("A", None, 1.0, 10.0),  # NULL code: not counted
        ("A", "A1", None, None),
        ("B", "B1", None, None),  # all-NULL sums → 0
        ("C", "C1", 1.0, 1.0),
        ("C", "C1", 2.0, 2.0),  # repeated code counted twice
        ("a", "a1", 1.0, 1.0),
        ("Á", "x", 1.0, 1.0),
    ]
    df = spark.createDataFrame(rows, "asset string, cod string, part double, theoricalQty double")
    got = [tuple(r)[:4] for r in ordered(portfolio_by_asset(df, RUN)).collect()]
    assert got == [
        ("A", 1, 1.0, 10),
        ("B", 1, 0.0, 0),
        ("C", 2, 3.0, 3),
        ("a", 1, 1.0, 1),
        ("Á", 1, 1.0, 1),
    ]


def test_extra_keys(spark):
    df = spark.createDataFrame(
        [("d1", "A", "a", 1.0, 1.0), ("d2", "A", "a", 2.0, 2.0), ("d2", "A", "b", 3.0, 3.0)],
        "day string, asset string, cod string, part double, theoricalQty double",
    )
    got = sorted(tuple(r)[:4] for r in portfolio_by_asset(df, RUN, by=("day",)).collect())
    assert got == [("d1", "A", 1, 1.0), ("d2", "A", 2, 5.0)]


def test_top_rows(f1_result):
    assert [r.acao for r in top_rows(f1_result, 3).collect()] == ["AMBEV S/A", "ITAU UNIBANCO", "PETROBRAS"]
    assert [r.acao for r in top_rows(f1_result, 1, "participacao").collect()] == ["ITAU UNIBANCO"]
