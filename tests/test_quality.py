"""Data-quality aggregates and checks."""

from __future__ import annotations

from folioflow.operators import (
    check_duplicates,
    check_negatives,
    check_nulls,
    check_total,
    check_unparsed,
    distinct_count,
    distinct_values,
    duplicate_count,
    negative_count,
    negative_rows,
    null_counts,
    row_count,
    summary_stats,
)

ROWS = [
    ("A1", "A", 2.0, 10.0),
    ("A1", "A", 3.0, None),
    (None, "B", 3.0, 5.0),
    (None, None, -1.0, 1.0),
    ("C1", "C", None, 2.0),
]
SCHEMA = "cod string, asset string, part double, theoricalQty double"


def test_counts(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    assert row_count(df).first().row_count == 5
    assert {r.column_name: r.null_count for r in null_counts(df).collect()} == {
        "cod": 2,
        "asset": 1,
        "part": 1,
        "theoricalQty": 1,
    }
    # pandas duplicated(): the second A1 and the second NULL repeat
    assert duplicate_count(df, "cod").first().duplicates == 2
    assert negative_count(df, "part").first().negatives == 1
    assert negative_rows(df, "part").count() == 1
    assert distinct_count(df, "asset").first().distinct_count == 3
    assert sorted(r.asset or "" for r in distinct_values(df, "asset").collect()) == ["", "A", "B", "C"]


def test_summary_stats_tie_break(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    s = summary_stats(df).first()
    assert s.row_count == 5 and s.column_count == 4
    assert s.max_value == 3.0 and s.argmax_label == "A1"  # ties at 3.0: smallest non-NULL code
    assert s.total_value == 7.0 and s.total_quantity == 18
    assert abs(s.mean_value - 1.75) < 1e-12
    assert s.total_value_text == "7.000" and s.total_quantity_text == "18"


def test_checks(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    rows = (
        check_nulls(df)
        .unionByName(check_duplicates(df))
        .unionByName(check_negatives(df))
        .unionByName(check_total(df, tolerance=0.5, target=7.2))
        .collect()
    )
    verdict = {(r.check, r.column_name): (r.value, r.passed) for r in rows}
    assert verdict[("no_nulls", "cod")] == (2.0, False)
    assert verdict[("no_duplicates", "cod")] == (2.0, False)
    assert verdict[("no_negatives", "part")] == (1.0, False)
    assert verdict[("total", "part")] == (7.0, True)


def test_unparsed(spark):
    df = spark.createDataFrame([("1,5", 1.5), ("x", None), (None, None)], "t string, v double")
    assert check_unparsed(df, "t", "v").first().value == 1.0


def test_constant_date_check_fails_on_two_dates(spark):
    from folioflow.operators import check_constant_date

    df = spark.createDataFrame([("A", "2025-07-25"), ("B", "2025-07-24")], "acao string, data string")
    row = check_constant_date(df, "2025-07-25").first()
    assert (row.value, row.passed) == (2.0, False)
    ok = check_constant_date(df.where("acao = 'A'"), "2025-07-25").first()
    assert ok.passed
