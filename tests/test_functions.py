"""Scalar functions: number parsing (F4), text cleaning (F5), dates, request token."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from folioflow.functions import (
    clean_text,
    parse_number_compat,
    parse_number_ptbr,
    partition_columns,
    request_token,
    to_number,
)
from folioflow.functions.text import WHITESPACE
from pyspark.sql.types import DoubleType

# (input, compat, ptbr)
NUMBER_CASES = [
    ("0,490", 0.49, "0.49"),
    ("476.976.044", None, "476976044"),
    ("976.044", 976.044, "976044"),
    ("1.234,56", None, "1234.56"),
    ("-1,5", -1.5, "-1.5"),
    ("R$ 3,10", 3.1, "3.1"),
    ("12%", 12.0, "12"),
    ("1e5", 15.0, "15"),
    (".5", 0.5, "0.5"),
    ("-.5", -0.5, "-0.5"),
    ("5.", 5.0, "5"),
    ("+4", 4.0, "4"),
    ("00,1", 0.1, "0.1"),
    ("5-3", None, None),
    ("1-", None, None),
    ("--1", None, None),
    ("-", None, None),
    ("", None, None),
    ("abc", None, None),
    ("1.2.3", None, None),
    ("1,2,3", None, None),
    ("1,000.5", None, None),
    (None, None, None),
]


@pytest.fixture(scope="module")
def number_frame(spark):
    rows = [(i, c[0]) for i, c in enumerate(NUMBER_CASES)]
    return spark.createDataFrame(rows, "i int, s string")


def test_parse_number_compat(number_frame):
    out = dict(number_frame.select("i", parse_number_compat("s").alias("v")).collect())
    for i, (text, compat, _) in enumerate(NUMBER_CASES):
        assert out[i] == compat, (text, out[i], compat)


def test_parse_number_ptbr(number_frame):
    out = dict(number_frame.select("i", parse_number_ptbr("s").alias("v")).collect())
    for i, (text, _, ptbr) in enumerate(NUMBER_CASES):
        want = None if ptbr is None else Decimal(ptbr)
        assert out[i] == want, (text, out[i], want)


def test_ptbr_decimal_overflow_is_null(spark):
    df = spark.createDataFrame([("12.345.678.901.234.567.890",)], "s string")
    assert df.select(parse_number_ptbr("s").alias("v")).first().v is None


def test_to_number_passes_numeric_columns_and_drops_nan(spark):
    df = spark.createDataFrame([(1.5,), (float("nan"),), (None,)], "x double")
    got = [r.v for r in df.select(to_number(F.col("x"), DoubleType()).alias("v")).collect()]
    assert got == [1.5, None, None]


TEXT_CASES = [
    ("  ALOS3 ", "ALOS3"),
    ("\tX\n", "X"),
    ("\u00a0NB\u00a0", "NB"),
    (" wide\u3000", "wide"),
    ("None", None),
    (" None ", None),
    ("none", "none"),
    ("", ""),
    ("nan", "nan"),
    ("ON  ED  NM", "ON  ED  NM"),
    (None, None),
]


def test_clean_text(spark):
    df = spark.createDataFrame([(i, c[0]) for i, c in enumerate(TEXT_CASES)], "i int, s string")
    out = dict(df.select("i", clean_text("s").alias("v")).collect())
    for i, (text, want) in enumerate(TEXT_CASES):
        assert out[i] == want, (text, out[i], want)


def test_whitespace_set_matches_python_strip():
    sample = "".join(chr(c) for c in range(0x3100))
    for ch in sample:
        assert (ch in WHITESPACE) == (ch.strip() == ""), hex(ord(ch))


def test_clean_text_casts_non_text(spark):
    df = spark.createDataFrame([(7,)], "n int")
    assert df.select(clean_text(F.col("n"), df.schema["n"].dataType).alias("v")).first().v == "7"


def test_partition_columns_are_zero_padded(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 5),)], "d date")
    row = df.select(*[c.alias(n) for n, c in partition_columns("d").items()]).first()
    assert (row.year, row.month, row.day) == ("2024", "01", "05")


def test_request_token_golden(spark):
    """Page 1, size 1200, pt-br, IBOV → documented URL token."""
    df = spark.createDataFrame([(1, 1200, "pt-br", "IBOV")], "p long, s long, l string, i string")
    token = df.select(request_token(F.col("p"), F.col("s"), F.col("l"), F.col("i")).alias("t")).first().t
    assert token == "eyJwYWdlTnVtYmVyIjoxLCJwYWdlU2l6ZSI6MTIwMCwibGFuZ3VhZ2UiOiJwdC1iciIsImluZGV4IjoiSUJPViJ9"


def test_request_token_long_params_have_no_line_breaks(spark):
    df = spark.createDataFrame([(1, 1200, "pt-br", "X" * 200)], "p long, s long, l string, i string")
    token = df.select(request_token(F.col("p"), F.col("s"), F.col("l"), F.col("i")).alias("t")).first().t
    assert "\n" not in token and "\r" not in token and len(token) > 76
