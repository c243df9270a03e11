"""Property tests: the Column parsers against a plain-Python statement of their grammar."""

from __future__ import annotations

import re
from decimal import ROUND_HALF_UP, Decimal

from hypothesis import given, settings
from hypothesis import strategies as st

from folioflow.functions import clean_text, parse_number_compat, parse_number_ptbr

ALPHABET = "0123456789,.-+ R$%e\t"


def py_strip(t: str) -> str:
    return re.sub(r"[^0-9,.\-]", "", t)


def py_ptbr(t: str | None) -> Decimal | None:
    if t is None:
        return None
    s = py_strip(t)
    if re.fullmatch(r"-?[0-9]+(,[0-9]+)?", s):
        n = s.replace(",", ".")
    elif re.fullmatch(r"-?[0-9]{1,3}(\.[0-9]{3})+(,[0-9]+)?", s):
        n = s.replace(".", "").replace(",", ".")
    elif re.fullmatch(r"-?([0-9]+\.[0-9]*|\.[0-9]+)", s):
        n = s
    else:
        return None
    d = Decimal(n).quantize(Decimal(1).scaleb(-18), rounding=ROUND_HALF_UP)
    return None if abs(d) >= Decimal(10) ** 18 else d


def py_compat(t: str | None) -> float | None:
    if t is None:
        return None
    try:
        return float(py_strip(t).replace(",", "."))
    except ValueError:
        return None


texts = st.lists(st.one_of(st.none(), st.text(alphabet=ALPHABET, max_size=14)), min_size=20, max_size=120)


@settings(max_examples=6, deadline=None)
@given(texts)
def test_ptbr_matches_grammar(spark, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, s string")
    got = dict(df.select("i", parse_number_ptbr("s").alias("v")).collect())
    for i, v in enumerate(values):
        assert got[i] == py_ptbr(v), (v, got[i], py_ptbr(v))


@settings(max_examples=6, deadline=None)
@given(texts)
def test_compat_matches_grammar(spark, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, s string")
    got = dict(df.select("i", parse_number_compat("s").alias("v")).collect())
    for i, v in enumerate(values):
        assert got[i] == py_compat(v), (v, got[i], py_compat(v))


@settings(max_examples=4, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(max_size=10)), min_size=20, max_size=80))
def test_clean_text_matches_python_strip(spark, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, s string")
    got = dict(df.select("i", clean_text("s").alias("v")).collect())
    for i, v in enumerate(values):
        want = None if v is None or v.strip() == "None" else v.strip()
        assert got[i] == want, (v, got[i], want)


@settings(max_examples=4, deadline=None)
@given(st.lists(st.one_of(st.none(), st.floats(allow_nan=False, allow_infinity=False, width=64)), min_size=1, max_size=60))
def test_sums_round_and_drop_nothing(spark, values):
    import math

    from folioflow.functions import sum_double, sums

    df = spark.createDataFrame([(v,) for v in values], "v double").repartition(3)
    got = df.agg(sum_double(sums("v")).alias("s")).first()["s"]
    there = [v for v in values if v is not None]
    want = math.fsum(there)
    assert abs(got - want) <= 1e-12 * max(1.0, math.fsum(map(abs, there)))


def test_consecutive_nanosecond_stamps_keep_their_microsecond(spark):
    import datetime as dt

    from pyspark.sql import functions as F

    from folioflow.sources.legacy import epoch_count_to_ntz

    first = 1_753_453_960_123_456_000
    got = spark.range(2000).select(epoch_count_to_ntz(F.lit(first) + F.col("id") * 1000 + 999).alias("t"), "id").orderBy("id").collect()
    start = dt.datetime(2025, 7, 25, 14, 32, 40, 123456)
    assert [r.t for r in got] == [start + dt.timedelta(microseconds=i) for i in range(2000)]
    early = spark.range(1).select(epoch_count_to_ntz(F.lit(-1)).alias("t")).first().t
    assert early == dt.datetime(1969, 12, 31, 23, 59, 59, 999999)
