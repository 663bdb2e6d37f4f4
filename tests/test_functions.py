"""Numeric and key rules: exact half-up decimals, surrogate keys, ages."""

from decimal import ROUND_HALF_UP, Decimal

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pulsevault.functions import age_years, avg_dec, dec_to_int, round_ratio, surrogate_key


def test_surrogate_key_golden(spark):
    df = spark.createDataFrame([("a", Decimal("0.0000"))], "s string, v decimal(10,4)")
    got = df.select(surrogate_key("s", "v").alias("k")).first().k
    assert got == "2a8c78173e21c6114c55180fa069b633"  # md5('a-0.0000')


def test_surrogate_key_null_token(spark):
    import hashlib
    df = spark.createDataFrame([("a", None)], "s string, t string")
    got = df.select(surrogate_key("s", "t").alias("k")).first().k
    assert got == hashlib.md5(b"a-_dbt_utils_surrogate_key_null_").hexdigest()


@settings(max_examples=25, deadline=None)
@given(st.lists(st.integers(min_value=-10**9, max_value=10**9), min_size=1, max_size=40))
def test_avg_dec_is_exact_half_up(spark, unscaled):
    vals = [Decimal(u).scaleb(-4) for u in unscaled]
    df = spark.createDataFrame([(v,) for v in vals], "x decimal(10,4)")
    got = df.agg(avg_dec("x", 4, 10).alias("m")).first().m
    exact = sum(vals) / Decimal(len(vals))
    want = exact.quantize(Decimal("0.0001"), rounding=ROUND_HALF_UP)
    assert got == want


def test_completeness_ratio_one_decimal(spark):
    df = spark.createDataFrame([(287, 288), (12, 24), (5, 5), (18, 288)], "n long, e long")
    got = [r.c for r in df.select(round_ratio(F.col("n") * 100, F.col("e"), 1, 5, 2).alias("c")).collect()]
    assert got == [Decimal("99.70"), Decimal("50.00"), Decimal("100.00"), Decimal("6.30")]


def test_decimal_to_int_rounds_half_up(spark):
    df = spark.createDataFrame([(Decimal("2.5"),), (Decimal("2.4"),), (Decimal("-2.5"),)], "x decimal(10,4)")
    assert [r.i for r in df.select(dec_to_int("x").alias("i")).collect()] == [3, 2, -3]


def test_age_complete_years(spark):
    df = spark.createDataFrame([("1957-04-08", "2026-04-07"), ("1957-04-08", "2026-04-08"), ("2000-02-29", "2001-02-28")],
                               "b string, a string")
    got = [r.age for r in df.select(age_years(F.col("b").cast("date"), F.col("a").cast("date")).alias("age")).collect()]
    assert got == [68, 69, 0]
