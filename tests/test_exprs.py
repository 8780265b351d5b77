"""Scalar functions on literal cases."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from nestmetrics.functions import exprs as E

NAN, INF = float("nan"), float("inf")


def apply(spark, values, ddl, fn):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {ddl}")
    return [r[0] for r in df.orderBy("i").select(fn(F.col("v"))).collect()]


PRICES = [
    ("$1,234.56", 1234.56),
    ("1234.56", 1234.56),
    ("  $500.00  ", 500.0),
    ("$100", 100.0),
    ("", None),
    (None, None),
    ("abc", None),
    ("$0.00", 0.0),
    ("$999,999.99", 999999.99),
    ("฿1,500", 1500.0),
    ("-$5", 5.0),
    ("1.2.3", None),
    (".", None),
]


def test_clean_price_text(spark):
    got = apply(spark, [p for p, _ in PRICES], "string", E.clean_price)
    assert got == [want for _, want in PRICES]


@pytest.mark.parametrize("ddl,values,want", [
    ("double", [99.99, NAN, None], [99.99, None, None]),
    ("int", [100, None], [100.0, None]),
])
def test_clean_price_numbers(spark, ddl, values, want):
    dtype = T.DoubleType() if ddl == "double" else T.IntegerType()
    assert apply(spark, values, ddl, lambda c: E.clean_price(c, dtype)) == want


BOOLS = [
    ("t", True), ("f", False), ("true", True), ("false", False), ("T", True), ("1", True), ("0", False),
    (None, None), ("maybe", None), ("  t  ", True), ("NaN", None), ("\tFALSE\n", False),
]


def test_parse_bool(spark):
    assert apply(spark, [b for b, _ in BOOLS], "string", E.parse_bool) == [want for _, want in BOOLS]
    assert apply(spark, [True, False, None], "boolean", E.parse_bool) == [True, False, None]


DATES = [
    ("2023-01-15", dt.date(2023, 1, 15)),
    ("01/15/2023", dt.date(2023, 1, 15)),
    (" 2023-01-15 ", dt.date(2023, 1, 15)),
    ("2023-01-15 10:30:00", dt.date(2023, 1, 15)),
    (None, None), ("", None), ("not-a-date", None), ("2023-02-30", None), ("13/45/2023", None),
]


def test_parse_date_lenient(spark):
    assert apply(spark, [d for d, _ in DATES], "string", E.parse_date_lenient) == [want for _, want in DATES]


def test_parse_date_keeps_typed_columns(spark):
    stamp = dt.datetime(2020, 5, 6, 7, 8)
    got = apply(spark, [stamp, None], "timestamp_ntz", lambda c: E.parse_date_lenient(c, T.TimestampNTZType()))
    assert got == [dt.date(2020, 5, 6), None]


def test_standardise_text_only_trims(spark):
    values = [" Entire home ", "\tprivate\n", "a  b", "", None]
    assert apply(spark, values, "string", E.standardise_text) == ["Entire home", "private", "a  b", "", None]


def test_host_tiers_are_right_closed(spark):
    got = apply(spark, [None, 0, -1, 1, 2, 3, 9, 10], "int", E.host_tier)
    assert got == [
        "Solo Host", None, None, "Solo Host", "Small Portfolio", "Mid Portfolio", "Mid Portfolio",
        "Commercial Operator",
    ]


def test_professional_flag_of_null_is_false(spark):
    assert apply(spark, [None, 2, 3], "int", E.professional_flag) == [False, False, True]


def test_rounding_is_half_even_on_the_scaled_value(spark):
    assert apply(spark, [0.125, 0.375, 2.5, None], "double", lambda c: E.round_half_even(c, 2)) == [0.12, 0.38, 2.5, None]


def test_tenure_counts_days(spark):
    got = apply(spark, [dt.date(2020, 9, 26), None], "date", lambda c: E.host_tenure_years(c, "2025-09-26"))
    assert got == [5.0, None]


def test_price_per_bedroom_needs_a_bedroom(spark):
    df = spark.createDataFrame([(100.0, 3.0), (100.0, 0.0), (100.0, None), (None, 2.0)], "p double, b double")
    assert [r[0] for r in df.select(E.price_per_bedroom(F.col("p"), F.col("b"))).collect()] == [33.33, None, None, None]


def test_occupancy_of_no_days_is_null(spark):
    df = spark.createDataFrame([(1, 3), (0, 0), (2, 2)], "u long, t long")
    assert [r[0] for r in df.select(E.occupancy_rate(F.col("u"), F.col("t"))).collect()] == [0.3333, None, 1.0]


def test_date_parts(spark):
    df = spark.createDataFrame([(dt.date(2024, 2, 9),)], "d date")  # a Friday
    row = df.select(*[c.alias(n) for n, c in E.date_parts(F.col("d")).items()]).first()
    assert row.asDict() == {
        "date_key": 20240209, "full_date": dt.date(2024, 2, 9), "year": 2024, "month": 2, "day": 9,
        "day_of_week": 4, "day_name": "Friday", "is_weekend": False, "month_name": "February", "quarter": 1,
    }


def test_weekend_presets_and_missing_date(spark):
    days = [dt.date(2024, 2, 8) + dt.timedelta(days=i) for i in range(4)] + [None]  # Thursday to Sunday
    assert apply(spark, days, "date", lambda c: E.weekend_flag(c, E.WEEKEND_SAT_SUN)) == [False, False, True, True, False]
    assert apply(spark, days, "date", lambda c: E.weekend_flag(c, E.WEEKEND_FRI_SAT)) == [False, True, True, False, False]


def test_date_key_round_trip(spark):
    days = [dt.date(2024, 2, 29), None]
    assert apply(spark, days, "date", lambda c: E.date_key_to_date(E.date_key(c))) == days
    assert apply(spark, [20241340], "int", E.date_key_to_date) == [None]


def test_month_bucket(spark):
    assert apply(spark, [dt.date(2024, 2, 9), None], "date", E.month_bucket) == ["2024-02", None]


def test_lenient_and_binary_flags(spark):
    words = ["true", "T", "1", "Yes", "y", "no", "0", "", None, "x"]
    want = [True] * 5 + [False] * 5
    assert apply(spark, words, "string", E.lenient_bool) == want
    assert apply(spark, words, "string", E.to_binary) == [float(w) for w in want]
    assert apply(spark, [" t "], "string", E.to_binary) == [1.0]


def test_to_numeric_coerces(spark):
    assert apply(spark, ["12.5", "x", None, "-3"], "string", E.to_numeric) == [12.5, None, None, -3.0]


def test_is_missing(spark):
    assert apply(spark, [1.0, NAN, INF, -INF, None], "double", E.is_missing) == [False, True, True, True, True]


def test_clip_keeps_nulls(spark):
    assert apply(spark, [5, 20, 243, None], "int", lambda c: E.clip_upper(c, 20)) == [5.0, 20.0, 20.0, None]


def test_log_transform_is_finite_or_null(spark):
    got = apply(spark, [0.0, 99.0, -1.0, None], "double", E.log_price)
    assert got[0] == 0.0 and math.isclose(got[1], math.log(100)) and got[2:] == [None, None]
    assert apply(spark, [800.0], "double", E.unlog_price) == [None]


def test_contains_ignores_case_and_null(spark):
    assert apply(spark, ["Entire home/apt", "ENTIRE", "Private room", None], "string",
                 lambda c: E.contains_ci(c, "entire")) == [True, True, False, False]


def test_number_texts(spark):
    values = [1234.5, 1235.5, None, NAN, INF]
    assert apply(spark, values, "double", E.format_currency) == ["฿1,234", "฿1,236", "N/A", "N/A", "N/A"]
    assert apply(spark, values, "double", E.format_number)[:2] == ["1,234", "1,236"]
    assert apply(spark, [0.123, 0.1225, None], "double", E.format_percent) == ["12.3%", "12.2%", "N/A"]
    assert apply(spark, [3.25, -3.25, 0.0], "double", E.signed_one_decimal) == ["+3.2", "-3.2", "+0.0"]


def test_percent_difference_guards_the_base(spark):
    df = spark.createDataFrame([(110.0, 100.0), (5.0, 0.0), (5.0, -1.0)], "a double, b double")
    assert [r[0] for r in df.select(E.percent_difference(F.col("a"), F.col("b"))).collect()] == [10.0, 0.0, 0.0]


def test_conditional_fill_only_where_condition_holds(spark):
    df = spark.createDataFrame([(0, None), (0, 1.5), (3, None)], "n int, v double")
    got = [r[0] for r in df.select(E.conditional_fill(F.col("v"), F.col("n") == 0, 0.0)).collect()]
    assert got == [0.0, 1.5, None]


def test_schema_helpers(spark):
    df = spark.createDataFrame([(1, "x")], "a int, b string")
    assert E.first_existing_col(df, ["z", "b", "a"]) == "b"
    assert E.first_existing_col(df, ["z"]) is None
    assert E.existing_columns(df, ["z", "b"]) == ["b"]
    shaped = E.project_schema(df, T.StructType.fromDDL("b string, c double, a long"))
    assert shaped.columns == ["b", "c", "a"] and tuple(shaped.first()) == ("x", None, 1)
    assert E.rename_reorder(df, {"b": "y", "a": "x"}).columns == ["y", "x"]
