"""Scalar expressions on hand-made edge rows."""

import math
from datetime import date

from pyspark.sql import functions as F

from tsmedallion.functions import scalar


def _values(spark, texts, expr, schema="t string"):
    rows = spark.createDataFrame([(t,) for t in texts], schema).select(expr.alias("v")).collect()
    return [r["v"] for r in rows]


def test_value_text(spark):
    texts = [".", "abc", None, " 1.5 ", "1e3", "1,000", "Infinity", ""]
    assert _values(spark, texts, scalar.parse_value(F.col("t"))) == [
        None,
        None,
        None,
        1.5,
        1000.0,
        None,
        math.inf,
        None,
    ]
    assert math.isnan(_values(spark, ["NaN"], scalar.parse_value(F.col("t")))[0])


def test_missing_mark_is_not_the_same_as_null(spark):
    assert _values(spark, [".", "abc", None], scalar.is_missing(F.col("t"))) == [True, False, False]


def test_missing_values_of_a_column(spark):
    parsed = _values(spark, ["-7", ".", "0.25", "..", "1e-3", "."], scalar.parse_value(F.col("t")))
    assert parsed == [-7.0, None, 0.25, None, 0.001, None]


def test_date_text(spark):
    texts = ["2024-01-01", "2024-13-01", "", "2024-1-5", None]
    assert _values(spark, texts, scalar.parse_date(F.col("t"))) == [
        date(2024, 1, 1),
        None,
        None,
        date(2024, 1, 5),
        None,
    ]


def test_pct_change(spark):
    rows = spark.createDataFrame(
        [(13.0, 8.0), (4.0, 0.0), (4.0, None), (None, 8.0), (50.0, -100.0)],
        "v double, p double",
    ).select(scalar.pct_change(F.col("v"), F.col("p")).alias("c"))
    found = [r["c"] for r in rows.collect()]
    assert found[0] == 62.5
    assert found[1:4] == [None, None, None]
    assert found[4] == -150.0


def test_day_of_week(spark):
    days = [date(2024, 2, 10), date(2024, 2, 11), date(2024, 2, 12), None]
    assert _values(spark, days, scalar.day_of_week(F.col("t")), "t date") == [6, 0, 1, None]
    assert _values(spark, days, scalar.is_weekend(F.col("t")), "t date") == [
        True,
        True,
        False,
        False,
    ]


def test_period_start(spark):
    for unit, first in [
        ("month", date(2024, 5, 1)),
        ("quarter", date(2024, 4, 1)),
        ("year", date(2024, 1, 1)),
    ]:
        found = _values(spark, [date(2024, 5, 17)], scalar.period_start(F.col("t"), unit), "t date")
        assert found == [first]


def test_labels(spark):
    values = [12.3456, None, math.nan]
    assert _values(spark, values, scalar.change_label(F.col("t")), "t double") == [
        "12.35% YoY",
        "N/A",
        "N/A",
    ]


def test_two_decimals_round_like_python(spark):
    values = [3.14159, None, 2.675, 0.125, 0.375, 258.115, -0.001, 1234567.891, math.nan, -math.inf]
    found = _values(spark, values, scalar.two_decimals(F.col("t")), "t double")
    assert found == [None if v is None else f"{v:.2f}" for v in values]


def test_share_of_nothing_is_null(spark):
    rows = spark.createDataFrame([(1, 3), (0, 0), (1, 800)], "a bigint, b bigint")
    found = rows.select(scalar.pct_of(F.col("a"), F.col("b")).alias("p")).collect()
    assert [r["p"] for r in found] == [33.33, None, 0.12]


def test_export_name():
    assert scalar.export_name(date(2024, 2, 1)) == "economic_indicators_20240201.csv"
