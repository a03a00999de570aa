"""Boundary rows of every scalar rule."""

import datetime as dt
import math

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tidewatch import schemas as S
from tidewatch.functions import scalar as X


def column(spark, kind, values, expression):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    rows = df.select("i", expression(F.col("v")).alias("r")).orderBy("i").collect()
    return [r.r for r in rows]


def test_rounding_follows_the_binary_value(spark):
    assert column(spark, "double", [1.005, 2.5, -2.5, 0.125, None], lambda c: X.round_half_away(c, 2)) == [
        1.0, 2.5, -2.5, 0.13, None,
    ]
    assert column(spark, "double", [2.5, -2.5, 0.4], lambda c: X.round_half_away(c, 0)) == [3.0, -3.0, 0.0]


def test_strict_parse_raises_and_lenient_gives_null(spark):
    good, bad = "2024-01-01 05:06:07", "2024-13-01 00:00:00"
    assert column(spark, "string", [good], X.parse_strict) == [dt.datetime(2024, 1, 1, 5, 6, 7)]
    with pytest.raises(PySparkException):
        column(spark, "string", [bad], X.parse_strict)
    assert column(spark, "string", [good, bad, "2024-01-01", "junk", None], X.parse_lenient) == [
        dt.datetime(2024, 1, 1, 5, 6, 7), None, None, None, None,
    ]


def test_weekday_conventions(spark):
    # 2024-01-01 was a Monday, 2024-01-07 a Sunday.
    days = [dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 6), dt.datetime(2024, 1, 7)]
    assert column(spark, "timestamp", days, X.weekday_iso) == [1, 6, 7]
    assert column(spark, "timestamp", days, X.weekday_from_sunday) == [1, 6, 0]


def test_peak_hours_include_both_ends(spark):
    hours = [dt.datetime(2024, 1, 1, h, 59, 59) for h in (17, 18, 22, 23)]
    assert column(spark, "timestamp", hours, lambda c: X.flag(X.is_peak(c))) == [0, 1, 1, 0]
    assert column(spark, "timestamp", hours, X.period_label) == [
        "Daytime", "Evening (18-22h)", "Evening (18-22h)", "Daytime",
    ]


def test_flags_are_strict_and_null_is_zero(spark):
    assert column(spark, "double", [2000.0, 2001.0, None], lambda c: X.flag(c > S.TIMEOUT_MS)) == [0, 1, 0]
    assert column(spark, "double", [75.0, 75.01], lambda c: X.flag(c > S.HIGH_CPU_PCT)) == [0, 1]


def test_codes(spark):
    assert column(spark, "string", ["SELECT", "DELETE", None], lambda c: X.code_of(c, S.QUERY_CODES)) == [0, 3, None]
    with pytest.raises(PySparkException, match="MERGE"):
        column(spark, "string", ["MERGE"], lambda c: X.code_of(c, S.QUERY_CODES))


def test_states_and_regions(spark):
    values = ["SP", "TO", "XX", None]
    assert column(spark, "string", values, X.state_name) == ["São Paulo", "Tocantins", "XX", None]
    assert column(spark, "string", values, X.region_of) == ["Southeast", "North", "XX", "Other"]
    assert len(S.STATE_NAMES) == 27 and set(S.STATE_NAMES) == set(S.STATE_REGIONS)


def test_delivery_bands(spark):
    days = [5.0, 5.1, 10.0, 15.1, 20.1, 25.0, 25.1, None]
    assert column(spark, "double", days, lambda c: X.band(c, S.DELIVERY_BUCKETS, S.DELIVERY_BUCKET_LAST)) == [
        "1-5 days", "6-10 days", "6-10 days", "16-20 days", "21-25 days", "21-25 days", "25+ days", "25+ days",
    ]
    days = [7.0, 7.1, 14.0, 14.1, 21.0, 21.1, None]
    assert column(spark, "double", days, lambda c: X.band(c, S.PERFORMANCE_LIMITS, S.PERFORMANCE_LAST)) == [
        "Fast", "Normal", "Normal", "Slow", "Slow", "Critical", "Critical",
    ]


def test_estimate_labels(spark):
    gaps = [-1.1, -1.0, 0.0, 0.1, 3.0, 3.1, None]
    assert column(spark, "double", gaps, X.estimate_label) == [
        "Early", "On time", "On time", "1-3 days late", "1-3 days late", "3+ days late", "3+ days late",
    ]
    assert column(spark, "double", [-0.5, 0.0, 2.5, None], X.at_least_zero) == [0.0, 0.0, 2.5, None]


def test_months(spark):
    assert column(spark, "timestamp", [dt.datetime(2018, 1, 31, 23, 59)], X.month_key) == ["2018-01"]
    assert column(spark, "string", ["2018-01", "2017-12"], X.month_name) == ["Jan 2018", "Dec 2017"]
    assert column(spark, "string", ["2018-01", "2017-12"], X.month_sort) == [201801, 201712]


def test_days_between_counts_whole_seconds(spark):
    rows = [(dt.datetime(2024, 1, 2, 2, 24), dt.datetime(2024, 1, 1)), (dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 1, 1))]
    df = spark.createDataFrame(rows, "a timestamp, b timestamp")
    assert [r.d for r in df.select(X.days_between(F.col("a"), F.col("b")).alias("d")).collect()] == [1.1, 0.0]


@pytest.mark.parametrize(
    ("signs", "level"),
    [((1, 1, 1), "CRITICAL"), ((1, 1, 0), "WARNING"), ((0, 1, 1), "WARNING"), ((0, 0, 1), "WARNING"), ((0, 0, 0), "OK")],
)
def test_risk_levels(spark, signs, level):
    df = spark.createDataFrame([signs], "a int, c int, s int")
    assert df.select(X.risk_level(F.col("a"), F.col("c"), F.col("s"))).first()[0] == level


def test_log_and_percent(spark):
    assert math.isclose(column(spark, "double", [1000.0], F.log10)[0], 3.0)
    df = spark.createDataFrame([(1, 3)], "a long, b long")
    assert df.select(X.percent(F.col("a"), F.col("b"), 1)).first()[0] == 33.3
