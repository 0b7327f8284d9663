import datetime as dt

import pytest
from pyspark.sql import functions as F

from pulse.functions import (
    breakout_type,
    clamp_or_null,
    engagement_level,
    engagement_trend,
    momentum_status,
    release_cohort,
    safe_div,
    sorted_name_list,
    trend_category,
    virality_category,
    week_start_sunday,
)


def one(spark, expr, value, dtype="double"):
    df = spark.createDataFrame([(value,)], f"x {dtype}")
    return df.select(expr(F.col("x")).alias("r")).first()["r"]


@pytest.mark.parametrize(
    "pct,label",
    [(10.01, "Surging"), (10.0, "Rising"), (5.0, "Stable"), (-4.99, "Stable"), (-5.0, "Declining"),
     (-10.0, "Falling"), (-50.0, "Falling"), (None, "Falling")],
)
def test_momentum_status_strict_bands(spark, pct, label):
    assert one(spark, momentum_status, pct) == label


@pytest.mark.parametrize(
    "v,label",
    [(100.0, "Viral"), (99.9, "High Engagement"), (50.0, "High Engagement"),
     (20.0, "Moderate Engagement"), (5.0, "Low Engagement"), (4.99, "Minimal Engagement"),
     (None, "Minimal Engagement")],
)
def test_engagement_level_inclusive(spark, v, label):
    assert one(spark, engagement_level, v) == label


@pytest.mark.parametrize(
    "c,label",
    [(80.0, "Extremely Viral"), (60.0, "Highly Viral"), (40.0, "Moderately Viral"),
     (20.0, "Slightly Viral"), (19.99, "Not Viral"), (0.0, "Not Viral")],
)
def test_virality_category_inclusive(spark, c, label):
    assert one(spark, virality_category, c) == label


@pytest.mark.parametrize(
    "days,label",
    [(-3, "New (0-30 days)"), (30, "New (0-30 days)"), (31, "Recent (31-90 days)"),
     (90, "Recent (31-90 days)"), (180, "Established (91-180 days)"),
     (181, "Catalog (180+ days)"), (None, "Catalog (180+ days)")],
)
def test_release_cohort(spark, days, label):
    assert one(spark, release_cohort, days, "long") == label


def test_trend_category(spark):
    df = spark.createDataFrame(
        [(51.0, 10.5), (51.0, 10.0), (10.0, 5.01), (0.0, 5.0), (0.0, -5.01), (None, None), (60.0, None)],
        "v double, d double",
    )
    got = [r[0] for r in df.select(trend_category("v", "d")).collect()]
    assert got == ["Viral", "Rising", "Rising", "Stable", "Declining", "Stable", "Stable"]


def test_engagement_trend_null_baseline_is_stable(spark):
    df = spark.createDataFrame([(5, 3.0), (1, 3.0), (3, 3.0), (9, None)], "x long, b double")
    got = [r[0] for r in df.select(engagement_trend("x", "b")).collect()]
    assert got == ["Increasing", "Decreasing", "Stable", "Stable"]


def test_breakout_types_first_match_wins(spark):
    df = spark.createDataFrame(
        [(45.0, 10.0), (65.0, 30.0), (70.0, 45.0), (50.0, 45.0)], "n double, p double"
    )
    got = [r[0] for r in df.select(breakout_type("n", "p")).collect()]
    assert got == ["Major Breakout", "Strong Breakout", "Rapid Growth", "Steady Growth"]


def test_safe_div_zero_and_null(spark):
    df = spark.createDataFrame([(1, 0), (1, None), (3, 2)], "a long, b long")
    got = [r[0] for r in df.select(safe_div("a", "b")).collect()]
    assert got == [None, None, 1.5]


def test_clamp_keeps_null_unlike_greatest(spark):
    df = spark.createDataFrame([(None,), (-5.0,), (150.0,), (42.0,)], "x double")
    got = [r[0] for r in df.select(clamp_or_null(F.col("x"), 0, 100)).collect()]
    assert got == [None, 0.0, 100.0, 42.0]
    # the unguarded built-in turns unknown into 0
    assert df.select(F.greatest(F.lit(0.0), "x")).first()[0] == 0.0


def test_week_starts_on_sunday(spark):
    days = [dt.date(2024, 1, d) for d in range(6, 15)]  # Sat 6 .. Sun 14
    df = spark.createDataFrame([(d,) for d in days], "d date")
    got = [r[0] for r in df.select(week_start_sunday("d")).collect()]
    assert got[0] == dt.date(2023, 12, 31)
    assert got[1:8] == [dt.date(2024, 1, 7)] * 7
    assert got[8] == dt.date(2024, 1, 14)


def test_sorted_name_list(spark):
    df = spark.createDataFrame(
        [([{"id": 1, "name": "b"}, {"id": 2, "name": "a"}, {"id": 3, "name": None}],), ([],), (None,)],
        "g array<struct<id:bigint,name:string>>",
    )
    got = [r[0] for r in df.select(sorted_name_list("g")).collect()]
    assert got == ["a, b", None, None]
