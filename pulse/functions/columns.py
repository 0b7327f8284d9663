"""Scalar column expressions shared by the metric and view operators.

Everything here is a built-in Spark expression (JVM side, inside
whole-stage codegen); no Python runs per row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pulse.config import (
    BREAKOUT_LABELS,
    BREAKOUT_RISE,
    BREAKOUT_RULES,
    COHORT_CUTS,
    COHORT_LABELS,
    ENGAGEMENT_CUTS,
    ENGAGEMENT_LABELS,
    ENGAGEMENT_TREND_LABELS,
    MOMENTUM_CUTS,
    MOMENTUM_LABELS,
    TREND_LABELS,
    VIRALITY_CUTS,
    VIRALITY_LABELS,
    DEFAULT_THRESHOLDS,
    Thresholds,
)


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def month_of(date: Column | str) -> Column:
    """A date's month as an integer, 202401 for January 2024: what fact tables are partitioned by."""
    return (F.year(_col(date)) * 100 + F.month(_col(date))).cast("int")


def since(df, column: str, start: Column):
    """The rows of ``df`` whose date ``column`` is ``start`` or later. On a table partitioned by
    the month of that date this is a partition filter, too."""
    if "month" in df.columns:
        df = df.where(F.col("month") >= month_of(start))
    return df.where(F.col(column) >= start)


def safe_div(num: Column | str, den: Column | str | int | float) -> Column:
    """NULL when the divisor is 0 or NULL; always floating point."""
    den_c = F.lit(den) if isinstance(den, (int, float)) else _col(den)
    return F.try_divide(_col(num).cast("double"), den_c.cast("double"))


def clamp_or_null(x: Column, lo: float, hi: float) -> Column:
    """``LEAST(hi, GREATEST(lo, x))`` with NULL propagation.

    Spark's least/greatest skip NULL arguments, so an unknown score would
    silently become ``lo``; the guard keeps it NULL.
    """
    return F.when(x.isNull(), F.lit(None).cast("double")).otherwise(
        F.least(F.lit(float(hi)), F.greatest(F.lit(float(lo)), x))
    )


def days_between(end: Column | str, start: Column | str) -> Column:
    return F.datediff(_col(end), _col(start)).cast("long")


def week_start_sunday(d: Column | str) -> Column:
    """Week truncation with weeks starting on Sunday (``date_trunc`` starts Monday)."""
    d = _col(d)
    return F.date_sub(d, F.dayofweek(d) - 1)


def round6(c: Column | str) -> Column:
    return F.round(_col(c), 6)


def _descending_gt(x: Column, cuts, labels) -> Column:
    expr = F.when(x > cuts[0], labels[0])
    for cut, label in zip(cuts[1:], labels[1:]):
        expr = expr.when(x > cut, label)
    return expr.otherwise(labels[len(cuts)])


def _descending_ge(x: Column, cuts, labels) -> Column:
    expr = F.when(x >= cuts[0], labels[0])
    for cut, label in zip(cuts[1:], labels[1:]):
        expr = expr.when(x >= cut, label)
    return expr.otherwise(labels[len(cuts)])


def momentum_status(pct_1d: Column | str) -> Column:
    """Strict bands on the 1-day % change; NULL falls to the last label."""
    return _descending_gt(_col(pct_1d), MOMENTUM_CUTS, MOMENTUM_LABELS)


def engagement_level(velocity: Column | str) -> Column:
    return _descending_ge(_col(velocity), ENGAGEMENT_CUTS, ENGAGEMENT_LABELS)


def virality_category(coefficient: Column | str) -> Column:
    return _descending_ge(_col(coefficient), VIRALITY_CUTS, VIRALITY_LABELS)


def trend_category(
    velocity: Column | str, popularity_change: Column | str, th: Thresholds = DEFAULT_THRESHOLDS
) -> Column:
    v, d = _col(velocity), _col(popularity_change)
    viral, rising, declining, stable = TREND_LABELS
    return (
        F.when((v > th.viral_velocity) & (d > th.viral_popularity_change), viral)
        .when(d > th.rising_popularity_change, rising)
        .when(d < th.declining_popularity_change, declining)
        .otherwise(stable)
    )


def release_cohort(days_since_release: Column | str) -> Column:
    x = _col(days_since_release)
    expr = F.when(x <= COHORT_CUTS[0], COHORT_LABELS[0])
    for cut, label in zip(COHORT_CUTS[1:], COHORT_LABELS[1:]):
        expr = expr.when(x <= cut, label)
    return expr.otherwise(COHORT_LABELS[-1])


def release_cohort_order(cohort: Column | str) -> Column:
    c = _col(cohort)
    expr = F.when(c == COHORT_LABELS[0], 1)
    for i, label in enumerate(COHORT_LABELS[1:-1], start=2):
        expr = expr.when(c == label, i)
    return expr.otherwise(len(COHORT_LABELS))


def engagement_trend(value: Column | str, baseline: Column | str) -> Column:
    x, b = _col(value), _col(baseline)
    up, down, flat = ENGAGEMENT_TREND_LABELS
    return F.when(x > b, up).when(x < b, down).otherwise(flat)


def breakout_type(now: Column | str, week_ago: Column | str) -> Column:
    n, p = _col(now), _col(week_ago)
    major, strong, rapid, steady = BREAKOUT_LABELS
    (major_below, major_at), (strong_below, strong_at) = BREAKOUT_RULES
    return (
        F.when((p < major_below) & (n >= major_at), major)
        .when((p < strong_below) & (n >= strong_at), strong)
        .when(n - p >= BREAKOUT_RISE, rapid)
        .otherwise(steady)
    )


def sorted_name_list(structs: Column | str, field: str = "name", sep: str = ", ") -> Column:
    """Names of an array of structs, sorted and joined; NULL when there are none.

    Same result as aggregating the unnested names with an ordered string_agg,
    but without exploding and regrouping the rows.
    """
    names = F.filter(F.transform(_col(structs), lambda g: g[field]), lambda n: n.isNotNull())
    return F.when(F.size(names) > 0, F.array_join(F.array_sort(names), sep))
