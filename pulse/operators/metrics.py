"""Per-snapshot derived metrics and per-date aggregated metrics.

Both are lag / moving-frame windows over each title's time series, ordered by
``snapshot_date``. "1d" / "7d" are *row* offsets, not calendar days: the daily
job snapshots only changed titles, so gaps are normal and the lag is the
previous snapshot that exists.

Physical shape: one hash exchange on ``movie_id``, one sort on
(``movie_id``, ``snapshot_date``). Dedupe, every lag and every frame share that
exchange and sort because they use the same partitioning and a prefix of the
same ordering. A title has at most one row per date, so a window group is
bounded by the number of dates, not by data volume.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pulse import schemas
from pulse.config import DEFAULT_THRESHOLDS, Thresholds
from pulse.functions.columns import clamp_or_null, safe_div, trend_category

BASE_COLUMNS = schemas.column_names(schemas.SNAPSHOT_BASE) + ["ingestion_timestamp"]


def by_movie(order_col: str = "snapshot_date"):
    return Window.partitionBy("movie_id").orderBy(order_col)


def dedupe_snapshots(snapshots: DataFrame) -> DataFrame:
    """One row per (``movie_id``, ``snapshot_date``): the latest ``ingestion_timestamp``.

    Expressed as "first row of its date" inside the per-title window, so it
    reuses the per-title exchange that the lags need (a ``row_number`` over
    (``movie_id``, ``snapshot_date``) would hash on both keys and force a
    second shuffle). Value columns break ties so reruns are deterministic.
    """
    w = Window.partitionBy("movie_id").orderBy(
        "snapshot_date",
        F.col("ingestion_timestamp").desc_nulls_last(),
        F.col("popularity").desc_nulls_last(),
        F.col("vote_count").desc_nulls_last(),
        F.col("vote_average").desc_nulls_last(),
    )
    prev_date = F.lag("snapshot_date", 1).over(w)
    return (
        snapshots.select(*BASE_COLUMNS)
        .withColumn("_prev_date", prev_date)
        .where(F.col("_prev_date").isNull() | (F.col("_prev_date") != F.col("snapshot_date")))
        .drop("_prev_date")
    )


def derived_metrics(snapshots: DataFrame, th: Thresholds = DEFAULT_THRESHOLDS) -> DataFrame:
    """The snapshot table with its 8 change columns recomputed (dedupe first, then lag)."""
    s = dedupe_snapshots(snapshots)
    w = by_movie()
    p, v = F.col("popularity"), F.col("vote_count")
    p1, v1 = F.lag(p, th.short_lag).over(w), F.lag(v, th.short_lag).over(w)
    p7, v7 = F.lag(p, th.long_lag).over(w), F.lag(v, th.long_lag).over(w)
    s = s.select(*BASE_COLUMNS, p1.alias("_p1"), v1.alias("_v1"), p7.alias("_p7"), v7.alias("_v7"))
    out = s.select(
        "movie_id",
        "snapshot_date",
        "popularity",
        "vote_count",
        "vote_average",
        (p - F.col("_p1")).alias("popularity_change_1d"),
        (p - F.col("_p7")).alias("popularity_change_7d"),
        (safe_div(p - F.col("_p1"), "_p1") * 100).alias("popularity_pct_change_1d"),
        (safe_div(p - F.col("_p7"), "_p7") * 100).alias("popularity_pct_change_7d"),
        (v - F.col("_v1")).alias("vote_count_change_1d"),
        (v - F.col("_v7")).alias("vote_count_change_7d"),
        (safe_div(v - F.col("_v1"), "_v1") * 100).alias("vote_count_pct_change_1d"),
        (safe_div(v - F.col("_v7"), "_v7") * 100).alias("vote_count_pct_change_7d"),
        "ingestion_timestamp",
    )
    return out


def _aggregate_columns(th: Thresholds):
    """Aggregated-metric columns over a frame that has ``_p7``, ``_v7``, ``_v14``, ``_ma``."""
    p, v = F.col("popularity"), F.col("vote_count")
    p7, v7, v14 = F.col("_p7"), F.col("_v7"), F.col("_v14")
    days = th.velocity_days
    velocity = safe_div(v - v7, days)
    score = (safe_div(v - v7, F.greatest(v7, F.lit(1))) * 100) * th.vote_weight + (
        safe_div(p - p7, F.greatest(p7, F.lit(1.0))) * 100
    ) * th.popularity_weight
    return [
        F.col("movie_id"),
        F.col("snapshot_date").alias("calculation_date"),
        F.col("_ma").alias("popularity_7d_ma"),
        (p - p7).alias("popularity_wow_change"),
        (safe_div(p - p7, p7) * 100).alias("popularity_wow_pct_change"),
        velocity.alias("vote_velocity_7d"),
        (velocity - safe_div(v7 - v14, days)).alias("vote_acceleration_7d"),
        clamp_or_null(score, th.coefficient_floor, th.coefficient_cap).alias("viral_coefficient"),
        trend_category(velocity, p - p7, th).alias("trend_category"),
    ]


def _with_history_lags(s: DataFrame, th: Thresholds) -> DataFrame:
    w = by_movie()
    return s.select(
        "movie_id",
        "snapshot_date",
        "popularity",
        "vote_count",
        F.lag("popularity", th.long_lag).over(w).alias("_p7"),
        F.lag("vote_count", th.long_lag).over(w).alias("_v7"),
        F.lag("vote_count", th.baseline_lag).over(w).alias("_v14"),
        F.avg("popularity").over(w.rowsBetween(-(th.ma_rows - 1), 0)).alias("_ma"),
    )


def aggregated_metrics(
    snapshots: DataFrame,
    calculation_date: _dt.date | None = None,
    th: Thresholds = DEFAULT_THRESHOLDS,
) -> DataFrame:
    """Aggregated metrics: windows over each title's history, then the date filter.

    ``calculation_date=None`` is the backfill: one row per snapshot with
    ``calculation_date = snapshot_date`` (all frames look backward only, so it
    equals the union of the per-date runs).

    For one date only the titles with a snapshot on that date and rows up to
    that date can matter; both restrictions are exact and go below the window
    (the date bound reaches the scan as a pushed filter).
    """
    s = snapshots.select(*BASE_COLUMNS)
    if calculation_date is not None:
        d = F.lit(calculation_date)
        s = s.where(F.col("snapshot_date") <= d)
        on_date = s.where(F.col("snapshot_date") == d).select("movie_id")
        s = s.join(on_date, "movie_id", "left_semi")
    out = _with_history_lags(dedupe_snapshots(s), th).select(*_aggregate_columns(th))
    if calculation_date is not None:
        out = out.where(F.col("calculation_date") == F.lit(calculation_date))
    return out


def aggregated_metrics_as_written(
    snapshots: DataFrame, calculation_date: _dt.date, th: Thresholds = DEFAULT_THRESHOLDS
) -> DataFrame:
    """The published statement read literally: date filter *before* the windows.

    Each title's window then holds one row, so every lag is NULL, the moving
    average equals the popularity, the coefficient is NULL and the trend is
    always the ELSE label. Kept as its own operator for comparison.
    """
    s = dedupe_snapshots(snapshots).where(F.col("snapshot_date") == F.lit(calculation_date))
    return _with_history_lags(s, th).select(*_aggregate_columns(th))
