"""Popularity-momentum views and reports.

Inputs are the stored tables: ``movies`` (dimension), ``snapshots`` (with the
derived change columns) and ``metrics`` (aggregated, one row per title and
calculation date). ``as_of`` replaces CURRENT_DATE so results are reproducible.

Joins of stored tables by title are sort-merge joins (``side_by_side``): their
buckets meet where they lie, and no table goes through the driver. Top-k views
rank after the limit (see ``ranking``).
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pulse.config import DEFAULT_THRESHOLDS, Thresholds
from pulse.functions.columns import (
    days_between,
    momentum_status,
    release_cohort,
    release_cohort_order,
    safe_div,
    sorted_name_list,
    week_start_sunday,
)
from pulse.operators.ranking import percentile_cont_distributed, top_k_ranked


def latest_per_movie(df: DataFrame, date_col: str) -> DataFrame:
    """The newest row of each title (``ROW_NUMBER() ... = 1``).

    Planned as a partial ``WindowGroupLimit`` before the shuffle, so at most one
    row per title and input partition is exchanged.
    """
    w = Window.partitionBy("movie_id").orderBy(F.col(date_col).desc())
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")


def side_by_side(table: DataFrame, *columns) -> DataFrame:
    """Columns of a stored table, to be joined by sort-merge.

    Spark takes a few columns of a table for that share of its compressed files: some
    MB stand for millions of titles, and without the hint it would broadcast them.
    """
    return table.select(*columns).hint("merge")


def _titles(movies: DataFrame) -> DataFrame:
    return side_by_side(movies, "movie_id", "title", "release_date")


def latest_popularity_metrics(snapshots: DataFrame, movies: DataFrame) -> DataFrame:
    """Latest snapshot per title with its daily / weekly change and momentum status."""
    latest = latest_per_movie(
        snapshots.select(
            "movie_id",
            "snapshot_date",
            "popularity",
            "popularity_change_1d",
            "popularity_change_7d",
            "popularity_pct_change_1d",
            "popularity_pct_change_7d",
        ),
        "snapshot_date",
    )
    return latest.join(_titles(movies), "movie_id").select(
        "movie_id",
        "title",
        "release_date",
        F.col("snapshot_date").alias("last_updated"),
        F.col("popularity").alias("current_popularity"),
        F.col("popularity_change_1d").alias("daily_change"),
        F.col("popularity_pct_change_1d").alias("daily_pct_change"),
        F.col("popularity_change_7d").alias("weekly_change"),
        F.col("popularity_pct_change_7d").alias("weekly_pct_change"),
        momentum_status("popularity_pct_change_1d").alias("momentum_status"),
    )


def popularity_moving_average(
    snapshots: DataFrame, movies: DataFrame, th: Thresholds = DEFAULT_THRESHOLDS
) -> DataFrame:
    """Per snapshot: 7-row moving average, deviation from it and 7-row sample stddev."""
    w = (
        Window.partitionBy("movie_id")
        .orderBy("snapshot_date")
        .rowsBetween(-(th.ma_rows - 1), Window.currentRow)
    )
    s = snapshots.select(
        "movie_id",
        "snapshot_date",
        "popularity",
        F.avg("popularity").over(w).alias("popularity_7d_ma"),
        F.stddev_samp("popularity").over(w).alias("popularity_volatility_7d"),
    )
    return s.join(side_by_side(movies, "movie_id", "title"), "movie_id").select(
        "movie_id",
        "title",
        "snapshot_date",
        "popularity",
        "popularity_7d_ma",
        (F.col("popularity") - F.col("popularity_7d_ma")).alias("deviation_from_ma"),
        "popularity_volatility_7d",
    )


def popularity_week_over_week(snapshots: DataFrame, movies: DataFrame) -> DataFrame:
    """Weekly (Sunday-start) avg / max / min per title, compared with the previous week row."""
    weekly = snapshots.groupBy("movie_id", week_start_sunday("snapshot_date").alias("week_start")).agg(
        F.avg("popularity").alias("avg_popularity"),
        F.max("popularity").alias("max_popularity"),
        F.min("popularity").alias("min_popularity"),
    )
    prev = F.lag("avg_popularity", 1).over(Window.partitionBy("movie_id").orderBy("week_start"))
    w = weekly.withColumn("_prev", prev)
    return w.join(side_by_side(movies, "movie_id", "title"), "movie_id").select(
        "movie_id",
        "title",
        F.col("week_start").alias("current_week"),
        F.col("avg_popularity").alias("current_week_avg_popularity"),
        F.col("_prev").alias("prev_week_avg_popularity"),
        (F.col("avg_popularity") - F.col("_prev")).alias("wow_change"),
        (safe_div(F.col("avg_popularity") - F.col("_prev"), "_prev") * 100).alias("wow_pct_change"),
        F.col("max_popularity").alias("peak_popularity"),
        F.col("min_popularity").alias("low_popularity"),
    )


def _latest_with_metrics(
    snapshots: DataFrame,
    movies: DataFrame,
    metrics: DataFrame,
    keep,
    ascending: bool,
    th: Thresholds,
    pct_name: str,
    rank_name: str,
) -> DataFrame:
    latest = latest_per_movie(
        snapshots.select("movie_id", "snapshot_date", "popularity", "popularity_pct_change_7d"),
        "snapshot_date",
    ).where(keep(F.col("popularity_pct_change_7d")))
    ranked = top_k_ranked(
        latest.join(_titles(movies), "movie_id"),
        "popularity_pct_change_7d",
        th.top_view_limit,
        rank_name,
        ascending=ascending,
    )
    # The metric columns neither filter nor order, so they are attached to the
    # <= k ranked rows only: the k keys (bounded by the limit) are broadcast as
    # a semi-join filter on the metric table, then left-joined.
    keys = ranked.select("movie_id", F.col("snapshot_date").alias("calculation_date"))
    m = metrics.select(
        "movie_id", "calculation_date", "popularity_7d_ma", "popularity_wow_pct_change"
    ).join(F.broadcast(keys), ["movie_id", "calculation_date"], "left_semi")
    joined = ranked.join(
        m.withColumnRenamed("calculation_date", "snapshot_date"),
        ["movie_id", "snapshot_date"],
        "left",
    )
    return joined.orderBy(rank_name, "movie_id").select(
        "movie_id",
        "title",
        "release_date",
        F.col("snapshot_date").alias("last_updated"),
        F.col("popularity").alias("current_popularity"),
        "popularity_7d_ma",
        F.col("popularity_pct_change_7d").alias(pct_name),
        F.col("popularity_wow_pct_change").alias("wow_pct_change"),
        rank_name,
    )


def top_gaining_movies(
    snapshots: DataFrame, movies: DataFrame, metrics: DataFrame, th: Thresholds = DEFAULT_THRESHOLDS
) -> DataFrame:
    return _latest_with_metrics(
        snapshots, movies, metrics, lambda c: c.isNotNull() & (c > 0), False, th,
        "weekly_pct_gain", "momentum_rank",
    )


def top_declining_movies(
    snapshots: DataFrame, movies: DataFrame, metrics: DataFrame, th: Thresholds = DEFAULT_THRESHOLDS
) -> DataFrame:
    return _latest_with_metrics(
        snapshots, movies, metrics, lambda c: c.isNotNull() & (c < 0), True, th,
        "weekly_pct_decline", "decline_rank",
    )


def daily_popularity_momentum_report(
    snapshots: DataFrame,
    movies: DataFrame,
    as_of: _dt.date,
    th: Thresholds = DEFAULT_THRESHOLDS,
) -> DataFrame:
    """Titles gaining traction (weekly % > 5), newest first by weekly %, top 50, with genres.

    Grouped per title (the published report groups by its nine output columns
    and would merge identical titles). The limit is taken before the genre
    list is built, so only 50 dimension rows are touched for it.
    """
    lpm = latest_popularity_metrics(snapshots, movies).where(
        F.col("weekly_pct_change") > th.gaining_report_min_weekly_pct
    )
    top = lpm.orderBy(F.col("weekly_pct_change").desc(), "movie_id").limit(th.report_limit)
    genres = side_by_side(movies, "movie_id", "genres")
    ordered = top.join(genres, "movie_id").orderBy(F.col("weekly_pct_change").desc(), "movie_id")
    return ordered.select(
        "title",
        "release_date",
        days_between(F.lit(as_of), "release_date").alias("days_since_release"),
        "current_popularity",
        "daily_change",
        "daily_pct_change",
        "weekly_change",
        "weekly_pct_change",
        "momentum_status",
        sorted_name_list("genres").alias("genres"),
    )


def release_cohort_trend(
    snapshots: DataFrame,
    movies: DataFrame,
    as_of: _dt.date,
    th: Thresholds = DEFAULT_THRESHOLDS,
) -> DataFrame:
    """Per release cohort: count, average and exact median weekly %, surging / falling counts."""
    lpm = latest_popularity_metrics(snapshots, movies).where(
        F.col("weekly_pct_change").isNotNull()
    )
    cohorts = lpm.select(
        release_cohort(days_between(F.lit(as_of), "release_date")).alias("release_cohort"),
        "weekly_pct_change",
        "current_popularity",
    )
    agg = cohorts.groupBy("release_cohort").agg(
        F.count(F.lit(1)).alias("num_movies"),
        F.avg("weekly_pct_change").alias("avg_weekly_pct_change"),
        # The sum is rounded first: its last digits depend on the order of the rows.
        (F.round(F.sum("current_popularity"), 8) / F.count("current_popularity")).alias("avg_popularity"),
        F.count_if(F.col("weekly_pct_change") > th.cohort_surging_pct).cast("long").alias(
            "surging_count"
        ),
        F.count_if(F.col("weekly_pct_change") < th.cohort_falling_pct).cast("long").alias(
            "falling_count"
        ),
    )
    median = percentile_cont_distributed(
        cohorts, "weekly_pct_change", 0.5, "median_weekly_pct_change", ["release_cohort"], few_groups=True
    )
    return (
        agg.join(median, "release_cohort", "left")
        .orderBy(release_cohort_order("release_cohort"))
        .select(
            "release_cohort",
            "num_movies",
            "avg_weekly_pct_change",
            "avg_popularity",
            "median_weekly_pct_change",
            "surging_count",
            "falling_count",
        )
    )
