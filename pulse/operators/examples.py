"""The documented example queries over the views."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulse.config import DEFAULT_THRESHOLDS, Thresholds
from pulse.operators.momentum import top_gaining_movies
from pulse.operators.virality import emerging_viral_trends, top_viral_movies


def example_top10_gaining(
    snapshots: DataFrame, movies: DataFrame, metrics: DataFrame, th: Thresholds = DEFAULT_THRESHOLDS
) -> DataFrame:
    """Top 10 titles gaining traction (the view's column is ``weekly_pct_gain``)."""
    v = top_gaining_movies(snapshots, movies, metrics, th)
    return (
        v.orderBy(F.col("weekly_pct_gain").desc(), "movie_id")
        .limit(10)
        .select("title", "weekly_pct_gain", "current_popularity")
    )


def example_top20_viral(
    metrics: DataFrame, movies: DataFrame, snapshots: DataFrame, th: Thresholds = DEFAULT_THRESHOLDS
) -> DataFrame:
    v = top_viral_movies(metrics, movies, snapshots, th, with_percentile=False)
    return v.where(F.col("viral_rank") <= 20).select(
        "title", "viral_coefficient", "avg_daily_votes", "virality_category"
    )


def example_top10_emerging(
    metrics: DataFrame, movies: DataFrame, snapshots: DataFrame, th: Thresholds = DEFAULT_THRESHOLDS
) -> DataFrame:
    v = emerging_viral_trends(metrics, movies, snapshots, th)
    return (
        v.orderBy(F.col("vote_acceleration_7d").desc(), "movie_id")
        .limit(10)
        .select("title", "vote_acceleration_7d", "viral_score_change_7d", "trend_category")
    )


def recent_updates_sample(movies: DataFrame, n: int = 10) -> DataFrame:
    """Newest dimension rows with the load day and time of day split out."""
    return (
        movies.orderBy(F.col("last_updated").desc(), "movie_id")
        .limit(n)
        .select(
            "movie_id",
            "title",
            "last_updated",
            F.to_date("last_updated").alias("update_date"),
            F.date_format("last_updated", "HH:mm:ss").alias("update_time"),
        )
    )
