"""Viral-coefficient views and reports.

The score view joins the metric table to the dimension and to the snapshot
of the same (title, date). Its global ``PERCENT_RANK`` is computed by
``ranking.percent_rank_distributed``; consumers that never show the
percentile ask for the view without it, so they skip that work entirely.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pulse.config import DEFAULT_THRESHOLDS, VIRALITY_LABELS, VIRAL_STATUS_LABELS, Thresholds
from pulse.functions.columns import (
    breakout_type,
    days_between,
    engagement_level,
    engagement_trend,
    safe_div,
    since,
    sorted_name_list,
    virality_category,
)
from pulse.operators.momentum import latest_per_movie, side_by_side
from pulse.operators.ranking import (
    percent_rank_distributed,
    percent_rank_of,
    percentile_cont_distributed,
    top_k_ranked,
)


def _by_movie(order_col: str):
    return Window.partitionBy("movie_id").orderBy(order_col)


def vote_velocity_metrics(
    snapshots: DataFrame, movies: DataFrame, th: Thresholds = DEFAULT_THRESHOLDS
) -> DataFrame:
    """Latest row per title with 7-row vote velocity, acceleration and engagement level.

    The acceleration lag runs over the whole history before the latest row is
    picked; "latest" is read from the same ascending window (no following
    row), so one exchange and one sort serve both.
    """
    w = _by_movie("snapshot_date")
    days = th.velocity_days
    velocity = safe_div("vote_count_change_7d", days)
    s = snapshots.select(
        "movie_id",
        "snapshot_date",
        "vote_count",
        "vote_average",
        "vote_count_change_1d",
        "vote_count_change_7d",
        "vote_count_pct_change_7d",
        velocity.alias("_velocity"),
        (velocity - safe_div(F.lag("vote_count_change_7d", th.long_lag).over(w), days)).alias(
            "vote_acceleration"
        ),
        F.lead("snapshot_date", 1).over(w).isNull().alias("_is_latest"),
    ).where("_is_latest")
    return s.join(side_by_side(movies, "movie_id", "title", "release_date"), "movie_id").select(
        "movie_id",
        "title",
        "release_date",
        F.col("snapshot_date").alias("last_updated"),
        F.col("vote_count").alias("current_vote_count"),
        "vote_average",
        F.col("vote_count_change_1d").alias("daily_vote_increase"),
        F.col("vote_count_change_7d").alias("weekly_vote_increase"),
        F.col("vote_count_pct_change_7d").alias("weekly_vote_pct_increase"),
        F.col("_velocity").alias("avg_daily_votes_7d"),
        "vote_acceleration",
        engagement_level("_velocity").alias("engagement_level"),
    )


def _metrics_with_context(
    metrics: DataFrame, movies: DataFrame, snapshots: DataFrame, where
) -> DataFrame:
    ma = metrics.where(where).select(
        "movie_id",
        "calculation_date",
        "vote_velocity_7d",
        "vote_acceleration_7d",
        "popularity_wow_pct_change",
        "viral_coefficient",
        "trend_category",
    )
    snaps = side_by_side(
        snapshots,
        "movie_id",
        F.col("snapshot_date").alias("calculation_date"),
        "vote_count",
        "popularity",
        "vote_average",
    )
    titles = side_by_side(movies, "movie_id", "title", "release_date")
    return ma.join(titles, "movie_id").join(snaps, ["movie_id", "calculation_date"])


def viral_coefficient_scores(
    metrics: DataFrame,
    movies: DataFrame,
    snapshots: DataFrame,
    with_percentile: bool = True,
) -> DataFrame:
    """Every scored (title, date) with context, its percentile over all rows and its tier."""
    j = _metrics_with_context(metrics, movies, snapshots, F.col("viral_coefficient").isNotNull())
    cols = [
        "movie_id",
        "title",
        "release_date",
        "calculation_date",
        "vote_velocity_7d",
        "vote_acceleration_7d",
        "popularity_wow_pct_change",
        "viral_coefficient",
        "trend_category",
        F.col("vote_count").alias("current_vote_count"),
        F.col("popularity").alias("current_popularity"),
        "vote_average",
    ]
    if with_percentile:
        # The same rows by their keys: the inner joins find one row for each key, or none.
        key = ["movie_id", "calculation_date", "viral_coefficient"]
        scored = metrics.where(F.col("viral_coefficient").isNotNull()).select(*key)
        days = side_by_side(snapshots, "movie_id", F.col("snapshot_date").alias("calculation_date"))
        scored = scored.join(side_by_side(movies, "movie_id"), "movie_id", "left_semi").join(days, ["movie_id", "calculation_date"], "left_semi")
        # Only these keys are dealt by value and back by title; rows with all columns stay where they lie.
        ranks = percent_rank_distributed(scored.dropDuplicates(key), "viral_coefficient", "_pr", population=scored)
        j = j.join(ranks.hint("merge"), key, "left")
        cols.append((F.col("_pr") * 100).alias("viral_score_percentile"))
    cols.append(virality_category("viral_coefficient").alias("virality_category"))
    return j.select(*cols)


def top_viral_movies(
    metrics: DataFrame,
    movies: DataFrame,
    snapshots: DataFrame,
    th: Thresholds = DEFAULT_THRESHOLDS,
    with_percentile: bool = True,
) -> DataFrame:
    """Latest score per title, coefficient >= 20, ranked; top 100.

    The percentile is over every scored row of every date, but only the <= 100
    returned rows need it, so it is computed for those values only
    (``ranking.percent_rank_of``): one pass over the metrics, semi-joined to
    the keys that a score needs. A title's latest scored row is found among
    these, before titles and snapshots are joined to the rows that remain.
    """
    scored = metrics.where(F.col("viral_coefficient").isNotNull())
    known = scored.join(side_by_side(movies, "movie_id").distinct(), "movie_id", "left_semi").join(
        side_by_side(snapshots, "movie_id", F.col("snapshot_date").alias("calculation_date")),
        ["movie_id", "calculation_date"],
        "left_semi",
    )
    latest = latest_per_movie(known, "calculation_date").where(
        F.col("viral_coefficient") >= th.top_viral_min_coefficient
    )
    top = top_k_ranked(latest, "viral_coefficient", th.top_view_limit, "viral_rank")
    ranked = viral_coefficient_scores(top, movies, snapshots, with_percentile=False).join(
        top.select("movie_id", "viral_rank"), "movie_id"
    )
    cols = [
        "movie_id",
        "title",
        "release_date",
        days_between("calculation_date", "release_date").alias("days_since_release"),
        F.col("calculation_date").alias("last_updated"),
        "viral_coefficient",
        "virality_category",
        "trend_category",
        F.col("vote_velocity_7d").alias("avg_daily_votes"),
        F.col("vote_acceleration_7d").alias("vote_acceleration"),
        F.col("current_vote_count").alias("total_votes"),
        F.col("vote_average").alias("rating"),
        "current_popularity",
        F.col("popularity_wow_pct_change").alias("wow_popularity_change"),
    ]
    if with_percentile:
        ranked = percent_rank_of(ranked, known, "viral_coefficient", "_pr")
        cols.append((F.col("_pr") * 100).alias("viral_score_percentile"))
    cols.append("viral_rank")
    return ranked.orderBy("viral_rank", "movie_id").select(*cols)


def emerging_viral_trends(
    metrics: DataFrame,
    movies: DataFrame,
    snapshots: DataFrame,
    th: Thresholds = DEFAULT_THRESHOLDS,
) -> DataFrame:
    """Accelerating titles: latest row with acceleration > 0, velocity >= 10 and a strong score."""
    j = _metrics_with_context(
        metrics, movies, snapshots, F.col("vote_acceleration_7d").isNotNull()
    )
    w = _by_movie("calculation_date")
    j = j.select(
        "*",
        (F.col("vote_acceleration_7d") > 0).alias("is_accelerating"),
        F.lag("viral_coefficient", th.long_lag).over(w).alias("viral_score_7d_ago"),
        F.lead("calculation_date", 1).over(w).isNull().alias("_is_latest"),
    )
    keep = (
        F.col("_is_latest")
        & (F.col("is_accelerating") == F.lit(True))
        & (F.col("vote_velocity_7d") >= th.emerging_min_velocity)
        & (
            (F.col("viral_coefficient") > th.emerging_min_coefficient)
            | (F.col("vote_acceleration_7d") > th.emerging_min_acceleration)
        )
    )
    top = (
        j.where(keep)
        .orderBy(F.col("vote_acceleration_7d").desc(), "movie_id")
        .limit(th.top_view_limit)
    )
    return top.select(
        "movie_id",
        "title",
        "release_date",
        F.col("calculation_date").alias("last_updated"),
        "vote_velocity_7d",
        "vote_acceleration_7d",
        F.col("viral_coefficient").alias("current_viral_score"),
        "viral_score_7d_ago",
        (F.col("viral_coefficient") - F.coalesce(F.col("viral_score_7d_ago"), F.lit(0.0))).alias(
            "viral_score_change_7d"
        ),
        "trend_category",
        "vote_count",
        "popularity",
        "is_accelerating",
    )


def vote_engagement_timeline(
    snapshots: DataFrame, movies: DataFrame, th: Thresholds = DEFAULT_THRESHOLDS
) -> DataFrame:
    """Per snapshot: 7-row average of daily votes, running peak, and trend vs rows 13..7 back.

    Three frames on one partitioning and ordering: one exchange, one sort.
    """
    w = _by_movie("snapshot_date")
    x = F.col("vote_count_change_1d")
    baseline = F.avg(x).over(w.rowsBetween(-(2 * th.long_lag - 1), -th.long_lag))
    s = snapshots.select(
        "movie_id",
        "snapshot_date",
        "vote_count",
        "vote_average",
        "vote_count_change_1d",
        F.avg(x).over(w.rowsBetween(-(th.ma_rows - 1), Window.currentRow)).alias(
            "vote_velocity_7d_ma"
        ),
        F.max(x).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)).alias(
            "peak_daily_votes_so_far"
        ),
        engagement_trend(x, baseline).alias("engagement_trend"),
    )
    return s.join(side_by_side(movies, "movie_id", "title"), "movie_id").select(
        "movie_id",
        "title",
        "snapshot_date",
        "vote_count",
        "vote_average",
        "vote_count_change_1d",
        "vote_velocity_7d_ma",
        "peak_daily_votes_so_far",
        "engagement_trend",
    )


def daily_viral_report(
    metrics: DataFrame,
    movies: DataFrame,
    snapshots: DataFrame,
    th: Thresholds = DEFAULT_THRESHOLDS,
) -> DataFrame:
    """Top-viral rows with rank <= 50, their genre list and overview."""
    tvm = top_viral_movies(metrics, movies, snapshots, th, with_percentile=False).where(
        F.col("viral_rank") <= th.daily_viral_max_rank
    )
    extra = side_by_side(movies, "movie_id", "genres", "overview")
    return (
        tvm.join(extra, "movie_id")
        .orderBy(F.col("viral_coefficient").desc(), "movie_id")
        .select(
            "movie_id",
            "title",
            "release_date",
            "days_since_release",
            "virality_category",
            "viral_coefficient",
            "avg_daily_votes",
            "total_votes",
            "rating",
            "current_popularity",
            "wow_popularity_change",
            sorted_name_list("genres").alias("genres"),
            "overview",
        )
    )


def viral_vs_nonviral(
    metrics: DataFrame,
    movies: DataFrame,
    snapshots: DataFrame,
    th: Thresholds = DEFAULT_THRESHOLDS,
) -> DataFrame:
    """Latest score per title split at 40: averages, positive-only budget/revenue, median velocity."""
    scores = viral_coefficient_scores(metrics, movies, snapshots, with_percentile=False)
    latest = latest_per_movie(
        scores.select(
            "movie_id",
            "calculation_date",
            "viral_coefficient",
            "vote_velocity_7d",
            "current_vote_count",
            "vote_average",
            "current_popularity",
        ),
        "calculation_date",
    )
    viral, non_viral = VIRAL_STATUS_LABELS
    vc = latest.join(side_by_side(movies, "movie_id", "release_date", "budget", "revenue"), "movie_id").select(
        F.when(F.col("viral_coefficient") >= th.viral_status_cut, viral)
        .otherwise(non_viral)
        .alias("viral_status"),
        "viral_coefficient",
        "vote_velocity_7d",
        "current_vote_count",
        "vote_average",
        "current_popularity",
        days_between("calculation_date", "release_date").alias("days_since_release"),
        "budget",
        "revenue",
    )
    agg = vc.groupBy("viral_status").agg(
        F.count(F.lit(1)).alias("num_movies"),
        F.avg("viral_coefficient").alias("avg_viral_coefficient"),
        F.avg("vote_velocity_7d").alias("avg_vote_velocity"),
        F.avg("current_vote_count").alias("avg_total_votes"),
        F.avg("vote_average").alias("avg_rating"),
        F.avg("current_popularity").alias("avg_popularity"),
        F.avg("days_since_release").alias("avg_days_since_release"),
        F.avg(F.when(F.col("budget") > 0, F.col("budget"))).alias("avg_budget"),
        F.avg(F.when(F.col("revenue") > 0, F.col("revenue"))).alias("avg_revenue"),
    )
    median = percentile_cont_distributed(
        vc, "vote_velocity_7d", 0.5, "median_vote_velocity", ["viral_status"], few_groups=True
    )
    return agg.join(median, "viral_status", "left").orderBy("viral_status")


def viral_breakouts(
    metrics: DataFrame,
    movies: DataFrame,
    snapshots: DataFrame,
    as_of: _dt.date,
    th: Thresholds = DEFAULT_THRESHOLDS,
) -> DataFrame:
    """Scores now >= 40 and above the score 7 scored rows earlier, within the last 30 days."""
    scores = viral_coefficient_scores(metrics, movies, snapshots, with_percentile=False)
    w = _by_movie("calculation_date")
    hist = scores.select(
        "movie_id",
        "title",
        "calculation_date",
        "viral_coefficient",
        F.lag("viral_coefficient", th.long_lag).over(w).alias("viral_score_7d_ago"),
    )
    now, ago = F.col("viral_coefficient"), F.col("viral_score_7d_ago")
    keep = (
        (now >= th.breakout_min_coefficient)
        & ago.isNotNull()
        & (now > ago)
        & (F.col("calculation_date") >= F.date_sub(F.lit(as_of), th.breakout_window_days))
    )
    return (
        hist.where(keep)
        .withColumn("viral_score_increase", now - ago)
        .orderBy(F.col("viral_score_increase").desc(), "movie_id", "calculation_date")
        .limit(th.report_limit)
        .select(
            "movie_id",
            "title",
            F.col("calculation_date").alias("breakout_date"),
            F.col("viral_coefficient").alias("current_viral_score"),
            "viral_score_7d_ago",
            "viral_score_increase",
            breakout_type(now, ago).alias("breakout_type"),
        )
    )


def genre_viral_performance(
    metrics: DataFrame,
    movies: DataFrame,
    snapshots: DataFrame,
    as_of: _dt.date,
    th: Thresholds = DEFAULT_THRESHOLDS,
) -> DataFrame:
    """Per genre over the last 30 days: distinct titles, score stats, highly viral share."""
    start = F.date_sub(F.lit(as_of), th.genre_window_days)
    metrics, snapshots = since(metrics, "calculation_date", start), since(snapshots, "snapshot_date", start)
    scores = viral_coefficient_scores(metrics, movies, snapshots, with_percentile=False)
    g = scores.select(
        "movie_id", "viral_coefficient", "vote_velocity_7d", "virality_category"
    ).join(side_by_side(movies, "movie_id", "genres"), "movie_id")
    exploded = g.select(
        F.explode("genres").alias("_g"),
        "movie_id",
        "viral_coefficient",
        "vote_velocity_7d",
        "virality_category",
    ).select(F.col("_g.name").alias("genre"), "*")
    highly = F.col("virality_category").isin(VIRALITY_LABELS[0], VIRALITY_LABELS[1])
    agg = exploded.groupBy("genre").agg(
        F.countDistinct("movie_id").alias("num_movies"),
        F.avg("viral_coefficient").alias("avg_viral_coefficient"),
        F.max("viral_coefficient").alias("max_viral_coefficient"),
        F.avg("vote_velocity_7d").alias("avg_vote_velocity"),
        F.count_if(highly).cast("long").alias("highly_viral_count"),
    )
    return (
        agg.where(F.col("num_movies") >= th.genre_min_movies)
        .select(
            "genre",
            "num_movies",
            "avg_viral_coefficient",
            "max_viral_coefficient",
            "avg_vote_velocity",
            "highly_viral_count",
            (safe_div("highly_viral_count", "num_movies") * 100).alias("viral_movie_percentage"),
        )
        .orderBy(F.col("avg_viral_coefficient").desc(), "genre")
    )
