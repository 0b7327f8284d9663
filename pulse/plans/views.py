"""The views and reports by name, and their registration for SQL.

An analyst works in SQL: ``register_views`` puts the ten views into the
session as temporary views over any ``Tables`` (a warehouse's or the
fixture's). They are lazy; a statement runs only what it needs.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from pulse.operators import momentum, virality
from pulse.plans.tables import Tables

VIEWS: dict[str, Callable[[Tables], DataFrame]] = {
    "latest_popularity_metrics": lambda t: momentum.latest_popularity_metrics(t.snapshots, t.movies),
    "popularity_7d_moving_average": lambda t: momentum.popularity_moving_average(t.snapshots, t.movies),
    "popularity_wow_comparison": lambda t: momentum.popularity_week_over_week(t.snapshots, t.movies),
    "top_gaining_movies": lambda t: momentum.top_gaining_movies(t.snapshots, t.movies, t.metrics),
    "top_declining_movies": lambda t: momentum.top_declining_movies(t.snapshots, t.movies, t.metrics),
    "vote_velocity_metrics": lambda t: virality.vote_velocity_metrics(t.snapshots, t.movies),
    "viral_coefficient_scores": lambda t: virality.viral_coefficient_scores(t.metrics, t.movies, t.snapshots),
    "top_viral_movies": lambda t: virality.top_viral_movies(t.metrics, t.movies, t.snapshots),
    "emerging_viral_trends": lambda t: virality.emerging_viral_trends(t.metrics, t.movies, t.snapshots),
    "vote_engagement_timeline": lambda t: virality.vote_engagement_timeline(t.snapshots, t.movies),
}

REPORTS: dict[str, Callable[[Tables], DataFrame]] = {
    "daily_popularity_momentum_report": lambda t: momentum.daily_popularity_momentum_report(t.snapshots, t.movies, t.as_of),
    "release_cohort_trend": lambda t: momentum.release_cohort_trend(t.snapshots, t.movies, t.as_of),
    "daily_viral_report": lambda t: virality.daily_viral_report(t.metrics, t.movies, t.snapshots),
    "viral_vs_nonviral": lambda t: virality.viral_vs_nonviral(t.metrics, t.movies, t.snapshots),
    "viral_breakouts": lambda t: virality.viral_breakouts(t.metrics, t.movies, t.snapshots, t.as_of),
    "genre_viral_performance": lambda t: virality.genre_viral_performance(t.metrics, t.movies, t.snapshots, t.as_of),
}

#: The documented example queries, over the registered views.
EXAMPLES = {
    "example_top10_gaining": "SELECT title, weekly_pct_gain, current_popularity FROM top_gaining_movies ORDER BY weekly_pct_gain DESC, movie_id LIMIT 10",
    "example_top20_viral": "SELECT title, viral_coefficient, avg_daily_votes, virality_category FROM top_viral_movies WHERE viral_rank <= 20",
    "example_top10_emerging": "SELECT title, vote_acceleration_7d, viral_score_change_7d, trend_category FROM emerging_viral_trends ORDER BY vote_acceleration_7d DESC, movie_id LIMIT 10",
}


def register_views(spark: SparkSession, tables: Tables) -> list[str]:
    """The ten views and the three tables as temporary views of the session."""
    for name, view in VIEWS.items():
        view(tables).createOrReplaceTempView(name)
    tables.movies.createOrReplaceTempView("movies")
    tables.snapshots.createOrReplaceTempView("movie_daily_snapshots")
    tables.metrics.createOrReplaceTempView("movie_metrics_aggregated")
    return [*VIEWS, "movies", "movie_daily_snapshots", "movie_metrics_aggregated"]


def report(tables: Tables, name: str) -> DataFrame:
    """A view or report by its name."""
    return (VIEWS | REPORTS)[name](tables)
