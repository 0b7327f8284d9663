"""View semantics on small hand-made tables (cases the fixtures do not reach)."""

import datetime as dt
import tempfile

from pyspark.sql import functions as F

from tests.conftest import D, base_snapshots, daily_series, movies
from pulse.operators import momentum, virality
from pulse.operators.metrics import aggregated_metrics, derived_metrics

AS_OF = D("2024-03-01")


def tables(spark, hist, dims):
    base = base_snapshots(spark, hist)
    return derived_metrics(base), movies(spark, dims), aggregated_metrics(base)


def test_latest_momentum_uses_newest_row_and_null_falls(spark):
    hist = daily_series(1, "2024-01-01", [10, 11, 12.2], [1, 2, 3]) + daily_series(2, "2024-01-01", [5], [1])
    snaps, mv, _ = tables(spark, hist, [(1, "a", "2024-01-01"), (2, "b", None)])
    got = {r.movie_id: r for r in momentum.latest_popularity_metrics(snaps, mv).collect()}
    assert got[1].last_updated == D("2024-01-03")
    assert got[1].momentum_status == "Surging"  # +10.9 %
    assert got[2].momentum_status == "Falling"  # no history


def test_minimal_engagement_and_acceleration(spark):
    hist = daily_series(1, "2024-01-01", [1] * 9, [0, 0, 0, 0, 0, 0, 0, 0, 14])
    snaps, mv, _ = tables(spark, hist, [(1, "a", None)])
    r = virality.vote_velocity_metrics(snaps, mv).first()
    assert r.avg_daily_votes_7d == 2.0 and r.engagement_level == "Minimal Engagement"
    assert r.vote_acceleration is None  # no 7d change 7 rows back


def test_cohorts_null_and_future_release(spark):
    hist = []
    dims = []
    for i, rd in enumerate([None, "2024-03-10", "2024-02-15", "2023-12-15", "2023-10-01"], start=1):
        hist += daily_series(i, "2024-01-01", [10] * 7 + [10 + i], [1] * 8)
        dims.append((i, f"m{i}", rd))
    snaps, mv, _ = tables(spark, hist, dims)
    got = {r.release_cohort: r.num_movies for r in momentum.release_cohort_trend(snaps, mv, AS_OF).collect()}
    assert got == {"New (0-30 days)": 2, "Recent (31-90 days)": 1, "Established (91-180 days)": 1,
                   "Catalog (180+ days)": 1}


def test_momentum_report_genres_and_grouping_per_title(spark):
    hist = daily_series(1, "2024-01-01", [10] * 7 + [20], [1] * 8) + daily_series(
        2, "2024-01-01", [10] * 7 + [20], [1] * 8
    )
    dims = [(1, "same", "2024-01-01", [(2, "b"), (1, "a")]), (2, "same", "2024-01-01", [])]
    snaps, mv, _ = tables(spark, hist, dims)
    rows = momentum.daily_popularity_momentum_report(snaps, mv, AS_OF).collect()
    assert len(rows) == 2  # identical titles are not merged
    assert sorted([r.genres for r in rows], key=str) == [None, "a, b"]
    assert all(r.days_since_release == 60 for r in rows)


def test_top_gaining_ranks_with_ties(spark):
    hist = []
    for i, last in enumerate([20, 20, 15, 5], start=1):
        hist += daily_series(i, "2024-01-01", [10] * 7 + [last], [1] * 8)
    snaps, mv, metrics = tables(spark, hist, [(i, f"m{i}", None) for i in range(1, 5)])
    got = [(r.movie_id, r.momentum_rank) for r in momentum.top_gaining_movies(snaps, mv, metrics).collect()]
    assert got == [(1, 1), (2, 1), (3, 3)]
    dec = [(r.movie_id, r.decline_rank) for r in momentum.top_declining_movies(snaps, mv, metrics).collect()]
    assert dec == [(4, 1)]


def test_scores_skip_unscored_rows_and_percentile(spark):
    hist = daily_series(1, "2024-01-01", [10] * 7 + [12, 14], [100] * 7 + [120, 140])
    snaps, mv, metrics = tables(spark, hist, [(1, "a", "2023-12-01")])
    rows = sorted(virality.viral_coefficient_scores(metrics, mv, snaps).collect(), key=lambda r: r.calculation_date)
    assert [r.viral_coefficient for r in rows] == [20.0, 40.0]
    assert [r.viral_score_percentile for r in rows] == [0.0, 100.0]
    assert [r.virality_category for r in rows] == ["Slightly Viral", "Moderately Viral"]
    top = virality.top_viral_movies(metrics, mv, snaps).collect()
    assert len(top) == 1 and top[0].viral_rank == 1 and top[0].viral_score_percentile == 100.0
    assert top[0].days_since_release == 39  # 2023-12-01 -> 2024-01-09


def test_breakouts_need_rise_within_window(spark):
    pops = [10] * 7 + [10] * 7 + [30]
    votes = [100] * 7 + [100] * 7 + [200]
    hist = daily_series(1, "2024-02-01", pops, votes)
    snaps, mv, metrics = tables(spark, hist, [(1, "a", None)])
    b = virality.viral_breakouts(metrics, mv, snaps, AS_OF).collect()
    assert len(b) == 1
    assert b[0].viral_score_7d_ago == 0.0 and b[0].breakout_type == "Major Breakout"
    assert virality.viral_breakouts(metrics, mv, snaps, AS_OF + dt.timedelta(days=60)).count() == 0


def test_genre_report_counts_rows_over_distinct_titles(spark):
    hist = []
    dims = []
    for i in range(1, 11):
        hist += daily_series(i, "2024-02-01", [10] * 7 + [20, 25], [100] * 7 + [200, 250])
        dims.append((i, f"m{i}", None, [(1, "Drama")]))
    snaps, mv, metrics = tables(spark, hist, dims)
    r = virality.genre_viral_performance(metrics, mv, snaps, AS_OF).first()
    assert r.genre == "Drama" and r.num_movies == 10
    assert r.highly_viral_count == 20 and r.viral_movie_percentage == 200.0
    assert virality.genre_viral_performance(metrics, mv.where(F.col("movie_id") > 1), snaps, AS_OF).count() == 0


def test_moving_stddev_single_row_is_null(spark):
    hist = daily_series(1, "2024-01-01", [10], [1]) + daily_series(2, "2024-01-01", [10, 14], [1, 2])
    snaps, mv, _ = tables(spark, hist, [(1, "a", None), (2, "b", None)])
    got = {(r.movie_id, r.snapshot_date): r for r in momentum.popularity_moving_average(snaps, mv).collect()}
    one = got[(1, D("2024-01-01"))]
    assert one.popularity_volatility_7d is None and one.deviation_from_ma == 0.0
    two = got[(2, D("2024-01-02"))]
    assert two.popularity_7d_ma == 12.0 and abs(two.popularity_volatility_7d - 2.8284271247) < 1e-9


def test_week_over_week_uses_previous_week_row(spark):
    # Sat 2024-01-06 and Sun 2024-01-07 fall in different Sunday-start weeks
    hist = [(1, "2024-01-06", 10.0, 1), (1, "2024-01-07", 20.0, 2), (1, "2024-01-08", 30.0, 3)]
    snaps, mv, _ = tables(spark, hist, [(1, "a", None)])
    rows = sorted(momentum.popularity_week_over_week(snaps, mv).collect(), key=lambda r: r.current_week)
    assert [r.current_week for r in rows] == [D("2023-12-31"), D("2024-01-07")]
    assert rows[1].current_week_avg_popularity == 25.0 and rows[1].wow_pct_change == 150.0


def test_the_percentile_counts_its_population_without_the_wide_join(spark):
    """The join with titles and ratings occurs once; the population is read by its keys and score."""
    from pulse.operators.virality import viral_coefficient_scores

    base = base_snapshots(spark, daily_series(1, "2024-01-01", range(1, 40), range(100, 139)))
    path = tempfile.mkdtemp(prefix="pulse-plan-")
    derived_metrics(base).write.parquet(f"{path}/s")
    aggregated_metrics(base).write.parquet(f"{path}/m")
    movies(spark, [(1, "t", "2024-01-01")]).write.parquet(f"{path}/d")
    tables = [spark.read.parquet(f"{path}/{x}") for x in "mds"]
    plan = viral_coefficient_scores(*tables)._jdf.queryExecution().executedPlan().toString()
    for wide in ("release_date", "vote_average"):
        assert plan.count(f"{wide}:") == 1, wide


def test_a_repeated_score_keeps_its_rows_and_counts_them(spark):
    hist = daily_series(1, "2024-01-01", [10] * 7 + [12, 14], [100] * 7 + [120, 140])
    snaps, mv, metrics = tables(spark, hist, [(1, "a", "2023-12-01")])
    twice = metrics.unionAll(metrics.where(F.col("calculation_date") == "2024-01-08"))
    rows = virality.viral_coefficient_scores(twice, mv, snaps).collect()
    got = sorted((r.viral_coefficient, r.viral_score_percentile) for r in rows)
    assert got == [(20.0, 0.0), (20.0, 0.0), (40.0, 100.0)]
