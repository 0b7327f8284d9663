import datetime as dt

import pytest
from pyspark.sql import functions as F

from tests.conftest import D, base_snapshots, daily_series
from pulse.operators.metrics import (
    aggregated_metrics,
    aggregated_metrics_as_written,
    dedupe_snapshots,
    derived_metrics,
)


def rows_by_date(df, key="snapshot_date"):
    return {r[key]: r for r in df.collect()}


def test_lags_are_row_offsets_and_null_before_history(spark):
    pops = [10, 11, 12, 13, 14, 15, 16, 17, 18]
    votes = [100, 110, 120, 130, 140, 150, 160, 170, 180]
    rows = daily_series(1, "2024-01-01", pops, votes)
    # sparse calendar: move the last row 30 days later; it is still "the next row"
    rows[-1] = (1, "2024-02-08", 18.0, 180)
    got = rows_by_date(derived_metrics(base_snapshots(spark, rows)))
    first = got[D("2024-01-01")]
    for c in ("popularity_change_1d", "popularity_change_7d", "vote_count_change_1d",
              "popularity_pct_change_1d", "vote_count_pct_change_7d"):
        assert first[c] is None
    second = got[D("2024-01-02")]
    assert second.popularity_change_1d == pytest.approx(1.0)
    assert second.vote_count_change_1d == 10
    assert second.popularity_pct_change_1d == pytest.approx(10.0)
    assert second.popularity_change_7d is None
    eighth = got[D("2024-01-08")]
    assert eighth.popularity_change_7d == pytest.approx(7.0)
    assert eighth.vote_count_change_7d == 70
    assert eighth.vote_count_pct_change_7d == pytest.approx(70.0)
    last = got[D("2024-02-08")]
    assert last.popularity_change_1d == pytest.approx(1.0)
    assert last.popularity_change_7d == pytest.approx(7.0)


def test_zero_previous_value_gives_null_pct(spark):
    rows = daily_series(1, "2024-01-01", [0, 5], [0, 4])
    got = rows_by_date(derived_metrics(base_snapshots(spark, rows)))[D("2024-01-02")]
    assert got.popularity_change_1d == 5.0
    assert got.popularity_pct_change_1d is None
    assert got.vote_count_pct_change_1d is None


def test_duplicate_key_keeps_latest_ingestion(spark):
    rows = [
        (1, "2024-01-01", 10.0, 100, 7.0, "2024-01-01 08:00:00"),
        (1, "2024-01-02", 20.0, 200, 7.0, "2024-01-02 08:00:00"),
        (1, "2024-01-02", 30.0, 300, 7.0, "2024-01-02 09:00:00"),
    ]
    d = dedupe_snapshots(base_snapshots(spark, rows))
    assert d.count() == 2
    got = rows_by_date(derived_metrics(base_snapshots(spark, rows)))
    assert got[D("2024-01-02")].popularity == 30.0
    assert got[D("2024-01-02")].popularity_change_1d == 20.0


def _series_for_coefficient(movie_id, p7, p, v7, v):
    # 8 rows: row 1 holds the 7-back values, row 8 the current ones
    pops = [p7] + [p7] * 6 + [p]
    votes = [v7] + [v7] * 6 + [v]
    return daily_series(movie_id, "2024-01-01", pops, votes)


@pytest.mark.parametrize(
    "p7,p,v7,v,expected",
    [
        (10, 12, 100, 120, 20.0),  # 0.6*20 + 0.4*20
        (10, 14, 100, 140, 40.0),
        (10, 16, 100, 160, 60.0),
        (10, 18, 100, 180, 80.0),
        (1, 100, 1, 1000, 100.0),  # clamped high
        (100, 1, 50, 50, 0.0),  # clamped low
        (0, 0, 0, 0, 0.0),  # divisors floored at 1
    ],
)
def test_viral_coefficient_exact_and_clamped(spark, p7, p, v7, v, expected):
    rows = _series_for_coefficient(1, p7, p, v7, v)
    m = aggregated_metrics(base_snapshots(spark, rows), D("2024-01-08")).first()
    assert m.viral_coefficient == pytest.approx(expected)
    assert m.vote_velocity_7d == pytest.approx((v - v7) / 7)


def test_coefficient_null_without_seven_rows_back(spark):
    rows = daily_series(1, "2024-01-01", [1, 2, 3, 4, 5, 6, 7], [1, 2, 3, 4, 5, 6, 7])
    m = aggregated_metrics(base_snapshots(spark, rows), D("2024-01-07")).first()
    assert m.viral_coefficient is None
    assert m.popularity_wow_change is None
    assert m.trend_category == "Stable"
    assert m.popularity_7d_ma == pytest.approx(4.0)


def test_acceleration_needs_fourteen_rows_back(spark):
    votes = [0] * 8 + [7] * 6 + [70, 140]  # 16 rows
    rows = daily_series(1, "2024-01-01", [5] * 16, votes)
    got = rows_by_date(aggregated_metrics(base_snapshots(spark, rows)), "calculation_date")
    assert got[D("2024-01-14")].vote_acceleration_7d is None  # row 14: no row 14 back
    r15 = got[D("2024-01-15")]  # v=70, v7=0 (row 8), v14=0 (row 1)
    assert r15.vote_velocity_7d == pytest.approx(10.0)
    assert r15.vote_acceleration_7d == pytest.approx(10.0)
    r16 = got[D("2024-01-16")]  # v=140, v7=7 (row 9), v14=0 (row 2)
    assert r16.vote_acceleration_7d == pytest.approx((140 - 7) / 7 - 1.0)


def test_trend_viral_requires_velocity_and_change(spark):
    rows = _series_for_coefficient(1, 10, 25, 0, 400)  # velocity 57.1, change +15
    assert aggregated_metrics(base_snapshots(spark, rows), D("2024-01-08")).first().trend_category == "Viral"
    rows = _series_for_coefficient(2, 10, 25, 0, 300)  # velocity 42.9
    assert aggregated_metrics(base_snapshots(spark, rows), D("2024-01-08")).first().trend_category == "Rising"


def test_backfill_equals_union_of_per_date_runs(spark):
    rows = daily_series(1, "2024-01-01", range(1, 20), range(10, 200, 10)) + daily_series(
        2, "2024-01-05", range(30, 10, -1), range(5, 105, 5)
    )
    snaps = base_snapshots(spark, rows)
    back = aggregated_metrics(snaps)
    dates = sorted({D(r[1]) for r in rows})
    per_date = None
    for d in dates:
        m = aggregated_metrics(snaps, d)
        per_date = m if per_date is None else per_date.unionByName(m)
    assert back.exceptAll(per_date).count() == 0
    assert per_date.exceptAll(back).count() == 0


def test_as_written_filters_before_windows(spark):
    rows = daily_series(1, "2024-01-01", range(1, 20), range(10, 200, 10))
    m = aggregated_metrics_as_written(base_snapshots(spark, rows), D("2024-01-15")).first()
    assert m.viral_coefficient is None
    assert m.popularity_wow_change is None
    assert m.trend_category == "Stable"
    assert m.popularity_7d_ma == 15.0
    proper = aggregated_metrics(base_snapshots(spark, rows), D("2024-01-15")).first()
    assert proper.viral_coefficient is not None


def test_late_snapshot_changes_following_rows_only(spark):
    rows = daily_series(1, "2024-01-01", range(1, 12), range(10, 120, 10))
    late = [r for r in rows if r[1] != "2024-01-05"]
    without = rows_by_date(derived_metrics(base_snapshots(spark, late)))
    with_late = rows_by_date(derived_metrics(base_snapshots(spark, rows)))
    assert without[D("2024-01-04")] == with_late[D("2024-01-04")]
    assert without[D("2024-01-06")].popularity_change_1d == 2.0
    assert with_late[D("2024-01-06")].popularity_change_1d == 1.0
