"""Thresholds, weights and labels used by the metric and view operators.

All numbers live in one frozen dataclass so a job can pass a variant, but the
defaults are the values the published views are defined with.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass

# ---------------------------------------------------------------------------
# These literals must equal the published view definitions for
# results to match. Listed in the order the definitions use them.
# ---------------------------------------------------------------------------

# momentum_status, from the 1-day popularity % change (strict >)
MOMENTUM_LABELS = ("Surging", "Rising", "Stable", "Declining", "Falling")
MOMENTUM_CUTS = (10.0, 5.0, -5.0, -10.0)

# engagement_level, from 7-day vote velocity (inclusive >=)
ENGAGEMENT_LABELS = (
    "Viral",
    "High Engagement",
    "Moderate Engagement",
    "Low Engagement",
    "Minimal Engagement",
)
ENGAGEMENT_CUTS = (100.0, 50.0, 20.0, 5.0)

# virality_category, from viral_coefficient (inclusive >=)
VIRALITY_LABELS = (
    "Extremely Viral",
    "Highly Viral",
    "Moderately Viral",
    "Slightly Viral",
    "Not Viral",
)
VIRALITY_CUTS = (80.0, 60.0, 40.0, 20.0)

# trend_category of the aggregated metrics
TREND_LABELS = ("Viral", "Rising", "Declining", "Stable")

# release cohorts, by days since release (inclusive <=), in report order
COHORT_LABELS = (
    "New (0-30 days)",
    "Recent (31-90 days)",
    "Established (91-180 days)",
    "Catalog (180+ days)",
)
COHORT_CUTS = (30, 90, 180)

# breakout_type of the breakout report: (score a week ago below, score now at
# least) for the first two labels, then a rise of at least BREAKOUT_RISE
BREAKOUT_LABELS = ("Major Breakout", "Strong Breakout", "Rapid Growth", "Steady Growth")
BREAKOUT_RULES = ((20.0, 40.0), (40.0, 60.0))
BREAKOUT_RISE = 20.0

# engagement_trend of the vote timeline
ENGAGEMENT_TREND_LABELS = ("Increasing", "Decreasing", "Stable")

# viral_status of the viral-vs-nonviral report
VIRAL_STATUS_LABELS = ("Viral", "Non-Viral")

# validation checks: (table, required column) pairs, in check order
MOVIES_REQUIRED_CHECKS = ("last_updated", "movie_id", "title")
SNAPSHOTS_REQUIRED_CHECKS = ("ingestion_timestamp", "movie_id", "snapshot_date")


# Fixed values, continued: the defaults below must equal the published
# definitions as well; a job may pass others.
@dataclass(frozen=True)
class Thresholds:
    # aggregated metrics
    vote_weight: float = 0.6
    popularity_weight: float = 0.4
    coefficient_floor: float = 0.0
    coefficient_cap: float = 100.0
    velocity_days: int = 7
    viral_velocity: float = 50.0
    viral_popularity_change: float = 10.0
    rising_popularity_change: float = 5.0
    declining_popularity_change: float = -5.0
    # lags and frames (row offsets, not calendar days)
    short_lag: int = 1
    long_lag: int = 7
    baseline_lag: int = 14
    ma_rows: int = 7
    # views and reports
    top_view_limit: int = 100
    report_limit: int = 50
    top_viral_min_coefficient: float = 20.0
    daily_viral_max_rank: int = 50
    gaining_report_min_weekly_pct: float = 5.0
    emerging_min_velocity: float = 10.0
    emerging_min_coefficient: float = 30.0
    emerging_min_acceleration: float = 5.0
    viral_status_cut: float = 40.0
    breakout_min_coefficient: float = 40.0
    breakout_window_days: int = 30
    genre_window_days: int = 30
    genre_min_movies: int = 10
    cohort_surging_pct: float = 10.0
    cohort_falling_pct: float = -10.0
    top_n_default: int = 1000


DEFAULT_THRESHOLDS = Thresholds()

# The fixture's "today": the last ship date at every scale factor. Views that
# the published SQL anchors on CURRENT_DATE() take an explicit ``as_of``.
FIXTURE_AS_OF = _dt.date(2001, 11, 4)
EVENTS_AS_OF = _dt.date(2024, 1, 30)
