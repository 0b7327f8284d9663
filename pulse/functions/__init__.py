"""Column-level building blocks (pure ``Column -> Column`` functions)."""

from pulse.functions.columns import (
    breakout_type,
    clamp_or_null,
    days_between,
    engagement_level,
    engagement_trend,
    momentum_status,
    month_of,
    release_cohort,
    release_cohort_order,
    round6,
    safe_div,
    since,
    sorted_name_list,
    trend_category,
    virality_category,
    week_start_sunday,
)

__all__ = [
    "breakout_type",
    "clamp_or_null",
    "days_between",
    "engagement_level",
    "engagement_trend",
    "momentum_status",
    "month_of",
    "release_cohort",
    "release_cohort_order",
    "round6",
    "safe_div",
    "since",
    "sorted_name_list",
    "trend_category",
    "virality_category",
    "week_start_sunday",
]
