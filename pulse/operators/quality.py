"""Data-quality checks: required-column NULL counts, one scan per table.

The published validator runs one COUNT query per column and stops at the
first failure; here all counts of a table come from a single aggregation and
are reported in long form, one row per check.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulse.config import MOVIES_REQUIRED_CHECKS, SNAPSHOTS_REQUIRED_CHECKS


def null_checks(df: DataFrame, table_name: str, columns: Sequence[str]) -> DataFrame:
    """Rows: table_name, check_order, check_name, failing_rows, total_rows, passed."""
    counts = df.agg(
        *[F.count_if(F.col(c).isNull()).alias(f"_c{i}") for i, c in enumerate(columns)],
        F.count(F.lit(1)).alias("_total"),
    )
    entries = F.array(
        *[
            F.struct(
                F.lit(i + 1).cast("long").alias("check_order"),
                F.lit(f"{c} is null").alias("check_name"),
                F.col(f"_c{i}").cast("long").alias("failing_rows"),
            )
            for i, c in enumerate(columns)
        ]
    )
    return counts.select(F.explode(entries).alias("_e"), "_total").select(
        F.lit(table_name).alias("table_name"),
        "_e.check_order",
        "_e.check_name",
        "_e.failing_rows",
        F.col("_total").cast("long").alias("total_rows"),
        (F.col("_e.failing_rows") == 0).alias("passed"),
    )


def validate_movies(movies: DataFrame) -> DataFrame:
    return null_checks(movies, "movies", MOVIES_REQUIRED_CHECKS)


def validate_snapshots(snapshots: DataFrame) -> DataFrame:
    return null_checks(snapshots, "movie_daily_snapshots", SNAPSHOTS_REQUIRED_CHECKS)


def validate_all(movies: DataFrame, snapshots: DataFrame) -> DataFrame:
    """Both tables' checks plus one overall row (``table_name = 'all'``)."""
    checks = validate_movies(movies).unionByName(validate_snapshots(snapshots))
    overall = checks.agg(
        F.lit("all").alias("table_name"),
        F.lit(0).cast("long").alias("check_order"),
        F.lit("all checks").alias("check_name"),
        F.sum("failing_rows").cast("long").alias("failing_rows"),
        F.sum("total_rows").cast("long").alias("total_rows"),
        F.bool_and("passed").alias("passed"),
    )
    return checks.unionByName(overall)


def exit_code(report: DataFrame) -> int:
    """0 when every check passed, 1 otherwise (one boolean crosses to the driver)."""
    ok = report.agg(F.bool_and("passed").alias("ok")).first()["ok"]
    return 0 if ok else 1
