"""Declared schemas of the three tables and of the raw detail records.

Parquet reads come back nullable; "required" columns are enforced by the
checks in ``pulse.operators.quality``, not by the reader.
"""

from __future__ import annotations

from pyspark.sql import types as T

GENRE = T.StructType([T.StructField("id", T.LongType()), T.StructField("name", T.StringType())])
COMPANY = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("name", T.StringType()),
        T.StructField("logo_path", T.StringType()),
        T.StructField("origin_country", T.StringType()),
    ]
)
COUNTRY = T.StructType(
    [T.StructField("iso_3166_1", T.StringType()), T.StructField("name", T.StringType())]
)
LANGUAGE = T.StructType(
    [
        T.StructField("iso_639_1", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("english_name", T.StringType()),
    ]
)

ARRAY_COLUMNS = {
    "genres": T.ArrayType(GENRE),
    "production_companies": T.ArrayType(COMPANY),
    "production_countries": T.ArrayType(COUNTRY),
    "spoken_languages": T.ArrayType(LANGUAGE),
}

MOVIES = T.StructType(
    [
        T.StructField("movie_id", T.LongType(), False),
        T.StructField("title", T.StringType(), False),
        T.StructField("original_title", T.StringType()),
        T.StructField("original_language", T.StringType()),
        T.StructField("overview", T.StringType()),
        T.StructField("release_date", T.DateType()),
        T.StructField("runtime", T.LongType()),
        T.StructField("budget", T.LongType()),
        T.StructField("revenue", T.LongType()),
        T.StructField("status", T.StringType()),
        T.StructField("tagline", T.StringType()),
        T.StructField("homepage", T.StringType()),
        T.StructField("imdb_id", T.StringType()),
        T.StructField("adult", T.BooleanType()),
        T.StructField("video", T.BooleanType()),
        T.StructField("genres", ARRAY_COLUMNS["genres"]),
        T.StructField("production_companies", ARRAY_COLUMNS["production_companies"]),
        T.StructField("production_countries", ARRAY_COLUMNS["production_countries"]),
        T.StructField("spoken_languages", ARRAY_COLUMNS["spoken_languages"]),
        T.StructField("poster_path", T.StringType()),
        T.StructField("backdrop_path", T.StringType()),
        T.StructField("last_updated", T.TimestampType(), False),
    ]
)

SNAPSHOT_BASE = T.StructType(
    [
        T.StructField("movie_id", T.LongType(), False),
        T.StructField("snapshot_date", T.DateType(), False),
        T.StructField("popularity", T.DoubleType(), False),
        T.StructField("vote_count", T.LongType(), False),
        T.StructField("vote_average", T.DoubleType(), False),
    ]
)

DERIVED_COLUMNS = (
    ("popularity_change_1d", T.DoubleType()),
    ("popularity_change_7d", T.DoubleType()),
    ("popularity_pct_change_1d", T.DoubleType()),
    ("popularity_pct_change_7d", T.DoubleType()),
    ("vote_count_change_1d", T.LongType()),
    ("vote_count_change_7d", T.LongType()),
    ("vote_count_pct_change_1d", T.DoubleType()),
    ("vote_count_pct_change_7d", T.DoubleType()),
)

SNAPSHOTS = T.StructType(
    list(SNAPSHOT_BASE.fields)
    + [T.StructField(n, t) for n, t in DERIVED_COLUMNS]
    + [T.StructField("ingestion_timestamp", T.TimestampType(), False)]
)

METRICS = T.StructType(
    [
        T.StructField("movie_id", T.LongType(), False),
        T.StructField("calculation_date", T.DateType(), False),
        T.StructField("popularity_7d_ma", T.DoubleType()),
        T.StructField("popularity_wow_change", T.DoubleType()),
        T.StructField("popularity_wow_pct_change", T.DoubleType()),
        T.StructField("vote_velocity_7d", T.DoubleType()),
        T.StructField("vote_acceleration_7d", T.DoubleType()),
        T.StructField("viral_coefficient", T.DoubleType()),
        T.StructField("trend_category", T.StringType()),
    ]
)

# Raw detail record, one JSON object per title. ``release_date`` stays a
# string until the transform; ``arrival_seq`` orders records for keep-last.
RAW_DETAILS = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("arrival_seq", T.LongType()),
        T.StructField("title", T.StringType()),
        T.StructField("original_title", T.StringType()),
        T.StructField("original_language", T.StringType()),
        T.StructField("overview", T.StringType()),
        T.StructField("release_date", T.StringType()),
        T.StructField("runtime", T.LongType()),
        T.StructField("budget", T.LongType()),
        T.StructField("revenue", T.LongType()),
        T.StructField("status", T.StringType()),
        T.StructField("tagline", T.StringType()),
        T.StructField("homepage", T.StringType()),
        T.StructField("imdb_id", T.StringType()),
        T.StructField("adult", T.BooleanType()),
        T.StructField("video", T.BooleanType()),
        T.StructField("genres", ARRAY_COLUMNS["genres"]),
        T.StructField("production_companies", ARRAY_COLUMNS["production_companies"]),
        T.StructField("production_countries", ARRAY_COLUMNS["production_countries"]),
        T.StructField("spoken_languages", ARRAY_COLUMNS["spoken_languages"]),
        T.StructField("poster_path", T.StringType()),
        T.StructField("backdrop_path", T.StringType()),
        T.StructField("popularity", T.DoubleType()),
        T.StructField("vote_count", T.LongType()),
        T.StructField("vote_average", T.DoubleType()),
    ]
)

# Change feed: which ids changed on which day.
CHANGES = T.StructType(
    [T.StructField("id", T.LongType()), T.StructField("changed_on", T.DateType())]
)


# Records that a load did not take, or took with a field left out.
REJECTS = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("arrival_seq", T.LongType()),
        T.StructField("target_table", T.StringType()),
        T.StructField("violation", T.StringType()),
        T.StructField("record", T.StringType()),
        T.StructField("run_date", T.DateType()),
    ]
)

# Each title's newest rows, the newest snapshot date they cover and how many
# rows per title they hold.
TAIL = T.StructType(
    [
        *SNAPSHOT_BASE.fields,
        T.StructField("ingestion_timestamp", T.TimestampType()),
        T.StructField("covers_date", T.DateType()),
        T.StructField("depth", T.IntegerType()),
    ]
)

# Each title's newest rows in one row (run store).
RECENT = T.StructType(
    [
        T.StructField("movie_id", T.LongType(), False),
        T.StructField(
            "recent",
            T.ArrayType(
                T.StructType(
                    [
                        *(T.StructField(f.name, f.dataType) for f in SNAPSHOT_BASE.fields[1:]),
                        T.StructField("ingestion_timestamp", T.TimestampType()),
                    ]
                )
            ),
        ),
    ]
)

# Stored tables by name.
TABLES = {
    "movies": MOVIES,
    "movie_daily_snapshots": SNAPSHOTS,
    "movie_metrics_aggregated": METRICS,
    "movie_snapshot_tail": TAIL,
    "movie_recent_snapshots": RECENT,
    "raw_latest_state": RAW_DETAILS,
    "rejected_records": REJECTS,
}


def column_names(schema: T.StructType) -> list[str]:
    return [f.name for f in schema.fields]
