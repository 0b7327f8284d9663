"""Adapters from the supplied test tables to the three table schemas.

Main adapter: ``part`` -> movies, ``lineitem`` -> daily snapshots.
Secondary adapter: ``events`` -> raw detail records, a change feed and a
second, denser snapshot set; ``customer`` -> an existing movies dimension.

Each snapshot adapter is a grouped aggregation by (title, date) followed, for
the running total, by one window per title. The rows are dealt by (title, date)
before they are grouped, into as many partitions as the source's bytes ask for
(``pieces``): almost every row is a group of its own, and a partial aggregation
of a whole input split would hold (and spill) nearly all its rows. Rows of one
(title, date) stream through one task in constant memory. A title has at most
one row per date after that, so every per-title window group is bounded by the
number of distinct dates, however large the input grows.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulse import schemas
from pulse.config import EVENTS_AS_OF, FIXTURE_AS_OF

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()

# Load timestamps stamped on adapter-built dimensions (constant so that runs
# are reproducible; real jobs stamp the load time).
FIXTURE_LOADED_AT = _dt.datetime(2001, 11, 4, 12, 0, 0)
CUSTOMER_LOADED_AT = _dt.datetime(2023, 12, 31, 0, 0, 0)


#: Source bytes that one partition of titles stands for (a partition's rows are
#: grouped and sorted in one task; a bucket of the stored tables is one scan
#: task and cannot be split), and the most buckets that a table can have.
PIECE_BYTES = 8 << 20
MOST_PIECES = 100_000


def source_files(spark: SparkSession, sf_dir: str, names: Sequence[str]) -> list[tuple[str, int, int]]:
    """(path, length, modification time) of every file of the named tables, folders included."""
    jvm = spark.sparkContext._jvm
    out = []
    for name in names:
        p = jvm.org.apache.hadoop.fs.Path(f"{sf_dir.rstrip('/')}/{name}.parquet")
        files = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listFiles(p, True)
        while files.hasNext():
            st = files.next()
            out.append((st.getPath().toString(), st.getLen(), st.getModificationTime()))
    return sorted(out)


def pieces(spark: SparkSession, sf_dir: str, names: Sequence[str]) -> int:
    """Partitions of titles by the bytes of the named tables, at least one for each task slot."""
    size = sum(length for _, length, _ in source_files(spark, sf_dir, names))
    return min(MOST_PIECES, max(spark.sparkContext.defaultParallelism, -(-size // PIECE_BYTES)))


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _ts(value: _dt.datetime) -> Column:
    return F.lit(value.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp")


def _null(dtype: T.DataType) -> Column:
    return F.lit(None).cast(dtype)


def _empty(name: str) -> Column:
    return F.array().cast(schemas.ARRAY_COLUMNS[name])


def _project_movies(df: DataFrame, cols: dict[str, Column]) -> DataFrame:
    """Project ``cols`` onto the movies schema; missing columns become typed NULL / []."""
    out = []
    for f in schemas.MOVIES.fields:
        if f.name in cols:
            out.append(cols[f.name].cast(f.dataType).alias(f.name))
        elif f.name in schemas.ARRAY_COLUMNS:
            out.append(_empty(f.name).alias(f.name))
        else:
            out.append(_null(f.dataType).alias(f.name))
    return df.select(*out)


def movies_from_part(part: DataFrame, as_of: _dt.date = FIXTURE_AS_OF) -> DataFrame:
    key = F.col("p_partkey")
    genres = F.when(key % 11 == 0, _empty("genres")).otherwise(
        F.array(
            F.struct(F.lit(1).cast("long").alias("id"), F.col("p_type").alias("name")),
            F.struct(F.lit(2).cast("long").alias("id"), F.col("p_brand").alias("name")),
        )
    )
    return _project_movies(
        part,
        {
            "movie_id": key,
            "title": F.col("p_name"),
            "overview": F.concat(F.col("p_name"), F.lit(" by "), F.col("p_brand")),
            "release_date": F.date_sub(F.lit(as_of), ((key * 37) % 400).cast("int")),
            "budget": F.when(F.col("p_size") % 5 == 0, F.lit(0)).otherwise(
                F.col("p_size").cast("long") * 1000000
            ),
            "revenue": (key % 7) * 1000000,
            "adult": F.lit(False),
            "video": F.lit(False),
            "genres": genres,
            "last_updated": _ts(FIXTURE_LOADED_AT),
        },
    )


def snapshots_from_lineitem(lineitem: DataFrame, parts: int | None = None) -> DataFrame:
    """One snapshot per (part, ship day); ``vote_count`` is a running total."""
    rows = lineitem.select(
        F.col("l_partkey").cast("long").alias("movie_id"),
        F.to_date("l_shipdate").alias("snapshot_date"),
        "l_extendedprice",
        "l_quantity",
        "l_shipdate",
    )
    daily = _by_day(rows, parts).agg(
        (
            F.floor(F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).cast("double") / 10)
            / 100
        ).alias("popularity"),
        (F.sum("l_quantity") * 3).alias("votes_today"),
        (F.avg("l_quantity") / 5).alias("vote_average"),
        F.max("l_shipdate").cast("timestamp").alias("ingestion_timestamp"),
    )
    return _with_running_votes(daily, parts)


def snapshots_from_events(events: DataFrame, parts: int | None = None) -> DataFrame:
    """One snapshot per (user, event day) of the events stream."""
    rows = events.select(
        F.col("user_id").cast("long").alias("movie_id"),
        F.to_date("ts").alias("snapshot_date"),
        "value",
        "ts",
    )
    daily = _by_day(rows, parts).agg(
        F.sum(F.col("value").cast("decimal(18,2)")).cast("double").alias("popularity"),
        (F.count(F.lit(1)) * 20).alias("votes_today"),
        F.count(F.lit(1)).alias("n"),
        F.max("ts").cast("timestamp").alias("ingestion_timestamp"),
    )
    daily = daily.withColumn(
        "vote_average", F.round(F.col("popularity") / F.col("n") / 60, 6)
    ).drop("n")
    return _with_running_votes(daily, parts)


def _by_day(rows: DataFrame, parts: int | None):
    """``rows`` grouped by (title, date), dealt by both into ``parts`` partitions."""
    if parts:
        rows = rows.repartition(parts, "movie_id", "snapshot_date")
    return rows.groupBy("movie_id", "snapshot_date")


def _with_running_votes(daily: DataFrame, parts: int | None) -> DataFrame:
    # Dealt by title once: the running total, all later per-title windows and a
    # write into as many buckets need no other exchange (movie_id is passed on
    # as it is; a new column of the same values would hide that).
    if parts:
        daily = daily.repartition(parts, "movie_id")
    w = (
        Window.partitionBy("movie_id")
        .orderBy("snapshot_date")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return daily.select(
        "movie_id",
        "snapshot_date",
        F.col("popularity").cast("double").alias("popularity"),
        F.sum("votes_today").over(w).cast("long").alias("vote_count"),
        F.col("vote_average").cast("double").alias("vote_average"),
        "ingestion_timestamp",
    )


def movies_from_customer(customer: DataFrame) -> DataFrame:
    """An existing dimension keyed like the events ids (every user is a customer)."""
    return _project_movies(
        customer,
        {
            "movie_id": F.col("c_custkey"),
            "title": F.col("c_name"),
            "overview": F.col("c_mktsegment"),
            "budget": F.floor(F.col("c_acctbal")).cast("long"),
            "adult": F.lit(False),
            "video": F.lit(False),
            "last_updated": _ts(CUSTOMER_LOADED_AT),
        },
    )


def raw_details_from_events(events: DataFrame) -> DataFrame:
    """Raw detail records, one per event: ``id = user_id``, ``arrival_seq = event_id``.

    Array fields other than ``genres`` are left missing (NULL) so that the
    transform's defaults are exercised.
    """
    et = F.col("event_type")
    cols = {
        "id": F.col("user_id"),
        "arrival_seq": F.col("event_id"),
        "title": F.concat(F.lit("Title "), F.col("user_id").cast("string")),
        "original_title": F.col("props"),
        "original_language": F.lit("en"),
        "overview": F.concat(et, F.lit(" "), F.col("props")),
        "release_date": F.date_format(F.col("ts"), "yyyy-MM-dd"),
        "runtime": (F.col("event_id") % 180).cast("long"),
        "budget": F.floor(F.col("value") * 1000).cast("long"),
        "revenue": F.floor(F.col("value") * 3000).cast("long"),
        "status": F.lit("Released"),
        "adult": et == "error",
        "video": et == "signup",
        "genres": F.array(F.struct(F.lit(1).cast("long").alias("id"), et.alias("name"))),
        "popularity": F.col("value"),
        "vote_count": F.floor(F.col("value") * 10).cast("long"),
        "vote_average": F.col("value") / 60,
    }
    out = []
    for f in schemas.RAW_DETAILS.fields:
        c = cols.get(f.name)
        out.append((c if c is not None else _null(f.dataType)).cast(f.dataType).alias(f.name))
    return events.select(*out)


def changes_from_events(events: DataFrame) -> DataFrame:
    return events.select(
        F.col("user_id").cast("long").alias("id"),
        F.to_date("ts").alias("changed_on"),
    )


class Fixture:
    """Lazily built tables of one scale-factor folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self.as_of = FIXTURE_AS_OF
        self.events_as_of = EVENTS_AS_OF

    def table(self, name: str) -> DataFrame:
        return read_table(self.spark, self.sf_dir, name)

    def title_pieces(self) -> int:
        """Partitions of the titles of ``movies`` and their snapshots."""
        return pieces(self.spark, self.sf_dir, ("part", "lineitem"))

    def event_pieces(self) -> int:
        """Partitions of the titles of ``customer_movies`` and their snapshots."""
        return pieces(self.spark, self.sf_dir, ("customer", "events"))

    def movies(self) -> DataFrame:
        return movies_from_part(self.table("part"), self.as_of)

    def base_snapshots(self) -> DataFrame:
        return snapshots_from_lineitem(self.table("lineitem"), self.title_pieces())

    def events_snapshots(self) -> DataFrame:
        return snapshots_from_events(self.table("events"), self.event_pieces())

    def raw_details(self) -> DataFrame:
        return raw_details_from_events(self.table("events"))

    def changes(self) -> DataFrame:
        return changes_from_events(self.table("events"))

    def customer_movies(self) -> DataFrame:
        return movies_from_customer(self.table("customer"))
