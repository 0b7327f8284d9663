"""Raw-record ingest: keep-last dedupe, the two transforms, upserts, change windows.

The published loader works on Python lists of dicts and issues
``DELETE ... IN UNNEST(@ids)`` then an append. Here each step is set-wise:

* keep-last per id is an aggregation (``max_by`` over ``arrival_seq``) with
  partial aggregation, so an id that arrives a million times is combined
  map-side and never lands whole in one task;
* the record guards become a violations DataFrame plus a strict mode that
  fails the job from inside the plan (``raise_error``), instead of a driver
  loop over records;
* delete-then-append becomes anti-join + union, and id lists stay
  DataFrames (semi / anti joins), never a collected ``isin`` list.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulse import schemas
from pulse.operators.records import FILE_NAME, FILE_TIME, MALFORMED, NULL_FIELDS, RECORD, UNFIT_FIELDS

SNAPSHOT_KEY = ["movie_id", "snapshot_date"]


# --------------------------------------------------------------------------
# A1: raw source
# --------------------------------------------------------------------------


def read_raw_details(spark: SparkSession, path: str) -> DataFrame:
    """Newline-delimited JSON detail records, read with the declared schema (no inference)."""
    return spark.read.schema(schemas.RAW_DETAILS).option("mode", "PERMISSIVE").json(path)


def read_landed(spark: SparkSession, path: str) -> DataFrame:
    """Landed records with the time and name of their file, which order records that carry no
    ``arrival_seq``; a line that is not a JSON record comes with its text in ``_malformed``."""
    schema = T.StructType([*schemas.RAW_DETAILS.fields, T.StructField(MALFORMED, T.StringType())])
    raw = spark.read.schema(schema).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", MALFORMED).json(path)
    return raw.select("*", F.col("_metadata.file_modification_time").alias(FILE_TIME), F.col("_metadata.file_name").alias(FILE_NAME))


def land_raw_details(raw: DataFrame, path: str, partition_by: str | None = None) -> str:
    """Write raw records as newline-delimited JSON (how a fetch step hands them over)."""
    w = raw.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(partition_by)
    w.json(path)
    return path


# --------------------------------------------------------------------------
# A4: keep-last dedupe
# --------------------------------------------------------------------------


def dedupe_keep_last(raw: DataFrame, key: str = "id", order: str = "arrival_seq") -> DataFrame:
    """Last arrival per ``key``; records without the key are dropped.

    The order is total: ``order``, then the landed file's time and name where
    the records carry them (``read_landed``), then the record's hash. A record
    without ``order`` stands before those that have it; none is lost, and
    equal arrivals give the same record every time. ``max_by`` runs partially
    per input partition, so the exchange carries one row per key and partition
    however hot a key is (as a sort-based aggregate: each partition's rows are
    sorted by key first).
    """
    where_from = [c for c in (FILE_TIME, FILE_NAME) if c in raw.columns]
    cols = [c for c in raw.columns if c not in where_from and c != MALFORMED]
    first = [F.col(order)] if order in raw.columns else []
    last = F.struct(*first, *where_from, F.xxhash64(*cols).alias("_hash"))
    return (
        raw.where(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.max_by(F.struct(*cols), last).alias("_r"))
        .select("_r.*")
    )


def split_malformed(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(records, lines that are none); records without an id are among the latter."""
    bad = F.col("id").isNull()
    if MALFORMED in raw.columns:
        bad = bad | F.col(MALFORMED).isNotNull()
    return raw.where(~bad), raw.where(bad)


def rejected_records(details: DataFrame, malformed: DataFrame, run_date: _dt.date) -> DataFrame:
    """Rows of the reject table: violations of the deduplicated records, and lines that are
    no records or have no id, each with its text."""
    found = required_field_violations(details).withColumn("record", F.lit(None).cast("string"))
    text = F.to_json(F.struct(*[c for c in malformed.columns if c in schemas.column_names(schemas.RAW_DETAILS)]))
    if RECORD in malformed.columns:
        text = F.col(RECORD)
    why = F.lit("id is missing")
    if MALFORMED in malformed.columns:
        text = F.coalesce(F.col(MALFORMED), text)
        why = F.when(F.col(MALFORMED).isNotNull(), F.lit("not a record")).otherwise(why)
    lines = malformed.select("id", "arrival_seq", F.lit("raw").alias("target_table"), why.alias("violation"), text.alias("record"))
    return found.unionByName(lines).withColumn("run_date", F.lit(run_date))


# --------------------------------------------------------------------------
# A2 / A3 / G3: transforms and their guards
# --------------------------------------------------------------------------


def _falsy_id(c: Column) -> Column:
    return c.isNull() | (c == 0)


def _falsy_text(c: Column) -> Column:
    return c.isNull() | (c == "")


def _movie_checks() -> list[tuple[str, Column]]:
    return [
        ("id is missing", _falsy_id(F.col("id"))),
        ("title is missing", _falsy_text(F.col("title"))),
    ]


def _snapshot_checks() -> list[tuple[str, Column]]:
    return [
        ("id is missing", _falsy_id(F.col("id"))),
        ("popularity is missing", F.col("popularity").isNull()),
        ("vote_count is missing", F.col("vote_count").isNull()),
        ("vote_average is missing", F.col("vote_average").isNull()),
    ]


def _apply_guards(raw: DataFrame, checks, mode: str, target: str) -> DataFrame:
    bad = F.lit(False)
    for _, cond in checks:
        bad = bad | cond
    if mode == "drop":
        return raw.where(~bad)
    if mode == "strict":
        msg = F.concat(
            F.lit(f"record violates the {target} contract: id="),
            F.coalesce(F.col("id").cast("string"), F.lit("NULL")),
        )
        # Evaluated inside the plan: the first bad record fails the job.
        return raw.where(F.when(bad, F.raise_error(msg).cast("boolean")).otherwise(F.lit(True)))
    raise ValueError(f"unknown mode {mode!r}")


def _ts_literal(ts: _dt.datetime | None) -> Column:
    if ts is None:
        return F.date_trunc("second", F.current_timestamp())
    return F.date_trunc("second", F.lit(ts.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp"))


def transform_movies(
    raw: DataFrame, loaded_at: _dt.datetime | None = None, mode: str = "drop", added: Sequence[str] = ()
) -> DataFrame:
    """Raw records -> movies rows, with the columns ``added`` after the declared ones.

    Missing ``adult`` / ``video`` default to false and missing arrays to [].
    An explicit ``null`` stays NULL where the records tell it from a missing
    key (``records.typed``); a schema-based JSON read cannot, so there both
    get the default. ``release_date`` strings that are not dates
    become NULL; ``required_field_violations`` reports them.
    ``mode='drop'`` leaves out records that fail the id / title guard;
    ``mode='strict'`` fails the job on the first one.
    """
    r = _apply_guards(raw, _movie_checks(), mode, "movies")

    def default(name: str, value: Column) -> Column:
        filled = F.coalesce(F.col(name), value)
        return F.when(~F.array_contains(NULL_FIELDS, name), filled) if NULL_FIELDS in r.columns else filled

    cols = {
        "movie_id": F.col("id"),
        "release_date": F.try_to_date(F.col("release_date")),
        "adult": default("adult", F.lit(False)),
        "video": default("video", F.lit(False)),
        "last_updated": _ts_literal(loaded_at),
    }
    for name, dtype in schemas.ARRAY_COLUMNS.items():
        cols[name] = default(name, F.array().cast(dtype))
    out = []
    for f in schemas.MOVIES.fields:
        c = cols.get(f.name, F.col(f.name) if f.name in r.columns else F.lit(None))
        out.append(c.cast(f.dataType).alias(f.name))
    return r.select(*out, *added)


def transform_snapshots(
    raw: DataFrame,
    snapshot_date: _dt.date,
    ingested_at: _dt.datetime | None = None,
    mode: str = "drop",
    added: Sequence[str] = (),
) -> DataFrame:
    """Raw records -> base snapshot rows for ``snapshot_date`` (an explicit job parameter), with
    the columns ``added`` after the declared ones."""
    r = _apply_guards(raw, _snapshot_checks(), mode, "snapshots")
    return r.select(
        F.col("id").cast("long").alias("movie_id"),
        F.lit(snapshot_date).alias("snapshot_date"),
        F.col("popularity").cast("double").alias("popularity"),
        F.col("vote_count").cast("long").alias("vote_count"),
        F.col("vote_average").cast("double").alias("vote_average"),
        _ts_literal(ingested_at).alias("ingestion_timestamp"),
        *added,
    )


def required_field_violations(raw: DataFrame) -> DataFrame:
    """Every (record, target table, check) that a transform would reject.

    Applied to the deduplicated records, as the loaders are. Also lists
    ``release_date`` strings that are present but not a date, and fields whose
    value does not fit their type (``records.typed``): both load as NULL.
    """
    checks = [("movies", n, c) for n, c in _movie_checks()]
    checks += [("movie_daily_snapshots", n, c) for n, c in _snapshot_checks()]
    rd = F.col("release_date")
    checks.append(
        ("movies", "release_date is not a date", rd.isNotNull() & F.try_to_date(rd).isNull())
    )
    found = F.array_compact(
        F.array(
            *[
                F.when(c, F.struct(F.lit(t).alias("target_table"), F.lit(n).alias("violation")))
                for t, n, c in checks
            ]
        )
    )
    if UNFIT_FIELDS in raw.columns:
        own = F.array(*map(F.lit, ("popularity", "vote_count", "vote_average")))
        target = lambda c: F.when(F.array_contains(own, c), "movie_daily_snapshots").otherwise("movies")
        unfit = F.transform(UNFIT_FIELDS, lambda c: F.struct(target(c).alias("target_table"), F.concat(c, F.lit(" is not of its type")).alias("violation")))
        found = F.concat(found, unfit)
    return raw.select("id", "arrival_seq", F.explode(found).alias("_v")).select(
        "id", "arrival_seq", "_v.target_table", "_v.violation"
    )


# --------------------------------------------------------------------------
# A5 / A6 / A7 / A12: upserts
# --------------------------------------------------------------------------


def upsert_movies(existing: DataFrame, incoming: DataFrame) -> DataFrame:
    """Dimension upsert: incoming rows replace existing rows with the same ``movie_id``.

    Columns that only one side has are kept, NULL in the other's rows (additive
    schema evolution).
    """
    keep = existing.join(incoming.select("movie_id"), "movie_id", "left_anti")
    return keep.unionByName(incoming, allowMissingColumns=True)


def upsert_snapshots_partition(
    existing: DataFrame, incoming: DataFrame, snapshot_date: _dt.date
) -> DataFrame:
    """The rows of the ``snapshot_date`` partition after the upsert.

    Only that date is read (a partition filter on a date-partitioned table)
    and rewritten; written with dynamic partition overwrite it replaces the
    one partition and leaves every other date untouched.
    """
    d = F.lit(snapshot_date)
    incoming = incoming.where(F.col("snapshot_date") == d)
    day = existing.where(F.col("snapshot_date") == d)
    keys = incoming.select(*SNAPSHOT_KEY)
    keep = day.join(keys, SNAPSHOT_KEY, "left_anti")
    return keep.unionByName(incoming, allowMissingColumns=True)


def upsert_snapshots(existing: DataFrame, incoming: DataFrame, snapshot_date: _dt.date) -> DataFrame:
    """The whole snapshot table after an idempotent upsert of one date's rows."""
    d = F.lit(snapshot_date)
    others = existing.where(F.col("snapshot_date") != d)
    touched = upsert_snapshots_partition(existing, incoming, snapshot_date)
    return others.unionByName(touched, allowMissingColumns=True)


def evolve_union(existing: DataFrame, incoming: DataFrame) -> DataFrame:
    """Additive schema evolution: new columns are added, old rows read them as NULL."""
    return existing.unionByName(incoming, allowMissingColumns=True)


def upsert_counts(
    existing: DataFrame, incoming: DataFrame, key: list[str], table: str
) -> DataFrame:
    """Affected-row counts of an upsert as one row: replaced, inserted, net new, total after.

    Each side is read once: rows of both are counted per key, and the keys'
    counts summed. Rows with a null in the key match nothing.
    """
    one, none = F.lit(1).cast("long"), F.lit(0).cast("long")
    old = existing.select(*key, one.alias("_old"), none.alias("_new"))
    both = old.unionByName(incoming.select(*key, none.alias("_old"), one.alias("_new")))
    per_key = both.groupBy(*key).agg(F.sum("_old").alias("_old"), F.sum("_new").alias("_new"))
    whole = F.lit(True)
    for c in key:
        whole = whole & F.col(c).isNotNull()
    total = lambda c: F.coalesce(F.sum(c), none)
    r = per_key.agg(
        total(F.when(whole & (F.col("_new") > 0), F.col("_old"))).alias("replaced_rows"),
        total("_new").alias("loaded_rows"),
        total("_old").alias("existing_rows"),
    )
    return r.select(
        F.lit(table).alias("table_name"),
        F.col("replaced_rows").cast("long").alias("replaced_rows"),
        F.col("loaded_rows").cast("long").alias("loaded_rows"),
        (F.col("loaded_rows") - F.col("replaced_rows")).cast("long").alias("net_new_rows"),
        (F.col("existing_rows") - F.col("replaced_rows") + F.col("loaded_rows"))
        .cast("long")
        .alias("total_rows"),
    )


# --------------------------------------------------------------------------
# A8 / A9 / A10 / A11: selections
# --------------------------------------------------------------------------


def top_n_popular(catalog: DataFrame, n: int = 1000) -> DataFrame:
    """The ``n`` most popular titles, adult and video titles excluded.

    ``catalog`` has ``movie_id``, ``popularity``, ``adult``, ``video``.
    ``orderBy().limit()`` is a per-partition top-n then an n-row merge.
    """
    c = catalog.where(~F.coalesce(F.col("adult"), F.lit(False)) & ~F.coalesce(F.col("video"), F.lit(False)))
    return c.orderBy(F.col("popularity").desc(), F.col("movie_id")).limit(n)


def changed_ids(changes: DataFrame, start: _dt.date, end: _dt.date) -> DataFrame:
    """Distinct ids changed in [start, end] (both days included)."""
    return (
        changes.where(F.col("changed_on").between(F.lit(start), F.lit(end)))
        .select(F.col("id"))
        .distinct()
    )


def changed_entities(
    details: DataFrame, changes: DataFrame, start: _dt.date, end: _dt.date, key: str = "id"
) -> DataFrame:
    """Detail records restricted to the ids changed in the window (a semi join)."""
    ids = changed_ids(changes, start, end).withColumnRenamed("id", key)
    return details.join(ids, key, "left_semi")


def tracked_ids(movies: DataFrame) -> DataFrame:
    return movies.select("movie_id").distinct().orderBy("movie_id")


def refresh_tracked_snapshots(
    raw: DataFrame,
    movies: DataFrame,
    existing_snapshots: DataFrame,
    snapshot_date: _dt.date,
    ingested_at: _dt.datetime | None = None,
) -> DataFrame:
    """Weekly refresh: fresh snapshots for every tracked id; the dimension is not touched."""
    tracked = movies.select(F.col("movie_id").alias("id"))
    details = dedupe_keep_last(raw).join(tracked, "id", "left_semi")
    fresh = transform_snapshots(details, snapshot_date, ingested_at)
    return upsert_snapshots(existing_snapshots, fresh, snapshot_date)
