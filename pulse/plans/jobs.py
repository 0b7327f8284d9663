"""Batch jobs: bootstrap, daily and weekly loads, and the metric refresh.

Each job is a handful of Spark jobs over DataFrames; nothing but row counts
comes back to the driver. Tables live in a ``Warehouse``:

* ``movies``                -- replaced as a new version on every upsert
                               (left unpartitioned: an upsert touches any title)
* ``movie_daily_snapshots`` -- partitioned by ``snapshot_date``, sorted by ``movie_id``
* ``movie_metrics_aggregated`` -- partitioned by ``calculation_date``
* ``movie_snapshot_tail``   -- each title's newest rows (the longest look-back), with the
                               date they cover
* ``rejected_records``      -- what a run did not take, partitioned by ``run_date``

The jobs run on a ``Warehouse`` or on a ``RunStore``, where all of a job's
writes become visible at one point and each upsert rewrites only the months
and buckets that it touches (``_merge_snapshots``).

Metric refresh after loading date D: the titles with a snapshot on or after
D are the only ones whose derived or aggregated values can change (all
frames look backward), and the partitions from D on contain exactly those
titles, so those partitions are recomputed from those titles' histories and
overwritten whole. A normal daily run touches one partition and reads only
the tail table (O(#titles), independent of how long the history is); a late
snapshot rewrites the partitions from its date on from full histories and
rebuilds the tail. Re-running a date replaces its metric partition instead of
appending duplicates.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulse import schemas
from pulse.config import DEFAULT_THRESHOLDS, Thresholds
from pulse.operators import ingest, records
from pulse.operators.metrics import BASE_COLUMNS, aggregated_metrics, derived_metrics
from pulse.plans.runs import RunStore, iso
from pulse.plans.warehouse import Warehouse

MOVIES = "movies"
SNAPSHOTS = "movie_daily_snapshots"
METRICS = "movie_metrics_aggregated"
TAIL = "movie_snapshot_tail"
REJECTS = "rejected_records"
RECENT = "movie_recent_snapshots"


@dataclass
class JobReport:
    counts: dict[str, int] = field(default_factory=dict)


def _observed_write(df: DataFrame, name: str, write) -> int:
    """Run ``write(df, counter)`` and return the rows it wrote, counted during the write."""
    obs = Observation(name)
    write(df, obs)
    return int(obs.get.get("rows", 0))


def _details(wh: Warehouse, raw: DataFrame, run_date: _dt.date, rep: JobReport) -> DataFrame:
    """The deduplicated records of a run, staged once; what the loads will not take goes to the
    reject table (one partition per run date) and is counted in the report.

    Jobs quarantine: a bad record does not stop the good ones, and none is
    dropped without a row in the reject table. Records that come as text
    (``records.read_records``) are typed after the dedupe; fields that nobody
    declared become columns.
    """
    good, malformed = ingest.split_malformed(raw)
    details = wh.stage(ingest.dedupe_keep_last(good), "details")
    if records.RECORD in raw.columns:
        details = typed_details(wh, details)
    rejects = ingest.rejected_records(details, malformed, run_date)
    staged = wh.stage(rejects, "rejects")
    wh.overwrite_partitions(REJECTS, staged, ["run_date"], reads_target=False)
    counts = staged.where("violation NOT LIKE '% is not a date' AND violation NOT LIKE '% is not of its type'").groupBy("target_table").agg(F.count_distinct(F.coalesce("id", F.xxhash64("record"))).alias("n"))
    for r in counts.collect():  # one row per target table
        rep.counts[f"rejected_{r['target_table']}"] = r["n"]
    return details


def typed_details(wh: Warehouse, kept: DataFrame) -> DataFrame:
    """The kept records' columns, staged; a field that the tables have as an added column keeps its type."""
    stored = [f for name in (MOVIES, SNAPSHOTS) if wh.exists(name) for f in wh.read(name).schema.fields]
    added = records.added_fields(kept, T.StructType(stored))
    return wh.stage(records.typed(kept, added), "typed-details")


def load_movies(wh: Warehouse, incoming: DataFrame) -> int:
    """Upsert the dimension; the number of rows written."""
    if isinstance(wh, RunStore):
        return sum(wh.merge(MOVIES, incoming).values())
    existing = wh.read(MOVIES, schemas.MOVIES)
    merged = ingest.upsert_movies(existing, incoming)
    n = _observed_write(merged, "movies_rows", lambda d, c: wh.replace(MOVIES, d, counter=c))
    wh.vacuum(MOVIES)
    return n


def _added_columns(rows: DataFrame) -> list[str]:
    """Columns that the declared snapshot schema does not have (additive schema evolution)."""
    declared = set(schemas.column_names(schemas.SNAPSHOTS))
    return [c for c in rows.columns if c not in declared]


def _with_added(derived: DataFrame, rows: DataFrame) -> DataFrame:
    """Derived rows with the added columns of the rows that they come from."""
    added = _added_columns(rows)
    out = derived.select(*schemas.column_names(schemas.SNAPSHOTS))
    return out.join(rows.select(*ingest.SNAPSHOT_KEY, *added), ingest.SNAPSHOT_KEY, "left") if added else out


def load_snapshots(wh: Warehouse, incoming: DataFrame, snapshot_date: _dt.date) -> int:
    existing = wh.read(SNAPSHOTS, schemas.SNAPSHOTS)
    part = ingest.upsert_snapshots_partition(existing, incoming, snapshot_date)
    part = part.select(*schemas.column_names(schemas.SNAPSHOTS), *_added_columns(part))
    return _observed_write(
        part,
        "snapshot_rows",
        lambda d, c: wh.overwrite_partitions(SNAPSHOTS, d, ["snapshot_date"], ["movie_id"], counter=c),
    )


def tail_depth(th: Thresholds) -> int:
    """Rows per title that a metric of the newest row can look at, that row included."""
    return max(th.short_lag, th.long_lag, th.baseline_lag, th.ma_rows - 1) + 1


def build_tail(snapshots: DataFrame, th: Thresholds = DEFAULT_THRESHOLDS) -> DataFrame:
    """Each title's newest ``tail_depth`` snapshot rows (base columns).

    The table is bounded by the number of titles, whatever the history
    length. ``row_number() <= k`` is planned as a partial ``WindowGroupLimit``.
    """
    w = Window.partitionBy("movie_id").orderBy(F.col("snapshot_date").desc())
    return (
        snapshots.select(*BASE_COLUMNS)
        .withColumn("_rn", F.row_number().over(w))
        .where(F.col("_rn") <= tail_depth(th))
        .drop("_rn")
    )


def _write_tail(wh: Warehouse, rows: DataFrame, covers: _dt.date | None, th: Thresholds) -> None:
    """Replace the tail; its rows say up to which snapshot date they are complete, and how deep."""
    marked = rows.withColumn("covers_date", F.lit(covers).cast("date")).withColumn("depth", F.lit(tail_depth(th)))
    wh.replace(TAIL, marked)
    wh.vacuum(TAIL)


def _stored_dates(wh: Warehouse) -> list[_dt.date]:
    """Snapshot dates that have a partition (a directory listing, no scan)."""
    return [_dt.date.fromisoformat(d) for d in wh.partition_values(SNAPSHOTS, "snapshot_date")]


def _write_metric_and_derived(wh: Warehouse, metric_rows, derived_rows, before_derived=None):
    # Metrics first: both read snapshot partitions that the derived write replaces.
    n_metrics = _observed_write(
        metric_rows,
        "metric_rows",
        lambda x, c: wh.overwrite_partitions(
            METRICS, x, ["calculation_date"], ["movie_id"], reads_target=False, counter=c
        ),
    )
    if before_derived is not None:
        before_derived()
    n_derived = _observed_write(
        derived_rows,
        "derived_rows",
        lambda x, c: wh.overwrite_partitions(SNAPSHOTS, x, ["snapshot_date"], ["movie_id"], counter=c),
    )
    return {"metric_rows": n_metrics, "derived_rows": n_derived}


def _refresh_full(wh: Warehouse, from_date: _dt.date, th: Thresholds) -> dict[str, int]:
    """Every partition from ``from_date`` on, from the full history of the titles in them."""
    base = wh.read(SNAPSHOTS, schemas.SNAPSHOTS)
    d = F.lit(from_date)
    active = base.where(F.col("snapshot_date") >= d).select("movie_id").distinct()
    history = base.join(active, "movie_id", "left_semi")
    metric_rows = aggregated_metrics(history, None, th).where(F.col("calculation_date") >= d)
    derived_rows = derived_metrics(history, th).where(F.col("snapshot_date") >= d)
    derived_rows = _with_added(derived_rows, base.where(F.col("snapshot_date") >= d))
    marks = _tail_marks(wh)
    old_tail = wh.read(TAIL).select(*BASE_COLUMNS) if marks and marks[1] >= tail_depth(th) else None
    counts = _write_metric_and_derived(wh, metric_rows, derived_rows)
    newest = max(_stored_dates(wh), default=None)
    if old_tail is None:
        _write_tail(wh, build_tail(wh.read(SNAPSHOTS), th), newest, th)
    else:
        # Each title's newest rows lie in its old tail rows before the date
        # or in the partitions from the date on (a partition-pruned read).
        recent = wh.read(SNAPSHOTS).where(F.col("snapshot_date") >= d).select(*BASE_COLUMNS)
        _write_tail(wh, build_tail(old_tail.where(F.col("snapshot_date") < d).unionByName(recent), th), newest, th)
    return counts


def _refresh_from_tail(
    wh: Warehouse, run_date: _dt.date, tail: DataFrame, th: Thresholds
) -> dict[str, int]:
    """The newest partition only, from the tail table: O(#titles), not O(history)."""
    d = F.lit(run_date)
    stored = wh.read(SNAPSHOTS, schemas.SNAPSHOTS).where(F.col("snapshot_date") == d)
    day = stored.select(*BASE_COLUMNS)
    before = tail.where(F.col("snapshot_date") < d)
    history = before.join(day.select("movie_id"), "movie_id", "left_semi").unionByName(day)
    metric_rows = aggregated_metrics(history, None, th).where(F.col("calculation_date") == d)
    derived_rows = _with_added(derived_metrics(history, th).where(F.col("snapshot_date") == d), stored)
    new_tail = build_tail(before.unionByName(day), th)
    return _write_metric_and_derived(
        wh, metric_rows, derived_rows, before_derived=lambda: _write_tail(wh, new_tail, run_date, th)
    )


def refresh_metrics(wh: Warehouse, from_date: _dt.date, th: Thresholds = DEFAULT_THRESHOLDS) -> dict[str, int]:
    """Recompute derived and aggregated metrics for every partition from ``from_date`` on.

    When ``from_date`` is the newest snapshot date (the daily case) the tail
    table supplies the look-back rows; a late date falls back to the titles'
    full histories and rebuilds the tail.
    """
    tail = _usable_tail(wh, from_date, th)
    if tail is not None:
        return _refresh_from_tail(wh, from_date, tail, th)
    return _refresh_full(wh, _first_stale(wh, from_date), th)


def _tail_marks(wh: Warehouse) -> tuple[_dt.date, int] | None:
    """(date up to which the tail is complete, its depth), from any of its rows."""
    row = wh.read(TAIL).select("covers_date", "depth").first() if wh.exists(TAIL) else None
    return (row[0], row[1]) if row and row[0] and row[1] else None


def _usable_tail(wh: Warehouse, run_date: _dt.date, th: Thresholds) -> DataFrame | None:
    """The tail's rows, if they are deep enough and complete up to the newest stored date
    before ``run_date``, and no later date is stored."""
    marks = _tail_marks(wh)
    if marks is None or marks[1] < tail_depth(th):
        return None
    dates = _stored_dates(wh)
    before = [d for d in dates if d < run_date]
    if any(d > run_date for d in dates) or (before and marks[0] < max(before)):
        return None
    return wh.read(TAIL).select(*BASE_COLUMNS)


def _first_stale(wh: Warehouse, run_date: _dt.date) -> _dt.date:
    """The first date whose metrics may be missing or old: a load that died before its refresh
    leaves stored dates that the tail does not cover."""
    marks = _tail_marks(wh)
    late = [d for d in _stored_dates(wh) if marks is None or d > marks[0]]
    return min([run_date, *late])


def load_and_refresh(
    wh: Warehouse, incoming: DataFrame, run_date: _dt.date, th: Thresholds = DEFAULT_THRESHOLDS
) -> dict[str, int]:
    """Upsert one date's snapshots and refresh the metrics, in as few writes as possible.

    On a ``RunStore``, see ``_merge_snapshots``. Otherwise, on the newest date the upserted rows of that date and the tail are all
    the metrics need: the day's rows with their derived columns are computed
    and staged once, the date partition is overwritten from the stage, and
    the metric partition and the new tail are computed from the stage and the
    old tail. A late date upserts its partition and takes the full refresh.
    """
    if isinstance(wh, RunStore):
        return _merge_snapshots(wh, incoming, run_date, th)
    tail = _usable_tail(wh, run_date, th)
    if tail is None:
        stale = _first_stale(wh, run_date)
        counts = {"snapshots": load_snapshots(wh, incoming, run_date)}
        counts.update(_refresh_full(wh, stale, th))
        return counts
    d = F.lit(run_date)
    existing = wh.read(SNAPSHOTS, schemas.SNAPSHOTS)
    upserted = ingest.upsert_snapshots_partition(existing, incoming, run_date)
    day = upserted.select(*BASE_COLUMNS)
    before = tail.where(F.col("snapshot_date") < d)
    history = before.join(day.select("movie_id"), "movie_id", "left_semi").unionByName(day)
    derived_rows = derived_metrics(history, th).where(F.col("snapshot_date") == d)
    # The day's rows read the partition they replace: stage them first.
    stage = wh.stage(_with_added(derived_rows, upserted), "day")
    n_snap = _observed_write(
        stage,
        "snapshot_rows",
        lambda x, c: wh.overwrite_partitions(
            SNAPSHOTS, x, ["snapshot_date"], ["movie_id"], reads_target=False, counter=c
        ),
    )
    staged_day = stage.select(*BASE_COLUMNS)
    staged_history = before.join(staged_day.select("movie_id"), "movie_id", "left_semi").unionByName(
        staged_day
    )
    metric_rows = aggregated_metrics(staged_history, None, th).where(F.col("calculation_date") == d)
    n_metrics = _observed_write(
        metric_rows,
        "metric_rows",
        lambda x, c: wh.overwrite_partitions(
            METRICS, x, ["calculation_date"], ["movie_id"], reads_target=False, counter=c
        ),
    )
    _write_tail(wh, build_tail(before.unionByName(staged_day), th), run_date, th)
    return {"snapshots": n_snap, "metric_rows": n_metrics, "derived_rows": n_snap}


def _rows_around(store: RunStore, incoming: DataFrame, run_date: _dt.date, th: Thresholds) -> DataFrame:
    """The incoming rows and the stored rows of the same titles that lie at most the longest
    look-back before or after them.

    On the newest date they come from the titles' newest rows; a late date
    reads the titles' histories.
    """
    d, most = F.lit(run_date), tail_depth(th) - 1
    newest = iso(store.fact("newest"))
    ids = incoming.select("movie_id")
    if newest is None or (run_date >= newest and (store.fact("depth") or 0) > most):
        stored = _recent_rows(store)
    else:
        stored = store.read(SNAPSHOTS).select(*BASE_COLUMNS)
    stored = stored.join(ids, "movie_id", "left_semi").where(F.col("snapshot_date") != d)
    side = F.col("snapshot_date") > d
    away = F.abs(F.date_diff("snapshot_date", d))
    near = F.row_number().over(Window.partitionBy("movie_id", side).orderBy(away))
    near_rows = stored.withColumn("_near", near).where(F.col("_near") <= most)
    return near_rows.select(*BASE_COLUMNS).unionByName(incoming.select(*BASE_COLUMNS))


def _recent_rows(store: RunStore) -> DataFrame:
    return store.read(RECENT).select("movie_id", F.explode("recent").alias("_r")).select("movie_id", "_r.*").select(*BASE_COLUMNS)


def recent_of(rows: DataFrame, th: Thresholds = DEFAULT_THRESHOLDS) -> DataFrame:
    """Each title's newest rows, newest first, as one row."""
    parts = F.struct(*(c for c in BASE_COLUMNS if c != "movie_id"))
    return build_tail(rows, th).groupBy("movie_id").agg(F.sort_array(F.collect_list(parts), asc=False).alias("recent"))


def _recent_after(store: RunStore, incoming: DataFrame, th: Thresholds) -> DataFrame:
    """The newest rows of the incoming titles (of all titles, if the stored ones are not deep enough)."""
    if store.fact("newest") is not None and (store.fact("depth") or 0) < tail_depth(th):
        old = store.read(SNAPSHOTS).select(*BASE_COLUMNS)
    else:
        old = _recent_rows(store).join(incoming.select("movie_id"), "movie_id", "left_semi")
    keep = old.join(incoming.select(*ingest.SNAPSHOT_KEY), ingest.SNAPSHOT_KEY, "left_anti")
    return recent_of(keep.unionByName(incoming.select(*BASE_COLUMNS)), th)


def _merge_snapshots(store: RunStore, incoming: DataFrame, run_date: _dt.date, th: Thresholds) -> dict[str, int]:
    """Upsert one date's snapshots and all that follows from them.

    A row reaches its title's next rows, as many as the longest look-back (14
    by default), and no others: exactly these (title, date) keys get new
    derived columns and metrics, and only their months are rewritten, however
    late the date is. Then the titles' newest rows follow.
    """
    d = F.lit(run_date)
    with store.run():
        incoming = store.stage(incoming.where(F.col("snapshot_date") == d), "incoming")
        rows = store.stage(_rows_around(store, incoming, run_date, th), "around")
        derived = derived_metrics(rows, th).where(F.col("snapshot_date") >= d).select(*schemas.column_names(schemas.SNAPSHOTS))
        added, stored_added = ([c for c in _added_columns(x) if c != "month"] for x in (incoming, store.read(SNAPSHOTS)))
        if added or stored_added:
            keys = rows.where(F.col("snapshot_date") > d).select(*ingest.SNAPSHOT_KEY)
            later = store.read(SNAPSHOTS).select(*ingest.SNAPSHOT_KEY, *stored_added).join(keys, ingest.SNAPSHOT_KEY, "left_semi")
            values = later.unionByName(incoming.select(*ingest.SNAPSHOT_KEY, *added), allowMissingColumns=True)
            derived = derived.join(values, ingest.SNAPSHOT_KEY, "left")
        metric_rows = aggregated_metrics(rows, None, th).where(F.col("calculation_date") >= d)
        recent = store.stage(_recent_after(store, incoming, th), "recent")
        snapshots = store.merge(SNAPSHOTS, derived)
        metrics = store.merge(METRICS, metric_rows)
        store.merge(RECENT, recent)
        newest = iso(store.fact("newest"))
        store.note("newest", max(run_date, newest or run_date).isoformat())
        store.note("depth", tail_depth(th))
    touched = {k: v["replaced"] + v["inserted"] for k, v in (("derived_rows", snapshots), ("metric_rows", metrics))}
    return {"snapshots": incoming.count(), **touched}


def run_bootstrap(
    wh: Warehouse,
    raw: DataFrame,
    snapshot_date: _dt.date,
    n: int = DEFAULT_THRESHOLDS.top_n_default,
    loaded_at: _dt.datetime | None = None,
    th: Thresholds = DEFAULT_THRESHOLDS,
) -> JobReport:
    """First load: the n most popular titles -> dimension, snapshots, metrics."""
    rep = JobReport()
    with wh.run():
        details = _details(wh, raw, snapshot_date, rep)
        catalog = details.select(F.col("id").alias("movie_id"), "popularity", "adult", "video")
        top = ingest.top_n_popular(catalog, n).select(F.col("movie_id").alias("id"))
        _load_both(wh, details.join(top, "id", "left_semi"), snapshot_date, loaded_at, th, rep)
    return rep


def _load_both(wh, details: DataFrame, snapshot_date, loaded_at, th, rep: JobReport) -> None:
    """Upsert the dimension and the date's snapshots, with all columns of the records, and refresh."""
    added = records.added_columns(details)
    rep.counts["movies"] = load_movies(wh, ingest.transform_movies(details, loaded_at, added=added))
    rows = ingest.transform_snapshots(details, snapshot_date, loaded_at, added=added)
    rep.counts.update(load_and_refresh(wh, rows, snapshot_date, th))


def run_daily(
    wh: Warehouse,
    raw: DataFrame,
    changes: DataFrame,
    snapshot_date: _dt.date,
    loaded_at: _dt.datetime | None = None,
    th: Thresholds = DEFAULT_THRESHOLDS,
) -> JobReport:
    """Changed ids of [D-1, D] -> details -> upsert both tables -> metrics for D.

    An empty change set loads nothing, and the metrics still run.
    """
    start = snapshot_date - _dt.timedelta(days=1)
    rep = JobReport()
    with wh.run():
        # Keep-last first (partial aggregation), then the semi join: an id with a
        # flood of arrivals is one row before it meets the join.
        details = ingest.changed_entities(_details(wh, raw, snapshot_date, rep), changes, start, snapshot_date)
        _load_both(wh, details, snapshot_date, loaded_at, th, rep)
    return rep


def run_weekly(
    wh: Warehouse,
    raw: DataFrame,
    snapshot_date: _dt.date,
    loaded_at: _dt.datetime | None = None,
    th: Thresholds = DEFAULT_THRESHOLDS,
) -> JobReport:
    """Fresh snapshots for every tracked title (dimension untouched) -> metrics."""
    rep = JobReport()
    with wh.run():
        tracked = wh.read(MOVIES, schemas.MOVIES).select(F.col("movie_id").alias("id"))
        details = _details(wh, raw, snapshot_date, rep).join(tracked, "id", "left_semi")
        fresh = ingest.transform_snapshots(details, snapshot_date, loaded_at, added=records.added_columns(details))
        rep.counts.update(load_and_refresh(wh, fresh, snapshot_date, th))
    return rep


def seed_warehouse(
    wh: Warehouse,
    movies: DataFrame,
    base_snapshots: DataFrame,
    th: Thresholds = DEFAULT_THRESHOLDS,
) -> None:
    """Write an existing state: dimension, snapshots with derived columns, metric backfill."""
    with wh.run():
        _seed(wh, movies, base_snapshots, th)


def _seed(wh: Warehouse, movies: DataFrame, base_snapshots: DataFrame, th: Thresholds) -> None:
    wh.replace(MOVIES, movies.select(*schemas.column_names(schemas.MOVIES)))
    wh.replace(
        SNAPSHOTS,
        derived_metrics(base_snapshots, th).select(*schemas.column_names(schemas.SNAPSHOTS)),
        ["snapshot_date"],
        ["movie_id"],
    )
    # Metrics and tail from the stored snapshots: the base rows are derived once.
    stored = wh.read(SNAPSHOTS)
    wh.replace(METRICS, aggregated_metrics(stored, None, th), ["calculation_date"], ["movie_id"])
    if isinstance(wh, RunStore):
        wh.replace(RECENT, recent_of(stored, th))
        newest = stored.agg(F.max("snapshot_date")).first()[0]
        wh.note("newest", newest.isoformat() if newest else None)
        wh.note("depth", tail_depth(th))
        return
    _write_tail(wh, build_tail(stored, th), max(_stored_dates(wh), default=None), th)
