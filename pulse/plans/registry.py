"""Every registered query as ``(spark, sf_dir) -> DataFrame`` over the supplied tables.

Views and reports read the lazily built fixture tables (``plans.tables``).
Ingest, upsert, job and stream keys run against the ``events`` adapter; the
keys that write (landed JSON, warehouse versions, stream state) write under
the session's shared checkpoint folder and return the resulting table.
Double columns are rounded to 6 places and array columns rendered as JSON
text so results compare exactly with the SQL oracle.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulse import schemas
from pulse.operators import examples, ingest, metrics, momentum, quality, records
from pulse.plans import jobs, views
from pulse.plans.runs import RunStore
from pulse.plans.tables import Tables, fixture_tables, stored_fixture_tables
from pulse.plans.warehouse import Warehouse
from pulse.session import BUCKET_JOINS, DEFAULT_CONF, scratch_path
from pulse.sources.fixtures import Fixture
from pulse.streaming.ingest import stream_ingest

Query = Callable[[SparkSession, str], DataFrame]

SINGLE_DATE = _dt.date(2001, 1, 10)  # 4 / 22 / 214 snapshots at sf 0.001 / 0.01 / 0.1
RUN_DATE = _dt.date(2024, 1, 30)  # last events day: the daily / weekly run date
LOADED_AT = _dt.datetime(2024, 1, 31, 0, 0, 0)
TOP_N = 1000


def presentable(df: DataFrame) -> DataFrame:
    """Doubles rounded to 6 places, arrays / structs as JSON text."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if isinstance(f.dataType, T.DoubleType):
            c = F.round(c, 6)
        elif isinstance(f.dataType, (T.ArrayType, T.StructType, T.MapType)):
            c = F.to_json(c)
        cols.append(c.alias(f.name))
    return df.select(*cols)


def _setup(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def _setup_buckets(spark: SparkSession) -> None:
    """The stored tables are bucketed by title: a session made elsewhere would exchange both
    sides of every join on (title, date) again."""
    _setup(spark)
    spark.conf.set(BUCKET_JOINS, DEFAULT_CONF[BUCKET_JOINS])


def on_tables(fn: Callable[[Tables], DataFrame]) -> Query:
    """A view over the stored tables (written once per session and source folder)."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        _setup_buckets(spark)
        return presentable(fn(stored_fixture_tables(spark, sf_dir)))

    return run


def on_views(statement: str) -> Query:
    """A SQL statement over the registered views."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        _setup_buckets(spark)
        views.register_views(spark, stored_fixture_tables(spark, sf_dir))
        return presentable(spark.sql(statement))

    return run


def on_raw_tables(fn: Callable[[Tables], DataFrame]) -> Query:
    """A table build computed from the supplied tables (not from stored copies)."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        _setup(spark)
        return presentable(fn(fixture_tables(spark, sf_dir)))

    return run


def on_fixture(fn: Callable[[Fixture], DataFrame]) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        _setup(spark)
        return presentable(fn(Fixture(spark, sf_dir)))

    return run


# -- ingest helpers -----------------------------------------------------------


def landed_raw(fx: Fixture) -> DataFrame:
    """The events-derived raw records, landed as JSON files and read back with the schema."""
    path = scratch_path(fx.spark, "landed-raw")
    ingest.land_raw_details(fx.raw_details(), path)
    return ingest.read_raw_details(fx.spark, path)


def landed_for_jobs(fx: Fixture) -> DataFrame:
    """The same landed files as the jobs read them: with file order and malformed lines."""
    path = scratch_path(fx.spark, "landed-raw")
    ingest.land_raw_details(fx.raw_details(), path)
    return ingest.read_landed(fx.spark, path)


def _incoming_snapshots(fx: Fixture) -> DataFrame:
    return ingest.transform_snapshots(ingest.dedupe_keep_last(fx.raw_details()), RUN_DATE, LOADED_AT)


def _schema_evolution(fx: Fixture) -> DataFrame:
    """Append a batch that carries a new field to a stored table; read with schema merge."""
    path = scratch_path(fx.spark, "evolving-snapshots")
    fx.events_snapshots().write.parquet(path)
    details = ingest.dedupe_keep_last(fx.raw_details())
    batch = ingest.transform_snapshots(details, RUN_DATE, LOADED_AT).join(
        details.select(F.col("id").alias("movie_id"), "revenue"), "movie_id"
    )
    batch.write.mode("append").parquet(path)
    return fx.spark.read.option("mergeSchema", "true").parquet(path)


def _fresh_warehouse(fx: Fixture, name: str) -> Warehouse:
    return Warehouse(fx.spark, scratch_path(fx.spark, name))


def _seeded_warehouse(fx: Fixture, name: str) -> Warehouse:
    wh = _fresh_warehouse(fx, name)
    jobs.seed_warehouse(wh, fx.customer_movies(), fx.events_snapshots())
    return wh


def _job_bootstrap(fx: Fixture) -> DataFrame:
    wh = _fresh_warehouse(fx, "wh-bootstrap")
    jobs.run_bootstrap(wh, landed_for_jobs(fx), RUN_DATE, TOP_N, LOADED_AT)
    return wh.read(jobs.METRICS).select(*schemas.column_names(schemas.METRICS))


def _job_daily(fx: Fixture) -> DataFrame:
    wh = _seeded_warehouse(fx, "wh-daily")
    jobs.run_daily(wh, landed_for_jobs(fx), fx.changes(), RUN_DATE, LOADED_AT)
    m = wh.read(jobs.METRICS).where(F.col("calculation_date") == F.lit(RUN_DATE))
    return m.select(*schemas.column_names(schemas.METRICS))


def _rejected_records(fx: Fixture) -> DataFrame:
    """What a daily run over the landed records does not take."""
    wh = _seeded_warehouse(fx, "wh-rejects")
    jobs.run_daily(wh, landed_for_jobs(fx), fx.changes(), RUN_DATE, LOADED_AT)
    return wh.read(jobs.REJECTS).drop("record")


def _job_after_failed_load(fx: Fixture) -> DataFrame:
    """A load of the day before that died before its refresh, then the daily run: the metrics of
    both dates must be there and right. An upsert version without commit lies about as well."""
    day_before = RUN_DATE - _dt.timedelta(days=1)
    base = fx.events_snapshots()
    wh = _fresh_warehouse(fx, "wh-failed")
    jobs.seed_warehouse(wh, fx.customer_movies(), base.where(F.col("snapshot_date") < F.lit(day_before)))
    jobs.load_snapshots(wh, base.where(F.col("snapshot_date") == F.lit(day_before)), day_before)
    fx.customer_movies().limit(1).write.parquet(f"{wh.root}/{jobs.MOVIES}/v=2")
    wh._fs_path(wh.root)[0].delete(wh._fs_path(f"{wh.root}/{jobs.MOVIES}/v=2/_SUCCESS")[1], False)
    jobs.run_daily(wh, landed_for_jobs(fx), fx.changes(), RUN_DATE, LOADED_AT)
    m = wh.read(jobs.METRICS).where(F.col("calculation_date") >= F.lit(day_before))
    return m.select(*schemas.column_names(schemas.METRICS))


def _stored_dimension(fx: Fixture) -> DataFrame:
    """The dimension after two upserts with a dead writer between them."""
    wh = _fresh_warehouse(fx, "wh-store")
    jobs.load_movies(wh, fx.customer_movies())
    fx.customer_movies().limit(1).write.parquet(f"{wh.root}/{jobs.MOVIES}/v=2")
    wh._fs_path(wh.root)[0].delete(wh._fs_path(f"{wh.root}/{jobs.MOVIES}/v=2/_SUCCESS")[1], False)
    details = ingest.dedupe_keep_last(fx.raw_details())
    jobs.load_movies(wh, ingest.transform_movies(details, LOADED_AT))
    return wh.read(jobs.MOVIES).select(*schemas.column_names(schemas.MOVIES))


def _schema_evolution_load(fx: Fixture) -> DataFrame:
    """The daily load with a new field: stored for the new rows, NULL for the old."""
    wh = _seeded_warehouse(fx, "wh-evolve")
    details = ingest.dedupe_keep_last(fx.raw_details())
    rows = ingest.transform_snapshots(details, RUN_DATE, LOADED_AT)
    jobs.load_and_refresh(wh, rows.join(details.select(F.col("id").alias("movie_id"), "revenue"), "movie_id"), RUN_DATE)
    return wh.read(jobs.SNAPSHOTS).select(*metrics.BASE_COLUMNS, "revenue")


def _job_weekly(fx: Fixture) -> DataFrame:
    wh = _seeded_warehouse(fx, "wh-weekly")
    jobs.run_weekly(wh, landed_for_jobs(fx), RUN_DATE, LOADED_AT)
    m = wh.read(jobs.METRICS).where(F.col("calculation_date") == F.lit(RUN_DATE))
    return m.select(*schemas.column_names(schemas.METRICS))


# -- jobs on the run store ----------------------------------------------------


def _run_store(fx: Fixture, name: str, snapshots: DataFrame | None = None) -> RunStore:
    store = RunStore(fx.spark, scratch_path(fx.spark, name), fx.event_pieces())
    jobs.seed_warehouse(store, fx.customer_movies(), fx.events_snapshots() if snapshots is None else snapshots)
    return store


_DAILY: dict[tuple[str, str], RunStore] = {}


def _daily_store(fx: Fixture) -> RunStore:
    """A run store after the daily run, once per session and source folder (what a run leaves is
    read by several keys)."""
    key = (fx.spark.sparkContext.applicationId, fx.sf_dir)
    if key not in _DAILY:
        store = _run_store(fx, "run-daily")
        jobs.run_daily(store, landed_for_jobs(fx), fx.changes(), RUN_DATE, LOADED_AT)
        _DAILY[key] = store
    return _DAILY[key]


def _job_dimension(fx: Fixture) -> DataFrame:
    return _daily_store(fx).read(jobs.MOVIES).select(*schemas.column_names(schemas.MOVIES))


def _job_derived(fx: Fixture) -> DataFrame:
    """The run date's snapshots with their derived columns after a daily run."""
    rows = _daily_store(fx).read(jobs.SNAPSHOTS).where(F.col("snapshot_date") == F.lit(RUN_DATE))
    return rows.select(*schemas.column_names(schemas.SNAPSHOTS))


def _job_recent(fx: Fixture) -> DataFrame:
    """Each title's newest rows after a daily run."""
    return jobs._recent_rows(_daily_store(fx))


LATE_DATE = RUN_DATE - _dt.timedelta(days=10)


def _late_snapshots(fx: Fixture) -> DataFrame:
    """Snapshots of every third title that arrive ten days late."""
    ids = fx.events_snapshots().select("movie_id").distinct().where("movie_id % 3 = 0")
    return ids.select(
        "movie_id",
        F.lit(LATE_DATE).alias("snapshot_date"),
        F.lit(500.25).alias("popularity"),
        (F.col("movie_id") + 7).alias("vote_count"),
        F.lit(5.0).alias("vote_average"),
        F.lit(LOADED_AT.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp").alias("ingestion_timestamp"),
    )


def _job_late_date(fx: Fixture) -> DataFrame:
    """All derived columns and metrics after rows that came late."""
    store = _run_store(fx, "run-late")
    jobs.load_and_refresh(store, _late_snapshots(fx), LATE_DATE)
    m = store.read(jobs.METRICS).select(*schemas.column_names(schemas.METRICS)).withColumnRenamed("calculation_date", "snapshot_date")
    return store.read(jobs.SNAPSHOTS).select(*schemas.column_names(schemas.SNAPSHOTS)).join(m, ingest.SNAPSHOT_KEY)


class _Killed(Exception):
    pass


def _job_killed(fx: Fixture) -> DataFrame:
    """A daily run that dies between two tables, and the same run again: the newest metrics as
    they are read after each."""
    store = _run_store(fx, "run-killed")
    merge = store.merge

    def dying(name: str, rows: DataFrame):
        if name == jobs.METRICS:
            raise _Killed
        return merge(name, rows)

    newest = F.col("calculation_date") >= F.lit(RUN_DATE)
    seen = []
    for phase in ("killed", "again"):
        store.merge = dying if phase == "killed" else merge
        try:
            jobs.run_daily(store, landed_for_jobs(fx), fx.changes(), RUN_DATE, LOADED_AT)
        except _Killed:
            pass
        rows = store.read(jobs.METRICS).where(newest).select(F.lit(phase).alias("phase"), *schemas.column_names(schemas.METRICS))
        seen.append(rows)
    return seen[0].unionByName(seen[1])


def _variant_lines(fx: Fixture) -> DataFrame:
    """Records as JSON text: some fields null, some missing, some undeclared."""
    own = ["id", "arrival_seq", "title", "release_date", "runtime", "video", "popularity", "vote_count", "vote_average"]
    raw = fx.raw_details()
    n = F.col("arrival_seq")
    told = F.when(n % 3 == 0, ',"adult":null,"genres":null').when(n % 3 == 1, F.concat(F.lit(',"adult":'), F.col("adult").cast("string"), F.lit(',"genres":'), F.to_json("genres"))).otherwise("")
    new = F.when(n % 2 == 0, F.format_string(',"franchise":{"id":%d,"name":"F%d"},"score":%d.5', n % 7, n % 7, n % 10)).otherwise("")
    return raw.select(F.concat(F.regexp_replace(F.to_json(F.struct(*own)), r"\}$", ""), told, new, F.lit("}")).alias("value"))


def _raw_variant_fields(fx: Fixture) -> DataFrame:
    """A daily run over records with null, missing and undeclared fields: what stands in the
    dimension and in the snapshots."""
    path = scratch_path(fx.spark, "landed-text")
    _variant_lines(fx).write.text(path)
    store = _run_store(fx, "run-variant")
    jobs.run_daily(store, records.read_records(fx.spark, path), fx.changes(), RUN_DATE, LOADED_AT)
    day = store.read(jobs.SNAPSHOTS).where(F.col("snapshot_date") == F.lit(RUN_DATE))
    day = day.select("movie_id", F.col("franchise.name").alias("snapshot_franchise"), F.col("score").alias("snapshot_score"))
    movies = store.read(jobs.MOVIES).select("movie_id", "title", "runtime", "adult", "video", "genres", "franchise", "score")
    return movies.join(day, "movie_id", "left")


def _stream_without_order(fx: Fixture) -> DataFrame:
    """The dimension after records without an arrival number: a title's first record lands before
    its last, and the stream runs after each landing."""
    landing = scratch_path(fx.spark, "landing")
    raw = fx.raw_details().where("id IS NOT NULL")
    store = _run_store(fx, "run-stream")
    for order in ("min", "max"):
        pick = getattr(F, f"{order}_by")(F.struct(*raw.columns), "arrival_seq").alias("r")
        records_ = raw.groupBy(F.col("id").alias("_id")).agg(pick).select("r.*").drop("arrival_seq")
        records_.repartition(3).write.mode("append").json(landing)
        stream_ingest(fx.spark, landing, store, LOADED_AT, max_files_per_trigger=2)
    return store.read(jobs.MOVIES).select(*schemas.column_names(schemas.MOVIES))


def _stream_rejected(fx: Fixture) -> DataFrame:
    """What the stream does not take: the same as the daily job."""
    landing = scratch_path(fx.spark, "landing")
    ingest.land_raw_details(fx.raw_details().repartition(4), landing)
    store = _run_store(fx, "run-stream-rejects")
    stream_ingest(fx.spark, landing, store, LOADED_AT, max_files_per_trigger=2, snapshot_date=RUN_DATE)
    return store.read(jobs.REJECTS).select(*schemas.column_names(schemas.REJECTS)).drop("record")


def _stream(fx: Fixture) -> DataFrame:
    landing = scratch_path(fx.spark, "landing")
    # Several files, so the stream runs several micro-batches.
    ingest.land_raw_details(fx.raw_details().repartition(8), landing)
    wh = _fresh_warehouse(fx, "wh-stream")
    wh.replace(jobs.MOVIES, fx.customer_movies())
    stream_ingest(fx.spark, landing, wh, LOADED_AT, max_files_per_trigger=4)
    return wh.read(jobs.MOVIES).select(*schemas.column_names(schemas.MOVIES))


def _stream_metrics(fx: Fixture) -> DataFrame:
    """Metrics of the run date after a stream that does the daily job's loads."""
    landing = scratch_path(fx.spark, "landing")
    ingest.land_raw_details(fx.raw_details().repartition(4), landing)
    wh = _seeded_warehouse(fx, "wh-stream-daily")
    stream_ingest(fx.spark, landing, wh, LOADED_AT, max_files_per_trigger=2, snapshot_date=RUN_DATE)
    m = wh.read(jobs.METRICS).where(F.col("calculation_date") == F.lit(RUN_DATE))
    return m.select(*schemas.column_names(schemas.METRICS))


def queries() -> dict[str, Query]:
    q: dict[str, Query] = {}
    # A: sources, ingest, sinks, jobs
    q["raw_details_parse"] = on_fixture(landed_raw)
    q["dedupe_keep_last"] = on_fixture(lambda fx: ingest.dedupe_keep_last(fx.raw_details()))
    q["transform_movies"] = on_fixture(
        lambda fx: ingest.transform_movies(ingest.dedupe_keep_last(fx.raw_details()), LOADED_AT)
    )
    q["transform_snapshots"] = on_fixture(_incoming_snapshots)
    q["required_field_violations"] = on_fixture(
        lambda fx: ingest.required_field_violations(ingest.dedupe_keep_last(fx.raw_details()))
    )
    q["upsert_movies"] = on_fixture(
        lambda fx: ingest.upsert_movies(
            fx.customer_movies(),
            ingest.transform_movies(ingest.dedupe_keep_last(fx.raw_details()), LOADED_AT),
        )
    )
    q["upsert_snapshots"] = on_fixture(
        lambda fx: ingest.upsert_snapshots(fx.events_snapshots(), _incoming_snapshots(fx), RUN_DATE)
    )
    q["schema_evolution_add_column"] = on_fixture(_schema_evolution)
    q["upsert_counts"] = on_fixture(
        lambda fx: ingest.upsert_counts(
            fx.events_snapshots(), _incoming_snapshots(fx), ingest.SNAPSHOT_KEY, jobs.SNAPSHOTS
        )
    )
    q["top_n_popular"] = on_tables(
        lambda t: ingest.top_n_popular(
            momentum.latest_per_movie(t.snapshots.select("movie_id", "snapshot_date", "popularity"), "snapshot_date")
            .join(t.movies.select("movie_id", "title", "adult", "video"), "movie_id"),
            TOP_N,
        ).select("movie_id", "title", "popularity")
    )
    q["changed_entities"] = on_fixture(
        lambda fx: ingest.changed_entities(
            ingest.dedupe_keep_last(fx.raw_details()),
            fx.changes(),
            RUN_DATE - _dt.timedelta(days=1),
            RUN_DATE,
        )
    )
    q["tracked_ids"] = on_tables(lambda t: ingest.tracked_ids(t.movies))
    q["refresh_tracked_snapshots"] = on_fixture(
        lambda fx: ingest.refresh_tracked_snapshots(
            fx.raw_details(), fx.customer_movies(), fx.events_snapshots(), RUN_DATE, LOADED_AT
        )
    )
    q["job_bootstrap"] = on_fixture(_job_bootstrap)
    q["job_daily"] = on_fixture(_job_daily)
    q["rejected_records"] = on_fixture(_rejected_records)
    q["job_after_failed_load"] = on_fixture(_job_after_failed_load)
    q["schema_evolution_load"] = on_fixture(_schema_evolution_load)
    q["stored_dimension"] = on_fixture(_stored_dimension)
    q["stream_metrics"] = on_fixture(_stream_metrics)
    q["job_dimension"] = on_fixture(_job_dimension)
    q["job_derived"] = on_fixture(_job_derived)
    q["job_recent"] = on_fixture(_job_recent)
    q["job_late_date"] = on_fixture(_job_late_date)
    q["job_killed"] = on_fixture(_job_killed)
    q["raw_variant_fields"] = on_fixture(_raw_variant_fields)
    q["stream_without_order"] = on_fixture(_stream_without_order)
    q["stream_rejected"] = on_fixture(_stream_rejected)
    q["job_weekly"] = on_fixture(_job_weekly)
    q["stream_ingest"] = on_fixture(_stream)
    # B: derived per-snapshot metrics
    q["derived_metrics"] = on_raw_tables(lambda t: t.snapshots)
    q["dedupe_snapshots"] = on_fixture(
        lambda fx: metrics.dedupe_snapshots(
            fx.events_snapshots().unionByName(_incoming_snapshots(fx))
        )
    )
    # C: aggregated metrics, three forms
    q["aggregated_metrics_backfill"] = on_raw_tables(lambda t: t.metrics)
    q["aggregated_metrics_for_date"] = on_fixture(
        lambda fx: metrics.aggregated_metrics(fx.base_snapshots(), SINGLE_DATE)
    )
    q["aggregated_metrics_as_written"] = on_fixture(
        lambda fx: metrics.aggregated_metrics_as_written(fx.base_snapshots(), SINGLE_DATE)
    )
    # D, E: views and reports
    for name, view in (views.VIEWS | views.REPORTS).items():
        q[name] = on_tables(view)
    # F: documented examples, as SQL over the registered views
    for name, statement in views.EXAMPLES.items():
        q[name] = on_views(statement)
    q["recent_updates_sample"] = on_tables(lambda t: examples.recent_updates_sample(t.movies))
    # G: data quality
    q["validate_movies"] = on_tables(lambda t: quality.validate_movies(t.movies))
    q["validate_snapshots"] = on_tables(lambda t: quality.validate_snapshots(t.snapshots))
    q["validate_all"] = on_tables(lambda t: quality.validate_all(t.movies, t.snapshots))
    return q
