"""Jobs on the run store: one commit point, touched partitions only, late rows, one layout for views."""

import datetime as dt
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from pulse import schemas
from pulse.config import DEFAULT_THRESHOLDS
from pulse.operators.metrics import BASE_COLUMNS, aggregated_metrics, derived_metrics
from pulse.plans import jobs, views
from pulse.plans.registry import presentable
from pulse.plans.runs import RunStore
from pulse.plans.tables import Tables, warehouse_tables
from tests.conftest import D, base_snapshots, daily_series, movies
from tests.test_jobs import LOADED, land, raw_recs, same
from pulse.operators import ingest

IDS = range(1, 13)


def store(spark, buckets=4):
    return RunStore(spark, tempfile.mkdtemp(prefix="pulse-runs-"), buckets)


def history(spark, days=60):
    rows = []
    for i in IDS:
        s = daily_series(i, "2024-01-01", [i * 10 + (7 * i * k) % 13 for k in range(days)], [i * 100 + 9 * k for k in range(days)])
        rows += [r for k, r in enumerate(s) if (k + i) % 4]  # gaps
    return base_snapshots(spark, rows)


def seeded(spark, base=None, buckets=4):
    w = store(spark, buckets)
    jobs.seed_warehouse(w, movies(spark, [(i, f"t{i}", None) for i in IDS]), base if base is not None else history(spark))
    return w


def full(w, base):
    """Whether the stored tables are what a full recompute of ``base`` gives."""
    snaps, mets = schemas.column_names(schemas.SNAPSHOTS), schemas.column_names(schemas.METRICS)
    recent = jobs.recent_of(base)
    return (
        same(w.read(jobs.SNAPSHOTS).select(*snaps), derived_metrics(base).select(*snaps))
        and same(w.read(jobs.METRICS).select(*mets), aggregated_metrics(base).select(*mets))
        and same(jobs._recent_rows(w), recent.select("movie_id", F.explode("recent").alias("r")).select("movie_id", "r.*").select(*BASE_COLUMNS))
    )


def upserted(base, incoming):
    return base.join(incoming, ingest.SNAPSHOT_KEY, "left_anti").unionByName(incoming)


@pytest.mark.parametrize("day", ["2024-02-29", "2024-01-20"])
def test_any_date_equals_full_recompute(spark, day):
    base = history(spark)
    w = seeded(spark, base)
    incoming = base_snapshots(spark, [(i, day, 55.5 + i, 5000 + i) for i in (2, 3, 7)] + [(99, day, 1.0, 1)])
    before = {t: w.folders(t) for t in (jobs.SNAPSHOTS, jobs.METRICS, jobs.MOVIES)}
    counts = jobs.load_and_refresh(w, incoming, D(day))
    assert full(w, upserted(base, incoming))
    # a title's next 14 rows lie within 20 days here; other months keep their folders
    last = D(day) + dt.timedelta(days=20)
    reach = {m for m in before[jobs.SNAPSHOTS] if D(day).strftime("%Y%m") <= m <= last.strftime("%Y%m")}
    for t in (jobs.SNAPSHOTS, jobs.METRICS):
        changed = {m for m, f in w.folders(t).items() if before[t].get(m) != f}
        assert changed <= reach | {D(day).strftime("%Y%m")}
    assert w.folders(jobs.MOVIES) == before[jobs.MOVIES]
    assert counts["derived_rows"] <= 4 * 15


def test_loads_in_any_order_give_one_state(spark):
    base = history(spark, 20)
    loads = [(d, base_snapshots(spark, [(i, d, 9.0 * i, 900 + i) for i in (1, 2, 5)])) for d in ("2024-01-25", "2024-01-22", "2024-01-10")]
    for order in (loads, loads[::-1]):
        w = seeded(spark, base)
        want = base
        for d, rows in order:
            jobs.load_and_refresh(w, rows, D(d))
            want = upserted(want, rows)
        jobs.load_and_refresh(w, order[0][1], D(order[0][0]))  # a rerun changes nothing
        assert full(w, want)


def test_a_run_that_dies_leaves_the_old_state(spark, monkeypatch):
    base = history(spark, 30)
    w = seeded(spark, base)
    held = w.read(jobs.METRICS)
    rows = base_snapshots(spark, [(i, "2024-01-31", 1.0, 1) for i in IDS])
    merge, left = w.merge, {"n": 2}

    def dying(name, df):
        left["n"] -= 1
        if left["n"] < 0:
            raise OSError("killed")
        return merge(name, df)

    monkeypatch.setattr(w, "merge", dying)
    with pytest.raises(OSError):
        jobs.load_and_refresh(w, rows, D("2024-01-31"))
    assert full(w, base) and full(RunStore(spark, w.root), base)
    monkeypatch.undo()
    jobs.load_and_refresh(w, rows, D("2024-01-31"))
    assert full(w, upserted(base, rows))
    assert held.count() == base.count()  # a reader of the state before still finds its files
    jobs.load_and_refresh(w, rows, D("2024-01-31"))
    assert len(w._pointers()) == 2  # what older states alone named is gone


def test_two_runs_cannot_become_the_same_one(spark):
    w = seeded(spark, history(spark, 5))
    other = RunStore(spark, w.root)
    rows = base_snapshots(spark, [(1, "2024-01-06", 1.0, 1)])
    with pytest.raises(RuntimeError, match="another writer"):
        with w.run():
            jobs.load_and_refresh(w, rows, D("2024-01-06"))
            jobs.load_and_refresh(other, rows, D("2024-01-06"))
    assert full(other, upserted(history(spark, 5), rows))


def test_only_touched_buckets_are_written(spark):
    w = store(spark, 16)
    jobs.seed_warehouse(w, movies(spark, [(i, f"t{i}", None) for i in range(1000)]), history(spark, 3))
    before = w.folders(jobs.MOVIES)
    counts = w.merge(jobs.MOVIES, movies(spark, [(5, "new title", None), (5000, "new", None)]))
    after = w.folders(jobs.MOVIES)
    changed = [b for b in after if before.get(b) != after[b]]
    assert len(before) == 16 and 1 <= len(changed) <= 2
    assert counts["replaced"] == 1 and counts["inserted"] == 1 and counts["kept"] < 2 * 1000 / 16 * 1.6
    size = lambda parts: sum(os.path.getsize(f"{d}/{f}") for b, r in parts.items() for d in [f"{w.root}/{jobs.MOVIES}/{r}/bucket={b}"] for f in os.listdir(d))
    assert size({b: after[b] for b in changed}) < size(after) / 4
    assert {r.title for r in w.read(jobs.MOVIES).where("movie_id IN (5, 5000)").collect()} == {"new title", "new"}
    assert w.read(jobs.MOVIES).count() == 1001


def test_views_on_the_jobs_own_tables(spark):
    base = history(spark)
    w = seeded(spark, base)
    dim = movies(spark, [(i, f"t{i}", "2024-01-03", [(1, "Drama"), (2, f"g{i % 2}")]) for i in IDS])
    w.merge(jobs.MOVIES, dim)
    as_of = D("2024-02-29")
    mine, lazy = warehouse_tables(w, as_of), Tables(dim, base, as_of)
    for name in ("latest_popularity_metrics", "vote_engagement_timeline", "viral_breakouts", "genre_viral_performance", "viral_coefficient_scores"):
        # sums of doubles depend on the order of the rows in their last digits
        assert same(presentable(views.report(mine, name)), presentable(views.report(lazy, name))), name
    plan = views.report(mine, "genre_viral_performance")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("PartitionFilters: [isnotnull(month") == 2
    old = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions",)}
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    try:
        for name in ("popularity_7d_moving_average", "vote_engagement_timeline"):
            plan = views.report(mine, name)._jdf.queryExecution().executedPlan().toString()
            assert "hashpartitioning" not in plan, name
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_jobs_give_the_same_tables_on_both_stores(spark):
    from pulse.plans.warehouse import Warehouse

    d = land(spark, raw_recs(6, 2), files=3)
    changes = spark.createDataFrame([(i, D("2024-01-10")) for i in (1, 2, 3)], schemas.CHANGES)
    found = []
    for w in (Warehouse(spark, tempfile.mkdtemp(prefix="pulse-wh-")), store(spark)):
        jobs.run_bootstrap(w, ingest.read_landed(spark, d), D("2024-01-09"), loaded_at=LOADED)
        jobs.run_daily(w, ingest.read_landed(spark, d), changes, D("2024-01-10"), loaded_at=LOADED)
        jobs.run_weekly(w, ingest.read_landed(spark, d), D("2024-01-11"), loaded_at=LOADED)
        found.append([w.read(t).select(*schemas.column_names(s)) for t, s in ((jobs.MOVIES, schemas.MOVIES), (jobs.SNAPSHOTS, schemas.SNAPSHOTS), (jobs.METRICS, schemas.METRICS), (jobs.REJECTS, schemas.REJECTS))])
    assert all(same(a, b) for a, b in zip(*found))


def test_an_empty_store_and_an_empty_load(spark):
    w = store(spark)
    assert w.read(jobs.METRICS).count() == 0 and w.read(jobs.MOVIES).count() == 0
    nothing = base_snapshots(spark, [(1, "2024-01-01", 1.0, 1)]).limit(0)
    jobs.load_and_refresh(w, nothing, D("2024-01-01"))
    assert w.read(jobs.SNAPSHOTS).count() == 0
    rows = base_snapshots(spark, [(1, "2024-01-02", 1.0, 1)])
    jobs.load_and_refresh(w, rows, D("2024-01-02"))
    assert full(w, rows)


def test_deeper_thresholds_rebuild_the_newest_rows(spark):
    from dataclasses import replace

    base = history(spark, 40)
    w = seeded(spark, base)
    th = replace(DEFAULT_THRESHOLDS, baseline_lag=25)
    rows = base_snapshots(spark, [(i, "2024-02-20", 3.0, 3) for i in (1, 2)])
    jobs.load_and_refresh(w, rows, D("2024-02-20"), th)
    want = aggregated_metrics(upserted(base, rows), D("2024-02-20"), th)
    got = w.read(jobs.METRICS).where(F.col("calculation_date") == F.lit(D("2024-02-20")))
    assert same(got.select(*want.columns), want)
    assert w.read(jobs.RECENT).where("movie_id = 1").select(F.size("recent")).first()[0] == 26


def test_a_run_stores_buckets_follow_the_bytes_of_the_source(spark, tmp_path, monkeypatch):
    """A bucket is one task: its rows are sorted and joined there."""
    from pulse.plans import jobs, registry
    from pulse.sources import fixtures

    spark.range(400).selectExpr(
        "id AS event_id", "timestamp_seconds(1700000000 + id * 20000) AS ts", "id % 9 AS user_id", "'view' AS event_type", "id * 0.5D AS value", "'{}' AS props"
    ).write.parquet(f"{tmp_path}/events.parquet")
    spark.range(9).selectExpr("id AS c_custkey", "'n' AS c_name", "'m' AS c_mktsegment", "1.5D AS c_acctbal").write.parquet(f"{tmp_path}/customer.parquet")
    slots = spark.sparkContext.defaultParallelism
    size = sum(n for _, n, _ in fixtures.source_files(spark, str(tmp_path), ("customer", "events")))
    monkeypatch.setattr(fixtures, "PIECE_BYTES", size // (2 * slots))
    fx = fixtures.Fixture(spark, str(tmp_path))
    store = registry._run_store(fx, "run-buckets")
    assert store._state()["buckets"] == fx.event_pieces() >= 2 * slots
    assert store.read(jobs.MOVIES).count() == 9
    key = lambda r: (r["movie_id"], r["snapshot_date"])
    columns = ["movie_id", "snapshot_date", "popularity", "vote_count"]
    plain = fixtures.snapshots_from_events(fx.table("events")).select(*columns)
    assert sorted(store.read(jobs.SNAPSHOTS).select(*columns).collect(), key=key) == sorted(plain.collect(), key=key)
