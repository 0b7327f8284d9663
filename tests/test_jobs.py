import datetime as dt
import json
import os
import tempfile

import pytest

from pyspark.sql import functions as F

from tests.conftest import D, base_snapshots, daily_series, movies
from pulse import schemas
from pulse.operators import ingest
from pulse.operators.metrics import aggregated_metrics, derived_metrics
from pulse.plans import jobs
from pulse.plans.warehouse import Warehouse
from pulse.streaming.ingest import stream_ingest

LOADED = dt.datetime(2024, 2, 1, 0, 0, 0)


def wh(spark):
    return Warehouse(spark, tempfile.mkdtemp(prefix="pulse-wh-"))


def same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def land(spark, recs, files=1):
    d = tempfile.mkdtemp(prefix="pulse-landing-")
    per = max(1, len(recs) // files)
    for i in range(0, len(recs), per):
        with open(os.path.join(d, f"part-{i:05d}.json"), "w") as f:
            for r in recs[i : i + per]:
                f.write(json.dumps(r) + "\n")
    return d


def raw_recs(n_ids=6, per_id=3, day="2024-01-10"):
    out, seq = [], 0
    for k in range(per_id):
        for i in range(1, n_ids + 1):
            seq += 1
            out.append({"id": i, "arrival_seq": seq, "title": f"t{i}-{k}", "popularity": float(i * 10 + k),
                        "vote_count": i * 100 + k, "vote_average": 5.0, "release_date": day})
    return out


def test_warehouse_versions_and_partition_overwrite(spark):
    w = wh(spark)
    s = base_snapshots(spark, [(1, "2024-01-01", 1.0, 1), (1, "2024-01-02", 2.0, 2)])
    w.replace("t", s, ["snapshot_date"])
    w.replace("t", s, ["snapshot_date"])
    assert w.current_path("t").endswith("v=2")
    upd = base_snapshots(spark, [(9, "2024-01-02", 9.0, 9)])
    w.overwrite_partitions("t", upd, ["snapshot_date"])
    got = {(r.movie_id, str(r.snapshot_date)) for r in w.read("t").collect()}
    assert got == {(1, "2024-01-01"), (9, "2024-01-02")}


def test_daily_rerun_is_idempotent(spark):
    w = wh(spark)
    hist = daily_series(1, "2024-01-01", range(1, 10), range(10, 100, 10)) + daily_series(
        2, "2024-01-01", range(20, 11, -1), range(5, 50, 5)
    )
    jobs.seed_warehouse(w, movies(spark, [(1, "a", None), (2, "b", None)]), base_snapshots(spark, hist))
    raw = ingest.read_raw_details(spark, land(spark, raw_recs(2, 2)))
    changes = spark.createDataFrame([(1, D("2024-01-10")), (2, D("2024-01-09"))], "id long, changed_on date")
    jobs.run_daily(w, raw, changes, D("2024-01-10"), LOADED)
    first = w.read(jobs.METRICS).where(F.col("calculation_date") == D("2024-01-10")).collect()
    jobs.run_daily(w, raw, changes, D("2024-01-10"), LOADED)
    second = w.read(jobs.METRICS).where(F.col("calculation_date") == D("2024-01-10")).collect()
    assert len(first) == 2 and sorted(first) == sorted(second)
    assert w.read(jobs.SNAPSHOTS).count() == len(hist) + 2


def test_empty_change_set_loads_nothing_but_metrics_run(spark):
    w = wh(spark)
    hist = daily_series(1, "2024-01-01", range(1, 10), range(10, 100, 10))
    jobs.seed_warehouse(w, movies(spark, [(1, "a", None)]), base_snapshots(spark, hist))
    raw = ingest.read_raw_details(spark, land(spark, raw_recs(1, 1)))
    changes = spark.createDataFrame([], schemas.CHANGES)
    rep = jobs.run_daily(w, raw, changes, D("2024-01-09"), LOADED)
    assert rep.counts["metric_rows"] == 1
    assert w.read(jobs.MOVIES).count() == 1


def test_late_snapshot_refresh_equals_full_recompute(spark):
    w = wh(spark)
    full = daily_series(1, "2024-01-01", range(1, 25), range(10, 250, 10)) + daily_series(
        2, "2024-01-03", range(40, 20, -1), range(5, 105, 5)
    )
    late_day = "2024-01-08"
    seed = [r for r in full if not (r[0] == 1 and r[1] == late_day)]
    jobs.seed_warehouse(w, movies(spark, [(1, "a", None), (2, "b", None)]), base_snapshots(spark, seed))
    late = base_snapshots(spark, [r for r in full if r[0] == 1 and r[1] == late_day])
    jobs.load_snapshots(w, late, D(late_day))
    jobs.refresh_metrics(w, D(late_day))
    want_s = derived_metrics(base_snapshots(spark, full)).select(*schemas.column_names(schemas.SNAPSHOTS))
    want_m = aggregated_metrics(base_snapshots(spark, full))
    got_s = w.read(jobs.SNAPSHOTS).select(*schemas.column_names(schemas.SNAPSHOTS))
    got_m = w.read(jobs.METRICS).select(*schemas.column_names(schemas.METRICS))
    assert same(got_s, want_s)
    assert same(got_m, want_m)
    want_tail = jobs.build_tail(base_snapshots(spark, full))
    assert same(w.read(jobs.TAIL).select(*want_tail.columns), want_tail)


@pytest.mark.parametrize("combined", [False, True])
def test_daily_refresh_from_tail_equals_full_recompute(spark, combined):
    w = wh(spark)
    hist = daily_series(1, "2024-01-01", range(1, 31), range(10, 310, 10)) + daily_series(
        2, "2024-01-10", range(40, 20, -1), range(5, 105, 5)
    ) + daily_series(3, "2024-01-01", [4, 5], [1, 2])
    jobs.seed_warehouse(w, movies(spark, [(1, "a", None), (2, "b", None), (3, "c", None)]), base_snapshots(spark, hist))
    assert w.read(jobs.TAIL).groupBy("movie_id").count().agg(F.max("count")).first()[0] == 15
    new_day = "2024-02-01"
    new = [(1, new_day, 99.0, 999), (2, new_day, 1.0, 200), (4, new_day, 3.0, 3)]
    if combined:
        counts = jobs.load_and_refresh(w, base_snapshots(spark, new), D(new_day))
        assert counts["snapshots"] == 3 and counts["metric_rows"] == 3
    else:
        jobs.load_snapshots(w, base_snapshots(spark, new), D(new_day))
        jobs.refresh_metrics(w, D(new_day))  # newest date: served from the tail
    full = base_snapshots(spark, hist + new)
    want_m = aggregated_metrics(full).where(F.col("calculation_date") == D(new_day))
    got_m = w.read(jobs.METRICS).where(F.col("calculation_date") == D(new_day)).select(*want_m.columns)
    assert got_m.count() == 3 and same(got_m, want_m)
    want_s = derived_metrics(full).select(*schemas.column_names(schemas.SNAPSHOTS))
    got_s = w.read(jobs.SNAPSHOTS).select(*schemas.column_names(schemas.SNAPSHOTS))
    assert same(got_s, want_s)
    want_tail = jobs.build_tail(full)
    assert same(w.read(jobs.TAIL).select(*want_tail.columns), want_tail)


def test_bootstrap_takes_top_n(spark):
    w = wh(spark)
    raw = ingest.read_raw_details(spark, land(spark, raw_recs(6, 2)))
    rep = jobs.run_bootstrap(w, raw, D("2024-01-10"), n=3, loaded_at=LOADED)
    assert rep.counts["movies"] == 3
    assert {r.movie_id for r in w.read(jobs.MOVIES).collect()} == {4, 5, 6}
    assert w.read(jobs.METRICS).count() == 3


def test_stream_ingest_equals_batch_upsert(spark):
    recs = raw_recs(8, 4)
    landing = land(spark, recs, files=8)
    w = wh(spark)
    existing = movies(spark, [(1, "old", None), (100, "keep", None)])
    w.replace(jobs.MOVIES, existing)
    epochs = stream_ingest(spark, landing, w, LOADED, max_files_per_trigger=2)
    assert epochs >= 2
    raw = ingest.read_raw_details(spark, landing)
    want = ingest.upsert_movies(existing, ingest.transform_movies(ingest.dedupe_keep_last(raw), LOADED))
    assert same(w.read(jobs.MOVIES).select(*want.columns), want)


def test_vacuum_keeps_newest_versions(spark):
    w = wh(spark)
    s = base_snapshots(spark, [(1, "2024-01-01", 1.0, 1)])
    for _ in range(4):
        w.replace("t", s)
    removed = w.vacuum("t", keep=2)
    assert len(removed) == 2
    assert w.current_path("t").endswith("v=4") and w.read("t").count() == 1


def test_cli_validate_exit_code(spark):
    from pulse.__main__ import main

    w = wh(spark)
    jobs.seed_warehouse(w, movies(spark, [(1, "a", None)]), base_snapshots(spark, [(1, "2024-01-01", 1.0, 1)]))
    assert main(["validate", w.root]) == 0
    bad = movies(spark, [(2, "b", None)]).withColumn("last_updated", F.lit(None).cast("timestamp"))
    w.replace(jobs.MOVIES, bad)
    assert main(["validate", w.root]) == 1


def test_views_over_job_warehouse(spark):
    from pulse.operators import momentum
    from pulse.plans.tables import warehouse_tables

    w = wh(spark)
    hist = daily_series(1, "2024-01-01", [10] * 7 + [20], [1] * 8)
    jobs.seed_warehouse(w, movies(spark, [(1, "a", "2024-01-01")]), base_snapshots(spark, hist))
    t = warehouse_tables(w, D("2024-02-01"))
    rows = momentum.top_gaining_movies(t.snapshots, t.movies, t.metrics).collect()
    assert [(r.movie_id, r.weekly_pct_gain, r.momentum_rank) for r in rows] == [(1, 100.0, 1)]
    assert rows[0].wow_pct_change == 100.0


def test_stream_batches_replayed_or_reordered_give_same_dimension(spark):
    from pulse.streaming.ingest import _batch_writer

    recs = raw_recs(5, 3)
    early = ingest.read_raw_details(spark, land(spark, recs[:8]))
    late = ingest.read_raw_details(spark, land(spark, recs[8:]))
    results = []
    for order in ([early, late], [late, early], [early, late, late, early]):
        w = wh(spark)
        w.replace(jobs.MOVIES, movies(spark, [(99, "keep", None)]))
        handle = _batch_writer(w, LOADED)
        for epoch, batch in enumerate(order):
            handle(batch, epoch)
        results.append(w.read(jobs.MOVIES))
    assert {r.movie_id: r.title for r in results[0].collect()} == {
        99: "keep", 1: "t1-2", 2: "t2-2", 3: "t3-2", 4: "t4-2", 5: "t5-2"
    }
    assert same(results[0], results[1]) and same(results[0], results[2])


def test_records_without_arrival_order_and_bad_lines_are_kept_or_listed(spark):
    d = land(spark, [{k: v for k, v in r.items() if k != "arrival_seq"} for r in raw_recs(3, 1)])
    with open(os.path.join(d, "part-00001.json"), "w") as f:
        f.write('{"id": 9, "title": broken\n{"title": "no id"}\n{"id": 5, "title": ""}\n')
    w = wh(spark)
    rep = jobs.run_bootstrap(w, ingest.read_landed(spark, d), D("2024-01-10"), loaded_at=LOADED)
    assert {r.movie_id for r in w.read(jobs.MOVIES).collect()} == {1, 2, 3}
    assert w.read(jobs.SNAPSHOTS).count() == 3
    rejects = {(r.id, r.target_table, r.violation) for r in w.read(jobs.REJECTS).collect()}
    assert {(None, "raw", "not a record"), (None, "raw", "id is missing"), (5, "movies", "title is missing")} <= rejects
    assert rep.counts["rejected_raw"] == 2 and rep.counts["rejected_movies"] == 1
    assert any("broken" in (r.record or "") for r in w.read(jobs.REJECTS).collect())


def test_a_dead_writer_blocks_nobody(spark):
    w = wh(spark)
    s = base_snapshots(spark, [(1, "2024-01-01", 1.0, 1)])
    w.replace("t", s)
    s.write.parquet(f"{w.root}/t/v=2")
    os.remove(f"{w.root}/t/v=2/_SUCCESS")
    assert w.current_path("t").endswith("v=1")
    w.replace("t", s)
    assert w.current_path("t").endswith("v=3")
    w.vacuum("t", keep=2)
    assert sorted(os.listdir(f"{w.root}/t")) == ["v=1", "v=3"]


def test_first_daily_run_with_an_empty_change_set(spark):
    w = wh(spark)
    raw = ingest.read_landed(spark, land(spark, raw_recs(1, 1)))
    jobs.run_daily(w, raw, spark.createDataFrame([], schemas.CHANGES), D("2024-01-09"), LOADED)
    assert w.read(jobs.SNAPSHOTS).count() == 0 and w.read(jobs.METRICS).columns[0] == "movie_id"
    changes = spark.createDataFrame([(1, D("2024-01-10"))], "id long, changed_on date")
    jobs.run_daily(w, raw, changes, D("2024-01-10"), LOADED)
    assert w.read(jobs.METRICS).count() == 1


def test_a_load_that_died_before_its_refresh_is_caught_up(spark):
    w = wh(spark)
    hist = daily_series(1, "2024-01-01", range(1, 21), range(10, 210, 10))
    jobs.seed_warehouse(w, movies(spark, [(1, "a", None)]), base_snapshots(spark, hist))
    died = [(1, "2024-01-21", 50.0, 400)]
    jobs.load_snapshots(w, base_snapshots(spark, died), D("2024-01-21"))  # no refresh follows
    new = [(1, "2024-01-22", 60.0, 500)]
    jobs.load_and_refresh(w, base_snapshots(spark, new), D("2024-01-22"))
    want = aggregated_metrics(base_snapshots(spark, hist + died + new))
    assert same(w.read(jobs.METRICS).select(*want.columns), want)
    want_s = derived_metrics(base_snapshots(spark, hist + died + new)).select(*schemas.column_names(schemas.SNAPSHOTS))
    assert same(w.read(jobs.SNAPSHOTS).select(*want_s.columns), want_s)


def test_the_tail_is_as_deep_as_the_thresholds_look(spark):
    from pulse.config import Thresholds

    th = Thresholds(ma_rows=30)
    hist = daily_series(1, "2024-01-01", range(1, 41), range(10, 410, 10))
    new = [(1, "2024-02-10", 70.0, 700)]
    want = aggregated_metrics(base_snapshots(spark, hist + new), None, th).where(F.col("calculation_date") == D("2024-02-10"))
    for seeded in (th, Thresholds()):  # a tail of other thresholds is too short and must not be used
        w = wh(spark)
        jobs.seed_warehouse(w, movies(spark, [(1, "a", None)]), base_snapshots(spark, hist), seeded)
        jobs.load_and_refresh(w, base_snapshots(spark, new), D("2024-02-10"), th)
        got = w.read(jobs.METRICS).where(F.col("calculation_date") == D("2024-02-10"))
        assert same(got.select(*want.columns), want)


def test_a_second_stream_run_reads_only_new_files(spark):
    landing = land(spark, raw_recs(3, 1))
    w = wh(spark)
    w.replace(jobs.MOVIES, movies(spark, [(100, "keep", None)]))
    assert stream_ingest(spark, landing, w, LOADED) == 1
    with open(os.path.join(landing, "part-99999.json"), "w") as f:
        f.write(json.dumps({"id": 7, "arrival_seq": 99, "title": "new", "popularity": 1.0, "vote_count": 1, "vote_average": 1.0}) + "\n")
    later = LOADED + dt.timedelta(days=1)
    assert stream_ingest(spark, landing, w, later, snapshot_date=D("2024-02-02")) == 1
    assert stream_ingest(spark, landing, w, later) == 0
    assert {r.movie_id for r in w.read(jobs.MOVIES).where(F.col("last_updated") == F.lit(later)).collect()} == {7}
    assert [(r.movie_id, str(r.snapshot_date)) for r in w.read(jobs.SNAPSHOTS).collect()] == [(7, "2024-02-02")]
    assert w.read(jobs.METRICS).count() == 1


def test_added_columns_are_read_back(spark):
    w = wh(spark)
    w.replace(jobs.MOVIES, movies(spark, [(1, "a", None)]).withColumn("extra", F.lit(5)))
    assert w.read(jobs.MOVIES).select("movie_id", "extra").first() == (1, 5)


def test_keep_last_is_the_same_every_time(spark):
    rows = [(1, 7, f"t{i}") for i in range(50)]
    df = spark.createDataFrame(rows, "id long, arrival_seq long, title string")
    got = {ingest.dedupe_keep_last(df.repartition(n)).first()["title"] for n in (1, 3, 8)}
    assert len(got) == 1


def test_a_new_field_goes_through_the_load_and_later_refreshes(spark):
    w = wh(spark)
    hist = daily_series(1, "2024-01-01", range(1, 6), range(10, 60, 10))
    jobs.seed_warehouse(w, movies(spark, [(1, "a", None)]), base_snapshots(spark, hist))
    new = base_snapshots(spark, [(1, "2024-01-06", 9.0, 90)]).withColumn("revenue", F.lit(7).cast("long"))
    jobs.load_and_refresh(w, new, D("2024-01-06"))
    jobs.load_and_refresh(w, base_snapshots(spark, [(1, "2024-01-07", 9.0, 95)]), D("2024-01-07"))
    jobs.load_and_refresh(w, base_snapshots(spark, [(2, "2024-01-03", 9.0, 95)]), D("2024-01-03"))  # a late date
    got = {(r.movie_id, str(r.snapshot_date)): r.revenue for r in w.read(jobs.SNAPSHOTS).collect()}
    assert got.pop((1, "2024-01-06")) == 7 and set(got.values()) == {None} and len(got) == 7
