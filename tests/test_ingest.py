import datetime as dt
import json
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from tests.conftest import D, TS, base_snapshots, movies
from pulse.operators import ingest

LOADED = dt.datetime(2024, 2, 1, 10, 30, 15)


@pytest.fixture(scope="module")
def raw(spark):
    recs = [
        {"id": 1, "arrival_seq": 1, "title": "One (old)", "popularity": 1.0, "vote_count": 10, "vote_average": 5.0},
        {"id": 1, "arrival_seq": 5, "title": "One", "popularity": 2.0, "vote_count": 20, "vote_average": 6.0,
         "release_date": "2024-01-05", "adult": None, "genres": [{"id": 3, "name": "Drama"}]},
        {"id": 2, "arrival_seq": 2, "title": "Two", "popularity": 3.0, "vote_count": 30, "vote_average": 7.0,
         "release_date": "", "adult": True},
        {"id": 0, "arrival_seq": 3, "title": "Zero", "popularity": 1.0, "vote_count": 1, "vote_average": 1.0},
        {"id": 4, "arrival_seq": 4, "title": "", "popularity": None, "vote_count": 4, "vote_average": 4.0},
        {"arrival_seq": 6, "title": "No id", "popularity": 1.0, "vote_count": 1, "vote_average": 1.0},
    ]
    path = os.path.join(tempfile.mkdtemp(prefix="pulse-raw-"), "raw.json")
    with open(path, "w") as f:
        for r in recs:
            f.write(json.dumps(r) + "\n")
    return ingest.read_raw_details(spark, path)


def test_dedupe_keeps_last_arrival_and_drops_missing_ids(spark, raw):
    d = {r.id: r for r in ingest.dedupe_keep_last(raw).collect()}
    assert set(d) == {0, 1, 2, 4}
    assert d[1].title == "One" and d[1].arrival_seq == 5


def test_transform_movies_defaults_and_guards(spark, raw):
    m = {r.movie_id: r for r in ingest.transform_movies(ingest.dedupe_keep_last(raw), LOADED).collect()}
    assert set(m) == {1, 2}  # id 0 and the empty title are rejected
    one, two = m[1], m[2]
    assert one.adult is False and one.video is False  # explicit null and missing both default
    assert [g.name for g in one.genres] == ["Drama"]
    assert one.production_companies == [] and one.spoken_languages == []
    assert one.release_date == D("2024-01-05")
    assert two.release_date is None  # empty string is not a date
    assert two.adult is True
    assert one.last_updated == LOADED.replace(microsecond=0)


def test_strict_mode_fails_the_job(spark, raw):
    with pytest.raises(Exception, match="violates the movies contract"):
        ingest.transform_movies(ingest.dedupe_keep_last(raw), LOADED, mode="strict").collect()


def test_transform_snapshots_guards(spark, raw):
    s = ingest.transform_snapshots(ingest.dedupe_keep_last(raw), D("2024-01-30"), LOADED)
    got = {r.movie_id: r for r in s.collect()}
    assert set(got) == {1, 2}  # id 0 rejected, NULL popularity rejected
    assert got[1].snapshot_date == D("2024-01-30") and got[1].vote_count == 20


def test_required_field_violations(spark, raw):
    v = {(r.id, r.target_table, r.violation) for r in
         ingest.required_field_violations(ingest.dedupe_keep_last(raw)).collect()}
    assert v == {
        (0, "movies", "id is missing"),
        (0, "movie_daily_snapshots", "id is missing"),
        (4, "movies", "title is missing"),
        (4, "movie_daily_snapshots", "popularity is missing"),
        (2, "movies", "release_date is not a date"),
    }


def test_upsert_movies_replaces_and_is_idempotent(spark):
    old = movies(spark, [(1, "a", None), (2, "b", None)])
    new = movies(spark, [(2, "B", "2024-01-01"), (3, "c", None)])
    once = ingest.upsert_movies(old, new)
    twice = ingest.upsert_movies(once, new)
    got = {r.movie_id: r.title for r in once.collect()}
    assert got == {1: "a", 2: "B", 3: "c"}
    assert once.exceptAll(twice).count() == 0 and twice.exceptAll(once).count() == 0


def test_upsert_snapshots_touches_only_that_date(spark):
    old = base_snapshots(spark, [(1, "2024-01-01", 1.0, 1), (1, "2024-01-02", 2.0, 2), (2, "2024-01-02", 5.0, 5)])
    new = base_snapshots(spark, [(1, "2024-01-02", 9.0, 9), (3, "2024-01-02", 7.0, 7)])
    d = D("2024-01-02")
    out = {(r.movie_id, r.snapshot_date): r.popularity for r in ingest.upsert_snapshots(old, new, d).collect()}
    assert out == {(1, D("2024-01-01")): 1.0, (1, d): 9.0, (2, d): 5.0, (3, d): 7.0}
    part = ingest.upsert_snapshots_partition(old, new, d)
    assert {r.snapshot_date for r in part.collect()} == {d}
    counts = ingest.upsert_counts(old, new, ingest.SNAPSHOT_KEY, "s").first()
    assert (counts.replaced_rows, counts.loaded_rows, counts.net_new_rows, counts.total_rows) == (1, 2, 1, 4)


def test_changed_entities_window(spark, raw):
    changes = spark.createDataFrame(
        [(1, D("2024-01-29")), (2, D("2024-01-27")), (1, D("2024-01-30"))], "id long, changed_on date"
    )
    ids = {r.id for r in ingest.changed_ids(changes, D("2024-01-29"), D("2024-01-30")).collect()}
    assert ids == {1}
    ent = ingest.changed_entities(ingest.dedupe_keep_last(raw), changes, D("2024-01-29"), D("2024-01-30"))
    assert [r.id for r in ent.collect()] == [1]


def test_top_n_excludes_adult_and_video(spark):
    cat = spark.createDataFrame(
        [(1, 5.0, False, False), (2, 9.0, True, False), (3, 7.0, False, True), (4, 6.0, None, False), (5, 6.0, False, False)],
        "movie_id long, popularity double, adult boolean, video boolean",
    )
    assert [r.movie_id for r in ingest.top_n_popular(cat, 2).collect()] == [4, 5]


def test_schema_evolution_union(spark):
    old = base_snapshots(spark, [(1, "2024-01-01", 1.0, 1)])
    new = base_snapshots(spark, [(2, "2024-01-02", 2.0, 2)]).withColumn("source", F.lit("x"))
    out = ingest.evolve_union(old, new)
    assert "source" in out.columns
    assert {r.movie_id: r.source for r in out.collect()} == {1: None, 2: "x"}
