"""Records as VARIANT: null against missing, undeclared fields, values that do not fit."""

import json
import os
import tempfile

import pytest
from pyspark.sql import types as T

from pulse import schemas
from pulse.operators import ingest, records
from pulse.plans import jobs
from pulse.plans.runs import RunStore
from pulse.plans.warehouse import Warehouse
from tests.conftest import D
from tests.test_jobs import LOADED

DAY = D("2024-01-10")


def landed(lines):
    path = tempfile.mkdtemp(prefix="pulse-records-")
    with open(os.path.join(path, "part-0.json"), "w") as f:
        f.writelines((x if isinstance(x, str) else json.dumps(x)) + "\n" for x in lines)
    return path


def record(i, seq=1, **more):
    return {"id": i, "arrival_seq": seq, "title": f"t{i}", "popularity": 1.0, "vote_count": 1, "vote_average": 1.0, **more}


def details(spark, lines, stored=()):
    raw = records.read_records(spark, landed(lines))
    kept = ingest.dedupe_keep_last(ingest.split_malformed(raw)[0])
    return records.typed(kept, records.added_fields(kept, T.StructType(list(stored))))


def test_null_is_not_missing(spark):
    d = details(spark, [record(1, adult=None, genres=None), record(2), record(3, adult=True, genres=[{"id": 1, "name": "a", "more": 2}])])
    m = {r.movie_id: r for r in ingest.transform_movies(d, LOADED).collect()}
    assert (m[1].adult, m[1].genres, m[1].video, m[1].spoken_languages) == (None, None, False, [])
    assert (m[2].adult, m[2].genres) == (False, [])
    assert m[3].adult is True and [(g.id, g.name) for g in m[3].genres] == [(1, "a")]


def test_undeclared_fields_become_typed_columns(spark):
    d = details(spark, [
        record(1, franchise={"id": 7, "name": "F"}, rating=1.5, Title="clash", month=3, tags=["x"], empty=None, mixed=1, **{"a b": 1}),
        record(2, rating=2, mixed="one", **{"a-b": 2}),
    ])
    kinds = {c: d.schema[c].dataType.simpleString() for c in records.added_columns(d)}
    assert kinds == {"Title_2": "string", "a_b": "bigint", "a_b_2": "bigint", "franchise": "struct<id:bigint,name:string>", "mixed": "string", "month_2": "bigint", "rating": "double", "tags": "array<string>"}
    rows = {r.id: r for r in d.collect()}
    assert rows[1].franchise.name == "F" and rows[1].Title_2 == "clash" and rows[2].rating == 2.0 and rows[2].franchise is None
    assert (rows[1].mixed, rows[2].mixed) == ("1", "one") and rows[1].title == "t1"


def test_a_stored_column_keeps_its_type_and_misfits_are_listed(spark):
    d = details(spark, [record(1, rating="high", runtime="long"), record(2, rating=3)], [T.StructField("rating", T.LongType())])
    assert d.schema["rating"].dataType == T.LongType()
    rows = {r.id: r for r in d.collect()}
    assert rows[1].rating is None and rows[2].rating == 3
    listed = {(r.id, r.target_table, r.violation) for r in ingest.required_field_violations(d).collect()}
    assert listed == {(1, "movies", "rating is not of its type"), (1, "movies", "runtime is not of its type")}


def test_lines_that_are_no_records(spark):
    raw = records.read_records(spark, landed([record(1), "", "  ", "[1]", "{broken", '"text"', {"title": "no id"}, {"id": "x"}]))
    good, bad = ingest.split_malformed(raw)
    assert [r.id for r in good.collect()] == [1]
    listed = ingest.rejected_records(details(spark, []), bad, DAY).collect()
    assert sorted((r.violation, r.record) for r in listed) == [
        ("id is missing", '{"id": "x"}'), ("id is missing", '{"title": "no id"}'),
        ("not a record", '"text"'), ("not a record", "[1]"), ("not a record", "{broken"),
    ]


@pytest.mark.parametrize("kind", [Warehouse, RunStore])
def test_a_new_field_goes_through_the_daily_job(spark, kind):
    """The field is in the dimension and in the snapshots, typed; rows without it read NULL, and
    a later run that lacks it keeps the column."""
    w = kind(spark, tempfile.mkdtemp(prefix="pulse-new-field-"))
    every = spark.createDataFrame([(i, DAY) for i in (1, 2, 3)], schemas.CHANGES)
    jobs.run_daily(w, records.read_records(spark, landed([record(1), record(2)])), every, DAY, loaded_at=LOADED)
    jobs.run_daily(w, records.read_records(spark, landed([record(2, franchise="F", score=2.5), record(3, score=1)])), every, DAY, loaded_at=LOADED)
    assert {(r.movie_id, r.franchise, r.score) for r in w.read(jobs.MOVIES).collect()} == {(1, None, None), (2, "F", 2.5), (3, None, 1.0)}
    assert {(r.movie_id, r.franchise, r.score) for r in w.read(jobs.SNAPSHOTS).collect()} == {(1, None, None), (2, "F", 2.5), (3, None, 1.0)}
    later = D("2024-01-11")
    jobs.run_daily(w, records.read_records(spark, landed([record(3, score="high")])), every.withColumn("changed_on", every.changed_on), later, loaded_at=LOADED)
    got = {(r.movie_id, r.score) for r in w.read(jobs.SNAPSHOTS).where("snapshot_date = DATE '2024-01-11'").collect()}
    assert got == {(3, None)} and w.read(jobs.MOVIES).schema["score"].dataType == T.DoubleType()
    assert ("score is not of its type", 3) in {(r.violation, r.id) for r in w.read(jobs.REJECTS).collect()}
