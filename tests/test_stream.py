"""The stream does what the daily job does, whatever the order and number of micro-batches."""

import json
import os
import shutil
import tempfile
import time

import pytest

from pulse import schemas
from pulse.operators import records
from pulse.plans import jobs
from pulse.plans.runs import RunStore
from pulse.plans.warehouse import Warehouse
from pulse.streaming.ingest import stream_ingest
from tests.conftest import D, movies
from tests.test_jobs import LOADED, same
from tests.test_records import record

DAY = D("2024-01-10")


def land_file(folder, name, lines, at):
    path = os.path.join(folder, name)
    with open(path, "w") as f:
        f.writelines((x if isinstance(x, str) else json.dumps(x)) + "\n" for x in lines)
    os.utime(path, (at, at))


def unordered(i, title, **more):
    r = record(i, title=title, **more)
    r.pop("arrival_seq")
    return r


def test_the_newer_file_wins(spark):
    """Records without arrival numbers: the file's time decides, not its name."""
    landing = tempfile.mkdtemp(prefix="pulse-landing-")
    now = time.time()
    land_file(landing, "z-old.json", [unordered(1, "old"), unordered(2, "only")], now - 500)
    land_file(landing, "a-new.json", [unordered(1, "new")], now - 100)
    w = RunStore(spark, tempfile.mkdtemp(prefix="pulse-runs-"), 4)
    stream_ingest(spark, landing, w, LOADED, max_files_per_trigger=1)
    assert {(r.movie_id, r.title) for r in w.read(jobs.MOVIES).collect()} == {(1, "new"), (2, "only")}
    land_file(landing, "b-late.json", [unordered(1, "older than new")], now - 300)
    assert stream_ingest(spark, landing, w, LOADED) >= 1
    assert {(r.movie_id, r.title) for r in w.read(jobs.MOVIES).collect()} == {(1, "new"), (2, "only")}


@pytest.mark.parametrize("kind", [Warehouse, RunStore])
def test_as_the_daily_job(spark, kind):
    landing = tempfile.mkdtemp(prefix="pulse-landing-")
    files = [
        [record(1, 1, title="a"), record(2, 2), "{broken", {"title": "no id"}],
        [record(1, 5, title="b", score=1.5), record(3, 6, title=""), record(4, 7, adult=None)],
        [record(3, 9, title="fixed"), record(5, 8, popularity=None), record(6, 10, title=""), "[]"],
    ]
    for i, lines in enumerate(files):
        land_file(landing, f"f{i}.json", lines, time.time() - 1000 + i)
    changes = spark.createDataFrame([(i, DAY) for i in (1, 3, 4, 5, 6)], schemas.CHANGES)
    start = movies(spark, [(9, "kept", None)])
    found = []
    for stream in (False, True):
        w = kind(spark, tempfile.mkdtemp(prefix="pulse-wh-"))
        with w.run():
            w.replace(jobs.MOVIES, start)
        if stream:
            stream_ingest(spark, landing, w, LOADED, max_files_per_trigger=1, snapshot_date=DAY, changes=changes)
        else:
            jobs.run_daily(w, records.read_records(spark, landing), changes, DAY, LOADED)
        found.append(w)
    batch, streamed = found
    for t, s in ((jobs.MOVIES, schemas.MOVIES), (jobs.SNAPSHOTS, schemas.SNAPSHOTS), (jobs.METRICS, schemas.METRICS), (jobs.REJECTS, schemas.REJECTS)):
        names = schemas.column_names(s)
        assert same(batch.read(t).select(*names), streamed.read(t).select(*names)), t
    assert {r.movie_id: r.score for r in streamed.read(jobs.MOVIES).collect()} == {9: None, 1: 1.5, 3: None, 4: None, 5: None}


def test_a_second_run_reads_only_new_files(spark):
    landing = tempfile.mkdtemp(prefix="pulse-landing-")
    land_file(landing, "f0.json", [record(1, 5, title="newest")], time.time() - 100)
    w = RunStore(spark, tempfile.mkdtemp(prefix="pulse-runs-"), 4)
    assert stream_ingest(spark, landing, w, LOADED) >= 1
    assert stream_ingest(spark, landing, w, LOADED) == 0
    shutil.move(os.path.join(landing, "f0.json"), tempfile.mkdtemp())
    # the first file is gone: the state store still knows its record
    land_file(landing, "f1.json", [record(1, 3, title="late"), record(2, 1, title="other")], time.time())
    stream_ingest(spark, landing, w, LOADED)
    assert {(r.movie_id, r.title) for r in w.read(jobs.MOVIES).collect()} == {(1, "newest"), (2, "other")}


def test_state_table(spark):
    landing = tempfile.mkdtemp(prefix="pulse-landing-")
    land_file(landing, "f0.json", [record(1, 5, title="newest"), record(1, 4, title="before")], time.time() - 100)
    w = Warehouse(spark, tempfile.mkdtemp(prefix="pulse-wh-"))
    stream_ingest(spark, landing, w, LOADED, state_table=True)
    assert [(r.movie_id, r.title) for r in w.read(jobs.MOVIES).collect()] == [(1, "newest")]
