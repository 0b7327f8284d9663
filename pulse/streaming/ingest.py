"""Incremental ingest of landed records with Structured Streaming: the daily job on what has landed.

The landed lines are read as text with the time and name of their file. Two
queries share the folder:

1. Records. Keep-last per id is a stateful streaming aggregation (``max_by``
   in update mode): the state store holds each id's latest record, by
   ``arrival_seq`` and, for records that carry none, by file time and name. A
   micro-batch writes the state of the ids it has seen and no others, and
   hands their latest records to ``foreachBatch``, which does what the daily
   job does: types them, lists what it will not take, upserts the dimension
   and, with a snapshot date, that date's snapshots and the metrics (of
   changed ids only, if a change feed is given). On a ``RunStore`` a
   micro-batch is one run: only the buckets and months of its ids are
   rewritten, and they become visible together.
2. Lines that are no record or have no id. They go to a folder of their
   epoch and from there, once the folder is drained, to the reject table.

A replayed epoch (``foreachBatch`` is at-least-once) meets the state it met
before, so it hands over the same records, which are upserted again; a bad
line's epoch folder is written anew. The checkpoints lie under the warehouse
root, one for each landing folder: a later run reads only files that have
landed since. ``trigger(availableNow=True)`` drains what has landed and stops,
which is how a scheduled daily run uses it.

``state_table=True`` keeps the latest records in a table of the warehouse
instead (the whole of it is written anew in every micro-batch).
"""

from __future__ import annotations

import datetime as _dt
import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulse import schemas
from pulse.operators import ingest, records
from pulse.plans import jobs
from pulse.plans.jobs import MOVIES, REJECTS, load_and_refresh, load_movies
from pulse.plans.warehouse import Warehouse

STATE = "raw_latest_state"


def _batch_writer(wh: Warehouse, loaded_at: _dt.datetime | None, snapshot_date: _dt.date | None = None, epochs: list | None = None):
    """Upserts of raw batches in any order, over a state table."""

    def handle(batch: DataFrame, epoch_id: int) -> None:
        state = wh.read(STATE, schemas.RAW_DETAILS)
        merged = ingest.dedupe_keep_last(
            state.unionByName(batch.select(*schemas.column_names(schemas.RAW_DETAILS)))
        )
        wh.replace(STATE, merged)
        wh.vacuum(STATE)
        touched = batch.where(F.col("id").isNotNull()).select("id").distinct()
        latest = wh.read(STATE).join(touched, "id", "left_semi")
        load_movies(wh, ingest.transform_movies(latest, loaded_at))
        if snapshot_date is not None:
            load_and_refresh(wh, ingest.transform_snapshots(latest, snapshot_date, loaded_at), snapshot_date)
        if epochs is not None:
            epochs.append(epoch_id)

    return handle


def _run_date(loaded_at: _dt.datetime | None, snapshot_date: _dt.date | None) -> _dt.date:
    return snapshot_date or (loaded_at or _dt.datetime.now(_dt.timezone.utc)).date()


def _latest_writer(wh: Warehouse, loaded_at: _dt.datetime | None, snapshot_date: _dt.date | None, changes: DataFrame | None, epochs: list):
    """The daily job over the latest records of the ids that a micro-batch has seen."""
    run_date = _run_date(loaded_at, snapshot_date)

    def handle(latest: DataFrame, epoch_id: int) -> None:
        kept = wh.stage(latest, "latest")
        with wh.run():
            details = jobs.typed_details(wh, kept)
            _replace_rejects(wh, ingest.rejected_records(details, kept.where("false"), run_date), kept, run_date)
            if changes is not None:
                details = ingest.changed_entities(details, changes, run_date - _dt.timedelta(days=1), run_date)
            added = records.added_columns(details)
            load_movies(wh, ingest.transform_movies(details, loaded_at, added=added))
            if snapshot_date is not None:
                rows = ingest.transform_snapshots(details, snapshot_date, loaded_at, added=added)
                load_and_refresh(wh, rows, snapshot_date)
        epochs.append(epoch_id)

    return handle


def _replace_rejects(wh: Warehouse, found: DataFrame, kept: DataFrame, run_date: _dt.date) -> None:
    """The run date's rejects, with those of the ids in ``kept`` (all lines without an id, if it
    has no id column) replaced by ``found``."""
    own = F.col("target_table") == "raw"
    before = wh.read(REJECTS).where(F.col("run_date") == F.lit(run_date))
    if "id" in kept.columns:
        others = before.where(~own).join(kept.select("id"), "id", "left_anti").unionByName(before.where(own))
    else:
        others = before.where(~own)
    names = schemas.column_names(schemas.REJECTS)
    staged = wh.stage(others.select(*names).unionByName(found.select(*names)), "rejects")
    wh.overwrite_partitions(REJECTS, staged, ["run_date"], reads_target=False)


def _malformed_writer(folder: str, run_date: _dt.date):
    def handle(batch: DataFrame, epoch_id: int) -> None:
        batch.withColumn("run_date", F.lit(run_date)).write.mode("overwrite").parquet(f"{folder}/epoch={epoch_id}")

    return handle


def stream_checkpoint(wh: Warehouse, landing_path: str) -> str:
    """The checkpoint folder of a landing folder's stream."""
    return f"{wh.root}/_streams/{hashlib.sha256(landing_path.rstrip('/').encode()).hexdigest()[:16]}"


def _drain(stream: DataFrame, mode: str, handle, checkpoint: str) -> None:
    query = stream.writeStream.outputMode(mode).foreachBatch(handle).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))


def stream_ingest(
    spark: SparkSession,
    landing_path: str,
    wh: Warehouse,
    loaded_at: _dt.datetime | None = None,
    max_files_per_trigger: int | None = None,
    checkpoint: str | None = None,
    snapshot_date: _dt.date | None = None,
    changes: DataFrame | None = None,
    state_table: bool = False,
) -> int:
    """Drain what has landed since the last run; returns the number of epochs run."""
    checkpoint = checkpoint or stream_checkpoint(wh, landing_path)
    limit = {"maxFilesPerTrigger": max_files_per_trigger} if max_files_per_trigger else {}
    epochs: list[int] = []
    if state_table:
        raw = spark.readStream.schema(schemas.RAW_DETAILS).options(**limit).json(landing_path)
        _drain(raw, "append", _batch_writer(wh, loaded_at, snapshot_date, epochs), checkpoint)
        return len(epochs)
    lines = records.with_keys(spark.readStream.format("text").options(**limit).load(landing_path))
    good, malformed = ingest.split_malformed(lines)
    _drain(ingest.dedupe_keep_last(good), "update", _latest_writer(wh, loaded_at, snapshot_date, changes, epochs), f"{checkpoint}/records")
    run_date = _run_date(loaded_at, snapshot_date)
    folder = f"{checkpoint}/malformed-lines"
    _drain(malformed, "append", _malformed_writer(folder, run_date), f"{checkpoint}/malformed")
    if epochs:
        _list_malformed(spark, wh, folder, run_date)
    return len(epochs)


def _list_malformed(spark: SparkSession, wh: Warehouse, folder: str, run_date: _dt.date) -> None:
    """The reject table's rows of the run date for lines without an id, from their epochs' folders."""
    fs, p = wh._fs_path(folder)
    if not fs.exists(p):
        return
    lines = spark.read.option("basePath", folder).parquet(f"{folder}/epoch=*").where(F.col("run_date") == F.lit(run_date))
    nothing = spark.createDataFrame([], schemas.RAW_DETAILS)
    found = ingest.rejected_records(nothing, lines, run_date)
    with wh.run():
        _replace_rejects(wh, found, lines.select("epoch"), run_date)
