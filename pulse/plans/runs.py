"""A warehouse whose tables change together, at one point, and in the partitions a run touches.

Layout. Every table is bucketed by ``movie_id`` into the same number of
buckets; the fact tables are partitioned by month, the dimension and the
titles' newest rows by bucket. So a view's date range is a partition filter,
per-title windows and joins on ``movie_id`` need no exchange, and an upsert
rewrites the months or buckets that have an incoming key and no others.

Commit. A run writes its partitions into folders of its own
(``<table>/run-<n>-<id>/<partition>=<value>``) and touches nothing that is
there. At its end it writes one small file that names the folder of every
partition of all tables, and renames it to ``_runs/<n>``: that is the only
moment at which anything changes, for all tables at once. A run that dies
before leaves the old state readable; its folders are removed by a later run.
Two runs cannot both become number n.

This is a naming convention for folders, not a table format: partitions are
plain bucketed Parquet, written by Spark's committer and read as catalog
tables whose partitions lie where the file says. ``Warehouse`` is the same
interface over whole versions of tables; the jobs run on both.
"""

from __future__ import annotations

import copy
import datetime as _dt
import hashlib
import json
import uuid
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulse import schemas
from pulse.functions.columns import month_of
from pulse.plans.warehouse import Warehouse


@dataclass(frozen=True)
class Layout:
    """A table's key, and its partition column with the value of a row among n buckets."""

    key: tuple[str, ...]
    partition: str
    value: Callable[[int], Column]
    bucketed: bool = True


def _bucket(n: int) -> Column:
    """The number of a row's bucket, as Spark's bucketed writer finds it."""
    return F.pmod(F.hash("movie_id"), F.lit(n))


LAYOUTS = {
    "movies": Layout(("movie_id",), "bucket", _bucket),
    "movie_daily_snapshots": Layout(("movie_id", "snapshot_date"), "month", lambda n: month_of("snapshot_date")),
    "movie_metrics_aggregated": Layout(("movie_id", "calculation_date"), "month", lambda n: month_of("calculation_date")),
    "movie_recent_snapshots": Layout(("movie_id",), "bucket", _bucket),
    "rejected_records": Layout((), "run_date", lambda n: F.col("run_date"), bucketed=False),
}


def _ddl(kind: T.DataType) -> str:
    """A type's DDL with every field name quoted."""
    if isinstance(kind, T.StructType):
        return "struct<" + ",".join(f"`{f.name}`:{_ddl(f.dataType)}" for f in kind.fields) + ">"
    if isinstance(kind, T.ArrayType):
        return f"array<{_ddl(kind.elementType)}>"
    if isinstance(kind, T.MapType):
        return f"map<{_ddl(kind.keyType)},{_ddl(kind.valueType)}>"
    return kind.simpleString()


class RunStore(Warehouse):
    def __init__(self, spark: SparkSession, root: str, buckets: int | None = None):
        super().__init__(spark, root)
        self._open: dict | None = None
        self._buckets = buckets or max(1, spark.sparkContext.defaultParallelism)

    # -- the one commit point ------------------------------------------------

    def _pointers(self) -> list[str]:
        fs, p = self._fs_path(f"{self.root}/_runs")
        if not fs.exists(p):
            return []
        return sorted(st.getPath().getName() for st in fs.listStatus(p) if st.getPath().getName().startswith("run-"))

    def _committed(self) -> dict:
        names = self._pointers()
        if not names:
            return {"run": 0, "buckets": self._buckets, "facts": {}, "tables": {}}
        return json.loads(self._text(f"{self.root}/_runs/{names[-1]}"))

    def _state(self) -> dict:
        """What a run has written so far, or what is committed."""
        return self._open if self._open is not None else self._committed()

    @contextmanager
    def run(self) -> Iterator[RunStore]:
        """All writes inside become visible together at the end, or not at all. Runs nest: the
        outermost one commits."""
        if self._open is not None:
            yield self
            return
        self._open = copy.deepcopy(self._committed())
        self._open["run"] += 1
        self._open["folder"] = f"run-{self._open['run']:010d}-{uuid.uuid4().hex[:8]}"
        try:
            yield self
            self._commit(self._open)
        finally:
            self._open = None
        self._clean()

    def _commit(self, state: dict) -> None:
        made = {k: v for k, v in state.items() if k != "folder"}
        temporary = f"{self.root}/_runs/.{state['folder']}"
        self._text(temporary, json.dumps(made))
        fs, source = self._fs_path(temporary)
        target = self._fs_path(f"{self.root}/_runs/run-{state['run']:010d}")[1]
        if fs.exists(target) or not fs.rename(source, target):
            raise RuntimeError(f"run {state['run']} was committed by another writer; start again from its state")

    def _clean(self, keep: int = 2) -> list[str]:
        """Remove folders that the newest ``keep`` states do not name, of runs up to the newest."""
        names = self._pointers()
        states = [json.loads(self._text(f"{self.root}/_runs/{n}")) for n in names[-keep:]]
        used = {(name, folder) for s in states for name, t in s["tables"].items() for folder in t["parts"].values()}
        fs, root = self._fs_path(self.root)
        removed = []
        for st in fs.listStatus(root):
            name = st.getPath().getName()
            if name not in LAYOUTS:
                continue
            for folder in (x.getPath() for x in fs.listStatus(st.getPath())):
                run = folder.getName()
                if run.startswith("run-") and int(run.split("-")[1]) <= states[-1]["run"] and (name, run) not in used:
                    fs.delete(folder, True)
                    removed.append(folder.toString())
        for n in names[:-keep]:
            fs.delete(self._fs_path(f"{self.root}/_runs/{n}")[1], False)
        return removed

    def fact(self, name: str):
        """A small value that was committed with the tables."""
        return self._state()["facts"].get(name)

    def note(self, name: str, value) -> None:
        self._open["facts"][name] = value

    # -- reading -------------------------------------------------------------

    def exists(self, name: str) -> bool:
        return name in self._state()["tables"]

    def current_path(self, name: str) -> str | None:
        return f"{self.root}/{name}" if self.exists(name) else None

    def partition_values(self, name: str, column: str) -> list[str]:
        layout = LAYOUTS[name]
        return sorted(self._state()["tables"].get(name, {"parts": {}})["parts"]) if column == layout.partition else []

    def folders(self, name: str) -> dict[str, str]:
        """Partition value -> the folder that holds it."""
        return dict(self._state()["tables"].get(name, {"parts": {}})["parts"])

    def read(self, name: str, schema: T.StructType | None = None) -> DataFrame:
        """The table's columns (declared and added), and ``month`` where it is partitioned by it."""
        df = self._table(name)
        return df.drop("bucket") if LAYOUTS[name].partition == "bucket" else df

    def _table(self, name: str) -> DataFrame:
        state, layout = self._state(), LAYOUTS[name]
        held = state["tables"].get(name)
        if held is None:
            declared = schemas.TABLES[name]
            kind = T.DateType() if layout.partition == "run_date" else T.IntegerType()
            fields = [f for f in declared.fields if f.name != layout.partition]
            return self.spark.createDataFrame([], T.StructType([*(T.StructField(f.name, f.dataType) for f in fields), T.StructField(layout.partition, kind)]))
        schema = T.StructType.fromJson(held["schema"])
        tag = hashlib.sha256(f"{self.root} {json.dumps(held, sort_keys=True)}".encode()).hexdigest()[:20]
        table = f"pulse_run_{tag}_{name}"
        if not self.spark.catalog.tableExists(table):
            columns = ", ".join(f"`{f.name}` {_ddl(f.dataType)}" for f in schema.fields)
            buckets = f"CLUSTERED BY (movie_id) SORTED BY ({', '.join(layout.key)}) INTO {state['buckets']} BUCKETS" if layout.bucketed else ""
            self.spark.sql(f"CREATE TABLE {table} ({columns}) USING parquet OPTIONS (path '{self.root}/{name}') PARTITIONED BY (`{layout.partition}`) {buckets}")
            date = "DATE " if isinstance(schema[layout.partition].dataType, T.DateType) else ""
            parts = [f"PARTITION (`{layout.partition}` = {date}'{v}') LOCATION '{self.root}/{name}/{folder}/{layout.partition}={v}'" for v, folder in held["parts"].items()]
            for i in range(0, len(parts), 1000):
                self.spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {' '.join(parts[i : i + 1000])}")
        return self.spark.table(table)

    # -- writing -------------------------------------------------------------

    def _placed(self, name: str, df: DataFrame) -> DataFrame:
        """``df`` with the partition column last."""
        layout = LAYOUTS[name]
        value = layout.value(self._state()["buckets"])
        return df.drop(layout.partition).withColumn(layout.partition, value) if layout.bucketed else df

    def _write(self, name: str, df: DataFrame, gone: Sequence[str], whole: bool) -> None:
        """Write placed rows to a folder of this run and point their partitions there; the
        partitions ``gone`` (or all others, if ``whole``) have no rows any more."""
        state, layout = self._open, LAYOUTS[name]
        folder, n = state["folder"], 2
        while self._fs_path(self.root)[0].exists(self._fs_path(f"{self.root}/{name}/{folder}")[1]):
            folder, n = f"{state['folder']}-{n}", n + 1
        path = f"{self.root}/{name}/{folder}"
        if layout.bucketed:
            table = f"pulse_write_{uuid.uuid4().hex}"
            (
                df.repartition(state["buckets"], "movie_id")
                .write.format("parquet").option("path", path)
                .partitionBy(layout.partition).bucketBy(state["buckets"], "movie_id").sortBy(*layout.key)
                .saveAsTable(table)
            )
            self.spark.sql(f"DROP TABLE {table}")  # the files stay
        else:
            df.write.partitionBy(layout.partition).parquet(path)
        held = state["tables"].setdefault(name, {"parts": {}, "schema": df.schema.jsonValue()})
        held["schema"] = df.schema.jsonValue()
        parts = {} if whole else {v: f for v, f in held["parts"].items() if v not in gone}
        fs, p = self._fs_path(path)
        prefix = f"{layout.partition}="
        for st in fs.listStatus(p):
            if st.getPath().getName().startswith(prefix):
                parts[st.getPath().getName()[len(prefix) :]] = folder
        held["parts"] = parts

    def replace(self, name: str, df: DataFrame, partition_by: Sequence[str] = (), sort_by: Sequence[str] = (), counter: Observation | None = None) -> str:
        """The whole table anew; the layout is the table's, whatever the arguments say."""
        with self.run():
            rows = self._placed(name, df)
            self._write(name, rows.observe(counter, F.count(F.lit(1)).alias("rows")) if counter else rows, (), True)
        return f"{self.root}/{name}"

    def overwrite_partitions(self, name: str, rows: DataFrame, partition_by: Sequence[str], sort_by: Sequence[str] = (), reads_target: bool = True, counter: Observation | None = None) -> str:
        """The partitions present in ``rows`` anew; nothing that is read is overwritten."""
        with self.run():
            placed = self._placed(name, rows)
            self._write(name, placed.observe(counter, F.count(F.lit(1)).alias("rows")) if counter else placed, (), False)
        return f"{self.root}/{name}"

    def merge(self, name: str, rows: DataFrame) -> dict[str, int]:
        """Upsert: a row replaces the stored row of its key. Keys of ``rows`` are unique.

        Only partitions with an incoming key are read and written, each once:
        a full outer join on the key says of every row what happens to it, and
        the counts are observed while it is written. Columns that the table
        does not have are added (null in other rows); columns that ``rows``
        lack are null in the rows it replaces.
        """
        layout = LAYOUTS[name]
        with self.run():
            new = self.stage(self._placed(name, rows), name)
            touched = [r[0] for r in new.select(layout.partition).distinct().collect()]  # months or buckets
            if not touched:
                return {"replaced": 0, "inserted": 0, "kept": 0}
            old = self._table(name).where(F.col(layout.partition).isin(touched))
            kinds = {f.name: f.dataType for f in [*old.schema.fields, *new.schema.fields] if f.name != layout.partition}
            kinds = {f.name: f.dataType for f in old.schema.fields if f.name != layout.partition} | {k: v for k, v in kinds.items() if k not in old.columns}
            both = old.select(*layout.key, F.struct(*(f"`{c}`" for c in old.columns)).alias("old")).join(
                new.select(*layout.key, F.struct(*(f"`{c}`" for c in new.columns)).alias("new")), list(layout.key), "full_outer"
            )
            is_new, is_old = F.col("new").isNotNull(), F.col("old").isNotNull()

            def field(side: str, have: list[str], c: str, kind: T.DataType) -> Column:
                return F.col(side)[c].cast(kind) if c in have else F.lit(None).cast(kind)

            columns = [F.when(is_new, field("new", new.columns, c, k)).otherwise(field("old", old.columns, c, k)).alias(c) for c, k in kinds.items()]
            value = F.coalesce(F.col("new")[layout.partition], F.col("old")[layout.partition]).alias(layout.partition)
            action = F.when(~is_old, "inserted").when(~is_new, "kept").otherwise("replaced")
            counter = Observation(f"{name}-{uuid.uuid4().hex[:8]}")
            counts = [F.count_if(F.col("_action") == a).alias(a) for a in ("replaced", "inserted", "kept")]
            merged = both.select(*columns, value, action.alias("_action")).observe(counter, *counts).drop("_action")
            self._write(name, merged, [str(v) for v in touched], False)
            return {a: int(n) for a, n in counter.get.items()}

    def vacuum(self, name: str, keep: int = 2) -> list[str]:
        """Old folders go when a run commits."""
        return []


def iso(value: str | None) -> _dt.date | None:
    return _dt.date.fromisoformat(value) if value else None
