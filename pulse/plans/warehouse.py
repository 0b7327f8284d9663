"""Tables stored as Parquet folders under one root, with copy-on-write replacement.

Plain Parquet has no DELETE or MERGE. A table is a folder of versions
``<root>/<name>/v=<n>``; ``replace`` writes the number after the highest
folder there is, committed or not, and readers always take the newest version
that has a ``_SUCCESS`` marker. A job that dies mid-write leaves the previous
version in force and blocks nobody; ``vacuum`` removes what it left. Fact
tables are partitioned by date and updated in place with dynamic partition
overwrite, which replaces only the partitions present in the written rows;
those rows are first staged under the shared checkpoint folder so a partition
is never overwritten by a plan that is still reading it.

What is guaranteed: a replaced version becomes visible as a whole. A partition
overwrite is not one commit: a reader of the same version that is in mid-scan
may fail on a file that was replaced and has to start again, and a job that
dies between two partitions leaves some of them new. Running the job for that
date again puts both right (every partition is written whole).

Tables are read with their declared schema (``schemas.TABLES``) plus the
columns that a writer added, which a version lists in ``_added_columns``; no
footer is read for it, and a table without rows or partitions can be read.

File-system calls go through the Hadoop ``FileSystem`` of the session, so the
same code works on a local disk or on shared cluster storage.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulse import schemas
from pulse.session import scratch_path


def _cluster(df: DataFrame, partition_by: Sequence[str], sort_by: Sequence[str]) -> DataFrame:
    """Lay rows out for a partitioned write.

    Range partitioning on (partition columns, sort columns) gives each writer
    task a contiguous slice: a date partition is written as a few files
    clustered by ``movie_id`` instead of one file per input split, and a very
    large (or hot) date is split across several tasks by ``movie_id`` rather
    than landing in one task as a hash partitioning on the date would.
    """
    keys = list(partition_by) + [c for c in sort_by if c not in partition_by]
    out = df.repartitionByRange(*keys) if partition_by else df
    return out.sortWithinPartitions(*keys) if keys else out


def _counted(df: DataFrame, counter: Observation | None) -> DataFrame:
    if counter is None:
        return df
    return df.observe(counter, F.count(F.lit(1)).alias("rows"))


class Warehouse:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    @contextmanager
    def run(self) -> Iterator[Warehouse]:
        """The writes of one job (each commits on its own here; see ``runs.RunStore``)."""
        yield self

    # -- file system -------------------------------------------------------
    def _fs_path(self, path: str):
        jvm = self.spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        fs = p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        return fs, p

    def _folders(self, name: str) -> dict[int, bool]:
        """Version numbers that have a folder, and whether the version is committed."""
        fs, p = self._fs_path(f"{self.root}/{name}")
        if not fs.exists(p):
            return {}
        out = {}
        for st in fs.listStatus(p):
            base = st.getPath().getName()
            if base.startswith("v=") and base[2:].isdigit():
                done = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(st.getPath(), "_SUCCESS")
                out[int(base[2:])] = fs.exists(done)
        return out

    def _versions(self, name: str) -> list[int]:
        return sorted(v for v, committed in self._folders(name).items() if committed)

    def _text(self, path: str, content: str | None = None) -> str:
        """Read a small text file ('' if there is none), or write it."""
        jvm = self.spark.sparkContext._jvm
        fs, p = self._fs_path(path)
        if content is not None:
            out = fs.create(p, True)
            out.write(bytearray(content.encode()))
            out.close()
            return content
        if not fs.exists(p):
            return ""
        source = fs.open(p)
        try:
            return bytes(jvm.org.apache.commons.io.IOUtils.toByteArray(source)).decode()
        finally:
            source.close()

    def _added(self, path: str) -> T.StructType:
        text = self._text(f"{path}/_added_columns")
        return T.StructType.fromJson(json.loads(text)) if text else T.StructType([])

    def _note_added(self, name: str, path: str, df: DataFrame) -> None:
        """Remember columns of ``df`` that the declared schema does not have."""
        declared = schemas.TABLES.get(name)
        if declared is None:
            return
        known = self._added(path)
        names = {f.name for f in [*declared.fields, *known.fields]}
        new = [f for f in df.schema.fields if f.name not in names]
        if new:
            self._text(f"{path}/_added_columns", T.StructType([*known.fields, *new]).json())

    def vacuum(self, name: str, keep: int = 2) -> list[str]:
        """Delete all but the newest ``keep`` committed versions of a table, and what dead
        writers left below the current version.

        Keeping the previous version lets a reader that started before the
        last replace finish. Returns the removed paths.
        """
        if keep < 1:
            raise ValueError("keep at least the current version")
        removed = []
        folders = self._folders(name)
        committed = sorted(v for v, done in folders.items() if done)
        dead = [v for v, done in folders.items() if not done and committed and v < committed[-1]]
        for v in sorted([*committed[:-keep], *dead]):
            fs, p = self._fs_path(f"{self.root}/{name}/v={v}")
            fs.delete(p, True)
            removed.append(p.toString())
        return removed

    def partition_values(self, name: str, column: str) -> list[str]:
        """Values of a partition column, read from the directory names (no data scan)."""
        path = self.current_path(name)
        if path is None:
            return []
        fs, p = self._fs_path(path)
        prefix = f"{column}="
        return sorted(
            st.getPath().getName()[len(prefix):]
            for st in fs.listStatus(p)
            if st.isDirectory() and st.getPath().getName().startswith(prefix)
        )

    def current_path(self, name: str) -> str | None:
        v = self._versions(name)
        return f"{self.root}/{name}/v={v[-1]}" if v else None

    def exists(self, name: str) -> bool:
        return self.current_path(name) is not None

    # -- read / write ------------------------------------------------------
    def read(self, name: str, schema: T.StructType | None = None) -> DataFrame:
        """The current version, with the declared schema and added columns."""
        path = self.current_path(name)
        schema = schema or schemas.TABLES.get(name)
        if path is None:
            if schema is None:
                raise FileNotFoundError(f"table {name!r} has no committed version under {self.root}")
            return self.spark.createDataFrame([], schema)
        if schema is None:
            return self.spark.read.parquet(path)
        return self.spark.read.schema(T.StructType([*schema.fields, *self._added(path).fields])).parquet(path)

    def replace(
        self,
        name: str,
        df: DataFrame,
        partition_by: Sequence[str] = (),
        sort_by: Sequence[str] = (),
        counter: Observation | None = None,
    ) -> str:
        """Write ``df`` as the next version of ``name`` (readers switch when it commits).

        ``counter`` counts the written rows during the write itself; it is
        attached above the clustering exchange, so the sampling pass of the
        range partitioner does not count rows too.
        """
        path = f"{self.root}/{name}/v={max(self._folders(name), default=0) + 1}"
        out = _counted(_cluster(df, partition_by, sort_by), counter)
        w = out.write.mode("errorifexists")
        if partition_by:
            w = w.partitionBy(*partition_by)
        w.parquet(path)
        self._note_added(name, path, df)
        return path

    def stage(self, rows: DataFrame, name: str) -> DataFrame:
        """Write ``rows`` once under the shared checkpoint folder and read them back."""
        path = scratch_path(self.spark, f"stage-{name}")
        rows.write.mode("errorifexists").parquet(path)
        return self.spark.read.schema(rows.schema).parquet(path)

    def overwrite_partitions(
        self,
        name: str,
        rows: DataFrame,
        partition_by: Sequence[str],
        sort_by: Sequence[str] = (),
        reads_target: bool = True,
        counter: Observation | None = None,
    ) -> str:
        """Replace only the partitions present in ``rows`` (dynamic partition overwrite).

        When ``rows`` is computed from the target table itself it is staged in
        the shared checkpoint folder first, so no partition is rewritten by a
        plan that is still reading it; ``reads_target=False`` skips the stage.
        """
        target = self.current_path(name)
        if target is None:
            return self.replace(name, rows, partition_by, sort_by, counter)
        if reads_target:
            stage = scratch_path(self.spark, f"stage-{name}")
            _counted(rows, counter).write.mode("errorifexists").parquet(stage)
            rows, counter = self.spark.read.schema(rows.schema).parquet(stage), None
        staged = _counted(_cluster(rows, partition_by, sort_by), counter)
        (
            staged.write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(*partition_by)
            .parquet(target)
        )
        self._note_added(name, target, rows)
        return target
