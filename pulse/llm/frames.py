"""Small Spark helpers shared by the operators."""

from __future__ import annotations

import os
from collections.abc import Iterable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulse.session import scratch_path

ROOT = str(Path(__file__).resolve().parents[2])

#: Rows and bytes that one Arrow batch may hold: a task keeps one batch in memory.
BATCH_ROWS = 2000
BATCH_BYTES = 8 << 20


def prepare(spark: SparkSession) -> None:
    """Bound the Arrow batches of this session (long texts would otherwise come 10,000 at a time),
    and let Python workers find this package where the driver found it (a cluster whose nodes do
    not share that folder gets it with ``--py-files``)."""
    env = spark.sparkContext.environment
    if ROOT not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(x for x in (env.get("PYTHONPATH"), ROOT) if x)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared scratch folder and read back: it cuts the lineage,
    and tasks lost later read the files again instead of running the plan again."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def free_names(df: DataFrame, *names: str) -> list[str]:
    """The names, each with as many underscores after it as make it no column of ``df``."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def n_parts(spark: SparkSession) -> int:
    """How many partitions the session gives a shuffle; blocks of work follow it."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def batches_of(schema: pa.Schema, columns: list, rows: int = 50_000) -> Iterator[pa.RecordBatch]:
    """Columns of equal length as record batches of at most ``rows`` rows."""
    n = len(columns[0])
    for i in range(0, n, rows):
        part = [c[i : i + rows] for c in columns]
        yield pa.record_batch([pa.array(c, type=f.type) for c, f in zip(part, schema)], schema=schema)


def split_by(key: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(order, starts, ends): ``order[starts[i]:ends[i]]`` are the places of the i-th distinct key."""
    order = np.argsort(key, kind="stable")
    sorted_ = key[order]
    cut = np.flatnonzero(sorted_[1:] != sorted_[:-1]) + 1 if len(key) else np.zeros(0, np.int64)
    starts = np.concatenate([[0], cut]).astype(np.int64) if len(key) else cut
    return order, starts, np.append(starts[1:], len(key)).astype(np.int64)[: len(starts)]


def pack_blocks(block: np.ndarray, fields: Iterable[np.ndarray], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """One row (block, data) for each block: its rows' fields, one column after the other."""
    fields = list(fields)
    order, starts, ends = split_by(block)
    fields = [f[order] for f in fields]
    ids, data = [], []
    size = 0
    for s, e in zip(starts, ends):
        ids.append(int(block[order[s]]))
        data.append(b"".join(f[s:e].tobytes() for f in fields))
        size += len(data[-1])
        if size >= BATCH_BYTES // 2:
            yield pa.record_batch([pa.array(ids, pa.int32()), pa.array(data, pa.binary())], schema=schema)
            ids, data, size = [], [], 0
    if ids:
        yield pa.record_batch([pa.array(ids, pa.int32()), pa.array(data, pa.binary())], schema=schema)


BLOCK_SCHEMA = pa.schema([("block", pa.int32()), ("data", pa.binary())])
BLOCK_DDL = "block int, data binary"


def unpack(data: bytes, kinds: list) -> list[np.ndarray]:
    """The columns that ``pack_blocks`` joined."""
    width = sum(np.dtype(k).itemsize for k in kinds)
    n, at, out = len(data) // width, 0, []
    for k in kinds:
        out.append(np.frombuffer(data, dtype=k, count=n, offset=at))
        at += n * np.dtype(k).itemsize
    return out


def grouped_blocks(batches: Iterator[pa.RecordBatch], kinds: list) -> Iterator[tuple[int, list[np.ndarray]]]:
    """Whole blocks from rows (block, data) that come sorted by block."""
    now, held = None, []

    def joined():
        return [np.concatenate(x) for x in zip(*held)]

    for batch in batches:
        for block, data in zip(batch.column(0).to_pylist(), batch.column(1)):
            if block != now:
                if held:
                    yield now, joined()
                now, held = block, []
            held.append(unpack(data.as_buffer(), kinds))
    if held:
        yield now, joined()


def to_blocks(packed: DataFrame, sub: int) -> DataFrame:
    """Rows (block, data) with each block whole in one task, blocks one after the other.

    Block b goes to partition b // sub, so a task reads ``sub`` blocks and
    keeps one of them in memory.
    """
    spark = packed.sparkSession
    return packed.repartitionById(n_parts(spark), (F.col("block") / sub).cast("int")).sortWithinPartitions("block")


class Forest:
    """Union-find over 0..n-1; the root of a set is its smallest member."""

    def __init__(self, n: int) -> None:
        self.parent = list(range(n))

    def find(self, x: int) -> int:
        p = self.parent
        while p[x] != x:
            p[x] = p[p[x]]
            x = p[x]
        return x

    def join(self, a: int, b: int) -> None:
        a, b = self.find(a), self.find(b)
        if a != b:
            self.parent[max(a, b)] = min(a, b)

    def roots(self) -> np.ndarray:
        return np.array([self.find(i) for i in range(len(self.parent))], dtype=np.int64)
