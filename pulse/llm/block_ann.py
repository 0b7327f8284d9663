"""Approximate nearest neighbours: a block matrix join on int8 tiles with exact bounds.

Vectors are packed into blocks; every query block meets every candidate block
once (a stated query set against all rows). In a tile, products of int8
vectors give an inner product for each pair and, from the quantisation
residuals' norms (Cauchy-Schwarz), a bound on its error. Pairs whose upper
bound stays below the k-th best lower bound cannot be among the k nearest and
go; the rest are computed again in double precision on the original vectors
and merged into the query's heap. The result is exact: the bounds never drop
a true neighbour.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pulse.llm.frames import n_parts, prepare, stored


@dataclass(frozen=True)
class BlockAnn:
    neighbours: int = 20
    query_block: int = 1024
    candidate_block: int = 8192


def usable(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """(vec_id, embedding) of the vectors that take part: id and vector not
    null, all components finite, not all zero. Of several vectors with one id the least
    (by its components in order) stands for all."""
    v = vectors.select(F.col(vec_id).cast("bigint").alias("vec_id"), F.col(embedding).alias("embedding"))
    v = v.where("vec_id IS NOT NULL AND embedding IS NOT NULL")
    finite = F.forall("embedding", lambda x: F.coalesce((F.abs(x) < F.lit(float("inf"))) & ~F.isnan(x.cast("double")), F.lit(False)))
    v = v.where(finite & F.exists("embedding", lambda x: x != 0))
    return v.groupBy("vec_id").agg(F.min("embedding").alias("embedding"))


def _kind(vectors: DataFrame):
    return np.float32 if vectors.schema["embedding"].dataType.elementType.typeName() == "float" else np.float64


_PACK_DDL = "block bigint, dims int, ids binary, data binary"
_PACK = pa.schema([("block", pa.int64()), ("dims", pa.int32()), ("ids", pa.binary()), ("data", pa.binary())])


def _packed(vectors: DataFrame, rows: int) -> DataFrame:
    """Blocks of at most ``rows`` vectors of one dimension: ids (int64) and components
    (float for vectors of floats, else double)."""
    n = vectors.count()
    blocks = max(1, -(-n // rows))
    kind = _kind(vectors)

    def pack(ids, dims, vecs):
        for a in range(0, len(ids), rows):
            yield dims, np.array(ids[a : a + rows], np.int64).tobytes(), np.concatenate(vecs[a : a + rows]).astype(kind).tobytes()

    def run(batches):
        now, ids, vecs = None, [], []

        def done():
            for d, i, x in pack(ids, now[1], vecs):
                yield pa.record_batch([pa.array([now[0]], pa.int64()), pa.array([d], pa.int32()), pa.array([i]), pa.array([x])], schema=_PACK)

        for batch in batches:
            keys = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
            values = batch.column(3)
            offsets = values.offsets.to_numpy()
            flat = values.values.to_numpy(zero_copy_only=False)
            for i, (key, vec_id) in enumerate(zip(keys, batch.column(2).to_pylist())):
                if key != now or len(ids) >= rows:
                    if ids:
                        yield from done()
                    now, ids, vecs = key, [], []
                ids.append(vec_id)
                vecs.append(flat[offsets[i] : offsets[i + 1]])
        if ids:
            yield from done()

    # about ``rows`` vectors have one block number; a fuller one is packed as several rows
    keyed = vectors.select(F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).alias("block"), F.size("embedding").alias("dims"), "vec_id", "embedding")
    keyed = keyed.repartition(min(blocks, n_parts(vectors.sparkSession)), "block").sortWithinPartitions("block", "dims")
    return keyed.mapInArrow(run, _PACK_DDL)


class Side:
    """The vectors of a block: double, quantised to int8, and the residuals' norms."""

    def __init__(self, ids: np.ndarray, x: np.ndarray) -> None:
        self.ids, self.x = ids, x.astype(np.float64)
        scale = np.abs(self.x).max(axis=1) / 127
        self.q = np.rint(self.x / scale[:, None]).astype(np.int8)
        self.scale = scale
        back = self.q * scale[:, None]
        self.rest = np.linalg.norm(self.x - back, axis=1)
        self.norm = np.linalg.norm(self.x, axis=1)
        self.norm_q = np.linalg.norm(back, axis=1)


def unpacked(dims: int, ids: bytes, data: bytes, kind) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(ids, np.int64), np.frombuffer(data, kind).reshape(-1, dims)


def int8_product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer products of int8 rows: float32 sums stay below 2**24 for 1000 dimensions at a time."""
    if a.shape[1] <= 1000:
        return a.astype(np.float32) @ b.astype(np.float32).T
    out = np.zeros((len(a), len(b)))
    for d in range(0, a.shape[1], 1000):
        out += a[:, d : d + 1000].astype(np.float32) @ b[:, d : d + 1000].astype(np.float32).T
    return out


def ordered_product(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Row-wise inner products, summed component by component from the first to the last."""
    out = np.zeros(len(x))
    for d in range(x.shape[1]):
        out += x[:, d] * y[:, d]
    return out


def _slack(query: Side, other: Side, i, j) -> np.ndarray:
    """How far the int8 products of queries ``i`` and candidates ``j`` may be from the inner products."""
    slack = query.rest[i] * other.norm[j] + query.norm_q[i] * other.rest[j]
    return slack + 1e-9 * (query.norm[i] * other.norm[j] + 1e-300)  # rounding of the float64 terms


def tile(query: Side, other: Side, least: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query row, candidate row, score) of the pairs that may be among the k nearest.

    ``least``: for each query a score that k candidates are known to reach.
    """
    if len(other.ids) > k and not np.isfinite(least).all():
        low = int8_product(query.q, other.q) * query.scale[:, None] * other.scale
        low -= _slack(query, other, np.s_[:, None], np.s_[None, :])
        low[query.ids[:, None] == other.ids] = -np.inf
        least = np.maximum(least, np.partition(low, low.shape[1] - k, axis=1)[:, -k])
    # First by the tile's widest slack of each query, in single precision with room for its rounding.
    most_norm = other.norm.max()
    wide = query.rest * most_norm + query.norm_q * other.rest.max() + 1e-5 * query.norm * most_norm + 1e-300
    with np.errstate(over="ignore", under="ignore", invalid="ignore"):
        near = int8_product(query.q, other.q) * (other.scale / other.scale.max()).astype(np.float32)
        reach = ((least - wide) / query.scale / other.scale.max()).astype(np.float32)
    i, j = np.nonzero(~(near < reach[:, None]))
    near = np.einsum("ij,ij->i", query.q[i], other.q[j], dtype=np.float64) * query.scale[i] * other.scale[j]
    keep = (near + _slack(query, other, i, j) >= least[i]) & (query.ids[i] != other.ids[j])
    i, j = i[keep], j[keep]
    return i, j, ordered_product(query.x[i], other.x[j])


def merge_heaps(best: tuple, i: np.ndarray, ids: np.ndarray, score: np.ndarray, n: int, k: int) -> tuple:
    """The k best (score, smaller id first) of each query from what it had and the new pairs."""
    q, v, s = (np.concatenate(x) for x in zip(best, (i, ids, score)))
    order = np.lexsort((v, -s, q))
    q, v, s = q[order], v[order], s[order]
    start = np.searchsorted(q, np.arange(n))
    keep = np.arange(len(q)) - start[q] < k
    return q[keep], v[keep], s[keep]


_HIT_DDL = "query_id bigint, vec_id bigint, score double"
_HIT = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])


TILE = 2048  # candidates multiplied at a time
CELL_BYTES = 32 << 20  # candidate blocks that a join keeps while queries pass by
OPEN = 64  # query blocks whose heaps a task holds before it passes them on


def _tiles(pairs: DataFrame, k: int, q_kind, c_kind) -> DataFrame:
    """Each query's k best of the candidate blocks that one task sees."""

    def run(batches):
        heaps = {}  # query block -> (its side, best pairs, score known to be reached)

        def done():
            for query, (q, v, s), _ in heaps.values():
                yield pa.record_batch([pa.array(query.ids[q]), pa.array(v), pa.array(s)], schema=_HIT)
            heaps.clear()

        for batch in batches:
            for dims, q_ids, q_data, c_ids, c_data in zip(*(c.to_pylist() for c in batch.columns)):
                if (dims, q_ids) not in heaps:
                    if len(heaps) >= OPEN:
                        yield from done()
                    query = Side(*unpacked(dims, q_ids, q_data, q_kind))
                    heaps[dims, q_ids] = (query, (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)), np.full(len(query.ids), -np.inf))
                query, best, least = heaps[dims, q_ids]
                n = len(query.ids)
                ids, x = unpacked(dims, c_ids, c_data, c_kind)
                for a in range(0, len(ids), TILE):
                    other = Side(ids[a : a + TILE], x[a : a + TILE])
                    i, j, score = tile(query, other, least, k)
                    best = merge_heaps(best, i, other.ids[j], score, n, k)
                    worst = np.full(n, np.inf)
                    np.minimum.at(worst, best[0], best[2])
                    least = np.where(np.bincount(best[0], minlength=n) >= k, worst, -np.inf)
                heaps[dims, q_ids] = (query, best, least)
        yield from done()

    return pairs.mapInArrow(run, _HIT_DDL)


def nearest(vectors: DataFrame, queries: DataFrame, p: BlockAnn = BlockAnn()) -> DataFrame:
    """(query_id, rank, vec_id, score): for each query its ``neighbours`` nearest vectors by
    largest inner product, ties to the smaller vec_id, its own id left out.

    ``vectors`` and ``queries`` come from ``usable``. Vectors of different
    dimensions do not meet; an empty side gives an empty table.
    """
    spark = vectors.sparkSession
    prepare(spark)
    candidates = stored(_packed(vectors, p.candidate_block), "ann-candidates")
    asked = stored(_packed(queries, p.query_block), "ann-queries")
    last, widest = candidates.agg(F.max("block"), F.max(F.octet_length("ids") + F.octet_length("data"))).first()
    if last is None:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    # Neighbouring blocks are a cell, and every query goes to each cell once: three cells a task
    # slot, or as many as ``CELL_BYTES`` asks for.
    cells = max(3 * spark.sparkContext.defaultParallelism, -(-(last + 1) * widest // CELL_BYTES))
    per_cell = -(-(last + 1) // cells)
    c = candidates.select(F.floor(F.col("block") / per_cell).alias("cell"), "dims", F.col("ids").alias("c_ids"), F.col("data").alias("c_data"))
    q = asked.select("dims", F.col("ids").alias("q_ids"), F.col("data").alias("q_data"))
    q = q.withColumn("cell", F.explode(F.sequence(F.lit(0), F.lit(last // per_cell)).cast("array<bigint>")))
    # The size that Spark states for a repeated side is that of one repetition: without
    # a hint it would be sent through the driver.
    tiles = q.hint("merge").join(c, ["cell", "dims"]).select("dims", "q_ids", "q_data", "c_ids", "c_data")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 4)  # a row is a pair of blocks
    hits = stored(_tiles(tiles, p.neighbours, _kind(queries), _kind(vectors)), "ann-hits")
    prepare(spark)
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return hits.withColumn("rank", rank).where(F.col("rank") <= p.neighbours).select("query_id", "rank", "vec_id", "score")
