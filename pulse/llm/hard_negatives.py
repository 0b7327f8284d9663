"""Hard-negative mining: coordinate pruning in buckets of vectors of like length.

For each anchor its positives are the first rows of its label by inner
product, and a positive's negatives the first rows of other labels whose
score lies in a band below the positive's. Both are searches for all rows
over a threshold that rises as better rows are found.

Vectors are dealt by range of length into buckets. A bucket keeps, for each
coordinate, the list of its rows sorted by that coordinate of the normed
vector. To reach a score of at least t, a row of a bucket whose longest
vector has length l must have a cosine of t / (|anchor| * l) or more with the
anchor; a bucket that would need more than 1 is passed over. In the others
that cosine gives each coordinate a feasible range. The ranges of the
anchor's focus coordinates (its largest ones) are cut out of the sorted lists
and intersected, and what is left is verified by the exact integer product.

Buckets are grouped into shards of bounded size, each with long and short
ones, and every block of anchors meets every shard (a stated query set
against all rows). A task holds one shard and streams the anchors past it,
longest bucket first, so thresholds rise early; what each shard found, at
most a handful a search, is merged by a window over the anchor.
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
class Mining:
    positives: int = 5
    negatives: int = 5
    #: A negative's score in percent of the positive's: least and most.
    low: int = 80
    high: int = 100
    #: Coordinates of an anchor whose ranges are intersected.
    focus: int = 6
    bucket_rows: int = 4096  # at most 65536: places in a bucket are 16 bits
    anchor_rows: int = 256
    shard_buckets: int = 8


#: Vectors whose squared length reaches this take no part: the products of all others fit into a long.
TOO_LONG = float(2**62)


def usable(vectors: DataFrame, vec_id: str = "vec_id", label: str = "label", embedding: str = "embedding", scale: float = 256.0) -> DataFrame:
    """(vec_id, label, embedding) of the rows that take part, components as ``floor(scale * x)``.

    Rows with a null id, label or vector, or a null or non-finite component,
    take no part, nor do vectors too long for their products to fit into a
    long. Of several rows with one id the least (label, vector) stands for all.
    """
    v = vectors.select(F.col(vec_id).cast("bigint").alias("vec_id"), F.col(label).cast("bigint").alias("label"), F.col(embedding).alias("embedding"))
    finite = F.forall("embedding", lambda x: F.coalesce((F.abs(x) < F.lit(float("inf"))) & ~F.isnan(x.cast("double")), F.lit(False)))
    v = v.where("vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL").where(finite)
    v = v.withColumn("embedding", F.transform("embedding", lambda x: F.floor(F.lit(scale) * x.cast("double"))))
    v = v.where(_square("embedding") < TOO_LONG)
    return v.groupBy("vec_id").agg(F.min(F.struct("label", "embedding")).alias("v")).select("vec_id", "v.label", "v.embedding")


def _square(column: str):
    return F.aggregate(column, F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))


def _matrix(column: pa.ListArray) -> np.ndarray:
    """Rows of one dimension as integers of the smallest type that holds them."""
    x = column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)
    most = int(np.abs(x).max()) if x.size else 0
    return x.astype(np.int16 if most < 2**15 else np.int32 if most < 2**31 else np.int64)


def normed(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(vectors of length 1, lengths); a zero vector stays."""
    y = x.astype(np.float64)
    length = np.sqrt((y * y).sum(axis=1))
    return y / np.where(length > 0, length, 1.0)[:, None], length


_ROW_DDL = "dims int, width int, longest double, serial int, ids binary, labels binary, data binary, more binary"
_ROW = pa.schema([("dims", pa.int32()), ("width", pa.int32()), ("longest", pa.float64()), ("serial", pa.int32()), ("ids", pa.binary()), ("labels", pa.binary()), ("data", pa.binary()), ("more", pa.binary())])


def _packed(rows: DataFrame, most: int, more) -> DataFrame:
    """Neighbouring rows (vec_id, label, embedding, ...) of one dimension, at most ``most``, as
    one; ``more`` makes bytes of a matrix and the batch of its rows."""

    def run(batches):
        held, count, dims, serial = [], 0, None, 0

        def done():
            table = pa.Table.from_batches(held).combine_chunks()
            x = _matrix(table.column("embedding").combine_chunks() if table.num_rows else held[0].column("embedding"))
            ids, labels = (table.column(c).to_numpy().astype(np.int64) for c in ("vec_id", "label"))
            longest = float(normed(x)[1].max())
            values = [dims, x.dtype.itemsize, longest, serial, ids.tobytes(), labels.tobytes(), x.tobytes(), more(x, table)]
            return pa.record_batch([pa.array([v], f.type) for v, f in zip(values, _ROW)], schema=_ROW)

        for batch in batches:
            sizes = np.diff(batch.column("embedding").offsets.to_numpy())
            at = 0
            while at < batch.num_rows:
                if count and (sizes[at] != dims or count >= most):
                    yield done()
                    held, count, serial = [], 0, serial + 1
                dims = int(sizes[at])
                same = np.flatnonzero(sizes[at:] != dims)
                end = min(at + (int(same[0]) if len(same) else batch.num_rows - at), at + most - count)
                held.append(batch.slice(at, end - at))
                count += end - at
                at = end
        if count:
            yield done()

    return rows.mapInArrow(run, _ROW_DDL)


def _lists(x: np.ndarray, _) -> bytes:
    """For each coordinate the places of the rows, sorted by the normed coordinate."""
    unit, _ = normed(x)
    return np.argsort(unit, axis=0, kind="stable").T.astype(np.uint16).tobytes()


def _bars(p: Mining):
    """Ids and scores of the anchors' positives; a missing one has the score -1."""

    def more(x, table):
        out = np.full((2, len(x), p.positives), -1, np.int64)
        for i, found in enumerate(table.column("found").to_pylist()):
            for j, f in enumerate(found):
                out[:, i, j] = f["vec_id"], f["score"]
        return out.tobytes()

    return more


class Rows:
    """A packed row's ids, labels and vectors."""

    def __init__(self, row: dict) -> None:
        self.ids, self.labels = np.frombuffer(row["ids"], np.int64), np.frombuffer(row["labels"], np.int64)
        self.dims = row["dims"]
        self.x = np.frombuffer(row["data"], f"i{row['width']}").reshape(len(self.ids), self.dims)
        self.longest, self.more = row["longest"], row["more"]


class Bucket(Rows):
    """Vectors of like length with their sorted coordinate lists."""

    def __init__(self, row: dict) -> None:
        super().__init__(row)
        unit, _ = normed(self.x)
        self.places = np.frombuffer(self.more, np.uint16).reshape(self.dims, len(self.ids))
        self.values = np.take_along_axis(unit.T, self.places.astype(np.int64), axis=1)
        self.wide = self.x.astype(np.float64 if self.longest < 2**26 else np.int64)

    def feasible(self, unit: np.ndarray, length: float, least: float, focus: np.ndarray) -> np.ndarray | None:
        """Places of the rows that may score ``least`` or more with an anchor (``unit`` * ``length``);
        None stands for all."""
        if least <= 0:
            return None
        if length * self.longest == 0 or least > length * self.longest * (1 + 1e-9):
            return np.zeros(0, np.int64)
        cosine = min(1.0, least / (length * self.longest))
        spread = np.sqrt(np.maximum(0.0, (1 - unit[focus] ** 2) * (1 - cosine**2)))
        low = np.where(unit[focus] < -cosine, -1.0, unit[focus] * cosine - spread) - 1e-7
        high = np.where(unit[focus] > cosine, 1.0, unit[focus] * cosine + spread) + 1e-7
        cuts = []
        for f, a, b in zip(focus.tolist(), low, high):
            i, j = np.searchsorted(self.values[f], [a, b])
            cuts.append((j - i, f, i, j))
        cuts.sort()
        _, f, i, j = cuts[0]
        left = self.places[f, i:j].astype(np.int64)
        for n, f, i, j in cuts[1:]:
            if not len(left) or n == len(self.ids):
                break
            inside = np.zeros(len(self.ids), bool)
            inside[self.places[f, i:j]] = True
            left = left[inside[left]]
        return left

    def scores(self, at: np.ndarray, anchor: np.ndarray, length: float) -> np.ndarray:
        """Exact products with the rows at these places."""
        if self.wide.dtype == np.float64 and length * self.longest < 2**52:
            return (self.wide[at] @ anchor.astype(np.float64)).astype(np.int64)
        return self.x[at].astype(np.int64) @ anchor.astype(np.int64)


class Best:
    """The first ``k`` (score, then smaller id) of what was offered."""

    def __init__(self, k: int, floor: int, ceiling: int) -> None:
        self.k, self.floor, self.ceiling = k, floor, ceiling
        self.score, self.ids = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def offer(self, score: np.ndarray, ids: np.ndarray) -> None:
        fit = (score >= self.floor) & (score <= self.ceiling)
        if not fit.any():
            return
        score, ids = np.append(self.score, score[fit]), np.append(self.ids, ids[fit])
        order = np.lexsort((ids, -score))[: self.k]
        self.score, self.ids = score[order], ids[order]
        if len(order) == self.k:
            self.floor = max(self.floor, int(self.score[-1]))


_NONE, _ALL = -(2**63), 2**63 - 1
_FOUND_DDL = "anchor_id bigint, positive_id bigint, positive_score bigint, vec_id bigint, score bigint"
_FOUND = pa.schema([(x.split()[0], pa.int64()) for x in _FOUND_DDL.split(", ")])


def _search(buckets: list[Bucket], block: Rows, p: Mining, negatives: bool):
    """What the buckets hold for a block of anchors: rows of ``_FOUND``."""
    unit, length = normed(block.x)
    bars = np.frombuffer(block.more, np.int64).reshape(2, len(block.ids), -1) if negatives else None
    out = []
    for i, anchor in enumerate(block.ids.tolist()):
        if negatives:
            pairs = [(int(a), int(s)) for a, s in bars[:, i].T if s >= 0]
            best = [Best(p.negatives, -(-p.low * s // 100), p.high * s // 100) for _, s in pairs]
        else:
            pairs, best = [(None, None)], [Best(p.positives, _NONE, _ALL)]
        if not best:
            continue
        focus = np.argsort(-np.abs(unit[i]), kind="stable")[: p.focus]
        for bucket in buckets:
            if bucket.dims != block.dims:
                continue
            at = bucket.feasible(unit[i], length[i], float(min(b.floor for b in best)), focus)
            same = (bucket.labels if at is None else bucket.labels[at]) == block.labels[i]
            at = np.flatnonzero(same != negatives) if at is None else at[same != negatives]
            at = at[bucket.ids[at] != anchor]
            if len(at):
                score = bucket.scores(at, block.x[i], length[i])
                for b in best:
                    b.offer(score, bucket.ids[at])
        for (positive, bar), b in zip(pairs, best):
            out += [(anchor, positive, bar, v, s) for v, s in zip(b.ids.tolist(), b.score.tolist())]
    return out


def _searched(buckets: DataFrame, anchors: DataFrame, p: Mining, negatives: bool) -> DataFrame:
    """Each shard's finds for each anchor."""
    spark = buckets.sparkSession
    parts, count = n_parts(spark), buckets.count()
    shards = max(1, -(-count // p.shard_buckets), min(count, parts))
    columns = ["dims", "width", "longest", "ids", "labels", "data", "more"]
    # neighbouring buckets, of like length, go to different shards
    held = buckets.select(F.pmod(F.col("part") + F.col("serial"), F.lit(shards)).alias("shard"), F.lit(0).alias("kind"), *columns)
    asked = anchors.select(F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"), F.lit(1).alias("kind"), *columns)
    dealt = held.unionByName(asked).repartitionById(parts, F.col("shard")).sortWithinPartitions("shard", "kind", F.desc("longest"))

    def run(batches):
        shard, own = None, []
        for batch in batches:
            for row in batch.to_pylist():
                if row["shard"] != shard:
                    shard, own = row["shard"], []
                if row["kind"] == 0:
                    own.append(Bucket(row))
                    continue
                found = _search(own, Rows(row), p, negatives)
                if found:
                    yield pa.record_batch([pa.array(c, pa.int64()) for c in zip(*found)], schema=_FOUND)

    return dealt.mapInArrow(run, _FOUND_DDL)


def mine(vectors: DataFrame, anchors: DataFrame, p: Mining = Mining()) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    ``vectors`` and ``anchors`` come from ``usable`` (anchors: rows of
    ``vectors``). An anchor's positives are its first other rows of its
    label; a pair's negatives the first rows of other labels that score at
    least ``low`` and at most ``high`` percent of the positive; higher scores
    first, ties by smaller vec_id. Vectors of different dimensions do not
    meet. An anchor without positives, a pair without negatives (such as one
    of a negative score) and an empty side give no rows.
    """
    spark = vectors.sparkSession
    prepare(spark)
    sized = vectors.withColumn("square", _square("embedding")).withColumn("dims", F.size("embedding")).where("dims > 0")
    order = ["dims", F.desc("square"), "vec_id"]  # the id parts equal vectors
    count = sized.count()
    parts = max(1, min(n_parts(spark), -(-count // 512)))
    dealt = sized.repartitionByRange(parts, *order).sortWithinPartitions(*order).select("vec_id", "label", "embedding")
    buckets = stored(_packed(dealt, p.bucket_rows, _lists).withColumn("part", F.spark_partition_id()), "mining-buckets")

    def blocks(rows, more, name):
        rows = rows.repartition(max(1, min(n_parts(spark), -(-count // p.bucket_rows))), "vec_id").sortWithinPartitions(F.size("embedding"), "vec_id")
        return stored(_packed(rows, p.anchor_rows, more), name)

    first = blocks(anchors.where(F.size("embedding") > 0).select("vec_id", "label", "embedding"), lambda x, _: b"", "mining-anchors")
    found = stored(_searched(buckets, first, p, False).select("anchor_id", "vec_id", "score"), "mining-found")
    place = F.row_number().over(Window.partitionBy("anchor_id").orderBy(F.desc("score"), "vec_id"))
    best = found.withColumn("place", place).where(F.col("place") <= p.positives)
    best = best.groupBy("anchor_id").agg(F.array_sort(F.collect_list(F.struct("place", "vec_id", "score"))).alias("found"))
    rows = anchors.join(best, anchors["vec_id"] == best["anchor_id"]).select("vec_id", "label", "embedding", "found")
    found = stored(_searched(buckets, blocks(rows, _bars(p), "mining-pairs"), p, True), "mining-negatives")
    place = F.row_number().over(Window.partitionBy("anchor_id", "positive_id").orderBy(F.desc("score"), "vec_id"))
    out = found.withColumn("rank", place).where(F.col("rank") <= p.negatives)
    return out.select("anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
