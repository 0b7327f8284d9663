"""Quality classifier: nearest-neighbour voting over latent-semantic vectors.

A document's terms are its byte trigrams (hashed to ``buckets``) and a few
terms that count its shape: character classes, repeated passages, distinct
and doubled words, word length. Term weights (damped counts times inverse document
frequency) of a bounded sample of labelled documents give a latent-semantic
space by singular value decomposition. The sample's vectors are broadcast;
every document is compared with all of them in blocks of exact cosine
products, and its ``neighbours`` nearest vote with weights that grow with
similarity.

The sample is bounded by ``per_label`` documents for each label, those with
the smallest hash of their doc_id.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from pulse.llm.frames import prepare
from pulse.llm.quality_rules import count_block
from pulse.llm.text import U64, Block, blocks, find_words

SHAPE_TERMS = 16


@dataclass(frozen=True)
class QualityKnn:
    #: Labelled documents that the classifier is fitted on, for each label.
    per_label: int = 2500
    buckets: int = 2048
    dimensions: int = 96
    neighbours: int = 25
    #: Votes weigh similarity to this power.
    power: float = 12.0
    #: Weight of the shape terms against the trigrams.
    shape_weight: float = 0.5


def term_counts(block: Block, buckets: int) -> np.ndarray:
    """Documents x buckets: counts of hashed byte trigrams."""
    n, buf, off = len(block), block.buf, block.off
    out = np.zeros(n * buckets, dtype=np.float32)
    step = 1 << 21
    for a in range(0, max(0, len(buf) - 2), step):
        b = buf[a : a + step + 2].astype(np.uint32)
        h = (b[:-2] * np.uint32(0x9E3779B1)) ^ (b[1:-1] * np.uint32(0x85EBCA77)) ^ (b[2:] * np.uint32(0xC2B2AE3D))
        h = (h ^ (h >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
        h = (h >> np.uint32(12)) % np.uint32(buckets)
        doc = np.repeat(np.arange(n), np.diff(np.clip(off - a, 0, len(h))))
        inside = np.ones(len(h), dtype=bool)
        ends = off[1:] - a
        for back in (1, 2):
            at = ends - back
            inside[at[(at >= 0) & (at < len(h))]] = False
        out += np.bincount((doc * buckets + h)[inside], minlength=n * buckets).astype(np.float32)
    return out.reshape(n, buckets)


def shape_terms(block: Block) -> np.ndarray:
    """Documents x SHAPE_TERMS: shares and ratios in 0 .. 1."""
    c = count_block(block, 8)
    w = find_words(block.buf, block.off)
    words = np.maximum(c.n_words, 1)
    chars = np.maximum(c.classes.sum(axis=1), 1)
    out = np.zeros((len(block), SHAPE_TERMS), dtype=np.float32)
    out[:, :9] = np.sqrt(c.classes / chars[:, None])
    out[:, 9] = c.n_repeat_words / words
    doc = w.doc().astype(U64)
    distinct = np.unique(np.stack([doc, w.hash], axis=1), axis=0)[:, 0].astype(np.int64) if len(doc) else np.zeros(0, np.int64)
    out[:, 10] = np.bincount(distinct, minlength=len(block)) / words
    out[:, 11] = np.minimum(c.word_chars / words / 20, 1)
    out[:, 12] = np.sqrt(c.n_symbols / chars)
    out[:, 13] = np.minimum(c.n_dup_lines / np.maximum(c.n_words / 10, 1), 1)
    out[:, 14] = np.minimum(np.log1p(c.n_words) / 12, 1)
    echo = (w.hash[1:] == w.hash[:-1]) & (doc[1:] == doc[:-1])
    out[:, 15] = np.bincount(w.doc()[1:][echo], minlength=len(block)) / words
    return out


def features(block: Block, p: QualityKnn) -> np.ndarray:
    return np.concatenate([np.log1p(term_counts(block, p.buckets)), shape_terms(block)], axis=1)


@dataclass
class Fitted:
    idf: np.ndarray
    centre: np.ndarray
    axes: np.ndarray  # features x dimensions
    vectors: np.ndarray  # sample x dimensions, of length 1
    labels: np.ndarray
    prior: float


def _weighted(x: np.ndarray, idf: np.ndarray, p: QualityKnn) -> np.ndarray:
    t = x[:, : p.buckets] * idf
    t /= np.maximum(np.linalg.norm(t, axis=1, keepdims=True), 1e-9)
    return np.concatenate([t, p.shape_weight * x[:, p.buckets :]], axis=1)


def _unit(z: np.ndarray) -> np.ndarray:
    return z / np.maximum(np.linalg.norm(z, axis=1, keepdims=True), 1e-9)


def fit(labelled: DataFrame, p: QualityKnn = QualityKnn()) -> Fitted | None:
    """The classifier from ``labelled`` (doc_id, text, label 0 or 1); None without labelled rows."""
    prepare(labelled.sparkSession)

    def run(batches):
        for block in blocks(batches, "text"):
            x = features(block, p).astype(np.float16)
            yield pa.record_batch([block.rows.column(0), pa.array([r.tobytes() for r in x], pa.binary())], names=["label", "x"])

    rows = labelled.select(F.col("label").cast("int"), "text").mapInArrow(run, "label int, x binary").collect()  # at most 2 * per_label rows
    if not rows:
        return None
    y = np.array([r["label"] for r in rows], dtype=np.float32)
    x = np.stack([np.frombuffer(r["x"], np.float16) for r in rows]).astype(np.float32)
    idf = np.log((1 + len(x)) / (1 + (x[:, : p.buckets] > 0).sum(axis=0))).astype(np.float32) + 0.1
    x = _weighted(x, idf, p)
    centre = x.mean(axis=0)
    x -= centre
    values, axes = np.linalg.eigh(x.T @ x)
    axes = axes[:, np.argsort(values)[::-1][: p.dimensions]].astype(np.float32)
    return Fitted(idf, centre, axes, _unit(x @ axes), y, float(y.mean()))


def sample(docs: DataFrame, labels: DataFrame, p: QualityKnn = QualityKnn()) -> DataFrame:
    """(doc_id, text, label): at most ``per_label`` documents of each label (labels: doc_id, label)."""
    order = Window.partitionBy("label").orderBy(F.xxhash64("doc_id", F.lit(3)), "doc_id")
    # the window's limit is pushed down: each task passes on per_label rows of a label at most
    few = labels.where("label IS NOT NULL AND doc_id IS NOT NULL").select("doc_id", "label").distinct().withColumn("r", F.row_number().over(order)).where(F.col("r") <= p.per_label)
    chosen = F.broadcast(few.select("doc_id", "label"))  # 2 * per_label rows at most
    found = docs.select("doc_id", "text").join(chosen, "doc_id").where("text IS NOT NULL")
    # a doc_id may stand in many rows
    order = Window.partitionBy("label").orderBy(F.xxhash64("doc_id", F.lit(3)), "doc_id", F.xxhash64("text"))
    return found.withColumn("r", F.row_number().over(order)).where(F.col("r") <= p.per_label).drop("r")


def classify(docs: DataFrame, fitted: Fitted | None, p: QualityKnn = QualityKnn()) -> DataFrame:
    """``docs`` (text and any columns) with ``score`` (0 to 1; higher: label 1 likelier).

    A null or empty text, or any text if there was nothing to learn from, gets
    the share of label 1 in the sample (0.5 without one). A ``score`` column of
    the input is replaced.
    """
    spark = docs.sparkSession
    prepare(spark)
    docs = docs.drop("score")
    columns = docs.columns
    if fitted is None:
        return docs.withColumn("score", F.lit(0.5))
    shared = spark.sparkContext.broadcast(fitted)

    def run(batches):
        f = shared.value
        k = min(p.neighbours, len(f.labels))
        for block in blocks(batches, "text"):
            score = np.full(len(block), f.prior)
            for a in range(0, len(block), 256):
                own = Block(block.rows, block.buf[block.off[a] : block.off[min(a + 256, len(block))]], block.off[a : a + 257] - block.off[a])
                z = _unit((_weighted(features(own, p), f.idf, p) - f.centre) @ f.axes)
                near = z @ f.vectors.T  # block of exact cosines
                top = np.argpartition(-near, k - 1, axis=1)[:, :k]
                weight = np.maximum(np.take_along_axis(near, top, axis=1), 0).astype(float) ** p.power
                total = weight.sum(axis=1)
                vote = (weight * f.labels[top]).sum(axis=1)
                filled = (np.diff(own.off) > 0) & (total > 0)
                score[a : a + 256] = np.where(filled, vote / np.where(total > 0, total, 1), f.prior)
            yield pa.RecordBatch.from_arrays([*block.rows.columns, pa.array(np.clip(score, 0, 1))], names=[*columns, "score"])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField("score", T.DoubleType())]))
