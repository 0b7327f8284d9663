"""Connected components of a graph given as edge rows, by star contraction.

Each round turns every neighbourhood into a star around its smallest node
(first over larger, then over smaller neighbours), so chains shrink
geometrically. A node's neighbourhood is never gathered: its minimum is a
combinable aggregate, joined back to the edges. Hubs, the nodes with more than
a thousandth of the edges, get their minimum from a broadcast list (at most
2000 rows), so a hub's edges stay where they are; only the others' edges are
dealt by node. Rounds are cut with tables in the shared scratch folder and go
on until the stars are settled.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulse.llm.frames import Forest, batches_of, stored

EDGE = pa.schema([("src", pa.int64()), ("dst", pa.int64())])
HUB_SHARE = 1000  # a hub has more than one edge end in so many
LEAST_HUB = 1000
_FLUSH = 500_000


def spanning(src: np.ndarray, dst: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges (node, smallest node of its component) that connect what the given edges connect."""
    nodes, at = np.unique(np.concatenate([src, dst]), return_inverse=True)
    forest = Forest(len(nodes))
    for a, b in zip(at[: len(src)].tolist(), at[len(src) :].tolist()):
        forest.join(a, b)
    root = forest.roots()
    keep = root != np.arange(len(nodes))
    return nodes[keep], nodes[root[keep]]


def _contract(batches):
    """The edges of one task as fewer edges with the same components (a bounded number at a time)."""
    held, n = [], 0
    for batch in batches:
        held.append([batch.column(i).to_numpy() for i in (0, 1)])
        n += batch.num_rows
        if n >= _FLUSH:
            yield from batches_of(EDGE, list(spanning(*(np.concatenate(x) for x in zip(*held)))))
            held, n = [], 0
    if n:
        yield from batches_of(EDGE, list(spanning(*(np.concatenate(x) for x in zip(*held)))))


def _stars(edges: DataFrame, larger: bool, most: int) -> DataFrame:
    """One contraction: rows (src > dst) to rows (src > dst). A node with more than ``most``
    edges is a hub."""
    both = edges.unionByName(edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"))) if larger else edges
    least = both.groupBy("src").agg(F.min("dst").alias("low"), F.count("*").alias("n")).withColumn("low", F.least("src", "low"))
    hubs = F.broadcast(least.where(F.col("n") > most).select("src", "low"))
    others = least.where(F.col("n") <= most).select("src", "low")
    joined = both.join(hubs, "src").unionByName(both.join(hubs.select("src"), "src", "left_anti").join(others, "src"))
    if larger:
        out = joined.where("dst > src").select(F.col("dst").alias("src"), F.col("low").alias("dst"))
    else:
        out = joined.select(F.explode(F.array(F.struct("src", F.col("low").alias("dst")), F.struct(F.col("dst").alias("src"), F.col("low").alias("dst")))).alias("e")).select("e.*")
    out = out.where("src <> dst")
    return out if larger else out.distinct()


def _settled(edges: DataFrame) -> bool:
    """Whether the edges are stars: a node has one smaller neighbour or is one, not both."""
    ends = F.explode(F.array(F.struct(F.col("src").alias("node"), F.lit(1).alias("up")), F.struct(F.col("dst").alias("node"), F.lit(0).alias("up"))))
    nodes = edges.select(ends.alias("e")).groupBy("e.node").agg(F.sum("e.up").alias("up"), F.min("e.up").alias("root"))
    return nodes.where("up > 1 OR (up = 1 AND root = 0)").isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """(node, component): every node of ``edges`` (src, dst bigint), with its component's smallest node.

    Loops and repeated edges change nothing; an empty table gives an empty table.
    """
    one_way = edges.where("src <> dst").select(F.greatest("src", "dst").alias("src"), F.least("src", "dst").alias("dst"))
    now = stored(one_way.mapInArrow(_contract, "src bigint, dst bigint").distinct(), "components")
    while not _settled(now):
        most = max(LEAST_HUB, now.count() // HUB_SHARE)
        now = stored(_stars(_stars(now, True, most), False, most), "components")
    roots = now.select(F.col("dst").alias("node"), F.col("dst").alias("component")).distinct()
    return now.select(F.col("src").alias("node"), F.col("dst").alias("component")).unionByName(roots)
