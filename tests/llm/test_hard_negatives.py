import math

import numpy as np
import pytest

from pulse.llm.hard_negatives import Best, Bucket, Mining, _lists, mine, normed, usable

from .brute import hard_negatives

SCHEMA = "vec_id bigint, label int, embedding array<double>"
COLUMNS = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def _rows(df):
    return sorted(tuple(r[c] for c in COLUMNS) for r in df.collect())


def _quantised(rows):
    return {v: (label, [math.floor(256 * x) for x in e]) for v, label, e in rows}


@pytest.mark.parametrize("p", [Mining(), Mining(bucket_rows=7, anchor_rows=3, shard_buckets=2), Mining(positives=2, negatives=9, low=50, high=95, focus=2)])
@pytest.mark.parametrize("seed", [1, 2])
def test_as_by_brute_force(spark, p, seed):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(400, 10)) * 0.3
    centre = rng.normal(size=(6, 10)) * 0.5
    label = rng.integers(0, 6, 400)
    x += centre[label]
    x[50:150] = x[50]  # a hot vector, with several labels
    x[200:220] *= 40
    x[220:240] *= 0.01
    x[240:243] = 0.0
    rows = [(int(i), int(c), v.tolist()) for i, (c, v) in enumerate(zip(label, x))]
    df = usable(spark.createDataFrame(rows, SCHEMA).repartition(4))
    want = hard_negatives(_quantised(rows), range(0, 400, 10), p.positives, p.negatives, p.low, p.high)
    assert want and _rows(mine(df, df.where("vec_id % 10 = 0"), p)) == want


def test_pruning_keeps_every_row_over_the_threshold():
    rng = np.random.default_rng(5)
    x = (normed(rng.normal(size=(600, 12)))[0] * rng.uniform(900, 1000, (600, 1))).astype(np.int64)
    row = {"ids": np.arange(600).tobytes(), "labels": np.zeros(600, np.int64).tobytes(), "dims": 12, "width": 8, "data": x.tobytes(), "longest": float(normed(x)[1].max()), "more": _lists(x, None)}
    bucket = Bucket(row)
    left = 0
    for anchor in (rng.normal(size=(30, 12)) * 200).astype(np.int64):
        unit, length = normed(anchor[None])
        score = x @ anchor
        focus = np.argsort(-np.abs(unit[0]))[:6]
        for least in np.sort(score)[[-1, -5, -60]]:
            at = bucket.feasible(unit[0], length[0], float(least), focus)
            if at is not None:
                assert set(np.flatnonzero(score >= least)) <= set(at.tolist())
                left += len(at)
        assert len(bucket.feasible(unit[0], length[0], float(length[0] * bucket.longest * 1.01), focus)) == 0
    assert left < 0.7 * 30 * 3 * 600


def test_best_keeps_smaller_ids_of_ties():
    b = Best(2, -(2**63), 2**63 - 1)
    b.offer(np.array([5, 5, 1]), np.array([9, 8, 1]))
    b.offer(np.array([5, 4]), np.array([3, 2]))
    assert b.ids.tolist() == [3, 8] and b.floor == 5


def test_rows_that_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, 1, [1.0, 0.0]), (1, 1, [0.5, 0.5]), (2, None, [1.0, 1.0]), (3, 2, None), (4, 2, [nan, 1.0]), (5, 2, [inf, 1.0]), (6, 2, [None, 1.0]), (7, 2, [0.45, 0.1]), (7, 2, [0.45, 0.1]), (None, 2, [0.4, 0.4]), (8, 2, []), (9, 2, [3.0]), (10, 2, [1e300, 1.0]), (11, 2, [1e15, 1.0]), (12, 2, [0.0, 0.0])]
    df = usable(spark.createDataFrame([(*r, "x") for r in rows], SCHEMA + ", shard string"))
    assert sorted(r["vec_id"] for r in df.collect()) == [0, 1, 7, 8, 9, 12]
    assert _rows(mine(df, df.where("vec_id = 0"))) == [(0, 1, 1, 7, 32768, 29440)]


def test_long_vectors_stay_exact(spark):
    rows = [(i, i % 2, [float(2**20 + i), float(2**20 - 3 * i), 0.0]) for i in range(40)]
    df = usable(spark.createDataFrame(rows, SCHEMA))
    assert _rows(mine(df, df.where("vec_id % 4 = 0"))) == hard_negatives(_quantised(rows), range(0, 40, 4))


def test_empty_sides(spark):
    df = usable(spark.createDataFrame([(1, 1, [1.0]), (2, 2, [1.0])], SCHEMA))
    none = df.limit(0)
    assert mine(df, none).collect() == [] and mine(none, none).collect() == [] and mine(df, df).collect() == []
    assert mine(df, df).columns == COLUMNS
