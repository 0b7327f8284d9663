import numpy as np
import pytest

from pulse.llm.block_ann import BlockAnn, nearest, usable


def _brute(vectors, queries, k):
    out = []
    for q, x in queries.items():
        scores = []
        for v, y in vectors.items():
            if v != q and len(x) == len(y):
                s = 0.0
                for a, b in zip(x, y):
                    s += float(a) * float(b)
                scores.append((-s, v))
        out += [(q, r + 1, v, -s) for r, (s, v) in enumerate(sorted(scores)[:k])]
    return sorted(out)


def _rows(df):
    return sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in df.collect())


@pytest.mark.parametrize("kind", ["float", "double"])
@pytest.mark.parametrize("p", [BlockAnn(neighbours=7), BlockAnn(neighbours=7, query_block=5, candidate_block=11)])
def test_as_by_brute_force(spark, p, kind):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(300, 9)).astype(np.float32)
    x[50:80] = x[50]  # ties
    x[90:95] *= 1e6
    x[95:99] *= 1e-6
    vectors = {i: row.tolist() for i, row in enumerate(x)}
    df = usable(spark.createDataFrame(list(vectors.items()), f"vec_id bigint, embedding array<{kind}>").repartition(4))
    want = _brute(vectors, {i: v for i, v in vectors.items() if i % 20 == 0}, 7)
    assert _rows(nearest(df, df.where("vec_id % 20 = 0"), p)) == want


def test_vectors_that_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0], "x"), (1, [0.0, 0.0], "x"), (2, None, "x"), (3, [nan, 1.0], "x"), (4, [inf, 1.0], "x"), (5, [None, 1.0], "x"), (6, [0.5, 0.5], "x"), (6, [0.5, 0.5], "x"), (None, [9.0, 9.0], "x"), (7, [], "x"), (8, [3.0], "x"), (9, [2.0, 2.0, 2.0], "x")]
    df = usable(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, block string"))
    assert sorted(r["vec_id"] for r in df.collect()) == [0, 6, 8, 9]
    assert _rows(nearest(df, df)) == [(0, 1, 6, 0.5), (6, 1, 0, 0.5)]


def test_empty_sides(spark):
    df = usable(spark.createDataFrame([(1, [1.0])], "vec_id bigint, embedding array<double>"))
    none = df.limit(0)
    assert nearest(df, none).collect() == [] and nearest(none, df).collect() == [] and nearest(none, none).collect() == []
    assert nearest(df, df).columns == ["query_id", "rank", "vec_id", "score"]


def test_repeated_queries_are_not_sent_through_the_driver(spark):
    from pulse.llm import block_ann

    rng = np.random.default_rng(4)
    rows = [(i, row.tolist()) for i, row in enumerate(rng.normal(size=(400, 6)).astype(np.float32))]
    df = usable(spark.createDataFrame(rows, "vec_id bigint, embedding array<float>"))
    seen, tiles = [], block_ann._tiles
    block_ann._tiles = lambda pairs, *a: seen.append(pairs) or tiles(pairs, *a)
    try:
        found = nearest(df, df.where("vec_id % 4 = 0"), BlockAnn(neighbours=3, query_block=10, candidate_block=5))
    finally:
        block_ann._tiles = tiles
    assert found.count() == 300
    plan = seen[0]._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastExchange" not in plan
    # every query block meets every candidate block once
    blocks, asked = (seen[0].select(c).distinct().count() for c in ("c_ids", "q_ids"))
    assert seen[0].count() == blocks * asked
