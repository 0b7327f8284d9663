import random

import numpy as np
import pytest

from pulse.llm.components import components
from pulse.llm.jaccard_join import JaccardJoin, _bounds, jaccard_components, keep_one

from .brute import components as brute
from .conftest import prose, variant


def _rows(df):
    return sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in df.collect())


@pytest.mark.parametrize("p", [JaccardJoin(), JaccardJoin(frequent_local=2, block_rows=5), JaccardJoin(frequent_most=0, slack=0.0, filter_bits=1 << 16)])
def test_components_as_by_brute_force(corpus, corpus_df, p):
    want = brute(corpus)
    assert _rows(jaccard_components(corpus_df, p)) == sorted((i, *want[i]) for i, _ in corpus)


def test_a_large_group_of_near_copies_in_small_row_blocks(spark):
    rng = random.Random(9)
    base = prose(rng, 120, 10**6)
    docs = [(i, variant(rng, base, rng.choice([0.01, 0.03, 0.05]))) for i in range(90)]
    docs += [(100 + i, prose(rng, 60, 10**6)) for i in range(20)]
    want = brute(docs)
    assert len({c for _, c in want.values()}) > 21  # some variants stand apart
    got = jaccard_components(spark.createDataFrame(docs, "doc_id bigint, text string").repartition(6), JaccardJoin(block_rows=12, frequent_local=3))
    assert _rows(got) == sorted((i, *want[i]) for i, _ in docs)


def test_bounds_hold_between_all_sizes():
    p = JaccardJoin()
    for n in range(1, 400):
        smaller = np.arange(-(-75 * n // 100), n + 1)
        kept, _ = _bounds(smaller, p)
        need = -(-75 * n // 100)
        assert (kept - smaller + need).min() >= _bounds(np.array([n]), p)[1][0]


def test_nulls_empty_repeated_rows_and_other_columns(spark):
    docs = [(1, "a b c d e f", "x"), (1, "a b c d e f", "x"), (None, "A B C D E F", "y"), (5, None, "z"), (6, "", None), (7, "", None), (None, "q r", None)]
    df = spark.createDataFrame(docs, "doc_id bigint, text string, node string")
    key = lambda r: tuple(str(x) for x in r)
    got = sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in jaccard_components(df).collect()), key=key)
    assert got == sorted([(1, 2, 1), (1, 2, 1), (None, 2, 1), (5, 0, 5), (6, 0, 6), (7, 0, 7), (None, 1, None)], key=key)
    kept = sorted(((r["doc_id"], r["text"]) for r in keep_one(df).collect()), key=key)
    # a row without an id that is linked to a named one goes
    assert kept == sorted([(1, "a b c d e f"), (None, "q r"), (5, None), (6, ""), (7, "")], key=key)
    assert keep_one(df).columns == df.columns


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id bigint, text string")
    assert jaccard_components(df).collect() == []


def test_components_of_chains_hubs_loops(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7), (300, 200), (300, 200), (200, 250)]
    rows = components(spark.createDataFrame(edges, "src bigint, dst bigint").repartition(7)).collect()
    got = {r["node"]: r["component"] for r in rows}
    want = {**{i: 0 for i in range(41)}, **{100 + i: 100 for i in range(30)}, 200: 200, 250: 200, 300: 200}
    assert got == want and len(rows) == len(want)
    assert components(spark.createDataFrame([], "src bigint, dst bigint")).collect() == []


def test_rows_that_only_share_passages_are_not_compared_with_all(spark, monkeypatch):
    """A ring of documents, each with a passage of either neighbour, is one graph of shared
    columns; near copies among them link, and the others go by their whole sets."""
    from pulse.llm import jaccard_join

    rng = random.Random(12)
    passages = [prose(rng, 25, 10**6) for _ in range(80)]
    docs = [(i, f"{p} {prose(rng, 45, 10**6)} {passages[i - 1]}") for i, p in enumerate(passages)]
    docs += [(100 + i, variant(rng, docs[i][1], 0.02)) for i in range(0, 80, 4)]
    docs += [(200 + i, "x y z u v w " + " ".join(docs[i][1].split(" ")[: 4 + i])) for i in range(12)]
    want = brute(docs)
    assert len({c for _, c in want.values()}) < len(docs) - 10
    met, links = [], jaccard_join._links
    monkeypatch.setattr(jaccard_join, "_links", lambda d, rows, p: met.append(rows.count()) or links(d, rows, p))
    df = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(6)
    for p in (JaccardJoin(block_rows=8), JaccardJoin(block_rows=8, frequent_local=2)):
        met.clear()
        assert _rows(jaccard_components(df, p)) == sorted((i, *want[i]) for i, _ in docs)
        assert sum(met) < len(docs)
