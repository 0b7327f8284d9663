import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from pulse.llm.mixing import Mixing, mix, mix_documents

from .brute import shares, words

SCHEMA = "doc_id bigint, source string, text string, bucket string"


def _docs(seed=1, n=600, big=0.34):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        source = "hot" if rng.random() < big else rng.choice(["a", "b", "c", "é", None])
        if rng.random() < 0.02:
            source = "tiny"
        out.append((i, source, rng.choice([None, "", " ".join("w" for _ in range(rng.randrange(1, 60)))]) if rng.random() < 0.1 else " ".join("w" for _ in range(rng.randrange(1, 60))), "x"))
    return out


def _weights(sources):
    ordered = sorted((s for s in sources if s is not None), key=lambda s: [ord(c) for c in s]) + ([None] if None in sources else [])
    return {s: float(i % 3 + 1) for i, s in enumerate(ordered)}


@pytest.mark.parametrize("p", [Mixing(), Mixing(bucket_rows=20)])
def test_targets_and_taken(spark, p):
    docs = _docs()
    rows = mix(spark.createDataFrame(docs, SCHEMA).repartition(5), p=p).collect()
    size = {i: len(words(t)) for i, _, t, _ in docs}
    by = defaultdict(int)
    for i, s, _, _ in docs:
        by[s] += size[i]
    total = sum(by.values())
    want = shares(by, _weights(by), total, 3)
    source = {i: s for i, s, _, _ in docs}
    assert len(rows) == len(docs)
    taken = defaultdict(int)
    for r in rows:
        s = source[r["doc_id"]]
        assert r["size"] == size[r["doc_id"]] and r["source_size"] == by[s]
        assert r["target"] == pytest.approx(want[s])
        assert r["taken"] in [k * r["size"] for k in range(4)]
        taken[s] += r["taken"]
    assert want["tiny"] == 3 * by["tiny"]  # a small source runs out and its excess is shared again
    for s in by:
        assert abs(taken[s] - want[s]) <= 60
    again = mix(spark.createDataFrame(docs, SCHEMA).repartition(3), p=p).collect()
    assert {(r["doc_id"], r["taken"]) for r in again} == {(r["doc_id"], r["taken"]) for r in rows}


def test_given_weights_and_repeated_rows(spark):
    docs = [(1, "a", "x y z", ""), (1, "a", "x y z", ""), (2, "b", "q " * 6, ""), (3, "c", "none of it", "")]
    weights = spark.createDataFrame([("a", 1.0), ("b", 1.0)], "source string, weight double")
    rows = mix(spark.createDataFrame(docs, SCHEMA), weights).collect()
    got = sorted((r["doc_id"], r["size"], r["source_size"], r["target"], r["taken"]) for r in rows)
    assert [g[:3] for g in got] == [(1, 3, 6), (1, 3, 6), (2, 6, 6), (3, 3, 3)]
    assert got[3][3:] == (0.0, 0) and got[0][3] == got[2][3] == 7.5
    assert sum(g[4] for g in got[:2]) in (6, 9) and got[2][4] == 6


def test_the_mixture_repeats_whole_rows(spark):
    docs = _docs(seed=3, n=200)
    df = spark.createDataFrame(docs, SCHEMA).repartition(3)
    taken = {r["doc_id"]: r["taken"] for r in mix(df).collect()}
    rows = mix_documents(df).collect()
    assert rows[0].asDict().keys() == {"doc_id", "source", "text", "bucket"}
    count = defaultdict(int)
    for r in rows:
        count[r["doc_id"]] += len(words(r["text"]))
        assert (r["doc_id"], r["source"], r["text"], r["bucket"]) in docs
    assert all(count[i] == taken[i] for i in taken)


def test_empty_table_and_sizeless_documents(spark):
    assert mix(spark.createDataFrame([], SCHEMA)).collect() == []
    assert mix_documents(spark.createDataFrame([], SCHEMA)).collect() == []
    r = mix(spark.createDataFrame([(1, None, None, None)], SCHEMA)).collect()
    assert [(x["size"], x["target"], x["taken"]) for x in r] == [(0, 0.0, 0)]
