import random

import numpy as np

from pulse.llm.quality_knn import QualityKnn, classify, fit, sample

from .conftest import prose


def _docs(n=240):
    rng = random.Random(6)
    out = []
    for i in range(n):
        t = prose(rng, rng.randrange(20, 80), 10**5)
        bad = rng.random() < 0.3
        if bad:
            t = rng.choice([t.upper().replace(" ", "!! "), " ".join(w + "$$" for w in t.split()), (t.split()[0] + " ") * 60, " | ".join(t.split())])
        out.append((i, t, 0 if bad else 1))
    return out


def test_held_out_labels(spark):
    docs = _docs()
    df = spark.createDataFrame([d[:2] for d in docs] + [(9000, None), (9001, ""), (9002, docs[0][1] * 50)], "doc_id bigint, text string").repartition(3)
    labels = spark.createDataFrame([(i, y) for i, _, y in docs if i % 5] + [(4, None), (None, 1), (77_777, 0)], "doc_id bigint, label int")
    p = QualityKnn(dimensions=24, neighbours=9)
    fitted = fit(sample(df, labels, p), p)
    rows = {r["doc_id"]: r["score"] for r in classify(df.selectExpr("*", "1 as score"), fitted, p).collect()}
    assert len(rows) == len(docs) + 3
    held = [(rows[i], y) for i, _, y in docs if i % 5 == 0]
    assert np.mean([(s >= 0.5) == y for s, y in held]) > 0.9
    assert all(0 <= s <= 1 for s in rows.values())
    assert rows[9000] == rows[9001] == fitted.prior


def test_sample_is_bounded(spark):
    docs = _docs(60)
    df = spark.createDataFrame([d[:2] for d in docs], "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in docs], "doc_id bigint, label int")
    got = sample(df, labels, QualityKnn(per_label=5)).groupBy("label").count().collect()
    assert {r["label"]: r["count"] for r in got} == {0: 5, 1: 5}


def test_without_labels_and_empty_table(spark):
    df = spark.createDataFrame([(1, "a b c")], "doc_id bigint, text string")
    none = spark.createDataFrame([], "doc_id bigint, label int")
    assert fit(sample(df, none)) is None
    assert classify(df, None).first()["score"] == 0.5
    p = QualityKnn(buckets=32, dimensions=2)
    fitted = fit(spark.createDataFrame([(1, "a b", 1), (2, "c d", 0)], "doc_id bigint, text string, label int"), p)
    assert classify(df.limit(0), fitted, p).collect() == []
