import random

import numpy as np
from pyspark.sql import functions as F

from pulse.llm.quality_rules import QualityRules, distance, judge, references

from .brute import base_failed, quality_counts

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def test_counts_as_by_brute_force(spark, corpus):
    odd = [(20_001, "# a | b\n# a | b\n<x> & $5 * 2%\n \n \n"), (20_002, "É ü 日本 😀\n\n"), (20_003, "\x00\x01 ctrl\x7f"), (20_004, " ".join(["a b c d e f g h"] * 5))]
    docs = [*corpus, *odd]
    df = spark.createDataFrame([(i, "en", t, "kept?") for i, t in docs], "doc_id bigint, lang string, text string, kept string")
    rows = judge(df).collect()
    got = {r["doc_id"]: tuple(r[c] for c in COUNTS) for r in rows}
    assert got == {i: quality_counts(t) for i, t in docs}
    failed = {i for i, t in docs if base_failed(quality_counts(t))}
    assert {r["doc_id"] for r in rows if r["base_failed"]} == failed
    assert not any(r["kept"] for r in rows if r["base_failed"])


def _english(rng, n):
    return " ".join(rng.choices(["the", "of", "and", "to", f"w{rng.randrange(10**6)}", f"q{rng.randrange(10**6)}"], [5, 3, 3, 2, 6, 6])[0] for _ in range(n)) + "."


def test_divergent_documents_go_and_clean_ones_stay(spark):
    rng = random.Random(2)
    clean = [(i, "en", _english(rng, rng.randrange(60, 300))) for i in range(150)]
    junk = [(1000 + i, "en", " ".join(f"{w}***$$" for w in _english(rng, 100).upper().split())) for i in range(5)]
    short = [(2000, "en", " ".join(f"W{i}##" for i in range(25)))]
    other = [(3000, None, _english(rng, 200)), (3001, "xx-unseen", junk[0][2])]
    df = spark.createDataFrame([*clean, *junk, *short, *other], "doc_id bigint, lang string, text string")
    rows = {r["doc_id"]: r for r in judge(df, QualityRules(most_languages=1)).collect()}
    assert all(rows[i]["kept"] for i, *_ in clean)
    assert not any(rows[i]["kept"] for i, *_ in junk)
    assert rows[2000]["kept"] and rows[2000]["word_distance"] is None  # too short to judge
    assert rows[3000]["kept"] and not rows[3001]["kept"]  # by the nearest reference


def test_references_count_all_documents(spark):
    docs = [(i, "en", "the cat the dog") for i in range(40)] + [(100, "de", "der hund"), (101, "de", None), (102, None, "x y")]
    df = spark.createDataFrame(docs, "doc_id bigint, lang string, text string").repartition(5)
    made = references(df, QualityRules(common_words=1, flush=7))
    assert sorted(made) == ["de", "en"]
    _, keys, shares = made["en"]
    assert len(keys) == 1 and np.allclose(shares, [0.5, 0.5])


def test_distance_is_jensen_shannon():
    p, q = np.array([[3.0, 1.0, 0.0]]), np.array([0.25, 0.25, 0.5])
    a, m = p[0] / 4, (p[0] / 4 + q) / 2
    kl = lambda x: sum(u * np.log2(u / v) for u, v in zip(x, m) if u)
    assert np.isclose(distance(p, q)[0], np.sqrt((kl(a) + kl(q)) / 2))
    assert distance(np.array([[1.0, 0, 0]]), np.array([0, 0, 1.0]))[0] == 1


def test_empty_table_and_no_language(spark):
    schema = "doc_id bigint, lang string, text string"
    assert judge(spark.createDataFrame([], schema)).collect() == []
    r = judge(spark.createDataFrame([(1, None, " ".join(f"w{i}" for i in range(50)))], schema)).first()
    assert r["kept"] and r["class_distance"] is None
