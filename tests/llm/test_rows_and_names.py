"""Many languages, hubs, repeated ids and clashing names."""

import random

import pytest
from pyspark.sql import functions as F

from pulse.llm import components as components_module
from pulse.llm.components import _stars, components
from pulse.llm.jaccard_join import keep_one
from pulse.llm.mixing import mix_documents
from pulse.llm.quality_knn import QualityKnn, sample
from pulse.llm.quality_rules import QualityRules, judge
from pulse.llm.substring_dedup import remove_repeats
from pulse.llm.url_filter import judge_urls

from .conftest import prose


def _language(rng, n):
    letters = rng.sample("abcdefghijklmnopqrstuvwxyz", 9)
    return ["".join(rng.choice(letters) for _ in range(rng.randrange(3, 8))) for _ in range(n)]


@pytest.mark.parametrize("shared", [500, 2, 0])
def test_every_language_has_its_own_reference(spark, shared):
    """How many references all tasks hold changes no verdict."""
    rng = random.Random(1)
    rows = []
    for lang in range(12):
        words = _language(rng, 25)
        rows += [(len(rows) + i, f"l{lang}", " ".join(rng.choice(words) for _ in range(60 + lang))) for i in range(10)]
    df = spark.createDataFrame(rows, "doc_id bigint, lang string, text string")
    names = ["doc_id", "kept", "class_distance", "word_distance"]
    found = {tuple(r) for r in judge(df.withColumn("ref", F.lit("mine")), QualityRules(shared_languages=shared)).select(*names).collect()}
    assert found == {tuple(r) for r in judge(df).select(*names).collect()}
    assert len(found) == 120 and all(r[1] for r in found)


def test_a_hub_keeps_to_no_task(spark, monkeypatch):
    """Edges of a hub are not dealt by node: the largest partition after the join stays small."""
    monkeypatch.setattr(components_module, "LEAST_HUB", 100)
    n = 20_000
    edges = spark.range(1, n).select(F.col("id").alias("src"), F.lit(0).cast("bigint").alias("dst"))
    edges = edges.unionByName(spark.range(n, n + 4000).select(F.col("id").alias("src"), (F.col("id") - 7).alias("dst")))
    old = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold", "spark.sql.shuffle.partitions")}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        out = _stars(edges.repartition(16), True, 100).groupBy(F.spark_partition_id()).count().collect()
        assert max(r["count"] for r in out) < 0.2 * sum(r["count"] for r in out)
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    found = {r["node"]: r["component"] for r in components(edges).collect()}
    assert found[n - 1] == 0 and set(found) == set(range(n + 4000)) and set(found.values()) == {0}


def test_a_long_chain_settles(spark):
    edges = spark.range(3000).select((F.col("id") + 1).alias("src"), F.col("id").alias("dst"))
    assert {r["component"] for r in components(edges).collect()} == {0}


def test_the_sample_is_bounded_by_rows(spark):
    docs = spark.createDataFrame([(1, f"text {i}") for i in range(500)] + [(2, "other")], "doc_id bigint, text string")
    labels = spark.createDataFrame([(1, 1), (2, 0)], "doc_id bigint, label int")
    assert sample(docs, labels, QualityKnn(per_label=20)).count() == 21


def test_one_row_of_each_component_stays(spark):
    rng = random.Random(3)
    a, b, c = (prose(rng, 40, 10**6) for _ in range(3))
    rows = [(1, a, "x"), (1, b, "x"), (2, a, "x"), (None, b, "x"), (3, c, "y"), (3, c, "x"), (None, c + " more", "x"), (4, "", "x"), (4, "", "x"), (None, None, "x")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, row_mark string")
    out = sorted((tuple(r) for r in keep_one(docs).collect()), key=str)
    assert out == sorted([(1, a, "x"), (1, b, "x"), (3, c, "x"), (4, "", "x"), (4, "", "x"), (None, None, "x")], key=str)


def test_clashing_names(spark):
    rng = random.Random(5)
    text = prose(rng, 50, 10**6)
    docs = spark.createDataFrame([(i, "s", text if i < 2 else prose(rng, 50, 10**6), 7.0) for i in range(6)], "doc_id bigint, source string, text string, mine double")
    odd = ["mix_at", "mix_doc_id", "Repeat_Spans", "row", "size"]
    for name in odd:
        own = docs.withColumnRenamed("mine", name)
        assert remove_repeats(own).columns == [*own.columns, "n_words", "n_removed"]
        assert {r[name] for r in remove_repeats(own).collect()} == {7.0}
        mixed = mix_documents(own)
        assert mixed.columns == own.columns and {r[name] for r in mixed.collect()} == {7.0}
    pages = spark.createDataFrame([("http://a.net/x", 7.0, 7.0)], "url string, m_host double, m_path double")
    rules = spark.createDataFrame([("net", "/", "block")], "rule_host string, rule_path string, rule_verdict string")
    r = judge_urls(pages, rules).first()
    assert (r["m_host"], r["m_path"], r["verdict"]) == (7.0, 7.0, "block")
