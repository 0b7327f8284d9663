import random
import re

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from pulse.operators.ranking import (
    percent_rank_distributed,
    percent_rank_of,
    percentile_cont_distributed,
    top_k_ranked,
)


@pytest.fixture(scope="module")
def skewed(spark):
    rnd = random.Random(7)
    rows = []
    for i in range(3000):
        g = rnd.choice(["a", "b", "c"])
        r = rnd.random()
        # a third of all rows on one value (clamped scores), some NULLs, some ties
        v = 100.0 if r < 0.33 else (None if r < 0.36 else float(rnd.randint(0, 400)) / 4)
        rows.append((i, g, v))
    return spark.createDataFrame(rows, "movie_id long, g string, v double")


def test_percent_rank_matches_builtin(spark, skewed):
    scored = skewed.where(F.col("v").isNotNull())
    want = scored.withColumn("pr", F.percent_rank().over(Window.orderBy("v")))
    got = percent_rank_distributed(scored, "v", "pr", buckets=16)
    diff = want.select("movie_id", F.round("pr", 12).alias("pr")).exceptAll(
        got.select("movie_id", F.round("pr", 12).alias("pr"))
    )
    assert diff.count() == 0
    assert got.count() == scored.count()


def test_grouped_percent_rank_matches_builtin(spark, skewed):
    scored = skewed.where(F.col("v").isNotNull())
    want = scored.withColumn("pr", F.percent_rank().over(Window.partitionBy("g").orderBy("v")))
    got = percent_rank_distributed(scored, "v", "pr", ["g"], buckets=8)
    a = want.select("movie_id", F.round("pr", 12).alias("pr"))
    b = got.select("movie_id", F.round("pr", 12).alias("pr"))
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


@pytest.mark.parametrize("fraction", [0.5, 0.1, 0.9, 0.0, 1.0])
def test_percentile_cont_matches_builtin(spark, skewed, fraction):
    want = {
        r["g"]: r["p"]
        for r in skewed.groupBy("g").agg(F.percentile("v", fraction).alias("p")).collect()
    }
    got = {
        r["g"]: r["p"]
        for r in percentile_cont_distributed(
            skewed, "v", fraction, "p", ["g"], buckets=8
        ).collect()
    }
    assert got.keys() == want.keys()
    for k in want:
        assert got[k] == pytest.approx(want[k])


def test_median_single_row_and_even_count(spark):
    df = spark.createDataFrame([("x", 5.0), ("y", 1.0), ("y", 4.0)], "g string, v double")
    got = {r["g"]: r["m"] for r in percentile_cont_distributed(df, "v", 0.5, "m", ["g"]).collect()}
    assert got == {"x": 5.0, "y": 2.5}


def test_null_is_a_group(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 2.0), ("a", 4.0), ("b", None)], "g string, v double")
    got = {r["g"]: r["m"] for r in percentile_cont_distributed(df, "v", 0.5, "m", ["g"]).collect()}
    assert got == {None: 1.5, "a": 4.0}
    ranks = {(r["g"], r["v"]): r["pr"] for r in percent_rank_distributed(df, "v", "pr", ["g"]).collect()}
    assert ranks == {(None, 1.0): 0.0, (None, 2.0): 1.0, ("a", 4.0): 0.0, ("b", None): None}


@pytest.mark.parametrize("buckets", [2, 9, 256])
def test_many_values_and_any_bucket_count(spark, buckets):
    df = spark.range(5000).select("id", (F.pmod(F.xxhash64("id"), F.lit(2500)) / 7).alias("v"))
    want = df.withColumn("pr", F.percent_rank().over(Window.orderBy("v"))).select("id", F.round("pr", 12))
    got = percent_rank_distributed(df, "v", "pr", buckets=buckets).select("id", F.round("pr", 12))
    assert want.exceptAll(got).count() == 0 and got.count() == 5000


def test_building_runs_no_job_and_nothing_meets_in_one_task(spark, skewed):
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("building", "building")
    scored = skewed.where(F.col("v").isNotNull())
    plans = [
        percent_rank_distributed(scored, "v", "pr"),
        percentile_cont_distributed(skewed, "v", 0.5, "m", ["g"]),
        percent_rank_of(scored.orderBy("v").limit(5), scored, "v", "pr"),
    ]
    assert tracker.getJobIdsForGroup("building") == []
    spark.sparkContext.setJobGroup("other", "other")
    windows = plans[0]._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in windows


def test_more_partitions_than_split_points(spark, skewed):
    scored = skewed.where(F.col("v").isNotNull())
    want = scored.withColumn("pr", F.percent_rank().over(Window.orderBy("v"))).select("movie_id", F.round("pr", 12))
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "5000")
    try:
        got = percent_rank_distributed(scored, "v", "pr").select("movie_id", F.round("pr", 12))
        assert want.exceptAll(got).count() == 0
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


def test_top_k_rank_equals_global_rank(spark, skewed):
    scored = skewed.where(F.col("v").isNotNull())
    full = scored.withColumn("r", F.rank().over(Window.orderBy(F.col("v").desc())))
    top = top_k_ranked(scored, "v", 50, "r")
    joined = top.alias("t").join(full.alias("f"), "movie_id")
    assert joined.where(F.col("t.r") != F.col("f.r")).count() == 0
    assert top.count() == 50


def test_percent_rank_of_matches_full_ranking(spark, skewed):
    scored = skewed.where(F.col("v").isNotNull())
    full = scored.withColumn("pr", F.percent_rank().over(Window.orderBy("v")))
    probe = scored.orderBy(F.col("v").desc(), "movie_id").limit(40)
    got = percent_rank_of(probe, scored, "v", "pr")
    joined = got.alias("g").join(full.alias("f"), "movie_id")
    assert joined.where(F.abs(F.col("g.pr") - F.col("f.pr")) > 1e-12).count() == 0


def test_distinct_values_are_not_dealt_by_a_group_alone(spark, skewed):
    """What is exchanged on the key of one group, or of a few, is aggregated before."""
    scored = skewed.where(F.col("v").isNotNull())
    old = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for df, key in ((percent_rank_distributed(scored, "v", "pr"), "_all"), (percentile_cont_distributed(scored, "v", 0.5, "m", ["g"], few_groups=True), "g")):
            lines = df._jdf.queryExecution().executedPlan().toString().split("\n")
            at = [i for i, x in enumerate(lines) if re.search(rf"Exchange hashpartitioning\({key}#\d+L?, \d+\)", x)]
            assert at
            for i in at:
                below = lines[i + 1] + lines[i + 2]
                assert "partial_" in below or "_n_bucket" in below, below
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_distinct_values_are_exchanged_once(spark, skewed):
    """Sizes, sample and positions read one aggregation of the values."""
    scored = skewed.where(F.col("v").isNotNull())
    old = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        lines = percent_rank_distributed(scored, "v", "pr")._jdf.queryExecution().executedPlan().toString().split("\n")
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    dealt = [x for x in lines if re.search(r"Exchange hashpartitioning\(_all#\d+L?, v#", x)]
    assert len(dealt) > 1 and len([x for x in dealt if "ReusedExchange" not in x]) == 1, dealt
