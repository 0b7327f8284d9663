"""Global ranks without funnelling every row through one task.

Spark plans ``rank()`` / ``percent_rank()`` / ``percentile_cont`` over an
un-partitioned window (or a few huge groups) by moving all rows into one
partition. The three compositions here keep the work distributed:

* ``top_k_ranked`` -- ORDER BY ... LIMIT k then RANK: take the top k first
  (``TakeOrderedAndProject``: per-partition top-k, then a k-row merge) and rank
  only those rows. Every row ranked above a kept row is itself kept, so the
  ranks equal the global ones.
* ``value_positions`` -- for each distinct value of a group: how many rows are
  strictly smaller, and how many equal it. Ties are collapsed first (a
  clamped score may put a third of all rows on one value), the group's value
  range is cut at split points, per-bucket counts are prefix-summed on a small
  table, and only the distinct values inside one bucket are sorted together.
  Split points are every eighth value of a sample chosen by the values' hash,
  so they follow from the data alone: a task that runs again gets the same.
  What is known of a whole group (its size, split points and bucket counts)
  is small and comes to the distinct values as a broadcast where the number
  of groups has a stated bound; distinct values are dealt by group and bucket
  only, never by group alone.
* ``percent_rank_distributed`` / ``percentile_cont_distributed`` -- built on
  ``value_positions``; exact, one plan whatever the size, and lazy: building
  a query runs no job. Groups are compared null-safe (NULL is a group).
* ``percent_rank_of`` -- the percent rank of a top-k result's few rows in one
  pass over the population.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Buckets per group: as many as a shuffle has partitions, within these bounds
# (a bucket is sorted in one task; split points are found in two steps of
# about the square root of their number).
LEAST_BUCKETS, MOST_BUCKETS = 256, 16384
# Sampled values for each split point (evens out the buckets).
SAMPLE_PER_BUCKET = 8
# A value with more than this share of its group's rows is joined back from a
# broadcast list (at most 1 / share values per group) when there is one group.
HOT_SHARE = 1 / 1000
# Groups up to which their sizes, split points and counts are broadcast.
FEW_GROUPS = 16


def _ordered(col: str, ascending: bool) -> Column:
    return F.col(col).asc_nulls_first() if ascending else F.col(col).desc_nulls_last()


def top_k_ranked(
    df: DataFrame,
    order_col: str,
    k: int,
    rank_col: str,
    ascending: bool = False,
    tiebreak: Sequence[str] = ("movie_id",),
) -> DataFrame:
    """``RANK() OVER (ORDER BY order_col)`` over the first ``k`` rows of that order.

    ``tiebreak`` picks deterministically which tied rows fill the last places.
    The rank window runs on at most ``k`` rows.
    """
    order = [_ordered(order_col, ascending)] + [F.col(c).asc() for c in tiebreak]
    top = df.orderBy(*order).limit(k)
    w = Window.orderBy(_ordered(order_col, ascending))
    return top.withColumn(rank_col, F.rank().over(w).cast("long"))


def _same(left: str, right: str, columns: Sequence[str]) -> Column:
    cond = F.lit(True)
    for c in columns:
        cond = cond & F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}"))
    return cond


def _default_buckets(df: DataFrame) -> int:
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return min(MOST_BUCKETS, max(LEAST_BUCKETS, parts))


def _join(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "inner", small: bool = False) -> DataFrame:
    """Join on ``on`` with NULL equal to NULL; the left side's columns and the right's others.

    ``small``: the right side's rows have a stated bound, and are broadcast.
    """
    if small:
        right = F.broadcast(right)
    extra = [F.col(f"r.{c}") for c in right.columns if c not in on]
    return left.alias("l").join(right.alias("r"), _same("l", "r", on), how).select("l.*", *extra)


def value_positions(
    df: DataFrame,
    value_col: str,
    group_cols: Sequence[str] = (),
    buckets: int | None = None,
    few_groups: bool = False,
) -> DataFrame:
    """Per (group, distinct non-null value): ``_n_eq``, ``_n_less``, ``_n_group``.

    ``_n_less`` counts rows of the group with a strictly smaller value;
    ``_n_group`` is the number of non-null rows in the group. ``few_groups``
    states that there are at most ``FEW_GROUPS`` groups (fixed labels, say).
    """
    groups = list(group_cols)
    v = F.col(value_col)
    buckets = buckets or _default_buckets(df)
    if not groups:
        # One group. Its key is a column (a literal would be folded away), but
        # only one-row, sampled and per-bucket results are keyed by it.
        one = df.where(v.isNotNull()).select(value_col).withColumn("_all", F.pmod(F.xxhash64(v), F.lit(1)))
        return value_positions(one, value_col, ["_all"], buckets, True).drop("_all")
    distinct = df.where(v.isNotNull()).groupBy(*groups, value_col).agg(F.count(F.lit(1)).alias("_n_eq"))
    # Sizes and sample read the counts too (never 0): all readers of the distinct values
    # ask for the same columns, so one aggregation and exchange serves them.
    counted = F.col("_n_eq") > 0
    sizes = distinct.groupBy(*groups).agg(F.count_if(counted).alias("_values"))
    every = F.greatest(F.lit(1), (F.col("_values") / (buckets * SAMPLE_PER_BUCKET)).cast("long"))
    sample = _join(distinct, sizes, groups, small=few_groups).where(counted & (F.pmod(F.xxhash64(v), every) == 0))
    # About buckets * SAMPLE_PER_BUCKET values of a group, whatever its size.
    splits = sample.groupBy(*groups).agg(F.sort_array(F.collect_list(value_col)).alias("_sample"))
    width = F.greatest(F.lit(1), F.ceil(F.size("_sample") / buckets).cast("int"))
    splits = splits.select(*groups, F.filter("_sample", lambda x, i: F.pmod(i + 1, width) == 0).alias("_splits"))
    step = max(2, round(buckets**0.5))
    coarse = F.filter("_splits", lambda x, i: F.pmod(i + 1, F.lit(step)) == 0)
    splits = splits.withColumn("_coarse", coarse)
    placed = _join(distinct, splits, groups, "left", small=few_groups)
    # How many split points lie below the value: whole steps first, then inside one step.
    jump = F.size(F.filter("_coarse", lambda x: x < v)) * step
    inside = F.size(F.filter(F.slice("_splits", F.col("_jump") + 1, F.lit(step)), lambda x: x < v))
    bucketed = placed.withColumn("_jump", F.coalesce(jump, F.lit(0))).withColumn("_bucket", F.col("_jump") + F.greatest(F.coalesce(inside, F.lit(0)), F.lit(0)))
    bucketed = bucketed.drop("_splits", "_coarse", "_jump")
    per_bucket = bucketed.groupBy(*groups, "_bucket").agg(F.sum("_n_eq").alias("_n_bucket"))
    gw = Window.partitionBy(*groups)
    before = F.sum("_n_bucket").over(gw.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1))
    prefix = per_bucket.select(
        *groups, "_bucket", F.coalesce(before, F.lit(0)).alias("_n_before"), F.sum("_n_bucket").over(gw).alias("_n_group")
    )
    positioned = _join(bucketed, prefix, [*groups, "_bucket"], small=few_groups)
    bw = Window.partitionBy(*groups, "_bucket").orderBy(value_col).rowsBetween(Window.unboundedPreceding, -1)
    return positioned.select(
        *groups,
        value_col,
        "_n_eq",
        (F.col("_n_before") + F.coalesce(F.sum("_n_eq").over(bw), F.lit(0))).alias("_n_less"),
        "_n_group",
    )


def percent_rank_distributed(
    df: DataFrame,
    value_col: str,
    out_col: str,
    group_cols: Sequence[str] = (),
    buckets: int | None = None,
    population: DataFrame | None = None,
) -> DataFrame:
    """``PERCENT_RANK() OVER (PARTITION BY groups ORDER BY value)`` for non-null values.

    ``(rows strictly smaller) / (n - 1)``; 0 for a one-row group; NULL values
    get NULL (callers here filter them out beforehand). ``population`` has
    the same groups and values as ``df`` by a cheaper plan (fewer columns or
    joins), if there is one.
    """
    groups = list(group_cols)
    pos = value_positions(df if population is None else population, value_col, groups, buckets)
    share = F.when(F.col("_n_group") <= 1, F.lit(0.0)).otherwise(F.col("_n_less") / (F.col("_n_group") - 1))
    ranks = pos.select(*groups, value_col, share.alias("_rank"), (F.col("_n_eq") > F.col("_n_group") * HOT_SHARE).alias("_hot"))
    if groups:
        out = _join(df, ranks.drop("_hot"), [*groups, value_col], "left")
        return out.withColumnRenamed("_rank", out_col)
    # Hot values come from a list of at most 1 / HOT_SHARE rows; their rows then
    # carry a scattered key, so that the join with all values meets no hot key.
    hot = F.broadcast(ranks.where("_hot").select(value_col, F.col("_rank").alias("_hot_rank")))
    rows = _join(df, hot, [value_col], "left")
    scatter = F.when(F.col("_hot_rank").isNotNull(), F.pmod(F.xxhash64(*df.columns), F.lit(1 << 20)) + 1).otherwise(F.lit(0))
    # One struct is the key, so the scatter takes part in dealing the rows.
    rows = rows.withColumn("_key", F.struct(F.col(value_col).alias("value"), scatter.alias("scatter")))
    key = F.struct(F.col(value_col).alias("value"), F.lit(0).cast("long").alias("scatter"))
    out = rows.join(ranks.select(key.alias("_key"), "_rank"), "_key", "left")
    return out.select(*df.columns, F.coalesce("_hot_rank", "_rank").alias(out_col))


def percentile_cont_distributed(
    df: DataFrame,
    value_col: str,
    fraction: float,
    out_col: str,
    group_cols: Sequence[str] = (),
    buckets: int | None = None,
    few_groups: bool = False,
) -> DataFrame:
    """Exact ``PERCENTILE_CONT(value, fraction)`` per group, without one-task groups.

    Returns one row per group that has a non-null value: the interpolation of
    the values at positions ``floor(f*(n-1))`` and ``ceil(f*(n-1))``.
    """
    groups = list(group_cols)
    pos = value_positions(df, value_col, groups, buckets, few_groups)
    target = F.lit(float(fraction)) * (F.col("_n_group") - 1)
    lo, hi = F.floor(target), F.ceil(target)
    covers = lambda k: (F.col("_n_less") <= k) & (k < F.col("_n_less") + F.col("_n_eq"))
    hits = pos.where(covers(lo) | covers(hi)).select(
        *groups,
        F.when(covers(lo), F.col(value_col)).alias("_v_lo"),
        F.when(covers(hi), F.col(value_col)).alias("_v_hi"),
        (target - lo).alias("_frac"),
    )
    # At most two rows per group.
    agg = hits.groupBy(*groups).agg(
        F.max("_v_lo").alias("_v_lo"), F.max("_v_hi").alias("_v_hi"), F.max("_frac").alias("_frac")
    )
    return agg.select(
        *groups,
        (F.col("_v_lo") + F.col("_frac") * (F.col("_v_hi") - F.col("_v_lo"))).alias(out_col),
    )


def percent_rank_of(
    rows: DataFrame,
    population: DataFrame,
    value_col: str,
    out_col: str,
) -> DataFrame:
    """``PERCENT_RANK`` of each of a few ``rows`` within a large ``population``.

    ``rows`` is a top-k result, bounded by its LIMIT; all of its values must
    occur in the population. Their distinct values form one sorted array; one
    pass over the population counts its rows by how many of these values lie
    below them (partial aggregation, k + 1 counts), and sums of these counts
    are the positions.
    """
    v = F.col(value_col)
    asked = rows.where(v.isNotNull()).agg(F.sort_array(F.collect_set(value_col)).alias("_asked"))
    pop = population.where(v.isNotNull()).select(value_col)
    # a row that equals the j-th value has j - 1 of them below it and belongs to the next value's count
    below = F.size(F.filter("_asked", lambda x: x <= v))
    counts = pop.withColumn("_asked", asked.scalar()).groupBy(below.alias("_at")).agg(F.count(F.lit(1)).alias("_n"))
    # At most k + 1 counts, k values and one total meet here.
    counted = counts.agg(F.struct(F.collect_list(F.struct("_at", "_n")).alias("_counts"), F.sum("_n").alias("_total")).alias("_c"))
    places = asked.select(F.posexplode("_asked").alias("_at", "_value")).withColumn("_c", counted.scalar()).select("_at", "_value", "_c.*")
    less = F.aggregate(F.filter("_counts", lambda c: c["_at"] <= F.col("_at")), F.lit(0).cast("long"), lambda a, c: a + c["_n"])
    share = F.when(F.col("_total") <= 1, F.lit(0.0)).otherwise(less / (F.col("_total") - 1))
    found = places.select(F.col("_value").alias(value_col), share.alias(out_col))
    return _join(rows, found, [value_col], "left")
