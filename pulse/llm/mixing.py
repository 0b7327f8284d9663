"""Mixing sources to target weights by weighted fair queueing.

Documents of a source stand in a shuffled order (by a hash of doc_id) and a
source may be gone through ``max_repeats`` times. A copy's virtual finish
time is the source's tokens up to and with it, over the source's weight. All
copies, range-sorted by finish time, form one queue; it ends where the
running total would pass the budget (by default the size of the input). At
that point every source that still has copies left stands at the same
virtual time, which is what sharing by weight means, and a source that ran
out has given ``max_repeats`` times its size.

Running totals come from totals per bucket of the order (within a source)
and per range partition (of the queue), so no source is sorted in one task.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pulse.llm.frames import n_parts, prepare, stored

ORDER_BITS = 31


#: Sources up to which what is known of each is broadcast.
FEW_SOURCES = 10_000


@dataclass(frozen=True)
class Mixing:
    max_repeats: int = 3
    seed: int = 17
    #: Documents whose running total one task sorts.
    bucket_rows: int = 50_000


def n_words(text: Column) -> Column:
    """Number of words of a text (null: 0)."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("bigint")


def cyclic_weights(sources: DataFrame, cycle: int = 3) -> DataFrame:
    """(source, weight): sources in code-point order, null last, weigh 1, 2, .. ``cycle``, 1, ..

    The number of sources is the number of things to weigh, not of documents.
    """
    place = F.row_number().over(Window.orderBy(F.col("source").isNull(), "source"))
    return sources.select("source").distinct().withColumn("weight", ((place - 1) % cycle + 1).cast("double"))


def targets(sources: DataFrame, budget: int, max_repeats: int) -> DataFrame:
    """``sources`` (source, source_size, weight) with ``target``: the budget shared by weight, each
    source at most ``max_repeats`` times its size, the excess shared again until none is above."""
    most = F.col("source_size") * max_repeats
    level = None  # virtual time up to which sources are served; it only rises
    while True:
        over = most <= F.col("weight") * (level if level is not None else -1.0)
        r = sources.agg(
            F.sum(F.when(over, most).otherwise(0)).alias("full"),
            F.sum(F.when(over, 0.0).otherwise(F.col("weight"))).alias("open"),
        ).first()
        if not r or not r["open"]:
            break
        new = (budget - r["full"]) / r["open"]
        if level is not None and new <= level:
            break
        level = new
    share = F.least(most.cast("double"), F.col("weight") * (level if level is not None else 0.0))
    return sources.withColumn("target", share)


def queue(sized: DataFrame, weights: DataFrame, p: Mixing, budget: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(taken copies in queue order, sources with their targets).

    ``sized`` has row_id, doc_id, source, size; copies get ``epoch`` and ``finish``
    (infinite for a closing copy). Sources are compared null-safe.
    """
    spark = sized.sparkSession
    total = sized.agg(F.count("*").alias("n"), F.coalesce(F.sum("size"), F.lit(0)).alias("s")).first()
    budget = total["s"] if budget is None else budget
    sizes = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    w = weights.select(F.col("source").alias("w_source"), "weight")
    sources = sizes.join(w, F.col("source").eqNullSafe(F.col("w_source")), "left").select("source", "source_size", F.coalesce("weight", F.lit(0.0)).alias("weight"))
    sources = stored(targets(stored(sources, "mixing-sources"), budget, p.max_repeats), "mixing-targets")

    place = F.pmod(F.xxhash64("doc_id", F.lit(p.seed)), F.lit(1 << ORDER_BITS))
    buckets = max(1, total["n"] // p.bucket_rows)
    keyed = sized.withColumn("place", place).withColumn("bucket", F.shiftright(F.col("place") * buckets, ORDER_BITS))
    sums = keyed.groupBy("source", "bucket").agg(F.sum("size").alias("s"))
    before = F.sum("s").over(Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1))
    sums = sums.select(F.col("source").alias("b_source"), F.col("bucket").alias("b_bucket"), F.coalesce(before, F.lit(0)).alias("before"))
    order = Window.partitionBy("source", "bucket").orderBy("place", "doc_id", "size", "row_id").rowsBetween(Window.unboundedPreceding, 0)
    run = keyed.withColumn("within", F.sum("size").over(order))
    run = run.join(sums, F.col("source").eqNullSafe(F.col("b_source")) & (F.col("bucket") == F.col("b_bucket")))
    s = sources.select(F.col("source").alias("s_source"), "source_size", "weight")
    run = run.join(s, F.col("source").eqNullSafe(F.col("s_source"))).where("weight > 0")
    copies = run.select("row_id", "doc_id", "source", "size", "place", "source_size", "weight", F.explode(F.sequence(F.lit(0), F.lit(p.max_repeats - 1))).alias("epoch"), (F.col("before") + F.col("within")).alias("upto"))
    copies = copies.withColumn("finish", (F.col("epoch") * F.col("source_size") + F.col("upto")) / F.col("weight")).drop("source_size", "weight", "upto")
    at = ["finish", "source", "place", "doc_id", "row_id", "epoch"]
    ranged = stored(copies.repartitionByRange(n_parts(spark), *at).withColumn("part", F.spark_partition_id()), "mixing-queue")
    parts = ranged.groupBy("part").agg(F.sum("size").alias("s"))
    # one row per range partition
    before = F.coalesce(F.sum("s").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    parts = parts.select("part", before.alias("before"), F.col("s").alias("all"))
    placed = ranged.join(parts, "part")
    whole = placed.where(F.col("before") + F.col("all") <= budget)
    cut = placed.where((F.col("before") + F.col("all") > budget) & (F.col("before") < budget))
    running = F.col("before") + F.sum("size").over(Window.partitionBy("part").orderBy(*at).rowsBetween(Window.unboundedPreceding, 0))
    cut = cut.withColumn("running", running).where(F.col("running") <= budget)
    columns = ["row_id", "doc_id", "source", "size", "epoch", "finish"]
    taken = stored(whole.select(columns).unionByName(cut.select(columns)), "mixing-taken")
    return taken.unionByName(_closing(taken, keyed, sources, p)), sources


def _closing(taken: DataFrame, keyed: DataFrame, sources: DataFrame, p: Mixing) -> DataFrame:
    """At most one more copy for each source that the queue's end left under its target: the
    one that brings it nearest (documents are whole, and one may be a good part of a small target)."""
    had = taken.groupBy("source").agg(F.sum("size").alias("had")).withColumnRenamed("source", "h_source")
    short = sources.join(had, F.col("source").eqNullSafe(F.col("h_source")), "left")
    short = short.select(F.col("source").alias("s_source"), (F.col("target") - F.coalesce("had", F.lit(0))).alias("short")).where("short > 0")
    used = taken.groupBy("row_id").agg(F.count("*").cast("int").alias("epoch"))
    free = keyed.join(used, "row_id", "left").withColumn("epoch", F.coalesce("epoch", F.lit(0))).where(F.col("epoch") < p.max_repeats)
    if sources.count() <= FEW_SOURCES:  # a source may hold a third of all rows: they stay where they are
        short = F.broadcast(short)
    free = free.join(short, F.col("source").eqNullSafe(F.col("s_source"))).where("size > 0 AND size < 2 * short")
    copy = F.struct("row_id", "doc_id", "size", "epoch")
    best = free.groupBy("source").agg(F.min_by(copy, F.struct(F.abs(F.col("short") - F.col("size")), "place", "doc_id", "row_id")).alias("c"))
    return best.select("c.row_id", "c.doc_id", "source", "c.size", "c.epoch", F.lit(float("inf")).alias("finish"))


def _sized(docs: DataFrame, size: Column) -> DataFrame:
    return stored(docs.select(F.monotonically_increasing_id().alias("row_id"), "doc_id", "source", size.alias("size")), "mixing-sizes")


def mix(docs: DataFrame, weights: DataFrame | None = None, p: Mixing = Mixing()) -> DataFrame:
    """(doc_id, size, source_size, target, taken) for every row of ``docs`` (doc_id, source, text).

    ``taken`` is the size times the copies that the queue took. A null text
    has size 0; a null source is a source; sources without a weight get
    nothing; repeated rows are documents of their own.
    """
    prepare(docs.sparkSession)
    sized = _sized(docs, n_words(F.col("text")))
    taken, sources = queue(sized, weights if weights is not None else cyclic_weights(sized), p)
    got = taken.groupBy("row_id").agg(F.sum("size").alias("taken"))
    s = sources.select(F.col("source").alias("s_source"), "source_size", "target")
    out = sized.join(got, "row_id", "left").join(s, F.col("source").eqNullSafe(F.col("s_source")))
    return out.select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("bigint").alias("taken"))


def mix_documents(docs: DataFrame, weights: DataFrame | None = None, p: Mixing = Mixing()) -> DataFrame:
    """The mixture itself: a row of ``docs`` for every copy the queue took, in queue order.

    Rows that agree in doc_id, source and size get their copies in the order
    of their texts. Documents without words have no size and are taken once
    each time the queue passes them.
    """
    prepare(docs.sparkSession)
    size = n_words(F.col("text"))
    sized = _sized(docs, size)
    taken, _ = queue(sized, weights if weights is not None else cyclic_weights(sized), p)
    times = taken.groupBy("row_id", "doc_id", "source", "size").agg(F.collect_list("finish").alias("mix_finish"))  # at most max_repeats
    key = ["doc_id", "source", "size"]
    number = F.row_number().over(Window.partitionBy(*key).orderBy("row_id"))
    times = sized.select("row_id", *key).withColumn("number", number).join(times.select("row_id", "mix_finish"), "row_id")
    times = times.select(*(F.col(c).alias(f"mix_{c}") for c in [*key, "number"]), "mix_finish")
    # the row is one struct, so its columns meet no name of the queue's
    rows = docs.select(F.struct(*docs.columns).alias("row"), "doc_id", "source", "text", size.alias("size"))
    rows = rows.withColumn("number", F.row_number().over(Window.partitionBy(*key).orderBy("text"))).drop("text")
    same = F.col("doc_id").eqNullSafe(F.col("mix_doc_id")) & F.col("source").eqNullSafe(F.col("mix_source"))
    same &= (F.col("size") == F.col("mix_size")) & (F.col("number") == F.col("mix_number"))
    mixed = rows.join(times, same).withColumn("mix_at", F.explode("mix_finish"))
    return mixed.repartitionByRange(n_parts(docs.sparkSession), "mix_at", "source", "doc_id").sortWithinPartitions("mix_at").select("row.*")
