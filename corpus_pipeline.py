"""The corpus pipeline: five stages over whole documents, each written and read again.

quality rules -> n-gram Jaccard join -> substring dedup -> mixing -> packing

A stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last
return the columns of ``documents``. ``run`` writes each stage's rows to the
shared scratch folder, so a stage starts from files and lost executors cost
a stage's tasks at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulse.llm.frames import stored, table
from pulse.llm.jaccard_join import keep_one
from pulse.llm.mixing import mix_documents
from pulse.llm.packing import Packing, pack_documents
from pulse.llm.quality_rules import judge
from pulse.llm.queries import tokenizer_path
from pulse.llm.substring_dedup import remove_repeats


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the divergence from their language."""
    return judge(docs).where("kept").select(docs.columns)


def jaccard_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents the one with the smallest doc_id."""
    return keep_one(docs)


def substring_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without their repeated passages (n_chars follows); documents of which
    nothing is left go."""
    cut = remove_repeats(docs).where("n_removed < n_words OR n_words = 0")
    if "n_chars" in docs.columns:
        length = F.length("text").cast(docs.schema["n_chars"].dataType)
        cut = cut.withColumn("n_chars", F.when(F.col("n_removed") > 0, length).otherwise(F.col("n_chars")))
    return cut.select(docs.columns)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mixture of the sources: a row for each copy that the queue takes."""
    return mix_documents(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the mixture's documents with their places in sequences."""
    return pack_documents(docs, Packing(tokenizer_path()))


STAGES = [
    ("quality_rules", quality_stage),
    ("ngram_jaccard_join", jaccard_stage),
    ("substring_dedup", substring_stage),
    ("mixing", mixing_stage),
    ("best_fit_packing", packing_stage),
]

#: SQL cannot express the stages; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages applied to ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
