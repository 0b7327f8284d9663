"""The queries opN_<name> over the supplied tables: thin calls of the operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulse.llm.block_ann import nearest, usable
from pulse.llm.conversation_repair import damage, repair, reports
from pulse.llm.frames import stored, table
from pulse.llm.hard_negatives import mine
from pulse.llm.hard_negatives import usable as usable_labelled
from pulse.llm.jaccard_join import jaccard_components
from pulse.llm.language_id import fit as fit_languages
from pulse.llm.language_id import identify
from pulse.llm.license_scan import scan
from pulse.llm.mixing import mix
from pulse.llm.packing import Packing, pack_documents
from pulse.llm.quality_knn import classify, sample
from pulse.llm.quality_knn import fit as fit_quality
from pulse.llm.quality_rules import judge
from pulse.llm.substring_dedup import joined_words, remove_repeats
from pulse.llm.suffix_dedup import remove_substrings
from pulse.llm.url_filter import judge_urls


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def remainder(doc_id: str, n: int):
    """crc32 of doc_id as text, modulo n."""
    return F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(n))


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    held_out = F.coalesce(remainder("doc_id", 4) == 2, F.lit(False))
    fitted = fit_languages(docs.where(~held_out).select("lang", "text"))
    found = identify(docs.select("doc_id", "text"), fitted, without=("text",))
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "cross_entropy", "rejected")


#: The rules (host, path, verdict) that op2 judges by.
URL_RULES = [
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
]


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "rule_host string, rule_path string, rule_verdict string")
    return judge_urls(table(spark, sf_dir, "pages").select("page_id", "url"), rules).drop("url")


def op3_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents"))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = judge(table(spark, sf_dir, "documents").select("doc_id", "lang", "text"))
    return out.drop("lang", "text")


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents"))


def op6_block_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = stored(usable(table(spark, sf_dir, "embeddings")), "ann-vectors")
    return nearest(vectors, vectors.where("vec_id % 20 = 0"))


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents"))


def op8_quality_knn(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = F.coalesce(remainder("doc_id", 5) == 0, F.lit(False))
    labels = table(spark, sf_dir, "labels").where(~held_out).select("doc_id", F.col("quality").alias("label"))
    found = classify(docs, fit_quality(sample(docs, labels)))
    return found.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2(joined_words(F.col("text")), 256).alias("kept_sha256"))


def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"), Packing(tokenizer_path()))


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports(repair(damage(table(spark, sf_dir, "conversations")), copies="copies"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = table(spark, sf_dir, "embeddings").select("vec_id", label.alias("label"), "embedding")
    vectors = stored(usable_labelled(rows), "mining-vectors")
    return mine(vectors, vectors.where("vec_id % 100 = 0"))


def op13_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = remove_substrings(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def queries():
    """Every query of this subpackage by name."""
    return {name: fn for name, fn in globals().items() if name.startswith("op") and callable(fn)}
