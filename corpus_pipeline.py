"""From raw documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and works on all documents that the one before it kept; all but the last
return the columns of ``documents``.  ``run`` writes each stage's result as Parquet to the shared folder and rereads it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobsieve.llm import language, quality
from jobsieve.llm.decontaminate import contaminated
from jobsieve.llm.near_dedup import near_duplicates
from jobsieve.llm.packing import best_fit_pack
from jobsieve.llm.queries import BYTE_BPE, BYTE_RANKS
from jobsieve.llm.store import broadcast_if_small, table, written


def _keyed(docs: DataFrame) -> tuple[DataFrame, str]:
    """docs and a column that tells its rows apart: doc_id, or where ids are null or repeated a new one, which follows
    doc_id, nulls last."""
    again = written(docs.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1 or doc_id is null").select("doc_id"), "again")
    if again.isEmpty():
        return docs, "doc_id"
    key = "_key"
    while key in docs.columns:
        key += "_"
    # the texts' hashes keep one id with many rows from being one task
    ordered = docs.sort(F.asc_nulls_last("doc_id"), F.xxhash64("text"))
    return written(ordered.withColumn(key, F.monotonically_increasing_id()), "keyed"), key


def _without(docs: DataFrame, key: str, dropped: DataFrame) -> DataFrame:
    """docs without the rows of the given keys."""
    keys = written(dropped.select(key).distinct(), "dropped")
    return docs.join(broadcast_if_small(keys, keys.count()), key, "left_anti")


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without a language: null texts, texts without a letter, and those that no language fits best.  Rows that
    repeat an id or have none are judged each by its text."""
    return language.kept_languages(docs, language.fit(docs, BYTE_RANKS))


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents whose neighbours in the latent space are mostly of low quality.  Rows that repeat an id or have none are
    judged each by its text."""
    return quality.kept_quality(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest doc_id of each group of near-duplicates, nulls last.  Rows that repeat an id
    or have none are documents of their own, judged by their texts."""
    keyed, key = _keyed(docs)
    found = near_duplicates(keyed, id_col=key).where(~F.col("kept"))
    return _without(keyed, key, found.select(F.col("doc_id").alias(key))).select(docs.columns)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str, least_words: int = 1) -> DataFrame:
    """Drops documents that hold an item of the benchmark, of any size unless least_words says otherwise; rows that repeat an id or
    have none are judged by their texts."""
    keyed, key = _keyed(docs)
    found = contaminated(keyed, table(spark, sf_dir, "benchmark"), least_words=least_words, id_col=key)
    return _without(keyed, key, found.select(F.col("doc_id").alias(key))).select(docs.columns)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs what is left into sequences of 2048 tokens, each row for itself, whatever its id."""
    return best_fit_pack(docs, BYTE_BPE)


STAGES = [
    ("language_id", language_id),
    ("quality_classifier", quality_classifier),
    ("minhash_near_dedup", near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("best_fit_packing", best_fit_packing),
]

#: The stages rest on fitted models and on token ids, which SQL can't express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
