"""The training-data pipeline: documents in, packed token sequences out.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor
kept; its result is written as Parquet into the shared folder and read again.
All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog_engine.llm import decontaminate, line_dedup, ngram_join, packing, quality
from catalog_engine.llm.common import free_name, stored
from catalog_engine.session import table

#: Near-duplicate stage: shingles of five words, similarity of 0.8 or more.
NEAR_WORDS = 5
NEAR_THRESHOLD = 80


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose probability of the best grade reaches the bar."""
    return quality.select_documents(docs, table(spark, sf_dir, "labels")).select(*docs.columns)


def line_deduplication(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Boilerplate lines out of the texts; ``n_chars`` follows. No row goes."""
    cleaned = line_dedup.drop_boilerplate(docs).select(*docs.columns)
    return cleaned.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else cleaned


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the least doc_id."""
    return ngram_join.one_of_each(docs, threshold=NEAR_THRESHOLD, words=NEAR_WORDS)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    uid = free_name(docs, "_uid")
    marked = docs.withColumn(uid, F.xxhash64("doc_id", "text"))
    found = decontaminate.contaminated(marked.select(F.col(uid).alias("doc_id"), "text"), table(spark, sf_dir, "benchmark"))
    return marked.join(found.select(F.col("doc_id").alias(uid)).distinct(), uid, "left_anti").select(*docs.columns)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 4,096 tokens: a row per piece, with its place."""
    return packing.pack(docs)


STAGES = [
    ("quality classifier", quality_classifier),
    ("line dedup", line_deduplication),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("best-fit packing", best_fit_packing),
]

#: The classifier and the tokenizer cannot be written in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return docs
