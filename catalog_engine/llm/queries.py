"""The registered queries of this folder: each operator on its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog_engine.llm import conversation_repair, decontaminate, divergence_audit, embedding_dedup, fingerprints, html_text, line_dedup, ngram_join, ordered_shards, packing, quality, sharding, token_rollup
from catalog_engine.llm.common import new_folder
from catalog_engine.session import table



def _selected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents that the classifier keeps."""
    kept = quality.select_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return kept.select("doc_id", "expected_grade", "tail_probability", F.lit(True).alias("keep"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_stratified_shards": lambda spark, sf_dir: sharding.shard(table(spark, sf_dir, "documents")),
    "op2_ordinal_quality": lambda spark, sf_dir: _selected(spark, sf_dir),
    "op3_embedding_neardup": lambda spark, sf_dir: embedding_dedup.link_vectors(table(spark, sf_dir, "embeddings")),
    "op4_training_order": lambda spark, sf_dir: ordered_shards.materialise(table(spark, sf_dir, "documents"), ordered_shards.shards_folder(spark)),
    "op5_best_fit_packing": lambda spark, sf_dir: packing.pack(table(spark, sf_dir, "documents")),
    "op6_decontamination": lambda spark, sf_dir: decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")),
    "op7_ngram_join": lambda spark, sf_dir: ngram_join.link_classes(table(spark, sf_dir, "documents")),
    "op8_line_dedup": lambda spark, sf_dir: line_dedup.drop_boilerplate(table(spark, sf_dir, "documents")).select("doc_id", "n_lines", "n_removed", "text"),
    "op9_token_counts": lambda spark, sf_dir: token_rollup.rollup(table(spark, sf_dir, "documents"), new_folder(spark, "token-rollup")),
    "op10_html_text": lambda spark, sf_dir: html_text.extract(table(spark, sf_dir, "pages")),
    "op11_divergence_audit": lambda spark, sf_dir: divergence_audit.audit(table(spark, sf_dir, "documents")),
    "op12_document_fingerprints": lambda spark, sf_dir: fingerprints.fingerprints(table(spark, sf_dir, "documents")),
    "op13_conversation_repair": lambda spark, sf_dir: conversation_repair.repair(table(spark, sf_dir, "conversations")),
}

#: DuckDB SQL for the queries that SQL can express over whole tables.
ORACLE: dict[str, str] = {
    "op1_stratified_shards": sharding.oracle_sql(),
    "op8_line_dedup": line_dedup.ORACLE_SQL,
    "op10_html_text": html_text.ORACLE_SQL,
    "op11_divergence_audit": divergence_audit.ORACLE_SQL,
    "op12_document_fingerprints": fingerprints.ORACLE_SQL,
    "op13_conversation_repair": conversation_repair.ORACLE_SQL,
}
