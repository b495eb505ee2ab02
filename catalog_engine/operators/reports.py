"""Aggregations and reports.

Per-page, per-batch and overall counts are one aggregation each (partial
on the map side, final after one small shuffle); nested lists are only
built over the batch summaries, whose number is bounded by the run plan
(ceil(total pages / pages per batch)), never over products.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .links import PAGES_PER_BATCH


def page_stats(routed: DataFrame) -> DataFrame:
    """A1: products on each page, how many came from the state, and how
    many of those were matched."""
    return routed.groupBy("page_number").agg(
        F.count(F.lit(1)).alias("page_products"),
        F.count_if(F.col("cached")).alias("cached_products"),
        F.count_if(F.col("route") == "emit_cached").alias("matched_cached_products"))


def run_totals(products: DataFrame, *more) -> DataFrame:
    """A2 + A3: pages, products, matched and the match ratio in percent;
    ``more`` aggregates ride along in the same pass."""
    agg = products.agg(
        F.count_distinct("page_number").alias("total_pages"),
        F.count(F.lit(1)).alias("total_products"),
        F.count_if(F.coalesce(F.col("matched"), F.lit(False))).alias("matched_products"), *more)
    return agg.withColumn(
        "match_ratio",
        F.coalesce(100.0 * F.try_divide(F.col("matched_products"), F.col("total_products")), F.lit(0.0)))


def with_batch_number(df: DataFrame, pages_per_batch: int = PAGES_PER_BATCH, start: int = 0,
                      offset: str = "offset") -> DataFrame:
    return df.withColumn("batch_number",
                         (F.floor((F.col(offset) - start) / pages_per_batch) + 1).cast("int"))


def batch_summary(products: DataFrame, pages_per_batch: int = PAGES_PER_BATCH, start: int = 0) -> DataFrame:
    """A4/K4: one summary per plan batch."""
    b = with_batch_number(products, pages_per_batch, start)
    return b.groupBy("batch_number").agg(
        (F.lit(start) + (F.col("batch_number") - 1) * pages_per_batch).cast("bigint").alias("start_offset"),
        F.lit(pages_per_batch).cast("bigint").alias("pages_per_batch"),
        F.count_distinct("offset").alias("total_pages"),
        F.count(F.lit(1)).alias("total_products"),
        F.count_if(F.coalesce(F.col("matched"), F.lit(False))).alias("matched_products"),
        F.max("offset").alias("end_offset"))


def _totals(summaries: DataFrame) -> list:
    def z(c):
        return F.coalesce(F.col(c), F.lit(0)) if c in summaries.columns else F.lit(0)
    return [*[F.sum(z(c)).cast("bigint").alias(c) for c in ("total_pages", "total_products", "matched_products")],
            F.count(F.lit(1)).alias("total_batches")]


def global_stats(summaries: DataFrame) -> DataFrame:
    """A5: totals over batch summaries, absent fields count as 0."""
    return summaries.agg(*_totals(summaries))


def final_summary(summaries: DataFrame) -> DataFrame:
    """Global totals, match percentage and the batch list nested
    in batch order as a JSON document (bounded by the number of plan
    batches), in one pass over the summaries."""
    lst = F.to_json(F.sort_array(F.collect_list(F.struct(*[F.col(c) for c in summaries.columns]))))
    return (summaries.agg(*_totals(summaries), lst.alias("batch_summaries"))
            .withColumn("match_percentage",
                        F.coalesce(100.0 * F.try_divide(F.col("matched_products"), F.col("total_products")),
                                   F.lit(0.0))))


def summary_rollup(products: DataFrame, pages_per_batch: int = PAGES_PER_BATCH, start: int = 0) -> DataFrame:
    """Per-batch rows and the grand total in one pass (rollup)."""
    b = with_batch_number(products, pages_per_batch, start)
    return (b.rollup("batch_number")
            .agg(F.count(F.lit(1)).alias("total_products"),
                 F.count_if(F.coalesce(F.col("matched"), F.lit(False))).alias("matched_products"),
                 F.count_distinct("offset").alias("total_pages"),
                 F.grouping_id().alias("level")))


def match_status(products: DataFrame) -> DataFrame:
    """Distribution of outcomes (matched / unmatched / error /
    missing_name)."""
    status = (F.when(F.col("error").isNotNull(), F.lit("error"))
              .when(F.col("full_name").isNull(), F.lit("missing_name"))
              .when(F.coalesce(F.col("matched"), F.lit(False)), F.lit("matched"))
              .otherwise(F.lit("unmatched")))
    return products.groupBy(status.alias("status")).agg(F.count(F.lit(1)).alias("products"))


def crawl_summary(products: DataFrame, *, total_batches: int | None = None,
                  products_per_batch: int = 500, reason: str = "finished") -> DataFrame:
    """K3: the run's summary row — pages, products, matched, match ratio,
    output batches, products per batch, last page processed, reason."""
    t = run_totals(products, F.max("page_number").cast("bigint").alias("last_page_processed"))
    nb = (F.lit(total_batches).cast("bigint") if total_batches is not None
          else F.ceil(F.col("total_products") / F.lit(products_per_batch)).cast("bigint"))
    return (t.withColumn("total_batches", nb)
            .withColumn("products_per_batch", F.lit(products_per_batch).cast("bigint"))
            .withColumn("reason", F.lit(reason)))


def add_to_global(previous: DataFrame, summaries: DataFrame) -> DataFrame:
    """S6 + A5/K5: previous global totals plus the new batch summaries."""
    new = global_stats(summaries)
    both = previous.select("total_pages", "total_products", "matched_products", "total_batches") \
        .unionByName(new.select("total_pages", "total_products", "matched_products", "total_batches"))
    return both.agg(*[F.sum(F.coalesce(F.col(c), F.lit(0))).cast("bigint").alias(c)
                      for c in ["total_pages", "total_products", "matched_products", "total_batches"]])
