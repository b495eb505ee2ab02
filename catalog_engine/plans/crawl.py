"""One whole run: listing pages -> links -> routes -> fetched product pages ->
extraction -> match -> state (with re-matched rows) -> output batches ->
summaries and global stats, each written below one folder and read back by the
next run."""

from __future__ import annotations

import os
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import extract as E
from ..operators import links as L
from ..operators import reports as R
from ..operators import state as ST
from ..session import cut_lineage, path_exists
from ..sinks import writers as W
from ..sources import summaries as SS
from ..sources.catalogue import validate_catalogue

STATE_SCHEMA = ("url string, full_name string, matched boolean, matched_name string, category string, "
                "page_number int, error string, pos bigint, version bigint")
NOT_FETCHED = "page not fetched"


def run_crawl(spark: SparkSession, listing: DataFrame, product_pages: DataFrame, catalogue: DataFrame, base: str, *,
              run_id: str, threshold: float = 90, batch_size: int = W.BATCH_SIZE, catalogue_mode: str = "fail",
              reason: str = "finished") -> DataFrame:
    """Run over ``listing`` (page_id, url, html) with the ``product_pages``
    (url, html) that are there for links to fetch; returns the products with
    their output batch, as read back from the batch files.

    Below ``base``: ``state`` (versioned), and per run ``runs/<run_id>`` with
    ``products``, ``batches``, ``summaries``, ``crawl_summary`` and
    ``final_summary``; ``run_totals/run_id=<run_id>`` holds the run's own totals,
    and the global stats are the sum over the runs. A link whose page is not there
    becomes an error row.

    A run may be called again with its ``run_id``, after it ended or broke off
    anywhere: its products are written first and found there by the next call, so
    that links it has added to the state since are not taken for cached; its
    state version is published once; every other folder is overwritten with the
    same rows. So nothing is counted twice and nothing is lost."""
    started = datetime.now(timezone.utc)
    catalogue = validate_catalogue(catalogue, catalogue_mode)
    folder, state_base = os.path.join(base, "runs", run_id), os.path.join(base, "state")
    schema = spark.createDataFrame([], STATE_SCHEMA).schema
    kept = os.path.join(folder, "products")
    # Spark commits the folder as a whole: with its mark it is complete
    if not path_exists(spark, os.path.join(kept, "_SUCCESS")):
        _products(spark, listing, product_pages, catalogue, W.read_state(spark, state_base, schema), threshold).write.mode("overwrite").parquet(kept)
    products = spark.read.parquet(kept)

    published = W.published(spark, state_base)
    if published.filter(F.col("run_id") == run_id).isEmpty():
        last = W.current_pointer(spark, state_base)
        version = last["version"] + 1 if last else 1
        # what was fetched or matched anew is written back; cached rows stand already
        updates = (products.filter(F.col("route") != "emit_cached").withColumn("version", F.lit(version).cast("bigint"))
                   .select(*[f.name for f in schema]))
        state = W.read_state(spark, state_base, schema)
        W.publish_state(ST.upsert(state, updates), state_base, version, run_id=run_id, batch_id=0)

    W.write_batches(W.number_batches(products, ["page_number", "pos", "url"], batch_size), os.path.join(folder, "batches"))
    W.write_batch_summaries(R.batch_summary(products), os.path.join(folder, "summaries"))
    times = {"start_time": F.lit(started), "end_time": F.current_timestamp()}
    W.write_summary(R.crawl_summary(products, products_per_batch=batch_size, reason=reason).withColumns(times), os.path.join(folder, "crawl_summary"))
    summaries = SS.read_batch_summaries(spark, os.path.join(folder, "summaries")).drop("batch_dir")
    W.write_summary(R.final_summary(summaries).withColumn("completion_date", F.current_timestamp()), os.path.join(folder, "final_summary"))
    # last: the run counts once this is there
    W.write_summary(R.global_stats(summaries), SS.run_totals_folder(base, run_id))
    batched = T.StructType([*products.schema, T.StructField("batch_number", T.IntegerType())])
    return spark.read.schema(batched).json(os.path.join(folder, "batches"))


def _products(spark: SparkSession, listing: DataFrame, product_pages: DataFrame, catalogue: DataFrame, state: DataFrame,
              threshold: float) -> DataFrame:
    links = L.first_seen(L.product_links(listing)).select("full_url", "page_id", "pos", "offset", "page_number")
    routed = cut_lineage(ST.route_links(links, state, catalogue, threshold=threshold, with_name=True))
    wanted = routed.filter(F.col("route") == "fetch").select(F.col("full_url").alias("url"), "pos", "offset", "page_number", "route")
    # Spark takes a page for as long as any string, so that it would broadcast all of them
    pages = wanted.join(product_pages.select("url", "html").hint("merge"), "url", "left")
    products = E.extract_products(pages).select("url", "full_name", "page_number", "pos", "offset", "route", "error")
    found = E.match_products(products, catalogue, threshold=threshold)
    common = ["url", "full_name", "page_number", "pos", "offset", "route", "matched", "matched_name", "category", "error"]
    fetched = found.withColumn("error", F.when(F.col("error").isNotNull(), F.lit(NOT_FETCHED))).select(*common)
    emitted = (routed.filter(F.col("route").isin("emit_cached", "emit_rematched"))
               .withColumn("error", F.lit(None).cast("string")).withColumnRenamed("full_url", "url").select(*common))
    return emitted.unionByName(fetched)
