"""Incremental runs with Structured Streaming.

* T1 bounded incremental run: a file source read with
  ``maxFilesPerTrigger`` and ``trigger(availableNow=True)`` processes the
  pages present now in groups of files, then stops.
* T2 resume: the query's ``checkpointLocation`` records which files were
  committed; sinks are idempotent per run and ``batchId`` (a run is named by
  its checkpoint): each micro-batch overwrites its own ``run=R/batch_id=N``
  folder, or publishes the next state version with that mark, once; so a
  replayed batch after a crash writes the same result, and a new run with a
  new checkpoint adds to what earlier runs left.
* T3 cross-batch URL dedup: inside each micro-batch the first occurrence
  (offset, page, position) is kept, then URLs already written by earlier
  batches or runs are removed with an anti join against the output table.
* T4 stream -> extract -> match -> state upsert, one state version per
  micro-batch, numbered on from the last published one.
* T5 running totals: counts per run and micro-batch, committed once each;
  the totals are their sum.

All folders live below the shared checkpoint folder (``spark.checkpoint.dir``).
"""

from __future__ import annotations

import hashlib
import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import extract as E
from ..operators import links as L
from ..operators import state as ST
from ..session import path_exists, scratch_path
from ..sinks import writers as W


def new_run_dir(spark: SparkSession, name: str) -> str:
    return scratch_path(spark, f"{name}-{uuid.uuid4().hex[:12]}")


def run_name(checkpoint: str) -> str:
    """A run is what one checkpoint records."""
    return hashlib.sha256(checkpoint.encode()).hexdigest()[:16]


#: Files of one increment of ``stage_files``; a micro-batch takes as many.
FILES_PER_INCREMENT = 2


def stage_files(df: DataFrame, path: str, increments: int, order: str) -> None:
    """Write ``df`` as ``increments`` increments, one append after the other
    in ``order`` (files arrive in crawl order, as they would from a crawler),
    so a file stream sees the data in several micro-batches. The table is
    computed once; rows without an order key arrive first."""
    spark, staged = df.sparkSession, f"{path}-staged-{uuid.uuid4().hex[:12]}"
    lo, hi = df.agg(F.min(order), F.max(order)).first()
    width = ((hi - lo + 1) / increments) if lo is not None else 1
    bucket = F.coalesce(F.floor((F.col(order) - F.lit(lo)) / F.lit(width)).cast("int"), F.lit(0))
    df.withColumn("_increment", bucket).write.partitionBy("_increment").parquet(staged)
    rows = spark.read.schema(T.StructType([*df.schema, T.StructField("_increment", T.IntegerType())])).parquet(staged)
    for b in range(increments):
        (rows.filter(F.col("_increment") == b).drop("_increment")
         .repartitionByRange(FILES_PER_INCREMENT, order).write.mode("append").parquet(path))


def _read_done(spark: SparkSession, out: str, schema) -> DataFrame:
    if not path_exists(spark, out):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(out)


def run_link_stream(spark: SparkSession, source: str, out: str, checkpoint: str,
                    schema, files_per_trigger: int = FILES_PER_INCREMENT) -> None:
    """T1 + T2 + T3: listing pages -> first-seen product links. The links of
    earlier runs below ``out`` count as seen."""
    link_cols = ["full_url", "page_id", "pos", "offset", "page_number"]
    run = run_name(checkpoint)

    def process(batch: DataFrame, batch_id: int) -> None:
        links = L.first_seen(L.product_links(batch)).select(*link_cols)
        done = _read_done(spark, out, T.StructType([*links.schema, T.StructField("run", T.StringType()),
                                                    T.StructField("batch_id", T.LongType())]))
        own = (F.col("run") == run) & (F.col("batch_id") == batch_id)
        new = links.join(done.filter(~own).select("full_url"), "full_url", "left_anti")
        # idempotent: a replay overwrites its own folder
        new.write.mode("overwrite").parquet(os.path.join(out, f"run={run}", f"batch_id={batch_id}"))

    q = (spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(source)
         .writeStream.foreachBatch(process).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()


def run_state_stream(spark: SparkSession, source: str, state_base: str, checkpoint: str, schema,
                     catalogue: DataFrame, threshold: float = 90, files_per_trigger: int = FILES_PER_INCREMENT,
                     after_publish=None) -> None:
    """T4: product pages -> extract -> match -> upsert into the state. Each
    micro-batch publishes the next version; one that is published already
    (a replay after a crash) is left as it is. ``after_publish`` is called with
    the batch id when a version stands."""
    from ..operators.extract import match_products

    run = run_name(checkpoint)

    def process(batch: DataFrame, batch_id: int) -> None:
        earlier = W.published(spark, state_base)
        if earlier.filter((F.col("run_id") == run) & (F.col("batch_id") == batch_id)).isEmpty():
            last = W.current_pointer(spark, state_base)
            version = last["version"] + 1 if last else 1
            # the page order, however the batch was split into files
            placed = batch.withColumn("pos", F.col("page_id").cast("long") if "page_id" in batch.columns else F.xxhash64("url", "html"))
            extracted = E.extract_products(placed).select("url", "full_name", "page_number", "error", "pos")
            products = match_products(extracted, catalogue, threshold=threshold)
            rows = products.select("url", "full_name", "matched", "matched_name", "category", "page_number",
                                   "error", "pos", F.lit(version).cast("long").alias("version"))
            current = W.read_state(spark, state_base, rows.schema)
            W.publish_state(ST.upsert(current, rows), state_base, version, run_id=run, batch_id=batch_id)
        if after_publish:
            after_publish(batch_id)

    q = (spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(source)
         .writeStream.foreachBatch(process).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()


TOTALS = ["total_products", "named_products", "error_products"]


def run_totals_stream(spark: SparkSession, source: str, out: str, checkpoint: str, schema,
                      files_per_trigger: int = FILES_PER_INCREMENT, after_commit=None) -> None:
    """T5: running totals over extracted products. Every micro-batch commits its
    own counts under (run, batch id); the totals are their sum (``read_totals``),
    so a replay changes nothing and a further run adds to them. ``after_commit`` is
    called with the batch id when its counts stand."""
    run = run_name(checkpoint)

    def process(batch: DataFrame, batch_id: int) -> None:
        products = E.extract_products(batch)
        counts = products.agg(F.count(F.lit(1)).alias("total_products"), F.count("full_name").alias("named_products"),
                              F.count("error").alias("error_products"))
        counts.coalesce(1).write.mode("overwrite").parquet(os.path.join(out, f"run={run}", f"batch_id={batch_id}"))
        if after_commit:
            after_commit(batch_id)

    q = (spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(source)
         .writeStream.foreachBatch(process).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()


def read_totals(spark: SparkSession, out: str) -> DataFrame:
    """The totals over all committed micro-batches; zeros before the first."""
    counts = _read_done(spark, out, T.StructType([T.StructField(c, T.LongType()) for c in TOTALS]))
    return counts.agg(*[F.coalesce(F.sum(c), F.lit(0)).cast("bigint").alias(c) for c in TOTALS])
