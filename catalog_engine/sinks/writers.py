"""Sinks (K1-K6) and the versioned state snapshot.

* Output batches (K1): ``batch_number = ceil(rank / N)`` in a total
  order, computed without a single-partition window: a range shuffle on
  the order keys, per-partition row numbers, per-partition counts turned
  into offsets over the (few) partitions, added back.
* State snapshots (K2): every write goes to a new version folder below a
  shared base path and is then published by a pointer row in a folder of its
  own; pointers are never overwritten. Readers take the highest complete
  pointer, so a half-written version is never seen. Only a missing folder
  counts as an empty state; a storage failure is raised.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import cut_lineage, path_exists

# Fixed value (must equal the reference's default): products per file.
BATCH_SIZE = 500


def number_batches(df: DataFrame, order: list[str], batch_size: int = BATCH_SIZE,
                   partitions: int | None = None) -> DataFrame:
    """K1: ``batch_number`` (1-based) for every ``batch_size`` rows in
    ``order`` (which must be a total order); the last batch is partial."""
    spark = df.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(n, *order).withColumn("_pid", F.spark_partition_id())
    local = Window.partitionBy("_pid").orderBy(*order)
    # range bounds come from sampling; materialise the ranks once (reliable
    # checkpoint in the shared folder) so counts and rows agree on _pid
    ranked = cut_lineage(ranged.withColumn("_local", F.row_number().over(local)))
    counts = ranked.groupBy("_pid").agg(F.max("_local").alias("_cnt"))
    offsets = counts.select("_pid", (F.sum("_cnt").over(Window.orderBy("_pid")) - F.col("_cnt")).alias("_base"))
    out = ranked.join(F.broadcast(offsets), "_pid")
    rank = F.col("_base") + F.col("_local")
    return (out.withColumn("batch_number", F.ceil(rank / F.lit(batch_size)).cast("int"))
            .drop("_pid", "_local", "_base"))


def write_batches(df: DataFrame, path: str, fmt: str = "json") -> None:
    """K1: one folder per batch (UTF-8 JSON keeps non-ASCII text)."""
    df.write.mode("overwrite").partitionBy("batch_number").format(fmt).save(path)


def write_batch_summaries(summaries: DataFrame, run_dir: str) -> None:
    """K4: one JSON summary per batch folder ``batch_number=N``."""
    summaries.write.mode("overwrite").partitionBy("batch_number").json(run_dir)


def write_summary(df: DataFrame, path: str) -> None:
    """K3-K6: one-row summaries as JSON (coalesced: a single row)."""
    df.coalesce(1).write.mode("overwrite").json(path)


POINTER = T.StructType([T.StructField("version", T.LongType()),
                        T.StructField("path", T.StringType()),
                        T.StructField("run_id", T.StringType()),
                        T.StructField("batch_id", T.LongType()),
                        T.StructField("size", T.LongType()),
                        T.StructField("matched_count", T.LongType()),
                        T.StructField("last_saved", T.TimestampType())])


def published(spark: SparkSession, base: str) -> DataFrame:
    """K2: one row per published snapshot with its metadata (size, matched
    count, time, and the run and micro-batch that wrote it)."""
    folder = os.path.join(base, "_published")
    if not path_exists(spark, folder):
        return spark.createDataFrame([], POINTER)
    # a pointer that broke off has no row: Spark commits the file as a whole
    return spark.read.schema(POINTER).option("recursiveFileLookup", "true").parquet(folder)


def current_pointer(spark: SparkSession, base: str):
    """The pointer row of the current snapshot, or None."""
    return published(spark, base).orderBy(F.col("version").desc()).first()


def publish_state(state: DataFrame, base: str, version: int, *, run_id: str = "", batch_id: int = -1,
                  buckets: int | None = None) -> str:
    """K2: write ``state`` as snapshot ``version`` and publish it.

    Every version is a whole snapshot, clustered by a hash of the url;
    ``buckets`` is the number of files (the session's shuffle parallelism
    unless given)."""
    spark = state.sparkSession
    path = os.path.join(base, f"v={version:012d}")
    spread = state.repartition(buckets, "url") if buckets else state.repartition("url")
    spread.sortWithinPartitions("url").write.mode("overwrite").parquet(path)
    written = spark.read.schema(state.schema).parquet(path)
    matched = F.count_if(F.coalesce(F.col("matched"), F.lit(False))) if "matched" in state.columns else F.lit(0)
    row = written.agg(F.lit(version).cast("long").alias("version"), F.lit(path).alias("path"),
                      F.lit(run_id).alias("run_id"), F.lit(batch_id).cast("long").alias("batch_id"),
                      F.count(F.lit(1)).alias("size"), matched.cast("long").alias("matched_count"),
                      F.current_timestamp().alias("last_saved"))
    row.coalesce(1).write.mode("overwrite").parquet(os.path.join(base, "_published", f"v={version:012d}"))
    return path


def read_state(spark: SparkSession, base: str, schema: T.StructType) -> DataFrame:
    """The published snapshot, or an empty state when none exists."""
    row = current_pointer(spark, base)
    if row is None:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(row["path"])


def clear_state(spark: SparkSession, base: str, schema: T.StructType, version: int) -> str:
    """Publish an empty snapshot as the next version."""
    return publish_state(spark.createDataFrame([], schema), base, version)
