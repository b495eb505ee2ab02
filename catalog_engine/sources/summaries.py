"""Summary sources (S6, S7): earlier global stats and per-batch summary
files read back as tables (glob read, the folder name kept per row)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import path_exists

BATCH_SUMMARY = T.StructType([
    T.StructField("batch_number", T.IntegerType()),
    T.StructField("start_offset", T.LongType()),
    T.StructField("pages_per_batch", T.LongType()),
    T.StructField("total_pages", T.LongType()),
    T.StructField("total_products", T.LongType()),
    T.StructField("matched_products", T.LongType()),
    T.StructField("end_offset", T.LongType()),
])

GLOBAL_STATS = T.StructType([
    T.StructField("total_pages", T.LongType()),
    T.StructField("total_products", T.LongType()),
    T.StructField("matched_products", T.LongType()),
    T.StructField("total_batches", T.LongType()),
])


def read_batch_summaries(spark: SparkSession, run_dir: str, schema: T.StructType = BATCH_SUMMARY) -> DataFrame:
    """Every batch folder's summary under a run folder (folders named
    ``batch_number=N``); a batch folder without a summary is simply absent;
    ``batch_dir`` is the folder the row came from."""
    df = spark.read.schema(schema).json(run_dir)
    return df.withColumn("batch_dir", F.regexp_extract(F.input_file_name(), r"(.*/batch_number=[^/]+)/", 1))


def read_global_stats(spark: SparkSession, path: str) -> DataFrame:
    """Previous totals (other keys such as processed URLs are
    ignored by the schema); empty when nothing was saved yet."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], GLOBAL_STATS)
    return spark.read.schema(GLOBAL_STATS).json(path)


def run_totals_folder(base: str, run_id: str) -> str:
    """Where a run leaves its own totals; writing them again changes nothing."""
    return f"{base}/run_totals/run_id={run_id}"


def read_latest_global_stats(spark: SparkSession, base: str) -> DataFrame:
    """The totals over all runs below ``base`` that ended; empty before the
    first run."""
    folder = f"{base}/run_totals"
    if not path_exists(spark, folder):
        return spark.createDataFrame([], GLOBAL_STATS)
    rows = spark.read.schema(GLOBAL_STATS).json(folder)
    return rows.agg(*[F.sum(f.name).cast("bigint").alias(f.name) for f in GLOBAL_STATS])


def read_final_summary(spark: SparkSession, base: str, run_id: str) -> DataFrame:
    """K6: a run's final summary, read back."""
    schema = T.StructType([*GLOBAL_STATS, T.StructField("batch_summaries", T.StringType()), T.StructField("match_percentage", T.DoubleType()),
                           T.StructField("completion_date", T.TimestampType())])
    return spark.read.schema(schema).json(f"{base}/runs/{run_id}/final_summary")
