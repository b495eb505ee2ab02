"""Catalogue sources (S1-S3) and the de-duplicated match side.

A catalogue row is ``(idx, brand, name, category)``; ``idx`` is the list
position and decides ties (first occurrence wins for dedup and for the best
match, last occurrence wins for the category lookup).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import full_name

CATALOGUE_ITEM = T.StructType([
    T.StructField("brand", T.StringType()),
    T.StructField("name", T.StringType()),
    T.StructField("category", T.StringType()),
])


class CatalogueError(ValueError):
    """The whole load is rejected (reference: any item without brand/name)."""


def read_catalogue_json(spark: SparkSession, path: str) -> DataFrame:
    """A JSON array of objects -> ``(idx, brand, name, category)``.

    The list position is needed for tie-breaks, so the array is parsed with
    ``from_json`` + ``posexplode`` (one JSON document is one unsplittable
    input anyway); every later step is distributed.
    """
    raw = spark.read.text(path, wholetext=True)
    items = F.from_json(F.col("value"), T.ArrayType(CATALOGUE_ITEM))
    return (raw.select(F.posexplode(items).alias("idx", "item"))
            .select(F.col("idx").cast("long").alias("idx"), "item.brand", "item.name", "item.category"))


def read_catalogue_files(spark: SparkSession, path: str) -> DataFrame:
    """S1 over many files: every file below ``path`` is one JSON array of
    objects; the list goes on from file to file in the order of their paths.

    A file is parsed as a VARIANT by one task; an item's place is its file's
    first position (the items of the files before) plus its place in the file.
    Only one row per file goes through the window that adds these up. Items that
    are no objects, and fields that are missing or null, are null; an empty array
    adds nothing; a file that is no JSON array is refused.
    """
    raw = spark.read.text(path, wholetext=True, recursiveFileLookup=True).select(F.input_file_name().alias("_file"), F.col("value"))
    parsed = raw.select("_file", F.parse_json("value").alias("_list"))
    wrong = F.raise_error(F.concat(F.lit("catalogue rejected: no JSON array in "), F.col("_file"))).cast("variant")
    parsed = parsed.select("_file", F.when(F.schema_of_variant("_list").startswith("ARRAY"), F.col("_list")).otherwise(wrong).alias("_list"))
    items = parsed.lateralJoin(spark.tvf.variant_explode(F.col("_list").outer())).select("_file", F.col("pos").cast("bigint").alias("_pos"), F.col("value").alias("_item"))
    ahead = Window.orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)
    first = items.groupBy("_file").agg(F.count(F.lit(1)).alias("_n")).select("_file", F.coalesce(F.sum("_n").over(ahead), F.lit(0)).alias("_first"))
    of = lambda name: F.try_variant_get("_item", f"$.{name}", "string").alias(name)
    return items.join(first, "_file").select((F.col("_first") + F.col("_pos")).alias("idx"), of("brand"), of("name"), of("category"))


def write_catalogue_files(catalogue: DataFrame, path: str, per_file: int = 10_000) -> None:
    """The catalogue as JSON array files of at most about ``per_file`` items, in
    the order of ``idx``; the files' folders sort by their first position."""
    part = F.lpad(F.floor(F.col("idx") / per_file).cast("string"), 12, "0").alias("part")
    item = F.struct("idx", F.struct("brand", "name", "category").alias("item"))
    lists = catalogue.select(part, item.alias("i")).groupBy("part").agg(F.sort_array(F.collect_list("i")).alias("all"))
    lists.select("part", F.to_json(F.transform("all", lambda x: x["item"])).alias("value")).write.mode("overwrite").partitionBy("part").text(path)


def catalogue_from_table(df: DataFrame, idx: str = "idx", brand: str = "brand",
                         name: str = "name", category: str | None = "category") -> DataFrame:
    """S1 for columnar sources: any table with an explicit position column."""
    cat = F.col(category) if category else F.lit(None).cast("string")
    return df.select(F.col(idx).cast("long").alias("idx"), F.col(brand).alias("brand"),
                     F.col(name).alias("name"), cat.alias("category"))


def validation_report(catalogue: DataFrame) -> DataFrame:
    """S3 as data: one row with the counts the validation rule needs."""
    bad = F.col("brand").isNull() | F.col("name").isNull()
    return catalogue.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(bad).alias("invalid_rows"),
    ).withColumn("valid", F.col("invalid_rows") == 0)


def validate_catalogue(catalogue: DataFrame, mode: str = "fail") -> DataFrame:
    """S3: reject the whole load when any item lacks brand or name.

    ``mode="fail"`` raises (one aggregate job); ``mode="quarantine"`` returns
    only the valid rows (call ``invalid_rows`` for the rest).
    """
    if mode == "quarantine":
        return catalogue.filter(F.col("brand").isNotNull() & F.col("name").isNotNull())
    row = validation_report(catalogue).first()
    if row["invalid_rows"]:
        raise CatalogueError(
            f"catalogue rejected: {row['invalid_rows']} of {row['rows']} items lack 'brand' or 'name'")
    return catalogue


def refuse_invalid(catalogue: DataFrame) -> DataFrame:
    """S3 inside a plan: reading an item that lacks brand or name fails the
    query, without a job of its own before it."""
    bad = F.col("brand").isNull() | F.col("name").isNull()
    refused = F.raise_error(F.lit("catalogue rejected: an item lacks 'brand' or 'name'")).cast("string")
    return catalogue.withColumn("brand", F.when(bad, refused).otherwise(F.col("brand")))


def invalid_rows(catalogue: DataFrame) -> DataFrame:
    return catalogue.filter(F.col("brand").isNull() | F.col("name").isNull())


def with_full_name(catalogue: DataFrame) -> DataFrame:
    return catalogue.withColumn("full_name", full_name("brand", "name"))


def unique_catalogue(catalogue: DataFrame) -> DataFrame:
    """N2 + N4 in one aggregation: one row per full name, carrying the
    first position (dedup keeps the first occurrence) and the category of
    the last occurrence ('' when missing) — one shuffle on full_name."""
    return (with_full_name(catalogue)
            .groupBy("full_name")
            .agg(F.min("idx").alias("idx"),
                 F.max_by(F.coalesce(F.col("category"), F.lit("")), F.col("idx")).alias("category"),
                 F.count(F.lit(1)).alias("copies")))


def duplicate_count(catalogue: DataFrame) -> DataFrame:
    """Rows, unique full names and their difference."""
    fn = full_name("brand", "name")
    return catalogue.agg(
        F.count(F.lit(1)).alias("original_count"),
        F.count_distinct(fn).alias("unique_count"),
    ).withColumn("duplicates_removed", F.col("original_count") - F.col("unique_count"))


def category_lookup(catalogue: DataFrame) -> DataFrame:
    """full_name -> category, last occurrence wins, missing -> ''."""
    return (with_full_name(catalogue).groupBy("full_name")
            .agg(F.max_by(F.coalesce(F.col("category"), F.lit("")), F.col("idx")).alias("category")))
