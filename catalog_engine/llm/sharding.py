"""Proportional stratified interleaving of documents into shards (operator 1).

Rows get a seeded random order within their source; a row's fractional rank is
(rank + 1/2) / rows of its source. In the order of fractional ranks every
stretch holds the sources in the corpus's proportions, so cutting that order
into equal stretches gives shards of one mixture. DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalog_engine.llm.common import cut, need_columns, nullsafe_key, numbered

SHARDS = 24
SEED = 20260
#: The law that holds: shard row counts are at most one apart.
LAW = "rows"


def seeded_order(doc_id, seed: int):
    """A pseudo-random string for a row; the same in any SQL engine."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("null"))).cast("binary"))


def shard(docs: DataFrame, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """One row per document: ``doc_id, size, text_crc32, law, shard, slot,
    grown_shard, source``.

    ``shard`` runs from 0 to ``shards`` - 1; ``slot`` is the row's place in
    its shard, gapless from 0; with fewer rows than shards some shards are
    empty. ``size`` is the text's UTF-8 bytes (null: none) plus 8,
    ``text_crc32`` the checksum of those bytes. ``grown_shard`` is null, as the
    law is "rows". Null sources are one source of their own; rows with equal or
    null ids are told apart by size and checksum, and rows equal in all of
    these are interchangeable. Other columns are ignored.
    """
    need_columns(docs, "doc_id", "text", "source")
    raw = F.coalesce(F.col("text").cast("string").cast("binary"), F.lit(b""))
    doc_id = F.col("doc_id").cast("long")
    rows = cut(
        docs.select(
            doc_id.alias("doc_id"),
            F.col("source").cast("string").alias("source"),
            nullsafe_key(F.col("source")).alias("stratum"),
            (F.octet_length(raw) + 8).cast("long").alias("size"),
            F.crc32(raw).alias("text_crc32"),
            seeded_order(doc_id, seed).alias("mixed"),
        )
    )
    order = ["mixed", "doc_id", "size", "text_crc32"]
    ranked = numbered(rows, ["stratum", *order], "place")
    strata = ranked.groupBy("stratum").agg(F.count(F.lit(1)).alias("in_source"), F.min("place").alias("first"))
    share = (F.col("place") - F.col("first") + F.lit(0.5)) / F.col("in_source")
    ranked = ranked.join(strata, "stratum").withColumn("share", share)
    ranked = numbered(ranked.drop("place", "first", "in_source"), ["share", "stratum", *order], "place")
    total = ranked.agg(F.count(F.lit(1)).alias("total"))
    out = ranked.join(F.broadcast(total)).withColumn("shard", F.expr(f"place * {shards} div total"))
    begins = F.expr(f"(shard * total + {shards} - 1) div {shards}")
    return out.select(
        "doc_id", "size", "text_crc32", F.lit(LAW).alias("law"), F.col("shard").cast("int").alias("shard"),
        (F.col("place") - begins).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"), "source",
    )


def oracle_sql(shards: int = SHARDS, seed: int = SEED) -> str:
    """The same rows in DuckDB, which has no crc32: it is folded over the bytes
    with the table of its polynomial."""
    table = []
    for byte in range(256):
        for _ in range(8):
            byte = byte >> 1 ^ (0xEDB88320 if byte & 1 else 0)
        table.append(byte)
    # the first element of a reduction is its start, which list_prepend puts there
    fold = f"list_reduce(list_prepend(4294967295, bytes), lambda c, b: xor(({table})[(xor(c, b) & 255) + 1], c >> 8))"
    return f"""
WITH raw AS (
  SELECT doc_id, source, coalesce(text, '') AS text, hex(encode(coalesce(text, ''))) AS h FROM documents
), sized AS (
  SELECT doc_id, source, CASE WHEN source IS NULL THEN 'n' ELSE 'v' || source END AS stratum,
         md5('{seed}:' || coalesce(doc_id::VARCHAR, 'null')) AS mixed, (length(h) // 2 + 8)::BIGINT AS size,
         list_transform(range(length(h) // 2), lambda i: ('0x' || substr(h, 2 * i + 1, 2))::BIGINT) AS bytes
  FROM raw
), summed AS (
  SELECT * EXCLUDE (bytes), xor({fold}, 4294967295)::BIGINT AS text_crc32 FROM sized
), ranked AS (
  SELECT *, (row_number() OVER (PARTITION BY stratum ORDER BY mixed, doc_id NULLS FIRST, size, text_crc32) - 0.5::DOUBLE)
            / count(*) OVER (PARTITION BY stratum) AS share FROM summed
), placed AS (
  SELECT *, row_number() OVER (ORDER BY share, stratum, mixed, doc_id NULLS FIRST, size, text_crc32) - 1 AS place, count(*) OVER () AS total FROM ranked
), dealt AS (SELECT *, place * {shards} // total AS shard FROM placed)
SELECT doc_id, size, text_crc32, '{LAW}' AS law, shard::INTEGER AS shard,
       (place - (shard * total + {shards - 1}) // {shards})::BIGINT AS slot, NULL::INTEGER AS grown_shard, source FROM dealt
"""
