"""Removal of cross-site boilerplate lines by distinct-site spread (operator 8).

Each line hash gets a HyperLogLog sketch of the sites it occurs on; sketches
merge in the aggregation, so a line on every page of the corpus costs one small
row per task. Lines whose estimate is near the threshold get an exact
count of their distinct sites; the others are decided by the estimate.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalog_engine.llm.common import cut, free_name, need_columns, nullsafe_key

#: A line on at least this many distinct sites is boilerplate.
MIN_SITES = 5
#: log2 of a sketch's registers; the relative standard error is about 1.04 / 2^(LOG_REGISTERS / 2).
LOG_REGISTERS = 10
#: Estimates within this many standard errors of the threshold are counted exactly.
BAND_ERRORS = 6.0

#: SQL that gives the same rows in DuckDB (distinct sites counted exactly).
ORACLE_SQL = f"""
WITH lines AS (
  SELECT doc_id, source, i AS line_no, parts[i] AS line, trim(parts[i], ' ' || chr(9) || chr(13)) AS body
  FROM (SELECT doc_id, source, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents),
       LATERAL (SELECT unnest(range(1, len(parts) + 1)) AS i)
), spread AS (
  SELECT body, min(struct_pack(d := doc_id, l := line_no)) AS first FROM lines WHERE body <> ''
  GROUP BY body HAVING count(DISTINCT coalesce(source, chr(0))) >= {MIN_SITES}
), marked AS (
  SELECT l.doc_id, l.line_no, l.line, s.body IS NOT NULL AND NOT (s.first.d = l.doc_id AND s.first.l = l.line_no) AS gone
  FROM lines l LEFT JOIN spread s ON l.body = s.body
)
SELECT doc_id, count(*) AS n_lines, sum(CASE WHEN gone THEN 1 ELSE 0 END)::BIGINT AS n_removed,
       coalesce(string_agg(line, chr(10) ORDER BY line_no) FILTER (WHERE NOT gone), '') AS text
FROM marked GROUP BY doc_id
"""


def _lines(text):
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def boilerplate(docs: DataFrame, site: str, min_sites: int) -> DataFrame:
    """(h1, h2, first): hashes of the lines on ``min_sites`` sites or more, and
    the first place of each, ``struct(doc_id, uid, line_no)``."""
    lines = docs.select("doc_id", "uid", nullsafe_key(F.col(site)).alias("site"), F.posexplode(_lines(F.col("text"))).alias("line_no", "line"))
    body = F.trim(F.col("line"), F.lit(" \t\r"))
    lines = lines.where(body != "").select("doc_id", "uid", "site", "line_no", F.xxhash64(body).alias("h1"), F.hash(body, F.length(body)).alias("h2"))
    place = F.struct("doc_id", "uid", "line_no")
    sketched = lines.groupBy("h1", "h2").agg(F.hll_sketch_agg("site", LOG_REGISTERS).alias("sketch"), F.count(F.lit(1)).alias("n"), F.min(place).alias("first"))
    sketched = sketched.where(F.col("n") >= min_sites).withColumn("sites", F.hll_sketch_estimate("sketch")).drop("sketch", "n")
    band = max(1.0, BAND_ERRORS * 1.04 / 2 ** (LOG_REGISTERS / 2) * min_sites)
    spread = cut(sketched.where(F.col("sites") >= min_sites - band))
    near = spread.where(F.col("sites") <= min_sites + band)
    exact = lines.select("h1", "h2", "site").join(near.select("h1", "h2"), ["h1", "h2"], "left_semi").distinct()
    exact = exact.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("exact")).where(F.col("exact") >= min_sites)
    sure = spread.where(F.col("sites") > min_sites + band).select("h1", "h2", "first")
    return sure.union(near.join(exact, ["h1", "h2"]).select("h1", "h2", "first"))


def drop_boilerplate(docs: DataFrame, site: str = "source", min_sites: int = MIN_SITES) -> DataFrame:
    """``docs`` with boilerplate lines taken out of ``text``, and the columns
    ``n_lines`` and ``n_removed`` (with an underscore before the name where
    ``docs`` has that column).

    Lines are what line feeds part; they are compared without spaces, tabs and
    carriage returns at either end. Lines on ``min_sites`` distinct sites or
    more go, all but the first place of each (least doc_id, then line), so
    nothing disappears from the corpus altogether. Blank lines stay. A null site
    is a site of its own. No row is dropped: a text of boilerplate alone
    becomes empty, a null text stays null. Rows with equal ids are told apart
    by their texts; rows equal in both share their first places.
    """
    need_columns(docs, "doc_id", "text", site)
    total, removed, own, gone = (free_name(docs, n) for n in ("n_lines", "n_removed", "_uid", "_gone"))
    docs = docs.withColumn(own, F.xxhash64("doc_id", "text", F.length("text")))
    narrow = docs.select("doc_id", F.col(own).alias("uid"), F.col(site).alias("site"), "text")
    common = cut(boilerplate(narrow, "site", min_sites))
    lines = narrow.select("doc_id", "uid", F.posexplode(_lines(F.col("text"))).alias("line_no", "line"))
    body = F.trim(F.col("line"), F.lit(" \t\r"))
    lines = lines.where(body != "").select("doc_id", "uid", "line_no", F.xxhash64(body).alias("h1"), F.hash(body, F.length(body)).alias("h2"))
    hits = lines.join(common, ["h1", "h2"]).where(~F.struct("doc_id", "uid", "line_no").eqNullSafe(F.col("first")))
    per_doc = hits.groupBy(F.col("uid").alias(own)).agg(F.collect_set("line_no").alias(gone))
    marked = docs.join(per_doc, own, "left")
    parts = _lines(F.col("text"))
    kept = F.filter(parts, lambda _, i: ~F.array_contains(gone, i))
    text = F.when(F.col(gone).isNull(), F.col("text")).otherwise(F.array_join(kept, "\n"))
    return marked.select(
        *[(text.alias("text") if c == "text" else F.col(f"`{c}`")) for c in docs.columns if c != own],
        F.size(parts).cast("long").alias(total), F.coalesce(F.size(gone), F.lit(0)).cast("long").alias(removed),
    )
