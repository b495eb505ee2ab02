"""Link and page operators (P1-P10): anchors out of listing HTML, skip
list, URL resolution, first-seen dedup, offsets and the run plan.

All built-in expressions (regex, arrays, ``parse_url``-style string work)
inside whole-stage code generation; the only shuffles are the dedup
aggregate (P4) and the anti join (P8).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import html as H
from ..functions.text import col_
from ..functions.urls import resolve_url

# Fixed values (must equal the reference's rules):
PRODUCT_LINK_PART = "/products/"
SKIP_PARTS = ["/new", "/create", "/all"]
PAGE_SIZE = 50
TOTAL_PAGES = 3094
PAGES_PER_BATCH = 100

OFFSET_RE = r"offset=(\d+)"


def extract_links(pages: DataFrame, contains: str = PRODUCT_LINK_PART,
                  html: str = "html") -> DataFrame:
    """One row per anchor whose href contains ``contains``, in document
    order (``pos`` = position among all anchors of the page). Any quotes;
    commented-out anchors and other attributes (``data-href``) do not count."""
    hrefs = H.attributes(H.without_comments(html), "a", "href")
    keep = [c for c in pages.columns if c != html]
    return (pages.select(*keep, F.posexplode(hrefs).alias("pos", "href"))
            .filter(F.col("href").contains(contains)))


def skip_filter(href, skip=SKIP_PARTS, mode: str = "contains") -> Column:
    """True for links to keep. ``contains`` is the reference's substring
    rule (also drops e.g. ``/products/all-day-cream``); ``segment`` only
    drops whole path segments."""
    h = col_(href)
    if mode == "contains":
        bad = F.exists(F.array(*[F.lit(s) for s in skip]), lambda s: F.contains(h, s))
    elif mode == "segment":
        alt = "|".join(s.strip("/") for s in skip)
        bad = h.rlike(f"/({alt})(/|\\?|#|$)")
    else:
        raise ValueError(mode)
    return ~bad


def page_offset(url) -> Column:
    """P5: the first ``offset=N`` in the URL, else 0."""
    v = F.regexp_extract(col_(url), OFFSET_RE, 1)
    return F.coalesce(F.nullif(v, F.lit("")).try_cast("bigint"), F.lit(0).cast("bigint"))


def with_page_numbers(pages: DataFrame, url: str = "url", page_size: int = PAGE_SIZE) -> DataFrame:
    """Offset, 1-based page number, expected product rank range."""
    off = page_offset(url)
    number = F.try_add(F.col("offset"), F.lit(1))
    return (pages.withColumn("offset", off)
            .withColumn("page_number", number)
            .withColumn("first_rank", F.try_add(F.try_multiply(F.col("offset"), F.lit(page_size)), F.lit(1)))
            .withColumn("last_rank", F.try_multiply(number, F.lit(page_size))))


def product_links(listing: DataFrame, skip_mode: str = "contains") -> DataFrame:
    """P1 + P2 + P3 + P5/P6 on a listing corpus ``(page_id, url, html)``."""
    links = extract_links(listing)
    return (links.filter(skip_filter("href", mode=skip_mode))
            .withColumn("full_url", resolve_url(F.col("url"), F.col("href")))
            .withColumn("offset", page_offset("url"))
            .withColumn("page_number", F.try_add(F.col("offset"), F.lit(1)).try_cast("int")))


def first_seen(links: DataFrame, key: str = "full_url", order=("offset", "page_id", "url", "pos")) -> DataFrame:
    """Keep the first occurrence of every URL (by offset, page and
    position on the page, a total order) — an arg-min aggregate, partial on
    the map side, one shuffle on the URL; no global sort."""
    others = [c for c in links.columns if c != key]
    best = F.min_by(F.struct(*others), F.struct(*[F.col(c) for c in order if c in links.columns]))
    return links.groupBy(key).agg(best.alias("_r")).select(key, "_r.*")


def plan_length(corpus_offsets: DataFrame, total_pages: int = TOTAL_PAGES) -> int:
    """Pages of the run plan: the configured number, or as many as the corpus
    shows when it has grown past that (one small aggregate)."""
    last = corpus_offsets.agg(F.max("offset")).first()[0]
    return max(total_pages, (last if last is not None else -1) + 1)


def missing_pages(spark: SparkSession, corpus_offsets: DataFrame, total_pages: int | None = None,
                  start: int = 0) -> DataFrame:
    """Expected offsets ``start .. total-1`` with no page in the corpus."""
    total = plan_length(corpus_offsets) if total_pages is None else total_pages
    expected = spark.range(start, total).withColumnRenamed("id", "offset")
    have = corpus_offsets.select("offset").distinct()
    return expected.join(have, "offset", "left_anti")


def batch_plan(spark: SparkSession, corpus_offsets: DataFrame, total_pages: int | None = None,
               pages_per_batch: int = PAGES_PER_BATCH, start: int = 0) -> DataFrame:
    """Batches of ``pages_per_batch`` pages from ``start``; the last one
    is partial. With the pages present in the corpus counted per batch."""
    total = plan_length(corpus_offsets) if total_pages is None else total_pages
    expected = spark.range(start, total).withColumnRenamed("id", "offset")
    have = corpus_offsets.select("offset").distinct().withColumn("present", F.lit(1))
    b = (F.floor((F.col("offset") - start) / pages_per_batch) + 1).cast("int")
    return (expected.join(have, "offset", "left").withColumn("batch_number", b)
            .groupBy("batch_number")
            .agg(F.min("offset").alias("start_offset"), F.max("offset").alias("end_offset"),
                 F.count(F.lit(1)).alias("pages"), F.count("present").alias("pages_present")))


def resume_point(progress: DataFrame, last_offset: str = "last_offset") -> DataFrame:
    """P10: ``last_offset + 1`` when progress exists, else 0."""
    return progress.agg(F.coalesce(F.max(last_offset) + 1, F.lit(0).cast("bigint")).alias("resume_offset"))
