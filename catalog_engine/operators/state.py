"""Keyed product state (C1-C12): upsert, membership, lookups with hit
accounting, stats, and routing of links against the state.

The state is a table keyed by ``url``; counters are computed from data
(lookups joined to the state), never kept in driver memory.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import matching as M

# Fixed value (must equal the reference's rule): assumed seconds saved per
# matched product served from the state instead of being fetched.
SECONDS_SAVED_PER_MATCHED_HIT = 2.5

ROUTES = ["emit_cached", "emit_rematched", "skip", "fetch"]


def upsert(current: DataFrame, updates: DataFrame, key: str = "url",
           order: tuple[str, ...] = ("version", "pos")) -> DataFrame:
    """Last write wins per key; rows without a key are rejected.

    ``order`` columns rank writes (later = larger; those that the rows lack are
    left out). Writes that tie in all of them are ranked by their content, so
    the result does not depend on the order of the rows. One shuffle on the
    key with a partial arg-max on the map side, so a hot key collapses before
    the exchange."""
    both = current.unionByName(updates, allowMissingColumns=True).filter(F.col(key).isNotNull())
    others = [c for c in both.columns if c != key]
    content = F.to_json(F.struct(*others))
    latest = F.max_by(F.struct(*others), F.struct(*[F.col(c) for c in order if c in both.columns], content))
    return both.groupBy(key).agg(latest.alias("_r")).select(key, "_r.*")


def rejected(updates: DataFrame, key: str = "url") -> DataFrame:
    """The rows an upsert refuses (no key)."""
    return updates.filter(F.col(key).isNull())


def known(requests: DataFrame, state: DataFrame, key: str = "url") -> DataFrame:
    """Requests whose key is in the state (left semi join)."""
    return requests.join(state.select(key), key, "left_semi")


def unknown(requests: DataFrame, state: DataFrame, key: str = "url") -> DataFrame:
    """Requests whose key is not in the state (left anti join)."""
    return requests.join(state.select(key), key, "left_anti")


def lookup(requests: DataFrame, state: DataFrame, key: str = "url") -> DataFrame:
    """Every request with its state row (hit) or NULLs (miss)."""
    st = state.select(key, F.lit(True).alias("_hit"),
                      F.coalesce(F.col("matched"), F.lit(False)).alias("_matched"))
    return requests.join(st, key, "left").withColumn("_hit", F.coalesce("_hit", F.lit(False)))


def lookup_counters(looked_up: DataFrame) -> DataFrame:
    """Hits, matched/unmatched hits, misses and both ratios."""
    hits = F.count_if(F.col("_hit"))
    mh = F.count_if(F.col("_hit") & F.col("_matched"))
    n = F.count(F.lit(1))
    agg = looked_up.agg(hits.alias("hits"), mh.alias("matched_hits"),
                        (hits - mh).alias("unmatched_hits"), (n - hits).alias("misses"))
    total = F.col("hits") + F.col("misses")
    return (agg.withColumn("hit_ratio", F.coalesce(F.try_divide(F.col("hits"), total), F.lit(0.0)))
            .withColumn("effective_hit_ratio",
                        F.coalesce(F.try_divide(F.col("matched_hits"), total), F.lit(0.0))))


def size_counters(state: DataFrame) -> DataFrame:
    """Size and matched count (missing ``matched`` = false)."""
    m = F.count_if(F.coalesce(F.col("matched"), F.lit(False)))
    return state.agg(F.count(F.lit(1)).alias("size"), m.alias("matched_count"),
                     (F.count(F.lit(1)) - m).alias("unmatched_count"))


def stats(state: DataFrame, requests: DataFrame | None = None, key: str = "url") -> DataFrame:
    """One row — size, matched/unmatched counts, lookup counters and
    ratios (two one-row aggregates joined)."""
    sizes = size_counters(state)
    if requests is None:
        return sizes
    return sizes.crossJoin(lookup_counters(lookup(requests, state, key)))


def clear(state: DataFrame) -> DataFrame:
    """An empty state with the same schema (the counters live in the
    request table, so they survive)."""
    return state.limit(0)


def route_links(links: DataFrame, state: DataFrame, catalogue: DataFrame, *,
                threshold: float = M.DEFAULT_THRESHOLD, key: str = "full_url",
                broadcast_rows: int | None = None, with_name: bool = False) -> DataFrame:
    """Route every link by its state row.

    * ``emit_cached``    cached and matched — served from the state;
    * ``emit_rematched`` cached, unmatched, its stored name now matches;
    * ``skip``           cached, unmatched, still no match;
    * ``fetch``          not cached, or cached without a name (earlier
                         error rows).

    The page number comes from the link (refreshed for cached rows).
    Re-matching scores each distinct stored name once. ``with_name`` adds the
    stored name as ``full_name``.
    """
    st = state.select(F.col("url").alias(key), F.lit(True).alias("cached"),
                      F.col("full_name").alias("cached_name"),
                      F.coalesce(F.col("matched"), F.lit(False)).alias("cached_matched"),
                      F.col("matched_name").alias("cached_matched_name"),
                      F.col("category").alias("cached_category"))
    # the state grows with the crawl, and its files are far smaller than its rows in
    # memory: by their size Spark would broadcast millions of rows
    st = st.hint("merge")
    j = links.join(st, key, "left").withColumn("cached", F.coalesce("cached", F.lit(False)))
    # only rows that need a match take part in the join on the name: links
    # that are not in the state have none, and would all meet in one key
    wants = F.coalesce(F.col("cached") & ~F.col("cached_matched") & F.col("cached_name").isNotNull(), F.lit(False))
    need, settled = j.filter(wants), j.filter(~wants)
    kw = {} if broadcast_rows is None else {"broadcast_rows": broadcast_rows}
    rem = M.best_match_texts(need.select(F.col("cached_name").alias("_text")), catalogue,
                             threshold=threshold, **kw)
    rem = rem.select(F.col("_text").alias("cached_name"), F.col("matched").alias("re_matched"),
                     F.col("matched_name").alias("re_name"), F.col("category").alias("re_category"))
    r = need.join(rem, "cached_name", "left").unionByName(settled, allowMissingColumns=True)
    route = (F.when(~F.col("cached") | F.col("cached_name").isNull(), F.lit("fetch"))
             .when(F.col("cached_matched"), F.lit("emit_cached"))
             .when(F.coalesce(F.col("re_matched"), F.lit(False)), F.lit("emit_rematched"))
             .otherwise(F.lit("skip")))
    out = r.withColumn("route", route)
    emitted_cached = F.col("route") == "emit_cached"
    emitted_re = F.col("route") == "emit_rematched"
    return out.select(
        *links.columns, "cached", "route", *([F.col("cached_name").alias("full_name")] if with_name else []),
        F.when(emitted_cached | emitted_re, F.lit(True))
         .when(F.col("route") == "skip", F.lit(False)).alias("matched"),
        F.when(emitted_cached, F.col("cached_matched_name"))
         .when(emitted_re, F.col("re_name")).alias("matched_name"),
        F.when(emitted_cached, F.col("cached_category"))
         .when(emitted_re, F.col("re_category")).alias("category"))


def time_saved(routed: DataFrame) -> DataFrame:
    """Estimated seconds saved by matched state hits."""
    n = F.count_if(F.col("route") == "emit_cached")
    return routed.agg(n.alias("matched_cached"),
                      (n * F.lit(SECONDS_SAVED_PER_MATCHED_HIT)).alias("time_saved_sec"))
