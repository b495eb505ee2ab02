"""Registered queries (Spark) and their DuckDB oracle SQL.

Every query reads whole driver tables (or data Spark derives from them);
``oracle_sql`` re-states the same result in DuckDB SQL over the
pre-registered views.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as TX
from ..operators import matching as M
from ..sources import catalogue as C
from . import fixtures as FX
from . import oracle as O

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


# --------------------------------------------------------------------------
# fixture SQL (same rules as plans.fixtures)
# --------------------------------------------------------------------------

CAT = "SELECT p_partkey AS idx, p_brand AS brand, p_name AS name, p_type AS category FROM part"
FULL = "(p_brand || ' ' || p_name)"
QNAMES = (
    "SELECT p_partkey AS query_id, CASE p_partkey % 6 "
    f"WHEN 0 THEN {FULL} WHEN 1 THEN p_name || ' ' || p_brand WHEN 2 THEN upper({FULL}) "
    f"WHEN 3 THEN substr({FULL}, 1, length({FULL}) - 1) WHEN 4 THEN p_name "
    "ELSE p_brand || ' & ' || replace(p_name, ' ', '-') || '®' END AS query FROM part")
PAIRS = (
    f"SELECT q.query_id, 0 AS shift, q.query AS a, {FULL} AS b FROM ({QNAMES}) q JOIN part p ON q.query_id = p.p_partkey "
    f"UNION ALL SELECT q.query_id, 1 AS shift, q.query AS a, {FULL} AS b FROM ({QNAMES}) q JOIN part p ON q.query_id + 1 = p.p_partkey")
STUDY_Q = "SELECT p_name AS query, min(p_partkey) AS query_id FROM part GROUP BY p_name"
DECORATED = (
    "SELECT p_partkey AS id, CASE p_partkey % 4 "
    "WHEN 0 THEN p_brand || ' & ' || p_name || '®' "
    "WHEN 1 THEN '  ' || upper(p_brand) || '/' || replace(p_name, ' ', '-') || '™ ' "
    "WHEN 2 THEN p_brand || ' ' || chr(9) || chr(160) || p_name || chr(10) "
    "ELSE p_type || ' -- ' || p_name END AS text FROM part")
UNIQUE_CAT = (
    f"SELECT brand || ' ' || name AS full_name, min(idx) AS idx, "
    f"arg_max(coalesce(category, ''), idx) AS category, count(*) AS copies FROM ({CAT}) c GROUP BY 1")


# --------------------------------------------------------------------------
# catalogue: S1-S3, N1-N4
# --------------------------------------------------------------------------

@register("catalogue_files",
          f"SELECT row_number() OVER (ORDER BY idx) - 1 AS idx, brand, name, category FROM ({CAT}) c")
def q_catalogue_files(spark, sf):
    """The catalogue as JSON array files, written by Spark and read back with
    the position over all files as ``idx``."""
    from ..streaming.ingest import new_run_dir
    path = f"{new_run_dir(spark, 'catalogue')}/lists"
    C.write_catalogue_files(FX.catalogue(spark, sf), path, per_file=300)
    return C.read_catalogue_files(spark, path)


@register("catalogue_validate",
          f"SELECT count(*) AS rows, count(*) FILTER (WHERE brand IS NULL OR name IS NULL) AS invalid_rows, "
          f"count(*) FILTER (WHERE brand IS NULL OR name IS NULL) = 0 AS valid FROM ({CAT}) c")
def q_catalogue_validate(spark, sf):
    return C.validation_report(FX.catalogue(spark, sf))


@register("normalize_names",
          f"SELECT id, text, {O.normalize('text')} AS normalized FROM ({DECORATED}) d")
def q_normalize_names(spark, sf):
    return FX.decorated_names(spark, sf).select("id", "text", TX.normalize_text("text").alias("normalized"))


@register("catalogue_dedup", UNIQUE_CAT)
def q_catalogue_dedup(spark, sf):
    return C.unique_catalogue(FX.catalogue(spark, sf))


@register("duplicate_count",
          f"SELECT count(*) AS original_count, count(DISTINCT brand || ' ' || name) AS unique_count, "
          f"count(*) - count(DISTINCT brand || ' ' || name) AS duplicates_removed FROM ({CAT}) c")
def q_duplicate_count(spark, sf):
    return C.duplicate_count(FX.catalogue(spark, sf))


@register("category_last_wins",
          f"SELECT brand || ' ' || name AS full_name, arg_max(coalesce(category, ''), idx) AS category "
          f"FROM ({CAT}) c GROUP BY 1")
def q_category_last_wins(spark, sf):
    return C.category_lookup(FX.catalogue(spark, sf))


# --------------------------------------------------------------------------
# scorers M1-M6 over whole-table pairs
# --------------------------------------------------------------------------

def _pairs_feature_sql() -> str:
    return (f"WITH p AS ({PAIRS}), f AS (SELECT query_id, shift, {', '.join(O.features_cols('a', 'a'))}, "
            f"{', '.join(O.features_cols('b', 'b'))} FROM p), "
            f"g AS (SELECT *, {', '.join(O.pair_cols('a', 'b'))} FROM f) ")


def _make_score_query(name: str):
    sql = (_pairs_feature_sql() +
           f"SELECT query_id, shift, a_s AS a, b_s AS b, round({O.SCORERS[name]('a', 'b')}, 4) AS score_{name} FROM g")

    @register(f"score_{name}", sql)
    def q(spark, sf, _n=name):
        return M.score_pairs(FX.score_pairs_input(spark, sf), "a", "b", [_n])
    return q


for _name in ["ratio", "token_sort", "token_set", "partial", "partial_token", "weighted"]:
    _make_score_query(_name)


# --------------------------------------------------------------------------
# best match M7/M8/N4
# --------------------------------------------------------------------------

def _best_match_sql(threshold: float, qsrc: str = QNAMES, pruned: bool = True) -> str:
    """Best match for ``qsrc`` rows ``(query_id, query)``; each distinct text
    is scored (same result as scoring every row). ``pruned`` leaves out pairs
    that cannot reach the threshold; the tests compare with the SQL that
    scores all pairs."""
    keep = f"WHERE {O.weighted_may_reach('q', 'c', 'req', 'p_i')}" if pruned else ""
    req = (f"(CASE WHEN length(q_s) < 15 THEN greatest(90.0::DOUBLE, {float(threshold)}::DOUBLE) "
           f"ELSE {float(threshold)}::DOUBLE END)")
    return (
        f"WITH qn AS ({qsrc}), uc AS ({UNIQUE_CAT}), "
        f"qf AS (SELECT DISTINCT query, {', '.join(O.features_cols('query', 'q'))} FROM qn WHERE query IS NOT NULL), "
        f"cf AS (SELECT idx, full_name, category, {', '.join(O.features_cols('full_name', 'c'))} FROM uc), "
        f"pr AS (SELECT qf.*, cf.*, {req} AS req, list_intersect(q_toks, c_toks) AS p_i FROM qf CROSS JOIN cf), "
        f"cand AS (SELECT * FROM pr {keep}), "
        f"g AS (SELECT *, {', '.join(O.pair_cols('q', 'c'))} FROM cand), "
        f"sc AS (SELECT query, idx, full_name, category, req, {O.weighted('q', 'c')} AS score FROM g), "
        f"best AS (SELECT query, arg_max(struct_pack(full_name := full_name, category := category, score := score), "
        f"struct_pack(s := score, i := -idx)) AS b FROM sc WHERE score >= req GROUP BY query) "
        f"SELECT qn.query_id, qn.query, b IS NOT NULL AS matched, b.full_name AS matched_name, "
        f"b.category AS category, round(b.score, 4) AS score FROM qn LEFT JOIN best USING (query)")


@register("best_match", _best_match_sql(90))
def q_best_match(spark, sf):
    return M.best_match(FX.query_names(spark, sf), FX.catalogue(spark, sf), threshold=90)


@register("adaptive_threshold", _best_match_sql(80))
def q_adaptive_threshold(spark, sf):
    return M.best_match(FX.query_names(spark, sf), FX.catalogue(spark, sf), threshold=80)


# --------------------------------------------------------------------------
# threshold study M9-M16 + P11
# --------------------------------------------------------------------------

def _study_sql_prefix(qsrc: str = STUDY_Q) -> str:
    q, c = "q", "c"
    scores = ", ".join(f"{O.SCORERS[n](q, c)} AS s_{n}" for n in M.STUDY_SCORERS)
    unions = " UNION ALL ".join(
        f"SELECT query_id, query, idx, full_name, '{n}' AS scorer, s_{n} AS score FROM sc" for n in M.STUDY_SCORERS)
    return (
        f"WITH sq AS ({qsrc}), uc AS ({UNIQUE_CAT}), "
        f"qf AS (SELECT query_id, query, {', '.join(O.features_cols(O.normalize('query'), 'q'))} FROM sq), "
        f"cf AS (SELECT idx, full_name, {', '.join(O.features_cols(O.normalize('full_name'), 'c'))} FROM uc), "
        f"pr AS (SELECT * FROM qf CROSS JOIN cf), "
        f"g AS (SELECT *, {', '.join(O.pair_cols(q, c))} FROM pr), "
        f"sc AS (SELECT query_id, query, idx, full_name, {scores} FROM g), "
        f"lg AS (SELECT * FROM ({unions}) u), "
        f"ps AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id, scorer ORDER BY score DESC, idx) AS rank FROM lg) r "
        f"WHERE rank <= 10), "
        f"mg AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, idx) AS rank FROM "
        f"(SELECT query_id, query, idx, full_name, max(score) AS score FROM ps GROUP BY ALL) m) r WHERE rank <= 5) ")


@register("topk_per_scorer",
          _study_sql_prefix() + "SELECT query_id, query, idx, full_name, scorer, round(score, 4) AS score, rank FROM ps")
def q_topk_per_scorer(spark, sf):
    ps, _ = M.study_topk(FX.study_queries(spark, sf), FX.catalogue(spark, sf))
    return ps.select("query_id", "query", "idx", "full_name", "scorer", F.round("score", 4).alias("score"), "rank")


@register("topk_merged",
          _study_sql_prefix() + "SELECT query_id, query, idx, full_name, round(score, 4) AS score, CAST(rank AS INTEGER) AS rank, "
          "score >= 70 AS shown, score >= 90 AS high_quality FROM mg")
def q_topk_merged(spark, sf):
    _, mg = M.study_topk(FX.study_queries(spark, sf), FX.catalogue(spark, sf))
    return mg.select("query_id", "query", "idx", "full_name", F.round("score", 4).alias("score"), "rank",
                     (F.col("score") >= 70).alias("shown"), (F.col("score") >= M.HIGH_QUALITY_SCORE).alias("high_quality"))


@register("threshold_sweep",
          _study_sql_prefix() +
          "SELECT sq.query_id, sq.query, t.threshold, coalesce(max(mg.score) >= t.threshold, false) AS would_match, "
          "count(mg.score) FILTER (WHERE mg.score >= t.threshold) AS matching_products "
          "FROM sq CROSS JOIN (SELECT unnest(" + str(M.STUDY_THRESHOLDS) + ") AS threshold) t "
          "LEFT JOIN mg ON mg.query_id = sq.query_id GROUP BY sq.query_id, sq.query, t.threshold")
def q_threshold_sweep(spark, sf):
    sq = FX.study_queries(spark, sf)
    _, mg = M.study_topk(sq, FX.catalogue(spark, sf))
    return M.threshold_sweep(sq, mg)


@register("threshold_sweep_all",
          _study_sql_prefix() +
          "SELECT sq.query_id, sq.query, t.threshold, coalesce(max(al.score) >= t.threshold, false) AS would_match, "
          "count(al.score) FILTER (WHERE al.score >= t.threshold) AS matching_products "
          "FROM sq CROSS JOIN (SELECT unnest(" + str(M.STUDY_THRESHOLDS) + ") AS threshold) t "
          "LEFT JOIN (SELECT query_id, idx, max(score) AS score FROM lg GROUP BY ALL) al ON al.query_id = sq.query_id "
          "GROUP BY sq.query_id, sq.query, t.threshold")
def q_threshold_sweep_all(spark, sf):
    """The sweep over the whole catalogue instead of the top-K."""
    sq = FX.study_queries(spark, sf)
    return M.threshold_sweep(sq, M.study_all(sq, FX.catalogue(spark, sf)))


@register("recommendation",
          _study_sql_prefix() +
          "SELECT sq.query_id, sq.query, round(b.best, 4) AS best_score, "
          "CASE WHEN b.best IS NULL THEN 'none' WHEN b.best >= 90 THEN 'high' WHEN b.best >= 80 THEN 'good' WHEN b.best >= 70 THEN 'fair' ELSE 'poor' END AS quality, "
          "CASE WHEN b.best >= 90 THEN 90 WHEN b.best >= 80 THEN 80 WHEN b.best >= 70 THEN 70 END AS recommended_threshold, "
          "length(sq.query) < 15 AS short_name_note, "
          f"(len({O.tokens('sq.query')}) <= 1 OR lower(sq.query) IN ('head', 'head shoulders', 'h s', 'dove', 'loreal', 'l''oreal')) "
          "AS short_input_warning "
          "FROM sq LEFT JOIN (SELECT query_id, max(score) AS best FROM mg GROUP BY query_id) b USING (query_id)")
def q_recommendation(spark, sf):
    sq = FX.study_queries(spark, sf)
    _, mg = M.study_topk(sq, FX.catalogue(spark, sf))
    return M.recommendation(sq, mg)


STUDY_REQUESTS = f"SELECT query_id, query, 1 + query_id % 3 AS k, 60 + 10 * (query_id % 4) AS show FROM ({QNAMES}) n"


# not registered as an oracle: it scores every name with every catalogue row, which
# takes DuckDB minutes on larger tables; the tests compare with it on a small one
STUDY_NAMES_SQL = (
    _study_sql_prefix(f"SELECT query, min(query_id) AS query_id FROM ({QNAMES}) n GROUP BY query") +
    f", asked AS ({STUDY_REQUESTS}), "
    "each AS (SELECT a.query, a.k, ps.idx, ps.full_name, max(ps.score) AS score FROM (SELECT DISTINCT query, k FROM asked) a "
    "JOIN ps ON ps.query = a.query AND ps.rank <= 2 * a.k GROUP BY ALL), "
    "best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query, k ORDER BY score DESC, idx) AS rank FROM each) r WHERE rank <= k) "
    "SELECT a.query_id, a.query, a.k AS top_matches, a.show AS show_threshold, b.rank::INTEGER AS rank, b.idx, b.full_name, "
    "round(b.score, 4) AS score, b.score >= 90 AS high_quality "
    "FROM asked a JOIN best b ON b.query = a.query AND b.k = a.k WHERE b.score >= a.show")


@register("study_names")
def q_study_names(spark, sf):
    """M9-M12 and M16 over a table of user queries, each with its own number of
    matches and display threshold."""
    return M.study_requests(FX.study_requests(spark, sf), FX.catalogue(spark, sf))


# --------------------------------------------------------------------------
# links and pages P1-P10
# --------------------------------------------------------------------------

from ..operators import links as L  # noqa: E402

SHOP = FX.SHOP
HREF_SQL = (f"CASE WHEN p_partkey % 7 = 1 THEN '{SHOP}/products/' || p_partkey "
            f"WHEN p_partkey % 7 = 2 THEN '//shop.example.com/products/' || p_partkey "
            f"ELSE '/products/' || p_partkey END")
LISTING = (
    "SELECT pg AS page_id, '" + SHOP + "/products/all?offset=' || pg AS url, "
    "'<html><body><!-- <a href=\"/products/old\">Old</a> --><a data-href=\"/products/no\">No</a>"
    "<nav><a href=\"/products/new\">New</a> <a href=\"/products/create\">Create</a></nav><ul>' || "
    "string_agg('<li><a href=\"' || href || '\">' || p_partkey || '</a></li>', '' ORDER BY p_partkey) || "
    "'</ul><a href=\"/products/' || min(p_partkey) || '\">again</a><a href=\"/products/' || ((pg + 1) * 50) || "
    "'\">featured</a><a href=\"/about\">About</a><a class=\"next\" href=\"/products/all?offset=' || (pg + 1) || "
    "'\">Next</a></body></html>' AS html "
    f"FROM (SELECT CAST(floor(p_partkey / 50) AS BIGINT) AS pg, p_partkey, {HREF_SQL} AS href FROM part) x GROUP BY pg")
ANCHOR = r'<a\b[^>]*?\shref="([^"]*)"'
UNESCAPED = ("replace(replace(replace(replace(replace(x, '&lt;', '<'), '&gt;', '>'), '&quot;', chr(34)), '&#x27;', chr(39)), "
             "'&amp;', '&')")


def _links_sql(src: str, contains: str) -> str:
    return (f"SELECT * FROM (SELECT page_id, url, UNNEST(range(len(h))) AS pos, UNNEST(h) AS href FROM "
            f"(SELECT page_id, url, list_transform(regexp_extract_all(regexp_replace(html, '(?s)<!--.*?-->', '', 'g'), '{ANCHOR}', 1), "
            f"lambda x: {UNESCAPED}) AS h FROM ({src}) s) t) u "
            f"WHERE contains(href, '{contains}')")


SKIP_SQL = "NOT (contains(href, '/new') OR contains(href, '/create') OR contains(href, '/all'))"
RESOLVE_SQL = (
    "CASE WHEN regexp_matches(href, '^[A-Za-z][A-Za-z0-9+.\\-]*:') THEN href "
    "WHEN starts_with(href, '//') THEN regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.\\-]*):', 1) || ':' || href "
    "WHEN starts_with(href, '/') THEN regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.\\-]*://[^/?#]*)', 1) || href "
    "WHEN starts_with(href, '?') THEN regexp_extract(url, '^([^?#]*)', 1) || href "
    "WHEN starts_with(href, '#') THEN regexp_extract(url, '^([^#]*)', 1) || href "
    "WHEN href = '' THEN regexp_extract(url, '^([^#]*)', 1) "
    "ELSE regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.\\-]*://[^/?#]*(?:[^?#]*/)?)', 1) || href END")
OFFSET_SQL = "coalesce(TRY_CAST(nullif(regexp_extract(url, 'offset=(\\d+)', 1), '') AS BIGINT), 0)"
PRODUCT_LINKS = (f"SELECT *, {RESOLVE_SQL} AS full_url, {OFFSET_SQL} AS \"offset\", "
                 f"CAST({OFFSET_SQL} + 1 AS INTEGER) AS page_number FROM ({_links_sql(LISTING, '/products/')}) l "
                 f"WHERE {SKIP_SQL}")
FIRST_SEEN = (f"SELECT full_url, arg_min(struct_pack(page_id := page_id, url := url, pos := pos, href := href, "
              f"\"offset\" := \"offset\", page_number := page_number), struct_pack(o := \"offset\", g := page_id, u := url, p := pos)) AS r "
              f"FROM ({PRODUCT_LINKS}) pl GROUP BY full_url")


@register("extract_links", _links_sql("SELECT page_id, url, html FROM pages", "/"))
def q_extract_links(spark, sf):
    from ..session import table
    return L.extract_links(table(spark, sf, "pages"), contains="/")


@register("filter_links",
          f"SELECT page_id, url, pos, href FROM ({_links_sql(LISTING, '/products/')}) l WHERE {SKIP_SQL}")
def q_filter_links(spark, sf):
    lk = L.extract_links(FX.listing_pages(spark, sf))
    return lk.filter(L.skip_filter("href")).select("page_id", "url", "pos", "href")


@register("resolve_urls", f"SELECT page_id, pos, href, full_url FROM ({PRODUCT_LINKS}) p")
def q_resolve_urls(spark, sf):
    return L.product_links(FX.listing_pages(spark, sf)).select("page_id", "pos", "href", "full_url")


@register("first_seen_links",
          f"SELECT full_url, r.page_id AS page_id, r.pos AS pos, r.page_number AS page_number FROM ({FIRST_SEEN}) f")
def q_first_seen_links(spark, sf):
    fs = L.first_seen(L.product_links(FX.listing_pages(spark, sf)))
    return fs.select("full_url", "page_id", "pos", "page_number")


@register("page_offsets",
          f"SELECT page_id, url, {OFFSET_SQL} AS \"offset\", {OFFSET_SQL} + 1 AS page_number, "
          f"{OFFSET_SQL} * 50 + 1 AS first_rank, ({OFFSET_SQL} + 1) * 50 AS last_rank "
          f"FROM (SELECT page_id, url FROM pages UNION ALL SELECT page_id, url FROM ({LISTING}) l) u")
def q_page_offsets(spark, sf):
    from ..session import table
    src = table(spark, sf, "pages").select("page_id", "url").unionByName(
        FX.listing_pages(spark, sf).select("page_id", "url"))
    return L.with_page_numbers(src)


PLAN_SQL = f"SELECT unnest(range(0, (SELECT greatest({L.TOTAL_PAGES}, max({OFFSET_SQL}) + 1) FROM ({LISTING}) l))) AS range"


@register("missing_pages",
          f"SELECT range AS \"offset\" FROM ({PLAN_SQL}) p WHERE range NOT IN (SELECT {OFFSET_SQL} FROM ({LISTING}) l)")
def q_missing_pages(spark, sf):
    lp = FX.listing_pages(spark, sf).select(L.page_offset("url").alias("offset"))
    return L.missing_pages(spark, lp)


@register("page_batches",
          f"SELECT CAST(floor(range / 100) + 1 AS INTEGER) AS batch_number, min(range) AS start_offset, "
          f"max(range) AS end_offset, count(*) AS pages, count(o.off) AS pages_present "
          f"FROM ({PLAN_SQL}) p LEFT JOIN (SELECT DISTINCT {OFFSET_SQL} AS off FROM ({LISTING}) l) o "
          f"ON o.off = range GROUP BY 1")
def q_page_batches(spark, sf):
    lp = FX.listing_pages(spark, sf).select(L.page_offset("url").alias("offset"))
    return L.batch_plan(spark, lp)


@register("resume_point",
          f"SELECT coalesce(max({OFFSET_SQL}) + 1, 0) AS resume_offset FROM ({LISTING}) l")
def q_resume_point(spark, sf):
    lp = FX.listing_pages(spark, sf).select(L.page_offset("url").alias("last_offset"))
    return L.resume_point(lp)


# --------------------------------------------------------------------------
# keyed state C1-C12, routing, reports A1-A8, output batches K1, M17
# --------------------------------------------------------------------------

from ..operators import reports as R  # noqa: E402
from ..operators import state as ST  # noqa: E402
from ..sinks import writers as W  # noqa: E402

VARIANT = QNAMES[len("SELECT p_partkey AS query_id, "):QNAMES.index(" AS query FROM part")]
M1_SQL = "(p_partkey % 3 = 0 AND p_partkey % 7 <> 0)"
M2_SQL = f"({M1_SQL} OR (p_partkey % 5 = 0 AND p_partkey % 7 <> 0))"


def _state_version_sql(m: str, v: int) -> str:
    return (f"SELECT '{SHOP}/products/' || p_partkey AS url, CASE WHEN p_partkey % 7 <> 0 THEN {VARIANT} END AS full_name, "
            f"{m} AS matched, CASE WHEN {m} THEN {FULL} END AS matched_name, CASE WHEN {m} THEN p_type END AS category, "
            f"CAST(floor(p_partkey / 50) + 1 AS INTEGER) AS page_number, {v} AS version FROM part")


STATE_VERSIONS = f"{_state_version_sql(M1_SQL, 1)} UNION ALL {_state_version_sql(M2_SQL, 2)}"
STATE = (f"SELECT url, r.full_name AS full_name, r.matched AS matched, r.matched_name AS matched_name, "
         f"r.category AS category, r.page_number AS page_number, r.version AS version FROM ("
         f"SELECT url, arg_max(struct_pack(full_name := full_name, matched := matched, matched_name := matched_name, "
         f"category := category, page_number := page_number, version := version), version) AS r "
         f"FROM ({STATE_VERSIONS}) v WHERE url IS NOT NULL GROUP BY url) s")
LOOKUPS = (f"SELECT l_orderkey, l_linenumber, CASE WHEN l_partkey % 11 = 0 THEN '{SHOP}/products/unknown-' || l_partkey "
           f"ELSE '{SHOP}/products/' || l_partkey END AS url FROM lineitem")
LOOKED_UP = (f"SELECT lk.*, st.url IS NOT NULL AS _hit, coalesce(st.matched, false) AS _matched "
             f"FROM ({LOOKUPS}) lk LEFT JOIN ({STATE}) st USING (url)")
LOOKUP_COUNTERS = (
    f"SELECT hits, matched_hits, hits - matched_hits AS unmatched_hits, misses, "
    f"coalesce(hits / nullif(hits + misses, 0), 0.0) AS hit_ratio, "
    f"coalesce(matched_hits / nullif(hits + misses, 0), 0.0) AS effective_hit_ratio FROM ("
    f"SELECT count(*) FILTER (WHERE _hit) AS hits, count(*) FILTER (WHERE _hit AND _matched) AS matched_hits, "
    f"count(*) FILTER (WHERE NOT _hit) AS misses FROM ({LOOKED_UP}) x) c")
SIZE_COUNTERS = (f"SELECT count(*) AS size, count(*) FILTER (WHERE coalesce(matched, false)) AS matched_count, "
                 f"count(*) - count(*) FILTER (WHERE coalesce(matched, false)) AS unmatched_count FROM ({STATE}) s")


def _state(spark, sf):
    v = FX.state_versions(spark, sf)
    return ST.upsert(v.filter(F.col("version") == 1), v.filter(F.col("version") == 2))


@register("state_upsert", STATE)
def q_state_upsert(spark, sf):
    return _state(spark, sf)


@register("state_semi", f"SELECT * FROM ({LOOKUPS}) lk WHERE url IN (SELECT url FROM ({STATE}) s)")
def q_state_semi(spark, sf):
    return ST.known(FX.lookups(spark, sf), _state(spark, sf))


@register("state_anti", f"SELECT * FROM ({LOOKUPS}) lk WHERE url NOT IN (SELECT url FROM ({STATE}) s)")
def q_state_anti(spark, sf):
    return ST.unknown(FX.lookups(spark, sf), _state(spark, sf))


@register("state_lookup_stats", LOOKUP_COUNTERS)
def q_state_lookup_stats(spark, sf):
    return ST.lookup_counters(ST.lookup(FX.lookups(spark, sf), _state(spark, sf)))


@register("state_stats", f"SELECT * FROM ({SIZE_COUNTERS}) a CROSS JOIN ({LOOKUP_COUNTERS}) b")
def q_state_stats(spark, sf):
    return ST.stats(_state(spark, sf), FX.lookups(spark, sf))


@register("state_clear",
          f"SELECT 0::BIGINT AS size, 0::BIGINT AS matched_count, 0::BIGINT AS unmatched_count, "
          f"0::BIGINT AS hits, 0::BIGINT AS matched_hits, 0::BIGINT AS unmatched_hits, count(*) AS misses, "
          f"0.0::DOUBLE AS hit_ratio, 0.0::DOUBLE AS effective_hit_ratio FROM ({LOOKUPS}) lk")
def q_state_clear(spark, sf):
    return ST.stats(ST.clear(_state(spark, sf)), FX.lookups(spark, sf))


LINKS_FS = (f"SELECT full_url, r.page_id AS page_id, r.pos AS pos, r.\"offset\" AS \"offset\", "
            f"r.page_number AS page_number FROM ({FIRST_SEEN}) f")
NEED = (f"SELECT DISTINCT st.full_name AS query_id, st.full_name AS query FROM ({LINKS_FS}) l "
        f"JOIN ({STATE}) st ON st.url = l.full_url WHERE NOT coalesce(st.matched, false) AND st.full_name IS NOT NULL")
ROUTED = (
    f"SELECT l.full_url, l.page_id, l.pos, l.\"offset\", l.page_number, st.url IS NOT NULL AS cached, "
    f"CASE WHEN st.url IS NULL OR st.full_name IS NULL THEN 'fetch' WHEN coalesce(st.matched, false) THEN 'emit_cached' "
    f"WHEN coalesce(bm.matched, false) THEN 'emit_rematched' ELSE 'skip' END AS route, "
    f"CASE WHEN st.url IS NULL OR st.full_name IS NULL THEN NULL WHEN coalesce(st.matched, false) THEN true "
    f"WHEN coalesce(bm.matched, false) THEN true ELSE false END AS matched, "
    f"CASE WHEN st.url IS NULL OR st.full_name IS NULL THEN NULL WHEN coalesce(st.matched, false) THEN st.matched_name "
    f"WHEN coalesce(bm.matched, false) THEN bm.matched_name END AS matched_name, "
    f"CASE WHEN st.url IS NULL OR st.full_name IS NULL THEN NULL WHEN coalesce(st.matched, false) THEN st.category "
    f"WHEN coalesce(bm.matched, false) THEN bm.category END AS category "
    f"FROM ({LINKS_FS}) l LEFT JOIN ({STATE}) st ON st.url = l.full_url "
    f"LEFT JOIN ({_best_match_sql(90, NEED)}) bm ON bm.query = st.full_name")


def _links(spark, sf):
    fs = L.first_seen(L.product_links(FX.listing_pages(spark, sf)))
    return fs.select("full_url", "page_id", "pos", "offset", "page_number")


def _routed(spark, sf):
    return ST.route_links(_links(spark, sf), _state(spark, sf), FX.catalogue(spark, sf))


@register("route_links", ROUTED)
def q_route_links(spark, sf):
    return _routed(spark, sf)


@register("time_saved",
          f"SELECT count(*) FILTER (WHERE route = 'emit_cached') AS matched_cached, "
          f"count(*) FILTER (WHERE route = 'emit_cached') * 2.5 AS time_saved_sec FROM ({ROUTED}) r")
def q_time_saved(spark, sf):
    return ST.time_saved(_routed(spark, sf))


REMATCH_Q = (f"SELECT DISTINCT full_name AS query_id, full_name AS query FROM ({STATE}) s "
             f"WHERE NOT coalesce(matched, false) AND full_name IS NOT NULL")


@register("rematch_unmatched",
          f"SELECT st.url, st.full_name, coalesce(bm.matched, false) AS matched, bm.matched_name, bm.category, bm.score "
          f"FROM ({STATE}) st LEFT JOIN ({_best_match_sql(90, REMATCH_Q)}) bm ON bm.query = st.full_name "
          f"WHERE NOT coalesce(st.matched, false) AND st.full_name IS NOT NULL")
def q_rematch_unmatched(spark, sf):
    return M.rematch_unmatched(_state(spark, sf), FX.catalogue(spark, sf))


CAT_BEFORE = f"SELECT * FROM ({CAT}) v WHERE idx % 10 <> 3"
CAT_AFTER = f"SELECT idx, brand, name, CASE WHEN idx % 13 = 0 THEN lower(category) ELSE category END AS category FROM ({CAT}) v WHERE idx % 11 <> 5"


@register("rematch_delta", _best_match_sql(90).replace(CAT, CAT_AFTER))
def q_rematch_delta(spark, sf):
    """M17 over two versions of the catalogue: matches against the first are
    brought up to the second, which equals a whole match against it."""
    before, after = FX.catalogue_versions(spark, sf)
    stored = M.best_match(FX.query_names(spark, sf), before, threshold=90)
    return M.rematch_delta(stored, before, after, threshold=90)


@register("page_stats",
          f"SELECT page_number, count(*) AS page_products, count(*) FILTER (WHERE cached) AS cached_products, "
          f"count(*) FILTER (WHERE route = 'emit_cached') AS matched_cached_products FROM ({ROUTED}) r GROUP BY page_number")
def q_page_stats(spark, sf):
    return R.page_stats(_routed(spark, sf))


@register("run_totals",
          f"SELECT count(DISTINCT page_number) AS total_pages, count(*) AS total_products, "
          f"count(*) FILTER (WHERE coalesce(matched, false)) AS matched_products, "
          f"coalesce(100.0 * (count(*) FILTER (WHERE coalesce(matched, false)) / nullif(count(*), 0)), 0.0) AS match_ratio "
          f"FROM ({ROUTED}) r")
def q_run_totals(spark, sf):
    return R.run_totals(_routed(spark, sf))


BATCH_SUMMARY = (
    f"SELECT CAST(floor(\"offset\" / 100) + 1 AS INTEGER) AS batch_number, "
    f"CAST((floor(\"offset\" / 100)) * 100 AS BIGINT) AS start_offset, 100::BIGINT AS pages_per_batch, "
    f"count(DISTINCT \"offset\") AS total_pages, count(*) AS total_products, "
    f"count(*) FILTER (WHERE coalesce(matched, false)) AS matched_products, max(\"offset\") AS end_offset "
    f"FROM ({ROUTED}) r GROUP BY 1, 2")


@register("batch_summary", BATCH_SUMMARY)
def q_batch_summary(spark, sf):
    return R.batch_summary(_routed(spark, sf))


GLOBAL = (f"SELECT sum(coalesce(total_pages, 0))::BIGINT AS total_pages, sum(coalesce(total_products, 0))::BIGINT AS total_products, "
          f"sum(coalesce(matched_products, 0))::BIGINT AS matched_products, count(*) AS total_batches FROM ({BATCH_SUMMARY}) b")


@register("global_stats", GLOBAL)
def q_global_stats(spark, sf):
    return R.global_stats(R.batch_summary(_routed(spark, sf)))


@register("final_summary",
          f"SELECT g.*, l.batch_summaries, coalesce(100.0 * (g.matched_products / nullif(g.total_products, 0)), 0.0) AS match_percentage "
          f"FROM ({GLOBAL}) g CROSS JOIN (SELECT to_json(list(struct_pack(batch_number := batch_number, start_offset := start_offset, "
          f"pages_per_batch := pages_per_batch, total_pages := total_pages, total_products := total_products, "
          f"matched_products := matched_products, end_offset := end_offset) ORDER BY batch_number))::VARCHAR AS batch_summaries "
          f"FROM ({BATCH_SUMMARY}) b) l")
def q_final_summary(spark, sf):
    return R.final_summary(R.batch_summary(_routed(spark, sf)))


@register("summary_rollup",
          f"SELECT CAST(floor(\"offset\" / 100) + 1 AS INTEGER) AS batch_number, count(*) AS total_products, "
          f"count(*) FILTER (WHERE coalesce(matched, false)) AS matched_products, count(DISTINCT \"offset\") AS total_pages, "
          f"CAST(GROUPING(CAST(floor(\"offset\" / 100) + 1 AS INTEGER)) AS BIGINT) AS level "
          f"FROM ({ROUTED}) r GROUP BY ROLLUP (CAST(floor(\"offset\" / 100) + 1 AS INTEGER))")
def q_summary_rollup(spark, sf):
    return R.summary_rollup(_routed(spark, sf))


@register("output_batches",
          f"SELECT full_url, page_number, route, CAST(ceil(row_number() OVER (ORDER BY \"offset\", pos) / 500.0) AS INTEGER) "
          f"AS batch_number FROM ({ROUTED}) r WHERE route IN ('emit_cached', 'emit_rematched')")
def q_output_batches(spark, sf):
    emitted = _routed(spark, sf).filter(F.col("route").isin("emit_cached", "emit_rematched"))
    return W.number_batches(emitted.select("full_url", "page_number", "route", "offset", "pos"),
                            ["offset", "pos"]).select("full_url", "page_number", "route", "batch_number")


# --------------------------------------------------------------------------
# product-page extraction E1-E19, end-to-end match M18, status A9
# --------------------------------------------------------------------------
# product pages E1-E19, M18
# --------------------------------------------------------------------------

from ..operators import extract as E  # noqa: E402


def _extracted_sql() -> str:
    """What the product pages must give, selected from the values that they are
    built from; no pattern is shared with the extraction."""
    k, v, w = "p_partkey", "(p_partkey % 9)", "(p_partkey % 5)"
    ok = f"({k} % 97 <> 13)"
    brand = f"(CASE WHEN {v} <> 1 THEN p_brand || CASE WHEN {w} = 1 THEN ' & Co' ELSE '' END END)"
    name = f"(CASE WHEN {v} <> 2 THEN p_name END)"
    image = f"('/img/' || {k} || CASE WHEN {v} = 6 THEN '.jpeg' ELSE '@1x.jpeg' END)"
    ing1, ing2, ing3 = "split_part(p_name, ' ', 1)", "split_part(p_name, ' ', 2)", "lower(p_type)"

    def row(name, link, role, irr, com, take):
        return (f"struct_pack(name := {name}, ingredient_link := '{SHOP}/ingredients/' || {link}, what_it_does := ['{role}'], "
                f"irritancy_values := {irr}, comedogenicity_values := {com}, id_rating := {take})")
    none, text = "NULL::VARCHAR[]", "::VARCHAR"
    r1 = row(ing1, ing1, "solvent", f"[({k} % 3){text}]", f"[({k} % 5){text}]", "'goodie'")
    r2 = row(ing2, ing2, "emollient", f"CASE WHEN {v} = 5 THEN {none} ELSE [({k} % 4){text}] END", f"[({k} % 2){text}]", "'icky'")
    r3 = row(ing3, ing3, "preservative", "['0']", f"CASE WHEN {v} = 5 THEN {none} ELSE ['1'] END", "NULL")
    rows = f"(CASE WHEN {v} = 8 THEN [{r1}, {r3}] ELSE [{r1}, {r2}, {r3}] END)"
    items = (f"list_filter({rows}, lambda z, i: list_position(list_transform({rows}, lambda y: y.name), z.name) = i)")
    highlights = (f"[struct_pack(\"function\" := 'solvent', ingredients := [{ing1}]), "
                  f"struct_pack(\"function\" := '', ingredients := [{ing3}])]")
    return (
        f"SELECT {k} AS page_id, CASE WHEN {ok} THEN {brand} || ' ' || {name} END AS full_name, "
        f"CASE WHEN {ok} THEN {brand} END AS brand, CASE WHEN {ok} THEN {name} END AS name, "
        f"CASE WHEN {ok} THEN p_type || ' size ' || p_size END AS description, "
        f"CAST(floor({k} / 50) + 1 AS INTEGER) AS page_number, '{SHOP}/products/' || {k} AS url, "
        f"CASE WHEN {ok} THEN {image} END AS image_url, "
        f"CASE WHEN {ok} AND {v} <> 6 THEN '/img/' || {k} || '_original.jpeg' END AS high_res_image_url, "
        f"CASE WHEN {ok} THEN CASE WHEN {v} = 3 THEN [] ELSE {items} END END AS ingredients, "
        f"CASE WHEN {ok} THEN ['#' || {ing3}] END AS hashtags, CASE WHEN {ok} THEN {highlights} END AS highlights, "
        f"CASE WHEN NOT {ok} THEN 'empty or missing page body' END AS error FROM part")


EXTRACTED = _extracted_sql()


def _extracted(spark, sf):
    return E.extract_products(FX.product_pages(spark, sf))


@register("product_fields",
          f"SELECT url, full_name, brand, name, description, page_number, image_url, high_res_image_url, error FROM ({EXTRACTED}) e")
def q_product_fields(spark, sf):
    return _extracted(spark, sf).select("url", "full_name", "brand", "name", "description", "page_number",
                                        "image_url", "high_res_image_url", "error")


@register("high_res_image",
          f"SELECT url, image_url, high_res_image_url FROM ({EXTRACTED}) e WHERE image_url IS NOT NULL")
def q_high_res_image(spark, sf):
    return _extracted(spark, sf).filter(F.col("image_url").isNotNull()).select("url", "image_url", "high_res_image_url")


ING_FLAT = (f"SELECT url, g.pos AS pos, g.v.name AS name, g.v.ingredient_link AS ingredient_link, "
            f"to_json(g.v.what_it_does)::VARCHAR AS what_it_does, to_json(g.v.irritancy_values)::VARCHAR AS irritancy_values, "
            f"to_json(g.v.comedogenicity_values)::VARCHAR AS comedogenicity_values, g.v.id_rating AS id_rating "
            f"FROM (SELECT url, UNNEST(list_transform(range(len(ingredients)), lambda ix: struct_pack(pos := ix, v := ingredients[ix + 1]))) AS g "
            f"FROM ({EXTRACTED}) e) t")


def _ing_flat(spark, sf):
    fl = E.flatten_ingredients(_extracted(spark, sf))
    return fl.select("url", "pos", "name", "ingredient_link", F.to_json("what_it_does").alias("what_it_does"),
                     F.to_json("irritancy_values").alias("irritancy_values"),
                     F.to_json("comedogenicity_values").alias("comedogenicity_values"), "id_rating")


@register("ingredients", ING_FLAT)
def q_ingredients(spark, sf):
    return _ing_flat(spark, sf)


@register("ingredient_dedup",
          f"SELECT url, len(ingredients) AS ingredient_count, "
          f"to_json(list_transform(ingredients, lambda z: z.name))::VARCHAR AS names FROM ({EXTRACTED}) e WHERE error IS NULL")
def q_ingredient_dedup(spark, sf):
    ex = _extracted(spark, sf).filter(F.col("error").isNull())
    return ex.select("url", F.size("ingredients").alias("ingredient_count"),
                     F.to_json(F.transform("ingredients", lambda z: z["name"])).alias("names"))


@register("ingredient_ratings",
          f"SELECT url, name, kind, value, TRY_CAST(value AS INTEGER) AS value_num FROM ("
          f"SELECT url, g.v.name AS name, 'irritancy' AS kind, UNNEST(g.v.irritancy_values) AS value FROM "
          f"(SELECT url, UNNEST(ingredients) AS g FROM (SELECT url, list_transform(ingredients, lambda q: struct_pack(v := q)) AS ingredients FROM ({EXTRACTED}) e0) e) t "
          f"UNION ALL SELECT url, g.v.name AS name, 'comedogenicity' AS kind, UNNEST(g.v.comedogenicity_values) AS value FROM "
          f"(SELECT url, UNNEST(ingredients) AS g FROM (SELECT url, list_transform(ingredients, lambda q: struct_pack(v := q)) AS ingredients FROM ({EXTRACTED}) e0) e) t2) u")
def q_ingredient_ratings(spark, sf):
    fl = E.flatten_ingredients(_extracted(spark, sf))
    irr = fl.select("url", "name", F.lit("irritancy").alias("kind"), F.explode("irritancy_values").alias("value"))
    com = fl.select("url", "name", F.lit("comedogenicity").alias("kind"), F.explode("comedogenicity_values").alias("value"))
    both = irr.unionByName(com)
    return both.withColumn("value_num", F.col("value").try_cast("int"))


@register("hashtags", f"SELECT url, to_json(hashtags)::VARCHAR AS hashtags FROM ({EXTRACTED}) e")
def q_hashtags(spark, sf):
    return _extracted(spark, sf).select("url", F.to_json("hashtags").alias("hashtags"))


@register("highlights", f"SELECT url, to_json(highlights)::VARCHAR AS highlights FROM ({EXTRACTED}) e")
def q_highlights(spark, sf):
    return _extracted(spark, sf).select("url", F.to_json("highlights").alias("highlights"))


@register("extract_errors",
          f"SELECT url, page_number, error, false AS matched FROM ({EXTRACTED}) e WHERE error IS NOT NULL")
def q_extract_errors(spark, sf):
    ex = _extracted(spark, sf)
    return ex.filter(F.col("error").isNotNull()).select("url", "page_number", "error", F.lit(False).alias("matched"))


@register("product_flatten",
          f"SELECT url, pos, name, UNNEST(from_json(what_it_does, '[\"VARCHAR\"]')) AS function FROM ({ING_FLAT}) f")
def q_product_flatten(spark, sf):
    return E.flatten_functions(_extracted(spark, sf))


PRODUCTS_MATCHED = (
    f"SELECT e.url, e.full_name, e.page_number, e.error, coalesce(bm.matched, false) AS matched, bm.matched_name, bm.category "
    f"FROM ({EXTRACTED}) e LEFT JOIN ({_best_match_sql(90, 'SELECT DISTINCT full_name AS query_id, full_name AS query FROM (' + EXTRACTED + ') x WHERE full_name IS NOT NULL')}) bm "
    f"ON bm.query = e.full_name")


def _matched_products(spark, sf):
    return E.match_products(_extracted(spark, sf).select("url", "full_name", "page_number", "error"), FX.catalogue(spark, sf))


@register("product_match", f"SELECT url, full_name, page_number, matched, matched_name, category FROM ({PRODUCTS_MATCHED}) p")
def q_product_match(spark, sf):
    return _matched_products(spark, sf).select("url", "full_name", "page_number", "matched", "matched_name", "category")


@register("match_status",
          f"SELECT CASE WHEN error IS NOT NULL THEN 'error' WHEN full_name IS NULL THEN 'missing_name' "
          f"WHEN matched THEN 'matched' ELSE 'unmatched' END AS status, count(*) AS products FROM ({PRODUCTS_MATCHED}) p GROUP BY 1")
def q_match_status(spark, sf):
    return R.match_status(_matched_products(spark, sf))


# --------------------------------------------------------------------------
# streaming T1-T5 (final tables compared with the batch results)
# --------------------------------------------------------------------------

from ..streaming import ingest as SI  # noqa: E402

STREAM_FILES = 4


def _stream_links(spark, sf, resume: bool = False):
    run = SI.new_run_dir(spark, "links")
    src, out, ck = (f"{run}/source", f"{run}/links", f"{run}/checkpoint")
    pages = FX.listing_pages(spark, sf)
    if resume:
        # first half of the corpus, run to completion, then the rest arrives
        # and the same checkpoint resumes with only the new files
        mid = pages.agg(F.percentile_approx("page_id", 0.5)).first()[0]
        SI.stage_files(pages.filter(F.col("page_id") <= mid), src, STREAM_FILES // 2, "page_id")
        SI.run_link_stream(spark, src, out, ck, pages.schema)
        SI.stage_files(pages.filter(F.col("page_id") > mid), src, STREAM_FILES // 2, "page_id")
        SI.run_link_stream(spark, src, out, ck, pages.schema)
    else:
        SI.stage_files(pages, src, STREAM_FILES, "page_id")
        SI.run_link_stream(spark, src, out, ck, pages.schema)
    return spark.read.parquet(out)


def _stored_state(spark, base):
    return spark.read.parquet(W.current_pointer(spark, base)["path"])


@register("stream_dedup",
          f"SELECT full_url, r.page_id AS page_id, r.pos AS pos, r.page_number AS page_number FROM ({FIRST_SEEN}) f")
def q_stream_dedup(spark, sf):
    return _stream_links(spark, sf).select("full_url", "page_id", "pos", "page_number")


@register("stream_ingest",
          f"SELECT page_id, count(*) AS links FROM ({LINKS_FS}) l GROUP BY page_id")
def q_stream_ingest(spark, sf):
    return _stream_links(spark, sf).groupBy("page_id").agg(F.count(F.lit(1)).alias("links"))


@register("stream_resume",
          f"SELECT full_url, r.page_id AS page_id, r.pos AS pos, r.page_number AS page_number FROM ({FIRST_SEEN}) f")
def q_stream_resume(spark, sf):
    return _stream_links(spark, sf, resume=True).select("full_url", "page_id", "pos", "page_number")


@register("stream_upsert",
          f"SELECT url, full_name, matched, matched_name, category FROM ({PRODUCTS_MATCHED}) p")
def q_stream_upsert(spark, sf):
    run = SI.new_run_dir(spark, "state")
    src, base, ck = f"{run}/source", f"{run}/state", f"{run}/checkpoint"
    pages = FX.product_pages(spark, sf)
    SI.stage_files(pages, src, STREAM_FILES, "page_id")
    SI.run_state_stream(spark, src, base, ck, pages.schema, FX.catalogue(spark, sf))
    return _stored_state(spark, base).select("url", "full_name", "matched", "matched_name", "category")


@register("stream_two_runs",
          f"SELECT 'link' AS kind, full_url AS url, NULL::VARCHAR AS full_name, NULL::BOOLEAN AS matched FROM ({FIRST_SEEN}) f "
          f"UNION ALL SELECT 'product', url, full_name, matched FROM ({PRODUCTS_MATCHED}) p")
def q_stream_two_runs(spark, sf):
    """T2-T4 over two runs with checkpoints of their own and one output: the
    second adds to what the first left."""
    run = SI.new_run_dir(spark, "two-runs")
    listing, product = FX.listing_pages(spark, sf), FX.product_pages(spark, sf)
    for k in (0, 1):
        for name, pages in (("listing", listing), ("product", product)):
            mid = pages.agg(F.percentile_approx("page_id", 0.5)).first()[0]
            part = pages.filter((F.col("page_id") > mid) == F.lit(bool(k)))
            SI.stage_files(part, f"{run}/{name}-{k}", 2, "page_id")
        SI.run_link_stream(spark, f"{run}/listing-{k}", f"{run}/links", f"{run}/link-checkpoint-{k}", listing.schema)
        SI.run_state_stream(spark, f"{run}/product-{k}", f"{run}/state", f"{run}/state-checkpoint-{k}", product.schema,
                            FX.catalogue(spark, sf))
    links = spark.read.parquet(f"{run}/links")
    none = F.lit(None)
    return (links.select(F.lit("link").alias("kind"), F.col("full_url").alias("url"), none.cast("string").alias("full_name"),
                         none.cast("boolean").alias("matched"))
            .unionByName(_stored_state(spark, f"{run}/state").select(F.lit("product").alias("kind"), "url", "full_name", "matched")))


@register("stream_stats",
          f"SELECT count(*) AS total_products, count(full_name) AS named_products, "
          f"count(error) AS error_products FROM ({EXTRACTED}) e")
def q_stream_stats(spark, sf):
    run = SI.new_run_dir(spark, "totals")
    src, out, ck = f"{run}/source", f"{run}/totals", f"{run}/checkpoint"
    pages = FX.product_pages(spark, sf)
    SI.stage_files(pages, src, STREAM_FILES, "page_id")
    SI.run_totals_stream(spark, src, out, ck, pages.schema)
    return SI.read_totals(spark, out)


# --------------------------------------------------------------------------
# summaries as files: K3 crawl summary, K4/S7 batch summary files, K5/S6
# --------------------------------------------------------------------------

from ..sources import summaries as SS  # noqa: E402


@register("crawl_summary",
          f"SELECT count(DISTINCT page_number) AS total_pages, count(*) AS total_products, "
          f"count(*) FILTER (WHERE coalesce(matched, false)) AS matched_products, "
          f"coalesce(100.0 * (count(*) FILTER (WHERE coalesce(matched, false)) / nullif(count(*), 0)), 0.0) AS match_ratio, "
          f"max(page_number)::BIGINT AS last_page_processed, CAST(ceil(count(*) / 500) AS BIGINT) AS total_batches, "
          f"500::BIGINT AS products_per_batch, 'finished' AS reason FROM ({PRODUCTS_MATCHED}) p")
def q_crawl_summary(spark, sf):
    return R.crawl_summary(_matched_products(spark, sf))


def _summary_files(spark, sf):
    """K4 writes one summary folder per batch (``batch_number=N``, written by
    the executors); S7 reads them back with a glob."""
    run = SI.new_run_dir(spark, "summaries")
    W.write_batch_summaries(R.batch_summary(_routed(spark, sf), pages_per_batch=10), run)
    return run


BATCH_SUMMARY_10 = BATCH_SUMMARY.replace("/ 100)", "/ 10)").replace(") * 100 AS", ") * 10 AS").replace(
    "100::BIGINT AS pages_per_batch", "10::BIGINT AS pages_per_batch")


@register("batch_summary_files", BATCH_SUMMARY_10)
def q_batch_summary_files(spark, sf):
    run = _summary_files(spark, sf)
    return SS.read_batch_summaries(spark, run).drop("batch_dir")


@register("global_stats_update",
          f"SELECT sum(total_pages)::BIGINT AS total_pages, sum(total_products)::BIGINT AS total_products, "
          f"sum(matched_products)::BIGINT AS matched_products, count(*)::BIGINT AS total_batches FROM ({BATCH_SUMMARY_10}) b")
def q_global_stats_update(spark, sf):
    run = _summary_files(spark, sf)
    prev = SS.read_global_stats(spark, f"{run}/global_stats")   # none saved yet -> empty
    return R.add_to_global(prev, SS.read_batch_summaries(spark, run))


# --------------------------------------------------------------------------
# the whole run
# --------------------------------------------------------------------------

FULL_RUN = (
    f"SELECT url, full_name, page_number, matched, matched_name, category, error, "
    f"CAST(ceil(row_number() OVER (ORDER BY page_number, pos, url) / 500) AS INTEGER) AS batch_number FROM ("
    f"SELECT r.full_url AS url, st.full_name, r.page_number, r.pos, r.matched, r.matched_name, r.category, NULL::VARCHAR AS error "
    f"FROM ({ROUTED}) r JOIN ({STATE}) st ON st.url = r.full_url WHERE r.route IN ('emit_cached', 'emit_rematched') "
    f"UNION ALL SELECT r.full_url, pm.full_name, r.page_number, r.pos, coalesce(pm.matched, false), pm.matched_name, pm.category, "
    f"CASE WHEN pm.url IS NULL OR pm.error IS NOT NULL THEN 'page not fetched' END "
    f"FROM ({ROUTED}) r LEFT JOIN ({PRODUCTS_MATCHED}) pm ON pm.url = r.full_url WHERE r.route = 'fetch') u")


def _full_run(spark, sf):
    """A run on the state of earlier crawls; returns its folder and products."""
    from .crawl import STATE_SCHEMA, run_crawl
    base = SI.new_run_dir(spark, "crawl")
    schema = spark.createDataFrame([], STATE_SCHEMA).schema
    earlier = _state(spark, sf).withColumn("version", F.col("version").cast("bigint"))
    for f in schema:
        if f.name not in earlier.columns:
            earlier = earlier.withColumn(f.name, F.lit(None).cast(f.dataType))
    W.publish_state(earlier.select(*[f.name for f in schema]), f"{base}/state", 2)
    return base, run_crawl(spark, FX.listing_pages(spark, sf), FX.product_pages(spark, sf), FX.catalogue(spark, sf), base, run_id="run-1")


@register("full_pipeline", FULL_RUN)
def q_full_pipeline(spark, sf):
    """Links, routes, fetch, extraction, match, state, batches, summaries."""
    _, products = _full_run(spark, sf)
    return products.select("url", "full_name", "page_number", "matched", "matched_name", "category", "error", "batch_number")


@register("full_pipeline_twice",
          f"SELECT k AS runs, sum(pages)::BIGINT AS total_pages, sum(products)::BIGINT AS total_products, "
          f"sum(good)::BIGINT AS matched_products, count(*) AS total_batches FROM (SELECT k, r, floor((page_number - 1) / 100) AS b, "
          f"count(DISTINCT page_number) AS pages, count(*) AS products, count(*) FILTER (WHERE matched) AS good FROM ("
          f"SELECT 1 AS r, page_number, matched FROM ({FULL_RUN}) p UNION ALL "
          # the second run finds the first one's names in the state: what has one and is matched is emitted, what has none is fetched again
          f"SELECT 2, page_number, matched FROM ({FULL_RUN}) p WHERE matched OR full_name IS NULL"
          f") x CROSS JOIN (SELECT unnest([1, 2]) AS k) ks WHERE r <= k GROUP BY 1, 2, 3) g GROUP BY k")
def q_full_pipeline_twice(spark, sf):
    """The global stats after a run that is called twice, and after a
    second run on the state that the first left."""
    from .crawl import run_crawl
    base, _ = _full_run(spark, sf)
    again = lambda run_id: run_crawl(spark, FX.listing_pages(spark, sf), FX.product_pages(spark, sf), FX.catalogue(spark, sf), base, run_id=run_id)
    again("run-1")
    first = SS.read_latest_global_stats(spark, base).select(F.lit(1).alias("runs"), "*")
    first = spark.createDataFrame(first.collect(), first.schema)  # one row, before the next run adds to it
    again("run-2")
    return first.unionByName(SS.read_latest_global_stats(spark, base).select(F.lit(2).alias("runs"), "*"))


@register("full_pipeline_state",
          f"SELECT coalesce(p.url, st.url) AS url, CASE WHEN p.url IS NULL THEN st.full_name ELSE p.full_name END AS full_name, "
          f"CASE WHEN p.url IS NULL THEN st.matched ELSE p.matched END AS matched FROM ({STATE}) st FULL OUTER JOIN ({FULL_RUN}) p ON p.url = st.url")
def q_full_pipeline_state(spark, sf):
    """The state after the run, re-matched rows written back."""
    base, _ = _full_run(spark, sf)
    return _stored_state(spark, f"{base}/state").select("url", "full_name", "matched")


@register("full_pipeline_stats",
          f"SELECT sum(pages)::BIGINT AS total_pages, sum(products)::BIGINT AS total_products, sum(good)::BIGINT AS matched_products, "
          f"count(*) AS total_batches FROM (SELECT floor((page_number - 1) / 100) AS b, count(DISTINCT page_number) AS pages, "
          f"count(*) AS products, count(*) FILTER (WHERE matched) AS good FROM ({FULL_RUN}) p GROUP BY 1) g")
def q_full_pipeline_stats(spark, sf):
    """The global stats that the run left, read back."""
    base, _ = _full_run(spark, sf)
    return SS.read_latest_global_stats(spark, base)
