"""Match joins (M7-M17): best match with length-adaptive thresholds, top-K
per scorer, merged top-K, threshold sweeps and recommendations.

Best matches at a weighted threshold of 86 or more (all that the crawl uses):

1. the catalogue is de-duplicated (first position wins, category of the last
   occurrence), query texts are made distinct;
2. ``operators.candidates`` joins both on the features that a pair must share
   to reach the threshold, which loses no match;
3. candidates pass an exact, code-generated necessary condition (length
   bands, thresholded ``levenshtein``, token differences, substring), and only
   what is left is scored;
4. ``max_by`` over ``struct(score, -idx)`` takes the best (ties: first
   catalogue position), a partial and a final aggregate.

Lower thresholds and single scorers compare all pairs: the catalogue is
broadcast only after a counted size check (``broadcast_rows``), beyond it the
same plan runs as a shuffled product (see README).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import similarity as S
from ..functions.semilocal import partial_score
from ..functions.text import apply_processor, col_
from ..session import DEFAULT_BROADCAST_BYTES, DEFAULT_BROADCAST_ROWS, cut_lineage, spread_for_compute
from ..sources.catalogue import refuse_invalid, unique_catalogue, with_full_name
from . import study
from .candidates import LEAST_THRESHOLD, candidate_pairs

# Fixed values (must equal the reference's rules):
DEFAULT_THRESHOLD = 90          # match threshold
SHORT_NAME_LENGTH = 15          # names shorter than this need >= 90
SHORT_NAME_MIN_THRESHOLD = 90
STUDY_THRESHOLDS = [95, 90, 85, 80, 75, 70, 65, 60]
STUDY_SCORERS = ["ratio", "token_set", "partial"]
HIGH_QUALITY_SCORE = 90
RECOMMENDATION_BANDS = [90, 80, 70]
SUSPICIOUS_TERMS = ["head", "head shoulders", "h s", "dove", "loreal", "l'oreal"]


def required_threshold(query: Column, threshold: float) -> Column:
    """M8: names shorter than 15 code points need max(90, threshold)."""
    t = F.lit(float(threshold))
    return F.when(F.length(query) < SHORT_NAME_LENGTH,
                  F.greatest(F.lit(float(SHORT_NAME_MIN_THRESHOLD)), t)).otherwise(t)


def match_side(catalogue: DataFrame, processor: str | None = "none") -> DataFrame:
    """De-duplicated catalogue with scorer features (built once per row). A
    catalogue with an item that lacks brand or name is rejected whole (S3);
    pass it through ``validate_catalogue(..., "quarantine")`` to match with
    the other items."""
    return S.with_match_features(unique_catalogue(refuse_invalid(catalogue)),
                                 apply_processor(F.col("full_name"), processor), "cf")


# Estimated bytes a catalogue row occupies on the broadcast side per code
# point of its text: three strings, three char arrays (~24 B per element
# in UnsafeArrayData with the string header) and three mask maps (key +
# one-word array per distinct char), rounded up.
BYTES_PER_CHAR = 160
# ... and per code point of the text features alone (three strings and tokens).
TEXT_BYTES_PER_CHAR = 16
ROW_OVERHEAD = 256
# A side with text features passes through the driver whole if it is broadcast.
TEXT_BROADCAST_BYTES = 64 * 1024 * 1024


def _pairs(queries: DataFrame, cat: DataFrame, broadcast_rows: int,
           broadcast_bytes: int | None = None) -> DataFrame:
    """Cross product of queries and the catalogue side. The catalogue is
    broadcast only when both its counted rows and its estimated size (from
    the measured text lengths) are under the limits; otherwise the pair
    work runs as a shuffled product (see README, known limits)."""
    if broadcast_bytes is None:
        broadcast_bytes = DEFAULT_BROADCAST_BYTES
    row = cat.agg(F.count(F.lit(1)).alias("n"),
                  F.coalesce(F.sum(F.length("cf_raw_s")), F.lit(0)).alias("chars")).first()
    est = row["n"] * ROW_OVERHEAD + row["chars"] * BYTES_PER_CHAR
    small = row["n"] <= broadcast_rows and est <= broadcast_bytes
    right = F.broadcast(cat) if small else cat
    return queries.crossJoin(right)


def best_match(queries: DataFrame, catalogue: DataFrame, *, threshold: float = DEFAULT_THRESHOLD,
               query_col: str = "query", key: str = "query_id", scorer: str = "weighted",
               processor: str | None = "none", adaptive: bool = True,
               broadcast_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """M7 + M8 + N4: for every query the best catalogue row, matched when
    its score reaches the (length-adaptive) threshold.

    Returns every query row with ``matched``, ``matched_name``, ``category``
    and ``score`` (NULL when unmatched). Because only the best row *above*
    the threshold matters, pairs that provably cannot reach it are not
    scored (the result is identical to scoring every pair).

    Each distinct query text is scored once (a partial + final aggregate
    collapses repeated names, hot names included, before any pair work);
    results go back to the query rows with an equi-join on the text, where
    AQE may broadcast the result or split skewed keys.
    """
    best = best_match_texts(queries.select(F.col(query_col).alias("_text")), catalogue,
                            threshold=threshold, scorer=scorer, processor=processor,
                            adaptive=adaptive, broadcast_rows=broadcast_rows)
    return join_best(queries, best, query_col, key).select(
        *queries.columns,
        F.coalesce(F.col("matched"), F.lit(False)).alias("matched"),
        "matched_name", "category", "score")


def join_best(rows: DataFrame, best: DataFrame, text: str, spread: str) -> DataFrame:
    """``rows`` with the best match of their ``text``. Rows without a text match
    nothing, and are spread by the column ``spread``, as they would otherwise
    meet in one task."""
    known = F.col(text).isNotNull()
    rows = rows.withColumn("_known", known).withColumn("_key", F.when(known, F.col(text)).otherwise(F.col(spread).cast("string")))
    found = best.withColumnRenamed("_text", "_key").withColumn("_known", F.lit(True))
    return rows.join(found, ["_known", "_key"], "left").drop("_known", "_key")


def best_match_texts(texts: DataFrame, catalogue: DataFrame, *, threshold: float = DEFAULT_THRESHOLD,
                     scorer: str = "weighted", processor: str | None = "none", adaptive: bool = True,
                     broadcast_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """Best match per distinct ``_text`` (see ``best_match``). Weighted
    matches from ``LEAST_THRESHOLD`` on come from the prefix-filtered join,
    which meets only texts that can reach the threshold; lower thresholds, which
    nearly any pair with a common token can reach, and other scorers compare all pairs."""
    if scorer == "weighted" and threshold >= LEAST_THRESHOLD:
        return _best_of_candidates(texts, catalogue, threshold, processor, adaptive, broadcast_rows)
    cat = match_side(catalogue, processor)
    # explicit repartition: AQE would coalesce the small post-distinct
    # shuffle into a single partition and run all pair work in one task
    parts = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    distinct = texts.filter(F.col("_text").isNotNull()).distinct().repartition(parts)
    req = required_threshold(F.col("_text"), threshold) if adaptive else F.lit(float(threshold))
    q = S.with_match_features(distinct.withColumn("_req", req), apply_processor(F.col("_text"), processor), "qf")
    pairs = _pairs(q, cat.select("idx", "full_name", "category", *S.feature_columns("cf")), broadcast_rows)
    qf, cf = S.Feat("qf"), S.Feat("cf")
    if scorer == "weighted":
        gate = S.weighted_may_reach(qf, cf, F.col("_req"))
    else:
        gate = F.lit(True)
    sc = F.when(gate, S.score(scorer, qf, cf))
    scored = pairs.select("_text", "_req", "idx", "full_name", "category", sc.alias("_score"))
    # only pairs at or above the threshold reach the aggregate (the gate is
    # evaluated once per pair; gate + score again only for the few hits)
    return _best_hit(scored.filter(F.col("_score") >= F.col("_req")))


def _best_hit(hits: DataFrame, least: str | None = None) -> DataFrame:
    """The best of (_text, idx, full_name, category, _score) per text, if it
    reaches the column ``least``."""
    best = (hits.groupBy("_text", *([least] if least else []))
            .agg(F.max_by(F.struct("full_name", "category", "_score"),
                          F.struct(F.col("_score"), -F.col("idx"))).alias("_b")))
    if least:
        best = best.filter(F.col("_b._score") >= F.col(least))
    return best.select(
        "_text",
        F.col("_b").isNotNull().alias("matched"),
        F.col("_b.full_name").alias("matched_name"),
        F.col("_b.category").alias("category"),
        F.round(F.col("_b._score"), 4).alias("score"),
    )


def match_candidates(texts: DataFrame, catalogue: DataFrame, *, threshold: float = DEFAULT_THRESHOLD,
                     processor: str | None = "none", adaptive: bool = True,
                     broadcast_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """The pairs that the prefix-filtered join looks at: every distinct text of
    ``_text`` with the catalogue rows that may reach its threshold, with the
    text features of both (prefixes qf, cf)."""
    cat = unique_catalogue(refuse_invalid(catalogue))
    parts = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    req = required_threshold(F.col("_text"), threshold) if adaptive else F.lit(float(threshold))
    # written once: what they come from (extraction, joins) is read for several joins
    # below. Nulls go after that: a filter before would be pushed into the extraction
    distinct = cut_lineage(texts.distinct()).filter(F.col("_text").isNotNull())
    # texts that share a hash meet each other's candidates, which are scored like any
    q = distinct.select(F.xxhash64("_text").alias("q"), "_text", req.alias("_req"), apply_processor(F.col("_text"), processor).alias("_qt"))
    c = cat.select("idx", "full_name", "category", apply_processor(F.col("full_name"), processor).alias("_ct"))
    pairs = candidate_pairs(q.select(F.col("q").alias("id"), F.col("_qt").alias("text"), F.col("_req").alias("req")),
                            c.select(F.col("idx").alias("id"), F.col("_ct").alias("text")), threshold, parts)
    q = S.with_text_features(q, "_qt", "qf").select("q", "_text", "_req", *S.text_feature_columns("qf"))
    c = S.with_text_features(c, "_ct", "cf").select("idx", "full_name", "category", *S.text_feature_columns("cf"))
    small = lambda texts, text: _text_side_is_small(texts, text, broadcast_rows)
    # Spark sees the size of files, not of the texts made from them: without the hint
    # it would broadcast a large side all the same
    q = q if small(distinct, "_text") else q.hint("merge")
    c = F.broadcast(c) if small(cat, "full_name") else c.hint("merge")
    return pairs.join(q, "q").join(c, F.col("c") == F.col("idx")).drop("q", "c")


def _text_side_is_small(texts: DataFrame, text: str, broadcast_rows: int) -> bool:
    row = texts.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.length(text)), F.lit(0)).alias("chars")).first()
    return row["n"] <= broadcast_rows and row["n"] * ROW_OVERHEAD + row["chars"] * TEXT_BYTES_PER_CHAR <= TEXT_BROADCAST_BYTES


def _best_of_candidates(texts: DataFrame, catalogue: DataFrame, threshold: float, processor: str | None,
                        adaptive: bool, broadcast_rows: int) -> DataFrame:
    pairs = match_candidates(texts, catalogue, threshold=threshold, processor=processor, adaptive=adaptive, broadcast_rows=broadcast_rows)
    qf, cf = S.Feat("qf"), S.Feat("cf")
    likely = pairs.filter(S.weighted_may_reach(qf, cf, F.col("_req")))
    scored = likely.select("_text", "_req", "idx", "full_name", "category", S.weighted_reaching(qf, cf, threshold).alias("_score"))
    # the threshold is tested on the best alone: a filter before the aggregate
    # would be pushed below the score and compute it twice
    return _best_hit(scored, "_req")


def score_pairs(pairs: DataFrame, a: str, b: str, scorers=None,
                processor: str | None = "none") -> DataFrame:
    """M1-M6 over a table of pairs: one rounded score column per scorer."""
    scorers = scorers or list(S.SCORERS)
    pairs = spread_for_compute(pairs)
    tmp = S.with_match_features(pairs, apply_processor(F.col(a), processor), "fa")
    tmp = S.with_match_features(tmp, apply_processor(F.col(b), processor), "fb")
    def score(n):
        # partial windows of all pairs of a batch in one sweep, linear in the longer text
        if n == "partial":
            return partial_score("fa_raw_s", "fb_raw_s")
        if n == "partial_token":
            best = F.greatest(partial_score("fa_srt_s", "fb_srt_s"), partial_score("fa_dst_s", "fb_dst_s"))
            return F.when(F.arrays_overlap("fa_toks", "fb_toks"), 100.0).otherwise(best)
        return S.score(n, S.Feat("fa"), S.Feat("fb"))

    return tmp.select(*pairs.columns, *[F.round(score(n), 4).alias(f"score_{n}") for n in scorers])


# --------------------------------------------------------------------------
# threshold study
# --------------------------------------------------------------------------

def study_scores(queries: DataFrame, catalogue: DataFrame, *, query_col: str = "query", key: str = "query_id",
                 carry: tuple[str, ...] = (), broadcast_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """M9: every (query, catalogue row, scorer) with its score on normalised
    text. No score is cut: a query without any good candidate still gets its
    best ones, however low. ``carry`` names query columns to keep."""
    cat = match_side(catalogue, "normalize")
    # explicit count: AQE would coalesce a small set of queries into one task
    spread = queries.repartition(int(queries.sparkSession.conf.get("spark.sql.shuffle.partitions")), key)
    q = S.with_match_features(spread, apply_processor(F.col(query_col), "normalize"), "qf")
    pairs = _pairs(q, cat.select("idx", "full_name", *S.feature_columns("cf")), broadcast_rows)
    scored = pairs.select(
        key, query_col, *carry, "idx", "full_name",
        F.array(*[F.struct(F.lit(n).alias("scorer"), S.score(n, S.Feat("qf"), S.Feat("cf")).alias("score"))
                  for n in STUDY_SCORERS]).alias("_s"))
    return scored.select(key, query_col, *carry, "idx", "full_name", F.inline("_s"))


def study_topk(queries: DataFrame, catalogue: DataFrame, *, top_matches: int | str = 5,
               query_col: str = "query", key: str = "query_id", literal_merge: bool = True,
               broadcast_rows: int = DEFAULT_BROADCAST_ROWS) -> tuple[DataFrame, DataFrame]:
    """Per scorer the top ``2 * top_matches`` catalogue rows,
    merged by max score per catalogue row, final top-K. ``top_matches`` is a
    number or the query column that holds each row's own. The search scores the
    pairs of the best upper bounds only (``operators.study``);
    ``literal_merge=False`` merges over the whole catalogue, which scores all.

    Returns ``(per_scorer, merged)``.
    """
    carry = (top_matches,) if isinstance(top_matches, str) else ()
    k = F.col(top_matches) if carry else F.lit(top_matches)
    if not literal_merge:
        long_ = study_scores(queries, catalogue, query_col=query_col, key=key, carry=carry, broadcast_rows=broadcast_rows)
        per_scorer = study.ranked(long_, key, 2 * k)
        merged_src = long_
    else:
        cat = cut_lineage(unique_catalogue(refuse_invalid(catalogue)).select("idx", "full_name"))
        asked = queries.select(key, query_col, *carry)
        hits = study.top_hits(asked, cat, STUDY_SCORERS, query_col=query_col, key=key, k=2 * k, processor="normalize")
        hits = cut_lineage(hits.drop("scored", "cell"))
        long_ = hits.join(asked, key).join(cat, "idx").select(key, query_col, *carry, "idx", "full_name", "scorer", "score")
        per_scorer = merged_src = study.ranked(long_, key, 2 * k)
    merged_src = merged_src.groupBy(key, query_col, *carry, "idx", "full_name").agg(F.max("score").alias("score"))
    w2 = Window.partitionBy(key).orderBy(F.col("score").desc(), F.col("idx"))
    merged = merged_src.withColumn("rank", F.row_number().over(w2)).filter(F.col("rank") <= k)
    return per_scorer.drop(*carry), merged.drop(*carry)


def study_requests(requests: DataFrame, catalogue: DataFrame, *, query_col: str = "query", key: str = "query_id") -> DataFrame:
    """M16 over a table of user queries (``key``, ``query_col``, top_matches,
    show_threshold): the displayed matches of each. A text that several rows
    ask for with the same ``top_matches`` is searched once; rows without a text
    have no matches."""
    asked = requests.where(F.col(query_col).isNotNull()).withColumn(
        "_study", F.concat(F.col("top_matches").cast("string"), F.lit(":"), F.col(query_col)))
    distinct = cut_lineage(asked.select("_study", F.col(query_col).alias("_text"), "top_matches").distinct())
    _, merged = study_topk(distinct, catalogue, top_matches="top_matches", query_col="_text", key="_study")
    shown = study_matches(asked.join(merged.drop("_text"), "_study"), "show_threshold")
    return shown.select(key, query_col, "top_matches", "show_threshold", "rank", "idx", "full_name", F.round("score", 4).alias("score"), "high_quality")


def study_pairs_scored(queries: DataFrame, catalogue: DataFrame, *, top_matches: int = 5, query_col: str = "query",
                       key: str = "query_id") -> DataFrame:
    """What the top-K search of ``study_topk`` looks at: per scorer the pairs
    that were scored and all pairs there are."""
    cat = unique_catalogue(refuse_invalid(catalogue)).select("idx", "full_name")
    hits = study.top_hits(queries.select(key, query_col), cat, STUDY_SCORERS, query_col=query_col, key=key,
                          k=F.lit(2 * top_matches), processor="normalize")
    scored = hits.groupBy(key, "scorer", "cell").agg(F.max("scored").alias("n")).groupBy("scorer").agg(F.sum("n").alias("pairs_scored"))
    every = queries.where(F.col(query_col).isNotNull()).agg(F.count(F.lit(1)).alias("q")).crossJoin(F.broadcast(cat.agg(F.count(F.lit(1)).alias("c"))))
    return scored.crossJoin(F.broadcast(every.select((F.col("q") * F.col("c")).alias("all_pairs"))))


def study_all(queries: DataFrame, catalogue: DataFrame, *, query_col: str = "query", key: str = "query_id") -> DataFrame:
    """M13 over the whole catalogue: every row's best score over the scorers,
    for ``threshold_sweep`` without the top-K cut."""
    return (study_scores(queries, catalogue, query_col=query_col, key=key)
            .groupBy(key, query_col, "idx", "full_name").agg(F.max("score").alias("score")))


def study_matches(merged: DataFrame, show_threshold: float | str = 70, key: str = "query_id") -> DataFrame:
    """Displayed rows (score >= show_threshold, a number or a column
    with each query's own) and the >= 90 flag."""
    shown = F.col(show_threshold) if isinstance(show_threshold, str) else F.lit(show_threshold)
    return (merged.filter(F.col("score") >= shown)
            .withColumn("high_quality", F.col("score") >= HIGH_QUALITY_SCORE))


def threshold_sweep(queries: DataFrame, merged: DataFrame, *, query_col: str = "query",
                    key: str = "query_id") -> DataFrame:
    """Per query and threshold, MATCH/NO MATCH from the best score
    and the number of rows of ``merged`` (the top-K, or ``study_all``) at or
    above the threshold.

    ``queries`` keeps queries without any candidate (NO MATCH, 0)."""
    per_q = merged.groupBy(key).agg(
        F.max("score").alias("best_score"),
        *[F.count_if(F.col("score") >= t).alias(f"_n{t}") for t in STUDY_THRESHOLDS])
    each = F.inline(F.array(*[F.struct(F.lit(t).alias("threshold"),
                                       F.coalesce(F.col("best_score") >= t, F.lit(False)).alias("would_match"),
                                       F.coalesce(F.col(f"_n{t}"), F.lit(0)).cast("long").alias("matching_products"))
                              for t in STUDY_THRESHOLDS]))
    return queries.select(key, query_col).join(per_q, key, "left").select(key, query_col, each)


def recommendation(queries: DataFrame, merged: DataFrame, *, query_col: str = "query", key: str = "query_id") -> DataFrame:
    """M14 + M15 + P11: recommended threshold band from the best score
    ("none" when there is no candidate at all, as with an empty catalogue),
    the short-name note (raw query length < 15) and the short-input warning."""
    best = merged.groupBy(key).agg(F.max("score").alias("best_score"))
    b = F.col("best_score")
    band = (F.when(b.isNull(), F.lit("none")).when(b >= 90, F.lit("high")).when(b >= 80, F.lit("good"))
            .when(b >= 70, F.lit("fair")).otherwise(F.lit("poor")))
    rec = F.when(b >= 90, F.lit(90)).when(b >= 80, F.lit(80)).when(b >= 70, F.lit(70))
    return (queries.select(key, query_col).join(best, key, "left")
            .select(key, query_col, F.round(b, 4).alias("best_score"),
                    band.alias("quality"), rec.alias("recommended_threshold"),
                    (F.length(col_(query_col)) < SHORT_NAME_LENGTH).alias("short_name_note"),
                    short_input_flag(col_(query_col)).alias("short_input_warning")))


def short_input_flag(q: Column) -> Column:
    """At most one whitespace token, or one of the suspicious terms."""
    from ..functions.text import word_count
    return (word_count(q) <= 1) | F.lower(q).isin(*SUSPICIOUS_TERMS)


def rematch_unmatched(state: DataFrame, catalogue: DataFrame, *, threshold: float = DEFAULT_THRESHOLD,
                      broadcast_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """Previously unmatched state rows with a name, matched again
    against a (newer) catalogue; returns the updated rows."""
    todo = state.filter(~F.coalesce(F.col("matched"), F.lit(False)) & F.col("full_name").isNotNull())
    res = best_match(todo.select(F.col("url").alias("query_id"), F.col("full_name").alias("query")),
                     catalogue, threshold=threshold, broadcast_rows=broadcast_rows)
    return res.select(F.col("query_id").alias("url"), F.col("query").alias("full_name"),
                      "matched", "matched_name", "category", "score")


def rematch_delta(stored: DataFrame, before: DataFrame, after: DataFrame, *, threshold: float = DEFAULT_THRESHOLD,
                  query_col: str = "query", key: str = "query_id", broadcast_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """M17 with catalogue versions: ``stored`` (the result of ``best_match``
    against ``before``) brought up to ``after``, as a whole match against that
    would give it.

    The catalogue rows that were added or changed in name, position or category
    are searched for every text; a stored match stands against what they offer
    by score, then position. Only texts whose matched row is gone or changed are
    searched in the whole catalogue. Scores are compared as stored, to 4 places.
    """
    row = ["full_name", "idx", "category"]
    old, new = (cut_lineage(unique_catalogue(refuse_invalid(c)).select(*row)) for c in (before, after))
    named = with_full_name(after)
    delta = named.join(new.join(old, row, "left_anti").select("full_name"), "full_name", "left_semi").drop("full_name")
    gone = old.join(new, row, "left_anti").select(F.col("full_name").alias("matched_name"), F.lit(True).alias("_gone"))
    stored = stored.join(gone, "matched_name", "left").withColumn("_gone", F.coalesce("_gone", F.lit(False)))
    texts = lambda df: df.select(F.col(query_col).alias("_text"))
    options = dict(threshold=threshold, broadcast_rows=broadcast_rows)
    found = (best_match_texts(texts(stored.filter(~F.col("_gone"))), delta, **options).withColumn("_whole", F.lit(False))
             .unionByName(best_match_texts(texts(stored.filter("_gone")), after, **options).withColumn("_whole", F.lit(True))))
    place = new.select(F.col("full_name").alias("matched_name"), "idx")
    found = cut_lineage(found.join(place, "matched_name").select(
        "_text", F.col("_whole").alias("_gone"), F.struct(F.col("score"), (-F.col("idx")).alias("at"), "matched_name", "category").alias("_found")))
    kept = stored.join(place, "matched_name", "left").withColumn("_kept", F.when(
        F.col("matched") & ~F.col("_gone"), F.struct(F.col("score"), (-F.col("idx")).alias("at"), "matched_name", "category")))
    # rows without a text are spread by their key, as in join_best
    known = F.col(query_col).isNotNull()
    kept = kept.withColumn("_known", known).withColumn("_key", F.when(known, F.col(query_col)).otherwise(F.col(key).cast("string")))
    out = kept.join(found.select(F.lit(True).alias("_known"), F.col("_text").alias("_key"), "_gone", "_found"), ["_known", "_key", "_gone"], "left")
    best = F.greatest("_kept", "_found")
    shown = [c for c in stored.columns if c not in ("matched", "matched_name", "category", "score", "_gone")]
    return out.withColumn("_best", best).select(
        *shown, F.col("_best").isNotNull().alias("matched"), F.col("_best.matched_name").alias("matched_name"),
        F.col("_best.category").alias("category"), F.col("_best.score").alias("score"))
