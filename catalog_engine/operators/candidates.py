"""Candidate pairs of the match join without scoring all pairs.

A prefix-filtered similarity join that loses nothing for weighted scores of
``LEAST_THRESHOLD`` and above. A pair can reach such a score t in these ways
only, and each way is an equi-join on features of the texts (d = 1 - t/100):

* ``g``: ratio, token_sort, or token_set with close differences. At most
  ``e`` of a text's distinct grams (of its tokens, padded in front) are missing
  in its partner: with i deletions and j insertions of at most D = d (n + m)
  together, i - j = n - m, at most gram * i + (gram - 1) * j go, and that is
  largest at the shortest partner: e = gram * n * 2d / (1 + d). In one order
  of all grams the least common gram is thus among the first e + 1 of both.
* ``w``: token_set with one token set (nearly) inside the other. All tokens
  of one side but ``b`` joined characters are common, so one of its first
  tokens, up to those that exceed b characters, is any token of the other.
* ``s``: one text is at least 1.5 and at most 8 times as long, and partial
  reaches t / 0.9, which demands a substring at t = 90 and close to one below.
  The grams of the shorter text (not padded) but e' are grams of the longer.
* ``l``: texts with too few grams for these rules meet all texts of a length
  that fits. There are few of them: repeated characters, hardly any letters.

Grams are ordered by ascending document frequency in the catalogue, so the
prefixes hold the rarest. What a join brings together must then fit in length and
in the bounds above for the two lengths at hand, which bitmaps of the gram sets
and of the characters test (bits of one that the other lacks stand for at least
one missing element each; of the characters only the i deleted ones are missing).
Beyond a length ratio of 8, and for partial_token (at most 85.5), no score
reaches the least threshold.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import tokens

LEAST_THRESHOLD = 86
GRAM = 3
#: 64-bit words of a gram set's bitmap.
WORDS = 4
#: Fixed values of the weighted scorer.
TOKEN_SCALE, PARTIAL_SCALE = 0.95, 0.9
CLOSE_RATIO, FAR_RATIO = 1.5, 8.0

# slack for bounds computed in doubles; a wider prefix only adds candidates
_SLACK = 1e-6

# codes of the ways; Q and C tell which side has the prefix, or is the shorter
GRAMS, LENGTH_Q, LENGTH_C, TOKENS_Q, TOKENS_C, PART_Q, PART_C = range(7)


def _token_grams(toks: Column) -> Column:
    pad = F.lit(" " * (GRAM - 1))
    of_token = lambda t: F.transform(F.sequence(F.lit(1), F.length(t)), lambda i: F.substring(F.concat(pad, t), i, GRAM))
    return F.array_distinct(F.flatten(F.transform(toks, of_token)))


def _substrings(text: Column, n: Column, length: int) -> Column:
    every = F.transform(F.sequence(F.lit(1), n - length + 1), lambda i: F.substring(text, i, length))
    return F.when(n >= length, F.array_distinct(every)).otherwise(F.array().cast("array<string>"))


def _numbered_chars(text: Column) -> Column:
    """Hashes of (character, k) for the k-th occurrence of each character."""
    chars = F.split(text, "")
    of = lambda every: F.flatten(F.transform(F.array_distinct(every), lambda c: F.transform(
        F.sequence(F.lit(1), F.size(F.filter(every, lambda x: x == c))), lambda k: F.xxhash64(c, k))))
    return F.transform(F.array(chars), of)[0]


def _features(side: DataFrame, partial: bool) -> DataFrame:
    """(id, req, n, n_tokens, k, f, len) and the bitmap of the numbered
    characters: a row per feature, kinds g, w, s and x (pieces shorter than a
    gram, for partners that are no longer)."""
    toks = tokens(F.col("text"))
    row = side.select("id", "req", "text", F.length("text").alias("n"), F.array_distinct(toks).alias("toks"))
    of_kind = lambda kind, c: F.transform(c, lambda f: F.struct(F.lit(kind).alias("k"), f.alias("f")))
    kinds = [of_kind("g", _token_grams(F.col("toks"))), of_kind("w", F.col("toks"))]
    if partial:
        text, n = F.col("text"), F.col("n")
        kinds.append(of_kind("s", F.when(n < GRAM, F.array("text")).otherwise(_substrings(text, n, GRAM))))
        pieces = F.concat(*[_substrings(text, n, length) for length in range(1, GRAM)])
        short = n <= int(FAR_RATIO) * (GRAM - 1)
        kinds.append(of_kind("x", F.when(short, pieces).otherwise(F.array().cast("array<string>"))))
    maps = [c.alias(f"c{w}") for w, c in enumerate(_bitmap(F.col("chars")))]
    row = row.select("*", _numbered_chars(F.col("text")).alias("chars")).select("*", *maps)
    about = ["id", "req", "n", *[f"c{w}" for w in range(WORDS)]]
    n_tokens = F.length(F.array_join("toks", " ")).alias("n_tokens")
    return row.select(*about, n_tokens, F.explode_outer(F.concat(*kinds)).alias("o")).select(*about, "n_tokens", "o.k", "o.f", F.length("o.f").alias("len"))


def _missing_grams(n: Column, req: Column) -> Column:
    d = 1 - req / 100
    return F.floor(n * GRAM * 2 * d / (1 + d) + _SLACK)


def _missing_chars(n: Column, req: Column) -> Column:
    """Joined characters of a token set that the other may lack; -1 if
    token_set cannot reach the threshold at all."""
    d = F.greatest(F.lit(0.0), 1 - req / TOKEN_SCALE / 100)
    most = F.floor((2 * d * (n - 1) - (1 - d)) / (1 + d) + _SLACK)
    return F.when(req > 100 * TOKEN_SCALE + _SLACK, -1).otherwise(F.greatest(F.lit(0), most))


def _missing_parts(n: Column, req: Column) -> Column:
    """-1 if partial cannot reach the threshold."""
    d = F.greatest(F.lit(0.0), 1 - req / PARTIAL_SCALE / 100)
    return F.when(req > 100 * PARTIAL_SCALE + _SLACK, -1).otherwise(GRAM * F.floor(d * 2 * n + _SLACK))


def _bitmap(hashes: Column) -> list[Column]:
    """Words of the set's bitmap."""
    zero, one = F.lit(0).cast("bigint"), F.lit(1).cast("bigint")

    def word(w: int) -> Column:
        own = F.filter(hashes, lambda h: F.pmod(F.shiftright(h, 8), F.lit(WORDS)) == w)
        return F.aggregate(own, zero, lambda acc, h: acc.bitwiseOR(F.call_function("shiftleft", one, F.pmod(h, F.lit(64)).cast("int"))))

    return [word(w) for w in range(WORDS)]


ABOUT = ["id", "n", "n_tokens", "d", "b", "p", "plain", *[f"{k}{w}" for k in "cg" for w in range(WORDS)]]


def _postings(features: DataFrame, frequency: DataFrame, partial: bool, queries: bool) -> DataFrame:
    """(way, h, *ABOUT) of one side."""
    known = features.join(frequency, ["k", "f"], "left")
    order = F.struct("k", F.coalesce("df", F.lit(0)).alias("df"), F.xxhash64("f").alias("h"), "len")
    own = ["id", "n", "n_tokens", "req", *[f"c{w}" for w in range(WORDS)]]
    rows = known.groupBy(*own).agg(F.sort_array(F.collect_list(F.when(F.col("k").isNotNull(), order))).alias("o"))
    of_kind = lambda kind: F.filter("o", lambda x: x["k"] == kind)
    hashes = lambda c: F.transform(c, lambda x: x["h"])
    rows = rows.select(
        *own, of_kind("w").alias("w"), *[hashes(of_kind(k)).alias(k) for k in "gsx"],
        _missing_grams(F.col("n"), F.col("req")).cast("int").alias("e"), _missing_chars(F.col("n_tokens"), F.col("req")).cast("int").alias("b"),
        _missing_parts(F.col("n"), F.col("req")).cast("int").alias("p"),
    )
    before = lambda i: F.aggregate(F.slice(F.col("w"), 1, i), F.lit(0), lambda acc, x: acc + x["len"]) + i - 1
    none = F.array().cast("array<bigint>")
    first_tokens = F.when(F.col("b") >= 0, hashes(F.filter(F.col("w"), lambda _, i: (i == 0) | (before(i) <= F.col("b"))))).otherwise(none)
    own, other = (TOKENS_Q, TOKENS_C) if queries else (TOKENS_C, TOKENS_Q)
    ways = [(GRAMS, F.slice("g", F.lit(1), F.col("e") + 1)), (own, first_tokens), (other, hashes("w"))]
    near = F.sequence(F.ceil(F.col("n") / CLOSE_RATIO).cast("bigint"), F.floor(F.col("n") * CLOSE_RATIO).cast("bigint"))
    longer = F.sequence(F.col("n").cast("bigint"), F.floor(F.col("n") * FAR_RATIO).cast("bigint"))
    own_length = F.array(F.col("n").cast("bigint"))
    if partial:
        own, other = (PART_Q, PART_C) if queries else (PART_C, PART_Q)
        weak = F.size("s") <= F.col("p")
        first_parts = F.when(weak, longer).otherwise(F.slice("s", F.lit(1), F.greatest(F.col("p"), F.lit(0)) + 1))
        # lengths never equal hashes but by chance, which only adds candidates
        ways += [(own, F.when(F.col("p") >= 0, first_parts).otherwise(none)), (other, F.concat("s", "x", own_length))]
    own, other = (LENGTH_Q, LENGTH_C) if queries else (LENGTH_C, LENGTH_Q)
    ways += [(own, F.when(F.size("g") <= F.col("e"), near).otherwise(none)), (other, own_length)]
    of_way = lambda way, h: F.transform(h, lambda x: F.struct(F.lit(way).alias("way"), x.alias("h")))
    emitted = F.concat(*[of_way(way, h) for way, h in ways])
    maps = [c.alias(f"g{w}") for w, c in enumerate(_bitmap(F.col("g")))]
    plain = (F.col("n") == F.col("n_tokens")).alias("plain")
    rows = rows.select(*[c for c in ABOUT if c in rows.columns], (1 - F.col("req") / 100).alias("d"), plain, *maps, emitted.alias("m"))
    # without nulls, of which the compiled join condition would test every column
    sure = [F.coalesce(F.col(c), F.lit(False) if c == "plain" else F.lit(0).cast(t)).alias(c) for c, t in rows.dtypes if c in ABOUT]
    return rows.select(*sure, F.explode("m").alias("at")).select("at.way", "at.h", *ABOUT)


def _fits() -> Column:
    """Whether a pair that met on a feature passes the bounds of its way. Each
    bitmap is looked at once, against a bound that depends on the way: the
    compiled condition must stay small enough for the JVM to optimise it."""
    nq, nc, way = F.col("q_n"), F.col("c_n"), F.col("way")
    close = (nq * 2 < nc * 3) & (nc * 2 < nq * 3)
    alike, any_number = way <= LENGTH_C, F.lit(1e9)
    # texts without repeated tokens or spaces are made of the same characters
    # however their tokens are arranged
    plain = F.col("q_plain") & F.col("c_plain")
    edits = F.col("q_d") * (nq + nc)

    def lacking(kind: str, x: str, y: str) -> Column:
        counts = [F.bit_count(F.col(f"{x}_{kind}{w}").bitwiseAND(F.bitwise_not(F.col(f"{y}_{kind}{w}")))) for w in range(WORDS)]
        return sum(counts[1:], counts[0])

    def few(x: str, y: str, tokens_way: int, part_way: int) -> Column:
        # no string of a text that is compared is longer than n or shorter than n_tokens
        deleted = (edits + (F.col(f"{x}_n") - F.col(f"{y}_n_tokens"))) * 0.5 + _SLACK
        grams = F.when(alike, (GRAM - 1) * edits + deleted).when(way == tokens_way, F.col(f"{x}_b")).otherwise(any_number)
        chars = F.when(alike & plain, deleted).when(way == part_way, F.col(f"{x}_p") * (1 / GRAM) + _SLACK).otherwise(any_number)
        return (lacking("g", x, y) <= grams) & (lacking("c", x, y) <= chars)

    lengths = F.when(way < PART_Q, close).otherwise(~close & (F.when(way == PART_Q, nc - nq).otherwise(nq - nc) > 0) & (nq <= nc * int(FAR_RATIO)) & (nc <= nq * int(FAR_RATIO)))
    return lengths & few("q", "c", TOKENS_Q, PART_Q) & few("c", "q", TOKENS_C, PART_C)


def candidate_pairs(queries: DataFrame, catalogue: DataFrame, threshold: float, partitions: int) -> DataFrame:
    """Distinct pairs (q, c) that hold every pair whose weighted score reaches
    its query's threshold. ``queries``: (id, text, req), req being at least
    ``threshold``; ``catalogue``: (id, text). Texts must not be null; an empty
    text reaches no threshold. Equal ids of different texts only add pairs. The
    pairs are partitioned by q.
    """
    if threshold < LEAST_THRESHOLD:
        raise ValueError(f"candidates are complete from a threshold of {LEAST_THRESHOLD} on, not {threshold}")
    partial = threshold <= 100 * PARTIAL_SCALE
    known = lambda df: df.where(F.col("text") != "")
    of_queries = _features(known(queries), partial)
    of_catalogue = _features(known(catalogue.withColumn("req", F.lit(float(threshold)))), partial)
    frequency = of_catalogue.where("k is not null").groupBy("k", "f").agg(F.count(F.lit(1)).alias("df"))
    side = lambda df, name: df.select("way", "h", *[F.col(c).alias(f"{name}_{c}") for c in ABOUT])
    q = side(_postings(of_queries, frequency, partial, True), "q")
    c = side(_postings(of_catalogue, frequency, partial, False), "c")
    # an explicit number: postings are few bytes for many pairs, so that AQE
    # would put them all into one task
    q, c = (df.repartition(partitions, "way", "h") for df in (q, c))
    pairs = q.join(c, ["way", "h"]).where(_fits()).select(F.col("q_id").alias("q"), F.col("c_id").alias("c"))
    return pairs.repartition(partitions, "q").distinct()
