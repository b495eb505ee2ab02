"""String similarity scorers (M1-M6) as native Spark Column builders.

Score scale 0-100. Contract (see SURVEY §2.11):

* ``ratio(a, b) = 200 * LCS(a, b) / (|a| + |b|)``; both empty -> 100.
* ``token_sort`` = ratio of the sorted, space-joined tokens.
* ``token_set``  = indel comparison of intersection / differences of the
  token sets (100 when one token set contains the other).
* ``partial``    = best ratio of the shorter string against every window
  (prefixes, full-length windows, suffixes) of the longer one.
* ``partial_token`` = 100 on any common token, else ``partial`` of the
  sorted token strings (all tokens, and distinct tokens).
* ``weighted`` = length-ratio driven mix of the above.

The longest common subsequence is computed with the bit-parallel
algorithm (Allison & Dix 1986; Hyyro 2004): the shorter string provides a
``char -> bitmask`` map, the longer one is folded over with
``aggregate``. One 62-bit word covers strings up to 62 characters (BIGINT
addition never overflows under ANSI mode); longer strings use a multi-word
fold with an explicit carry, so no length is left to a Python fallback.

Scoring a pair only needs per-row "profiles" (characters + masks), which
are built once per row *before* any join, so the pairwise expression is
only the fold.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import col_, tokens

WORD = 62  # bits used per BIGINT word



def _long(v: int) -> Column:
    return F.lit(v).cast("long")


def let(value: Column, fn) -> Column:
    """Evaluate ``value`` once and pass it to ``fn`` as a lambda variable
    (expressions inside a fold are otherwise re-evaluated at every step)."""
    return F.transform(F.array(value), fn).getItem(0)


def _shl(x, bits) -> Column:
    # the Python wrapper only takes an int shift; the SQL function takes a column
    return F.call_function("shiftleft", x, bits if isinstance(bits, Column) else F.lit(bits))


def _shr(x, bits) -> Column:
    return F.call_function("shiftright", x, bits if isinstance(bits, Column) else F.lit(bits))


# --------------------------------------------------------------------------
# per-row profiles
# --------------------------------------------------------------------------

def char_array(s) -> Column:
    """Code points of ``s`` as an array of 1-character strings."""
    return F.regexp_extract_all(col_(s), F.lit("(?s)."), 0)


def bit_masks(chars) -> Column:
    """``map<char, array<bigint>>``: bit i of word k is set where
    ``chars[62k + i] == char``."""
    chars = col_(chars)
    n = F.size(chars)
    words = F.greatest(F.lit(1), F.ceil(n / F.lit(WORD)).cast("int"))
    uniq = F.array_distinct(chars)

    def word_mask(c, k):
        lo = k * WORD
        hi = F.least(n, lo + WORD) - 1
        return F.aggregate(
            F.sequence(lo, hi), _long(0),
            lambda acc, i: acc.bitwiseOR(
                F.when(chars[i] == c, _shl(_long(1), i - lo)).otherwise(_long(0))))

    return F.map_from_arrays(
        uniq,
        F.transform(uniq, lambda c: F.transform(F.sequence(F.lit(0), words - 1),
                                               lambda k: word_mask(c, k))))


def profile(s) -> Column:
    """struct(s, n, chars, masks) — everything a pairwise LCS needs."""
    s = col_(s)
    chars = char_array(s)
    return F.struct(
        s.alias("s"),
        F.length(s).alias("n"),
        chars.alias("chars"),
        bit_masks(chars).alias("masks"),
    )


def match_features(s) -> Column:
    """Per-row features for every scorer: raw profile, distinct tokens,
    sorted-token profile, sorted-distinct-token profile."""
    s = col_(s)
    toks = tokens(s)
    return F.struct(
        profile(s).alias("raw"),
        F.array_distinct(toks).alias("toks"),
        profile(F.array_join(F.sort_array(toks), " ")).alias("srt"),
        profile(F.array_join(F.sort_array(F.array_distinct(toks)), " ")).alias("dst"),
    )


class Feat:
    """Features stored as flat top-level columns ``{prefix}_{key}``.

    Struct-valued feature columns get inlined field by field by Catalyst's
    project collapsing, which would rebuild the masks inside every fold
    step; flat columns are computed once per row. ``Feat("f")["raw"]["n"]``
    is ``col("f_raw_n")``.
    """

    PROFILES = ("raw", "srt", "dst")

    def __init__(self, prefix: str):
        self.prefix = prefix

    def __getitem__(self, key: str):
        name = f"{self.prefix}_{key}"
        if key in self.PROFILES:
            return Feat(name)
        return F.col(name)


def with_text_features(df, text, prefix: str):
    """The features of ``text`` that the necessary conditions need: the three
    strings with their lengths, the distinct tokens and a token signature."""
    t = col_(text)
    toks = tokens(t)
    strings = {
        "raw": t,
        "srt": F.array_join(F.sort_array(toks), " "),
        "dst": F.array_join(F.sort_array(F.array_distinct(toks)), " "),
    }
    df = df.select("*", *[v.alias(f"{prefix}_{k}_s") for k, v in strings.items()],
                   F.array_distinct(toks).alias(f"{prefix}_toks"))
    # 64-bit token signature: a token set contained in another has no bit
    # outside the other's signature (a cheap necessary test for subsets)
    return df.select("*", F.aggregate(f"{prefix}_toks", _long(0),
                                      lambda acc, tk: acc.bitwiseOR(_shl(_long(1), F.pmod(F.hash(tk), F.lit(64)))))
                     .alias(f"{prefix}_sig"),
                     *[F.length(f"{prefix}_{k}_s").alias(f"{prefix}_{k}_n") for k in strings])


def with_match_features(df, text, prefix: str):
    """Add the flat feature columns of ``text`` under ``prefix``."""
    df = with_text_features(df, text, prefix)
    df = df.select("*", *[char_array(f"{prefix}_{k}_s").alias(f"{prefix}_{k}_chars") for k in Feat.PROFILES])
    return df.select("*", *[bit_masks(f"{prefix}_{k}_chars").alias(f"{prefix}_{k}_masks") for k in Feat.PROFILES])


def feature_columns(prefix: str, parts: tuple[str, ...] = ("s", "n", "chars", "masks")) -> list[str]:
    cols = [f"{prefix}_toks", f"{prefix}_sig"]
    for k in Feat.PROFILES:
        cols += [f"{prefix}_{k}_{x}" for x in parts]
    return cols


def text_feature_columns(prefix: str) -> list[str]:
    return feature_columns(prefix, ("s", "n"))


# --------------------------------------------------------------------------
# LCS
# --------------------------------------------------------------------------

def _lcs_one_word(masks, n, other) -> Column:
    full = _shl(_long(1), n) - 1

    def step(v, c):
        m = F.coalesce(F.try_element_at(masks, c).getItem(0), _long(0))
        return (v + v.bitwiseAND(m)).bitwiseOR(v.bitwiseAND(F.bitwise_not(m))).bitwiseAND(full)

    v = F.aggregate(other, full, step)
    return n - F.bit_count(v)


def _lcs_multi_word(masks, n, other) -> Column:
    words = F.ceil(n / F.lit(WORD)).cast("int")
    ks = F.sequence(F.lit(0), words - 1)

    def bits(k):
        return F.least(F.lit(WORD), n - k * WORD)

    empty = F.array().cast("array<bigint>")

    def run(fulls):
        zeros = F.transform(fulls, lambda x: _long(0))

        def step(v, c):
            m = F.coalesce(F.try_element_at(masks, c), zeros)

            def word(st, k):
                x = v[k]
                mk = m[k]
                total = x + x.bitwiseAND(mk) + st["carry"]
                new = total.bitwiseAND(fulls[k]).bitwiseOR(x.bitwiseAND(F.bitwise_not(mk)))
                return F.struct(F.array_append(st["v"], new).alias("v"),
                                _shr(total, bits(k)).alias("carry"))

            return F.aggregate(ks, F.struct(empty.alias("v"), _long(0).alias("carry")), word,
                               lambda st: st["v"])

        v = F.aggregate(other, fulls, step)
        return n - F.aggregate(v, _long(0), lambda acc, x: acc + F.bit_count(x))

    return let(F.transform(ks, lambda k: _shl(_long(1), bits(k)) - 1), run)


def lcs_length(chars_a, masks_a, chars_b) -> Column:
    """LCS length of a (which provides the masks) and b."""
    n = F.size(chars_a)
    return (F.when((n == 0) | (F.size(chars_b) == 0), F.lit(0))
            .when(n <= WORD, _lcs_one_word(masks_a, n, chars_b))
            .otherwise(_lcs_multi_word(masks_a, n, chars_b)))


def lcs_profiles(pa, pb) -> Column:
    """LCS of two profiles; the shorter one provides the masks."""
    return F.when(pa["n"] <= pb["n"], lcs_length(pa["chars"], pa["masks"], pb["chars"])) \
            .otherwise(lcs_length(pb["chars"], pb["masks"], pa["chars"]))


def lcs_strings(a, b) -> Column:
    """LCS of two strings that have no profile; the shorter one's masks are
    built once and folded over."""
    def of(short, long_):
        return let(char_array(short), lambda cs: let(bit_masks(cs), lambda ms: lcs_length(cs, ms, char_array(long_))))
    # one fold for either order: the strings are swapped, not the expression
    swap = F.length(a) > F.length(b)
    return let(F.struct(F.when(swap, b).otherwise(a).alias("x"), F.when(swap, a).otherwise(b).alias("y")),
               lambda p: of(p["x"], p["y"]))


def _norm(d, total) -> Column:
    """100 - 100*d/total, 100 when total == 0."""
    return F.when(total == 0, F.lit(100.0)).otherwise(100.0 - 100.0 * d / total)


def _ratio_from_lcs(lcs, la, lb) -> Column:
    total = la + lb
    return F.when(total == 0, F.lit(100.0)).otherwise(200.0 * lcs / total)


# --------------------------------------------------------------------------
# scorers over profiles / features
# --------------------------------------------------------------------------

def ratio_p(pa, pb) -> Column:
    return _ratio_from_lcs(lcs_profiles(pa, pb), pa["n"], pb["n"])


def _partial_directed(px, py) -> Column:
    """max ratio(x, window of y) with |x| <= |y|; window offsets j run from
    1-|x| (prefix of length 1) to |y|-1 (suffix of length 1)."""
    lx, ly = px["n"], py["n"]

    def window_score(j):
        start = F.greatest(j, F.lit(0))
        length = F.least(ly, j + lx) - start
        lcs = lcs_length(px["chars"], px["masks"], F.slice(py["chars"], start + 1, length))
        return 200.0 * lcs / (lx + length)

    return (F.when(lx == 0, F.when(ly == 0, F.lit(100.0)).otherwise(F.lit(0.0)))
            .otherwise(F.array_max(F.transform(F.sequence(1 - lx, ly - 1), window_score))))


def partial_p(pa, pb) -> Column:
    la, lb = pa["n"], pb["n"]
    return (F.when(la < lb, _partial_directed(pa, pb))
            .when(la > lb, _partial_directed(pb, pa))
            .otherwise(F.greatest(_partial_directed(pa, pb), _partial_directed(pb, pa))))


def token_sort_f(fa, fb) -> Column:
    return ratio_p(fa["srt"], fb["srt"])


def token_set_f(fa, fb) -> Column:
    ta, tb = fa["toks"], fb["toks"]
    inter = F.sort_array(F.array_intersect(ta, tb))
    diff_a = F.sort_array(F.array_except(ta, tb))
    diff_b = F.sort_array(F.array_except(tb, ta))
    sa, sb = F.array_join(diff_a, " "), F.array_join(diff_b, " ")
    la, lb = F.length(sa), F.length(sb)
    s = F.length(F.array_join(inter, " "))
    e = F.when(s > 0, F.lit(1)).otherwise(F.lit(0))
    def lcs_of(short, long_):
        # masks of the per-pair string built once, then folded over
        return let(char_array(short), lambda cs: let(bit_masks(cs), lambda ms: lcs_length(cs, ms, char_array(long_))))
    lcs = F.when(la <= lb, lcs_of(sa, sb)).otherwise(lcs_of(sb, sa))
    dist = la + lb - 2 * lcs
    r1 = _norm(dist, (s + e + la) + (s + e + lb))
    mixed = F.greatest(r1, _norm(e + la, s + (s + e + la)), _norm(e + lb, s + (s + e + lb)))
    return (F.when((F.size(ta) == 0) | (F.size(tb) == 0), F.lit(0.0))
            .when((F.size(inter) > 0) & ((F.size(diff_a) == 0) | (F.size(diff_b) == 0)), F.lit(100.0))
            # no common token: the differences are the distinct token strings,
            # whose profiles were built per row
            .when(F.size(inter) == 0, ratio_p(fa["dst"], fb["dst"]))
            .otherwise(mixed))


def partial_token_f(fa, fb) -> Column:
    p_all = partial_p(fa["srt"], fb["srt"])
    same = (fa["srt"]["n"] == fa["dst"]["n"]) & (fb["srt"]["n"] == fb["dst"]["n"])
    return (F.when(F.arrays_overlap(fa["toks"], fb["toks"]), F.lit(100.0))
            .when(same, p_all)
            .otherwise(F.greatest(p_all, partial_p(fa["dst"], fb["dst"]))))


def length_ratio(la, lb) -> Column:
    return F.greatest(la, lb) / F.least(la, lb)


def weighted_f(fa, fb) -> Column:
    la, lb = fa["raw"]["n"], fb["raw"]["n"]
    q = length_ratio(la, lb)
    r = ratio_p(fa["raw"], fb["raw"])
    scale = F.when(q <= 8, F.lit(0.9)).otherwise(F.lit(0.6))
    short = F.greatest(r, 0.95 * F.greatest(token_sort_f(fa, fb), token_set_f(fa, fb)))
    long_ = F.greatest(r, scale * partial_p(fa["raw"], fb["raw"]),
                       0.95 * scale * partial_token_f(fa, fb))
    return (F.when((la == 0) | (lb == 0), F.lit(0.0))
            .when(q < 1.5, short)
            .otherwise(long_))


SCORERS = {
    "ratio": lambda fa, fb: ratio_p(fa["raw"], fb["raw"]),
    "token_sort": token_sort_f,
    "token_set": token_set_f,
    "partial": lambda fa, fb: partial_p(fa["raw"], fb["raw"]),
    "partial_token": partial_token_f,
    "weighted": weighted_f,
}


def score(scorer: str, fa, fb) -> Column:
    """Score two ``match_features`` columns with a named scorer."""
    fa = fa if isinstance(fa, Feat) else col_(fa)
    fb = fb if isinstance(fb, Feat) else col_(fb)
    try:
        return SCORERS[scorer](fa, fb)
    except KeyError:
        raise ValueError(f"unknown scorer {scorer!r}; one of {sorted(SCORERS)}") from None


# Column-level conveniences on raw strings (features built inline).

def ratio(a, b) -> Column:
    return score("ratio", match_features(a), match_features(b))


def token_sort_ratio(a, b) -> Column:
    return score("token_sort", match_features(a), match_features(b))


def token_set_ratio(a, b) -> Column:
    return score("token_set", match_features(a), match_features(b))


def partial_ratio(a, b) -> Column:
    return score("partial", match_features(a), match_features(b))


def partial_token_ratio(a, b) -> Column:
    return score("partial_token", match_features(a), match_features(b))


def weighted_ratio(a, b) -> Column:
    return score("weighted", match_features(a), match_features(b))


# --------------------------------------------------------------------------
# cheap necessary conditions (built-in, code-generated) for pruning
# --------------------------------------------------------------------------

def _lev_within(a, b, bound) -> Column:
    """levenshtein(a, b) <= bound (thresholded, so the DP stops early).
    Levenshtein never exceeds the indel distance, so ``indel <= bound``
    implies this condition."""
    return (bound >= 0) & (F.call_function("levenshtein", a, b, bound.cast("int")) >= 0)


def ratio_may_reach(pa, pb, t) -> Column:
    """Necessary for ratio(a, b) >= t: indel = S - 2L <= (1 - t/100) S.
    The length band (ratio <= 200 * min / S) is tested first."""
    t = t if isinstance(t, Column) else F.lit(float(t))
    total = pa["n"] + pb["n"]
    bound = F.floor(total * (1.0 - t / 100.0) + 1e-9)
    band = 200.0 * F.least(pa["n"], pb["n"]) >= t * total - 1e-9
    return band & _lev_within(pa["s"], pb["s"], bound)


def weighted_may_reach(fa, fb, t, inter: Column | None = None) -> Column:
    """A condition implied by ``weighted(a, b) >= t`` (t may be a column).

    * q < 1.5: ratio >= t, or token_sort / token_set >= t / 0.95 (the
      latter needs a common token or close distinct-token strings);
    * 1.5 <= q <= 8: ratio <= 80, partial_token part <= 85.5, so for
      t >= 90 only partial = 100, i.e. the shorter string is a substring;
      below 90 every such pair is kept;
    * q > 8: the score is at most 60.
    """
    t = t if isinstance(t, Column) else F.lit(float(t))
    la, lb = fa["raw"]["n"], fb["raw"]["n"]
    q = length_ratio(la, lb)
    tt = t / 0.95
    short_ok = (ratio_may_reach(fa["raw"], fb["raw"], t)
                | ratio_may_reach(fa["srt"], fb["srt"], tt)
                | token_set_may_reach(fa, fb, tt, inter))
    longer = F.when(la >= lb, fa["raw"]["s"]).otherwise(fb["raw"]["s"])
    shorter = F.when(la >= lb, fb["raw"]["s"]).otherwise(fa["raw"]["s"])
    mid_ok = F.when(t >= 90, F.contains(longer, shorter)).otherwise(F.lit(True))
    return (F.when((la == 0) | (lb == 0), t <= 0)
            .when(q < 1.5, short_ok)
            .when(q <= 8, mid_ok)
            .otherwise(t <= 60))

def token_set_may_reach(fa, fb, t, inter: Column | None = None) -> Column:
    """Necessary for token_set(a, b) >= t, from built-ins only.

    No common token: token_set is the ratio of the distinct-token strings
    (length band + thresholded levenshtein). Common tokens: with the token
    differences A, B (each computed once) and the distinct-token string
    lengths n_a, n_b of the rows, the joined intersection has length
    s = n_a - |A| - 1 and the difference ratio's total is n_a + n_b, so the
    subset case (100), the two closed-form intersection ratios and the
    difference-ratio bound (band + levenshtein of the joined differences)
    need no intersection array. A length band on n_a, n_b or a possible
    subset (64-bit token signatures) is tested first from row data only.
    ``inter`` is accepted for compatibility and unused.
    """
    t = t if isinstance(t, Column) else F.lit(float(t))
    ta, tb = fa["toks"], fb["toks"]
    na, nb = F.size(ta), F.size(tb)
    n_a, n_b = fa["dst"]["n"], fb["dst"]["n"]
    total = n_a + n_b
    bound = F.floor(total * (1.0 - t / 100.0) + 1e-9)

    def shared(da, db):
        subset = (F.size(da) == 0) | (F.size(db) == 0)

        def with_strings(sa, sb):
            la, lb = F.length(sa), F.length(sb)
            s = n_a - la - 1
            r2_ok = (s > 0) & (_norm(1 + la, s + (s + 1 + la)) >= t - 1e-9)
            r3_ok = (s > 0) & (_norm(1 + lb, s + (s + 1 + lb)) >= t - 1e-9)
            r1_ok = (F.abs(la - lb) <= bound) & _lev_within(sa, sb, bound)
            return r2_ok | r3_ok | r1_ok

        return subset | let(F.array_join(F.sort_array(da), " "), lambda sa: let(
            F.array_join(F.sort_array(db), " "), lambda sb: with_strings(sa, sb)))

    band = 200.0 * F.least(n_a, n_b) >= t * total - 1e-9
    sa_sig, sb_sig = fa["sig"], fb["sig"]
    may_subset = ((sa_sig.bitwiseAND(F.bitwise_not(sb_sig)) == 0)
                  | (sb_sig.bitwiseAND(F.bitwise_not(sa_sig)) == 0))
    overlap_ok = let(F.array_except(ta, tb), lambda da: let(F.array_except(tb, ta), lambda db: shared(da, db)))
    return ((na > 0) & (nb > 0) & (band | may_subset)) & F.when(F.arrays_overlap(ta, tb), overlap_ok) \
        .otherwise(ratio_may_reach(fa["dst"], fb["dst"], t))


def weighted_reaching(fa, fb, least: float) -> Column:
    """weighted(a, b) where it reaches ``least``, which is 86 or more, and any
    value below elsewhere. From the features of ``with_text_features``.

    From 86 on partial_token (0.855 * 100 at most) and length ratios beyond 8
    play no part, and from 90 on partial counts only as 100, for a substring.
    """
    la, lb = fa["raw"]["n"], fb["raw"]["n"]

    def ratio_s(pa, pb):
        return _ratio_from_lcs(lcs_strings(pa["s"], pb["s"]), pa["n"], pb["n"])

    def token_set_s():
        ta, tb = fa["toks"], fb["toks"]
        inter = F.array_intersect(ta, tb)
        sets = F.struct(F.array_join(F.sort_array(F.array_except(ta, tb)), " ").alias("x"),
                        F.array_join(F.sort_array(F.array_except(tb, ta)), " ").alias("y"),
                        F.length(F.array_join(inter, " ")).alias("s"))

        def of(p):
            lx, ly, n = F.length(p["x"]), F.length(p["y"]), p["s"]
            e = F.when(n > 0, F.lit(1)).otherwise(F.lit(0))
            dist = lx + ly - 2 * lcs_strings(p["x"], p["y"])
            r1 = _norm(dist, (n + e + lx) + (n + e + ly))
            mixed = F.greatest(r1, _norm(e + lx, n + (n + e + lx)), _norm(e + ly, n + (n + e + ly)))
            return F.when(n == 0, r1).when((lx == 0) | (ly == 0), F.lit(100.0)).otherwise(mixed)

        return F.when((F.size(ta) == 0) | (F.size(tb) == 0), F.lit(0.0)).otherwise(let(sets, of))

    none = F.lit(0.0)
    short = F.greatest(ratio_s(fa["raw"], fb["raw"]), 0.95 * F.greatest(ratio_s(fa["srt"], fb["srt"]), token_set_s()))
    q = length_ratio(la, lb)
    longer = F.when(la >= lb, fa["raw"]["s"]).otherwise(fb["raw"]["s"])
    shorter = F.when(la >= lb, fb["raw"]["s"]).otherwise(fa["raw"]["s"])
    inside = F.when(F.contains(longer, shorter), F.lit(100.0))
    if least < 90:
        inside = inside.otherwise(let(shorter, lambda x: let(longer, lambda y: let(char_array(x), lambda cx: let(
            bit_masks(cx), lambda mx: _partial_directed({"n": F.size(cx), "chars": cx, "masks": mx}, {"n": F.length(y), "chars": char_array(y)}))))))
    return (F.when((la == 0) | (lb == 0), none).when(q < 1.5, short)
            .when(q <= 8, 0.9 * F.coalesce(inside, none)).otherwise(none))
