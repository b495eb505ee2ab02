"""DuckDB SQL text for the correctness oracle.

Independent re-statement of the contract in SQL: the LCS is a bit-parallel
``list_reduce`` over HUGEINT masks (strings up to 125 code points), all
arithmetic in DOUBLE in the same operation order as the Spark side, scores
rounded to 4 places. Helpers return SQL expressions over column names.

The pruning condition (``weighted_may_reach``) repeats the bound that the Spark
side uses, to keep the oracle quick; it is no independent check of that bound.
The tests run the best match against the SQL without it (``pruned=False``).
"""

from __future__ import annotations

import itertools

_ids = itertools.count()

WS = r"[\t\n\x0B\f\r\x{85}\p{Z}]"


def _v(prefix: str) -> str:
    return f"{prefix}{next(_ids)}"


def chars(s: str) -> str:
    return f"regexp_extract_all({s}, '(?s).')"


def tokens(s: str) -> str:
    t = _v("tk")
    return f"list_filter(regexp_split_to_array({s}, '{WS}+'), lambda {t}: {t} <> '')"


def ustrip(s: str) -> str:
    return f"regexp_replace({s}, '^{WS}+|{WS}+$', '', 'g')"


def normalize(s: str) -> str:
    x = f"lower({s})"
    x = f"replace({x}, '&', ' and ')"
    x = f"replace(replace({x}, '-', ' '), '/', ' ')"
    x = f"replace(replace({x}, '®', ''), '™', '')"
    x = f"regexp_replace({x}, '{WS}+', ' ', 'g')"
    return ustrip(x)


def lcs(x: str, y: str) -> str:
    """LCS length; x provides the masks."""
    c, i, v, m = _v("c"), _v("i"), _v("v"), _v("m")
    full = f"((1::HUGEINT << length({x})) - 1)"
    mask = (f"coalesce(list_sum(list_transform(range(length({x})), lambda {i}: "
            f"CASE WHEN substr({x}, {i} + 1, 1) = {c} THEN (1::HUGEINT << {i}) ELSE 0::HUGEINT END)), 0::HUGEINT)")
    fold = (f"list_reduce(list_transform({chars(y)}, lambda {c}: {mask}), "
            f"lambda {v}, {m}: (({v} + ({v} & {m})) | ({v} & ~{m})) & {full}, {full})")
    return (f"(CASE WHEN length({x}) = 0 OR length({y}) = 0 THEN 0 "
            f"ELSE length({x}) - bit_count({fold}) END)")


def ratio(a: str, b: str) -> str:
    tot = f"(length({a}) + length({b}))"
    l_ = f"(CASE WHEN length({a}) <= length({b}) THEN {lcs(a, b)} ELSE {lcs(b, a)} END)"
    return f"(CASE WHEN {tot} = 0 THEN 100.0::DOUBLE ELSE 200.0::DOUBLE * {l_} / {tot} END)"


def _norm(d: str, total: str) -> str:
    return f"(CASE WHEN ({total}) = 0 THEN 100.0::DOUBLE ELSE 100.0::DOUBLE - 100.0::DOUBLE * ({d}) / ({total}) END)"


def _partial_directed(x: str, y: str) -> str:
    j = _v("j")
    st = f"greatest({j}, 0)"
    ln = f"(least(length({y}), {j} + length({x})) - {st})"
    win = f"substr({y}, {st} + 1, {ln})"
    body = f"200.0::DOUBLE * {lcs(x, win)} / (length({x}) + {ln})"
    return (f"(CASE WHEN length({x}) = 0 THEN (CASE WHEN length({y}) = 0 THEN 100.0::DOUBLE ELSE 0.0::DOUBLE END) "
            f"ELSE list_max(list_transform(range(1 - length({x}), length({y})), lambda {j}: {body})) END)")


def partial(a: str, b: str) -> str:
    return (f"(CASE WHEN length({a}) < length({b}) THEN {_partial_directed(a, b)} "
            f"WHEN length({a}) > length({b}) THEN {_partial_directed(b, a)} "
            f"ELSE greatest({_partial_directed(a, b)}, {_partial_directed(b, a)}) END)")


def features_cols(s: str, p: str) -> list[str]:
    """SELECT items building the token columns the scorers read (prefix p)."""
    return [
        f"{s} AS {p}_s",
        f"list_distinct({tokens(s)}) AS {p}_toks",
        f"array_to_string(list_sort({tokens(s)}), ' ') AS {p}_srt",
        f"array_to_string(list_sort(list_distinct({tokens(s)})), ' ') AS {p}_dst",
    ]


def pair_cols(a: str = "a", b: str = "b") -> list[str]:
    """Second layer: per-pair token set pieces (from features_cols)."""
    x = _v("x")
    y = _v("y")
    return [
        f"list_sort(list_intersect({a}_toks, {b}_toks)) AS p_inter",
        f"list_sort(list_filter({a}_toks, lambda {x}: NOT list_contains({b}_toks, {x}))) AS p_da",
        f"list_sort(list_filter({b}_toks, lambda {y}: NOT list_contains({a}_toks, {y}))) AS p_db",
    ]


def token_sort(a: str = "a", b: str = "b") -> str:
    return ratio(f"{a}_srt", f"{b}_srt")


def token_set(a: str = "a", b: str = "b") -> str:
    sa, sb = "array_to_string(p_da, ' ')", "array_to_string(p_db, ' ')"
    la, lb = f"length({sa})", f"length({sb})"
    s = "length(array_to_string(p_inter, ' '))"
    e = f"(CASE WHEN {s} > 0 THEN 1 ELSE 0 END)"
    l_ = f"(CASE WHEN {la} <= {lb} THEN {lcs(sa, sb)} ELSE {lcs(sb, sa)} END)"
    dist = f"({la} + {lb} - 2 * {l_})"
    r1 = _norm(dist, f"({s} + {e} + {la}) + ({s} + {e} + {lb})")
    mixed = (f"greatest({r1}, {_norm(f'{e} + {la}', f'{s} + ({s} + {e} + {la})')}, "
             f"{_norm(f'{e} + {lb}', f'{s} + ({s} + {e} + {lb})')})")
    return (f"(CASE WHEN len({a}_toks) = 0 OR len({b}_toks) = 0 THEN 0.0::DOUBLE "
            f"WHEN len(p_inter) > 0 AND (len(p_da) = 0 OR len(p_db) = 0) THEN 100.0::DOUBLE "
            f"WHEN len(p_inter) = 0 THEN {ratio(f'{a}_dst', f'{b}_dst')} "
            f"ELSE {mixed} END)")


def partial_token(a: str = "a", b: str = "b") -> str:
    p_all = partial(f"{a}_srt", f"{b}_srt")
    same = f"(length({a}_srt) = length({a}_dst) AND length({b}_srt) = length({b}_dst))"
    return (f"(CASE WHEN len(list_intersect({a}_toks, {b}_toks)) > 0 THEN 100.0::DOUBLE "
            f"WHEN {same} THEN {p_all} "
            f"ELSE greatest({p_all}, {partial(f'{a}_dst', f'{b}_dst')}) END)")


def weighted(a: str = "a", b: str = "b") -> str:
    la, lb = f"length({a}_s)", f"length({b}_s)"
    q = f"(greatest({la}, {lb})::DOUBLE / least({la}, {lb}))"
    r = ratio(f"{a}_s", f"{b}_s")
    scale = f"(CASE WHEN {q} <= 8 THEN 0.9::DOUBLE ELSE 0.6::DOUBLE END)"
    short = f"greatest({r}, 0.95::DOUBLE * greatest({token_sort(a, b)}, {token_set(a, b)}))"
    long_ = (f"greatest({r}, {scale} * {partial(f'{a}_s', f'{b}_s')}, "
             f"(0.95::DOUBLE * {scale}) * {partial_token(a, b)})")
    return (f"(CASE WHEN {la} = 0 OR {lb} = 0 THEN 0.0::DOUBLE "
            f"WHEN {q} < 1.5 THEN {short} ELSE {long_} END)")


SCORERS = {
    "ratio": lambda a="a", b="b": ratio(f"{a}_s", f"{b}_s"),
    "token_sort": token_sort,
    "token_set": token_set,
    "partial": lambda a="a", b="b": partial(f"{a}_s", f"{b}_s"),
    "partial_token": partial_token,
    "weighted": weighted,
}


def _ascii(s: str) -> str:
    return f"NOT regexp_matches({s}, '[^\\x00-\\x7F]')"


def _ratio_may_reach(a: str, b: str, t: str) -> str:
    """Necessary condition for ratio(a, b) >= t (levenshtein only on ASCII
    text: DuckDB's levenshtein counts bytes)."""
    tot = f"(length({a}) + length({b}))"
    band = f"(200.0::DOUBLE * least(length({a}), length({b})) >= ({t}) * {tot} - 1e-9)"
    bound = f"floor({tot} * (1.0::DOUBLE - ({t}) / 100.0::DOUBLE) + 1e-9)"
    lev = f"(NOT ({_ascii(a)} AND {_ascii(b)}) OR levenshtein({a}, {b}) <= {bound})"
    return f"({band} AND {bound} >= 0 AND {lev})"


def token_set_may_reach(a: str, b: str, t: str, inter: str) -> str:
    """SQL twin of the Spark bound (``inter`` = list_intersect column)."""
    na, nb, ni = f"len({a}_toks)", f"len({b}_toks)", f"len({inter})"
    sum_i = f"length(array_to_string({inter}, ''))"
    sum_a = f"(length({a}_dst) - ({na} - 1))"
    sum_b = f"(length({b}_dst) - ({nb} - 1))"
    s = f"({sum_i} + {ni} - 1)"
    la = f"(CASE WHEN {na} > {ni} THEN ({sum_a} - {sum_i}) + ({na} - {ni} - 1) ELSE 0 END)"
    lb = f"(CASE WHEN {nb} > {ni} THEN ({sum_b} - {sum_i}) + ({nb} - {ni} - 1) ELSE 0 END)"
    subset = f"({na} = {ni} OR {nb} = {ni})"
    r2 = f"({_norm(f'1 + {la}', f'{s} + ({s} + 1 + {la})')} >= ({t}) - 1e-9)"
    r3 = f"({_norm(f'1 + {lb}', f'{s} + ({s} + 1 + {lb})')} >= ({t}) - 1e-9)"
    total = f"(({s} + 1 + {la}) + ({s} + 1 + {lb}))"
    bound = f"floor({total} * (1.0::DOUBLE - ({t}) / 100.0::DOUBLE) + 1e-9)"
    x, y = _v("x"), _v("y")
    sa = f"array_to_string(list_sort(list_filter({a}_toks, lambda {x}: NOT list_contains({b}_toks, {x}))), ' ')"
    sb = f"array_to_string(list_sort(list_filter({b}_toks, lambda {y}: NOT list_contains({a}_toks, {y}))), ' ')"
    lev = f"(NOT ({_ascii(sa)} AND {_ascii(sb)}) OR levenshtein({sa}, {sb}) <= {bound})"
    r1 = f"(abs({la} - {lb}) <= {bound} AND {bound} >= 0 AND {lev})"
    shared = f"({subset} OR {r2} OR {r3} OR {r1})"
    return (f"({na} > 0 AND {nb} > 0 AND (CASE WHEN {ni} > 0 THEN {shared} "
            f"ELSE {_ratio_may_reach(f'{a}_dst', f'{b}_dst', t)} END))")


def weighted_may_reach(a: str, b: str, t: str, inter: str = "p_i") -> str:
    la, lb = f"length({a}_s)", f"length({b}_s)"
    q = f"(greatest({la}, {lb})::DOUBLE / least({la}, {lb}))"
    tt = f"(({t}) / 0.95::DOUBLE)"
    short = (f"({_ratio_may_reach(f'{a}_s', f'{b}_s', t)} OR {_ratio_may_reach(f'{a}_srt', f'{b}_srt', tt)} "
             f"OR {token_set_may_reach(a, b, tt, inter)})")
    longer = f"(CASE WHEN {la} >= {lb} THEN {a}_s ELSE {b}_s END)"
    shorter = f"(CASE WHEN {la} >= {lb} THEN {b}_s ELSE {a}_s END)"
    mid = f"(CASE WHEN ({t}) >= 90 THEN contains({longer}, {shorter}) ELSE true END)"
    return (f"(CASE WHEN {la} = 0 OR {lb} = 0 THEN ({t}) <= 0 WHEN {q} < 1.5 THEN {short} "
            f"WHEN {q} <= 8 THEN {mid} ELSE ({t}) <= 60 END)")
