"""Scorers (M1-M6) against a plain dynamic-programming brute force, plus
hand-computed goldens and properties (SURVEY §5 items 3-5)."""
import random

import pytest
from pyspark.sql import functions as F

import brute
from catalog_engine.functions import similarity as S
from catalog_engine.functions import text as TX


def _pairs():
    rnd = random.Random(11)
    alpha = "abcde fgé"
    out = [("abc", "abd"), ("", ""), ("a", ""), ("", "b"), ("head shoulders", "shoulders head"),
           ("ab", "ab ab"), ("x y z", "z y x"), ("Brand#1 small ring", "small ring"),
           ("a" * 61, "a" * 62), ("ab" * 40, "ba" * 33), ("®™x", "x")]
    for _ in range(120):
        out.append(("".join(rnd.choice(alpha) for _ in range(rnd.randint(0, 24))),
                    "".join(rnd.choice(alpha) for _ in range(rnd.randint(0, 24)))))
    for _ in range(6):  # multi-word LCS path (> 62 code points)
        out.append(("".join(rnd.choice(alpha) for _ in range(rnd.randint(63, 90))),
                    "".join(rnd.choice(alpha) for _ in range(rnd.randint(63, 90)))))
    return out


@pytest.fixture(scope="module")
def scored(spark):
    df = spark.createDataFrame(_pairs(), "a string, b string")
    df = S.with_match_features(S.with_match_features(df, F.col("a"), "fa"), F.col("b"), "fb")
    cols = [S.score(n, S.Feat("fa"), S.Feat("fb")).alias(n) for n in S.SCORERS]
    return df.select("a", "b", *cols).collect()


@pytest.mark.parametrize("name", list(S.SCORERS))
def test_scorer_matches_brute_force(scored, name):
    bad = [(r.a, r.b, r[name], brute.SCORERS[name](r.a, r.b)) for r in scored
           if abs(r[name] - brute.SCORERS[name](r.a, r.b)) > 1e-9]
    assert not bad, bad[:5]


def test_goldens_and_properties(scored):
    by = {(r.a, r.b): r for r in scored}
    assert round(by[("abc", "abd")].ratio, 2) == 66.67
    assert by[("", "")].ratio == 100.0
    assert by[("x y z", "z y x")].token_set == 100.0
    assert by[("x y z", "z y x")].token_sort == 100.0
    for r in scored:
        for n in S.SCORERS:
            assert 0.0 <= r[n] <= 100.0
        if r.a == r.b and r.a:
            assert r.ratio == 100.0


def test_symmetry(spark):
    rows = [(a, b) for a, b in _pairs()[:60]]
    df = spark.createDataFrame(rows, "a string, b string")
    df = S.with_match_features(S.with_match_features(df, F.col("a"), "fa"), F.col("b"), "fb")
    out = df.select(*[(S.score(n, S.Feat("fa"), S.Feat("fb")) - S.score(n, S.Feat("fb"), S.Feat("fa"))).alias(n)
                      for n in ["ratio", "token_sort", "token_set", "partial", "weighted"]]).collect()
    for r in out:
        assert all(abs(x) < 1e-9 for x in r)


def test_normalize_text(spark):
    rows = [("Head & Shoulders®",), ("  A-B/C™   d ",), ("x",)]
    got = [r[0] for r in spark.createDataFrame(rows, "t string").select(TX.normalize_text("t")).collect()]
    assert got == [brute.normalize_text(t) for (t,) in rows]
    assert got[0] == "head and shoulders"
    again = spark.createDataFrame([(g,) for g in got], "t string").select(TX.normalize_text("t")).collect()
    assert [r[0] for r in again] == got  # idempotent


def test_gate_never_drops_a_match(spark):
    """The pruning condition is implied by weighted >= t (pruned = full)."""
    rows = _pairs()
    rnd = random.Random(3)
    names = ["Brand#1 small ring", "Brand#12 red widget", "blue bolt", "Brand#2 & small-ring®"]
    rows += [(rnd.choice(names), rnd.choice(names) + rnd.choice(["", "s", " x"])) for _ in range(80)]
    df = spark.createDataFrame(rows, "a string, b string")
    df = S.with_match_features(S.with_match_features(df, F.col("a"), "fa"), F.col("b"), "fb")
    fa, fb = S.Feat("fa"), S.Feat("fb")
    for t in (90.0, 80.0, 95.0):
        out = df.select(S.weighted_f(fa, fb).alias("w"), S.weighted_may_reach(fa, fb, F.lit(t)).alias("g")).collect()
        assert all(r.g for r in out if r.w >= t)
