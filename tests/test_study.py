"""The threshold study's search and the semi-local kernel against brute force."""
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import brute
from catalog_engine.functions import semilocal as L
from catalog_engine.operators import matching as M
from catalog_engine.operators import study


def some_texts(rng, count, most=24, alphabet="abcde é"):
    return ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, most))) for _ in range(count)]


def test_kernel_is_brute_force():
    rng = random.Random(3)
    a, b = ["", "", "ab", "ab", "😀b"] + some_texts(rng, 400), ["", "x", "ab", "b", "b😀"] + some_texts(rng, 400)
    x, y = [L.codes(t) for t in a], [L.codes(t) for t in b]
    assert L.lcs_lengths(x, y).tolist() == [brute.lcs(s, t) for s, t in zip(a, b)]
    assert np.allclose(L.partial_ratios(x, y), [brute.partial(s, t) for s, t in zip(a, b)], rtol=0, atol=1e-12)
    assert L.partial_ratios([], []).tolist() == []


def test_windows_of_long_texts():
    """2,000 characters: all windows against the LCS of each, computed apart."""
    rng = random.Random(4)
    y = "".join(rng.choice("abcdefgh") for _ in range(2000))
    x = y[700:730] + "zz" + y[735:760]
    windows = [y[max(j, 0) : min(len(y), j + len(x))] for j in range(1 - len(x), len(y))]
    lcs = L.lcs_lengths([L.codes(x)] * len(windows), [L.codes(w) for w in windows])
    want = max(200.0 * n / (len(x) + len(w)) for n, w in zip(lcs.tolist(), windows))
    assert L.partial_ratios([L.codes(x)], [L.codes(y)])[0] == want > 85
    assert L.partial_ratios([L.codes(y)], [L.codes(y)])[0] == 100.0


def test_partial_scores_of_pairs(spark):
    rng = random.Random(5)
    pairs = list(zip(some_texts(rng, 60), some_texts(rng, 60))) + [(None, "a"), ("a b", "b  a"), ("x" * 2000, "x" * 70 + "y")]
    got = M.score_pairs(spark.createDataFrame(pairs, "a string, b string"), "a", "b", ["partial", "partial_token"]).collect()
    for r in got:
        if r.a is None:
            assert r.score_partial is None
        elif len(r.a) < 100:
            assert (r.score_partial, r.score_partial_token) == (round(brute.partial(r.a, r.b), 4), round(brute.partial_token(r.a, r.b), 4))


@pytest.mark.parametrize("blocks", [(256, 4096), (7, 9)])
def test_topk_is_that_of_all_pairs(spark, monkeypatch, blocks):
    monkeypatch.setattr(study, "QUERY_BLOCK", blocks[0])
    monkeypatch.setattr(study, "CATALOGUE_BLOCK", blocks[1])
    rng = random.Random(6)
    words = "red blue ring bolt anvil large small hot cold a".split()
    names = sorted({" ".join(rng.choices(words, k=rng.randint(1, 4))) for _ in range(60)})
    asked = ["", "   ", "zzz", "RED & ring®", "ring ring", "bolt-hot"] + [" ".join(rng.choices(words + ["xx", "anv"], k=rng.randint(1, 4))) for _ in range(20)]
    catalogue = spark.createDataFrame([(i, "b", n, "c") for i, n in enumerate(names)], "idx long, brand string, name string, category string")
    queries = spark.createDataFrame([(i, t, 1 + i % 4) for i, t in enumerate(asked)] + [(99, None, 2)], "query_id long, query string, k long")
    per_scorer, merged = M.study_topk(queries, catalogue, top_matches="k")
    scorers = {n: brute.SCORERS[n] for n in M.STUDY_SCORERS}
    rows, best = set(), set()
    for i, text in enumerate(asked):
        k, top = 1 + i % 4, {}
        for name, score in scorers.items():
            found = sorted((-score(brute.normalize_text(text), brute.normalize_text("b " + n)), j) for j, n in enumerate(names))[: 2 * k]
            rows |= {(i, name, rank + 1, j, round(-s, 9)) for rank, (s, j) in enumerate(found)}
            for s, j in found:
                top[j] = max(top.get(j, -1), -s)
        best |= {(i, rank + 1, j, round(s, 9)) for rank, (s, j) in enumerate(sorted(((s, j) for j, s in top.items()), key=lambda x: (-x[0], x[1]))[:k])}
    assert {(r.query_id, r.scorer, r["rank"], r.idx, round(r.score, 9)) for r in per_scorer.collect()} == rows
    assert {(r.query_id, r["rank"], r.idx, round(r.score, 9)) for r in merged.collect()} == best


def test_search_scores_a_part_of_the_pairs(spark):
    """Where a query has enough good candidates, the others are not scored."""
    from test_candidates import diverse_names
    rng = random.Random(7)
    names, _ = diverse_names(rng, 150)
    family = sorted({n + end for n in names for end in ("", " a", " b", " c", "s", "x", " xl", " 1", " 2", " 3", " 4", " 5")})
    catalogue = spark.createDataFrame([(i, n.split(" ", 1)[0], n.split(" ", 1)[1], "c") for i, n in enumerate(family)], "idx long, brand string, name string, category string")
    queries = spark.createDataFrame([(i, n) for i, n in enumerate(rng.sample(names, 40))], "query_id long, query string")
    got = {r.scorer: (r.pairs_scored, r.all_pairs) for r in M.study_pairs_scored(queries, catalogue).collect()}
    assert set(got) == set(M.STUDY_SCORERS)
    assert all(every == 40 * len(family) for _, every in got.values())
    assert all(got[name][0] < 0.1 * got[name][1] for name in ("ratio", "token_set", "partial")), got


def test_study_names_is_its_sql(spark):
    """The SQL takes minutes on larger tables."""
    import duckdb
    from conftest import SF_SMALL
    from oracle_check import TABLES, compare
    from catalog_engine.plans.registry import QUERIES, STUDY_NAMES_SQL
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    assert compare(spark, con, "study_names", QUERIES["study_names"], STUDY_NAMES_SQL, SF_SMALL)["status"] == "ok"


def test_requests_keep_every_row(spark):
    catalogue = spark.createDataFrame([(0, "b", "red ring", "c"), (1, "b", "blue ring", "c")], "idx long, brand string, name string, category string")
    rows = [(1, "b red ring", 1, 70), (2, "b red ring", 1, 99), (3, "b red ring", 2, 0), (4, None, 2, 0), (5, "b red ring", 2, 0)]
    got = M.study_requests(spark.createDataFrame(rows, "query_id long, query string, top_matches long, show_threshold long"), catalogue)
    assert sorted((r.query_id, r["rank"], r.full_name) for r in got.collect()) == [
        (1, 1, "b red ring"), (2, 1, "b red ring"), (3, 1, "b red ring"), (3, 2, "b blue ring"), (5, 1, "b red ring"), (5, 2, "b blue ring")]
    empty = M.study_requests(spark.createDataFrame([], "query_id long, query string, top_matches long, show_threshold long"), catalogue)
    assert empty.count() == 0
