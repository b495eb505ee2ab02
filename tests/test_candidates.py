"""The prefix-filtered match join: nothing is lost, few pairs are looked at,
and no plan of the crawl compares all pairs."""
import random
import re

import pytest
from pyspark.sql import functions as F

import brute
from catalog_engine.operators import candidates as C
from catalog_engine.operators import matching as M
from catalog_engine.plans import fixtures as FX
from conftest import SF_SMALL


def _edited(rng, text, words):
    chars = list(text)
    for _ in range(rng.randint(0, 3)):
        k, r = rng.randrange(len(chars)), rng.random()
        if r < 0.4 and len(chars) > 1:
            chars.pop(k)
        elif r < 0.7:
            chars.insert(k, rng.choice("aeiou x"))
        else:
            chars[k] = rng.choice("bcd ")
    text = "".join(chars)
    if rng.random() < 0.2:
        toks = text.split()
        rng.shuffle(toks)
        text = " ".join(toks)
    if rng.random() < 0.1:
        text += " " + rng.choice(words)
    return text[: len(text) // 2] if rng.random() < 0.1 else text


@pytest.fixture(scope="module")
def odd_texts():
    """Texts of few characters, repeated tokens, blanks only, near copies."""
    rng = random.Random(7)
    texts = {"".join(rng.choice(a) for _ in range(rng.randint(1, 26))) for a in ("aab ", "abc d", "aé  \t", "xy") for _ in range(30)}
    base = ["aa bb cc dd", "aa bb cc dd ee", "longword1x of", "longword1y of", "the big red fox", "fox red big the", "  ", "\t", " a", "a" * 16, "a" * 18,
            "a b c d e f g h", "h g f e d c b a", "ab ab ab cd", "ab cd", "abcdefghijklmnopqrstuvwxyz abcdefghij"]
    texts |= set(base) | {_edited(rng, b, ["aa"]) for b in base for _ in range(4)}
    texts = sorted(texts - {""})
    scores = {(i, j): brute.weighted(a, b) for i, a in enumerate(texts) for j, b in enumerate(texts)}
    return texts, scores


@pytest.mark.parametrize("threshold", [86, 90, 95, 100])
def test_no_pair_is_lost(spark, odd_texts, threshold):
    texts, scores = odd_texts
    rows = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    got = {(r.q, r.c) for r in C.candidate_pairs(rows.withColumn("req", F.lit(float(threshold))), rows, threshold, 4).collect()}
    lost = [(texts[a], texts[b], s) for (a, b), s in scores.items() if s >= threshold and (a, b) not in got]
    assert not lost, lost[:5]


def test_thresholds_of_each_query(spark, odd_texts):
    """Rows may ask for more than the join's threshold."""
    texts, scores = odd_texts
    rows = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    req = M.required_threshold(F.col("text"), 86)
    got = {(r.q, r.c) for r in C.candidate_pairs(rows.withColumn("req", req), rows, 86, 4).collect()}
    assert all((a, b) in got for (a, b), s in scores.items() if s >= (90 if len(texts[a]) < 15 else 86))


def diverse_names(rng, count):
    syllables = [a + b for a in "bcdfghklmnprstvz" for b in ("a", "e", "i", "o", "u", "an", "er", "il", "os", "ut")]
    words = ["".join(rng.choice(syllables) for _ in range(rng.randint(2, 4))) for _ in range(6000)]
    return sorted({" ".join(rng.choice(words) for _ in range(rng.randint(2, 5))) for _ in range(count)}), words


def test_diverse_names_meet_few_others(spark):
    rng = random.Random(8)
    names, words = diverse_names(rng, 1500)
    asked = sorted({_edited(rng, rng.choice(names), words) for _ in range(800)} - {""})
    queries = spark.createDataFrame(list(enumerate(asked)), "id long, text string")
    catalogue = spark.createDataFrame(list(enumerate(names)), "id long, text string")
    for threshold in (86, 90, 95):
        pairs = C.candidate_pairs(queries.withColumn("req", F.lit(float(threshold))), catalogue, threshold, 4).count()
        assert pairs < 0.01 * len(asked) * len(names), (threshold, pairs)


def test_empty_sides_and_low_thresholds(spark):
    none = spark.createDataFrame([], "id long, text string, req double")
    some = spark.createDataFrame([(1, "ab", 90.0), (2, "", 90.0)], "id long, text string, req double")
    assert C.candidate_pairs(none, some.drop("req"), 90, 2).count() == 0
    assert C.candidate_pairs(some, none.drop("req"), 90, 2).count() == 0
    assert [tuple(r) for r in C.candidate_pairs(some, some.drop("req"), 90, 2).collect()] == [(1, 1)]
    with pytest.raises(ValueError):
        C.candidate_pairs(some, some, 85, 2)


@pytest.mark.parametrize("name", ["best_match", "product_match", "route_links"])
def test_no_plan_compares_all_pairs(spark, name):
    from __spark_entry__ import queries
    plan = queries()[name](spark, SF_SMALL)._jdf.queryExecution().toString()
    assert "BroadcastNestedLoopJoin" not in plan and "CartesianProduct" not in plan


def test_join_condition_is_small_enough_to_be_compiled(spark):
    """The JVM does not optimise methods of more than 8,000 bytes."""
    rows = spark.createDataFrame([(i, f"name {i}") for i in range(50)], "id long, text string")
    pairs = C.candidate_pairs(rows.withColumn("req", F.lit(90.0)), rows, 90, 2)
    told = spark._jvm.PythonSQLUtils.explainString(pairs._jdf.queryExecution(), "codegen")
    for part in told.split("== Subtree"):
        if "Join" in part[:4000] and "bit_count" in part[:20000]:
            sizes = [int(x) for x in re.findall(r"maxMethodCodeSize:(\d+)", part[:2000])]
            assert all(s < 8000 for s in sizes), sizes


def test_rows_without_a_text_match_nothing(spark):
    catalogue = spark.createDataFrame([(0, "b", "n one", "c")], "idx long, brand string, name string, category string")
    rows = spark.createDataFrame([(1, "b n one"), (2, None), (None, None), (3, ""), (4, "b n one")], "query_id long, query string")
    got = {(r.query_id, r.query): (r.matched, r.matched_name) for r in M.best_match(rows, catalogue).collect()}
    assert got == {(1, "b n one"): (True, "b n one"), (4, "b n one"): (True, "b n one"), (2, None): (False, None), (None, None): (False, None), (3, ""): (False, None)}


def test_generated_names_are_matched_as_by_all_pairs(spark):
    rng = random.Random(9)
    names, words = diverse_names(rng, 60)
    catalogue = spark.createDataFrame([(i, n.split(" ", 1)[0], n.split(" ", 1)[1], "c") for i, n in enumerate(names)], "idx long, brand string, name string, category string")
    asked = sorted({_edited(rng, rng.choice(names), words) for _ in range(120)} - {""})
    rows = spark.createDataFrame(list(enumerate(asked)), "query_id long, query string")
    for threshold in (86, 90, 95):
        got = {r.query: (r.matched_name, r.score) for r in M.best_match(rows, catalogue, threshold=threshold).collect()}
        for text in asked:
            best = max(((brute.weighted(text, n), -i) for i, n in enumerate(names)))
            req = max(90, threshold) if len(text) < 15 else threshold
            want = (names[-best[1]], round(best[0], 4)) if best[0] >= req else (None, None)
            assert got[text] == want, (threshold, text, got[text], want)
