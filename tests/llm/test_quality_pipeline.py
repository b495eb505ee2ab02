"""The classifier and the pipeline, each stage against brute force."""
import random

import numpy as np
import pytest
from conftest import SF_SMALL
from tokenizers import Tokenizer

import corpus_pipeline
from catalog_engine.llm import decontaminate, quality
from catalog_engine.llm.common import stored, tokenizer_path
from test_pairs import brute_words, classes
from test_text import brute_edits, brute_lines

SF = "/root/testdata/sf0.01"


def made_up(n, seed):
    """Documents of three grades: noise words, with insults, or signs."""
    rng = random.Random(seed)
    rows = []
    for k in range(n):
        grade = rng.choice([0, 1, 2, 2, 2])
        words = [f"w{rng.randrange(400)}" for _ in range(rng.randint(5, 120))]
        if grade == 1:
            words += rng.choices(["dreck", "kroll", "vazz"], k=2)
        rng.shuffle(words)
        text = " ".join(w + "###" for w in words) if grade == 0 else " ".join(words)
        rows.append((k, text, grade))
    return rows


def test_fit_orders_grades_on_held_out_rows():
    rows = made_up(3000, 1)
    features = quality.Features()
    x, y = [features.of(t) for _, t, _ in rows], np.array([g for *_, g in rows])
    model = quality.fit(x[:2000], y[:2000])
    assert (np.diff(model.thresholds) > 0).all()
    p = model.probabilities(np.array([model.weights[r].sum() for r in x[2000:]]))
    assert np.allclose(p.sum(axis=1), 1)
    assert (p.argmax(axis=1) == y[2000:]).mean() > 0.97


def test_gradient_is_that_of_the_likelihood():
    """The fit must not end above the loss of nearby weights."""
    rows = made_up(400, 2)
    features = quality.Features()
    x, y = [features.of(t) for _, t, _ in rows], np.array([g for *_, g in rows])
    loss = lambda m: -np.log(m.probabilities(np.array([m.weights[r].sum() for r in x]))[np.arange(len(y)), y]).mean()
    start = loss(quality.fit(x, y, steps=1))
    assert loss(quality.fit(x, y, steps=60)) < 0.5 * start


def test_selection_with_odd_rows(spark):
    rows = made_up(600, 3)
    docs = spark.createDataFrame([(k, t, "s", k) for k, t, _ in rows] + [(None, None, None, 0), (7, "", "s", 0)], "doc_id long, text string, tail_probability string, c0 int")
    labels = spark.createDataFrame([(k, int(g > 0), int(g == 1), "x") for k, _, g in rows] + [(None, 1, 0, "x"), (5, None, None, "x"), (9999, 1, 0, "x")], "doc_id long, quality int, toxic int, text string")
    scored = quality.score(docs, quality.train(docs, labels))
    assert scored.columns == ["doc_id", "text", "tail_probability", "c0", "expected_grade", "_tail_probability"]
    out = scored.collect()
    assert len(out) == 602
    grade = {k: g for k, _, g in rows}
    means = [np.mean([r.expected_grade for r in out if r.text and grade.get(r.doc_id) == g]) for g in range(3)]
    assert means[0] < means[1] < means[2]
    flat = quality.score(docs, quality.train(docs, labels.limit(0))).collect()
    assert len({r.expected_grade for r in flat}) == 1
    assert quality.select_documents(docs.limit(0), labels).count() == 0
    worst = quality.graded(spark.createDataFrame([(1, 1, 0), (1, 0, 0), (2, 1, 0), (2, 1, 1)], "doc_id long, quality int, toxic int"))
    assert {(r.doc_id, r.grade) for r in worst.collect()} == {(1, 0), (2, 1)}


@pytest.fixture(scope="module")
def stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        out.append(stored(stage(spark, out[-1], SF), "test-stage"))
    return out


def rows_of(df):
    return {r.doc_id: r for r in df.collect()}


def test_stages_keep_the_columns(spark, stages):
    for df in stages[1:-1]:
        assert df.columns == stages[0].columns
    assert corpus_pipeline.ORACLE_SQL is None


def test_classifier_stage(spark, stages):
    """Scores made here, of the same model, select the same rows; held
    against the labels, good documents stay and the others mostly go."""
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    model = quality.train(stages[0], labels)
    before, after = rows_of(stages[0]), rows_of(stages[1])
    features = quality.Features()
    tail = {d: model.probabilities(np.array([model.weights[features.of(r.text)].sum()]))[0, -1] for d, r in before.items()}
    assert set(after) == {d for d, p in tail.items() if p >= quality.LEAST_TAIL}
    rated = [(r.doc_id, r.quality, r.toxic) for r in labels.collect()]
    good = [d for d, q, t in rated if q == 1 and t == 0]
    assert np.mean([d in after for d in good]) > 0.97
    assert np.mean([d in after for d, q, t in rated if q == 0 or t == 1]) < 0.2


def test_line_stage(stages):
    before, after = stages[1].collect(), rows_of(stages[2])
    want = brute_lines([(r.doc_id, r.text, r.source) for r in before], 5)
    assert {d: r.text for d, r in after.items()} == {d: t for d, _, _, t in want}
    assert all(r.n_chars == len(r.text) for r in after.values())


def test_near_duplicate_stage(stages):
    before, after = rows_of(stages[2]), rows_of(stages[3])
    ids = sorted(before)
    sets = []
    for d in ids:
        w = brute_words(before[d].text)
        sets.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    links = [(i, j) for i, a in enumerate(sets) for j in range(i) if (b := sets[j]) and a and 10 * min(len(a), len(b)) >= 8 * max(len(a), len(b)) and 100 * len(a & b) >= 80 * len(a | b)]
    up = classes(len(ids), links)
    assert set(after) == {d for i, d in enumerate(ids) if up[i] == i}
    assert len(after) < len(before)


def test_decontamination_stage(spark, stages):
    before, after = rows_of(stages[3]), rows_of(stages[4])
    items = [decontaminate.words_of(r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    hold, exact = set(), set()
    for d, r in before.items():
        own = decontaminate.words_of(r.text)
        for item in items:
            if len(set(item) & set(own)) > len(set(item)) // 2 and (e := brute_edits(own, item)) <= decontaminate.edits_allowed(len(item)):
                hold.add(d)
                exact |= {d} if e == 0 else set()
    gone = set(before) - set(after)
    assert exact <= gone <= hold
    assert len(gone) >= 0.95 * len(hold)


def test_packing_stage(spark, stages):
    model = Tokenizer.from_file(tokenizer_path())
    before, pieces = stages[4].collect(), stages[5].collect()
    total = {r.doc_id: len(model.encode(r.text or "", add_special_tokens=False).ids) + 1 for r in before}
    got: dict = {}
    for p in pieces:
        got[p.doc_id] = got.get(p.doc_id, 0) + p.length
    assert got == total
    used = len({p.sequence_id for p in pieces})
    assert used <= -(-sum(total.values()) // 4096) * 1.02 + 2


def test_queries_are_registered(spark):
    from __spark_entry__ import queries

    names = list(queries())
    assert all(any(n.startswith(f"op{i}_") for n in names) for i in range(1, 11)) and "pipeline" in names
    assert queries()["pipeline"](spark, SF_SMALL).count() > 0
