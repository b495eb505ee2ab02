"""Ordinal cumulative-link regression on graded ratings (operator 2).

P(grade <= j) = sigmoid(threshold_j - w . x): one weight vector over hashed
text features, shared by all grades, and ordered thresholds. The expected grade
and the tail probability P(grade = best) rank and select documents.

The model is fitted on a bounded sample of the labelled documents
(``SAMPLE_DOCS`` of them, by hash of the id) and scores every document.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalog_engine.llm.common import cut, free_name, need_columns, release_tokenizers

#: Labelled documents that the model is fitted on, at most.
SAMPLE_DOCS = 20_000
BUCKETS = 1 << 20
GRADES = 3
STEPS = 400
RATE = 0.1
#: Weight of the squared weights in the loss.
RIDGE = 1e-5
#: Features in fewer sampled documents than this have no weight, nor have those
#: whose chi-square against the grades is below the next value, or below the
#: one after as a share of the documents: what a text is about must not tell its
#: grade by chance.
LEAST_DOCS = 6
LEAST_CHI2 = 15.0
LEAST_EFFECT = 0.006
#: Words and stems in a larger share of documents have no weight either: they
#: would add up with a text's length.
MOST_SHARE = 0.25
#: The first buckets, which are kept for shares and signs.
SHAPES = 1 << 12
#: Lengths of the word beginnings that are features besides whole words.
STEMS = (4, 5)
SEED = 5
#: Documents that a scoring task hands on at once.
BLOCK_DOCS = 1000
#: A document is kept if the probability of the best grade reaches this.
LEAST_TAIL = 0.7

WORD = re.compile(r"\w+")
SIGNS = re.compile(r"[^\w\s]+")
#: Classes of UTF-8 bytes: other, capital, digit, sign, white space.
_CLASS = np.zeros(256, dtype=np.uint8)
_CLASS[65:91], _CLASS[48:58], _CLASS[[9, 10, 11, 12, 13, 32]] = 1, 2, 4
_CLASS[[*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = 3


def graded(labels: DataFrame) -> DataFrame:
    """(doc_id, grade) of rated documents: 0 poor, 1 toxic, 2 good; of several
    ratings of a document the worst counts, rows without a rating none."""
    need_columns(labels, "doc_id", "quality", "toxic")
    grade = F.when(F.col("quality") == 0, 0).when(F.col("toxic") == 1, 1).when(F.col("quality").isNotNull(), 2)
    rated = labels.select(F.col("doc_id").cast("long").alias("doc_id"), grade.alias("grade")).where("doc_id is not null and grade is not null")
    return rated.groupBy("doc_id").agg(F.min("grade").alias("grade"))


class Features:
    """Hash buckets of a text: its distinct words in lower case and their
    beginnings, its distinct runs of signs, and steps of a few shares and of
    its length. Buckets of frequent words are remembered in a bounded cache."""

    MAX_WORDS = 150_000

    def __init__(self):
        self.seen: dict[str, int] = {}

    def _bucket(self, name: str) -> int:
        h = xxhash.xxh3_64_intdigest(name.encode("utf-8", "replace"))
        return h % SHAPES if " " in name else SHAPES + h % (BUCKETS - SHAPES)

    def of(self, text: str | None) -> np.ndarray:
        text = text or ""
        words = WORD.findall(text.lower())
        runs = SIGNS.findall(text)
        distinct = set(words)
        names = distinct | {"s " + r[:3] for r in set(runs)}
        for n in STEMS:
            names |= {f"{w[:n]}-" for w in distinct if len(w) > n}
        found = list(map(self.seen.get, names))
        if None in found:
            if len(self.seen) > self.MAX_WORDS:
                self.seen.clear()
            for k, name in enumerate(names):
                if found[k] is None:
                    found[k] = self._bucket(name)
                    if len(name) <= 24:
                        self.seen[name] = found[k]
        raw = np.frombuffer(text.encode("utf-8", "replace"), dtype=np.uint8)
        kinds = np.bincount(_CLASS[raw], minlength=5) / max(1, len(raw))
        lines = text.split("\n")
        n = max(1, len(words))
        shares = (
            ("distinct", len(distinct) / n**0.75), ("lines", len(set(lines)) / len(lines)), ("capitals", kinds[1]), ("digits", kinds[2]),
            ("signs", kinds[3] * 2), ("spaces", kinds[4]), ("width", np.log2(1 + len(raw) / n) / 8), ("size", np.log2(1 + n) / 20),
        )
        return np.array(found + [self._bucket(f"{k} {int(min(v, 4.0) * 20)}") for k, v in shares], dtype=np.int32)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


class Model:
    """Weights and ordered thresholds."""

    def __init__(self, weights: np.ndarray, thresholds: np.ndarray):
        self.weights, self.thresholds = weights, thresholds

    def probabilities(self, scores: np.ndarray) -> np.ndarray:
        """P(grade = j) per row."""
        upto = _sigmoid(self.thresholds[None, :] - scores[:, None])
        return np.diff(np.hstack([np.zeros((len(scores), 1)), upto, np.ones((len(scores), 1))]), axis=1)


def telling(flat: np.ndarray, of: np.ndarray, grades: np.ndarray) -> np.ndarray:
    """Buckets that enough documents have and whose share of documents differs
    between the grades by more than chance (chi-square of a grades x 2 table)."""
    have = np.stack([np.bincount(flat[grades[of] == g], minlength=BUCKETS) for g in range(GRADES)]).astype(float)
    docs = np.bincount(grades, minlength=GRADES)[:, None].astype(float)
    seen, n = have.sum(axis=0), float(len(grades))
    with np.errstate(divide="ignore", invalid="ignore"):
        expected = docs * seen / n
        off = (have - expected) ** 2
        chi2 = np.nan_to_num(off / expected).sum(axis=0) + np.nan_to_num(off / (docs - expected)).sum(axis=0)
    common = seen > MOST_SHARE * n
    common[:SHAPES] = False
    return (seen >= LEAST_DOCS) & (chi2 >= max(LEAST_CHI2, LEAST_EFFECT * n)) & ~common


def fit(rows: list[np.ndarray], grades: np.ndarray, steps: int = STEPS) -> Model:
    """Maximum likelihood with a ridge, by Adam over all rows at once. The
    thresholds are a first one and positive gaps, so they stay ordered."""
    weights, first, gaps = np.zeros(BUCKETS), np.array([-1.0]), np.zeros(GRADES - 2)
    model = lambda: Model(weights, np.concatenate([first, first + np.cumsum(np.exp(gaps))]))
    if not rows:
        return Model(weights, np.concatenate([first, first + np.cumsum(np.exp(gaps))]))
    flat, of = np.concatenate(rows), np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    usable = telling(flat, of, grades)
    flat, of = flat[usable[flat]], of[usable[flat]]
    # the fit works on the telling buckets alone, the rest stay at zero
    buckets, flat = np.unique(flat, return_inverse=True)
    dense, weights = weights, np.zeros(len(buckets))
    scale = 1 / len(rows)
    state = [(np.zeros_like(p), np.zeros_like(p)) for p in (weights, first, gaps)]
    for step in range(1, steps + 1):
        m = model()
        scores = np.bincount(of, weights=weights[flat], minlength=len(rows))
        edges = np.concatenate([[-np.inf], m.thresholds, [np.inf]])
        up, low = (_sigmoid(np.clip(edges[grades + k], -1e9, 1e9) - scores) for k in (1, 0))
        p = np.maximum(up - low, 1e-12)
        d_up, d_low = up * (1 - up) / p, low * (1 - low) / p
        d_score = (d_up - d_low) * scale
        g_weights = np.bincount(flat, weights=d_score[of], minlength=len(buckets)) + RIDGE * weights
        d_edges = np.zeros(GRADES + 1)
        np.add.at(d_edges, grades + 1, -d_up * scale)
        np.add.at(d_edges, grades, d_low * scale)
        d_thresholds = d_edges[1:GRADES]
        g_first = np.array([d_thresholds.sum()])
        g_gaps = np.cumsum(d_thresholds[::-1])[::-1][1:] * np.exp(gaps)
        for value, grad, (mean, square) in zip((weights, first, gaps), (g_weights, g_first, g_gaps), state):
            mean += 0.1 * (grad - mean)
            square += 0.001 * (grad * grad - square)
            value -= RATE * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-9)
    dense[buckets] = weights
    return Model(dense, model().thresholds)


def _described(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    release_tokenizers()
    features = Features()
    for batch in batches:
        yield batch[["doc_id", "grade"]].assign(buckets=[features.of(t) for t in batch["text"]])


def _fitted(rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows.sort_values("doc_id")
    m = fit(rows["buckets"].tolist(), rows["grade"].to_numpy().astype(np.int64))
    buckets = np.flatnonzero(m.weights)
    return pd.DataFrame({"buckets": [buckets], "weights": [m.weights[buckets]], "thresholds": [m.thresholds]})


def train(docs: DataFrame, labels: DataFrame, sample_docs: int = SAMPLE_DOCS) -> Model:
    """The model of a sample of the labelled documents. The sample's ids
    (bounded) are broadcast, its features (bounded) meet in one task."""
    mixed = F.xxhash64("doc_id", F.lit(SEED))
    sample = cut(graded(labels).orderBy(mixed, "doc_id").limit(sample_docs))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = texts.join(F.broadcast(sample), "doc_id").mapInPandas(_described, "doc_id bigint, grade int, buckets array<int>")
    found = rows.withColumn("one", F.lit(1)).groupBy("one").applyInPandas(_fitted, "buckets array<bigint>, weights array<double>, thresholds array<double>").collect()
    if not found:
        return fit([], np.empty(0, dtype=np.int64))
    weights = np.zeros(BUCKETS)
    weights[np.array(found[0].buckets, dtype=np.int64)] = found[0].weights
    return Model(weights, np.array(found[0].thresholds))


def _scored(model: Model) -> Callable:
    buckets = np.flatnonzero(model.weights)
    values, thresholds = model.weights[buckets], model.thresholds  # a sparse copy travels to the tasks

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        release_tokenizers()
        weights, features = np.zeros(BUCKETS), Features()
        weights[buckets] = values
        model = Model(weights, thresholds)
        for batch in batches:
            for at in range(0, len(batch), BLOCK_DOCS):
                part = batch.iloc[at : at + BLOCK_DOCS]
                p = model.probabilities(np.array([weights[features.of(t)].sum() for t in part["text"]]))
                yield part.assign(expected_grade=p @ np.arange(GRADES), tail=p[:, -1])
        # the worker lives on; what it holds would count against later stages
        features.seen.clear()
        pa.default_memory_pool().release_unused()

    return score


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with ``expected_grade`` (0 to 2) and ``tail_probability`` (of
    the best grade), each with an underscore before the name where ``docs``
    has that column. A null text counts as empty; an empty text is scored by its
    shares alone. Every row is returned once, whatever its id."""
    need_columns(docs, "doc_id", "text")
    grade, tail = free_name(docs, "expected_grade"), free_name(docs, "tail_probability")
    names = [f"c{i}" for i in range(len(docs.columns))]
    plain = docs.toDF(*names)
    text = names[docs.columns.index("text")]
    passed = plain.withColumnRenamed(text, "text")
    schema = ", ".join(f"`{c}` {t}" for c, t in passed.dtypes) + ", expected_grade double, tail double"
    return passed.mapInPandas(_scored(model), schema).toDF(*docs.columns, grade, tail)


def select_documents(docs: DataFrame, labels: DataFrame, least_tail: float = LEAST_TAIL, sample_docs: int = SAMPLE_DOCS) -> DataFrame:
    """The rows of ``docs`` whose tail probability reaches ``least_tail``, with
    the columns that :func:`score` adds. Without labelled documents the model
    is flat, and every row has the same score."""
    scored = score(docs, train(docs, labels, sample_docs))
    return scored.where(F.col(scored.columns[-1]) >= least_tail)
