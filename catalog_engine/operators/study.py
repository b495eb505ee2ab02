"""Top-K per scorer without scoring all pairs.

Queries and catalogue are dealt into blocks; a task owns a cell (query block,
catalogue block). There, character counts and token lengths bound every score
from above with a few array operations, and the pairs of the best bounds are scored
first, until a query's K-th score is above its next bound. The tasks' hits are
merged by rank. No score is cut: queries without any good candidate get their
best ones, however low.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import semilocal as L
from ..functions.text import apply_processor

#: Rows of a block at most, on average.
QUERY_BLOCK = 256
CATALOGUE_BLOCK = 4096
#: Characters share buckets by code point, which only raises the bounds.
BUCKETS = 64
_SLACK = 1e-9


class _Side:
    """What the bounds need of the texts of one block."""

    def __init__(self, texts: list[str]):
        self.texts, self.codes = texts, [L.codes(t) for t in texts]
        self.tokens = [set(t.split()) for t in texts]
        self.n = np.array([len(c) for c in self.codes], dtype=np.int64)
        self.chars = self._counts(self.codes)
        distinct = [L.codes("".join(t)) for t in self.tokens]
        self.letters = np.array([len(d) for d in distinct], dtype=np.int64)
        self.token_chars = self._counts(distinct)
        self.n_tokens = np.array([len(t) for t in self.tokens], dtype=np.int64)

    @staticmethod
    def _counts(codes: list[np.ndarray]) -> np.ndarray:
        out = np.zeros((len(codes), BUCKETS), dtype=np.int32)
        for row, c in enumerate(codes):
            out[row] = np.bincount(c % BUCKETS, minlength=BUCKETS)
        return out


def _common(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Characters that each pair has in common at most."""
    out = np.zeros((len(a), len(b)), dtype=np.int32)
    for k in range(BUCKETS):
        if a[:, k].any() and b[:, k].any():
            out += np.minimum(a[:, k][:, None], b[:, k][None, :])
    return out


def _joined(chars: np.ndarray, count: np.ndarray) -> np.ndarray:
    return chars + np.maximum(0, count - 1)


def _token_bounds(q: _Side, c: _Side) -> np.ndarray:
    """Upper bounds of token_set; exact but for the LCS of the differences."""
    shared, letters = (np.zeros((len(q.texts), len(c.texts)), dtype=np.int32) for _ in range(2))
    rows_of: dict[str, list[int]] = {}
    for row, toks in enumerate(c.tokens):
        for t in toks:
            rows_of.setdefault(t, []).append(row)
    for row, toks in enumerate(q.tokens):
        for t in toks:
            if t in rows_of:
                shared[row, rows_of[t]] += 1
                letters[row, rows_of[t]] += len(t)
    tq, tc = q.n_tokens[:, None], c.n_tokens[None, :]
    la, lb = (_joined(side - letters, t - shared) for side, t in ((q.letters[:, None], tq), (c.letters[None, :], tc)))
    s = _joined(letters, shared)
    e = (s > 0).astype(np.int64)
    total = (s + e + la) + (s + e + lb)
    apart = q.letters[:, None] + c.letters[None, :] - 2 * _common(q.token_chars, c.token_chars)
    norm = lambda d, n: 100.0 - 100.0 * d / np.maximum(1, n)
    best = norm(apart, total)
    both = np.maximum(norm(e + la, s + (s + e + la)), norm(e + lb, s + (s + e + lb)))
    best = np.where(shared > 0, np.maximum(best, both), best)
    best = np.where((shared > 0) & ((shared == tq) | (shared == tc)), 100.0, best)
    return np.where((tq == 0) | (tc == 0), 0.0, best)


def _bounds(q: _Side, c: _Side) -> dict[str, np.ndarray]:
    common = _common(q.chars, c.chars)
    total = q.n[:, None] + c.n[None, :]
    shorter = np.minimum(q.n[:, None], c.n[None, :])
    ratio = np.where(total == 0, 100.0, 200.0 * common / np.maximum(1, total))
    # a window needs no more characters than are in common
    partial = np.where(total == 0, 100.0, 200.0 * common / np.maximum(1, shorter + common))
    return {"ratio": ratio, "token_set": _token_bounds(q, c), "partial": partial}


def _token_sets(a: list[set[str]], b: list[set[str]]) -> np.ndarray:
    out, open_, x, y, more = np.zeros(len(a)), [], [], [], []
    for k, (ta, tb) in enumerate(zip(a, b)):
        inter = ta & tb
        if not ta or not tb:
            continue
        if inter and (len(inter) == len(ta) or len(inter) == len(tb)):
            out[k] = 100.0
            continue
        sa, sb, s = " ".join(sorted(ta - tb)), " ".join(sorted(tb - ta)), len(" ".join(inter))
        open_.append(k)
        x.append(L.codes(sa))
        y.append(L.codes(sb))
        more.append(s)
    lcs = L.lcs_lengths(x, y)
    for k, ca, cb, s, both in zip(open_, x, y, more, lcs.tolist()):
        la, lb, e = len(ca), len(cb), 1 if s else 0
        norm = lambda d, n: 100.0 if n == 0 else 100.0 - 100.0 * d / n
        out[k] = norm(la + lb - 2 * both, (s + e + la) + (s + e + lb))
        if s:
            out[k] = max(out[k], norm(e + la, s + (s + e + la)), norm(e + lb, s + (s + e + lb)))
    return out


def _scores(scorer: str, q: _Side, c: _Side, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    if scorer == "token_set":
        return _token_sets([q.tokens[k] for k in i], [c.tokens[k] for k in j])
    x, y = [q.codes[k] for k in i], [c.codes[k] for k in j]
    if scorer == "partial":
        return L.partial_ratios(x, y)
    total = q.n[i] + c.n[j]
    return np.where(total == 0, 100.0, 200.0 * L.lcs_lengths(x, y) / np.maximum(1, total))


def _best(scorer: str, bounds: np.ndarray, q: _Side, c: _Side, k: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per query its scored rows and their scores, the best k among them."""
    order = np.argsort(-bounds, axis=1, kind="stable")
    found = [np.empty(0) for _ in k]
    done, kth = np.zeros(len(k), dtype=np.int64), np.full(len(k), -1.0)
    while True:
        i, j = [], []
        for row in range(len(k)):
            ahead = order[row, done[row] : done[row] + max(16, int(k[row]))]
            ahead = ahead[bounds[row, ahead] >= kth[row] - _SLACK]
            i.append(np.full(len(ahead), row))
            j.append(ahead)
        sizes = [len(x) for x in j]
        if not sum(sizes):
            return [(order[row, : done[row]], found[row]) for row in range(len(k))]
        new = np.split(_scores(scorer, q, c, np.concatenate(i), np.concatenate(j)), np.cumsum(sizes)[:-1])
        for row, got in enumerate(new):
            found[row] = np.concatenate([found[row], got])
            done[row] += len(got)
            if 0 < k[row] <= len(found[row]):
                kth[row] = np.partition(found[row], -int(k[row]))[-int(k[row])]


def _searched(scorers: list[str]):
    def search(rows: pd.DataFrame) -> pd.DataFrame:
        queries, cat = rows[rows["idx"].isna()], rows[rows["idx"].notna()].sort_values("idx")
        out = []
        if len(queries) and len(cat):
            q, c = _Side(queries["text"].tolist()), _Side(cat["text"].tolist())
            k, idx = queries["k"].to_numpy(dtype=np.int64), cat["idx"].to_numpy(dtype=np.int64)
            bounds = _bounds(q, c)
            for scorer in scorers:
                for key, most, (place, score) in zip(queries["key"], k, _best(scorer, bounds[scorer], q, c, k)):
                    top = np.lexsort((idx[place], -score))[:most]
                    out.append(pd.DataFrame({"key": key, "scorer": scorer, "idx": idx[place[top]], "score": score[top], "scored": len(place)}))
        empty = pd.DataFrame({"key": pd.Series(dtype="str"), "scorer": pd.Series(dtype="str"), "idx": pd.Series(dtype="int64"), "score": pd.Series(dtype="float64"), "scored": pd.Series(dtype="int64")})
        found = pd.concat(out) if out else empty
        return found.assign(cell=int(rows["a"].iloc[0]) << 32 | int(rows["b"].iloc[0]))[["key", "scorer", "idx", "score", "scored", "cell"]]

    return search


def top_hits(queries: DataFrame, catalogue: DataFrame, scorers: list[str], *, query_col: str, key: str, k, processor: str) -> DataFrame:
    """(``key``, scorer, idx, score, scored, cell): of every cell the best ``k``
    (a column of ``queries``) rows per query and scorer; ``scored`` is the number
    of pairs that the cell scored for that query and scorer. ``catalogue`` holds
    (idx, full_name); a query without a text has no hits."""
    spark = queries.sparkSession
    queries = queries.where(F.col(query_col).isNotNull())
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    nq, nc = queries.count(), catalogue.count()
    qb, cb = max(1, -(-nq // QUERY_BLOCK), min(nq, tasks)), max(1, -(-nc // CATALOGUE_BLOCK))
    none = lambda kind: F.lit(None).cast(kind)
    q = queries.select(
        F.pmod(F.xxhash64(key), F.lit(qb)).cast("int").alias("a"), F.explode(F.sequence(F.lit(0), F.lit(cb - 1))).alias("b"), F.to_json(F.struct(key)).alias("key"),
        none("bigint").alias("idx"), apply_processor(F.col(query_col), processor).alias("text"), k.cast("bigint").alias("k"))
    c = catalogue.select(
        F.explode(F.sequence(F.lit(0), F.lit(qb - 1))).alias("a"), F.pmod(F.xxhash64("idx"), F.lit(cb)).cast("int").alias("b"), none("string").alias("key"),
        "idx", apply_processor(F.col("full_name"), processor).alias("text"), none("bigint").alias("k"))
    # an explicit number: the blocks are few bytes for much work
    cells = q.union(c).repartition(max(tasks, min(qb * cb, 4 * tasks)), "a", "b")
    found = cells.groupBy("a", "b").applyInPandas(_searched(scorers), "key string, scorer string, idx bigint, score double, scored bigint, cell bigint")
    as_key = F.from_json("key", queries.select(key).schema)[key]
    return found.withColumn("key", as_key).withColumnRenamed("key", key)


def ranked(hits: DataFrame, key: str, most) -> DataFrame:
    w = Window.partitionBy(key, "scorer").orderBy(F.col("score").desc(), F.col("idx"))
    return hits.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= most)
