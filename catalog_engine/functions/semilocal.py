"""Semi-local longest common subsequences for batches of string pairs: one sweep
over x and y gives the LCS of x with every window of y (M3, M6).

Strands enter at the left of every character of x and above every character of y;
at a cell they cross once at most, and never where the characters are equal. The
strand that leaves below column j tells where it entered; the LCS of x with
y[s:e] is (e - s) less the strands that enter at s or later and leave before e.
The cells of an anti-diagonal do not depend on each other, so a batch of pairs is
computed by |x| + |y| array operations.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

#: Cells of an anti-diagonal, over all pairs of a batch.
BATCH_CELLS = 1 << 18


def codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.int32)


def _entered(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Where the strand entered that leaves below each column: a column of y, or
    a negative number for the left side. Rows are pairs, padded with -1 and -2."""
    m, n = x.shape[1], y.shape[1]
    rows = x[:, ::-1]
    left = np.tile(np.arange(-m, 0, dtype=np.int32), (len(x), 1))  # the last row of x first
    down = np.tile(np.arange(n, dtype=np.int32), (len(x), 1))
    for d in range(m + n - 1):
        lo, hi = max(0, d - n + 1), min(m - 1, d)
        a, b = left[:, m - 1 - hi : m - lo], down[:, d - hi : d - lo + 1]
        swap = (rows[:, m - 1 - hi : m - lo] == y[:, d - hi : d - lo + 1]) | (a > b)
        a[:], b[:] = np.where(swap, b, a), np.where(swap, a, b)
    return down


def _batches(x: list[np.ndarray], y: list[np.ndarray]):
    """(places, x, y) padded, pairs of similar lengths together."""
    lengths = np.array([[len(a), len(b)] for a, b in zip(x, y)], dtype=np.int64).reshape(-1, 2)
    order, at = np.lexsort((lengths[:, 0], lengths[:, 1])), 0
    while at < len(order):
        n = max(1, lengths[order[at], 1])
        take = order[at : at + max(1, BATCH_CELLS // (2 * n))]
        take = take[lengths[take, 1] <= 2 * n + 8]
        at += len(take)
        padded = []
        for side, pad in ((x, -1), (y, -2)):
            width = max(1, max(len(side[k]) for k in take))
            full = np.full((len(take), width), pad, dtype=np.int32)
            for row, k in enumerate(take):
                full[row, : len(side[k])] = side[k]
            padded.append(full)
        yield take, *padded


def lcs_lengths(x: list[np.ndarray], y: list[np.ndarray]) -> np.ndarray:
    out = np.zeros(len(x), dtype=np.int64)
    for take, a, b in _batches(x, y):
        sizes = np.array([len(y[k]) for k in take])
        inside = np.arange(b.shape[1]) < sizes[:, None]
        out[take] = sizes - ((_entered(a, b) >= 0) & inside).sum(axis=1)
    return out


def _directed(x: list[np.ndarray], y: list[np.ndarray]) -> np.ndarray:
    """Best ratio of x with the windows of y that are as long as x, and with the
    shorter beginnings and ends of y; x is not longer than y."""
    out = np.zeros(len(x))
    for take, a, b in _batches(x, y):
        m, n = (np.array([len(side[k]) for k in take])[:, None] for side in (x, y))
        column = np.arange(b.shape[1])[None, :]
        entered, inside = _entered(a, b), column < n
        # strands within the window that begins at s: begun at s or later, left before s + m
        first, last = np.maximum(0, column - m + 1), entered
        counts = np.zeros((len(take), b.shape[1] + 1), dtype=np.int64)
        row, j = np.nonzero(inside & (entered >= 0) & (last >= first))
        np.add.at(counts, (row, np.broadcast_to(first, entered.shape)[row, j]), 1)
        np.add.at(counts, (row, last[row, j] + 1), -1)
        width = np.minimum(m, n - column)
        found = np.where(inside, 200.0 * (width - counts.cumsum(axis=1)[:, :-1]) / np.maximum(1, m + width), 0.0)
        # beginnings of y of column + 1 characters
        begun = ((entered >= 0) & inside).cumsum(axis=1)
        heads = np.where(inside & (column + 1 < m), 200.0 * (column + 1 - begun) / (m + column + 1), 0.0)
        best = np.maximum(found.max(axis=1), heads.max(axis=1))
        out[take] = np.where(m[:, 0] == 0, np.where(n[:, 0] == 0, 100.0, 0.0), best)
    return out


def partial_ratios(x: list[np.ndarray], y: list[np.ndarray]) -> np.ndarray:
    """The partial score of each pair, whichever side is the shorter; both
    directions where they are as long."""
    short = [a if len(a) <= len(b) else b for a, b in zip(x, y)]
    long_ = [b if len(a) <= len(b) else a for a, b in zip(x, y)]
    out = _directed(short, long_)
    same = [k for k in range(len(x)) if len(x[k]) == len(y[k])]
    if same:
        out[same] = np.maximum(out[same], _directed([long_[k] for k in same], [short[k] for k in same]))
    return out


@F.pandas_udf(DoubleType())
def partial_score(a: pd.Series, b: pd.Series) -> pd.Series:
    """Partial score of two string columns; null where one is null."""
    known = (a.notna() & b.notna()).to_numpy()
    out = np.full(len(a), np.nan)
    out[known] = partial_ratios([codes(t) for t in a[known]], [codes(t) for t in b[known]])
    return pd.Series(out).where(known, None)
