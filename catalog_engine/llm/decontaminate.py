"""Benchmark decontamination by CGK embedding and bit-sampling LSH (operator 6).

A document is contaminated by a benchmark item if a run of its words is within
a few word edits of the item. The CGK random walk turns a word sequence into a
string three times as long (each step writes the current word and moves on or
stays by a random bit of step and word), so that sequences within a small edit
distance differ in few places of their strings. Hashes of a few sampled places,
repeated over several walks, make windows of the documents and items of the same
size collide with a target recall; long items are looked for by pieces, one of
which has its share of the edits at most. What collides is verified by the exact
edit distance of the whole item.

Windows are cut where they can matter: each of k edits breaks at most three of
an item's m - 2 runs of three words, so a copy holds m - 2 - 3 k of them at
places that differ from the item's by k at most. A window starts wherever as many
runs of the document, found at their places in an item, put the item's start at
most k words away. What collides is searched for the best run around it, wherever
that starts.
"""

from __future__ import annotations

import math
import re
from collections import defaultdict
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import repeat

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalog_engine.llm.common import need_columns

#: Edits per word of an item (similarity 0.8).
EDIT_SHARE = 0.2
RUN = 3
#: Items with fewer words are matched by no near copy and left out.
LEAST_WORDS = 5
WALKS = 6
SAMPLES_PER_WALK = 10
PLACES = 4
#: Longer items are looked for by pieces (see ``pieces``).
PIECE_WORDS = 30
SEED = 97
#: Bytes of item text that are sent to every task at once; larger benchmarks
#: take several passes.
PASS_BYTES = 32 << 20
WINDOWS = 20_000
#: Words of windows that are verified together.
CELLS = 1_600_000
#: Documents whose windows are embedded together.
BLOCK_DOCS = 2500

WORD = re.compile(r"\w+")
_M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
PAD = np.uint64(0)


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def words_of(text: str | None) -> list[str]:
    """The words of a whole text, in lower case."""
    return WORD.findall((text or "").lower())


def edits_allowed(words: int) -> int:
    """The edits that count as a copy: a fifth of the words, but so few that
    one run of three words stays whole."""
    k = int(EDIT_SHARE * words)
    while k and math.ceil((words - k) / (k + 1)) < RUN:
        k -= 1
    return k


def pieces(words: int) -> list[tuple[int, int]]:
    """(begin, end) of the pieces of an item whose windows are looked for.

    CGK strings drift apart with the number of edits, so long items are cut
    into g pieces of about equal size. Of k edits one piece has k / g at most,
    which is within a fifth of its own words, so no copy is lost."""
    g = -(-words // PIECE_WORDS)
    return [(words * i // g, words * (i + 1) // g) for i in range(g)]


def walk(windows: np.ndarray, seed: int) -> np.ndarray:
    """CGK strings of rows of word ids: 3 m places for windows of m words."""
    rows, m = windows.shape
    padded = np.hstack([windows, np.full((rows, 1), PAD, dtype=np.uint64)])
    at, every = np.zeros(rows, dtype=np.int64), np.arange(rows)
    out = np.empty((rows, 3 * m), dtype=np.uint64)
    for step in range(3 * m):
        now = padded[every, at]
        out[:, step] = now
        bit = _mix(now ^ _mix(np.full(1, seed * 100_003 + step + 1, dtype=np.uint64) * _M2)) & np.uint64(1)
        at = np.minimum(at + bit.astype(np.int64), m)
    return out


def bit_samples(strings: np.ndarray, seed: int) -> np.ndarray:
    """One hash of a few sampled places for each repetition. Places come from
    the first two thirds, which a walk fills before it can run out of words."""
    rng = np.random.default_rng([seed, strings.shape[1]])
    usable = max(1, 2 * strings.shape[1] // 3)
    out = np.empty((len(strings), SAMPLES_PER_WALK), dtype=np.uint64)
    for r in range(SAMPLES_PER_WALK):
        h = np.full(len(strings), r + 1 + 64 * seed, dtype=np.uint64)
        for place in rng.integers(0, usable, PLACES):
            h = _mix(h * _M1 + strings[:, place])
        out[:, r] = h
    return out


def edit_distances(texts: np.ndarray, items: np.ndarray) -> np.ndarray:
    """Least edits between each item (row) and any prefix of its text (row):
    all rows advance together through the table of the edit distance."""
    return _last_row(texts, items, np.arange(texts.shape[1] + 1), 1).min(axis=1)


def nearest_runs(texts: np.ndarray, items: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(edits, start) of the run of each text (row) that is nearest to its item
    (row), the first of those. A cell of the table holds edits times ``unit``
    plus the start, so that the least cell has the least start too."""
    unit = texts.shape[1] + 1
    return np.divmod(_last_row(texts, items, np.arange(unit), unit).min(axis=1), unit)


def _last_row(texts: np.ndarray, items: np.ndarray, first: np.ndarray, unit: int) -> np.ndarray:
    """The last row of the table of the edit distance, whose first row is given
    and where an edit costs ``unit``."""
    rows, width = texts.shape
    ways = np.arange(width + 1, dtype=np.int64) * unit
    last = np.broadcast_to(first, (rows, width + 1)).astype(np.int64)
    for i in range(items.shape[1]):
        now = np.empty_like(last)
        now[:, 0] = (i + 1) * unit
        now[:, 1:] = np.minimum(last[:, 1:] + unit, last[:, :-1] + (texts != items[:, i : i + 1]) * np.int64(unit))
        # a row's insertions: the least over earlier places plus the way from there
        last = np.minimum.accumulate(now - ways, axis=1) + ways
    return last


class Benchmark:
    """Items by size, their run places and their LSH buckets. Words that no
    item has are all one (``PAD``), which equals no word of an item."""

    def __init__(self, items: list[tuple[int | None, str | None]]):
        self.vocabulary: dict[str, int] = {}
        self.items: list[tuple[int | None, np.ndarray]] = []
        self.sizes: dict[int, np.ndarray] = {}
        #: Item and offset in it for each row of ``sizes``.
        self.places: dict[int, np.ndarray] = {}
        by_size = defaultdict(list)
        for item_id, text in items:
            words = words_of(text)
            if len(words) >= LEAST_WORDS:
                ids = [self.vocabulary.setdefault(w, xxhash.xxh3_64_intdigest(w.encode("utf-8", "replace")) or 1) for w in words]
                ids = np.array(ids, dtype=np.uint64)
                for begin, end in pieces(len(words)):
                    by_size[end - begin].append(((len(self.items), begin), ids[begin:end]))
                self.items.append((item_id, ids))
        found = []
        self.buckets: dict[int, list[tuple]] = {}
        for m, own in by_size.items():
            self.places[m], self.sizes[m] = np.array([p for p, _ in own]), np.stack([w for _, w in own])
            for w in self.sizes[m]:
                r = runs_at(w, np.arange(len(w) - RUN + 1))
                found += zip(r.tolist(), [m] * len(r), range(len(r)))
            self.buckets[m] = []
            for s in range(WALKS):
                for column in bit_samples(walk(self.sizes[m], SEED + s), SEED + s).T:
                    members = np.argsort(column, kind="stable")
                    keys, firsts = np.unique(column[members], return_index=True)
                    self.buckets[m].append((keys, np.r_[firsts, len(members)], members))
        found = sorted(set(found))
        self.run_keys, starts = np.unique(np.array([f[0] for f in found], dtype=np.uint64), return_index=True)
        self.run_starts = np.r_[starts, len(found)]
        self.run_sizes = np.array([f[1] for f in found], dtype=np.int64)
        self.run_places = np.array([f[2] for f in found], dtype=np.int64)

    def ids(self, text: str | None) -> np.ndarray:
        words = words_of(text)
        return np.fromiter(map(self.vocabulary.get, words, repeat(0)), dtype=np.uint64, count=len(words))

    def windows(self, ids: np.ndarray, begins: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """(size, starts) of the windows where an item may lie; ``begins``
        holds the document's first word for every word."""
        known = np.flatnonzero((ids[:-2] != PAD) & (ids[1:-1] != PAD) & (ids[2:] != PAD)) if len(ids) >= RUN else np.empty(0, dtype=np.int64)
        own = runs_at(ids, known)
        if not len(self.run_keys) or not len(own):
            return
        at = np.minimum(np.searchsorted(self.run_keys, own), len(self.run_keys) - 1)
        good = self.run_keys[at] == own
        hits, at = known[good], at[good]
        count = self.run_starts[at + 1] - self.run_starts[at]
        entry = np.repeat(self.run_starts[at], count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        hits = np.repeat(hits, count)
        sizes, starts = self.run_sizes[entry], hits - self.run_places[entry]
        for m in np.unique(sizes).tolist():
            own, k = sizes == m, edits_allowed(m)
            order = np.argsort(starts[own], kind="stable")
            place, begin = starts[own][order], begins[hits[own]][order]
            place, at = np.unique(place, return_index=True)
            counts, begin = np.diff(np.r_[at, len(begin)]), begin[at]
            before = np.r_[0, np.cumsum(counts)]
            # an edit before the first whole run shifts what the runs tell of the start
            tried, at = np.unique((place[:, None] + np.arange(-k, k + 1)).ravel(), return_index=True)
            near = before[np.searchsorted(place, tried + k, "right")] - before[np.searchsorted(place, tried - k, "left")]
            enough = near >= max(1, m - RUN + 1 - RUN * k)
            # a start before the document tells that its first words are missing
            yield m, np.unique(np.maximum(tried, begin[at // (2 * k + 1)])[enough])


def runs_at(ids: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Hashes of the runs that begin at some places."""
    out = np.zeros(len(places), dtype=np.uint64)
    for k in range(RUN):
        out = _mix(out * _M1 + ids[places + k])
    return out


def matches(benchmark: Benchmark, texts: list[str | None]) -> list[tuple[int, int | None, int, int]]:
    """(document, item id, start, edits) for every window that an item matches."""
    docs = [benchmark.ids(t) for t in texts]
    gap = 2 * max((len(w) for _, w in benchmark.items), default=0) + RUN
    # documents one after another, with room around them that fits no item
    room = np.full(gap, PAD, dtype=np.uint64)
    line = np.concatenate([room, *(np.r_[d, room] for d in docs)])
    lengths = np.array([len(d) + gap for d in docs])
    firsts = gap + np.cumsum(lengths) - lengths
    found = defaultdict(list)
    for m, starts in benchmark.windows(line, np.r_[np.zeros(gap, dtype=np.int64), np.repeat(firsts, lengths)]):
        for s in range(0, len(starts), WINDOWS):
            part = starts[s : s + WINDOWS]
            wide = line[part[:, None] + np.arange(m)]
            pairs = []
            for w in range(WALKS):
                strings = walk(wide, SEED + w)
                for r, column in enumerate(bit_samples(strings, SEED + w).T):
                    keys, firsts_of, members = benchmark.buckets[m][w * SAMPLES_PER_WALK + r]
                    at = np.minimum(np.searchsorted(keys, column), len(keys) - 1)
                    rows = np.flatnonzero(keys[at] == column)
                    count = firsts_of[at[rows] + 1] - firsts_of[at[rows]]
                    which = np.repeat(firsts_of[at[rows]], count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
                    pairs.append(np.repeat(rows, count) * len(benchmark.places[m]) + members[which])
            rows, of = np.divmod(np.unique(np.concatenate(pairs)), len(benchmark.places[m]))
            owners, offsets = benchmark.places[m][of].T
            for item, begin, d in zip(owners.tolist(), (part[rows] - offsets).tolist(), (np.searchsorted(firsts, part[rows], "right") - 1).tolist()):
                found[len(benchmark.items[item][1])].append((item, begin, d))
    out = set()
    for m, own in found.items():
        k, own = edits_allowed(m), np.unique(np.array(own), axis=0)
        rows = max(1, CELLS // (m + 2 * k))
        for t in range(0, len(own), rows):
            item, begin, d = own[t : t + rows].T
            # the start is at most k words away, and so is the end
            edits, starts = nearest_runs(line[begin[:, None] + np.arange(-k, m + k)], np.stack([benchmark.items[i][1] for i in item]))
            starts = np.maximum(begin - k + starts - firsts[d], 0)
            out.update((int(d[x]), benchmark.items[item[x]][0], int(starts[x]), int(edits[x])) for x in np.flatnonzero(edits <= k))
    return list(out)


@lru_cache(maxsize=1)
def _benchmark(items: tuple) -> Benchmark:
    """Built once per Python worker."""
    return Benchmark(list(items))


def _searched(items: tuple) -> Callable:
    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        benchmark = _benchmark(items)
        for batch in batches:
            for at in range(0, len(batch), BLOCK_DOCS):
                part = batch.iloc[at : at + BLOCK_DOCS]
                own = part["doc_id"].to_numpy()
                rows = [(own[d], item, start, edits) for d, item, start, edits in matches(benchmark, part["text"].tolist())]
                out = pd.DataFrame(rows, columns=["doc_id", "item_id", "start_word", "edits"])
                yield out.astype({"doc_id": "Int64", "item_id": "Int64", "start_word": "int64", "edits": "int64"})

    return search


def contaminated(docs: DataFrame, benchmark: DataFrame, pass_bytes: int = PASS_BYTES) -> DataFrame:
    """One row per document and benchmark item that it holds: ``doc_id,
    item_id, start_word, edits`` (the place with the fewest edits, the
    first of those).

    A match is a run of words that becomes the item by at most a fifth of the
    item's words in insertions, deletions and replacements; words are ``\\w+`` in
    lower case. Items with fewer than five words (null and empty ones too)
    match nothing; null and empty documents hold nothing. Rows that share an
    id are pooled under it. Other columns are ignored; without documents or
    items there are no rows.
    """
    need_columns(docs, "doc_id", "text")
    need_columns(benchmark, "item_id", "text")
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    passes = total // pass_bytes + 1
    out = None
    for p in range(passes):
        part = tuple(tuple(r) for r in items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(passes)) == p).collect())
        found = docs.mapInPandas(_searched(part), "doc_id bigint, item_id bigint, start_word bigint, edits bigint")
        out = found if out is None else out.union(found)
    best = F.min(F.struct("edits", "start_word"))
    return out.groupBy("doc_id", "item_id").agg(best.alias("best")).select("doc_id", "item_id", "best.start_word", "best.edits")
