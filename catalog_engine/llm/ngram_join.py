"""N-gram Jaccard join by T-occurrence search (operator 7).

Two documents link when the Jaccard similarity of their sets of word shingles
reaches a threshold. Spark groups the documents that can link at all, and in
each group DivideSkip searches the inverted lists: the short lists of a
document's shingles are merged and counted, the long ones probed by binary
search, and a partner must reach the overlap T that the threshold demands.

Grouping, without loss: two sets of at most ``s`` shingles that reach the
threshold differ in at most ``k`` shingles, so if shingles are dealt into
more than k parts by their hash, the sets agree on whole parts. Sets are compared
in classes of similar size; a set emits one signature (hash of a part's
content) for each part of its class, and for the next class if a partner there
is possible. Sets that share a signature fall into one candidate group; groups
that are large are parted by a prefix filter over exact counts of their
shingles (``_refined``). Equal sets are one set throughout, so copies cost
nothing.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from catalog_engine.llm.common import connected_components, cut, free_name, need_columns, release_tokenizers, stored

SHINGLE_WORDS = 3
#: Similarity in hundredths.
THRESHOLD = 90
#: Upper ends of neighbouring size classes differ by this factor.
CLASS_RATIO = 1.3
#: A class has so many parts that this many standard errors below the mean are
#: still enough filled ones.
FILLED_ERRORS = 2.0
#: Shingles of a candidate group that one task searches; larger groups are
#: split (see ``_split``).
GROUP_SHINGLES = 2_000_000

_M1, _M2, _M3 = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def shingle_set(text: str | None, words: int = SHINGLE_WORDS) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles of a whole text:
    words are runs without ASCII white space, A-Z in lower case; a text with
    fewer words is one shingle; without words the set is empty."""
    found = (text or "").encode("utf-8", "replace").lower().split()
    if not found:
        return np.empty(0, dtype=np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, found), dtype=np.uint64, count=len(found))
    width = min(words, len(h))
    count = len(h) - width + 1
    out = np.full(count, width, dtype=np.uint64)
    for k in range(width):
        out = _mix(out * _M1 + h[k : k + count])
    return np.unique(out)


def most_apart(size: int, threshold: int) -> int:
    """The most shingles in which two sets of at most ``size`` can differ.

    J >= t with |x| + |y| = S and difference H means (S - H) / (S + H) >= t,
    so H <= S (1 - t) / (1 + t), and S <= 2 size."""
    return 2 * size * (100 - threshold) // (100 + threshold)


@lru_cache
def size_classes(threshold: int) -> tuple[np.ndarray, list[int]]:
    """Upper ends of the size classes, and the parts of each.

    Small classes end where one more difference becomes possible, others a
    factor CLASS_RATIO above the last. Sets that differ in k shingles agree on all
    but k of P parts. With k + 1 parts the only agreement could be a part
    that is empty in both, which says nothing, so there are as many more
    parts as leave k + 1 of them filled in nearly every set of the class."""
    ends, parts = [0], []
    while ends[-1] < 1 << 40:
        apart = most_apart(ends[-1] + 1, threshold)
        # the last size at which no more than ``apart`` differences are possible
        same = ((apart + 1) * (100 + threshold) - 1) // (2 * (100 - threshold))
        ends.append(max(same, int(ends[-1] * CLASS_RATIO)))
        least, need = ends[-2] + 1, most_apart(ends[-1], threshold) + 1
        p = need
        while need > 1 and p < 2 * need + 2 and p * (1 - math.exp(-least / p)) - FILLED_ERRORS * math.sqrt(p * math.exp(-least / p)) < need:
            p += max(1, p // 100)
        parts.append(p)
    return np.array(ends[1:], dtype=np.int64), parts


def signatures(shingles: np.ndarray, threshold: int = THRESHOLD) -> np.ndarray:
    """The part signatures under which a set meets every partner: those of its
    filled parts, and of all parts if fewer than k + 1 are filled (then a
    partner may agree on empty ones alone, and has too few filled ones too)."""
    n = len(shingles)
    if not n:
        return np.empty(0, dtype=np.uint64)
    ends, counts = size_classes(threshold)
    at = int(np.searchsorted(ends, n))
    classes = [at]
    # a larger partner has at most n / t shingles
    while (int(ends[at]) + 1) * threshold <= n * 100:
        at += 1
        classes.append(at)
    mixed, out = _mix(shingles ^ _M2), []
    for c in classes:
        parts = counts[c]
        part = ((shingles >> np.uint64(16)) % np.uint64(parts)).astype(np.int64)
        content = np.zeros(parts, dtype=np.uint64)
        np.add.at(content, part, mixed)
        label = np.arange(parts, dtype=np.uint64) * _M3 + np.uint64((c + 1) * int(_M1) & 0xFFFFFFFFFFFFFFFF)
        sign = _mix(content ^ _mix(label))
        filled = np.bincount(part, minlength=parts) > 0
        out.append(sign[filled] if filled.sum() > most_apart(int(ends[c]), threshold) else sign)
    return np.concatenate(out)


#: Documents whose signatures are matched at once before they are shuffled.
BLOCK_DOCS = 1000
#: Signatures of at most so many documents give all their pairs, which are
#: tested one by one; those of more only tie their documents together.
SMALL = 4
HISTOGRAM = 64


def _described(words: int):
    """Per document the size, a 128-bit hash and a histogram of its set: the
    shingles in each of a few buckets by hash (the sum of the differences of two
    histograms is never above the number of shingles in which the sets differ)."""

    def describe(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        release_tokenizers()
        for batch in batches:
            keys, counts = [], []
            for text in batch["text"]:
                s = shingle_set(text, words)
                held = np.bincount((s >> np.uint64(40)).astype(np.int64) % HISTOGRAM, minlength=HISTOGRAM)
                counts.append(np.minimum(held, 65535).astype("<u2").tobytes())
                keys.append((len(s), *(int(_mix(s ^ m).sum(dtype=np.uint64)) for m in (_M2, _M3))))
            h = [np.array([k[i] for k in keys], dtype=np.uint64).view(np.int64) for i in (1, 2)]
            yield batch[["doc_id", "uid"]].assign(n=[k[0] for k in keys], h1=h[0], h2=h[1], histogram=counts)

    return describe


def _collapsed(uid: np.ndarray, signs: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The signatures of a block of documents as rows (place of the document,
    signature, documents it stands for), signatures as even numbers. One that more
    than a few documents of the block share goes on with the first of them and
    their number, and the others meet that one under an odd number of its own;
    so a hot signature costs a few rows per block."""
    every, of = np.concatenate(signs) & ~np.uint64(1), np.repeat(np.arange(len(signs)), [len(x) for x in signs])
    if not len(every):
        return of, every, np.empty(0, dtype=np.int32)
    _, first, group, size = np.unique(every, return_index=True, return_inverse=True, return_counts=True)
    stays, stands = size[group] <= SMALL, np.ones(len(every), dtype=np.int32)
    stays[first] = True
    stands[first] = np.where(size > SMALL, size, 1)
    lead = of[first[group]]
    met = np.unique(np.stack([of[~stays], lead[~stays]]), axis=1)
    own = _mix(uid.view(np.uint64) ^ _M1) | np.uint64(1)
    out = np.concatenate([of[stays], met[0], np.unique(met[1])])
    every = np.concatenate([every[stays], own[met[1]], own[np.unique(met[1])]])
    return out, every, np.concatenate([stands[stays], np.ones(len(every) - stays.sum(), dtype=np.int32)])


def _signed(threshold: int, words: int):
    """The part signatures of each document."""

    def sign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, len(batch), BLOCK_DOCS):
                part = batch.iloc[at : at + BLOCK_DOCS]
                uid, count = part["uid"].to_numpy(), len(part)
                of, every, stands = _collapsed(uid, [signatures(shingle_set(t, words), threshold) for t in part["text"]])
                order = np.argsort(of, kind="stable")
                ends = np.searchsorted(of[order], np.arange(count + 1))
                every, stands = every[order].view(np.int64), stands[order]
                yield pd.DataFrame({"uid": uid, "sign": [every[a:b] for a, b in zip(ends, ends[1:])], "stands": [stands[a:b] for a, b in zip(ends, ends[1:])]})

    return sign


def _possible(threshold: int):
    """Pairs whose histograms allow a link."""

    def keep(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            a, b = (np.frombuffer(b"".join(batch[c]), dtype="<u2").reshape(-1, HISTOGRAM).astype(np.int64) for c in ("a_histogram", "b_histogram"))
            most = (batch["a_n"] + batch["b_n"]).to_numpy() * (100 - threshold) // (100 + threshold)
            yield batch.loc[np.abs(a - b).sum(axis=1) <= most, ["uid", "other"]]

    return keep


class _Index:
    """Inverted lists over a few sets of one candidate group."""

    def __init__(self, sets: list[np.ndarray]):
        self.sets = sets
        self.sizes = np.array([len(s) for s in sets], dtype=np.int64)
        every = np.concatenate(sets) if sets else np.empty(0, dtype=np.uint64)
        owner = np.repeat(np.arange(len(sets), dtype=np.int64), self.sizes)
        order = np.argsort(every, kind="stable")
        every, self.postings = every[order], owner[order]
        starts = np.flatnonzero(np.r_[True, every[1:] != every[:-1]]) if len(every) else np.empty(0, dtype=np.int64)
        self.keys, self.starts = every[starts], starts
        self.lengths = np.diff(np.r_[starts, len(every)])

    def lists_of(self, shingles: np.ndarray) -> np.ndarray:
        """Positions of the inverted lists of those shingles that have one."""
        if not len(self.keys):
            return np.empty(0, dtype=np.int64)
        at = np.minimum(np.searchsorted(self.keys, shingles), len(self.keys) - 1)
        return at[self.keys[at] == shingles]

    def search(self, shingles: np.ndarray, threshold: int, skip: np.ndarray) -> np.ndarray:
        """Members that link with a set, without those that ``skip`` marks.

        T, the least overlap with any partner, is t times the set's size.
        The L = T - 1 longest lists are the long ones: a partner must occur
        on at least T - L = 1 of the short lists, whose merge so gives the
        candidates, and long lists are probed in the candidates alone."""
        need = -(-threshold * len(shingles) // 100)
        lists = self.lists_of(shingles)
        if len(lists) < need:
            return np.empty(0, dtype=np.int64)
        lists = lists[np.argsort(self.lengths[lists], kind="stable")]
        short, long = lists[: len(lists) - need + 1], lists[len(lists) - need + 1 :]
        merged = np.concatenate([self.postings[self.starts[i] : self.starts[i] + self.lengths[i]] for i in short])
        found, counts = np.unique(merged[~skip[merged]], return_counts=True)
        size = len(shingles)
        fits = (threshold * np.maximum(self.sizes[found], size) <= 100 * np.minimum(self.sizes[found], size)) & (counts + len(long) >= need)
        found, counts = found[fits], counts[fits]
        probes = self.keys[long]
        out = []
        for member, count in zip(found.tolist(), counts.tolist()):
            own = self.sets[member]
            at = np.minimum(np.searchsorted(own, probes), len(own) - 1)
            both = count + int((own[at] == probes).sum())
            if 100 * both >= threshold * (size + len(own) - both):
                out.append(member)
        return np.array(out, dtype=np.int64)


def _search_group(threshold: int, words: int):
    """Links of a group, as a forest: (a, b) join what is linked; a pair that
    earlier links already join is not looked at again."""

    def search(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("uid")
        ids, roles = rows["uid"].to_numpy(), rows["role"].to_numpy()
        sets = [shingle_set(t, words) for t in rows["text"]]
        index = _Index(sets)
        component = np.arange(len(sets))
        links = []
        for i in range(len(sets)):
            # in a pair of blocks only members of different blocks are compared
            skip = (component == component[i]) | ((roles == roles[i]) & (roles[i] != 0))
            if skip.all():
                continue
            for j in index.search(sets[i], threshold, skip):
                if component[i] != component[j]:
                    links.append((ids[i], ids[j]))
                    component[component == component[j]] = component[i]
        return pd.DataFrame(links, columns=["a", "b"]).astype("int64")

    return search


def _with_pivot(threshold: int, words: int):
    """Compares some members of a large group with its pivot."""

    def compare(members: pd.DataFrame, pivot: pd.DataFrame) -> pd.DataFrame:
        out = members[["group", "uid", "n", "class"]]
        if not len(members) or not len(pivot):
            return out.iloc[:0].assign(linked=False, apart=0.0)
        first, same = shingle_set(pivot["pivot_text"].iloc[0], words), []
        for text in members["text"]:
            own = shingle_set(text, words)
            both = len(np.intersect1d(own, first, assume_unique=True))
            union = len(own) + len(first) - both
            same.append((100 * both >= threshold * union, 1 - both / union))
        return out.assign(linked=[x[0] for x in same], apart=[x[1] for x in same])

    return compare


def _split(large: DataFrame, texts: DataFrame, limit: int, threshold: int, words: int) -> DataFrame:
    """Links within groups that are too large for one task.

    Every member is first compared with one, the pivot (of the size class that
    holds most), which takes one look per member. Jaccard distance is a metric:
    what is linked with the pivot needs comparing only with what is not, and
    only if the distances to the pivot differ by at most 1 - t. What remains
    is dealt into blocks of one size class; a pair of blocks of the same or of
    neighbouring classes is searched in a task of its own."""
    ends, _ = size_classes(threshold)
    # classes that a partner can be away: it has at most n / t shingles
    steps = max(int(np.searchsorted(ends, e * 100 // threshold)) - c for c, e in enumerate(ends[:-40].tolist()))
    large = large.withColumn("class", F.size(F.filter(F.array(*[F.lit(int(e)) for e in ends]), lambda e: e < F.col("n"))))
    heavy = large.groupBy("group", "class").agg(F.sum("n").alias("s"), F.min("uid").alias("uid"))
    heavy = heavy.groupBy("group").agg(F.max(F.struct("s", "uid"))["uid"].alias("pivot"), F.ceil(F.sum("s") / limit).cast("int").alias("shares"))
    heavy = cut(heavy)
    dealt = large.join(heavy.drop("pivot"), "group").withColumn("share", F.pmod(F.xxhash64("uid", F.lit(7)), F.col("shares")).cast("int"))
    dealt = dealt.join(texts, "uid").select("group", "share", "uid", "n", "class", "text")
    pivots = heavy.join(texts, F.col("pivot") == F.col("uid")).select(F.col("group").alias("of"), F.explode(F.expr("sequence(0, shares - 1)")).alias("part"), F.col("text").alias("pivot_text"))
    schema = "group bigint, uid bigint, n bigint, class int, linked boolean, apart double"
    compared = cut(dealt.groupBy("group", "share").cogroup(pivots.groupBy("of", "part")).applyInPandas(_with_pivot(threshold, words), schema))
    star = compared.where("linked").join(heavy, "group").select(F.col("uid").alias("a"), F.col("pivot").alias("b")).where("a != b")
    nearest = compared.where(~F.col("linked")).groupBy("group").agg(F.min("apart").alias("nearest"))
    rest = compared.join(nearest, "group").where(~F.col("linked") | (F.col("apart") >= F.col("nearest") - (100 - threshold) / 100 - 1e-9))
    blocks = cut(rest.groupBy("group", "class").agg(F.ceil(F.sum("n") * 2 / limit).cast("int").alias("blocks")))
    rest = rest.join(blocks, ["group", "class"]).withColumn("block", F.pmod(F.xxhash64("uid", F.lit(8)), F.col("blocks")).cast("int"))
    own = F.struct("class", "block")
    rest = rest.select("group", "uid", own.alias("own"), F.explode(F.array(*[F.col("class") + d for d in range(-steps, steps + 1)])).alias("class"))
    rest = rest.join(blocks, ["group", "class"])
    rest = rest.select("group", "uid", "own", "class", F.explode(F.expr("sequence(0, blocks - 1)")).alias("block")).select("group", "uid", "own", own.alias("other"))
    role = F.when(F.col("own") == F.col("other"), 0).when(F.col("own") < F.col("other"), 1).otherwise(2)
    pairs = rest.select("group", "uid", F.least("own", "other").alias("x"), F.greatest("own", "other").alias("y"), role.alias("role"))
    found = pairs.join(texts, "uid").groupBy("group", "x", "y").applyInPandas(_search_group(threshold, words), "a bigint, b bigint")
    return star.union(found)


def _ties(signed: DataFrame, about: DataFrame, threshold: int) -> DataFrame:
    """Edges (uid, first) between documents that share signatures, from rows
    (uid, sign, stands): signatures of up to SMALL documents give their pairs,
    of which the histograms in ``about`` leave the possible ones; those of more,
    and those that stand for a whole block's share, tie all their documents."""
    same, row = Window.partitionBy("sign"), Window.partitionBy("sign").orderBy("uid")
    tied = (F.sum("stands").over(same) > SMALL) | (F.col("sign").bitwiseAND(F.lit(1)) == 1)
    earlier = F.array(*[F.lag("uid", d).over(row) for d in range(1, SMALL)])
    met = signed.select("uid", tied.alias("tied"), F.first("uid").over(row).alias("first"), earlier.alias("earlier"))
    met = met.select("uid", "tied", F.explode(F.when(F.col("tied"), F.array("first")).otherwise(F.array_compact("earlier"))).alias("other"))
    met = cut(met.where("uid != other").distinct())
    side = lambda name, key: about.select(F.col("uid").alias(key), F.col("n").alias(f"{name}_n"), F.col("histogram").alias(f"{name}_histogram"))
    pairs = met.where("not tied").select("uid", "other").join(side("a", "uid"), "uid").join(side("b", "other"), "other")
    pairs = pairs.select("uid", "other", "a_n", "a_histogram", "b_n", "b_histogram").mapInPandas(_possible(threshold), "uid bigint, other bigint")
    return cut(met.where("tied").select("uid", F.col("other").alias("first")).union(pairs))


#: Blocks of a large group in which shingles are counted before the shuffle.
REFINE_BLOCKS = 8


def _counted(words: int):
    """How many sets of a block hold each shingle."""

    def count(rows: pd.DataFrame) -> pd.DataFrame:
        found, counts = np.unique(np.concatenate([shingle_set(t, words) for t in rows["text"]]), return_counts=True)
        return pd.DataFrame({"group": rows["group"].iloc[0], "block": rows["block"].iloc[0], "shingle": found.view(np.int64), "held": counts})

    return count


def _prefixes(threshold: int, words: int):
    """The prefix of each set of a block, as signatures: in the order of the
    group's counts, rarest first, two sets that link share one of their first
    n - T + 1 shingles, where T = t * n is the least overlap. A shingle that is
    not among the ``shared`` ones is in no other set. A signature also holds the
    size class, of the set and of the next one if a partner there is possible."""
    ends, _ = size_classes(threshold)

    def prefix(rows: pd.DataFrame, shared: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("uid")
        keys = shared["shingle"].to_numpy().astype(np.int64).view(np.uint64)
        order = np.argsort(keys)
        keys, held = keys[order], shared["held"].to_numpy()[order]
        signs = []
        for group, text in zip(rows["group"].to_numpy(), rows["text"]):
            own = shingle_set(text, words)
            n = len(own)
            at = np.minimum(np.searchsorted(keys, own), max(len(keys) - 1, 0))
            known = keys[at] == own if len(keys) else np.zeros(n, dtype=bool)
            # of the prefix only shared shingles can meet another set
            room = n - -(-threshold * n // 100) + 1 - int((~known).sum())
            first = own[known][np.lexsort((own[known], held[at[known]]))[: max(room, 0)]] if known.any() else own[:0]
            c = int(np.searchsorted(ends, n))
            classes = [c]
            while (int(ends[c]) + 1) * threshold <= n * 100:
                c += 1
                classes.append(c)
            mixed = _mix(first ^ _mix(np.array([group], dtype=np.int64).view(np.uint64) ^ _M2))
            signs.append(np.concatenate([_mix(mixed ^ np.uint64((c + 1) * int(_M1) & 0xFFFFFFFFFFFFFFFF)) for c in classes]))
        uid = rows["uid"].to_numpy()
        if not len(rows):
            return pd.DataFrame({"uid": [], "sign": [], "stands": []}).astype("int64")
        of, every, stands = _collapsed(uid, signs)
        return pd.DataFrame({"uid": uid[of], "sign": every.view(np.int64), "stands": stands})

    return prefix


def _refined(large: DataFrame, texts: DataFrame, about: DataFrame, limit: int, threshold: int, words: int) -> DataFrame:
    """Large groups (group, uid, n) parted by prefix filtering.

    Part signatures also agree by chance, where documents share a passage, and
    such ties add up to groups of documents that have nothing else in common.
    Here shingles are counted over all sets of a group, exactly, and only sets
    that share a shingle of their rarest ones stay together. Counts are added up
    in blocks first, so a shingle of all sets of a group costs a row per block."""
    shares = large.groupBy("group").agg(F.ceil(F.sum("n") * REFINE_BLOCKS / limit).cast("int").alias("shares"))
    dealt = large.join(shares, "group").withColumn("block", F.pmod(F.xxhash64("uid", F.lit(9)), F.col("shares")).cast("int"))
    dealt = stored(dealt.select("group", "block", "uid").join(texts, "uid").select("group", "block", "uid", "text"), "refine")
    held = dealt.groupBy("group", "block").applyInPandas(_counted(words), "group bigint, block int, shingle bigint, held bigint")
    held = held.withColumn("held", F.sum("held").over(Window.partitionBy("group", "shingle")))
    shared = held.where("held > 1").select("group", "block", "shingle", "held")
    signed = dealt.groupBy("group", "block").cogroup(shared.groupBy("group", "block")).applyInPandas(_prefixes(threshold, words), "uid bigint, sign bigint, stands int")
    near = _ties(signed, about, threshold)
    finer = connected_components(near, "uid", "first").select(F.col("id").alias("uid"), F.col("component").alias("group"))
    return cut(large.select("uid", "n").join(finer, "uid").select("group", "uid", "n"))


def _identified(docs: DataFrame) -> DataFrame:
    """(doc_id, uid, text); equal rows get equal numbers, as they have the same
    set and need no telling apart."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return docs.select("doc_id", F.xxhash64("doc_id", "text", F.length("text")).alias("uid"), "text")


def link_classes(docs: DataFrame, threshold: int = THRESHOLD, words: int = SHINGLE_WORDS, group_shingles: int = GROUP_SHINGLES) -> DataFrame:
    """One row per document: ``doc_id, n_shingles, component_id`` and
    ``set_id``.

    Documents link when 100 * intersection >= ``threshold`` * union of their
    shingle sets; ``component_id`` is the smallest doc_id reachable by links,
    ``set_id`` the smallest with the same set. A text without words (null,
    empty, white space) links with nothing. Rows that share a doc_id are
    treated as documents of their own that carry the same id. A null doc_id
    is kept, and is the component only of rows that reach no other id. Other
    columns are ignored; an empty table gives no rows.
    """
    need_columns(docs, "doc_id", "text")
    out = row_classes(_identified(docs), threshold, words, group_shingles)
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"), F.coalesce("set_id", "doc_id").alias("set_id"))


def one_of_each(docs: DataFrame, threshold: int = THRESHOLD, words: int = SHINGLE_WORDS, group_shingles: int = GROUP_SHINGLES) -> DataFrame:
    """The rows of ``docs`` without near copies: of each class the row with the
    least doc_id stays (a null id only where the class has no other). Texts
    without words are in no class and stay. Of rows with equal doc_id and text
    one stays, whatever their other columns."""
    need_columns(docs, "doc_id", "text")
    own = free_name(docs, "_uid")
    rows = row_classes(_identified(docs), threshold, words, group_shingles)
    place = F.struct(F.col("doc_id").isNull(), "doc_id", "uid")
    best = rows.groupBy(F.coalesce("class", "uid").alias("class")).agg(F.min(place)["uid"].alias(own)).select(own)
    marked = docs.withColumn(own, F.xxhash64(F.col("doc_id").cast("long"), F.col("text").cast("string"), F.length(F.col("text").cast("string"))))
    return marked.join(best, own, "left_semi").dropDuplicates([own]).select(*docs.columns)


def row_classes(docs: DataFrame, threshold: int, words: int, group_shingles: int) -> DataFrame:
    """(doc_id, uid, n, class, component_id, set_id) for rows (doc_id, uid,
    text); the last three are null for texts without words."""
    described = cut(docs.mapInPandas(_described(words), "doc_id bigint, uid bigint, n bigint, h1 bigint, h2 bigint, histogram binary"))
    linkable = described.where("n > 0")
    sets = cut(linkable.groupBy("n", "h1", "h2").agg(F.min("uid").alias("set_uid"), F.min("doc_id").alias("set_id")))
    # the texts are read once more, which is cheaper than to store signatures
    signed = docs.select("uid", "text").mapInPandas(_signed(threshold, words), "uid bigint, sign array<bigint>, stands array<int>")
    about = linkable.select("uid", "n", "histogram").dropDuplicates(["uid"])
    near = _ties(signed.select("uid", F.inline(F.arrays_zip("sign", "stands"))), about, threshold)
    set_of = linkable.join(sets, ["n", "h1", "h2"]).select("uid", "set_uid")
    near = near.join(set_of, "uid").select(F.col("first").alias("uid"), F.col("set_uid").alias("a")).join(set_of, "uid").select("a", F.col("set_uid").alias("b"))
    groups = connected_components(near, "a", "b").select(F.col("id").alias("set_uid"), F.col("component").alias("group"))
    # the text of a set is that of the row whose number the set has
    members = cut(groups.join(sets.select("set_uid", "n"), "set_uid").select("group", F.col("set_uid").alias("uid"), "n"))
    sizes = members.groupBy("group").agg(F.sum("n").alias("size"))
    texts = docs.join(members.select("uid"), "uid", "left_semi").select("uid", "text").dropDuplicates(["uid"])
    small = members.join(sizes.where(F.col("size") <= group_shingles), "group", "left_semi")
    large = cut(members.join(sizes.where(F.col("size") > group_shingles), "group", "left_semi"))
    if not large.isEmpty():
        # what hangs together by chance parts here, before any text is sent twice
        finer = _refined(large, texts, about, group_shingles, threshold, words)
        sizes = finer.groupBy("group").agg(F.sum("n").alias("size"))
        small = small.union(finer.join(sizes.where(F.col("size") <= group_shingles), "group", "left_semi"))
        large = cut(finer.join(sizes.where(F.col("size") > group_shingles), "group", "left_semi"))
    links = small.join(texts, "uid").select("group", "uid", F.lit(0).alias("role"), "text").groupBy("group").applyInPandas(_search_group(threshold, words), "a bigint, b bigint")
    if not large.isEmpty():
        links = links.union(_split(large, texts, group_shingles, threshold, words))
    linked = connected_components(cut(links), "a", "b").select(F.col("id").alias("set_uid"), "component")
    classes = sets.join(linked, "set_uid", "left").withColumn("component", F.coalesce("component", "set_uid"))
    smallest = classes.groupBy("component").agg(F.min("set_id").alias("component_id"))
    classes = classes.join(smallest, "component").select("n", "h1", "h2", F.col("component").alias("class"), "component_id", "set_id")
    return described.join(classes, ["n", "h1", "h2"], "left").select("doc_id", "uid", "n", "class", "component_id", "set_id")
