"""Vector and shingle joins against brute force."""
import numpy as np
import pytest
from pyspark.sql import functions as F

from catalog_engine.llm import embedding_dedup, ngram_join
from catalog_engine.llm.common import connected_components
from conftest import SF_SMALL


def classes(n, pairs):
    up = list(range(n))
    for a, b in pairs:
        x, y = up[a], up[b]
        if x != y:
            up = [min(x, y) if u in (x, y) else u for u in up]
    return up


def brute_words(text):
    words, now = [], bytearray()
    for b in (text or "").encode():
        if b in b" \t\n\v\f\r":
            if now:
                words.append(bytes(now))
            now = bytearray()
        else:
            now.append(b + 32 if 65 <= b <= 90 else b)
    return words + ([bytes(now)] if now else [])


def brute_sets(texts):
    out = []
    for t in texts:
        w = brute_words(t)
        out.append({tuple(w[i : i + 3]) for i in range(max(1, len(w) - 2))} if w else set())
    return out


def brute_links(sets):
    sizes = [len(s) for s in sets]
    return [
        (i, j) for i in range(len(sets)) for j in range(i)
        if sizes[i] and sizes[j] and 10 * min(sizes[i], sizes[j]) >= 9 * max(sizes[i], sizes[j]) and 100 * len(sets[i] & sets[j]) >= 90 * len(sets[i] | sets[j])
    ]


def test_components(spark):
    rng = np.random.default_rng(3)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 400, (260, 2))] + [(i, i + 1) for i in range(1000, 1060)] + [(2000, i) for i in range(1900, 1990)]
    ids = sorted({x for e in edges if e[0] != e[1] for x in e})
    up = classes(len(ids), [(ids.index(a), ids.index(b)) for a, b in edges if a != b])
    got = connected_components(spark.createDataFrame(edges, "a long, b long"), "a", "b")
    assert {tuple(r) for r in got.collect()} == {(i, ids[u]) for i, u in zip(ids, up)}


@pytest.mark.parametrize("group_shingles", [ngram_join.GROUP_SHINGLES, 300])
def test_ngram_join_is_brute_force(spark, group_shingles):
    rng = np.random.default_rng(1)
    texts = [r.text for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").limit(120).collect()]
    vocabulary = [f"w{i}" for i in range(300)]
    base = list(rng.choice(vocabulary, 80))
    for k in range(90):  # one large group of near copies, at all distances around the threshold
        copy = list(base)
        for _ in range(k % 7):
            copy[int(rng.integers(80))] = f"x{rng.integers(1000)}"
        texts.append(" ".join(copy))
    for n in (1, 2, 3, 4, 9, 10, 11, 12, 13, 30):
        w = list(rng.choice(vocabulary, n))
        texts += [" ".join(w), " ".join(w).upper(), "\t\n" + "  ".join(w) + " ", " ".join(w[:-1] + ["other"]), " ".join([*w, "more"])]
    texts += [None, "", "  \n", "É é", "é é", "a b"]
    rows = [(i * 3 % 1009, t, "x") for i, t in enumerate(texts)]
    out = ngram_join.link_classes(spark.createDataFrame(rows, "doc_id long, text string, n string"), group_shingles=group_shingles).collect()
    sets = brute_sets(texts)
    up = classes(len(texts), brute_links(sets))
    smallest = {u: min(rows[i][0] for i in range(len(texts)) if up[i] == u) for u in set(up)}
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in out) == sorted((rows[i][0], len(sets[i]), smallest[up[i]]) for i in range(len(texts)))


def test_ngram_join_edges(spark):
    schema = "doc_id long, text string"
    assert ngram_join.link_classes(spark.createDataFrame([], schema)).count() == 0
    rows = [(1, "a b c d"), (1, "a b c d"), (None, "a b c d"), (7, None), (7, "A B C  D"), (None, None)]
    out = ngram_join.link_classes(spark.createDataFrame(rows, schema)).collect()
    assert sorted((r.doc_id or -1, r.n_shingles, r.component_id or -1) for r in out) == [(-1, 0, -1), (-1, 2, 1), (1, 2, 1), (1, 2, 1), (7, 0, 7), (7, 2, 1)]


def test_signatures_meet_every_partner():
    rng = np.random.default_rng(2)
    for n in [1, 2, 5, 9, 10, 11, 19, 20, 21, 60, 200, 1000]:
        for _ in range(25):
            s = np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64))
            drop = rng.integers(0, n // 10 + 1)
            add = rng.integers(0, n // 10 + 1)
            t = np.unique(np.r_[s[drop:], rng.integers(0, 1 << 63, add, dtype=np.uint64)])
            both = len(np.intersect1d(s, t))
            if 100 * both >= 90 * (len(s) + len(t) - both):
                assert len(np.intersect1d(ngram_join.signatures(s), ngram_join.signatures(t)))


def test_ngram_join_links_families_over_blocks(spark, monkeypatch):
    """A text that is not the first of its block links with its variants in the
    next; the first of the two blocks differ too much to link."""
    monkeypatch.setattr(ngram_join, "BLOCK_DOCS", 24)
    base, variants = [f"w{i}" for i in range(200)], []
    for k in range(47):
        copy = list(base)
        for at in (0, 31, 62):
            copy[100 * (k >= 23) + 3 + (4 * k + at) % 94] = f"e{k}"
        variants.append(" ".join(copy))
    texts = [*variants[:23], " ".join(base), *variants[23:]]
    assert {(j, i) for i, j in brute_links(brute_sets(texts)) if j < 24 <= i} == {(23, i) for i in range(24, 48)}
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    assert {r.component_id for r in ngram_join.link_classes(docs).collect()} == {0}


def test_large_groups_part_where_only_a_passage_is_shared(spark):
    """One group by chance: the texts share a passage, two also all else but a word."""
    passage = [f"p{i}" for i in range(60)]
    texts = [" ".join([f"d{k}w{i}" for i in range(40)] + passage) for k in range(30)]
    texts += [texts[7] + " more", None, ""]
    rows = [(100 + k, 0, t) for k, t in enumerate(texts) if t]
    docs = spark.createDataFrame([(u, t) for u, _, t in rows], "doc_id long, text string").select("doc_id", F.col("doc_id").alias("uid"), "text")
    about = docs.mapInPandas(ngram_join._described(3), "doc_id bigint, uid bigint, n bigint, h1 bigint, h2 bigint, histogram binary").select("uid", "n", "histogram")
    large = about.select(F.lit(0).cast("long").alias("group"), "uid", "n")
    got = ngram_join._refined(large, docs.select("uid", "text"), about, 1000, 90, 3).collect()
    assert sorted(r.uid for r in got) == [107, 130] and len({r.group for r in got}) == 1


def brute_vectors(rows, cosine):
    good = [i for i, (_, v) in enumerate(rows) if v and None not in v and np.isfinite(np.array(v, float)).all() and np.any(np.array(v, float))]
    links = []
    for x, i in enumerate(good):
        for j in good[:x]:
            a, b = (np.array(rows[k][1], np.float32).astype(float) for k in (i, j))
            if len(a) == len(b) and a @ b / np.sqrt((a @ a) * (b @ b)) >= cosine:
                links.append((i, j))
    return links


@pytest.mark.parametrize("chunk_rows", [4096, 7])
def test_vectors_are_brute_force(spark, chunk_rows):
    rng = np.random.default_rng(4)
    rows = [(int(r.vec_id), list(r.embedding)) for r in spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").collect()]
    dims, top = len(rows[0][1]), max(r[0] for r in rows) + 1
    centre = rng.standard_normal(dims)
    rows += [(top + k, (centre + rng.standard_normal(dims) * 0.17 * (k % 5) / 4).tolist()) for k in range(80)]
    copies = rows[3][1]
    rows += [(top + 100 + k, list(copies)) for k in range(5)] + [(top + 200, [x * 2 for x in copies]), (top + 201, None), (top + 202, [0.0] * dims), (top + 203, [float("nan")] * dims), (top + 204, [float("inf")] + copies[1:]), (top + 205, [None] + copies[1:]), (top + 206, []), (top + 207, copies[:10]), (top + 208, [1.0, 2.0]), (top + 209, [2.0, 4.0])]
    links = brute_vectors(rows, 0.95)
    up = classes(len(rows), links)
    smallest = {u: min(rows[i][0] for i in range(len(rows)) if up[i] == u) for u in set(up)}
    count = np.bincount(np.array(links).ravel(), minlength=len(rows))
    assert count.max() > 15
    got = embedding_dedup.link_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), chunk_rows=chunk_rows).collect()
    want = [(rows[i][0], int(count[i]), smallest[up[i]], rows[i][0] == smallest[up[i]]) for i in range(len(rows))]
    assert sorted(map(tuple, got)) == sorted(want)


def test_vectors_edges(spark):
    schema = "vec_id long, embedding array<float>, block int, cell long"
    assert embedding_dedup.link_vectors(spark.createDataFrame([], schema)).count() == 0
    rows = [(1, [1.0, 0.0], 0, 0), (1, [1.0, 0.0], 0, 0), (None, [1.0, 0.0], 0, 0), (None, [0.0, 1.0], 0, 0), (4, [float("nan"), 1.0], 0, 0)]
    got = embedding_dedup.link_vectors(spark.createDataFrame(rows, schema)).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, [(1, 2, 1, True), (1, 2, 1, True), (None, 2, 1, False), (None, 0, None, True), (4, 0, 4, True)]))
