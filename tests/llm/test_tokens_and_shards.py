"""Sharding, packing, training order and token counts."""
import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from conftest import SF_SMALL
from tokenizers import Tokenizer

from catalog_engine.llm import ordered_shards, packing, sharding, token_rollup
from catalog_engine.llm.common import cached_tokenizer, numbered, tokenizer_path

DOCS = "doc_id long, text string, source string, lang string"
ODD = [
    (1, "one two three", "a", "en"), (1, "one two three", "a", "en"), (2, None, None, None), (3, "", "a", "en"), (None, "É<|endoftext|>x", "b", "fr"),
    (None, None, "b", "fr"), (4, "don't  STOP\n\n12 ½ ", "b", "de"), (5, "日本語 テキスト", "c", "ja"), (6, "word " * 9000, "c", "en"), (7, "x" * 5000, "c", "en"),
]


@pytest.fixture(scope="module")
def model():
    return Tokenizer.from_file(tokenizer_path())


def ids_of(model, text):
    return model.encode(text or "", add_special_tokens=False).ids


def test_cached_tokenizer_is_the_tokenizer(spark, model):
    rng = random.Random(1)
    texts = [r.text for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()] + [t for _, t, _, _ in ODD]
    texts += ["".join(chr(rng.randrange(256)) for _ in range(40)) for _ in range(500)] + ["".join(rng.choice("'sStredvmll 1²½éÉßµªº\xa0\x85\x1c!?.İΣ́") for _ in range(40)) for _ in range(500)]
    cached = cached_tokenizer(tokenizer_path())
    cached.MAX_WORDS = 700  # so that the cache is emptied on the way
    try:
        got = [np.frombuffer(b, "<u4").tolist() for k in range(0, len(texts), 50) for b in cached.ids(texts[k : k + 50])]
    finally:
        del cached.MAX_WORDS
    assert got == [ids_of(model, t) for t in texts]


def test_numbered(spark):
    df = spark.range(1000).selectExpr("id * 7919 % 1000 as v").repartition(5)
    assert sorted((r.v, r.n) for r in numbered(df, ["v"], "n").collect()) == [(i, i) for i in range(1000)]


def brute_shards(rows, shards, seed):
    md5 = lambda d: hashlib.md5(f"{seed}:{'null' if d is None else d}".encode()).hexdigest()
    raw = lambda t: (t or "").encode()
    key = lambda s: "n" if s is None else "v" + s
    rows = [(key(s), md5(d), -1 if d is None else d, len(raw(t)) + 8, zlib.crc32(raw(t))) for d, t, s in rows]
    sizes, ranked = Counter(r[0] for r in rows), []
    place = Counter()
    for r in sorted(rows):
        ranked.append(((place[r[0]] + 0.5) / sizes[r[0]], *r))
        place[r[0]] += 1
    n, out, begun = len(rows), [], Counter()
    for i, r in enumerate(sorted(ranked)):
        shard = i * shards // n
        out.append((r[3], r[4], r[5], shard, begun[shard]))
        begun[shard] += 1
    return sorted(out)


def test_shards_are_brute_force(spark):
    docs = [(r.doc_id, r.text, r.source) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()] + [r[:3] for r in ODD]
    for rows, shards in ((docs, 24), (docs[:5], 24), (docs, 1)):
        out = sharding.shard(spark.createDataFrame(rows, "doc_id long, text string, source string"), shards).collect()
        assert sorted((-1 if r.doc_id is None else r.doc_id, r["size"], r.text_crc32, r.shard, r.slot) for r in out) == brute_shards(rows, shards, sharding.SEED)
    out = sharding.shard(spark.createDataFrame(docs, "doc_id long, text string, source string")).toPandas()
    counts = out.groupby("shard").size()
    assert counts.max() - counts.min() <= 1 and len(counts) == 24
    mixture = out.groupby(["source", "shard"], dropna=False).size().unstack(fill_value=0)
    assert (mixture.max(axis=1) - mixture.min(axis=1)).max() <= 2
    assert sharding.shard(spark.createDataFrame([], "doc_id long, text string, source string, shard int")).count() == 0


def test_best_fit_never_overfills():
    rng = random.Random(2)
    for _ in range(50):
        sizes = [rng.randint(1, 64) for _ in range(rng.randint(0, 200))]
        bins = packing.best_fit(sizes, 64)
        assert sorted(i for b in bins for i in b) == list(range(len(sizes)))
        assert all(sum(sizes[i] for i in b) <= 64 for b in bins)


@pytest.mark.parametrize(("capacity", "group_items"), [(4096, 50_000), (128, 20)])
def test_packing_is_whole(spark, model, capacity, group_items):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()] + [r[:2] for r in ODD]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = packing.pack(docs, capacity, group_items=group_items).collect()
    want = []
    for doc_id, text in rows:
        ids = [*ids_of(model, text), 1]
        want += [(doc_id, k, s, len(ids[s : s + capacity]), zlib.crc32(np.array(ids[s : s + capacity], "<u4").tobytes())) for k, s in enumerate(range(0, len(ids), capacity))]
    key = lambda r: tuple(-1 if v is None else v for v in r)
    assert sorted(map(key, (r[:5] for r in got))) == sorted(map(key, want))
    by: dict = {}
    for r in got:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for pieces in by.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= capacity
    least = -(-sum(w[3] for w in want) // capacity)
    assert len(by) <= least * 1.02 + 2
    assert packing.pack(spark.createDataFrame([], "doc_id long, text string, size int")).count() == 0


def test_feistel_is_a_permutation():
    for n in (1, 2, 3, 5, 16, 17, 1000, 4097):
        got = ordered_shards.permuted(np.arange(n), n)
        assert sorted(got.tolist()) == list(range(n))
    assert (ordered_shards.permuted(np.arange(1000), 1000, 1) != ordered_shards.permuted(np.arange(1000), 1000, 2)).any()


def test_training_order_round_trip(spark, model):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()] + [r[:2] for r in ODD]
    path = ordered_shards.shards_folder(spark)
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    report = ordered_shards.materialise(docs, path, length=64, per_shard=100).orderBy("slot").collect()
    stream = []
    for _, text in rows:
        stream += [*ids_of(model, text), 1]
    n = -(-len(stream) // 64)
    stream += [0] * (n * 64 - len(stream))
    slots = ordered_shards.permuted(np.arange(n), n)
    want = {int(s): stream[64 * k : 64 * k + 64] for k, s in enumerate(slots)}
    assert [r.slot for r in report] == list(range(n))
    got = list(ordered_shards.read_slots(path, 0, n + 5, 64, 100))
    assert [g.tolist() for g in got] == [want[s] for s in range(n)]
    assert [g.tolist() for g in ordered_shards.read_slots(path, 97, 10, 64, 100)] == [want[s] for s in range(97, 107)]
    assert all(r.ids_crc32 == zlib.crc32(np.array(want[r.slot], "<u2").tobytes()) and (r.shard, r.byte_offset) == (r.slot // 100, r.slot % 100 * 128) for r in report)
    assert sum(r.n_tokens for r in report) == sum(len(ids_of(model, t)) + 1 for _, t in rows)
    assert {d for r in report for d in r.doc_ids} == {d for d, _ in rows}
    assert ordered_shards.materialise(spark.createDataFrame([], "doc_id long, text string, slot int"), ordered_shards.shards_folder(spark)).count() == 0


def totals(rows, model):
    out: Counter = Counter()
    for _, text, source, lang in rows:
        for name, n in (("word_bpe_49k", len(ids_of(model, text))), ("words-1", len((text or "").encode().split()))):
            for k, v in (("d", 1), ("t", n), ("b", len((text or "").encode()))):
                out[source, lang, name, k] += v
    return out


def as_counter(df):
    out: Counter = Counter()
    for r in df.collect():
        for k, v in (("d", r.n_docs), ("t", r.n_tokens), ("b", r.n_bytes)):
            out[r.source, r.lang, r.tokenizer, k] += v
    return out


def test_rollup_follows_changes(spark, model, tmp_path):
    state = token_rollup.TokenRollup(spark, f"{tmp_path}/state")
    change = lambda op, rows: spark.createDataFrame([(op, *r) for r in rows], f"op string, {DOCS}")
    assert state.totals().count() == 0
    assert state.apply(1, change("insert", ODD))
    assert as_counter(state.totals()) == totals(ODD, model)
    second = change("delete", [(4, None, None, None), (99, None, None, None)]).union(change("revise", [(1, "new", "z", "en")]))
    assert state.apply(2, second)
    now = [r for r in ODD if r[0] not in (1, 4)] + [(1, "new", "z", "en")]
    assert as_counter(state.totals()) == totals(now, model)
    assert not state.apply(2, second) and not state.apply(1, change("insert", ODD))
    assert as_counter(state.totals()) == totals(now, model)
    # a batch that broke off before its mark is not there, and is written anew
    broken = change("insert", [(50, "later", "z", "en")])
    broken.limit(0).selectExpr("doc_id", "source", "lang", "op as tokenizer", "1L as n_docs", "1L as n_tokens", "1L as n_bytes").write.parquet(f"{tmp_path}/state/ledger/batch=3")
    assert as_counter(state.totals()) == totals(now, model)
    assert state.apply(3, broken)
    assert as_counter(state.totals()) == totals([*now, (50, "later", "z", "en")], model)
    with pytest.raises(Exception, match="unknown op"):
        state.apply(4, change("replace", ODD))
    assert as_counter(state.totals()) == totals([*now, (50, "later", "z", "en")], model)


def test_rollup_query_is_brute_force(spark, model, tmp_path):
    import re

    rows = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text", "source", "lang").collect()]
    first: dict = {}
    for r in rows:
        first[r[1]] = min(first.get(r[1], r[0]), r[0])
    left = [(d, re.sub(token_rollup.EMAIL, "<email>", t), s, lang) for d, t, s, lang in rows if first[t] == d]
    got = token_rollup.rollup(spark.createDataFrame(rows, DOCS), f"{tmp_path}/r")
    assert +as_counter(got) == +totals(left, model)
