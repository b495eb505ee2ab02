"""Source divergence audit, document fingerprints and conversation repair against brute force."""
import hashlib
import random
import re
import zlib
from collections import Counter

import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F

from catalog_engine.llm import conversation_repair, divergence_audit, fingerprints

DOCS = "doc_id long, text string, lang string, source string"
WORDS = "alpha beta gamma delta élan Straße ÉTÉ über x".split()


def odd_documents():
    rng = random.Random(5)
    rows = [(i, " ".join(rng.choices(WORDS, k=rng.randint(0, 12))) + rng.choice([".", "-1 a_b", " 日本", ""]), rng.choice(["en", "de"]), rng.choice("abcdef")) for i in range(60)]
    rows += [(100, None, None, None), (101, "alpha beta", None, "a"), (102, "", "fr", "a"), (103, None, "fr", "b"), (104, "42 !", "fr", "c"), (105, "solo " * 30_000, "en", "a")]
    return rows + [rows[0], rows[0], rows[-1]]


def brute_audit(rows, min_docs, ranks):
    docs = [(lang or "", source or "", re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))) for _, text, lang, source in rows]
    out = []
    for lang in {d[0] for d in docs}:
        mine = [d for d in docs if d[0] == lang]
        held = Counter(t for d in mine for t in set(d[2]))
        kept = [t for t, n in held.items() if n >= min_docs]
        groups = {s: Counter() for _, s, _ in mine}
        for _, s, terms in mine:
            groups[s].update(t for t in terms if held[t] >= min_docs)

        def shares(c):
            total = sum(c.values()) + len(kept)
            return {t: 1 + 10**9 * (c[t] + 1) // total for t in kept}

        p, q = {s: shares(c) for s, c in groups.items()}, shares(sum(groups.values(), Counter()))
        f = lambda a, b: (a - b) * (a - b) // b
        for s in groups:
            pairs = [(o, sum(f(p[s][t], p[o][t]) for t in kept)) for o in groups if o != s]
            terms = [(t, f(p[s][t], q[t])) for t in kept if groups[s][t] and p[s][t] > q[t]]
            for part, found in (("pair", pairs), ("term", terms)):
                found.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, item, value, k + 1) for k, (item, value) in enumerate(found) if part == "pair" or k < ranks]
    return sorted(out)


@pytest.mark.parametrize(("block_groups", "block_terms", "ranks"), [(32, 2048, 200), (2, 3, 2), (1, 1, 200)])
def test_audit_is_brute_force(spark, block_groups, block_terms, ranks):
    rows = odd_documents()
    docs = spark.createDataFrame(rows, DOCS).withColumn("term", F.lit(1)).withColumn("n", F.lit("x")).withColumn("rank", F.lit(0)).repartition(3)
    got = divergence_audit.audit(docs, 3, ranks, block_groups, block_terms).collect()
    assert sorted(tuple(r) for r in got) == brute_audit(rows, 3, ranks)


def test_audit_edges(spark, monkeypatch):
    assert divergence_audit.audit(spark.createDataFrame([], DOCS)).count() == 0
    # counts beyond 64 bits times the unit, in the shares of SQL and of the cells
    row = spark.range(1).selectExpr("30000000000L as n", "30000000000L as total", "5L as terms")
    assert row.select(divergence_audit._share("n", "total", "terms").alias("p")).first().p == 1 + 10**9 * 30_000_000_001 // 30_000_000_005
    import pandas as pd
    cell = pd.DataFrame({
        "lang": "en", "a": 0, "b": 0, "t": 0, "source": ["x", "y", "x", "y"], "own": 0, "n": [None, None, 20_000_000_000, 3], "term": [None, None, b"k", b"k"],
        "total": [20_000_000_000, 3, None, None], "terms": [2, 2, None, None], "terms_here": [2, 2, None, None],
    })
    p = lambda n, total: 1 + 10**9 * (n + 1) // (total + 2)
    x, y = [p(20_000_000_000, 20_000_000_000), p(0, 20_000_000_000)], [p(3, 3), p(0, 3)]
    want = {"x": sum((a - b) ** 2 // b for a, b in zip(x, y)), "y": sum((b - a) ** 2 // a for a, b in zip(x, y))}
    assert {r.source: r.value for r in divergence_audit._cell(cell).itertuples()} == want


def brute_vector(text):
    wide = [0] * 16
    for p in text.split("\n"):
        hexed = "".join(hashlib.sha256((salt + p).encode()).hexdigest() for salt in "ab")
        wide = [(w + int(hexed[8 * k : 8 * k + 8], 16)) % 2**32 for k, w in enumerate(wide)]
    clauses = [c.strip(" ") for c in re.split("[.!?,;:。！？，、；：\n]+", text)]
    signs = [0] * 128
    for c in filter(None, clauses):
        h = hashlib.md5(c.encode()).hexdigest()
        for lane in range(128):
            signs[lane] += 1 if int(h[8 * (lane // 32) : 8 * (lane // 32) + 8], 16) >> (lane % 32) & 1 else -1
    return "".join(f"{w:08X}" for w in wide) + "".join(f"{s % 65536:04X}" for s in signs), signs


def brute_near(a, b):
    both, norms = 2 * sum(x * y for x, y in zip(a, b)), sum(x * x + y * y for x, y in zip(a, b))
    return min(1.0, max(0.0, both / norms)) if norms else 1.0


def brute_fingerprints(rows):
    rows = [(d, t or "") for d, t in rows]
    md5 = lambda d, t: hashlib.md5(f"{'null' if d is None else d}:{t}".encode()).digest()
    rows.sort(key=lambda r: (r[0] is not None, -(r[0] or 0), md5(*r)))
    out = []
    for k, (d, t) in enumerate(rows):
        follower, take = rows[(k + 1) % len(rows)][1], len(t) // 2
        edited = t[: len(t) - take] + follower[:take]
        (own, s), (new, e) = brute_vector(t), brute_vector(edited)
        out.append((d, len(t), hashlib.sha256(edited.encode()).hexdigest(), own, new, brute_near(s, e), brute_near(s, brute_vector(follower)[1])))
    return out


ODD_TEXTS = [
    (1, "one, two. three\nfour"), (1, "one, two. three\nfour"), (1, "one, two. three\nfour"), (2, None), (3, ""), (4, "   "), (None, "É 日本語。テキスト, ok"), (None, None),
    (5, "four\none, two. three"), (6, "x"), (7, "clause %d. " * 3 % (1, 2, 3)), (8, "\n".join(f"line {i}; part {i % 7}" for i in range(6000))), (9, "word " * 9000), (-5, "neg, ative"),
]


def test_fingerprints_are_brute_force(spark):
    order = lambda r: tuple((v is None, v) for v in r)
    for rows in (ODD_TEXTS, ODD_TEXTS[:1], [ODD_TEXTS[0]] * 4):
        docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("key", F.lit("k")).withColumn("copies", F.lit(9)).repartition(4)
        got = fingerprints.fingerprints(docs).collect()
        assert sorted((tuple(r) for r in got), key=order) == sorted(brute_fingerprints(rows), key=order)
    assert fingerprints.fingerprints(spark.createDataFrame([], "doc_id long, text string, key int")).count() == 0


def test_fingerprint_likeness_is_near_the_shared_part(spark):
    """Against the exact 2 <a, b> / (<a, a> + <b, b>) of the clause counts."""
    clauses = lambda text: Counter(filter(None, (c.strip(" ") for c in re.split("[.!?,;:\n]+", text))))

    def exact(a, b):
        a, b = clauses(a), clauses(b)
        norms = sum(n * n for c in (a, b) for n in c.values())
        return 2 * sum(n * b[c] for c, n in a.items()) / norms if norms else 1.0

    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text")
    got = {r.doc_id: r for r in fingerprints.fingerprints(docs).collect()}
    rows = sorted(((r.doc_id, r.text) for r in docs.collect()), reverse=True)
    off, edited = [], []
    for k, (i, text) in enumerate(rows):
        follower, take = rows[(k + 1) % len(rows)][1], len(text) // 2
        new = text[: len(text) - take] + follower[:take]
        off += [abs(exact(text, new) - got[i].near_edited), abs(exact(text, follower) - got[i].near_next)]
        edited.append((got[i].near_edited, got[i].near_next))
    assert sum(off) / len(off) < 0.06 and max(off) < 0.4
    assert sum(e > n for e, n in edited) / len(edited) > 0.9
    assert len({r.fingerprint for r in got.values()}) == len({t for _, t in rows})


def test_fingerprints_take_inserts_and_deletes(spark):
    texts = [(1, "a, b\nc\nd"), (2, "x"), (None, "n\nm"), (4, "left alone")]
    prints = spark.createDataFrame(texts, "doc_id long, text string").select("doc_id", fingerprints.vector(F.col("text")).alias("vec"))
    changes = [(1, "c", -1), (1, "new, one", 1), (1, "c", 1), (1, "d", -1), (2, "x", 1), (2, None, 1), (None, "m", -1), (3, "fresh", 1)]
    after = fingerprints.update(prints, spark.createDataFrame(changes, "doc_id long, paragraph string, sign int").repartition(3))
    got = {r.doc_id: r.d for r in after.select("doc_id", fingerprints.digest(F.col("vec")).alias("d")).collect()}
    # the order of the paragraphs does not matter
    assert got == {i: brute_vector(t)[0] for i, t in {1: "new, one\nc\na, b", 2: "\nx\nx", None: "n", 3: "fresh", 4: "left alone"}.items()}
    v = lambda t: fingerprints.vector(F.lit(t))
    row = spark.range(1).select(
        fingerprints.digest(fingerprints.plus(v("a\nb"), v("c"))).alias("p"), fingerprints.digest(fingerprints.minus(v("a\nc\nb"), v("c"))).alias("m"),
    ).first()
    assert (row.p, row.m) == (brute_vector("c\nb\na")[0], brute_vector("b\na")[0])


def brute_audit_string(codes):
    """Least (cost, letters) of all edits, tried one by one."""
    best = None

    def tried(i, roles, cost, letters, inserts):
        nonlocal best
        if best and cost > best[0]:
            return
        if inserts < 2:
            for r in "ua":
                tried(i, roles + r, cost + 2, letters + "I", inserts + 1)
        if i == len(codes):
            if re.fullmatch("(s?(ua)+)?", roles) and (best is None or (cost, letters) < best):
                best = (cost, letters)
            return
        more = 1 if codes[i] & 8 else 0
        if not codes[i] & 4:
            tried(i + 1, roles + "xsua"[codes[i] & 3], cost + more, letters + "K", 0)
            for r in "ua":
                tried(i + 1, roles + r, cost + 2 + more, letters + "R", 0)
        tried(i + 1, roles, cost + 3, letters + "D", 0)

    tried(0, "", 0, "", 0)
    return best


def some_codes(rng, most):
    return bytes(rng.choice([0, 1, 2, 2, 2, 3, 3, 3]) | (4 if rng.random() < 0.2 else 0) | (8 if rng.random() < 0.2 else 0) for _ in range(rng.randint(0, most)))


def test_cheapest_edits_are_brute_force():
    rng = random.Random(1)
    for _ in range(200):
        codes = some_codes(rng, 4)
        assert {conversation_repair.cheapest(codes, s) for s in (1, 2, 512)} == {brute_audit_string(codes)}


def test_segments_do_not_change_the_audit():
    rng = random.Random(2)
    for _ in range(200):
        codes = some_codes(rng, 80)
        assert len({conversation_repair.cheapest(codes, s) for s in (1, 3, 16, 512)}) == 1


def brute_repair(rows):
    """As the contract says, with the audit of ``cheapest`` (tested above)."""
    by: dict = {}
    for conv, turn, role, text in rows:
        mine = by.setdefault(conv, [])
        role, text = " " if role is None else role, " " if text is None else text
        what = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if what == 1 else re.sub("[.!?]", "", text) if what == 2 else text
        mine += [] if what == 0 else [(turn, "user" if what == 4 else role, text)] * (2 if what == 3 else 1)
    out = []
    for conv, mine in by.items():
        mine.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), hashlib.md5(r[2].encode()).hexdigest()))
        faults, codes, seen = Counter(), bytearray(), set()
        for _, role, text in mine:
            body = text.strip(" \t\n\x0b\x0c\r")
            fault = "blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else ""
            seen.add((role, text))
            faults[fault] += 1
            codes.append((" sua".find(role[:1]) if role[:1] in ("s", "u", "a") else 0) | (4 if fault in ("blank", "duplicate") else 0) | (8 if fault == "truncated" else 0))
        turns = [t for t, _, _ in mine if t is not None]
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(mine, mine[1:]))
        cost, audit = conversation_repair.cheapest(bytes(codes), 10**9)
        lines, roles, rest = [], "", iter(mine)
        for letter in audit:
            role, text = ("", "") if letter == "I" else next(rest)[1:]
            if letter != "D":
                role = role if letter == "K" else "assistant" if roles[-1:] == "u" else "user"
                lines.append(f"{role}:{text}")
                roles += role[0]
        assert re.fullmatch("(s?(ua)+)?", roles)
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        out.append((conv, gaps, faults["blank"], faults["duplicate"], faults["truncated"], illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return out


TALKS = "conv_id long, turn long, role string, text string"


def odd_talks():
    rng = random.Random(3)
    texts = ["Hello.", "Hello.", "what is it?", "cut sh", "", " \t", None, "é! ", "x.\n"]
    rows = [(rng.choice([1, 2, 3, 4, 5, None]), rng.choice([None, *range(12)]), rng.choice(["system", "user", "user", "assistant", "assistant", "tool", "", None]), rng.choice(texts)) for _ in range(150)]
    rows += [(7, t, ("user", "assistant")[t % 2], f"turn {t}." + " long" * (90_000 if t == 20 else 0)) for t in range(700)]  # longer than a segment
    dropped = next(c for c in range(1000, 2000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    return [*rows, (dropped, 0, "user", "Hi."), (8, None, "user", "Hi."), (9, 2**62, "user", "far."), (9, 0, "system", "far.")]


@pytest.mark.parametrize("segment", [512, 7])
def test_repair_is_brute_force(spark, segment):
    rows = odd_talks()
    talks = spark.createDataFrame(rows, TALKS).withColumn("copy", F.lit("c")).withColumn("audit", F.lit(1)).repartition(3)
    order = lambda r: tuple((v is None, v) for v in r)
    got = sorted((tuple(r) for r in conversation_repair.repair(talks, segment).collect()), key=order)
    assert got == sorted(brute_repair(rows), key=order)
    assert conversation_repair.repair(spark.createDataFrame([], TALKS + ", cost int"), segment).count() == 0


def test_given_conversations_are_brute_force(spark):
    talks = spark.read.parquet(f"{SF_SMALL}/conversations.parquet")
    want = brute_repair([tuple(r) for r in talks.select("conv_id", "turn", "role", "text").collect()])
    assert sorted(tuple(r) for r in conversation_repair.repair(talks).collect()) == sorted(want)
