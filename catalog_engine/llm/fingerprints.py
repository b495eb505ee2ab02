"""Document fingerprints by a homomorphic multiset hash (operator 12).

A paragraph (what line feeds part) hashes to a wide vector: 16 lanes modulo
2^32 from its SHA-256 sums, which tell texts apart, and 128 lanes modulo 2^16
that add +1 or -1 for each of its clauses, whose products estimate how much
two texts share. A text's fingerprint is the sum of its paragraphs' vectors, so
the order of the paragraphs does not matter, and a paragraph is inserted or
deleted by adding or taking away its vector. DataFrame functions only.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalog_engine.llm.common import cut, need_columns, numbered

#: Lanes that tell texts apart, and their salted hashes (8 lanes each).
SALTS = ("a", "b")
WIDE = 8 * len(SALTS)
#: Lanes of the likeness: the bits of an MD5 sum.
SIGNS = 128
#: What parts clauses; they are compared without spaces at either end.
CLAUSE_ENDS = "[.!?,;:。！？，、；：\\n]+"

_WIDE_UNIT, _SIGN_UNIT = 1 << 32, 1 << 16


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def _word(hexed: Column, first: int, digits: int) -> Column:
    """The number of a few hexadecimal digits; 16 give a signed one."""
    return F.conv(F.substring(hexed, first + 1, digits), 16, -10).cast("bigint")


def _mod(x: Column, unit: int) -> Column:
    return F.pmod(x, F.lit(unit).cast("bigint"))


def _wide_lanes(text: Column) -> Column:
    def of_paragraph(p: Column) -> Column:
        sums = [F.sha2(F.concat(F.lit(salt), p), 256) for salt in SALTS]
        return F.concat(*[_let(s, lambda h: F.array(*[_word(h, 8 * k, 8) for k in range(8)])) for s in sums])

    vectors = F.transform(F.split(text, "\n", -1), of_paragraph)
    total = lambda v, lane: F.aggregate(v, F.lit(0).cast("bigint"), lambda acc, p: _mod(acc + F.get(p, lane), _WIDE_UNIT))
    return _let(vectors, lambda v: F.transform(F.sequence(F.lit(0), F.lit(WIDE - 1)), lambda lane: total(v, lane)))


def _sign_lanes(text: Column) -> Column:
    """Lane 32 w + k adds +1 for a clause whose MD5 sum has bit k set in its
    32-bit word w, and -1 for others. Two words are counted at once, in the
    halves of a 64-bit number."""
    trimmed = F.transform(F.split(text, CLAUSE_ENDS, -1), lambda c: F.trim(c))
    clauses = F.transform(F.filter(trimmed, lambda c: c != ""), lambda c: F.md5(c.cast("binary")))
    both = F.lit((1 << 32) + 1).cast("bigint")

    def lanes(sums: Column, first: int) -> Column:
        count = lambda words, k: F.aggregate(
            words, F.lit(0).cast("bigint"), lambda acc, h: acc + F.call_function("shiftrightunsigned", h, k).bitwiseAND(both)
        )
        ones = lambda words: F.transform(F.sequence(F.lit(0), F.lit(31)), lambda k: count(words, k))
        split = lambda s: F.concat(F.transform(s, lambda x: F.shiftrightunsigned(x, 32)), F.transform(s, lambda x: x.bitwiseAND(F.lit((1 << 32) - 1))))
        return _let(_let(F.transform(sums, lambda h: _word(h, first, 16)), ones), split)

    signed = lambda sums: F.transform(
        F.concat(lanes(sums, 0), lanes(sums, 16)), lambda ones: _mod(ones * 2 - F.size(sums).cast("bigint"), _SIGN_UNIT)
    )
    return _let(clauses, signed)


def vector(text: Column) -> Column:
    """``struct(wide, signs)`` of a whole text or of one paragraph; null reads
    as the empty text, which is one empty paragraph."""
    text = F.coalesce(text.cast("string"), F.lit(""))
    return F.struct(_wide_lanes(text).alias("wide"), _sign_lanes(text).alias("signs"))


def plus(a: Column, b: Column) -> Column:
    """The fingerprint vector of the paragraphs of both."""
    add = lambda name, unit: F.zip_with(a[name], b[name], lambda x, y: _mod(x + y, unit)).alias(name)
    return F.struct(add("wide", _WIDE_UNIT), add("signs", _SIGN_UNIT))


def minus(a: Column, b: Column) -> Column:
    """The fingerprint vector of ``a`` without the paragraphs of ``b``."""
    take = lambda name, unit: F.zip_with(a[name], b[name], lambda x, y: _mod(x - y, unit)).alias(name)
    return F.struct(take("wide", _WIDE_UNIT), take("signs", _SIGN_UNIT))


def digest(v: Column) -> Column:
    """The vector as text: 8 digits for each wide lane, 4 for each sign lane."""
    digits = lambda lanes, n: F.array_join(F.transform(lanes, lambda x: F.lpad(F.hex(x), n, "0")), "")
    return F.concat(digits(v["wide"], 8), digits(v["signs"], 4))


def _centred(signs: Column) -> Column:
    return F.transform(signs, lambda x: x - F.when(x >= _SIGN_UNIT // 2, _SIGN_UNIT).otherwise(0))


def likeness(a: Column, b: Column) -> Column:
    """Estimate of 2 |A and B| / (|A| + |B|) of the multisets of clauses (in
    squared multiplicities) from two arrays of sign lanes, from 0 to 1; 1 for
    two texts without clauses. The standard error is about 0.09."""
    added = lambda x: F.aggregate(x, F.lit(0).cast("bigint"), lambda acc, y: acc + y)

    def of(x: Column) -> Column:
        dot = added(F.zip_with(x["p"], x["q"], lambda p, q: p * q))
        norms = added(F.zip_with(x["p"], x["q"], lambda p, q: p * p + q * q))
        share = (dot * 2).cast("double") / F.nullif(norms, F.lit(0)).cast("double")
        return F.coalesce(F.greatest(F.lit(0.0), F.least(F.lit(1.0), share)), F.lit(1.0))

    return _let(F.struct(_centred(a).alias("p"), _centred(b).alias("q")), of)


def update(fingerprints: DataFrame, changes: DataFrame, key: str = "doc_id") -> DataFrame:
    """``fingerprints`` (key, vec: the struct of ``vector``) after ``changes``
    (key, paragraph, sign: 1 inserts, -1 deletes), without reading any text
    again. Keys without changes stay as they are; a key that only ``changes``
    has starts from no paragraph at all; a null paragraph is an empty one. Sums
    are aggregated in the tasks, so a key with very many changes sends one row
    from each. Null keys are a key of their own."""
    lane = lambda v, i: v["wide"][i] if i < WIDE else v["signs"][i - WIDE]
    vec = F.col("vec")
    changed = changes.select(F.col(key).alias("key"), vector(F.col("paragraph")).alias("vec"), F.col("sign").cast("bigint").alias("sign"))
    every = fingerprints.select(F.col(key).alias("key"), "vec", F.lit(1).cast("bigint").alias("sign")).union(changed)
    # as decimals, so that no sum of however many changes overflows
    sums = every.groupBy("key").agg(*[F.sum((lane(vec, i) * F.col("sign")).cast("decimal(20,0)")).alias(f"s{i}") for i in range(WIDE + SIGNS)])
    lanes = lambda first, end, unit: F.array(*[F.pmod(F.col(f"s{i}"), F.lit(unit).cast("decimal(20,0)")).cast("bigint") for i in range(first, end)])
    return sums.select(F.col("key").alias(key), F.struct(lanes(0, WIDE, _WIDE_UNIT).alias("wide"), lanes(WIDE, WIDE + SIGNS, _SIGN_UNIT).alias("signs")).alias("vec"))


def _with_edits(docs: DataFrame) -> DataFrame:
    """(doc_id, n_chars, text, copies, take, head, next_signs): each distinct
    (doc_id, text) with the first ``take`` characters and the sign lanes of the
    document that follows it.

    The order comes from a narrow table of keys. Texts move once, by key; the
    part that the document before needs (half of that one's length at most) moves to
    it as cut.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    doc_id = F.col("doc_id").cast("long")
    # 128 bits of id and text: equal rows are one key
    key = F.md5(F.concat(F.coalesce(doc_id.cast("string"), F.lit("null")), F.lit(":"), text).cast("binary"))
    rows = docs.select(key.alias("key"), doc_id.alias("doc_id"), text.alias("text"))
    narrow = rows.select("key", "doc_id", F.length("text").cast("long").alias("n_chars")).groupBy("key", "doc_id", "n_chars").agg(F.count(F.lit(1)).alias("copies"))
    narrow = narrow.withColumn("null_id", F.col("doc_id").isNull()).withColumn("back", F.bitwise_not(F.col("doc_id")))
    placed = cut(numbered(narrow, ["null_id", "back", "key"], "place").select("key", "doc_id", "n_chars", "copies", "place"))
    total = placed.agg(F.count(F.lit(1)).alias("total"))
    after = placed.crossJoin(F.broadcast(total)).select("key", "n_chars", F.expr("(place + 1) % total").alias("place"))
    follows = placed.select(F.col("key").alias("next_key"), "place")
    # one row per key: what it has to send to the key before it
    asked = after.join(follows, "place").select(F.col("next_key").alias("key"), F.col("key").alias("of"), F.expr("n_chars div 2").alias("take"))
    # copies of a key meet here; every task sends one of each
    texts = rows.groupBy("key").agg(F.first("text").alias("text"))
    heads = texts.join(asked, "key").select(
        F.col("of").alias("key"), F.expr("substring(text, 1, cast(take as int))").alias("head"), F.transform(_sign_lanes(F.col("text")), lambda x: (x - 32768).cast("smallint")).alias("next_signs")
    )
    found = texts.join(placed.select("key", "doc_id", "n_chars", "copies"), "key").join(heads, "key")
    return found.select("doc_id", "n_chars", "text", "copies", F.expr("n_chars div 2").alias("take"), "head", F.transform("next_signs", lambda x: x.cast("bigint") + 32768).alias("next_signs"))


def fingerprints(docs: DataFrame) -> DataFrame:
    """One row per document: ``doc_id, n_chars, edited_sha256, fingerprint,
    edited_fingerprint, near_edited, near_next``.

    The edited text is the text with its last floor(n_chars / 2) code points
    replaced by the first as many (or all) of the next document in descending
    doc_id, after the last one the first's. Null texts read as empty. Null ids
    come first; rows with equal ids follow each other by the MD5 sum of their
    texts; of rows equal in both, each but the last has a copy of itself as the next.
    A single document is its own next. Other columns are ignored; an empty table
    gives no rows.
    """
    need_columns(docs, "doc_id", "text")
    rows = _with_edits(docs)
    edited = lambda tail: F.concat(F.expr("substring(text, 1, cast(n_chars - take as int))"), tail)
    own_head = F.expr("substring(text, 1, cast(take as int))")
    rows = rows.select(
        "doc_id", "n_chars", "copies", vector(F.col("text")).alias("vec"), edited(F.col("head")).alias("edited"),
        F.when(F.col("copies") > 1, edited(own_head)).alias("edited_self"), "next_signs",
    )
    result = lambda e, next_signs: F.struct(
        F.sha2(F.col(e), 256).alias("edited_sha256"), vector(F.col(e)).alias("vec"), next_signs.alias("next_signs")
    )
    rows = rows.select(
        "doc_id", "n_chars", "copies", "vec", result("edited", F.col("next_signs")).alias("last"),
        F.when(F.col("copies") > 1, result("edited_self", F.col("vec")["signs"])).alias("others"),
    )
    # copies in two steps, so that no array is longer than 10,000
    rows = rows.withColumn("block", F.explode(F.expr("sequence(0, (copies - 1) div 10000)")))
    rows = rows.withColumn("copy", F.explode(F.expr("sequence(block * 10000 + 1, least(copies, block * 10000 + 10000))")))
    rows = rows.select("doc_id", "n_chars", "vec", F.when(F.col("copy") == F.col("copies"), F.col("last")).otherwise(F.col("others")).alias("got"))
    return rows.select(
        "doc_id", "n_chars", F.col("got")["edited_sha256"].alias("edited_sha256"), digest(F.col("vec")).alias("fingerprint"), digest(F.col("got")["vec"]).alias("edited_fingerprint"),
        likeness(F.col("vec")["signs"], F.col("got")["vec"]["signs"]).alias("near_edited"), likeness(F.col("vec")["signs"], F.col("got")["next_signs"]).alias("near_next"),
    )


def _oracle_sql() -> str:
    """The same rows in DuckDB, for tables without repeated rows."""
    wide = " || ".join(
        f"upper(printf('%08x', (list_sum(list_transform(pars, lambda p: ('0x' || substr(sha256('{salt}' || p), {8 * k + 1}, 8))::BIGINT)) % {_WIDE_UNIT})::BIGINT))"
        for salt in SALTS for k in range(8)
    )
    lane = f"((2 * coalesce(list_sum(list_transform(sums, lambda h: (('0x' || substr(h, 8 * (lane // 32) + 1, 8))::BIGINT >> (lane % 32)::INTEGER) & 1)), 0) - len(sums)) % {_SIGN_UNIT} + {_SIGN_UNIT}) % {_SIGN_UNIT}"
    share = lambda a, b: f"coalesce(greatest(0.0::DOUBLE, least(1.0::DOUBLE, (2 * list_sum(list_transform(range(1, {SIGNS + 1}), lambda i: {a}[i] * {b}[i])))::DOUBLE / nullif(list_sum(list_transform(range(1, {SIGNS + 1}), lambda i: {a}[i] * {a}[i] + {b}[i] * {b}[i])), 0)::DOUBLE)), 1.0::DOUBLE)"
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, length(coalesce(text, '')) AS n FROM documents),
o AS (
  SELECT *, coalesce(lead(text) OVER (ORDER BY doc_id DESC), first_value(text) OVER (ORDER BY doc_id DESC)) AS follower,
         coalesce(lead(doc_id) OVER (ORDER BY doc_id DESC), first_value(doc_id) OVER (ORDER BY doc_id DESC)) AS next_id FROM d
), texts AS (
  SELECT doc_id, 0 AS edited, text FROM o
  UNION ALL SELECT doc_id, 1, left(text, n - n // 2) || left(follower, n // 2) FROM o
), units AS (
  SELECT doc_id, edited, text, string_split(text, chr(10)) AS pars,
         list_transform(list_filter(list_transform(regexp_split_to_array(text, '{CLAUSE_ENDS}'), lambda c: trim(c, ' ')), lambda c: c <> ''), lambda c: md5(c)) AS sums
  FROM texts
), lanes AS (
  SELECT doc_id, edited, text, {wide} AS wide, list_transform(range({SIGNS}), lambda lane: ({lane})::BIGINT) AS signs FROM units
), found AS (
  SELECT doc_id, edited, sha256(text) AS sha, wide || array_to_string(list_transform(signs, lambda x: upper(printf('%04x', x))), '') AS fingerprint,
         list_transform(signs, lambda x: CASE WHEN x >= {_SIGN_UNIT // 2} THEN x - {_SIGN_UNIT} ELSE x END) AS s FROM lanes
)
SELECT o.doc_id, o.n AS n_chars, e.sha AS edited_sha256, a.fingerprint, e.fingerprint AS edited_fingerprint,
       {share("a.s", "e.s")} AS near_edited, {share("a.s", "f.s")} AS near_next
FROM o JOIN found a ON a.doc_id = o.doc_id AND a.edited = 0 JOIN found e ON e.doc_id = o.doc_id AND e.edited = 1
     JOIN found f ON f.doc_id = o.next_id AND f.edited = 0
"""


ORACLE_SQL = _oracle_sql()
