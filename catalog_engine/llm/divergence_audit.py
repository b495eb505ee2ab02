"""Audit of how far the sources of a language diverge in their words (operator 11).

Three-dimensional cube partitioning: the groups (language, source) of a
language are dealt into blocks, its terms too. A task owns a cell (group block,
group block, term block); it gets the two blocks' counts of those terms (a
slice travels once for every group block), computes the partial divergences of
all pairs in both directions, and the partial sums are added along the terms.
All arithmetic is in whole numbers.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from catalog_engine.llm.common import need_columns, release_tokenizers, stored

#: A term counts in a language if at least so many of its documents hold it.
MIN_DOCS = 3
#: Shares are whole numbers of this unit.
UNIT = 1_000_000_000
#: Ranks of the part ``term``.
TERM_RANKS = 200
#: Groups and terms of a block, on average.
BLOCK_GROUPS = 32
BLOCK_TERMS = 2048
#: Distinct (group, term) entries that a counting task holds at once.
HELD = 300_000
#: UNIT * (count + 1) fits into 64 bits below this count.
_NARROW = 9_000_000_000

#: Every byte that no term holds becomes a space, A-Z become a-z; all bytes of
#: characters beyond ASCII belong to terms.
_FOLD = bytes(c if c >= 0x80 or 0x61 <= c <= 0x7A else c + 0x20 if 0x41 <= c <= 0x5A else 0x20 for c in range(256))


def terms_of(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(_FOLD).split()


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, source, term, n, docs) of a task's documents, in parts."""
    release_tokenizers()
    counts: dict = {}
    held = 0

    def parts():
        for (lang, source), (n, docs) in counts.items():
            if n:
                terms = list(n)
                yield pa.record_batch(
                    [pa.array([lang] * len(terms)), pa.array([source] * len(terms)), pa.array(terms, pa.binary()), pa.array([n[t] for t in terms], pa.int64()), pa.array([docs[t] for t in terms], pa.int64())],
                    names=["lang", "source", "term", "n", "docs"],
                )

    for batch in batches:
        for lang, source, text in zip(*(batch.column(c).to_pylist() for c in ("lang", "source", "text"))):
            n, docs = counts.setdefault((lang, source), (Counter(), Counter()))
            before = len(n)
            terms = terms_of(text)
            n.update(terms)
            docs.update(set(terms))
            held += len(n) - before
            if held > HELD:
                yield from parts()
                counts.clear()
                held = 0
    yield from parts()


def term_counts(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs): occurrences, and documents that hold the
    term, per group; tasks add up before the shuffle."""
    counted = docs.mapInArrow(_counted, "lang string, source string, term binary, n bigint, docs bigint")
    return counted.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def _share(n: str, total: str, terms: str) -> Column:
    """1 + floor(UNIT * (n + 1) / (total + terms)), exact at any count."""
    wide = f"cast({UNIT} as decimal(10,0)) * cast({n} + 1 as decimal(20,0)) div cast({total} + {terms} as decimal(20,0))"
    return F.expr(f"1 + CASE WHEN {n} < {_NARROW} THEN {UNIT} * ({n} + 1) div ({total} + {terms}) ELSE {wide} END")


def _cell(rows: pd.DataFrame) -> pd.DataFrame:
    """Partial divergences of one cell: rows with a term hold a count, rows
    without one describe a group."""
    a, b = int(rows["a"].iloc[0]), int(rows["b"].iloc[0])
    groups = rows[rows["term"].isna()].sort_values(["own", "source"])
    slices = rows[rows["term"].notna()]
    at = pd.Series(np.arange(len(groups)), index=groups["source"])
    present, term = np.unique(slices["term"].to_numpy(dtype=object), return_inverse=True) if len(slices) else (np.empty(0, object), np.empty(0, np.int64))
    # one more column: any kept term of the block that no group of the cell holds
    counts = np.zeros((len(groups), len(present) + 1), dtype=np.int64)
    counts[at.loc[slices["source"]].to_numpy(), term] = slices["n"].to_numpy(dtype=np.int64)
    weight = np.ones(len(present) + 1, dtype=np.int64)
    weight[-1] = int(groups["terms_here"].iloc[0]) - len(present)
    total = groups["total"].to_numpy(dtype=np.int64) + groups["terms"].to_numpy(dtype=np.int64)
    if counts.max(initial=0) >= _NARROW:
        shares = np.array([[1 + UNIT * (int(n) + 1) // int(t) for n in row] for row, t in zip(counts, total)], dtype=np.int64)
    else:
        shares = 1 + UNIT * (counts + 1) // np.maximum(total, 1)[:, None]
    own, names = groups["own"].to_numpy(), groups["source"].to_numpy()
    out = []
    for block, other in {(a, b), (b, a)}:
        others = np.flatnonzero(own == other)
        q = shares[others]
        for i in np.flatnonzero(own == block):
            apart = shares[i] - q
            value = (apart * apart // q * weight).sum(axis=1)
            out.append(pd.DataFrame({"source": names[i], "item": names[others], "value": value})[others != i])
    found = pd.concat(out) if out else pd.DataFrame({"source": [], "item": [], "value": []})
    return found.assign(lang=rows["lang"].iloc[0])[["lang", "source", "item", "value"]]


def _pairs(groups: DataFrame, slices: DataFrame, kept: DataFrame, block_groups: int, block_terms: int) -> DataFrame:
    """(lang, source, item, value) for each ordered pair of a language's groups."""
    blocks = groups.groupBy("lang").agg(
        F.ceil(F.count(F.lit(1)) / block_groups).cast("int").alias("group_blocks"),
        F.greatest(F.lit(1), F.ceil(F.first("terms") / block_terms)).cast("int").alias("term_blocks"),
    )
    own = F.pmod(F.xxhash64("source"), F.col("group_blocks")).cast("int")
    block = F.pmod(F.xxhash64("term"), F.col("term_blocks")).cast("int")
    here = kept.join(blocks, "lang").groupBy("lang", block.alias("t")).agg(F.count(F.lit(1)).alias("terms_here"))
    described = groups.join(blocks, "lang").select("lang", "source", "total", "terms", "group_blocks", own.alias("own"), F.explode(F.expr("sequence(0, term_blocks - 1)")).alias("t"))
    described = described.join(here, ["lang", "t"], "left")
    shape = lambda df, n, term, total, terms, terms_here: df.select(
        "lang", "t", "source", "own", n.cast("bigint").alias("n"), term.cast("binary").alias("term"), total.cast("bigint").alias("total"), terms.cast("bigint").alias("terms"), terms_here.cast("bigint").alias("terms_here"),
        F.explode(F.expr("sequence(0, group_blocks - 1)")).alias("other"),
    )
    none = F.lit(None)
    counted = slices.join(blocks, "lang").select("lang", "source", "term", "n", "group_blocks", own.alias("own"), block.alias("t"))
    rows = shape(counted, F.col("n"), F.col("term"), none, none, none).union(
        shape(described, none, none, F.col("total"), F.col("terms"), F.coalesce("terms_here", F.lit(0)))
    )
    rows = rows.select("lang", F.least("own", "other").alias("a"), F.greatest("own", "other").alias("b"), "t", "source", "own", "n", "term", "total", "terms", "terms_here")
    partial = rows.groupBy("lang", "a", "b", "t").applyInPandas(_cell, "lang string, source string, item string, value bigint")
    return partial.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))


def audit(docs: DataFrame, min_docs: int = MIN_DOCS, term_ranks: int = TERM_RANKS, block_groups: int = BLOCK_GROUPS, block_terms: int = BLOCK_TERMS) -> DataFrame:
    """Rows ``lang, source, part, item, value, rank``.

    A group is a (lang, source) that occurs; null lang, source or text reads
    as ''. Terms are runs of ASCII letters and of characters beyond ASCII, A-Z
    in lower case. A language keeps the V terms that at least ``min_docs`` of its
    documents hold. A group (and the language as a whole) gives a kept term with
    n occurrences the share p = 1 + floor(10^9 (n + 1) / (N + V)), N being n's
    sum over the kept terms; the divergence at a term is
    f = floor((p - q)^2 / q).

    Part ``pair``: ``item`` is each other source of the language with its q, and
    ``value`` the sum of f over all kept terms (0 without any). Part ``term``:
    ``item`` is each kept term of the group with p above the language's q, and
    ``value`` is f; ranks up to ``term_ranks``. ``rank`` counts from 1 within a
    group and part by value descending, then item in UTF-8 order. A group whose
    texts hold no terms has pairs too; a language of one source has none. Rows
    that repeat count as documents each; ids and other columns are not read. An
    empty table gives no rows.
    """
    need_columns(docs, "text", "lang", "source")
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
    docs = docs.select(blank("lang"), blank("source"), F.col("text").cast("string").cast("binary").alias("text"))
    counts = stored(term_counts(docs), "term-counts")
    kept = counts.groupBy("lang", "term").agg(F.sum("n").alias("in_lang"), F.sum("docs").alias("docs")).where(F.col("docs") >= min_docs)
    slices = stored(counts.drop("docs").join(kept.select("lang", "term", "in_lang"), ["lang", "term"]), "kept-counts")
    kept = slices.select("lang", "term", "in_lang").distinct()
    langs = kept.groupBy("lang").agg(F.sum("in_lang").alias("lang_total"), F.count(F.lit(1)).alias("terms"))
    totals = slices.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = docs.select("lang", "source").distinct().join(totals, ["lang", "source"], "left").join(langs, "lang", "left")
    groups = stored(groups.na.fill(0, ["total", "terms", "lang_total"]), "audit-groups")
    of_group = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pairs = _pairs(groups, slices, kept, block_groups, block_terms).select("lang", "source", F.lit("pair").alias("part"), "item", "value", F.row_number().over(of_group).alias("rank"))
    p, q = _share("n", "total", "terms"), _share("in_lang", "lang_total", "terms")
    typical = slices.join(groups, ["lang", "source"]).select("lang", "source", F.col("term").cast("string").alias("item"), p.alias("p"), q.alias("q")).where("p > q")
    typical = typical.select("lang", "source", F.lit("term").alias("part"), "item", F.expr("(p - q) * (p - q) div q").alias("value"))
    typical = typical.withColumn("rank", F.row_number().over(of_group)).where(F.col("rank") <= term_ranks)
    return pairs.union(typical)


#: The same rows in DuckDB.
ORACLE_SQL = f"""
WITH d AS (
  SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS terms
  FROM documents
), w AS (SELECT id, lang, source, unnest(terms) AS term FROM d),
counts AS (SELECT lang, source, term, count(*) AS n FROM w GROUP BY ALL),
kept AS (SELECT lang, term, count(*) AS n FROM w GROUP BY lang, term HAVING count(DISTINCT id) >= {MIN_DOCS}),
langs AS (SELECT lang, count(*) AS v, sum(n) AS total FROM kept GROUP BY lang),
g AS (SELECT DISTINCT lang, source FROM d),
cells AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, k.n AS in_lang
  FROM g JOIN kept k ON k.lang = g.lang LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
), totals AS (SELECT lang, source, sum(n) AS total FROM cells GROUP BY lang, source),
shares AS (
  SELECT c.lang, c.source, c.term, c.n, 1 + ({UNIT}::HUGEINT * (c.n + 1)) // (t.total + l.v)::HUGEINT AS p,
         1 + ({UNIT}::HUGEINT * (c.in_lang + 1)) // (l.total + l.v)::HUGEINT AS q
  FROM cells c JOIN totals t ON t.lang = c.lang AND t.source = c.source JOIN langs l ON l.lang = c.lang
), sums AS (
  SELECT x.lang, x.source, y.source AS item, sum((x.p - y.p) * (x.p - y.p) // y.p) AS value
  FROM shares x JOIN shares y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source GROUP BY ALL
), found AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(s.value, 0)::BIGINT AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
       LEFT JOIN sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, ((p - q) * (p - q) // q)::BIGINT FROM shares WHERE n > 0 AND p > q
)
SELECT * FROM (
  SELECT lang, source, part, item, value, (row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item))::INTEGER AS rank FROM found
) WHERE part = 'pair' OR rank <= {TERM_RANKS}
"""
