"""Delta-maintained token counts (operator 9).

Totals per source, language and tokenizer version are kept by signed deltas: an
insert adds a document's counts, a delete takes back what was added for it, a
revision does both. Counts are sums, so deltas of any batches add up in any
order.

On disk (below one folder, in Spark tables of Parquet):

    ledger/batch=N   what batch N added or took back, per document and tokenizer
    deltas/batch=N   the same summed per source, language and tokenizer
    done/batch=N     written last; a batch without it is not there

A batch is written once: applying a batch id that is done changes nothing, and
one that broke off is written anew, over what it left.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog_engine.llm.common import cached_tokenizer, need_columns, nullsafe_key, tokenizer_path

#: Name of a tokenizer version -> vocabulary file; None counts words.
TOKENIZERS: dict[str, str | None] = {"word_bpe_49k": "word_bpe_49k.json", "words-1": None}
KEYS = ["source", "lang", "tokenizer"]
LEDGER = "doc_id long, source string, lang string, tokenizer string, n_docs long, n_tokens long, n_bytes long"
DELTAS = "source string, lang string, tokenizer string, n_docs long, n_tokens long, n_bytes long"


def _counted(vocabularies: dict[str, str | None]) -> Callable:
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, len(batch), 500):
                part = batch.iloc[at : at + 500]
                texts = part["text"].tolist()
                raw = [(t or "").encode("utf-8", "replace") for t in texts]
                for name, vocabulary in vocabularies.items():
                    tokens = [len(r.split()) for r in raw] if vocabulary is None else [len(x) // 4 for x in cached_tokenizer(vocabulary).ids(texts)]
                    yield part[["doc_id", "source", "lang"]].assign(tokenizer=name, n_docs=1, n_tokens=tokens, n_bytes=[len(r) for r in raw])

    return count


class TokenRollup:
    """Totals below ``path``, a folder that driver and executors share."""

    def __init__(self, spark: SparkSession, path: str, tokenizers: dict[str, str | None] | None = None):
        self.spark, self.path = spark, path.rstrip("/")
        names = TOKENIZERS if tokenizers is None else tokenizers
        self.vocabularies = {n: v and (v if "/" in v else tokenizer_path(v)) for n, v in names.items()}

    def _exists(self, folder: str) -> bool:
        jvm = self.spark._jvm
        where = jvm.org.apache.hadoop.fs.Path(folder)
        return where.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(where)

    def _batches(self) -> list[int]:
        jvm = self.spark._jvm
        where = jvm.org.apache.hadoop.fs.Path(f"{self.path}/done")
        fs = where.getFileSystem(self.spark._jsc.hadoopConfiguration())
        found = [s.getPath().getName() for s in fs.listStatus(where)] if fs.exists(where) else []
        return sorted(int(n.partition("=")[2]) for n in found if n.startswith("batch=") and self.is_done(int(n.partition("=")[2])))

    def is_done(self, batch: int) -> bool:
        return self._exists(f"{self.path}/done/batch={batch}/_SUCCESS")

    def _read(self, table: str, schema: str, batches: list[int]) -> DataFrame:
        if not batches:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[f"{self.path}/{table}/batch={b}" for b in batches])

    def ledger(self) -> DataFrame:
        """What the done batches added, net, per document and tokenizer."""
        rows = self._read("ledger", LEDGER, self._batches())
        return rows.groupBy("doc_id", *KEYS).agg(*[F.sum(c).alias(c) for c in ("n_docs", "n_tokens", "n_bytes")]).where("n_docs <> 0 or n_tokens <> 0 or n_bytes <> 0")

    def apply(self, batch: int, changes: DataFrame) -> bool:
        """Commit a batch of changes; False if it is done already.

        ``changes`` has ``op`` ("insert", "delete" or "revise"), ``doc_id``,
        ``source``, ``lang`` and ``text``. A delete or revision takes back all
        that stands for the doc_id, a revision then counts the new row. Rows of
        an unknown op are refused; a delete of what was never there, or with a
        null doc_id, changes nothing. Several inserts of one doc_id count each.
        """
        need_columns(changes, "op", "doc_id", "source", "lang", "text")
        if self.is_done(batch):
            return False
        known = F.coalesce(F.col("op").isin("insert", "delete", "revise"), F.lit(False))
        refused = F.raise_error(F.concat(F.lit("unknown op "), F.coalesce(F.col("op").cast("string"), F.lit("null"))))
        changes = changes.select(
            F.when(known, F.col("op")).otherwise(refused).alias("op"), F.col("doc_id").cast("long").alias("doc_id"),
            F.col("source").cast("string").alias("source"), F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"),
        )
        added = changes.where("op <> 'delete'").select("doc_id", "source", "lang", "text").mapInPandas(_counted(self.vocabularies), LEDGER)
        rows = added
        if self._batches():
            gone = changes.where("op <> 'insert'").select("doc_id").distinct()
            back = self.ledger().join(gone, "doc_id", "left_semi")
            rows = added.union(back.select("doc_id", *KEYS, *[(-F.col(c)).alias(c) for c in ("n_docs", "n_tokens", "n_bytes")]))
        ledger, deltas = f"{self.path}/ledger/batch={batch}", f"{self.path}/deltas/batch={batch}"
        rows.write.mode("overwrite").parquet(ledger)
        written = self.spark.read.schema(LEDGER).parquet(ledger)
        sums = written.groupBy(*KEYS).agg(*[F.sum(c).alias(c) for c in ("n_docs", "n_tokens", "n_bytes")])
        sums.write.mode("overwrite").parquet(deltas)
        self.spark.range(1).select(F.lit(batch).alias("id")).coalesce(1).write.mode("overwrite").parquet(f"{self.path}/done/batch={batch}")
        return True

    def totals(self) -> DataFrame:
        """One row per source, language and tokenizer version with ``n_docs,
        n_tokens, n_bytes``; null sources and languages are groups of their
        own, groups without documents are gone. Without batches no rows."""
        rows = self._read("deltas", DELTAS, self._batches())
        return rows.groupBy(*KEYS).agg(*[F.sum(c).cast("long").alias(c) for c in ("n_docs", "n_tokens", "n_bytes")]).where("n_docs <> 0")


#: Fixed value: what is masked as an e-mail address in a revision.
EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"


def history(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Two batches of changes over a whole table: every document is inserted;
    then copies of a text are deleted (all but its least doc_id), and the other
    texts that hold an e-mail address are revised, with a mark in its place."""
    need_columns(docs, "doc_id", "source", "lang", "text")
    rows = docs.select("doc_id", "source", "lang", "text")
    inserts = rows.withColumn("op", F.lit("insert"))
    keyed = rows.withColumn("h", F.md5(nullsafe_key(F.col("text")).cast("binary")))
    first = keyed.groupBy("h").agg(F.min("doc_id").alias("first"))
    copies = keyed.select("doc_id", "h").join(first, "h").where("doc_id <> first").select("doc_id", F.lit(True).alias("copy"))
    masked = F.regexp_replace("text", EMAIL, "<email>")
    later = rows.select("doc_id", "source", "lang", F.when(F.col("text").rlike(EMAIL), masked).alias("text")).join(copies.distinct(), "doc_id", "left")
    later = later.where("copy or text is not null")
    op = F.when(F.col("copy"), "delete").otherwise("revise")
    return inserts, later.select(op.alias("op"), "doc_id", "source", "lang", F.when(F.col("copy").isNull(), F.col("text")).alias("text"))


def rollup(docs: DataFrame, path: str, tokenizers: dict[str, str | None] | None = None) -> DataFrame:
    """The totals after :func:`history`; its second batch is sent twice."""
    state = TokenRollup(docs.sparkSession, path, tokenizers)
    inserts, changes = history(docs)
    state.apply(1, inserts)
    state.apply(2, changes)
    state.apply(2, changes)
    return state.totals()
