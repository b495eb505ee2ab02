"""Helpers shared by the operators of this folder: the shared scratch folder,
a distributed row number, connected components, and cached tokenisation."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share (``spark.checkpoint.dir``).

    A local master has one machine, so there a temporary folder is made when
    the setting is missing; on a cluster a missing setting is an error.
    """
    sc = spark.sparkContext
    base = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not base:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="llm-shared-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(base)
    return base


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it again: cuts
    the lineage, and a lost executor loses nothing."""
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def cut(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the shared folder."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def need_columns(df: DataFrame, *names: str) -> None:
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"missing columns {missing}; the table has {df.columns}")


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores before it until no column has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def numbered(df: DataFrame, order: list[str], out: str) -> DataFrame:
    """Adds the row number (from 0) in the order of the columns ``order``,
    without bringing the rows into one task: range partitions are sorted,
    numbered within, and shifted by the sizes of the partitions before. The
    broadcast table has one row per partition. Only for narrow rows, as they
    are written once so that numbers and sizes come from the same layout."""
    pid, at, n, before = "_pid", "_at", "_n", "_before"
    rows = cut(
        df.repartitionByRange(*order).sortWithinPartitions(*order)
        .withColumn(pid, F.spark_partition_id())
        .withColumn(at, F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)))
    )
    sizes = rows.groupBy(pid).agg(F.count(F.lit(1)).alias(n))
    ahead = Window.orderBy(pid).rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select(pid, F.coalesce(F.sum(n).over(ahead), F.lit(0)).alias(before))
    return rows.join(F.broadcast(sizes), pid).withColumn(out, F.col(before) + F.col(at)).drop(pid, at, before)


def connected_components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(id, component) for every node of the edges; ``component`` is the
    smallest id that can be reached.

    Each round hangs every node under its smallest smaller neighbour
    (aggregated map-side, so a hub costs one row per task), shortens the
    paths by two jumps and contracts the edges; nodes that no edge joins any
    more are done. The tables of a round are checkpointed.
    """
    left = cut(edges.select(F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo")).where("hi != lo").distinct())
    nodes = left.select(F.col("hi").alias("id")).union(left.select("lo")).distinct().select("id", F.col("id").alias("component"))
    while not left.isEmpty():
        up = left.groupBy("hi").agg(F.min("lo").alias("up"))
        for _ in range(2):
            above = up.select(F.col("hi").alias("up"), F.col("up").alias("upper"))
            up = up.join(above, "up", "left").select("hi", F.coalesce("upper", "up").alias("up"))
        up = cut(up)
        low = up.select(F.col("hi").alias("lo"), F.col("up").alias("low_up"))
        moved = left.join(up, "hi").join(low, "lo", "left").select(F.col("up").alias("x"), F.coalesce("low_up", "lo").alias("y"))
        # a path that two jumps did not shorten to its end stays an edge
        unfinished = up.select(F.col("up").alias("lo")).distinct().join(low, "lo").select(F.col("lo").alias("x"), F.col("low_up").alias("y"))
        nodes = cut(nodes.join(up.withColumnRenamed("hi", "component"), "component", "left").select("id", F.coalesce("up", "component").alias("component")))
        left = cut(moved.union(unfinished).where("x != y").select(F.greatest("x", "y").alias("hi"), F.least("x", "y").alias("lo")).distinct())
    return nodes


def nullsafe_key(c: Column) -> Column:
    """A string that is never null and differs for null and every value."""
    return F.when(c.isNull(), F.lit("n")).otherwise(F.concat(F.lit("v"), c.cast("string")))


class CachedTokenizer:
    """Ids of ``word_bpe_49k.json`` with the ids of each distinct word cached
    (the vocabulary works on one word at a time and marks the last piece of
    each word, so words can be looked up apart).

    Texts of Latin-1 characters are cut into words here, by the same rule as
    the vocabulary's own pre-tokenizer; all other texts, and texts that hold
    a special token's string, go to the tokenizer whole. The cache is bounded.
    ``dtype`` is the little-endian integer the ids are stored as.
    """

    MAX_WORDS = 600_000
    LONG_WORD = 64
    #: The pre-tokenizer's rule, written out for lower-case Latin-1.
    WORD = re.compile(
        "'s|'t|'re|'ve|'m|'ll|'d"
        "|[a-z\u00aa\u00b5\u00ba\u00df-\u00f6\u00f8-\u00ff]+"
        "|[0-9\u00b2\u00b3\u00b9\u00bc-\u00be]"
        "|[^ \t\n\r\f\v\u0085\u00a00-9a-z\u00aa\u00b5\u00ba\u00df-\u00f6\u00f8-\u00ff\u00b2\u00b3\u00b9\u00bc-\u00be]+"
    )

    def __init__(self, path: str, dtype: str = "<u4"):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.model, self.dtype, self.seen = Tokenizer.from_file(path), np.dtype(dtype), {}
        self.special = [t.content for t in self.model.get_added_tokens_decoder().values()]
        self.last = np.zeros(self.model.get_vocab_size(), dtype=bool)
        for word, i in self.model.get_vocab().items():
            self.last[i] = word.endswith("</w>")

    def _whole(self, text: str) -> np.ndarray:
        (found,) = self.model.encode_batch_fast([text], add_special_tokens=False)
        return np.asarray(found.ids, dtype=self.dtype)

    def ids(self, texts: list[str | None]) -> list[bytes]:
        """The ids of each text as bytes of ``dtype``; none for null."""
        words = [self._words(t) if t else () for t in texts]
        vocabulary = set().union(*(w for w in words if w is not None))
        new = list(vocabulary.difference(self.seen))
        if len(self.seen) + len(new) > self.MAX_WORDS:
            self.seen.clear()
            new = list(vocabulary)
        fresh = {}
        for k in range(0, len(new), 1000):
            part = new[k : k + 1000]
            raw = (ids := self._whole(" ".join(part))).tobytes()
            ends = ((np.flatnonzero(self.last[ids]) + 1) * self.dtype.itemsize).tolist()
            if len(ends) != len(part):
                fresh.update((w, self._whole(w).tobytes()) for w in part)
                continue
            at = 0
            for w, end in zip(part, ends):
                fresh[w] = raw[at:end]
                at = end
        known = self.seen
        if len(fresh) <= self.MAX_WORDS and not any(len(w) > self.LONG_WORD for w in fresh):
            known.update(fresh)
        elif fresh:
            known = fresh | {w: known[w] for w in vocabulary if w not in fresh}
        look = known.__getitem__
        return [self._whole(t).tobytes() if w is None else b"".join(map(look, w)) for t, w in zip(texts, words)]

    def _words(self, text: str) -> list[str] | None:
        """None if the text must go to the tokenizer whole."""
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return None
        if any(s in text for s in self.special):
            return None
        return self.WORD.findall(text.lower())


_TOKENIZERS: dict = {}


def cached_tokenizer(path: str, dtype: str = "<u4") -> CachedTokenizer:
    """One per Python worker and vocabulary."""
    if (path, dtype) not in _TOKENIZERS:
        _TOKENIZERS[path, dtype] = CachedTokenizer(path, dtype)
    return _TOKENIZERS[path, dtype]


def release_tokenizers() -> None:
    """Tasks that need none call this: Python workers live on from stage to
    stage, and would carry the word cache along."""
    _TOKENIZERS.clear()


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def crc32_sql(text: str) -> str:
    """DuckDB SQL for the CRC-32 of a string's UTF-8 bytes, which DuckDB has no
    function for: the bytes are folded with the table of its polynomial."""
    table = []
    for byte in range(256):
        for _ in range(8):
            byte = byte >> 1 ^ (0xEDB88320 if byte & 1 else 0)
        table.append(byte)
    digits = f"hex(encode({text}))"
    each = f"list_transform(range(length({digits}) // 2), lambda i: ('0x' || substr({digits}, 2 * i + 1, 2))::BIGINT)"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {each}), lambda c, b: xor(({table})[(xor(c, b) & 255) + 1]::BIGINT, c >> 8)), 4294967295)"
