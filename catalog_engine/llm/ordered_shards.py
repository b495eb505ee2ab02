"""Training-order materialisation of token ids (operator 4).

Documents become one stream of ids per input partition (an end id after each),
cut into sequences of a fixed length. A keyed Feistel network over the least
even number of bits that holds all sequences, walked on until it lands below
their number, is a permutation of them: it gives each sequence its global slot
without sorting or a table. Slots are dealt into ranges, and each range is
written as one shard of fixed-stride records, so that slot s stands at byte
(s mod slots per shard) * stride of shard s div slots per shard: a reader can
start, stop and resume anywhere and reads forward.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from catalog_engine.llm.common import cached_tokenizer, need_columns, new_folder, stored, tokenizer_path

SEQUENCE = 1024
SLOTS_PER_SHARD = 8192
#: zstd level of records on their way to their shard.
RECORD_LEVEL = 6
KEY = 0x5EED_0F_0DE5
ROUNDS = 6
#: Ids are stored as little-endian unsigned 16-bit integers; the vocabulary has 49,408.
DTYPE = "<u2"
END_ID = 1
#: Fills the last sequence of a partition.
PAD_ID = 0

_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def _round(half: np.ndarray, key: int) -> np.ndarray:
    h = half + np.uint64(key & 0xFFFFFFFFFFFFFFFF)
    h = (h ^ (h >> np.uint64(30))) * _M1
    h = (h ^ (h >> np.uint64(27))) * _M2
    return h ^ (h >> np.uint64(31))


def permuted(x: np.ndarray, n: int, key: int = KEY) -> np.ndarray:
    """The places of 0 <= x < n under a keyed permutation of n numbers."""
    bits = max(1, ((max(n, 2) - 1).bit_length() + 1) // 2)
    mask = np.uint64((1 << bits) - 1)
    x = x.astype(np.uint64)
    walking = np.ones(len(x), dtype=bool)
    while walking.any():
        left, right = x[walking] >> np.uint64(bits), x[walking] & mask
        for r in range(ROUNDS):
            left, right = right, left ^ (_round(right, key * (r + 1) + 0x9E3779B97F4A7C15 * (r + 1)) & mask)
        x[walking] = (left << np.uint64(bits)) | right
        walking &= x >= np.uint64(n)
    return x.astype(np.int64)


def _sequences(vocabulary: str, length: int) -> Callable:
    size = np.dtype(DTYPE).itemsize
    end, pad, width = np.array([END_ID], dtype=DTYPE).tobytes(), np.array([PAD_ID], dtype=DTYPE).tobytes(), length * size

    def cut_stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, compressor, partition = cached_tokenizer(vocabulary, DTYPE), zstandard.ZstdCompressor(level=RECORD_LEVEL), TaskContext.get().partitionId()
        stream, inside, rows, at = bytearray(), [], [], 0
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1)
            for k in range(0, len(ids), 500):
                for doc_id, raw in zip(ids[k : k + 500], tokens.ids(texts[k : k + 500].to_pylist())):
                    stream += raw + end
                    inside.append(doc_id)
                    whole = len(stream) // width * width
                    for begin in range(0, whole, width):
                        rows.append((partition, at, length, inside, compressor.compress(bytes(stream[begin : begin + width]))))
                        inside, at = [doc_id] if len(stream) > begin + width else [], at + 1
                    del stream[:whole]
                if rows:
                    yield _batch(rows)
                    rows = []
        if stream:
            yield _batch([(partition, at, len(stream) // size, inside, compressor.compress(bytes(stream) + pad * (length - len(stream) // size)))])

    return cut_stream


_ROWS = pa.schema([("part", pa.int32()), ("at", pa.int64()), ("length", pa.int32()), ("doc_ids", pa.list_(pa.int64())), ("record", pa.binary())])


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _ROWS)], schema=_ROWS)


def _slotted(total: int, key: int) -> Callable:
    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            slot = permuted(b["ordinal"].to_numpy(), total, key)
            yield pa.RecordBatch.from_arrays([pa.array(slot), *[b[c] for c in ("length", "doc_ids", "record")]], names=["slot", "length", "doc_ids", "record"])

    return place


def _written(path: str, length: int, per_shard: int) -> Callable:
    stride = length * np.dtype(DTYPE).itemsize

    def write(table: pa.Table) -> pa.Table:
        from pyarrow import fs

        table = table.sort_by("slot")
        shard = table["shard"][0].as_py()
        files, folder = fs.FileSystem.from_uri(path)
        name, attempt = f"{folder}/{shard_name(shard)}", TaskContext.get().taskAttemptId()
        decompress, sums = zstandard.ZstdDecompressor().decompress, []
        with files.open_output_stream(f"{name}.{attempt}.part") as out:
            for record in table["record"]:
                ids = decompress(record.as_py())
                out.write(ids)
                sums.append(zlib.crc32(ids))
        # a second attempt writes the same bytes: whichever ends last stands
        files.move(f"{name}.{attempt}.part", name)
        slot = table["slot"].to_numpy()
        columns = {"slot": slot, "shard": table["shard"], "byte_offset": (slot - shard * per_shard) * stride, "n_tokens": table["length"], "ids_crc32": pa.array(sums, pa.int64()), "doc_ids": table["doc_ids"]}
        return pa.table(columns)

    return write


def shard_name(shard: int) -> str:
    return f"tokens-{shard:08d}.bin"


def materialise(docs: DataFrame, path: str, length: int = SEQUENCE, per_shard: int = SLOTS_PER_SHARD, key: int = KEY, vocabulary: str | None = None) -> DataFrame:
    """Write the shards below ``path`` (a URI or folder that executors share)
    and return a row per sequence: ``slot`` (0 to N - 1, gapless), ``shard,
    byte_offset, n_tokens`` (without padding), ``ids_crc32`` (of the whole
    record) and ``doc_ids`` (of the documents in it, in order).

    ``docs`` needs ``doc_id`` and ``text``; other columns are ignored. A null
    or empty text is the end id alone; rows with equal or null ids stand each
    for itself. An empty table writes no shard and gives no rows. The rows are
    the report of the writing, so they are stored when this returns.
    """
    need_columns(docs, "doc_id", "text")
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    # stored, so that a sequence keeps its number whatever is computed again
    rows = stored(docs.mapInArrow(_sequences(vocabulary or tokenizer_path(), length), "part int, at bigint, length int, doc_ids array<bigint>, record binary"), "sequences")
    sizes = rows.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    ahead = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = sizes.select("part", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("before"))
    total = rows.count()
    # one row per input partition is broadcast
    numbered = rows.join(F.broadcast(before), "part").select((F.col("before") + F.col("at")).alias("ordinal"), "length", "doc_ids", "record")
    slotted = numbered.mapInArrow(_slotted(total, key), "slot bigint, length int, doc_ids array<bigint>, record binary")
    slotted = slotted.withColumn("shard", F.expr(f"slot div {per_shard}"))
    from pyarrow import fs

    files, folder = fs.FileSystem.from_uri(path)
    files.create_dir(folder, recursive=True)
    schema = "slot bigint, shard bigint, byte_offset bigint, n_tokens int, ids_crc32 bigint, doc_ids array<bigint>"
    return stored(slotted.groupBy("shard").applyInArrow(_written(path, length, per_shard), schema), "shard-report")


def read_slots(path: str, first: int, count: int, length: int = SEQUENCE, per_shard: int = SLOTS_PER_SHARD) -> Iterator[np.ndarray]:
    """The ids of ``count`` slots from ``first`` on, read forward shard by
    shard; ends early after the last slot."""
    from pyarrow import fs

    files, folder = fs.FileSystem.from_uri(path)
    stride = length * np.dtype(DTYPE).itemsize
    slot = first
    while slot < first + count:
        name = f"{folder}/{shard_name(slot // per_shard)}"
        if files.get_file_info(name).type == fs.FileType.NotFound:
            return
        with files.open_input_file(name) as f:
            f.seek(slot % per_shard * stride)
            while slot < first + count and len(record := f.read(stride)) == stride:
                yield np.frombuffer(record, dtype=DTYPE)
                slot += 1
                if slot % per_shard == 0:
                    break
            else:
                return


def shards_folder(spark: SparkSession) -> str:
    """A new folder for shards below the shared folder, as a URI."""
    path = new_folder(spark, "token-shards")
    return path if "://" in path or path.startswith("file:") else f"file://{path}"
