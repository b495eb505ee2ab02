"""Best-fit packing of documents into token sequences (operator 5).

Hierarchical residual packing: every input partition packs its own pieces by
best fit (longest first) and emits the bins that are nearly full; the
underfull bins go on as items, unopened, into fewer groups, which pack them by
best fit again, and so on until one group is left or a round stops paying.
Only lengths and checksums move, never token ids.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalog_engine.llm.common import cached_tokenizer, cut, need_columns, tokenizer_path

CAPACITY = 4096
#: A bin with at most this many free places is closed at once.
SLACK = 4
#: Bins that one task packs again in a later round.
GROUP_ITEMS = 50_000
#: A round that saves a smaller share of the open bins than this is the last.
LEAST_GAIN = 0.002
END_ID = 1

PIECE = "struct<doc_id:bigint,piece:int,start:bigint,length:bigint,ids_crc32:bigint>"
BINS = f"size bigint, members array<{PIECE}>"
_PIECE = pa.struct([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())])
_BINS = pa.schema([("size", pa.int64()), ("members", pa.list_(_PIECE))])


def best_fit(sizes: list[int], capacity: int) -> list[list[int]]:
    """Indices of ``sizes`` per bin. Longest first; each goes to the bin with
    the least room that holds it. One bit per amount of room says whether a
    bin with that much is open, so the search is a shift and a mask."""
    bins: list[list[int]] = []
    by_room: dict[int, list[int]] = {}
    rooms = 0
    for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        size = sizes[i]
        fit = rooms >> size
        if fit:
            room = size + (fit & -fit).bit_length() - 1
            at = by_room[room].pop()
            if not by_room[room]:
                rooms &= ~(1 << room)
            bins[at].append(i)
        else:
            room, at = capacity, len(bins)
            bins.append([i])
        if room > size:
            by_room.setdefault(room - size, []).append(at)
            rooms |= 1 << (room - size)
    return bins


def _pack(items: list[tuple[int, list]], capacity: int) -> list[tuple[int, list]]:
    return [(sum(items[i][0] for i in b), [m for i in b for m in items[i][1]]) for b in best_fit([s for s, _ in items], capacity)]


def _batches(bins: list[tuple[int, list]], rows: int = 20_000) -> Iterator[pa.RecordBatch]:
    names = [f.name for f in _PIECE]
    for k in range(0, len(bins), rows):
        part = bins[k : k + rows]
        yield pa.RecordBatch.from_arrays([pa.array([s for s, _ in part], pa.int64()), pa.array([[dict(zip(names, m)) for m in ms] for _, ms in part], pa.list_(_PIECE))], schema=_BINS)


def cut_pieces(doc_id: int | None, ids: bytes, capacity: int) -> list[tuple]:
    """(doc_id, piece, start, length, crc32) of a document's ids, given as
    little-endian unsigned 32-bit integers; only a longer one is cut."""
    n = len(ids) // 4
    return [(doc_id, k, s, min(capacity, n - s), zlib.crc32(ids[4 * s : 4 * (s + capacity)])) for k, s in enumerate(range(0, n, capacity))]


def _local(capacity: int, vocabulary: str) -> Callable:
    end = END_ID.to_bytes(4, "little")

    def pack_partition(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, items = cached_tokenizer(vocabulary), []
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1)
            for k in range(0, len(ids), 500):
                for doc_id, raw in zip(ids[k : k + 500], tokens.ids(texts[k : k + 500].to_pylist())):
                    items += [(p[3], [p]) for p in cut_pieces(doc_id, raw + end, capacity)]
        yield from _batches(_pack(items, capacity))

    return pack_partition


def _again(capacity: int) -> Callable:
    names = [f.name for f in _PIECE]

    def pack_group(table: pa.Table) -> pa.Table:
        items = [(s, [tuple(m[n] for n in names) for m in ms]) for s, ms in zip(table["size"].to_pylist(), table["members"].to_pylist())]
        # the order in which a shuffle delivers rows may differ when a task runs again
        items.sort(key=lambda x: (x[0], [tuple(-1 if v is None else v for v in m) for m in x[1]]))
        return pa.Table.from_batches(_batches(_pack(items, capacity)), schema=_BINS)

    return pack_group


def _placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per piece, with its place in its sequence."""
    for batch in batches:
        ids, lists = batch.column(0).to_numpy(), batch.column(1)
        members, bin_of = lists.flatten(), lists.value_parent_indices().to_numpy()
        length = members.field("length").to_numpy()
        ends = np.cumsum(length)
        first = np.searchsorted(bin_of, bin_of)
        offset = ends - length - (ends - length)[first]
        names = [f.name for f in _PIECE]
        columns = {n: members.field(n) for n in names} | {"sequence_id": pa.array(ids[bin_of]), "offset": pa.array(offset)}
        for k in range(0, len(length), 50_000):
            yield pa.RecordBatch.from_pydict({n: c[k : k + 50_000] for n, c in columns.items()})


def pack(docs: DataFrame, capacity: int = CAPACITY, vocabulary: str | None = None, group_items: int = GROUP_ITEMS) -> DataFrame:
    """One row per piece: ``doc_id, piece, start, length, ids_crc32,
    sequence_id, offset``; the pieces of a sequence fill it from offset 0
    without a gap, ``capacity`` tokens at most.

    ``docs`` needs ``doc_id`` and ``text``; other columns are ignored. A null
    or empty text is one piece of the end id alone. Rows with equal (or null)
    ids are packed each on its own. An empty table gives no rows.
    """
    need_columns(docs, "doc_id", "text")
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    bins = cut(docs.mapInArrow(_local(capacity, vocabulary or tokenizer_path()), BINS))
    full = F.col("size") >= capacity - SLACK
    closed, rest = [bins.where(full)], bins.where(~full)
    count = rest.count()
    while count > 1:
        groups = -(-count // group_items)
        spread = F.pmod(F.xxhash64("size", F.col("members")[0], F.lit(len(closed))), F.lit(groups))
        packed = cut(rest.withColumn("_group", spread).groupBy("_group").applyInArrow(_again(capacity), BINS))
        closed.append(packed.where(full))
        rest = packed.where(~full)
        before, count = count, rest.count()
        if groups == 1 or packed.count() > before * (1 - LEAST_GAIN):
            break
    every = rest
    for part in closed:
        every = every.unionByName(part)
    every = every.withColumn("sequence_id", F.monotonically_increasing_id())
    return every.select("sequence_id", "members").mapInArrow(_placed, f"{PIECE[7:-1].replace(':', ' ')}, sequence_id bigint, offset bigint")
