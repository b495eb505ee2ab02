"""Near-duplicate vectors by a subspace pigeonhole join (operator 3).

Unit vectors with cosine >= c are at most sqrt(2 (1 - c)) apart. A rotation
spreads the energy evenly over the coordinates, which are dealt into blocks of
a few dimensions; each block gets a share of the squared distance in
proportion to its dimensions. The squared distances of the blocks add up to
the whole, so a linked pair keeps to its budget in one block at least. Each
block is range-joined on a grid over its first dimensions, and a pair that
keeps the budget there is verified with the full vectors, in double precision.

A pair that keeps to its budget in several blocks counts in the first of
them only, so the union of the candidates needs no pairs to be written: each
task returns sums and a spanning forest. Equal vectors are one vector with a
weight. Cells that hold many vectors are dealt into chunks, and pairs of chunks
go to tasks of their own.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalog_engine.llm.common import connected_components, cut, need_columns

COSINE = 0.95
BLOCK_DIMS = 8
GRID_DIMS = 3
#: Vectors of a cell that one chunk holds.
CHUNK_ROWS = 8192
#: Pairs that are verified at once.
PAIRS = 20_000
SEED = 11
#: Rounding in the budgets; verification is exact.
EPS = 1e-9
#: Slack of the first look, which is in single precision.
ROUGH = 1e-5


def unit(x: np.ndarray) -> np.ndarray:
    """Rows of length one. All sums run elementwise in a fixed order, so that a
    vector gets the same numbers in every task."""
    total = np.zeros(len(x))
    for k in range(x.shape[1]):
        total += x[:, k] * x[:, k]
    return x / np.sqrt(total)[:, None]


def rotated(u: np.ndarray, seed: int = SEED) -> np.ndarray:
    """Two rounds of random signs and a Walsh-Hadamard transform, after zeros
    are added up to a power of two: an orthogonal map, exact in its
    coefficients and thus the same on every machine."""
    dims = max(BLOCK_DIMS, 1 << max(0, (u.shape[1] - 1).bit_length()))
    y = np.zeros((len(u), dims))
    y[:, : u.shape[1]] = u
    rng = np.random.default_rng(seed)
    for _ in range(2):
        y = y * (1 - 2 * rng.integers(0, 2, dims))
        h = 1
        while h < dims:
            z = y.reshape(len(y), -1, 2, h)
            y = np.concatenate([z[:, :, :1] + z[:, :, 1:], z[:, :, :1] - z[:, :, 1:]], axis=2).reshape(len(y), dims)
            h *= 2
        y = y / np.sqrt(dims)
    return y


def budget(dims: int, cosine: float) -> float:
    """The share of one block in the squared distance."""
    return 2 * (1 - cosine) * BLOCK_DIMS / dims + EPS


def grid(y: np.ndarray, block: int, cosine: float) -> tuple[np.ndarray, np.ndarray]:
    """(row, cell) of the cells where each row is compared in a block: its own,
    and each smaller one that its ball reaches. Cells are two radii wide, so
    a ball reaches one neighbour in each dimension."""
    width = 2 * np.sqrt(budget(y.shape[1], cosine))
    at = y[:, block * BLOCK_DIMS : block * BLOCK_DIMS + GRID_DIMS] / width
    home = np.floor(at)
    near = np.where(at - home < 0.5, -1, 1)
    code = lambda c: ((c[:, 0] + 512) * 1024 + c[:, 1] + 512) * 1024 + c[:, 2] + 512
    own = code(home).astype(np.int64)
    rows, cells = [np.arange(len(y))], [own]
    for move in range(1, 2**GRID_DIMS):
        other = code(home + near * [(move >> k) & 1 for k in range(GRID_DIMS)]).astype(np.int64)
        smaller = np.flatnonzero(other < own)
        rows.append(smaller)
        cells.append(other[smaller])
    return np.concatenate(rows), np.concatenate(cells)


def _matrix(column: pa.Array | pa.ChunkedArray, dims: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy().astype(np.float64).reshape(-1, dims)


def _dealt(cosine: float) -> Callable:
    """Every vector in every cell where it is compared."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths = np.asarray(batch["embedding"].value_lengths())
            for dims in np.unique(lengths):
                part = batch.filter(pa.array(lengths == dims))
                y = rotated(unit(_matrix(part["embedding"], int(dims))))
                for block in range(y.shape[1] // BLOCK_DIMS):
                    rows, cells = grid(y, block, cosine)
                    home = np.r_[np.ones(len(y), dtype=bool), np.zeros(len(rows) - len(y), dtype=bool)]
                    n = len(rows)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(n, x, dtype=np.int32)) for x in (dims, block)]
                        + [pa.array(cells), pa.array(home)] + [part[c].take(pa.array(rows)) for c in ("uid", "weight", "embedding")],
                        names=["dims", "block", "cell", "home", "uid", "weight", "embedding"],
                    )

    return deal


class _Forest:
    def __init__(self, n: int):
        self.up = np.arange(n)

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        up = self.up
        apart = up[a] != up[b]
        for i, j in zip(a[apart].tolist(), b[apart].tolist()):
            x, y = up[i], up[j]
            if x != y:
                up[up == max(x, y)] = min(x, y)


def _near_rows(left: np.ndarray, right: np.ndarray, side: np.ndarray, least: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of rows to look at, of a chunk of a cell (side 0) with itself, or of
    one (0 or 1) with another (2) or with visitors (3)."""
    first, own, second = np.flatnonzero(side <= 1), np.flatnonzero(side == 0), np.flatnonzero(side >= 2)
    step = max(1, 4_000_000 // max(1, len(own) + len(second)))
    for k in range(0, len(first), step):
        rows = first[k : k + step]
        cols = np.concatenate([own[k:], second])
        a, b = np.nonzero(left[rows] @ right[cols].T >= least)
        a, b = rows[a], cols[b]
        once = (a < b) | (side[b] >= 2)
        yield a[once], b[once]


def _compared(cosine: float) -> Callable:
    """Links of a task, as weights per vector and a forest."""

    def compare(table: pa.Table) -> pa.Table:
        table = table.sort_by([("uid", "ascending"), ("side", "ascending")])
        dims, block = (table[c][0].as_py() for c in ("dims", "block"))
        x = _matrix(table["embedding"], dims)
        uid, weight, side = (table[c].to_numpy() for c in ("uid", "weight", "side"))
        u = unit(x)
        y = rotated(u)
        share = budget(y.shape[1], cosine)
        z = np.ascontiguousarray(y[:, block * BLOCK_DIMS : (block + 1) * BLOCK_DIMS])
        # z.z' - |z|^2 / 2 - |z'|^2 / 2 is minus half the squared distance
        half, one = -(z * z).sum(axis=1, keepdims=True) / 2, np.ones((len(z), 1))
        left, right = (np.hstack(p).astype(np.float32) for p in ([z, half, one], [z, one, half]))
        links, forest, n = np.zeros(len(x), dtype=np.int64), _Forest(len(x)), len(x)
        for a, b in _near_rows(left, right, side, -share / 2 - ROUGH):
            for s in range(0, len(a), PAIRS):
                p, q = a[s : s + PAIRS], b[s : s + PAIRS]
                apart = ((y[p] - y[q]) ** 2).reshape(len(p), -1, BLOCK_DIMS).sum(axis=2)
                own = (apart[:, block] <= share) & ~(apart[:, :block] <= share).any(axis=1)
                p, q = p[own], q[own]
                linked = np.einsum("ij,ij->i", u[p], u[q]) >= cosine
                p, q = p[linked], q[linked]
                links += np.bincount(p, weights=weight[q], minlength=n).astype(np.int64) + np.bincount(q, weights=weight[p], minlength=n).astype(np.int64)
                forest.join(p, q)
        found = np.flatnonzero(links)
        return pa.table({"uid": uid[found], "links": links[found], "root": uid[forest.up[found]]})

    return compare


def link_vectors(vectors: DataFrame, cosine: float = COSINE, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """One row per vector: ``vec_id, n_links, component_id, kept``.

    Two vectors link when their cosine, in double precision, is at least
    ``cosine``; equal vectors always do. Vectors that are null, empty, zero or
    hold null or non-finite components link with nothing, nor do vectors of
    different lengths. Rows that share a vec_id are vectors of their own that
    carry the same id; a row with a null vec_id counts as a link partner, and
    is kept only where its class has no id. Other columns are ignored; an
    empty table gives no rows.
    """
    need_columns(vectors, "vec_id", "embedding")
    vectors = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").alias("raw"))
    finite = F.forall("raw", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    nonzero = F.exists("raw", lambda v: v != 0)
    good = F.coalesce(finite & nonzero, F.lit(False))
    vectors = vectors.withColumn("embedding", F.when(good, F.col("raw"))).drop("raw")
    classes = cut(
        vectors.where("embedding is not null").groupBy("embedding")
        .agg(F.min("vec_id").alias("first_id"), F.count(F.lit(1)).alias("weight"))
        .withColumn("uid", F.xxhash64("embedding"))
    )
    schema = f"dims int, block int, cell bigint, home boolean, uid bigint, weight bigint, embedding {dict(classes.dtypes)['embedding']}"
    dealt = classes.select("uid", "weight", "embedding").mapInArrow(_dealt(cosine), schema)
    # coordinates of unit vectors lie in [-1, 1], so there are at most
    # (2 / width + 2)^3 cells for each block and length of vectors
    home = F.count_if("home")
    chunks = lambda n: F.ceil(n / chunk_rows).cast("int")
    cells = cut(dealt.groupBy("dims", "block", "cell").agg(chunks(home).alias("homes"), chunks(F.count_if(~F.col("home"))).alias("visits")).where("homes > 0"))
    dealt = dealt.join(F.broadcast(cells), ["dims", "block", "cell"])
    dealt = dealt.withColumn("own", F.pmod(F.xxhash64("uid", F.lit(1)), F.when(F.col("home"), F.col("homes")).otherwise(F.col("visits"))).cast("int"))
    # a chunk of the cell meets every chunk (0 to homes - 1, itself too) and every
    # chunk of visitors (homes + 1 on); the first chunk of visitors rides with
    # each chunk that meets itself
    partners = F.expr("if(home, filter(sequence(0, homes + visits - 1), x -> x <> homes or visits = 0), sequence(0, homes - 1))")
    dealt = dealt.withColumn("other", F.explode(partners))
    i = F.expr("case when not home then other when other < homes then least(own, other) else own end")
    j = F.expr("case when not home then if(own = 0, other, homes + own) when other < homes then greatest(own, other) else other end")
    side = F.expr("case when not home then 3 when other = own then 0 when other > own then 1 else 2 end")
    dealt = dealt.select("dims", "block", "cell", i.alias("i"), j.alias("j"), side.alias("side"), "uid", "weight", "embedding")
    found = cut(dealt.groupBy("dims", "block", "cell", "i", "j").applyInArrow(_compared(cosine), "uid bigint, links bigint, root bigint"))
    links = found.groupBy("uid").agg(F.sum("links").alias("links"))
    joined = connected_components(found.where("uid != root"), "uid", "root").select(F.col("id").alias("uid"), "component")
    classes = classes.join(links, "uid", "left").join(joined, "uid", "left").withColumn("component", F.coalesce("component", "uid"))
    smallest = classes.groupBy("component").agg(F.min("first_id").alias("component_id"))
    classes = classes.join(smallest, "component").select("embedding", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"), "component_id")
    out = vectors.join(classes, "embedding", "left")
    component = F.coalesce("component_id", "vec_id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.col("vec_id").eqNullSafe(component).alias("kept"))
