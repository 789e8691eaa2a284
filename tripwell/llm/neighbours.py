"""Nearest neighbours by inner product: a block matrix join with a quantised first pass.

Queries and candidates are dealt into blocks, and every task takes one block of
queries and a lane of candidate blocks. Vectors are quantised to eight bits with a
scale of their own. The product of two quantised tiles, exact in single precision,
estimates all inner products, and the lengths of the quantisation errors bound how
far each estimate can be off. Pairs whose upper bound stays below a lower bound of
the k-th best go; the others are recomputed in double precision on the original
vectors and enter the query's heap. The heaps of the lanes are merged at the end.
No pair is lost: the result is exact.

Every row is a vector of its own, also where ids repeat: it is a candidate for all but
itself, and as a query it has ranks of its own under its id. Vectors that are null, empty, zero, or hold null or non-finite components, and those
without an id, take no part. Vectors of different length are never compared. Ties go
to the smaller id.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripwell.sources.storage import store

BLOCK, QUERY_BLOCK = 4096, 1024
_EXACT_DIM = 1 << 24


def usable(vector: Column) -> Column:
    """Whether a vector has a direction: no null or non-finite component and not all zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.coalesce(vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def quantise(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Eight-bit values, scales, lengths of the quantised vectors and of what they miss."""
    scale = np.abs(vectors).max(axis=1) / 127
    values = np.rint(vectors / scale[:, None])
    near = values * scale[:, None]
    return values.astype(np.int8), scale, np.linalg.norm(near, axis=1), np.linalg.norm(vectors - near, axis=1)


class QueryBlock:
    """The best ``k`` of every query of a block, over the candidate blocks shown so far."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray, vectors: np.ndarray, k: int):
        self.ids, self.rows, self.vectors, self.k = ids, rows, vectors, k
        self.values, self.scale, self.length, self.miss = quantise(vectors)
        self.heaps: list[list[tuple[float, int]]] = [[] for _ in ids]
        self.least = np.full(len(ids), -np.inf)

    def show(self, ids: np.ndarray, rows: np.ndarray, vectors: np.ndarray) -> None:
        values, scale, length, miss = quantise(vectors)
        kind = np.float32 if vectors.shape[1] * 127 * 127 < _EXACT_DIM else np.float64
        near = (self.values.astype(kind) @ values.astype(kind).T) * self.scale[:, None] * scale[None, :]
        off = self.miss[:, None] * (length + miss)[None, :] + self.length[:, None] * miss[None, :]
        off += 1e-9 * (self.length + self.miss)[:, None] * (length + miss)[None, :] + 1e-300
        own = self.rows[:, None] == rows[None, :]
        low = np.where(own, -np.inf, near - off)
        floor = self.least
        if len(ids) > self.k:
            floor = np.maximum(floor, np.partition(low, len(ids) - self.k, axis=1)[:, len(ids) - self.k])
        q, c = np.nonzero((near + off >= floor[:, None]) & ~own)
        scores = np.empty(len(q))
        for at in range(0, len(q), 50_000):
            part = slice(at, at + 50_000)
            scores[part] = np.einsum("ij,ij->i", self.vectors[q[part]], vectors[c[part]])
        cuts = np.searchsorted(q, np.arange(len(self.ids) + 1))
        for i in np.flatnonzero(np.diff(cuts)):
            part = slice(cuts[i], cuts[i + 1])
            some, found = scores[part], ids[c[part]]
            if len(some) > self.k:
                order = np.lexsort((found, -some))[:self.k]
                some, found = some[order], found[order]
            heap = self.heaps[i]
            for entry in zip(some.tolist(), (-found).tolist()):
                if len(heap) < self.k:
                    heapq.heappush(heap, entry)
                elif entry > heap[0]:
                    heapq.heapreplace(heap, entry)
            if len(heap) == self.k:
                self.least[i] = heap[0][0]

    def best(self) -> pa.RecordBatch:
        found = [(q, r, -minus, s) for q, r, heap in zip(self.ids.tolist(), self.rows.tolist(), self.heaps) for s, minus in heap]
        q, r, c, s = zip(*found) if found else ((), (), (), ())
        return pa.RecordBatch.from_pydict({"query_id": pa.array(q, pa.int64()), "query_row": pa.array(r, pa.int64()),
                                           "vec_id": pa.array(c, pa.int64()), "score": pa.array(s, pa.float64())})


def _packed(rows: DataFrame, block: Column) -> DataFrame:
    """One row per block: its ids, row numbers and vectors, one after the other."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def made(key, ids, numbers, parts):
            return pa.RecordBatch.from_pydict({
                "dim": pa.array([key[0]], pa.int32()), "block": pa.array([key[1]], pa.int64()),
                "ids": pa.array([np.concatenate(ids).tobytes()], pa.binary()),
                "rows": pa.array([np.concatenate(numbers).tobytes()], pa.binary()),
                "vectors": pa.array([np.concatenate(parts).tobytes()], pa.binary())})

        key, ids, numbers, parts = None, [], [], []
        for batch in batches:
            dims, blocks = (batch.column(c).to_numpy() for c in ("dim", "block"))
            cuts = [0, *(np.flatnonzero((np.diff(dims) != 0) | (np.diff(blocks) != 0)) + 1).tolist(), len(dims)]
            for a, b in zip(cuts, cuts[1:]):
                if a == b:
                    continue
                now = (int(dims[a]), int(blocks[a]))
                if key is not None and now != key:
                    yield made(key, ids, numbers, parts)
                    ids, numbers, parts = [], [], []
                key = now
                ids.append(batch.column("vec_id")[a:b].to_numpy())
                numbers.append(batch.column("row")[a:b].to_numpy())
                parts.append(batch.column("vector")[a:b].flatten().to_numpy())
        if key is not None:
            yield made(key, ids, numbers, parts)

    dealt = rows.withColumn("block", block).repartition("dim", "block").sortWithinPartitions("dim", "block", "vec_id", "row")
    return dealt.select("dim", "block", "vec_id", "row", "vector").mapInArrow(
        run, "dim int, block long, ids binary, rows binary, vectors binary")


def nearest(vectors: DataFrame, is_query: Column, k: int = 20, id_column: str = "vec_id",
            vector: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` largest inner products of each query with all other vectors.

    ``is_query`` is a condition on the id column, stated as ``vec_id``.
    """
    spark = vectors.sparkSession
    picked = vectors.select(F.col(id_column).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("vector"))
    usable_rows = picked.where(F.col("vec_id").isNotNull() & usable(F.col("vector")))
    # Stored, so that queries and candidates read the same row numbers.
    rows = store(usable_rows.withColumn("row", F.monotonically_increasing_id()), "vectors").withColumn("dim", F.size("vector"))
    sizes = rows.groupBy("dim").agg(F.count("*").alias("n"), F.count(F.when(is_query, 1)).alias("q")).collect()
    schema = "query_id long, rank int, vec_id long, score double"
    if not any(r.q for r in sizes):
        return spark.createDataFrame([], schema)
    parallel = int(spark.conf.get("spark.sql.shuffle.partitions"))
    candidate_blocks = {r.dim: -(-r.n // BLOCK) for r in sizes}
    query_blocks = {r.dim: -(-r.q // QUERY_BLOCK) for r in sizes if r.q}
    lanes = {d: max(1, min(candidate_blocks[d], -(-parallel // n))) for d, n in query_blocks.items()}

    def looked_up(values: dict[int, int]) -> Column:
        return F.create_map(*[F.lit(x) for pair in values.items() for x in pair])[F.col("dim")]

    hashed = F.xxhash64("row")
    wanted = rows.where(F.col("dim").isin(*query_blocks))
    candidates = _packed(wanted, F.pmod(hashed, looked_up(candidate_blocks)).cast("long")).select(
        "dim", F.explode(F.sequence(F.lit(0), looked_up(query_blocks) - 1)).alias("query_block"),
        F.pmod("block", looked_up(lanes)).cast("int").alias("lane"), F.lit(1).alias("kind"), "block", "ids", "rows", "vectors")
    queries = _packed(wanted.where(is_query), F.pmod(hashed, looked_up(query_blocks)).cast("long")).select(
        "dim", F.col("block").cast("int").alias("query_block"),
        F.explode(F.sequence(F.lit(0), looked_up(lanes) - 1)).alias("lane"), F.lit(0).alias("kind"), "block", "ids", "rows", "vectors")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, block = None, None
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("dim", "query_block", "lane", "kind")]
            for i, (dim, query_block, lane, kind) in enumerate(zip(*columns)):
                ids, numbers = (np.frombuffer(batch.column(c)[i].as_py(), np.int64) for c in ("ids", "rows"))
                found = np.frombuffer(batch.column("vectors")[i].as_py(), np.float64).reshape(-1, dim)
                if kind == 0:
                    if block is not None:
                        yield block.best()
                    key, block = (dim, query_block, lane), QueryBlock(ids, numbers, found, k)
                elif key == (dim, query_block, lane):
                    block.show(ids, numbers, found)
        if block is not None:
            yield block.best()

    met = queries.union(candidates).repartition("dim", "query_block", "lane").sortWithinPartitions(
        "dim", "query_block", "lane", "kind", "block")
    best = met.mapInArrow(search, "query_id long, query_row long, vec_id long, score double")
    order = Window.partitionBy("query_id", "query_row").orderBy(F.desc("score"), "vec_id")
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")
