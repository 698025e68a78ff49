"""Exact nearest neighbours of a stated query set by a block matrix join.

Vectors are quantised to int8 with one scale per vector and gathered into blocks.  Every
block of queries meets every block of candidates; the product of the int8 blocks bounds
each inner product from both sides, by the norms of what quantising left out.  Pairs
whose upper bound reaches the query's k-th best lower bound are recomputed in double
precision from the original vectors and merged in one bounded heap per query.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

K = 20
#: rows of a block of candidates and of queries, on average
CANDIDATE_ROWS = 4096
QUERY_ROWS = 1024
#: candidate blocks that one task matches with a query block before it hands on its heaps
BLOCKS_PER_GROUP = 16
#: survivors recomputed at a time
RECOMPUTE = 1 << 16

_BLOCK = "block int, dim int, n int, ids binary, vectors binary"


def usable(vec: Column) -> Column:
    """Not null, no null or non-finite component, not zero throughout."""
    def finite(x):
        return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    return F.coalesce(vec.isNotNull() & F.forall(vec, finite) & F.exists(vec, lambda x: x != 0),
                      F.lit(False))


def _blocks(vectors: DataFrame, rows: int) -> tuple[DataFrame, int]:
    """Vectors of ``(id, vec)`` in blocks of equal dimension, and the number of blocks of
    each dimension."""
    n_blocks = max(1, -(-vectors.count() // rows))

    def gather(table: pa.Table) -> pa.Table:
        vec = table.column("vec").combine_chunks()
        values = vec.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
        ids = table.column("id").to_numpy().astype(np.int64)
        return pa.table({
            "block": pa.array([table.column("block")[0].as_py()], pa.int32()),
            "dim": pa.array([table.column("dim")[0].as_py()], pa.int32()),
            "n": pa.array([len(ids)], pa.int32()),
            "ids": pa.array([ids.tobytes()], pa.binary()),
            "vectors": pa.array([values.tobytes()], pa.binary())})

    keyed = vectors.select("id", "vec", F.size("vec").alias("dim"), F.pmod(
        F.xxhash64("id", "vec"), F.lit(n_blocks)).cast("int").alias("block"))
    return keyed.groupBy("block", "dim").applyInArrow(gather, _BLOCK), n_blocks


class _Quantised:
    """int8 form ``scale * q`` of vectors, with the norms that bound its error."""

    def __init__(self, x: np.ndarray):
        top = np.abs(x).max(axis=1)
        self.scale = top / 127
        self.q = np.rint(x / self.scale[:, None]).astype(np.int8)
        approx = self.q * self.scale[:, None]
        self.left = np.linalg.norm(x - approx, axis=1)
        self.norm = np.linalg.norm(x, axis=1)
        self.approx_norm = np.linalg.norm(approx, axis=1)


def tile_bounds(a: _Quantised, b: _Quantised) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper bounds of all inner products of two blocks.

    The int8 product runs in a float type that holds its integer sums exactly:
    ``x.y - x^.y^ = x.(y - y^) + (x - x^).y^``."""
    exact = np.float32 if a.q.shape[1] * 127 * 127 < 1 << 24 else np.float64
    mid = (a.q.astype(exact) @ b.q.astype(exact).T) * a.scale[:, None] * b.scale
    room = np.outer(a.norm, b.left) + np.outer(a.left, b.approx_norm)
    room += 1e-9 * np.outer(a.norm, b.norm)     # rounding of the bounds themselves
    return mid - room, mid + room


def match(queries: np.ndarray, query_ids: np.ndarray, vectors: np.ndarray, ids: np.ndarray,
          heaps: list[list], k: int) -> None:
    """Merge one block of candidates into the queries' heaps of ``(score, -id)``."""
    low, high = tile_bounds(_Quantised(queries), _Quantised(vectors))
    own = query_ids[:, None] == ids
    low[own] = high[own] = -np.inf
    least = np.array([h[0][0] if len(h) == k else -np.inf for h in heaps])
    if len(ids) > k:
        least = np.maximum(least, np.partition(low, len(ids) - k, axis=1)[:, len(ids) - k])
    # scores in the heaps are rounded in the last places
    least = least - 1e-9 * np.abs(least).clip(max=np.finfo(np.float64).max)
    at_q, at_v = np.nonzero((high >= least[:, None]) & ~own)
    for lo in range(0, len(at_q), RECOMPUTE):
        qs, vs = at_q[lo:lo + RECOMPUTE], at_v[lo:lo + RECOMPUTE]
        scores = np.zeros(len(qs))
        for d in range(queries.shape[1]):       # in order, as a plain loop would add them
            scores += queries[qs, d] * vectors[vs, d]
        for q, item in zip(qs.tolist(), zip(scores.tolist(), (-ids[vs]).tolist())):
            heap = heaps[q]
            if len(heap) < k:
                heapq.heappush(heap, item)
            elif item > heap[0]:
                heapq.heapreplace(heap, item)


def nearest(vectors: DataFrame, queries: DataFrame, id_col: str = "vec_id",
            vec_col: str = "embedding", k: int = K) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` candidates of largest inner product of
    each query, nearest first, ties to the smaller id.

    ``queries`` and ``vectors`` have the columns ``id_col`` (integers) and ``vec_col``;
    others are not read.  Candidates with the query's id are the query itself and no
    answer.  Vectors that are null, zero or hold null or non-finite components, rows
    without id and vectors of another length than the query's take no part.  A query id
    with several vectors has an answer for each; equal query rows count once, equal
    candidate rows each.  Fewer candidates than ``k`` give as many answers.
    """
    def rows(df: DataFrame) -> DataFrame:
        return (df.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).alias("vec"))
                .where(F.col("id").isNotNull() & usable(F.col("vec"))))

    cand, n_cand = _blocks(rows(vectors), CANDIDATE_ROWS)
    asked, n_asked = _blocks(rows(queries).dropDuplicates(["id", "vec"]), QUERY_ROWS)
    n_groups = -(-n_cand // BLOCKS_PER_GROUP)
    left = asked.select(F.col("block").alias("qblock"), "dim", F.col("n").alias("nq"),
                        F.col("ids").alias("qids"), F.col("vectors").alias("qvec"),
                        F.explode(F.sequence(F.lit(0), F.lit(n_groups - 1))).alias("cgroup"))
    right = cand.select(F.explode(F.sequence(F.lit(0), F.lit(n_asked - 1))).alias("qblock"), "dim",
                        F.pmod("block", F.lit(n_groups)).alias("cgroup"),
                        F.col("n").alias("nc"), F.col("ids").alias("cids"), F.col("vectors").alias("cvec"))
    tiles = left.join(right, ["qblock", "cgroup", "dim"])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, qids, heaps = None, None, []

        def hand_on():
            rows = [(q, p, -v, s) for p, (q, heap) in enumerate(zip(qids.tolist(), heaps))
                    for s, v in heap]
            cols = list(zip(*rows)) if rows else [()] * 4
            return pa.RecordBatch.from_arrays(
                [pa.array(cols[0], pa.int64()),
                 pa.array([key[0] * (1 << 32) + p for p in cols[1]], pa.int64()),
                 pa.array(cols[2], pa.int64()), pa.array(cols[3], pa.float64())],
                names=["query_id", "query", "vec_id", "score"])

        for batch in batches:
            for r in range(batch.num_rows):
                row = {c: batch.column(c)[r].as_py() for c in batch.schema.names}
                dim, now = row["dim"], (row["qblock"], row["dim"], row["cgroup"])
                if now != key:
                    if key is not None:
                        yield hand_on()
                    key = now
                    qids = np.frombuffer(row["qids"], np.int64)
                    qvec = np.frombuffer(row["qvec"], np.float64).reshape(-1, dim)
                    heaps = [[] for _ in qids]
                match(qvec, qids, np.frombuffer(row["cvec"], np.float64).reshape(-1, dim),
                      np.frombuffer(row["cids"], np.int64), heaps, k)
        if key is not None:
            yield hand_on()

    found = tiles.mapInArrow(search, "query_id long, query long, vec_id long, score double")
    best = Window.partitionBy("query_id", "query").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
