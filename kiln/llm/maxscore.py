"""Exact top-k search by integer inner product with MaxScore over a sharded index.

Vectors are sparse rows of terms and integer weights, of either sign.  The index is cut into
shards; a shard holds the postings of each term (documents in order, with weights) and the
term's largest and smallest weight.  For a query these bound what each term can add.  Terms
are ordered by that bound: the cheapest ones whose bounds together stay below the query's
k-th best score so far are non-essential, as a document found in none of the other lists
cannot reach it.  Only the essential lists are traversed; the others are probed, largest
bound first, for the documents that are still competitive.  A task goes through the shards of
one group with the same thresholds; the groups' best are merged per query.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

K = 10
FACTOR = 1024
#: postings (and documents) of a shard, on average
SHARD_POSTINGS = 1 << 18
#: postings (and rows) of a block of queries, on average
QUERY_POSTINGS = 1 << 18
#: shards that one task searches in turn for a block of queries
SHARDS_PER_GROUP = 4
#: squared lengths below this keep every score within a long (Cauchy and Schwarz)
MAX_SQUARES = float(1 << 62)

_SHARD = ("part int, n int, ids binary, copies binary, terms binary, starts binary, "
          "highs binary, lows binary, docs binary, weights binary")
_QUERIES = "part int, ids binary, starts binary, terms binary, weights binary"


def quantised(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding",
              factor: int = FACTOR) -> DataFrame:
    """``id, terms, weights``: each component ``x`` as ``floor(factor * x)`` (in double), the
    places of the non-zero ones being the terms.

    Vectors that are null or hold null or non-finite components, and rows without id, are
    left out; so are vectors whose squared length reaches ``MAX_SQUARES``, as their scores
    need not fit a long.  Zero and empty vectors stay, without terms.
    """
    def finite(x: Column) -> Column:
        return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))

    whole = vectors.select(F.col(id_col).cast("long").alias("id"), F.transform(
        F.col(vec_col), lambda x: F.lit(float(factor)) * x.cast("double")).alias("x")).where(
        F.col("id").isNotNull() & F.coalesce(F.forall("x", finite), F.lit(False)))
    whole = whole.where(F.aggregate("x", F.lit(0.0), lambda a, v: a + v * v) < MAX_SQUARES)
    pairs = F.transform("x", lambda v, i: F.struct(i.alias("t"), F.floor(v).cast("long").alias("w")))
    return whole.select("id", F.filter(pairs, lambda p: p["w"] != 0).alias("p")).select(
        "id", F.col("p.t").alias("terms"), F.col("p.w").alias("weights"))


def _dealt(rows: DataFrame, size: int) -> tuple[DataFrame, int]:
    """Distinct ``id, terms, weights`` with their ``copies``, dealt evenly over ``part``s of
    ``size`` postings, and the number of parts.  Equal rows are counted before the shuffle."""
    total = rows.agg(F.sum(F.size("terms") + 1)).first()[0] or 0
    n = max(1, -(-total // size))
    distinct = rows.groupBy("id", "terms", "weights").agg(F.count(F.lit(1)).alias("copies"))
    return distinct.withColumn("part", F.pmod(
        F.xxhash64("id", "terms", "weights"), F.lit(n)).cast("int")), n


def _flat(table: pa.Table, name: str) -> tuple[np.ndarray, np.ndarray]:
    col = table.column(name).combine_chunks()
    return col.flatten().to_numpy(zero_copy_only=False).astype(np.int64), np.diff(
        col.offsets.to_numpy().astype(np.int64))


def _one_row(part: int, n: int | None, arrays: dict[str, np.ndarray]) -> pa.Table:
    cols = {"part": pa.array([part], pa.int32())}
    if n is not None:
        cols["n"] = pa.array([n], pa.int32())
    return pa.table({**cols, **{k: pa.array([v.tobytes()], pa.binary()) for k, v in arrays.items()}})


def build_shard(table: pa.Table) -> pa.Table:
    """One row with the postings of the documents of a shard, term by term."""
    terms, sizes = _flat(table, "terms")
    weights, _ = _flat(table, "weights")
    docs = np.repeat(np.arange(len(sizes)), sizes)
    order = np.lexsort((docs, terms))
    terms, weights, docs = terms[order], weights[order], docs[order]
    named, first, counts = np.unique(terms, return_index=True, return_counts=True)
    highs = np.maximum.reduceat(weights, first) if len(first) else weights
    lows = np.minimum.reduceat(weights, first) if len(first) else weights
    # a list of half the documents or more names them all, with weight 0 where the term is not
    n = len(sizes)
    full = counts * 2 >= n
    kept = np.where(full, n, counts)
    starts = np.append(0, np.cumsum(kept))
    term_of = np.repeat(np.arange(len(named)), counts)
    place = starts[term_of] + np.where(full[term_of], docs, np.arange(len(docs)) - first[term_of])
    all_docs = np.arange(starts[-1]) - np.repeat(starts[:-1], kept)
    all_docs[place] = docs
    all_weights = np.zeros(starts[-1], np.int64)
    all_weights[place] = weights
    return _one_row(table.column("part")[0].as_py(), n, {
        "ids": table.column("id").to_numpy().astype(np.int64),
        "copies": table.column("copies").to_numpy().astype(np.int64),
        "terms": named, "starts": starts.astype(np.int64), "highs": highs, "lows": lows,
        "docs": all_docs.astype(np.int32), "weights": all_weights})


def _query_block(table: pa.Table) -> pa.Table:
    terms, sizes = _flat(table, "terms")
    weights, _ = _flat(table, "weights")
    return _one_row(table.column("part")[0].as_py(), None, {
        "ids": table.column("id").to_numpy().astype(np.int64),
        "starts": np.append(0, np.cumsum(sizes)).astype(np.int64), "terms": terms, "weights": weights})


class Shard:
    """Postings of one shard, read back from its row."""

    def __init__(self, row: dict):
        self.n = row["n"]
        for name in ("ids", "copies", "terms", "starts", "highs", "lows", "weights"):
            setattr(self, name, np.frombuffer(row[name], np.int64))
        self.docs = np.frombuffer(row["docs"], np.int32)

    def _postings(self, t: int) -> tuple[np.ndarray, np.ndarray]:
        lo, hi = self.starts[t], self.starts[t + 1]
        return self.docs[lo:hi], self.weights[lo:hi]

    def _probe(self, t: int, wanted: np.ndarray) -> np.ndarray:
        """Weights of term ``t`` in the documents ``wanted`` (ascending), 0 where it is not."""
        docs, weights = self._postings(t)
        if len(docs) == self.n:
            return weights[wanted]
        at = np.searchsorted(docs, wanted)
        at[at == len(docs)] = 0
        return np.where(docs[at] == wanted, weights[at], 0)

    def search(self, terms: np.ndarray, weights: np.ndarray, least: int | None) -> tuple[np.ndarray, np.ndarray, int]:
        """Documents that reach the score ``least`` (all, without it), their scores, and how
        many postings were met.  Documents below it may be missing, none at or above it is."""
        at = np.searchsorted(self.terms, terms)
        at[at == len(self.terms)] = 0
        there = self.terms[at] == terms if len(self.terms) else np.zeros(len(terms), bool)
        at, q = at[there], weights[there]
        most = np.maximum(np.where(q > 0, q * self.highs[at], q * self.lows[at]), 0)
        order = np.argsort(most, kind="stable")
        at, q = at[order], q[order]
        # room[j]: what the j cheapest terms can add; a float, rounded up
        room = np.append(0.0, np.cumsum(most[order].astype(np.float64)) * (1 + 1e-9))
        cheap = 0
        if least is not None and least > 0:
            cheap = int(np.searchsorted(room, least, side="left")) - 1
        score = np.zeros(self.n, np.int64)
        found = np.zeros(self.n, bool) if cheap else None
        met = 0
        for j in range(len(at) - 1, cheap - 1, -1):
            docs, w = self._postings(at[j])
            met += len(docs)
            if len(docs) == self.n:
                score += q[j] * w
                found = None
            else:
                score[docs] += q[j] * w
                if found is not None:
                    found[docs] = True
        if least is None:
            return np.arange(self.n), score, met
        near = score + room[cheap] >= least
        if found is not None:
            near &= found
        left = np.nonzero(near)[0]
        score = score[left]
        for j in range(cheap - 1, -1, -1):
            if not len(left):
                break
            score += q[j] * self._probe(at[j], left)
            met += len(left)
            keep = score + room[j] >= least
            left, score = left[keep], score[keep]
        return left, score, met


def merge(best: list, shard: Shard, docs: np.ndarray, scores: np.ndarray, own: int, k: int) -> list:
    """The ``k`` best of ``best`` and the documents found, as ``(-score, id, copies)``."""
    others = shard.ids[docs] != own
    docs, scores = docs[others], scores[others]
    if len(docs) > k:
        kth = np.partition(scores, len(scores) - k)[len(scores) - k]
        docs, scores = docs[scores >= kth], scores[scores >= kth]
        if len(docs) > k:
            first = np.lexsort((shard.ids[docs], -scores))[:k]
            docs, scores = docs[first], scores[first]
    return sorted(best + list(zip((-scores).tolist(), shard.ids[docs].tolist(),
                                  shard.copies[docs].tolist())))[:k]


def search(vectors: DataFrame, queries: DataFrame, k: int = K) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` highest inner products of each query with
    all vectors, ties to the smaller id; exact.

    Both tables have ``id`` (not null), ``terms`` (each once) and ``weights`` (integers), as
    :func:`quantised` gives them; other columns are not read.  A term that a vector lacks
    counts as 0, so vectors without terms score 0 and take part, and vectors of different
    lengths meet on the terms they share.  Vectors with the query's id are the query itself
    and no answer.  Equal vector rows are answers each; equal query rows count once, and a
    query id with several vectors has answers for each.  Fewer vectors than ``k`` give as many
    answers; empty tables give none.  Long vectors only mean fewer of them in a shard.
    """
    shards, n_shards = _dealt(vectors, SHARD_POSTINGS)
    blocks, n_blocks = _dealt(queries, QUERY_POSTINGS)
    n_groups = -(-n_shards // SHARDS_PER_GROUP)
    index = (shards.groupBy("part").applyInArrow(build_shard, _SHARD)
             .withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))))
             .withColumn("grp", F.pmod("part", F.lit(n_groups))))
    asked = (blocks.groupBy("part").applyInArrow(_query_block, _QUERIES)
             .withColumn("block", F.col("part"))
             .withColumn("grp", F.explode(F.sequence(F.lit(0), F.lit(n_groups - 1)))))

    def tile(asked: pa.Table, shards: pa.Table) -> pa.Table:
        out: list[tuple] = []
        if asked.num_rows and shards.num_rows:
            row = asked.to_pylist()[0]
            ids, starts, terms, weights = (np.frombuffer(row[c], np.int64)
                                           for c in ("ids", "starts", "terms", "weights"))
            best: list[list] = [[] for _ in ids]
            for r in range(shards.num_rows):
                shard = Shard(shards.slice(r, 1).to_pylist()[0])
                for p, own in enumerate(ids.tolist()):
                    least = -best[p][-1][0] if len(best[p]) == k else None
                    lo, hi = starts[p], starts[p + 1]
                    docs, scores, _ = shard.search(terms[lo:hi], weights[lo:hi], least)
                    best[p] = merge(best[p], shard, docs, scores, own, k)
            block = row["block"] << 32
            out = [(own, block + p, v, -s, min(c, k))
                   for p, own in enumerate(ids.tolist()) for s, v, c in best[p]]
        cols = list(zip(*out)) if out else [()] * 5
        names = ("query_id", "query", "vec_id", "score", "copies")
        return pa.table({n: pa.array(c, pa.int64()) for n, c in zip(names, cols)})

    found = (asked.groupBy("block", "grp").cogroup(index.groupBy("block", "grp"))
             .applyInArrow(tile, "query_id long, query long, vec_id long, score long, copies long"))
    each = found.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies")))
    order = Window.partitionBy("query_id", "query").orderBy(F.desc("score"), "vec_id", "copy")
    return (each.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
