"""ALS over more ratings than the blocks of Spark's solver hold.

Spark's ALS deals all ratings to ``numUserBlocks`` and ``numItemBlocks`` blocks, each with its
ratings and the other side's factors in one task's memory, and the factors it starts from
depend on the number of user blocks.  Here users and items are dealt to as many shards as the
ratings ask for, and the model stays that of Spark's blocks: Spark draws the first user factors
(a fit of no iteration, over one rating for each user), and each half step solves the normal
equations that Spark's solver solves, ``(sum y y' + reg * n * I) x = sum r y``.

A half step is two cogroups: the shards of the side that is known send each shard of the other
those factors that its ratings name, and each shard solves its ids from what it got.  A shard
solves its ratings window by window, so a user with many of them needs no more memory.
"""

from __future__ import annotations

import sys
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kiln.session import FREE_SHUFFLES, checkpoint_dir, settings

# tasks get these functions whole, whether or not the package is on their path
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: ratings of a shard, about; the model does not depend on it
SHARD_RATINGS = 500_000
#: ratings whose products are in memory at a time, and those summed by one product of matrices
WINDOW, PIECE = 8_192, 16
#: bytes of one batch between a task and its Python, about
BATCH_BYTES = 1 << 22

_FIELDS = {"int": pa.int32(), "binary": pa.binary()}
#: ``at`` is where a row lies.  Ratings: shard ``at``'s ids, where the ratings of each start,
#: which of the factors got each rating takes, and its value.  Requests: the ids at ``at`` whose
#: factors ``shard`` takes; ``starts`` and the rest are null
_DEALT = "at int, shard int, ids binary, starts binary, source binary, rating binary"
_SENT = "at int, sender int, factors binary"
_FACTORS = "at int, ids binary, factors binary"


@dataclass
class Dealt:
    """The ratings by user shard and by item shard, and the distinct users."""
    by_user: DataFrame
    by_item: DataFrame
    users: DataFrame
    shards: int

    @property
    def partitions(self) -> int:
        # as many again, as a hash leaves some without a shard
        return 2 * self.shards


def _arrow(schema: str, rows: list[tuple]) -> pa.Table:
    fields = [f.split() for f in schema.split(", ")]
    columns = zip(*rows) if rows else [()] * len(fields)
    return pa.table([pa.array(c, _FIELDS[t]) for c, (_, t) in zip(columns, fields)],
                    names=[n for n, _ in fields])


def _ints(value: pa.Scalar) -> np.ndarray:
    return np.frombuffer(value.as_buffer(), np.int32)


def _shard(col, shards: int):
    return F.pmod(F.hash(col), F.lit(shards))


def _deal(table: pa.Table) -> pa.Table:
    """The ratings of one shard as one row, and its requests to each shard of the other side."""
    shard = table.column("at")[0].as_py()
    other, ids, source, rating = (table.column(c).to_numpy() for c in ("other", "id", "source", "rating"))
    order = np.lexsort((rating, source, ids))
    other, ids, source, rating = other[order], ids[order], source[order], rating[order]
    # factors arrive shard by shard, in each by id
    asked, place = np.unique((other.astype(np.int64) << 32) + source + 2**31, return_inverse=True)
    starts = np.flatnonzero(np.append(True, ids[1:] != ids[:-1])).astype(np.int32)
    rows = [(shard, shard, ids[starts].tobytes(), starts.tobytes(), place.astype(np.int32).tobytes(),
             rating.tobytes())]
    senders, cut = np.unique(asked >> 32, return_index=True)
    wanted = ((asked & 0xFFFFFFFF) - 2**31).astype(np.int32)
    for sender, part in zip(senders.tolist(), np.split(wanted, cut[1:])):
        rows.append((sender, shard, part.tobytes(), None, None, None))
    return _arrow(_DEALT, rows)


def _pack(table: pa.Table) -> pa.Table:
    """Rows ``(id, features)`` of a shard as one row, by id."""
    ids = table.column("id").to_numpy()
    order = np.argsort(ids)
    features = table.column("features").combine_chunks()
    factors = features.flatten().to_numpy().reshape(len(ids), -1)[order]
    return _arrow(_FACTORS, [(table.column("at")[0].as_py(), ids[order].tobytes(), factors.tobytes())])


def _unpack(rank: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, factors in zip(batch.column("ids"), batch.column("factors")):
                ids, values = _ints(ids), np.frombuffer(factors.as_buffer(), np.float32)
                features = pa.ListArray.from_arrays(pa.array(np.arange(len(ids) + 1, dtype=np.int32) * rank), values)
                for part in pa.table([ids, features], names=["id", "features"]).to_batches(10_000):
                    yield part
    return rows


def _send(rank: int):
    def send(known: pa.Table, requests: pa.Table) -> pa.Table:
        if not known.num_rows or not requests.num_rows:
            return _arrow(_SENT, [])
        sender, ids = known.column("at")[0].as_py(), _ints(known.column("ids")[0])
        factors = np.frombuffer(known.column("factors")[0].as_buffer(), np.float32).reshape(-1, rank)
        tables, rows, size = [], [], 0
        for shard, asked in zip(requests.column("shard").to_pylist(), requests.column("ids")):
            rows.append((shard, sender, factors[np.searchsorted(ids, _ints(asked))].tobytes()))
            size += len(rows[-1][2])
            if size >= BATCH_BYTES:
                tables.append(_arrow(_SENT, rows))
                rows, size = [], 0
        return pa.concat_tables([*tables, _arrow(_SENT, rows)])
    return send


def normal_solutions(starts: np.ndarray, source: np.ndarray, rating: np.ndarray, factors: np.ndarray,
                     reg: float, window: int = WINDOW, piece: int = PIECE) -> np.ndarray:
    """For each id, whose ratings begin at ``starts``, the solution of its normal equations over
    its ratings ``rating`` of ``factors[source]``; sums in double precision, as Spark's.

    An id's ratings are summed in pieces, the last filled up with zeros; sums of an id whose
    ratings go on behind a window are carried into the next."""
    n, rank = len(source), factors.shape[1]
    ends = np.append(starts[1:], n)
    diagonal = np.arange(rank)
    found, carried = np.empty((len(starts), rank), np.float32), 0.0
    for a in range(0, n, window):
        b = min(a + window, n)
        first, last = np.searchsorted(starts, a, "right") - 1, np.searchsorted(starts, b)
        begin = np.maximum(starts[first:last] - a, 0)
        length = np.minimum(ends[first:last] - a, b - a) - begin
        pieces = -(-length // piece)
        lead = np.cumsum(pieces) - pieces
        at = np.arange(b - a) + np.repeat(lead * piece - begin, length)
        terms = np.zeros((pieces.sum() * piece, rank + 1))
        terms[at, :rank], terms[at, rank] = factors[source[a:b]], rating[a:b]
        terms = terms.reshape(-1, piece, rank + 1)
        sums = np.add.reduceat(np.matmul(terms.transpose(0, 2, 1), terms), lead)
        sums[0] += carried
        done = last - (ends[last - 1] > b)
        carried = sums[-1].copy() if done < last else 0.0
        sums = sums[:done - first]
        sums[:, diagonal, diagonal] += reg * (ends - starts)[first:done, None]
        found[first:done] = np.linalg.solve(sums[:, :rank, :rank], sums[:, :rank, rank:])[..., 0]
    return found


def _solve(rank: int, reg: float):
    def solve(got: pa.Table, block: pa.Table) -> pa.Table:
        if not block.num_rows:
            return _arrow(_FACTORS, [])
        at, ids, starts, source, rating = (block.column(c)[0] for c in ("at", "ids", "starts", "source", "rating"))
        parts = got.column("factors")
        order = np.argsort(got.column("sender").to_numpy())
        factors = np.concatenate([np.frombuffer(parts[int(i)].as_buffer(), np.float32) for i in order])
        found = normal_solutions(_ints(starts), _ints(source), np.frombuffer(rating.as_buffer(), np.float32),
                                 factors.reshape(-1, rank), reg)
        return _arrow(_FACTORS, [(at.as_py(), ids.as_py(), found.tobytes())])
    return solve


def _setting(spark, partitions: int):
    # the frames are dealt by their shard once and stay so
    return settings(spark, {**FREE_SHUFFLES, "spark.sql.adaptive.enabled": "false",
                            "spark.sql.execution.arrow.maxBytesPerBatch": str(BATCH_BYTES),
                            "spark.sql.shuffle.partitions": str(partitions)})


def deal(train: DataFrame, als: ALS, n: int) -> Dealt:
    """The ``n`` ratings of ``train`` dealt to shards of users and of items, for estimators with
    the columns of ``als``."""
    spark = train.sparkSession
    checkpoint_dir(spark)
    shards = max(1, -(-n // SHARD_RATINGS))
    user, item = F.col(als.getUserCol()).cast("int"), F.col(als.getItemCol()).cast("int")
    rating = F.col(als.getRatingCol()).cast("float")
    whole = F.assert_true((user == F.col(als.getUserCol())) & (item == F.col(als.getItemCol()))
                          & rating.isNotNull() & ~F.isnan(rating),
                          F.lit("ALS takes whole numbers as ids, and ratings that are neither null nor NaN"))
    ratings = train.select(user.alias("user"), item.alias("item"), rating.alias("rating"), whole.alias("whole"))

    def side(of: str, other: str) -> DataFrame:
        rows = ratings.where("whole IS NULL").select(
            _shard(of, shards).alias("at"), _shard(other, shards).alias("other"),
            F.col(of).alias("id"), F.col(other).alias("source"), "rating")
        return (rows.groupBy("at").applyInArrow(_deal, _DEALT)
                .repartition(2 * shards, "at").checkpoint(eager=True))
    with _setting(spark, 2 * shards):
        return Dealt(side("user", "item"), side("item", "user"),
                     ratings.select("user").distinct().checkpoint(eager=True), shards)


def _first_factors(als: ALS, users: DataFrame) -> ALSModel:
    """The model that Spark's fit starts from.  Its user factors depend on the users, the blocks,
    the rank and the seed alone, so one rating for each user is enough."""
    one = users.select(F.col("user").alias(als.getUserCol()), F.col("user").alias(als.getItemCol()),
                       F.lit(1.0).alias(als.getRatingCol()))
    return als.copy({als.maxIter: 0}).fit(one)


def fit(als: ALS, dealt: Dealt) -> ALSModel:
    """The model of ``als`` (explicit ratings, one iteration at least) on the dealt ratings; it is
    kept in files below the checkpoint folder."""
    spark, rank, n = dealt.users.sparkSession, als.getRank(), dealt.partitions

    def half_step(known: DataFrame, to: DataFrame) -> DataFrame:
        requests = to.where("starts IS NULL").groupBy("at")
        sent = known.repartition(n, "at").groupBy("at").cogroup(requests).applyInArrow(_send(rank), _SENT)
        blocks = to.where("starts IS NOT NULL").groupBy("at")
        return (sent.repartition(n, "at").groupBy("at").cogroup(blocks)
                .applyInArrow(_solve(rank, als.getRegParam()), _FACTORS).checkpoint(eager=True))

    first = _first_factors(als, dealt.users)
    with _setting(spark, n):
        users = (first.userFactors.select(_shard("id", dealt.shards).alias("at"), "id", "features")
                 .groupBy("at").applyInArrow(_pack, _FACTORS))
        for _ in range(als.getMaxIter()):
            items = half_step(users, dealt.by_item)
            users = half_step(items, dealt.by_user)
        path = f"{checkpoint_dir(spark)}/als-{uuid.uuid4().hex}"
        first.write().save(path)
        for name, side in (("userFactors", users), ("itemFactors", items)):
            rows = side.mapInArrow(_unpack(rank), "id int, features array<float>")
            rows.write.mode("overwrite").parquet(f"{path}/{name}")
    return ALSModel.read().session(spark).load(path)
