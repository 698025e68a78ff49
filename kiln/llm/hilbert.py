"""Sharding along a Hilbert curve over document metadata.

Several metadata values are quantised to a few bits each, order kept; the Hilbert index
of the cell orders the rows, so that rows that are near in all of these values stand near
each other.  Runs of that order are the shards.  A file of a run spans a small box of the
values, so a reader can skip files on any of them by their column statistics.

1. Cut values of each dimension come from counts of its values over all rows; they are
   added up in ranges of the values, and only the cuts go to the driver.
2. The sort keys and sizes alone (no texts) are range-partitioned, sorted, written and
   numbered by partition sizes.  A run starts where a shard starts and where the bytes
   before a row reach the next multiple of a run's share; the keys there are picked out.
3. Rows find their run by those keys, are shuffled once to it, and are written: a task has
   one run, so tasks are equal in bytes (but for single texts longer than a run), however
   unequal the shards are.  Rows with
   the key at which a run starts, if others of that key stand before it, are checkpointed
   and numbered first, by counts per partition: the number says which run a row goes to.

Law ``rows``: numbers of rows of two shards are at most one apart.
"""

from __future__ import annotations

import uuid

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F, types as T

from kiln.session import checkpoint_dir

SHARDS = 24
DIMENSIONS = ("source", "lang", "n_chars")
BITS = 8
#: bytes of a run at most, but for its last text
RUN_BYTES = 128 << 20
#: bytes that a row has besides its text
ROW_BYTES = 8
#: columns that writing adds
_ADDED = ("__shard", "__slot", "__h", "__id", "__tie", "__run", "__at", "__first")


def hilbert_index(coords: np.ndarray, bits: int) -> np.ndarray:
    """Hilbert index of each row of ``coords`` (rows x dimensions, ``bits`` bits each).

    Skilling's transform: from the top bit down, a set bit inverts the lower bits of the
    first coordinate and a clear one exchanges them with its own; the Gray code of the
    result, bits interleaved, is the index."""
    x = coords.astype(np.int64).T.copy()
    n = len(x)
    for b in range(bits - 1, 0, -1):
        low = (1 << b) - 1
        for i in range(n):
            invert = (x[i] >> b) & 1 == 1
            swap = np.where(invert, 0, (x[0] ^ x[i]) & low)
            x[0] ^= np.where(invert, low, swap)
            x[i] ^= swap
    for i in range(1, n):
        x[i] ^= x[i - 1]
    flip = np.zeros_like(x[0])
    for b in range(bits - 1, 0, -1):
        flip ^= np.where((x[n - 1] >> b) & 1 == 1, (1 << b) - 1, 0)
    x ^= flip
    index = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            index = index << 1 | (x[i] >> b) & 1
    return index


def cut_values(docs: DataFrame, column: str, bits: int) -> list:
    """At most ``2**bits - 2`` ascending values of ``column``: all of them if they are no
    more, else those that cut the rows (nulls left out) evenly."""
    spark, n = docs.sparkSession, (1 << bits) - 2
    counts = (docs.select(F.col(column).alias("v")).where(F.col("v").isNotNull())
              .groupBy("v").agg(F.count("*").alias("rows"))
              .repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), "v")
              .withColumn("part", F.spark_partition_id()).checkpoint())
    sizes = counts.groupBy("part").agg(F.sum("rows"), F.count("*")).collect()   # one row per partition
    total, before = 0, []
    for part, rows, _ in sorted(sizes):
        before.append((part, total))
        total += rows
    if sum(values for _, _, values in sizes) <= n:
        return sorted(r.v for r in counts.collect())
    upto = F.sum("rows").over(Window.partitionBy("part").orderBy("v"))
    # row number total * k // n, for each k below n, is the last of its value or before it
    cut = (counts.withColumn("upto", upto)
           .join(F.broadcast(spark.createDataFrame(before, "part int, before long")), "part")
           .withColumn("upto", F.col("upto") + F.col("before"))
           .where(F.expr(f"(upto * {n} + {total - 1}) div {total} > "
                         f"((upto - rows) * {n} + {total - 1}) div {total}")))
    return sorted(r.v for r in cut.select("v").collect())


def _curve(cuts: list[list], bits: int):
    @F.pandas_udf(T.LongType())
    def curve(dims: pd.DataFrame) -> pd.Series:
        coords = np.zeros((len(dims), len(cuts)), np.int64)     # a null is cell 0
        for d, values in enumerate(cuts):
            col = dims.iloc[:, d]
            known = col.notna().to_numpy()
            if values and known.any():
                at = np.searchsorted(np.array(values, dtype=object), col[known].to_numpy(object), "right")
                coords[known, d] = at + 1
        return pd.Series(hilbert_index(coords.clip(max=(1 << bits) - 1), bits))
    return curve


def _sort_keys(*cols: pd.Series) -> np.ndarray:
    """Signed longs as bytes that sort alike."""
    raw = np.stack([c.to_numpy(np.int64) for c in cols], axis=1).view(np.uint64) ^ np.uint64(1 << 63)
    return np.ascontiguousarray(raw.astype(">u8")).view(f"S{8 * len(cols)}").ravel()


def shard_starts(n: int, shards: int) -> list[int]:
    """Place of each shard's first row among ``n`` rows, and ``n``."""
    return [n * s // shards for s in range(shards + 1)]


def write_shards(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
                 dimensions: tuple[str, ...] = DIMENSIONS, shards: int = SHARDS,
                 runs_per_shard: int | None = None, bits: int = BITS) -> None:
    """Write all rows and columns of ``docs`` to Parquet files under ``path``, one folder
    ``__shard=k`` per shard that has rows, with the row's ``__slot`` in its shard.

    ``dimensions`` are numeric or text columns.  Rows with equal index stand in the order
    of their ids (integers; null last) and texts, rows equal in those in any order.  Columns
    of ``docs`` named like the added ones are left out.  Null texts have no bytes, long ones
    are not cut, null dimensions come first; no rows write no folder.

    A shard is written as one run or more, of ``RUN_BYTES`` at most; small tables are cut into
    ``runs_per_shard`` times ``shards`` runs, as many as shuffle partitions if that is None.
    """
    spark = docs.sparkSession
    checkpoint_dir(spark)
    own = [c for c in docs.columns if c not in _ADDED]
    dims = F.struct(*(F.col(c).alias(f"d{k}") for k, c in enumerate(dimensions)))
    curve = _curve([cut_values(docs, c, bits) for c in dimensions], bits)
    keyed = (docs.select(*own, curve(dims).alias("__h"),
                         F.coalesce(F.col(id_col).cast("long"), F.lit((1 << 63) - 1)).alias("__id"),
                         F.xxhash64(text_col).alias("__tie")))
    size = (F.coalesce(F.octet_length(text_col), F.lit(0)) + F.lit(ROW_BYTES)).cast("long")

    place = F.monotonically_increasing_id()
    key = ["__h", "__id", "__tie"]
    keys = (keyed.select(*key, size.alias("size"), F.rand(0).alias("salt"))         # equal keys may go to several partitions
            .repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), *key, "salt")
            .sortWithinPartitions(*key).drop("salt")
            .withColumn("part", F.shiftrightunsigned(place, 33))
            .withColumn("at", place.bitwiseAND(F.lit((1 << 33) - 1))).checkpoint())
    parts = sorted(keys.groupBy("part").agg(F.count("*"), F.sum("size")).collect())  # a row per partition
    sizes, before, before_bytes, n, total = {}, {}, [], 0, 0
    for part, rows, size_ in parts:
        sizes[part], before[part] = rows, n
        before_bytes.append((part, total))
        n, total = n + rows, total + size_
    m = runs_per_shard or max(1, -(-int(spark.conf.get("spark.sql.shuffle.partitions")) // shards))
    share = max(1, -(-total // max(m * shards, -(-total // RUN_BYTES))))
    starts = shard_starts(n, shards)
    places = set(starts)
    if n:
        upto = F.sum("size").over(Window.partitionBy("part").orderBy("at"))
        ends = (keys.withColumn("upto", upto)
                .join(F.broadcast(spark.createDataFrame(before_bytes, "part long, bytes long")), "part")
                .withColumn("upto", F.col("upto") + F.col("bytes"))
                .where(F.expr(f"upto div {share} > (upto - size) div {share}")))
        places |= {before[r.part] + r.at + 1 for r in ends.select("part", "at").collect()}  # a row per run
    wanted, rest = [], sorted((g for g in places if g < n), reverse=True)
    for part in sorted(sizes):
        while rest and rest[-1] < before[part] + sizes[part]:
            g = rest.pop()
            wanted.append((part, g - before[part], g))
    cuts: list[bytes] = []
    divided: dict[tuple, int] = {}          # place of the first row of keys that runs divide
    if wanted:
        picked = (keys.join(F.broadcast(spark.createDataFrame(wanted, "part long, at long, g long")),
                            ["part", "at"]).select("g", "__h", "__id", "__tie").toPandas().sort_values("g"))
        cuts = list(_sort_keys(picked["__h"], picked["__id"], picked["__tie"]))
        begins = picked["g"].tolist()
        run_keys = [tuple(map(int, r)) for r in picked[key].to_numpy()]
        firsts: dict[tuple, int] = {}
        for *k, part, at in (keys.join(F.broadcast(spark.createDataFrame(
                sorted(set(run_keys)), "__h long, __id long, __tie long")), key)
                .groupBy(*key, "part").agg(F.min("at")).collect()):     # about one row per run
            firsts[tuple(k)] = min(before[part] + at, firsts.get(tuple(k), n))
        divided = {k: firsts[k] for k, g in zip(run_keys, begins) if firsts[k] < g}
    else:
        begins = []

    @F.pandas_udf(T.IntegerType())
    def run_of(h: pd.Series, i: pd.Series, tie: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(np.array(cuts), _sort_keys(h, i, tie), "right") - 1).astype("int32")

    @F.pandas_udf(T.IntegerType())
    def run_at(g: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(np.array(begins), g.to_numpy(), "right") - 1).astype("int32")

    shard_of = [int(np.searchsorted(starts, g, "right")) - 1 for g in begins]
    runs = spark.createDataFrame([(k, s, g - starts[s]) for k, (g, s) in enumerate(zip(begins, shard_of))],
                                 "__run int, __shard int, __first long")
    runned = keyed.withColumn("__run", run_of(*key)).withColumn("__slot", F.lit(0).cast("long"))
    if divided:
        table = F.broadcast(spark.createDataFrame(
            [(*k, g) for k, g in divided.items()], "__h long, __id long, __tie long, first long"))
        same = (keyed.join(table.drop("first"), key, "left_semi").sortWithinPartitions(*key)
                .withColumn("__shard", F.shiftrightunsigned(place, 33))
                .withColumn("__slot", place.bitwiseAND(F.lit((1 << 33) - 1))).checkpoint())
        ahead = Window.partitionBy(*key).orderBy("__shard").rowsBetween(Window.unboundedPreceding, -1)
        shift = (same.groupBy(*key, "__shard").agg(F.min("__slot").alias("at"), F.count("*").alias("rows"))
                 .withColumn("ahead", F.coalesce(F.sum("rows").over(ahead), F.lit(0)))
                 .join(table, key)
                 .select(*key, "__shard", (F.col("first") + F.col("ahead") - F.col("at")).alias("__run")))
        same = (same.join(F.broadcast(shift), [*key, "__shard"])
                .withColumn("__slot", F.col("__slot") + F.col("__run"))
                .withColumn("__run", run_at("__slot")))
        runned = (runned.join(table.drop("first"), key, "left_anti").select(*own, *key, "__run", "__slot")
                  .union(same.select(*own, *key, "__run", "__slot")))
    placed = (runned.repartitionById(max(1, len(begins)), F.col("__run"))     # a run in each task
              .sortWithinPartitions(*key, "__slot").withColumn("__at", place.bitwiseAND(F.lit((1 << 33) - 1)))
              .join(F.broadcast(runs), "__run")                               # one row per run
              .withColumn("__slot", F.col("__at") + F.col("__first")))
    placed.select(*own, "__slot", "__shard").write.partitionBy("__shard").parquet(path)


def read_shards(docs: DataFrame, path: str) -> DataFrame:
    """Rows of the files under ``path`` (written from ``docs``): columns of ``docs``,
    ``__slot`` and ``__shard``."""
    own = [f for f in docs.schema if f.name not in _ADDED]
    schema = T.StructType(own + [T.StructField("__slot", T.LongType()),
                                 T.StructField("__shard", T.IntegerType())])
    return docs.sparkSession.read.schema(schema).parquet(path)


def shard_documents(docs: DataFrame, path: str | None = None, id_col: str = "doc_id",
                    text_col: str = "text", **options) -> DataFrame:
    """Write ``docs`` to shards and read them back: ``id_col, size, text_crc32, law, shard,
    slot, grown_shard`` per row, from the files.

    ``size``: UTF-8 bytes of the text (null: none) plus ``ROW_BYTES``; a null text has the
    checksum of no bytes.  No rows give no shards.
    """
    path = path or f"{checkpoint_dir(docs.sparkSession)}/hilbert-{uuid.uuid4().hex}"
    write_shards(docs, path, id_col, text_col, **options)
    text = F.coalesce(F.col(text_col), F.lit(""))
    return read_shards(docs, path).select(
        F.col(id_col), (F.octet_length(text).cast("long") + ROW_BYTES).alias("size"),
        F.crc32(text).alias("text_crc32"), F.lit("rows").alias("law"),
        F.col("__shard").alias("shard"), F.col("__slot").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"))
