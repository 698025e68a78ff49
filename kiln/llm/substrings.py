"""Exact substring deduplication with fixed-block anchors.

Any window of ``2 * block`` words covers a whole block of its text (words ``k * block``
to ``(k + 1) * block - 1``).  So the non-overlapping blocks of all texts are the
index, and every rolling run of ``block`` words probes it: each repeat of a window has a
probe that hits a block of the repeat.  Hits are extended, word by word, to the windows
around them; the windows that repeat, joined, are the maximal exact repeats.

The work is done on chunks of whole texts (by a hash of the id; two per shuffle partition
of the session) and on buckets of hashes (one per partition), so both are bounded by the
size of a partition.  Their keys are picked so that Spark deals them out evenly:

1. chunk -> bucket: the distinct hashes of a chunk's blocks and of its rolling probes,
   packed as sorted differences.  A run held by a third of all texts sends one hash per
   chunk.  32 hash bits decide here; a chance hit costs a little work, never a wrong row.
2. bucket -> chunk: the probes that hit a block of the index and occur in more than one
   chunk (repeats inside a chunk are found there).
3. chunk -> bucket: each distinct window around a hit, with a 128-bit hash and its first
   place (id, position) in the chunk.
4. bucket -> chunk: one bit per window, set if that place is the first of all.

The texts are shuffled once, by chunk; the three passes over them read the same
exchange.  What goes between chunks and buckets is a few bytes a word.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

WINDOW_WORDS = 20
_MULT = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xBF58476D1CE4E5B9)


# ---- packed arrays -------------------------------------------------------------

def _planes(values: np.ndarray) -> bytes:
    """Bytes of equal significance together: constant ones then compress away."""
    return values.view(np.uint8).reshape(len(values), values.itemsize).T.tobytes()


def _unplanes(data: bytes, dtype) -> np.ndarray:
    width = np.dtype(dtype).itemsize
    return np.ascontiguousarray(
        np.frombuffer(data, np.uint8).reshape(width, len(data) // width).T).view(dtype).ravel()


def _pack_sorted(values: np.ndarray) -> bytes:
    return _planes(np.diff(values, prepend=np.uint32(0)))


def _unpack_sorted(data: bytes) -> np.ndarray:
    return np.cumsum(_unplanes(data, np.uint32), dtype=np.uint32)


# ---- words and windows of a chunk ------------------------------------------------

class _Chunk:
    """Word hashes of the texts of a chunk, in the order of (without id, id, text)."""

    def __init__(self, table: pa.Table, block: int, buckets: int):
        order = pc.sort_indices(table, sort_keys=[
            ("__none", "ascending"), ("__oid", "ascending"), ("__text", "ascending")])
        self.table = table.take(order).combine_chunks()
        self.block, self.buckets = block, buckets
        text = pc.fill_null(self.table.column("__text"), "").combine_chunks()
        if isinstance(text, pa.ChunkedArray):
            text = text.chunk(0) if text.num_chunks else pa.array([], pa.string())
        text = pc.ascii_trim_whitespace(text)
        parts = pc.ascii_split_whitespace(text)
        words, counts = parts.flatten(), parts.value_lengths().to_numpy(zero_copy_only=False)
        # an empty text is cut into one empty word
        empty = pc.equal(pc.binary_length(text), 0).to_numpy(zero_copy_only=False)
        if empty.any():
            words = words.filter(pc.greater(pc.binary_length(words), 0))
            counts = np.where(empty, 0, counts)
        self.words = words
        self.ends = np.cumsum(counts, dtype=np.int64)
        self.starts = self.ends - counts
        self.n_words = counts
        self.doc = np.repeat(np.arange(len(counts)), counts)
        self.left = (self.ends[self.doc] - np.arange(len(self.doc))
                     if len(self.doc) else np.zeros(0, np.int64))   # words to the text's end
        self._hash()

    def _hash(self) -> None:
        from xxhash import xxh3_128_digest
        enc = self.words.dictionary_encode()
        if isinstance(enc, pa.ChunkedArray):
            enc = enc.combine_chunks()
        each = np.frombuffer(b"".join(map(xxh3_128_digest, enc.dictionary.cast(pa.binary()).to_pylist())),
                             np.uint64).reshape(-1, 2)
        at = enc.indices.to_numpy(zero_copy_only=False)
        self._a, self._b = (each[at, 0], each[at, 1]) if len(at) else (np.zeros(0, np.uint64),) * 2

    def _rolled(self, word_hashes: np.ndarray, n: int) -> np.ndarray:
        """Hash of the ``n`` words from each place; places too near the chunk's end: 0."""
        out = np.zeros(len(word_hashes), np.uint64)
        m = len(word_hashes) - n + 1
        if m > 0:
            h = word_hashes[:m].copy()
            for k in range(1, n):
                h *= _MULT
                h += word_hashes[k:k + m]
            h ^= h >> np.uint64(32)
            h *= _MIX
            h ^= h >> np.uint64(29)
            out[:m] = h
        return out

    def probes(self) -> tuple[np.ndarray, np.ndarray]:
        """Places of all rolling runs of ``block`` words, and their keys: bucket above,
        32 hash bits below."""
        at = np.nonzero(self.left >= self.block)[0]
        return at, _key(self._rolled(self._a, self.block)[at], self.buckets)

    def blocks(self, at: np.ndarray) -> np.ndarray:
        """Which of the probes at ``at`` are blocks of their text."""
        return (at - self.starts[self.doc[at]]) % self.block == 0

    def windows(self, hit: np.ndarray) -> np.ndarray:
        """Places of the windows that cover a hit."""
        size = 2 * self.block
        seen = np.concatenate([[0], np.cumsum(hit, dtype=np.int64)])
        at = np.nonzero(self.left >= size)[0]
        return at[seen[at + self.block + 1] > seen[at]]

    def window_hashes(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        size = 2 * self.block
        return self._rolled(self._a, size)[at], self._rolled(self._b, size)[at]

    def hits(self, found: np.ndarray) -> np.ndarray:
        """For each place, whether a probe there hits a block elsewhere: ``found`` has
        the keys that other chunks share, repeats inside the chunk are added."""
        at, keys = self.probes()
        hit = np.zeros(len(self.doc), bool)
        if len(at):
            order = np.argsort(keys, kind="stable")
            ordered = keys[order]
            new = np.concatenate([[True], ordered[1:] != ordered[:-1]])
            run = np.cumsum(new) - 1
            size = np.bincount(run)
            indexed = np.bincount(run, weights=self.blocks(at)[order]) > 0
            first = ordered[new]
            good = (size > 1) & indexed
            if len(found):
                k = np.searchsorted(found, first).clip(max=len(found) - 1)
                good |= found[k] == first
            hit[at[order[good[run]]]] = True
        return hit

    def distinct_windows(self, found: np.ndarray):
        """Windows around hits: places, the run of equal windows each belongs to, and for
        each run its hashes and first place, ordered by bucket and hash."""
        at = self.windows(self.hits(found))
        h1, h2 = self.window_hashes(at)
        order = np.lexsort((h2, h1))        # stable: places stay in order within a run
        at, h1, h2 = at[order], h1[order], h2[order]
        new = np.ones(len(at), bool)
        new[1:] = (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])
        return at, new, h1[new], h2[new], at[new]


def _key(h: np.ndarray, buckets: int) -> np.ndarray:
    return ((((h >> np.uint64(32)) * np.uint64(buckets)) & ~np.uint64(0xFFFFFFFF))
            | (h & np.uint64(0xFFFFFFFF)))


def _bucket(h: np.ndarray, buckets: int) -> np.ndarray:
    return ((h >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)


# ---- the four passes -----------------------------------------------------------

def _even_keys(spark: SparkSession, partitions: int) -> tuple[list[int], list[int]]:
    """Integers, one per partition that a shuffle by them would fill, and as many others."""
    n = F.lit(partitions)
    rows = (spark.range(16 * partitions).select(F.col("id").cast("int").alias("k"))
            .groupBy(F.pmod(F.hash("k"), n).alias("p"))
            .agg(F.min("k").alias("low"), F.max("k").alias("high")).collect())
    low, high = sorted(r["low"] for r in rows), sorted(r["high"] for r in rows)
    return low, sorted({*low, *high})


_TO_BUCKET = "__bucket int, __chunk int, blocks binary, probes binary"
_HITS = "__chunk int, __bucket int, kind int, data binary"
_WINDOWS = "__bucket int, __chunk int, h1 binary, h2 binary, none binary, oid binary, pos binary"


def _arrow(schema: str, rows: list[tuple]) -> pa.Table:
    fields = [f.split() for f in schema.split(", ")]
    types = {"int": pa.int32(), "binary": pa.binary()}
    cols = list(zip(*rows)) if rows else [()] * len(fields)
    return pa.table([pa.array(c, types[t]) for c, (_, t) in zip(cols, fields)],
                    names=[n for n, _ in fields])


def _send_hashes(table: pa.Table, block: int, places: list[int]) -> pa.Table:
    buckets = len(places)
    chunk = _Chunk(table, block, buckets)
    at, keys = chunk.probes()
    blocks, probes = np.unique(keys[chunk.blocks(at)]), np.unique(keys)
    edges = np.arange(buckets + 1, dtype=np.uint64) << np.uint64(32)
    cut_b, cut_p = np.searchsorted(blocks, edges), np.searchsorted(probes, edges)
    number = table.column("__chunk")[0].as_py()
    return _arrow(_TO_BUCKET, [
        (places[k], number, _pack_sorted(blocks[cut_b[k]:cut_b[k + 1]].astype(np.uint32)),
         _pack_sorted(probes[cut_p[k]:cut_p[k + 1]].astype(np.uint32)))
        for k in range(buckets) if cut_p[k + 1] > cut_p[k]])


def _find_hits(table: pa.Table) -> pa.Table:
    number = table.column("__bucket")[0].as_py()
    chunks = table.column("__chunk").to_pylist()
    probes = [_unpack_sorted(x) for x in table.column("probes").to_pylist()]
    blocks = np.unique(np.concatenate([_unpack_sorted(x) for x in table.column("blocks").to_pylist()]))
    every = np.sort(np.concatenate(probes))
    again = np.unique(every[1:][every[1:] == every[:-1]])
    found = np.intersect1d(again, blocks, assume_unique=True)
    rows = []
    for chunk, own in zip(chunks, probes):
        hits = np.intersect1d(own, found, assume_unique=True)
        if len(hits):
            rows.append((chunk, number, 0, _pack_sorted(hits)))
    return _arrow(_HITS, rows)


def _found(replies: pa.Table, places: list[int]) -> np.ndarray:
    number = {b: np.uint64(k) for k, b in enumerate(places)}
    keys = [_unpack_sorted(d).astype(np.uint64) | (number[b] << np.uint64(32))
            for b, k, d in zip(*(replies.column(c).to_pylist() for c in ("__bucket", "kind", "data")))
            if k == 0]
    return np.sort(np.concatenate(keys)) if keys else np.zeros(0, np.uint64)


def _send_windows(table: pa.Table, replies: pa.Table, block: int, places: list[int]) -> pa.Table:
    buckets = len(places)
    chunk = _Chunk(table, block, buckets)
    _, _, h1, h2, first = chunk.distinct_windows(_found(replies, places))
    none, oid = (chunk.table.column(c).to_numpy()[chunk.doc[first]] for c in ("__none", "__oid"))
    pos = (first - chunk.starts[chunk.doc[first]]).astype(np.uint32)
    cut = np.searchsorted(_bucket(h1, buckets), np.arange(buckets + 1))
    number = table.column("__chunk")[0].as_py()
    return _arrow(_WINDOWS, [
        (places[k], number, *(_planes(x[cut[k]:cut[k + 1]]) for x in (h1, h2, none, oid, pos)))
        for k in range(buckets) if cut[k + 1] > cut[k]])


def _first_places(table: pa.Table) -> pa.Table:
    number = table.column("__bucket")[0].as_py()
    parts = [[_unplanes(d, t) for d in table.column(c).to_pylist()]
             for c, t in (("h1", np.uint64), ("h2", np.uint64), ("none", np.int8), ("oid", np.int64),
                          ("pos", np.uint32))]
    sizes = [len(x) for x in parts[0]]
    h1, h2, none, oid, pos = (np.concatenate(p) for p in parts)
    order = np.lexsort((pos, oid, none, h2, h1))
    new = np.ones(len(order), bool)
    s1, s2 = h1[order], h2[order]
    new[1:] = (s1[1:] != s1[:-1]) | (s2[1:] != s2[:-1])
    first = np.zeros(len(order), bool)
    first[order[new]] = True
    ends = np.cumsum(sizes)
    return _arrow(_HITS, [
        (chunk, number, 1, np.packbits(first[end - size:end]).tobytes())
        for chunk, size, end in zip(table.column("__chunk").to_pylist(), sizes, ends)])


def _remove(table: pa.Table, replies: pa.Table, block: int, places: list[int], carry: list[str],
            whole: bool) -> pa.Table:
    buckets = len(places)
    chunk = _Chunk(table, block, buckets)
    at, new, h1, _, _ = chunk.distinct_windows(_found(replies, places))
    bucket_of = {b: k for k, b in enumerate(places)}
    winner = np.zeros(len(h1), bool)
    cut = np.searchsorted(_bucket(h1, buckets), np.arange(buckets + 1))
    for b, k, d in zip(*(replies.column(c).to_pylist() for c in ("__bucket", "kind", "data"))):
        if k == 1:
            b = bucket_of[b]
            n = cut[b + 1] - cut[b]
            winner[cut[b]:cut[b + 1]] = np.unpackbits(np.frombuffer(d, np.uint8), count=n)
    gone = np.ones(len(at), bool)
    gone[new] = ~winner                    # only the first place of all stays
    cover = np.zeros(len(chunk.doc) + 2 * block + 1, np.int64)
    np.add.at(cover, at[gone], 1)
    np.add.at(cover, at[gone] + 2 * block, -1)
    keep = np.cumsum(cover)[:len(chunk.doc)] == 0
    kept = np.bincount(chunk.doc[keep], minlength=len(chunk.n_words)).astype(np.int64)
    words = chunk.words.filter(pa.array(keep))
    offsets = pa.array(np.concatenate([[0], np.cumsum(kept)]).astype(np.int32))
    text = pc.binary_join(pa.ListArray.from_arrays(offsets, words), " ")
    if whole:
        text = pc.if_else(pa.array(kept == chunk.n_words), chunk.table.column("__text"), text)
    return pa.table([chunk.table.column("__none"), chunk.table.column("__oid"), pa.array(chunk.n_words.astype(np.int64)),
                     pa.array(chunk.n_words.astype(np.int64) - kept), text,
                     *(chunk.table.column(f"__c{k}") for k in range(len(carry)))],
                    names=["__none", "__oid", "n_words", "n_removed", "kept_text",
                           *(f"__c{k}" for k in range(len(carry)))])


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   window_words: int = WINDOW_WORDS, carry: list[str] | None = None,
                   keep_untouched: bool = False) -> DataFrame:
    """``id_col, n_words, n_removed, kept_text`` and the columns ``carry`` per row.

    A word goes if a window of ``window_words`` consecutive words of its text covers it
    whose words also start earlier: in a text of smaller id, or earlier in the same text.
    Windows are judged on the input.  ``kept_text`` joins the words that stay by one
    space; with ``keep_untouched`` a text that loses no word stays as it is.

    Ids are integers, of any size and sign.  Null and empty texts have no words; a text
    of any length is one text.  Rows of equal id count in the order of their texts, equal
    rows one after the other; rows without id come after all others.  An empty table gives
    no rows.  ``window_words`` is even.  Columns of ``docs`` other than those named are not read.
    """
    spark = docs.sparkSession
    places, chunks = _even_keys(spark, int(spark.conf.get("spark.sql.shuffle.partitions")))
    block, carry = window_words // 2, carry or []
    if window_words != 2 * block:
        raise ValueError("window_words must be even")

    # rows without id are dealt out by their text, and come after every id
    rows = (docs.select(F.col(id_col).isNull().cast("byte").alias("__none"),
                        F.coalesce(F.col(id_col).cast("long"), F.xxhash64(text_col)).alias("__oid"),
                        F.col(text_col).alias("__text"),
                        *(F.col(c).alias(f"__c{k}") for k, c in enumerate(carry)))
            .withColumn("__chunk", F.lit(chunks)[F.pmod(F.xxhash64("__oid"), F.lit(len(chunks))).cast("int")]))
    grouped = rows.groupBy("__chunk")
    hits = (grouped.applyInArrow(lambda t: _send_hashes(t, block, places), _TO_BUCKET)
            .groupBy("__bucket").applyInArrow(_find_hits, _HITS))
    firsts = (grouped.cogroup(hits.groupBy("__chunk"))
              .applyInArrow(lambda d, h: _send_windows(d, h, block, places), _WINDOWS)
              .groupBy("__bucket").applyInArrow(_first_places, _HITS))
    out = T.StructType([T.StructField("__none", T.ByteType()), T.StructField("__oid", T.LongType()),
                        T.StructField("n_words", T.LongType()),
                        T.StructField("n_removed", T.LongType()),
                        T.StructField("kept_text", T.StringType())]
                       + [T.StructField(f"__c{k}", rows.schema[f"__c{k}"].dataType)
                          for k in range(len(carry))])
    done = (grouped.cogroup(hits.union(firsts).groupBy("__chunk"))
            .applyInArrow(lambda d, r: _remove(d, r, block, places, carry, keep_untouched), out))
    own_id = F.when(F.col("__none") == 0, F.col("__oid")).cast(docs.schema[id_col].dataType)
    return done.select(own_id.alias(id_col), "n_words", "n_removed", "kept_text",
                       *(F.col(f"__c{k}").alias(c) for k, c in enumerate(carry)))
