"""SimHash near-duplicates within two bits by deletion-variant signatures.

A 64-bit fingerprint is cut into two segments.  Fingerprints that differ in at most
two bits have a segment that differs in at most one, so they share one of its
one-wildcard variants (the segment with one bit blanked, 32 per segment).  Variants
are an index: an equality join on them gives candidate pairs, a bit count verifies
them.

The join runs on distinct fingerprints, so copies cost nothing.  A variant shared by
more than ``HOT_VARIANT`` distinct fingerprints would give a quadratic number of
pairs; its fingerprints are linked another, equally exact way: two fingerprints
differ in at most two bits exactly if a third value lies at most one bit from both,
so each fingerprint is listed under itself and its 64 one-bit neighbours and linked
to the smallest fingerprint in each list.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F, types as T

from kiln.session import checkpoint_dir

from .components import components
from .words import slices, word_chunks

SHINGLE_WORDS = 3
MAX_BITS = 2
HASH_SEED = 42
#: distinct fingerprints under one variant up to which they are paired
HOT_VARIANT = 16
#: fingerprints that more than one in so many rows have are labelled by a broadcast
HOT_CLASSES = 1000

_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little")


def _hashes(data: bytes, n: int) -> Iterator[np.ndarray]:
    from xxhash import xxh64_intdigest
    carry: list[bytes] = []
    hashed = False
    for words in word_chunks(data.lower()):
        words = carry + words
        if len(words) >= n:
            hashed = True
            shingles = map(b" ".join, zip(*(words[k:] for k in range(n))))
            yield np.fromiter((xxh64_intdigest(s, HASH_SEED) for s in shingles), np.uint64,
                              len(words) - n + 1)
        carry = words[-(n - 1):] if n > 1 else []
    if carry and not hashed:
        yield np.array([xxh64_intdigest(b" ".join(carry), HASH_SEED)], dtype=np.uint64)


def fingerprints(texts: list[bytes | None], shingle_words: int = SHINGLE_WORDS) -> np.ndarray:
    """SimHash of each text, as uint64."""
    ones = np.zeros((len(texts), 64), dtype=np.int64)
    total = np.zeros(len(texts), dtype=np.int64)
    pending: list[tuple[int, np.ndarray]] = []
    waiting = 0

    def count():
        doc = np.repeat([d for d, _ in pending], [len(h) for _, h in pending])
        octets = np.concatenate([h for _, h in pending]).view(np.uint8).reshape(-1, 8)
        docs, doc = np.unique(doc, return_inverse=True)
        total[docs] += np.bincount(doc, minlength=len(docs))
        for k in range(8):
            seen = np.bincount(doc * 256 + octets[:, k], minlength=256 * len(docs))
            ones[docs, 8 * k:8 * k + 8] += seen.reshape(-1, 256) @ _BITS

    for d, data in enumerate(texts):
        for h in _hashes(data, shingle_words) if data else ():
            pending.append((d, h))
            waiting += len(h)
            if waiting > 100_000:
                count()
                pending, waiting = [], 0
    if pending:
        count()
    return np.packbits(2 * ones > total[:, None], axis=1, bitorder="little").view("<u8").ravel()


def simhash(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
            shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """``(id, fp)`` per row: the 64-bit SimHash of its word shingles as a long.

    Words are lower-cased in A-Z only; a bit is set if it is set in over half of the
    shingle hashes, repeats included.  A text with fewer words than a shingle has one
    shingle, all its words; null and empty texts have fingerprint 0."""
    def fp(batches):
        for batch in batches:
            for part in slices(batch, 1, 256):
                texts = part.column(1).cast(pa.binary()).to_pylist()
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(fingerprints(texts, shingle_words).view(np.int64))],
                    names=["id", "fp"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(fp, T.StructType([
        T.StructField("id", rows.schema["id"].dataType), T.StructField("fp", T.LongType())]))


def _variants(fps: DataFrame) -> DataFrame:
    """``(fp, variant)``: 32 one-wildcard variants of each 32-bit segment; the upper half
    of ``variant`` says which segment and bit are meant."""
    low = F.col("fp").bitwiseAND(F.lit(0xFFFFFFFF))
    high = F.shiftrightunsigned("fp", 32)
    keys = [F.lit((s * 32 + j) << 32).bitwiseOR(seg.bitwiseAND(F.lit(0xFFFFFFFF ^ (1 << j))))
            for s, seg in enumerate((low, high)) for j in range(32)]
    return fps.select("fp", F.explode(F.array(*keys)).alias("variant"))


def links(fps: DataFrame, hot_variant: int = HOT_VARIANT) -> DataFrame:
    """Edges ``(a, b)`` between distinct fingerprints of ``fps`` (column ``fp``, no
    repeats) of at most two differing bits.  Not every such pair is an edge, but every
    such pair is connected by edges, and every edge is such a pair."""
    shared = (_variants(fps)
              .withColumn("n", F.count("*").over(Window.partitionBy("variant")))
              .where("n > 1").checkpoint())
    few = shared.where(F.col("n") <= hot_variant).select("variant", "fp")
    pairs = (few.withColumnRenamed("fp", "a").join(few.withColumnRenamed("fp", "b"), "variant")
             .where("a < b").where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= MAX_BITS)
             .select("a", "b"))
    hot = shared.where(F.col("n") > hot_variant).select("fp").distinct()
    near = [F.col("fp")] + [F.col("fp").bitwiseXOR(F.lit(1 << j if j < 63 else -(1 << 63)))
                            for j in range(64)]
    lists = hot.select(F.col("fp").alias("a"), F.explode(F.array(*near)).alias("near"))
    stars = (lists.withColumn("b", F.min("a").over(Window.partitionBy("near")))
             .where("a <> b").select("a", "b"))
    return pairs.union(stars).distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    shingle_words: int = SHINGLE_WORDS,
                    hot_variant: int = HOT_VARIANT) -> DataFrame:
    """``id_col, fingerprint, component_id`` per row of ``docs``.

    ``fingerprint``: 16 lower-case hex digits.  ``component_id``: the smallest id
    reachable over links of at most two differing bits, the row's own included.  Rows
    with the same id each have their row; null ids are never the smallest, and a group
    of null ids only has a null ``component_id``.  No rows give no rows.  Other columns
    of ``docs`` are not read, whatever their names.
    """
    checkpoint_dir(docs.sparkSession)
    rows = simhash(docs, id_col, text_col, shingle_words).checkpoint()
    classes = rows.groupBy("fp").agg(F.min("id").alias("rep"), F.count("*").alias("n")).checkpoint()
    comps = components(links(classes.select("fp"), hot_variant))
    reps = comps.join(classes.select(F.col("fp").alias("node"), "rep"), "node")
    smallest = reps.groupBy("component").agg(F.min("rep").alias("smallest"))
    linked = reps.join(smallest, "component").select(F.col("node").alias("fp"), "smallest")
    labels = classes.join(linked, "fp", "left").select(
        "fp", "n", F.coalesce("smallest", "rep").alias("component_id"))
    # a fingerprint of many rows is not shuffled: no more than HOT_CLASSES have so many
    hot = (labels.where(F.col("n") * HOT_CLASSES > rows.count()).select("fp", "component_id")
           .checkpoint())
    labels = labels.select("fp", "component_id")
    labelled = (rows.join(F.broadcast(hot), "fp")
                .union(rows.join(F.broadcast(hot), "fp", "left_anti").join(labels, "fp")))
    return labelled.select(
        F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        "component_id")
