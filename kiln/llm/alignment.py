"""Alignment of two tokenisations of the same text, over the bytes that both stand for.

Per batch of documents the starts of one side's tokens look up the covering token of the
other side with ``pandas.merge_asof``, keyed by document, and the other way round; the union
of both directions is all overlapping pairs.  Pairs whose byte ranges end together cut the
document into groups and are its links.  How often an id pair is linked is counted over the
whole corpus: two tokens that end together are such that one's bytes end with the other's,
so the two vocabularies alone bound the pairs there can be (:meth:`TokenPair.pair_bound`,
324 297 for the default ones), and the table of counts stays that small at any corpus size.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from .storage import shared_folder
from .tokens import ByteEncoder, tokenizer_path

#: text that is aligned at a time (a single text may be longer), and documents
BATCH_CHARS = 1 << 18
BATCH_DOCS = 256

_DETAIL = "a_ids array<int>, b_ids array<int>, overlaps array<struct<a:int,b:int>>, groups string"


class TokenPair:
    """Tokenizer A (byte-level, run on a space and the text) and tokenizer B (sentencepiece,
    which adds that space itself)."""

    def __init__(self, a_path: str, b_path: str):
        import sentencepiece
        self.a = ByteEncoder(a_path, special=False)
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        self.n_b = self.b.get_piece_size()
        #: type of a link: an id pair as one number
        self.link_type = np.dtype("<u4" if self.a.size * self.n_b <= 1 << 32 else "<u8")
        self.a_bytes = [self.a.bytes_of.get(i, b"") for i in range(self.a.size)]
        self.b_bytes = [self._piece(i) for i in range(self.n_b)]
        self.a_size = np.array([len(x) for x in self.a_bytes])
        self.b_size = np.array([len(x) for x in self.b_bytes])
        self._b_all = np.frombuffer(b"".join(self.b_bytes), np.uint8)
        self._b_first = np.append(0, np.cumsum(self.b_size))[:-1]
        # a token's text in the list of groups: inside a side's list, and as its last
        self.a_text = [np.array([b"%d%s" % (i, end) for i in range(self.a.size)], object) for end in (b",", b"|")]
        self.b_text = [np.array([b"%d%s" % (i, end) for i in range(self.n_b)], object) for end in (b",", b";")]

    def _piece(self, i: int) -> bytes:
        piece = self.b.id_to_piece(i)
        if self.b.is_byte(i):
            return bytes([int(piece[3:-1], 16)])
        return piece.replace("▁", " ").encode()

    def pair_bound(self) -> int:
        """Id pairs of which one's bytes end with the other's: all that can be linked."""
        a, b = defaultdict(int), defaultdict(int)
        for found, names in ((a, self.a_bytes), (b, self.b_bytes)):
            for x in names:
                found[x] += 1
        return (sum(n * b.get(x[k:], 0) for x, n in a.items() for k in range(len(x)))
                + sum(n * a.get(x[k:], 0) for x, n in b.items() for k in range(1, len(x))))

    def encode(self, texts: list[str]) -> tuple[list, list]:
        """Ids of both sides for each text; none where the text is empty or the bytes of a
        side's tokens are not a space and the text."""
        none = np.zeros(0, np.uint32)
        a_ids = [self.a.encode(" " + t) if t else none for t in texts]
        b_ids = [np.array(x, np.uint32) for x in self.b.encode(texts, num_threads=1)]
        for k, t in enumerate(texts):
            # a byte-level tokenizer has a token for every byte and loses none
            if not t or self._bytes_of_b(b_ids[k]) != b" " + t.encode():
                a_ids[k] = b_ids[k] = none
        return a_ids, b_ids

    def _bytes_of_b(self, ids: np.ndarray) -> bytes:
        size = self.b_size[ids]
        first = np.cumsum(size) - size
        return self._b_all[np.arange(size.sum()) + np.repeat(self._b_first[ids] - first, size)].tobytes()


@lru_cache(maxsize=1)
def token_pair(a_path: str, b_path: str) -> TokenPair:
    """The worker's tokenizers."""
    return TokenPair(a_path, b_path)


class Aligned:
    """Tokens of a batch of documents, their overlaps, links and groups."""

    def __init__(self, pair: TokenPair, texts: list[str]):
        a_ids, b_ids = pair.encode(texts)
        self.pair, self.n = pair, len(texts)
        self.a, self.n_a = self._joined(a_ids)
        self.b, self.n_b = self._joined(b_ids)
        a, b = self._ranges(self.a, self.n_a, pair.a_size), self._ranges(self.b, self.n_b, pair.b_size)
        into_b = pd.merge_asof(a[["doc", "start", "at"]], b, on="start", by="doc", suffixes=("", "_b"))
        into_a = pd.merge_asof(b[["doc", "start", "at"]], a.assign(from_=a["start"]), on="start", by="doc",
                               suffixes=("", "_a"))
        # pairs that start together are found in both directions
        into_a = into_a[into_a["from_"] != into_a["start"]]
        self.over_a = np.concatenate([into_b["at"].to_numpy(np.int64), into_a["at_a"].to_numpy(np.int64)])
        self.over_b = np.concatenate([into_b["at_b"].to_numpy(np.int64), into_a["at"].to_numpy(np.int64)])
        together = a["end"].to_numpy()[self.over_a] == b["end"].to_numpy()[self.over_b]
        order = np.argsort(self.over_a[together], kind="stable")
        #: places of the linked tokens, document by document
        self.link_a, self.link_b = self.over_a[together][order], self.over_b[together][order]
        self.link_doc = a["doc"].to_numpy()[self.link_a]
        self.n_links = np.bincount(self.link_doc, minlength=self.n)

    @staticmethod
    def _joined(ids: list) -> tuple[np.ndarray, np.ndarray]:
        sizes = np.array([len(x) for x in ids], np.int64)
        return np.concatenate(ids).astype(np.int64) if ids else np.zeros(0, np.int64), sizes

    def _ranges(self, ids: np.ndarray, sizes: np.ndarray, length: np.ndarray) -> pd.DataFrame:
        """Document and byte range of each token; ranges count on from document to document,
        as ``merge_asof`` wants them sorted (both sides stand for the same bytes)."""
        end = np.cumsum(length[ids])
        return pd.DataFrame({"doc": np.repeat(np.arange(self.n), sizes), "start": end - length[ids],
                             "end": end, "at": np.arange(len(ids))})

    def groups(self) -> list[bytes]:
        """``a1,a2|b1;a3|b2,b3`` of each document, empty without tokens."""
        # a link ends its group: a token's group is the number of links before it
        a_group = np.searchsorted(self.link_a, np.arange(len(self.a)))
        b_group = np.searchsorted(self.link_b, np.arange(len(self.b)))
        a_upto, b_before = self.link_a + 1, np.append(0, self.link_b + 1)
        a_last = np.zeros(len(self.a), bool)
        b_last = np.zeros(len(self.b), bool)
        a_last[self.link_a] = b_last[self.link_b] = True
        out = np.empty(len(self.a) + len(self.b), object)
        inner, last = self.pair.a_text
        out[np.arange(len(self.a)) + b_before[a_group]] = np.where(a_last, last[self.a], inner[self.a])
        inner, last = self.pair.b_text
        out[np.arange(len(self.b)) + a_upto[b_group]] = np.where(b_last, last[self.b], inner[self.b])
        ends = np.append(0, np.cumsum(self.n_a + self.n_b)).tolist()
        out = out.tolist()
        return [b"".join(out[lo:hi])[:-1] for lo, hi in zip(ends, ends[1:])]

    def links(self) -> np.ndarray:
        """The id pair of each link as one number."""
        return (self.a[self.link_a] * self.pair.n_b + self.b[self.link_b]).astype(self.pair.link_type)

    def detail(self) -> dict[str, pa.Array]:
        """Ids, overlapping token places and groups of each document."""
        def lists(values: pa.Array, sizes: np.ndarray) -> pa.Array:
            return pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(sizes)), pa.int32()), values)

        doc = np.repeat(np.arange(self.n), self.n_a)[self.over_a]
        order = np.lexsort((self.over_b, self.over_a))
        first_a, first_b = (np.append(0, np.cumsum(n))[:-1] for n in (self.n_a, self.n_b))
        pairs = pa.StructArray.from_arrays(
            [pa.array((at - first[doc])[order], pa.int32())
             for at, first in ((self.over_a, first_a), (self.over_b, first_b))], names=["a", "b"])
        return {"a_ids": lists(pa.array(self.a, pa.int32()), self.n_a),
                "b_ids": lists(pa.array(self.b, pa.int32()), self.n_b),
                "overlaps": lists(pairs, np.bincount(doc, minlength=self.n)),
                "groups": pa.array([g.decode() for g in self.groups()])}


def _slices(sizes: list[int]) -> Iterator[tuple[int, int]]:
    """Runs of texts of at most ``BATCH_CHARS`` (one text may have more)."""
    lo, total = 0, 0
    for k, size in enumerate(sizes):
        if k > lo and (total + size > BATCH_CHARS or k - lo >= BATCH_DOCS):
            yield lo, k
            lo, total = k, 0
        total += size
    if sizes:
        yield lo, len(sizes)


def _paths(a_path: str | None, b_path: str | None) -> tuple[str, str]:
    return a_path or tokenizer_path("byte_bpe_50k.json"), b_path or tokenizer_path("piece_bpe_32k.model")


def align_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    a_path: str | None = None, b_path: str | None = None, detail: bool = True) -> DataFrame:
    """``doc_id, n_a, n_b, n_overlaps, n_groups, links, groups_sha256``: one row per row of
    ``docs``, in one pass without a shuffle.

    ``links`` holds ``a_id * (size of B's vocabulary) + b_id`` of each pair of tokens whose
    byte ranges end together, in order, as little-endian unsigned integers
    (``TokenPair.link_type``: 32 bits if they fit).  ``detail`` adds
    ``a_ids``, ``b_ids``, ``overlaps`` (places of all pairs of tokens that share a byte) and
    ``groups`` (``a1,a2|b1;a3|b2,b3``).  Special tokens' strings in a text are plain text.

    A text that is null, empty or that either tokenizer does not give back byte for byte (it
    holds U+2581, say) has no tokens: zeros, empty lists and an empty hash.  Whole texts are
    aligned, long ones in a batch of their own.  Equal rows and null ids are rows like any
    other; other columns of ``docs`` are not read; an empty table gives no rows.
    """
    paths = _paths(a_path, b_path)
    id_type = docs.schema[id_col].dataType.simpleString()

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = token_pair(*paths)
        for batch in batches:
            sizes = pc.fill_null(pc.utf8_length(batch.column("text")), 0).to_pylist()
            for lo, hi in _slices(sizes):
                got = Aligned(pair, [t or "" for t in batch.column("text").slice(lo, hi - lo).to_pylist()])
                ends = np.append(0, np.cumsum(got.n_links)).tolist()
                links = got.links()
                cols = {
                    "doc_id": batch.column("doc_id").slice(lo, hi - lo),
                    "n_a": pa.array(got.n_a), "n_b": pa.array(got.n_b),
                    "n_overlaps": pa.array(np.bincount(np.repeat(np.arange(got.n), got.n_a)[got.over_a],
                                                       minlength=got.n)),
                    "n_groups": pa.array(got.n_links),
                    "links": pa.array([links[x:y].tobytes() for x, y in zip(ends, ends[1:])], pa.binary()),
                    "groups_sha256": pa.array([hashlib.sha256(g).hexdigest() if g else "" for g in got.groups()])}
                if detail:
                    cols.update(got.detail())
                yield pa.RecordBatch.from_arrays(list(cols.values()), names=list(cols))

    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        align, f"doc_id {id_type}, n_a long, n_b long, n_overlaps long, n_groups long, links binary, "
               f"groups_sha256 string{', ' + _DETAIL if detail else ''}")


def link_counts(aligned: DataFrame, n_b: int, link_type: np.dtype) -> DataFrame:
    """``pair, n, is_best`` of all linked id pairs: how many links hold the pair, and whether
    no pair of the same B id is linked more often.  Counted in each task before the shuffle;
    the pairs are bounded by the vocabularies (see the module)."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for batch in batches:
            col = batch.column("links")
            for lo in range(0, len(col), BATCH_DOCS):
                links = np.frombuffer(b"".join(col.slice(lo, BATCH_DOCS).to_pylist()), link_type)
                new, n = np.unique(links, return_counts=True)
                keys, back = np.unique(np.concatenate([keys, new.astype(np.int64)]), return_inverse=True)
                total = np.zeros(len(keys), np.int64)
                np.add.at(total, back, np.concatenate([counts, n]))
                counts = total
        yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(counts)], names=["pair", "n"])

    counts = aligned.select("links").mapInArrow(count, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    same_b = Window.partitionBy(F.col("pair") % n_b)
    return counts.select("pair", "n", (F.col("n") == F.max("n").over(same_b)).alias("is_best"))


def with_counts(spark: SparkSession, aligned: DataFrame, counts: DataFrame, link_type: np.dtype) -> DataFrame:
    """``aligned`` with ``n_links``, ``n_best`` (links whose pair is a best of its B id) and
    ``count_sum`` (the counts of all links).  The counts, bounded by the vocabularies, are
    looked up in a broadcast."""
    table = counts.orderBy("pair").toArrow()
    known = spark.sparkContext.broadcast(tuple(
        table.column(c).to_numpy() for c in ("pair", "n", "is_best")))
    names = [c for c in aligned.columns if c != "links"]
    schema = ", ".join(f"`{c}` {aligned.schema[c].dataType.simpleString()}" for c in names)

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs, n, best = known.value
        for batch in batches:
            col = batch.column("links")
            for lo in range(0, len(col), BATCH_DOCS):
                rows = batch.slice(lo, BATCH_DOCS)
                data = rows.column("links").to_pylist()
                at = np.searchsorted(pairs, np.frombuffer(b"".join(data), link_type))
                ends = np.append(0, np.cumsum([len(x) // link_type.itemsize for x in data])).astype(np.int64)

                def summed(values: np.ndarray) -> pa.Array:
                    total = np.append(0, np.cumsum(values[at].astype(np.int64)))
                    return pa.array(total[ends[1:]] - total[ends[:-1]])

                yield pa.RecordBatch.from_arrays(
                    [rows.column(c) for c in names] + [pa.array(np.diff(ends)), summed(best), summed(n)],
                    names=[*names, "n_links", "n_best", "count_sum"])

    return aligned.select(*names, "links").mapInArrow(
        look_up, f"{schema}, n_links long, n_best long, count_sum long")


def alignment_digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                      a_path: str | None = None, b_path: str | None = None) -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256``: the aligned
    documents with their links weighed by the whole corpus.

    Documents are tokenised once: what the counts need is written to the shared folder and
    read back for counting and for the lookups.  Rows are as in :func:`align_documents`.
    """
    spark = docs.sparkSession
    paths = _paths(a_path, b_path)
    folder = shared_folder(spark, "alignment")
    align_documents(docs, id_col, text_col, *paths, detail=False).drop("n_overlaps").write.parquet(folder)
    aligned = spark.read.parquet(folder)
    pair = token_pair(*paths)
    counts = link_counts(aligned, pair.n_b, pair.link_type)
    return with_counts(spark, aligned, counts, pair.link_type).select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
