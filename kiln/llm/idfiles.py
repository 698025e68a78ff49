"""Files of token ids, range-coded in independent, checksummed blocks.

A file holds a run of documents in ascending id order::

    magic, blocks of ids, document table, trailer

Blocks (``rangecoder``) are cut from the ids of all documents of the file one after the
other.  The document table (zlib) has each document's id and number of ids; the trailer
its place, length and checksum, the number of ids, and the magic again.  A task writes
one file under a name of its own and reports it; only reported files are read, so a task
that is lost and run again leaves at most a file that nobody reads.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from . import rangecoder
from .storage import file_system, shared_folder
from .tokens import piece_encoder, tokenizer_path
from .words import slices

TOKENIZER = "word_bpe_49k.json"
VOCABULARY = 49_408
END_ID = 2
MAGIC = b"KILNIDS1"
_TRAILER = struct.Struct("<QIIQQ8s")    # table: offset, bytes, crc32; documents, ids, magic


class IdFileWriter:
    """Writes one file; ids are held until a block is full."""

    def __init__(self, sink, vocab: int, block_ids: int = rangecoder.BLOCK_IDS):
        self._sink, self._vocab, self._block = sink, vocab, block_ids
        self._held: list[np.ndarray] = []
        self._n_held = 0
        self._docs: list[int | None] = []
        self._sizes: list[int] = []
        self._offset = sink.write(MAGIC)
        self.n_ids = 0

    def add(self, doc: int | None, ids: np.ndarray) -> None:
        self.add_all([doc], np.array([len(ids)]), [ids])

    def add_all(self, docs: Sequence[int | None], sizes: np.ndarray, ids: Iterable[np.ndarray]) -> None:
        """Documents in order with their numbers of ids, and all their ids, cut anywhere."""
        self._docs.extend(docs)
        self._sizes.extend(sizes.tolist())
        for part in ids:
            self._hold(part)

    def _hold(self, ids: np.ndarray) -> None:
        self.n_ids += len(ids)
        self._held.append(ids)
        self._n_held += len(ids)
        while self._n_held >= self._block:
            self._flush(self._block)

    def _flush(self, n: int) -> None:
        ids = np.concatenate(self._held)
        self._held, self._n_held = [ids[n:]], len(ids) - n
        self._offset += self._sink.write(rangecoder.encode_block(ids[:n], self._vocab))

    def close(self) -> tuple[int, int, int]:
        """(documents, ids, bytes) of the file."""
        if self._n_held:
            self._flush(self._n_held)
        known = np.array([d is not None for d in self._docs], np.uint8)
        docs = np.array([d or 0 for d in self._docs], "<i8")
        table = zlib.compress(known.tobytes() + docs.tobytes()
                              + np.array(self._sizes, "<u8").tobytes())
        self._sink.write(table)
        self._sink.write(_TRAILER.pack(self._offset, len(table), zlib.crc32(table),
                                       len(self._docs), self.n_ids, MAGIC))
        return len(self._docs), self.n_ids, self._offset + len(table) + _TRAILER.size


def read_id_file(source, size: int) -> Iterator[tuple[int | None, int, np.ndarray]]:
    """``(document, place of its first id in the file, ids)`` in order; one block and what
    is left of the one before are held."""
    source.seek(size - _TRAILER.size)
    at, length, crc, n_docs, n_ids, magic = _TRAILER.unpack(source.read(_TRAILER.size))
    if magic != MAGIC:
        raise ValueError("not a file of ids")
    source.seek(at)
    table = source.read(length)
    if zlib.crc32(table) != crc:
        raise ValueError("damaged document table")
    table = zlib.decompress(table)
    known = np.frombuffer(table, np.uint8, n_docs)
    docs = np.frombuffer(table, "<i8", n_docs, n_docs)
    sizes = np.frombuffer(table, "<u8", n_docs, 9 * n_docs)
    source.seek(len(MAGIC))
    held, place = np.zeros(0, np.int32), 0
    for doc, has_id, n in zip(docs.tolist(), known.tolist(), sizes.tolist()):
        while len(held) < n:
            head = source.read(rangecoder.HEAD_BYTES)
            block = head + source.read(rangecoder.block_size(head)[0] - len(head))
            held = np.concatenate([held, rangecoder.decode_block(block)])
        yield (doc if has_id else None), place, held[:n]
        held, place = held[n:], place + n
    if place != n_ids or source.tell() != at:
        raise ValueError("ids and document table differ")


def write_id_files(docs: DataFrame, folder: str, id_col: str = "doc_id", text_col: str = "text",
                   tokenizer: str | None = None, spaced: bool = False, vocab: int = VOCABULARY,
                   end_id: int = END_ID, partitions: int | None = None) -> DataFrame:
    """Write the ids of all texts, in ascending order of (id, text), one file per
    range partition; returns the written manifest ``part, file, docs, ids, bytes``.

    Each row is a document; null ids come first; null and empty texts have the end id
    alone.  Ids are integers.  No rows give no files.
    """
    spark = docs.sparkSession
    path = tokenizer or tokenizer_path(TOKENIZER)
    file_system(folder)[0].create_dir(file_system(folder)[1], recursive=True)
    partitions = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    # ranges are cut by a short beginning of the text: their sample goes to the driver
    rows = (docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).alias("text"))
            .repartitionByRange(partitions, "doc", F.substring("text", 1, 16))
            .sortWithinPartitions("doc", "text"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        encoder = piece_encoder(path, spaced)
        fs, place = file_system(folder)
        name = f"ids-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}"
        sink = writer = None
        for batch in batches:
            for part in slices(batch, 1, batch.num_rows):
                if writer is None:
                    sink = fs.open_output_stream(f"{place}/{name}", compression=None)
                    writer = IdFileWriter(sink, vocab)
                sizes, ids = encoder.encode_column(part.column(1), end_id)
                writer.add_all(part.column(0).to_pylist(), sizes, (x.astype(np.int32) for x in ids))
        if writer is not None:
            n_docs, n_ids, size = writer.close()
            sink.close()
            yield pa.RecordBatch.from_pydict(
                {"part": pa.array([TaskContext.get().partitionId()], pa.int32()), "file": [name],
                 "docs": [n_docs], "ids": [n_ids], "bytes": [size]})

    return rows.mapInArrow(write, "part int, file string, docs long, ids long, bytes long").checkpoint()


def read_id_files(manifest: DataFrame, folder: str, id_col: str = "doc_id") -> DataFrame:
    """Documents of the files in a manifest: ``id_col, start, n_tokens, ids`` (``start``:
    ids of all documents before it; ``ids`` little-endian unsigned 32-bit)."""
    files = sorted(manifest.collect(), key=lambda r: r["part"])     # one row per file
    places, start = [], 0
    for f in files:
        places.append((f["file"], start, f["bytes"]))
        start += f["ids"]
    spark = manifest.sparkSession
    todo = spark.createDataFrame(places, "file string, start long, bytes long")
    if places:
        todo = todo.repartitionByRange(len(places), "start")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, place = file_system(folder)
        for batch in batches:
            for f in batch.to_pylist():
                with fs.open_input_file(f"{place}/{f['file']}") as source:
                    out: list[tuple] = []
                    held = 0
                    for doc, at, ids in read_id_file(source, f["bytes"]):
                        out.append((doc, f["start"] + at, len(ids), ids.astype("<u4").tobytes()))
                        held += len(ids)
                        if held > 1 << 21:
                            yield _batch(out)
                            out, held = [], 0
                    if out:
                        yield _batch(out)

    return (todo.mapInArrow(read, "doc long, start long, n_tokens long, ids binary")
            .withColumnRenamed("doc", id_col))


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    doc, start, n, ids = zip(*rows)
    return pa.RecordBatch.from_arrays(
        [pa.array(doc, pa.int64()), pa.array(start, pa.int64()), pa.array(n, pa.int64()),
         pa.array(ids, pa.binary())], names=["doc", "start", "n_tokens", "ids"])


def through_files(docs: DataFrame, folder: str | None = None, **options) -> DataFrame:
    """Write ``docs`` to files of ids in a new shared folder and read them back."""
    folder = folder or shared_folder(docs.sparkSession, "ids")
    id_col = options.get("id_col", "doc_id")
    return read_id_files(write_id_files(docs, folder, **options), folder, id_col)
