"""Sum-of-squares packing of documents into fixed-length training sequences.

Each task packs the rows it reads, in one pass and without a shuffle: a document's
ids fill whole sequences first, and what remains is one item that goes into the open
sequence whose choice makes the sum of squared level counts smallest.  Levels (ids in
an open sequence) are tracked in one array of counts.  Sequences still open at the
end of a task, or beyond ``max_open``, are topped up by cutting items of the emptiest
ones; the last partial sequence of a task is cut into powers of two, the lengths that
need no padding.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from .tokens import byte_encoder, piece_encoder, tokenizer_path
from .words import slices

SEQUENCE_TOKENS = 1024
TOKENIZER = "byte_bpe_50k.json"
END_ID = 0
#: open sequences that a task holds at most (4 KB of ids each)
MAX_OPEN = 2048
#: sequences that one task can number
SEQUENCES_PER_TASK = 1 << 33

_FIELDS = [("start", "long"), ("length", "long"), ("doc_tokens", "long"),
           ("sequence_id", "long"), ("offset", "long"), ("ids", "binary")]


class SumOfSquares:
    """Open sequences of one task, by level.

    An item is ``(doc, start, doc_tokens, ids)``.  Full sequences are handed to
    ``emit`` as lists of items.
    """

    def __init__(self, size: int, emit, max_open: int = MAX_OPEN):
        self.size, self.emit, self.max_open = size, emit, max_open
        self.counts = np.zeros(size + 1, dtype=np.int64)
        self.at: dict[int, list[list]] = {}
        self.n_open = 0

    def level_for(self, n: int) -> int:
        """Level (0: a new sequence) that takes ``n`` more ids at the smallest sum of
        squares of the counts of levels 1 to size - 1; ties go to the fullest."""
        top = self.size - n
        gain = 2 * self.counts + 1      # the sum grows so when a level gets one more
        gain[self.size] = 0             # full sequences are no longer open
        best, least = 0, gain[n]
        if top > 0:
            move = gain[n + 1:self.size + 1] - (2 * self.counts[1:top + 1] - 1)
            move[self.counts[1:top + 1] == 0] = np.iinfo(np.int64).max
            k = top - 1 - int(np.argmin(move[::-1]))
            if self.counts[k + 1] and move[k] <= least:
                best = k + 1
        return best

    def add(self, item: tuple) -> None:
        n = len(item[3]) // 4
        level = self.level_for(n)
        window = self._pop(level) if level else []
        window.append(item)
        if level + n == self.size:
            self.emit(window)
        else:
            self._push(level + n, window)
            if self.n_open > self.max_open:
                self.top_up()

    def _pop(self, level: int) -> list:
        self.counts[level] -= 1
        self.n_open -= 1
        return self.at[level].pop()

    def _push(self, level: int, window: list) -> None:
        self.counts[level] += 1
        self.n_open += 1
        self.at.setdefault(level, []).append(window)

    def top_up(self) -> None:
        """Fill the fullest open sequences from the emptiest, cutting items where needed;
        at most one sequence stays open."""
        order = [(lv, w) for lv in sorted(self.at) for w in self.at[lv]]
        self.counts[:] = 0
        self.at, self.n_open = {}, 0
        lo, hi = 0, len(order) - 1
        donor = list(order[lo][1]) if order else []
        while lo < hi:
            level, window = order[hi]
            room = self.size - level
            while room:
                if not donor:
                    lo += 1
                    if lo >= hi:
                        break
                    donor = list(order[lo][1])
                doc, start, total, ids = donor.pop()
                n = len(ids) // 4
                if n > room:    # its tail moves, its head waits for the next sequence
                    donor.append((doc, start, total, ids[:4 * (n - room)]))
                    start, ids, n = start + n - room, ids[4 * (n - room):], room
                window.append((doc, start, total, ids))
                room -= n
            if room:
                self._push(self.size - room, window)
                return
            self.emit(window)
            hi -= 1
        if donor:
            self._push(sum(len(x[3]) for x in donor) // 4, donor)

    def close(self) -> None:
        self.top_up()
        rest = [x for windows in self.at.values() for w in windows for x in w]
        self.counts[:] = 0
        self.at, self.n_open = {}, 0
        left = sum(len(x[3]) for x in rest) // 4
        while left:
            room = 1 << (left.bit_length() - 1)
            left -= room
            window = []
            while room:
                doc, start, total, ids = rest.pop()
                n = len(ids) // 4
                if n > room:
                    rest.append((doc, start + room, total, ids[4 * room:]))
                    ids, n = ids[:4 * room], room
                window.append((doc, start, total, ids))
                room -= n
            self.emit(window)


def _pack_partition(batches: Iterator[pa.RecordBatch], path: str, spaced: bool, size: int,
                    end_id: int, max_open: int, task: int) -> Iterator[pa.RecordBatch]:
    if spaced:
        fast = byte_encoder(path, special=True)

        def encode(texts):
            return [fast.encode(t).astype("<u4").tobytes() if t else b"" for t in texts]
    else:
        encode = piece_encoder(path, spaced).encode
    end = int(end_id).to_bytes(4, "little")
    out: list[tuple] = []
    next_id = task * SEQUENCES_PER_TASK

    def emit(window):
        nonlocal next_id
        offset = 0
        for doc, start, total, ids in window:
            n = len(ids) // 4
            out.append((doc, start, n, total, next_id, offset, ids))
            offset += n
        next_id += 1

    id_type = None

    def flush():
        cols = list(zip(*out))
        out.clear()
        return pa.RecordBatch.from_arrays(
            [pa.array(cols[0], type=id_type)]
            + [pa.array(c, type=pa.int64()) for c in cols[1:6]]
            + [pa.array(cols[6], type=pa.binary())],
            names=["doc"] + [f for f, _ in _FIELDS])

    packer = SumOfSquares(size, emit, max_open)
    for batch in batches:
        id_type = batch.schema.field(0).type
        for part in slices(batch, 1, 128):
            for doc, ids in zip(part.column(0).to_pylist(),
                                encode(part.column(1).to_pylist())):
                ids += end
                total = len(ids) // 4
                whole = total // size * size
                for start in range(0, whole, size):
                    emit([(doc, start, total, ids[4 * start:4 * (start + size)])])
                if whole < total:
                    packer.add((doc, whole, total, ids[4 * whole:]))
            if len(out) >= 4096:
                yield flush()
    packer.close()
    if out:
        yield flush()


def pack_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   tokenizer: str | None = None, spaced: bool = True,
                   size: int = SEQUENCE_TOKENS, end_id: int = END_ID,
                   max_open: int = MAX_OPEN) -> DataFrame:
    """Pieces of packed sequences: ``id_col, start, length, doc_tokens, sequence_id,
    offset, ids`` (``ids`` little-endian unsigned 32-bit).

    Each row of ``docs`` is a document of its own, also when its id or its text
    repeats or its id is null.  Its ids are those of the whole text followed by
    ``end_id``; a null or empty text has the end id alone.  No rows give no pieces.
    Other columns of ``docs`` are not read, whatever their names.  Equal items go to the
    same levels in whatever order they are read; texts of any length are packed whole.
    ``spaced`` says that ``tokenizer`` is byte-level.
    """
    path = tokenizer or tokenizer_path(TOKENIZER)

    def pack(batches):
        from pyspark import TaskContext
        yield from _pack_partition(batches, path, spaced, size, end_id, max_open,
                                   TaskContext.get().partitionId())

    rows = docs.select(F.col(id_col).alias("doc"), F.col(text_col).alias("text"))
    schema = T.StructType([T.StructField("doc", rows.schema["doc"].dataType)]
                          + [T.StructField(f, T.LongType() if t == "long" else T.BinaryType())
                             for f, t in _FIELDS])
    return rows.mapInArrow(pack, schema).withColumnRenamed("doc", id_col)


def piece_digests(pieces: DataFrame) -> DataFrame:
    """The pieces with ``ids_crc32`` in place of their ids."""
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")
