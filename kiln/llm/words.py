"""Words of texts: runs of characters other than ``\\x20`` and ``\\x09``-``\\x0D``."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: bytes of a text that are cut into words at a time
CHUNK_BYTES = 1 << 22
#: bytes of texts that are worked on together, if they are more than one text
SLICE_BYTES = 1 << 23
_SPACE = re.compile(rb"[\x20\x09-\x0d]")


def word_chunks(data: bytes, size: int = CHUNK_BYTES) -> Iterator[list[bytes]]:
    """The words of ``data`` (UTF-8) in order, a bounded number of bytes at a time.

    ``bytes.split`` cuts at exactly the six ASCII white-space characters."""
    lo = 0
    while len(data) - lo > size:
        cut = _SPACE.search(data, lo + size)
        if cut is None:
            break
        yield data[lo:cut.start()].split()
        lo = cut.start()
    yield data[lo:].split()


def slices(batch: pa.RecordBatch, texts: int | str, rows: int) -> Iterator[pa.RecordBatch]:
    """All rows of ``batch`` in order, at most ``rows`` at a time and, where that leaves more
    than one, about ``SLICE_BYTES`` of the column ``texts`` at most."""
    sizes = pc.fill_null(pc.binary_length(batch.column(texts)), 0).to_numpy(zero_copy_only=False)
    ends, lo = np.cumsum(sizes, dtype=np.int64), 0
    while lo < batch.num_rows:
        before = int(ends[lo - 1]) if lo else 0
        hi = max(lo + 1, min(lo + rows, int(np.searchsorted(ends, before + SLICE_BYTES, "right"))))
        yield batch.slice(lo, hi - lo)
        lo = hi
