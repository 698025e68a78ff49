"""Adaptive range coder for token ids, mixing order-2, order-1 and order-0 predictions.

A block of ids is cut into lanes that are coded side by side with one model; nothing
outside a block is needed to decode it.  The model predicts from what the block has
shown so far:

* order 2 and order 1: for the last two ids and for the last id, the id that followed,
  with a confidence from 0 to 7;
* order 0: how often each id had to be spelled out.

For each pair of confidences the model counts how often either prediction was right;
these counts are the weights of the mixture: the range is shared out to the order-2
prediction, to the order-1 prediction and to the order-0 frequencies.  The model is
brought up to date after each round of steps, the same way by encoder and decoder, so
that all lanes and, when encoding, all steps of a round are array operations.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np

BLOCK_IDS = 1 << 22
MAX_LANES = 4096
#: ids of a lane, at least
LANE_IDS = 256
ROUND_STEPS = 16
_HEAD = struct.Struct("<4sIIIII")     # magic, ids, vocabulary, lanes, payload bytes, crc32
_MAGIC = b"KRC1"

_SHARE_BITS, _FREQ_BITS = 12, 20
_SHARES, _FREQS = 1 << _SHARE_BITS, 1 << _FREQ_BITS
_RUN_BITS = 6
_LEAST_REST = 64                      # of _SHARES, for order 0
_PAIR_BITS = 18
_U32 = np.uint64(32)
_LOW = np.uint64(0xFFFFFFFF)
_SH, _FR = np.uint64(_SHARE_BITS), np.uint64(_FREQ_BITS)


#: confidence after a wrong prediction (first eight: halved) and after a right one
_NEXT_SURE = np.array([k >> 1 for k in range(8)] + [min(k + 1, 7) for k in range(8)], np.uint8)
# what was coded: four times the weights' row, plus 1 if order 2 was right, else 2 if order 1 was
_CODED = np.arange(512)
_NEXT_TWO = _NEXT_SURE[(_CODED >> 6) + 8 * (_CODED & 3 == 1)]
_LOST_TWO = (_CODED & 3 != 1) & (_CODED >> 6 < 2)
# of order 1: twice the row, plus 1 if it was right
_NEXT_ONE = _NEXT_SURE[((_CODED >> 2) & 7) + 8 * (_CODED & 1)][:256]
_LOST_ONE = ((_CODED & 1 == 0) & ((_CODED >> 2) & 7 < 2))[:256]


class _Model:
    def __init__(self, vocab: int):
        self.vocab = vocab
        self.one = np.full(vocab + 1, vocab, np.int64)          # vocab: no prediction, no id
        self.two = np.full(1 << _PAIR_BITS, vocab, np.int32)
        self.sure_one = np.zeros(vocab + 1, np.uint8)
        self.sure_two = np.zeros(1 << _PAIR_BITS, np.uint8)
        self.spelled = np.zeros(vocab, np.int64)
        self.seen = np.zeros((128, 3), np.int64)                # coded, order 2 right, order 1 right
        self._weigh()

    def _weigh(self) -> None:
        n, two, one = (self.seen[:, k] for k in range(3))
        a = 1 + (_SHARES - 1) * (2 * two + 1) // (2 * n + 4)
        b = 1 + (_SHARES - 1) * (2 * one + 1) // (2 * n + 4)
        most = _SHARES - _LEAST_REST
        over = a + b > most
        a, b = (np.where(over, np.maximum(1, x * (most - 2) // (a + b)), x) for x in (a, b))
        self.upto_two, self.upto_one = a.astype(np.uint64), (a + b).astype(np.uint64)
        # by what was coded: where its share begins, and the share
        self.begin = np.stack([a + b, 0 * a, a, a], axis=1).astype(np.uint64).ravel()
        self.share = np.stack([_SHARES - a - b, a, b, b], axis=1).astype(np.uint64).ravel()
        total = int(self.spelled.sum())
        counts = np.cumsum(self.spelled) if total else np.arange(1, self.vocab + 1)
        spare = _FREQS - self.vocab
        self.cum = np.zeros(self.vocab + 1, np.int64)
        self.cum[1:] = np.arange(1, self.vocab + 1) + spare * counts // (total or self.vocab)
        self.start = self.cum.astype(np.uint64)
        self.freq = np.diff(self.start)
        self._index = None

    def find(self, place: np.ndarray) -> np.ndarray:
        """The id whose share of the order-0 frequencies holds each place.  An index of
        runs of places answers for those that lie in one share; the rest are searched."""
        if self._index is None:
            self._index = np.searchsorted(self.cum, np.arange(0, _FREQS + 1, 1 << _RUN_BITS), "right") - 1
        run = place >> _RUN_BITS
        ids = self._index.take(run)
        open_ = np.nonzero(self._index.take(run + 1) != ids)[0]
        ids[open_] = np.searchsorted(self.cum, place[open_], "right") - 1
        return ids

    def predict(self, before: np.ndarray, last: np.ndarray):
        """Predictions of both orders, the pair's place, and the weights' row."""
        pair = self.pair(before, last)
        two, one = self.two.take(pair), self.one.take(last)
        row = self.sure_two.take(pair) << 4 | self.sure_one.take(last) << 1 | (two == one)
        return pair, two, one, row.astype(np.int64)

    def pair(self, before: np.ndarray, last: np.ndarray) -> np.ndarray:
        mixed = before.astype(np.uint32) * np.uint32(0x9E3779B1)
        mixed += last.astype(np.uint32) * np.uint32(0x85EBCA77)
        mixed ^= mixed >> np.uint32(15)
        mixed *= np.uint32(0x2C1B3C6D)
        return (mixed >> np.uint32(32 - _PAIR_BITS)).astype(np.int64)

    def learn(self, ids, last, pair, one, coded) -> None:
        """Take in a round, in the order of steps, then lanes; a place that comes up more
        than once keeps its last."""
        ids, last, pair, one, coded = (x.ravel() for x in (ids, last, pair, one, coded))
        seen = np.bincount(coded, minlength=512).reshape(128, 4)
        self.seen += np.stack([seen.sum(axis=1), seen[:, 1], seen[:, 2]], axis=1)
        self.spelled += np.bincount(ids[coded & 3 == 0], minlength=self.vocab)
        by_one = coded >> 2 << 1 | (ids == one)
        for at, known, lost, after, table, sure in (
                (pair, coded, _LOST_TWO, _NEXT_TWO, self.two, self.sure_two),
                (last, by_one, _LOST_ONE, _NEXT_ONE, self.one, self.sure_one)):
            lost = np.nonzero(lost.take(known))[0]
            table[at.take(lost)] = ids.take(lost)
            sure[at] = after.take(known)
        self._weigh()


def _rounds(steps: int):
    lo, n = 0, 1
    while lo < steps:
        hi = min(steps, lo + n)
        yield lo, hi
        lo, n = hi, min(ROUND_STEPS, n if lo == 0 else 2 * n)


def _context(x: np.ndarray, lo: int, hi: int, vocab: int):
    """Ids before the steps ``lo`` to ``hi`` of each lane: the one before the last, the last."""
    pad = np.full((2, x.shape[1]), vocab, x.dtype)
    full = np.concatenate([pad, x[max(0, lo - 2):hi]]) if lo < 2 else x[lo - 2:hi]
    full = full[len(full) - (hi - lo) - 2:]
    return full[:-2], full[1:-1]


def _lanes(n: int) -> int:
    return max(1, min(MAX_LANES, n // LANE_IDS))


def encode_block(ids: np.ndarray, vocab: int) -> bytes:
    """One block: header, words of each lane, checksum over all that follows it."""
    n = len(ids)
    if not 0 < n <= 0xFFFFFFFF or vocab >= _FREQS or int(ids.max()) >= vocab:
        raise ValueError("a block takes ids below its vocabulary, one at least")
    lanes = _lanes(n)
    steps = -(-n // lanes)
    x = np.zeros(lanes * steps, np.int64)
    x[:n] = ids
    x = np.ascontiguousarray(x.reshape(lanes, steps).T)
    model = _Model(vocab)
    low = np.zeros(lanes, np.uint64)
    size = np.full(lanes, 0xFFFFFFFFFFFFFFFF, np.uint64)
    words = np.zeros((lanes, steps + 2), np.uint64)
    used = np.zeros(lanes, np.int64)

    def add(amount):
        nonlocal low
        new = low + amount
        carry = np.nonzero(new < low)[0]
        if len(carry):
            words[carry, used[carry] - 1] += np.uint64(1)
        low = new

    for lo, hi in _rounds(steps):
        part = x[lo:hi]
        before, last = _context(x, lo, hi, vocab)
        pair, two, one, row = model.predict(before, last)
        is_two = part == two
        coded = row << 2
        coded += is_two
        coded += 2 * (~is_two & (part == one))
        told = coded & 3 != 0
        begin, share = model.begin.take(coded), model.share.take(coded)
        start, freq = model.start.take(part), model.freq.take(part)
        np.copyto(start, np.uint64(0), where=told)
        np.copyto(freq, np.uint64(_FREQS), where=told)
        for t in range(hi - lo):
            unit = size >> _SH
            new = unit * begin[t]
            unit *= share[t]
            unit >>= _FR
            # what was cut off the share's range is not used
            new += unit * start[t]
            add(new)
            size = unit * freq[t]
            out = np.nonzero(size <= _LOW)[0]
            if len(out):
                words[out, used[out]] = low[out] >> _U32
                used[out] += 1
                low[out] <<= _U32
                size[out] <<= _U32
        model.learn(part, last, pair, one, coded)

    add(np.full(lanes, 0xFFFFFFFF, np.uint64))
    words[np.arange(lanes), used] = low >> _U32
    used += 1
    for k in range(words.shape[1] - 1, 0, -1):
        words[:, k - 1] += words[:, k] >> _U32
        words[:, k] &= _LOW
    mask = np.arange(words.shape[1]) < used[:, None]
    payload = used.astype("<u4").tobytes() + words[mask].astype("<u4").tobytes()
    head = _HEAD.pack(_MAGIC, n, vocab, lanes, len(payload), 0)
    crc = zlib.crc32(payload, zlib.crc32(head[:-4]))
    return head[:-4] + struct.pack("<I", crc) + payload


def block_size(head: bytes) -> tuple[int, int]:
    """(bytes of the block, its ids) from its first ``HEAD_BYTES`` bytes."""
    magic, n, _, _, payload, _ = _HEAD.unpack(head)
    if magic != _MAGIC:
        raise ValueError("not a block")
    return _HEAD.size + payload, n


HEAD_BYTES = _HEAD.size


def decode_block(block: bytes) -> np.ndarray:
    """The ids of a block; fails if its checksum does not hold."""
    magic, n, vocab, lanes, length, crc = _HEAD.unpack_from(block)
    payload = block[_HEAD.size:_HEAD.size + length]
    if magic != _MAGIC or len(payload) != length or \
            zlib.crc32(payload, zlib.crc32(block[:_HEAD.size - 4])) != crc:
        raise ValueError("damaged block")
    steps = -(-n // lanes)
    used = np.frombuffer(payload, "<u4", lanes).astype(np.int64)
    flat = np.frombuffer(payload, "<u4", offset=4 * lanes)
    width = int(used.max()) + 2
    words = np.zeros((lanes, width), np.uint64)
    words[np.arange(width) < used[:, None]] = flat
    model = _Model(vocab)
    val = words[:, 0] << _U32 | words[:, 1]
    # where each lane's next word is; after its last there are zeros
    at, last_at = (np.arange(lanes) * width + k for k in (2, width - 1))
    words = words.ravel()
    size = np.full(lanes, 0xFFFFFFFFFFFFFFFF, np.uint64)
    # two steps before the first: no ids
    full = np.full((steps + 2, lanes), vocab, np.int64)
    x = full[2:]
    pairs, ones, codes = (np.zeros((min(steps, ROUND_STEPS), lanes), np.int64) for _ in range(3))
    for lo, hi in _rounds(steps):
        for t in range(lo, hi):
            pair, two, one, row = model.predict(full[t], full[t + 1])
            unit = size >> _SH
            place = val // unit
            is_two, told = place < model.upto_two.take(row), place < model.upto_one.take(row)
            coded = np.left_shift(row, 2, out=codes[t - lo])
            coded += told
            coded += told & ~is_two
            pairs[t - lo], ones[t - lo] = pair, one
            val -= unit * model.begin.take(coded)
            unit *= model.share.take(coded)
            unit >>= _FR
            ids = x[t]
            np.copyto(ids, one)
            np.copyto(ids, two, where=is_two)
            size = unit << _FR
            rest = np.nonzero(~told)[0]
            if len(rest):
                u, v = unit.take(rest), val.take(rest)
                spelled = model.find(np.minimum(v // u, np.uint64(_FREQS - 1)).astype(np.int64))
                ids[rest] = spelled
                val[rest] = v - u * model.start.take(spelled)
                size[rest] = u * model.freq.take(spelled)
            out = np.nonzero(size <= _LOW)[0]
            if len(out):
                place = at.take(out)
                val[out] = val.take(out) << _U32 | words.take(np.minimum(place, last_at.take(out)))
                at[out] = place + 1
                size[out] = size.take(out) << _U32
        model.learn(x[lo:hi], full[lo + 1:hi + 1], *(c[:hi - lo] for c in (pairs, ones, codes)))
    return x.astype(np.int32).T.ravel()[:n]
