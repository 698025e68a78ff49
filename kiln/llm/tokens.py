"""Tokenising whole texts with the ``tokenizers`` library, piece by piece.

A text is cut where its tokenizer cuts it anyway, so that the ids of a text are
the ids of its pieces one after the other.  Each distinct piece is encoded by
the library once per worker and kept in a bounded table; prose repeats its words,
so most pieces come from the table.

* byte-level tokenizers: before a single space that stands between two
  characters that are not white space (the space opens the next pre-token);
* word tokenizers that drop white space: at white space (whole columns of texts: at ASCII
  white space, by Arrow).
"""

from __future__ import annotations

import json
import os
import re
import struct
from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: pieces that a worker keeps (as many again from before), and their characters at most
CACHE_PIECES = 500_000
PIECE_CHARS = 48
#: words of a column whose ids are put together at a time
COLUMN_WORDS = 1 << 18
#: marks at the end of a word that are cut off, at most
MARKS = 4

#: white space other than spaces and line feeds
_OTHER_SPACE = re.compile("[\t\x0b-\r\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
_INNER_SPACE = re.compile(r"(?<=\S) (?=\S)")
#: white space to Python's ``str`` but not to the tokenizers' patterns
_SEPARATORS = re.compile("[\x1c-\x1f]")
_PACKED = [struct.Struct(f"<{n}I").pack for n in range(64)]
#: a word of letters, Latin-1 at most, and the mark after it: two pre-tokens
_PLAIN = re.compile("([A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\xff]+)([.,;:!?]*)")

#: bytes that are ASCII letters and digits
_LETTERS = np.array([b < 128 and chr(b).isalnum() for b in range(256)])


def tokenizer_path(name: str) -> str:
    """Place of a vocabulary file of the installed public tokenizers."""
    import public_tokenizers
    return public_tokenizers.path(name)


def _byte_letters() -> dict[int, str]:
    """The printable letter of each byte in byte-level vocabularies: itself where Latin-1
    prints it, else the next one from U+0100 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in own]
    return {**{b: chr(b) for b in own}, **{b: chr(256 + k) for k, b in enumerate(rest)}}


def token_bytes(vocab: dict[str, int]) -> dict[int, bytes]:
    """The bytes of each entry of a byte-level vocabulary, by id."""
    back = {letter: byte for byte, letter in _byte_letters().items()}
    return {i: bytes(back[c] for c in entry) for entry, i in vocab.items() if all(c in back for c in entry)}


class ByteEncoder:
    """A byte-level vocabulary file run by the ``tiktoken`` library, which gives the same ids
    as ``tokenizers`` in less time.  With ``special`` the strings of added tokens in a text
    become their ids, else they are plain text.

    The ids are the same where those of merged entries follow the order of the merges and
    the pre-tokenizer is the plain byte-level one, which is checked."""

    def __init__(self, path: str, special: bool):
        import public_tokenizers
        import tiktoken
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab = spec["model"]["vocab"]
        merged = [vocab["".join(m.split(" ") if isinstance(m, str) else m)] for m in spec["model"]["merges"]]
        if merged != sorted(merged) or spec["pre_tokenizer"]["type"] != "ByteLevel":
            raise ValueError(f"not a plain byte-level vocabulary: {path}")
        added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.bytes_of = token_bytes({e: i for e, i in vocab.items() if e not in added})
        self.size = max(*vocab.values(), *added.values()) + 1
        self._path, self._special, self._whole = path, special, None
        self._fast = tiktoken.Encoding(
            os.path.basename(path), pat_str=public_tokenizers.PATTERN,
            mergeable_ranks={b: i for i, b in self.bytes_of.items()}, special_tokens=added)

    def encode(self, text: str) -> np.ndarray:
        """Ids of a text, unsigned 32-bit."""
        try:
            return self._fast.encode_to_numpy(
                text, allowed_special="all" if self._special else set(), disallowed_special=())
        except ValueError:
            # white space without end is too deep for the pattern there
            pass
        if self._whole is None:
            from tokenizers import Tokenizer
            os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
            self._whole = Tokenizer.from_file(self._path)
            self._whole.encode_special_tokens = not self._special
        return np.array(self._whole.encode(text, add_special_tokens=False).ids, np.uint32)


@lru_cache(maxsize=2)
def byte_encoder(path: str, special: bool) -> ByteEncoder:
    """The worker's encoder."""
    return ByteEncoder(path, special)


@lru_cache(maxsize=2)
def piece_encoder(path: str, spaced: bool) -> "PieceEncoder":
    """The worker's encoder; what it knows serves later tasks too."""
    return PieceEncoder(path, spaced)


class PieceEncoder:
    """Texts to ids, as little-endian unsigned 32-bit bytes.

    ``spaced`` says how pieces are cut: True for byte-level tokenizers (a piece
    keeps its leading space), False for word tokenizers.  A null text has no ids.
    """

    def __init__(self, path: str, spaced: bool, cache_pieces: int = CACHE_PIECES):
        from tokenizers import Tokenizer
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self._tok = Tokenizer.from_file(path)
        self._spaced, self._cap = spaced, cache_pieces
        self._known: dict[str, bytes] = {}
        self._before: dict[str, bytes] = {}
        self._bytes = _byte_letters()
        self._merge = self._tok.model.tokenize
        self._marks = {c: self._model(c) for c in ".,;:!?"}
        self._line = self._model(self._bytes[0x0A]) if spaced else b""
        added = [t.content for t in self._tok.get_added_tokens_decoder().values()]
        #: what all added tokens begin with, in lower case
        self._added = os.path.commonprefix(added).lower() if added else None
        #: bytes that are marks of no added token
        self._marking = np.array([32 < b < 127 and not chr(b).isalnum() and not any(chr(b) in a for a in added)
                                  for b in range(256)])

    def _model(self, pre_token: str) -> bytes:
        ids = [t.id for t in self._merge(pre_token)]
        return _PACKED[len(ids)](*ids) if len(ids) < len(_PACKED) else struct.pack(f"<{len(ids)}I", *ids)

    def _word(self, word: str, start: bool = False) -> bytes:
        """Ids of a word of letters, with the space before it unless it stands at a start."""
        if not self._spaced:
            word = word.lower()
        if not word.isascii():
            word = word.encode().decode("latin-1").translate(self._bytes)
        return self._model(self._bytes[0x20] + word if self._spaced and not start else word)

    def _raw(self, pieces: list[str]) -> list[bytes]:
        """Ids of pieces that are not known yet.  Plain words go to the library's model
        directly, as the one or two pre-tokens they are; all else goes through the whole
        tokenizer."""
        out: list[bytes | None] = []
        other = []
        for piece in pieces:
            if piece.isascii() and piece.isalpha():
                out.append(self._word(piece))
                continue
            stem = piece[:-1]
            mark = self._marks.get(piece[-1:])
            if mark is not None and stem.isalpha() and stem.isascii():
                out.append((self._known.get(stem) or self._before.get(stem) or self._word(stem)) + mark)
                continue
            line = self._spaced and piece[:2] == "\n\0"
            start = line or self._spaced and piece[:1] == "\0"
            plain = _PLAIN.fullmatch(piece, 2 * line or int(start))
            if plain is None:
                other.append(len(out))
                out.append(None)
                continue
            word, marks = plain.groups()
            known = None if start or not marks else self._known.get(word)
            out.append((self._line if line else b"") + (known or self._word(word, start))
                       + (b"" if not marks else self._marks.get(marks) or self._model(marks)))
        if other:
            done = self._tok.encode_batch([self._source(pieces[k]) for k in other],
                                          add_special_tokens=False)
            for k, e in zip(other, done):
                ids = e.ids
                out[k] = struct.pack(f"<{len(ids)}I", *ids)
        return out

    def _pieces(self, text: str) -> list[str]:
        if self._spaced:
            if "\0" in text:
                return ["\0" + text]
            plain = not (text[0] == " " or text[-1] == " " or "  " in text or " \n" in text
                         or "\n " in text or "\n\n" in text or _OTHER_SPACE.search(text))
            # a single line feed is a pre-token of its own, and no space opens the next
            parts = (text.replace("\n", " \n\0").split(" ") if plain else _INNER_SPACE.split(text))
            # a text starts without a space: mark its first piece
            parts[0] = "\0" + parts[0]
            return parts
        return [text] if _SEPARATORS.search(text) else text.split()

    def _source(self, piece: str) -> str:
        if not self._spaced:
            return piece
        if piece[:2] == "\n\0":
            return "\n" + piece[2:]
        return piece[1:] if piece[0] == "\0" else " " + piece

    def encode(self, texts: Sequence[str | None]) -> list[bytes]:
        """One bytes value per text."""
        cut = [self._pieces(t) if t else () for t in texts]
        known = self._known
        new = set().union(*cut).difference(known)
        extra = {}
        if new:
            if len(known) + len(new) > self._cap:
                self._before, self._known = known, {}
                known, new = self._known, set().union(*cut)
            before = self._before
            again = new.intersection(before)
            known.update((p, before[p]) for p in again)
            new -= again
            short = [p for p in new if len(p) <= PIECE_CHARS]
            known.update(zip(short, self._raw(short)))
            long = [p for p in new if len(p) > PIECE_CHARS]
            if long:
                extra = dict(zip(long, self._raw(long)))
        if extra:
            return [b"".join([known.get(p) if p in known else extra[p] for p in c]) for c in cut]
        return [b"".join([known[p] for p in c]) for c in cut]

    def _codes(self, pieces: list[str]) -> list[bytes]:
        """Ids of distinct pieces."""
        out = list(map(self._known.get, pieces))
        new = [k for k, c in enumerate(out) if c is None]
        if not new:
            return out
        if len(self._known) + len(new) > self._cap:
            self._before, self._known = self._known, {}
        known, before = self._known, self._before
        unseen = []
        for k in new:
            piece = pieces[k]
            out[k] = code = before.get(piece)
            if code is None:
                unseen.append(k)
            else:
                known[piece] = code
        for k, code in zip(unseen, self._raw([pieces[k] for k in unseen])):
            out[k] = code
            if len(pieces[k]) <= PIECE_CHARS:
                known[pieces[k]] = code
        return out

    def _words(self, texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
        """The words of all texts, one after the other, and how many there are up to the end of
        each text.

        Texts are cut at ASCII white space alone (a word may be empty) and before a few marks
        that end a word, after a letter or digit; A-Z are in lower case, unless that could
        make an added token."""
        texts = pc.fill_null(texts, "")
        low = pc.ascii_lower(texts)
        if self._added is not None:
            low = pc.if_else(pc.match_substring(low, self._added), texts, low)
        cut = pc.ascii_split_whitespace(low)
        upto = np.cumsum(pc.list_value_length(cut).to_numpy(zero_copy_only=False), dtype=np.int64)
        words = cut.flatten()
        ends = np.frombuffer(words.buffers()[1], np.int32 if pa.types.is_string(words.type) else np.int64)
        ends = ends[words.offset:words.offset + len(words) + 1]
        data = np.frombuffer(words.buffers()[2] or b"", np.uint8)
        if not len(data):
            return words, upto
        last = np.nonzero(self._marking[data[ends[1:] - 1]] & (np.diff(ends) > 1))[0]
        place = ends[last + 1] - 1
        for _ in range(MARKS - 1):
            more = self._marking[data[np.maximum(place - 1, 0)]]
            place -= more
        one, two = (data[np.maximum(place - k, 0)] for k in (1, 2))
        plain = _LETTERS[one] & (place - ends[last] >= 1)
        latin = (two == 0xC3) & (one >= 0x80) & (one < 0xC0) & (one != 0x97) & (one != 0xB7) & (place - ends[last] >= 2)
        keep = plain | latin
        last = last[keep]
        cuts = np.insert(ends, last + 1, place[keep])
        words = pa.Array.from_buffers(words.type, len(cuts) - 1, [None, pa.py_buffer(cuts), words.buffers()[2]])
        return words, upto + np.searchsorted(last, upto)

    def encode_column(self, texts: pa.Array, end_id: int) -> tuple[np.ndarray, Iterator[np.ndarray]]:
        """The number of ids of each text with ``end_id`` after it, and all these ids
        (unsigned 32-bit), a bounded number of words at a time.

        Word tokenizers: words are cut and told apart by Arrow, so that Python sees each
        distinct word of the column once."""
        if self._spaced:
            end = int(end_id).to_bytes(4, "little")
            done = [np.frombuffer(ids + end, "<u4") for ids in self.encode(texts.to_pylist())]
            return np.array([len(x) for x in done], np.int64), iter(done)
        words, at = self._words(texts)
        words = words.dictionary_encode()
        codes = self._codes(words.dictionary.to_pylist())
        codes.append(int(end_id).to_bytes(4, "little"))
        flat = np.frombuffer(b"".join(codes), "<u4")
        size = np.fromiter(map(len, codes), np.int64, len(codes)) >> 2
        start = np.cumsum(size) - size
        index = np.insert(words.indices.to_numpy(zero_copy_only=False), at, len(codes) - 1)
        upto = np.zeros(len(index) + 1, np.int64)
        np.cumsum(size[index], out=upto[1:])
        ends = upto[at + np.arange(1, len(at) + 1)]

        def ids() -> Iterator[np.ndarray]:
            for lo in range(0, len(index), COLUMN_WORDS):
                part = index[lo:lo + COLUMN_WORDS]
                before = upto[lo:lo + len(part) + 1] - upto[lo]
                yield flat[np.repeat(start[part] - before[:-1], np.diff(before)) + np.arange(before[-1])]

        return np.diff(ends, prepend=0), ids()
