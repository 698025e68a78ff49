import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from kiln.llm import catalog, packing, tokens
from kiln.llm.tokens import PieceEncoder, tokenizer_path

from .conftest import ODD_ROWS, SF


def ids_of(texts, name, end):
    tok = Tokenizer.from_file(tokenizer_path(name))
    return [np.array(e.ids + [end], "<u4") for e in
            tok.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def check(rows, texts, size=1024):
    """Pieces cover every document's ids once, sequences are gapless and without padding."""
    want = Counter((d, x.tobytes()) for d, x in
                   zip((d for d, _ in texts), ids_of([t for _, t in texts], packing.TOKENIZER, 0)))
    seqs, pieces = defaultdict(list), defaultdict(list)
    for r in rows:
        seqs[r.sequence_id].append((r.offset, r.length))
        pieces[r.doc_id].append(r)
    for parts in seqs.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at and length > 0
            at += length
        assert at <= size and (at == size or at & (at - 1) == 0)
    assert sum(r.length for r in rows) == sum(len(x) // 4 * n for (_, x), n in want.items())
    known = defaultdict(list)
    for (d, x), n in want.items():
        known[d] += [x] * n
    for d, parts in pieces.items():
        assert {r.doc_tokens for r in parts} <= {len(x) // 4 for x in known[d]}
        for r in parts:
            assert any(zlib.crc32(x[4 * r.start:4 * (r.start + r.length)]) == r.ids_crc32
                       for x in known[d])


def test_packs_the_table(spark, tables):
    rows = catalog.op1_packing(spark, SF).collect()
    texts = [(r.doc_id, r.text) for r in tables("documents").collect()]
    check(rows, texts)
    per_doc = defaultdict(list)
    for r in rows:
        per_doc[r.doc_id].append((r.start, r.length, r.doc_tokens))
    assert set(per_doc) == {d for d, _ in texts}
    for parts in per_doc.values():
        at = 0
        for start, length, total in sorted(parts):
            assert start == at
            at += length
        assert at == total


def test_odd_rows(odd_docs):
    check(packing.piece_digests(packing.pack_documents(odd_docs)).collect(), ODD_ROWS)


def test_no_rows(no_docs):
    assert packing.pack_documents(no_docs).count() == 0


def test_level_is_the_one_of_smallest_sum_of_squares():
    rng = np.random.default_rng(0)
    packer = packing.SumOfSquares(16, lambda w: None)
    for n in rng.integers(1, 16, 300).tolist():
        sums = {}
        for level in [0] + [h for h in range(1, 16) if packer.counts[h] and h + n <= 16]:
            c = packer.counts.copy()
            if level:
                c[level] -= 1
            if level + n < 16:
                c[level + n] += 1
            sums[level] = int((c[1:16] ** 2).sum())
        assert sums[packer.level_for(n)] == min(sums.values())
        packer.add(("d", 0, n, b"\0" * 4 * n))


@pytest.mark.parametrize("max_open", [1, 2, 50])
def test_nothing_is_lost_when_open_sequences_are_topped_up(max_open):
    rng = np.random.default_rng(1)
    done = []
    packer = packing.SumOfSquares(64, done.append, max_open)
    ids = [rng.integers(0, 1000, int(n)).astype("<u4").tobytes() for n in rng.integers(1, 64, 400)]
    for d, x in enumerate(ids):
        packer.add((d, 0, len(x) // 4, x))
        assert packer.n_open <= max_open
    packer.close()
    got = defaultdict(dict)
    for w in done:
        n = sum(len(x[3]) for x in w) // 4
        assert n == 64 or n & (n - 1) == 0
        for d, start, _, x in w:
            got[d][start] = x
    assert [b"".join(x for _, x in sorted(got[d].items())) for d in range(len(ids))] == ids


@pytest.mark.parametrize("name,spaced", [("byte_bpe_50k.json", True), ("word_bpe_49k.json", False)])
def test_pieces_have_the_ids_of_the_whole_text(tables, name, spaced):
    odd = ["", "  lead", "trail  ", "a  b", "a\n b", "a\n\n\nb", "a\n\n", "\n\na", "a\n\nb c", "\na\nb\n", "x.\n's y","a \nb", "tab\tb \tc", "don't we'll I'S", "é é É",
           "Σ ΑΣ ΑΣ.", "İstanbul", "日本 語。", "1,234 5.6", "a b  c", "word.,! word...",
           "ß ẞ ª º µ ÷ ×", "\0a b", "a \0b", "e ́x", "ﬁ ﬃ", "\x85 a\x85b c \x85 d", " ", " a", "\n",
           "\na", "a's,b", "x" * 300, "<|startoftext|> <|endoftext|>", "a\x1cb \x1d c"]
    texts = [r.text for r in tables("documents").limit(100).collect()] + odd
    encoder = PieceEncoder(tokenizer_path(name), spaced, cache_pieces=50)
    assert encoder.encode([None]) == [b""]
    for lo in range(0, len(texts), 7):
        part = texts[lo:lo + 7]
        assert encoder.encode(part) == [x[:-1].tobytes() for x in ids_of(part, name, 0)]


@pytest.mark.parametrize("name,spaced", [("byte_bpe_50k.json", True), ("word_bpe_49k.json", False)])
def test_columns_have_the_ids_of_the_whole_texts(monkeypatch, name, spaced):
    monkeypatch.setattr(tokens, "COLUMN_WORDS", 5)
    rng = np.random.default_rng(5)
    letters = np.array([*"aAbKtsß'.,!?-$<|>1 \t\n\x1c\x85", "é", "É", "×", "÷", "ſ", "İ", "́", "日", "　", "'s", "  "])
    texts = ["".join(rng.choice(letters, int(n))) for n in rng.integers(0, 25, 1500)]
    texts += [None, "", " ", None, "Don't. we'll! x's... x's!?", "...", "a-. b", "é. É, ×! ÷? é.", "日。 日.",
              "a<|endoftext|>. B", "<|ENDOFTEXT|> A.", "word..... word.!", "1. 2, 3x!", "x" * 300 + ".", ".a", "'. '!! a'."]
    encoder = PieceEncoder(tokenizer_path(name), spaced, cache_pieces=50)
    column = pa.array(texts)
    for lo in range(0, len(texts), 100):
        sizes, ids = encoder.encode_column(column.slice(lo, 100), 7)
        want = ids_of(texts[lo:lo + 100], name, 7)
        assert sizes.tolist() == [len(x) for x in want]
        assert np.concatenate(list(ids)).tolist() == np.concatenate(want).tolist()


def test_a_column_asks_for_each_distinct_word_once(monkeypatch):
    asked = []
    encoder = PieceEncoder(tokenizer_path("word_bpe_49k.json"), False)
    raw = encoder._raw
    monkeypatch.setattr(encoder, "_raw", lambda pieces: asked.extend(pieces) or raw(pieces))
    column = pa.array(["One word, one WORD. Word! Word$$ (one)", "WORD one, ONE?! Two."] * 500)
    for _ in range(2):
        encoder.encode_column(column, 2)
    assert sorted(asked) == sorted(["one", "word", "two", ",", ".", "!", "$$", "?!", "(one", ")"])
