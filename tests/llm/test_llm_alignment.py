"""Alignment of two tokenisations against a plain version, over whole texts."""

import hashlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from kiln.llm import alignment as al
from kiln.llm.catalog import QUERIES
from kiln.llm.tokens import byte_encoder, tokenizer_path


@pytest.fixture(scope="module")
def tokenizers():
    """The two libraries as the contract names them, and the bytes of their tokens."""
    import sentencepiece
    from tokenizers import Tokenizer
    a = Tokenizer.from_file(tokenizer_path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=tokenizer_path("piece_bpe_32k.model"))
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    letters = {chr(x): x for x in own}
    letters.update({chr(256 + k): x for k, x in enumerate(x for x in range(256) if x not in own)})

    def a_bytes(i):
        return bytes(letters[c] for c in a.id_to_token(i))

    def b_bytes(i):
        p = b.id_to_piece(i)
        return bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode()

    return a, b, a_bytes, b_bytes


def ranges(ids, bytes_of):
    out, at = [], 0
    for i in ids:
        out.append((at, at + len(bytes_of(i))))
        at = out[-1][1]
    return out


def one(text, tokenizers):
    """ids of both sides, their ranges; empty where the bytes are not given back."""
    a, b, a_bytes, b_bytes = tokenizers
    if not text:
        return [], [], [], []
    x, y = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
    data = b" " + text.encode()
    if b"".join(map(a_bytes, x)) != data or b"".join(map(b_bytes, y)) != data:
        return [], [], [], []
    return x, y, ranges(x, a_bytes), ranges(y, b_bytes)


def brute(rows, tokenizers):
    """Expected rows of the query, from ends in a dictionary and groups in a loop."""
    docs, counts = [], Counter()
    for i, text in rows:
        x, y, rx, ry = one(text, tokenizers)
        end_b = {e: j for j, (_, e) in enumerate(ry)}
        links = [(k, end_b[e]) for k, (_, e) in enumerate(rx) if e in end_b]
        groups, a0, b0 = [], 0, 0
        for k, j in links:
            groups.append(",".join(map(str, x[a0:k + 1])) + "|" + ",".join(map(str, y[b0:j + 1])))
            a0, b0 = k + 1, j + 1
        pairs = [(x[k], y[j]) for k, j in links]
        counts.update(pairs)
        docs.append((i, len(x), len(y), len(groups), pairs, ";".join(groups)))
    best = defaultdict(int)
    for (_, q), n in counts.items():
        best[q] = max(best[q], n)
    return [(i, na, nb, ng, len(p), sum(counts[z] == best[z[1]] for z in p), sum(counts[z] for z in p),
             hashlib.sha256(g.encode()).hexdigest() if g else "") for i, na, nb, ng, p, g in docs], counts


def sort(rows):
    return sorted(map(tuple, rows), key=repr)


def test_query_equals_brute_force_on_the_whole_table(spark, tables, tokenizers):
    rows = [tuple(r) for r in tables("documents").select("doc_id", "text").collect()]
    want, counts = brute(rows, tokenizers)
    assert sort(QUERIES["op13_alignment"](spark, SF_SMALL).collect()) == sort(want)
    assert len(counts) < al.token_pair(*al._paths(None, None)).pair_bound() < 400_000


ODD = [(20, "<|endoftext|> <s></s><unk> <0x41> Ġ"), (21, "a▁b"), (22, "▁"), (23, "  lead and trail  \t\r\n"),
       (24, "é" * 3000), (25, "日本語のテキスト😀👩‍👩‍👧"), (26, "﻿​ x\x85"), (27, "\x00\x01"),
       (28, "ſﬁ ①Å Å"), (29, "a\nb\n\n\nc    d"), (20, "<|endoftext|> <s></s><unk> <0x41> Ġ")]


def test_odd_rows(spark, odd_docs, no_docs, tokenizers):
    more = spark.createDataFrame(ODD, "doc_id long, text string")
    docs = odd_docs.unionByName(more, allowMissingColumns=True).select(
        "*", *(F.lit(1).alias(c) for c in ("links", "n_a", "pair", "groups", "doc", "at")))
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    assert sort(al.alignment_digests(docs).collect()) == sort(brute(rows, tokenizers)[0])
    assert al.alignment_digests(no_docs).count() == 0


def test_overlaps_are_all_pairs_that_share_bytes(spark, odd_docs, tokenizers):
    docs = odd_docs.where("length(text) < 3000").unionByName(
        spark.createDataFrame(ODD, "doc_id long, text string"), allowMissingColumns=True)
    found = al.align_documents(docs).collect()
    assert len(found) == docs.count()
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    for r in found:
        if r["doc_id"] is None:
            continue
        x, y, rx, ry = one(texts[r["doc_id"]], tokenizers)
        assert (r["a_ids"], r["b_ids"]) == (x, y)
        want, j = [], 0
        for k, (lo, hi) in enumerate(rx):
            while j and ry[j - 1][1] > lo:
                j -= 1
            while j < len(ry) and ry[j][1] <= lo:
                j += 1
            while j < len(ry) and ry[j][0] < hi:
                want.append((k, j))
                j += 1
        assert [tuple(p) for p in r["overlaps"]] == want and r["n_overlaps"] == len(want)
        assert hashlib.sha256(r["groups"].encode()).hexdigest() == r["groups_sha256"] or not r["groups"]


def test_batches_do_not_matter(monkeypatch):
    pair = al.token_pair(*al._paths(None, None))
    texts = ["one two", "", "three", "日本 x", "a▁", "y" * 50]
    alone = [al.Aligned(pair, [t]).groups()[0] for t in texts]
    assert al.Aligned(pair, texts).groups() == alone
    monkeypatch.setattr(al, "BATCH_CHARS", 10)
    assert list(al._slices([len(t) for t in texts])) == [(0, 2), (2, 4), (4, 5), (5, 6)]
    assert list(al._slices([])) == []


@pytest.mark.parametrize("special", [False, True])
def test_fast_encoder_gives_the_ids_of_the_tokenizers_library(special):
    from tokenizers import Tokenizer
    path = tokenizer_path("byte_bpe_50k.json")
    slow = Tokenizer.from_file(path)
    slow.encode_special_tokens = not special
    fast = byte_encoder(path, special)
    texts = [f"a{c}b {c}1{c}, {c}{c} a {c}'ll  {c}" for c in map(chr, range(1, 0xD800, 7))]
    texts += [t for _, t in ODD] + ["", "x" * 5000, "<|endoftext|>" * 3, "a <|endoftext|>b", " " * 3000 + "x"]
    for t, e in zip(texts, slow.encode_batch(texts, add_special_tokens=False)):
        assert fast.encode(t).tolist() == e.ids


def test_white_space_without_end():
    fast = byte_encoder(tokenizer_path("byte_bpe_50k.json"), False)
    ids = fast.encode("a" + " " * 1_500_000 + "b")
    assert b"".join(fast.bytes_of[i] for i in ids.tolist()) == b"a" + b" " * 1_500_000 + b"b"


def test_ids_are_unsigned_words():
    assert byte_encoder(tokenizer_path("byte_bpe_50k.json"), True).encode("a b").dtype == np.uint32
    assert pa.array(byte_encoder(tokenizer_path("byte_bpe_50k.json"), True).encode("a")).type == pa.uint32()
