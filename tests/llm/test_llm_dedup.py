import hashlib
import re
from collections import Counter

import numpy as np
import pytest
import xxhash

from kiln.llm import catalog, components, simhash, substrings

from .conftest import ODD_ROWS, SF, prose


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


# ---- SimHash ---------------------------------------------------------------------

def fingerprint(text, n=3):
    w = words(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(w[k:k + n]) for k in range(len(w) - n + 1)] or ([" ".join(w)] if w else [])
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << j for j in range(64) if 2 * sum(x >> j & 1 for x in h) > len(h))


def linked(ids, fps, bits=2):
    """Smallest id reachable, by brute force."""
    group = list(range(len(ids)))

    def find(x):
        while group[x] != x:
            x = group[x]
        return x
    fps = np.array(fps, np.uint64)
    for i in range(len(fps)):
        for j in (np.nonzero(np.bitwise_count(fps[i + 1:] ^ fps[i]) <= bits)[0] + i + 1).tolist():
            group[find(i)] = find(j)
    least = {}
    for k, i in enumerate(ids):
        if i is not None:
            least[find(k)] = min(i, least.get(find(k), i))
    return [least.get(find(k)) for k in range(len(ids))]


def expect(rows):
    fps = [fingerprint(t) for _, t in rows]
    return Counter((i, f"{f:016x}", c) for (i, _), f, c in
                   zip(rows, fps, linked([i for i, _ in rows], fps)))


def test_simhash_of_the_table(spark, tables):
    rows = [(r.doc_id, r.text) for r in tables("documents").collect()]
    assert Counter(map(tuple, catalog.op6_simhash(spark, SF).collect())) == expect(rows)


def test_simhash_of_odd_rows(odd_docs, no_docs):
    assert Counter(map(tuple, simhash.near_duplicates(odd_docs).collect())) == expect(ODD_ROWS)
    assert simhash.near_duplicates(no_docs).count() == 0


def test_long_texts_are_cut_into_chunks_without_a_trace(monkeypatch):
    text = prose(4, 500).encode()
    whole = simhash.fingerprints([text])
    monkeypatch.setattr(simhash, "word_chunks", lambda d: iter(
        [d.split()[k:k + 1] for k in range(len(d.split()))]))
    assert simhash.fingerprints([text]) == whole
    assert simhash.fingerprints([b"One", b"two words", b""]).tolist() == [
        fingerprint("One"), fingerprint("two words"), 0]


@pytest.mark.parametrize("hot", [1, 4, 1000])
def test_links_do_not_depend_on_where_hot_variants_start(spark, hot):
    """A dense group (all within a few bits of one value) and scattered values."""
    rng = np.random.default_rng(3)
    centre = int(rng.integers(0, 1 << 63))
    fps = {centre ^ (1 << int(a)) ^ (1 << int(b)) ^ (1 << int(c))
           for a, b, c in rng.integers(0, 64, (150, 3))} | {int(x) for x in rng.integers(0, 1 << 63, 100)}
    fps = sorted(fps | {x ^ 3 for x in list(fps)[:20]})
    signed = [x - (1 << 64) if x >= 1 << 63 else x for x in fps]
    edges = simhash.links(spark.createDataFrame([(x,) for x in signed], "fp long"), hot)
    for a, b in edges.collect():
        assert bin((a ^ b) & (1 << 64) - 1).count("1") <= 2
    got = {r.node: r.component for r in components.components(edges).collect()}
    want = linked(signed, fps)
    assert [got.get(x, x) for x in signed] == want


def test_components_of_a_path_and_loops(spark):
    edges = [(k, k + 1) for k in range(40)] + [(100, 101), (101, 100), (7, 7), (None, 3), (55, 55)]
    got = dict(components.components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert got == {**{k: 0 for k in range(41)}, 100: 100, 101: 100}


# ---- substrings --------------------------------------------------------------------

def cut(rows, size=20):
    """Brute force; rows in their order of precedence."""
    seen, out = set(), []
    for i, text in rows:
        w = words(text)
        keep = [True] * len(w)
        for k in range(len(w) - size + 1):
            key = tuple(w[k:k + size])
            if key in seen:
                keep[k:k + size] = [False] * size
            seen.add(key)
        kept = " ".join(x for x, y in zip(w, keep) if y)
        out.append((i, len(w), len(w) - sum(keep), kept))
    return out


def test_substrings_of_the_table(spark, tables):
    rows = sorted((r.doc_id, r.text) for r in tables("documents").collect())
    want = [(i, n, m, hashlib.sha256(k.encode()).hexdigest()) for i, n, m, k in cut(rows)]
    got = catalog.op2_substrings(spark, SF).select("doc_id", "n_words", "n_removed", "kept_sha256")
    assert sorted(map(tuple, got.collect())) == want
    assert sum(m for _, _, m, _ in want) > 0


def test_substrings_of_odd_rows(odd_docs, no_docs):
    rows = sorted((r for r in ODD_ROWS if r[0] is not None), key=lambda r: (r[0], r[1] or ""))
    rows += [r for r in ODD_ROWS if r[0] is None]
    got = substrings.remove_repeats(odd_docs, carry=["source", "fp"]).collect()
    assert Counter((r.doc_id, r.n_words, r.n_removed, r.kept_text) for r in got) == Counter(cut(rows))
    assert {(r.source, r.fp) for r in got} == {("s", 2)}
    assert substrings.remove_repeats(no_docs).count() == 0


def test_substrings_keep_ids_of_any_size(spark):
    text = prose(8, 30)
    ids = [-(1 << 63), -1, 0, 1 << 62, (1 << 62) + 5, (1 << 63) - 1, None, None]
    rows = [(i, text if k % 2 else text + f" end{k}") for k, i in enumerate(ids)]
    got = substrings.remove_repeats(spark.createDataFrame(rows[::-1], "doc_id long, text string"))
    got = Counter((r.doc_id, r.n_words, r.n_removed, r.kept_text) for r in got.collect())
    # the two rows without id come last, in any order
    assert got == Counter(cut(rows)) and got[(-(1 << 63), 31, 0, text + " end0")] == 1


@pytest.mark.parametrize("size", [2, 4, 20])
def test_windows_of_any_size_and_very_frequent_words(spark, size):
    rng = np.random.default_rng(size)
    rows = [(k, " ".join(rng.choice(["a", "b", "the"], int(rng.integers(0, 60)), p=[.1, .1, .8])))
            for k in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = substrings.remove_repeats(df, window_words=size)
    assert sorted(map(tuple, got.collect())) == cut(rows, size)


def test_untouched_texts_stay_as_they_are(spark):
    df = spark.createDataFrame([(1, " a\n b "), (2, None)], "doc_id long, text string")
    got = substrings.remove_repeats(df, keep_untouched=True)
    assert sorted(map(tuple, got.collect())) == [(1, 2, 0, " a\n b "), (2, 0, 0, None)]


def test_slices_hold_all_rows_and_bounded_bytes(monkeypatch):
    import pyarrow as pa
    from kiln.llm import words
    monkeypatch.setattr(words, "SLICE_BYTES", 100)
    texts = [None, "", "x" * 60, "y" * 40, "z", "w" * 500, "v", None, *("u" * 30 for _ in range(9))]
    batch = pa.RecordBatch.from_pydict({"id": list(range(len(texts))), "text": texts})
    got = [p.column("text").to_pylist() for p in words.slices(batch, "text", 4)]
    assert sum(got, []) == texts
    assert all(len(p) <= 4 and (len(p) == 1 or sum(len(t or "") for t in p) <= 100) for p in got)
    assert len(got[0]) == 4 and list(words.slices(batch.slice(0, 0), 1, 4)) == []
