import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from kiln.llm import catalog, decontaminate, neighbours, toxicity

from .conftest import SF, prose

# ---- toxicity ----------------------------------------------------------------------


def planted(n=600):
    """Clean sentences, and in every third document one with a planted word."""
    rng = np.random.default_rng(0)
    rows, labels = [], []
    for k in range(n):
        sentences = [prose(int(rng.integers(0, 10_000)), 8) + "." for _ in range(int(rng.integers(1, 6)))]
        if k % 3 == 0:
            at = int(rng.integers(0, len(sentences)))
            sentences[at] = prose(k, 3) + f" {'grump' if k % 2 else 'snarl'}{k % 7} " + prose(k + 1, 3) + "."
        rows.append((k, (" " if k % 4 else "\n").join(sentences)))
        labels.append((k, int(k % 3 == 0)))
    return rows, labels


def test_labels_of_documents_find_sentences(spark):
    rows, labels = planted()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = toxicity.train(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
    got = toxicity.score(docs, model).withColumn("held", toxicity.held_out("doc_id")).collect()
    held = [r for r in got if r.held]
    assert {r.doc_id for r in held} == {k for k, _ in rows if zlib.crc32(str(k).encode()) % 5 == 0}
    right = [(r.score >= 0.5) == (r.doc_id % 3 == 0) for r in held]
    assert sum(right) / len(right) > 0.95
    texts = dict(rows)
    found = [texts[r.doc_id].split()[s.first_word:s.first_word + s.n_words]
             for r in got for s in r.offending]
    assert sum(any("grump" in w or "snarl" in w for w in s) for s in found) / len(found) > 0.95


def test_noisy_or_of_the_sentences(spark):
    model = toxicity.Model(*_model({"bad": 3.0, "worse": 5.0}), -2.0)
    text = "bad, bad thing. Fine here.\nworse bad"
    row = toxicity.score(spark.createDataFrame([(text,)], "text string"), model).first()
    p = [1 / (1 + np.exp(-z)) for z in (1.0, -2.0, 6.0)]
    assert row.score == pytest.approx(1 - np.prod([1 - x for x in p]), rel=1e-9)
    assert [(s.first_word, s.n_words) for s in row.offending] == [(0, 3), (5, 2)]
    assert [s.score for s in row.offending] == pytest.approx([p[0], p[2]])


def _model(weights):
    from xxhash import xxh32_intdigest
    items = sorted((xxh32_intdigest(w), x) for w, x in weights.items())
    return np.array([h for h, _ in items], np.uint32), np.array([x for _, x in items])


def test_odd_rows_are_scored(odd_docs, no_docs, spark):
    labels = spark.createDataFrame([(1, 1), (2, 0), (6, None), (None, 1), (99, 1)], "doc_id long, toxic int")
    model = toxicity.train(odd_docs, labels)
    got = toxicity.score(odd_docs, model).collect()
    assert len(got) == odd_docs.count() and all(0 <= r.score <= 1 for r in got)
    assert all(r.score == 0 for r in got if not (r.text or "").strip())
    assert toxicity.score(no_docs, model).count() == 0
    none = toxicity.train(no_docs, labels.where("1 = 0"))
    assert {r.score < 1e-5 for r in toxicity.score(odd_docs.where("doc_id = 6"), none).collect()} == {True}


def test_sample_is_bounded_in_bytes(spark, monkeypatch):
    rows, labels = planted(400)
    docs = spark.createDataFrame(rows + rows[:50] + [(401, "grump1 " * 9000)], "doc_id long, text string")
    marks = spark.createDataFrame(labels + labels[:9] + [(401, 0)], "doc_id long, toxic int")
    seen = []
    monkeypatch.setattr(toxicity, "fit", lambda y, parts: seen.append([len(s) for s, _ in parts]))
    by_hash = [r.doc_id for r in docs.select("doc_id").distinct().where(~toxicity.held_out("doc_id"))
               .orderBy(F.xxhash64("doc_id")).collect() if r.doc_id != 401]      # 401: too long
    texts = dict(rows)
    for size in (1 << 16, 20_000):
        toxicity.train(docs, marks, train_bytes=size)
        sizes = np.cumsum([len(texts[i].encode()) for i in by_hash if len(texts[i]) <= size // 64])
        assert len(seen[-1]) == np.searchsorted(sizes, size, "right")
    toxicity.train(docs, marks, train_docs=10)
    assert len(seen[-1]) == 10


def test_fit_in_chunks_is_the_same(monkeypatch):
    rows, labels = planted(200)
    s = toxicity._Sentences(pa.array([t for _, t in rows]))
    sentence, feature = s.features()
    size = np.bincount(sentence, minlength=len(s.first))
    docs = [(size[s.sentence_doc == k], feature[s.sentence_doc[sentence] == k].astype(np.uint32))
            for k in range(len(rows))]
    y = np.array([t for _, t in labels])
    whole = toxicity.fit(y, docs, steps=40)
    monkeypatch.setattr(toxicity, "CHUNK", 37)
    cut = toxicity.fit(y, docs, steps=40)
    np.testing.assert_array_equal(whole.features, cut.features)
    np.testing.assert_allclose(whole.weights, cut.weights, rtol=1e-6, atol=1e-9)


def test_held_out_accuracy_on_the_table(spark, tables):
    sf = SF.replace("0.001", "0.1")
    got = catalog.op3_toxicity(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id")
    right = got.where("held_out").agg(F.avg((F.col("predicted") == F.col("toxic")).cast("int")),
                                      F.count("*")).first()
    assert right[1] > 500 and right[0] > 0.95


# ---- decontamination ---------------------------------------------------------------

def lower_words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").lower())


def leaks(docs, items, n=5, least=0.8):
    """Largest weighted similarity of all windows, by brute force; a text of fewer words
    than a shingle is one."""
    def shingles(t):
        w = lower_words(t)
        return [tuple(w[k:k + n]) for k in range(len(w) - n + 1)] or ([tuple(w)] if w else [])

    out = {}
    for i, t in docs:
        s = shingles(t)
        for item, u in items:
            other = Counter(shingles(u))
            if i is None or item is None or not s or not other:
                continue
            m = sum(other.values())
            best = 0
            for k in range(max(1, len(s) - m + 1)):
                window = Counter(s[k:k + m])
                both = sum((window & other).values())
                best = max(best, both / (sum(window.values()) + m - both))
            if best >= least:
                out[i, item] = max(out.get((i, item), 0), round(best, 9))
    return out


def found(df):
    return {(r.doc_id, r.item_id): round(r.similarity, 9) for r in df.collect()}


def test_leaks_of_the_table(spark, tables):
    sf = SF.replace("0.001", "0.01")
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet")
            .where("length(text) < 4000").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    grams = {g for _, u in items for w in [lower_words(u)] for g in zip(*(w[k:] for k in range(5)))}
    near = [(i, t) for i, t in docs
            if any(g in grams for w in [lower_words(t)] for g in zip(*(w[k:] for k in range(5))))]
    got = {k: v for k, v in found(catalog.op10_decontaminate(spark, sf)).items()
           if k[0] in {i for i, _ in docs}}
    assert got == leaks(near, items) and got


def test_leaks_of_the_table_at_any_length(spark, tables):
    """All documents: brute force over every window of the pairs that share enough places."""
    sf = SF.replace("0.001", "0.01")
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    grams = {}
    for k, (_, u) in enumerate(items):
        w = lower_words(u)
        for g in zip(*(w[j:] for j in range(5))):
            grams.setdefault(g, set()).add(k)
    want, long = {}, 0
    for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect():
        w = lower_words(r.text)
        shared = Counter(k for g in zip(*(w[j:] for j in range(5))) for k in grams.get(g, ()))
        # similarity is at most shared places / shingles of the item
        for k, places in shared.items():
            if places >= 0.8 * (len(lower_words(items[k][1])) - 4):
                one = leaks([(r.doc_id, r.text)], [items[k]])
                want.update(one)
                long += len(one) if len(r.text) >= 4000 else 0
    assert found(catalog.op10_decontaminate(spark, sf)) == want and long


def test_edited_leaks(spark):
    """Words changed, put in and taken out, at text ends and inside, and short texts."""
    rng = np.random.default_rng(5)
    items = [(k, prose(100 + k, int(rng.integers(1, 70)))) for k in range(25)] + [(77, None), (None, prose(1, 30))]
    docs = []
    for k in range(200):
        w = lower_words(items[k % 25][1])
        for _ in range(int(rng.integers(0, 3))):
            at = int(rng.integers(0, len(w)))
            w = [w[:at] + ["new"] + w[at + 1:], w[:at] + ["new"] + w[at:], w[:at] + w[at + 1:]][k % 3] or w
        docs.append((k, prose(k, k % 4 * 10) + " " + " ".join(w) + " " + prose(k + 1, k % 3 * 10)))
    got = found(decontaminate.contaminated(spark.createDataFrame(docs, "doc_id long, text string"),
                                           spark.createDataFrame(items, "item_id long, text string")))
    assert got == leaks(docs, items) and len(got) > 60


def test_leaks_with_parts_moved(spark):
    """Parts of an item in another order, words between them; also repeated shingles."""
    rng = np.random.default_rng(6)
    items, docs = [], []
    for k in range(45):
        m, gap = [(60, 1), (100, 5), (200, 8)][k % 3]
        # no word twice; every fifth item repeats its first part's words
        w = [f"i{k}w{x % (m // 2) if k % 5 == 0 else x}" for x in range(m)]
        cut = m // 2 if k < 30 else int(rng.integers(1, m))
        fill = [f"gap{x}" for x in range(gap if k < 30 else int(rng.integers(0, 12)))]
        items.append((k, " ".join(w)))
        docs.append((k, " ".join([prose(k, 20)] + w[cut:] + fill + w[:cut] + [prose(k + 1, 30)])))
        docs.append((100 + k, " ".join(w[cut:] + fill + w[:cut])))
        docs.append((200 + k, " ".join(w[:cut] + fill + w + fill + w[cut:])))
    docs += [(7, items[8][1]), (7, prose(3, 40) + " " + items[7][1])]         # two texts of one id
    items.append((8, items[9][1]))                                            # two texts of one item
    got = found(decontaminate.contaminated(spark.createDataFrame(docs, "doc_id long, text string"),
                                           spark.createDataFrame(items, "item_id long, text string")))
    assert got == leaks(docs, items) and {k for k in range(30) if (k, k) in got} >= {0, 1, 2}


def test_short_texts_and_few_words_much_repeated(spark):
    """Texts below a shingle are matched whole; alternating words at similarity 0.9."""
    items = [(1, "What is the capital"), (2, "yes"), (3, "a b c"), (4, "one two three four five")]
    docs = [(k, t) for k, t in enumerate(["what is  the CAPITAL", "yes", "yes yes", "c b a", "a b c", "a b c d e",
                                          "tell me what is the capital of it", "one two three four",
                                          "one two three four five", "", None])]
    for k in range(40):
        items.append((100 + k, " ".join([f"a{k}", f"b{k}"] * 12)[:-len(f" b{k}")]))
        docs.append((100 + k, " ".join([f"b{k}", f"a{k}"] * 12)[:-len(f" a{k}")]))
    got = found(decontaminate.contaminated(spark.createDataFrame(docs, "doc_id long, text string"),
                                           spark.createDataFrame(items, "item_id long, text string")))
    assert got == leaks(docs, items)
    assert set(got) == {(0, 1), (1, 2), (4, 3), (8, 4)} | {(k, k) for k in range(100, 140)}


def test_odd_tables(spark, odd_docs, no_docs):
    items = spark.createDataFrame([(1, prose(2, 25)), (2, ""), (3, "word " * 30), (3, "word " * 30)],
                                  "item_id long, text string").withColumn("fp", F.lit(1))
    rows = [(r.doc_id, r.text) for r in odd_docs.select("doc_id", "text").collect()]
    got = found(decontaminate.contaminated(odd_docs, items))
    assert got == leaks(rows, [(1, prose(2, 25)), (3, "word " * 30)]) and set(got) == {(2, 1), (10, 3)}
    assert decontaminate.contaminated(no_docs, items).count() == 0
    assert decontaminate.contaminated(odd_docs, items.where("1 = 0")).count() == 0


# ---- nearest neighbours ------------------------------------------------------------

def nearest(rows, asked, k):
    """Brute force over usable vectors; exact sums of short vectors."""
    ok = [(i, v) for i, v in rows if i is not None and v and None not in v
          and np.all(np.isfinite(v)) and any(v)]
    out = []
    for q in asked:
        for i, v in {(i, tuple(v)) for i, v in ok if i == q}:
            hits = sorted((-float(np.dot(np.array(v, float), np.array(w, float))), j)
                          for j, w in ok if j != q and len(w) == len(v))[:k]
            out += [(q, r + 1, j, -s) for r, (s, j) in enumerate(hits)]
    return sorted(out)


def test_neighbours_of_the_table(spark, tables):
    rows = [(r.vec_id, r.embedding) for r in tables("embeddings").collect()]
    got = sorted(map(tuple, catalog.op9_neighbours(spark, SF).collect()))
    want = nearest(rows, [i for i, _ in rows if i % 20 == 0], 20)
    assert [r[:3] for r in got] == [r[:3] for r in want]
    assert [r[3] for r in got] == pytest.approx([r[3] for r in want], rel=1e-12)


def test_odd_vectors(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "CANDIDATE_ROWS", 7)
    monkeypatch.setattr(neighbours, "QUERY_ROWS", 3)
    monkeypatch.setattr(neighbours, "BLOCKS_PER_GROUP", 2)
    rng = np.random.default_rng(2)
    nan, inf = float("nan"), float("inf")
    rows = [(k, [float(x) for x in rng.integers(-3, 4, 4)]) for k in range(60)]
    rows += [(100, None), (101, []), (102, [0.0] * 4), (103, [1.0, nan, 1.0, 1.0]), (104, [1.0, inf, 0.0, 0.0]),
             (105, [1.0, None, 1.0, 1.0]), (None, [9.0] * 4), (106, [1.0, 2.0]), (107, [2.0, 2.0]), (5, rows[5][1])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("block", F.lit(1))
    queries = df.where("vec_id % 5 = 0 or vec_id > 100")
    got = sorted(map(tuple, neighbours.nearest(df, queries, k=6).collect()))
    asked = sorted({i for i, _ in rows if i is not None and (i % 5 == 0 or i > 100)})
    assert got == nearest(rows, asked, 6)
    assert neighbours.nearest(df.where("1 = 0"), queries).count() == 0
    assert neighbours.nearest(df, queries.where("1 = 0")).count() == 0


def test_bounds_hold():
    rng = np.random.default_rng(4)
    for scale in (1e-20, 1.0, 1e20):
        a, b = rng.normal(size=(40, 33)) * scale, rng.normal(size=(50, 33)) * scale
        low, high = neighbours.tile_bounds(neighbours._Quantised(a), neighbours._Quantised(b))
        assert (low <= a @ b.T).all() and (a @ b.T <= high).all()
