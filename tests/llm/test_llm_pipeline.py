"""The pipeline, stage by stage, against brute-force versions."""

import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F
from xxhash import xxh32_intdigest

import corpus_pipeline as cp
from kiln.llm import toxicity

from .conftest import SF
from .test_llm_dedup import cut, fingerprint, linked
from .test_llm_packing import check
from .test_llm_scoring import leaks


def noisy_or(text, model):
    weights = dict(zip(model.features.tolist(), model.weights.tolist()))
    clean = 1.0
    for line in (text or "").lower().split("\n"):
        words = line.encode().split()
        words = [w.decode() for w in words]
        sentence = []
        for k, w in enumerate(words):
            sentence.append(w.strip(toxicity._MARKS))
            if re.search(r"[.!?]$", w) or k == len(words) - 1:
                found = {xxh32_intdigest(x) for x in sentence}
                found |= {xxh32_intdigest("^" + x[:n]) for x in sentence for n in toxicity.PREFIXES if len(x) >= n}
                z = model.bias + sum(weights.get(h, 0.0) for h in found)
                clean *= 1 - 1 / (1 + np.exp(-min(max(z, -40), 40)))
                sentence = []
    return 1 - clean


@pytest.fixture(scope="module")
def stages(spark, tables, tmp_path_factory):
    """Rows that go into and come out of each stage."""
    docs, out = tables("documents"), []
    for name, stage in cp.STAGES:
        path = str(tmp_path_factory.mktemp("stages") / name)
        stage(spark, docs, SF).write.parquet(path)
        after = spark.read.parquet(path)
        out.append((name, docs, after))
        docs = after
    return out


def rows(df):
    return sorted((r.doc_id, r.text) for r in df.collect())


def test_stages_are_the_listed_ones(stages, tables):
    assert [n for n, _ in cp.STAGES] == ["toxicity", "near_duplicates", "substrings", "decontamination", "packing"]
    for _, before, after in stages[:-1]:
        assert after.schema.names == before.schema.names == tables("documents").columns
        assert after.schema.simpleString() == before.schema.simpleString()


def test_toxicity(spark, stages, tables):
    _, before, after = stages[0]
    model = toxicity.train(before, tables("labels"))
    assert rows(after) == [(i, t) for i, t in rows(before) if noisy_or(t, model) < 0.5]


def test_near_duplicates(stages):
    _, before, after = stages[1]
    ids, texts = zip(*rows(before))
    group = linked(list(ids), [fingerprint(t) for t in texts])
    assert rows(after) == [(i, t) for i, t, g in zip(ids, texts, group) if i == g]


def test_substrings(stages):
    _, before, after = stages[2]
    texts = dict(rows(before))
    want = [(i, k if m else texts[i]) for i, _, m, k in cut(rows(before))]
    assert rows(after) == want
    assert all(r.n_chars == len(r.text) for r in after.collect())


def test_decontamination(stages, tables):
    _, before, after = stages[3]
    items = [(r.item_id, r.text) for r in tables("benchmark").collect()]
    bad = {i for i, _ in leaks(rows(before), items)}
    assert rows(after) == [(i, t) for i, t in rows(before) if i not in bad]


def test_packing(stages):
    _, before, after = stages[4]
    check(after.collect(), rows(before))


def test_run_gives_the_last_stage(spark, stages):
    got = cp.run(spark, SF)
    assert Counter(r.doc_id for r in got.collect()) and got.columns == stages[4][2].columns
    per_doc = got.groupBy("doc_id").agg(F.sum("length").alias("n"), F.max("doc_tokens").alias("m"))
    assert per_doc.where("n <> m").count() == 0
    assert {r.doc_id for r in per_doc.collect()} == {i for i, _ in rows(stages[4][1])}


@pytest.mark.parametrize("k", range(5))
def test_odd_rows_and_no_rows(spark, odd_docs, no_docs, k):
    """Nulls, empty, long and repeated texts and further columns pass every stage."""
    name, stage = cp.STAGES[k]
    got = stage(spark, odd_docs, SF)
    if name != "packing":
        assert got.columns == odd_docs.columns
        kept = Counter(r.doc_id for r in got.collect())
        assert not kept - Counter(r.doc_id for r in odd_docs.collect())
        assert kept[None] == 2          # rows without id are never dropped
        if name == "near_duplicates":
            assert kept[1] == 1 and kept[8] == kept[9] == 0 and kept[3] == 1 and kept[4] == 0
    assert stage(spark, no_docs, SF).count() == 0


@pytest.mark.parametrize("k", range(4))
def test_columns_named_like_those_of_the_operators(spark, k):
    docs = spark.createDataFrame([(1, "a b c d e f"), (2, "a b c d e f"), (3, None)], "doc_id long, text string")
    names = ["kept_text", "n_removed", "n_words", "__text", "__n", "digest", "n", "score", "__score", "rest_0", "__c0"]
    docs = docs.select("*", *(F.lit(f"own {c}").alias(c) for c in names))
    got = cp.STAGES[k][1](spark, docs, SF)
    assert got.columns == docs.columns
    assert all(r[c] == f"own {c}" for r in got.collect() for c in names)
    assert {r.doc_id for r in got.collect()} == ({1, 3} if k == 1 else {1, 2, 3})
