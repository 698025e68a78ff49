"""MaxScore against a plain inner product over all pairs."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from kiln.llm import maxscore as ms


def brute(rows, queries, k):
    """Rows are (id, {term: weight})."""
    out, seen = [], set()
    for q, qw in queries:
        key = (q, tuple(sorted(qw.items())))
        if key in seen:
            continue
        seen.add(key)
        scored = sorted((-sum(w * cw.get(t, 0) for t, w in qw.items()), c) for c, cw in rows if c != q)
        out += [(q, r + 1, c, -s) for r, (s, c) in enumerate(scored[:k])]
    return sorted(out)


def frame(spark, rows):
    return spark.createDataFrame([(i, sorted(w), [w[t] for t in sorted(w)], "x") for i, w in rows],
                                 "id long, terms array<int>, weights array<long>, copies string").repartition(3)


@pytest.mark.parametrize("seed,density,low", [(1, 0.1, 0), (2, 0.5, -40), (3, 1.0, -40), (4, 0.03, -3)])
def test_search_equals_all_pairs(spark, monkeypatch, seed, density, low):
    monkeypatch.setattr(ms, "SHARD_POSTINGS", 700)
    monkeypatch.setattr(ms, "QUERY_POSTINGS", 200)
    rng = np.random.default_rng(seed)

    def vector():
        return {int(t): int(w) for t in np.nonzero(rng.random(40) < density)[0]
                if (w := rng.integers(low, 41)) != 0}

    rows = [(int(i), vector()) for i in rng.permutation(400) - 100]
    rows += rows[:30] + [rows[0]] * 20 + [(1000 + i, rows[5][1]) for i in range(15)] + [(5, vector())]
    queries = [r for r in rows if r[0] % 20 == 0] + [(5000, {}), (5001, {999: 3}), (5002, vector())]
    found = ms.search(frame(spark, rows), frame(spark, queries), k=7)
    assert sorted(map(tuple, found.collect())) == brute(rows, queries, 7)


def test_quantised_rows(spark):
    nan, inf = float("nan"), float("inf")
    vectors = [(0, [0.5, -0.25, 1e-9]), (20, [1.0, 1.0, 1.0]), (1, [0.0, 0.0, 0.0]), (2, None), (3, [nan, 1.0, 1.0]),
               (4, [inf, 0.0, 0.0]), (5, [None, 1.0, 1.0]), (6, [-0.0005, 0.0, 0.0]), (None, [1.0, 1.0, 1.0]), (7, []),
               (8, [1e300, 0.0, 0.0]), (9, [0.5, -0.25, 1e-9]), (9, [0.5, -0.25, 1e-9]), (10, [1.0])]
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<double>").withColumn("id", F.lit(1))
    q = ms.quantised(df)
    kept = {r["id"]: dict(zip(r["terms"], r["weights"])) for r in q.collect()}
    assert kept == {0: {0: 512, 1: -256}, 20: {0: 1024, 1: 1024, 2: 1024}, 1: {}, 6: {0: -1}, 7: {},
                    9: {0: 512, 1: -256}, 10: {0: 1024}}
    found = sorted(map(tuple, ms.search(q, q.where("id % 20 = 0")).collect()))
    rows = [(r["id"], dict(zip(r["terms"], r["weights"]))) for r in q.collect()]
    assert found == brute(rows, [r for r in rows if r[0] % 20 == 0], 10)
    assert [r[2:] for r in found if r[0] == 0][:3] == [(10, 524288), (9, 327680), (9, 327680)]
    assert ms.search(q.limit(0), q).count() == ms.search(q, q.limit(0)).count() == 0


def test_unnecessary_postings_are_not_met(spark):
    rng = np.random.default_rng(5)
    # one strong term that few documents have, and many weak ones that all have
    rows = [(i, {**({0: 900} if i % 97 == 0 else {}), **{t: int(rng.integers(1, 5)) for t in range(1, 30)}})
            for i in range(2000)]
    table = frame(spark, rows).withColumn("copies", F.lit(1).cast("long")).withColumn("part", F.lit(0))
    shard = ms.Shard(ms.build_shard(table.toArrow()).to_pylist()[0])
    terms, weights = np.arange(30), np.ones(30, np.int64)
    docs, scores, all_met = shard.search(terms, weights, None)
    assert len(docs) == 2000
    kth = int(np.sort(scores)[-10])
    docs, scores, met = shard.search(terms, weights, kth)
    assert met < all_met / 20 and sorted(scores.tolist())[-10] == kth
