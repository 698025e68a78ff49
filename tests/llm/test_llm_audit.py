"""The filter audit against a plain count over rows, orders and steps."""

import re
from itertools import permutations

import pytest
from pyspark.sql import functions as F

from kiln.llm import filter_audit as fa


def failures(rows):
    """(doc_id, part, mask) of (doc_id, text, lang) rows, by the five definitions."""
    first = {}
    for i, t, _ in rows:
        if i is not None:
            first[t or ""] = min(i, first.get(t or "", i))
    out = []
    for i, t, lang in rows:
        t = t or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        out.append((i, lang or "", (
            len(w) < 100, 100 * len(set(w)) < 80 * len(w),
            100 * len(re.findall("[A-Z]", t)) > 10 * len(t), bool(re.search(r"[#$%&*|]", t)),
            i is not None and t in first and first[t] < i)))
    return out


def audit(failed, good, toxic):
    res = {}
    for part in {p for _, p, _ in failed}:
        mine = [(f, good(i), toxic(i)) for i, p, f in failed if p == part]
        total = dict.fromkeys("ABCDE", 0)
        for order in permutations(range(5)):
            left = mine
            for step, k in enumerate(order):
                name = "ABCDE"[k]
                gone = [r for r in left if r[0][k]]
                left = [r for r in left if not r[0][k]]
                total[name] += len(gone)
                res[part, "".join("ABCDE"[x] for x in order), step + 1] = [
                    len(left), len(gone), sum(r[0][k] for r in mine) - len(gone),
                    sum(r[0][k] and sum(r[0]) == 1 for r in mine),
                    sum(r[1] for r in gone), sum(r[2] for r in gone), name]
        for key, row in res.items():
            if key[0] == part:
                row[6] = total[row[6]]
    return {k: tuple(v) for k, v in res.items()}


LONG = " ".join(f"w{k}" for k in range(120))
ROWS = [
    (1, LONG, "en"), (2, LONG, "de"), (3, LONG, None), (3, LONG, "en"), (2, LONG, "de"), (None, LONG, "en"),
    (None, LONG, "en"), (None, None, None), (4, "", ""), (5, None, "en"), (6, "A B C a #", "en"),
    (7, "WORD " * 150, "en"), (8, "x\x0by\x0cz\x1cq\xa0r", "fr"), (9, "ÄÖÜ AB" + "c" * 14, "fr"),
    (10, "\t\n \r", "fr"), (11, "word " * 30_000, "fr"), (12, " " + LONG + "\n", "en"), (-5, "", "de"),
    (13, "50% off | now", "zz"), (14, ("ab " * 79 + "cd ") * 2, "zz"),
    (15, " ".join(f"u{k % 80}" for k in range(100)), "zz"), (16, " ".join(f"u{k % 79}" for k in range(100)), "zz")]
LABELS = [(1, 1, 0), (2, 1, 1), (2, 0, None), (3, None, 1), (6, 1, 1), (None, 1, 1), (7, 0, 1), (99, 1, 1), (13, 2, 1)]


def got(spark, rows, labels):
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").select(
        "*", *(F.lit(7).alias(c) for c in ("part", "n", "A", "good", "digest", "steps", "mask")))
    labels = spark.createDataFrame(labels, "doc_id long, quality int, toxic int").withColumn("n", F.lit(9))
    found = fa.interactions(fa.with_labels(fa.text_failures(docs), labels), "ABCDE", n="n", weights=["good", "toxic"])
    return {tuple(r)[:3]: tuple(r)[3:] for r in found.collect()}, found.count()


def test_audit_equals_a_plain_count(spark):
    found, n = got(spark, ROWS, LABELS)
    good = {i for i, q, _ in LABELS if i is not None and q == 1}
    toxic = {i for i, _, t in LABELS if i is not None and t == 1}
    want = audit(failures(ROWS), lambda i: i in good, lambda i: i in toxic)
    assert n == len(found) == len(want) == 600 * len({r[2] or "" for r in ROWS})
    assert found == want


def test_empty_tables(spark):
    assert got(spark, [], LABELS) == ({}, 0)
    found, n = got(spark, [(1, "a", "en")], [])
    assert n == 600 and all(v[4] == v[5] == 0 for v in found.values())


def test_general_filters_and_null_flags(spark):
    rows = spark.createDataFrame([("p", True, None), ("p", True, True), (None, False, True)],
                                 "part string, long boolean, odd boolean")
    found = {tuple(r)[:3]: tuple(r)[3:] for r in fa.interactions(rows, ["long", "odd"]).collect()}
    assert found["p", "longodd", 1] == (0, 2, 0, 1, 3)
    assert found["p", "oddlong", 2] == (0, 1, 1, 1, 3)
    assert found[None, "oddlong", 1] == (0, 1, 0, 1, 2)
    with pytest.raises(ValueError):
        fa.interactions(rows, "abcdefg")
