import hashlib
import io
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from kiln.llm import catalog, hilbert, idfiles, rangecoder, storage, warc

from .conftest import ODD_ROWS, SF
from .test_llm_packing import ids_of

# ---- range coder and files of ids --------------------------------------------------


@pytest.mark.parametrize("n", [1, 2, 3, 63, 64, 65, 127, 128, 129, 1000, 70_001])
@pytest.mark.parametrize("vocab", [1, 2, 300, 49_408])
def test_blocks_round_trip(n, vocab):
    rng = np.random.default_rng(n)
    for ids in (rng.integers(0, vocab, n), np.minimum(rng.geometric(0.1, n), vocab) - 1,
                np.full(n, vocab - 1), np.arange(n) % vocab):
        block = rangecoder.encode_block(ids, vocab)
        assert (rangecoder.decode_block(block) == ids).all()
        assert rangecoder.block_size(block[:rangecoder.HEAD_BYTES]) == (len(block), n)


def test_predictable_ids_take_little_room():
    rng = np.random.default_rng(0)
    phrase = rng.integers(0, 49_408, 50)
    assert len(rangecoder.encode_block(np.tile(phrase, 20_000), 49_408)) < 1_000_000 * 0.2
    skewed = np.minimum(rng.geometric(0.05, 200_000), 49_000)
    p = np.bincount(skewed)[1:] / 200_000
    entropy = -(p[p > 0] * np.log2(p[p > 0])).sum()
    assert 8 * len(rangecoder.encode_block(skewed, 49_408)) / 200_000 < entropy + 0.6


def test_damage_is_found():
    block = bytearray(rangecoder.encode_block(np.arange(500) % 7, 10))
    for at in (5, len(block) // 2, len(block) - 1):
        bad = bytearray(block)
        bad[at] ^= 1
        with pytest.raises(ValueError):
            rangecoder.decode_block(bytes(bad))
    with pytest.raises(ValueError):
        rangecoder.decode_block(bytes(block[:-3]))
    with pytest.raises(ValueError):
        rangecoder.encode_block(np.array([10]), 10)


def test_documents_across_blocks():
    sink = io.BytesIO()
    docs = [(5, 3), (None, 0), (5, 10), (-1, 1), (9, 25), (10, 0), (11, 7)]
    rng = np.random.default_rng(1)
    ids = [rng.integers(0, 50, n).astype(np.int32) for _, n in docs]
    writer = idfiles.IdFileWriter(sink, 50, block_ids=8)
    for (d, _), x in zip(docs, ids):
        writer.add(d, x)
    n_docs, n_ids, size = writer.close()
    assert (n_docs, n_ids, size) == (7, 46, len(sink.getvalue()))
    at = 0
    for (doc, start, got), (d, n), x in zip(idfiles.read_id_file(sink, size), docs, ids, strict=True):
        assert (doc, start) == (d, at) and (got == x).all()
        at += n


def test_table_through_files(spark, tables):
    got = sorted(map(tuple, catalog.op5_id_files(spark, SF).select(
        "doc_id", "start", "n_tokens", "ids_crc32").collect()))
    rows = sorted((r.doc_id, r.text) for r in tables("documents").collect())
    want, at = [], 0
    for (d, _), x in zip(rows, ids_of([t for _, t in rows], idfiles.TOKENIZER, 2)):
        want.append((d, at, len(x), zlib.crc32(x.tobytes())))
        at += len(x)
    assert got == want


def test_odd_rows_through_files(odd_docs, no_docs):
    got = idfiles.through_files(odd_docs).orderBy("start").collect()
    rows = sorted(ODD_ROWS, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    want = ids_of([t for _, t in rows], idfiles.TOKENIZER, 2)
    assert [(r.doc_id, bytes(r.ids)) for r in got] == [(d, x.tobytes()) for (d, _), x in zip(rows, want)]
    assert [r.start for r in got] == np.cumsum([0] + [len(x) for x in want])[:-1].tolist()
    assert idfiles.through_files(no_docs).count() == 0


# ---- WARC ----------------------------------------------------------------------------

LONG = "<p>" + "x y " * 40 + "é</p>"
PAGES = [(1, "http://a/1", LONG), (2, "http://a/2", "short"), (3, None, "short"), (4, "u\r\nX: 1", LONG),
         (5, "http://a/5", None), (6, "http://a/6", ""), (-2, "http://a/-2", LONG), (7, "u", "a\r\n\r\nWARC/1.1\r\n" * 30),
         (8, "u", "a\r\n\r\nWARC/1.1\r\n" * 30), (None, "n", LONG), (9, "u", "z" * 99), (10, "u", "z" * 99),
         (11, "u", "z" * 100), (12, "u", "z" * 100), (11, "u", "z" * 100), (13, "u", "q" * 400_000)]


def records(rows):
    first = {}
    for i, _, h in rows:
        if i is not None and len((h or "").encode()) >= 100:
            first[h] = min(i, first.get(h, i))
    out = []
    for i, _, h in rows:
        data = (h or "").encode()
        to = first.get(h)
        revisit = to is not None and to != i
        out.append((i, len(data), hashlib.sha256(data).hexdigest(), "revisit" if revisit else "response",
                    to if revisit else None))
    return Counter(out)


def test_archives_of_odd_pages(spark):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string") \
        .withColumn("digest", F.lit("d")).withColumn("k", F.lit(1))
    got = warc.through_archives(pages)
    assert Counter(map(tuple, got.select("page_id", "payload_bytes", "payload_digest", "record_type",
                                         "refers_to").collect())) == records(PAGES)
    assert warc.through_archives(pages.where("1 = 0")).count() == 0


def test_archives_of_the_table(spark, tables):
    rows = [(r.page_id, r.url, r.html) for r in tables("pages").collect()]
    assert Counter(map(tuple, catalog.op7_warc(spark, SF).collect())) == records(rows)


def test_predicates_are_pushed_and_payloads_kept(spark):
    folder = storage.shared_folder(spark, "warc-test")
    warc.write_warc(spark.createDataFrame(PAGES, "page_id long, url string, html string"), folder)
    back = warc.read_warc(spark, folder)
    some = back.where("record_type = 'response' and page_id >= 2 and page_id < 9 and target_uri is not null")
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"\bFilter\b", plan)
    want = {i: h or "" for i, u, h in PAGES if i in (2, 5, 6, 7)}
    assert {r.page_id: bytes(r.payload).decode() for r in some.collect()} == want
    assert {r.page_id for r in back.where("page_id in (2, 4, 77)").collect()} == {2, 4}
    assert {r.page_id for r in back.where("length(payload) = 5").collect()} == {2, 3}
    assert back.where("record_type = 'revisit'").where("payload is not null").count() == 0
    heads = warc.read_warc(spark, folder, payloads=False)
    assert heads.count() == len(PAGES) and heads.where("payload is not null").count() == 0


class Counting(io.BytesIO):
    def __init__(self, data):
        super().__init__(data)
        self.taken = 0

    def read(self, n=-1):
        out = super().read(n)
        self.taken += len(out)
        return out


@pytest.mark.parametrize("members", ["own", "one", "plain"])
def test_unwanted_payloads_are_passed_over(members, monkeypatch):
    """Files of this writer, files of one gzip member per record, and plain files."""
    rng = np.random.default_rng(0)
    bodies = [rng.bytes(int(n)).hex().encode() for n in rng.integers(0, 300_000, 12)]
    data = b""
    for k, body in enumerate(bodies):
        own = warc.record(k, "u", body, "d", None, "1970-01-01T00:00:00Z")
        if members != "own":
            raw = zlib.decompress(own, 31)
            tail = zlib.decompressobj(31)
            tail.decompress(own)
            raw += zlib.decompress(tail.unused_data, 31)
            raw = raw.replace(warc._SKIP.encode(), b"X-Other")
            own = warc._gzip(raw) if members == "one" else raw
        data += own
    monkeypatch.setattr(warc, "_READ", 1000)
    source = Counting(data)
    got = list(warc.records(source, lambda row: row["page_id"] in (3, 11)))
    assert [(r["page_id"], r["payload"]) for r in got] == [(k, bodies[k]) for k in (3, 11)]
    if members != "one":
        assert source.taken < len(data) / 2
    assert [r["page_id"] for r in warc.records(io.BytesIO(data), payloads=False)] == list(range(12))
    with pytest.raises((ValueError, zlib.error)):
        list(warc.records(io.BytesIO(data[:-50])))


# ---- Hilbert shards --------------------------------------------------------------------

@pytest.mark.parametrize("dims,bits", [(2, 4), (3, 3), (4, 2)])
def test_curve_visits_every_cell_stepwise(dims, bits):
    cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims), axis=-1).reshape(-1, dims)
    index = hilbert.hilbert_index(cells, bits)
    assert sorted(index) == list(range(len(cells)))
    path = cells[np.argsort(index)]
    assert (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()


def check_shards(rows, texts, shards=24):
    sizes = Counter(r.shard for r in rows)
    assert max(sizes.values()) - min([sizes.get(s, 0) for s in range(shards)]) <= 1
    for s in sizes:
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(sizes[s]))
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in rows) == Counter(
        (d, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for d, t in texts)
    assert {(r.law, r.grown_shard) for r in rows} == {("rows", None)}


def test_shards_of_the_table(spark, tables):
    rows = catalog.op8_hilbert(spark, SF).collect()
    check_shards(rows, [(r.doc_id, r.text) for r in tables("documents").collect()])


def test_shards_of_odd_rows(odd_docs, no_docs):
    rows = hilbert.shard_documents(odd_docs, shards=3).collect()
    check_shards(rows, ODD_ROWS, 3)
    # more shards than rows
    assert len(hilbert.shard_documents(odd_docs.where("doc_id in (1, 2)")).collect()) == 2
    assert hilbert.shard_documents(no_docs).count() == 0


def test_files_hold_all_columns_and_small_boxes(spark, tables):
    docs = tables("documents")
    path = storage.shared_folder(spark, "shards-test")
    hilbert.write_shards(docs, path, shards=8)
    back = hilbert.read_shards(docs, path)
    assert Counter(map(tuple, back.select(docs.columns).collect())) == Counter(map(tuple, docs.collect()))
    spread = back.groupBy("__shard").agg(F.countDistinct("lang").alias("n"),
                                         F.countDistinct("source").alias("m")).collect()
    assert sum(r.n for r in spread) / len(spread) < 4
    assert sum(r.m for r in spread) / len(spread) < docs.select("source").distinct().count()


def test_cuts_are_of_all_rows(spark):
    """Rare values of a table with more rows than a sample would have, and many values."""
    rare = [(20_000 * j + 7 * k, f"rare{k:02}") for k in range(40) for j in range(3)]
    ids = {i for i, _ in rare}
    rows = rare + [(i, "common" if i % 2 else "usual") for i in range(60_000) if i not in ids]
    docs = spark.createDataFrame(rows, "doc_id long, source string").selectExpr(
        "*", "'en' AS lang", "'t' AS text", "int(pow(doc_id % 1000, 2)) AS n_chars").repartition(5)
    assert hilbert.cut_values(docs, "source", 8) == sorted({s for _, s in rows})
    seen = sorted((i % 1000) ** 2 for i, _ in rows)
    assert hilbert.cut_values(docs, "n_chars", 8) == sorted({seen[len(seen) * k // 254] for k in range(254)})
    path = storage.shared_folder(spark, "shards-rare-test")
    hilbert.write_shards(docs, path, dimensions=("source", "lang"), shards=4)
    order = [r.source for r in hilbert.read_shards(docs, path).orderBy("__shard", "__slot").collect()]
    assert len(order) == 60_000 and 1 + sum(a != b for a, b in zip(order, order[1:])) == 42


def test_equal_rows_are_divided(spark):
    """Shards start among rows equal in id and text, which may differ in another column."""
    rows = [(None if k % 3 else k, "same text" if k % 3 else f"text {k % 50}", k % 4) for k in range(600)]
    rows += [(7, "seven", 0)] * 200
    docs = spark.createDataFrame(rows, "doc_id long, text string, other int").selectExpr(
        "*", "'s' AS source", "'en' AS lang", "length(text) AS n_chars").repartition(5)
    check_shards(hilbert.shard_documents(docs, shards=7, runs_per_shard=3).collect(),
                 [(i, t) for i, t, _ in rows], 7)
    path = storage.shared_folder(spark, "shards-equal-test")
    hilbert.write_shards(docs, path, shards=7)
    assert Counter(map(tuple, hilbert.read_shards(docs, path).select("doc_id", "text", "other").collect())
                   ) == Counter(rows)


def test_order_is_the_plain_sort(spark, tables):
    docs = tables("documents").select("doc_id", "text", *hilbert.DIMENSIONS)
    cuts = [sorted({r[0] for r in docs.select(c).distinct().collect() if r[0] is not None})
            for c in ("source", "lang")] + [hilbert.cut_values(docs, "n_chars", hilbert.BITS)]
    rows = docs.collect()
    cells = np.array([[0 if r[c] is None else 1 + sum(v <= r[c] for v in values)
                       for c, values in zip(hilbert.DIMENSIONS, cuts)] for r in rows])
    index = hilbert.hilbert_index(cells, hilbert.BITS)
    want = [r.doc_id for _, r in sorted(zip(index.tolist(), rows), key=lambda x: (x[0], x[1].doc_id))]
    got = [r.doc_id for r in catalog.op8_hilbert(spark, SF).orderBy("shard", "slot").collect()]
    assert got == want


def test_files_are_equal_in_bytes(spark, monkeypatch):
    """A third of the rows, in one stretch of the order, hold nearly all bytes."""
    rows = [(k, ("long text " * 200) if k < 300 else "short", "a" if k < 300 else "b") for k in range(900)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").selectExpr(
        "*", "'en' AS lang", "length(text) AS n_chars").repartition(4)
    monkeypatch.setattr(hilbert, "RUN_BYTES", 40_000)
    path = storage.shared_folder(spark, "shards-bytes-test")
    hilbert.write_shards(docs, path, shards=6)
    back = hilbert.read_shards(docs, path)
    size = F.octet_length("text") + hilbert.ROW_BYTES
    files = [r.bytes for r in back.groupBy(F.input_file_name()).agg(F.sum(size).alias("bytes")).collect()]
    assert sum(files) == sum(len(t) + 8 for _, t, _ in rows) and max(files) <= 40_000 + 2008
    counts = Counter(r["__shard"] for r in back.select("__shard").collect())
    assert sorted(counts.values()) == [150] * 6
    for shard in range(6):
        slots = [r["__slot"] for r in back.where(F.col("__shard") == shard).select("__slot").collect()]
        assert sorted(slots) == list(range(150))
