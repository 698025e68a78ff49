"""Toxicity by multiple-instance learning: documents are labelled, sentences are scored.

A sentence with the known features ``W`` (its words and the beginnings of its words, each
once) has probability ``sigmoid(b + sum of w[i], i in W)``;
a document is toxic unless none of its sentences is (noisy-or):
``1 - product of (1 - p)``.  Weights are fitted to the labels of documents by full-batch
gradient steps, so that the sentences that explain a label get its weight.  The scored
sentences then say where a document offends.

Fitting reads a bounded sample of labelled documents (``TRAIN_DOCS`` and ``TRAIN_BYTES``,
the smallest id hashes); scoring is one pass over all documents without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F, types as T

from kiln.session import checkpoint_dir

from .words import slices

#: labelled documents that the model is fitted to at most
TRAIN_DOCS = 8_000
#: bytes of their texts at most (the features of a byte take about two)
TRAIN_BYTES = 24 << 20
#: documents of the sample in which a feature has to stand to get a weight
MIN_DOCS = 3
#: letters of the beginnings of words that are features
PREFIXES = (4, 5, 6)
STEPS = 200
LEARNING_RATE = 0.1
#: weight of the sum of the weights' absolute values in the loss
L1 = 1e-4
#: a fit ends when the losses of its last ``SPAN`` steps lie within this part of each other
TOLERANCE = 1e-2
SPAN = 10
#: features of the sample that a step weighs at a time
CHUNK = 1 << 20
#: a sentence of this score or more is reported
OFFENDING = 0.5

_MARKS = ".,;:!?\"'()[]{}<>"


@dataclass(frozen=True)
class Model:
    """``features``: ascending hashes; ``weights``: theirs; ``bias``: of a sentence."""
    features: np.ndarray
    weights: np.ndarray
    bias: float


class _Sentences:
    """Words of a batch of texts with the sentence and the text of each."""

    def __init__(self, texts: pa.Array):
        from xxhash import xxh32_intdigest
        texts = pc.fill_null(texts, "")
        lines = pc.split_pattern(pc.utf8_lower(texts), "\n")
        line_doc = np.repeat(np.arange(len(texts)),
                             lines.value_lengths().to_numpy(zero_copy_only=False))
        parts = pc.ascii_split_whitespace(lines.flatten())
        n = parts.value_lengths().to_numpy(zero_copy_only=False)
        words = parts.flatten()
        full = pc.greater(pc.binary_length(words), 0).to_numpy(zero_copy_only=False)
        line = np.repeat(np.arange(len(n)), n)[full]
        words = words.filter(pa.array(full))
        ends = pc.match_substring_regex(words, r"[.!?]$").to_numpy(zero_copy_only=False)
        self.doc = line_doc[line]
        new = np.ones(len(words), bool)
        if len(words):
            new[1:] = ends[:-1] | (line[1:] != line[:-1])
        self.sentence = np.cumsum(new) - 1
        self.first = np.nonzero(new)[0]             # first word of each sentence
        self.sentence_doc = self.doc[self.first]
        counts = np.bincount(self.doc, minlength=len(texts)) if len(words) else np.zeros(len(texts), int)
        self.doc_start = np.cumsum(counts) - counts  # first word of each text
        self.n_words = np.diff(np.append(self.first, len(words)))
        enc = pc.utf8_trim(words, characters=_MARKS).dictionary_encode()
        if isinstance(enc, pa.ChunkedArray):
            enc = enc.combine_chunks()
        self.word = enc.indices.to_numpy(zero_copy_only=False)
        #: hashes of the features of each distinct word; 0: none
        self.hashes = np.array(
            [[xxh32_intdigest(w), *(xxh32_intdigest("^" + w[:n]) if len(w) >= n else 0 for n in PREFIXES)]
             for w in enc.dictionary.to_pylist()], dtype=np.uint32).reshape(-1, 1 + len(PREFIXES))

    def features(self, known: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(sentence, hash) of all features, or (sentence, place in ``known``) of those
        among ``known``; each pair once, ascending."""
        if known is None:
            word = self.hashes.astype(np.int64)
            ok, size = word != 0, np.int64(1) << 32
        elif len(known):
            word = np.searchsorted(known, self.hashes).clip(max=len(known) - 1)
            ok, size = (known[word] == self.hashes) & (self.hashes != 0), np.int64(len(known))
        else:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        has = ok.any(axis=1)[self.word]
        sentence, at = self.sentence[has], self.word[has]
        pairs = (sentence[:, None] * size + word[at])[ok[at]]
        return np.divmod(np.unique(pairs), size)

    def scores(self, model: Model) -> np.ndarray:
        """Probability of each sentence."""
        sentence, feature = self.features(model.features)
        z = model.bias + np.bincount(sentence, weights=model.weights[feature],
                                     minlength=len(self.first))
        return 1 / (1 + np.exp(-z.clip(-40, 40)))


def _sums(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Sums of consecutive runs of ``values``; an empty run has 0."""
    out = np.zeros(len(sizes))
    full = np.nonzero(sizes)[0]
    if len(full):
        out[full] = np.add.reduceat(values, (np.cumsum(sizes) - sizes)[full])
    return out


def _chunks(sizes: np.ndarray) -> list[tuple[int, int, int, int]]:
    """Runs of sentences with about ``CHUNK`` features: first and end sentence, first and end
    feature."""
    ends = np.cumsum(sizes)
    cuts = np.unique(np.concatenate([[0, len(sizes)], np.nonzero(np.diff(ends // CHUNK))[0] + 1])).tolist()
    place = np.concatenate([[0], ends])
    return [(lo, hi, int(place[lo]), int(place[hi])) for lo, hi in zip(cuts, cuts[1:])]


def fit(labels: np.ndarray, docs: list[tuple[np.ndarray, np.ndarray]], min_docs: int = MIN_DOCS,
        steps: int = STEPS, rate: float = LEARNING_RATE, l1: float = L1,
        tolerance: float = TOLERANCE) -> Model:
    """Fit to documents given as (number of features of each sentence, their hashes).
    Without both labels the model scores all sentences alike, near 0 or near 1.

    Steps end when the losses of the last ``SPAN`` lie within ``tolerance`` of each other,
    after ``steps`` at the latest.  Beside the features themselves (4 bytes each) a step
    needs memory for ``CHUNK`` of them, one number a sentence and a few a weight."""
    y = np.asarray(labels, dtype=np.float64)
    if not len(y) or y.min() == y.max():
        return Model(np.zeros(0, np.uint32), np.zeros(0), 20.0 if len(y) and y[0] else -20.0)
    every, df = np.unique(np.concatenate([np.unique(h) for _, h in docs]), return_counts=True)
    known = every[df >= min_docs]
    del every, df
    n_sent = np.array([len(s) for s, _ in docs])
    total = int(n_sent.sum())
    sentence_doc = np.repeat(np.arange(len(docs)), n_sent)
    parts, sizes = [], []               # known features by sentence, and their numbers
    for s, h in docs:
        at = np.searchsorted(known, h).clip(max=max(len(known) - 1, 0))
        ok = known[at] == h if len(known) else np.zeros(len(h), bool)
        parts.append(at[ok].astype(np.int32))
        sizes.append(np.bincount(np.repeat(np.arange(len(s)), s)[ok], minlength=len(s)))
    feature, sizes = np.concatenate(parts), np.concatenate(sizes)
    del parts
    chunks = _chunks(sizes)
    w, bias = np.zeros(len(known)), float(np.log(max(y.sum(), 1) / max(total, 1)))
    m, v = np.zeros(len(known) + 1), np.zeros(len(known) + 1)
    losses: list[float] = []
    z = np.zeros(total)
    for step in range(1, steps + 1):
        for lo, hi, first, end in chunks:
            z[lo:hi] = bias + _sums(w[feature[first:end]], sizes[lo:hi])
        p = 1 / (1 + np.exp(-z.clip(-40, 40)))
        # of a document: minus the logarithm of the probability that no sentence is toxic
        doubt = np.bincount(sentence_doc, weights=np.logaddexp(0, z), minlength=len(y))
        clean = np.exp(-doubt)
        toxic = np.maximum(1 - clean, 1e-12)
        losses.append(np.where(y == 1, -np.log(toxic), doubt).mean() + l1 * np.abs(w).sum())
        last = losses[-SPAN:]           # the first steps may raise the loss before it falls
        if step > SPAN and max(last) - min(last) < tolerance * max(last):
            break
        slope = p * np.where(y == 1, -clean / toxic, 1.0)[sentence_doc] / len(y)
        grad = np.zeros(len(known) + 1)
        for lo, hi, first, end in chunks:
            grad[:-1] += np.bincount(feature[first:end], minlength=len(known),
                                     weights=np.repeat(slope[lo:hi], sizes[lo:hi]))
        grad[-1] = slope.sum()
        # a weight moves only against more slope than its absolute value costs
        g = grad[:-1] + l1 * np.sign(w)
        rest = w == 0
        g[rest] = np.sign(grad[:-1][rest]) * np.maximum(np.abs(grad[:-1][rest]) - l1, 0)
        g = np.append(g, grad[-1])
        m = 0.9 * m + 0.1 * g
        v = 0.999 * v + 0.001 * g * g
        move = rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
        new = w - move[:-1]
        new[(w != 0) & (np.sign(new) != np.sign(w))] = 0
        w, bias = new, bias - move[-1]
    keep = w != 0
    return Model(known[keep], w[keep], float(bias))


def held_out(id_col: str):
    """The rows whose labels are never learned from."""
    return F.coalesce(F.pmod(F.crc32(F.col(id_col).cast("string")), F.lit(5)) == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "toxic", train_docs: int = TRAIN_DOCS,
          train_bytes: int = TRAIN_BYTES) -> Model:
    """Fit to at most ``train_docs`` labelled rows outside ``held_out`` with ``train_bytes``
    of text in all: those whose ids have the smallest hashes.  A text of over a 64th of
    ``train_bytes`` is passed over, a whole text or none is read.  Null ids and labels, and
    labels without a text, teach nothing; null and empty texts teach what no words say; rows
    equal in id, label and text teach once, an id of several texts or labels each of them.
    Without labels or texts the model finds nothing toxic."""
    checkpoint_dir(docs.sparkSession)
    sample = (labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("y"))
              .where(F.col("y").isin(0, 1) & F.col("id").isNotNull())
              .where(~held_out("id")).distinct()
              .orderBy(F.xxhash64("id"), "id", "y").limit(train_docs))
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    near = (texts.join(F.broadcast(sample), "id")               # train_docs rows
            .select("id", "y", "text", F.xxhash64("id").alias("h"), F.xxhash64("text").alias("t"),
                    F.coalesce(F.octet_length("text"), F.lit(0)).alias("n"))
            .where(F.col("n") <= train_bytes // 64).dropDuplicates(["id", "y", "text"]).checkpoint())
    first = near.select("h", "id", "y", "t", "n").orderBy("h", "id", "y", "t").limit(train_docs).toArrow()
    taken = int(np.searchsorted(np.cumsum(first.column("n").to_numpy(), dtype=np.int64), train_bytes, "right"))
    last = first.slice(taken - 1, 1).to_pylist()[0] if taken else None
    rows = near.select("id", "y", "text").where(
        F.struct("h", "id", "y", "t") <= F.struct(*(F.lit(last[c]).cast(near.schema[c].dataType)
                                                    for c in ("h", "id", "y", "t")))
        if last else F.lit(False))

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", 512):
                s = _Sentences(part.column("text"))
                sentence, feature = s.features()
                size = np.bincount(sentence, minlength=len(s.first)).astype(np.int32)
                n_sent = np.bincount(s.sentence_doc, minlength=part.num_rows)
                n_feat = np.bincount(s.sentence_doc[sentence], minlength=part.num_rows)
                cut = [np.concatenate([[0], np.cumsum(n)]).astype(np.int32) for n in (n_sent, n_feat)]
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), part.column("y"),
                     pa.ListArray.from_arrays(cut[0], pa.array(size)),
                     pa.ListArray.from_arrays(cut[1], pa.array(feature.astype(np.uint32).view(np.int32)))],
                    names=["id", "y", "sizes", "features"])

    got = rows.mapInArrow(words, T.StructType([
        rows.schema["id"], T.StructField("y", T.IntegerType()),
        T.StructField("sizes", T.ArrayType(T.IntegerType())),
        T.StructField("features", T.ArrayType(T.IntegerType()))])).toArrow()
    got = got.sort_by([("id", "ascending"), ("y", "ascending")])
    y = got.column("y").to_numpy()
    sizes, features = got.column("sizes"), got.column("features")
    parts = [(sizes[k].values.to_numpy(zero_copy_only=False),
              features[k].values.to_numpy(zero_copy_only=False).view(np.uint32))
             for k in range(got.num_rows)]
    del got, sizes, features
    return fit(y, parts)


def _locate(s: _Sentences, p: np.ndarray, n: int) -> pa.Array:
    """Per text, its sentences of score ``OFFENDING`` or more."""
    bad = np.nonzero(p >= OFFENDING)[0]
    doc = s.sentence_doc[bad]
    items = pa.StructArray.from_arrays(
        [pa.array((s.first[bad] - s.doc_start[doc]).astype(np.int32)),
         pa.array(s.n_words[bad].astype(np.int32)), pa.array(p[bad])],
        names=["first_word", "n_words", "score"])
    cuts = np.concatenate([[0], np.cumsum(np.bincount(doc, minlength=n))]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(cuts), items)


def score(docs: DataFrame, model: Model, text_col: str = "text", score_col: str = "score",
          sentences_col: str | None = "offending") -> DataFrame:
    """All columns of ``docs`` plus ``score_col`` (0 to 1) and, if asked for,
    ``sentences_col``: the offending sentences as ``(first_word, n_words, score)``.

    Texts without words (null, empty) have score 0; of any other length all sentences count.
    Rows are scored one by one, also when they repeat; no rows give no rows.  Columns of
    ``docs`` with the added names are replaced."""
    names = [c for c in docs.columns if c not in (score_col, sentences_col)]
    handle = docs.sparkSession.sparkContext.broadcast(model)    # bounded by the sample

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text_col, 512):
                s = _Sentences(part.column(text_col))
                p = s.scores(handle.value)
                clean = np.bincount(s.sentence_doc, weights=np.log1p(-np.minimum(p, 1 - 1e-15)),
                                    minlength=part.num_rows)
                cols = [part.column(c) for c in names] + [pa.array(1 - np.exp(clean))]
                if sentences_col:
                    cols.append(_locate(s, p, part.num_rows))
                yield pa.RecordBatch.from_arrays(cols, names=out.names)

    if text_col not in names:
        raise ValueError(f"{text_col} can't be replaced by a score")
    out = T.StructType([docs.schema[c] for c in names] + [T.StructField(score_col, T.DoubleType())])
    if sentences_col:
        out = out.add(sentences_col, T.ArrayType(T.StructType([
            T.StructField("first_word", T.IntegerType()), T.StructField("n_words", T.IntegerType()),
            T.StructField("score", T.DoubleType())])))
    return docs.mapInArrow(run, out)
