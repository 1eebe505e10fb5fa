"""Quality by the votes of labelled neighbours in a latent-semantic space.

A text is a bag of terms: its words as written, the shapes of its words (letters, digits and each other sign, runs
as one), and levels of two shares, that of words equal to the word before and that of words the text has had already. Terms are
hashed to ``DIMENSIONS`` columns, weighted ``(1 + ln tf) * ln((1 + n) / (1 + df))`` with document frequencies counted over all
documents, and brought to length one. The latent space holds the ``RANK`` leading right singular vectors of the labelled texts, found by
subspace iteration: each step is a job over their weighted terms, and a task gives back one matrix of DIMENSIONS x RANK.

The labelled vectors, about ``FIT_ROWS`` of ``RANK`` numbers, are broadcast. Every document is compared with all of them, in blocks
of documents, by exact cosine products. The ``NEIGHBOURS`` nearest, ties included, vote with their labels, weighted by the
``POWER``-th power of the cosine; ``PRIOR`` votes for the share of good labels stand for the case of no near neighbour.

Only the labelled rows are a sample: those whose hash of the id lies below FIT_ROWS / labels. Whole texts are read.

Cases: NULL and empty texts, and texts of terms that no or all documents have, have a vector of zeros and get the share of good
labels. Without labels all scores are 0; with labels of one kind all are that label. A document with several labels counts once per
different label, equal texts with equal labels once. Repeated rows are scored alike. Columns are carried inside
one struct, so no name can clash. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.llm import kernel
from tidewater.llm.common import cut
from tidewater.llm.lang_id import remainder

FIT_ROWS = 20_000
DIMENSIONS = 4096
RANK = 64
STEPS = 5
PARTS = 16  # tasks of a step of the subspace iteration
ROWS = 256  # documents compared at once
NEIGHBOURS = 15
POWER = 16
PRIOR = 0.05
THRESHOLD = 0.7

REPEATED = (0.02, 0.05, 0.1, 0.2, 0.4, 0.8)  # levels of the share of words equal to the word before
KNOWN = (0.5, 0.7, 0.8, 0.9, 0.95)  # levels of the share of words seen before in the text
LEVELS = len(REPEATED) + len(KNOWN)  # they have the first columns
LEVEL_COUNT = 8  # so often a reached level counts

LETTER, DIGIT, BLANK = 97, 48, 32
SHAPE = np.arange(256, dtype=np.uint8)
SHAPE[65:91], SHAPE[97:123], SHAPE[48:58], SHAPE[128:] = 65, LETTER, DIGIT, LETTER
SHAPE[[9, 10, 11, 12, 13]] = BLANK


@dataclass
class Terms:
    """Term counts of several texts: the columns and counts of text i are at ``first[i]`` to ``first[i + 1]``."""

    first: np.ndarray
    columns: np.ndarray
    counts: np.ndarray

    def dense(self, lo: int, hi: int, idf: np.ndarray) -> np.ndarray:
        """Weighted rows lo to hi, each of length one or zero."""
        a, b = self.first[lo], self.first[hi]
        out = np.zeros((hi - lo, len(idf)), np.float32)
        row = np.repeat(np.arange(hi - lo), np.diff(self.first[lo : hi + 1]))
        out[row, self.columns[a:b]] = 1 + np.log(self.counts[a:b])
        out *= idf
        return _unit(out)


def _unit(m: np.ndarray) -> np.ndarray:
    length = np.linalg.norm(m, axis=1, keepdims=True)
    return np.divide(m, length, out=m, where=length > 0)


def shape_words(data: np.ndarray, offsets: np.ndarray) -> kernel.Words:
    """Words of sign classes, in which a run of one class is one sign."""
    kind = SHAPE[data]
    keep = np.ones(len(kind), bool)
    keep[1:] = kind[1:] != kind[:-1]
    keep[offsets[:-1][offsets[:-1] < len(kind)]] = True
    short = kind[keep]
    return kernel.words(short, np.concatenate(([0], np.cumsum(keep)))[offsets], short != BLANK, kernel.BYTE_MIX[short])


def terms(column: pa.Array, dimensions: int = DIMENSIONS) -> Iterator[Terms]:
    """Terms of the texts, some at a time."""
    for lo, hi, data, offsets in kernel.text_slices(column):
        n = hi - lo
        w = kernel.words(data, offsets, kernel.NOT_SPACE[data], kernel.BYTE_MIX[data])
        s = shape_words(data, offsets)
        text, text_s = np.repeat(np.arange(n), w.counts), np.repeat(np.arange(n), s.counts)
        words = np.maximum(w.counts, 1)
        again = (w.hashes[1:] == w.hashes[:-1]) & (text[1:] == text[:-1])
        repeated = np.bincount(text[1:][again], minlength=n) / words
        mine, at = np.unique(kernel.mix(w.hashes ^ kernel.mix(text.astype(np.uint64))), return_index=True)
        known = 1 - np.bincount(text[at], minlength=n) / words
        reached = np.stack([repeated > v for v in REPEATED] + [(known > v) & (w.counts > 0) for v in KNOWN], axis=1)
        level_text, level = np.nonzero(reached)
        hashes = np.concatenate([kernel.mix(w.hashes), kernel.mix(s.hashes + np.uint64(1))])
        column_of = LEVELS + (hashes % np.uint64(dimensions - LEVELS)).astype(np.int64)
        key, count = np.unique(np.concatenate([text, text_s]) * dimensions + column_of, return_counts=True)
        key = np.concatenate([key, level_text * dimensions + level])
        count = np.concatenate([count, np.full(len(level), LEVEL_COUNT)])
        order = np.argsort(key, kind="stable")
        key = key[order]
        yield Terms(np.searchsorted(key, np.arange(n + 1) * dimensions), (key % dimensions).astype(np.int32), count[order].astype(np.int32))


@dataclass
class Model:
    idf: np.ndarray
    space: np.ndarray  # DIMENSIONS x RANK
    vectors: np.ndarray  # RANK x labelled rows, of length one
    labels: np.ndarray
    share: float

    def scores(self, column: pa.Array) -> Iterator[np.ndarray]:
        for t in terms(column, len(self.idf)):
            for lo in range(0, len(t.first) - 1, ROWS):
                hi = min(lo + ROWS, len(t.first) - 1)
                votes = self._votes(_unit(t.dense(lo, hi, self.idf) @ self.space))
                yield np.round(votes, 5)  # products of blocks differ in their last bits

    def _votes(self, z: np.ndarray) -> np.ndarray:
        near = z @ self.vectors
        np.maximum(near, 0, out=near)
        n = near.shape[1]
        if n > NEIGHBOURS:
            least = np.partition(near, n - NEIGHBOURS, axis=1)[:, n - NEIGHBOURS, None]
            near[near < least] = 0
        row, at = np.nonzero(near)
        weight = near[row, at].astype(np.float64) ** POWER
        votes = np.bincount(row, weight, len(z))
        good = np.bincount(row, weight * self.labels[at], len(z))
        return np.clip((good + PRIOR * self.share) / (votes + PRIOR), 0, 1)


def document_counts(docs: DataFrame, dimensions: int = DIMENSIONS) -> tuple[int, np.ndarray]:
    """The number of documents, and of those with a term of each column."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(dimensions + 1, np.int64)  # the last counts documents
        for batch in batches:
            total[dimensions] += batch.num_rows
            for t in terms(batch.column(0), dimensions):
                total[:dimensions] += np.bincount(t.columns, minlength=dimensions)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], ["place", "n"])

    found = docs.select("text").mapInArrow(run, "place int, n long").groupBy("place").agg(F.sum("n").alias("n")).collect()
    total = np.zeros(dimensions + 1, np.int64)  # one row per column
    for r in found:
        total[r["place"]] = r["n"]
    return int(total[dimensions]), total[:dimensions]


def _labelled_terms(rows: DataFrame, dimensions: int) -> DataFrame:
    """(columns, counts, label) of the labelled texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lo = 0
            for t in terms(batch.column(0), dimensions):
                n = len(t.first) - 1
                first = pa.array(t.first.astype(np.int32))
                lists = [pa.ListArray.from_arrays(first, pa.array(x)) for x in (t.columns, t.counts)]
                yield pa.RecordBatch.from_arrays([*lists, batch.column(1).slice(lo, n)], ["columns", "counts", "label"])
                lo += n

    return rows.select("text", "label").mapInArrow(run, "columns array<int>, counts array<int>, label int")


def _terms_of(batch: pa.RecordBatch) -> Terms:
    columns, counts = batch.column(0), batch.column(1)
    first = np.concatenate(([0], np.cumsum(columns.value_lengths().to_numpy(zero_copy_only=False))))
    return Terms(first, columns.flatten().to_numpy(), counts.flatten().to_numpy())


def _step(known: DataFrame, idf: np.ndarray, space: np.ndarray) -> np.ndarray:
    """X'(X space) for the weighted rows X; each task sends one matrix."""
    shared = known.sparkSession.sparkContext.broadcast((idf, space))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w, q = shared.value
        total = np.zeros(q.shape, np.float32)
        for batch in batches:
            t = _terms_of(batch)
            for lo in range(0, batch.num_rows, ROWS):
                x = t.dense(lo, min(lo + ROWS, batch.num_rows), w)
                total += x.T @ (x @ q)
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["m"])

    parts = known.coalesce(PARTS).mapInArrow(run, "m binary").collect()  # at most PARTS matrices
    return sum((np.frombuffer(r["m"], np.float32).reshape(space.shape) for r in parts), np.zeros(space.shape))


def fit(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS, dimensions: int = DIMENSIONS, rank: int = RANK) -> Model:
    """Fit on ``docs`` (doc_id, text) with ``labels`` (doc_id, quality 0 or 1): the labels that a hash puts below ``fit_rows``."""
    known = labels.filter("quality IN (0, 1) AND doc_id IS NOT NULL").select("doc_id", F.col("quality").cast("int").alias("label"))
    n = known.count()
    lot = F.pmod(F.xxhash64(F.lit(12), "doc_id"), F.lit(1 << 40)) / float(1 << 40)
    picked = F.broadcast(known.filter(lot < fit_rows / max(n, 1)))  # about fit_rows rows of two numbers
    rows = docs.select("doc_id", "text").join(picked, "doc_id").select("text", "label").distinct()
    rows = cut(_labelled_terms(rows, dimensions).repartition(PARTS), "labelled")
    total, having = document_counts(docs, dimensions)
    idf = np.log((1 + total) / (1 + having)).astype(np.float32)
    space = np.linalg.qr(np.random.default_rng(12).standard_normal((dimensions, rank)))[0].astype(np.float32)
    for _ in range(STEPS):
        space = np.linalg.qr(_step(rows, idf, space))[0].astype(np.float32)
    shared = docs.sparkSession.sparkContext.broadcast((idf, space))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w, q = shared.value
        for batch in batches:
            t = _terms_of(batch)
            z = [_unit(t.dense(lo, min(lo + ROWS, batch.num_rows), w) @ q).tobytes() for lo in range(0, batch.num_rows, ROWS)]
            yield pa.RecordBatch.from_arrays([pa.array([b"".join(z)], pa.binary()), pa.array([batch.column(2).to_pylist()], pa.list_(pa.int32()))], ["z", "label"])

    found = rows.mapInArrow(run, "z binary, label array<int>").collect()  # about fit_rows vectors
    z = np.frombuffer(b"".join(r["z"] for r in found), np.float32).reshape(-1, rank)
    y = np.array([v for r in found for v in r["label"]], np.float64)
    return Model(idf, space, np.ascontiguousarray(z.T), y, float(y.mean()) if len(y) else 0.0)


def rate(rows: DataFrame, model: Model) -> DataFrame:
    """``rows`` has one struct column ``row`` with a ``text``; adds its score."""
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = list(shared.value.scores(batch.column(0).field("text")))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.concatenate([np.zeros(0), *scores]))], ["row", "score"])

    return rows.mapInArrow(run, T.StructType([*rows.schema.fields, T.StructField("score", T.DoubleType())]))


def training_labels(labels: DataFrame) -> DataFrame:
    """Labels outside the held-out quarter."""
    return labels.filter(remainder(F.col("doc_id"), 4) != 2).select("doc_id", "quality")
