"""Toxic passages by maximum-scoring segments.

Every word has a score: the log-odds of its use in toxic against other labelled texts under an informative Dirichlet
prior (words are drawn towards the frequency they have in all labelled texts), where that differs from zero
by ``LEAST_Z`` standard deviations. A word without such a score takes that of its longest prefix that has one, so that
unseen endings of a known stem count; the k-th of equal words in a row has 1 / k of the score. Every word also pays ``DRIFT``, so that a text without signal scores below zero. One
linear scan finds all maximal scoring segments. By extreme-value theory the best segment of a clean text of m words
exceeds S with probability ``1 - exp(-K m exp(-lambda S))``: lambda is the root of ``E[exp(lambda s)] = 1`` over the words
of clean texts, K is fitted on the best segments of clean texts. A segment is significant when that probability is
below ``SIGNIFICANT``. The score of a text is a logistic function of the significance of its best segment and of the
sum over its significant segments, fitted on labelled texts.

The model is fitted on labelled rows chosen by a hash of their id, about ``FIT_ROWS`` of them, and holds at most ``MAX_WORDS``
words. Whole texts are scored.

Cases: NULL and empty texts have no segment and get the score of a text without signal. Without labels of both kinds all
scores are the share of toxic labels (0 without labels). A document with several labels counts once per label. Ties
and repeated rows need no rule. Columns are carried inside one struct, so no name can clash.
"""

from __future__ import annotations

import math
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
MAX_WORDS = 50_000
PREFIXES = (4, 5, 6)  # bytes
PRIOR = 0.02  # weight of the Dirichlet prior: so many pseudo-words per counted word
LEAST_Z = 3.0
DRIFT = 0.15
SIGNIFICANT = 0.05
THRESHOLD = 0.3


def segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (from, past the end, score) in linear time.

    Only words with a positive score start a candidate; a running sum carries what stands between them. Every candidate
    keeps a link to the nearest one before it with a smaller sum on its left. A search follows these links, so a
    candidate that was passed over once is never visited again; one that is merged passes its link on.
    """
    total = np.concatenate(([0.0], np.cumsum(scores)))
    found: list[tuple[int, int, float, float, int]] = []  # from, past the end, sums before and after, link
    for i in np.flatnonzero(scores > 0).tolist():
        a, b, low, high = i, i + 1, float(total[i]), float(total[i + 1])
        j = len(found) - 1
        while j >= 0 and found[j][2] >= low:
            j = found[j][4]
        while j >= 0 and found[j][3] < high:
            a, _, low, _, link = found[j]
            del found[j:]
            j = link
        found.append((a, b, low, high, j))
    return [(a, b, high - low) for a, b, low, high, _ in found]


def prefix_hashes(w: kernel.Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(word, hash of its first n bytes) of the words that are longer."""
    longer = np.flatnonzero(w.ends - w.starts > n)
    at = w.starts[longer]
    return longer, kernel.mix((w.prefix[at + n] - w.prefix[at]) * kernel.powers(kernel.BASE_INV, len(w.prefix))[at] + np.uint64(n))


def run_places(w: kernel.Words) -> np.ndarray:
    """The place, from 1, of each word among equal words in a row; a text begins anew."""
    at = np.arange(len(w.hashes))
    fresh = np.ones(len(at), bool)
    fresh[1:] = w.hashes[1:] != w.hashes[:-1]
    fresh[w.first[:-1][w.first[:-1] < len(at)]] = True
    return at - np.maximum.accumulate(np.where(fresh, at, 0)) + 1


@dataclass
class Model:
    hashes: np.ndarray  # sorted
    scores: np.ndarray  # without the drift
    rate: float  # lambda
    log_k: float
    weights: tuple[float, float, float]  # constant, best segment, sum of significant ones

    def bits(self, score: float, n: int) -> float:
        """-ln of the expected number of segments as good in a clean text of n words."""
        return self.rate * score - self.log_k - math.log(max(n, 1))

    def texts(self, column: pa.Array) -> Iterator[tuple[int, list[tuple[int, int, float]]]]:
        """Of each text its number of words and its segments."""
        bitmap = np.zeros(1 << 20, bool)
        bitmap[self.hashes >> np.uint64(44)] = True
        for _, _, data, offsets in kernel.text_slices(column):
            w = kernel.byte_words(data, offsets, kernel.ALNUM)
            s = np.zeros(len(w.hashes))
            if len(self.hashes):  # a later kind of token overrules an earlier one
                for owner, h in [*(prefix_hashes(w, n) for n in PREFIXES), (np.arange(len(w.hashes)), w.hashes)]:
                    maybe = np.flatnonzero(bitmap[h >> np.uint64(44)])
                    at = np.minimum(np.searchsorted(self.hashes, h[maybe]), len(self.hashes) - 1)
                    hit = self.hashes[at] == h[maybe]
                    s[owner[maybe[hit]]] = self.scores[at[hit]]
            s = s / run_places(w) - DRIFT
            for a, b in zip(w.first[:-1].tolist(), w.first[1:].tolist(), strict=True):
                yield b - a, segments(s[a:b]) if b > a else []

    def passages(self, n: int, found: list[tuple[int, int, float]]) -> list[tuple[int, int, float]]:
        """The significant ones, with the probability that a clean text of n words has one as good."""
        known = [(a, b, -math.expm1(-math.exp(min(700.0, -self.bits(s, n))))) for a, b, s in found]
        return [x for x in known if x[2] < SIGNIFICANT]

    def features(self, n: int, found: list[tuple[int, int, float]]) -> tuple[float, float]:
        bits = [self.bits(s, n) for _, _, s in found]
        level = -math.log(SIGNIFICANT)
        best = max([*bits, -level])
        return (best if best < level else level + math.log1p(best - level)), math.log1p(sum(x for x in bits if x > level))

    def score(self, n: int, found: list[tuple[int, int, float]]) -> float:
        x = np.dot(self.weights, (1.0, *self.features(n, found)))
        return float(1 / (1 + math.exp(-max(-700.0, min(700.0, x)))))


def _constant(share: float) -> Model:
    p = min(max(share, 1e-9), 1 - 1e-9)
    return Model(np.zeros(0, np.uint64), np.zeros(0), 1.0, 0.0, (math.log(p / (1 - p)), 0.0, 0.0))


def _word_counts(rows: DataFrame) -> DataFrame:
    """(hash, toxic, c) over the labelled rows (text, toxic); a word, and each of its prefixes, counts once per text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            toxic = np.array(batch.column(1).to_pylist(), np.int64)
            for lo, hi, data, offsets in kernel.text_slices(batch.column(0)):
                w = kernel.byte_words(data, offsets, kernel.ALNUM)
                text = np.repeat(np.arange(lo, hi), w.counts)
                kinds = [(np.arange(len(w.hashes)), w.hashes), *(prefix_hashes(w, n) for n in PREFIXES)]
                text = np.concatenate([text[owner] for owner, _ in kinds])
                h = np.concatenate([x for _, x in kinds])
                order = np.lexsort((h, text))
                h, text = h[order], text[order]
                first = np.ones(len(h), bool)
                first[1:] = (h[1:] != h[:-1]) | (text[1:] != text[:-1])
                of_word = toxic[text]
                for k in (0, 1):
                    h_k, c = np.unique(h[first & (of_word == k)], return_counts=True)
                    columns = [pa.array(h_k.view(np.int64)), pa.array(np.full(len(h_k), k, np.int32)), pa.array(c.astype(np.int64))]
                    yield pa.RecordBatch.from_arrays(columns, ["hash", "toxic", "c"])

    return rows.mapInArrow(run, "hash long, toxic int, c long").groupBy("hash").pivot("toxic", [0, 1]).agg(F.sum("c"))


def fit(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS, max_words: int = MAX_WORDS) -> Model:
    """Fit on ``docs`` (doc_id, text) with ``labels`` (doc_id, toxic 0 or 1): the labels that a hash puts below ``fit_rows``."""
    known = labels.filter("toxic IN (0, 1) AND doc_id IS NOT NULL").select("doc_id", F.col("toxic").cast("int").alias("toxic"))
    n = known.count()
    lot = F.pmod(F.xxhash64(F.lit(9), "doc_id"), F.lit(1 << 40)) / float(1 << 40)
    known = F.broadcast(known.filter(lot < fit_rows / max(n, 1)))  # about fit_rows rows of two numbers
    rows = cut(docs.select("doc_id", "text").join(known, "doc_id").select("text", "toxic").distinct(), "labelled")
    share = rows.agg(F.avg("toxic")).first()[0]
    if share is None or share in (0.0, 1.0):
        return _constant(share or 0.0)
    counts = cut(_word_counts(rows).select("hash", F.coalesce("0", F.lit(0)).alias("c0"), F.coalesce("1", F.lit(0)).alias("c1")), "label-words")
    n0, n1 = counts.agg(F.sum("c0"), F.sum("c1")).first()
    if not n0 or not n1:
        return _constant(share)
    prior = (F.col("c0") + F.col("c1")) * PRIOR
    weight = (n0 + n1) * PRIOR
    y0, y1 = F.col("c0") + prior, F.col("c1") + prior
    delta = F.log(y1 / (n1 + weight - y1)) - F.log(y0 / (n0 + weight - y0))
    scored = counts.select("hash", "c0", delta.alias("delta"), (delta / F.sqrt(1 / y0 + 1 / y1)).alias("z"))
    scored = scored.filter(F.abs("z") >= LEAST_Z).orderBy(F.desc(F.abs("z")), "hash").limit(max_words).toPandas()
    h = scored["hash"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(h)
    score = scored["delta"].to_numpy(float)[order]
    share0 = scored["c0"].to_numpy(float)[order] / n0
    model = Model(h[order], score, _rate(score - DRIFT, share0), 0.0, (0.0, 0.0, 0.0))
    return _calibrated(model, rows)


def _rate(scores: np.ndarray, share: np.ndarray) -> float:
    """The positive root of E[exp(x s)] = 1; other words of clean texts score -DRIFT."""
    rest = 1 - share.sum()

    def excess(x: float) -> float:
        return float((share * np.exp(np.minimum(x * scores, 700))).sum() + rest * math.exp(-x * DRIFT)) - 1

    lo, hi = 1e-6, 1e-6
    while excess(hi) <= 0 and hi < 50:
        hi = hi * 2 + 0.01
    for _ in range(100):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if excess(mid) < 0 else (lo, mid)
    return max(hi, 0.01)


def _calibrated(model: Model, rows: DataFrame) -> Model:
    """Fit K on clean rows and the logistic function on all rows; the driver gets two numbers per fitting row."""
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, found = [], []
            for words, s in shared.value.texts(batch.column(0)):
                n.append(words)
                found.append([x[2] for x in s])
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(n, pa.int64()), pa.array(found, pa.list_(pa.float64()))], ["toxic", "n", "s"])

    seen = cut(rows.select("text", "toxic").mapInArrow(scan, "toxic int, n long, s array<double>"), "label-segments")
    clean = seen.filter("toxic = 0 AND size(s) > 0").agg(F.avg(F.array_max("s") * model.rate - F.log("n"))).first()[0]
    # Of a Gumbel variable with location ln K the mean lies Euler's constant above it.
    model.log_k = clean - 0.5772156649 if clean is not None else 0.0
    level = rows.sparkSession.sparkContext.broadcast(model)

    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            each = [level.value.features(n, [(0, 0, v) for v in s]) for n, s in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)]
            columns = [pa.array([f[k] for f in each], pa.float64()) for k in (0, 1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], ["toxic", "best", "total"])

    seen = seen.mapInArrow(reduce, "toxic int, best double, total double").collect()
    x = np.array([(1.0, r["best"], r["total"]) for r in seen])
    y = np.array([r["toxic"] for r in seen], float)
    w = np.zeros(3)
    for _ in range(50):  # Newton steps with a small ridge
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        hess = (x * (p * (1 - p))[:, None]).T @ x + 1e-2 * np.eye(3)
        step = np.linalg.solve(hess, x.T @ (y - p) - 1e-2 * w)
        w += step
        if np.abs(step).max() < 1e-9:
            break
    model.weights = tuple(w.tolist())
    return model


def rate(rows: DataFrame, model: Model) -> DataFrame:
    """``rows`` has one struct column ``row`` with a ``text``; adds score and passages (first word, last word, p)."""
    shared = rows.sparkSession.sparkContext.broadcast(model)
    passage = pa.list_(pa.struct([("first_word", pa.int32()), ("last_word", pa.int32()), ("p", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m: Model = shared.value
        for batch in batches:
            scores, passages = [], []
            for n, found in m.texts(batch.column(0).field("text")):
                scores.append(m.score(n, found))
                passages.append([{"first_word": a, "last_word": b - 1, "p": p} for a, b, p in m.passages(n, found)])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64()), pa.array(passages, passage)], ["row", "score", "passages"])

    kind = T.ArrayType(T.StructType([T.StructField("first_word", T.IntegerType()), T.StructField("last_word", T.IntegerType()), T.StructField("p", T.DoubleType())]))
    return rows.mapInArrow(run, T.StructType([*rows.schema.fields, T.StructField("score", T.DoubleType()), T.StructField("passages", kind)]))


def training_labels(labels: DataFrame) -> DataFrame:
    """Labels outside the held-out quarter."""
    return labels.filter(remainder(F.col("doc_id"), 4) != 2).select("doc_id", "toxic")
