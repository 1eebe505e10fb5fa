"""Language identification by word-first backoff.

A word (a run of letters, lower-cased) that was seen in training scores with its log frequency in each language. An
unseen word scores with its character n-grams instead: with the longest n at which any of its n-grams is known, by the
mean of their log frequencies. The language with the largest sum over all words wins; ties go to the first in order.

The model is fitted on labelled rows chosen by a hash of their text, about ``FIT_ROWS`` of them however many there are.
It holds at most ``MAX_WORDS`` words and ``MAX_GRAMS`` n-grams, the most frequent ones, so that its size is bounded.
Counting is a Spark aggregation; texts are scored whole.

Cases: a NULL text, or one without a letter, is ``und`` with score 0. A text whose words and letters are all unknown gets
the first language with score 1/n. Without labelled rows everything is ``und``. Rows are independent: ties, repeated
rows and empty tables need no rule. Columns are carried inside one struct, so no name can clash.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.llm import kernel

FIT_ROWS = 20_000
MAX_WORDS = 200_000
MAX_GRAMS = 200_000
LONGEST = 4
#: Bytes of text handled at once: n-grams take some hundred bytes of memory for each.
SLICE = 1 << 18
#: Rows handed on at once.
BATCH_ROWS = 500
SMOOTHING = 0.5
UNKNOWN = "und"


@cache
def characters() -> tuple[np.ndarray, np.ndarray]:
    """Per code point: whether it is a letter, and a random number for its lower-case form."""
    n = 0x110000
    letter = np.zeros(n, bool)
    lower = np.arange(n, dtype=np.uint64)
    for c in range(0x33480):  # no letters are assigned above
        x = chr(c)
        if x.isalpha():
            letter[c] = True
            y = x.lower()
            if len(y) == 1:
                lower[c] = ord(y)
    return letter, kernel.mix(lower + np.uint64(1))


def letter_words(data: np.ndarray, offsets: np.ndarray) -> kernel.Words:
    points = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), np.uint32)
    before = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))
    letter, mixed = characters()
    return kernel.words(points, before[offsets], letter[points], mixed[points])


def grams(w: kernel.Words, words: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(index into ``words``, hash) of every character n-gram of the given words."""
    count = np.maximum(w.ends[words] - w.starts[words] - n + 1, 0)
    owner = np.repeat(np.arange(len(words)), count)
    at = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count) + w.starts[words][owner]
    shift = kernel.powers(kernel.BASE_INV, len(w.prefix))[at]
    return owner, kernel.mix((w.prefix[at + n] - w.prefix[at]) * shift + np.uint64(n))


@dataclass
class Table:
    """Sorted hashes and their log frequencies, one column per language."""

    hashes: np.ndarray
    logs: np.ndarray

    def find(self, h: np.ndarray) -> np.ndarray:
        """Row of each hash, -1 where it is unknown."""
        if not len(self.hashes):
            return np.full(len(h), -1)
        at = np.minimum(np.searchsorted(self.hashes, h), len(self.hashes) - 1)
        return np.where(self.hashes[at] == h, at, -1)


@dataclass
class Model:
    langs: list[str]
    words: Table
    grams: list[Table]  # by length, from 1

    def word_scores(self, w: kernel.Words, words: np.ndarray) -> np.ndarray:
        """A row of scores for each of ``words``."""
        out = np.zeros((len(words), len(self.langs)))
        at = self.words.find(w.hashes[words])
        out[at >= 0] = self.words.logs[at[at >= 0]]
        rest = np.flatnonzero(at < 0)
        for n in range(len(self.grams), 0, -1):
            if not len(rest):
                break
            owner, h = grams(w, words[rest], n)
            row = self.grams[n - 1].find(h)
            owner, row = owner[row >= 0], row[row >= 0]
            known = np.bincount(owner, minlength=len(rest))
            for k in range(len(self.langs)):
                total = np.bincount(owner, self.grams[n - 1].logs[row, k], minlength=len(rest))
                out[rest, k] += total / np.maximum(known, 1)
            rest = rest[known == 0]
        return out

    def predict(self, column: pa.Array) -> tuple[list[str], list[float]]:
        names, scores = [], []
        for _, _, data, offsets in kernel.text_slices(column, SLICE):
            w = letter_words(data, offsets)
            n = w.counts
            if not self.langs:
                names += [UNKNOWN] * len(n)
                scores += [0.0] * len(n)
                continue
            _, first, inverse = np.unique(w.hashes, return_index=True, return_inverse=True)
            each = self.word_scores(w, first)
            text = np.repeat(np.arange(len(n)), n)
            total = np.stack([np.bincount(text, each[inverse, k], minlength=len(n)) for k in range(len(self.langs))], axis=1)
            total -= total.max(axis=1, keepdims=True)
            best = total.argmax(axis=1)
            likely = np.exp(total / np.sqrt(np.maximum(n, 1))[:, None])
            score = 1 / likely.sum(axis=1)
            names += [self.langs[b] if k else UNKNOWN for b, k in zip(best.tolist(), n.tolist(), strict=True)]
            scores += np.where(n > 0, score, 0.0).tolist()
        return names, scores


def _counts(rows: DataFrame, langs: list[str]) -> DataFrame:
    """(n, hash, lang, c): words (n = 0) and n-grams of the labelled rows (text, lang)."""
    number = {x: k for k, x in enumerate(langs)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lang = np.array([number[x] for x in batch.column(1).to_pylist()], np.int64)
            for lo, hi, data, offsets in kernel.text_slices(batch.column(0), SLICE):
                w = letter_words(data, offsets)
                of_word = np.repeat(lang[lo:hi], w.counts)
                every = np.arange(len(w.hashes))
                for n in range(LONGEST + 1):
                    owner, h = grams(w, every, n) if n else (every, w.hashes)
                    for k in np.unique(of_word):
                        found, c = np.unique(h[of_word[owner] == k], return_counts=True)
                        size = len(found)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.full(size, n, np.int32)), pa.array(found.view(np.int64)), pa.array(np.full(size, k, np.int32)), pa.array(c.astype(np.int64))],
                            ["n", "hash", "lang", "c"],
                        )

    found = rows.select("text", "lang").mapInArrow(run, "n int, hash long, lang int, c long")
    return found.groupBy("n", "hash", "lang").agg(F.sum("c").alias("c"))


def fit(labelled: DataFrame, fit_rows: int = FIT_ROWS, max_words: int = MAX_WORDS, max_grams: int = MAX_GRAMS) -> Model:
    """Fit on the rows of ``labelled`` (text, lang) that the hash of their text puts below ``fit_rows`` expected rows."""
    rows = labelled.filter("text IS NOT NULL AND lang IS NOT NULL")
    n = rows.count()
    lot = F.pmod(F.xxhash64(F.lit(4), "text"), F.lit(1 << 40)) / float(1 << 40)
    rows = rows.filter(lot < fit_rows / max(n, 1)).select("text", "lang")
    langs = sorted(r["lang"] for r in rows.groupBy("lang").count().collect())  # one row per language
    if not langs:
        return Model([], Table(np.zeros(0, np.uint64), np.zeros((0, 0))), [])
    wide = _counts(rows, langs).groupBy("n", "hash").agg(
        F.sum("c").alias("all"), F.map_from_entries(F.collect_list(F.struct("lang", "c"))).alias("by")
    )  # at most one entry per language
    keep = wide.filter("all > 1").select("n", "hash", "all", *[F.coalesce(F.col("by")[k], F.lit(0)).alias(f"c{k}") for k in range(len(langs))])

    def table(n: list[int], limit: int) -> dict[int, Table]:
        top = keep.filter(F.col("n").isin(n)).orderBy(F.desc("all"), "n", "hash").limit(limit).toPandas()
        out = {}
        for k in n:
            part = top[top["n"] == k]
            h = part["hash"].to_numpy(np.int64).view(np.uint64)
            c = part[[f"c{i}" for i in range(len(langs))]].to_numpy(float)
            order = np.argsort(h)
            logs = np.log((c + SMOOTHING) / (c.sum(axis=0) + SMOOTHING * (len(c) + 1)))
            out[k] = Table(h[order], logs[order])
        return out

    by = table(list(range(1, LONGEST + 1)), max_grams)
    return Model(langs, table([0], max_words)[0], [by[n] for n in range(1, LONGEST + 1)])


def identify(rows: DataFrame, model: Model, least_score: float | None = None) -> DataFrame:
    """``rows`` has one struct column ``row`` with a ``text``; adds lang_pred and score (0 to 1).

    With ``least_score``, rows without a language or with a lower score are left out.
    """
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for lo in range(0, whole.num_rows, BATCH_ROWS):
                batch = whole.slice(lo, BATCH_ROWS)
                names, scores = shared.value.predict(batch.column(0).field("text"))
                out = pa.RecordBatch.from_arrays([batch.column(0), pa.array(names, pa.string()), pa.array(scores, pa.float64())], ["row", "lang_pred", "score"])
                if least_score is not None:
                    out = out.filter(pa.array([x != UNKNOWN and s >= least_score for x, s in zip(names, scores, strict=True)], pa.bool_()))
                yield out

    kind = T.StructType([*rows.schema.fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    return rows.mapInArrow(run, kind)


def remainder(doc_id: Column, by: int) -> Column:
    """crc32 of the id as text, modulo ``by``; 0 for a NULL id."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(by)), F.lit(0))


def training_rows(docs: DataFrame) -> DataFrame:
    """Labelled rows outside the held-out fifth."""
    return docs.filter(remainder(F.col("doc_id"), 5) != 0).select("text", "lang")
