"""Benchmark decontamination: word windows of the benchmark as a broadcast hash set, scanned over every document.

Words are runs of letters, digits and non-ASCII characters after lower-casing A-Z. A window is ``size`` consecutive
words of an item; an item with fewer words, but not none, is one window. The windows are spread over blocks of a
fixed number of rows; each block is broadcast and all documents are scanned against it, so what is broadcast has a
bound however large the benchmark is. A hash hit counts only after the words themselves have been compared.

Cases: a NULL or empty text has no words and no hits. NULL item ids hit words but are listed in no item list. Equal
items and repeated rows count once in item lists; each document row gets its own result, also when ids repeat. Empty
tables give empty or clean results. Columns of the documents are carried inside one struct, so no name can clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.llm import kernel
from tidewater.llm.common import cut, running_total

WINDOW = 10
BLOCK_ROWS = 200_000  # (window, item) rows per broadcast: some 60 MB in a Python worker
#: Bytes of text handled at once: words and windows take some sixty bytes of memory for each.
SLICE = 1 << 18


def windows(benchmark: DataFrame, size: int = WINDOW) -> DataFrame:
    """Distinct (window, n, item): the words joined by spaces, their number, the item id as text."""

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            out = []
            for item, text in zip(ids, texts, strict=True):
                w = plain_words(text or "")
                n = min(size, len(w))
                out += [(b" ".join(w[i : i + n]).decode(), n, item) for i in range(len(w) - n + 1) if n]
            columns = list(zip(*out, strict=True)) or [(), (), ()]
            kinds = (pa.string(), pa.int32(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["window", "n", "item"])

    items = benchmark.select(F.col("item_id").cast("string"), "text")
    return items.mapInArrow(split, "window string, n int, item string").distinct()


_SEPARATORS = bytes(int(kernel.LOWER[b]) if kernel.ALNUM[kernel.LOWER[b]] else 32 for b in range(256))


def plain_words(text: str) -> list[bytes]:
    return text.encode().translate(_SEPARATORS).split()


class HashSet:
    """Windows by hash. A bit table answers most look-ups; entries hold the words, to verify a hit."""

    BITS = 20

    def __init__(self, rows: list[tuple[str, int, str | None]]):
        self.by_size: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        self.entries: dict[int, list[tuple[bytes, str | None]]] = {}
        sizes: dict[int, list[int]] = {}
        for window, n, item in rows:
            w = np.array([kernel.word_hash(x) for x in window.split(" ")], np.uint64)
            h = int(kernel.gram_hashes(w, n)[0])
            self.entries.setdefault(h, []).append((window.encode(), item))
            sizes.setdefault(n, []).append(h)
        for n, hs in sizes.items():
            table = np.unique(np.array(hs, np.uint64))
            bits = np.zeros(1 << self.BITS, bool)
            bits[table >> np.uint64(64 - self.BITS)] = True
            self.by_size[n] = table, bits

    def hits(self, w: kernel.Words, lower: np.ndarray) -> Iterator[tuple[int, int, int, str | None]]:
        """(text, first word, past the last word, item) of every verified window; words count within the slice."""
        for n, (table, bits) in self.by_size.items():
            g = kernel.gram_hashes(w.hashes, n)
            maybe = np.flatnonzero(bits[g >> np.uint64(64 - self.BITS)])
            at = np.minimum(np.searchsorted(table, g[maybe]), len(table) - 1)
            maybe = maybe[table[at] == g[maybe]]
            texts = np.searchsorted(w.first, maybe, "right") - 1
            fits = maybe + n <= w.first[texts + 1]
            for i, text in zip(maybe[fits].tolist(), texts[fits].tolist(), strict=True):
                seen = b" ".join(lower[a:b].tobytes() for a, b in zip(w.starts[i : i + n], w.ends[i : i + n], strict=True))
                for window, item in self.entries[int(g[i])]:
                    if window == seen:
                        yield text, i, i + n, item


def _scan(shared) -> object:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: HashSet = shared.value
        for batch in batches:
            rows = batch.column(0)
            text = rows.field("text")
            had = batch.column(1).to_pylist(), batch.column(2).to_pylist()
            n_words, spans, items = [], [], []
            for lo, hi, data, offsets in kernel.text_slices(text, SLICE):
                w = kernel.byte_words(data, offsets, kernel.ALNUM)
                cover: dict[int, list[tuple[int, int]]] = {}
                found: dict[int, set[str]] = {}
                for doc, a, b, item in known.hits(w, kernel.LOWER[data]):
                    cover.setdefault(doc, []).append((a - int(w.first[doc]), b - int(w.first[doc])))
                    if item is not None:
                        found.setdefault(doc, set()).add(item)
                n_words += w.counts.tolist()
                for doc in range(hi - lo):
                    before = np.frombuffer(had[0][lo + doc] or b"", np.int64).reshape(-1, 2).tolist()
                    spans.append(np.array(union([*before, *cover.get(doc, [])]), np.int64).tobytes())
                    items.append(sorted(found.get(doc, set()) | set(had[1][lo + doc] or ())))
            yield pa.RecordBatch.from_arrays(
                [rows, pa.array(spans, pa.binary()), pa.array(items, pa.list_(pa.string())), pa.array(n_words, pa.int64())],
                ["row", "spans", "items", "n_words"],
            )

    return run


def union(spans: list) -> list[tuple[int, int]]:
    """Intervals without overlap that cover the same words."""
    out: list[list[int]] = []
    for a, b in sorted(map(tuple, spans)):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [tuple(x) for x in out]


def scan(rows: DataFrame, benchmark: DataFrame, size: int = WINDOW, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``rows`` has one struct column ``row`` with a ``text``; adds spans (int64 pairs), items and n_words."""
    spark = rows.sparkSession
    grams = cut(windows(benchmark, size), "windows")
    n = grams.count()
    blocks = max(1, -(-n // block_rows))
    if blocks > 1:
        order = [F.col("window"), F.col("item")]
        grams = cut(running_total(grams, order, F.lit(1), "window-ranks"), "window-blocks")
    kind = T.StructType([*rows.schema.fields, T.StructField("spans", T.BinaryType()), T.StructField("items", T.ArrayType(T.StringType())), T.StructField("n_words", T.LongType())])
    out = rows.select("row", F.lit(None).cast("binary").alias("spans"), F.lit(None).cast("array<string>").alias("items"))
    for k in range(blocks):
        mine = grams if blocks == 1 else grams.filter(F.floor(F.col("_rank") / block_rows) == k)
        shared = spark.sparkContext.broadcast(HashSet([tuple(r) for r in mine.select("window", "n", "item").collect()]))
        out = out.select("row", "spans", "items").mapInArrow(_scan(shared), kind)
        if k + 1 < blocks:
            out = cut(out, "scanned")
    return out


def _covered(spans: Column) -> Column:
    @F.pandas_udf("long")
    def total(s):
        return s.map(lambda b: int((x := np.frombuffer(b, np.int64).reshape(-1, 2))[:, 1].sum() - x[:, 0].sum()))

    return total(spans)


def contamination(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """One row per document: doc_id, n_words, n_hit (words inside a window), n_items, items (ids), contaminated."""
    found = scan(docs.select(F.struct("doc_id", "text").alias("row")), benchmark, size, block_rows)
    hit = _covered(F.col("spans"))
    return found.select("row.doc_id", "n_words", "spans", "items").select(
        "doc_id",
        "n_words",
        hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        "items",
        (F.length("spans") > 0).alias("contaminated"),
    )


def decontaminate(
    docs: DataFrame, benchmark: DataFrame, remove: str = "documents", size: int = WINDOW, block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """``docs`` with the same columns, without contaminated documents or (``remove="spans"``) without the words hit.

    A span goes from its first word to its last one; what stands around it is joined by a space.
    """
    if remove not in ("documents", "spans"):
        raise ValueError(f"remove is documents or spans, not {remove!r}")
    found = scan(docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")), benchmark, size, block_rows)
    if remove == "documents":
        return found.filter(F.length("spans") == 0).select("row.*")

    @F.pandas_udf("string")
    def without(text, spans):
        return text.combine(spans, cut_spans)

    rest = F.when(F.length("spans") == 0, F.col("row.text")).otherwise(without(F.col("row.text"), F.col("spans")))
    return found.select(*[rest.alias(c) if c == "text" else F.col(f"row.`{c}`") for c in docs.columns])


def cut_spans(text: str | None, spans: bytes) -> str | None:
    pairs = np.frombuffer(spans, np.int64).reshape(-1, 2)
    if text is None or not len(pairs):
        return text
    data = text.encode()
    w = kernel.byte_words(np.frombuffer(data, np.uint8), np.array([0, len(data)]), kernel.ALNUM)
    out, at = [], 0
    for a, b in pairs:
        out.append(data[at : w.starts[a]].rstrip())
        at = int(w.ends[b - 1])
    out.append(data[at:].lstrip())
    return b" ".join(x for x in out if x).decode()


def items_digest(items: Column) -> Column:
    """sha256 of the ids sorted as strings and joined by commas."""
    return F.sha2(F.concat_ws(",", F.array_sort(items)), 256)
