"""Token files: ids in canonical length-limited Huffman code, in independent blocks with bit-offset checkpoints.

Writing: texts are encoded by the tokenizer; ids are counted over all documents; package-merge gives each id a code of at
most ``MAX_BITS`` bits; documents are range-partitioned and sorted by doc_id, and each range is written as blocks of whole
documents. A folder holds ``codebook`` (id, bits: the canonical code follows from the lengths) and ``blocks``, both
written by Spark, so a lost task leaves no part of a file behind.

A block row has its range, the ids of the range before it, and a payload: magic, numbers of documents and ids, doc_ids,
NULL flags, ids per document, a checkpoint for every ``STRIDE`` ids (the bits since the last checkpoint), the code bits,
and a CRC. Reading looks up ``MAX_BITS`` bits at a time in one table and decodes between all checkpoints of a block at
once. Blocks need nothing but the codebook.

Every document ends with one end id. A tokenizer that splits at white space and ends words is asked for each different
word only once per worker and time (``Encoder``); the ids are those of whole texts, which the tests compare.

Cases: NULL and empty texts have the end id alone. Documents with equal doc_id stand next to each other in the order of
their ids; NULL doc_ids come first. An empty table gives files without blocks. Only doc_id and text are read.
"""

from __future__ import annotations

import json
import os
import zlib
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidewater.llm import kernel
from tidewater.llm.common import cut

MAX_BITS = 16
STRIDE = 64
BLOCK_IDS = 1 << 16
END_ID = 2
MAGIC = b"TWH1"
CACHE_WORDS = 500_000

_encoders: dict[int, Encoder] = {}


class Encoder:
    """Texts to ids. Words between ASCII white space are looked up in a table of the words seen so far.

    Only a tokenizer whose pre-tokens never hold white space and each end with one end-of-word token takes the table;
    other tokenizers encode whole texts. ASCII letters are lower-cased first where the tokenizer does so itself.
    """

    def __init__(self, config: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(config)
        spec = json.loads(config)
        suffix = spec["model"].get("end_of_word_suffix") or ""
        kinds = [x["type"] for x in (spec.get("normalizer") or {}).get("normalizers", [])]
        self.by_word = bool(suffix) and kinds == ["NFC", "Replace", "Lowercase"]
        self.ends = np.zeros(self.tokenizer.get_vocab_size(), bool)
        if self.by_word:
            self.ends[[i for t, i in self.tokenizer.get_vocab().items() if t.endswith(suffix)]] = True
        self.clear()

    def clear(self) -> None:
        self.index: dict[bytes, int] = {}
        self.size = 0
        self.flat = np.empty(1 << 16, np.uint32)
        self.start, self.length, self.seen = (np.zeros(1 << 14, np.int64) for _ in range(3))

    def shrink(self) -> None:
        """Forget all but the words met most often."""
        words, n = list(self.index), len(self.index)
        keep = np.sort(np.argsort(-self.seen[:n], kind="stable")[: CACHE_WORDS // 3])
        flat, start, length = self.flat, self.start, self.length
        self.clear()
        ids = flat[np.repeat(start[keep] - np.cumsum(length[keep]) + length[keep], length[keep]) + np.arange(length[keep].sum())]
        self._put([words[i] for i in keep.tolist()], ids, length[keep])

    def _put(self, words: list[bytes], ids: np.ndarray, lengths: np.ndarray) -> None:
        k, n = len(self.index), len(words)
        while k + n > len(self.start):
            self.start, self.length, self.seen = (np.concatenate((x, np.zeros_like(x))) for x in (self.start, self.length, self.seen))
        while self.size + len(ids) > len(self.flat):
            self.flat = np.concatenate((self.flat, np.empty_like(self.flat)))
        self.flat[self.size : self.size + len(ids)] = ids
        self.length[k : k + n] = lengths
        self.start[k : k + n] = self.size + np.cumsum(lengths) - lengths
        self.size += len(ids)
        self.index.update(zip(words, range(k, k + n), strict=True))

    def _learn(self, words: list[bytes]) -> None:
        plain, other = [], []
        for w in words:
            (plain if w.isalpha() or w.decode().isalpha() else other).append(w)
        for lo in range(0, len(plain), 4096):
            part = plain[lo : lo + 4096]
            (found,) = self.tokenizer.encode_batch_fast([b" ".join(part).decode()], add_special_tokens=False)  # without offsets
            ids = np.array(found.ids, np.uint32)
            ends = np.flatnonzero(self.ends[ids]) + 1
            if len(ends) == len(part) and ends[-1] == len(ids):  # one pre-token for each word
                self._put(part, ids, np.diff(ends, prepend=0))
            else:
                other += part
        for lo in range(0, len(other), 4096):
            part = other[lo : lo + 4096]
            found = [e.ids for e in self.tokenizer.encode_batch_fast([w.decode() for w in part], add_special_tokens=False)]
            self._put(part, np.array([i for ids in found for i in ids], np.uint32), np.array([len(ids) for ids in found], np.int64))

    def encode(self, column: pa.Array) -> Iterator[np.ndarray]:
        """The ids of each text, without an end id."""
        if not self.by_word:
            for lo in range(0, len(column), 256):
                texts = [t or "" for t in column.slice(lo, 256).to_pylist()]
                yield from (np.array(e.ids, np.uint32) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False))
            return
        for _, _, data, offsets in kernel.text_slices(column):
            if len(self.index) > CACHE_WORDS:
                self.shrink()
            data, offsets = apart(data, offsets)
            raw = data.tobytes()
            words: list[bytes] = []
            counts = [0]
            for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
                words += raw[a:b].split()
                counts.append(len(words))
            at = np.fromiter(map(self.index.get, words, repeat(-1)), np.int64, len(words))
            missing = np.flatnonzero(at < 0)
            if len(missing):
                new = [words[i] for i in missing.tolist()]
                self._learn(list(dict.fromkeys(new)))
                at[missing] = np.fromiter(map(self.index.__getitem__, new), np.int64, len(new))
            self.seen[: len(self.index)] += np.bincount(at, minlength=len(self.index))
            n = self.length[at]
            ends = np.concatenate(([0], np.cumsum(n)))
            ids = self.flat[np.repeat(self.start[at] - ends[:-1], n) + np.arange(ends[-1])]
            bounds = ends[np.array(counts)].tolist()
            yield from (ids[a:b] for a, b in zip(bounds[:-1], bounds[1:], strict=True))


_SPACE = ~kernel.NOT_SPACE
_ASCII_ALNUM = kernel.ALNUM & (np.arange(256) < 128)
_STOP = np.isin(np.arange(256), [44, 46])


def apart(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower-case A-Z and set off a full stop or comma between an ASCII letter or digit and white space by a space.

    Such a mark is a pre-token of its own anyway, and words without it are met more often. Special tokens are matched
    before lower-casing, so texts with ``<|`` keep their case.
    """
    if b"<|" in data.tobytes():
        return data, offsets
    data = kernel.LOWER[data]
    if len(data) < 3:
        return data, offsets
    at = np.flatnonzero(_STOP[data[1:-1]] & _ASCII_ALNUM[data[:-2]] & _SPACE[data[2:]]) + 1
    at = at[~np.isin(at, offsets)]  # the first character of a text has nothing before it
    return np.insert(data, at, 32), offsets + np.searchsorted(at, offsets)


def _encoder(shared) -> Encoder:
    """The worker's encoder, with the words it knows from earlier tasks."""
    key = hash(shared.value)
    if key not in _encoders:
        _encoders.clear()
        _encoders[key] = Encoder(shared.value)
    return _encoders[key]


def encode_texts(docs: DataFrame, config: str, end_id: int = END_ID) -> DataFrame:
    """(doc_id, n, ids) with ids as little-endian unsigned numbers of ``id_type(config)``; every document ends with end_id."""
    shared = docs.sparkSession.sparkContext.broadcast(config)
    kind = id_type(config)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(shared)
        for batch in batches:
            n, out = [], []
            for ids in encoder.encode(batch.column(1)):
                n.append(len(ids) + 1)
                out.append(np.append(ids, np.uint32(end_id)).astype(kind).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(out, pa.binary())], ["doc_id", "n", "ids"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, n long, ids binary")


def id_type(config: str) -> str:
    spec = json.loads(config)
    top = max([*spec["model"]["vocab"].values(), *(x["id"] for x in spec.get("added_tokens", []))])
    return "<u2" if top < 1 << 16 else "<u4"


def count_ids(encoded: DataFrame, kind: str) -> dict[int, int]:
    """How often each id occurs; one row per id of the vocabulary reaches the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << 16, np.int64)
        for batch in batches:
            column = batch.column(0).cast(pa.large_binary())
            ends = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1, 8 * column.offset)
            size = np.dtype(kind).itemsize
            every = np.frombuffer(column.buffers()[2], kind, int(ends[-1] - ends[0]) // size, int(ends[0])) if ends[-1] else np.zeros(0, kind)
            for lo in range(0, len(every), 1 << 20):
                c = np.bincount(every[lo : lo + (1 << 20)], minlength=len(total))
                total = c + np.pad(total, (0, len(c) - len(total)))
        ids = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(total[ids])], ["id", "c"])

    return dict(encoded.select("ids").mapInArrow(run, "id long, c long").groupBy("id").agg(F.sum("c")).collect())


def code_lengths(counts: dict[int, int], max_bits: int = MAX_BITS) -> dict[int, int]:
    """Bits per id by package-merge: the best prefix code without a code longer than ``max_bits``."""
    order = sorted(counts, key=lambda i: (counts[i], i))
    n = len(order)
    if n > 1 << max_bits:
        raise ValueError(f"{n} ids need more than {max_bits} bits")
    if n <= 1:
        return dict.fromkeys(order, 1)
    leaves = np.array([counts[i] for i in order], np.float64)
    items, is_leaf = leaves, [np.ones(n, bool)]
    for _ in range(max_bits - 1):
        pairs = items[: len(items) // 2 * 2].reshape(-1, 2).sum(axis=1)
        both = np.concatenate((leaves, pairs))
        at = np.argsort(both, kind="stable")
        items = both[at]
        is_leaf.append(at < n)
    bits, take = np.zeros(n, np.int64), 2 * n - 2
    for leaf in reversed(is_leaf):
        k = int(leaf[:take].sum())
        bits[:k] += 1
        take = 2 * (take - k)
    return dict(zip(order, bits.tolist(), strict=True))


class Code:
    """The canonical code of the given lengths: shorter codes first, then smaller ids."""

    def __init__(self, bits: dict[int, int]):
        self.width = max(bits.values(), default=1)
        size = max(bits, default=0) + 1
        self.codes, self.bits = np.zeros(size, np.uint32), np.zeros(size, np.int64)
        self.symbol = np.zeros(1 << self.width, np.uint32)
        self.used = np.zeros(1 << self.width, np.int64)
        code = last = 0
        for i in sorted(bits, key=lambda i: (bits[i], i)):
            code <<= bits[i] - last
            last = bits[i]
            self.codes[i], self.bits[i] = code, last
            span = slice(code << (self.width - last), (code + 1) << (self.width - last))
            self.symbol[span], self.used[span] = i, last
            code += 1

    def pack(self, ids: np.ndarray) -> tuple[np.ndarray, bytes]:
        """(bits between checkpoints, the code bits, first bit first)."""
        n = self.bits[ids]
        ends = np.cumsum(n)
        at = ends - n
        value = self.codes[ids].astype(np.int64) << (24 - (at & 7) - n)
        size = (int(ends[-1]) + 7 >> 3) + 2
        out = np.zeros(size, np.float64)
        for k in range(3):  # bits of different codes never meet, so sums are unions
            out += np.bincount((at >> 3) + k, (value >> (16 - 8 * k)) & 255, size)[:size]
        marks = at[::STRIDE]
        return np.diff(marks, prepend=0).astype("<u2"), out[:-2].astype(np.uint8).tobytes()

    def unpack(self, n: int, steps: np.ndarray, data: bytes) -> np.ndarray:
        b = np.frombuffer(data + bytes(4), np.uint8).astype(np.uint32)
        window = (b[:-3] << 24) | (b[1:-2] << 16) | (b[2:-1] << 8) | b[3:]
        at = np.cumsum(steps.astype(np.int64))
        out = np.empty((STRIDE, len(at)), np.uint32)
        mask, top = (1 << self.width) - 1, len(window) - 1
        for k in range(STRIDE):  # the last lane may run past its ids; what it reads there is cut off
            look = (window[np.minimum(at >> 3, top)] >> (32 - self.width - (at & 7)).astype(np.uint32)) & np.uint32(mask)
            out[k] = self.symbol[look]
            at += self.used[look]
        return out.T.reshape(-1)[:n]


def block(code: Code, doc_ids: list[int | None], lengths: list[int], ids: np.ndarray) -> bytes:
    steps, bits = code.pack(ids)
    body = b"".join([
        MAGIC,
        np.array([len(doc_ids), len(ids), len(bits)], "<u8").tobytes(),
        np.array([x or 0 for x in doc_ids], "<i8").tobytes(),
        np.array([x is None for x in doc_ids], np.uint8).tobytes(),
        np.array(lengths, "<u8").tobytes(),
        steps.tobytes(),
        bits,
    ])
    return body + zlib.crc32(body).to_bytes(4, "little")


def read_block(code: Code, payload: bytes) -> Iterator[tuple[int | None, np.ndarray]]:
    if payload[:4] != MAGIC or zlib.crc32(payload[:-4]) != int.from_bytes(payload[-4:], "little"):
        raise ValueError("damaged block")
    n_docs, n, n_bits = np.frombuffer(payload, "<u8", 3, 4).tolist()
    at = 28
    doc_ids = np.frombuffer(payload, "<i8", n_docs, at).tolist()
    empty = np.frombuffer(payload, np.uint8, n_docs, at + 8 * n_docs).tolist()
    lengths = np.frombuffer(payload, "<u8", n_docs, at + 9 * n_docs).astype(np.int64)
    at += 17 * n_docs
    steps = np.frombuffer(payload, "<u2", -(-n // STRIDE), at)
    at += 2 * len(steps)
    ids = code.unpack(n, steps, payload[at : at + n_bits])
    ends = np.cumsum(lengths)
    for x, none, a, b in zip(doc_ids, empty, (ends - lengths).tolist(), ends.tolist(), strict=True):
        yield None if none else x, ids[a:b]


def write_tokens(docs: DataFrame, tokenizer_file: str, path: str, end_id: int = END_ID) -> None:
    """Encode ``docs`` (doc_id, text) and write the files below ``path``."""
    with open(tokenizer_file, encoding="utf-8") as f:  # read by the driver; executors get its text
        config = f.read()
    spark, kind = docs.sparkSession, id_type(config)
    encoded = cut(encode_texts(docs, config, end_id), "ids")
    bits = code_lengths(count_ids(encoded, kind))
    spark.createDataFrame(list(bits.items()), "id long, bits int").coalesce(1).write.parquet(f"{path}/codebook")
    shared = spark.sparkContext.broadcast(bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code, part = Code(shared.value), TaskContext.get().partitionId()
        start = 0
        held: list[tuple[int | None, np.ndarray]] = []

        def out() -> pa.RecordBatch:
            nonlocal start
            ids = np.concatenate([x for _, x in held])
            payload = block(code, [d for d, _ in held], [len(x) for _, x in held], ids)
            columns = [pa.array([part], pa.int32()), pa.array([start], pa.int64()), pa.array([len(ids)], pa.int64()), pa.array([payload], pa.binary())]
            start += len(ids)
            held.clear()
            return pa.RecordBatch.from_arrays(columns, ["part", "start", "n", "payload"])

        size = 0
        for batch in batches:
            for doc_id, data in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                held.append((doc_id, np.frombuffer(data.as_py(), kind)))
                size += len(held[-1][1])
                if size >= BLOCK_IDS:
                    yield out()
                    size = 0
        if held:
            yield out()

    ordered = encoded.repartitionByRange("doc_id", F.xxhash64("ids")).sortWithinPartitions("doc_id", F.xxhash64("ids"))
    ordered.select("doc_id", "ids").mapInArrow(run, "part int, start long, n long, payload binary").write.parquet(f"{path}/blocks")


def _decoded(spark: SparkSession, path: str, row, kind: pa.DataType, sql: str) -> DataFrame:
    bits = {r["id"]: r["bits"] for r in spark.read.parquet(f"{path}/codebook").collect()}  # one row per id
    shared = spark.sparkContext.broadcast(bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = Code(shared.value)
        for batch in batches:
            for part, at, payload in zip(*(batch.column(c).to_pylist() for c in range(3)), strict=True):
                doc_ids, starts, n, values = [], [], [], []
                for doc_id, ids in read_block(code, payload):
                    doc_ids.append(doc_id)
                    starts.append(at)
                    n.append(len(ids))
                    values.append(row(ids))
                    at += len(ids)
                columns = [pa.array([part] * len(n), pa.int32()), pa.array(doc_ids, pa.int64()), pa.array(starts, pa.int64()), pa.array(n, pa.int64()), pa.array(values, kind)]
                yield pa.RecordBatch.from_arrays(columns, ["part", "doc_id", "at", "n_tokens", "value"])

    blocks = spark.read.parquet(f"{path}/blocks")
    found = blocks.select("part", "start", "payload").mapInArrow(run, f"part int, doc_id long, at long, n_tokens long, value {sql}")
    ranges = blocks.groupBy("part").agg(F.sum("n").alias("_n"))
    before = F.coalesce(F.sum("_n").over(W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    ranges = ranges.select("part", before.alias("_before"))  # one row per range
    out = found.join(F.broadcast(ranges), "part")
    return out.select("doc_id", (F.col("_before") + F.col("at")).alias("start"), "n_tokens", "value")


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids): ids with the end id, start is the number of ids of all documents before."""
    return _decoded(spark, path, lambda ids: ids, pa.list_(pa.int32()), "array<int>").withColumnRenamed("value", "ids")


def read_digests(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32): the CRC of the ids as little-endian unsigned 32-bit numbers."""
    return _decoded(spark, path, lambda ids: zlib.crc32(ids.astype("<u4").tobytes()), pa.int64(), "long").withColumnRenamed("value", "ids_crc32")
