"""Exact deduplication by composable polynomial fingerprints.

A text without its white space, as UTF-8 bytes b[0..n-1], has the fingerprint ``sum(b[i] * X**(n-1-i))`` modulo two
primes, with its length. Chunks are hashed on their own; the fingerprint of two joined parts is
``left * X**len(right) + right``, so the parts of a huge document may be hashed in parallel (``part_fingerprints``,
``join_parts``) and give the fingerprint of the whole. Equal fingerprints are only candidates: their texts are
compared chunk by chunk (``compare``). A chunk is the same in all members of a group when its smallest and its largest
value agree, which needs one row per group, chunk and task, so a group of any size is compared without a hot task.

Of equal texts the row with the most code points stays, then the one with the smallest doc_id.

Cases: NULL counts as empty; all empty texts form one group. Repeated rows are members of their own; of two rows with
the same doc_id and length either is the one that stays, and both are marked kept when they are equal in doc_id. A
NULL doc_id comes after every other. An empty table gives an empty result. Only doc_id and text are read, so extra
columns cannot clash. A text is normalised in one task; its chunks are hashed and sent to comparison one by one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import attach, cut

#: The two fields of the fingerprint: a prime below 2**31 and the point at which the polynomial is evaluated.
FIELDS = ((2147483647, 1103515245), (2147483629, 1664525001))
CHUNK = 1 << 16  # bytes
SPACES = b" \t\n\x0b\x0c\r"


def _table(p: int, x: int, n: int) -> np.ndarray:
    out = np.empty(n, np.uint64)
    v = 1
    for i in range(n):
        out[i] = v
        v = v * x % p
    return out


_POWERS = [_table(p, x, CHUNK)[::-1].copy() for p, x in FIELDS]  # highest first
Fingerprint = tuple[int, int, int]  # bytes, and a value in each field
EMPTY: Fingerprint = (0, 0, 0)


def chunk_fingerprint(data: bytes | memoryview) -> Fingerprint:
    """The fingerprint of at most CHUNK bytes: 8-bit values times 31-bit powers cannot overflow a 64-bit sum."""
    b = np.frombuffer(data, np.uint8).astype(np.uint64)
    n = len(b)
    return n, *[int(np.dot(b, w[CHUNK - n :]) % np.uint64(p)) for (p, _), w in zip(FIELDS, _POWERS, strict=True)]


def combine(left: Fingerprint, right: Fingerprint) -> Fingerprint:
    """The fingerprint of two texts, one after the other."""
    shift = [pow(x, right[0], p) for p, x in FIELDS]
    values = [(a * s + b) % p for a, b, s, (p, _) in zip(left[1:], right[1:], shift, FIELDS, strict=True)]
    return left[0] + right[0], *values


def fingerprint(data: bytes) -> Fingerprint:
    if len(data) <= CHUNK:
        return chunk_fingerprint(data)
    view, out = memoryview(data), EMPTY
    for at in range(0, len(data), CHUNK):
        out = combine(out, chunk_fingerprint(view[at : at + CHUNK]))
    return out


def normalised(text: str | None) -> bytes:
    return (text or "").encode().translate(None, SPACES)


def _key(fp: Fingerprint) -> str:
    return f"{fp[0]:x}.{fp[1]:08x}{fp[2]:08x}"


def fingerprints(docs: DataFrame) -> DataFrame:
    """One row per document row: doc_id, n_chars (code points of the text), text_sha256 and the fingerprint."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, shas, prints = [], [], []
            for text in batch.column(1):
                text = text.as_py()
                data = normalised(text)
                sizes.append(len(text or ""))
                shas.append(hashlib.sha256(data).hexdigest())
                prints.append(_key(fingerprint(data)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), pa.array(shas, pa.string()), pa.array(prints, pa.string())], ["doc_id", "n_chars", "text_sha256", "fingerprint"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {dict(docs.dtypes)['doc_id']}, n_chars long, text_sha256 string, fingerprint string")


def part_fingerprints(parts: DataFrame) -> DataFrame:
    """For documents that are stored as several rows (doc_id, part, text): the fingerprint of each part on its own."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [fingerprint(normalised(t)) for t in batch.column(2).to_pylist()] or [EMPTY]
            columns = [pa.array(c, pa.int64()) for c in zip(*found, strict=True)]
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *columns], ["doc_id", "part", "n", "f0", "f1"])

    kinds = dict(parts.dtypes)
    return parts.select("doc_id", "part", "text").mapInArrow(run, f"doc_id {kinds['doc_id']}, part {kinds['part']}, n long, f0 long, f1 long")


def join_parts(parts: DataFrame) -> DataFrame:
    """(doc_id, fingerprint) of whole documents from ``part_fingerprints``: each part is shifted by the bytes after
    it, after which parts add up in any order, so Spark sums them before the shuffle."""
    from pyspark.sql import Window as W

    later = W.partitionBy("doc_id").orderBy(F.desc("part")).rowsBetween(W.unboundedPreceding, -1)
    after = parts.withColumn("_after", F.coalesce(F.sum("n").over(later), F.lit(0)))

    @F.pandas_udf("struct<f0:long,f1:long>")
    def shifted(f0, f1, n):
        import pandas as pd

        moved = [[a * pow(x, k, p) % p for a, k in zip(f, n, strict=True)] for f, (p, x) in zip((f0, f1), FIELDS, strict=True)]
        return pd.DataFrame({"f0": moved[0], "f1": moved[1]})

    moved = after.select("doc_id", "n", shifted("f0", "f1", "_after").alias("s"))
    sums = moved.groupBy("doc_id").agg(F.sum("n").alias("n"), *[F.sum(f"s.f{i}").alias(f"f{i}") for i in (0, 1)])
    value = [F.lpad(F.lower(F.hex(F.pmod(F.col(f"f{i}"), F.lit(p)))), 8, "0") for i, (p, _) in enumerate(FIELDS)]
    return sums.select("doc_id", F.concat(F.lower(F.hex("n")), F.lit("."), *value).alias("fingerprint"))


def compare(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(fingerprint, same): for the fingerprints in ``wanted`` (fingerprint, doc_id of every member), whether all members
    have the same normalised text. Chunks are compared one by one."""
    ids = wanted.select(F.col("doc_id").alias("_id")).distinct()
    members = docs.select("doc_id", "text").join(ids, F.col("doc_id").eqNullSafe(F.col("_id")), "left_semi")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["fingerprint", "chunk", "data"]
        kinds = [pa.string(), pa.int64(), pa.binary()]
        for batch in batches:
            out: list[list] = [[], [], []]
            for text in batch.column(1):
                data = normalised(text.as_py())
                key = _key(fingerprint(data))
                for at in range(0, max(1, len(data)), CHUNK):
                    for column, v in zip(out, (key, at // CHUNK, data[at : at + CHUNK]), strict=True):
                        column.append(v)
                if len(out[0]) >= 2000:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds, strict=True)], names)
                    out = [[], [], []]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds, strict=True)], names)

    chunks = members.mapInArrow(run, "fingerprint string, chunk long, data binary")
    ends = chunks.groupBy("fingerprint", "chunk").agg(F.min("data").alias("lo"), F.max("data").alias("hi"))
    return ends.groupBy("fingerprint").agg(F.min(F.col("lo") == F.col("hi")).alias("same"))


def group_exact(docs: DataFrame) -> DataFrame:
    """One row per document row: doc_id, keep_id, group_size, kept, text_sha256, fingerprint."""
    prints = cut(fingerprints(docs), "fingerprints")
    total = prints.count()
    sizes = prints.groupBy("fingerprint").agg(F.count(F.lit(1)).alias("_n"))
    several = cut(sizes.filter("_n > 1"), "equal-fingerprints")
    wanted = attach(prints, several, "fingerprint", "_n", total)
    verified = compare(docs, wanted)
    # Different texts under one fingerprint: their group goes on by the digest of the text instead.
    clash = verified.filter(~F.col("same")).select("fingerprint", F.lit(True).alias("_clash"))
    n_clash = clash.count()
    group = F.col("fingerprint")
    if n_clash:
        prints = prints.join(clash, "fingerprint", "left")
        group = F.when(F.col("_clash"), F.col("text_sha256")).otherwise(group)
    prints = prints.withColumn("_group", group).drop("_clash")
    if n_clash:
        prints = cut(prints, "regrouped")
    first = F.min(F.struct((-F.col("n_chars")).alias("_c"), F.col("doc_id").isNull().alias("_z"), F.col("doc_id").alias("_d")))
    best = cut(prints.groupBy("_group").agg(first.alias("_first"), F.count(F.lit(1)).alias("group_size")), "exact-groups")
    out = attach(prints, best, "_group", "group_size", total)
    keep = F.col("_first._d")
    kept = F.col("doc_id").eqNullSafe(keep) & (F.col("n_chars") == -F.col("_first._c"))
    return out.select("doc_id", keep.alias("keep_id"), "group_size", kept.alias("kept"), "text_sha256", "fingerprint")
