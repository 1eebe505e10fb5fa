"""Near-duplicate detection with HyperMinHash sketches, confirmed on full shingle sets.

A document is the set of its distinct five-word shingles. Its sketch has 128 registers: the hashes of a document fall
into 128 buckets, and a register keeps, of the smallest hash of its bucket, the number of leading zeros (6 bits) and the
10 bits after them. A bucket without a hash takes the register of another one, in a fixed random order per bucket, so
that two sets agree in a register with a probability equal to their Jaccard similarity, at any size.

1. Bands: 64 keys of five registers each. Two sets of similarity 0.75 share no key with a probability near 1e-5.
2. Documents with equal sets are one class from here on; a bucket counts only when it holds two different sets. Band keys
   are sorted over ranges, where a key that stands alone is passed over, so each is moved once, with a hash of its set.
3. Sets in such buckets are built again from one text each, which a bit map of bounded size finds where it lies. They get a finer sketch of 2048 registers, of each of which one bit is kept, drawn from the smallest
   hash and the number of the register. Half of what is different agrees by chance; so corrected, the agreement
   estimates the similarity with a standard deviation below 0.018 at 0.75.
4. First pairs: each set takes, of one drawn set of each of its buckets, the one that agrees best; a pair that shares
   several buckets is compared once. Whole registers, corrected
   for those that agree by chance, sort out pairs once more; full sets decide. Links give components. This is done
   twice, with new draws and between components only the second time.
5. Remaining pairs: buckets that still hold several components are compared inside tasks, block against block, each set
   outside the bucket's largest component with all others. A pair passes sizes, fine bits and corrected registers in its
   first common bucket; only sets in such pairs are sent there as a whole, and compared in the same way; a link joins
   the components at once, so a bucket gives at most one link fewer than it has components. Pairs never become rows. A
   bucket full of copies gives none; work in a bucket grows with the square of the components near the threshold, the
   rows moved with its size (and its number of blocks of ``PART`` shingles).
6. The final components are those of all links.

Links between sets of one component that were not compared cannot change a component.

Cases: a NULL or empty text, and one without words, has no shingles and is linked with nothing. With fewer than five words
the whole sequence is the one shingle. Sets, not ids, are the nodes: rows with the same doc_id and different texts have
the component of their own text each. A NULL doc_id is linked with nothing. An empty table gives an empty result. Only
doc_id and text are read. ``one_of_each`` keeps, of rows of one group with the same smallest doc_id, one row.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import cache
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.llm import kernel
from tidewater.llm.common import attach, cut
from tidewater.llm.graph import components

WORDS = 5
PERCENT = 75
BUCKET_BITS = 7
MANTISSA = 10
BANDS = 64
BAND_ROWS = 5
#: The estimate from 128 registers strays by 0.038 at a similarity of 0.75; five times that is let through, and more for
#: small sets, whose registers repeat each other: SMALL / sqrt(shingles).
SLACK, SMALL = 0.19, 0.6
FINE_BITS = 11
#: Of the fine estimate at 0.75; four standard deviations are let through.
FINE_DEVIATION, FINE_SIGMAS = 0.018, 4
#: Bytes of text handled at once: words and shingles take some sixty bytes of memory for each.
SLICE = 1 << 18
#: Shingles of a block: its full sets take 16 MB.
PART = 1 << 21
#: Bits of the map of wanted rows: 8 MB. What it lets through by chance is sorted out by a join.
MARKS = 1 << 26

K = 1 << BUCKET_BITS
_random = np.random.default_rng(20240)
_PICKS = np.array([_random.choice(K, BAND_ROWS, replace=False) for _ in range(BANDS)])
TRIES = 24


@cache
def asks(bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Of each of 2**bits buckets: the priority it gives to the others, and the first it asks."""
    priority = np.random.default_rng(bits).random((1 << bits, 1 << bits), np.float32)
    # A few rows at once: the order of all columns takes twice their memory.
    first = np.concatenate([np.argpartition(p, TRIES, axis=1)[:, :TRIES].copy() for p in np.split(priority, 16)])
    order = np.argsort(np.take_along_axis(priority, first, axis=1), axis=1)
    return priority, np.take_along_axis(first, order, axis=1)


def shingle_sets(column: pa.Array) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    for _, _, data, offsets in kernel.text_slices(column, SLICE):
        w = kernel.byte_words(data, offsets, kernel.NOT_SPACE)
        grams = kernel.gram_hashes(w.hashes, WORDS)
        for a, b in zip(w.first[:-1].tolist(), w.first[1:].tolist(), strict=True):
            if b - a >= WORDS:
                s = np.sort(grams[a : b - WORDS + 1])
                yield s[np.concatenate(([True], s[1:] != s[:-1]))]
            elif b > a:
                yield kernel.gram_hashes(w.hashes[a:b], b - a)
            else:
                yield np.zeros(0, np.uint64)


def smallest(s: np.ndarray, bits: int) -> np.ndarray:
    """The smallest hash in each of 2**bits buckets of a sorted set; an empty bucket has that of the first full one in
    its own fixed order of all buckets."""
    k = 1 << bits
    at = np.searchsorted(s, np.arange(k, dtype=np.uint64) << np.uint64(64 - bits))
    full = at < np.append(at[1:], len(s))
    out = np.empty(k, np.uint64)
    out[full] = s[at[full]]
    empty, lender = np.flatnonzero(~full), np.flatnonzero(full)
    if len(empty):
        priority, first = asks(bits)
        if len(lender) > 64:
            asked = first[empty]
            good = full[asked]
            found = good.any(axis=1)
            out[empty[found]] = out[asked[found, good[found].argmax(axis=1)]]
            empty = empty[~found]
        if len(empty):
            out[empty] = out[lender[np.argmin(priority[np.ix_(empty, lender)], axis=1)]]
    return out


def registers(s: np.ndarray) -> np.ndarray:
    """The HyperMinHash sketch of a sorted set with at least one hash."""
    v = smallest(s, BUCKET_BITS) << np.uint64(BUCKET_BITS)
    zeros = 64 - np.frexp(v.astype(np.float64))[1]  # of a value that rounds up to a power of two: one less, always
    zeros = np.clip(zeros, 0, 62).astype(np.uint64)
    rest = (v << (zeros + np.uint64(1))) >> np.uint64(64 - MANTISSA)
    return ((zeros << np.uint64(MANTISSA)) | rest).astype(np.uint16)


def band_keys(sketch: np.ndarray) -> np.ndarray:
    picked = sketch[_PICKS].astype(np.uint64) + np.uint64(1)
    return kernel.mix((picked * kernel.powers(kernel.SHINGLE, BAND_ROWS + 1)[1:]).sum(axis=1) + np.arange(BANDS, dtype=np.uint64) * np.uint64(kernel.BASE)).view(np.int64)


FINE = [f"f{k}" for k in range((1 << FINE_BITS) // 64)]


def fine_bits(s: np.ndarray) -> np.ndarray:
    """One bit of each fine register, 64 in a long."""
    low = smallest(s, FINE_BITS) + np.arange(1 << FINE_BITS, dtype=np.uint64) * np.uint64(kernel.SHINGLE)
    return np.packbits((kernel.mix(low) & np.uint64(1)).astype(np.uint8)).view(np.int64)


def agreement(a: str, b: str) -> Column:
    """Fine registers whose bits differ in columns a_f0 .. and b_f0 .., as the estimated similarity."""
    differ = F.lit(0)
    for m in FINE:
        differ += F.bit_count(F.col(f"{a}_{m}").bitwiseXOR(F.col(f"{b}_{m}")))
    return 1 - differ * (2.0 / (1 << FINE_BITS))  # half of what is different agrees by chance


def may_link(a: str, b: str) -> Column:
    """By sizes and by the fine estimate."""
    n, m = F.col(f"{a}_n"), F.col(f"{b}_n")
    return (100 * F.least(n, m) >= PERCENT * F.greatest(n, m)) & (agreement(a, b) >= PERCENT / 100 - FINE_SIGMAS * FINE_DEVIATION)


def digest(s: np.ndarray) -> bytes:
    return hashlib.blake2b(s.tobytes(), digest_size=16).digest()


def sketches(docs: DataFrame, *carried: str) -> DataFrame:
    """One row per document row: doc_id, n_shingles, digest (of the full set), bands, and the ``carried`` columns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, digests, bands = [], [], []
            for s in shingle_sets(batch.column(1)):
                n.append(len(s))
                digests.append(digest(s))
                bands.append(band_keys(registers(s)) if len(s) else None)
            made = [pa.array(n, pa.int64()), pa.array(digests, pa.binary()), pa.array(bands, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays([batch.column(0), *made, *batch.columns[2:]], ["doc_id", "n_shingles", "digest", "bands", *carried])

    kinds = dict(docs.dtypes)
    more = "".join(f", {c} {kinds[c]}" for c in carried)
    return docs.select("doc_id", "text", *carried).mapInArrow(run, f"doc_id {kinds['doc_id']}, n_shingles long, digest binary, bands array<long>{more}")


def marked(rows: DataFrame, wanted: DataFrame, *keys: str) -> DataFrame:
    """The ``rows`` with ``keys`` of ``wanted`` (one row for each), NULL keys left out; what is not wanted mostly stays where it is.

    Hashes of the wanted keys make a bit map, which is broadcast; the join after it moves only what passes.
    """
    spot = F.pmod(F.xxhash64(*keys), F.lit(MARKS))
    bits = F.bitmap_construct_agg(F.bitmap_bit_position(spot)).alias("_bits")
    marks = wanted.groupBy(F.bitmap_bucket_number(spot).alias("_bucket")).agg(bits)
    near = rows.withColumn("_bucket", F.bitmap_bucket_number(spot)).join(F.broadcast(marks), "_bucket")
    at = F.bitmap_bit_position(spot)
    byte = F.conv(F.hex(F.substring("_bits", F.shiftright(at, 3).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    near = near.filter(F.getbit(byte, at.bitwiseAND(7).cast("int")) == 1)
    return near.join(wanted, list(keys)).select(rows.columns)  # Spark would move a semi join below the bit map


def full_sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(node, n, sketch, shingles, f0 ..) of the texts of ``docs`` (doc_id, _text, text) that are ``wanted`` (doc_id, _text, one row for
    each): digest, sketch, full set, fine sketch. ``_text`` tells the texts of one doc_id apart."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 500):
                sets = [s for s in shingle_sets(batch.slice(lo, 500).column(0)) if len(s)]
                if not sets:
                    continue
                fine = [pa.array(c) for c in np.array([fine_bits(s) for s in sets]).T.copy()]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([digest(s) for s in sets], pa.binary()),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array([registers(s).tobytes() for s in sets], pa.binary()),
                        pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64())),
                        *fine,
                    ],
                    ["node", "n", "sketch", "shingles", *FINE],
                )

    kind = "node binary, n long, sketch binary, shingles array<long>, " + ", ".join(f"{f} long" for f in FINE)
    once = marked(docs.select("doc_id", "_text", "text"), wanted, "doc_id", "_text").dropDuplicates(["doc_id", "_text"])
    return once.select("text").mapInArrow(run, kind)


def chance(n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """The probability that registers of two sets without a common element agree, for set sizes n and m."""
    zeros = np.arange(0, 58)
    tail = [1 - (1 - 2.0**-zeros[None, :]) ** np.maximum(1.0, x / K)[:, None] for x in (n, m)]
    exact = [t - np.append(t[:, 1:], np.zeros((len(t), 1)), axis=1) for t in tail]
    return (exact[0] * exact[1]).sum(axis=1) / (1 << MANTISSA)


def likely(x: np.ndarray, y: np.ndarray, n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Whether sketches (rows of registers) of sets of sizes n and m make the similarity likely, corrected for chance."""
    by_chance = chance(n, m)
    est = ((x == y).mean(axis=1) - by_chance) / (1 - by_chance)
    return est >= PERCENT / 100 - SLACK - SMALL / np.sqrt(np.minimum(n, m))


def estimated(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) of sets (node, n, sketch) that are ``likely``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x, y = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint16).reshape(-1, K) for c in ("sa", "sb"))
            good = pa.array(likely(x, y, *(batch.column(c).to_numpy(zero_copy_only=False) for c in ("na", "nb"))))
            yield pa.RecordBatch.from_arrays([batch.column("a").filter(good), batch.column("b").filter(good)], ["a", "b"])

    one = sets.select(F.col("node").alias("a"), F.col("n").alias("na"), F.col("sketch").alias("sa"))
    other = sets.select(F.col("node").alias("b"), F.col("n").alias("nb"), F.col("sketch").alias("sb"))
    both = pairs.join(one, "a").join(other, "b").select("a", "b", "na", "nb", "sa", "sb")
    return both.mapInArrow(run, "a binary, b binary")


def confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) whose full sets (node, shingles) have the similarity. ``pairs`` are read more than once and should be cut."""
    one = marked(sets.select(F.col("node").alias("a"), F.col("shingles").alias("xa")), pairs.select("a").distinct(), "a")
    other = marked(sets.select(F.col("node").alias("b"), F.col("shingles").alias("xb")), pairs.select("b").distinct(), "b")
    both = pairs.join(one, "a").join(other, "b")
    same = F.size(F.array_intersect("xa", "xb"))
    return both.filter(100 * same >= PERCENT * (F.size("xa") + F.size("xb") - same)).select("a", "b")


def shared(rows: DataFrame) -> DataFrame:
    """Of rows (key, d), sorted by both inside each partition, those with a neighbour of the same key and another d, once each. The
    first and the last row of a partition, whose neighbours are elsewhere, always stay."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        give = lambda x: pa.RecordBatch.from_arrays([pa.array(c) for c in x], ["key", "d"])
        held, stays = np.empty((2, 0), np.int64), True
        for batch in batches:
            if not batch.num_rows:
                continue
            x = np.concatenate([held, np.stack([batch.column(c).to_numpy() for c in ("key", "d")])], axis=1)
            x = x[:, np.append(True, (x[:, 1:] != x[:, :-1]).any(axis=0))]
            met = x[0, 1:] == x[0, :-1]
            good = np.append(False, met) | np.append(met, False)
            good[0] |= stays
            held, stays = x[:, -1:], bool(good[-1])
            yield give(x[:, :-1][:, good[:-1]])
        if held.size:
            yield give(held)

    return rows.mapInArrow(run, "key long, d long")


def bucket_members(known: DataFrame, classes: DataFrame) -> DataFrame:
    """(key, node, n): the different sets in every bucket that holds at least two, and a few that are alone; node is the digest of a set.

    The keys of copies differ in doc_id, so that many copies lie in many ranges.
    """
    d = F.xxhash64("digest").alias("d")  # tells the sets of one bucket apart
    order = ["key", "d", "doc_id"]
    rows = known.select(F.explode("bands").alias("key"), d, "doc_id").repartitionByRange(*order).sortWithinPartitions(*order)
    sets = classes.select(d, F.col("digest").alias("node"), "n")
    return shared(rows.select("key", "d")).distinct().join(sets, "d").select("key", "node", "n")


def best_heads(members: DataFrame, sets: DataFrame, total: int, draw: int) -> DataFrame:
    """For each set the one it agrees with best among the heads of its buckets: (a, b), at most one per b.

    A head is drawn from the sets of a bucket by hash, anew for each ``draw``. ``members`` (key, node, comp) has a
    component for each set; heads of the same component are left out.
    """
    heads = members.groupBy("key").agg(
        F.min(F.struct(F.xxhash64("node", F.lit(draw)).alias("lot"), "node", "comp")).alias("h"),
        F.count(F.lit(1)).alias("_n"), F.min("comp").alias("_lo"), F.max("comp").alias("_hi"),
    )
    heads = heads.filter("_lo != _hi").select("key", "_n", F.col("h.node").alias("a"), F.col("h.comp").alias("a_comp"))
    met = attach(members.select("key", F.col("node").alias("b"), "comp"), cut(heads, "bucket-heads"), "key", "_n", total)
    met = cut(met.filter("a_comp != comp").select("a", "b").distinct(), "head-meetings")
    side = lambda name: sets.select(F.col("node").alias(name), *[F.col(c).alias(f"{name}_{c}") for c in ("n", *FINE)])
    drawn = cut(met.groupBy("a").agg(F.count(F.lit(1)).alias("_n")).join(side("a"), "a"), "drawn-sets")
    pairs = attach(met, drawn, "a", "_n", met.count()).join(side("b"), "b").filter(may_link("a", "b"))
    best = pairs.groupBy("b").agg(F.min(F.struct((-agreement("a", "b")).alias("s"), "a")).alias("x"))
    return best.select(F.col("x.a").alias("a"), "b")


class Block:
    """Bucket members as arrays, one entry (row) for each."""

    def __init__(self, node, comp, main, block, n, sketch, fine, shingles):
        self.node, self.comp, self.main, self.block, self.n, self.sketch, self.fine, self.shingles = node, comp, main, block, n, sketch, fine, shingles

    @staticmethod
    def of(batch: pa.RecordBatch) -> Block:
        get = lambda c: batch.column(c).to_numpy(zero_copy_only=False)
        sets: list[np.ndarray | None] = [None] * batch.num_rows
        if "shingles" in batch.schema.names:
            values, ends = batch.column("shingles").values.to_numpy().view(np.uint64), batch.column("shingles").offsets.to_numpy()
            sets = [values[a:b] for a, b in pairwise(ends.tolist())]
        return Block(
            batch.column("node").to_pylist(), batch.column("comp").to_pylist(), get("main"), get("block"), get("n"),
            np.frombuffer(b"".join(batch.column("sketch").to_pylist()), np.uint16).reshape(-1, K),
            np.stack([get(f).view(np.uint64) for f in FINE], axis=1), sets,
        )

    def rows(self, a: int, b: int) -> Block:
        return Block(*(x[a:b] for x in vars(self).values()))

    @staticmethod
    def joined(parts: list[Block]) -> Block:
        if len(parts) == 1:
            return parts[0]
        columns = zip(*(vars(p).values() for p in parts), strict=True)
        return Block(*([y for x in c for y in x] if isinstance(c[0], list) else np.concatenate(c) for c in columns))

    def pairs(self, key: int, i: int, k: int) -> Iterator[tuple[int, int]]:
        """Rows of block i outside the main component with rows of block k that may be linked and meet in no smaller bucket."""
        right = np.flatnonzero(self.block == k)
        bands: dict[int, np.ndarray] = {}
        for x in np.flatnonzero((self.block == i) & ~self.main).tolist():
            y = right[self.main[right] | (right > x)] if i == k else right
            n, m = self.n[x], self.n[y]
            y = y[100 * np.minimum(n, m) >= PERCENT * np.maximum(n, m)]
            differ = np.bitwise_count(self.fine[y] ^ self.fine[x]).sum(axis=1, dtype=np.int64)
            y = y[1 - differ * (2.0 / (1 << FINE_BITS)) >= PERCENT / 100 - FINE_SIGMAS * FINE_DEVIATION]
            if len(y):
                y = y[likely(self.sketch[y], self.sketch[x], self.n[y], np.full(len(y), n))]
            for z in y.tolist():
                if self.comp[x] == self.comp[z]:
                    continue
                for at in (x, z):
                    if at not in bands:
                        bands[at] = band_keys(self.sketch[at])
                if bands[x][bands[x] == bands[z]].min(initial=key) == key:
                    yield x, z

    def candidates(self, *mark: int) -> Iterator[tuple]:
        """(key, i, k, block, main, node, comp) of the rows in any of ``pairs``."""
        for x in sorted({x for pair in self.pairs(*mark) for x in pair}):
            yield (*mark, int(self.block[x]), bool(self.main[x]), self.node[x], self.comp[x])

    def links(self, *mark: int) -> Iterator[tuple]:
        """The (node, node) of ``pairs`` whose full sets have the similarity, as far as they join components."""
        root = {c: c for c in self.comp}

        def find(c: bytes) -> bytes:
            while root[c] != c:
                root[c] = root[root[c]]
                c = root[c]
            return c

        for x, z in self.pairs(*mark):
            a, b = find(self.comp[x]), find(self.comp[z])
            if a != b:
                same = len(np.intersect1d(self.shingles[x], self.shingles[z], assume_unique=True))
                if 100 * same >= PERCENT * (int(self.n[x]) + int(self.n[z]) - same):
                    root[max(a, b)] = min(a, b)
                    yield self.node[x], self.node[z]


MARKED = ["key", "i", "k", "block", "main", "node", "comp"]


def by_block(rows: DataFrame, handle: Callable[..., Iterator[tuple]], names: list[str], kinds: list[pa.DataType], sql: str) -> DataFrame:
    """What ``handle(block, key, i, k)`` gives for the rows of each (key, i, k); ``rows`` has MARKED and sketches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[Block] = []
        mark: tuple[int, ...] = ()

        def out(found: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([f[c] for f in found], kind) for c, kind in enumerate(kinds)], names)

        for batch in batches:
            if not batch.num_rows:
                continue
            found: list[tuple] = []
            ids = np.stack([batch.column(c).to_numpy().astype(np.int64) for c in ("key", "i", "k")])
            begins = np.flatnonzero((ids[:, 1:] != ids[:, :-1]).any(axis=0)) + 1
            every = Block.of(batch)
            for a, b in pairwise([0, *begins.tolist(), batch.num_rows]):
                here = tuple(ids[:, a].tolist())
                if held and here != mark:
                    found += handle(Block.joined(held), *mark)
                    held = []
                mark = here
                held.append(every.rows(a, b))
            yield out(found)
        if held:
            yield out(list(handle(Block.joined(held), *mark)))

    return rows.repartition("key", "i", "k").sortWithinPartitions("key", "i", "k").mapInArrow(run, sql)


def other_links(members: DataFrame, sets: DataFrame) -> DataFrame:
    """Confirmed links (a, b) that join the components inside each bucket; ``members`` has (key, node, n, comp)."""
    shares = members.groupBy("key", "comp").agg(F.count(F.lit(1)).alias("_c"), F.sum("n").alias("_w"))
    largest = F.max(F.struct("_c", "comp", "_w"))
    mixed = shares.groupBy("key").agg(largest.alias("_l"), F.count(F.lit(1)).alias("_k"), F.sum("_c").alias("_n"), F.sum("_w").alias("_w"))
    mixed = mixed.filter("_k > 1").select("key", F.col("_l.comp").alias("_main"), "_n", (F.col("_w") - F.col("_l._w")).alias("_others"), F.col("_l._w").alias("_same"))
    inside = attach(members, cut(mixed, "mixed-buckets"), "key", "_n", members.count())
    # Sets outside the main component lie in blocks 0 .. xs - 1, those of the main component in the blocks after; where
    # all fit one block there is only that. Each block of the first kind meets itself and all blocks after it.
    main, one = F.col("comp") == F.col("_main"), F.col("_others") + F.col("_same") <= PART
    xs = F.when(one, 1).otherwise(F.ceil(F.col("_others") / PART)).cast("int")
    ms = F.when(one, 0).otherwise(F.ceil(F.col("_same") / PART)).cast("int")
    of = lambda count: F.pmod(F.xxhash64("node", F.lit(5)), F.greatest(count, F.lit(1))).cast("int")
    inside = inside.select("key", "node", "comp", main.alias("main"), xs.alias("_xs"), ms.alias("_ms"), F.when(main & ~one, xs + of(ms)).otherwise(of(xs)).alias("block"))
    every = F.sequence(F.lit(0), F.col("_xs") + F.col("_ms") - 1)
    blocks = F.filter(every, lambda j: (j < F.col("_xs")) | (F.col("block") < F.col("_xs")))
    inside = inside.withColumn("_j", F.explode(blocks)).withColumn("i", F.least("block", "_j")).withColumn("k", F.greatest("block", "_j"))
    sketched = inside.select(MARKED).join(sets.select("node", "n", "sketch", *FINE), "node")
    kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.bool_(), pa.binary(), pa.binary()]
    sql = "key long, i int, k int, block int, main boolean, node binary, comp binary"
    met = cut(by_block(sketched, Block.candidates, MARKED, kinds, sql), "candidates")
    # Full sets go only to buckets where they have a candidate.
    found = marked(sets, met.select("node").distinct(), "node")
    return by_block(met.join(found, "node"), Block.links, ["a", "b"], [pa.binary()] * 2, "a binary, b binary")


def in_components(members: DataFrame, comp: DataFrame) -> DataFrame:
    side = comp.select(F.col("node").alias("_node"), F.col("comp").alias("_comp"))
    out = members.join(side, F.col("node") == F.col("_node"), "left")
    return cut(out.select("key", "node", "n", F.coalesce("_comp", "node").alias("comp")), "bucket-components")


def links(docs: DataFrame, known: DataFrame, classes: DataFrame) -> DataFrame:
    """Confirmed links (a, b) between sets (named by their digests) whose components are those of all links."""
    members = cut(bucket_members(known, classes), "bucket-members")
    total = members.count()
    nodes = members.select(F.col("node").alias("digest")).distinct()
    wanted = classes.join(nodes, "digest", "left_semi").select("_rep.doc_id", "_rep._text")
    sets = cut(full_sets(docs, cut(wanted, "wanted-texts")), "sets")
    found, placed = None, members.withColumn("comp", F.col("node"))
    for draw in range(2):
        pairs = estimated(cut(best_heads(placed, sets, total, draw), "head-pairs"), sets)
        new = confirmed(cut(pairs, "likely-pairs"), sets)
        found = cut(new if found is None else found.unionByName(new), "head-links")
        placed = in_components(members, components(found))
    return found.unionByName(other_links(placed, sets))


def grouped(docs: DataFrame, *carried: str) -> DataFrame:
    """One row per document row: doc_id, n_shingles, component_id, kept, the ``carried`` columns, and comp, which names the
    component also where an id has several texts."""
    docs = docs.withColumn("_text", F.xxhash64("text"))  # tells the texts of one doc_id apart
    sk = cut(sketches(docs, "_text", *carried), "near-sketches")
    known = sk.filter("n_shingles > 0 AND doc_id IS NOT NULL")
    first = F.min(F.struct("doc_id", "_text")).alias("_rep")
    classes = cut(known.groupBy("digest").agg(first, F.min("n_shingles").alias("n"), F.count(F.lit(1)).alias("_n")), "near-sets")
    comp = components(links(docs, known, classes))
    classes = classes.withColumn("_rep", F.col("_rep.doc_id"))
    named = cut(comp.join(classes.withColumnRenamed("digest", "node"), "node").select("node", "comp", "_rep"), "named-sets")
    least = cut(named.groupBy("comp").agg(F.min("_rep").alias("component_id"), F.count(F.lit(1)).alias("_n")), "component-ids")
    side = attach(named.select("node", "comp"), least, "comp", "_n", named.count()).select("node", "comp", "component_id")
    classes = classes.join(side, F.col("digest") == F.col("node"), "left")
    classes = classes.select("digest", F.coalesce("component_id", "_rep").alias("component_id"), F.coalesce("comp", "digest").alias("comp"), "_n")
    out = attach(known.select("doc_id", "n_shingles", "digest", *carried), cut(classes, "near-classes"), "digest", "_n", known.count())
    alone = sk.filter("n_shingles = 0 OR doc_id IS NULL").withColumn("component_id", F.col("doc_id")).withColumn("comp", F.lit(None).cast("binary"))
    names = ["doc_id", "n_shingles", "component_id", "comp", *carried]
    return out.select(names).unionByName(alone.select(names)).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def group_near(docs: DataFrame) -> DataFrame:
    """One row per document row: doc_id, n_shingles, component_id, kept (doc_id = component_id)."""
    return grouped(docs).drop("comp")


def one_of_each(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each group of near-duplicates; rows that are linked with nothing stay.

    The row with the smallest doc_id stays; of several such rows that with the smallest hash of its text, of equal texts any one.
    """
    key = F.xxhash64("text")  # tells the texts of one doc_id apart
    found = cut(grouped(docs.select("doc_id", "text", key.alias("_key")), "_key").filter("comp IS NOT NULL"), "near-groups")
    found = found.withColumnRenamed("doc_id", "_id")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), F.col("doc_id").alias("_id"), key.alias("_key"))
    rows = rows.join(found.filter("NOT kept").select("_id", "_key").distinct(), ["_id", "_key"], "left_anti")
    kept = found.filter("kept")
    twice = kept.groupBy("_id", "comp").agg(F.min("_key").alias("_best"), F.count(F.lit(1)).alias("_n")).filter("_n > 1")
    twice = cut(twice, "near-repeated")
    if twice.take(1):
        worse = kept.join(twice, ["_id", "comp"]).filter("_key <> _best").select("_id", "_key").distinct()
        best = twice.select("_id", F.col("_best").alias("_key"))
        again = rows.join(best, ["_id", "_key"]).groupBy("_id", "_key").agg(F.first("_row").alias("_row"))
        rows = rows.join(worse.unionByName(best), ["_id", "_key"], "left_anti").select("_row").unionByName(again.select("_row"))
    return rows.select("_row.*")
