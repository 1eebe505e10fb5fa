"""Hard negatives by the threshold algorithm of Fagin, Lotem and Naor over per-dimension sorted lists.

Rows in the order of their labels are cut into blocks of ``BLOCK`` candidates, anchors are dealt into chunks of about ``CHUNK``; a
group of a task is one block with one chunk. Inside it every dimension has its candidates sorted by component. For an
anchor each list is read from its top where the anchor's component is positive and from its bottom where it is negative; lists of zero
components add nothing to a score and are not read. A row met for the first time in any list is scored in full, by
integers (random access). The threshold, the score of a row that would stand at the present place of every list, bounds
the scores of all rows not yet met. Reading stops once it lies strictly below the k-th score of every window, or, where a
window has fewer than k rows yet, strictly below the lower end of that window; and where all rows of the block have been
met. Lists are read in steps that grow by a quarter, so an anchor reads at most that much further than it must.

The first run finds the positives: the ``positives`` best other rows of the anchor's label, in the blocks where that label lies. The
second finds, in all blocks with another label, the ``negatives`` best rows of each window
``low * positive <= 100 * score <= high * positive``. A block gives at most k rows per window, which are merged by rank.

Cases: rows with a NULL label, NULL vector, or NULL or non-finite component take no part. Equal rows count once. "Other"
rows are those with another id; rows of one id with different contents are rows of their own, as anchors too. A NULL id is never
an anchor and comes last among ties. Shorter vectors are padded with zeros, an empty vector scores zero everywhere. The
window of a negative positive is empty; that of zero holds the scores zero. A score that does not fit a long raises an
ArithmeticError. An empty table gives no rows. Further columns are left out.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.llm.common import cut, running_total

BLOCK = 16_384  # candidates a task sorts
CHUNK = 4_096  # anchors a task serves
SCALE = 256
FIRST = 64  # entries of each list in the first step
EXACT = 1 << 53  # integers below are exact as doubles
POSITIVES, NEGATIVES = 5, 10
LOW, HIGH = 30, 90  # percent of the positive's score


def vectors(df: DataFrame, id_col: str = "vec_id", vector: str = "embedding", label: Column | str = "label", scale: int = SCALE) -> DataFrame:
    """Rows that take part, as (id, label, v): components scaled and floored."""
    label = F.col(label) if isinstance(label, str) else label
    x = F.col(vector)
    bad = F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    whole = F.transform(x, lambda c: F.floor(c.cast("double") * scale).cast("double"))
    out = df.filter(x.isNotNull()).select(F.col(id_col).cast("long").alias("id"), label.cast("long").alias("label"), whole.alias("v"), bad.alias("bad"))
    return out.filter("label IS NOT NULL AND NOT bad").drop("bad")


def relabelled(id_col: str = "vec_id", label: str = "label") -> Column:
    """Every seventh id gets the next of ten labels."""
    return F.when(F.pmod(F.col(id_col), F.lit(7)) == 0, F.pmod(F.col(label) + 1, F.lit(10))).otherwise(F.col(label))


# -- the algorithm inside one block --------------------------------------------------------------------


def matrix(column: pa.ChunkedArray | pa.Array, width: int | None = None) -> np.ndarray:
    """Rows of an array column, padded with zeros to the longest."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    values = column.flatten().to_numpy(zero_copy_only=False)
    sizes = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    width = max(width or 0, int(sizes.max(initial=0)))
    if len(sizes) and (sizes == width).all():
        return values.reshape(len(sizes), width)
    out = np.zeros((len(sizes), width))
    row = np.repeat(np.arange(len(sizes)), sizes)
    out[row, np.arange(len(values)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = values
    return out


def products(m: np.ndarray, v: np.ndarray, most: float) -> np.ndarray:
    """``m @ v`` in integers; ``most`` bounds the absolute sums of products."""
    if most < EXACT:
        return (m @ v).astype(np.int64)
    if most >= 2.0**63:
        raise ArithmeticError("a score does not fit a long")
    return m.astype(np.int64) @ v.astype(np.int64)


@dataclass
class Block:
    """Candidates in the order of their ids, with one list per dimension sorted by component."""

    ids: np.ndarray
    labels: np.ndarray
    m: np.ndarray  # one row per candidate
    lists: np.ndarray  # of each dimension, candidates from the smallest to the largest component
    largest: float

    @classmethod
    def of(cls, ids: np.ndarray, labels: np.ndarray, m: np.ndarray) -> Block:
        order = np.argsort(ids, kind="stable")
        m = np.ascontiguousarray(m[order])
        lists = np.argsort(m, axis=0, kind="stable").T.astype(np.int32)
        return cls(ids[order], labels[order], m, np.ascontiguousarray(lists), float(np.abs(m).max(initial=0)))

    def search(self, anchor: np.ndarray, fit: np.ndarray, lows: Sequence[int | None], highs: Sequence[int | None], k: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """Of each window [low, high] (None: open) the k best (rows, scores) among the rows with ``fit``."""
        n = len(self.ids)
        found = [(np.zeros(0, np.int64), np.zeros(0, np.int64)) for _ in lows]
        seen = np.zeros(n, bool)
        up, down = np.flatnonzero(anchor > 0), np.flatnonzero(anchor < 0)
        signed = np.concatenate([anchor[up], anchor[down]])
        most = float(np.abs(anchor).sum()) * self.largest
        depth = 0
        while depth < n and not seen.all():
            to = min(n, max(FIRST, depth + depth // 4)) if len(signed) else n
            met = np.full(n, to == n)  # at their ends the lists, or none for an anchor of zeros, leave no row out
            met[self.lists[up, n - to : n - depth]] = True
            met[self.lists[down, depth:to]] = True
            fresh = np.flatnonzero(met & ~seen)
            seen[fresh] = True
            fresh = fresh[fit[fresh]]
            scores = products(self.m[fresh], anchor, most)
            found = [_best(*f, fresh, scores, low, high, k) for f, low, high in zip(found, lows, highs, strict=True)]
            depth = to
            at = np.concatenate([self.m[self.lists[up, n - depth], up], self.m[self.lists[down, depth - 1], down]])
            bound = int(products(at[None, :], signed, most)[0])
            if all(_closed(f[1], low, bound, k) for f, low in zip(found, lows, strict=True)):
                break
        return found


def _closed(scores: np.ndarray, low: int | None, bound: int, k: int) -> bool:
    """No row with a score of at most ``bound`` can enter."""
    return bool(len(scores) >= k and bound < scores[-1]) or (low is not None and bound < low)


def _best(rows: np.ndarray, scores: np.ndarray, more: np.ndarray, more_scores: np.ndarray, low: int | None, high: int | None, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Merge k best with further rows; ties go to the smaller row, which has the smaller id."""
    fit = np.ones(len(more), bool)
    if low is not None:
        fit &= more_scores >= low
    if high is not None:
        fit &= more_scores <= high
    if len(scores) >= k:
        fit &= more_scores >= scores[-1]
    if not fit.any():
        return rows, scores
    rows, scores = np.concatenate([rows, more[fit]]), np.concatenate([scores, more_scores[fit]])
    best = np.lexsort((rows, -scores))[:k]
    return rows[best], scores[best]


# -- blocks and anchors ----------------------------------------------------------------------------------


def blocks(items: DataFrame, block_rows: int = BLOCK) -> DataFrame:
    """Cut the distinct rows, in the order of their labels, into blocks: (id, label, v, key, block)."""
    keyed = items.distinct().withColumn("key", F.xxhash64("id", "label", "v"))
    placed = running_total(keyed, [F.col("label"), F.col("key"), F.col("id")], F.lit(1), "vectors")
    return placed.select("id", "label", "v", "key", F.expr(f"_rank div {block_rows}").alias("block"))


def label_blocks(candidates: DataFrame) -> DataFrame:
    """Of each label its first and last block, and those with nothing else: (label, first, last, only_from, only_to)."""
    runs = candidates.groupBy("block", "label").agg(F.lit(1).alias("one"))
    kinds = runs.groupBy("block").agg(F.count("one").alias("kinds"))
    own = runs.join(kinds, "block")
    single = F.when(F.col("kinds") == 1, F.col("block"))
    return own.groupBy("label").agg(F.min("block").alias("first"), F.max("block").alias("last"), F.min(single).alias("only_from"), F.max(single).alias("only_to"))


def _search(candidates: DataFrame, anchors: DataFrame, chunks: int, work: Callable[[Block, pa.Table], Iterator[tuple]], schema: str) -> DataFrame:
    """Run ``work`` on every block with each chunk of its anchors; ``anchors`` has a row per ``block`` to search."""
    names = T.StructType.fromDDL(schema).names
    spread = candidates.withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(chunks - 1).cast("long"))))
    placed = anchors.withColumn("chunk", F.pmod("key", F.lit(chunks)))

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        rows: list[tuple] = []
        if left.num_rows and right.num_rows:
            ids = left["id"].to_pylist()
            last = max((i for i in ids if i is not None), default=0) + 1  # stands for NULL, which comes last
            block = Block.of(np.array([last if i is None else i for i in ids]), left["label"].to_numpy(), matrix(left["v"]))
            rows = list(work(block, right))
            if None in ids:
                at = names.index("other_id")
                rows = [(*r[:at], None, *r[at + 1 :]) if r[at] == last else r for r in rows]
        columns = zip(*rows, strict=True) if rows else [[] for _ in names]
        return pa.Table.from_arrays([pa.array(c, pa.int64()) for c in columns], names=names)

    by = ["block", "chunk"]
    return spread.select(*by, "id", "label", "v").groupBy(*by).cogroup(placed.groupBy(*by)).applyInArrow(run, schema)


def _vectors_of(block: Block, table: pa.Table) -> np.ndarray:
    """The anchors' vectors in the width of the block; what the block's rows lack is zero there."""
    width = block.m.shape[1]
    return matrix(table["v"], width)[:, :width]


def _ranked(found: DataFrame, by: Sequence[str], k: int) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.desc("score"), F.asc_nulls_last("other_id"))
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def mine(
    items: DataFrame,
    is_anchor: Column,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    low: int = LOW,
    high: int = HIGH,
    block_rows: int = BLOCK,
    chunk_rows: int = CHUNK,
) -> DataFrame:
    """Hard negatives of the rows with ``is_anchor`` (an expression over ``id``) among ``items`` (id, label, v).

    Returns anchor_id, positive_id, rank, negative_id, positive_score, negative_score.
    """
    candidates = cut(blocks(items, block_rows), "blocks")
    anchors = candidates.filter(is_anchor & F.col("id").isNotNull()).drop("block").join(label_blocks(candidates), "label")
    anchors = cut(anchors, "anchors")
    chunks = max(1, -(-anchors.count() // chunk_rows))
    last = candidates.agg(F.max("block")).first()[0] or 0

    def nearest(block: Block, table: pa.Table) -> Iterator[tuple]:
        for me, label, key, a in zip(*(table[c].to_pylist() for c in ("id", "label", "key")), _vectors_of(block, table), strict=True):
            ((rows, scores),) = block.search(a, (block.labels == label) & (block.ids != me), [None], [None], positives)
            for r, s in zip(block.ids[rows].tolist(), scores.tolist(), strict=True):
                yield me, key, r, s

    own = anchors.withColumn("block", F.explode(F.sequence("first", "last")))
    best = _ranked(_search(candidates, own, chunks, nearest, "id long, key long, other_id long, score long"), ["id", "key"], positives)
    best = best.groupBy("id", "key").agg(F.array_sort(F.collect_list(F.struct("rank", "other_id", "score"))).alias("p"))
    windows = cut(anchors.join(best, ["id", "key"]), "positives")  # p has at most ``positives`` entries

    def hard(block: Block, table: pa.Table) -> Iterator[tuple]:
        columns = (table[c].to_pylist() for c in ("id", "label", "key", "p"))
        for me, label, key, p, a in zip(*columns, _vectors_of(block, table), strict=True):
            spans = [(x, -(-low * x["score"] // 100), high * x["score"] // 100) for x in p]
            spans = [s for s in spans if s[1] <= s[2]]
            if not spans:
                continue
            found = block.search(a, block.labels != label, [s[1] for s in spans], [s[2] for s in spans], negatives)
            for (x, _, _), (rows, scores) in zip(spans, found, strict=True):
                for r, s in zip(block.ids[rows].tolist(), scores.tolist(), strict=True):
                    yield me, key, x["rank"], x["other_id"], x["score"], r, s

    others = windows.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(last).cast("long")))).filter("only_from IS NULL OR block < only_from OR block > only_to")
    found = _search(candidates, others, chunks, hard, "id long, key long, place long, positive_id long, positive_score long, other_id long, score long")
    out = _ranked(found, ["id", "key", "place", "positive_id", "positive_score"], negatives)
    return out.select(F.col("id").alias("anchor_id"), "positive_id", "rank", F.col("other_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
