"""Per-key operations in event order that stay correct and balanced when one key holds most rows.

Each operation has one plain form, a window over the key, used for every key that fits a task. Hot keys are
range-partitioned by (key, order) into chunks of about ``rows_per_task`` rows, whatever the spread of keys,
times or ties. The same window runs inside each chunk, and one summary row per (key, chunk) carries the effect
of the earlier chunks. Chunk numbers must not change between the two uses, so the chunks are checkpointed to
the shared folder. The summary has at most (chunks + hot keys) rows.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewater.plans import skew
from tidewater.plans.skew import DEFAULT, HotKeys, SkewPolicy
from tidewater.session import shared_dir

CHUNK = "_chunk"


def _order(order: Sequence[str], newest_first: bool = False) -> list[Column]:
    return [F.desc(c) if newest_first else F.asc(c) for c in order]


def _hot(df: DataFrame, keys: Sequence[str], policy: SkewPolicy) -> HotKeys | None:
    if keys:
        return skew.find_hot_keys(df, keys, policy)
    rows = df.count()
    return HotKeys((), df.limit(0), rows, 1) if rows > policy.rows_per_task else None


def chunked(df: DataFrame, keys: Sequence[str], order: Sequence[str], rows: int, policy: SkewPolicy) -> DataFrame:
    """``df`` cut into contiguous (key, order) ranges, with the number of the range in ``_chunk``."""
    shared_dir(df.sparkSession)
    n = skew.tasks_for(rows, policy)
    ranged = df.repartitionByRange(n, *[F.col(c) for c in (*keys, *order)])
    return ranged.withColumn(CHUNK, F.spark_partition_id()).checkpoint()


def _by_key(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    policy: SkewPolicy,
    plain: Callable[[DataFrame], DataFrame],
    cut: Callable[[DataFrame, HotKeys], DataFrame],
) -> DataFrame:
    hot = _hot(df, keys, policy)
    if hot is None:
        return plain(df)
    if not keys:
        return cut(chunked(df, keys, order, hot.rows, policy), hot)
    cold_rows, hot_rows = skew.split(df, hot)
    return plain(cold_rows).unionByName(cut(chunked(hot_rows, keys, order, hot.rows, policy), hot))


def _with_carry(chunks: DataFrame, carry: DataFrame, keys: Sequence[str], hot: HotKeys, policy: SkewPolicy) -> DataFrame:
    """Join the carry back; it has at most one row per chunk and hot key, so its size is known beforehand."""
    bound = skew.tasks_for(hot.rows, policy) + hot.count
    small = F.broadcast(carry) if bound <= policy.broadcast_rows else carry
    on = [*keys, CHUNK]
    cond = None
    for k in on:
        part = chunks[k].eqNullSafe(small[k])
        cond = part if cond is None else cond & part
    return chunks.join(small, cond, "left").drop(*[small[k] for k in on])


def number_rows(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    out: str = "rn",
    total: str | None = None,
    first_of: str | None = None,
    policy: SkewPolicy = DEFAULT,
) -> DataFrame:
    """Exact 1-based position of each row inside its key; on demand the number of rows of the key as ``total``
    and the value of column ``first_of`` in the key's first row as ``first_<column>``."""
    first_out = f"first_{first_of}"

    def plain(d: DataFrame) -> DataFrame:
        w = Window.partitionBy(*keys)
        by = w.orderBy(*_order(order))
        d = d.withColumn(out, F.row_number().over(by).cast("bigint"))
        if first_of:
            d = d.withColumn(first_out, F.first(first_of).over(by.rowsBetween(Window.unboundedPreceding, 0)))
        return d.withColumn(total, F.count(F.lit(1)).over(w)) if total else d

    def cut(chunks: DataFrame, hot: HotKeys) -> DataFrame:
        inner = Window.partitionBy(*keys, CHUNK).orderBy(*_order(order))
        head = F.min_by(F.struct(first_of), F.struct(*order)) if first_of else F.lit(None)
        sizes = chunks.groupBy(*keys, CHUNK).agg(F.count(F.lit(1)).alias("_n"), head.alias("_head"))
        w = Window.partitionBy(*keys)
        before = w.orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
        carry = sizes.select(
            *keys,
            CHUNK,
            F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"),
            F.sum("_n").over(w).alias("_all_rows"),
            F.first("_head").over(w.orderBy(CHUNK)).alias("_head"),
        )
        d = chunks.withColumn(out, F.row_number().over(inner).cast("bigint"))
        d = _with_carry(d, carry, keys, hot, policy).withColumn(out, F.col(out) + F.col("_before"))
        if total:
            d = d.withColumn(total, F.col("_all_rows"))
        if first_of:
            d = d.withColumn(first_out, F.col(f"_head.{first_of}"))
        return d.drop(CHUNK, "_before", "_all_rows", "_head")

    return _by_key(df, keys, order, policy, plain, cut)


def nearest(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: Column,
    out: str,
    where: Column | None = None,
    later: bool = False,
    policy: SkewPolicy = DEFAULT,
) -> DataFrame:
    """``value`` of the closest earlier (or later) row of the same key that satisfies ``where``.

    ``value`` is best a struct, so that a NULL field is told apart from "no such row". Looking later runs the
    window newest first: the frame then only grows, while one that reaches forward is recomputed per row.
    """
    picked = value if where is None else F.when(where, value)

    def plain(d: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
        w = Window.partitionBy(*keys, *extra).orderBy(*_order(order, later))
        if where is None:
            return d.withColumn(out, F.lag(picked).over(w))
        frame = w.rowsBetween(Window.unboundedPreceding, -1)
        return d.withColumn(out, F.last(picked, ignorenulls=True).over(frame))

    def cut(chunks: DataFrame, hot: HotKeys) -> DataFrame:
        rank = F.struct(*[F.col(c) for c in order])
        edge = F.min_by if later else F.max_by
        cond = F.lit(True) if where is None else where
        ends = chunks.groupBy(*keys, CHUNK).agg(edge(picked, F.when(cond, rank)).alias("_edge"))
        w = Window.partitionBy(*keys).orderBy(F.desc(CHUNK) if later else F.asc(CHUNK))
        frame = w.rowsBetween(Window.unboundedPreceding, -1)
        carry = ends.select(*keys, CHUNK, F.last("_edge", ignorenulls=True).over(frame).alias("_carry"))
        d = _with_carry(plain(chunks, [CHUNK]), carry, keys, hot, policy)
        return d.withColumn(out, F.coalesce(F.col(out), F.col("_carry"))).drop(CHUNK, "_carry")

    return _by_key(df, keys, order, policy, plain, cut)


def running_max(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: Column,
    out: str,
    include_self: bool = True,
    policy: SkewPolicy = DEFAULT,
) -> DataFrame:
    """Largest ``value`` up to each row (or before it). ``keys`` may be empty: the whole stream in order."""
    return running_maxima(df, keys, order, {out: value}, include_self, policy)


def running_maxima(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    values: Mapping[str, Column],
    include_self: bool = True,
    policy: SkewPolicy = DEFAULT,
) -> DataFrame:
    """Several running maxima in one pass: output column to value."""
    end = 0 if include_self else -1

    def plain(d: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
        # With no keys this is one task, reached only when the input is at most ``rows_per_task`` rows.
        w = Window.partitionBy(*keys, *extra).orderBy(*_order(order)).rowsBetween(Window.unboundedPreceding, end)
        return d.select("*", *[F.max(value).over(w).alias(out) for out, value in values.items()])

    def cut(chunks: DataFrame, hot: HotKeys) -> DataFrame:
        tops = chunks.groupBy(*keys, CHUNK).agg(*[F.max(value).alias(f"_top_{out}") for out, value in values.items()])
        frame = Window.partitionBy(*keys).orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
        carry = tops.select(*keys, CHUNK, *[F.max(f"_top_{out}").over(frame).alias(f"_carry_{out}") for out in values])
        d = _with_carry(plain(chunks, [CHUNK]), carry, keys, hot, policy)
        best = [F.greatest(F.col(out), F.col(f"_carry_{out}")).alias(out) if out in values else F.col(out) for out in [*df.columns, *values]]
        return d.select(*best)

    return _by_key(df, keys, order, policy, plain, cut)


def following(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: Column,
    n: int,
    out: str,
    policy: SkewPolicy = DEFAULT,
) -> DataFrame:
    """Array of ``value`` of the row and its ``n`` successors in the key; shorter at the end of the key.

    Hot keys are cut into blocks of equal row count. The first ``n`` rows of a block are also copied to the
    block before, so that every row sees its successors.
    """

    def leads(d: DataFrame, parts: Sequence[str], by: Sequence[str]) -> DataFrame:
        w = Window.partitionBy(*parts).orderBy(*_order(by))
        found = F.array(value, *[F.lead(value, i).over(w) for i in range(1, n + 1)])
        return d.withColumn(out, F.filter(found, lambda x: x.isNotNull()))

    def plain(d: DataFrame) -> DataFrame:
        return leads(d, keys, order)

    hot = _hot(df, keys, policy)
    if hot is None:
        return plain(df)
    cold_rows, hot_rows = skew.split(df, hot) if keys else (None, df)
    block_rows = max(policy.rows_per_task, n + 1)
    numbered = number_rows(hot_rows, keys, order, "_rn", policy=policy).withColumn("_at", F.col("_rn") - 1)
    own = F.call_function("div", F.col("_at"), F.lit(block_rows))
    near_start = (F.pmod(F.col("_at"), F.lit(block_rows)) < n) & (own > 0)
    copied = numbered.withColumn("_own", own).withColumn(
        "_block", F.explode(F.when(near_start, F.array(own, own - 1)).otherwise(F.array(own)))
    )
    done = leads(copied, [*keys, "_block"], ["_rn"]).filter(F.col("_block") == F.col("_own"))
    done = done.drop("_rn", "_at", "_own", "_block")
    return done if cold_rows is None else plain(cold_rows).unionByName(done)
