"""Hot keys: finding them, and joins that split them.

A key is *hot* when it holds more rows than one task should sort. Hot keys are found by one aggregation with
map-side combine. Their number is bounded by what they are: no more than all rows divided by ``rows_per_task``. The
number of pieces they are cut into has the same bound, and no key is left out.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.session import shared_dir


@dataclass(frozen=True)
class SkewPolicy:
    """Limits for one task. ``even_keys`` states that no key is hot, and saves the count."""

    rows_per_task: int = 5_000_000
    broadcast_rows: int = 200_000
    even_keys: bool = False


DEFAULT = SkewPolicy()


@dataclass(frozen=True)
class HotKeys:
    keys: tuple[str, ...]
    table: DataFrame  # keys + _rows, a local relation
    rows: int
    count: int


def find_hot_keys(df: DataFrame, keys: Sequence[str], policy: SkewPolicy = DEFAULT) -> HotKeys | None:
    """The hot keys of ``df`` or None. Runs one aggregation over the key columns only."""
    if policy.even_keys:
        return None
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
    biggest = counts.filter(F.col("_rows") > policy.rows_per_task)
    rows = biggest.collect()
    if not rows:
        return None
    table = df.sparkSession.createDataFrame(rows, biggest.schema)
    return HotKeys(tuple(keys), table, sum(r["_rows"] for r in rows), len(rows))


def _same(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [left[k].eqNullSafe(right[k]) for k in keys])


def split(df: DataFrame, hot: HotKeys) -> tuple[DataFrame, DataFrame]:
    """Rows of cold keys and rows of hot keys; the hot table is bounded, so it is broadcast."""
    table = F.broadcast(hot.table.select(*hot.keys))
    cond = _same(df, table, hot.keys)
    return df.join(table, cond, "left_anti"), df.join(table, cond, "left_semi")


def bounded_broadcast(df: DataFrame, policy: SkewPolicy = DEFAULT) -> DataFrame:
    """Mark ``df`` for broadcast when it has at most ``broadcast_rows`` rows, else leave the choice to Spark."""
    return F.broadcast(df) if df.limit(policy.broadcast_rows + 1).count() <= policy.broadcast_rows else df


def _salts(hot: HotKeys, policy: SkewPolicy) -> DataFrame:
    n = F.ceil(F.col("_rows") / F.lit(policy.rows_per_task))
    return hot.table.select(*hot.keys, n.cast("int").alias("_salts"))


def skew_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    how: str = "inner",
    condition: Column | None = None,
    policy: SkewPolicy = DEFAULT,
) -> DataFrame:
    """Equi join on ``keys`` (columns of both sides) for ``how`` in inner / left, hot keys split over tasks.

    Only ``keys`` may appear on both sides. With hot keys the rows of the left side are dealt to salts and
    the right rows of the same keys are copied to each of them; for an inner join right keys that are hot are
    dealt out as well, so each pair still meets exactly once. The salt is a hash of the row, so that a task that
    is run again deals its rows the same way; rows should carry an id, as equal rows share a salt.
    """
    assert how in ("inner", "left")
    hot_left = find_hot_keys(left, keys, policy)
    hot_right = find_hot_keys(right, keys, policy)
    if how == "left" and hot_right is not None:
        return _left_of_hot(left, right, keys, condition, hot_right, policy)
    if hot_left is None and hot_right is None:
        return _equi(left, right, list(keys), how, condition)
    left, right = _deal(left, right, hot_left, keys, "_ls", policy)
    right, left = _deal(right, left, hot_right, keys, "_rs", policy)
    joined = _equi(left, right, [*keys, "_ls", "_rs"], how, condition)
    return joined.drop("_ls", "_rs")


def _left_of_hot(
    left: DataFrame, right: DataFrame, keys: Sequence[str], condition: Column | None, hot: HotKeys, policy: SkewPolicy
) -> DataFrame:
    """Left join where right keys are hot: their rows meet in a salted inner join, then left rows without a partner follow."""
    shared_dir(left.sparkSession)
    cold_left, hot_left = split(left, hot)
    cold_right, hot_right = split(right, hot)
    out = skew_join(cold_left, cold_right, keys, "left", condition, policy)
    hot_left = hot_left.withColumn("_row", F.monotonically_increasing_id()).checkpoint()  # ids must not change
    pairs = skew_join(hot_left, hot_right, keys, "inner", condition, policy)
    rest = hot_left.join(pairs.select("_row").distinct(), "_row", "left_anti").drop("_row")
    out = out.unionByName(pairs.drop("_row")).unionByName(rest, allowMissingColumns=True)
    return out


def _equi(left: DataFrame, right: DataFrame, keys: list[str], how: str, condition: Column | None) -> DataFrame:
    if condition is None:
        return left.join(right, keys, how)
    r = right.select(*[F.col(k).alias(f"_r_{k}") if k in keys else F.col(k) for k in right.columns])
    cond = reduce(lambda a, b: a & b, [F.col(k) == F.col(f"_r_{k}") for k in keys])
    return left.join(r, cond & condition, how).drop(*[f"_r_{k}" for k in keys])


def _deal(
    side: DataFrame, other: DataFrame, hot: HotKeys | None, keys: Sequence[str], salt: str, policy: SkewPolicy
) -> tuple[DataFrame, DataFrame]:
    """Give each row of a hot key of ``side`` one salt, and copy the matching rows of ``other`` to all salts."""
    if hot is None:
        return side.withColumn(salt, F.lit(0)), other.withColumn(salt, F.lit(0))
    salts = F.broadcast(_salts(hot, policy))
    n = F.coalesce(F.col("_salts"), F.lit(1))
    spread = F.xxhash64(*[side[c] for c in _hashable(side)])
    dealt = side.join(salts, _same(side, salts, keys), "left").select(
        *[side[c] for c in side.columns], F.pmod(spread, n).cast("int").alias(salt)
    )
    copied = other.join(salts, _same(other, salts, keys), "left").select(
        *[other[c] for c in other.columns], F.explode(F.sequence(F.lit(0), n - 1)).alias(salt)
    )
    return dealt, copied


def _hashable(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if not isinstance(f.dataType, (T.MapType, T.VariantType))]


def lookup(big: DataFrame, small: DataFrame, keys: Sequence[str], policy: SkewPolicy = DEFAULT) -> DataFrame:
    """Inner join of ``big`` with ``small`` (one row per key); rows of hot keys do not move.

    The part of ``small`` that belongs to hot keys is as small as their list and is broadcast.
    """

    def match(a: DataFrame, b: DataFrame) -> DataFrame:
        b = b.select(*[F.col(c).alias(f"_k_{c}") if c in keys else F.col(c) for c in b.columns])
        on = reduce(lambda x, y: x & y, [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys])
        return a.join(b, on).drop(*[f"_k_{k}" for k in keys])

    hot = find_hot_keys(big, keys, policy)
    if hot is None:
        return match(big, small)
    cold_rows, hot_rows = split(big, hot)
    hot_small = split(small, hot)[1]
    return match(cold_rows, small).unionByName(match(hot_rows, F.broadcast(hot_small)))


def full_outer(left: DataFrame, right: DataFrame, keys: Sequence[str], policy: SkewPolicy = DEFAULT) -> DataFrame:
    """Full outer equi join that splits hot keys.

    A full outer join cannot be salted on both sides, so hot keys are cut out: those with partners go through
    the salted inner join, and those without are known from the key counts of the other side.
    """
    hots = [h for h in (find_hot_keys(left, keys, policy), find_hot_keys(right, keys, policy)) if h]
    if not hots:
        return left.join(right, list(keys), "full")
    table = reduce(lambda a, b: a.unionByName(b), [h.table.select(*keys) for h in hots]).distinct()
    hot = HotKeys(tuple(keys), table, 0, 0)
    cold_left, hot_left = split(left, hot)
    cold_right, hot_right = split(right, hot)
    out = cold_left.join(cold_right, list(keys), "full").unionByName(
        skew_join(hot_left, hot_right, keys, "inner", policy=policy)
    )
    for side, other in ((hot_left, hot_right), (hot_right, hot_left)):
        partners = F.broadcast(other.select(*keys).distinct())  # at most one row per hot key
        out = out.unionByName(side.join(partners, list(keys), "left_anti"), allowMissingColumns=True)
    return out.select(*keys, *[c for c in left.columns + right.columns if c not in keys])


def tasks_for(rows: int, policy: SkewPolicy) -> int:
    return max(1, math.ceil(rows / policy.rows_per_task))
