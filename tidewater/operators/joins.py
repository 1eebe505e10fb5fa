"""Joins of two event streams. Columns other than the keys must have different names on the two sides."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.functions.timeexpr import Duration, cell, duration_us, from_micros, micros, spark_duration
from tidewater.operators.windows import assign_window, window_agg
from tidewater.plans.ordered import nearest
from tidewater.plans.skew import DEFAULT, SkewPolicy, bounded_broadcast, full_outer, skew_join

# Up to this many rows per key a plain equi join with a range condition compares few pairs.
SMALL_KEY_ROWS = 1000


def window_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    left_ts: str,
    right_ts: str,
    size: Duration,
    policy: SkewPolicy = DEFAULT,
) -> DataFrame:
    """All pairs of rows with the same key in the same tumbling window."""
    if left.isStreaming or right.isStreaming:
        on = ["_w", *keys]
        joined = _framed_stream(left, left_ts, size).join(_framed_stream(right, right_ts, size), on)
        rest = [c for c in joined.columns if c != "_w"]
        return joined.select(F.col("_w.start").alias("window_start"), F.col("_w.end").alias("window_end"), *rest)
    framed_right = assign_window(right, right_ts, size).drop("window_end")
    return skew_join(assign_window(left, left_ts, size), framed_right, [*keys, "window_start"], policy=policy)


def _framed_stream(df: DataFrame, ts: str, size: Duration) -> DataFrame:
    """Add the window as the only event-time column: a streaming join takes one per side."""
    framed = df.withColumn("_w", F.window(ts, spark_duration(size)))
    return framed.withColumn(ts, from_micros(micros(ts), df, ts))


def window_cogroup(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    left_ts: str,
    right_ts: str,
    size: Duration,
    left_aggs: Sequence[Column],
    right_aggs: Sequence[Column],
) -> DataFrame:
    """Per key and window, aggregates of both sides, also where one side has no rows.

    The sides are tagged rows of one union, aggregated once with map-side combine: no join, no hot group. A row
    carries NULL in the columns of the other side, so count a column rather than rows. Ask for ``collect_list``
    only where groups are known to be small. Streams need a watermark on both time columns.
    """
    sides = [
        left.withColumn("_ts", F.col(left_ts)).drop(left_ts),
        right.withColumn("_ts", F.col(right_ts)).drop(right_ts),
    ]
    both = sides[0].unionByName(sides[1], allowMissingColumns=True)
    return window_agg(both, keys, "_ts", size, [*left_aggs, *right_aggs])


def small_keys(
    left: DataFrame, right: DataFrame, keys: Sequence[str], key_rows: int | None, policy: SkewPolicy
) -> bool:
    """Whether no key has many rows on either side; counted unless the bound is known."""
    limit = min(SMALL_KEY_ROWS, policy.rows_per_task)
    if key_rows is not None:
        return key_rows <= limit
    return all((d.groupBy(*keys).count().agg(F.max("count")).first()[0] or 0) <= limit for d in (left, right))


def stream_interval(
    right: DataFrame, keys: Sequence[str], left_ts: str, right_ts: str, lo: int, hi: int
) -> tuple[DataFrame, Column]:
    """The right side with renamed keys, and a join condition from which Spark derives how long to keep state."""
    r = right.select(*[F.col(c).alias(f"_r_{c}") if c in keys else F.col(c) for c in right.columns])
    on = F.expr(
        f"{right_ts} >= {left_ts} + INTERVAL '{lo / 1e6:.6f}' SECOND AND "
        f"{right_ts} <= {left_ts} + INTERVAL '{hi / 1e6:.6f}' SECOND"
    )
    for k in keys:
        on = on & (F.col(k) == F.col(f"_r_{k}"))
    return r, on


def interval_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    left_ts: str,
    right_ts: str,
    low: Duration,
    high: Duration,
    how: str = "inner",
    key_rows: int | None = None,
    policy: SkewPolicy = DEFAULT,
) -> DataFrame:
    """Pairs with the same key and ``left_ts + low <= right_ts <= left_ts + high``; ``how`` is inner or left.

    ``key_rows`` is a known bound on the rows per key of both sides, such as 1 for unique keys; without it the
    rows per key are counted. Where keys are small this is an equi join with a range condition. Otherwise time is cut into buckets of the
    interval's length and the right side is copied to the two or three buckets it can meet, which bounds the
    pairs that are compared; a bucket that is still hot is salted.
    """
    lo, hi = duration_us(low), duration_us(high)
    cond = (micros(right_ts) - micros(left_ts)).between(lo, hi)
    if left.isStreaming or right.isStreaming:
        r, on = stream_interval(right, keys, left_ts, right_ts, lo, hi)
        return left.join(r, on, "inner" if how == "inner" else "left_outer").drop(*[f"_r_{k}" for k in keys])
    if small_keys(left, right, keys, key_rows, policy):
        r = right.select(*[F.col(c).alias(f"_r_{c}") if c in keys else F.col(c) for c in right.columns])
        on = cond
        for k in keys:
            on = on & (F.col(k) == F.col(f"_r_{k}"))
        return left.join(r, on, how).drop(*[f"_r_{k}" for k in keys])
    width = max(hi - lo, 1)
    r_us = micros(right_ts)
    near = F.explode(F.sequence(cell(r_us - F.lit(hi), width), cell(r_us - F.lit(lo), width)))
    a = left.withColumn("_bucket", cell(micros(left_ts), width))
    b = right.select("*", near.alias("_bucket"))
    return skew_join(a, b, [*keys, "_bucket"], how, cond, policy).drop("_bucket")


def history_join(
    left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner", policy: SkewPolicy = DEFAULT
) -> DataFrame:
    """Each row meets all rows of the same key on the other side, over the whole history (inner or full)."""
    if how == "inner":
        return skew_join(left, right, keys, policy=policy)
    return full_outer(left, right, keys, policy)


def rule_pair_match(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    action: str,
    rules: DataFrame,
    rule_order: str | None = None,
    policy: SkewPolicy = DEFAULT,
) -> DataFrame:
    """Rows whose previous action and own action form a rule ``(action1, action2)``.

    With ``rule_order`` only the newest rule holds. Rules are broadcast when their number is small.
    """
    if rule_order is not None:
        newest = rules.agg(F.max(F.struct(rule_order, "action1", "action2")).alias("_r"))
        rules = newest.select("_r.action1", "_r.action2")
    before = nearest(df, keys, order, F.struct(F.col(action).alias("a")), "_prev", policy=policy)
    pairs = before.withColumn("action1", F.col("_prev.a")).withColumn("action2", F.col(action)).drop("_prev")
    wanted = bounded_broadcast(rules.select("action1", "action2").distinct(), policy)
    return pairs.join(wanted, ["action1", "action2"])


def rule_pair_match_asof(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    ts: str,
    action: str,
    versions: DataFrame,
    valid_from: str,
    version: str,
    policy: SkewPolicy = DEFAULT,
) -> DataFrame:
    """Rows whose previous action and own action are those of the rule in force at their time.

    ``versions`` has ``valid_from``, ``version``, ``action1`` and ``action2``: each replaces the one before from its time on, that time
    included; of versions of one time the greatest ``version`` holds. A row before the first version matches nothing, and so does
    one without a time. Versions are carried along in one ordered pass over rows and versions together, so neither side needs to be small.
    Adds ``rule_version``, ``action1`` and ``action2``.
    """
    before = nearest(df, keys, order, F.struct(F.col(action).alias("a")), "_prev", policy=policy)
    rule = F.struct(F.col(version).alias("version"), "action1", "action2")
    changes = versions.select(F.col(valid_from).alias("_at"), F.lit(0).alias("_kind"), F.col(version).cast("bigint").alias("_tie"), rule.alias("_rule"), F.lit(None).cast(before.select(F.struct("*")).schema[0].dataType).alias("_row"))
    rows = before.filter(F.col(ts).isNotNull() & F.col("_prev").isNotNull())
    rows = rows.select(F.col(ts).alias("_at"), F.lit(1).alias("_kind"), F.lit(0).cast("bigint").alias("_tie"), F.lit(None).cast(changes.schema["_rule"].dataType).alias("_rule"), F.struct("*").alias("_row"))
    both = changes.filter(F.col("_at").isNotNull()).unionByName(rows)
    held = nearest(both, [], ["_at", "_kind", "_tie"], F.col("_rule"), "_held", where=F.col("_kind") == 0, policy=policy)
    hit = (F.col("_row._prev.a") == F.col("_held.action1")) & (F.col(f"_row.{action}") == F.col("_held.action2"))
    found = held.filter((F.col("_kind") == 1) & hit)
    return found.select(*[F.col(f"_row.{c}").alias(c) for c in df.columns], F.col("_held.version").alias("rule_version"), "_held.action1", "_held.action2")
