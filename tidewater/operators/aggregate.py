"""Keyed and windowed aggregates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.functions.aggregates import mean_time_ms
from tidewater.functions.text import bitmap_slot
from tidewater.functions.timeexpr import Duration, cell, duration_us, from_micros, micros, spark_duration, whole_div
from tidewater.operators.windows import BOUNDS, assign_window, window_agg
from tidewater.plans.ordered import number_rows, running_max
from tidewater.plans.skew import DEFAULT, SkewPolicy


def latest_by_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The newest whole row of each key. An aggregate, so rows are combined before the shuffle."""
    rest = [c for c in df.columns if c not in keys]
    best = F.max_by(F.struct(*rest), F.struct(*order)).alias("_r")
    return df.groupBy(*keys).agg(best).select(*keys, *[F.col(f"_r.{c}").alias(c) for c in rest])


def most_active(df: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """The key with most rows; among equals the one whose last row is newest."""
    per_key = df.groupBy(key).agg(F.count(F.lit(1)).alias("cnt"), F.max(F.struct(*order)).alias("_last"))
    best = per_key.agg(F.max(F.struct("cnt", "_last", key)).alias("_b"))
    return best.select(F.col(f"_b.{key}").alias(key), F.col("_b.cnt").alias("cnt"))


def most_active_running(
    df: DataFrame, key: str, order: Sequence[str], policy: SkewPolicy = DEFAULT
) -> DataFrame:
    """After each row: the key with most rows so far, and its count; among equals the newest.

    Counts run per key, then a running maximum runs over the whole stream, cut into ranges of ``order``.
    """
    counted = number_rows(df.select(key, *order), [key], order, "_n", policy=policy)
    best = F.struct(F.col("_n").alias("n"), *order, F.col(key).alias("k"))
    top = running_max(counted, [], order, best, "_b", policy=policy)
    return top.select(*order, F.col("_b.k").alias(f"top_{key}"), F.col("_b.n").alias("cnt"))


def running_count(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], out: str = "cnt", policy: SkewPolicy = DEFAULT
) -> DataFrame:
    """Rows of the key so far, after each row."""
    return number_rows(df, keys, order, out, policy=policy)


def mean_time(df: DataFrame, keys: Sequence[str], ts: str, size: Duration) -> DataFrame:
    """Mean event time per key and window, to the millisecond."""
    size_us = duration_us(size)
    start_us = cell(micros(ts), size_us) * F.lit(size_us)
    start_ms = whole_div(start_us, F.lit(1000))
    mean = df.groupBy(start_us.alias("_start"), *keys).agg(mean_time_ms(ts, start_ms).alias("_off"))
    at = F.col("_start") + F.col("_off") * F.lit(1000)
    return mean.select(
        from_micros(F.col("_start"), df, ts).alias("window_start"),
        from_micros(F.col("_start") + F.lit(size_us), df, ts).alias("window_end"),
        *keys,
        from_micros(at, df, ts).alias("avg_ts"),
    )


def pv_uv(df: DataFrame, user: str, ts: str, size: Duration) -> DataFrame:
    """Views, visitors and their ratio per window.

    Rows are first reduced to one per (window, user), spread by both, and only those are added up per window.
    """
    per_user = window_agg(df, [user], ts, size, [F.count(F.lit(1)).alias("_n")])
    totals = per_user.groupBy(*BOUNDS).agg(F.sum("_n").alias("pv"), F.count(user).alias("uv"))
    return totals.withColumn("ratio", F.col("pv").cast("double") / F.nullif(F.col("uv"), F.lit(0)))


def unique_count(df: DataFrame, keys: Sequence[str], value: str, ts: str, size: Duration, out: str = "uv") -> DataFrame:
    """Distinct values per key and window; spread by (key, window, value) before the final count."""
    seen = window_agg(df, [*keys, value], ts, size, [F.count(F.lit(1)).alias("_n")])
    return seen.groupBy(*BOUNDS, *keys).agg(F.count(value).alias(out))


def unique_count_stream(df: DataFrame, value: str, ts: str, size: Duration, out: str = "uv") -> DataFrame:
    """Streaming form of :func:`unique_count` without keys.

    State is one entry per (window, value), spread over tasks, and one count per window; both go when the
    watermark passes the window.
    """
    framed = df.select(F.window(ts, spark_duration(size)).alias("_w"), value)
    counts = framed.dropDuplicates(["_w", value]).groupBy("_w").agg(F.count(value).alias(out))
    return counts.select(F.col("_w.start").alias("window_start"), F.col("_w.end").alias("window_end"), out)


def unique_count_bitmap(
    df: DataFrame, value: str, ts: str, size: Duration, bits: int = 1 << 29, seed: int = 61, out: str = "uv"
) -> DataFrame:
    """Unique count through a hashed bitmap: values that share a slot count once."""
    slots = df.select(ts, bitmap_slot(F.col(value).cast("string"), bits, seed).alias("_slot"))
    return unique_count(slots, [], "_slot", ts, size, out)


def unique_count_sketch(df: DataFrame, value: str, ts: str, size: Duration, out: str = "uv") -> DataFrame:
    """Unique count by a HyperLogLog sketch per window; the sketch merges over windows with ``hll_union_agg``."""
    sketch = window_agg(df, [], ts, size, [F.hll_sketch_agg(value).alias("sketch")])
    return sketch.withColumn(out, F.hll_sketch_estimate("sketch"))


def unique_running(
    df: DataFrame, value: str, ts: str, seq: str, size: Duration, out: str = "uv", policy: SkewPolicy = DEFAULT
) -> DataFrame:
    """After each first visit inside a window: the number of distinct values so far."""
    framed = assign_window(df, ts, size)
    first = framed.groupBy(*BOUNDS, value).agg(F.min(F.struct(ts, seq)).alias("_f"))
    first = first.select(*BOUNDS, value, F.col(f"_f.{ts}").alias(ts), F.col(f"_f.{seq}").alias(seq))
    return number_rows(first, list(BOUNDS), [ts, seq], out, policy=policy)


def every_n_mean_time(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], ts: str, n: int, policy: SkewPolicy = DEFAULT
) -> DataFrame:
    """Each ``n``-th row of a key closes a batch and emits its mean event time; an open rest emits nothing."""
    slim = df.select(*dict.fromkeys([*keys, *order, ts]))
    numbered = number_rows(slim, keys, order, "_rn", policy=policy)
    ms = whole_div(micros(ts), F.lit(1000))
    batches = numbered.groupBy(*keys, cell(F.col("_rn") - 1, n).alias("batch")).agg(
        F.count(F.lit(1)).alias("_n"), F.sum(ms).alias("_ms")
    )
    full = batches.filter(F.col("_n") == n)
    return full.select(*keys, "batch", from_micros(whole_div(F.col("_ms"), F.lit(n)) * 1000, df, ts).alias("avg_ts"))


def complete_batches(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], n: int, policy: SkewPolicy = DEFAULT
) -> DataFrame:
    """Number the batches of ``n`` rows per key; ``complete`` is false for the rest that is still buffered."""
    numbered = number_rows(df, keys, order, "_rn", "_total", policy=policy)
    batch = cell(F.col("_rn") - 1, n)
    done = batch < cell(F.col("_total"), n)
    return numbered.withColumn("batch_id", batch).withColumn("complete", done).drop("_rn", "_total")


def keyed_state(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], first_of: str, policy: SkewPolicy = DEFAULT
) -> DataFrame:
    """Per row, what keyed state holds after it: the list length, the count in the map, the reduced row (the
    first row's ``first_of`` with the newest time), and the formatted aggregate."""
    out = number_rows(df, keys, order, "list_size", first_of=first_of, policy=policy)
    return out.withColumn("map_count", F.col("list_size")).withColumn(
        "agg_result", F.concat(F.lit("result "), F.col("list_size").cast("string"))
    )
