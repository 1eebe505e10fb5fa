"""Late data, as seen by a watermark that moves with each row.

Rows arrive in the order of ``order`` (an arrival number first). The watermark before a row is the newest event
time among earlier arrivals minus the allowed disorder. Spark's streaming watermark moves only between
micro-batches; this per-row model is the exact contract, and the batch functions here compute it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewater.functions.timeexpr import Duration, cell, duration_us, from_micros, micros
from tidewater.plans.ordered import running_max, running_maxima
from tidewater.plans.skew import DEFAULT, SkewPolicy, lookup

ON_TIME, LATE_ALLOWED, TOO_LATE = "on_time", "late_allowed", "too_late"


def watermark_trace(
    df: DataFrame, order: Sequence[str], ts: str, delay: Duration, policy: SkewPolicy = DEFAULT
) -> DataFrame:
    """The watermark after each row."""
    seen = running_max(df, [], order, micros(ts), "_top", policy=policy)
    return seen.withColumn("watermark", from_micros(F.col("_top") - F.lit(duration_us(delay)), df, ts)).drop("_top")


def watermark_of_sources(
    df: DataFrame,
    order: Sequence[str],
    source: str,
    sources: Sequence[object],
    ts: str,
    delay: Duration,
    clock: str,
    idle_after: int,
    policy: SkewPolicy = DEFAULT,
) -> DataFrame:
    """The watermark after each row where several sources have one of their own.

    A source's watermark is its newest event time; that of the whole is the smallest among the sources that are not idle, less the
    delay. A source is idle when its last row, or without one the first row of all, lies more than ``idle_after`` units of ``clock``
    (an arrival number or time) back. A source that has sent nothing and is not idle holds the watermark back, as do
    sources that are all idle; it never falls. ``sources`` are few and known; all their maxima come from one ordered pass,
    and the falls are taken out by a second. Rows of other sources move nothing.
    """
    tops = {f"_top{i}": F.when(F.col(source) == F.lit(s), micros(ts)) for i, s in enumerate(sources)}
    seen = {f"_seen{i}": F.when(F.col(source) == F.lit(s), F.col(clock)) for i, s in enumerate(sources)}
    rows = running_maxima(df, [], order, {**tops, **seen, "_start": -F.col(clock)}, policy=policy)
    never = F.lit(-(1 << 62)).cast("bigint")
    live = []
    for i in range(len(sources)):
        is_live = F.col(clock) - F.coalesce(F.col(f"_seen{i}"), -F.col("_start")) <= F.lit(idle_after)
        live.append(F.when(is_live, F.coalesce(F.col(f"_top{i}"), never)))
    lowest = F.least(*live) if len(live) > 1 else live[0]  # NULLs, that is idle sources, are passed over
    rows = rows.withColumn("_lowest", F.when(lowest > never, lowest)).drop(*tops, *seen, "_start")
    rows = running_max(rows, [], order, F.col("_lowest"), "_top", policy=policy)
    return rows.withColumn("watermark", from_micros(F.col("_top") - F.lit(duration_us(delay)), df, ts)).drop("_top", "_lowest")


def _watermark_before(
    df: DataFrame, order: Sequence[str], ts: str, delay: Duration, policy: SkewPolicy
) -> DataFrame:
    seen = running_max(df, [], order, micros(ts), "_top", include_self=False, policy=policy)
    return seen.withColumn("_wm", F.col("_top") - F.lit(duration_us(delay))).drop("_top")


def last_window_end(ts: str, size: Duration, slide: Duration | None = None) -> Column:
    """End of the last window that holds the row, in microseconds."""
    step = duration_us(slide or size)
    return cell(micros(ts), step) * F.lit(step) + F.lit(duration_us(size))


def late_status(
    df: DataFrame,
    order: Sequence[str],
    ts: str,
    delay: Duration,
    size: Duration,
    lateness: Duration = "0 seconds",
    slide: Duration | None = None,
    newest_before_us: int | None = None,
    policy: SkewPolicy = DEFAULT,
) -> DataFrame:
    """``on_time`` while one of the row's windows is open, ``late_allowed`` while one still takes corrections,
    ``too_late`` after that: such rows form the late-data output. ``newest_before_us`` is the newest event time
    of the rows that arrived before ``df``."""
    seen = _watermark_before(df, order, ts, delay, policy)
    if newest_before_us is not None:
        earlier = F.lit(newest_before_us - duration_us(delay))
        seen = seen.withColumn("_wm", F.greatest(F.col("_wm"), earlier))
    end = last_window_end(ts, size, slide)
    status = (
        F.when(F.col("_wm").isNull() | (end > F.col("_wm")), F.lit(ON_TIME))
        .when(end + F.lit(duration_us(lateness)) > F.col("_wm"), F.lit(LATE_ALLOWED))
        .otherwise(F.lit(TOO_LATE))
    )
    return seen.withColumn("status", status).drop("_wm")


def closed_until(
    df: DataFrame,
    order: Sequence[str],
    ts: str,
    delay: Duration,
    lateness: Duration,
    out: str = "closed_us",
    policy: SkewPolicy = DEFAULT,
) -> DataFrame:
    """The time up to which windows are final when the row arrives, for sliding counts that drop late rows;
    NULL before the first watermark, when every window is open."""
    seen = _watermark_before(df, order, ts, delay, policy)
    return seen.withColumn(out, F.col("_wm") - F.lit(duration_us(lateness))).drop("_wm")


def periodic_count(
    df: DataFrame, keys: Sequence[str], ts: str, period: Duration, policy: SkewPolicy = DEFAULT
) -> DataFrame:
    """From the first row of a key on, every ``period``: the number of its rows so far.

    Rows are first counted per (key, tick), so the ordered pass has at most one row per key and tick. Ticks end
    with the newest event time of the data.
    """
    p = duration_us(period)
    slim = df.select(*keys, micros(ts).alias("_us"))
    end_us = slim.agg(F.max("_us")).first()[0]
    first = slim.groupBy(*keys).agg(F.min("_us").alias("_first"))
    based = lookup(slim, first, keys, policy)
    tick = cell(F.col("_us") - F.col("_first") + F.lit(p - 1), p)
    counts = based.groupBy(*keys, "_first", tick.alias("_tick")).agg(F.count(F.lit(1)).alias("_n"))
    w = Window.partitionBy(*keys).orderBy("_tick")
    stop = cell(F.lit(end_us).cast("bigint") - F.col("_first"), p) + 1
    runs = counts.select(
        *keys,
        "_first",
        F.greatest(F.col("_tick"), F.lit(1)).alias("_from"),
        F.sum("_n").over(w).alias("cnt"),
        F.coalesce(F.lead("_tick").over(w), stop).alias("_next"),
    ).filter(F.col("_next") > F.col("_from"))
    ticks = runs.select(*keys, "_first", "cnt", F.explode(F.sequence(F.col("_from"), F.col("_next") - 1)).alias("_k"))
    return ticks.select(*keys, from_micros(F.col("_first") + F.col("_k") * F.lit(p), df, ts).alias("tick"), "cnt")
