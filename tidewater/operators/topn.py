"""Top-N per group and the reports built on it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewater.functions.timeexpr import Duration
from tidewater.operators.windows import sliding_count, window_count


def top_n(df: DataFrame, partition: Sequence[str], order: Sequence[Column], n: int, out: str = "rn") -> DataFrame:
    """The first ``n`` rows of each partition.

    The filter stands directly on ``row_number``, so Spark keeps only ``n`` rows per group and task before the
    shuffle, and a hot group does not travel.
    """
    w = Window.partitionBy(*partition).orderBy(*order)
    ranked = df.withColumn(out, F.row_number().over(w)).filter(F.col(out) <= n)
    return ranked.withColumn(out, F.col(out).cast("bigint"))


def hot_by_window(
    df: DataFrame,
    key: str,
    ts: str,
    size: Duration,
    slide: Duration,
    n: int,
    closed_until_us: Column | None = None,
) -> DataFrame:
    """Top ``n`` keys by row count of each sliding window; ties go to the smaller key."""
    counts = sliding_count(df, [key], ts, size, slide, closed_until_us=closed_until_us)
    return top_n(counts, ["window_end"], [F.desc("cnt"), F.asc(key)], n).select("window_end", key, "cnt", "rn")


def top_by_tumbling(df: DataFrame, key: str, ts: str, size: Duration, n: int) -> DataFrame:
    counts = window_count(df, [key], ts, size)
    return top_n(counts, ["window_start", "window_end"], [F.desc("cnt"), F.asc(key)], n)


def top_values(df: DataFrame, partition: Sequence[str], value: str, n: int, ties: Sequence[str]) -> DataFrame:
    """Table aggregate: ``n`` rows ``(value, rank)`` per group."""
    best = top_n(df, partition, [F.desc(value), *[F.asc(t) for t in ties]], n, "rank")
    return best.select(*partition, F.col(value).alias("value"), "rank")
