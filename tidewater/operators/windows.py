"""Time windows: tumbling, sliding, session, cumulative. Windows align to the epoch."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewater.functions.timeexpr import Duration, cell, duration_us, from_micros, micros, spark_duration
from tidewater.plans.skew import DEFAULT, SkewPolicy, lookup

BOUNDS = ("window_start", "window_end")


def assign_window(df: DataFrame, ts: str, size: Duration, slide: Duration | None = None) -> DataFrame:
    """Add ``window_start`` and ``window_end``; with ``slide`` the row appears once per window it is in."""
    args = [spark_duration(size)] + ([spark_duration(slide)] if slide else [])
    w = df.withColumn("_w", F.window(ts, *args))
    return w.select(*df.columns, F.col("_w.start").alias("window_start"), F.col("_w.end").alias("window_end"))


def window_agg(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    size: Duration,
    aggs: Sequence[Column],
    slide: Duration | None = None,
) -> DataFrame:
    """Aggregate per key and window, batch or streaming (append mode emits a window once it has closed)."""
    args = [spark_duration(size)] + ([spark_duration(slide)] if slide else [])
    grouped = df.groupBy(F.window(ts, *args).alias("_w"), *keys).agg(*aggs)
    rest = [c for c in grouped.columns if c not in ("_w", *keys)]
    return grouped.select(F.col("_w.start").alias("window_start"), F.col("_w.end").alias("window_end"), *keys, *rest)


def window_count(
    df: DataFrame, keys: Sequence[str], ts: str, size: Duration, slide: Duration | None = None, out: str = "cnt"
) -> DataFrame:
    return window_agg(df, keys, ts, size, [F.count(F.lit(1)).alias(out)], slide)


def salted_count(df: DataFrame, ts: str, size: Duration, spread: str, salts: int = 10, out: str = "cnt") -> DataFrame:
    """Two-phase count per window: partial counts per salt, then their total.

    The salt comes from a column, so a task that is run again deals its rows the same way.
    """
    salted = df.withColumn("_salt", F.pmod(F.xxhash64(spread), F.lit(salts)))
    partial = window_count(salted, ["_salt"], ts, size, out="_n")
    return partial.groupBy(*BOUNDS).agg(F.sum("_n").alias(out))


def _runs_of_ends(
    marks: DataFrame, keys: Sequence[str], first: Column, last: Column, span: int, out: str
) -> DataFrame:
    """Add up counts that each hold for the window ends ``first..last``; one row per key and end.

    A count enters at its first end and leaves after its last. Ends are cut into chunks of ``span`` so that the
    running total is local to a (key, chunk) of bounded size; a count is copied to the one or two chunks it
    reaches, not to each of its windows.
    """
    lo, hi = cell(F.col("_first"), span), cell(F.col("_last"), span)
    parts = marks.select(*keys, "_n", first.alias("_first"), last.alias("_last"))
    parts = parts.select("*", F.explode(F.sequence(lo, hi)).alias("_chunk"))
    stop = (F.col("_chunk") + 1) * F.lit(span)
    enter = F.struct(F.greatest(F.col("_first"), F.col("_chunk") * F.lit(span)).alias("e"), F.col("_n").alias("d"))
    leave = F.struct((F.col("_last") + 1).alias("e"), (-F.col("_n")).alias("d"))
    steps = parts.select(*keys, "_chunk", F.explode(F.array(enter, leave)).alias("_s")).filter(F.col("_s.e") < stop)
    w = Window.partitionBy(*keys, "_chunk").orderBy("_s.e")
    totals = steps.select(
        *keys,
        F.col("_s.e").alias("_from"),
        F.sum("_s.d").over(w.rangeBetween(Window.unboundedPreceding, Window.currentRow)).alias(out),
        F.coalesce(F.lead("_s.e").over(w), stop).alias("_next"),
    )
    live = totals.filter((F.col(out) > 0) & (F.col("_next") > F.col("_from")))
    return live.select(*keys, out, F.explode(F.sequence(F.col("_from"), F.col("_next") - 1)).alias("_end"))


def sliding_count(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    size: Duration,
    slide: Duration,
    out: str = "cnt",
    closed_until_us: Column | None = None,
) -> DataFrame:
    """Sliding count by panes.

    Spark's own sliding window copies each row ``size / slide`` times before it aggregates. Here rows are first
    counted per pane of length ``slide`` (map-side combine), and each pane enters and leaves a running total.
    ``closed_until_us`` is the time up to which windows are already final when the row arrives; the row does
    not count for windows that end at or before it.
    """
    size_us, slide_us = duration_us(size), duration_us(slide)
    if size_us % slide_us:
        raise ValueError("size must be a multiple of slide")
    n = size_us // slide_us
    pane = cell(micros(ts), slide_us).alias("_pane")
    if closed_until_us is None:
        panes = df.groupBy(*keys, pane).agg(F.count(F.lit(1)).alias("_n"))
        first = F.col("_pane") + 1
    else:
        open_ = F.greatest(F.col("_pane"), F.col("_closed")) + 1
        marked = df.select(*keys, pane, cell(closed_until_us, slide_us).alias("_closed"))
        panes = marked.groupBy(*keys, "_pane", open_.alias("_open")).agg(F.count(F.lit(1)).alias("_n"))
        panes = panes.filter(F.col("_open") <= F.col("_pane") + n)
        first = F.col("_open")
    ends = _runs_of_ends(panes, keys, first, F.col("_pane") + n, 4 * n, out)
    end_us = F.col("_end") * F.lit(slide_us)
    return ends.select(
        from_micros(end_us - F.lit(size_us), df, ts).alias("window_start"),
        from_micros(end_us, df, ts).alias("window_end"),
        *keys,
        out,
    )


def cumulate_count(
    df: DataFrame, keys: Sequence[str], ts: str, step: Duration, size: Duration, out: str = "cnt"
) -> DataFrame:
    """Cumulative windows: from the start of each ``size`` window to every ``step`` inside it."""
    size_us, step_us = duration_us(size), duration_us(step)
    if size_us % step_us:
        raise ValueError("size must be a multiple of step")
    n = size_us // step_us
    panes = df.groupBy(*keys, cell(micros(ts), step_us).alias("_pane")).agg(F.count(F.lit(1)).alias("_n"))
    last = (cell(F.col("_pane"), n) + 1) * F.lit(n)
    # Ends 1..n of a window belong to it, so chunks run over end - 1.
    ends = _runs_of_ends(panes, keys, F.col("_pane"), last - 1, n, out)
    end_us = (F.col("_end") + 1) * F.lit(step_us)
    return ends.select(
        from_micros(cell(F.col("_end"), n) * F.lit(size_us), df, ts).alias("window_start"),
        from_micros(end_us, df, ts).alias("window_end"),
        *keys,
        out,
    )


def session_agg(df: DataFrame, keys: Sequence[str], ts: str, gap: Duration, sums: dict[str, Column]) -> DataFrame:
    """Sessions per key: rows at most ``gap`` apart belong together; the session ends ``gap`` after its last row.

    All rows of one epoch-aligned cell of length ``gap`` are in one session, so rows are first aggregated per
    cell. The ordered pass then sees at most one row per key and cell, however many rows a key has.
    """
    gap_us = duration_us(gap)
    us = micros(ts)
    cells = df.groupBy(*keys, cell(us, gap_us).alias("_cell")).agg(
        F.min(us).alias("_lo"),
        F.max(us).alias("_hi"),
        F.count(F.lit(1)).alias("_n"),
        *[F.sum(c).alias(name) for name, c in sums.items()],
    )
    w = Window.partitionBy(*keys).orderBy("_cell")
    prev = F.lag("_hi").over(w)
    marked = cells.withColumn("_new", (prev.isNull() | (F.col("_lo") - prev > F.lit(gap_us))).cast("int"))
    marked = marked.withColumn("_session", F.sum("_new").over(w))
    out = marked.groupBy(*keys, "_session").agg(
        F.min("_lo").alias("_lo"),
        F.max("_hi").alias("_hi"),
        F.sum("_n").alias("cnt"),
        *[F.sum(name).alias(name) for name in sums],
    )
    return out.select(
        *keys,
        from_micros(F.col("_lo"), df, ts).alias("session_start"),
        from_micros(F.col("_hi") + F.lit(gap_us), df, ts).alias("session_end"),
        "cnt",
        *sums,
    )


def session_stream(df: DataFrame, keys: Sequence[str], ts: str, gap: Duration, sums: dict[str, Column]) -> DataFrame:
    """The streaming form, on Spark's session window."""
    grouped = df.groupBy(F.session_window(ts, spark_duration(gap)).alias("_w"), *keys).agg(
        F.count(F.lit(1)).alias("cnt"), *[F.sum(c).alias(name) for name, c in sums.items()]
    )
    return grouped.select(
        *keys, F.col("_w.start").alias("session_start"), F.col("_w.end").alias("session_end"), "cnt", *sums
    )


def keep_newest(
    df: DataFrame, keys: Sequence[str], ts: str, size: Duration, n: int, order: Sequence[str]
) -> DataFrame:
    """Evict all but the newest ``n`` rows of each key and window.

    The filter on ``row_number`` lets Spark cut each group to ``n`` rows before the shuffle.
    """
    framed = assign_window(df, ts, size)
    w = Window.partitionBy(*keys, *BOUNDS).orderBy(*[F.desc(c) for c in order])
    return framed.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= n).drop("_rn")


def keep_last_span(
    df: DataFrame, keys: Sequence[str], ts: str, size: Duration, span: Duration, policy: SkewPolicy = DEFAULT
) -> DataFrame:
    """Evict rows older than ``span`` before the newest row of their key and window."""
    framed = assign_window(df, ts, size)
    on = [*keys, *BOUNDS]
    newest = framed.groupBy(*on).agg(F.max(ts).alias("_newest"))
    joined = lookup(framed, newest, on, policy)
    return joined.filter(micros("_newest") - micros(ts) <= F.lit(duration_us(span))).drop("_newest")
