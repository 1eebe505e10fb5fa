"""Bursts of failures by timer.

The first failure of a key opens a span of fixed length; failures inside it are counted. A success inside the
span (its last instant included) cancels it. A span that ends with at least ``n`` failures gives one alert, and
the next failure opens the next span. Where a span begins depends on the one before, so this is a fold in order.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.functions.timeexpr import Duration, duration_us, from_micros, micros
from tidewater.plans.ordered import nearest, number_rows
from tidewater.plans.skew import DEFAULT, SkewPolicy
from tidewater.session import shared_dir

# Runs of more failures than this (without a success between) are cut by jumps, not folded in one row.
FOLD_ROWS = 1000


def failure_bursts(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    ts: str,
    failed: Column,
    n: int = 3,
    within: Duration = "2 seconds",
    policy: SkewPolicy = DEFAULT,
    fold_rows: int = FOLD_ROWS,
) -> DataFrame:
    """One row per alert: keys, ``first_ts``, ``last_ts`` and ``times``. The last column of ``order`` is unique
    inside a key."""
    width = duration_us(within)
    slim = df.select(*dict.fromkeys([*keys, *order, ts]), failed.alias("_bad"))
    end = F.struct(micros(ts).alias("t"), F.col(order[-1]).cast("string").alias("id"))
    seen = nearest(slim, keys, order, end, "_ok", ~F.col("_bad"), later=True, policy=policy)
    # The success that ends a run of failures names the run.
    run = [*keys, "_run"]
    fails = seen.filter("_bad").select(
        *keys, F.coalesce("_ok.id", F.lit("")).alias("_run"), F.col("_ok.t").alias("_end"), micros(ts).alias("_t")
    )
    times = fails.groupBy(*run, "_end", "_t").agg(F.count(F.lit(1)).alias("_c"))
    sizes = times.groupBy(*run).agg(F.count(F.lit(1)).alias("_size"))
    if sizes.filter(F.col("_size") > fold_rows).isEmpty():
        found = _fold(times, run, n, width)
    else:
        sized = number_rows(times, run, ["_t"], "_rn", "_size", policy=policy).drop("_rn")
        short = sized.filter(F.col("_size") <= fold_rows).drop("_size")
        long = sized.filter(F.col("_size") > fold_rows).drop("_size")
        found = _fold(short, run, n, width).unionByName(_jump(long, run, n, width, policy))
    return found.select(
        *keys, from_micros(F.col("f"), df, ts).alias("first_ts"), from_micros(F.col("l"), df, ts).alias("last_ts"), "times"
    )


def _fold(times: DataFrame, run: Sequence[str], n: int, width: int) -> DataFrame:
    """Short runs: one array per run, folded by a native expression."""
    runs = times.groupBy(*run, "_end").agg(F.sort_array(F.collect_list(F.struct("_t", "_c"))).alias("_a"))
    span = "named_struct('f', s.f, 'l', s.l, 'n', s.n)"
    spans = f"""aggregate(_a,
        named_struct('f', CAST(NULL AS BIGINT), 'l', CAST(NULL AS BIGINT), 'n', 0L,
                     'd', CAST(array() AS ARRAY<STRUCT<f: BIGINT, l: BIGINT, n: BIGINT>>)),
        (s, x) -> CASE WHEN s.f IS NOT NULL AND x._t <= s.f + {width}
            THEN named_struct('f', s.f, 'l', x._t, 'n', s.n + x._c, 'd', s.d)
            ELSE named_struct('f', x._t, 'l', x._t, 'n', x._c,
                              'd', CASE WHEN s.n >= {n} THEN concat(s.d, array({span})) ELSE s.d END) END,
        s -> CASE WHEN s.n >= {n} AND (_end IS NULL OR _end > s.f + {width})
            THEN concat(s.d, array({span})) ELSE s.d END)"""
    return runs.select(*run[:-1], F.inline(F.expr(spans))).withColumnRenamed("n", "times")


def _on(a: DataFrame, b: DataFrame, pairs: Sequence[tuple[str, str]]) -> Column:
    return reduce(lambda x, y: x & y, [a[p].eqNullSafe(b[q]) for p, q in pairs])


def _jump(times: DataFrame, run: Sequence[str], n: int, width: int, policy: SkewPolicy) -> DataFrame:
    """Long runs: each failure points to the first failure after its span, and the span starts are the failures
    reached from the first one. Pointers are doubled, so a run of m spans takes log2(m) rounds of joins on
    (run, time), which spread evenly however long the run is."""
    shared_dir(times.sparkSession)
    times = times.checkpoint()
    fails = times.select(*run, F.col("_t").alias("_at"), F.lit(0).alias("_probe"), F.col("_t").alias("_of"))
    probes = times.select(
        *run, (F.col("_t") + F.lit(width)).alias("_at"), F.lit(1).alias("_probe"), F.col("_t").alias("_of")
    )
    aimed = nearest(
        fails.unionByName(probes), run, ["_at", "_probe", "_of"], F.struct("_at"), "_to", F.col("_probe") == 0, True, policy
    )
    jumps = aimed.filter("_probe = 1 AND _to IS NOT NULL").select(*run, "_of", F.col("_to._at").alias("_to")).checkpoint()
    starts = times.groupBy(*run).agg(F.min("_t").alias("_s")).checkpoint()
    while not jumps.isEmpty():
        other = jumps.select(*[F.col(c).alias(f"r_{c}") for c in jumps.columns])
        keyed = [(k, f"r_{k}") for k in run]
        reached = starts.join(other, _on(starts, other, [*keyed, ("_s", "r__of")])).select(*run, F.col("r__to").alias("_s"))
        starts = starts.unionByName(reached).checkpoint()
        jumps = jumps.join(other, _on(jumps, other, [*keyed, ("_to", "r__of")])).select(
            *run, "_of", F.col("r__to").alias("_to")
        ).checkpoint()
    marks = starts.select(*[F.col(k).alias(f"r_{k}") for k in run], F.col("_s"))
    marked = times.join(marks, _on(times, marks, [*[(k, f"r_{k}") for k in run], ("_t", "_s")]), "left")
    marked = marked.drop(*[f"r_{k}" for k in run])
    placed = nearest(marked, run, ["_t"], F.struct("_s"), "_p", F.col("_s").isNotNull(), policy=policy)
    spans = placed.withColumn("f", F.coalesce("_s", "_p._s")).groupBy(*run, "_end", "f").agg(
        F.max("_t").alias("l"), F.sum("_c").alias("times")
    )
    live = F.col("_end").isNull() | (F.col("_end") > F.col("f") + F.lit(width))
    return spans.filter((F.col("times") >= n) & live).select(*run[:-1], "f", "l", "times")
