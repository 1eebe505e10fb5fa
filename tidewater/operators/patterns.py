"""Event patterns per key: strict and relaxed sequences, time limits, timeouts, login and order checks.

Rows of a key are ordered by ``order`` (event time first, then a tie breaker). A time limit is strict:
``last - first < within``.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.functions.timeexpr import Duration, duration_us, micros
from tidewater.operators.topn import top_n
from tidewater.plans.ordered import following, nearest
from tidewater.plans.skew import DEFAULT, SkewPolicy

MATCHED, TIMEOUT = "matched", "timeout"


@dataclass(frozen=True)
class Step:
    name: str
    condition: Column


def times(name: str, condition: Column, n: int) -> list[Step]:
    """``n`` rows in a row that satisfy one condition."""
    return [Step(f"{name}{i + 1}", condition) for i in range(n)]


def match_strict(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    ts: str,
    steps: Sequence[Step],
    within: Duration | None = None,
    policy: SkewPolicy = DEFAULT,
) -> DataFrame:
    """Rows that follow each other directly and satisfy the steps one by one. Overlapping matches are kept.

    Output: keys and one struct of the ``order`` columns per step.
    """
    n = len(steps)
    flags = [s.condition.alias(f"_f{i}") for i, s in enumerate(steps)]
    row = df.select(*dict.fromkeys([*keys, *order, ts]), *flags)
    value = F.struct(ts, *[c for c in order if c != ts], *[f"_f{i}" for i in range(n)])
    seen = following(row, keys, order, value, n - 1, "_next", policy)
    cond = F.size("_next") == n
    for i in range(n):
        cond = cond & F.coalesce(F.get("_next", F.lit(i))[f"_f{i}"], F.lit(False))
    if within is not None:
        span = micros(F.get("_next", F.lit(n - 1))[ts]) - micros(F.get("_next", F.lit(0))[ts])
        cond = cond & (span < F.lit(duration_us(within)))
    at = [
        F.struct(*[F.get("_next", F.lit(i))[c].alias(c) for c in order]).alias(s.name) for i, s in enumerate(steps)
    ]
    return seen.filter(cond).select(*keys, *at)


def match_relaxed(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    ts: str,
    steps: Sequence[Step],
    within: Duration | None = None,
    policy: SkewPolicy = DEFAULT,
) -> DataFrame:
    """Each step is followed, not necessarily directly, by the next one: the nearest later row is taken.

    One row per row that satisfies the first step, with ``status`` matched or timeout and one struct per step
    (NULL where the step did not come in time). Rows that satisfy no step are dropped before the shuffle.
    """
    n = len(steps)
    relevant = F.lit(False)
    for s in steps:
        relevant = relevant | s.condition
    flags = [F.coalesce(s.condition, F.lit(False)).alias(f"_f{i}") for i, s in enumerate(steps)]
    row = df.filter(relevant).select(*dict.fromkeys([*keys, *order, ts]), *flags)
    own = F.struct(*order)
    chain: list[str] = []
    # From the last step back: each pass finds the nearest later row of one step and the chain behind it.
    for i in range(n - 1, 0, -1):
        value = F.struct(own.alias(f"s{i}"), *[F.col(f"_c.s{j}").alias(f"s{j}") for j in range(i + 1, n) if chain])
        row = nearest(row, keys, order, value, "_d", F.col(f"_f{i}"), later=True, policy=policy)
        row = row.drop("_c").withColumnRenamed("_d", "_c")
        chain.append(f"s{i}")
    first = row.filter("_f0")
    last = F.col(f"_c.s{n - 1}")
    ok = last.isNotNull()
    if within is not None:
        ok = ok & (micros(last[ts]) - micros(ts) < F.lit(duration_us(within)))
    ok = F.coalesce(ok, F.lit(False))
    later = [F.when(ok, F.col(f"_c.s{i}")).alias(steps[i].name) for i in range(1, n)]
    status = F.when(ok, F.lit(MATCHED)).otherwise(F.lit(TIMEOUT)).alias("status")
    return first.select(*keys, own.alias(steps[0].name), *later, status)


def click_limit(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], ts: str, limit: int, day_zone: str = "+08:00"
) -> DataFrame:
    """Rows of each key and day up to one past the limit: ``kept`` rows pass, the next one is the ``warning``.

    Later rows carry no output, so each key and day is cut to ``limit + 1`` rows before the shuffle. The day
    starts at midnight of ``day_zone``.
    """
    day = F.to_date(F.from_utc_timestamp(df[ts].cast("timestamp"), day_zone)).alias("day")
    dated = df.select("*", day)
    first = top_n(dated, [*keys, "day"], [F.asc(c) for c in order], limit + 1)
    return first.withColumn("tag", F.when(F.col("rn") <= limit, F.lit("kept")).otherwise(F.lit("warning")))


def order_status(
    df: DataFrame,
    keys: Sequence[str],
    action: str,
    ts: str,
    limit: Duration,
    grace: Duration = "0 seconds",
    created: str = "create",
    paid: str = "pay",
) -> DataFrame:
    """State of each order from its first creation and first payment.

    ``paid`` in time, ``paid_late``, ``created_not_paid``, ``paid_not_created``, and ``pay_first`` when the
    payment comes first by more than ``grace``.
    """
    name = F.lower(F.col(action))
    times_ = df.groupBy(*keys).agg(
        F.min(F.when(name == created, F.col(ts))).alias("create_ts"),
        F.min(F.when(name == paid, F.col(ts))).alias("pay_ts"),
    )
    wait = micros("pay_ts") - micros("create_ts")
    status = (
        F.when(F.col("pay_ts").isNull(), "created_not_paid")
        .when(F.col("create_ts").isNull(), "paid_not_created")
        .when(wait < F.lit(-duration_us(grace)), "pay_first")
        .when(wait < F.lit(duration_us(limit)), "paid")
        .otherwise("paid_late")
    )
    known = F.col("pay_ts").isNotNull() | F.col("create_ts").isNotNull()
    return times_.filter(known).withColumn("status", status)


def last_value_with_ttl(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    ts: str,
    value: str,
    ttl: Duration,
    out: str = "last_value",
    policy: SkewPolicy = DEFAULT,
) -> DataFrame:
    """The state a row finds: the value of the row before, unless ``ttl`` has passed since. Each row renews it."""
    state = F.struct(F.col(ts).alias("t"), F.col(value).alias("v"))
    seen = nearest(df, keys, order, state, "_s", policy=policy)
    live = micros(ts) - micros("_s.t") < F.lit(duration_us(ttl))
    return seen.withColumn(out, F.when(live, F.col("_s.v"))).drop("_s")
