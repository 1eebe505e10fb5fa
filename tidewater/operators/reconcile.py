"""Two-sided reconciliation: matched rows and the unmatched rows of each side."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.functions.timeexpr import Duration, duration_us, micros
from tidewater.operators.joins import SMALL_KEY_ROWS, interval_join, small_keys, stream_interval
from tidewater.plans.skew import DEFAULT, SkewPolicy

MATCHED, LEFT_ONLY, RIGHT_ONLY = "matched", "left_only", "right_only"


def reconcile(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    left_ts: str,
    right_ts: str,
    left_wait: Duration,
    right_wait: Duration,
    tags: tuple[str, str, str] = (MATCHED, LEFT_ONLY, RIGHT_ONLY),
    key_rows: int | None = None,
    policy: SkewPolicy = DEFAULT,
) -> DataFrame:
    """Match on key while ``-right_wait <= right_ts - left_ts <= left_wait``; ``tag`` names the outcome.
    ``key_rows`` is a known bound on the rows per key, as in :func:`interval_join`.

    Where keys are small this is one full outer join. A full outer join cannot split a hot key, so otherwise
    the matches come from a bucketed, salted left join and the unmatched right rows from its mirror image.
    """
    lo, hi = -duration_us(right_wait), duration_us(left_wait)
    if left.isStreaming or right.isStreaming:
        r, on = stream_interval(right, keys, left_ts, right_ts, lo, hi)
        return _tagged(left.join(r, on, "full_outer"), left, right, keys, left_ts, right_ts, tags)
    if small_keys(left, right, keys, key_rows, policy):
        r = right.select(*[F.col(c).alias(f"_r_{c}") if c in keys else F.col(c) for c in right.columns])
        on = reduce(lambda a, b: a & b, [F.col(k) == F.col(f"_r_{k}") for k in keys])
        on = on & (micros(right_ts) - micros(left_ts)).between(lo, hi)
        return _tagged(left.join(r, on, "full"), left, right, keys, left_ts, right_ts, tags)
    low, high = f"{lo} microseconds", f"{hi} microseconds"
    found = interval_join(left, right, keys, left_ts, right_ts, low, high, "left", SMALL_KEY_ROWS + 1, policy)
    back = interval_join(
        right, left, keys, right_ts, left_ts, f"{-hi} microseconds", f"{-lo} microseconds", "left",
        SMALL_KEY_ROWS + 1, policy,
    )
    missing = back.filter(F.col(left_ts).isNull())
    return _tagged(found.unionByName(missing), left, right, [], left_ts, right_ts, tags)


def _tagged(
    joined: DataFrame,
    left: DataFrame,
    right: DataFrame,
    renamed: Sequence[str],
    left_ts: str,
    right_ts: str,
    tags: tuple[str, str, str],
) -> DataFrame:
    """Name the outcome; the keys in ``renamed`` still stand once per side."""
    tag = (
        F.when(F.col(right_ts).isNull(), F.lit(tags[1]))
        .when(F.col(left_ts).isNull(), F.lit(tags[2]))
        .otherwise(F.lit(tags[0]))
    )
    both = [F.coalesce(F.col(c), F.col(f"_r_{c}")).alias(c) if c in renamed else F.col(c) for c in left.columns]
    rest = [c for c in right.columns if c not in left.columns]
    return joined.select(*both, *rest, tag.alias("tag"))
