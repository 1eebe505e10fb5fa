"""Event-time arithmetic in whole microseconds."""

from __future__ import annotations

import datetime as dt

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Duration = str | dt.timedelta


def duration_us(d: Duration) -> int:
    """Length of ``"1 hour"``, ``"5 minutes"`` or a timedelta in microseconds."""
    return pd.Timedelta(d).value // 1000


def spark_duration(d: Duration) -> str:
    return f"{duration_us(d)} microseconds"


def micros(ts: str | Column) -> Column:
    """Epoch microseconds of a timestamp with or without zone (the session runs in UTC)."""
    col = F.col(ts) if isinstance(ts, str) else ts
    return F.unix_micros(col.cast("timestamp"))


def from_micros(us: Column, df: DataFrame, ts: str) -> Column:
    """Timestamp of the same type as column ``ts`` of ``df``."""
    return F.timestamp_micros(us).cast(df.schema[ts].dataType)


def cell(us: Column, width: int) -> Column:
    """Index of the epoch-aligned cell of ``width`` microseconds, in whole-number arithmetic."""
    # ``div`` cuts towards zero; taking the remainder off first makes it a floor.
    return whole_div(us - F.pmod(us, F.lit(width)), F.lit(width))


def whole_div(a: Column, b: Column) -> Column:
    """Whole-number division, cut towards zero."""
    return F.call_function("div", a, b)


def seconds_to_ts(sec: Column) -> Column:
    return F.timestamp_seconds(sec)


def millis_to_ts(ms: Column) -> Column:
    return F.timestamp_millis(ms)


def whole_second_ts(ms: Column) -> Column:
    """Timestamp of epoch milliseconds cut to the second."""
    return F.timestamp_seconds(cell(ms, 1000))
