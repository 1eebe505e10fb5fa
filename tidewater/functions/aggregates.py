"""Aggregate expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidewater.functions.timeexpr import micros, whole_div


def weighted_avg(value: Column, weight: Column) -> Column:
    """``sum(value * weight) / sum(weight)`` in whole numbers; NULL when the weights add up to 0."""
    return whole_div(F.sum(value * weight), F.nullif(F.sum(weight), F.lit(0)))


def mean_time_ms(ts: str | Column, base_ms: Column) -> Column:
    """Mean event time in whole milliseconds. Times are summed from ``base_ms`` on, so the sum stays small."""
    ms = whole_div(micros(ts), F.lit(1000))
    return whole_div(F.sum(ms - base_ms), F.count(F.lit(1)))
