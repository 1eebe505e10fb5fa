"""Changelog streams: a table seen as inserts, retractions and updates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.operators.aggregate import latest_by_key
from tidewater.plans.ordered import number_rows
from tidewater.plans.skew import DEFAULT, SkewPolicy

INSERT, UPDATE_BEFORE, UPDATE_AFTER, DELETE = "+I", "-U", "+U", "-D"


def count_changelog(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], policy: SkewPolicy = DEFAULT
) -> DataFrame:
    """Changelog of a count per key: ``+I`` for the first row, then ``-U`` old and ``+U`` new."""
    slim = df.select(*keys, *order)
    n = number_rows(slim, keys, order, "_n", policy=policy)

    def change(kind: str, count):
        return F.struct(F.lit(kind).alias("row_kind"), count.alias("cnt"))

    changes = F.when(F.col("_n") == 1, F.array(change(INSERT, F.col("_n")))).otherwise(
        F.array(change(UPDATE_BEFORE, F.col("_n") - 1), change(UPDATE_AFTER, F.col("_n")))
    )
    return n.select(*keys, *order, F.inline(changes))


def apply_changelog(df: DataFrame, keys: Sequence[str], order: Sequence[str], kind: str = "row_kind") -> DataFrame:
    """The table a changelog stands for: the newest row per key, unless it was deleted or retracted."""
    newest = latest_by_key(df, keys, order)
    return newest.filter(F.col(kind).isin(INSERT, UPDATE_AFTER)).drop(kind)
