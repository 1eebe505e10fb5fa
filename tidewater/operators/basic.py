"""Projections, predicates, routing, union and partitioning."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from functools import reduce
from typing import Any

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.functions.text import java_hash, not_blank, split_words


def fields_to_rows(df: DataFrame, columns: Sequence[str | Column], out: str = "field") -> DataFrame:
    """One row per listed field, as text."""
    cols = [F.col(c) if isinstance(c, str) else c for c in columns]
    return df.select(F.explode(F.array(*[c.cast("string") for c in cols])).alias(out))


def word_pairs(df: DataFrame, value: str = "value") -> DataFrame:
    """``(word, 1)`` for each blank-separated word."""
    return df.select(F.explode(F.split(value, " ")).alias("word"), F.lit(1).cast("bigint").alias("one"))


def keep_non_blank(df: DataFrame, column: str) -> DataFrame:
    return df.filter(not_blank(F.col(column)))


def route(df: DataFrame, rules: Mapping[str, Column], default: str = "rest", tag: str = "tag") -> DataFrame:
    """Tag each row with the first rule it satisfies; read an output back with :func:`output`."""
    cases = None
    for name, cond in rules.items():
        cases = F.when(cond, F.lit(name)) if cases is None else cases.when(cond, F.lit(name))
    return df.withColumn(tag, F.lit(default) if cases is None else cases.otherwise(F.lit(default)))


def output(df: DataFrame, name: str, tag: str = "tag") -> DataFrame:
    return df.filter(F.col(tag) == name).drop(tag)


def union_all(streams: Sequence[DataFrame]) -> DataFrame:
    """Bag union by column name."""
    return reduce(DataFrame.unionByName, streams)


def connect(sides: Mapping[str, tuple[DataFrame, Sequence[Column]]], origin: str = "origin") -> DataFrame:
    """Map streams of different types to one schema each, and union them with the name of their side."""
    return union_all([df.select(F.lit(name).alias(origin), *columns) for name, (df, columns) in sides.items()])


def split_to_rows(df: DataFrame, column: str, sep_regex: str = "[?]") -> DataFrame:
    """Lateral split: the row once per part, with ``word`` and its ``length``."""
    words = df.select("*", F.explode(split_words(F.col(column), sep_regex)).alias("word"))
    return words.withColumn("length", F.length("word"))


def key_range_scan(
    df: DataFrame, key: str, low: str, high: str, columns: Sequence[str], out: str = "row"
) -> DataFrame:
    """Rows with ``low <= key < high``, flattened to the key followed by its values joined with ``_``.

    The bounds are plain comparisons on the column, so they reach the row-group statistics of sorted files.
    """
    values = F.concat_ws("_", *[F.col(c).cast("string") for c in columns])
    return df.filter((F.col(key) >= low) & (F.col(key) < high)).select(key, F.concat(F.col(key), values).alias(out))


def rich_map(
    df: DataFrame,
    function: Callable[[Any, pd.DataFrame], pd.DataFrame],
    schema: str,
    open_: Callable[[], Any] = lambda: None,
    close: Callable[[Any], None] = lambda resource: None,
) -> DataFrame:
    """Map Arrow batches with a resource that each task opens once and closes at its end.

    For work that needs a client or a model; plain expressions stay in Spark.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        resource = open_()
        try:
            for batch in batches:
                yield function(resource, batch)
        finally:
            close(resource)

    return df.mapInPandas(run, schema)


def partition_id(key: Column, n: int) -> Column:
    """Partition number from the hash of the key."""
    return F.abs(java_hash(key.cast("string")) % n).cast("int")


def partition_by_hash(df: DataFrame, key: str, n: int, out: str = "pid") -> DataFrame:
    """Send each row to the partition its hash names."""
    return df.withColumn(out, partition_id(F.col(key), n)).repartitionById(n, F.col(out))


def partition_by_bounds(df: DataFrame, column: str, bounds: Sequence[float], out: str = "pid") -> DataFrame:
    """Send value ranges to partitions: below the first bound to 0, from the last bound on to ``len(bounds)``."""
    pid = reduce(lambda a, b: a + b, [(F.col(column) >= b).cast("int") for b in bounds])
    return df.withColumn(out, pid).repartitionById(len(bounds) + 1, F.col(out))


def spread_evenly(df: DataFrame, n: int) -> DataFrame:
    """Deal rows to ``n`` partitions in turn."""
    return df.repartition(n)


def partition_by_key(df: DataFrame, n: int, *keys: str) -> DataFrame:
    return df.repartition(n, *keys)
