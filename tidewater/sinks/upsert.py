"""Keyed upserts: the last write of a key wins.

A batch appends its newest row per key to a log, in a folder named after the batch, so that a batch that is
run again replaces its own output. Readers reduce the log to the newest row per key; ``compact`` rewrites it.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession

from tidewater.operators.aggregate import latest_by_key


def upsert_batch(path: str, keys: Sequence[str], order: Sequence[str]) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function."""

    def write(batch: DataFrame, batch_id: int) -> None:
        latest_by_key(batch, keys, order).write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return write


def read_latest(spark: SparkSession, path: str, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    return latest_by_key(spark.read.parquet(path).drop("batch"), keys, order)


def compact(spark: SparkSession, path: str, target: str, keys: Sequence[str], order: Sequence[str]) -> None:
    """Write the current table as the first batch of a new log."""
    read_latest(spark, path, keys, order).write.mode("errorifexists").parquet(f"{target}/batch=-1")
