"""Per-batch outputs for what a streaming plan cannot hold: ranking, and the late-data split.

Each function writes a folder named after the batch, with overwrite, so a batch that is run again after a failure
replaces its own output. Paths belong in storage all executors share.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.functions.timeexpr import Duration, duration_us, micros, spark_duration
from tidewater.operators.late import late_status
from tidewater.operators.topn import top_n
from tidewater.operators.windows import window_count
from tidewater.plans.skew import DEFAULT, SkewPolicy
from tidewater.sinks.upsert import read_latest, upsert_batch


def hot_counts(df: DataFrame, key: str, ts: str, size: Duration, slide: Duration) -> DataFrame:
    """Counts per key and sliding window; in append mode a window leaves whole, in one batch."""
    return window_count(df, [key], ts, size, slide)


def top_n_batch(path: str, partition: Sequence[str], order: Sequence[Column], n: int) -> Callable[[DataFrame, int], None]:
    """Rank the closed windows of a batch."""

    def write(batch: DataFrame, batch_id: int) -> None:
        top_n(batch, partition, order, n).write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return write


def replace_counts_batch(path: str, key: str) -> Callable[[DataFrame, int], None]:
    """For counts in update mode, where a late row corrects its window: the newer count replaces the older one.

    Counts only grow, so the biggest is the newest. Read the ranking with :func:`ranked_counts`.
    """
    return upsert_batch(path, ["window_end", key], ["cnt"])


def ranked_counts(spark: SparkSession, path: str, key: str, n: int) -> DataFrame:
    counts = read_latest(spark, path, ["window_end", key], ["cnt"])
    return top_n(counts, ["window_end"], [F.desc("cnt"), F.asc(key)], n).select("window_end", key, "cnt", "rn")


def late_split_batch(
    path: str,
    order: Sequence[str],
    ts: str,
    delay: Duration,
    size: Duration,
    lateness: Duration = "0 seconds",
    slide: Duration | None = None,
    policy: SkewPolicy = DEFAULT,
) -> Callable[[DataFrame, int], None]:
    """Tag each row with its lateness before any aggregation, where Spark would drop late rows silently.

    The newest event time so far is one row per batch below ``path/newest``; the rows go to ``path/rows`` by
    status. Micro-batches must arrive in the order of ``order``.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        before = None
        if batch_id > 0:
            before = spark.read.parquet(f"{path}/newest/batch={batch_id - 1}").first()["us"]
        batch = batch.persist()  # read for the newest time, the ordered pass and the output
        try:
            top = batch.agg(F.max(micros(ts)).alias("us")).first()["us"]
            rows = late_status(batch, order, ts, delay, size, lateness, slide, before, policy)
            rows.write.mode("overwrite").partitionBy("status").parquet(f"{path}/rows/batch={batch_id}")
            newest = max((t for t in (before, top) if t is not None), default=None)
            one = spark.createDataFrame([(newest,)], "us bigint")
            one.write.mode("overwrite").parquet(f"{path}/newest/batch={batch_id}")
        finally:
            batch.unpersist()

    return write


def tagged_batch(path: str) -> Callable[[DataFrame, int], None]:
    """The two outputs of :func:`ordered.run_tagged` in folders of their own, written in one pass."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").partitionBy("late").parquet(f"{path}/batch={batch_id}")

    return write


def pane_counts(df: DataFrame, key: str, ts: str, size: Duration, slide: Duration) -> DataFrame:
    """Counts per key and sliding window in two stateful steps: rows are counted once per pane of ``slide``, and only the counts of
    closed panes enter the windows they belong to. ``size`` is a multiple of ``slide``."""
    if duration_us(size) % duration_us(slide):
        raise ValueError("size must be a multiple of slide")
    panes = df.groupBy(key, F.window(ts, spark_duration(slide)).alias("pane")).agg(F.count(F.lit(1)).alias("n"))
    whole = panes.select(key, "n", F.window_time("pane").alias("pane_time"))
    sums = whole.groupBy(key, F.window("pane_time", spark_duration(size), spark_duration(slide)).alias("w")).agg(F.sum("n").alias("cnt"))
    return sums.select(key, F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "cnt")
