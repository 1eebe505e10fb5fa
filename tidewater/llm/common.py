"""What several operators share: cutting lineage, joins that leave hot keys where they are, distributed running totals."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.session import scratch_path, ship_package

#: A key is hot when it holds more than one in so many rows; there are then fewer than HOT_SHARE hot keys.
HOT_SHARE = 2000

#: White space of the word contracts: space and U+0009 to U+000D.
SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cut(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: later steps restart from there if an executor is lost."""
    ship_package(df.sparkSession)
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def attach(rows: DataFrame, side: DataFrame, key: str, weight: str, total: int) -> DataFrame:
    """Inner join of ``rows`` with ``side``, which has one row per ``key`` and the number of its rows in ``weight``.

    Rows of hot keys do not move: fewer than ``HOT_SHARE`` keys can hold more than ``total / HOT_SHARE`` rows
    each, so their part of ``side`` has a bounded number of rows and is broadcast. ``rows`` and ``side`` are read
    more than once and should be cut. NULL keys have no partner.
    """
    is_hot = F.col(weight) * HOT_SHARE > F.lit(total)
    found = side.filter(is_hot).collect()
    if not found:
        return rows.join(side, key)
    hot = F.broadcast(rows.sparkSession.createDataFrame(found, side.schema))
    keys = [r[key] for r in found]
    if isinstance(keys[0], (bytes, bytearray)):
        cold_rows = rows.join(hot.select(key), key, "left_anti")
    else:
        cold_rows = rows.filter(~F.col(key).isin(keys))
    return rows.join(hot, key).unionByName(cold_rows.join(side.filter(~is_hot), key))


def running_total(df: DataFrame, order: Sequence[Column], amount: Column, name: str) -> DataFrame:
    """Add ``_rank`` (from 0) and ``_before``, the sum of ``amount`` over all rows earlier in ``order``.

    ``order`` must decide all ties that matter. Rows are range-partitioned and sorted; a window runs inside each
    range, and one row per range carries the totals of the ranges before. No task sees more than one range, or
    one row per range.
    """
    from pyspark.sql import Window as W

    placed = df.withColumn("_amount", amount).repartitionByRange(*order).sortWithinPartitions(*order)
    placed = cut(placed.withColumn("_at", F.monotonically_increasing_id()), name)
    rng = F.shiftright("_at", 33)
    ranges = placed.groupBy(rng.alias("_range")).agg(F.count(F.lit(1)).alias("_n"), F.sum("_amount").alias("_sum"))
    earlier = W.orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    ranges = ranges.select(
        "_range",
        F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_n0"),
        F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_sum0"),
    )
    inside = W.partitionBy("_range").orderBy("_at").rowsBetween(W.unboundedPreceding, -1)
    out = placed.withColumn("_range", rng).withColumn("_own", F.coalesce(F.sum("_amount").over(inside), F.lit(0)))
    out = out.join(F.broadcast(ranges), "_range")  # one row per shuffle partition
    return out.select(
        *df.columns,
        (F.col("_n0") + F.col("_at").bitwiseAND((1 << 33) - 1)).alias("_rank"),
        (F.col("_sum0") + F.col("_own")).alias("_before"),
    )
