"""File sinks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidewater.functions.timeexpr import Duration, cell, duration_us, micros
from tidewater.plans import skew
from tidewater.plans.ordered import CHUNK, chunked
from tidewater.plans.skew import SkewPolicy

#: Rows of a writer that one task numbers.
ROLL = SkewPolicy(rows_per_task=1_000_000)


def write_csv(df: DataFrame, path: str, rows_per_file: int | None = None) -> None:
    """CSV without header; a file rolls over after ``rows_per_file`` rows. Blanks around text are kept."""
    writer = df.write.mode("errorifexists")
    if rows_per_file:
        writer = writer.option("maxRecordsPerFile", rows_per_file)
    writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)


def stream_files(
    df: DataFrame, path: str, checkpoint: str, fmt: str = "parquet", every: str | None = None, rows_per_file: int = 0
) -> StreamingQuery:
    """Rolling files from a stream: a new file per trigger, and after ``rows_per_file`` rows. Files and the
    checkpoint together give exactly-once output. Without ``every`` the query drains its source and stops."""
    writer = df.writeStream.format(fmt).option("path", path).option("checkpointLocation", checkpoint)
    if rows_per_file:
        writer = writer.option("maxRecordsPerFile", rows_per_file)
    trigger = {"processingTime": every} if every else {"availableNow": True}
    return writer.outputMode("append").trigger(**trigger).start()


def rolled(
    df: DataFrame, writer: str, order: Sequence[str], ts: str, size: Column, most: int, idle: Duration, age: Duration, policy: SkewPolicy = ROLL
) -> DataFrame:
    """Add ``file``, the number from 0 of the file in which each row of a ``writer`` goes.

    A file ends when nothing was written for ``idle`` or longer, when ``age`` has passed since the files after that pause began (and each
    further ``age``), and when the bytes written since then reach the next multiple of ``most``: so no file is longer than ``most`` and one
    row. Writers with many rows are cut into ranges of ``order``, each of which is numbered by itself and then moved by what the ranges
    before it hold. Rows without a time stay in the file of the row before.
    """
    limits = (most, duration_us(idle), duration_us(age))
    hot = skew.find_hot_keys(df, [writer], policy)
    if hot is None:
        return _rolled(df, writer, order, ts, size, *limits)
    cold_rows, hot_rows = skew.split(df, hot)
    ranges = chunked(hot_rows, [writer], order, hot.rows, policy)
    return _rolled(cold_rows, writer, order, ts, size, *limits).unionByName(_rolled_ranges(ranges, writer, order, ts, size, *limits, policy))


def _rolled(df: DataFrame, writer: str, order: Sequence[str], ts: str, size: Column, most: int, idle: int, age: int) -> DataFrame:
    by = Window.partitionBy(writer).orderBy(*order)
    up_to = by.rowsBetween(Window.unboundedPreceding, 0)
    us = F.coalesce(micros(ts), F.last(micros(ts), ignorenulls=True).over(up_to), F.lit(0))
    rows = df.withColumn("_us", us)
    pause = F.col("_us") - F.lag("_us").over(by) >= F.lit(idle)
    rows = rows.withColumn("_run", F.count(F.when(pause, 1)).over(up_to))
    in_run = Window.partitionBy(writer, "_run").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("_age", cell(F.col("_us") - F.first("_us").over(in_run), age))
    in_age = Window.partitionBy(writer, "_run", "_age").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("_part", cell(F.coalesce(F.sum(size).over(in_age), F.lit(0)), most))
    place = F.struct("_run", "_age", "_part")
    first = F.coalesce(place != F.lag(place).over(by), F.lit(False))
    rows = rows.withColumn("_first", first)
    return rows.withColumn("file", F.count(F.when(F.col("_first"), 1)).over(up_to)).drop("_us", "_run", "_age", "_part", "_first")


def _rolled_ranges(chunks: DataFrame, writer: str, order: Sequence[str], ts: str, size: Column, most: int, idle: int, age: int, policy: SkewPolicy) -> DataFrame:
    """As :func:`_rolled`; ``chunks`` has the number of the range of each row."""
    by = Window.partitionBy(writer, CHUNK).orderBy(*order)
    up_to = by.rowsBetween(Window.unboundedPreceding, 0)
    earlier = lambda *keys: Window.partitionBy(writer, *keys).orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    newest = lambda value, where: F.max_by(value, F.when(where, F.struct(*order)))

    def with_carry(rows: DataFrame, carry: DataFrame, *keys: str) -> DataFrame:
        on = [writer, CHUNK, *keys]
        small = skew.bounded_broadcast(carry.select([F.col(c).alias(f"_on{on.index(c)}") if c in on else c for c in carry.columns]).checkpoint(), policy)
        cond = F.lit(True)
        for i, c in enumerate(on):
            cond = cond & rows[c].eqNullSafe(small[f"_on{i}"])
        return rows.join(small, cond, "left").drop(*[f"_on{i}" for i in range(len(on))])

    # The time before each range.
    ends = chunks.groupBy(writer, CHUNK).agg(newest(micros(ts), micros(ts).isNotNull()).alias("_end"))
    last = F.last("_end", ignorenulls=True).over(earlier())
    carry = ends.select(writer, CHUNK, F.when(F.count(F.lit(1)).over(earlier()) > 0, F.coalesce(last, F.lit(0))).alias("_us0"))
    rows = with_carry(chunks, carry)
    rows = rows.withColumn("_us", F.coalesce(F.last(micros(ts), ignorenulls=True).over(up_to), "_us0", F.lit(0)))
    rows = rows.withColumn("_begins", F.coalesce(F.col("_us") - F.coalesce(F.lag("_us").over(by), "_us0") >= F.lit(idle), F.lit(True)))
    # Runs, and when they began.
    ends = rows.groupBy(writer, CHUNK).agg(F.count(F.when(F.col("_begins"), 1)).alias("_runs"), newest(F.col("_us"), F.col("_begins")).alias("_start"))
    before = F.coalesce(F.sum("_runs").over(earlier()), F.lit(0)).alias("_run0")
    rows = with_carry(rows, ends.select(writer, CHUNK, before, F.last("_start", ignorenulls=True).over(earlier()).alias("_start0")))
    rows = rows.withColumn("_run", F.col("_run0") + F.count(F.when(F.col("_begins"), 1)).over(up_to))
    start = F.coalesce(F.last(F.when(F.col("_begins"), F.col("_us")), ignorenulls=True).over(up_to), "_start0")
    rows = rows.withColumn("_age", cell(F.col("_us") - start, age))
    # Bytes of the same run and age in the ranges before.
    sums = rows.groupBy(writer, CHUNK, "_run", "_age").agg(F.sum(size).alias("_bytes"))
    sums = sums.select(writer, CHUNK, "_run", "_age", F.sum("_bytes").over(earlier("_run", "_age")).alias("_bytes0")).filter("_bytes0 IS NOT NULL")
    rows = with_carry(rows, sums, "_run", "_age")
    in_age = Window.partitionBy(writer, CHUNK, "_run", "_age").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("_part", cell(F.coalesce(F.sum(size).over(in_age), F.lit(0)) + F.coalesce("_bytes0", F.lit(0)), most))
    # Changes of place in the ranges before, and on the way from one to the next.
    place = F.struct("_run", "_age", "_part")
    rows = rows.withColumn("_place", place).withColumn("_first", F.coalesce(place != F.lag(place).over(by), F.lit(False)))
    ends = rows.groupBy(writer, CHUNK).agg(
        F.count(F.when(F.col("_first"), 1)).alias("_n"), F.min_by("_place", F.struct(*order)).alias("_from"), F.max_by("_place", F.struct(*order)).alias("_to")
    )
    step = F.col("_from") != F.lag("_to").over(Window.partitionBy(writer).orderBy(CHUNK))
    ends = ends.withColumn("_step", F.coalesce(step, F.lit(False)).cast("bigint"))
    total = F.coalesce(F.sum(F.col("_n") + F.col("_step")).over(earlier()), F.lit(0)) + F.col("_step")
    rows = with_carry(rows, ends.select(writer, CHUNK, total.alias("_file0")))
    file = F.col("_file0") + F.count(F.when(F.col("_first"), 1)).over(up_to)
    helpers = ["_us0", "_us", "_begins", "_run0", "_start0", "_run", "_age", "_bytes0", "_part", "_place", "_first", "_file0"]
    return rows.withColumn("file", file).drop(CHUNK, *helpers)


def write_rolling(df: DataFrame, path: str, writer: str, order: Sequence[str], ts: str, line: Column, most: int, idle: Duration, age: Duration) -> None:
    """Text files of one line per row, one folder per writer and file, rolled by :func:`rolled`; a line counts its bytes and its end."""
    rows = df.withColumn("_line", line)
    rows = rolled(rows, writer, order, ts, F.octet_length("_line") + 1, most, idle, age)
    rows = rows.repartitionByRange(writer, "file").sortWithinPartitions(writer, "file", *order)
    rows.select(writer, "file", F.col("_line").alias("value")).write.partitionBy(writer, "file").text(path)
