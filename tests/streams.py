"""Replay a DataFrame as a stream of small files."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_files(df: DataFrame, arrival: str, parts: int) -> str:
    """Files in arrival order; returns the folder."""
    folder = tempfile.mkdtemp(prefix="tw-in-")
    bounds = [r[0] for r in df.select(F.ntile(parts).over(_window(arrival)).alias("p"), arrival).groupBy("p").agg(F.max(arrival)).orderBy("p").select(F.col(f"max({arrival})")).collect()]
    low = None
    for b in bounds:
        piece = df.filter(F.col(arrival) <= b)
        if low is not None:
            piece = piece.filter(F.col(arrival) > low)
        piece.coalesce(1).write.mode("append").parquet(folder)
        low = b
    return folder


def _window(col):
    from pyspark.sql import Window

    return Window.orderBy(col)


def read_stream(spark, folder: str, schema) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder)


def replay(df: DataFrame, arrival: str, parts: int = 3) -> DataFrame:
    return read_stream(df.sparkSession, write_files(df, arrival, parts), df.schema)


def drain(stream: DataFrame, mode: str = "append", checkpoint: str | None = None) -> DataFrame:
    """Run to the end and return what reached the sink."""
    spark = stream.sparkSession
    name = "sink_" + uuid.uuid4().hex
    query = (
        stream.writeStream.format("memory")
        .queryName(name)
        .outputMode(mode)
        .option("checkpointLocation", checkpoint or tempfile.mkdtemp(prefix="tw-cp-"))
        .trigger(availableNow=True)
        .start()
    )
    assert query.awaitTermination(240), "stream did not end"
    return spark.table(name)


def drain_batches(stream: DataFrame, fn, checkpoint: str | None = None, mode: str = "append") -> None:
    query = (
        stream.writeStream.foreachBatch(fn)
        .outputMode(mode)
        .option("checkpointLocation", checkpoint or tempfile.mkdtemp(prefix="tw-cp-"))
        .trigger(availableNow=True)
        .start()
    )
    assert query.awaitTermination(240), "stream did not end"
