"""Tables as sources: DDL over files, a stream as a table, event-time columns."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.functions.timeexpr import Duration, spark_duration, whole_second_ts


def table_from_ddl(
    spark: SparkSession, name: str, path: str, fmt: str, columns: str | None = None, options: Mapping[str, str] | None = None
) -> DataFrame:
    """Declare a connector table in DDL and return it. ``columns`` is a DDL column list for untyped formats."""
    settings = {"path": path, **(options or {})}
    text = ", ".join(f"{k} '{v}'" for k, v in settings.items())
    cols = f"({columns})" if columns else ""
    spark.sql(f"CREATE OR REPLACE TEMPORARY VIEW {name} {cols} USING {fmt} OPTIONS ({text})")
    return spark.table(name)


def stream_as_table(
    df: DataFrame, name: str, columns: Mapping[str, str], rowtime: str | None = None, delay: Duration = "0 seconds"
) -> DataFrame:
    """Pick and rename columns (``old -> new``), mark the row time, and register a view."""
    picked = df.select(*[F.col(old).alias(new) for old, new in columns.items()])
    if rowtime and df.isStreaming:
        picked = picked.withWatermark(rowtime, spark_duration(delay))
    picked.createOrReplaceTempView(name)
    return picked


def with_event_time(df: DataFrame, millis: str, out: str = "et", delay: Duration = "1 second") -> DataFrame:
    """Row time from epoch milliseconds, cut to the second, with its watermark."""
    timed = df.withColumn(out, whole_second_ts(F.col(millis)))
    return timed.withWatermark(out, spark_duration(delay)) if df.isStreaming else timed


def with_processing_time(df: DataFrame, out: str = "pt") -> DataFrame:
    """The time of the batch that reads the row."""
    return df.withColumn(out, F.current_timestamp())
