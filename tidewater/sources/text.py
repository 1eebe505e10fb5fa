"""Text sources: delimited records and access logs. They parse a ``value`` column, from files or a stream."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

LOG_TIME = "dd/MM/yyyy:HH:mm:ss"


def read_lines(spark: SparkSession, path: str, stream: bool = False, files_per_batch: int | None = None) -> DataFrame:
    reader = spark.readStream if stream else spark.read
    if stream and files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.text(path)


def read_socket(spark: SparkSession, host: str, port: int) -> DataFrame:
    """Lines from a socket; not replayable, so for trials only."""
    return spark.readStream.format("socket").option("host", host).option("port", port).load()


def parse_records(
    lines: DataFrame, schema: T.StructType, sep: str = ",", value: str = "value", trim: bool = True
) -> DataFrame:
    """Split each line and cast the parts; a part that does not parse is NULL.

    Numbers may be surrounded by blanks. With ``trim=False`` text keeps its blanks.
    """
    parts = F.split(F.col(value), f"\\Q{sep}\\E")

    def field(i: int, f: T.StructField) -> Column:
        part = F.get(parts, F.lit(i))
        if isinstance(f.dataType, T.StringType):
            return (F.trim(part) if trim else part).alias(f.name)
        return F.trim(part).try_cast(f.dataType).alias(f.name)

    return lines.select(*[field(i, f) for i, f in enumerate(schema.fields)])


def read_records(
    spark: SparkSession, path: str, schema: T.StructType, sep: str = ",", stream: bool = False, trim: bool = True
) -> DataFrame:
    return parse_records(read_lines(spark, path, stream), schema, sep, trim=trim)


def parse_access_log(lines: DataFrame, value: str = "value") -> DataFrame:
    """Access-log fields with ``valid`` false for lines that do not parse; split with :func:`accepted`.

    The zone offset in the line is not applied: times are read as UTC.
    """
    parts = F.split(F.col(value), " ")

    def part(i: int) -> Column:
        return F.get(parts, F.lit(i))

    rows = lines.select(
        F.col(value).alias("line"),
        part(0).alias("ip"),
        part(1).alias("user_id"),
        F.try_to_timestamp(part(3), F.lit(LOG_TIME)).alias("ts"),
        part(5).alias("method"),
        part(6).alias("url"),
    )
    return rows.withColumn("valid", F.col("ts").isNotNull() & F.col("url").isNotNull())


def accepted(rows: DataFrame) -> DataFrame:
    return rows.filter("valid").drop("valid", "line")


def rejected(rows: DataFrame) -> DataFrame:
    return rows.filter(~F.col("valid")).select("line")
