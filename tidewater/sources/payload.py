"""Message payloads and topics. The topic reader needs Spark's Kafka package on the cluster."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_topic(spark: SparkSession, servers: str, topic: str, starting: str = "latest", **options: str) -> DataFrame:
    reader = spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
    reader = reader.option("subscribe", topic).option("startingOffsets", starting)
    return message_text(reader.options(**options).load())


def message_text(messages: DataFrame) -> DataFrame:
    """Key and value of raw messages as text."""
    keyed = [F.col("key").cast("string").alias("key")] if "key" in messages.columns else []
    return messages.select(*keyed, F.col("value").cast("string").alias("value"))


def parse_json(
    lines: DataFrame, schema: T.StructType, renames: Mapping[str, str] | None = None, value: str = "value"
) -> DataFrame:
    """JSON fields by an explicit schema, renamed; ``valid`` is false where the text is no such JSON."""
    corrupt = "_corrupt"
    wide = T.StructType([*schema.fields, T.StructField(corrupt, T.StringType())])
    parsed = lines.withColumn("_j", F.from_json(value, wide, {"columnNameOfCorruptRecord": corrupt}))
    names = renames or {}
    fields = [F.col(f"_j.{f.name}").alias(names.get(f.name, f.name)) for f in schema.fields]
    valid = F.col("_j").isNotNull() & F.col(f"_j.{corrupt}").isNull()
    return parsed.select(F.col(value).alias("line"), *fields, F.coalesce(valid, F.lit(False)).alias("valid"))
