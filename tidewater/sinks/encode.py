"""Rows as messages or documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def to_messages(df: DataFrame, key: str | None = None) -> DataFrame:
    """``(key, value)`` with the row as JSON, ready for ``write.format("kafka")``."""
    value = F.to_json(F.struct(*df.columns)).alias("value")
    return df.select(F.col(key).cast("string").alias("key"), value) if key else df.select(value)


def to_documents(df: DataFrame, index: str, doc_id: str | None = None, day: Column | None = None) -> DataFrame:
    """``(index, id, source)`` per row. With ``day`` the index name ends in ``-yyyyMMdd``; ``id`` NULL lets the
    store choose."""
    name = F.lit(index) if day is None else F.concat(F.lit(f"{index}-"), F.date_format(day, "yyyyMMdd"))
    ident = F.col(doc_id).cast("string") if doc_id else F.lit(None).cast("string")
    return df.select(name.alias("index"), ident.alias("id"), F.to_json(F.struct(*df.columns)).alias("source"))
