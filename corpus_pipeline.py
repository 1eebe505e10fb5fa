"""A corpus pipeline of five operators. Each stage reads what its predecessor wrote."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.llm import decontaminate, lang_id, mixture, near_dups, shards
from tidewater.llm.common import cut, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: Documents whose language is less certain than this are rejected, as are those without a letter.
LEAST_SCORE = 0.5


def identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is known with some certainty; the model learns from labelled rows outside a fifth.

    Documents without text or letters go. Rows are independent, so ties and repeated rows need no rule.
    """
    model = lang_id.fit(lang_id.training_rows(docs))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    return lang_id.identify(rows, model, LEAST_SCORE).select("row.*")


def deduplicated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: the one with the smallest doc_id, and one row of it.

    Two different texts under one doc_id are two documents. Documents without words or without a doc_id stay.
    """
    return near_dups.one_of_each(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark; those without words stay, repeated rows are treated alike."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them; NULL is a source, repeated rows have copies of their own."""
    return mixture.mix(docs)


def sharded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Shard and slot of every document row, NULL ids and texts included."""
    return shards.assign(docs).select("doc_id", "size", "text_crc32", "shard", "slot")


STAGES: list[tuple[str, Stage]] = [
    ("lang_id", identified),
    ("near_dups", deduplicated),
    ("decontaminate", decontaminated),
    ("mix", mixed),
    ("shard", sharded),
]

#: Models, pseudo-random draws and packing have no SQL form; the stages are tested against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = cut(docs, f"stage-{name}")
    return docs
