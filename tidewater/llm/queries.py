"""The registered queries of this package: each operator over its whole tables, with the columns its contract names."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.llm import decontaminate, exact_dups, hard_negatives, lang_id, licenses, mixture, near_dups, pseudonyms, quality, shards, token_alignment, token_files, toxicity
from tidewater.llm.common import table
from tidewater.session import scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = pseudonyms.pseudonymise(table(spark, sf_dir, "documents").select("doc_id", "text"))
    count = [F.size(F.array_remove("kinds", kind)) for kind in pseudonyms.PATTERNS]
    count = [(F.size("kinds") - n).cast("long").alias(f"n_{kind}") for kind, n in zip(pseudonyms.PATTERNS, count, strict=True)]
    return out.select("row.doc_id", "text", F.size("kinds").cast("long").alias("n_replaced"), *count)


@query
def op2_near_dups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dups.group_near(table(spark, sf_dir, "documents"))


@query
def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "token-files")
    token_files.write_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), path)
    return token_files.read_digests(spark, path)


@query
def op4_lang_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = lang_id.identify(docs.select(F.struct("doc_id", "text").alias("row")), lang_id.fit(lang_id.training_rows(docs)))
    held_out = lang_id.remainder(F.col("row.doc_id"), 5) == 0
    return out.select("row.doc_id", held_out.alias("held_out"), "lang_pred", "score")


@query
def op5_exact_dups(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = exact_dups.group_exact(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


@query
def op6_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


@query
def op7_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = shards.assign(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


@query
def op8_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mixture.mixture(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "size", "source_size", "target", "taken", "source", "copies")


@query
def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, toxicity.training_labels(table(spark, sf_dir, "labels")))
    out = toxicity.rate(docs.select(F.struct("doc_id", "text").alias("row")), model)
    held_out = lang_id.remainder(F.col("row.doc_id"), 4) == 2
    predicted = (F.col("score") >= toxicity.THRESHOLD).cast("int")
    return out.select("row.doc_id", held_out.alias("held_out"), "score", predicted.alias("predicted"), "passages")


@query
def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    out = decontaminate.contamination(docs, items)
    digest = decontaminate.items_digest(F.col("items"))
    return out.select("doc_id", "n_words", "n_hit", "n_items", digest.alias("items_sha256"), "contaminated")


@query
def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "documents").select(F.struct("doc_id", "text").alias("row"))
    rows = token_alignment.alignments(rows, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))
    out = token_alignment.scored(rows.withColumn("row", F.struct("row.doc_id")))
    return out.select("row.doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


@query
def op12_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality.fit(docs, quality.training_labels(table(spark, sf_dir, "labels")))
    out = quality.rate(docs.select(F.struct("doc_id", "text").alias("row")), model)
    held_out = lang_id.remainder(F.col("row.doc_id"), 4) == 2
    predicted = (F.col("score") >= quality.THRESHOLD).cast("int")
    return out.select("row.doc_id", held_out.alias("held_out"), "score", predicted.alias("predicted"))


@query
def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = hard_negatives.vectors(table(spark, sf_dir, "embeddings"), label=hard_negatives.relabelled())
    return hard_negatives.mine(rows, F.pmod("id", F.lit(100)) == 0)
