"""Session functions for SQL users. All of them are SQL functions, so Spark inlines them into the plan."""

from __future__ import annotations

from pyspark.sql import SparkSession

_SCALARS = {
    "java_hash": (
        "s STRING",
        "BIGINT",
        """pmod(aggregate(filter(split(s, ''), c -> c <> ''), 0L,
             (h, c) -> pmod(h * 31 + ascii(c), 4294967296L)) + 2147483648L, 4294967296L) - 2147483648L""",
    ),
    "weighted_avg_result": (
        "weighted_total BIGINT, weight BIGINT",
        "BIGINT",
        "weighted_total div nullif(weight, 0)",
    ),
    "not_blank": ("s STRING", "BOOLEAN", "length(trim(coalesce(s, ''))) > 0"),
}

_TABLES = {
    "split_words": (
        "s STRING",
        "word STRING, length INT",
        """SELECT col AS word, length(col) AS length
           FROM explode(split(regexp_replace(s, '[?]+$', ''), '[?]'))""",
    ),
}


def register_all(spark: SparkSession) -> list[str]:
    """Create the temporary functions; call them from SQL or with ``F.call_function``."""
    for name, (params, result, body) in _SCALARS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({params}) RETURNS {result} RETURN {body}")
    for name, (params, result, body) in _TABLES.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({params}) RETURNS TABLE ({result}) RETURN {body}")
    return [*_SCALARS, *_TABLES]
