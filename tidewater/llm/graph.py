"""Connected components of a link table, in rounds of hooking, pointer jumping and contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import cut


def components(links: DataFrame) -> DataFrame:
    """(node, comp) of every node in ``links`` (a, b): comp is the smallest node reachable.

    Each round every node hooks to its smallest neighbour, chains of hooks are shortened by doubling, and the links are
    contracted; the number of nodes with links at least halves. All tables are written between rounds. Nodes with very
    many links are aggregated before the shuffle, and Spark splits them in the joins.
    """
    comp = None
    while True:
        links = links.filter("a != b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        links = cut(links, "links")
        if not links.take(1):
            return comp if comp is not None else links.select(F.col("a").alias("node"), F.col("b").alias("comp"))
        ends = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hook = ends.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("_m"))
        hook = cut(hook.select("node", F.least("node", "_m").alias("comp")), "hooks")
        hook = _to_roots(hook)
        comp = hook if comp is None else cut(_map(comp, "comp", hook), "components")
        links = _map(_map(links, "a", hook), "b", hook)


def _map(df: DataFrame, column: str, hook: DataFrame) -> DataFrame:
    """Replace ``column`` by the comp of its node; nodes that are not in ``hook`` stay."""
    side = hook.select(F.col("node").alias("_node"), F.col("comp").alias("_to"))
    out = df.join(side, F.col(column) == F.col("_node"), "left")
    return out.select(*[F.coalesce("_to", c).alias(c) if c == column else c for c in df.columns])


def _to_roots(hook: DataFrame) -> DataFrame:
    while True:
        side = hook.select(F.col("node").alias("_node"), F.col("comp").alias("_to"))
        further = hook.join(side, F.col("comp") == F.col("_node")).select("node", F.col("_to").alias("comp"), (F.col("_to") != F.col("comp")).alias("_moved"))
        further = cut(further, "roots")
        if not further.filter("_moved").take(1):
            return further.drop("_moved")
        hook = further.drop("_moved")
