"""Mixing sources to target weights: certain whole copies first, then Pareto order sampling for the rest.

Every source has a target number of words. Its documents expect different numbers of copies: in proportion to a measure
(``measure``: the number of binary digits of the size, so that a document twice as long has one step more), no document
more than ``most``, and such that the words expected of a source are its target. Of the expected copies the whole part is
certain; the fraction is the inclusion probability p of one more copy. Those copies are drawn by Pareto order sampling: a
document with the uniform number u gets the rank variable ``(u / (1-u)) / (p / (1-p))``, and the smallest ranks are taken.
The size of the sample is fixed in words: it ends where the source reaches its target, and the document at the
cut is taken when that comes nearer. As the ranks at p and 1 meet at 1, the cut lies near rank 1 and documents are
included with probabilities near p. u is a hash of doc_id, text and seed, so reruns agree.

Sources in code point order, NULL last, take the given weights in turn. They share ``budget`` times all words. No
target exceeds ``most`` times its source; what is above goes to the others by weight until none is above.

Cases: NULL and empty texts have size 0 and the smallest measure; they never move a sum. Sources without
words have target 0. Ties in rank are broken by doc_id, then by the hash of the text; equal rows are interchangeable.
Empty tables give empty results. Only doc_id, source and text are read, or all columns are carried in one struct.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidewater.llm.common import WORD, attach, cut, running_total

WEIGHTS = (3.0, 1.0, 2.0)
BUDGET = 1.5
MOST = 2.0
SEED = 20


def size_of(text: Column) -> Column:
    """Words between white space."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def measure(size: Column) -> Column:
    """What the expected copies of a document are in proportion to, within its source: 1 for no word, else 1 to 63."""
    return F.length(F.bin(size)).cast("long")


def shared_level(t: DataFrame, keys: Sequence[str], total: Column, tie: Sequence[Column] = ()) -> DataFrame:
    """``t`` with _level, the level l of each group of ``keys`` at which the sum of min(l * _w, _limit) is ``total``; NULL when all are at _limit.

    In the order of _limit / _w the rows at their limit come first, so sums over those before and those after find l.
    Rows without a limit take nothing and need no level.
    """
    group = W.partitionBy(*keys) if keys else W.partitionBy(F.lit(1))
    by_ratio = group.orderBy(F.col("_limit") / F.col("_w"), *tie)
    spent = F.coalesce(F.sum("_limit").over(by_ratio.rowsBetween(W.unboundedPreceding, -1)), F.lit(0.0))
    level = (total - spent) / F.sum("_w").over(by_ratio.rowsBetween(0, W.unboundedFollowing))
    below = F.col("_limit") > level * F.col("_w")
    # The level of the first row below its limit holds for all below; those before it are at their limits.
    t = t.withColumns({"_ratio": F.col("_limit") / F.col("_w"), "_below": F.when(below, level)})
    return t.withColumn("_level", F.min(F.when(F.col("_below").isNotNull(), F.struct("_ratio", "_below"))).over(group)["_below"])


def targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, budget: float = BUDGET, most: float = MOST) -> DataFrame:
    """``sizes`` (source, source_size) has one row per source; adds target and ``_start``, the words of earlier sources.

    The rounds of handing on what is above a limit end where one level l gives each source min(l * weight, limit).
    """
    by_name = W.orderBy(F.col("source").isNull(), "source")
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    t = sizes.withColumn("_w", F.get(cycle, (F.row_number().over(by_name) - 1) % len(weights)))
    before = by_name.rowsBetween(W.unboundedPreceding, -1)
    t = t.withColumn("_start", F.coalesce(F.sum("source_size").over(before), F.lit(0)))
    t = t.withColumn("_limit", F.col("source_size") * float(most))
    total = F.sum("source_size").over(W.partitionBy(F.lit(1))) * float(budget)
    t = shared_level(t, [], total, (F.col("source").isNull(), F.col("source")))
    target = F.when(F.col("_level").isNull(), F.col("_limit")).otherwise(F.least(F.col("_limit"), F.col("_level") * F.col("_w")))
    return t.select("source", "source_size", target.alias("target"), "_start")


def expected(cells: DataFrame, most: float = MOST) -> DataFrame:
    """``cells`` (_source, _measure, _size, target) has one row per source and measure; adds ``_each``, the expected copies of a document."""
    t = cells.withColumns({"_w": (F.col("_measure") * F.col("_size")).cast("double"), "_limit": F.col("_size") * float(most)})
    # Cells without words have no say; they take the level of their source like all others.
    level = shared_level(t.filter("_size > 0"), ["_source"], F.col("target"), (F.col("_measure"),)).groupBy("_source").agg(F.first("_level").alias("_level"))
    t = t.drop("_w", "_limit").join(level.withColumn("_known", F.lit(True)), "_source", "left")
    each = F.when(F.col("_level").isNull(), F.lit(float(most))).otherwise(F.least(F.lit(float(most)), F.col("_level") * F.col("_measure")))
    return t.withColumn("_each", F.when(F.col("_known"), each).otherwise(0.0)).drop("_level", "_known")


def _sized(rows: DataFrame, seed: int) -> DataFrame:
    u = F.xxhash64(F.lit(seed), "row.doc_id", "row.text")
    return rows.select(
        "row",
        F.col("row.source").alias("source"),
        size_of(F.col("row.text")).alias("size"),
        F.coalesce(F.concat(F.lit("s"), "row.source"), F.lit("n")).alias("_source"),  # NULL is a source of its own
        ((F.shiftrightunsigned(u, 11) + F.lit(0.5)) / F.lit(float(1 << 53))).alias("_u"),
    )


def draw(
    rows: DataFrame,
    weights: Sequence[float] = WEIGHTS,
    budget: float = BUDGET,
    most: float = MOST,
    seed: int = SEED,
) -> DataFrame:
    """``rows`` (row with doc_id, source, size, _source, _u; no texts; read several times) with source_size, target and
    the whole ``copies`` the mix takes."""
    count = F.count(F.lit(1))
    rows = rows.withColumn("_measure", measure(F.col("size")))
    rows = rows.withColumn("_cell", F.concat_ws("/", F.col("_measure").cast("string"), "_source"))
    # A source with a third of all rows is one row per task and measure here.
    sums = rows.groupBy("_cell", "_source", "_measure").agg(F.first("source").alias("source"), F.sum("size").alias("_size"), count.alias("_n"))
    sums = cut(sums, "cell-sizes")
    plan = targets(sums.groupBy("source").agg(F.sum("_size").alias("source_size")), weights, budget, most)
    plan = plan.withColumn("_source", F.coalesce(F.concat(F.lit("s"), "source"), F.lit("n"))).drop("source")
    cells = cut(expected(sums.drop("source").join(plan, "_source"), most), "cell-targets")
    sure = F.floor(F.col("_each") + 1e-9)
    cells = cells.withColumns({"_sure": sure.cast("long"), "_p": F.greatest(F.col("_each") - sure, F.lit(0.0))})
    want = F.col("target") - F.sum(F.col("_sure") * F.col("_size")).over(W.partitionBy("_source"))
    cells = cut(cells.withColumn("_want", want).drop("_source", "_measure", "_size"), "cell-plans")
    ranked = attach(rows, cells, "_cell", "_n", rows.count()).withColumn("_rank_by", pareto_rank(F.col("_u"), F.col("_p")))
    order = [F.col("source").isNull(), F.col("source"), F.col("_rank_by"), F.col("row.doc_id"), F.col("_u")]
    placed = running_total(ranked, order, F.col("size"), "pareto-ranks")
    seen = F.col("_before") - F.col("_start")
    # Taken when most of the document lies below the cut: the total then misses the target by half a document at most.
    extra = ((seen + F.col("size") / 2.0) <= F.col("_want")) & (F.col("_want") > 1e-6) & (F.col("_p") > 1e-9)
    return placed.withColumn("copies", F.col("_sure") + F.when(extra, 1).otherwise(0)).withColumn("taken", F.col("copies") * F.col("size"))


def pareto_rank(u: Column, p: Column) -> Column:
    """Random odds divided by inclusion odds; documents that cannot be included come last."""
    return F.when(p > 1e-9, (u / (1 - u)) * (1 - p) / p).otherwise(F.lit(float("inf")))


def mixture(docs: DataFrame, weights: Sequence[float] = WEIGHTS, budget: float = BUDGET, most: float = MOST, seed: int = SEED) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target (of its source), copies, taken (words)."""
    rows = _sized(docs.select(F.struct("doc_id", "source", "text").alias("row")), seed)
    rows = cut(rows.withColumn("row", F.struct("row.doc_id")), "sizes")
    out = draw(rows, weights, budget, most, seed)
    return out.select("row.doc_id", "source", "size", "source_size", "target", "copies", "taken")


def mix(docs: DataFrame, weights: Sequence[float] = WEIGHTS, budget: float = BUDGET, most: float = MOST, seed: int = SEED) -> DataFrame:
    """The mixed corpus: rows of ``docs``, each as often as the mix takes it, with the columns of ``docs``.

    Copies are decided on ids and sizes; the texts move once, to be joined with them by doc_id and hash of the text.
    Repeated rows are taken as often as was decided for all of them: each the same whole number of times, and the first
    of them, numbered over one sorted table, once more. They have one rank, so at most one group of a source has such a rest.
    """
    named = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    sized = _sized(named, seed).withColumn("_row", F.struct("row.doc_id", F.xxhash64("row.text").alias("h")))
    rows = cut(sized.withColumn("row", F.col("_row")).drop("_row"), "sizes")
    drawn = draw(rows, weights, budget, most, seed)
    copies = drawn.groupBy("row").agg(F.sum("copies").alias("_copies"), F.count(F.lit(1)).alias("_rows"))
    copies = copies.filter("_copies > 0").select(F.col("row").alias("_key"), "_copies", "_rows")
    key = F.struct("row.doc_id", F.xxhash64("row.text").alias("h"))
    joined = named.withColumn("_key0", key).join(copies, F.col("_key0").eqNullSafe(F.col("_key")))
    joined = joined.withColumn("_each", F.floor(F.col("_copies") / F.col("_rows")).cast("int")).withColumn("_rest", F.col("_copies") % F.col("_rows"))
    even = joined.filter("_rest = 0").select("row", "_each")
    uneven = joined.filter("_rest > 0").select("row", F.xxhash64("_key").alias("_group"), "_each", "_rest")
    uneven = cut(uneven.withColumn("_place", F.monotonically_increasing_id()), "uneven-copies")
    uneven = running_total(uneven, [F.col("_group"), F.col("_place")], F.lit(1).cast("long"), "uneven-order")
    first = uneven.groupBy("_group").agg(F.min("_rank").alias("_first"))
    uneven = uneven.join(F.broadcast(first), "_group")  # one row per source
    more = F.when(F.col("_rank") - F.col("_first") < F.col("_rest"), 1).otherwise(0)
    all_rows = even.unionByName(uneven.select("row", (F.col("_each") + more).cast("int").alias("_each"))).filter("_each > 0")
    return all_rows.withColumn("_copy", F.explode(F.sequence(F.lit(1), "_each"))).select("row.*")
