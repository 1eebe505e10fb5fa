"""Sharding by balanced label propagation, in DataFrame operations only.

Documents are linked through hubs: here the digest of a text that several documents share. A document starts in the shard
that a hash of its row names. In each round the documents of a hub look for the shard that holds most of their
neighbours (a lot, new in every round, decides ties) and ask to move there. A shard admits, of those who ask, what its
quota has left plus what leaves it in the same round, so that hubs can swap places between full shards; a new lot
decides who is admitted. Each move joins documents of a hub, so the number of cut links falls until no hub is divided or
can move. Hubs above 1 / ``PIECE`` of a shard (a bounded number) start packed, the largest first, in the fullest shard
that has room, as no round could make so much room at once; only one that fits nowhere, as any above a whole shard,
starts divided, over the shards with most room, and finds no room to join. Documents without links fill what the others
leave free.
A last cut of the order (shard, hub) into pieces of equal size makes the law exact. Large hubs stand in the middle of a
shard and unlinked documents at its ends, so the cut falls among the latter where there are any, and else divides one
hub per border at most.

``law="rows"``: row counts of any two shards differ by one at most. ``law="bytes"``: a shard's bytes differ from the
mean by one document at most.

Cases: a NULL text has 8 bytes, crc32 0 and is linked with other NULL texts; empty texts are linked with each other.
Repeated rows and ids are documents of their own. An empty table gives an empty result. Only doc_id and text are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import HOT_SHARE, cut, running_total

SHARDS = 24
QUIET = 3  # rounds without a move, each with new lots, that end the propagation
PIECE = 64  # hubs above 1 / PIECE of a shard are packed one by one: fewer than PIECE * shards


def nodes(docs: DataFrame, law: str) -> DataFrame:
    """One row per document: doc_id, size, text_crc32, hub (digest), node (a number), load (in the unit of the law)."""
    text = F.coalesce("text", F.lit(""))
    size = F.octet_length(text).cast("long") + 8
    out = docs.select(
        "doc_id",
        size.alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
        F.coalesce(F.sha2("text", 256), F.lit("null")).alias("hub"),
        F.monotonically_increasing_id().alias("node"),
    )
    return out.withColumn("load", F.lit(1).cast("long") if law == "rows" else F.col("size"))


def pack(loads: list[tuple[str, int]], shards: int, quota: float) -> tuple[dict[str, list[tuple[int, float]]], list[float]]:
    """Of each hub its pieces (shard, share of the hub), best fit of the largest first; the room left in each shard."""
    room, pieces = [quota] * shards, {}
    for hub, load in sorted(loads, key=lambda x: (-x[1], x[0])):
        fits = [s for s in range(shards) if room[s] >= load]
        if fits:
            s = min(fits, key=lambda s: (room[s], s))
            pieces[hub], room[s] = [(s, 1.0)], room[s] - load
            continue
        pieces[hub], rest = [], float(load)
        for s in sorted(range(shards), key=lambda s: (-room[s], s)):
            if rest > 0 and room[s] > 0:
                part = min(rest, room[s])
                pieces[hub].append((s, part / load))
                room[s], rest = room[s] - part, rest - part
    return pieces, room


def _share_of(at: Column, room: list[float]) -> Column:
    """The shard in which ``at``, from 0 to 1, falls when the shards take parts in proportion to their room."""
    free = sum(room) or 1.0
    ends = [sum(room[: s + 1]) / free for s in range(len(room))]
    return F.size(F.filter(F.array(*[F.lit(e) for e in ends[:-1]]), lambda e: e <= at))


def admitted(wants: dict[tuple[int, int], int], free: list[float]) -> list[float]:
    """Of each shard the share it admits of the load that asks for it (``wants``: from, to): the largest shares that keep
    what comes in within the free room and what leaves in the same round."""
    shards = len(free)
    asked = [sum(load for (_, t), load in wants.items() if t == s) for s in range(shards)]
    share = [1.0] * shards
    for _ in range(1000):  # falls from 1 to the largest fixed point
        leaving = [sum(load * share[t] for (f, t), load in wants.items() if f == s) for s in range(shards)]
        new = [min(share[s], max(0.0, free[s] + leaving[s]) / asked[s]) if asked[s] else 1.0 for s in range(shards)]
        if max(a - b for a, b in zip(share, new, strict=True)) < 1e-6:
            break
        share = new
    return share


def propagate(cells: DataFrame, shards: int, room: list[float], slack: float) -> tuple[DataFrame, list[int], list[float]]:
    """Label propagation over ``cells`` (hub, start, load, n, shard), one row per hub and start shard.

    Documents of a hub that started in one shard have the same neighbours and move together. Returns (hub, start, shard),
    the number of cut links before each round and at the end, and the load of each shard. Hubs that are whole stay and
    leave the rounds, so these shrink. Only numbers per shard, and per pair of shards, reach the driver.
    """
    settled, cut_edges, load, quiet, turn = [], [], [0.0] * shards, 0, 0
    cells = cut(cells, "cells")
    for r in cells.groupBy("shard").agg(F.sum("load").alias("load")).collect():  # one row per shard
        load[r["shard"]] += r["load"]
    pairs = lambda n: F.col(n) * (F.col(n) - 1) / 2
    while True:
        held = cells.groupBy("hub", "shard").agg(F.sum("load").alias("_load"), F.sum("n").alias("_n"))
        best = F.max_by("shard", F.struct("_load", F.xxhash64(F.lit(turn), "hub", "shard").alias("t")))
        edges = (pairs("_all") - F.col("_same")).cast("long").alias("_cut")
        goals = held.groupBy("hub").agg(best.alias("_goal"), F.count(F.lit(1)).alias("_k"), F.sum("_n").alias("_all"), F.sum(pairs("_n")).alias("_same"))
        goals = goals.select("hub", "_goal", "_k", edges)
        asked = cut(cells.join(goals, "hub"), "asked")
        settled.append(asked.filter("_k = 1").select("hub", "start", "shard"))
        # A cut link is counted once per cell of its hub there, so by hub here.
        edges = asked.filter("_k > 1").groupBy("hub").agg(F.first("_cut").alias("_cut")).agg(F.coalesce(F.sum("_cut"), F.lit(0))).first()[0]
        cut_edges.append(edges)
        if not edges or quiet == QUIET:
            settled.append(asked.filter("_k > 1").select("hub", "start", "shard"))
            break
        moves = F.col("_goal") != F.col("shard")
        wants = asked.filter(moves).groupBy("shard", "_goal").agg(F.sum("load").alias("load")).collect()  # one row per pair of shards
        share = admitted({(r["shard"], r["_goal"]): r["load"] for r in wants}, [q + slack - x for q, x in zip(room, load, strict=True)])
        lot = F.pmod(F.xxhash64("hub", F.lit(turn), F.lit(2)), F.lit(1 << 20)) / float(1 << 20)
        goes = moves & (lot < F.get(F.array(*[F.lit(x) for x in share]), F.col("_goal")))
        after = F.when(goes, F.col("_goal")).otherwise(F.col("shard"))
        cells = cut(asked.filter("_k > 1").select("hub", "start", "load", "n", after.alias("shard"), F.col("shard").alias("_from")), "cells")
        moved = cells.filter("shard != _from").groupBy("shard", "_from").agg(F.sum("load").alias("load")).collect()
        for r in moved:
            load[r["shard"]] += r["load"]
            load[r["_from"]] -= r["load"]
        cells = cells.drop("_from")
        quiet = 0 if moved else quiet + 1
        turn += 1
    out = settled[0]
    for part in settled[1:]:
        out = out.unionByName(part)
    return out, cut_edges, load


def labels(every: DataFrame, shards: int, quota: float, total: int) -> DataFrame:
    """``every`` with _label, the shard meant for the document, and _side, its place in the shard's order."""
    spark = every.sparkSession
    hubs = cut(every.groupBy("hub").agg(F.count(F.lit(1)).alias("_n"), F.sum("load").alias("_load")).filter("_n > 1 OR _load > 1"), "hubs")
    # Fewer than PIECE * shards hubs are large; fewer than HOT_SHARE have more rows than a join key should.
    large = (F.col("_load") > 1) & ((F.col("_load") * PIECE > F.lit(quota)) | (F.col("_n") * HOT_SHARE > F.lit(total)))
    pieces, room = pack([(r["hub"], r["_load"]) for r in hubs.filter(large).collect()], shards, quota)
    ends = []
    for hub, own in pieces.items():
        upto = [sum(share for _, share in own[: i + 1]) for i in range(len(own))]
        ends.append((hub, [s for s, _ in own], upto[:-1]))
    ends = F.broadcast(spark.createDataFrame(ends, "hub string, _shards array<int>, _ends array<double>"))
    start = F.pmod(F.xxhash64("doc_id", "node"), F.lit(shards)).cast("int")
    placed = every.join(ends, "hub", "left").withColumn("start", start)
    top = placed.filter("_shards IS NOT NULL")
    u = F.pmod(F.xxhash64("node", F.lit(1)), F.lit(1 << 30)) / float(1 << 30)
    top = top.withColumns({"_label": F.get("_shards", F.size(F.filter("_ends", lambda e: e <= u))), "_side": F.lit(2)})
    linked = hubs.filter(~large & (F.col("_n") > 1)).select("hub")
    below = placed.filter("_shards IS NULL")
    cells = below.groupBy("hub", "start").agg(F.sum("load").alias("load"), F.count(F.lit(1)).alias("n")).join(linked, "hub")
    found, _, load = propagate(cells.withColumn("shard", F.col("start")), shards, room, quota / PIECE)
    room = [max(0.0, free - own) for free, own in zip(room, load, strict=True)]
    rest = cut(below.join(found.withColumnRenamed("shard", "_label"), ["hub", "start"], "left").drop("start", "_shards", "_ends"), "linked")
    # Documents without links follow each other into what is free, in proportion.
    single = running_total(rest.filter("_label IS NULL"), [F.xxhash64("node"), F.col("node")], F.col("load"), "single-order")
    amount = rest.filter("_label IS NULL").agg(F.sum("load")).first()[0]
    at = (F.col("_before") + F.col("load") / 2) / F.lit(float(amount or 1))
    side = F.when(F.pmod("node", F.lit(2)) == 0, 0).otherwise(4)  # they stand at both ends of a shard
    half = F.when(F.pmod(F.xxhash64("hub", F.lit(2)), F.lit(2)) == 0, 1).otherwise(3)
    single = single.withColumns({"_label": _share_of(at, room), "_side": side})
    rest = rest.filter("_label IS NOT NULL").withColumn("_side", half)
    names = [*every.columns, "_label", "_side"]
    return top.select(names).unionByName(rest.select(names)).unionByName(single.select(names))


def assign(docs: DataFrame, shards: int = SHARDS, law: str = "rows") -> DataFrame:
    """One row per document: doc_id, size, text_crc32, hub, shard, slot (gapless in its shard from 0)."""
    if law not in ("rows", "bytes"):
        raise ValueError(f"law is rows or bytes, not {law!r}")
    every = cut(nodes(docs, law), "nodes")
    n, load = every.agg(F.count(F.lit(1)), F.coalesce(F.sum("load"), F.lit(0))).first()
    put = cut(labels(every, shards, max(load / shards, 1.0), n), "labels")
    order = [F.col(c) for c in ("_label", "_side", "hub", "doc_id", "node")]
    placed = running_total(put, order, F.col("load"), "shard-order")
    return _slots(placed.withColumn("shard", _piece(F.col("_before"), F.col("load"), load, shards, law)))


def _piece(before: Column, load: Column, total: int, shards: int, law: str) -> Column:
    at = before if law == "rows" else before + F.shiftright(load, 1)
    return F.least(F.floor(at * shards / F.lit(max(total, 1))), F.lit(shards - 1)).cast("int")


def _slots(placed: DataFrame) -> DataFrame:
    first = placed.groupBy("shard").agg(F.min("_rank").alias("_first"))
    out = placed.join(F.broadcast(first), "shard")  # one row per shard
    return out.select("doc_id", "size", "text_crc32", "hub", "shard", (F.col("_rank") - F.col("_first")).alias("slot"))


def cut_links(assigned: DataFrame) -> DataFrame:
    """One row (linked, together): pairs of linked documents, and how many of them share a shard, counted in groups."""
    pairs = lambda n: F.col(n) * (F.col(n) - 1) / 2
    by = assigned.groupBy("hub", "shard").agg(F.count(F.lit(1)).alias("n"))
    hubs = by.groupBy("hub").agg(F.sum("n").alias("all"), F.sum(pairs("n")).alias("same"))
    return hubs.agg(F.sum(pairs("all")).cast("long").alias("linked"), F.sum("same").cast("long").alias("together"))
