"""Stateful streaming operators equal their batch twins, whatever the micro-batches and the order of arrival."""

import datetime as dt
from collections import Counter

import pytest
from pyspark.sql import functions as F
from streams import drain, read_stream, replay

from tidewater.functions.timeexpr import micros
from tidewater.operators import aggregate, bursts, changelog, joins, late, patterns
from tidewater.plans.views import Views
from tidewater.session import scratch_path
from tidewater.streaming import processors as P
from tidewater.streaming.ordered import run_ordered, run_tagged

ORDER = ["ts", "seq"]
DELAY = "6 hours"


@pytest.fixture(scope="module")
def events(spark, sf):
    v = Views(spark, sf)
    e = v.events.filter("user_id < 8").select("user_id", "event_type", F.col("ts").cast("timestamp").alias("ts"), "k", "seq")
    return e.cache()


@pytest.fixture(scope="module")
def stream(events):
    """Events out of order by up to 50 places, then a row of another user that moves the watermark to the end."""
    end = events.agg(F.max("ts")).first()[0]
    last = end + dt.timedelta(hours=6, milliseconds=1)  # the watermark counts whole milliseconds
    flush = events.limit(1).select(
        F.lit(-1).cast("bigint").alias("user_id"), F.lit("none").alias("event_type"), F.lit(last).alias("ts"),
        F.lit(0).cast("bigint").alias("k"), F.lit(10**9).alias("seq"),
    )
    arrival = F.when(F.col("user_id") < 0, 10**9).otherwise(F.col("seq") + (F.col("seq") * 7919) % 7)
    return replay(events.unionByName(flush).withColumn("arrival", arrival.cast("bigint")), "arrival", 3)


def rows(df):
    cols = sorted(df.columns)
    return Counter(tuple(r) for r in df.filter("user_id >= 0").select(*cols).collect())


def strict(d):
    steps = [patterns.Step("a", F.col("event_type") == "view"), patterns.Step("b", F.col("event_type") == "click")]
    m = patterns.match_strict(d, ["user_id"], ORDER, "ts", steps, "1 day")
    return m.select("user_id", F.col("a.seq").alias("s0_seq"), F.col("b.seq").alias("s1_seq"))


def relaxed(d):
    steps = [patterns.Step(s, F.col("event_type") == s) for s in ("signup", "click", "purchase")]
    m = patterns.match_relaxed(d, ["user_id"], ORDER, "ts", steps, "3 days")
    later = [F.col(f"{s.name}.seq").alias(f"s{i}_seq") for i, s in enumerate(steps)]
    return m.select("user_id", *later, "status")


def pairs(d):
    r = d.sparkSession.createDataFrame([(a, b) for a in KINDS for b in KINDS], "action1 string, action2 string")
    return joins.rule_pair_match(d, ["user_id"], ORDER, "event_type", r).select("user_id", "seq", "action1", "action2")


KINDS = ["view", "click", "purchase", "signup", "error"]

CASES = {
    "running_count": (
        P.RunningCount(),
        lambda d: aggregate.running_count(d.select("user_id", *ORDER), ["user_id"], ORDER).drop("ts"),
    ),
    "changelog": (P.CountChangelog(), lambda d: changelog.count_changelog(d, ["user_id"], ORDER).drop("ts")),
    "every_n": (
        P.EveryN(5),
        lambda d: aggregate.every_n_mean_time(d, ["user_id"], ORDER, "ts", 5).select(
            "user_id", "batch", (micros("avg_ts") / 1000).cast("bigint").alias("avg_ms")
        ),
    ),
    "complete_batches": (
        P.CompleteBatches(4),
        lambda d: aggregate.complete_batches(d, ["user_id"], ORDER, 4).filter("complete").select("user_id", "seq", "batch_id"),
    ),
    "keyed_state": (
        P.KeyedStateView("event_type"),
        lambda d: aggregate.keyed_state(d, ["user_id"], ORDER, "event_type").select(
            "user_id", "seq", "list_size", "map_count", F.col("first_event_type").alias("first_value"), "agg_result"
        ),
    ),
    "ttl": (
        P.LastValueTtl("event_type", "1 day"),
        lambda d: patterns.last_value_with_ttl(d, ["user_id"], ORDER, "ts", "event_type", "1 day").select(
            "user_id", "seq", "last_value"
        ),
    ),
    "action_pairs": (P.ActionPairs("event_type"), pairs),
    "strict": (P.StrictSequence("event_type", ["view", "click"], "1 day"), strict),
    "relaxed": (P.RelaxedSequence("event_type", ["signup", "click", "purchase"], "3 days"), relaxed),
    "bursts": (
        P.FailureBursts("event_type", "view", 1, "12 hours"),
        lambda d: bursts.failure_bursts(d, ["user_id"], ORDER, "ts", F.col("event_type") == "view", 1, "12 hours").select(
            "user_id", micros("first_ts").alias("first_us"), micros("last_ts").alias("last_us"), "times"
        ),
    ),
    "click_limit": (
        P.ClickLimit(1),
        lambda d: patterns.click_limit(d, ["user_id"], ORDER, "ts", 1).select("user_id", "seq", "tag"),
    ),
    "periodic": (
        P.PeriodicCount("1 day"),
        lambda d: late.periodic_count(d, ["user_id"], "ts", "1 day").select("user_id", micros("tick").alias("tick_us"), "cnt"),
    ),
}


@pytest.mark.parametrize("name", list(CASES))
def test_stream_equals_batch(name, events, stream):
    processor, batch = CASES[name]
    end_us = events.agg(F.max(micros("ts"))).first()[0]
    got = rows(drain(run_ordered(stream.withWatermark("ts", DELAY), ["user_id"], "ts", "seq", processor)))
    want = rows(batch(events))
    if name in ("relaxed", "bursts"):
        # Results that fall due after the end of the data are still open in the stream.
        missing = want - got
        assert not got - want
        assert sum(missing.values()) <= 8
    else:
        assert got == want
    assert end_us and sum(got.values()) > 0


@pytest.mark.parametrize("name", ["every_n", "click_limit", "relaxed"])
def test_waiting_rows_in_buckets(name, events, stream):
    """Beyond a small pool rows wait in parts of time buckets; the result is the same."""
    processor, batch = CASES[name]
    processor.pool_rows, processor.part_rows, processor.bucket = 5, 2, "3 hours"
    try:
        got = rows(drain(run_ordered(stream.withWatermark("ts", DELAY), ["user_id"], "ts", "seq", processor)))
    finally:
        del processor.pool_rows, processor.part_rows, processor.bucket
    assert not got - rows(batch(events)) and sum((rows(batch(events)) - got).values()) <= (8 if name == "relaxed" else 0)


def test_late_and_timeless_rows_are_a_second_output(spark, events):
    """With no allowed disorder rows come late; together with the handled ones they are the input."""
    some = events.withColumn("ts", F.when(F.col("seq") % 13 != 0, F.col("ts")))
    arrival = (F.col("seq") + (F.col("seq") * 7919) % 101).alias("arrival")
    last = events.agg(F.max("ts")).first()[0] + dt.timedelta(days=1)
    flush = spark.createDataFrame([(-1, "none", last, 0, 10**9)], events.schema)
    ordered = some.select("*", arrival.cast("bigint")).unionByName(flush.withColumn("arrival", F.lit(10**9).cast("bigint")))
    stream = replay(ordered, "arrival", 4).withWatermark("ts", "0 seconds")
    out = drain(run_tagged(stream, ["user_id"], "ts", "seq", P.RunningCount())).filter("user_id >= 0").collect()
    late, main = [r for r in out if r.late], [r for r in out if not r.late]
    assert Counter([r.late_seq for r in late] + [r.seq for r in main]) == Counter(r.seq for r in events.collect())
    assert all(r.seq is None and r.cnt is None for r in late) and all(r.late_seq is None for r in main)
    assert {r.late_seq for r in late if r.late_us is None} == {r.seq for r in events.collect() if r.seq % 13 == 0}
    assert any(r.late_us is not None for r in late)
    at = {r.seq: r.ts for r in events.collect()}
    for user in {r.user_id for r in main}:
        mine = sorted((at[r.seq], r.seq, r.cnt) for r in main if r.user_id == user)
        assert [c for _, _, c in mine] == list(range(1, len(mine) + 1))


def test_a_hot_key_waits_in_buckets(spark):
    rows_ = spark.range(60_000).select(F.lit(1).cast("bigint").alias("user_id"), F.timestamp_seconds(F.lit(1_700_000_000) + F.col("id") * 7 % 59_999).alias("ts"), F.col("id").alias("seq"))
    flush = spark.range(1).select(F.lit(-1).cast("bigint").alias("user_id"), F.timestamp_seconds(F.lit(1_800_000_000)).alias("ts"), F.lit(10**9).cast("bigint").alias("seq"))
    stream = replay(rows_.unionByName(flush), "seq", 2).withWatermark("ts", "20 hours")
    out = drain(run_ordered(stream, ["user_id"], "ts", "seq", P.RunningCount())).filter("user_id = 1")
    order = {r.seq: r.rn for r in rows_.selectExpr("seq", "row_number() OVER (ORDER BY ts, seq) AS rn").collect()}
    assert {r.seq: r.cnt for r in out.collect()} == order


@pytest.mark.parametrize("late_hours", [0, 2, 3])
def test_windows_fire_are_corrected_and_purged(spark, late_hours):
    """Against a replay of the micro-batches one by one; the lateness may be a multiple of the size."""
    hour = 3_600_000_000
    batches_ = [[(i % 2, (base * 7 + i * 11) % 40 + base * 6) for i in range(30)] for base in range(5)] + [[(9, 900)]]
    rows_ = [(k, t, n) for n, batch in enumerate(batches_) for k, t in batch]
    df = spark.createDataFrame([(k, dt.datetime(2024, 1, 1) + dt.timedelta(minutes=20 * t), n) for k, t, n in rows_], "k long, ts timestamp, n long")
    folder = None
    for n in range(len(batches_)):
        part = df.filter(F.col("n") == n).coalesce(1)
        folder = folder or scratch_path(spark, "windows-in")
        part.write.mode("append").parquet(folder)
    stream = read_stream(spark, folder, df.schema).withWatermark("ts", "30 minutes")
    got = Counter(tuple(r) for r in drain(P.corrected_windows(stream, ["k"], "ts", "2 hours", f"{late_hours} hours")).filter("k < 9").collect())
    zero = int(dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc).timestamp()) * 1_000_000
    state, want, newest = {}, Counter(), None
    for batch in [*batches_, []]:
        mark = -1 if newest is None else newest - hour // 2
        counts = Counter((k, (zero + t * hour // 3) // (2 * hour) * 2 * hour) for k, t in batch if k < 9)
        for (k, w), n in sorted(counts.items()):
            if w + (2 + late_hours) * hour <= mark:
                want[k, w, "late", n] += 1
                continue
            had, fired = state.get((k, w), (0, False))
            state[k, w] = (had + n, fired)
            if fired:
                want[k, w, "-U", had] += 1
                want[k, w, "+U", had + n] += 1
        for (k, w), (n, fired) in list(state.items()):
            if w + 2 * hour <= mark and not fired:
                want[k, w, "+I", n] += 1
                state[k, w] = (n, True)
            if w + (2 + late_hours) * hour <= mark:
                del state[k, w]
        newest = max([zero + t * hour // 3 for _, t in batch] + ([] if newest is None else [newest]), default=newest)
    assert got == want
    assert {r[2] for r in want} == ({"+I", "late"} if not late_hours else {"+I", "-U", "+U", "late"} & {r[2] for r in want})


def test_slices_of_several_files_are_one_micro_batch_each(spark, sf, monkeypatch):
    """Large slices are written by several tasks; micro-batches stay equal spans of the number."""
    from streams import drain_batches

    from tidewater.plans import stream_queries

    monkeypatch.setattr(stream_queries, "FILE_ROWS", 50)
    v = stream_queries.Views(spark, sf)
    rows = v.events.select("user_id", "seq")
    stream = stream_queries._slices(v, rows, "seq", {"user_id": -1})
    seen, parts = {}, {}

    def keep(batch, k):
        seen[k] = sorted(r.seq for r in batch.filter("user_id >= 0").collect())
        parts[k] = batch.select(F.input_file_name()).distinct().count()

    drain_batches(stream, keep)
    every = sorted(r.seq for r in rows.collect())
    span = (every[-1] - every[0]) // stream_queries.SLICES + 1
    assert [seen[k] for k in sorted(seen)] == [[s for s in every if (s - every[0]) // span == k] for k in range(stream_queries.SLICES)]
    assert min(parts.values()) > 1


def _clicks(spark, rows_):
    """A stream of (user_id, ad_id, minute, seq), a micro-batch for each list, and a row that moves the watermark to the end."""
    zero = dt.datetime(2024, 1, 1)
    schema = "user_id long, ad_id long, ts timestamp, seq long, batch long"
    all_ = [(u, a, zero + dt.timedelta(minutes=m), s, b) for b, part in enumerate(rows_) for u, a, m, s in part]
    all_.append((-1, None, zero + dt.timedelta(days=400), 10**9, len(rows_)))
    df = spark.createDataFrame(all_, schema)
    return replay(df, "batch", len(rows_) + 1).withWatermark("ts", "1 hour")


def _limited(rows_, limit):
    """One by one: the first ``limit`` rows of a key and day are kept, the next gives a warning."""
    seen, want = Counter(), Counter()
    for u, a, m, s in sorted((r for part in rows_ for r in part), key=lambda r: (r[2], r[3])):
        key = u, a, (m + 480) // 1440
        seen[key] += 1
        if seen[key] <= limit + 1:
            want[u, a, s, "kept" if seen[key] <= limit else "warning"] += 1
    return want


@pytest.mark.parametrize(("limit", "pool"), [(1, 16_384), (2, 3)])
def test_keys_beside_a_null_stay_what_they_are(spark, limit, pool):
    """A NULL in a part of a key changes no other key, whatever Arrow batch they share; large numbers stay exact."""
    big = 2**53 + 1
    rows_ = [[(big + i % 4, [0, 1, None][i % 3], base * 2880 + i * 37 % 2880, base * 100 + i) for i in range(60)] for base in range(3)]
    processor = P.ClickLimit(limit)
    processor.pool_rows, processor.part_rows = pool, 2
    out = drain(run_ordered(_clicks(spark, rows_), ["user_id", "ad_id"], "ts", "seq", processor)).filter("user_id >= 0")
    assert Counter(tuple(r) for r in out.select("user_id", "ad_id", "seq", "tag").collect()) == _limited(rows_, limit)


def test_state_follows_groups_not_keys(spark):
    """Calls of the state store do not grow with the number of keys: all keys of a group are one row of state."""
    rows_ = [[(i % 200, i % 5, base * 1440 + i * 7 % 1440, base * 1000 + i) for i in range(400)] for base in range(2)]
    stream = run_ordered(_clicks(spark, rows_), ["user_id", "ad_id"], "ts", "seq", P.ClickLimit(1), groups=4)
    query = stream.writeStream.format("memory").queryName("grouped").option("checkpointLocation", scratch_path(spark, "cp"))
    query = query.outputMode("append").trigger(availableNow=True).start()
    assert query.awaitTermination(240)
    assert max(op["numRowsUpdated"] for p in query.recentProgress for op in p["stateOperators"]) <= 3 * 4  # a few values a group
    got = Counter(tuple(r) for r in spark.table("grouped").filter("user_id >= 0").select("user_id", "ad_id", "seq", "tag").collect())
    assert got == _limited(rows_, 1)


def test_keys_of_other_types(spark):
    """Dates, texts and small numbers as keys, NULLs among them, keep type and value."""
    days = [dt.date(2024, 1, 1), None, dt.date(1960, 2, 3)]
    rows_ = [(days[i % 3], ["a", "", None][i % 2 + i % 4 // 2], i % 2 == 0, i % 3 / 3, dt.datetime(2024, 1, 1) + dt.timedelta(minutes=i), i) for i in range(40)]
    df = spark.createDataFrame([*rows_, (None, "end", None, None, dt.datetime(2025, 1, 1), 10**6)], "d date, t string, b boolean, f double, ts timestamp, seq long")
    keys = ["d", "t", "b", "f"]
    out = drain(run_ordered(replay(df, "seq", 2).withWatermark("ts", "1 minute"), keys, "ts", "seq", P.RunningCount()))
    assert out.dtypes[:4] == df.dtypes[:4]
    seen, want = Counter(), Counter()
    for *key, _, seq in rows_:
        seen[tuple(key)] += 1
        want[(*key, seq, seen[tuple(key)])] += 1
    assert Counter(tuple(r) for r in out.filter("t IS DISTINCT FROM 'end'").collect()) == want


def test_click_limit_is_whole_where_numbers_do_not_follow_time(spark, sf, tmp_path):
    """The query on events whose numbers begin anew in time, as in a table put together from parts: no click is lost as late."""
    from tidewater.plans.stream_queries import STREAM_QUERIES

    events = spark.read.parquet(f"{sf}/events.parquet").filter("event_id < 300").drop("props")
    events = events.withColumn("props", F.format_string('{"k": %d}', F.col("event_id") % 7))
    parts = [events.withColumn("event_id", F.col("event_id") + 1000 * c).withColumn("user_id", F.col("user_id") + 100 * c) for c in range(3)]
    parts[0].union(parts[1]).union(parts[2]).write.parquet(f"{tmp_path}/events.parquet")
    got = Counter(tuple(r) for r in STREAM_QUERIES["stream_click_limit"](spark, str(tmp_path)).select("user_id", "ad_id", "seq", "tag").collect())
    clicks = spark.read.parquet(f"{tmp_path}/events.parquet").filter("event_type = 'click'").selectExpr("user_id", "event_id % 1000 % 7 % 5", "ts", "event_id")
    rows_ = [(u, a, int((ts - dt.datetime(2024, 1, 1)).total_seconds() // 60), s) for u, a, ts, s in clicks.collect()]
    assert got == _limited([sorted(rows_, key=lambda r: r[3])], 1) and sum(got.values()) > 90
