"""Operators that run unchanged on streams give the batch result; sinks and restarts."""

import datetime as dt
import tempfile
from collections import Counter

import pytest
from pyspark.sql import functions as F
from streams import drain, drain_batches, read_stream, replay, write_files

from tidewater.operators import aggregate, basic, joins, late, reconcile, topn, windows
from tidewater.plans.views import Views
from tidewater.sinks import files, upsert
from tidewater.sinks.external import RowWriter, stream_to_console
from tidewater.sources import payload, tables
from tidewater.sources import text as text_source
from tidewater.streaming import batches
from tidewater.streaming import processors as P
from tidewater.streaming.ordered import run_ordered


def counted(df):
    cols = sorted(df.columns)
    return Counter(tuple(r) for r in df.select(*cols).collect())


@pytest.fixture(scope="module")
def events(spark, sf):
    v = Views(spark, sf)
    e = v.events.select("user_id", "event_type", F.col("ts").cast("timestamp").alias("ts"), "k", "seq")
    return e.cache()


def flushed(events, arrival="seq"):
    """The events, then one row far ahead that closes all windows."""
    ahead = events.limit(1).select(
        F.lit(-1).cast("bigint").alias("user_id"), F.lit("click").alias("event_type"),
        F.lit(dt.datetime(2030, 1, 1)).alias("ts"), F.lit(0).cast("bigint").alias("k"), F.lit(10**9).alias("seq"),
    )
    return events.unionByName(ahead.union(ahead.withColumn("event_type", F.lit("purchase"))))


@pytest.fixture(scope="module")
def folder(events):
    return write_files(flushed(events), "seq", 4)


@pytest.fixture()
def stream(spark, events, folder):
    return read_stream(spark, folder, events.schema).withWatermark("ts", "1 hour")


CASES = {
    "window_count": lambda d: windows.window_count(d, ["user_id"], "ts", "1 day"),
    "sliding": lambda d: windows.window_count(d, ["event_type"], "ts", "6 hours", "3 hours"),
    "url_count": lambda d: windows.window_count(d, ["k"], "ts", "1 day"),
}


@pytest.mark.parametrize("name", list(CASES))
def test_windowed_stream_equals_batch(name, events, stream):
    got = counted(drain(CASES[name](stream)).filter("window_end < '2029-01-01'"))
    assert got == counted(CASES[name](events))


def test_session_stream(events, stream):
    got = drain(windows.session_stream(stream, ["user_id"], "ts", "6 hours", {"total": F.col("k")})).filter("user_id >= 0")
    assert counted(got) == counted(windows.session_agg(events, ["user_id"], "ts", "6 hours", {"total": F.col("k")}))


def test_unique_stream(events, stream):
    got = drain(aggregate.unique_count_stream(stream, "user_id", "ts", "1 day")).filter("window_end < '2029-01-01'")
    assert counted(got) == counted(aggregate.unique_count(events, [], "user_id", "ts", "1 day"))


def test_running_count_in_update_mode(events, stream):
    got = drain(stream.groupBy("user_id").agg(F.count(F.lit(1)).alias("cnt")), "update")
    last = counted(got.groupBy("user_id").agg(F.max("cnt").alias("cnt")).filter("user_id >= 0"))
    assert last == counted(events.groupBy("user_id").agg(F.count(F.lit(1)).alias("cnt")))


def test_newest_row_in_complete_mode(events, stream):
    got = drain(aggregate.latest_by_key(stream, ["user_id"], ["ts", "seq"]), "complete").filter("user_id >= 0")
    assert counted(got) == counted(aggregate.latest_by_key(events, ["user_id"], ["ts", "seq"]))


def test_payload_stream(events, stream):
    raw = stream.select(F.col("user_id").cast("string").cast("binary").alias("key"), F.col("event_type").cast("binary").alias("value"))
    got = drain(payload.message_text(raw)).filter("key <> '-1'")
    assert counted(got) == counted(events.select(F.col("user_id").cast("string").alias("key"), F.col("event_type").alias("value")))


def test_update_mode_counts_are_refused_in_append_mode(stream):
    from pyspark.errors import AnalysisException

    with pytest.raises(AnalysisException):
        drain(stream.groupBy("user_id").count())


def sides(d):
    left = d.filter("event_type = 'click'").select("user_id", F.col("ts").alias("l_ts"), F.col("seq").alias("l_seq"))
    right = d.filter("event_type = 'purchase'").select("user_id", F.col("ts").alias("r_ts"), F.col("seq").alias("r_seq"))
    return left, right


def stream_sides(spark, events, folder):
    left, right = sides(read_stream(spark, folder, events.schema))
    return left.withWatermark("l_ts", "1 hour"), right.withWatermark("r_ts", "1 hour")


def test_window_join_stream(spark, events, folder):
    left, right = stream_sides(spark, events, folder)
    got = drain(joins.window_join(left, right, ["user_id"], "l_ts", "r_ts", "1 day")).filter("user_id >= 0")
    want = joins.window_join(*sides(events), ["user_id"], "l_ts", "r_ts", "1 day")
    assert counted(got) == counted(want)


def test_cogroup_stream(spark, events, folder):
    aggs = [F.count("l_seq").alias("l"), F.sum("l_seq").alias("l_sum")], [F.count("r_seq").alias("r")]
    args = (["user_id"], "l_ts", "r_ts", "1 day", *aggs)
    got = drain(joins.window_cogroup(*stream_sides(spark, events, folder), *args)).filter("user_id >= 0")
    assert counted(got) == counted(joins.window_cogroup(*sides(events), *args))


def test_rules_stream(spark, events, folder):
    """Action pairs of the stream meet a rule table that is read again in each micro-batch."""
    rules_path = tempfile.mkdtemp() + "/rules"
    spark.createDataFrame([("view", "purchase")], "action1 string, action2 string").write.parquet(rules_path)
    rules = spark.read.parquet(rules_path)
    few = events.filter("user_id < 20")
    s = read_stream(spark, write_files(flushed(few), "seq", 2), events.schema).withWatermark("ts", "1 hour")
    pairs = run_ordered(s, ["user_id"], "ts", "seq", P.ActionPairs("event_type"))
    got = drain(pairs.join(rules, ["action1", "action2"])).filter("user_id >= 0")
    want = joins.rule_pair_match(few, ["user_id"], ["ts", "seq"], "event_type", rules)
    assert counted(got.select("user_id", "seq")) == counted(want.select("user_id", "seq"))


def test_interval_join_stream(spark, events, folder):
    left, right = stream_sides(spark, events, folder)
    args = (["user_id"], "l_ts", "r_ts", "-6 hours", "12 hours")
    got = drain(joins.interval_join(left, right, *args)).filter("user_id >= 0")
    assert counted(got) == counted(joins.interval_join(*sides(events), *args))


def test_reconcile_stream(spark, events, folder):
    left, right = stream_sides(spark, events, folder)
    args = (["user_id"], "l_ts", "r_ts", "5 hours", "3 hours")
    got = drain(reconcile.reconcile(left, right, *args)).filter("user_id >= 0")
    assert counted(got) == counted(reconcile.reconcile(*sides(events), *args))


def test_union_and_route_stream(events, stream):
    kinds = [stream.filter(F.col("event_type") == t).select("user_id", "seq") for t in ("click", "view")]
    assert drain(basic.union_all(kinds)).filter("user_id >= 0").count() == events.filter("event_type in ('click','view')").count()
    tagged = basic.route(stream, {"clicks": F.col("event_type") == "click"})
    got = drain(basic.output(tagged, "clicks").drop("k")).filter("user_id >= 0")
    assert got.count() == events.filter("event_type = 'click'").count()


def test_stream_as_table_and_times(spark, events, folder):
    stream = read_stream(spark, folder, events.schema)
    tables.stream_as_table(stream, "clicks_rt", {"user_id": "who", "ts": "rt", "event_type": "kind"}, "rt", "1 hour")
    got = drain(spark.sql("SELECT who, rt FROM clicks_rt WHERE kind = 'view'"))
    assert got.count() == events.filter("event_type = 'view'").count()
    ms = stream.select((F.unix_millis("ts")).alias("ms"), "user_id")
    timed = drain(tables.with_processing_time(tables.with_event_time(ms, "ms")))
    row = timed.filter("user_id >= 0").orderBy("ms").first()
    assert row["et"].microsecond == 0 and row["pt"] is not None


def test_hot_items_stream(spark, events, stream):
    path = tempfile.mkdtemp() + "/top"
    views = stream.filter("event_type = 'view' or user_id < 0")
    order = [F.desc("cnt"), F.asc("k")]
    counts = batches.hot_counts(views, "k", "ts", "6 hours", "3 hours")
    drain_batches(counts, batches.top_n_batch(path, ["window_end"], order, 3))
    got = spark.read.parquet(path).filter("window_end < '2029-01-01'").select("window_end", "k", "cnt", "rn")
    want = topn.hot_by_window(events.filter("event_type = 'view'"), "k", "ts", "6 hours", "3 hours", 3)
    assert counted(got) == counted(want)


def test_corrected_counts_replace_older_ones(spark, events):
    """Update mode sends a count again when late rows arrive; the ranking uses the last one."""
    path = tempfile.mkdtemp() + "/counts"
    mixed = events.withColumn("arrival", F.col("seq") + (F.col("seq") * 7919) % 50)
    late_ok = replay(mixed, "arrival", 3).withWatermark("ts", "30 days")
    drain_batches(batches.hot_counts(late_ok, "k", "ts", "6 hours", "3 hours"), batches.replace_counts_batch(path, "k"), mode="update")
    want = topn.hot_by_window(events, "k", "ts", "6 hours", "3 hours", 3)
    assert counted(batches.ranked_counts(spark, path, "k", 3)) == counted(want)


def test_console(stream):
    query = stream_to_console(stream.select("seq"), rows=1)
    query.processAllAvailable()
    query.stop()
    assert query.exception() is None
    assert sum(p["numInputRows"] for p in query.recentProgress) > 0


def test_late_split_stream(spark, events):
    path = tempfile.mkdtemp() + "/late"
    mixed = events.withColumn("arrival", F.col("seq") + (F.col("seq") * 7919) % 50)
    order = ["arrival", "seq"]
    args = (order, "ts", "1 hour", "1 hour", "1 hour")
    drain_batches(replay(mixed, "arrival", 4), batches.late_split_batch(path, *args))
    got = spark.read.parquet(f"{path}/rows").select("seq", "status")
    want = late.late_status(mixed, *args).select("seq", "status")
    assert counted(got) == counted(want)
    assert len({s for (_, s) in counted(want)}) == 3


def test_upsert_stream_and_compaction(spark, events, stream):
    path, smaller = tempfile.mkdtemp() + "/log", tempfile.mkdtemp() + "/compact"
    keys, order = ["user_id"], ["ts", "seq"]
    drain_batches(stream, upsert.upsert_batch(path, keys, order))
    want = counted(aggregate.latest_by_key(events, keys, order))
    assert counted(upsert.read_latest(spark, path, keys, order).filter("user_id >= 0")) == want
    upsert.compact(spark, path, smaller, keys, order)
    assert counted(upsert.read_latest(spark, smaller, keys, order).filter("user_id >= 0")) == want


def test_file_sink_stream(spark, events, folder):
    out, cp = tempfile.mkdtemp() + "/out", tempfile.mkdtemp()
    for _ in range(2):  # the second run finds nothing new
        query = files.stream_files(read_stream(spark, folder, events.schema), out, cp, rows_per_file=200)
        assert query.awaitTermination(120)
    assert spark.read.parquet(out).count() == events.count() + 2


def test_text_stream(spark, events):
    source = tempfile.mkdtemp()
    lines = events.select(F.concat_ws(", ", "user_id", "k", F.lit("3"), "event_type", F.lit("17")).alias("value"))
    lines.repartition(3).write.mode("append").text(source)
    from tidewater import schemas

    got = drain(text_source.read_records(spark, source, schemas.USER_BEHAVIOR, stream=True))
    assert got.filter("user_id IS NOT NULL AND ts = 17 AND category_id = 3").count() == events.count()


def test_row_writer(events, stream):
    import pathlib

    class FileWriter(RowWriter):
        def __init__(self, folder):
            self.folder = folder

        def open(self, partition_id, epoch_id):
            self.file = open(f"{self.folder}/{epoch_id}-{partition_id}.txt", "w")
            return True

        def process(self, row):
            self.file.write(f"{row['seq']}\n")

        def close(self, error):
            self.file.close()

    out = tempfile.mkdtemp()
    query = stream.writeStream.foreach(FileWriter(out)).trigger(availableNow=True)
    assert query.option("checkpointLocation", tempfile.mkdtemp()).start().awaitTermination(120)
    lines = [x for f in pathlib.Path(out).glob("*.txt") for x in f.read_text().split()]
    assert len(lines) == events.count() + 2


@pytest.mark.parametrize("kind", ["batches", "clicks"])
def test_restart_keeps_state(spark, events, kind):
    """A query stopped half-way goes on from its checkpoint and ends with the rows of an unbroken run."""
    few = events.filter("user_id < 5")
    processor = P.CompleteBatches(4) if kind == "batches" else P.ClickLimit(1)
    folder, cp, out = tempfile.mkdtemp() + "/in", tempfile.mkdtemp(), tempfile.mkdtemp() + "/out"
    half = few.agg(F.expr("percentile_approx(seq, 0.5)")).first()[0]
    for piece in (few.filter(F.col("seq") <= half), flushed(few).filter(F.col("seq") > half)):
        piece.coalesce(1).write.mode("append").parquet(folder)
        source = read_stream(spark, folder, events.schema).withWatermark("ts", "1 hour")
        result = run_ordered(source, ["user_id"], "ts", "seq", processor)
        assert files.stream_files(result, out, cp).awaitTermination(240)
    got = counted(spark.read.parquet(out).filter("user_id >= 0"))
    whole = drain(run_ordered(replay(flushed(few), "seq", 1).withWatermark("ts", "1 hour"), ["user_id"], "ts", "seq", processor))
    assert got == counted(whole.filter("user_id >= 0"))
    assert got


def test_order_watch(spark):
    rows = [
        ("o1", "create", 0, 1), ("o1", "pay", 60, 2),
        ("o2", "create", 0, 3), ("o2", "pay", 1000, 4),
        ("o3", "pay", 10, 5), ("o4", "create", 20, 6),
        ("o5", "pay", 30, 7), ("o5", "create", 32, 8),
        ("end", "none", 10**6, 9),
    ]
    df = spark.createDataFrame(rows, "order_id string, action string, sec bigint, seq bigint")
    df = df.select("order_id", "action", F.timestamp_seconds(F.col("sec") + 1000).alias("ts"), "seq")
    s = replay(df, "seq", 1).withWatermark("ts", "0 seconds")
    got = drain(run_ordered(s, ["order_id"], "ts", "seq", P.OrderWatch("action", "15 minutes", "5 seconds")))
    assert {(r["order_id"], r["at_us"] // 10**6 - 1000, r["status"]) for r in got.collect()} == {
        ("o1", 60, "paid"), ("o2", 900, "timeout"), ("o2", 1000, "paid_not_created"), ("o3", 10, "paid_not_created"),
        ("o4", 920, "timeout"), ("o5", 32, "paid"),
    }
