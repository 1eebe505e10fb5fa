"""Small inputs with results known beforehand or worked out by hand. Times are milliseconds unless said."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidewater import schemas
from tidewater.functions import register, text
from tidewater.functions.timeexpr import millis_to_ts, seconds_to_ts
from tidewater.operators import aggregate, basic, changelog, joins, patterns, reconcile, windows
from tidewater.sinks import encode, files
from tidewater.sources import payload, tables
from tidewater.sources import text as text_source


def ms_table(spark, rows, names):
    """Rows whose last column is a time in milliseconds, with a running ``seq``."""
    df = spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], [*names, "ms", "seq"])
    return df.withColumn("ts", millis_to_ts(F.col("ms")))


def side(df, p, *more):
    return df.select("key", F.col("ts").alias(f"{p}_ts"), F.col("seq").alias(f"{p}_seq"), *more)


@pytest.fixture(scope="module")
def ab(spark):
    a = ms_table(spark, [("a", 1000), ("b", 2000), ("a", 1000), ("c", 3000)], ["key"])
    b = ms_table(spark, [("a", 3000), ("b", 4000), ("a", 2000), ("b", 2000)], ["key"])
    return side(a, "l"), side(b, "r")


def test_window_join(ab):
    got = joins.window_join(*ab, ["key"], "l_ts", "r_ts", "5 seconds").groupBy("key").count().collect()
    assert {tuple(r) for r in got} == {("a", 4), ("b", 2)}


def test_window_cogroup(ab):
    sizes = ([F.collect_list("l_seq").alias("l")], [F.collect_list("r_seq").alias("r")])
    got = joins.window_cogroup(*ab, ["key"], "l_ts", "r_ts", "5 seconds", *sizes)
    assert {(r["key"], len(r["l"] or []), len(r["r"] or [])) for r in got.collect()} == {("a", 2, 2), ("c", 1, 0), ("b", 1, 2)}


def test_interval_join(spark):
    orders = ms_table(spark, [("x", 5000), ("y", 5000), ("y", 20000), ("z", 51000)], ["key"])
    clicks = ms_table(
        spark,
        [("z", 2000), ("x", 3000), ("x", 0), ("x", 15000), ("x", 15001), ("y", 10000), ("y", 20000), ("y", 30000), ("z", 46000)],
        ["key"],
    )
    got = joins.interval_join(side(orders, "l"), side(clicks, "r"), ["key"], "l_ts", "r_ts", "-5 seconds", "10 seconds")
    # both ends of the interval count
    assert {(r["key"], r["l_seq"], r["r_seq"]) for r in got.collect()} == {
        ("x", 0, 1), ("x", 0, 2), ("x", 0, 3), ("y", 1, 5), ("y", 2, 6), ("y", 2, 7), ("z", 3, 8)
    }


def test_history_join(spark):
    a = spark.createDataFrame([("a", 1), ("b", 2), ("a", 3), ("c", 4)], "key string, l bigint")
    b = spark.createDataFrame([("a", 1), ("b", 2), ("a", 3), ("d", 4)], "key string, r bigint")
    inner = joins.history_join(a, b, ["key"]).groupBy("key").count()
    assert {tuple(r) for r in inner.collect()} == {("a", 4), ("b", 1)}
    outer = joins.history_join(a, b, ["key"], "full").filter("l IS NULL OR r IS NULL")
    assert {tuple(r) for r in outer.collect()} == {("c", 4, None), ("d", None, 4)}


@pytest.mark.parametrize("right_wait, third", [("0 seconds", "right_only"), ("3 seconds", "matched")])
def test_bill_check(spark, right_wait, third):
    app = ms_table(spark, [("order-1", 1000), ("order-2", 2000), ("order-3", 4000)], ["key"])
    other = ms_table(spark, [("order-1", 1000), ("order-3", 3000)], ["key"])
    got = reconcile.reconcile(side(app, "l"), side(other, "r"), ["key"], "l_ts", "r_ts", "5 seconds", right_wait)
    tags = {(r["key"], r["tag"]) for r in got.collect()}
    want = {("order-1", "matched"), ("order-2", "left_only"), ("order-3", third)}
    assert tags == (want | {("order-3", "left_only")} if third == "right_only" else want)


def test_rules(spark):
    acts = ms_table(spark, [("Alice", "login", 1), ("Alice", "pay", 2), ("Bob", "login", 3), ("Bob", "buy", 4)], ["user", "action"])
    rules = spark.createDataFrame([(1, "login", "pay"), (2, "login", "buy")], "n bigint, action1 string, action2 string")
    every = joins.rule_pair_match(acts, ["user"], ["ts", "seq"], "action", rules)
    assert {(r["user"], r["action1"], r["action2"]) for r in every.collect()} == {("Alice", "login", "pay"), ("Bob", "login", "buy")}
    newest = joins.rule_pair_match(acts, ["user"], ["ts", "seq"], "action", rules, "n")
    assert {r["user"] for r in newest.collect()} == {"Bob"}


LOGINS = [
    ("user_1", "fail", 2000), ("user_1", "fail", 3000), ("user_2", "fail", 4000), ("user_1", "fail", 5000),
    ("user_2", "fail", 7000), ("user_2", "fail", 8000), ("user_2", "success", 6000),
]


def test_three_fails(spark):
    df = ms_table(spark, LOGINS, ["user", "kind"])
    m = patterns.match_strict(df, ["user"], ["ts", "seq"], "ts", patterns.times("f", F.col("kind") == "fail", 3))
    got = [(r["user"], *[int(r[f"f{i}"]["ts"].timestamp() * 1000) for i in (1, 2, 3)]) for r in m.collect()]
    assert got == [("user_1", 2000, 3000, 5000)]
    # the limit is strict: 3 seconds from first to last is not within 3 seconds
    for limit, n in (("3 seconds", 0), ("3001 milliseconds", 1)):
        steps = patterns.times("f", F.col("kind") == "fail", 3)
        assert patterns.match_strict(df, ["user"], ["ts", "seq"], "ts", steps, limit).count() == n


def test_order_timeout(spark):
    rows = [
        ("user_1", "order_1", "create", 1000), ("user_2", "order_2", "create", 2000), ("user_1", "order_1", "modify", 10_000),
        ("user_1", "order_1", "pay", 60_000), ("user_2", "order_3", "create", 600_000), ("user_2", "order_3", "pay", 1_200_000),
    ]
    df = ms_table(spark, rows, ["user", "order", "kind"])
    steps = [patterns.Step("create", F.col("kind") == "create"), patterns.Step("pay", F.col("kind") == "pay")]
    m = patterns.match_relaxed(df, ["order"], ["ts", "seq"], "ts", steps, "15 minutes")
    assert {(r["order"], r["status"]) for r in m.collect()} == {("order_1", "matched"), ("order_2", "timeout"), ("order_3", "matched")}


CLICKS = [
    ("zhangsan", "/home", 1000), ("lisi", "/home", 1000), ("lisi", "/cart", 3000), ("zhangsan", "/cart", 2000),
    ("wangwu", "/home", 1000), ("tianliu", "/home", 4000), ("lisi", "/pay", 2500),
]


def test_newest_visit_and_visitors(spark):
    df = ms_table(spark, CLICKS, ["user", "url"])
    newest = aggregate.latest_by_key(df, ["user"], ["ts", "seq"])
    assert {(r["user"], r["ms"]) for r in newest.collect()} == {("zhangsan", 2000), ("lisi", 3000), ("tianliu", 4000), ("wangwu", 1000)}
    assert aggregate.unique_count(df, [], "user", "ts", "10 seconds").first()["uv"] == 4
    best = aggregate.most_active(df, "user", ["ts", "seq"]).first()
    assert tuple(best) == ("lisi", 3)


def test_most_active_tie_goes_to_the_newer(spark):
    df = ms_table(spark, [("a", "/", 1), ("b", "/", 2), ("b", "/", 3), ("a", "/", 4)], ["user", "url"])
    assert tuple(aggregate.most_active(df, "user", ["ts", "seq"]).first()) == ("a", 2)


def test_changelog(spark):
    rows = [(1, "+I", "bob", 1), (2, "+I", "alice", 20), (3, "-U", "alice", 20), (4, "+U", "alice", 120), (5, "+I", "eve", 9), (6, "-D", "eve", 9)]
    df = spark.createDataFrame(rows, "seq bigint, row_kind string, name string, n bigint")
    table = changelog.apply_changelog(df, ["name"], ["seq"]).select("name", "n")
    assert {tuple(r) for r in table.collect()} == {("bob", 1), ("alice", 120)}


def test_burst_cleared_by_success_at_the_last_instant(spark):
    from tidewater.operators.bursts import failure_bursts

    rows = [("a", "fail", 0), ("a", "fail", 1000), ("a", "fail", 1500), ("a", "success", 2000)]
    rows += [("b", "fail", 0), ("b", "fail", 1000), ("b", "fail", 2000), ("b", "success", 2001), ("b", "fail", 2002)]
    df = ms_table(spark, rows, ["user", "kind"])
    got = failure_bursts(df, ["user"], ["ts", "seq"], "ts", F.col("kind") == "fail", 3, "2 seconds")
    assert [(r["user"], r["times"], r["last_ts"].timestamp()) for r in got.collect()] == [("b", 3, 2.0)]


def test_session_gap_is_inclusive(spark):
    df = ms_table(spark, [("a", 0), ("a", 1000), ("a", 2001)], ["user"])
    got = windows.session_agg(df, ["user"], "ts", "1 second", {}).orderBy("session_start")
    assert [(r["cnt"], r["session_end"].timestamp()) for r in got.collect()] == [(2, 2.0), (1, 3.001)]


CLICK_LINES = [
    "mary, ./home,1000", "alice, ./cart,2000", "bob, ./home,3000", "bob, ./prod?id=1,3300", "bob, ./home,3500", "alice, ./x, 3200",
]


def test_csv_sink_keeps_blanks(spark, tmp_path):
    """Filter and projection of one user, written as CSV."""
    source, target = str(tmp_path / "in"), str(tmp_path / "out")
    spark.createDataFrame([(x,) for x in CLICK_LINES], "value string").coalesce(1).write.text(source)
    clicks = text_source.read_records(spark, source, schemas.CLICK, trim=False)
    assert clicks.filter("ts IS NULL").count() == 0
    files.write_csv(clicks.where(F.col("user") == "bob").select("url", "user"), target, rows_per_file=1)
    lines = sorted(r["value"] for r in spark.read.text(target).collect())
    assert [x.replace('"', "") for x in lines] == [" ./home,bob", " ./home,bob", " ./prod?id=1,bob"]
    assert len([p for p in (tmp_path / "out").iterdir() if p.name.startswith("part")]) >= 3
    back = tables.table_from_ddl(spark, "bob_clicks", target, "csv", "url STRING, user STRING")
    assert {r["url"] for r in back.collect()} == {" ./home", " ./prod?id=1"}


def test_numbers_with_blanks_and_bad_parts(spark):
    df = spark.createDataFrame([("1, 2 ,x,pv, 7",), ("1,2",), ("",)], "value string")
    got = text_source.parse_records(df, schemas.USER_BEHAVIOR).collect()
    assert tuple(got[0]) == (1, 2, None, "pv", 7)
    assert tuple(got[1]) == (1, 2, None, None, None)


def test_order_and_receipt_logs(spark):
    """Seconds in the feed; status of orders and reconciliation with receipts."""
    orders = ["1,create,,100", "1,pay,tx1,700", "2,create,,100", "2,pay,tx2,1172", "3,create,,120", "4,pay,tx4,130"]
    receipts = ["tx1,wechat,705", "tx2,alipay,1178", "tx9,wechat,50"]
    log = text_source.parse_records(spark.createDataFrame([(x,) for x in orders], "value string"), schemas.ORDER_LOG)
    log = log.withColumn("ts", seconds_to_ts(F.col("ts")))
    status = patterns.order_status(log, ["order_id"], "action", "ts", "15 minutes")
    assert {(r["order_id"], r["status"]) for r in status.collect()} == {
        ("1", "paid"), ("2", "paid_late"), ("3", "created_not_paid"), ("4", "paid_not_created")
    }
    paid = basic.keep_non_blank(log, "tx_id").select("tx_id", F.col("ts").alias("l_ts"))
    got = text_source.parse_records(spark.createDataFrame([(x,) for x in receipts], "value string"), schemas.RECEIPT_LOG)
    got = got.select("tx_id", "channel", seconds_to_ts(F.col("ts")).alias("r_ts"))
    tags = reconcile.reconcile(paid, got, ["tx_id"], "l_ts", "r_ts", "5 seconds", "3 seconds")
    assert {(r["tx_id"], r["tag"]) for r in tags.collect()} == {
        ("tx1", "matched"), ("tx2", "left_only"), ("tx2", "right_only"), ("tx4", "left_only"), ("tx9", "right_only")
    }


def test_click_limit(spark):
    """121 clicks of one pair in a day: 10 pass, one warning; the day starts at UTC+8."""
    rows = [("u", "ad", 1_511_658_000_000 + i * 1000) for i in range(121)] + [("v", "ad", 1_511_658_000_000)]
    df = ms_table(spark, rows, ["user", "ad"])
    out = patterns.click_limit(df, ["user", "ad"], ["ts", "seq"], "ts", 10)
    assert {tuple(r) for r in out.groupBy("user", "tag").count().collect()} == {("u", "kept", 10), ("u", "warning", 1), ("v", "kept", 1)}
    midnight = int(dt.datetime(2024, 1, 1, 16, tzinfo=dt.timezone.utc).timestamp() * 1000)
    two = ms_table(spark, [("u", "ad", midnight - 1), ("u", "ad", midnight)], ["user", "ad"])
    assert patterns.click_limit(two, ["user", "ad"], ["ts", "seq"], "ts", 1).filter("tag = 'kept'").count() == 2


def test_access_log(spark):
    lines = ["1.2.3.4 - - 17/05/2015:10:05:03 +0000 GET /a/b.html", "broken", "1.2.3.4 - - xx +0000 GET /a"]
    rows = text_source.parse_access_log(spark.createDataFrame([(x,) for x in lines], "value string"))
    good = text_source.accepted(rows).first()
    assert (good["ip"], good["user_id"], good["method"], good["url"]) == ("1.2.3.4", "-", "GET", "/a/b.html")
    assert good["ts"] == dt.datetime(2015, 5, 17, 10, 5, 3)
    assert text_source.rejected(rows).count() == 2


def test_json_payload(spark):
    df = spark.createDataFrame([('{"id":"1","name":"n","phone":"5"}',), ("{",), ("7",)], "value string")
    rows = payload.parse_json(df, schemas.PERSON_JSON, schemas.PERSON_RENAMES)
    assert [(r["id"], r["idphone"]) for r in text_source.accepted(rows).collect()] == [("1", "5")]
    assert text_source.rejected(rows).count() == 2


def test_documents(spark):
    df = spark.createDataFrame([("1", dt.datetime(2024, 2, 3))], "id string, day timestamp")
    row = encode.to_documents(df, "person", None, F.col("day")).first()
    assert row["index"] == "person-20240203" and row["id"] is None and '"id":"1"' in row["source"]


def java_string_hash(s):
    h = 0
    for c in s:
        h = (31 * h + ord(c)) & 0xFFFFFFFF
    return h - (1 << 32) if h >= 1 << 31 else h


def test_hashes(spark):
    words = ["", "abc", "hello world", "été", "x" * 300, "你好"]
    register.register_all(spark)
    df = spark.createDataFrame([(w,) for w in words], "s string")
    for r in df.select("s", text.java_hash(F.col("s")).alias("a"), F.call_function("java_hash", F.col("s")).alias("b")).collect():
        assert r["a"] == r["b"] == java_string_hash(r["s"])
    slot = df.select("s", text.bitmap_slot(F.col("s")).alias("h")).collect()
    for r in slot:
        h = 0
        for c in r["s"]:
            h = h * 61 + ord(c)
        assert r["h"] == h & ((1 << 29) - 1)


def test_registered_functions(spark):
    register.register_all(spark)
    words = spark.sql("SELECT word, length FROM VALUES ('a?bb??') AS t(s), LATERAL split_words(s)").collect()
    assert [tuple(r) for r in words] == [("a", 1), ("bb", 2)]
    row = spark.sql("SELECT weighted_avg_result(sum(v * w), sum(w)) AS x FROM VALUES (1L, 3L), (4L, 1L) AS t(v, w)").first()
    assert row["x"] == 1
    assert spark.sql("SELECT weighted_avg_result(0L, 0L) AS x").first()["x"] is None


def test_partitioning(spark):
    df = spark.range(0, 100).withColumn("k", F.col("id") % 30)
    assert basic.spread_evenly(df, 4).rdd.getNumPartitions() == 4
    sizes = basic.spread_evenly(df, 4).groupBy(F.spark_partition_id()).count().collect()
    assert max(r["count"] for r in sizes) - min(r["count"] for r in sizes) <= 4
    assert df.coalesce(1).rdd.getNumPartitions() == 1
    by_key = basic.partition_by_key(df, 4, "k").select("k", F.spark_partition_id().alias("p")).distinct()
    assert by_key.count() == 30
    ranged = basic.partition_by_bounds(df, "k", [11, 21]).select("k", "pid", F.spark_partition_id().alias("p"))
    assert ranged.filter("p <> pid").count() == 0
    hashed = basic.partition_by_hash(df, "k", 3).select("k", "pid", F.spark_partition_id().alias("p"))
    assert hashed.filter("p <> pid").count() == 0


def test_route_takes_the_first_rule(spark):
    df = spark.createDataFrame([("mary",), ("bob",), (None,)], "user string")
    rules = {"m": F.col("user") == "mary", "any": F.col("user").isNotNull()}
    tagged = basic.route(df, rules)
    assert {(r["user"], r["tag"]) for r in tagged.collect()} == {("mary", "m"), ("bob", "any"), (None, "rest")}


def test_words(spark):
    df = spark.createDataFrame([("hello a",), ("b c",), ("d e",), ("f g",)], "value string")
    assert basic.word_pairs(df).count() == 8


def test_panes_equal_spark_windows(spark):
    rows = [("a", i * 977 % 50_000) for i in range(200)] + [("b", 0), ("b", 50_000), (None, 7)]
    df = ms_table(spark, rows, ["user"])
    for size, slide in (("10 seconds", "10 seconds"), ("10 seconds", "1 second"), ("12 seconds", "4 seconds")):
        a = windows.sliding_count(df, ["user"], "ts", size, slide).select("user", "window_start", "window_end", "cnt")
        b = windows.window_count(df, ["user"], "ts", size, slide).select("user", "window_start", "window_end", "cnt")
        assert sorted(map(str, a.collect())) == sorted(map(str, b.collect()))
    with pytest.raises(ValueError):
        windows.sliding_count(df, ["user"], "ts", "10 seconds", "3 seconds")
