"""The registered queries: each operator over the analytics tables. Columns are named as in ``oracle``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater import schemas
from tidewater.functions import aggregates, register, text, timeexpr
from tidewater.operators import aggregate, basic, bursts, changelog, joins, late, patterns, reconcile, topn, windows
from tidewater.plans.views import Views
from tidewater.sinks import encode, files
from tidewater.session import scratch_path
from tidewater.sources import payload, tables
from tidewater.sources import text as text_source

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn: Callable[[Views], DataFrame]) -> Callable[[Views], DataFrame]:
    QUERIES[fn.__name__] = lambda spark, sf_dir: fn(Views(spark, sf_dir))
    return fn


# -- sources ---------------------------------------------------------------------------------------


@query
def csv_records(v: Views) -> DataFrame:
    b = v.user_behavior
    seconds = timeexpr.cell(timeexpr.micros("ts"), 1_000_000)
    lines = b.select(F.concat_ws(", ", "user_id", "item_id", "category_id", "behavior", seconds).alias("value"))
    return text_source.parse_records(lines, schemas.USER_BEHAVIOR).withColumnRenamed("ts", "sec")


@query
def access_log_parse(v: Views) -> DataFrame:
    rows = text_source.accepted(text_source.parse_access_log(v.access_log))
    return rows.withColumn("ts", F.col("ts").cast("timestamp_ntz"))


@query
def access_log_rejects(v: Views) -> DataFrame:
    return text_source.rejected(text_source.parse_access_log(v.access_log))


@query
def ddl_table_scan(v: Views) -> DataFrame:
    t = tables.table_from_ddl(v.spark, "ddl_events", f"{v.dir}/events.parquet", "parquet")
    return t.select("event_id", "user_id", "event_type", "ts")


@query
def kafka_payload(v: Views) -> DataFrame:
    raw = v.clicks.select(F.col("user_name").cast("binary").alias("key"), F.col("url").cast("binary").alias("value"))
    return payload.message_text(raw)


def _persons(v: Views) -> DataFrame:
    return payload.parse_json(v.person_json, schemas.PERSON_JSON, schemas.PERSON_RENAMES)


@query
def json_to_person(v: Views) -> DataFrame:
    return text_source.accepted(_persons(v))


@query
def json_rejects(v: Views) -> DataFrame:
    return text_source.rejected(_persons(v))


@query
def key_range_scan(v: Views) -> DataFrame:
    cols = ["p_name", "p_brand", "p_size"]
    # The row key is computed from p_partkey; the same bounds on the stored column reach the scan.
    stored = v.key_table.filter("p_partkey >= 10 AND p_partkey < 1000")
    return basic.key_range_scan(stored, "row_key", "00000010", "00001000", cols)


@query
def stream_as_table(v: Views) -> DataFrame:
    tables.stream_as_table(v.page_views, "behavior_table", {"item_id": "item", "behavior": "action", "ts": "rt"}, "rt")
    return v.spark.sql("SELECT item, action, rt FROM behavior_table WHERE action = 'pv'")


@query
def event_time_column(v: Views) -> DataFrame:
    ms = v.events.select("event_id", timeexpr.whole_div(timeexpr.micros("ts"), F.lit(1000)).alias("ms"))
    return tables.with_event_time(ms, "ms").withColumn("et", F.col("et").cast("timestamp_ntz"))


# -- sinks -----------------------------------------------------------------------------------------


@query
def file_sink_roundtrip(v: Views) -> DataFrame:
    path = scratch_path(v.spark, "rolling-sink")
    files.write_csv(v.clicks.select("url", "user_name"), path, rows_per_file=1000)
    return tables.table_from_ddl(v.spark, "rolling_sink", path, "csv", "url STRING, user_name STRING")


@query
def rolling_files(v: Views) -> DataFrame:
    """Files that roll by size, pause and age: what each holds, from the files."""
    path = scratch_path(v.spark, "rolling-files")
    us = timeexpr.micros("ts").cast("string")
    rows = v.events.withColumn("writer", F.col("seq") % 2)
    files.write_rolling(rows, path, "writer", ["seq"], "ts", F.concat_ws(",", "seq", "user_id", "event_type", us), 8192, "3 hours", "2 days")
    lines = v.spark.read.schema("value string, writer bigint, file bigint").text(path)
    at = F.split("value", ",")[3].cast("bigint")
    found = lines.groupBy("writer", "file").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("value") + 1).alias("bytes"), F.min(at).alias("first_us"), F.max(at).alias("last_us")
    )
    return found.select("writer", "file", "n", "bytes", "first_us", "last_us")


@query
def csv_insert(v: Views) -> DataFrame:
    path = scratch_path(v.spark, "csv-sink")
    files.write_csv(v.clicks.filter("user_name = 'u7'").select("url", "user_name"), path)
    return tables.table_from_ddl(v.spark, "csv_sink", path, "csv", "url STRING, user_name STRING")


@query
def csv_file_records(v: Views) -> DataFrame:
    """Delimited lines written to text files and read back from them."""
    path = scratch_path(v.spark, "text-source")
    seconds = timeexpr.cell(timeexpr.micros("ts"), 1_000_000)
    v.user_behavior.select(F.concat_ws(", ", "user_id", "item_id", "category_id", "behavior", seconds)).write.text(path)
    lines = v.spark.read.text(path)
    return text_source.parse_records(lines, schemas.USER_BEHAVIOR).withColumnRenamed("ts", "sec")


@query
def kafka_encode(v: Views) -> DataFrame:
    return encode.to_messages(v.clicks.select("user_name", "url", "seq"), key="user_name")


@query
def to_documents(v: Views) -> DataFrame:
    docs = encode.to_documents(v.clicks.select("user_name", "url", "seq", "ts"), "clicks", "seq", F.col("ts"))
    return docs.select("index", "id", F.get_json_object("source", "$.url").alias("url"))


@query
def upsert_latest(v: Views) -> DataFrame:
    return aggregate.latest_by_key(v.clicks, ["user_name"], ["ts", "seq"])


@query
def upsert_wide_column(v: Views) -> DataFrame:
    line = v.events.select(F.concat_ws(",", "user_id", "event_type", "k").alias("value"), "ts", "seq")
    parts = F.split("value", ",")
    put = line.select(parts[0].alias("row_key"), parts[1].alias("cf1_name"), parts[2].alias("cf1_age"), "ts", "seq")
    return aggregate.latest_by_key(put, ["row_key"], ["ts", "seq"]).select("row_key", "cf1_name", "cf1_age")


@query
def complete_batches(v: Views) -> DataFrame:
    b = aggregate.complete_batches(v.events.select("user_id", "ts", "seq"), ["user_id"], ["ts", "seq"], 10)
    return b.filter("complete").select("user_id", "seq", "batch_id")


# -- projections, filters, partitioning ---------------------------------------------------------------


@query
def map_project(v: Views) -> DataFrame:
    return v.clicks.select("user_name")


@query
def flatmap_fields(v: Views) -> DataFrame:
    ms = timeexpr.whole_div(timeexpr.micros("ts"), F.lit(1000))
    return basic.fields_to_rows(v.clicks, ["user_name", "url", ms])


@query
def word_pairs(v: Views) -> DataFrame:
    return basic.word_pairs(v.table("part").select(F.concat_ws(" ", "p_name", "p_type").alias("value")))


@query
def filter_predicates(v: Views) -> DataFrame:
    b = v.page_views.filter(F.col("ts") > F.lit("2024-01-02").cast("timestamp_ntz"))
    return basic.keep_non_blank(b, "behavior").select("user_id", "item_id", "ts")


@query
def map_length(v: Views) -> DataFrame:
    return v.clicks.select("user_name", F.length("user_name").cast("bigint").alias("len"))


@query
def map_with_setup(v: Views) -> DataFrame:
    def lengths(prefix, batch):
        return batch.assign(tagged=prefix + batch["user_name"], len=batch["user_name"].str.len())

    return basic.rich_map(v.clicks.select("user_name"), lengths, "user_name string, tagged string, len bigint", lambda: "user ")


@query
def table_api_select(v: Views) -> DataFrame:
    return v.clicks.where(F.col("user_name") == "u1").select("url", "user_name")


@query
def sql_project_view(v: Views) -> DataFrame:
    v.clicks.createOrReplaceTempView("click_table")
    return v.spark.sql("SELECT url, user_name FROM click_table WHERE user_name <> 'u1'")


@query
def hash_concat(v: Views) -> DataFrame:
    return v.clicks.select("url", F.concat(text.java_hash(F.col("url")).cast("string"), F.lit("----"), "url").alias("tagged"))


@query
def route_by_value(v: Views) -> DataFrame:
    rules = {"u1": F.col("user_name") == "u1", "u2": F.col("user_name") == "u2"}
    return basic.route(v.clicks, rules).select("tag", "user_name", "url", "seq")


@query
def custom_partition(v: Views) -> DataFrame:
    return basic.partition_by_hash(v.events.select("user_id", "seq"), "user_id", 4).select(
        "user_id", "seq", F.col("pid").cast("bigint").alias("pid")
    )


@query
def range_partition(v: Views) -> DataFrame:
    p = basic.partition_by_bounds(v.events.select("k", "seq"), "k", [11, 21])
    return p.select("k", "seq", F.col("pid").cast("bigint").alias("pid"))


@query
def union_streams(v: Views) -> DataFrame:
    kinds = [v.events.filter(F.col("event_type") == t).select("user_id", "event_type", "ts") for t in ("click", "view")]
    return basic.union_all(kinds)


@query
def connect_map(v: Views) -> DataFrame:
    return basic.connect(
        {
            "clicks": (v.left_stream, [F.col("user_id").alias("who"), F.col("l_ts").alias("at")]),
            "orders": (v.table("orders"), [F.col("o_custkey").alias("who"), F.col("o_orderdate").alias("at")]),
        }
    )


# -- joins -----------------------------------------------------------------------------------------


@query
def window_join(v: Views) -> DataFrame:
    j = joins.window_join(v.left_stream, v.right_stream, ["user_id"], "l_ts", "r_ts", "1 day")
    return j.select("user_id", "l_seq", "r_seq", "window_start", "window_end")


@query
def window_cogroup(v: Views) -> DataFrame:
    return joins.window_cogroup(
        v.left_stream, v.right_stream, ["user_id"], "l_ts", "r_ts", "1 day",
        [F.count("l_seq").alias("l_cnt"), F.sum("l_seq").alias("l_sum")],
        [F.count("r_seq").alias("r_cnt"), F.sum("r_seq").alias("r_sum")],
    )


@query
def interval_join(v: Views) -> DataFrame:
    j = joins.interval_join(v.left_stream, v.right_stream, ["user_id"], "l_ts", "r_ts", "-6 hours", "12 hours")
    return j.select("user_id", "l_seq", "r_seq", "l_ts", "r_ts")


@query
def pay_match_interval(v: Views) -> DataFrame:
    return joins.interval_join(v.pay_log, v.receipt_log, ["tx_id"], "pay_ts", "receipt_ts", "-300 days", "500 days", key_rows=1)


@query
def history_join(v: Views) -> DataFrame:
    return joins.history_join(v.left_stream, v.right_stream, ["user_id"]).select("user_id", "l_seq", "r_seq")


@query
def history_join_outer(v: Views) -> DataFrame:
    creates = v.order_log.filter("action = 'create'").select("order_id", F.col("seq").alias("l_seq"))
    pays = v.order_log.filter("action = 'pay'").select("order_id", F.col("seq").alias("r_seq"))
    return joins.history_join(creates, pays, ["order_id"], "full")


@query
def rule_pair_match(v: Views) -> DataFrame:
    e = v.events.select("user_id", "event_type", "ts", "seq")
    hits = joins.rule_pair_match(e, ["user_id"], ["ts", "seq"], "event_type", v.rules)
    return hits.select("user_id", "seq", "action1", "action2")


@query
def rule_pair_match_latest(v: Views) -> DataFrame:
    e = v.events.select("user_id", "event_type", "ts", "seq")
    hits = joins.rule_pair_match(e, ["user_id"], ["ts", "seq"], "event_type", v.rules, "rule_seq")
    return hits.select("user_id", "seq", "action1", "action2")


@query
def rule_pair_match_asof(v: Views) -> DataFrame:
    """Pairs of actions that form the rule in force at their time; some signups put a new rule in force."""
    e = v.events.select("user_id", "event_type", "ts", "seq")
    hits = joins.rule_pair_match_asof(e, ["user_id"], ["ts", "seq"], "ts", "event_type", v.rule_versions, "valid_from", "rule_seq")
    return hits.select("user_id", "seq", "rule_version", "action1", "action2")


@query
def bill_check(v: Views) -> DataFrame:
    app = v.pay_log.select(F.col("tx_id").alias("order_id"), F.col("pay_ts").alias("app_ts"))
    third = v.receipt_log.select(
        F.col("tx_id").alias("order_id"), F.lit("success").alias("third_status"), F.col("receipt_ts").alias("third_ts")
    )
    tags = ("matched", "app_only", "third_only")
    return reconcile.reconcile(app, third, ["order_id"], "app_ts", "third_ts", "365 days", "0 seconds", tags, 1)


@query
def reconcile_payments(v: Views) -> DataFrame:
    tags = ("matched", "order_only", "receipt_only")
    return reconcile.reconcile(
        v.pay_log, v.receipt_log, ["tx_id"], "pay_ts", "receipt_ts", "500 days", "300 days", tags, 1
    )


@query
def lateral_split(v: Views) -> DataFrame:
    parts = basic.split_to_rows(v.table("pages").select("page_id", "url"), "url")
    return parts.select("page_id", "word", F.col("length").cast("bigint").alias("length"))


# -- aggregations ------------------------------------------------------------------------------------


@query
def running_count(v: Views) -> DataFrame:
    return aggregate.running_count(v.clicks.select("user_name", "ts", "seq"), ["user_name"], ["ts", "seq"])


@query
def most_active_user(v: Views) -> DataFrame:
    return aggregate.most_active(v.clicks, "user_name", ["ts", "seq"])


@query
def most_active_running(v: Views) -> DataFrame:
    return aggregate.most_active_running(v.clicks, "user_name", ["ts", "seq"])


@query
def latest_visit(v: Views) -> DataFrame:
    return aggregate.latest_by_key(v.clicks, ["user_name"], ["ts", "seq"]).select("user_name", "url", "ts")


@query
def sql_group_count(v: Views) -> DataFrame:
    v.clicks.createOrReplaceTempView("click_table")
    return v.spark.sql("SELECT user_name, count(url) AS cnt FROM click_table GROUP BY user_name")


@query
def changelog_counts(v: Views) -> DataFrame:
    return changelog.count_changelog(v.clicks, ["user_name"], ["ts", "seq"]).select("user_name", "seq", "row_kind", "cnt")


@query
def apply_changelog(v: Views) -> DataFrame:
    return changelog.apply_changelog(v.changelog, ["user_id"], ["ts", "seq"]).select("user_id", "n", "seq")


@query
def weighted_avg(v: Views) -> DataFrame:
    weight = F.floor("value").cast("bigint")
    return v.events.groupBy("user_id").agg(aggregates.weighted_avg(F.col("k"), weight).alias("wavg"))


@query
def table_agg_top2(v: Views) -> DataFrame:
    counts = windows.window_count(v.clicks, ["user_name"], "ts", "1 hour")
    return topn.top_values(counts, ["window_start", "window_end"], "cnt", 2, ["user_name"])


@query
def window_count_user(v: Views) -> DataFrame:
    return windows.window_count(v.clicks, ["user_name"], "ts", "1 hour")


@query
def window_avg_ts(v: Views) -> DataFrame:
    return aggregate.mean_time(v.clicks, ["user_name"], "ts", "1 day")


@query
def window_pv_uv(v: Views) -> DataFrame:
    return aggregate.pv_uv(v.clicks, "user_name", "ts", "6 hours")


@query
def window_uv(v: Views) -> DataFrame:
    return aggregate.unique_count(v.clicks, [], "user_name", "ts", "6 hours")


@query
def window_url_count(v: Views) -> DataFrame:
    return windows.window_count(v.clicks, ["url"], "ts", "6 hours")


@query
def hourly_pv(v: Views) -> DataFrame:
    return windows.window_count(v.page_views, [], "ts", "1 hour")


@query
def hourly_pv_salted(v: Views) -> DataFrame:
    return windows.salted_count(v.page_views, "ts", "1 hour", "seq")


@query
def hourly_uv(v: Views) -> DataFrame:
    return aggregate.unique_count(v.page_views, [], "user_id", "ts", "1 hour")


@query
def uv_bitmap(v: Views) -> DataFrame:
    return aggregate.unique_count_bitmap(v.page_views, "user_id", "ts", "1 hour")


@query
def uv_running(v: Views) -> DataFrame:
    r = aggregate.unique_running(v.page_views, "user_id", "ts", "seq", "1 hour")
    return r.select("window_end", "user_id", "seq", "uv")


@query
def uv_hll(v: Views) -> DataFrame:
    """The exact count of each hour, and whether the sketch is within 5 % of it."""
    sketch = aggregate.unique_count_sketch(v.page_views, "user_id", "ts", "1 hour")
    sketch = sketch.select("window_start", "window_end", F.col("uv").alias("_guess"))
    exact = QUERIES["hourly_uv"](v.spark, v.dir)
    near = F.abs(F.col("_guess") - F.col("uv")) <= 0.05 * F.col("uv")
    return exact.join(sketch, ["window_start", "window_end"]).withColumn("within_bound", near).drop("_guess")


@query
def marketing_total(v: Views) -> DataFrame:
    m = v.marketing.withColumn("name", F.lit("total"))
    return windows.sliding_count(m, ["name"], "ts", "1 hour", "1 minute")


@query
def marketing_by_channel(v: Views) -> DataFrame:
    m = v.marketing.filter("behavior <> 'UNINSTALL'")
    return windows.sliding_count(m, ["channel", "behavior"], "ts", "1 hour", "5 minutes")


def _limited_clicks(v: Views, tag: str) -> DataFrame:
    limited = patterns.click_limit(v.ad_click, ["user_id", "ad_id"], ["ts", "seq"], "ts", 1)
    return basic.output(limited, tag).join(v.user_place, "user_id")


@query
def ad_clicks_by_province(v: Views) -> DataFrame:
    return windows.sliding_count(_limited_clicks(v, "kept"), ["province"], "ts", "1 hour", "5 minutes")


@query
def every_n_average(v: Views) -> DataFrame:
    return aggregate.every_n_mean_time(v.clicks, ["user_name"], ["ts", "seq"], "ts", 5)


@query
def keyed_state_view(v: Views) -> DataFrame:
    s = aggregate.keyed_state(v.clicks, ["user_name"], ["ts", "seq"], "url")
    return s.select("user_name", "seq", "url", "list_size", "map_count", "first_url", "ts", "agg_result")


# -- windows and late data ---------------------------------------------------------------------------


@query
def sliding_count(v: Views) -> DataFrame:
    return windows.sliding_count(v.user_behavior, ["category_id"], "ts", "1 hour", "5 minutes")


@query
def sliding_count_panes(v: Views) -> DataFrame:
    return windows.sliding_count(v.user_behavior, ["category_id"], "ts", "1 hour", "5 minutes")


@query
def session_sum(v: Views) -> DataFrame:
    cents = F.round(F.col("value") * 100).cast("bigint")
    return windows.session_agg(v.events, ["user_id"], "ts", "6 hours", {"cents": cents})


@query
def sql_tumble(v: Views) -> DataFrame:
    v.clicks.createOrReplaceTempView("click_table")
    return v.spark.sql(
        """SELECT user_name, window.end AS end_ts, count(url) AS cnt
           FROM click_table GROUP BY user_name, window(ts, '1 hour')"""
    )


@query
def tvf_tumble(v: Views) -> DataFrame:
    return windows.assign_window(v.clicks, "ts", "10 seconds").select("user_name", "seq", "window_start", "window_end")


@query
def tvf_cumulate(v: Views) -> DataFrame:
    return windows.cumulate_count(v.user_behavior, ["category_id"], "ts", "1 hour", "1 day")


# Hopping counts in SQL: count per pane, then let each pane enter the windows it belongs to.
HOP_COUNTS = """
    SELECT item_id, window_end, sum(n) AS cnt
    FROM (SELECT item_id, n, explode(sequence(w.end, w.end + INTERVAL 55 MINUTES, INTERVAL 5 MINUTES)) AS window_end
          FROM (SELECT item_id, window(ts, '5 minutes') AS w, count(item_id) AS n
                FROM page_views GROUP BY item_id, window(ts, '5 minutes')))
    GROUP BY item_id, window_end"""


@query
def sql_hop(v: Views) -> DataFrame:
    v.page_views.createOrReplaceTempView("page_views")
    return v.spark.sql(HOP_COUNTS)


@query
def api_slide(v: Views) -> DataFrame:
    return windows.sliding_count(v.page_views, ["item_id"], "ts", "1 hour", "5 minutes").drop("window_start")


@query
def manual_window(v: Views) -> DataFrame:
    return windows.window_count(v.clicks, ["user_name"], "ts", "10 minutes")


@query
def evict_last_n(v: Views) -> DataFrame:
    kept = windows.keep_newest(v.events, ["user_id"], "ts", "1 day", 2, ["ts", "seq"])
    return kept.groupBy("user_id", "window_start", "window_end").agg(F.sum("k").alias("total"))


@query
def evict_last_span(v: Views) -> DataFrame:
    kept = windows.keep_last_span(v.events.select("user_id", "k", "ts"), ["user_id"], "ts", "1 day", "2 hours")
    return kept.groupBy("user_id", "window_start", "window_end").agg(F.sum("k").alias("total"))


@query
def late_status(v: Views) -> DataFrame:
    s = late.late_status(v.disordered, ["arrival", "event_id"], "ts", "10 minutes", "1 hour", "30 minutes")
    return s.select("event_id", "status")


@query
def late_corrected(v: Views) -> DataFrame:
    """Hourly counts when a window closes, and after the rows that its lateness still lets in."""
    s = late.late_status(v.disordered, ["arrival", "event_id"], "ts", "10 minutes", "1 hour", "30 minutes")
    hour = timeexpr.duration_us("1 hour")
    start = timeexpr.cell(timeexpr.micros("ts"), hour) * F.lit(hour)
    on_time = F.count(F.when(F.col("status") == late.ON_TIME, 1))
    counts = s.filter(F.col("status") != late.TOO_LATE).groupBy(start.alias("_us")).agg(on_time.alias("first_cnt"), F.count(F.lit(1)).alias("cnt"))
    ends = [timeexpr.from_micros(F.col("_us") + F.lit(d), v.events, "ts").alias(n) for d, n in ((0, "window_start"), (hour, "window_end"))]
    return counts.select(*ends, "first_cnt", "cnt")


@query
def late_split(v: Views) -> DataFrame:
    s = late.late_status(v.disordered, ["arrival", "event_id"], "ts", "1 hour", "1 hour")
    return s.filter(F.col("status") == late.TOO_LATE).select("event_id", "arrival", "ts")


@query
def watermark_trace(v: Views) -> DataFrame:
    w = late.watermark_trace(v.disordered, ["arrival", "event_id"], "ts", "5 seconds")
    return w.select("event_id", "watermark")


@query
def watermark_idle(v: Views) -> DataFrame:
    """The watermark of four sources, of which one is silent at times."""
    rows = v.disordered.withColumn("source", F.col("user_id") % 4)
    rows = rows.filter("NOT (source = 3 AND (event_id DIV 200) % 2 = 1)")
    w = late.watermark_of_sources(rows, ["arrival", "event_id"], "source", range(4), "ts", "10 minutes", "arrival", 60)
    return w.select("event_id", "source", "watermark")


@query
def periodic_pv(v: Views) -> DataFrame:
    return late.periodic_count(v.clicks, ["user_name"], "ts", "1 day")


# -- top-n -------------------------------------------------------------------------------------------


@query
def hot_items(v: Views) -> DataFrame:
    pv = v.page_views
    return topn.hot_by_window(pv, "item_id", "ts", "1 hour", "5 minutes", 10)


@query
def hot_items_sql(v: Views) -> DataFrame:
    v.page_views.createOrReplaceTempView("page_views")
    return v.spark.sql(
        f"""WITH counts AS ({HOP_COUNTS}),
           ranked AS (
             SELECT *, row_number() OVER (PARTITION BY window_end ORDER BY cnt DESC, item_id) AS rn FROM counts)
           SELECT window_end, item_id, cnt, CAST(rn AS BIGINT) AS rn FROM ranked WHERE rn <= 5"""
    )


@query
def hot_pages(v: Views) -> DataFrame:
    # The watermark is that of all rows; only then rows of other kinds are left out.
    seen = late.closed_until(v.disordered, ["arrival", "event_id"], "ts", "1 minute", "1 minute")
    gets = seen.filter(text.equals_ignore_case(F.col("event_type"), "VIEW"))
    gets = gets.withColumn("url", F.concat(F.lit("/"), (F.col("k") % 20).cast("string")))
    return topn.hot_by_window(gets, "url", "ts", "10 minutes", "1 minute", 3, F.col("closed_us"))


@query
def hot_pages_late(v: Views) -> DataFrame:
    """Rows that come too late for all their sliding windows, the lateness included."""
    s = late.late_status(v.disordered, ["arrival", "event_id"], "ts", "1 minute", "10 minutes", "1 minute", "1 minute")
    gets = s.filter(text.equals_ignore_case(F.col("event_type"), "VIEW"))
    return gets.filter(F.col("status") == late.TOO_LATE).select("event_id", "arrival", "ts")


@query
def window_top2_users(v: Views) -> DataFrame:
    return topn.top_by_tumbling(v.clicks, "user_name", "ts", "1 hour", 2)


# -- patterns ----------------------------------------------------------------------------------------


def _login_matches(v: Views, within: str | None, n: int = 3) -> DataFrame:
    steps = patterns.times("fail", F.col("status") == "fail", n)
    m = patterns.match_strict(v.login, ["user_id"], ["ts", "seq"], "ts", steps, within)
    names = [s.name for s in steps]
    return m.select(
        "user_id",
        *[F.col(f"{s}.seq").alias(f"{s}_seq") for s in names],
        F.col(f"{names[0]}.ts").alias("first_ts"),
        F.col(f"{names[-1]}.ts").alias("last_ts"),
    )


@query
def pattern_next(v: Views) -> DataFrame:
    kind = F.col("event_type")
    steps = [patterns.Step("a", kind == "view"), patterns.Step("b", kind == "click"), patterns.Step("c", kind == "purchase")]
    m = patterns.match_strict(v.events, ["user_id"], ["ts", "seq"], "ts", steps)
    return m.select("user_id", *[F.col(f"{s.name}.seq").alias(f"{s.name}_seq") for s in steps])


@query
def pattern_times(v: Views) -> DataFrame:
    return _login_matches(v, None)


@query
def login_fail_alert(v: Views) -> DataFrame:
    return _login_matches(v, "2 days")


@query
def login_fail_timer(v: Views) -> DataFrame:
    failed = F.col("status") == "fail"
    return bursts.failure_bursts(v.login, ["user_id"], ["ts", "seq"], "ts", failed, 3, "1 day")


@query
def pattern_followed_by(v: Views) -> DataFrame:
    kind = F.col("event_type")
    steps = [patterns.Step("a", kind == "signup"), patterns.Step("b", kind == "purchase")]
    m = patterns.match_relaxed(v.events, ["user_id"], ["ts", "seq"], "ts", steps, "1 day")
    return m.select("user_id", F.col("a.seq").alias("a_seq"), F.col("b.seq").alias("b_seq"), "status")


@query
def pattern_three_steps(v: Views) -> DataFrame:
    kind = F.col("event_type")
    steps = [patterns.Step("a", kind == "signup"), patterns.Step("b", kind == "click"), patterns.Step("c", kind == "purchase")]
    m = patterns.match_relaxed(v.events, ["user_id"], ["ts", "seq"], "ts", steps, "3 days")
    return m.select("user_id", *[F.col(f"{s.name}.seq").alias(f"{s.name}_seq") for s in steps], "status")


@query
def order_timeout(v: Views) -> DataFrame:
    action = F.col("action")
    steps = [patterns.Step("create", action == "create"), patterns.Step("pay", action == "pay")]
    m = patterns.match_relaxed(v.order_log, ["order_id"], ["ts", "seq"], "ts", steps, "5 days")
    return m.select(
        "order_id", F.col("create.seq").alias("create_seq"), F.col("pay.seq").alias("pay_seq"), "status"
    )


@query
def ad_blacklist(v: Views) -> DataFrame:
    return _limited_clicks(v, "warning").select("user_id", "ad_id", "seq", F.lit("click over 1 times").alias("msg"))


@query
def ad_clicks_kept(v: Views) -> DataFrame:
    return _limited_clicks(v, "kept").select("user_id", "ad_id", "province", "ts", "seq")


@query
def order_status(v: Views) -> DataFrame:
    return patterns.order_status(v.order_log, ["order_id"], "action", "ts", "5 days")


@query
def ttl_last_value(v: Views) -> DataFrame:
    e = v.events.select("user_id", "event_type", "ts", "seq")
    return patterns.last_value_with_ttl(e, ["user_id"], ["ts", "seq"], "ts", "event_type", "6 hours").select(
        "user_id", "seq", "last_value"
    )


# -- user-defined functions ---------------------------------------------------------------------------


@query
def java_hash(v: Views) -> DataFrame:
    return v.table("part").select("p_partkey", text.java_hash(F.col("p_name")).alias("h"))


@query
def udf_from_sql(v: Views) -> DataFrame:
    register.register_all(v.spark)
    v.table("pages").createOrReplaceTempView("page_table")
    return v.spark.sql(
        """SELECT page_id, word, CAST(length AS BIGINT) AS length, java_hash(word) AS h
           FROM page_table, LATERAL split_words(url)"""
    )
