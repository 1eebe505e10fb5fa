"""Adapter views: the record types of the operators, over the analytics tables."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.session import prepare

# How event types stand for the actions of each feed.
BEHAVIOR = {"view": "pv", "click": "cart", "purchase": "buy", "error": "fav", "signup": "uv"}
ORDER_ACTION = {"signup": "create", "purchase": "pay"}
MARKETING = {"click": "CLICK", "view": "DOWNLOAD", "purchase": "INSTALL", "error": "UNINSTALL"}
ROW_KIND = {"signup": "+I", "view": "+U", "purchase": "+U", "click": "-U", "error": "-D"}
CHANNELS = ("app store", "wechat", "weibo")


def _recode(col: Column, names: dict[str, str]) -> Column:
    out = None
    for old, new in names.items():
        out = F.when(col == old, new) if out is None else out.when(col == old, new)
    return out


class Views:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = prepare(spark)
        self.dir = sf_dir.rstrip("/")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.dir}/{name}.parquet")

    @cached_property
    def events(self) -> DataFrame:
        """``events`` with ``k``, the number in ``props``, and ``seq``."""
        k = F.regexp_extract("props", "[0-9]+", 0).cast("bigint")
        return self.table("events").withColumn("k", k).withColumn("seq", F.col("event_id"))

    @cached_property
    def clicks(self) -> DataFrame:
        return self.events.select(
            F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("user_name"),
            F.concat(F.lit("/"), "event_type", F.lit("?k="), F.col("k").cast("string")).alias("url"),
            "ts",
            "seq",
        )

    @cached_property
    def user_behavior(self) -> DataFrame:
        return self.events.select(
            "user_id",
            F.col("k").alias("item_id"),
            (F.col("k") % 10).alias("category_id"),
            _recode(F.col("event_type"), BEHAVIOR).alias("behavior"),
            "ts",
            "seq",
        )

    @cached_property
    def page_views(self) -> DataFrame:
        """``user_behavior`` rows of behaviour ``pv``, filtered on the stored column so that the scan can skip."""
        rows = self.events.filter("event_type = 'view'")
        return rows.select(
            "user_id", F.col("k").alias("item_id"), (F.col("k") % 10).alias("category_id"), F.lit("pv").alias("behavior"),
            "ts", "seq",
        )

    @cached_property
    def login(self) -> DataFrame:
        ip = F.concat_ws(".", F.lit("10.0"), (F.col("user_id") % 256).cast("string"), F.col("k").cast("string"))
        status = F.when(F.col("event_type") == "error", "fail").otherwise("success")
        return self.events.select("user_id", ip.alias("ip"), status.alias("status"), "ts", "seq")

    @cached_property
    def order_log(self) -> DataFrame:
        rows = self.events.filter(F.col("event_type").isin(*ORDER_ACTION))
        return rows.select(
            (F.col("user_id") * 10 + F.col("k") % 10).alias("order_id"),
            "user_id",
            _recode(F.col("event_type"), ORDER_ACTION).alias("action"),
            "ts",
            "seq",
        )

    @cached_property
    def pay_log(self) -> DataFrame:
        return self.table("orders").select(F.col("o_orderkey").alias("tx_id"), F.col("o_orderdate").alias("pay_ts"))

    @cached_property
    def receipt_log(self) -> DataFrame:
        receipts = self.table("lineitem").groupBy(F.col("l_orderkey").alias("tx_id"))
        return receipts.agg(F.min("l_shipdate").alias("receipt_ts"))

    @cached_property
    def ad_click(self) -> DataFrame:
        rows = self.events.filter("event_type = 'click'")
        return rows.select("user_id", (F.col("k") % 5).alias("ad_id"), "ts", "seq")

    @cached_property
    def user_place(self) -> DataFrame:
        """Province and city of each user. Join it after the click limit, when few rows per user are left."""
        return (
            self.table("customer")
            .join(self.table("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
            .join(self.table("region"), F.col("n_regionkey") == F.col("r_regionkey"))
            .select(F.col("c_custkey").alias("user_id"), F.col("n_name").alias("province"), F.col("r_name").alias("city"))
        )

    @cached_property
    def access_log(self) -> DataFrame:
        """Access-log lines; each 97th is damaged."""
        method = F.when(F.col("event_type").isin("view", "click"), "GET").otherwise("POST")
        line = F.concat_ws(
            " ",
            F.concat(F.lit("10.0.0."), (F.col("user_id") % 256).cast("string")),
            F.col("user_id").cast("string"),
            F.lit("-"),
            F.date_format("ts", "dd/MM/yyyy:HH:mm:ss"),
            F.lit("+0000"),
            method,
            F.concat(F.lit("/"), "event_type", F.lit("/"), F.col("k").cast("string")),
        )
        bad = F.concat(F.lit("damaged "), F.col("seq").cast("string"))
        return self.events.select(F.when(F.col("seq") % 97 == 0, bad).otherwise(line).alias("value"), "seq")

    @cached_property
    def marketing(self) -> DataFrame:
        channel = F.element_at(F.array(*[F.lit(c) for c in CHANNELS]), (F.col("k") % 3 + 1).cast("int"))
        rows = self.events.filter(F.col("event_type").isin(*MARKETING))
        return rows.select(
            "user_id", _recode(F.col("event_type"), MARKETING).alias("behavior"), channel.alias("channel"), "ts", "seq"
        )

    @cached_property
    def person_json(self) -> DataFrame:
        """JSON lines of persons; each 50th is damaged."""
        key = F.col("c_custkey").cast("string")
        text = F.concat(
            F.lit('{"id":"'), key, F.lit('","name":"'), "c_name", F.lit('","address":"nation '),
            F.col("c_nationkey").cast("string"), F.lit('","job":"'), "c_mktsegment", F.lit('","phone":"555-'), key,
            F.lit('"}'),
        )
        bad = F.concat(F.lit('{"id":'), key, F.lit(',"name"'))
        return self.table("customer").select(F.when(F.col("c_custkey") % 50 == 0, bad).otherwise(text).alias("value"))

    @cached_property
    def left_stream(self) -> DataFrame:
        rows = self.events.filter("event_type = 'click'")
        return rows.select("user_id", F.col("ts").alias("l_ts"), F.col("seq").alias("l_seq"))

    @cached_property
    def right_stream(self) -> DataFrame:
        rows = self.events.filter("event_type = 'purchase'")
        return rows.select("user_id", F.col("ts").alias("r_ts"), F.col("seq").alias("r_seq"))

    @cached_property
    def rules(self) -> DataFrame:
        rows = [(1, "view", "purchase"), (2, "click", "purchase")]
        return self.spark.createDataFrame(rows, "rule_seq bigint, action1 string, action2 string")

    @cached_property
    def rule_versions(self) -> DataFrame:
        """Rules with the time from which on they hold."""
        first = F.element_at(F.array(*[F.lit(x) for x in ("view", "click", "error")]), (F.col("user_id") % 3 + 1).cast("int"))
        rows = self.events.filter("event_type = 'signup' AND k % 10 = 7")
        return rows.select(F.col("ts").alias("valid_from"), F.col("seq").alias("rule_seq"), first.alias("action1"), F.lit("purchase").alias("action2"))

    @cached_property
    def key_table(self) -> DataFrame:
        return self.table("part").withColumn("row_key", F.lpad(F.col("p_partkey").cast("string"), 8, "0"))

    @cached_property
    def disordered(self) -> DataFrame:
        """Events with an arrival number that differs from event-time order."""
        arrival = F.col("event_id") + (F.lit(7919) * F.col("event_id")) % 50
        return self.events.withColumn("arrival", arrival)

    @cached_property
    def changelog(self) -> DataFrame:
        kind = _recode(F.col("event_type"), ROW_KIND).alias("row_kind")
        return self.events.select("user_id", F.col("k").alias("n"), kind, "ts", "seq")
