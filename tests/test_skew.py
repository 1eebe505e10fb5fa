"""Operators give the same rows when one key holds most of the data and must be split over tasks."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from tidewater.operators import aggregate, changelog, joins, late, patterns, reconcile
from tidewater.plans import ordered, skew
from tidewater.plans.skew import SkewPolicy
from tidewater.plans.views import Views

TINY = SkewPolicy(rows_per_task=60, broadcast_rows=1000)
ORDER = ["ts", "seq"]


@pytest.fixture(scope="module")
def events(spark, sf):
    """Events in which user 0 holds about half of the rows and user NULL a tenth; ties in time included."""
    v = Views(spark, sf)
    user = F.when(F.col("seq") % 2 == 0, F.lit(0)).when(F.col("seq") % 10 == 1, F.lit(None)).otherwise(F.col("user_id"))
    df = v.events.select(
        user.cast("bigint").alias("user_id"), "event_type", F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("ts"), "k", "seq"
    )
    return df.cache()


def same(plain, split):
    assert sorted(plain.columns) == sorted(split.columns)
    a = Counter(map(str, plain.select(*sorted(plain.columns)).collect()))
    b = Counter(map(str, split.select(*sorted(plain.columns)).collect()))
    assert a == b
    assert sum(a.values()) > 0


def test_hot_keys_are_found_and_bounded(events):
    hot = skew.find_hot_keys(events, ["user_id"], TINY)
    assert {r["user_id"] for r in hot.table.collect()} == {0, None}
    assert skew.find_hot_keys(events, ["user_id"]) is None
    every = skew.find_hot_keys(events, ["user_id"], SkewPolicy(1))
    counts = events.groupBy("user_id").count().filter("count > 1")
    assert every.count == counts.count() == every.table.count()  # no key is left out


def test_left_join_with_hot_right_keys(events):
    left = events.select("user_id", F.col("seq").alias("l"), F.col("k").alias("lk")).filter("l % 7 = 0")
    right = events.select("user_id", F.col("seq").alias("r"), F.col("k").alias("rk")).filter("r % 3 = 0")
    for condition in (None, F.col("rk") < F.col("lk")):
        plain = skew.skew_join(left, right, ["user_id"], "left", condition)
        same(plain, skew.skew_join(left, right, ["user_id"], "left", condition, TINY))
    few = left.filter("user_id = 0").limit(3)
    same(skew.skew_join(few, right, ["user_id"], "left"), skew.skew_join(few, right, ["user_id"], "left", policy=TINY))


def test_successors_without_keys(events):
    args = ([], ["seq"], F.struct("seq"), 3, "x")
    same(ordered.following(events, *args), ordered.following(events, *args, policy=TINY))


KEYED = {
    "number": lambda d, p: ordered.number_rows(d, ["user_id"], ORDER, total="n", policy=p),
    "previous": lambda d, p: ordered.nearest(d, ["user_id"], ORDER, F.struct("seq", "k"), "x", policy=p),
    "next": lambda d, p: ordered.nearest(d, ["user_id"], ORDER, F.struct("seq"), "x", later=True, policy=p),
    "next_where": lambda d, p: ordered.nearest(
        d, ["user_id"], ORDER, F.struct("seq"), "x", F.col("event_type") == "purchase", True, policy=p
    ),
    "previous_where": lambda d, p: ordered.nearest(
        d, ["user_id"], ORDER, F.struct("seq"), "x", F.col("event_type") == "signup", policy=p
    ),
    "rare_next": lambda d, p: ordered.nearest(
        d, ["user_id"], ORDER, F.struct("seq"), "x", F.col("seq") % 250 == 0, True, policy=p
    ),
    "running_max": lambda d, p: ordered.running_max(d, ["user_id"], ["seq"], F.col("k"), "m", policy=p),
    "running_max_all": lambda d, p: ordered.running_max(d, [], ["seq"], F.col("k"), "m", include_self=False, policy=p),
    "following": lambda d, p: ordered.following(d, ["user_id"], ORDER, F.struct("seq"), 4, "x", policy=p),
    "changelog": lambda d, p: changelog.count_changelog(d, ["user_id"], ORDER, policy=p),
    "batches": lambda d, p: aggregate.complete_batches(d, ["user_id"], ORDER, 7, policy=p),
    "every_n": lambda d, p: aggregate.every_n_mean_time(d, ["user_id"], ORDER, "ts", 5, policy=p),
    "state": lambda d, p: aggregate.keyed_state(d, ["user_id"], ORDER, "event_type", policy=p),
    "uv_running": lambda d, p: aggregate.unique_running(
        d.withColumn("visitor", F.col("seq") % 300), "visitor", "ts", "seq", "5 days", policy=p
    ),
    "most_active": lambda d, p: aggregate.most_active_running(d, "user_id", ORDER, policy=p),
    "ttl": lambda d, p: patterns.last_value_with_ttl(d, ["user_id"], ORDER, "ts", "k", "3 hours", policy=p),
    "late": lambda d, p: late.late_status(d, ["seq"], "ts", "1 hour", "1 hour", policy=p),
    "periodic": lambda d, p: late.periodic_count(d, ["user_id"], "ts", "1 day", policy=p),
    "strict": lambda d, p: patterns.match_strict(
        d, ["user_id"], ORDER, "ts", patterns.times("t", F.col("event_type").isin("view", "click"), 3), "2 days", p
    ),
    "relaxed": lambda d, p: patterns.match_relaxed(
        d,
        ["user_id"],
        ORDER,
        "ts",
        [patterns.Step(s, F.col("event_type") == s) for s in ("signup", "click", "purchase")],
        "1 day",
        p,
    ),
}


@pytest.mark.parametrize("name", list(KEYED))
def test_split_keys_give_the_same_rows(events, name):
    same(KEYED[name](events, skew.DEFAULT), KEYED[name](events, TINY))


def sides(events):
    left = events.filter("event_type in ('click', 'view')").select("user_id", F.col("ts").alias("l_ts"), F.col("seq").alias("l_seq"))
    right = events.filter("event_type in ('purchase', 'error')").select(
        "user_id", F.col("ts").alias("r_ts"), F.col("seq").alias("r_seq")
    )
    return left, right


JOINS = {
    "window": lambda a, b, p: joins.window_join(a, b, ["user_id"], "l_ts", "r_ts", "10 days", p),
    "interval": lambda a, b, p: joins.interval_join(a, b, ["user_id"], "l_ts", "r_ts", "-6 hours", "12 hours", policy=p),
    "interval_wide": lambda a, b, p: joins.interval_join(a, b, ["user_id"], "l_ts", "r_ts", "0 hours", "9 days", policy=p),
    "interval_point": lambda a, b, p: joins.interval_join(a, b, ["user_id"], "l_ts", "r_ts", "1 hours", "1 hours", policy=p),
    "interval_left": lambda a, b, p: joins.interval_join(
        a, b, ["user_id"], "l_ts", "r_ts", "-6 hours", "12 hours", "left", None, p
    ),
    "history": lambda a, b, p: joins.history_join(a, b, ["user_id"], policy=p),
    "history_full": lambda a, b, p: joins.history_join(a, b, ["user_id"], "full", p),
    "history_full_one_sided": lambda a, b, p: joins.history_join(a, b.filter("user_id > 0"), ["user_id"], "full", p),
    "reconcile": lambda a, b, p: reconcile.reconcile(a, b, ["user_id"], "l_ts", "r_ts", "2 hours", "1 hours", policy=p),
}


@pytest.mark.parametrize("name", list(JOINS))
def test_split_joins_give_the_same_rows(events, name):
    left, right = sides(events)
    same(JOINS[name](left, right, skew.DEFAULT), JOINS[name](left, right, TINY))


def test_rules_match_with_hot_key(events, spark):
    rules = spark.createDataFrame([("view", "purchase"), ("click", "error")], "action1 string, action2 string")

    def run(p):
        return joins.rule_pair_match(events, ["user_id"], ORDER, "event_type", rules, policy=p)

    same(run(skew.DEFAULT), run(TINY))


def test_large_rule_table_is_not_broadcast(spark):
    df = spark.range(50)
    plan = skew.bounded_broadcast(df, SkewPolicy(broadcast_rows=10))._jdf.queryExecution().analyzed().toString()
    assert "broadcast" not in plan
    plan = skew.bounded_broadcast(df, SkewPolicy(broadcast_rows=50))._jdf.queryExecution().analyzed().toString()
    assert "broadcast" in plan


def test_failure_bursts_with_long_runs(events):
    """Folding and jumping give the same spans, and both agree with a plain loop."""
    import datetime as dt

    from tidewater.operators.bursts import failure_bursts

    failed = F.col("event_type") != "signup"
    width = dt.timedelta(hours=5)

    def run(policy, fold_rows):
        return failure_bursts(events, ["user_id"], ORDER, "ts", failed, 2, "5 hours", policy, fold_rows)

    same(run(skew.DEFAULT, 1000), run(TINY, 2))
    want = Counter()
    rows = sorted(events.collect(), key=lambda r: (str(r["user_id"]), r["ts"], r["seq"]))
    state = {}

    def close(user):
        first, last, n = state.pop(user)
        if n >= 2:
            want[(user, first, last, n)] += 1

    for r in rows:
        user, ts = r["user_id"], r["ts"]
        if user in state and ts > state[user][0] + width:
            close(user)
        if r["event_type"] == "signup":
            state.pop(user, None)
        elif user in state:
            first, _, n = state[user]
            state[user] = (first, ts, n + 1)
        else:
            state[user] = (ts, ts, 1)
    for user in list(state):
        close(user)
    got = Counter(tuple(r) for r in run(skew.DEFAULT, 1000).collect())
    assert got == want
