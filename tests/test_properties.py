"""Random inputs against plain Python loops."""

import datetime as dt
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tidewater.functions.timeexpr import millis_to_ts
from tidewater.operators import aggregate, joins, late, patterns, windows
from tidewater.plans.skew import SkewPolicy

EPOCH = dt.datetime(1970, 1, 1)
SMALL = SkewPolicy(rows_per_task=25)


def ms(t):
    return round((t - EPOCH) / dt.timedelta(milliseconds=1))


def table(spark, seed, n=150, keys=4, span=20_000):
    """Rows (key, kind, ms, seq): many ties in time, one key with half of the rows."""
    rnd = random.Random(seed)
    rows = [
        ("k0" if rnd.random() < 0.5 else f"k{rnd.randrange(keys)}", rnd.choice("abc"), rnd.randrange(0, span, 250), i)
        for i in range(n)
    ]
    df = spark.createDataFrame(rows, "key string, kind string, ms bigint, seq bigint")
    return rows, df.withColumn("ts", millis_to_ts(F.col("ms")).cast("timestamp_ntz"))


def by_key(rows):
    groups = defaultdict(list)
    for key, kind, t, seq in sorted(rows, key=lambda r: (r[2], r[3])):
        groups[key].append((kind, t, seq))
    return groups


@pytest.mark.parametrize("seed", [1, 2])
def test_relaxed_pattern(spark, seed):
    rows, df = table(spark, seed)
    steps = [patterns.Step(s, F.col("kind") == s) for s in "abc"]
    got = Counter()
    for policy in (SMALL, SkewPolicy()):
        m = patterns.match_relaxed(df, ["key"], ["ts", "seq"], "ts", steps, "3 seconds", policy)
        out = Counter((r["key"], *[r[s]["seq"] if r[s] else None for s in "abc"], r["status"]) for r in m.collect())
        assert not got or got == out
        got = out
    want = Counter()
    for key, events in by_key(rows).items():
        for i, (kind, t, seq) in enumerate(events):
            if kind != "a":
                continue
            chain, at = [seq], t
            for k2, t2, s2 in events[i + 1 :]:
                if len(chain) < 3 and k2 == "abc"[len(chain)]:
                    chain.append(s2)
                    at = t2
            if len(chain) == 3 and at - t < 3000:
                want[(key, *chain, "matched")] += 1
            else:
                want[(key, seq, None, None, "timeout")] += 1
    assert got == want


@pytest.mark.parametrize("seed", [3, 4])
def test_strict_pattern(spark, seed):
    rows, df = table(spark, seed)
    steps = [patterns.Step("x", F.col("kind") != "c"), patterns.Step("y", F.col("kind") == "b"), patterns.Step("z", F.col("kind") != "a")]
    want = Counter()
    for key, events in by_key(rows).items():
        for x, y, z in zip(events, events[1:], events[2:]):
            if x[0] != "c" and y[0] == "b" and z[0] != "a" and z[1] - x[1] < 1500:
                want[(key, x[2], y[2], z[2])] += 1
    for policy in (SMALL, SkewPolicy()):
        m = patterns.match_strict(df, ["key"], ["ts", "seq"], "ts", steps, "1500 milliseconds", policy)
        assert Counter((r["key"], r["x"]["seq"], r["y"]["seq"], r["z"]["seq"]) for r in m.collect()) == want


@pytest.mark.parametrize("seed", [5, 6])
def test_windows_by_loop(spark, seed):
    rows, df = table(spark, seed)
    slide, cumulate = Counter(), Counter()
    for key, _, t, _ in rows:
        for i in range(1, 5):
            slide[(key, (t // 1000 + i) * 1000)] += 1
        start = t // 4000 * 4000
        for end in range(start + 1000, start + 4001, 1000):
            if t < end:
                cumulate[(key, start, end)] += 1
    got = windows.sliding_count(df, ["key"], "ts", "4 seconds", "1 second").collect()
    assert {(r["key"], ms(r["window_end"])): r["cnt"] for r in got} == slide
    got = windows.cumulate_count(df, ["key"], "ts", "1 second", "4 seconds").collect()
    assert {(r["key"], ms(r["window_start"]), ms(r["window_end"])): r["cnt"] for r in got} == cumulate


@pytest.mark.parametrize("seed", [7, 8])
def test_sessions_by_loop(spark, seed):
    rows, df = table(spark, seed, 60)
    want = Counter()
    for key, events in by_key(rows).items():
        start = last = None
        n = 0
        for _, t, _ in events + [(None, 10**9, None)]:
            if start is not None and t - last > 500:
                want[(key, start, last + 500, n)] += 1
                start, n = None, 0
            if start is None:
                start = t
            last, n = t, n + 1
    got = windows.session_agg(df, ["key"], "ts", "500 milliseconds", {})
    assert Counter((r["key"], ms(r["session_start"]), ms(r["session_end"]), r["cnt"]) for r in got.collect()) == want


@pytest.mark.parametrize("seed", [9, 10])
def test_interval_join_by_loop(spark, seed):
    rows, df = table(spark, seed)
    left = df.filter("kind = 'a'").select("key", F.col("ts").alias("l_ts"), F.col("seq").alias("l"))
    right = df.filter("kind = 'b'").select("key", F.col("ts").alias("r_ts"), F.col("seq").alias("r"))
    want = Counter()
    for k1, kind1, t1, s1 in rows:
        hits = [s2 for k2, kind2, t2, s2 in rows if kind1 == "a" and kind2 == "b" and k1 == k2 and -700 <= t2 - t1 <= 1300]
        for s2 in hits or ([None] if kind1 == "a" else []):
            want[(k1, s1, s2)] += 1
    for policy in (SMALL, SkewPolicy()):
        got = joins.interval_join(left, right, ["key"], "l_ts", "r_ts", "-700 milliseconds", "1300 milliseconds", "left", None, policy)
        assert Counter((r["key"], r["l"], r["r"]) for r in got.collect()) == want


@pytest.mark.parametrize("seed", [11, 12])
def test_late_rows_by_loop(spark, seed):
    rows, df = table(spark, seed)
    want, top = {}, None
    for _, _, t, seq in rows:  # arrival is the order of seq
        end = t // 1000 * 1000 + 1000
        mark = None if top is None else top - 2000
        if mark is None or end > mark:
            want[seq] = "on_time"
        else:
            want[seq] = "late_allowed" if end + 3000 > mark else "too_late"
        top = t if top is None else max(top, t)
    for policy in (SMALL, SkewPolicy()):
        got = late.late_status(df, ["seq"], "ts", "2 seconds", "1 second", "3 seconds", policy=policy)
        assert {r["seq"]: r["status"] for r in got.collect()} == want
    assert len(set(want.values())) == 3


@pytest.mark.parametrize("seed", [13])
def test_batches_by_loop(spark, seed):
    rows, df = table(spark, seed)
    want = Counter()
    for key, events in by_key(rows).items():
        for i in range(len(events) // 7 * 7):
            want[(key, events[i][2], i // 7)] += 1
    got = aggregate.complete_batches(df, ["key"], ["ts", "seq"], 7).filter("complete")
    assert Counter((r["key"], r["seq"], r["batch_id"]) for r in got.collect()) == want
