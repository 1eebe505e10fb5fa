"""Rules in force at a time, watermarks of several sources, and rolling files, against one-by-one forms."""

import datetime as dt
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tidewater.operators import joins, late
from tidewater.plans.skew import DEFAULT, SkewPolicy
from tidewater.session import scratch_path
from tidewater.sinks import files

T0 = dt.datetime(2024, 5, 1)
SMALL = SkewPolicy(rows_per_task=40)


def at(seconds):
    return None if seconds is None else T0 + dt.timedelta(seconds=seconds)


@pytest.mark.parametrize("policy", [DEFAULT, SMALL])
def test_rules_in_force_at_the_time(spark, policy):
    rng = random.Random(4)
    kinds = ["a", "b", "c", None]
    rows = [(rng.choice([1, 1, 1, 2, 3, None]), rng.choice(kinds), rng.randrange(900), i) for i in range(300)] + [(1, "a", None, 900)]
    rules = [(rng.randrange(50, 900), i, rng.choice("abc"), rng.choice("abc")) for i in range(25)] + [(400, 50, "a", "b"), (400, 51, "b", "c"), (None, 60, "a", "a")]
    df = spark.createDataFrame([(u, k, at(t), i) for u, k, t, i in rows], "u long, kind string, ts timestamp_ntz, seq long").repartition(3)
    versions = spark.createDataFrame([(at(t), i, a, b) for t, i, a, b in rules], "valid_from timestamp_ntz, n long, action1 string, action2 string")
    out = joins.rule_pair_match_asof(df, ["u"], ["ts", "seq"], "ts", "kind", versions, "valid_from", "n", policy)
    got = Counter((r.u, r.seq, r.rule_version, r.action1, r.action2) for r in out.collect())
    want = Counter()
    for user in {r[0] for r in rows}:
        mine = sorted((r for r in rows if r[0] == user), key=lambda r: (r[2] is not None, r[2] or 0, r[3]))
        for before, row in zip(mine, mine[1:], strict=False):
            held = max(((t, n, a, b) for t, n, a, b in rules if t is not None and row[2] is not None and t <= row[2]), default=None)
            if held and (before[1], row[1]) == held[2:]:
                want[(user, row[3], *held[1:])] += 1
    assert got == want and len(want) > 5
    assert joins.rule_pair_match_asof(df, ["u"], ["ts", "seq"], "ts", "kind", versions.limit(0), "valid_from", "n", policy).count() == 0


@pytest.mark.parametrize("policy", [DEFAULT, SMALL])
def test_idle_sources_do_not_hold_the_watermark(spark, policy):
    rng = random.Random(8)
    rows = [(i * 3, rng.choice("xxyyyz" if i % 100 < 40 else "xy") if i % 150 < 120 else rng.choice("xq"), None if rng.random() < 0.05 else i * 10 + rng.randrange(-60, 60), i) for i in range(400)]
    df = spark.createDataFrame([(a, s, at(t), i) for a, s, t, i in rows], "arrival long, s string, ts timestamp_ntz, i long").repartition(4)
    out = late.watermark_of_sources(df, ["arrival", "i"], "s", ["x", "y", "z"], "ts", "30 seconds", "arrival", 45, policy)
    got = {r.i: r.watermark for r in out.collect()}
    top, seen, mark, want = dict.fromkeys("xyz"), dict.fromkeys("xyz"), None, {}
    for arrival, s, t, i in rows:
        if s in top:
            seen[s] = arrival
            top[s] = t if top[s] is None else top[s] if t is None else max(top[s], t)
        live = [k for k in "xyz" if arrival - (rows[0][0] if seen[k] is None else seen[k]) <= 45]
        if live and all(top[k] is not None for k in live):
            low = min(top[k] for k in live)
            mark = low if mark is None else max(mark, low)
        want[i] = at(None if mark is None else mark - 30)
    assert got == want and len(set(want.values())) > 50


def test_files_roll_by_size_pause_and_age(spark):
    rng = random.Random(6)
    rows, t = [], 0
    for i in range(500):
        t += 4000 if rng.random() < 0.02 else rng.randrange(60)
        rows.append((i, i % 3, None if rng.random() < 0.03 else at(t), "x" * rng.randrange(1, 40)))
    df = spark.createDataFrame(rows, "i long, w long, ts timestamp_ntz, text string").repartition(4)
    path = scratch_path(spark, "rolling-test")
    files.write_rolling(df, path, "w", ["i"], "ts", F.concat_ws(",", "i", "text"), 300, "1 hour", "30 minutes")
    lines = spark.read.schema("value string, w long, file long").text(path).collect()
    got = {int(r.value.split(",")[0]): (r.w, r.file) for r in lines}
    assert len(lines) == len(rows)
    want = {}
    for w in range(3):
        number, last, start, size, age = 0, None, None, 0, 0
        for i, _, ts, text in (r for r in rows if r[1] == w):
            us = ts if ts is not None else last or dt.datetime(1970, 1, 1)
            if last is None:
                start = us
            elif us - last >= dt.timedelta(hours=1):
                number, start, size, age = number + 1, us, 0, 0
            elif (us - start) // dt.timedelta(minutes=30) != age:
                number, age, size = number + 1, (us - start) // dt.timedelta(minutes=30), 0
            elif size // 300 != (size - before) // 300:
                number += 1
            before = len(f"{i},{text}") + 1
            size += before
            last = us
            want[i] = (w, number)
    assert got == want
    sizes = Counter()
    for r in lines:
        sizes[r.w, r.file] += len(r.value) + 1
    assert max(sizes.values()) <= 300 + 50 and len(sizes) > 20


@pytest.mark.parametrize("steady", [True, False])
def test_files_of_large_writers_roll_in_ranges(spark, steady):
    """Writers cut into ranges have the files of writers numbered whole; times may go back, be absent, and writers be NULL."""
    rng = random.Random(7)
    rows, t = [], 0
    for i in range(1500):
        t += 4000 if rng.random() < 0.01 else rng.randrange(60) - (0 if steady else 25)
        rows.append((i, None if i % 5 == 4 else i % 2, None if rng.random() < 0.05 or i < 40 else at(t + 10**6), rng.randrange(1, 40)))
    df = spark.createDataFrame(rows, "i long, w long, ts timestamp_ntz, n long").repartition(4)
    args = (df, "w", ["i"], "ts", F.col("n"), 300, "1 hour", "30 minutes")
    want = {r.i: r.file for r in files.rolled(*args).collect()}
    ranged = files.rolled(*args, SkewPolicy(rows_per_task=100))
    assert {r.i: r.file for r in ranged.collect()} == want and len(set(want.values())) > 30
    assert "_chunk" not in ranged.columns and "ExistingRDD" in ranged._jdf.queryExecution().toString()
