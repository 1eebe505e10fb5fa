"""Stateful streaming operators; each has a batch twin of the same meaning in ``operators``."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

from tidewater.functions.timeexpr import Duration, duration_us, micros
from tidewater.streaming.ordered import US, FrameProcessor, OrderedProcessor, watermark_us


class RunningCount(FrameProcessor):
    state_schema = "n bigint"
    output_schema = "seq bigint, cnt bigint"

    def frame(self, key, state, rows):
        n = (state[0] if state else 0) + np.arange(1, len(rows) + 1)
        return (int(n[-1]),), [rows.seq, n]


class CountChangelog(FrameProcessor):
    """The first row of a key is an insert; each further one takes back the count before and gives the new one."""

    state_schema = "n bigint"
    output_schema = "seq bigint, row_kind string, cnt bigint"

    def frame(self, key, state, rows):
        before = state[0] if state else 0
        n = before + np.arange(len(rows))
        counts = np.stack([n, n + 1], axis=1).ravel()
        kinds = np.tile(np.array(["-U", "+U"], object), len(rows))
        seq = np.repeat(rows.seq, 2)
        if not before:
            counts, kinds, seq = counts[1:], kinds[1:], seq[1:]
            kinds[0] = "+I"
        return (before + len(rows),), [seq, kinds, counts]


class EveryN(FrameProcessor):
    """Mean event time (milliseconds) of each ``n`` rows."""

    state_schema = "n bigint, total_ms bigint, batch bigint"
    output_schema = "batch bigint, avg_ms bigint"

    def __init__(self, n: int):
        self.n = n

    def frame(self, key, state, rows):
        n, total, batch = state or (0, 0, 0)
        sums = np.concatenate(([0], np.cumsum(rows.us // 1000)))
        ends = np.arange(self.n - n, len(rows) + 1, self.n)  # rows of this frame in each full batch
        totals = sums[ends]
        means = np.diff(totals, prepend=-total) // self.n if len(ends) else totals
        done = len(ends)
        used = int(ends[-1]) if done else 0
        rest = int(sums[-1] - sums[used]) + (0 if done else total)
        state = (n + len(rows) - done * self.n, rest, batch + done)
        return state, [batch + np.arange(done), means]


class CompleteBatches(FrameProcessor):
    """Rows leave in batches of ``n``; the rest stays in checkpointed state and goes on after a restart."""

    state_schema = "batch bigint, held array<bigint>"
    output_schema = "seq bigint, batch_id bigint"

    def __init__(self, n: int):
        self.n = n

    def frame(self, key, state, rows):
        batch, held = state or (0, [])
        seq = np.concatenate([np.array(held, np.int64), rows.seq])
        full = len(seq) // self.n
        out = [seq[: full * self.n], batch + np.repeat(np.arange(full), self.n)]
        return (batch + full, seq[full * self.n :].tolist()), out


class KeyedStateView(OrderedProcessor):
    """What keyed state holds after each row: list size, map count, reduced first value, formatted aggregate."""

    state_schema = "n bigint, first string"
    output_schema = "seq bigint, list_size bigint, map_count bigint, first_value string, agg_result string"

    def __init__(self, column: str):
        self.row_fields = [(column, "string")]

    def step(self, key, state, us, seq, row):
        n, first = state or (0, row[0])
        n += 1
        return (n, first), [(seq, n, n, first, f"result {n}")]


class LastValueTtl(OrderedProcessor):
    """The value of the row before, unless ``ttl`` has passed; each row renews it."""

    state_schema = "us bigint, v string"
    output_schema = "seq bigint, last_value string"

    def __init__(self, column: str, ttl: Duration):
        self.row_fields = [(column, "string")]
        self.ttl = duration_us(ttl)

    def step(self, key, state, us, seq, row):
        live = state is not None and us - state[0] < self.ttl
        return (us, row[0]), [(seq, state[1] if live else None)]

    def deadline(self, state):
        return state[0] + self.ttl

    def expire(self, key, state, at):
        return None, []


class ActionPairs(OrderedProcessor):
    """Each action with the one before it. Join the result with the rules: a file-backed rule table is read
    again in every micro-batch, so changed rules take effect."""

    state_schema = "v string"
    output_schema = "seq bigint, action1 string, action2 string"

    def __init__(self, column: str):
        self.row_fields = [(column, "string")]

    def step(self, key, state, us, seq, row):
        return (row[0],), ([(seq, state[0], row[0])] if state else [])


class StrictSequence(OrderedProcessor):
    """Rows that follow each other directly and have the given values in ``column``, one per step."""

    state_schema = "seqs array<bigint>, times array<bigint>, vals array<string>"

    def __init__(self, column: str, values: Sequence[str], within: Duration | None = None):
        self.row_fields = [(column, "string")]
        self.values = list(values)
        self.within = duration_us(within) if within is not None else None
        self.output_schema = ", ".join(f"s{i}_seq bigint" for i in range(len(values)))

    def step(self, key, state, us, seq, row):
        seqs, times, vals = state or ([], [], [])
        seqs, times, vals = [*seqs, seq], [*times, us], [*vals, row[0]]
        out = []
        n = len(self.values)
        if len(seqs) == n:
            if vals == self.values and (self.within is None or us - times[0] < self.within):
                out = [tuple(seqs)]
            seqs, times, vals = seqs[1:], times[1:], vals[1:]
        return (seqs, times, vals), out


class RelaxedSequence(OrderedProcessor):
    """Each step followed, not necessarily directly, by the next; open matches time out after ``within``."""

    state_schema = "open array<struct<us: bigint, seqs: array<bigint>>>"

    def __init__(self, column: str, values: Sequence[str], within: Duration):
        self.row_fields = [(column, "string")]
        self.values = list(values)
        self.within = duration_us(within)
        self.output_schema = ", ".join([f"s{i}_seq bigint" for i in range(len(values))] + ["status string"])

    def step(self, key, state, us, seq, row):
        n, kept, out = len(self.values), [], []
        for start, seqs in [tuple(o) for o in (state[0] if state else [])]:
            if self.values[len(seqs)] == row[0]:
                seqs = [*seqs, seq]
                if len(seqs) == n:
                    out.append((*seqs, "matched"))
                    continue
            kept.append((start, list(seqs)))
        if row[0] == self.values[0]:
            kept.append((us, [seq]))
        return ((kept,) if kept else None), out

    def deadline(self, state):
        return min(o[0] for o in state[0]) + self.within

    def expire(self, key, state, at):
        late = [o for o in state[0] if o[0] + self.within <= at]
        kept = [tuple(o) for o in state[0] if o[0] + self.within > at]
        n = len(self.values)
        out = [(o[1][0], *[None] * (n - 1), "timeout") for o in late]
        return ((kept,) if kept else None), out


class FailureBursts(OrderedProcessor):
    """Alert when a span of fixed length from the first failure ends with ``n`` failures and no success."""

    state_schema = "first bigint, last bigint, n bigint"
    output_schema = "first_us bigint, last_us bigint, times bigint"

    def __init__(self, column: str, failed: str, n: int, within: Duration):
        self.row_fields = [(column, "string")]
        self.failed, self.n, self.width = failed, n, duration_us(within)

    def step(self, key, state, us, seq, row):
        if row[0] != self.failed:
            return None, []
        first, _, n = state or (us, us, 0)
        return (first, us, n + 1), []

    def deadline(self, state):
        return state[0] + self.width + 1  # the last instant of the span is inside it

    def expire(self, key, state, at):
        return None, ([state] if state[2] >= self.n else [])


class ClickLimit(FrameProcessor):
    """Per key and day the first ``limit`` rows pass, the next gives a warning, the rest are dropped."""

    state_schema = "day bigint, n bigint"
    output_schema = "seq bigint, tag string"

    def __init__(self, limit: int, zone_hours: int = 8):
        self.limit, self.shift = limit, zone_hours * 3_600_000_000

    def frame(self, key, state, rows):
        after, _, out = self.frames([key], [state], np.array([0, len(rows)]), rows)
        return after[0], out

    def frames(self, keys, states, starts, rows):
        day = (rows.us + self.shift) // 86_400_000_000  # rises with the rows of a key
        owner = np.repeat(np.arange(len(keys)), np.diff(starts))
        at = np.arange(len(day))
        is_first = np.diff(owner, prepend=-1).astype(bool) | np.diff(day, prepend=day[0]).astype(bool)
        n = at - np.maximum.accumulate(np.where(is_first, at, 0))
        days, counts = np.array([s or (0, 0) for s in states], np.int64).T
        n += np.where(day == days[owner], counts[owner], 0)  # the day goes on
        tags = np.where(n < self.limit, "kept", "warning").astype(object)
        said = n <= self.limit
        last = starts[1:] - 1
        return list(zip(day[last].tolist(), (n[last] + 1).tolist(), strict=True)), owner[said], [rows.seq[said], tags[said]]

    def deadline(self, state):
        return (state[0] + 1) * 86_400_000_000 - self.shift

    def expire(self, key, state, at):
        return None, []


class OrderWatch(OrderedProcessor):
    """Order states as they become known: ``paid``, ``timeout`` when no payment came in time, and
    ``paid_not_created`` when no creation came within ``grace`` of the payment."""

    state_schema = "created bigint, paid bigint"
    output_schema = "at_us bigint, status string"

    def __init__(self, column: str, limit: Duration, grace: Duration = "0 seconds", created: str = "create", paid: str = "pay"):
        self.row_fields = [(column, "string")]
        self.limit, self.grace = duration_us(limit), duration_us(grace)
        self.created, self.paid = created, paid

    def step(self, key, state, us, seq, row):
        created, paid = state or (None, None)
        kind = (row[0] or "").lower()
        if kind == self.created:
            if paid is not None:
                return None, [(us, "paid")]
            return (created if created is not None else us, None), []
        if kind == self.paid:
            if created is not None:
                return None, [(us, "paid")]
            return (None, paid if paid is not None else us), []
        return state, []

    def deadline(self, state):
        return state[0] + self.limit if state[0] is not None else state[1] + self.grace + 1

    def expire(self, key, state, at):
        return None, [(at, "timeout") if state[0] is not None else (state[1], "paid_not_created")]


class PeriodicCount(OrderedProcessor):
    """From the first row of a key on, every ``period``: its rows so far."""

    state_schema = "next bigint, n bigint"
    output_schema = "tick_us bigint, cnt bigint"

    def __init__(self, period: Duration):
        self.period = duration_us(period)

    def step(self, key, state, us, seq, row):
        tick, n = state or (us + self.period, 0)
        return (tick, n + 1), []

    def deadline(self, state):
        return state[0] + 1  # rows at the tick itself count

    def expire(self, key, state, at):
        return (state[0] + self.period, state[1]), [(state[0], state[1])]


class CorrectedWindows(StatefulProcessor):
    """Counts of tumbling windows that fire, are corrected and are purged.

    A window fires with ``+I`` once the watermark has reached its end. Until its lateness has passed too, rows that still come give, per
    micro-batch, ``-U`` with the count before and ``+U`` with the new one. Then its state goes, and rows that come after that are
    given as ``late`` with their number. State is a map from window to its count and whether it has fired.
    """

    output_schema = "start_us bigint, row_kind string, cnt bigint"

    def __init__(self, size: Duration, lateness: Duration):
        self.size, self.lateness = duration_us(size), duration_us(lateness)

    def init(self, handle) -> None:
        self._handle = handle
        self._windows = handle.getMapState("windows", "start bigint", "n bigint, fired boolean")

    def handleInputRows(self, key, rows, timerValues):
        watermark = watermark_us(timerValues)
        out = []
        us = np.concatenate([part.iloc[:, -1].to_numpy() for part in rows])  # eight bytes a row
        starts, counts = np.unique(us // self.size * self.size, return_counts=True)
        for start, n in zip(starts.tolist(), counts.tolist(), strict=True):
            end = start + self.size
            if end + self.lateness <= watermark:
                out.append((start, "late", n))
                continue
            had, fired = self._windows.getValue((start,)) if self._windows.containsKey((start,)) else (0, False)
            self._windows.updateValue((start,), (had + n, fired))
            if fired:
                out += [(start, "-U", had), (start, "+U", had + n)]
            if not had:
                self._handle.registerTimer(_timer(end))
                self._handle.registerTimer(_timer(end + self.lateness))
        yield from self._frame(key, out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        watermark = watermark_us(timerValues)
        at = expiredTimerInfo.getExpiryTimeInMs()
        out = []
        for at_end, offset in ((True, self.size), (False, self.size + self.lateness)):
            start = (at + 1) * 1000 - offset
            if start % self.size or not self._windows.containsKey((start,)):
                continue
            if start + offset > watermark:
                self._handle.registerTimer(at)
                continue
            n, fired = self._windows.getValue((start,))
            if at_end and not fired:
                out.append((start, "+I", n))
                self._windows.updateValue((start,), (n, True))
            elif not at_end:
                if not fired:
                    out.append((start, "+I", n))
                self._windows.removeKey((start,))
        yield from self._frame(key, out)

    def close(self) -> None:
        return None

    def _frame(self, key, out: list[tuple]):
        if out:
            yield pd.DataFrame([(*key, *r) for r in out], columns=self.result_names)


def _timer(us: int) -> int:
    """A timer is due when the watermark has passed it: one millisecond before an instant that the watermark may just reach."""
    return us // 1000 - 1


def corrected_windows(df: DataFrame, keys: list[str], ts: str, size: Duration, lateness: Duration) -> DataFrame:
    """(keys, start_us, row_kind, cnt) of a stream with a watermark on ``ts``; rows without an event time are left out. Sizes and
    latenesses are whole milliseconds."""
    if duration_us(size) % 1000 or duration_us(lateness) % 1000:
        raise ValueError("windows in whole milliseconds")
    processor = CorrectedWindows(size, lateness)
    types = dict(df.dtypes)
    processor.result_names = [*keys, "start_us", "row_kind", "cnt"]
    schema = ", ".join([f"{k} {types[k]}" for k in keys] + [processor.output_schema])
    slim = df.filter(F.col(ts).isNotNull()).select(*keys, micros(ts).alias(US))
    return slim.groupBy(*keys).transformWithStateInPandas(processor, schema, "Append", "eventTime")
