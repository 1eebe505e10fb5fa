"""Keyed streaming operators in event-time order.

Rows of a key wait in state until the watermark has passed them, and are then handled in the order of event
time and tie breaker. So the result does not depend on the order of arrival (within the watermark's delay) nor
on the cut into micro-batches, and it equals the batch form.

Keys are dealt by their hash to a fixed number of groups, and a group is what Spark's state is keyed by: calls of the state
store follow the groups that have rows, not the keys. Up to ``POOL_ROWS`` waiting rows of a group lie in one value. More lie in a map
from time bucket to parts of at most ``PART_ROWS`` rows: arriving rows are added without reading what waits there, and when
the watermark moves, only buckets it has reached are read, some ``PART_ROWS`` rows (or one bucket) after the other. So a task holds
such a stretch of one group, its pool and the states of its keys. Rows are kept in Arrow format, and due rows are handed over as
frames of arrays, sorted by key and time. State is kept in the RocksDB store and checkpointed by Spark.

A row is late when the watermark of its arrival has passed it. Late rows, and rows without an event time, are a second output of the
same operator (:func:`run_tagged`): every input row is handled or comes out as late.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from typing import Any

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import StructType

from tidewater.functions.timeexpr import Duration, duration_us, micros

US = "_us"
NEVER = -(1 << 62)  # before any event time
POOL_ROWS = 16_384
PART_ROWS = 8192
BUCKET = "1 hour"
GROUPS = 1024  # of keys; more of them for more tasks, or beyond some ten thousand keys a group
WHOLE = ("tinyint", "smallint", "int", "bigint")


@dataclass
class Frame:
    """Rows: event time in microseconds, tie breaker, and further columns: those an operator reads, while rows wait also their key."""

    us: np.ndarray
    seq: np.ndarray
    values: list[np.ndarray]

    def __len__(self) -> int:
        return len(self.us)

    def take(self, rows: np.ndarray | slice) -> Frame:
        return Frame(self.us[rows], self.seq[rows], [v[rows] for v in self.values])

    def to_bytes(self) -> bytes:
        columns = [pa.array(x, from_pandas=True) for x in (self.us, self.seq, *self.values)]
        batch = pa.RecordBatch.from_arrays(columns, [str(i) for i in range(len(columns))])
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, batch.schema) as out:
            out.write_batch(batch)
        return sink.getvalue().to_pybytes()

    @staticmethod
    def of_bytes(data: bytes) -> Frame:
        table = pa.ipc.open_stream(data).read_all()
        columns = [c.to_numpy() for c in table.columns]
        return Frame(columns[0], columns[1], columns[2:])

    @staticmethod
    def joined(frames: Sequence[Frame]) -> Frame:
        if len(frames) == 1:
            return frames[0]
        columns = [np.concatenate(c) for c in zip(*((f.us, f.seq, *f.values) for f in frames), strict=True)]
        return Frame(columns[0], columns[1], columns[2:])


class FrameProcessor(StatefulProcessor):
    """Subclasses say what a frame of due rows does to the state of its key.

    ``state`` is a tuple of the fields of ``state_schema`` or None for a new key. A key may give several frames in a row. Keys come as
    whole numbers or text, NULL as None.
    """

    row_fields: Sequence[tuple[str, str]] = ()  # (name, type) of the input columns the operator reads
    state_schema = "n bigint"
    output_schema = "n bigint"
    bucket: Duration = BUCKET  # width of a time bucket of waiting rows
    pool_rows = POOL_ROWS
    part_rows = PART_ROWS
    result_names: Sequence[str] = ()  # keys, output columns and the tag, set by the run functions
    input_names: Sequence[str] = ()
    n_keys = 0
    tagged = False

    def frame(self, key: tuple, state: tuple | None, rows: Frame) -> tuple[Any, list]:
        """New state, and the output columns (without the key) for the rows, in order of time and tie breaker."""
        raise NotImplementedError

    def frames(self, keys: Sequence[tuple], states: Sequence[tuple | None], starts: np.ndarray, rows: Frame) -> tuple[list, np.ndarray, list]:
        """:meth:`frame` for many keys, where the rows of key ``i`` are those from ``starts[i]`` up to ``starts[i + 1]``: the new states,
        the number of the key of each output row, and the output columns. Subclasses may handle all keys at once."""
        after, owners, outs = [], [], []
        for i, (key, state) in enumerate(zip(keys, states, strict=True)):
            state, out = self.frame(key, state, rows.take(slice(starts[i], starts[i + 1])))
            after.append(state)
            if out and len(out[0]):
                owners.append(np.full(len(out[0]), i))
                outs.append(out)
        if not outs:
            return after, np.empty(0, np.int64), []
        return after, np.concatenate(owners), [np.concatenate(c) for c in zip(*outs, strict=True)]

    def deadline(self, state: tuple | None) -> int | None:
        """Event time (microseconds) from which on :meth:`expire` must run before any row."""
        return None

    def expire(self, key: tuple, state: tuple, at: int) -> tuple[Any, list[tuple]]:
        raise NotImplementedError

    # -- Spark interface: a key of Spark's is a group ---------------------------------------------

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        self._width = duration_us(self.bucket)
        self._waiting = handle.getMapState("waiting", "bucket bigint, part int", "rows binary")
        self._value = handle.getValueState("value", "states binary")  # of the keys: a pickled dict of tuples
        index = "index array<struct<bucket: bigint, parts: int, first: bigint>>"
        self._clock = handle.getValueState("clock", f"timer bigint, deadline bigint, pool binary, {index}")
        self._sets_deadlines = type(self).deadline is not FrameProcessor.deadline

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        watermark = watermark_us(timerValues)
        timer, deadline, pool, index = self._load()
        for part in rows:
            part.columns = self.input_names  # computed columns arrive without their names
            us = part[US].to_numpy()
            late = part["_no_time"].to_numpy() | (us <= watermark)
            if late.any() and self.tagged:
                yield self._late(part[late])
            if late.all():
                continue
            fresh = Frame(us, part["_seq"].to_numpy(), [part[n].to_numpy() for n in self.input_names[4:]])
            pool.append(fresh.take(np.flatnonzero(~late)))
            if sum(map(len, pool)) > self.pool_rows:
                self._put(Frame.joined(pool), index)
                pool = []
        self._save(timer, deadline, pool, index, watermark)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        watermark = watermark_us(timerValues)
        timer, deadline, pool, index = self._load()
        states = self._states()
        touched = False
        buckets = sorted(b for b, (_, first) in index.items() if first <= watermark)
        while True:
            read: list[Frame] = []
            while buckets and sum(map(len, read)) < self.part_rows:
                bucket = buckets.pop(0)
                read.append(self._take(bucket, index))
            # Rows of the pool up to the end of a bucket belong before the next bucket.
            end = min((bucket + 1) * self._width - 1, watermark) if buckets else watermark
            if read or pool:
                rows = Frame.joined([*read, *pool])
                is_due = rows.us <= end
                due, rest = rows.take(np.flatnonzero(is_due)), rows.take(np.flatnonzero(~is_due))
                pool = [rest] if len(rest) else []
                if len(due):
                    touched = True
                    yield from self._handle_due(due, states)
            if not buckets:
                break
        if sum(map(len, pool)) > self.pool_rows:  # with what was not due of the last bucket
            self._put(Frame.joined(pool), index)
            pool = []
        if self._sets_deadlines and (touched or (deadline is not None and deadline <= watermark)):
            touched = True
            deadline, out = self._expire_due(states, watermark)
            yield from out
        if touched:
            if states:
                self._value.update((pickle.dumps(states, pickle.HIGHEST_PROTOCOL),))
            else:
                self._value.clear()
        self._save(timer, deadline, pool, index, watermark)

    def close(self) -> None:
        return None

    # -- helpers -----------------------------------------------------------------------------------

    def _states(self) -> dict[tuple, tuple]:
        found = self._value.get()
        return {} if found is None else pickle.loads(bytes(found[0]))

    def _load(self) -> tuple[int, int | None, list[Frame], dict[int, tuple[int, int]]]:
        """The timer, the first deadline of a key, the pool, and of each bucket its parts and the first event time in it."""
        found = self._clock.get()
        if found is None:
            return -1, None, [], {}
        timer, deadline, pool, index = found
        return timer, deadline, [] if pool is None else [Frame.of_bytes(bytes(pool))], {x[0]: (x[1], x[2]) for x in map(tuple, index)}

    def _put(self, rows: Frame, index: dict[int, tuple[int, int]]) -> None:
        buckets = rows.us // self._width
        order = np.argsort(buckets, kind="stable")
        found, starts = np.unique(buckets[order], return_index=True)
        for b, mine in zip(found.tolist(), np.split(order, starts[1:]), strict=True):
            parts, first = index.get(b, (0, 1 << 62))
            for lo in range(0, len(mine), self.part_rows):
                self._waiting.updateValue((b, parts), (rows.take(mine[lo : lo + self.part_rows]).to_bytes(),))
                parts += 1
            index[b] = parts, min(first, int(rows.us[mine].min()))

    def _take(self, bucket: int, index: dict[int, tuple[int, int]]) -> Frame:
        """Read a bucket and remove it."""
        parts = index.pop(bucket)[0]
        found = [Frame.of_bytes(self._waiting.getValue((bucket, k))[0]) for k in range(parts)]
        for k in range(parts):
            self._waiting.removeKey((bucket, k))
        return Frame.joined(found)

    def _handle_due(self, rows: Frame, states: dict[tuple, tuple]) -> Iterator[pd.DataFrame]:
        nulls, *columns = rows.values[: self.n_keys + 1]
        codes = nulls
        for c in columns:
            mine, found = pd.factorize(c)
            codes = np.unique(codes * len(found) + mine, return_inverse=True)[1]
        order = np.lexsort((rows.seq, rows.us, codes))
        starts = np.flatnonzero(np.diff(codes[order], prepend=-1))
        keys = _keys([c[order[starts]] for c in columns], nulls[order[starts]])
        starts = np.append(starts, len(order))
        mine = Frame(rows.us, rows.seq, rows.values[self.n_keys + 1 :]).take(order)
        after, owners, out = self.frames(keys, [states.get(k) for k in keys], starts, mine)
        for key, state in zip(keys, after, strict=True):
            if state is None:
                states.pop(key, None)
            else:
                states[key] = state
        yield from self._rows(keys, owners, out)

    def _expire_due(self, states: dict[tuple, tuple], now: int) -> tuple[int | None, Iterator[pd.DataFrame]]:
        """Expire what is due of all keys: the next deadline, and the output."""
        left, keys, owners, out = [], [], [], []
        for key, state in list(states.items()):
            due = self.deadline(state)
            if due is not None and due <= now:
                for state, more in self._expired(key, state, now):
                    owners += [len(keys)] * len(more)
                    out += more
                keys.append(key)
                due = None
                if state is None:
                    del states[key]
                else:
                    states[key] = state
                    due = self.deadline(state)
            if due is not None:
                left.append(due)
        return min(left, default=None), self._rows(keys, np.array(owners, np.int64), _columns(out))

    def _expired(self, key, state, now: int):
        due = self.deadline(state) if state is not None else None
        while due is not None and due <= now:
            state, out = self.expire(key, state, due)
            yield state, out
            due = self.deadline(state) if state is not None else None

    def _save(self, old: int, deadline: int | None, pool: list[Frame], index: dict[int, tuple[int, int]], watermark: int) -> None:
        """Keep one timer per group, at the first whole millisecond from the earliest waiting row or deadline on."""
        due = [first for _, first in index.values()] + [int(f.us.min()) for f in pool]
        if deadline is not None:
            due.append(deadline)
        timer = -(-min(due) // 1000) if due else -1
        if timer != old:
            if old > watermark // 1000:
                self._handle.deleteTimer(old)
            if timer >= 0:
                self._handle.registerTimer(timer)
        if timer < 0:
            self._clock.clear()
        else:
            self._clock.update((timer, deadline, Frame.joined(pool).to_bytes() if pool else None, [(b, *x) for b, x in sorted(index.items())]))

    def _rows(self, keys: Sequence[tuple], owners: np.ndarray, out: list) -> Iterator[pd.DataFrame]:
        if not out or not len(out[0]):
            return
        n = len(out[0])
        columns = [_key_column(values)[owners] for values in zip(*keys, strict=True)] + list(out)
        if self.tagged:
            columns += [np.zeros(n, bool), np.full(n, None), np.full(n, None)]
        yield pd.DataFrame(dict(zip(self.result_names, columns, strict=True)))

    def _late(self, rows: pd.DataFrame) -> pd.DataFrame:
        n = len(rows)
        us = rows[US].astype(object).where(~rows["_no_time"], None)
        blank = len(self.result_names) - self.n_keys - 3
        nulls, *columns = [rows[c].to_numpy() for c in self.input_names[4 : self.n_keys + 5]]
        keys = [_key_column(values) for values in zip(*_keys(columns, nulls), strict=True)]
        columns = [*keys, *[np.full(n, None)] * blank, np.ones(n, bool), rows["_seq"].to_numpy(), us.to_numpy()]
        return pd.DataFrame(dict(zip(self.result_names, columns, strict=True)))


class OrderedProcessor(FrameProcessor):
    """An operator that looks at one row after the other: what a row does may set a deadline before the next row."""

    def step(self, key: tuple, state: tuple | None, us: int, seq: int, row: tuple) -> tuple[Any, list[tuple]]:
        """New state and output values (without the key) for one row."""
        raise NotImplementedError

    def frame(self, key, state, rows):
        out: list[tuple] = []
        values = list(zip(*(v.tolist() for v in rows.values), strict=True)) or [()] * len(rows)
        for us, seq, row in zip(rows.us.tolist(), rows.seq.tolist(), values, strict=True):
            for state, more in self._expired(key, state, us):
                out += more
            state, more = self.step(key, state, us, seq, row)
            out += more
        return state, _columns(out)


def _columns(rows: list[tuple]) -> list:
    """Columns of objects, so that integers beside NULLs stay integers."""
    return [_objects(values) for values in zip(*rows, strict=True)]


def _objects(values: Sequence) -> np.ndarray:
    column = np.empty(len(values), object)
    column[:] = values
    return column


def _key_column(values: Sequence) -> np.ndarray:
    return np.array(values, np.int64) if all(type(v) is int for v in values) else _objects(values)


def _keys(columns: Sequence[np.ndarray], nulls: np.ndarray) -> list[tuple]:
    """Keys from their columns, and the bits of what is NULL in them."""
    lists = [c.tolist() for c in columns]
    if nulls.any():
        lists = [[None if null >> i & 1 else v for v, null in zip(c, nulls.tolist(), strict=True)] for i, c in enumerate(lists)]
    return list(zip(*lists, strict=True))


def watermark_us(timer_values) -> int:
    """In microseconds; before the first one nothing is late, rows before 1970 included."""
    ms = timer_values.getCurrentWatermarkInMs()
    return ms * 1000 if ms > 0 else NEVER


def _run(df: DataFrame, keys: Sequence[str], ts: str, seq: str, processor: FrameProcessor, tag: str, groups: int) -> DataFrame:
    if not df.isStreaming:
        raise ValueError("the batch operators do this on tables")
    types = dict(df.dtypes)
    # A NULL beside whole numbers would turn them into floats on their way, and floats are no keys: NULLs travel as bits of a number of
    # their own, keys of other types as text.
    carried = {k: types[k] if types[k] in WHOLE else "string" for k in keys}
    columns = [F.coalesce(F.col(k).cast(t), F.lit(0 if t in WHOLE else "").cast(t)).alias(f"_k{i}") for i, (k, t) in enumerate(carried.items())]
    nulls = F.lit(0).cast("bigint")
    for i, k in enumerate(keys):
        nulls += F.when(F.col(k).isNull(), 1 << i).otherwise(0)
    group = F.pmod(F.xxhash64(*keys), F.lit(groups)).alias("_group")
    # Without the event-time column itself Spark leaves late rows to the operator.
    us, no_time = F.coalesce(micros(ts), F.lit(NEVER)).alias(US), F.col(ts).isNull().alias("_no_time")
    values = [F.col(n).alias(f"_v{i}") for i, (n, _) in enumerate(processor.row_fields)]
    slim = df.select(group, us, no_time, F.col(seq).cast("bigint").alias("_seq"), nulls.alias("_nulls"), *columns, *values)
    schema = StructType.fromDDL(", ".join([f"{k} {t}" for k, t in carried.items()] + [processor.output_schema + tag]))
    processor.result_names, processor.input_names, processor.n_keys = schema.names, slim.columns, len(keys)
    out = slim.groupBy("_group").transformWithStateInPandas(processor, schema, "Append", "eventTime")
    return out.select(*[F.col(k).cast(types[k]).alias(k) for k in keys], *schema.names[len(keys) :])


def run_ordered(df: DataFrame, keys: Sequence[str], ts: str, seq: str, processor: FrameProcessor, groups: int = GROUPS) -> DataFrame:
    """Apply a processor to a stream that has a watermark on ``ts``. Output: the keys and the processor's columns.

    Late rows and rows without an event time have no place in the order and are left out: :func:`run_tagged` gives them too.
    A query keeps its number of ``groups`` for life: it is the most tasks that can work at once.
    """
    return _run(df, keys, ts, seq, processor, "", groups)


def run_tagged(df: DataFrame, keys: Sequence[str], ts: str, seq: str, processor: FrameProcessor, groups: int = GROUPS) -> DataFrame:
    """As :func:`run_ordered` with two outputs in one: ``late`` is false for rows of the processor, and true for input
    rows that came too late or have no event time, with their ``late_seq`` and ``late_us``. Split it on write, for example
    by partition (``batches.tagged_batch``)."""
    processor.tagged = True
    return _run(df, keys, ts, seq, processor, ", late boolean, late_seq bigint, late_us bigint", groups)
