"""Keyed state and timers: what window expressions cannot say on a stream.

``InOrder`` keeps the rows of a key until the watermark has passed them and
then hands them over in (time, row id) order, so a subclass is a plain state
machine and its results do not depend on how rows were spread over batches.
Rows that come after the watermark has passed their time go to ``on_late``, which
drops them unless a subclass says something about them, as ``LateSplit`` does; rows without a time
have no place in the order and go to ``on_undated``, by the same rule. Null values reach ``on_row`` as None.

A call of the state API costs more than the work on a row, so none is made per key: keys are put into ``GROUPS`` groups by their
hash, and Spark's state and timers belong to a group. Rows travel and wait in packs: a step before the shuffle sorts many Arrow batches
at once and makes one row of all rows of a group, an Arrow message with their least and greatest time. A pack that is not late is put into the
state as it came, small ones together. A firing brings the packs that are due in order of time, in slices of ``SLICE`` rows, and folds each key of a slice,
row by row (``on_row``) or at once (``on_rows``); results leave after every slice as Arrow messages, so a key of any number of
rows needs no more memory for them. What the keys of a group remember is one Arrow table with their next deadlines; only keys that have
rows or a deadline are unpacked. The Pandas form of the state API is used, as the one for rows holds all results of a task's timers in this version
of Spark. Null keys are keys like any other; the closing row of a replay is told by a column that ``runner.replay`` adds.

Times inside processors are microseconds since the epoch.
"""

from __future__ import annotations

import math
import sys
from collections import deque
from collections.abc import Iterable, Iterator
from typing import Any

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Row, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from rillwork.functions.scalar import epoch_micros
from rillwork.operators.automaton import Machine, rows_of
from rillwork.streaming.runner import CLOSING

# Executors may not have the package installed, so its classes travel with the plan.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

AT = "at"
GROUPS = 1024
GATHER = 200_000  # rows that are put into packs at once
PIECE = 4096  # rows of a pack that travels
MERGED = 131_072  # rows of a pack that waits, if it is put together from smaller ones
SLICE = 200_000  # rows that are folded at once
TOLD = 50_000  # results after which some are handed on
DAY = 86_400_000_000
Memory = tuple | None
Out = Iterable[tuple]


def keyed(df: DataFrame, keys: list[str], ts: str, delay: str, columns: list[str],
          processor: "InOrder") -> DataFrame:
    """Run ``processor`` per key over (``at``, columns); the last column must be the row id."""
    kinds = {f.name: f.dataType for f in df.schema.fields}
    names = [f"k{i}" for i in range(len(keys))]
    held = [T.StructField(n, kinds[k]) for n, k in zip(names, keys)]
    rows = T.StructType([*held, T.StructField(AT, T.LongType()), *[T.StructField(c, kinds[c]) for c in columns]])
    processor.n_keys, processor.packed = len(keys), to_arrow_schema(rows)
    known = T._parse_datatype_string(processor.memory_schema).fields
    known = [T.StructField(f"m{i}", f.dataType) for i, f in enumerate(known)]
    processor.known = to_arrow_schema(T.StructType([*held, *known, T.StructField("deadline", T.LongType())]))
    processor.telling = to_arrow_schema(T._parse_datatype_string(processor.output_schema))
    processor.by_row = type(processor).on_rows is InOrder.on_rows
    # the closing row takes part in nothing but the watermark; it is left out behind it, as a filter would be moved before it
    closing = F.col(CLOSING) if CLOSING in df.columns else F.lit(False)
    plain = df.withWatermark(ts, delay).select(
        closing.alias("closing"), F.pmod(F.xxhash64(*[F.col(k) for k in keys]), F.lit(GROUPS)).alias("part") if keys else F.lit(0).cast("long").alias("part"),
        *[F.col(k).alias(n) for n, k in zip(names, keys)], epoch_micros(F.col(ts)).alias(AT),
        *[F.col(c).alias(f"c{i}") for i, c in enumerate(columns)])
    told = (plain.mapInArrow(_pack(processor.packed), _PACK).groupBy("part")
            .transformWithStateInPandas(statefulProcessor=processor, outputStructType="rows binary",
                                        outputMode="Append", timeMode="EventTime"))
    return told.mapInArrow(_unpack(processor.telling), processor.output_schema)


# ``least`` and ``greatest`` of rows without a time are 0
_PACK = "part long, dated boolean, least long, greatest long, n long, rows binary"


def _changes(column: pa.Array) -> np.ndarray:
    """For every value but the first whether it differs from the one before."""
    after, before = column.slice(1), column.slice(0, max(len(column) - 1, 0))
    differ = pc.fill_null(pc.not_equal(after, before), False)
    return pc.or_(differ, pc.xor(pc.is_null(after), pc.is_null(before))).to_numpy(zero_copy_only=False)


def _runs(new: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """First and end of the runs of ``n`` rows, of which ``new`` tells where one begins."""
    first = np.concatenate([[0], np.flatnonzero(new) + 1])
    return first, np.concatenate([first[1:], [n]])


def _one(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
    return batches[0] if len(batches) == 1 else pa.Table.from_batches(batches).combine_chunks().to_batches()[0]


def _ordered(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
    """Rows of several packs in order; a single pack is in order."""
    if len(batches) == 1:
        return batches[0]
    rows = _one(batches)
    return rows.take(pc.sort_indices(rows, sort_keys=[(AT, "ascending"), (rows.schema.names[-1], "ascending")]))


def _pack(schema: pa.Schema):
    """Batches of (closing, part, keys, at, columns) to packs of the rows of a part, in order of time."""
    def packed(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        batch = _one(held)
        names = batch.schema.names
        batch = batch.take(pc.sort_indices(batch, sort_keys=[(n, "ascending") for n in ("part", AT, names[-1])]))
        part, at = batch.column(0).to_numpy(), batch.column(names.index(AT))
        dated, at = at.is_valid().to_numpy(zero_copy_only=False), at.fill_null(0).to_numpy()
        pieces = [(a, min(a + PIECE, b)) for a, b in zip(*(e.tolist() for e in _runs((np.diff(part) != 0) | (dated[1:] != dated[:-1]), len(batch))))
                  for a in range(a, b, PIECE)]
        first, end = np.array(pieces).T
        rows = pa.RecordBatch.from_arrays(batch.columns[1:], schema=schema)
        packs = [rows.slice(a, b - a).serialize().to_pybytes() for a, b in pieces]
        return pa.RecordBatch.from_arrays(
            [pa.array(part[first]), pa.array(dated[first]), pa.array(at[first]), pa.array(at[end - 1]), pa.array(end - first), pa.array(packs, pa.binary())],
            ["part", "dated", "least", "greatest", "n", "rows"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            batch = pa.RecordBatch.from_arrays(batch.columns[1:], batch.schema.names[1:]).filter(pc.invert(batch.column(0)))
            if len(batch):
                held.append(batch)
                n += len(batch)
            if n >= GATHER:
                yield packed(held)
                held, n = [], 0
        if held:
            yield packed(held)

    return run


def _unpack(schema: pa.Schema):
    """Arrow messages to their rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in batch.column(0):
                yield pa.ipc.read_record_batch(rows.as_buffer(), schema)

    return run


def listed(column: pa.Array) -> list:
    """What ``to_pylist`` gives, by way of NumPy where that is the same and several times as fast."""
    kind = column.type
    if pa.types.is_string(kind) or not column.null_count and (pa.types.is_integer(kind) or pa.types.is_boolean(kind) or pa.types.is_floating(kind)):
        return column.to_numpy(zero_copy_only=False).tolist()
    return column.to_pylist()


def _dicts(rows: pa.RecordBatch) -> list[dict]:
    names = rows.schema.names
    return [dict(zip(names, row)) for row in zip(*map(listed, rows.columns))]


def _key_tuples(columns: list[pa.Array], n: int) -> list[tuple]:
    """Keys as tuples that are equal if the keys are, NaN too."""
    if not columns:
        return [()] * n
    return list(zip(*([math.nan if v != v else v for v in listed(c)] if pa.types.is_floating(c.type) else listed(c) for c in columns)))


def _record(schema: str) -> Row:
    """A row class with the column names of a flat schema text."""
    return Row(*[column.split()[0] for column in schema.split(", ")])


def _millis(micros: int) -> int:
    return -(-micros // 1000)


def flags(column: pa.Array) -> np.ndarray:
    """Booleans, with null for False."""
    return pc.fill_null(column, False).to_numpy(zero_copy_only=False)


class InOrder(StatefulProcessor):
    """Base of all event-time processors; see ``keyed``."""

    n_keys: int
    packed: pa.Schema
    known: pa.Schema
    telling: pa.Schema
    by_row: bool
    memory_schema: str
    output_schema: str

    # --- what a subclass fills in

    def on_row(self, key: tuple, memory: Memory, row: dict) -> tuple[Memory, Out]:
        """Next row of the key, in order."""
        return memory, ()

    def on_rows(self, key: tuple, memory: Memory, rows: pa.RecordBatch, out: list[tuple]) -> Memory:
        """The next rows of the key, in order; a subclass may fold them at once if nothing is due between them."""
        return self._walk(key, memory, _dicts(rows), out)

    def deadline(self, memory: Memory) -> int | None:
        """When ``on_time`` wants to be called if no row comes first."""
        return None

    def on_time(self, key: tuple, memory: Memory, at: int) -> tuple[Memory, Out]:
        """The deadline ``at`` has passed."""
        return memory, ()

    def on_late(self, key: tuple, row: dict) -> Out:
        """A row whose time the watermark had passed when it came."""
        return ()

    def on_undated(self, key: tuple, row: dict) -> Out:
        """A row without a time."""
        return ()

    def unpack(self, memory: Memory) -> Any:
        """Memory as ``on_row`` wants it, once per firing."""
        return memory

    def pack(self, memory: Any) -> Memory:
        """Memory as the state holds it."""
        return memory

    # --- Spark's side

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getMapState("waiting", "least long, greatest long, no long", "rows binary")
        self.memory = handle.getValueState("memory", "rows binary")
        self.alarm = handle.getValueState("alarm", "millis long, packs long")

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        passed = timerValues.getCurrentWatermarkInMs() * 1000
        out, small, n_small = [], [], 0
        self._open_alarm()
        for packs in rows:
            for dated, least, greatest, n, pack in zip(*(packs[c].tolist() for c in ("dated", "least", "greatest", "n", "rows"))):
                if not dated:
                    for row_key, row in self._each(self._table(pack)):
                        out.extend(self.on_undated(row_key, row))
                elif passed > 0 and least <= passed:
                    table = self._table(pack)
                    late = int(np.searchsorted(self._times(table), passed, side="right"))
                    for row_key, row in self._each(table.slice(0, late)):
                        out.extend(self.on_late(row_key, row))
                    if late < n:
                        small.append(table.slice(late))
                        n_small += n - late
                elif 2 * n >= PIECE:
                    self._put(pack, least, greatest)
                else:
                    small.append(self._table(pack))
                    n_small += n
                if n_small >= MERGED:
                    self._keep(_ordered(small))
                    small, n_small = [], 0
                if len(out) >= TOLD:
                    yield self._told(out)
        if small:
            self._keep(_ordered(small))
        self._close_alarm()
        if out:
            yield self._told(out)

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:
        passed = timerValues.getCurrentWatermarkInMs() * 1000
        out: list[tuple] = []
        self._open_alarm()
        self.armed = None
        self._open_memory()
        for rows in self._due(passed):
            for key, memory in self._fold(rows, out):
                self.live[key] = memory
                if len(out) >= TOLD:
                    yield self._told(out)
        deadlines = self.table.column("deadline")
        self._load([self.keys[i] for i in pc.indices_nonzero(pc.less_equal(deadlines, passed)).to_pylist()])
        for key, memory in self.live.items():
            if memory is not None:
                self.live[key] = self._fire(key, memory, passed + 1, out)
                if len(out) >= TOLD:
                    yield self._told(out)
        self._close_memory()
        self._close_alarm()
        if out:
            yield self._told(out)

    def close(self) -> None:
        pass

    # Rows: packs in the state, slices in order of time, keys of a slice.

    def _table(self, rows: bytes) -> pa.RecordBatch:
        return pa.ipc.read_record_batch(pa.py_buffer(bytes(rows)), self.packed)

    def _times(self, table: pa.RecordBatch) -> np.ndarray:
        return table.column(self.n_keys).to_numpy()

    def _plain(self, table: pa.RecordBatch) -> pa.RecordBatch:
        """The rows without their keys."""
        return table.select(list(range(self.n_keys, table.num_columns)))

    def _each(self, table: pa.RecordBatch) -> Iterable[tuple[tuple, dict]]:
        return zip(_key_tuples(table.columns[:self.n_keys], len(table)), _dicts(self._plain(table)))

    def _keep(self, table: pa.RecordBatch) -> None:
        for begin in range(0, len(table), MERGED):
            rows = table.slice(begin, MERGED)
            at = self._times(rows)
            self._put(rows.serialize().to_pybytes(), int(at[0]), int(at[-1]))

    def _put(self, rows: bytes, least: int, greatest: int) -> None:
        self.packs += 1
        self.waiting.updateValue((least, greatest, self.packs), (rows,))
        self._wake_at(least)

    def _due(self, passed: int) -> Iterator[pa.RecordBatch]:
        """Rows up to the watermark, in order and no more than ``SLICE`` at once; the state keeps the others.

        Packs are brought by their least time. What is before the least time of the next one is complete, so only packs that overlap are
        held together.
        """
        due = sorted(tuple(int(v) for v in k) for k in self.waiting.keys())
        for least, _, _ in due:
            if least > passed:
                self._wake_at(least)
                break
        due = [k for k in due if k[0] <= passed]
        held, n, enough = [], 0, SLICE
        for i, pack in enumerate(due):
            held.append(self._table(self.waiting.getValue(pack)[0]))
            self.waiting.removeKey(pack)
            n += len(held[-1])
            last = i + 1 == len(due)
            if n < enough and not last:
                continue
            rows = _ordered(held)
            until = passed if last else due[i + 1][0] - 1
            ready = int(np.searchsorted(self._times(rows), until, side="right"))
            for begin in range(0, ready, SLICE):
                yield rows.slice(begin, min(SLICE, ready - begin))
            n = len(rows) - ready
            held, enough = [rows.slice(ready)] if n else [], max(SLICE, 2 * n)
        if held:
            self._keep(held[0])

    def _fold(self, rows: pa.RecordBatch, out: list[tuple]) -> Iterator[tuple[tuple, Memory]]:
        """The keys of a slice with what they remember after it."""
        names = rows.schema.names[:self.n_keys]
        if names:  # a stable sort, so the rows of a key stay in order
            rows = rows.take(pc.sort_indices(rows, sort_keys=[(n, "ascending") for n in names]))
        new = np.zeros(len(rows) - 1, dtype=bool)
        for column in rows.columns[:self.n_keys]:
            new |= _changes(column)
        first, end = _runs(new, len(rows))
        keys = _key_tuples([c.take(pa.array(first)) for c in rows.columns[:self.n_keys]], len(first))
        self._load(keys)
        rows = self._plain(rows)
        dicts = _dicts(rows) if self.by_row else []
        for key, a, b in zip(keys, first.tolist(), end.tolist()):
            memory = self.live.get(key)
            yield key, self._walk(key, memory, dicts[a:b], out) if self.by_row else self.on_rows(key, memory, rows.slice(a, b - a), out)

    def _walk(self, key: tuple, memory: Memory, rows: list[dict], out: list[tuple]) -> Memory:
        for row in rows:
            memory = self._fire(key, memory, row[AT], out)
            memory, made = self.on_row(key, memory, row)
            out.extend(made)
        return memory

    def _told(self, out: list[tuple]) -> pd.DataFrame:
        rows = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), self.telling)], schema=self.telling)
        out.clear()
        return pd.DataFrame({"rows": [rows.slice(a, TOLD).serialize().to_pybytes() for a in range(0, len(rows), TOLD)]})

    # What keys remember: ``table`` as the state holds it, ``live`` the keys that a firing touches.

    def _open_memory(self) -> None:
        held = [pa.ipc.read_record_batch(pa.py_buffer(bytes(self.memory.get()[0])), self.known)] if self.memory.exists() else []
        self.table = held[0] if held else pa.RecordBatch.from_pylist([], schema=self.known)
        self.keys = _key_tuples(self.table.columns[:self.n_keys], len(self.table))
        self.place = {k: i for i, k in enumerate(self.keys)}
        self.live: dict[tuple, Memory] = {}

    def _load(self, keys: list[tuple]) -> None:
        wanted = [k for k in keys if k not in self.live and k in self.place]
        if wanted:
            at = pa.array([self.place[k] for k in wanted], pa.int64())
            columns = [listed(c.take(at)) for c in self.table.columns[self.n_keys:-1]]
            self.live.update((k, self.unpack(m)) for k, m in zip(wanted, zip(*columns)))

    def _close_memory(self) -> None:
        table = self.table
        if self.live:
            rest = np.ones(len(table), dtype=bool)
            rest[[self.place[k] for k in self.live if k in self.place]] = False
            made = [(*k, *self.pack(m), self.deadline(m)) for k, m in self.live.items() if m is not None]
            columns = list(zip(*made)) or [()] * len(self.known)
            made = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, self.known)], schema=self.known)
            table = pa.Table.from_batches([table.filter(pa.array(rest)), made]).combine_chunks().to_batches()
            table = table[0] if table else made
            if len(table):
                self.memory.update((table.serialize().to_pybytes(),))
            else:
                self.memory.clear()
        first = pc.min(table.column("deadline")).as_py()
        if first is not None:
            self._wake_at(first)
        self.live, self.table, self.keys, self.place = {}, None, [], {}

    def _fire(self, key: tuple, memory: Memory, before: int, out: list[tuple]) -> Memory:
        """Let all deadlines before a time pass."""
        while memory is not None:
            at = self.deadline(memory)
            if at is None or at >= before:
                break
            memory, made = self.on_time(key, memory, at)
            out.extend(made)
        return memory

    # One timer per group, at the earliest time anything can happen.

    def _open_alarm(self) -> None:
        self.told = tuple(self.alarm.get()) if self.alarm.exists() else (None, 0)
        self.armed, self.packs = self.told

    def _wake_at(self, micros: int) -> None:
        at = _millis(micros)
        if self.armed is None or at < self.armed:
            self.armed = at

    def _close_alarm(self) -> None:
        before, _ = self.told
        if (self.armed, self.packs) == self.told and before in self.handle.listTimers():
            return
        if before is not None and before != self.armed:
            self.handle.deleteTimer(before)
        if self.armed is not None:
            self.handle.registerTimer(self.armed)
            self.alarm.update((self.armed, self.packs))
        else:
            self.alarm.clear()


class DailyLimit(InOrder):
    """First ``limit`` rows of a UTC day pass; the next one raises the day's only alarm. Columns: id.

    A key is forgotten at the end of its day. ``keys`` are the key columns with their types.
    """

    memory_schema = "day long, n long"

    def __init__(self, limit: int, keys: str = "user_id long"):
        self.limit = limit
        self.output_schema = f"{keys}, at long, event_id long, tag string"

    def deadline(self, memory):
        return (memory[0] + 1) * DAY - 1

    def on_time(self, key, memory, at):
        return None, ()

    def on_row(self, key, memory, row):
        day = row[AT] // DAY
        n = memory[1] if memory and memory[0] == day else 0
        n += 1
        tag = "pass" if n <= self.limit else "alarm"
        out = [(*key, row[AT], row["event_id"], tag)] if n <= self.limit + 1 else []
        return (day, n), out

    def on_rows(self, key, memory, rows, out):
        at = rows.column(0).to_numpy()
        days, first, n = np.unique(at // DAY, return_index=True, return_counts=True)
        before = np.where(days == memory[0], memory[1], 0) if memory else np.zeros(len(days), dtype=int)
        nth = np.arange(1, len(at) + 1) - np.repeat(first, n) + np.repeat(before, n)
        told = np.flatnonzero(nth <= self.limit + 1)
        ids = listed(rows.column(1).take(pa.array(told)))
        out.extend((*key, t, i, "pass" if k <= self.limit else "alarm") for t, i, k in zip(at[told].tolist(), ids, nth[told].tolist()))
        return int(days[-1]), int(before[-1] + n[-1])


class PaymentWatch(InOrder):
    """Follows an order from creation (kind ``create``) to payment (``pay``). Columns: kind, id.

    Speaks up when both are known, and when the limit passes with one missing;
    a part that turns up after that corrects the report. What is known about an
    order is forgotten ``keep`` seconds after its last change, and its numbers ``no`` begin
    anew; the latest report by ``at``, the event time it was made, is the status of an order.
    """

    memory_schema = "created long, paid long, since long, no int, told boolean"
    output_schema = "order_id long, created long, paid long, status string, no int, at long"

    def __init__(self, limit: float, keep: float):
        self.limit, self.keep = int(limit * 1_000_000), int(keep * 1_000_000)

    def on_row(self, key, memory, row):
        created, paid, _, no, _ = memory or (None, None, None, 0, False)
        if row["kind"] == "create":
            known, created = created is not None, row[AT] if created is None else created
        elif row["kind"] != "pay":  # other kinds, null among them, say nothing about the order
            return memory, ()
        else:
            known, paid = paid is not None, row[AT] if paid is None else paid
        if known:
            return memory, ()
        if created is None or paid is None:
            return (created, paid, row[AT], no, False), ()
        status = "paid" if paid - created <= self.limit else "late"
        return (created, paid, row[AT], no + 1, True), [(*key, created, paid, status, no + 1, row[AT])]

    def deadline(self, memory):
        return memory[2] + (self.keep if memory[4] else self.limit)

    def on_time(self, key, memory, at):
        created, paid, _, no, told = memory
        if told:
            return None, ()
        status = "missing_create" if created is None else "timeout"
        return (created, paid, at, no + 1, True), [(*key, created, paid, status, no + 1, at)]


class RisingAlarm(InOrder):
    """Alarms when a value has not fallen for ``hold`` seconds; re-arms on the next row that does not fall.

    A row whose value is null neither falls nor counts as the value before; NaN is above all numbers, as in the batch form. Columns: vc, id.
    """

    memory_schema = "height double, due long"
    output_schema = "id long, alarm_at long"

    def __init__(self, hold: float):
        self.hold = int(hold * 1_000_000)

    def on_row(self, key, memory, row):
        if row["vc"] is None:
            return memory, ()
        height, due = memory or (0.0, None)
        value = math.inf if math.isnan(row["vc"]) else float(row["vc"])
        if value < height:
            due = None
        elif due is None:
            due = row[AT] + self.hold
        return (value, due), ()

    def deadline(self, memory):
        return memory[1]

    def on_time(self, key, memory, at):
        return (memory[0], None), [(*key, at)]


class NextRow(InOrder):
    """Two adjacent rows, the first marked ``is_first`` and the second ``is_second``, less than ``within`` apart."""

    memory_schema = "at long, id long, is_first boolean"
    output_schema = "user_id long, first_id long, second_id long"

    def __init__(self, within: float):
        self.within = int(within * 1_000_000)

    def on_row(self, key, memory, row):
        out = []
        if memory and memory[2] and row["is_second"] and row[AT] - memory[0] < self.within:
            out.append((*key, memory[1], row["event_id"]))
        return (row[AT], row["event_id"], row["is_first"]), out

    def on_rows(self, key, memory, rows, out):
        at, ids = rows.column(0).to_numpy(), listed(rows.column("event_id"))
        first, second = flags(rows.column("is_first")), flags(rows.column("is_second"))
        if memory:
            at, ids = np.concatenate([[memory[0]], at]), [memory[1], *ids]
            first, second = np.concatenate([[bool(memory[2])], first]), np.concatenate([[False], second])
        pairs = np.flatnonzero(first[:-1] & second[1:] & (np.diff(at) < self.within))
        out.extend((*key, ids[i], ids[i + 1]) for i in pairs.tolist())
        return int(at[-1]), ids[-1], bool(first[-1])


class FollowedBy(InOrder):
    """First rows with the nearest later second row within the limit; unmatched ones are reported when it passes."""

    memory_schema = "firsts array<struct<at: long, id: long>>"
    output_schema = "user_id long, first_id long, second_id long, tag string"

    def __init__(self, within: float):
        self.within = int(within * 1_000_000)

    def unpack(self, memory):
        return deque((f["at"], f["id"]) for f in memory[0])

    def pack(self, memory):
        return (list(memory),)

    def on_row(self, key, memory, row):
        firsts = memory if memory is not None else deque()
        out = []
        if row["is_second"]:  # every open first is less than the limit away: older ones were fired
            out = [(*key, f[1], row["event_id"], "match") for f in firsts if row[AT] - f[0] < self.within]
            out += [(*key, f[1], None, "timeout") for f in firsts if row[AT] - f[0] >= self.within]
            firsts.clear()
        if row["is_first"]:
            firsts.append((row[AT], row["event_id"]))
        return firsts if firsts else None, out

    def deadline(self, memory):
        return memory[0][0] + self.within

    def on_time(self, key, memory, at):
        first = memory.popleft()
        return memory if memory else None, [(*key, first[1], None, "timeout")]


class CountWindow(InOrder):
    """Total of every ``n`` rows of a key; an incomplete group is not emitted. Columns: cents, id.

    Rows whose value is null count as rows and add nothing; the total of null values alone is null.
    """

    memory_schema = "no long, rows long, cents long, some boolean"
    output_schema = "user_id long, window_no long, cents long"

    def __init__(self, n: int):
        self.n = n

    def on_rows(self, key, memory, rows, out):
        no, begun, cents, some = memory or (0, 0, 0, False)
        column = rows.column("cents")
        values, known = pc.fill_null(column, 0).to_numpy(), pc.is_valid(column).to_numpy(zero_copy_only=False)
        window = (begun + np.arange(len(values))) // self.n
        starts = np.flatnonzero(np.diff(window, prepend=-1))
        totals, there = np.add.reduceat(values, starts).tolist(), np.logical_or.reduceat(known, starts).tolist()
        totals[0], there[0] = totals[0] + cents, there[0] or some
        done = (begun + len(values)) // self.n
        out.extend((*key, no + i, total if any_value else None) for i, (total, any_value) in enumerate(zip(totals[:done], there)))
        left = (begun + len(values)) % self.n
        return (no + done, left, totals[-1], there[-1]) if left else (no + done, 0, 0, False)


class CountSlide(InOrder):
    """On every ``slide``-th row of a key the values of the last ``size`` rows or fewer, newest first. Columns: cents, id.

    The state holds a ring of the last values, whatever the number of rows.
    """

    memory_schema = "rows long, ring array<long>"
    output_schema = "user_id long, fired_at_row long, cents array<long>"

    def __init__(self, size: int, slide: int):
        self.size, self.slide = size, slide

    def on_rows(self, key, memory, rows, out):
        seen, ring = memory or (0, [])
        values = [*ring, *listed(rows.column("cents"))]
        for nth in range(seen + self.slide - seen % self.slide, seen + len(rows) + 1, self.slide):
            end = len(ring) + nth - seen
            out.append((*key, nth, values[max(0, end - self.size):end][::-1]))
        return seen + len(rows), values[-self.size:]


class Retract(InOrder):
    """Running count per key as a change log: a row that takes the old count back and one that sets the new. Columns: id."""

    memory_schema = "n long"

    def __init__(self, keys: str):
        self.output_schema = f"{keys}, at long, event_id long, added boolean, n long"

    def on_rows(self, key, memory, rows, out):
        n = memory[0] if memory else 0
        for at, event_id in zip(listed(rows.column(0)), listed(rows.column("event_id"))):
            if n:
                out.append((*key, at, event_id, False, n))
            n += 1
            out.append((*key, at, event_id, True, n))
        return (n,)


class NearFirst(InOrder):
    """Rows at most ``within`` seconds after the first row of their key. Columns: id."""

    memory_schema = "first long"
    output_schema = "user_id long, at long, event_id long, first_at long"

    def __init__(self, within: float):
        self.within = int(within * 1_000_000)

    def on_rows(self, key, memory, rows, out):
        at = listed(rows.column(0))
        first, begin = (memory[0], 0) if memory else (at[0], 1)
        ids = listed(rows.column("event_id"))
        out.extend((*key, t, i, first) for t, i in zip(at[begin:], ids[begin:]) if t - first <= self.within)
        return (first,)


class OnceAfterFirst(InOrder):
    """The first row of a key sets a timer ``wait`` seconds after it, which fires once. Columns: id."""

    memory_schema = "due long, fired boolean"
    output_schema = "user_id long, fired_at long"

    def __init__(self, wait: float):
        self.wait = int(wait * 1_000_000)

    def on_row(self, key, memory, row):
        return memory or (row[AT] + self.wait, False), ()

    def deadline(self, memory):
        return None if memory[1] else memory[0]

    def on_time(self, key, memory, at):
        return (memory[0], True), [(*key, at)]


class WithState(InOrder):
    """``step(memory, row) -> (memory, outputs)`` as a processor: emit one, many or no row per input row."""

    def __init__(self, step, memory_schema: str, output_schema: str):
        self.step, self.memory_schema, self.output_schema = step, memory_schema, output_schema

    def on_row(self, key, memory, row):
        memory, made = self.step(memory, row)
        return memory, [(*key, *o) for o in made]


class LateSplit(InOrder):
    """Passes rows on in order and marks those that came too late, and those without a time as undated. Columns: id."""

    memory_schema = "n long"
    output_schema = "user_id long, at long, event_id long, tag string"

    def on_rows(self, key, memory, rows, out):
        out.extend((*key, at, event_id, "on_time") for at, event_id in zip(listed(rows.column(0)), listed(rows.column("event_id"))))
        return None

    def on_late(self, key, row):
        return [(*key, row[AT], row["event_id"], "late")]

    def on_undated(self, key, row):
        return [(*key, None, row["event_id"], "undated")]


class Reconcile(InOrder):
    """Pairs the two sides of a key, at most ``within`` seconds apart; the first row of a side counts. Columns: is_left, id.

    ``tag`` is match, or only_left or only_right when the time is up. A key is forgotten ``within`` after its last report.
    """

    memory_schema = "left long, right long, since long, told boolean"
    output_schema = "key long, left_at long, right_at long, tag string"

    def __init__(self, within: float):
        self.within = int(within * 1_000_000)

    def on_row(self, key, memory, row):
        left, right, since, told = memory or (None, None, row[AT], False)
        if told:
            return memory, ()
        if row["is_left"] is None:  # of neither side
            return memory, ()
        if row["is_left"]:
            left = row[AT] if left is None else left
        else:
            right = row[AT] if right is None else right
        if left is None or right is None:
            return (left, right, since, False), ()
        return (left, right, row[AT], True), [(*key, left, right, "match")]

    def deadline(self, memory):
        return memory[2] + self.within

    def on_time(self, key, memory, at):
        left, right, _, told = memory
        if told:
            return None, ()
        return (left, right, at, True), [(*key, left, right, "only_left" if right is None else "only_right")]


class PatternWatch(InOrder):
    """Matches of a pattern of any number of steps, and those that run out of time. Columns: hits, id.

    The state holds the rows of open matches once, each with its row before (``nodes``), and the open matches as their last row. A match is
    reported as its steps and row ids.
    """

    memory_schema = ("nodes array<struct<before: int, step: int, id: long>>, "
                     "opened array<struct<start: long, node: int, state: int, edges: array<int>>>")

    def __init__(self, machine: Machine, keys: str = "user_id long"):
        self.machine = machine
        self.output_schema = f"{keys}, tag string, steps array<int>, ids array<long>"

    def unpack(self, memory):
        nodes: list[tuple] = []
        for before, step, row in (n.values() for n in memory[0]):
            nodes.append((nodes[before] if before >= 0 else None, step, row))
        edges = self.machine.edges
        return [(start, nodes[node], state, tuple(edges[state][e] for e in on)) for start, node, state, on in (m.values() for m in memory[1])]

    def pack(self, memory):
        nodes, place = [], {}

        def kept(path: tuple) -> int:
            way = []
            while path is not None and id(path) not in place:
                way.append(path)
                path = path[0]
            for node in reversed(way):
                before = -1 if node[0] is None else place[id(node[0])]
                place[id(node)] = len(nodes)
                nodes.append((before, node[1], node[2]))
            return place[id(way[0])] if way else place[id(path)]

        edges = self.machine.edges
        opened = [(start, kept(path), state, [edges[state].index(e) for e in on]) for start, path, state, on in memory]
        return nodes, opened

    def on_rows(self, key, memory, rows, out):
        opened, found = memory or [], []
        for at, hits, row in zip(*(listed(rows.column(i)) for i in range(3))):
            if opened or hits & 1:
                opened = self.machine.feed(opened, at, hits, row, True, found)
        self._tell(key, found, out)
        return opened or None

    def deadline(self, memory):
        return min(m[0] for m in memory) + self.machine.within

    def on_time(self, key, memory, at):
        found, out = [], []
        left = self.machine.expire(memory, at, found)
        self._tell(key, found, out)
        return left or None, out

    def _tell(self, key, found, out):
        for tag, path in found:
            steps, ids = zip(*rows_of(path))
            out.append((*key, tag, list(steps), list(ids)))


class StateKinds(StatefulProcessor):
    """Value, list and map state side by side: rows so far, ids of the newest rows (those that have one), rows per type (null is one)."""

    output_schema = "user_id long, event_type string, of_type long, n long, newest string"

    def __init__(self, newest: int):
        self.newest = newest

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.n = handle.getValueState("n", "n long")
        self.ids = handle.getListState("ids", "event_id long")
        self.types = handle.getMapState("types", "event_type string", "n long")

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:
        total = self.n.get()[0] if self.n.exists() else 0
        ids = [i[0] for i in self.ids.get()]
        seen: dict[str, int] = {}
        for r in rows:
            total += 1
            if r["event_id"] is not None:
                ids = sorted([*ids, r["event_id"]])[-self.newest:]
            seen[r["event_type"]] = seen.get(r["event_type"], 0) + 1
        self.n.update((total,))
        self.ids.put([(i,) for i in ids])
        for event_type, more in seen.items():
            before = self.types.getValue((event_type,))[0] if self.types.containsKey((event_type,)) else 0
            self.types.updateValue((event_type,), (before + more,))
        newest = ",".join(str(i) for i in ids)
        result = _record(self.output_schema)
        return iter([result(key[0], t[0], n[0], total, newest) for t, n in self.types.iterator()])

    def close(self) -> None:
        pass


class AlarmClock(StatefulProcessor):
    """Each row sets a timer ``wait`` milliseconds of wall-clock time after it; its firing gives a row."""

    output_schema = "user_id long, set_rows long"

    def __init__(self, wait: int):
        self.wait = wait

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.set_rows = handle.getMapState("set_rows", "millis long", "n long")

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:
        at = timerValues.getCurrentProcessingTimeInMs() + self.wait
        n = sum(1 for _ in rows)
        if self.set_rows.containsKey((at,)):
            n += self.set_rows.getValue((at,))[0]
        else:
            self.handle.registerTimer(at)
        self.set_rows.updateValue((at,), (n,))
        return iter(())

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[Row]:
        at = expiredTimerInfo.getExpiryTimeInMs()
        n = self.set_rows.getValue((at,))[0]
        self.set_rows.removeKey((at,))
        return iter([_record(self.output_schema)(key[0], n)])

    def close(self) -> None:
        pass
