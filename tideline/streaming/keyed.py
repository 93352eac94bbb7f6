"""Per-key state of a stream in Spark's own state store: timers, state that expires, and lists of rows.

Rows of a key are taken in order. They are brought into one form first (``packed``): each task sorts what it has read
and hands on, per key, arrays instead of rows, so the work that grows with a key's rows is done before the shuffle and
a key's own task only merges sorted arrays. What it holds is one micro-batch of one key, whose size the source bounds
(``files_per_batch``), and the state.

State leaves by event time: a timer is set to when a key's state can matter no more, is moved when the key goes on,
and clears the state when the watermark passes it. So the store holds the keys that are alive, not all keys ever seen.

Processors travel with their code (``travels_whole``): the process in which Spark prepares a processor beside the driver
is not given the files of ``addPyFile`` or ``--py-files`` and need not find this package otherwise.
"""

from __future__ import annotations

import json
import sys
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

#: Names do not begin with an underscore, as the rows that processors get are made of named tuples.
#: Event time of what ``packed`` hands on: the newest row of a chunk.
CHUNK_TIME = "rt__"
#: Which keys of a group are null, as a 1 or 0 for each; state is kept under keys without nulls.
NULLS = "nulls__"
#: Which whole numbers of a chunk's rows are null: bit i for column i, and nothing if none is. With nulls in their
#: arrays, numbers would reach a processor as floats.
ABSENT = "absent__"


def travels_whole(module: str) -> None:
    """Send the classes and functions of a module to Python workers as code, not as names to import.

    A module with processors of its own calls this with its ``__name__``.
    """
    cloudpickle.register_pickle_by_value(sys.modules[module])


travels_whole(__name__)


def _key_type(frame: DataFrame, key: str) -> T.DataType:
    kind = frame.schema[key].dataType
    if not isinstance(kind, (T.NumericType, T.StringType)):
        raise ValueError(f"key {key} must be a number or a text")
    return kind


def grouping(frame: DataFrame, keys: list[str]) -> DataFrame:
    """Keys with something else in place of null, and ``NULLS``, which tells them apart."""
    filled = {}
    for k in keys:
        kind = _key_type(frame, k)
        filled[k] = F.coalesce(F.col(k), F.lit("" if isinstance(kind, T.StringType) else 0).cast(kind))
    nulls = F.concat(F.lit(""), *[F.when(F.col(k).isNull(), "1").otherwise("0") for k in keys])
    return frame.select(*[filled[k].alias(k) if k in keys else k for k in frame.columns], nulls.alias(NULLS))


def key_values(keys: list[str], key: tuple) -> dict:
    """The keys of a group as they were, from its grouping key, of which ``NULLS`` is the last."""
    return {k: None if null == "1" else value for k, value, null in zip(keys, key, key[-1])}


def packed(rows: DataFrame, keys: list[str], order: list[str], delay: str, masked: bool = False) -> DataFrame:
    """One row per key (and ``NULLS``) and Arrow batch, with a sorted array for every other column, and the watermark.

    ``order`` starts with epoch milliseconds; rows without them are the last of their key and move no watermark. A chunk
    is as late as its newest row, so rows that a source delivers more than ``delay`` out of order may still be taken in,
    but never the other way round. With ``masked``, null whole numbers are 0 in the arrays and told by ``ABSENT``.
    """
    rows, keys = grouping(rows, keys), [*keys, NULLS]
    rest = [c for c in rows.columns if c not in keys]
    whole = [i for i, c in enumerate(rest) if masked and isinstance(rows.schema[c].dataType, T.IntegralType)]
    if whole and whole[-1] > 62:
        raise ValueError("put whole numbers among the first 63 columns besides the keys")
    fields = [rows.schema[k] for k in keys]
    fields += [T.StructField(c, T.ArrayType(rows.schema[c].dataType)) for c in rest]
    fields += [T.StructField(ABSENT, T.ArrayType(T.LongType()))] if masked else []
    schema = T.StructType([*fields, T.StructField("newest__", T.LongType())])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch]).sort_by([(c, "ascending") for c in [*keys, *order]]).combine_chunks()
            changed = np.zeros(table.num_rows, bool)
            changed[0] = True
            for k in keys:
                codes = np.asarray(pc.dictionary_encode(table[k]).combine_chunks().indices)
                changed[1:] |= codes[1:] != codes[:-1]
            first = np.flatnonzero(changed)
            bounds = pa.array(np.append(first, table.num_rows).astype(np.int32))
            columns = [table[k].combine_chunks().take(pa.array(first)) for k in keys]
            absent = np.zeros(table.num_rows, np.int64)
            for i, c in enumerate(rest):
                values = table[c].combine_chunks()
                if i in whole and values.null_count:
                    absent |= np.asarray(pc.is_null(values)).astype(np.int64) << i
                    values = pc.fill_null(values, 0)
                columns.append(pa.ListArray.from_arrays(bounds, values))
            if masked and absent.any():
                columns.append(pa.ListArray.from_arrays(bounds, pa.array(absent)))
            elif masked:
                nothing = pa.array(np.zeros(len(first) + 1, np.int32))
                columns.append(pa.ListArray.from_arrays(nothing, pa.array([], pa.int64())))
            # Rows without a time are the last of each key.
            times = table[order[0]].combine_chunks()
            timed = np.add.reduceat(np.asarray(pc.is_valid(times)).astype(np.int64), first)
            newest = np.asarray(pc.fill_null(times, 0))[np.maximum(first + timed - 1, 0)]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(newest, pa.int64(), mask=timed == 0)], names=schema.names)

    chunks = rows.mapInArrow(pack, schema).withColumn(CHUNK_TIME, F.timestamp_millis("newest__"))
    return chunks.drop("newest__").withWatermark(CHUNK_TIME, delay)


def unpacked(chunks: list[pd.DataFrame], columns: list[str]) -> pd.DataFrame:
    """The rows of what ``packed`` has made of a key; whole numbers of which some are null are of pandas' own kind."""
    rows = pd.DataFrame({c: np.concatenate([x for chunk in chunks for x in chunk[c]]) for c in columns})
    packs = [pack for chunk in chunks for pack in zip(chunk[ABSENT], chunk[columns[0]])]
    if any(len(bits) for bits, _ in packs):
        absent = np.concatenate([bits if len(bits) else np.zeros(len(own), np.int64) for bits, own in packs])
        for i, c in enumerate(columns):
            mask = (absent >> i & 1).astype(bool)
            if mask.any():
                rows[c] = pd.arrays.IntegerArray(rows[c].to_numpy(), mask)
    return rows


class InOrder(StatefulProcessor):
    """Rows of a key, in order, a micro-batch at a time; those without a time come last.

    A subclass says what it keeps (``open``), what comes out (``on_rows``) and when its state is void (``alive_until``,
    epoch milliseconds or None for never).
    """

    #: Rows without a time are left out.
    timed_only = False

    def __init__(self, keys: list[str], order: list[str], columns: list[str], output: list[str]):
        self.keys, self.order, self.columns, self.output = keys, order, columns, output

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open(handle)

    def open(self, handle: StatefulProcessorHandle) -> None:
        raise NotImplementedError

    def on_rows(self, rows: pd.DataFrame) -> pd.DataFrame:
        raise NotImplementedError

    def alive_until(self) -> int | None:
        return None

    def clear(self) -> None:
        raise NotImplementedError

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        merged = unpacked(list(rows), self.columns)
        out = self.on_rows(merged.sort_values(self.order, kind="stable", ignore_index=True))
        self._move_timer()
        if len(out):
            yield self._keyed(key, out)

    def _move_timer(self) -> None:
        until = self.alive_until()
        if until is None:
            return
        for timer in list(self.handle.listTimers()):
            if timer != until:
                self.handle.deleteTimer(timer)
        self.handle.registerTimer(int(until))

    def _keyed(self, key, out: pd.DataFrame) -> pd.DataFrame:
        return out.assign(**key_values(self.keys, key))[self.output]

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.clear()
        return iter(())

    def close(self) -> None:
        pass


class ExpiringCounter(InOrder):
    """Number of a row among its key's rows since the last ``ttl`` ms without one, as column ``name``; 1 for a row
    without a time."""

    def __init__(self, keys, order, columns, output, ttl: int, name: str):
        super().__init__(keys, order, columns, output)
        self.ttl, self.name = ttl, name

    def open(self, handle):
        self.state = handle.getValueState("counter", "n LONG, last LONG")

    def on_rows(self, rows):
        n, self.last = self.state.get() if self.state.exists() else (0, None)
        time = rows[self.order[0]].dropna().to_numpy(np.int64)
        count = np.ones(len(rows), np.int64)
        if len(time):
            count[: len(time)] = self._counted(time, n, self.last)
            self.last = int(time[-1])
            self.state.update((int(count[len(time) - 1]), self.last))
        return rows.assign(**{self.name: count})

    def _counted(self, time: np.ndarray, n: int, last: int | None) -> np.ndarray:
        fresh = np.empty(len(time), bool)
        fresh[0] = last is None or time[0] - last >= self.ttl
        fresh[1:] = np.diff(time) >= self.ttl
        at = np.arange(len(time))
        start = np.maximum.accumulate(np.where(fresh, at, -1))
        return np.where(start >= 0, at - start + 1, n + at + 1)

    def alive_until(self):
        return None if self.last is None else self.last + self.ttl

    def clear(self):
        self.state.clear()


@dataclass(frozen=True)
class Value:
    """A running value: the ``sum`` of a whole-number column (null as long as all are), or the newest text of a column
    that was not null."""

    name: str
    kind: str
    column: str
    inclusive: bool = True


class RunningValues(InOrder):
    """Running values of a key; the state holds one value for each and is written for keys with new rows only."""

    def __init__(self, keys, order, columns, output, values: list[Value]):
        super().__init__(keys, order, columns, output)
        self.values = values

    def open(self, handle):
        types = ", ".join(f"v{i} {'LONG' if v.kind == 'sum' else 'STRING'}" for i, v in enumerate(self.values))
        self.state = handle.getValueState("reached", types)

    def prepare(self, rows: pd.DataFrame, first: bool) -> pd.DataFrame:
        """The rows with columns that depend on whether the key's first row is among them."""
        return rows

    def on_rows(self, rows):
        known = self.state.get() if self.state.exists() else None
        rows = self.prepare(rows, known is None)
        reached = []
        for value, before in zip(self.values, known or [None] * len(self.values)):
            if value.kind == "sum":
                own = rows[value.column]
                counted = np.logical_or.accumulate(own.notna().to_numpy()) | (before is not None)
                up_to = int(before or 0) + np.cumsum(own.fillna(0).to_numpy(np.int64))
                reached.append(int(up_to[-1]) if counted[-1] else None)
                before = int(before or 0)
            else:
                own = rows[value.column].to_numpy()
                at = np.maximum.accumulate(np.where(pd.notna(own), np.arange(len(own)), -1))
                up_to = np.where(at >= 0, own[at], before).astype(object)
                reached.append(up_to[-1])
            if not value.inclusive:
                up_to = np.concatenate((np.array([before], up_to.dtype), up_to[:-1]))
            elif value.kind == "sum" and not counted.all():
                up_to = pd.arrays.IntegerArray(up_to, ~counted)
            rows = rows.assign(**{value.name: up_to})
        self.state.update(tuple(reached))
        return rows


class CountChanges(InOrder):
    """What each micro-batch does to its keys' row counts: ``+I``, or ``-U`` of the old and ``+U`` of the new one."""

    def __init__(self, keys, order, columns, output, name: str):
        super().__init__(keys, order, columns, output)
        self.name = name

    def open(self, handle):
        self.state = handle.getValueState("count", "n LONG")

    def on_rows(self, rows):
        old = self.state.get()[0] if self.state.exists() else 0
        new = int(old) + len(rows)
        self.state.update((new,))
        ops = [("-U", int(old)), ("+U", new)] if old else [("+I", new)]
        return pd.DataFrame(ops, columns=["op", self.name])


class SequenceWithin(InOrder):
    """``trigger`` rows before which ``first`` and, after it, ``then`` occurred, all within ``ttl`` ms."""

    timed_only = True

    def __init__(self, keys, order, columns, output, kind: str, first: str, then: str, trigger: str, ttl: int):
        super().__init__(keys, order, columns, output)
        self.kind, self.first, self.then, self.trigger, self.ttl = kind, first, then, trigger, ttl

    def open(self, handle):
        # Times of the newest ``first`` row and of the newest one that a ``then`` row followed.
        self.state = handle.getValueState("steps", "open LONG, matched LONG")

    def on_rows(self, rows):
        never = np.iinfo(np.int64).min // 2
        known = self.state.get() if self.state.exists() else (None, None)
        was_open, was_matched = (never if x is None else x for x in known)
        time, kind = rows[self.order[0]].to_numpy(np.int64), rows[self.kind].to_numpy()
        opened = np.maximum.accumulate(np.where(kind == self.first, time, was_open))
        before = np.concatenate(([was_open], opened[:-1]))
        matched = np.maximum.accumulate(np.where(kind == self.then, before, was_matched))
        seen = np.concatenate(([was_matched], matched[:-1]))
        self.newest = int(opened[-1])
        if self.newest > never:
            self.state.update((self.newest, int(matched[-1]) if matched[-1] > never else None))
        else:
            self.newest = None
        return rows[(kind == self.trigger) & (np.maximum(was_matched, seen) > time - self.ttl)]

    def alive_until(self):
        return None if self.newest is None else self.newest + self.ttl

    def clear(self):
        self.state.clear()


#: Turns the rows of some windows, told apart by the given column, into one row per window that fired.
WindowFunction = Callable[[pd.DataFrame, str], pd.DataFrame]


class RowWindows(InOrder):
    """Windows over rows of a key that a trigger fires; the rows of the open window are kept as list state."""

    def __init__(self, keys, order, columns, output, number: str, types: str, function: WindowFunction):
        super().__init__(keys, order, columns, output)
        self.number, self.types, self.function = number, types, function

    def open(self, handle):
        self.kept = handle.getListState("rows", self.types)
        self.count = handle.getValueState("count", "n LONG")

    def on_rows(self, rows):
        held = list(self.kept.get()) if self.kept.exists() else []
        n = self.count.get()[0] if self.count.exists() else 0
        if held:
            rows = pd.DataFrame({c: self._put_before(rows[c], values) for c, values in zip(self.columns, zip(*held))})
        fired, left, n = self.fire(rows, len(held), int(n))
        # List state is put anew: purged rows are gone, evicted ones too.
        if len(left):
            self.kept.put(list(zip(*([None if x is pd.NA else x for x in left[c].tolist()] for c in self.columns))))
        else:
            self.kept.clear()
        self.count.update((n,))
        return self.function(fired, self.number) if len(fired) else fired

    @staticmethod
    def _put_before(fresh: pd.Series, values: tuple):
        """A column with values of the state before those that have come; both may hold nulls."""
        if fresh.dtype.kind == "i" and (None in values or pd.api.types.is_extension_array_dtype(fresh.dtype)):
            kind = f"Int{8 * fresh.dtype.itemsize}"
            return pd.concat([pd.Series(values, dtype=kind), fresh.astype(kind)], ignore_index=True)
        before = np.empty(len(values), fresh.dtype)
        before[:] = values
        return np.concatenate((before, fresh.to_numpy()))

    def fire(self, rows: pd.DataFrame, held: int, n: int) -> tuple[pd.DataFrame, pd.DataFrame, int]:
        """Rows of the windows that fire, the rows to keep, and the new count; the first ``held`` rows are known."""
        raise NotImplementedError

    def clear(self):
        self.kept.clear()


class CountTumble(RowWindows):
    """Each ``size`` rows are a window, numbered from 0; firing purges it."""

    def __init__(self, *args, size: int):
        super().__init__(*args)
        self.size = size

    def fire(self, rows, held, n):
        full = len(rows) // self.size * self.size
        fired = rows.iloc[:full].assign(**{self.number: n + np.arange(full) // self.size})
        return fired, rows.iloc[full:], n + full // self.size


class CountSlide(RowWindows):
    """One window that fires after every ``fire_every`` rows, numbered from 1, once all but the newest ``keep_last``
    rows are evicted."""

    def __init__(self, *args, fire_every: int, keep_last: int):
        super().__init__(*args)
        self.fire_every, self.keep_last = fire_every, keep_last

    def fire(self, rows, held, n):
        # Of all rows of the key, those here have the numbers n - held + 1 to n + fresh.
        fresh = len(rows) - held
        firings = np.arange(n // self.fire_every + 1, (n + fresh) // self.fire_every + 1)
        ends = firings * self.fire_every - (n - held)
        begins = np.maximum(ends - self.keep_last, 0)
        sizes = ends - begins
        within = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        fired = rows.iloc[np.repeat(begins, sizes) + within].assign(**{self.number: np.repeat(firings, sizes)})
        return fired, rows.iloc[max(len(rows) - self.keep_last, 0) :], n + fresh


class MarkerWindows(RowWindows):
    """A row whose ``marker`` column is true closes its window, which fires with its newest ``keep_last`` rows and is
    purged; windows are numbered from 0. Of an open window no more rows are kept than it could fire with. Rows without
    a time are a window's oldest."""

    def __init__(self, *args, marker: str, keep_last: int):
        super().__init__(*args)
        self.marker, self.keep_last = marker, keep_last

    def fire(self, rows, held, n):
        closes = rows[self.marker].to_numpy(bool)
        window = np.concatenate(([0], np.cumsum(closes)[:-1]))
        timed = rows[self.order[0]].notna().to_numpy()
        if not timed.all():
            at = np.lexsort((timed, window))
            rows, closes, window = rows.iloc[at], closes[at], window[at]
        newest = np.flatnonzero(np.append(window[1:] != window[:-1], True))[window]
        kept = newest - np.arange(len(rows)) < self.keep_last
        closed = int(closes.sum())
        done = window < closed
        numbered = rows.assign(**{self.number: n + window})
        return numbered[kept & done], rows[kept & ~done], n + closed


class DueAlerts(StatefulProcessor):
    """An alert ``delay`` ms after each watched row; timers of the same key and time are one."""

    def __init__(self, key: str, times: str, watched: str, name: str, delay: int):
        self.key, self.times, self.watched, self.name, self.delay = key, times, watched, name, delay

    def init(self, handle):
        self.handle = handle

    def handleInputRows(self, key, rows, timerValues):
        for chunk in rows:
            times, watched = (np.concatenate(list(chunk[c])) for c in (self.times, self.watched))
            for time in np.unique(times[watched.astype(bool)]):
                self.handle.registerTimer(int(time) + self.delay)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        found = key_values([self.key], (key[0], key[-1][:1]))
        yield pd.DataFrame({**{k: [v] for k, v in found.items()}, self.name: [expiredTimerInfo.getExpiryTimeInMs()]})

    def close(self):
        pass


class SilenceAlerts(StatefulProcessor):
    """An alert for a watched row that nothing of its key followed within ``delay`` ms.

    What is kept of a key are its stretches: rows that follow each other within ``delay``, told by their first time
    and their last row. The key's one timer is that of the stretch that is over first; when it goes off, all stretches
    the watermark has passed are told at once. Rows may come in any order up to the watermark.
    """

    def __init__(self, key: str, order: list[str], delay: int):
        self.key, self.order, self.delay = key, order, delay

    def init(self, handle):
        self.handle = handle
        self.state = handle.getValueState(
            "stretches", "first ARRAY<BIGINT>, last ARRAY<BIGINT>, id ARRAY<BIGINT>, watched ARRAY<BOOLEAN>"
        )

    def handleInputRows(self, key, rows, timerValues):
        known = list(zip(*self.state.get())) if self.state.exists() else []
        fresh = [x for chunk in rows for x in zip(chunk["first__"], chunk["last__"], chunk["id__"], chunk["watched__"])]
        merged = joined_stretches([*known, *fresh], self.delay)
        self._store(merged)
        due = self._due(merged)
        timers = list(self.handle.listTimers())
        for timer in timers:
            if timer != due:
                self.handle.deleteTimer(timer)
        if due is not None and due not in timers:
            self.handle.registerTimer(due)
        return iter(())

    def _due(self, stretches: list[tuple]) -> int | None:
        return int(stretches[0][1]) + self.delay + 1 if stretches else None

    def _store(self, stretches: list[tuple]) -> None:
        if stretches:
            first, last, ids, watched = zip(*stretches)
            self.state.update(
                ([int(x) for x in first], [int(x) for x in last], [int(x) for x in ids], [bool(x) for x in watched])
            )
        else:
            self.state.clear()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        passed = timerValues.getCurrentWatermarkInMs() - self.delay
        known = list(zip(*self.state.get())) if self.state.exists() else []
        left = [s for s in known if s[1] >= passed]
        self._store(left)
        if left:
            self.handle.registerTimer(self._due(left))
        alerts = [s for s in known if s[1] < passed and s[3]]
        if alerts:
            time, ident = self.order
            own = {k: [v] * len(alerts) for k, v in key_values([self.key], key).items()}
            last, row = [s[1] for s in alerts], [s[2] for s in alerts]
            yield pd.DataFrame({**own, time: last, ident: row, "alert_time": [x + self.delay for x in last]})

    def close(self):
        pass


def joined_stretches(stretches: list[tuple], delay: int) -> list[tuple]:
    """Stretches (first, last, id of the last row, whether that is watched) of which no two are within ``delay``."""
    out: list[tuple] = []
    for first, last, row, watched in sorted(stretches, key=lambda s: (s[0], s[1], s[2])):
        if out and first - out[-1][1] <= delay:
            a = out[-1]
            newest = max((a[1], a[2], a[3]), (last, row, watched))
            out[-1] = (a[0], *newest)
        else:
            out.append((first, last, row, watched))
    return out


class VersionsByTime(StatefulProcessor):
    """Rows with the newest version of their key that is not younger than they are, for a group of keys.

    Rows and versions wait until the watermark passes them, so a version that arrives late still counts. Of the versions
    the watermark has passed only the newest of a key is kept, in pages of at most ``PAGE`` keys on average, so that a
    call reads and writes a few pages and not the group's whole state, and not a key at a time either.
    """

    #: What waits: keys and the other columns as JSON; side 0 are versions.
    ENTRY = {"key__": pa.string(), "side__": pa.int32(), "at__": pa.int64(), "id__": pa.int64(), "data__": pa.string()}
    #: A version is found before a row of the same time, and the last of several versions is the newest.
    ORDER = ["key__", "at__", "side__", "id__", "data__"]
    PAGE = 32

    def init(self, handle):
        self.handle = handle
        self.waiting = handle.getListState("waiting", "entries BINARY")
        self.pages = handle.getMapState("pages", "page INT", "versions STRING")
        self.size = handle.getValueState("size", "pages INT, keys LONG")

    def handleInputRows(self, key, rows, timerValues):
        soonest = []
        for chunk in rows:
            columns = {c: pa.array(np.concatenate(list(chunk[c])), kind) for c, kind in self.ENTRY.items()}
            self.waiting.appendValue((self._written(pa.table(columns)),))
            soonest.append(pc.min(columns["at__"]).as_py())
        timers = list(self.handle.listTimers())
        if not any(timer <= min(soonest) for timer in timers):
            for timer in timers:
                self.handle.deleteTimer(timer)
            self.handle.registerTimer(min(soonest))
        return iter(())

    @staticmethod
    def _written(entries: pa.Table) -> bytes:
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, entries.schema) as writer:
            writer.write_table(entries)
        return sink.getvalue().to_pybytes()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        held = [pa.ipc.open_stream(bytes(x[0])).read_all() for x in self.waiting.get()] if self.waiting.exists() else []
        if not held:
            return
        entries = pa.concat_tables(held)
        passed = pc.less_equal(entries["at__"], timerValues.getCurrentWatermarkInMs())
        ready, left = entries.filter(passed), entries.filter(pc.invert(passed))
        if left.num_rows:
            self.waiting.put([(self._written(left),)])
            # The timer that has gone off is still listed.
            self.handle.registerTimer(pc.min(left["at__"]).as_py())
        else:
            self.waiting.clear()
        if ready.num_rows:
            out = self._found(ready)
            if len(out):
                yield out

    def _found(self, ready: pa.Table) -> pd.DataFrame:
        """The rows with their versions; the newest versions are kept."""
        count, keys = self.size.get() if self.size.exists() else (1, 0)
        page_of = {k: self._page_of(k, count) for k in pc.unique(ready["key__"]).to_pylist()}
        pages = {page: self._page(page) for page in set(page_of.values())}
        known = [(k, 0, *pages[page][k]) for k, page in page_of.items() if k in pages[page]]
        if known:
            before = [pa.array(values, kind) for values, kind in zip(zip(*known), self.ENTRY.values())]
            ready = pa.concat_tables([ready, pa.table(before, list(self.ENTRY))])
        ready = ready.sort_by([(c, "ascending") for c in self.ORDER]).combine_chunks()
        owner, data = (ready[c].combine_chunks() for c in ("key__", "data__"))
        codes = np.asarray(pc.dictionary_encode(owner).indices)
        first = np.append(True, codes[1:] != codes[:-1])
        version, at = np.asarray(ready["side__"]) == 0, np.arange(len(first))
        newest = np.maximum.accumulate(np.where(version, at, -1))
        none = newest < np.maximum.accumulate(np.where(first, at, 0))
        last = np.flatnonzero(np.append(first[1:], True) & ~none)
        self._keep(ready.take(pa.array(newest[last])), pages, page_of, int(count), int(keys))
        rows = np.flatnonzero(~version)
        found = pa.array(newest[rows], mask=none[rows])
        return pd.DataFrame(
            {"key__": owner.take(pa.array(rows)), "data__": data.take(pa.array(rows)), "version__": data.take(found)}
        )

    def _keep(self, newest: pa.Table, pages: dict, page_of: dict, count: int, keys: int) -> None:
        changed, before = set(), keys
        for k, *version in zip(*(newest[c].to_pylist() for c in ("key__", "at__", "id__", "data__"))):
            page = page_of[k]
            if pages[page].get(k) != version:
                keys += k not in pages[page]
                pages[page][k] = version
                changed.add(page)
        if keys > count * self.PAGE:
            # Twice as many pages or more, all written anew: as rarely as the number of keys doubles.
            every = [v for p in range(count) for v in (pages[p] if p in pages else self._page(p)).items()]
            while keys > count * self.PAGE:
                count *= 2
            pages, changed = {p: {} for p in range(count)}, range(count)
            for k, version in every:
                pages[self._page_of(k, count)][k] = version
        for page in changed:
            self.pages.updateValue((page,), (json.dumps(pages[page]),))
        if keys > before:
            self.size.update((count, keys))

    @staticmethod
    def _page_of(key: str, count: int) -> int:
        return zlib.crc32(key.encode()) % count

    def _page(self, page: int) -> dict:
        """Time, id and data of the newest version, by key."""
        found = self.pages.getValue((page,))
        return json.loads(found[0]) if found else {}

    def close(self):
        pass


def _one_key(keys: list[str]) -> str:
    if len(keys) != 1:
        raise ValueError("give one key column; make a struct's text or a hash of several")
    return keys[0]


def in_order(
    rows: DataFrame, keys: list[str], order: list[str], delay: str, output: str, processor: Callable[..., InOrder], *args, **named
) -> DataFrame:
    """Run an ``InOrder`` processor over a stream; ``output`` is the DDL of the result, keys and row columns by name."""
    schema = T.StructType.fromDDL(output)
    if processor.timed_only:
        rows = rows.where(F.col(order[0]).isNotNull())
    columns = [c for c in rows.columns if c not in keys]
    made = processor(keys, order, columns, schema.names, *args, **named)
    chunks = packed(rows, keys, order, delay, masked=True)
    return chunks.groupBy(*keys, NULLS).transformWithStateInPandas(made, schema, "append", "EventTime")


def row_windows(
    rows: DataFrame, keys: list[str], order: list[str], delay: str, output: str, number: str, function: WindowFunction,
    processor: Callable[..., RowWindows], **named,
) -> DataFrame:
    """Run one of the ``RowWindows`` over a stream; ``function`` sums up the rows of the windows that fire."""
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.drop(*keys).schema)
    return in_order(rows, keys, order, delay, output, processor, number, kept, function, **named)


def due_alerts(
    rows: DataFrame, keys: list[str], time: str, watched: str, delay_ms: int, delay: str, parts: int = 64
) -> DataFrame:
    """An alert per key and due time, ``delay_ms`` after each row whose ``watched`` column is true, once the watermark
    has passed it.

    Rows without a time are left out. All others move the watermark on, but of those that are not watched only the newest of a batch goes further. Alerts
    do not depend on each other, so a key's rows are spread over ``parts`` sets of timers by their time.
    """
    key = _one_key(keys)
    part = F.pmod(F.xxhash64(time), F.lit(parts)).cast("int").alias("part__")
    timed = rows.where(F.col(time).isNotNull())
    spread = timed.select(key, part, time, F.coalesce(watched, F.lit(False)).alias("watched__"))

    def fewer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                kept = np.asarray(batch.column(3)).copy()
                kept[np.argmax(np.asarray(batch.column(2)))] = True
                yield batch.filter(pa.array(kept))

    schema = T.StructType([rows.schema[key], T.StructField("alert_time", T.LongType())])
    chunks = packed(spread.mapInArrow(fewer, spread.schema), [key, "part__"], [time], delay).groupBy(key, "part__", NULLS)
    made = DueAlerts(key, time, "watched__", "alert_time", delay_ms)
    return chunks.transformWithStateInPandas(made, schema, "append", "EventTime")


def silence_alerts(
    rows: DataFrame, keys: list[str], order: list[str], watched: str, delay_ms: int, delay: str
) -> DataFrame:
    """An alert for each row whose ``watched`` column is true and which ``delay_ms`` of silence follow.

    ``order`` is a time in ms and a whole-number id; rows without a time are left out. A task joins what it has read of a key into stretches first, so
    a key with many rows sends few.
    """
    key = _one_key(keys)
    time, ident = order
    ready = grouping(rows.where(F.col(time).isNotNull()).select(key, *order, watched), [key])
    schema = T.StructType(
        [ready.schema[key], ready.schema[NULLS], *[T.StructField(n, T.LongType()) for n in ("first__", "last__", "id__")],
         T.StructField("watched__", T.BooleanType())]
    )

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            table = pa.Table.from_batches([batch]).sort_by([(c, "ascending") for c in (key, NULLS, *order)]).combine_chunks()
            if not table.num_rows:
                continue
            codes = [np.asarray(pc.dictionary_encode(table[c]).combine_chunks().indices) for c in (key, NULLS)]
            times = np.asarray(table[time].combine_chunks())
            breaks = np.diff(times) > delay_ms
            for c in codes:
                breaks |= c[1:] != c[:-1]
            first, last = np.flatnonzero(np.append(True, breaks)), np.flatnonzero(np.append(breaks, True))
            column = lambda name, at: table[name].combine_chunks().take(pa.array(at))
            yield pa.RecordBatch.from_arrays(
                [column(key, first), column(NULLS, first), column(time, first), column(time, last), column(ident, last).cast(pa.int64()),
                 pc.fill_null(column(watched, last), False)],
                names=schema.names,
            )

    stretches = ready.mapInArrow(pack, schema)
    marked = stretches.withColumn(CHUNK_TIME, F.timestamp_millis("last__")).withWatermark(CHUNK_TIME, delay)
    result = T.StructType([rows.schema[key], *[T.StructField(n, T.LongType()) for n in (time, ident, "alert_time")]])
    return marked.groupBy(key, NULLS).transformWithStateInPandas(
        SilenceAlerts(key, order, delay_ms), result, "append", "EventTime"
    )


def as_of_join(
    left: DataFrame,
    versions: DataFrame,
    keys: list[str],
    left_order: list[str],
    version_order: list[str],
    columns: list[str],
    delay: str,
    parts: int = 8,
    groups: int = 512,
) -> DataFrame:
    """Stream form of ``joins.as_of_join``: left rows with the newest version not after them, once the watermark has
    passed them; versions up to ``delay`` late take part.

    Times are ms, ids whole numbers. Keys are dealt to ``groups`` by their hash, as a call per key costs more than its
    rows do. A group's rows are spread over ``parts`` states by their id, and its versions, of which the state keeps few,
    go to each of them; a task holds one micro-batch of one such state. A null key has no version. Rows and versions without
    a time are left out, as no watermark passes them. Late ones are judged with what else a task has read of their group.
    """
    kept = left.drop(*keys)

    def side(frame: DataFrame, order: list[str], number: int, names: list[str], part) -> DataFrame:
        return frame.where(F.col(order[0]).isNotNull()).select(
            *keys, part.cast("int").alias("part__"), F.lit(number).alias("side__"), F.col(order[0]).cast("long").alias("at__"),
            F.coalesce(F.col(order[1]).cast("long"), F.lit(np.iinfo(np.int64).min)).alias("id__"),
            F.to_json(F.struct(*names)).alias("data__"),
        )

    def signless(key: str):
        # Zero has two signs, which are one key.
        float_key = isinstance(_key_type(both, key), (T.FloatType, T.DoubleType))
        return F.when(F.col(key) == 0, F.abs(key)).otherwise(F.col(key)).alias(key) if float_key else F.col(key)

    # Versions are packed once, as part -1, and then copied to the parts.
    both = side(left, left_order, 1, kept.columns, F.pmod(F.xxhash64(left_order[1]), F.lit(parts))).unionByName(
        side(versions.dropna(subset=keys), version_order, 0, columns, F.lit(-1))
    )
    owned = both.withColumn("key__", F.to_json(F.struct(*map(signless, keys)))).drop(*keys)
    dealt = owned.withColumn("group__", F.pmod(F.xxhash64("key__"), F.lit(groups)).cast("int"))
    chunks = packed(dealt, ["group__", "part__"], ["at__", "side__", "id__"], delay)
    copies = F.when(F.col("part__") < 0, F.sequence(F.lit(0), F.lit(parts - 1))).otherwise(F.array("part__"))
    spread = chunks.withColumn("part__", F.explode(copies))
    schema = "key__ STRING, data__ STRING, version__ STRING"
    found = spread.groupBy("group__", "part__").transformWithStateInPandas(VersionsByTime(), schema, "append", "EventTime")
    # Types as they were: a number of 64 bits does not pass through a pandas column with nulls unharmed, but as text.
    return found.select(
        F.from_json("key__", both.select(*keys).schema).alias("key__"),
        F.from_json("data__", kept.schema).alias("row__"),
        F.from_json("version__", versions.select(*columns).schema).alias("version__"),
    ).select("key__.*", "row__.*", "version__.*")
