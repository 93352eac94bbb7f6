"""User code over groups: accumulators that are partial before the shuffle, and functions that see rows in order.

Spark's own aggregates come first (``groupBy().agg``); these are for what they cannot say. An accumulator never sees a
whole group: each task adds the rows it has read to states of its own, and states are merged, spread over parts first,
so a key with a third of all rows is a few small states per task. A group function must see its group in one task;
it gets an iterator and holds what it keeps itself.
"""

from __future__ import annotations

from abc import ABC, abstractmethod
from collections.abc import Callable, Iterator
from itertools import groupby

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

PARTS = 16


class Accumulator(ABC):
    """``state`` and ``output`` are the DDL of what is handed between tasks and of the result's columns.

    States and results are tuples of plain values. ``merge`` must not depend on order or grouping.
    """

    state: str
    output: str

    @abstractmethod
    def create(self) -> tuple: ...

    @abstractmethod
    def add(self, state: tuple, rows: pd.DataFrame) -> tuple:
        """``rows`` are some rows of one group, without the keys."""

    @abstractmethod
    def merge(self, a: tuple, b: tuple) -> tuple: ...

    @abstractmethod
    def result(self, state: tuple) -> tuple: ...


def accumulate(
    frame: DataFrame, keys: list[str], accumulator: Accumulator, columns: list[str], held: int = 20_000, parts: int = PARTS
) -> DataFrame:
    """The accumulator's result per key over ``columns``; a null key is a key.

    A task holds at most ``held`` states and hands them on when they become more.
    """
    key_fields = [frame.schema[k] for k in keys]
    state_fields = T.StructType.fromDDL(accumulator.state).fields
    partial = T.StructType([*key_fields, T.StructField("__part", T.IntegerType()), *state_fields])
    merged, final = T.StructType([*key_fields, *state_fields]), T.StructType(
        [*key_fields, *T.StructType.fromDDL(accumulator.output).fields]
    )

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        states: dict[tuple, tuple] = {}
        part = TaskContext.get().partitionId() % parts
        for batch in batches:
            places: dict[tuple, list[int]] = {}
            for i, key in enumerate(_keys_of(batch, keys)):
                places.setdefault(key, []).append(i)
            values = batch.select(columns).to_pandas()
            for key, own in places.items():
                rows = values if len(own) == len(values) else values.iloc[own].reset_index(drop=True)
                states[key] = accumulator.add(states.get(key) or accumulator.create(), rows)
            if len(states) > held:
                yield _batch([(*key, part, *state) for key, state in states.items()], partial)
                states = {}
        if states:
            yield _batch([(*key, part, *state) for key, state in states.items()], partial)

    def merge(fields: list[str], schema: T.StructType, finish: Callable[[tuple], tuple]):
        n = len(keys)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            rows = (row for batch in batches for row in zip(*[c.to_pylist() for c in batch.columns]))
            out = []
            for group, own in groupby(rows, key=lambda row: row[: len(fields)]):
                state = None
                for row in own:
                    mine = tuple(row[len(fields) :])
                    state = mine if state is None else accumulator.merge(state, mine)
                out.append((*group[:n], *finish(state)))
                if len(out) >= 4096:
                    yield _batch(out, schema)
                    out = []
            if out:
                yield _batch(out, schema)

        return run

    def gathered(states: DataFrame, by: list[str]) -> DataFrame:
        return states.repartition(*by).sortWithinPartitions(*by) if by else states.coalesce(1)

    by_part = [*keys, "__part"]
    states = frame.select(*keys, *columns).mapInArrow(add, partial)
    first = gathered(states, by_part).mapInArrow(merge(by_part, merged, lambda state: state), merged)
    return gathered(first, keys).mapInArrow(merge(keys, final, accumulator.result), final)


def _keys_of(batch: pa.RecordBatch, keys: list[str]) -> list[tuple]:
    if not keys:
        return [()] * batch.num_rows
    return list(zip(*[batch.column(batch.schema.get_field_index(k)).to_pylist() for k in keys]))


def _batch(rows: list[tuple], schema: T.StructType) -> pa.RecordBatch:
    arrow = to_arrow_schema(schema)
    return pa.RecordBatch.from_arrays(
        [pa.array([row[i] for row in rows], field.type) for i, field in enumerate(arrow)], schema=arrow
    )


#: Gets a key and the rows of its group in order, as dicts; gives the rows of the result without the key.
GroupFunction = Callable[[tuple, Iterator[dict]], Iterator[tuple]]


def process_groups(frame: DataFrame, keys: list[str], order: list[str], function: GroupFunction, output: str) -> DataFrame:
    """Run a function over each group's rows in ``order``; it may stop reading before the end.

    The group is a stream: one Arrow batch of it is in memory. All of it passes through one task, so what can be said
    by an ``Accumulator`` should be.
    """
    return _in_order(frame, keys, order, function, output)


def co_group(
    left: DataFrame, right: DataFrame, keys: list[str], order: list[str], function: GroupFunction, output: str
) -> DataFrame:
    """Run a function over the rows of both sides of a key, interleaved by ``order``; of equals, left comes first.

    ``order`` names columns that both sides have. A row's dict has ``side`` (``left`` or ``right``) and null for columns
    of the other side. Neither side is held. Groups that only one side has are there, too.
    """
    sides = [frame.withColumn("side", F.lit(name)) for frame, name in ((left, "left"), (right, "right"))]
    return _in_order(sides[0].unionByName(sides[1], allowMissingColumns=True), keys, [*order, "side"], function, output)


def _in_order(frame: DataFrame, keys: list[str], order: list[str], function: GroupFunction, output: str) -> DataFrame:
    schema = T.StructType([*[frame.schema[k] for k in keys], *T.StructType.fromDDL(output).fields])
    names, n = [*keys, *[c for c in frame.columns if c not in keys]], len(keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (row for batch in batches for row in zip(*[c.to_pylist() for c in batch.columns]))
        out = []
        for key, own in groupby(rows, key=lambda row: row[:n]):
            for made in function(key, (dict(zip(names[n:], row[n:])) for row in own)):
                out.append((*key, *made))
                if len(out) >= 4096:
                    yield _batch(out, schema)
                    out = []
        if out:
            yield _batch(out, schema)

    dealt = frame.select(*names).repartition(*keys) if keys else frame.select(*names).coalesce(1)
    return dealt.sortWithinPartitions(*keys, *order).mapInArrow(run, schema)


class Average(Accumulator):
    """Sum, count and average of a column; nulls are left out."""

    state = "total DOUBLE, n LONG"
    output = "total DOUBLE, n LONG, average DOUBLE"

    def __init__(self, column: str):
        self.column = column

    def create(self):
        return 0.0, 0

    def add(self, state, rows):
        values = rows[self.column].dropna()
        return state[0] + float(values.sum()), state[1] + len(values)

    def merge(self, a, b):
        return a[0] + b[0], a[1] + b[1]

    def result(self, state):
        return state[0], state[1], state[0] / state[1] if state[1] else None


class CountPerItem(Accumulator):
    """How often each value of a column occurs, as text ``a=1,b=2`` in order of the values; for columns with few."""

    state = "items ARRAY<STRING>, counts ARRAY<LONG>"
    output = "counts STRING"

    def __init__(self, column: str):
        self.column = column

    def create(self):
        return [], []

    def add(self, state, rows):
        found = rows[self.column].value_counts()
        return self.merge(state, (list(found.index), [int(n) for n in found]))

    def merge(self, a, b):
        both = dict(zip(*a))
        for item, n in zip(*b):
            both[item] = both.get(item, 0) + n
        items = sorted(both)
        return items, [both[i] for i in items]

    def result(self, state):
        return (",".join(f"{item}={n}" for item, n in zip(*state)),)
