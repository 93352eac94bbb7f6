"""Compressed bitmaps of 64-bit ids, as a table of containers.

An id's upper 48 bits name its container, the lower 16 its place there. A container is stored in the smallest of three
forms: a sorted array of places, a bitmap of 8 KB, or runs of neighbouring places. So one sparse id costs two bytes
and a long range of ids four, and a set can have any number of containers in any number of tasks. Uniting, intersecting
and looking up work container by container; counting reads stored numbers only.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ARRAY, BITMAP, RUNS = 0, 1, 2
PLACES = 1 << 16


def encoded(places: np.ndarray) -> tuple[int, bytes]:
    """The smallest form of some different places in ascending order."""
    if not len(places):
        return ARRAY, b""
    breaks = np.flatnonzero(np.diff(places.astype(np.int64)) != 1)
    n_runs = len(breaks) + 1
    sizes = (2 * len(places), PLACES // 8, 4 * n_runs)
    form = sizes.index(min(sizes))
    if form == ARRAY:
        return form, places.astype("<u2").tobytes()
    if form == BITMAP:
        bits = np.zeros(PLACES, np.uint8)
        bits[places] = 1
        return form, np.packbits(bits, bitorder="little").tobytes()
    first = places[np.append(0, breaks + 1)]
    last = places[np.append(breaks, len(places) - 1)]
    return form, np.column_stack([first, last]).astype("<u2").tobytes()


def decoded(form: int, data: bytes) -> np.ndarray:
    """The places of a container in ascending order."""
    if form == ARRAY:
        return np.frombuffer(data, "<u2").astype(np.int64)
    if form == BITMAP:
        return np.flatnonzero(np.unpackbits(np.frombuffer(data, np.uint8), bitorder="little"))
    runs = np.frombuffer(data, "<u2").astype(np.int64).reshape(-1, 2)
    sizes = runs[:, 1] - runs[:, 0] + 1
    starts = np.cumsum(sizes) - sizes
    return np.repeat(runs[:, 0] - starts, sizes) + np.arange(sizes.sum())


def contains(form: int, data: bytes, places: np.ndarray) -> np.ndarray:
    """Which places a container has, without spreading it out."""
    if form == BITMAP:
        bits = np.frombuffer(data, np.uint8)
        return (bits[places >> 3] >> (places & 7).astype(np.uint8)) & 1 == 1
    values = np.frombuffer(data, "<u2").astype(np.int64)
    if form == ARRAY:
        at = np.searchsorted(values, places)
        return (at < len(values)) & (values[np.minimum(at, len(values) - 1)] == places)
    at = np.searchsorted(values[::2], places, "right") - 1
    return (at >= 0) & (places <= values[1::2][np.maximum(at, 0)])


def container_of(number: str) -> Column:
    return F.shiftright(F.col(number).cast("long"), 16).alias("container")


def place_of(number: str) -> Column:
    return F.col(number).cast("long").bitwiseAND(F.lit(PLACES - 1)).cast("int").alias("place")


FORM = [T.StructField("form", T.ByteType()), T.StructField("n", T.LongType()), T.StructField("data", T.BinaryType())]


def build(frame: DataFrame, keys: list[str], number: str) -> DataFrame:
    """keys, container, form, n and data of the set of ``number`` per key; null numbers are left out.

    A group is one container: at most 65,536 places, gathered in the tasks that read the rows first. Numbers that
    occur often are thus sent once per task.
    """
    places = (
        frame.where(F.col(number).isNotNull())
        .groupBy(*keys, container_of(number))
        .agg(F.collect_set(place_of(number)).alias("places"))
    )
    return _packed(places, keys)


def _packed(places: DataFrame, keys: list[str]) -> DataFrame:
    kept = [*keys, "container"]
    schema = T.StructType([*[places.schema[c] for c in kept], *FORM])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(batch.schema.get_field_index("places"))
            flat, bounds = np.asarray(lists.flatten()), np.concatenate(([0], np.cumsum(np.asarray(lists.value_lengths()))))
            made = [encoded(np.unique(flat[a:b])) for a, b in zip(bounds, bounds[1:])]
            n = [len(np.unique(flat[a:b])) for a, b in zip(bounds, bounds[1:])]
            columns = [batch.column(batch.schema.get_field_index(c)) for c in kept]
            columns += [pa.array([m[0] for m in made], pa.int8()), pa.array(n, pa.int64()), pa.array([m[1] for m in made], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return places.select(*kept, "places").mapInArrow(run, schema)


def count(bitmaps: DataFrame, keys: list[str], name: str = "n") -> DataFrame:
    """How many ids each key has; the data is not read."""
    return bitmaps.groupBy(*keys).agg(F.sum("n").alias(name))


def _spread(bitmaps: DataFrame, keys: list[str]) -> DataFrame:
    """The places of each container as a list; a list has at most 65,536."""
    kept = [*keys, "container"]
    schema = T.StructType([*[bitmaps.schema[c] for c in kept], T.StructField("places", T.ArrayType(T.IntegerType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                forms, data = (part.column(part.schema.get_field_index(c)).to_pylist() for c in ("form", "data"))
                lists = [decoded(f, d).astype(np.int32) for f, d in zip(forms, data)]
                columns = [part.column(part.schema.get_field_index(c)) for c in kept]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(lists, pa.list_(pa.int32()))], names=schema.names)

    return bitmaps.select(*kept, "form", "data").mapInArrow(run, schema)


def united(bitmaps: DataFrame, keys: list[str]) -> DataFrame:
    """The union per key over all the sets that ``bitmaps`` has, days or finer keys.

    Containers that one set alone has are taken over as they are.
    """
    shared = bitmaps.groupBy(*keys, "container").agg(
        F.count("*").alias("sets"), F.first("form").alias("form"), F.first("n").alias("n"), F.first("data").alias("data")
    )
    alone = shared.where("sets = 1").drop("sets")
    several = shared.where("sets > 1").select(*[F.col(k).alias(f"__{k}") for k in [*keys, "container"]])
    same = [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in [*keys, "container"]]
    met = _spread(bitmaps.join(several, _all(same), "left_semi"), keys)
    # An array of sets is never made: places of all sets are put together one by one.
    together = met.select(*keys, "container", F.explode("places").alias("place")).groupBy(*keys, "container").agg(
        F.collect_set("place").alias("places")
    )
    return alone.unionByName(_packed(together, keys))


def _all(conditions: list[Column]) -> Column:
    out = conditions[0]
    for condition in conditions[1:]:
        out = out & condition
    return out


def common(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    """The intersection per key: containers that both have, the smaller one looked up in the larger."""
    kept = [*keys, "container"]
    renamed = b.select(*[F.col(k).alias(f"__{k}") for k in kept], *[F.col(c).alias(f"__{c}") for c in ("form", "n", "data")])
    same = [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in kept]
    both = a.join(renamed, _all(same)).select(*kept, "form", "n", "data", "__form", "__n", "__data")
    schema = T.StructType([*[a.schema[c] for c in kept], *FORM])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            value = lambda name, batch=batch: batch.column(batch.schema.get_field_index(name)).to_pylist()
            out = []
            for f, n, d, g, m, e in zip(*map(value, ("form", "n", "data", "__form", "__n", "__data"))):
                small, large = ((f, d), (g, e)) if n <= m else ((g, e), (f, d))
                places = decoded(*small)
                out.append(places[contains(*large, places)])
            made = [encoded(places) for places in out]
            columns = [batch.column(batch.schema.get_field_index(c)) for c in kept]
            columns += [pa.array([m[0] for m in made], pa.int8()), pa.array([len(p) for p in out], pa.int64()),
                        pa.array([m[1] for m in made], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return both.mapInArrow(run, schema).where("n > 0")


def with_membership(
    rows: DataFrame, bitmaps: DataFrame, keys: list[str], number: str, name: str, parts: int = 8
) -> DataFrame:
    """Adds whether ``number`` is in the set of the row's key; null numbers are in none.

    A container and the rows that ask it meet in one task, the container first, so a row never carries one. The rows
    of a container are spread over ``parts`` tasks, each of which gets a copy of it.
    """
    kept = [*keys, "__container", "__part"]
    asked = rows.withColumns(
        {"__container": container_of(number), "__place": place_of(number),
         "__part": F.pmod(F.xxhash64(number, F.monotonically_increasing_id()), F.lit(parts)).cast("int"), "__kind": F.lit(1)}
    )
    sets = bitmaps.select(
        *keys, F.col("container").alias("__container"), F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("__part"),
        F.lit(0).alias("__kind"), F.col("form").alias("__form"), F.col("data").alias("__data"),
    )
    both = asked.unionByName(sets, allowMissingColumns=True).repartition(*kept).sortWithinPartitions(*kept, "__kind")
    schema = T.StructType([*rows.schema.fields, T.StructField(name, T.BooleanType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, form, data = None, None, None
        for batch in batches:
            value = lambda c, batch=batch: batch.column(batch.schema.get_field_index(c))
            places = list(zip(*[value(c).to_pylist() for c in kept[:-1]]))
            kinds, found = np.asarray(value("__kind")), np.zeros(batch.num_rows, bool)
            asked_places = np.asarray(value("__place").fill_null(0), np.int64)
            marks = [0, *[i for i in range(1, len(places)) if places[i] != places[i - 1] or kinds[i] != kinds[i - 1]], len(places)]
            for a, b in zip(marks, marks[1:]):
                if kinds[a] == 0:
                    held, form, data = places[a], value("__form")[a].as_py(), value("__data")[a].as_py()
                elif places[a] == held and held[-1] is not None:
                    found[a:b] = contains(form, data, asked_places[a:b])
            yield pa.RecordBatch.from_arrays([*[value(c) for c in schema.names[:-1]], pa.array(found)], names=schema.names).filter(
                pa.array(kinds == 1)
            )

    return both.mapInArrow(run, schema)
