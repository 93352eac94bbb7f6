"""Which keys may have been seen before: Bloom filters kept per day, in shards, with a join only for what they let pass.

A key belongs to one shard and sets some bits of it. The number of shards follows the expected keys and the accepted
share of false positives; a shard has 32,768 bits, so filters of any size are tables of 4 KB rows that are built,
united over days and probed in parallel. A filter has no false negatives: what it rejects is new. What it accepts is
looked up exactly, so results are exact and the filter only saves the join.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SHARD_BITS = 32_768


@dataclass(frozen=True)
class Sizing:
    """``shards`` of ``SHARD_BITS`` bits each, of which a key sets ``probes`` in one."""

    shards: int
    probes: int

    @staticmethod
    def of(keys: int, error: float) -> "Sizing":
        """For so many different keys and so large a share of false positives.

        Keys spread unevenly over shards; a tenth more bits makes up for that.
        """
        bits = 1.1 * max(keys, 1) * -math.log(error) / math.log(2) ** 2
        return Sizing(max(1, math.ceil(bits / SHARD_BITS)), max(1, round(-math.log2(error))))

    def bytes(self) -> int:
        return self.shards * SHARD_BITS // 8


def _shard(key: list[str], sizing: Sizing) -> Column:
    return F.pmod(F.xxhash64(*key), F.lit(sizing.shards)).cast("int")


def _bits(key: list[str], sizing: Sizing) -> list[Column]:
    """Places in the shard from two more hashes of the key; the second one is odd, so the probes differ."""
    first, step = F.xxhash64(F.lit(1), *key), F.xxhash64(F.lit(2), *key).bitwiseOR(F.lit(1))
    at = lambda i: F.pmod(F.shiftright(first, 17) + F.lit(i) * F.shiftright(step, 20), F.lit(SHARD_BITS))
    return [at(i).cast("int") for i in range(sizing.probes)]


def build(frame: DataFrame, day: list[str], key: list[str], sizing: Sizing) -> DataFrame:
    """day, shard and bits; filters of different days unite. Bits are set in the tasks that read the rows."""
    placed = frame.select(*day, _shard(key, sizing).alias("shard"), F.explode(F.array(*_bits(key, sizing))).alias("bit"))
    return placed.groupBy(*day, "shard").agg(F.bitmap_construct_agg("bit").alias("bits"))


def united(filters: DataFrame) -> DataFrame:
    """One filter over all days that ``filters`` has."""
    return filters.groupBy("shard").agg(F.bitmap_or_agg("bits").alias("bits"))


def with_maybe_seen(rows: DataFrame, filters: DataFrame, key: list[str], sizing: Sizing, name: str, parts: int = 8) -> DataFrame:
    """Adds whether the united filter may have the row's key; false is certain.

    Rows meet their shard in one task, the shard first; the rows of a shard are spread over ``parts`` tasks.
    """
    hashes = F.struct(*[bit.alias(f"b{i}") for i, bit in enumerate(_bits(key, sizing))])
    asked = rows.withColumns(
        {"__shard": _shard(key, sizing), "__bits": hashes, "__kind": F.lit(1),
         "__part": F.pmod(F.monotonically_increasing_id(), F.lit(parts)).cast("int")}
    )
    shards = filters.select(
        F.col("shard").alias("__shard"), F.col("bits").alias("__filter"), F.lit(0).alias("__kind"),
        F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("__part"),
    )
    kept = ["__shard", "__part"]
    both = asked.unionByName(shards, allowMissingColumns=True).repartition(*kept).sortWithinPartitions(*kept, "__kind")
    schema = T.StructType([*rows.schema.fields, T.StructField(name, T.BooleanType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, bits = None, np.zeros(0, np.uint8)
        for batch in batches:
            value = lambda c, batch=batch: batch.column(batch.schema.get_field_index(c))
            shard, part, kind = (np.asarray(value(c)) for c in ("__shard", "__part", "__kind"))
            probes = [np.asarray(b.fill_null(0)) for b in value("__bits").flatten()]
            breaks = np.flatnonzero((np.diff(shard) != 0) | (np.diff(part) != 0) | (np.diff(kind) != 0)) + 1
            found = np.zeros(batch.num_rows, bool)
            for a, b in zip([0, *breaks], [*breaks, batch.num_rows]):
                if a == b:
                    continue
                if kind[a] == 0:
                    held, bits = (shard[a], part[a]), np.frombuffer(value("__filter")[int(a)].as_py(), np.uint8)
                elif held == (shard[a], part[a]):
                    hit = np.ones(b - a, bool)
                    for probe in probes:
                        at = probe[a:b]
                        hit &= (bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1
                    found[a:b] = hit
            out = pa.RecordBatch.from_arrays([*[value(c) for c in schema.names[:-1]], pa.array(found)], names=schema.names)
            yield out.filter(pa.array(kind == 1))

    return both.mapInArrow(run, schema)


def unseen(rows: DataFrame, filters: DataFrame, known: DataFrame, key: list[str], sizing: Sizing) -> DataFrame:
    """The rows whose key is not in ``known``, exactly: only what the filter lets pass is joined. Null keys are new."""
    asked = with_maybe_seen(rows, filters, key, sizing, "__maybe")
    checked = asked.where("__maybe").join(known.select(*key).distinct(), key, "left_anti")
    return asked.where("NOT __maybe").drop("__maybe").unionByName(checked.drop("__maybe"))
