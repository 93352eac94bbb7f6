"""Row helpers shared by the operators: routing rows to shards and walking through sorted rows group by group."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.session import stored

#: Removes the shuffle files of a query when it is done, not when the driver happens to collect its garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Rows that go to a Python worker at once. Texts and sets are long, and a worker holds a batch several times over.
BATCH, BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch", "1000"
#: A null id counts as one document that comes after all others.
LAST_ID = (1 << 63) - 1


def written(frame: DataFrame) -> DataFrame:
    """``stored``, with what the write has shuffled removed right after it: later steps read the table alone.

    The write goes through Python workers in small batches, so that their memory does not follow the texts' length.
    """
    conf = frame.sparkSession.conf
    before = {CLEANUP: conf.get(CLEANUP, "false"), BATCH: conf.get(BATCH)}
    conf.set(CLEANUP, "true")
    conf.set(BATCH, BATCH_ROWS)
    try:
        return stored(frame)
    finally:
        for name, value in before.items():
            conf.set(name, value)


def id_or_last(name: str = "doc_id") -> Column:
    return F.coalesce(F.col(name).cast("long"), F.lit(LAST_ID))


def shuffle_partitions(frame: DataFrame) -> int:
    return int(frame.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def beside(reference: DataFrame, stream: DataFrame, keys: list[str], order: list[str] = ()) -> DataFrame:
    """Both frames in one, dealt by ``keys``; in each task a key's ``reference`` rows (kind 0) come first.

    A task reads the rows one by one, so only the reference of one key has to fit into memory.
    """
    rows = reference.withColumn("kind", F.lit(0)).unionByName(
        stream.withColumn("kind", F.lit(1)), allowMissingColumns=True
    )
    return rows.repartition(shuffle_partitions(rows), *keys).sortWithinPartitions(*keys, "kind", *order)


def salted(reference: DataFrame, stream: DataFrame, loads: DataFrame, per_task: int) -> tuple[DataFrame, DataFrame]:
    """Add a ``salt`` so that no (shard, salt) gets many more than ``per_task`` rows of the stream.

    ``loads`` has the rows each shard is to expect. Shards under the limit have salt 0. The reference of a
    larger shard is repeated for each of its salts. The limit grows with all rows, so that at most about a
    thousand large shards are named to the driver.
    """
    total = loads.agg(F.sum("load")).first()[0] or 0
    limit = max(per_task, total // 1024)
    large = loads.where(F.col("load") > limit).select("shard", F.ceil(F.col("load") / limit).cast("int").alias("n"))
    pieces = [F.lit(x) for row in large.collect() for x in (row["shard"], row["n"])]
    n = F.coalesce(F.create_map(*pieces)[F.col("shard")], F.lit(1)) if pieces else F.lit(1)
    return (
        reference.withColumn("salt", F.explode(F.sequence(F.lit(0), n - 1))),
        stream.withColumn("salt", F.pmod(F.xxhash64("id"), n).cast("int")),
    )


def grouped(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[tuple, Iterator[dict]]]:
    """Sorted rows as (key, rows of that key); the rows of a key must be read before the next key."""
    rows = (row for batch in batches for row in batch.to_pylist())
    row = next(rows, None)
    while row is not None:
        key = tuple(row[k] for k in keys)

        def own(key=key):
            nonlocal row
            while row is not None and tuple(row[k] for k in keys) == key:
                yield row
                row = next(rows, None)

        piece = own()
        yield key, piece
        for _ in piece:
            pass


#: Bits of a membership filter: 2 MB, whatever the data.
FILTER_BITS = 1 << 24


def membership(frame: DataFrame, column: str) -> np.ndarray:
    """A filter of fixed size for the hashes in ``column``: false where a hash is certainly not among them."""
    place = F.pmod(F.col(column), F.lit(FILTER_BITS)) + 1
    parts = (
        frame.select(place.alias("place"))
        .groupBy(F.bitmap_bucket_number("place").alias("part"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("place")).alias("bits"))
    )
    out = np.zeros(FILTER_BITS // 8, np.uint8)
    for row in parts.collect():
        bits = np.frombuffer(row["bits"], np.uint8)
        begin = (row["part"] - 1) * len(bits)
        out[begin : begin + len(bits)] = bits
    return out


def likely_members(frame: DataFrame, column: str, bits: np.ndarray) -> DataFrame:
    """The rows the filter lets pass, so that fewer are shuffled; a join must follow that decides."""
    filter_bits = bits.tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = np.frombuffer(filter_bits, np.uint8)
        for batch in batches:
            place = np.asarray(batch.column(column)) % FILTER_BITS
            yield batch.filter(pa.array((known[place >> 3] >> (place & 7).astype(np.uint8) & 1).astype(bool)))

    return frame.mapInArrow(run, frame.schema)
