"""Running a stream over what is there now, with results in the shared folder."""

from __future__ import annotations

import threading
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from tideline.session import ROCKS_DB, STATE_STORE, scratch_folder
from tideline.sinks.tables import read_keyed, upsert_batch

_starting = threading.Lock()


def with_event_time(frame: DataFrame, column: str, delay: str, name: str = "rt") -> DataFrame:
    """A zoned copy of the event time as ``name``, with rows up to ``delay`` late accepted."""
    return frame.withColumn(name, F.col(column).cast("timestamp")).withWatermark(name, delay)


def start(spark: SparkSession, writer: DataStreamWriter, keyed: bool = False) -> StreamingQuery:
    """Start a stream; one with the state of ``streaming.keyed`` (``keyed``) gets RocksDB as its store.

    Spark's default store takes no state of several kinds in one operator. A stream runs in a copy of the session that
    is made when it starts, so the session has its own store again right after.
    """
    if not keyed:
        return writer.start()
    with _starting:
        before = spark.conf.get(STATE_STORE)
        spark.conf.set(STATE_STORE, ROCKS_DB)
        try:
            return writer.start()
        finally:
            spark.conf.set(STATE_STORE, before)


def append_to(frame: DataFrame, path: str, checkpoint: str, keyed: bool = False) -> None:
    """Process what is there and append final rows to a table; each row is written once."""
    writer = (
        frame.writeStream.outputMode("append")
        .format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
    )
    start(frame.sparkSession, writer, keyed).awaitTermination()


def each_batch(
    frame: DataFrame, work: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "update", keyed: bool = False
) -> None:
    """Process what is there, handing each micro-batch to ``work``."""
    writer = (
        frame.writeStream.outputMode(mode)
        .foreachBatch(work)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
    )
    start(frame.sparkSession, writer, keyed).awaitTermination()


def appended(spark: SparkSession, frame: DataFrame, purpose: str) -> DataFrame:
    """The final rows a stream gives for what is there now."""
    base = scratch_folder(spark, purpose)
    schema = frame.schema
    append_to(frame, f"{base}/rows", f"{base}/checkpoint")
    return spark.read.schema(schema).parquet(f"{base}/rows")


def kept_current(spark: SparkSession, frame: DataFrame, keys: list[str], purpose: str) -> DataFrame:
    """The newest state of each key of a stream's updated results."""
    base = scratch_folder(spark, purpose)

    def store(batch: DataFrame, number: int) -> None:
        upsert_batch(batch, f"{base}/rows", keys, keys, number)

    each_batch(frame, store, f"{base}/checkpoint")
    return read_keyed(spark, f"{base}/rows", keys, keys)
