"""Message topics: append-only and keyed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tideline.operators.joins import newest_per_key


def _encoded(columns: list[str], encoding: str) -> Column:
    record = F.struct(*columns)
    if encoding == "json":
        return F.to_json(record)
    if encoding == "csv":
        return F.to_csv(record)
    raise ValueError(f"unknown encoding {encoding}")


def append_messages(frame: DataFrame, columns: list[str], encoding: str = "json") -> DataFrame:
    """One message per row, without a key."""
    return frame.select(_encoded(columns, encoding).alias("value"))


def upsert_messages(
    changes: DataFrame, keys: list[str], columns: list[str], order: list[str], encoding: str = "csv"
) -> DataFrame:
    """One message per key with its newest row; the value is null where the key was deleted.

    ``changes`` has an ``op`` column of ``+I``, ``-U``, ``+U`` and ``-D``.
    """
    newest = newest_per_key(changes.where(F.col("op") != "-U"), keys, order)
    value = F.when(F.col("op") != "-D", _encoded(columns, encoding))
    return newest.select(_encoded(keys, encoding).alias("key"), value.alias("value"))


def write_topic(messages: DataFrame, servers: str, topic: str) -> None:
    """Send a batch; a task that is run again sends again, so delivery is at least once."""
    messages.write.format("kafka").option("kafka.bootstrap.servers", servers).option("topic", topic).save()


def stream_topic(messages: DataFrame, servers: str, topic: str, checkpoint: str) -> StreamingQuery:
    return (
        messages.writeStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .option("checkpointLocation", checkpoint)
        .start()
    )
