"""Kafka topics as streams. The connector jar must be on the cluster's class path."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


Start = str | dict[str, dict[int, int]]

# Names and types of the columns a Kafka row carries.
KAFKA_COLUMNS = "key BINARY, value BINARY, topic STRING, partition INT, offset BIGINT, timestamp TIMESTAMP"


def kafka_options(
    servers: str, topics: list[str], start: Start = "latest", group: str | None = None, per_batch: int | None = None
) -> dict[str, str]:
    """Reader options.

    ``start`` is ``earliest``, ``latest``, or offsets per topic and partition. It applies to
    the first run only: later runs go on from the offsets committed in the checkpoint.
    ``per_batch`` bounds the rows of a micro-batch.
    """
    if isinstance(start, dict):
        offsets = {t: {str(p): o for p, o in parts.items()} for t, parts in start.items()}
        start = json.dumps(offsets)
    elif start not in ("earliest", "latest"):
        raise ValueError(f"start must be earliest, latest or offsets, not {start}")
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": ",".join(topics),
        "startingOffsets": start,
    }
    if group:
        options["kafka.group.id"] = group
    if per_batch:
        options["maxOffsetsPerTrigger"] = str(per_batch)
    return options


def read_topics(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    return spark.readStream.format("kafka").options(**options).load()


def decode(rows: DataFrame, schema: T.StructType, encoding: str = "json") -> DataFrame:
    """Typed columns from message values, with topic, partition, offset and message time.

    A CSV value that does not fit the schema is skipped.
    """
    value = F.col("value").cast("string")
    if encoding == "json":
        record = F.from_json(value, schema)
    elif encoding == "csv":
        fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema)
        record = F.from_csv(value, fields)
    else:
        raise ValueError(f"unknown encoding {encoding}")
    parsed = rows.select(
        record.alias("record"), "topic", "partition", "offset",
        F.col("timestamp").cast("timestamp_ntz").alias("message_time"),
    )
    usable = F.col("record").isNotNull()
    for name in schema.fieldNames():
        if encoding == "csv":
            usable = usable & F.col(f"record.{name}").isNotNull()
    return parsed.where(usable).select("record.*", "topic", "partition", "offset", "message_time")

