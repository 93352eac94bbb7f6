"""Streaming forms that Spark's own operators and state express directly."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from operator import and_

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tideline.functions.timing import bucket, epoch_millis
from tideline.operators.changes import snapshot_changes
from tideline.operators.windows import grow
from tideline.sinks.tables import append_batch
from tideline.streaming.run import kept_current


def windowed(frame: DataFrame, time: str, size: str, keys: list[str], *aggregates: Column, slide: str | None = None) -> DataFrame:
    """Time windows with zone-less bounds; a window is final once the watermark passes its end."""
    grouped = frame.groupBy(F.window(time, size, slide), *keys).agg(*aggregates)
    return grouped.select(
        F.col("window.start").cast("timestamp_ntz").alias("window_start"),
        F.col("window.end").cast("timestamp_ntz").alias("window_end"),
        *[c for c in grouped.columns if c != "window"],
    )


def sessions(frame: DataFrame, time: str, gap: str, keys: list[str], *aggregates: Column) -> DataFrame:
    grouped = frame.groupBy(F.session_window(time, gap), *keys).agg(*aggregates)
    return grouped.select(
        F.col("session_window.start").cast("timestamp_ntz").alias("window_start"),
        F.col("session_window.end").cast("timestamp_ntz").alias("window_end"),
        *[c for c in grouped.columns if c != "session_window"],
    )


def silence(frame: DataFrame, time: str, keys: list[str], order: list[str], delay_ms: int, kind: str) -> DataFrame:
    """Last row of each activity stretch that ended in more than ``delay_ms`` of silence.

    A row at most ``delay_ms`` later prolongs the stretch, which withdraws the alert.
    """
    gap = f"{delay_ms + 1} milliseconds"
    last = F.max_by(F.struct(*order, kind), F.struct(*order)).alias("__last")
    return sessions(frame, time, gap, keys, last).select(*keys, "__last.*")


def interval_join(
    left: DataFrame, right: DataFrame, keys: list[str], left_time: str, right_time: str, span: int
) -> DataFrame:
    """Stream-stream join: left time at most ``span`` ms after the right time.

    Both sides need watermarks; the range lets Spark drop rows that can match no more. The
    time bucket is a second equal key, so the state of a large key is spread over its
    buckets; a right row is kept in the two buckets its range can touch.
    """
    low, high = bucket(F.unix_millis(right_time), span), bucket(F.unix_millis(right_time) + span, span)
    a = left.withColumn("__bucket", bucket(F.unix_millis(left_time), span))
    b = right.withColumn("__near", F.explode(F.sequence(low, high))).withColumnsRenamed(
        {k: f"__r_{k}" for k in keys}
    )
    condition = (
        (F.col("__bucket") == F.col("__near"))
        & (F.col(left_time) >= F.col(right_time))
        & (F.col(left_time) <= F.col(right_time) + F.expr(f"INTERVAL {span} MILLISECONDS"))
    )
    for k in keys:
        condition = condition & (F.col(k) == F.col(f"__r_{k}"))
    return a.join(b, condition).drop("__bucket", "__near", *[f"__r_{k}" for k in keys])


def growing(
    spark: SparkSession,
    frame: DataFrame,
    time: str,
    size: int,
    step: int,
    keys: list[str],
    distinct: tuple[str, str],
    sums: dict[str, Column],
) -> DataFrame:
    """Windows that grow by ``step`` up to ``size``, with exact distinct counts.

    The stream keeps one row per step, key and item current. Its state leaves with the
    watermark, and the growing totals are formed when the result is read.
    """
    keyed = [*keys, distinct[1]]
    totals = [F.sum(value).alias(name) for name, value in sums.items()]
    parts = windowed(frame, time, f"{step} milliseconds", keyed, F.count(F.lit(1)).alias("__n"), *totals)
    current = kept_current(spark, parts, ["window_start", *keyed], "growing")
    number = bucket(epoch_millis(F.col("window_start")), step)
    return grow(current.withColumn("__step", number), size, step, keys, distinct, list(sums))


def window_join(
    left: DataFrame, right: DataFrame, keys: list[str], left_time: str, right_time: str, size: str
) -> DataFrame:
    """Stream-stream join of rows in the same fixed window; both sides need watermarks."""
    a = left.withColumn("window", F.window(left_time, size)).drop(left_time)
    b = right.withColumn("window", F.window(right_time, size)).drop(right_time)
    joined = a.join(b, [*keys, "window"])
    return joined.select(
        F.col("window.start").cast("timestamp_ntz").alias("window_start"),
        F.col("window.end").cast("timestamp_ntz").alias("window_end"),
        *[c for c in joined.columns if c != "window"],
    )


def counts_in_state(
    frame: DataFrame, keys: list[str], schema: str, name: str, spread_by: str, parts: int = 8
) -> DataFrame:
    """Rows per key and ``part`` kept in user-defined state; ``schema`` is the DDL of the keys.

    A key is spread over ``parts`` states by the hash of ``spread_by``, whose counts the
    reader adds up. Rows come in Arrow batches and only their number is kept.
    """

    def count(
        key: tuple, batches: Iterator[pd.DataFrame], state: GroupState
    ) -> Iterator[pd.DataFrame]:
        total = (state.get[0] if state.exists else 0) + sum(len(batch) for batch in batches)
        state.update((total,))
        yield pd.DataFrame({**{k: [v] for k, v in zip([*keys, "part"], key)}, name: [total]})

    part = F.pmod(F.xxhash64(spread_by), F.lit(parts)).cast("int").alias("part")
    return frame.select(*keys, part).groupBy(*keys, "part").applyInPandasWithState(
        count, f"{schema}, part INT, {name} BIGINT", f"{name} BIGINT", "update", GroupStateTimeout.NoTimeout
    )


def new_keys(frame: DataFrame, keys: list[str]) -> DataFrame:
    """Each key once, when it is first seen."""
    return frame.select(*keys).dropDuplicates(keys)


def change_feed(keys: list[str], values: list[str], state: str, results: str):
    """``foreachBatch`` work that turns updated results into ``+I``, ``-U`` and ``+U`` rows.

    ``state`` holds the result table after each batch, from which the next one starts.
    """

    def work(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        batch.persist()
        new = batch.select(*keys, *values)
        old = spark.read.parquet(f"{state}/batch={number - 1}") if number else new.where(F.lit(False))
        named = new.select(*[F.col(k).alias(f"__n_{k}") for k in keys])
        same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"__n_{k}")) for k in keys])
        touched = old.join(named, same, "left_semi")
        append_batch(snapshot_changes(touched, new, keys, values), results, number)
        append_batch(old.join(named, same, "left_anti").unionByName(new), state, number)
        batch.unpersist()

    return work
