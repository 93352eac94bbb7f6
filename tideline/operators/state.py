"""Per-key state expressed as ordered jobs: counters with expiry, patterns, timers.

Each job runs over a whole table (``job.over(frame)``) and, but for the one that looks
ahead, over a stream (``tideline.streaming.carry``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.functions.timing import bucket
from tideline.operators.ordered import (
    MAX_ROWS,
    OrderedJob,
    Stage,
    next_value,
    ordered,
    previous_value,
    running_count,
    running_last,
    running_max,
)


def counter_with_expiry(keys: list[str], order: list[str], ttl: int, name: str) -> OrderedJob:
    """Running count that starts again when ``ttl`` passed since the key's last row."""

    def starts(frame: DataFrame) -> DataFrame:
        time, previous = F.col(order[0]), F.col("__prev")
        fresh = previous.isNull() | (time - previous >= ttl)
        return frame.withColumn("__start", F.when(fresh, F.col("__at")))

    return OrderedJob(
        keys,
        order,
        [
            Stage(lambda: [previous_value("__prev", F.col(order[0])), running_count("__at")]),
            Stage(lambda: [running_last("__from", F.col("__start"))], starts),
        ],
        lambda frame: frame.withColumn(name, F.col("__at") - F.col("__from") + 1).drop(
            "__prev", "__at", "__start", "__from"
        ),
    )


def sequence_within(
    keys: list[str], order: list[str], kind: str, first: str, then: str, trigger: str, ttl: int
) -> OrderedJob:
    """``trigger`` rows before which ``first`` and, after it, ``then`` occurred, all within ``ttl``.

    The newest ``then`` row has the newest possible ``first`` before it, so it decides alone;
    no pairs are formed.
    """

    def opened() -> list:
        time = F.when(F.col(kind) == first, F.col(order[0]))
        return [running_last("__open", time, inclusive=False)]

    def matched() -> list:
        done = F.when(F.col(kind) == then, F.col("__open"))
        return [running_last("__matched", done, inclusive=False)]

    def hits(frame: DataFrame) -> DataFrame:
        alive = F.col("__matched") > F.col(order[0]) - ttl
        return frame.where((F.col(kind) == trigger) & alive).drop("__open", "__matched")

    return OrderedJob(keys, order, [Stage(opened), Stage(matched)], hits)


def delayed_alerts(frame: DataFrame, keys: list[str], time: str, condition: Column, delay: int) -> DataFrame:
    """One alert per key and due time, ``delay`` after each row that meets the condition."""
    due = (F.col(time) + F.lit(delay)).alias("alert_time")
    return frame.where(condition).select(*keys, due).distinct()


def silence_alerts(
    frame: DataFrame, keys: list[str], order: list[str], condition: Column, delay: int, max_rows: int = MAX_ROWS
) -> DataFrame:
    """An alert for each row that meets the condition and is followed by ``delay`` of silence.

    Any later row of the key withdraws the pending alert.
    """
    time = F.col(order[0])
    watched = ordered(frame.withColumn("__watch", condition), keys, order, max_rows, counted=True).scan(
        next_value("__next", time)
    )
    due = time + F.lit(delay)
    silent = F.col("__watch") & (F.col("__next").isNull() | (F.col("__next") > due))
    return watched.rows().where(silent).select(*keys, *order, due.alias("alert_time"))


def mark_first_seen(keys: list[str], order: list[str], name: str) -> OrderedJob:
    """1 on the first row of each key, 0 on the others; exact, unlike a Bloom filter."""
    return OrderedJob(
        keys,
        order,
        [Stage(lambda: [running_count("__at")])],
        lambda frame: frame.withColumn(name, (F.col("__at") == 1).cast("int")).drop("__at"),
    )


def lateness(
    arrival: list[str], time: str, window: int, disorder: int, allowed: int, name: str = "lateness"
) -> OrderedJob:
    """How each row meets its window, replayed in arrival order.

    The watermark at a row is the largest event time so far less ``disorder``. A row is
    ``on_time`` while its window is open, ``refire`` within ``allowed`` after that and
    ``late`` afterwards. The row's own time cannot close its own window.
    """

    def judge(frame: DataFrame) -> DataFrame:
        end = (bucket(F.col(time), window) + 1) * F.lit(window)
        mark = F.col("__max") - F.lit(disorder)
        judged = (
            F.when(end > mark, "on_time").when(end + F.lit(allowed) > mark, "refire").otherwise("late")
        )
        return frame.withColumn(name, judged).drop("__max")

    return OrderedJob([], arrival, [Stage(lambda: [running_max("__max", F.col(time))])], judge)
