"""Time, count and marker windows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tideline.functions.timing import bucket, local_time
from tideline.operators.ordered import (
    MAX_ROWS,
    OrderedJob,
    Stage,
    ordered,
    previous_value,
    running_count,
)


def window_bounds(window: str = "window") -> list[Column]:
    """Start, end and last instant (end - 1 ms) of a time window."""
    end = F.col(f"{window}.end")
    return [
        F.col(f"{window}.start").alias("window_start"),
        end.alias("window_end"),
        (end - F.expr("INTERVAL '0.001' SECOND")).alias("window_time"),
    ]


def tumble(
    frame: DataFrame, time: str, size: str, keys: list[str], *aggregates: Column, offset: str | None = None
) -> DataFrame:
    """Fixed windows. ``offset`` shifts the grid, e.g. ``16 hours`` for days that start at UTC+8."""
    grouped = frame.groupBy(F.window(time, size, startTime=offset), *keys).agg(*aggregates)
    return grouped.select(*window_bounds(), *[c for c in grouped.columns if c != "window"])


def _windows_of(pane: Column, slide: int, size: int) -> Column:
    """First instants of the sliding windows that hold a pane."""
    start = pane * F.lit(slide)
    return F.sequence(start - F.lit(size - slide), start, F.lit(slide))


def hop_sums(
    frame: DataFrame, time: Column, size: int, slide: int, keys: list[str], sums: dict[str, Column], tasks: int | None = None
) -> DataFrame:
    """Sliding sums: one partial per pane of ``slide`` ms, then panes copied to their windows.

    Rows are aggregated before they are copied, so the copies number panes, not rows.
    ``size`` must be a multiple of ``slide``. Give ``tasks`` (``rows.tasks_for``) for keys that are almost as many as
    the rows: summing first would leave as many, so rows are dealt to that number of tasks, and a key's panes are
    copied where they are summed up.
    """
    rows = frame.select(bucket(time, slide).alias("__pane"), *keys, *[value.alias(name) for name, value in sums.items()])
    if tasks:
        rows = rows.repartition(tasks, "__pane", *keys)
    panes = rows.groupBy("__pane", *keys).agg(*[F.sum(name).alias(name) for name in sums])
    if tasks:
        panes = panes.repartition(tasks, *keys)
    copied = panes.withColumn("__start", F.explode(_windows_of(F.col("__pane"), slide, size)))
    grouped = copied.groupBy("__start", *keys).agg(*[F.sum(name).alias(name) for name in sums])
    return grouped.select(
        local_time(F.col("__start")).alias("window_start"),
        local_time(F.col("__start") + F.lit(size)).alias("window_end"),
        *keys,
        *sums,
    )


def hop_distinct(
    frame: DataFrame, time: Column, size: int, slide: int, keys: list[str], item: str, name: str
) -> DataFrame:
    """Sliding distinct count; an item is copied once per pane it occurs in, not once per row."""
    seen = frame.select(bucket(time, slide).alias("__pane"), *keys, item).distinct()
    copied = seen.withColumn("__start", F.explode(_windows_of(F.col("__pane"), slide, size)))
    grouped = copied.groupBy("__start", *keys).agg(F.count_distinct(item).alias(name))
    return grouped.select(
        local_time(F.col("__start")).alias("window_start"),
        local_time(F.col("__start") + F.lit(size)).alias("window_end"),
        *keys,
        name,
    )


def cumulate(
    frame: DataFrame,
    time: Column,
    size: int,
    step: int,
    keys: list[str],
    distinct: tuple[str, str] | None = None,
    sums: dict[str, Column] | None = None,
) -> DataFrame:
    """Windows that share a start and grow by ``step`` up to ``size``.

    Rows are not copied to every end. An item counts in the step where the window first
    sees it and a sum in its own step; running sums over the steps give every end. A key
    has a row for each end from its first data on. ``distinct`` is (result name, item).
    """
    number = bucket(time, step)
    names = list(sums or {})
    totals = [F.sum(value).alias(name) for name, value in (sums or {}).items()]
    items = [distinct[1]] if distinct else []
    # At most one row per step, key and item is left before the steps are added up.
    parts = frame.groupBy(number.alias("__step"), *keys, *items).agg(F.count(F.lit(1)).alias("__n"), *totals)
    return grow(parts, size, step, keys, distinct, names)


def grow(
    parts: DataFrame, size: int, step: int, keys: list[str], distinct: tuple[str, str] | None, sums: list[str]
) -> DataFrame:
    """Growing windows from one row per step (``__step``, counted from the epoch), key and item."""
    per_window = F.lit(size // step)
    parts = parts.withColumns(
        {
            "__win": F.floor(F.col("__step") / per_window).cast("long"),
            "__step": F.pmod(F.col("__step"), per_window).cast("int"),
        }
    )
    names = list(sums)
    if distinct:
        name, item = distinct
        steps_of_item = Window.partitionBy("__win", *keys, item).orderBy("__step")
        fresh = (F.row_number().over(steps_of_item) == 1) & F.col(item).isNotNull()
        parts = parts.withColumn(name, fresh.cast("long"))
        names.insert(0, name)
    per_step = parts.groupBy("__win", "__step", *keys).agg(*[F.sum(n).alias(n) for n in names])
    by_step = Window.partitionBy("__win", *keys).orderBy("__step")
    up_to_here = by_step.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    running = per_step.select(
        "__win",
        "__step",
        *keys,
        *[F.sum(n).over(up_to_here).alias(n) for n in names],
        F.coalesce(F.lead("__step").over(by_step), per_window).alias("__until"),
    )
    start = F.col("__win") * F.lit(size)
    # A step without data repeats the totals of the one before.
    filled = running.withColumn("__at", F.explode(F.sequence(F.col("__step"), F.col("__until") - 1)))
    return filled.select(
        local_time(start).alias("window_start"),
        local_time(start + (F.col("__at") + 1) * F.lit(step)).alias("window_end"),
        *keys,
        *names,
    )


def numbered(
    frame: DataFrame, keys: list[str], order: list[str], name: str, max_rows: int = MAX_ROWS
) -> DataFrame:
    """Position 1..n of each row in its key (or in the whole table, with no key)."""
    return ordered(frame, keys, order, max_rows, counted=True).scan(running_count(name)).rows()


def count_tumble(
    frame: DataFrame, keys: list[str], order: list[str], n: int, *aggregates: Column, max_rows: int = MAX_ROWS
) -> DataFrame:
    """Aggregate each run of ``n`` rows; a run that is not full does not fire."""
    placed = numbered(frame, keys, order, "__at", max_rows).withColumn(
        "window_no", F.floor((F.col("__at") - 1) / n).cast("long")
    )
    grouped = placed.groupBy(*keys, "window_no").agg(*aggregates, F.count(F.lit(1)).alias("__n"))
    return grouped.where(F.col("__n") == n).drop("__n")


def count_slide(
    frame: DataFrame,
    keys: list[str],
    order: list[str],
    fire_every: int,
    keep_last: int,
    *aggregates: Column,
    max_rows: int = MAX_ROWS,
) -> DataFrame:
    """Fire after every ``fire_every`` rows over the newest ``keep_last`` rows.

    Early firings hold fewer rows. A row is copied to the few firings that hold it.
    """
    at = F.col("__at")
    first = F.ceil(at / fire_every)
    last = F.floor((at + keep_last - 1) / fire_every)
    placed = numbered(frame, keys, order, "__at", max_rows).where(first <= last)
    copied = placed.withColumn("firing", F.explode(F.sequence(first, last)))
    grouped = copied.groupBy(*keys, "firing").agg(*aggregates, F.max("__at").alias("__newest"))
    # The last firing exists only if its closing row does.
    return grouped.where(F.col("__newest") == F.col("firing") * fire_every).drop("__newest")


def marker_windows(
    frame: DataFrame,
    keys: list[str],
    order: list[str],
    marker: Column,
    keep_last: int,
    max_rows: int = MAX_ROWS,
) -> DataFrame:
    """Rows of windows closed by a marker row, each window cut to its newest ``keep_last`` rows.

    Adds ``window_no`` and ``place`` (1 = newest). Rows after the last marker never fire.
    """
    closed = F.coalesce(marker, F.lit(False))
    placed = (
        ordered(frame, keys, order, max_rows, counted=True)
        .scan(running_count("window_no", closed, inclusive=False))
        .rows()
        .withColumn("__closes", closed)
    )
    newest_first = Window.partitionBy(*keys, "window_no").orderBy(*[F.col(c).desc() for c in order])
    kept = placed.withColumn("place", F.row_number().over(newest_first)).where(
        F.col("place") <= keep_last
    )
    # The marker is the newest row of its window, so a kept window without one is open.
    per_window = Window.partitionBy(*keys, "window_no")
    return (
        kept.withColumn("__fired", F.max("__closes").over(per_window))
        .where("__fired")
        .drop("__fired", "__closes")
    )


def session_windows(
    frame: DataFrame,
    keys: list[str],
    order: list[str],
    gap: int,
    *aggregates: Column,
    max_rows: int = MAX_ROWS,
) -> DataFrame:
    """Windows that grow while a key's rows follow within less than ``gap`` ms.

    Sessions are numbered by an ordered scan and then grouped, so a large key is not
    merged in one task.
    """
    time = F.col(order[0])

    def with_start(rows: DataFrame) -> DataFrame:
        opens = F.col("__prev").isNull() | (time - F.col("__prev") >= gap)
        return rows.withColumn("__opens", opens)

    numbering = OrderedJob(
        keys,
        order,
        [
            Stage(lambda: [previous_value("__prev", time)]),
            Stage(lambda: [running_count("__no", F.col("__opens"))], with_start),
        ],
        lambda rows: rows,
    )
    grouped = numbering.over(frame, max_rows).groupBy(*keys, "__no").agg(
        F.min(time).alias("__first"), F.max(time).alias("__last"), *aggregates
    )
    return grouped.select(
        local_time(F.col("__first")).alias("window_start"),
        local_time(F.col("__last") + F.lit(gap)).alias("window_end"),
        *[c for c in grouped.columns if c not in ("__no", "__first", "__last")],
    )
