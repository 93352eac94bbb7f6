"""Ordered scans per key that never hold one large key in one task.

Running counts, "last value so far", next-row lookups and short row frames all depend on
the order of rows inside a key. A plain window function sorts a whole key in one task,
which a key with a third of all rows does not survive. So every key is cut into slices of
at most about ``max_rows`` rows: the window functions run per (key, slice), and what a
slice needs from the others is a small total per slice, folded in slice order and joined
back. A key with few rows is one slice.

Slices are cut by row counts. A histogram per key over short stretches of time gives the
rows before each stretch, and so the slice it falls into. A stretch with too many rows is
cut by the rows before each of its instants, and an instant with too many rows by ranges
of the row id. A row far off in time or a burst thus fills no slice. All of this is part
of the plan: preparing it runs no job.

``counted`` looks first: a job counts rows per key, of which the driver learns the largest
number only, and if no key has more than ``max_rows`` rows, plain window functions do. If
one has, rows that a later step reads again are written to the shared folder in between, so
nothing stays in the executors' storage. The same job counts all rows, which are dealt to
tasks by that number: what a task sorts does not grow with the table.

With no key at all the whole table is one ordered sequence and is treated the same way.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline.functions.timing import bucket
from tideline.operators.rows import tasks_of
from tideline.session import stored

MAX_ROWS = 2_000_000
#: Length of the stretches that are counted first, in units of the order's time (ms).
GRAIN = 60_000

_SLICE, _HALO = "__slice", "__halo"
_FIRST, _CURRENT, _LAST = Window.unboundedPreceding, Window.currentRow, Window.unboundedFollowing


@dataclass(frozen=True)
class Running:
    """One ordered expression, in the three places it has to be computed.

    ``local`` works inside a slice, ``total`` condenses a slice to one value, ``fold``
    condenses the totals of the other slices and ``merge`` joins local and folded value.
    ``alone`` is the local value where there is nothing to merge it with.
    """

    name: str
    local: Callable[[WindowSpec], Column]
    total: Callable[[Column], Column]
    fold: Callable[[Column], Column]
    merge: Callable[[Column, Column], Column]
    forward: bool = False
    alone: Callable[[Column], Column] = lambda local: local


def _up_to(window: WindowSpec, inclusive: bool) -> WindowSpec:
    return window.rowsBetween(_FIRST, _CURRENT if inclusive else -1)


def running_sum(name: str, value: Column, inclusive: bool = True) -> Running:
    return Running(
        name,
        lambda w: F.sum(value).over(_up_to(w, inclusive)),
        lambda order: F.sum(value),
        F.sum,
        lambda local, carry: F.coalesce(local, F.lit(0)) + F.coalesce(carry, F.lit(0)),
        alone=lambda local: F.coalesce(local, F.lit(0)),
    )


def running_count(name: str, condition: Column | None = None, inclusive: bool = True) -> Running:
    hit = F.lit(True) if condition is None else F.coalesce(condition, F.lit(False))
    return running_sum(name, hit.cast("long"), inclusive)


def running_max(name: str, value: Column, inclusive: bool = True) -> Running:
    return Running(
        name,
        lambda w: F.max(value).over(_up_to(w, inclusive)),
        lambda order: F.max(value),
        F.max,
        F.greatest,
    )


def running_min(name: str, value: Column, inclusive: bool = True) -> Running:
    return Running(
        name,
        lambda w: F.min(value).over(_up_to(w, inclusive)),
        lambda order: F.min(value),
        F.min,
        F.least,
    )


def running_last(name: str, value: Column, inclusive: bool = True) -> Running:
    """Newest non-null value so far."""
    return Running(
        name,
        lambda w: F.last(value, ignorenulls=True).over(_up_to(w, inclusive)),
        lambda order: F.max_by(value, F.when(value.isNotNull(), order)),
        lambda total: F.last(total, ignorenulls=True),
        lambda local, carry: F.coalesce(local, carry),
    )


def previous_value(name: str, value: Column) -> Running:
    """Value of the row before; the value column must not hold nulls."""
    return running_last(name, value, inclusive=False)


def next_value(name: str, value: Column) -> Running:
    """Value of the row after; the value column must not hold nulls."""
    return Running(
        name,
        lambda w: F.lead(value).over(w),
        lambda order: F.min_by(value, order),
        lambda total: F.first(total, ignorenulls=True),
        lambda local, carry: F.coalesce(local, carry),
        forward=True,
    )


@dataclass(frozen=True)
class Ordered:
    """Rows ready for ordered expressions, each, if keys are ``cut``, with the slice of its key that holds it."""

    frame: DataFrame
    keys: tuple[str, ...]
    order: tuple[str, ...]
    cut: bool
    counted: bool = False
    scanned: bool = False
    #: Tasks the rows are dealt to, if they were counted.
    tasks: int | None = None

    def group(self) -> list[str]:
        """The columns whose equal values make a group that one task may hold."""
        return [*self.keys, _SLICE] if self.cut else [*self.keys]

    def dealt(self, frame: DataFrame) -> DataFrame:
        """The rows by group, in as many tasks as they need by their number."""
        return frame.repartition(self.tasks, *self.group()) if self.tasks and self.group() else frame

    def scan(self, *running: Running, since: DataFrame | None = None) -> "Ordered":
        """Add one column per expression.

        ``since`` holds, per key, the totals reached before these rows (see ``totals``);
        the micro-batches of a stream hand it on from one to the next.
        """
        frame, carry, helpers = self.frame, {}, []
        if self.cut:
            # Rows feed both the totals and the result, so an earlier scan is kept, not run twice.
            frame = _kept(frame, self.counted) if self.scanned else frame
            frame = join_null_safe(frame, self._carried(frame, running), self.group())
            carry = {r.name: F.col(f"__c_{r.name}") for r in running}
            helpers = [f"__c_{r.name}" for r in running]
        earlier = [r for r in running if not r.forward] if since is not None else []
        if earlier and self.keys:
            reached = since.select(*self.keys, *[F.col(r.name).alias(f"__s_{r.name}") for r in earlier])
            frame = join_null_safe(frame, reached, list(self.keys))
        elif earlier:
            frame = frame.withColumns({f"__s_{r.name}": since.select(r.name).scalar() for r in earlier})
        for r in earlier:
            reached = F.col(f"__s_{r.name}")
            carry[r.name] = r.merge(carry[r.name], reached) if r.name in carry else reached
            helpers.append(f"__s_{r.name}")
        # Rows that were scanned before and joined to nothing since are where they belong, for finer keys too.
        if self.cut or earlier or not self.scanned:
            frame = self.dealt(frame)
        window = Window.partitionBy(*self.group()).orderBy(*self.order)
        columns = {
            r.name: r.merge(r.local(window), carry[r.name]) if r.name in carry else r.alone(r.local(window)) for r in running
        }
        return replace(self, frame=frame.withColumns(columns).drop(*helpers), scanned=True)

    def _carried(self, frame: DataFrame, running: tuple[Running, ...]) -> DataFrame:
        """Per slice, the folded totals of the slices before (or after) it."""
        group, position = self.group(), F.struct(*self.order)
        totals = frame.groupBy(*group).agg(*[r.total(position).alias(r.name) for r in running])
        by_slice = Window.partitionBy(*self.keys).orderBy(_SLICE)
        before, after = by_slice.rowsBetween(_FIRST, -1), by_slice.rowsBetween(1, _LAST)
        return totals.select(
            *group,
            *[
                r.fold(F.col(r.name)).over(after if r.forward else before).alias(f"__c_{r.name}")
                for r in running
            ],
        )

    def by(self, *keys: str) -> "Ordered":
        """The same rows under finer keys, or the first ones again; the slices of the first keys serve both."""
        return replace(self, keys=keys)

    def transform(self, change: Callable[[DataFrame], DataFrame]) -> "Ordered":
        """Change the rows; ``change`` must keep columns it does not know."""
        return replace(self, frame=change(self.frame))

    def rows(self) -> DataFrame:
        return self.frame.drop(_SLICE)


def join_null_safe(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Left join on equal keys, a null key matching a null key."""
    renamed = right.withColumnsRenamed({k: f"__r_{k}" for k in keys})
    condition = None
    for k in keys:
        term = left[k].eqNullSafe(renamed[f"__r_{k}"])
        condition = term if condition is None else condition & term
    return left.join(renamed, condition, "left").drop(*[f"__r_{k}" for k in keys])


def _kept(frame: DataFrame, counted: bool) -> DataFrame:
    return stored(frame) if counted else frame.persist()


def ordered(
    frame: DataFrame,
    keys: list[str],
    order: list[str],
    max_rows: int = MAX_ROWS,
    grain: int = GRAIN,
    keep: bool = False,
    counted: bool = False,
) -> Ordered:
    """Prepare ``frame`` for ordered work per key; ``counted`` does it by what a count of its rows says.

    ``order`` starts with a BIGINT time and ends with a unique id, so the order is total.
    The id is a number, or a text, which a single instant is cut by in its first characters
    only. ``keep`` says that the frame is costly to make and should be made once if keys are cut,
    not once for the histograms and once for the rows.
    """
    tasks = None
    if counted:
        largest, count = _counted(frame, keys)
        tasks = max(tasks_of(count), frame.sparkSession.sparkContext.defaultParallelism)
        if largest <= max_rows:
            return Ordered(frame, tuple(keys), tuple(order), cut=False, tasks=tasks)
    rows = _kept(frame, counted) if keep else frame
    # Rows without a time come first.
    time = F.coalesce(F.col(order[0]).cast("long"), F.lit(-(1 << 62)))
    rows = rows.withColumn("__stretch", bucket(time, grain))
    histogram = rows.groupBy(*keys, "__stretch").agg(F.count(F.lit(1)).alias("__n"))
    rows = join_null_safe(rows, _cuts(histogram, keys, "__stretch", max_rows, "__s1", "__full"), [*keys, "__stretch"])
    # Instants of the stretches that are too large for a slice; without any, nothing is joined.
    instants = rows.where(F.col("__full")).withColumn("__instant", time)
    place = [*keys, "__stretch"]
    histogram = instants.groupBy(*place, "__instant").agg(F.count(F.lit(1)).alias("__n"))
    cuts = _cuts(histogram, place, "__instant", max_rows, "__s2", "__crowd")
    rows = join_null_safe(rows.withColumn("__instant", time), cuts, [*place, "__instant"])
    last = F.col(order[-1])
    text_id = isinstance(frame.schema[order[-1]].dataType, T.StringType)
    part = F.substring(last, 1, 8) if text_id else bucket(last, max_rows).cast("string")
    part_order = F.lit(0).cast("long") if text_id else bucket(last, max_rows)
    crowd = F.coalesce(F.col("__crowd"), F.lit(False))
    slice_ = F.struct(
        F.col("__s1").alias("a"),
        F.col("__full").cast("int").alias("b"),
        F.coalesce(F.col("__s2"), F.lit(0)).alias("c"),
        crowd.cast("int").alias("d"),
        *[F.when(crowd, F.col(c)).alias(f"e{i}") for i, c in enumerate(order[1:-1])],
        F.when(crowd, part_order).alias("f"),
        F.when(crowd, part).alias("g"),
    )
    cut = rows.withColumn(_SLICE, slice_).drop("__stretch", "__instant", "__s1", "__full", "__s2", "__crowd")
    return Ordered(cut, tuple(keys), tuple(order), cut=True, counted=counted, tasks=tasks)


def _counted(frame: DataFrame, keys: list[str]) -> tuple[int, int]:
    """The number of rows of the largest key, and of all keys."""
    if not keys:
        count = frame.count()
        return count, count
    largest, count = frame.groupBy(*keys).count().agg(F.max("count"), F.sum("count")).first()
    return largest or 0, count or 0


def _cuts(histogram: DataFrame, keys: list[str], cell: str, max_rows: int, name: str, full: str) -> DataFrame:
    """For each cell of a key, the slice that the rows before it put it into, and whether it is too large itself."""
    before = Window.partitionBy(*keys).orderBy(cell).rowsBetween(_FIRST, -1)
    rank = F.floor(F.coalesce(F.sum("__n").over(before), F.lit(0)) / F.lit(max_rows)).cast("long")
    return histogram.select(*keys, cell, rank.alias(name), (F.col("__n") > max_rows).alias(full))


def totals(
    frame: DataFrame,
    keys: list[str],
    order: list[str],
    running: list[Running],
    since: DataFrame | None = None,
) -> DataFrame:
    """Per key, the values reached after these rows: the ``since`` of the next rows."""
    backward = [r for r in running if not r.forward]
    position = F.struct(*order)
    now = frame.groupBy(*keys).agg(*[r.total(position).alias(r.name) for r in backward])
    if since is None:
        return now
    if not keys:
        return now.select(
            *[r.merge(F.col(r.name), since.select(r.name).scalar()).alias(r.name) for r in backward]
        )
    old = since.withColumnsRenamed({c: f"__o_{c}" for c in since.columns})
    condition = None
    for k in keys:
        term = now[k].eqNullSafe(old[f"__o_{k}"])
        condition = term if condition is None else condition & term
    both = now.join(old, condition, "full")
    return both.select(
        *[F.coalesce(F.col(k), F.col(f"__o_{k}")).alias(k) for k in keys],
        *[r.merge(F.col(r.name), F.col(f"__o_{r.name}")).alias(r.name) for r in backward],
    )


@dataclass(frozen=True)
class Stage:
    """Columns derived from the stages before, then ordered expressions over them."""

    running: Callable[[], list[Running]]
    prepare: Callable[[DataFrame], DataFrame] = lambda frame: frame


@dataclass(frozen=True)
class OrderedJob:
    """Ordered work per key that runs over a whole table or, with carried state, over a stream."""

    keys: list[str]
    order: list[str]
    stages: list[Stage]
    finish: Callable[[DataFrame], DataFrame]

    def over(self, frame: DataFrame, max_rows: int = MAX_ROWS) -> DataFrame:
        cut = ordered(frame, self.keys, self.order, max_rows, counted=True)
        for stage in self.stages:
            cut = cut.transform(stage.prepare).scan(*stage.running())
        return self.finish(cut.rows())


def row_frames(
    frame: DataFrame,
    keys: list[str],
    order: list[str],
    preceding: int,
    columns: Callable[[WindowSpec], dict[str, Column]],
    max_rows: int = MAX_ROWS,
    counted: bool = False,
) -> DataFrame:
    """Window functions over the current row and the ``preceding`` rows before it.

    A slice first receives copies of the last rows before it; they take part in the frames
    and are dropped afterwards.
    """
    cut = ordered(frame, keys, order, max_rows, counted=counted)
    window = Window.partitionBy(*cut.group()).orderBy(*order).rowsBetween(-preceding, _CURRENT)
    if not cut.cut:
        return cut.dealt(cut.frame).withColumns(columns(window))
    newest_first = Window.partitionBy(*keys, _SLICE).orderBy(*[F.col(c).desc() for c in order])
    tails = (
        cut.frame
        .withColumn("__back", F.row_number().over(newest_first))
        .where(F.col("__back") <= preceding)
    )
    by_order = Window.partitionBy(*keys).orderBy(_SLICE, *order).rowsBetween(-(preceding - 1), 0)
    by_slice = Window.partitionBy(*keys).orderBy(_SLICE)
    copies = (
        tails.withColumn("__tail", F.collect_list(F.struct(*frame.columns)).over(by_order))
        .where(F.col("__back") == 1)
        .withColumn(_SLICE, F.lead(_SLICE).over(by_slice))
        .where(F.col(_SLICE).isNotNull())
        .select(_SLICE, F.explode("__tail").alias("__row"))
        .select("__row.*", _SLICE, F.lit(True).alias(_HALO))
    )
    own = cut.frame.withColumn(_HALO, F.lit(False))
    framed = own.unionByName(copies).withColumns(columns(window))
    return framed.where(~F.col(_HALO)).drop(_SLICE, _HALO)


def range_sums(
    frame: DataFrame,
    keys: list[str],
    order: list[str],
    span: int,
    sums: dict[str, Column],
    max_rows: int = MAX_ROWS,
    counted: bool = False,
) -> DataFrame:
    """Add sums over the rows of the last ``span`` time units up to this one's time.

    A sum up to now minus the sum up to just before the span: both are running totals over
    the instants of a key, of which the earlier one is read at a mark put ``span`` before
    each instant. The cost does not depend on how many rows a span holds. A null value
    counts as 0; values should be whole numbers or decimals, so that differences are exact.
    """
    time = order[0]
    instants = frame.groupBy(*keys, F.col(time).alias("__at")).agg(*[F.sum(v).alias(n) for n, v in sums.items()])
    ends = instants.select(*keys, "__at", F.col("__at").alias("__t"), F.lit(1).alias("__side"), *sums)
    marks = instants.select(
        *keys, "__at", (F.col("__at") - span).alias("__t"), F.lit(0).alias("__side"),
        *[F.lit(None).cast(instants.schema[n].dataType).alias(n) for n in sums],
    )
    reached = (
        ordered(ends.unionByName(marks), keys, ["__t", "__side", "__at"], max_rows, counted=counted)
        .scan(*[running_sum(f"__to_{n}", F.col(n)) for n in sums])
        .rows()
    )
    signed = lambda n: F.when(F.col("__side") == 1, F.col(f"__to_{n}")).otherwise(-F.col(f"__to_{n}"))
    within = reached.groupBy(*keys, "__at").agg(*[F.sum(signed(n)).alias(n) for n in sums])
    return join_null_safe(frame.withColumn("__at", F.col(time)), within, [*keys, "__at"]).drop("__at")
