"""Visits: sub-sessions, page stays, and the reports on them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.functions.timing import day_of
from tideline.operators.ordered import (
    MAX_ROWS,
    OrderedJob,
    Stage,
    next_value,
    ordered,
    previous_value,
    running_last,
)
from tideline.operators.ranking import top_n
from tideline.operators.windows import cumulate
from tideline.streaming.keyed import RunningValues, Value, in_order, travels_whole

# For VisitState.
travels_whole(__name__)

# Event names with a meaning of their own.
STARTS = ["applaunch", "wakeup"]
PAGE_LOAD = "pageload"
ENDS = ["putback", "appclose"]
PAGE_LEFT = "flag"
HEARTBEAT = "x001"

ORDER = ["timestamp", "log_id"]
DIMENSIONS = ["province", "city", "region", "devicetype", "is_new", "releasechannel"]

TRAFFIC_COLUMNS = [
    "guid", "log_id", "sessionid", "split_session_id", "event_id", "ts", "page_id", "page_load_time", *DIMENSIONS,
]


def visit_state() -> list:
    """What a visit hands from row to row: its start, the current page and its load time."""
    start = F.when(
        F.col("__starts"),
        F.struct(
            F.col("sessionid"),
            F.concat_ws(":", "sessionid", F.col("timestamp").cast("string")).alias("split_session_id"),
            *DIMENSIONS,
        ),
    )
    page = F.when(F.col("eventid") == PAGE_LOAD, F.col("properties")["pageId"])
    load = F.when(F.col("__starts") | (F.col("eventid") == PAGE_LOAD), F.col("timestamp"))
    return [
        running_last("__start", start),
        running_last("__page", page),
        running_last("__page_before", page, inclusive=False),
        running_last("__load", load),
        running_last("__load_before", load, inclusive=False),
    ]


def previous_row() -> list:
    return [previous_value("__prev", F.col("timestamp"))]


def with_starts(rows: DataFrame) -> DataFrame:
    return rows.withColumn("__starts", F.col("eventid").isin(STARTS) | F.col("__prev").isNull())


def visit_rows(detail: DataFrame, max_rows: int = MAX_ROWS) -> DataFrame:
    """Each log row with its visit, page and the time of the user's next row.

    A launch, a wake-up or the user's first row starts a sub-session, whose dimensions are
    those of its first row. A page load sets the page, also when it is the first row.
    """
    rows = ordered(detail, ["guid"], ORDER, max_rows, keep=True, counted=True).scan(
        *previous_row(), next_value("__next", F.col("timestamp"))
    )
    return rows.transform(with_starts).scan(*visit_state()).rows()


def _entry(event: Column, ts: Column, page: str, load: str) -> Column:
    return F.struct(
        event.alias("event_id"), ts.alias("ts"), F.col(page).alias("page_id"), F.col(load).alias("page_load_time"),
    )


def _own_entries() -> Column:
    """The row itself, after one that closes the old page if it loads a new one."""
    time = F.col("timestamp")
    own = _entry(F.col("eventid"), time, "__page", "__load")
    left = _entry(F.lit(PAGE_LEFT), time, "__page_before", "__load_before")
    loads = (F.col("eventid") == PAGE_LOAD) & ~F.col("__starts")
    return F.when(loads, F.array(left, own)).otherwise(F.array(own))


def _beat_entries(every: int, at_most: int) -> Column:
    """A row each ``every`` ms until the user's next row, for at most ``at_most`` ms.

    None follow a row that puts the app in the background or closes it.
    """
    first = F.col("timestamp") + F.lit(every)
    last = F.least(F.col("__next") - 1, F.col("timestamp") + F.lit(at_most))
    silent = ~F.col("eventid").isin(ENDS) & (first <= last)
    times = F.when(silent, F.sequence(first, last, F.lit(every).cast("long"))).otherwise(
        F.array().cast("array<bigint>")
    )
    return F.transform(times, lambda t: _entry(F.lit(HEARTBEAT), t, "__page", "__load"))


def _traffic(visits: DataFrame, entries: Column) -> DataFrame:
    rows = visits.select(
        "guid", "log_id", "__start.sessionid", "__start.split_session_id",
        *[F.col(f"__start.{c}").alias(c) for c in DIMENSIONS],
        F.explode(entries).alias("__entry"),
    )
    return rows.select("*", "__entry.*").select(*TRAFFIC_COLUMNS)


def split_sessions(visits: DataFrame) -> DataFrame:
    """One traffic row per log row, plus one that closes the old page at each page load."""
    return _traffic(visits, _own_entries())


def session_job() -> OrderedJob:
    """Session splitting as an ordered job, for streams."""
    return OrderedJob(
        ["guid"], ORDER, [Stage(previous_row), Stage(visit_state, with_starts)], split_sessions
    )


class VisitState(RunningValues):
    """Session starts, pages and load times; a user's first row starts a sub-session whatever it is."""

    def prepare(self, rows, first):
        starts = rows["opens"].to_numpy(bool)
        if first:
            starts[0] = True
        loads = starts | rows["loads"].to_numpy(bool)
        return rows.assign(starts=starts, start=rows["start"].where(starts, None), load=rows["at"].where(loads, None))


def split_sessions_stream(visits: DataFrame, delay: str) -> DataFrame:
    """``split_sessions`` while the log comes in, each user's visit in Spark's state store."""
    time, event = F.col("timestamp"), F.col("eventid")
    start = F.struct("sessionid", F.concat_ws(":", "sessionid", time.cast("string")).alias("split_session_id"), *DIMENSIONS)
    rows = visits.select(
        "guid", *ORDER, "eventid", event.isin(STARTS).alias("opens"), (event == PAGE_LOAD).alias("loads"),
        F.to_json(start).alias("start"), F.when(event == PAGE_LOAD, F.col("properties")["pageId"]).alias("page"),
        time.cast("string").alias("at"),
    )
    values = [
        Value("visit", "last", "start"), Value("page_now", "last", "page"), Value("page_before", "last", "page", False),
        Value("load_now", "last", "load"), Value("load_before", "last", "load", False),
    ]
    output = (
        "guid BIGINT, log_id BIGINT, timestamp BIGINT, eventid STRING, starts BOOLEAN, visit STRING, page_now STRING, "
        "page_before STRING, load_now STRING, load_before STRING"
    )
    kept = in_order(rows, ["guid"], ORDER, delay, output, VisitState, values)
    starts = visits.select(start.alias("start")).schema["start"].dataType
    return split_sessions(
        kept.select(
            "guid", *ORDER, "eventid", F.col("starts").alias("__starts"), F.from_json("visit", starts).alias("__start"),
            F.col("page_now").alias("__page"), F.col("page_before").alias("__page_before"),
            F.col("load_now").cast("long").alias("__load"), F.col("load_before").cast("long").alias("__load_before"),
        )
    )


def heartbeats(visits: DataFrame, every: int, at_most: int) -> DataFrame:
    """Only the rows that fill silent stretches."""
    return _traffic(visits, _beat_entries(every, at_most))


def traffic(detail: DataFrame, every: int, at_most: int, max_rows: int = MAX_ROWS) -> DataFrame:
    """All traffic rows: log rows, page closings and heartbeats, from one pass over the visits."""
    return _traffic(visit_rows(detail, max_rows), F.concat(_own_entries(), _beat_entries(every, at_most)))


def session_summary(rows: DataFrame) -> DataFrame:
    """Length, page views and end of each sub-session."""
    return rows.groupBy("guid", "split_session_id", *DIMENSIONS).agg(
        (F.max("ts") - F.min("ts")).alias("session_time"),
        F.count_if(F.col("event_id") == PAGE_LOAD).alias("session_pv"),
        F.max("ts").alias("session_end"),
    )


def session_time(rows: DataFrame) -> DataFrame:
    """Total length of a session's sub-sessions."""
    parts = rows.groupBy("guid", "sessionid", "split_session_id").agg(
        (F.max("ts") - F.min("ts")).alias("part_time")
    )
    return parts.groupBy("guid", "sessionid").agg(F.sum("part_time").alias("session_time"))


# Dimension sets of the traffic reports.
REPORT_SETS = [
    [], ["releasechannel"], ["releasechannel", "is_new"], ["devicetype"], ["province", "city", "region"],
]


def traffic_report(sessions: DataFrame) -> DataFrame:
    """Users, page views, time and sessions for each dimension set."""
    columns = [F.col(c) for c in DIMENSIONS]
    sets = [[F.col(c) for c in names] for names in REPORT_SETS]
    return sessions.groupingSets(sets, *columns).agg(
        F.count_distinct("guid").alias("uv"),
        F.sum("session_pv").alias("pv"),
        F.sum("session_time").alias("total_time"),
        F.count(F.lit(1)).alias("session_cnt"),
        F.grouping_id().alias("gid"),
    )


def per_set(frame: DataFrame, dimensions: list[str], sets: list[list[str]], number: str) -> DataFrame:
    """One copy of a row per dimension set, the columns outside the set emptied."""
    types = dict(frame.dtypes)
    copies = [
        F.struct(
            F.lit(i).alias(number),
            *[(F.col(c) if c in names else F.lit(None).cast(types[c])).alias(c) for c in dimensions],
        )
        for i, names in enumerate(sets)
    ]
    rest = [c for c in frame.columns if c not in dimensions]
    return frame.select(*rest, F.explode(F.array(*copies)).alias("__set")).select(*rest, "__set.*")


def cumulative_report(sessions: DataFrame, size: int, step: int) -> DataFrame:
    """The report so far at each ``step`` of a ``size`` window, by session end."""
    copies = per_set(sessions, DIMENSIONS, REPORT_SETS[1:], "set_no")
    return cumulate(
        copies,
        F.col("session_end"),
        size,
        step,
        ["set_no", *DIMENSIONS],
        ("uv", "guid"),
        {"pv": F.col("session_pv"), "total_time": F.col("session_time"), "session_cnt": F.lit(1)},
    )


def page_report(rows: DataFrame) -> DataFrame:
    """Stay, sessions, views and users of each page; one load is one view."""
    stays = (
        rows.where(F.col("page_id").isNotNull())
        .groupBy("page_id", "page_load_time", "split_session_id", "guid")
        .agg((F.max("ts") - F.min("ts")).alias("stay"))
    )
    return stays.groupBy("page_id").agg(
        F.sum("stay").alias("page_time"),
        F.count_distinct("split_session_id").alias("session_cnt"),
        F.count(F.lit(1)).alias("page_pv"),
        F.count_distinct("guid").alias("page_uv"),
    )


def top_pages(report: DataFrame, measure: str, n: int = 20) -> DataFrame:
    return top_n(report, [F.desc(measure), F.asc("page_id")], n)


def retention(rows: DataFrame, as_of: str, days: int = 7) -> DataFrame:
    """Of the rows and users of the ``as_of`` day, those first seen 1..``days`` days before.

    ``rows`` has ``first_time``: registration, or else first access, in epoch ms.
    """
    today = F.lit(as_of).cast("date")
    age = F.datediff(today, day_of(F.col("first_time")))
    active = rows.where(day_of(F.col("timestamp")) == today).withColumn("__age", age)
    counted = active.groupBy("releasechannel", "devicetype", "guid").agg(
        F.count(F.lit(1)).alias("__rows"), F.max("__age").alias("__age")
    )
    measures = []
    for n in range(1, days + 1):
        hit = F.col("__age") == n
        measures.append(F.sum(F.when(hit, F.col("__rows")).otherwise(0)).alias(f"rows_{n}day"))
        measures.append(F.count_if(hit).alias(f"users_{n}day"))
    report = counted.groupBy("releasechannel", "devicetype").agg(*measures)
    return report.withColumn("calc_date", today)
