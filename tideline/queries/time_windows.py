"""Event-time and ingest-time window queries over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tideline.functions.timing import epoch_millis, local_time
from tideline.operators import windows as W
from tideline.operators.aggregates import counts_as_text
from tideline.queries.registry import query
from tideline.queries.relational import DAY, HOUR, action_sql, actions

TIME = "action_time"



def _floor(width: int, time: str = "action_time") -> str:
    return f"make_timestamp({time} // {width} * {width * 1000})"


@query(
    "win_tumble",
    action_sql(f"""
    SELECT {_floor(HOUR)} AS window_start, {_floor(HOUR)} + INTERVAL 1 HOUR AS window_end,
           {_floor(HOUR)} + INTERVAL 1 HOUR - INTERVAL 1 MILLISECOND AS window_time,
           channel, count(DISTINCT guid) AS uv FROM action_event GROUP BY ALL"""),
)
def win_tumble(spark, folder):
    """Hourly users per channel, with the last instant of the window."""
    return W.tumble(actions(spark, folder), "ts", "1 hour", ["channel"], F.count_distinct("guid").alias("uv"))


@query(
    "win_hop",
    action_sql(f"""
    WITH copies AS (SELECT channel, guid, make_timestamp((action_time // {2 * HOUR} - i) * {2 * HOUR * 1000}) AS window_start
                    FROM action_event, (SELECT unnest(range(0, 3)) AS i))
    SELECT window_start, window_start + INTERVAL 6 HOUR AS window_end, channel, count(DISTINCT guid) AS uv
    FROM copies GROUP BY ALL"""),
)
def win_hop(spark, folder):
    """Every two hours, the users of the last six per channel."""
    return W.hop_distinct(actions(spark, folder), F.col(TIME), 6 * HOUR, 2 * HOUR, ["channel"], "guid", "uv")


_CUMULATE = f"""
    WITH first_seen AS (SELECT channel, action_time // {DAY} AS d, min(action_time % {DAY} // {HOUR}) AS first_step
                        FROM action_event GROUP BY ALL),
         grid AS (SELECT channel, d, unnest(range(first_step, 24)) AS step FROM first_seen)
    SELECT make_timestamp(g.d * {DAY * 1000}) AS window_start,
           make_timestamp(g.d * {DAY * 1000} + (g.step + 1) * {HOUR * 1000}) AS window_end, g.channel,
           count(DISTINCT a.guid) AS uv, count(*) AS pv
    FROM grid g JOIN action_event a ON a.channel = g.channel AND a.action_time // {DAY} = g.d
         AND a.action_time % {DAY} // {HOUR} <= g.step
    GROUP BY ALL"""


@query("win_cumulate", action_sql(_CUMULATE))
def win_cumulate(spark, folder):
    """Hour by hour, the users and views of the day so far per channel."""
    return W.cumulate(
        actions(spark, folder), F.col(TIME), DAY, HOUR, ["channel"], ("uv", "guid"), {"pv": F.lit(1)}
    )


@query(
    "win_legacy_group",
    action_sql(f"""SELECT {_floor(DAY)} AS day_start, CAST(sum(action_timelong) AS BIGINT) AS total
                   FROM action_event GROUP BY ALL"""),
)
def win_legacy_group(spark, folder):
    """The window function in GROUP BY, through SQL text."""
    return spark.sql(
        """SELECT window.start AS day_start, sum(action_timelong) AS total
           FROM {rows} GROUP BY window(ts, '1 day')""",
        rows=actions(spark, folder),
    )


_ARRIVAL = "action_time + guid % 7 * 60000"


def _arrived(spark, folder):
    """Rows with the time they reached the system, some minutes after they happened."""
    return actions(spark, folder).withColumn(
        "arrival", F.col("action_time") + F.col("guid") % 7 * 60_000
    )


@query(
    "win_proc_tumble",
    action_sql(f"""SELECT {_floor(HOUR, f'({_ARRIVAL})')} AS window_start, CAST(sum(action_timelong) AS BIGINT) AS total
                   FROM action_event GROUP BY ALL"""),
)
def win_proc_tumble(spark, folder):
    """Hourly action time by arrival."""
    rows = _arrived(spark, folder).withColumn("arrived_at", local_time(F.col("arrival")))
    return W.tumble(rows, "arrived_at", "1 hour", [], F.sum("action_timelong").alias("total")).drop(
        "window_end", "window_time"
    )


@query(
    "win_proc_hop",
    action_sql(f"""
    WITH copies AS (SELECT action_timelong, make_timestamp((({_ARRIVAL}) // {HOUR} - i) * {HOUR * 1000}) AS window_start
                    FROM action_event, (SELECT unnest(range(0, 4)) AS i))
    SELECT window_start, window_start + INTERVAL 4 HOUR AS window_end, CAST(sum(action_timelong) AS BIGINT) AS total
    FROM copies GROUP BY ALL"""),
)
def win_proc_hop(spark, folder):
    """Each hour, the action time of the last four by arrival."""
    return W.hop_sums(
        _arrived(spark, folder), F.col("arrival"), 4 * HOUR, HOUR, [], {"total": F.col("action_timelong")}
    )


@query(
    "win_full_process",
    action_sql(f"""
    SELECT channel, (action_time // {DAY} * {DAY}) || ',' || (action_time // {DAY} * {DAY} + {DAY}) || ',' ||
           (action_time // {DAY} * {DAY} + {DAY} - 1) || ' : ' || CAST(sum(action_timelong) AS BIGINT) AS message
    FROM action_event GROUP BY channel, action_time // {DAY}"""),
)
def win_full_process(spark, folder):
    """A message per window with its bounds and content."""
    daily = W.tumble(actions(spark, folder), "ts", "1 day", ["channel"], F.sum("action_timelong").alias("total"))
    start, end = epoch_millis(F.col("window_start")), epoch_millis(F.col("window_end"))
    return daily.select(
        "channel", F.format_string("%d,%d,%d : %d", start, end, end - 1, F.col("total")).alias("message")
    )


@query(
    "win_incremental_agg",
    action_sql(f"""
    SELECT window_start, channel, string_agg(event_id || '=' || n, ',' ORDER BY event_id) AS counts FROM (
      SELECT {_floor(DAY)} AS window_start, channel, event_id, count(*) AS n FROM action_event GROUP BY ALL)
    GROUP BY ALL"""),
)
def win_incremental_agg(spark, folder):
    """A map of event counts per day and channel, built from counts per event."""
    rows = actions(spark, folder).select(
        F.window("ts", "1 day")["start"].alias("window_start"), "channel", "event_id"
    )
    return counts_as_text(rows, ["window_start", "channel"], "event_id")


@query(
    "win_incremental_avg",
    action_sql(f"""
    SELECT {_floor(DAY)} AS window_start, channel, CAST(sum(action_timelong) AS BIGINT) AS total, count(*) AS cnt,
           CAST(sum(action_timelong) AS BIGINT) / count(*) AS mean, max(action_timelong) AS best,
           min(log_id) FILTER (WHERE action_timelong = top) AS best_log
    FROM (SELECT *, max(action_timelong) OVER (PARTITION BY channel, action_time // {DAY}) AS top FROM action_event)
    GROUP BY ALL"""),
)
def win_incremental_avg(spark, folder):
    """Sum, count, average and the row of the maximum, all from small accumulators."""
    long = F.col("action_timelong")
    return W.tumble(
        actions(spark, folder), "ts", "1 day", ["channel"],
        F.sum(long).alias("total"), F.count(F.lit(1)).alias("cnt"),
        (F.sum(long) / F.count(F.lit(1))).alias("mean"), F.max(long).alias("best"),
        F.max_by("log_id", F.struct(long, -F.col("log_id"))).alias("best_log"),
    ).drop("window_end", "window_time")


@query(
    "win_session_merge",
    action_sql(f"""
    WITH gaps AS (SELECT *, CASE WHEN action_time - lag(action_time) OVER w < {2 * HOUR} THEN 0 ELSE 1 END AS starts
                  FROM action_event WINDOW w AS (PARTITION BY guid ORDER BY action_time, log_id)),
         islands AS (SELECT *, sum(starts) OVER (PARTITION BY guid ORDER BY action_time, log_id) AS no FROM gaps)
    SELECT guid, make_timestamp(min(action_time) * 1000) AS window_start,
           make_timestamp((max(action_time) + {2 * HOUR}) * 1000) AS window_end, count(*) AS cnt,
           CAST(sum(action_timelong) AS BIGINT) AS total FROM islands GROUP BY guid, no"""),
)
def win_session_merge(spark, folder):
    """Activity sessions of a user, ended by two silent hours."""
    rows = actions(spark, folder).select("guid", "action_time", "log_id", "action_timelong")
    return W.session_windows(
        rows, ["guid"], ["action_time", "log_id"], 2 * HOUR,
        F.count(F.lit(1)).alias("cnt"), F.sum("action_timelong").alias("total"),
    )
