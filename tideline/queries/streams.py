"""Streaming forms over the same tables; each gives what its batch form gives.

A run handles what is there now. Windows the watermark has not passed stay open, so the
checks of append-mode windows hold the closed ones only.
"""

from __future__ import annotations

import pandas as pd
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from tideline.operators import changes as C
from tideline.operators.ranking import top_n_per_group
from tideline.operators.rows import split_rows
from tideline.plans import traffic as V
from tideline.queries import joining, ordering, relational, time_windows, warehouse  # noqa: F401
from tideline.queries.registry import ORACLES, query
from tideline.queries.relational import DAY, HOUR, action_sql
from tideline.session import scratch_folder
from tideline.sinks.committed import commit_to, read_committed
from tideline.sinks.tables import append_batch, read_batches
from tideline.sources.behaviour import CHANNELS, action_event, app_log
from tideline.sources.tables import table, table_stream
from tideline.sources.watched import watch_changing_lines
from tideline.streaming import keyed as K
from tideline.streaming import operators as O
from tideline.streaming.carry import ordered_stream
from tideline.streaming.dimensions import RunningDimension
from tideline.streaming.run import append_to, appended, each_batch, kept_current, with_event_time

ORDER = ["action_time", "log_id"]


def actions(spark, folder):
    return action_event(table_stream(spark, folder, "events"))


def parts_of(spark, folder, base: str):
    """The events in three parts in order of time; each is in the watched folder ``base`` when it is yielded."""
    events, day = table(spark, folder, "events"), F.day("ts")
    for part in (day <= 9, (day > 9) & (day <= 20), (day > 20) | F.col("ts").isNull()):
        events.where(part).write.mode("append").parquet(f"{base}/events.parquet")
        yield table_stream(spark, base, "events")


def actions_of(events):
    """User actions with the channel the SQL gives to a row that holds no number for it."""
    return action_event(events).withColumn("channel", F.coalesce("channel", F.lit(CHANNELS[-1])))


def appended_in_parts(spark, folder, purpose, result_of):
    """Final rows of a query that is stopped and started between three parts of the events, its state in Spark's store."""
    base, schema = scratch_folder(spark, purpose), None
    for events in parts_of(spark, folder, base):
        result = result_of(actions_of(events))
        schema = result.schema
        append_to(result, f"{base}/rows", f"{base}/checkpoint", keyed=True)
    return spark.read.schema(schema).parquet(f"{base}/rows")


def _closed(size: str, delay: str, select: str, extra: str = "") -> str:
    return action_sql(f"""
    SELECT * FROM (
      SELECT time_bucket(INTERVAL {size}, ts) AS window_start, time_bucket(INTERVAL {size}, ts) + INTERVAL {size} AS window_end, {select}
      FROM action_event {extra} GROUP BY ALL)
    WHERE window_end <= (SELECT max(ts) FROM action_event {extra}) - INTERVAL {delay}""")


def _counts():
    return [F.count(F.lit(1)).alias("cnt"), F.sum("action_timelong").alias("total")]


_COUNTS = "channel, count(*) AS cnt, CAST(sum(action_timelong) AS BIGINT) AS total"


@query("wm_bounded", _closed("1 hour", "1 hour", _COUNTS))
def wm_bounded(spark, folder):
    """Hourly sums with rows up to an hour late taken in."""
    rows = with_event_time(actions(spark, folder), "ts", "1 hour")
    return appended(spark, O.windowed(rows, "rt", "1 hour", ["channel"], *_counts()), "bounded")


@query("wm_monotonic", _closed("6 hours", "0 hour", _COUNTS))
def wm_monotonic(spark, folder):
    """Sums over six hours of rows that come in order."""
    rows = with_event_time(actions(spark, folder), "ts", "0 seconds")
    return appended(spark, O.windowed(rows, "rt", "6 hours", ["channel"], *_counts()), "monotonic")


@query("wm_forward", _closed("1 day", "30 minutes", _COUNTS))
def wm_forward(spark, folder):
    """A watermark set once and kept by the views built on it."""
    rows = with_event_time(actions(spark, folder), "ts", "30 minutes")
    picked = spark.sql("SELECT rt, channel, action_timelong FROM {marked}", marked=rows)
    return appended(spark, O.windowed(picked, "rt", "1 day", ["channel"], *_counts()), "forward")


@query("wm_custom", _closed("2 hours", "1 millisecond", _COUNTS))
def wm_custom(spark, folder):
    """A watermark one millisecond behind the newest row."""
    rows = with_event_time(actions(spark, folder), "ts", "1 millisecond")
    return appended(spark, O.windowed(rows, "rt", "2 hours", ["channel"], *_counts()), "custom")


@query(
    "wm_min_of_inputs",
    action_sql("""
    WITH both_kinds AS (SELECT * FROM action_event WHERE event_id IN ('click', 'view'))
    SELECT * FROM (SELECT time_bucket(INTERVAL 1 hour, ts) AS window_start, count(*) AS cnt FROM both_kinds GROUP BY ALL)
    WHERE window_start + INTERVAL 1 hour <= (SELECT min(m) FROM (SELECT max(ts) AS m FROM both_kinds GROUP BY event_id))"""),
)
def wm_min_of_inputs(spark, folder):
    """Two inputs of which the slower one sets the time."""
    clicks = actions(spark, folder).where("event_id = 'click'")
    views = actions(spark, folder).where("event_id = 'view'")
    merged = with_event_time(clicks, "ts", "0 seconds").unionByName(with_event_time(views, "ts", "0 seconds"))
    hourly = O.windowed(merged, "rt", "1 hour", [], F.count(F.lit(1)).alias("cnt"))
    return appended(spark, hourly, "slowest").drop("window_end")


@query(
    "late_allowed_stream",
    action_sql("""SELECT time_bucket(INTERVAL 1 hour, ts) AS window_start, time_bucket(INTERVAL 1 hour, ts) + INTERVAL 1 hour AS window_end,
                  channel, count(*) AS cnt, CAST(sum(action_timelong) AS BIGINT) AS total FROM action_event GROUP BY ALL"""),
)
def late_allowed_stream(spark, folder):
    """Windows that fire at once and again for each late row, newest result kept."""
    rows = with_event_time(actions(spark, folder), "ts", "3 hours")
    fired = O.windowed(rows, "rt", "1 hour", ["channel"], *_counts())
    return kept_current(spark, fired, ["window_start", "window_end", "channel"], "refired")


@query("late_side_output_stream", ORACLES["late_side_output"])
def late_side_output_stream(spark, folder):
    """Late rows kept apart while the stream runs."""
    rows = joining.arrived(actions(spark, folder))
    judged = ordered_stream(spark, rows, joining.lateness_job())
    return judged.where("lateness = 'late'").select("log_id", "guid", "action_time")


@query(
    "win_hop_stream",
    action_sql(f"""
    WITH copies AS (SELECT channel, ts, make_timestamp((action_time // {2 * HOUR} - i) * {2 * HOUR * 1000}) AS window_start
                    FROM action_event, (SELECT unnest(range(0, 3)) AS i))
    SELECT window_start, window_start + INTERVAL 6 HOUR AS window_end, channel, count(*) AS cnt
    FROM copies GROUP BY ALL HAVING window_start + INTERVAL 6 HOUR <= (SELECT max(ts) FROM action_event)"""),
)
def win_hop_stream(spark, folder):
    """Sliding counts of closed windows."""
    rows = with_event_time(actions(spark, folder), "ts", "0 seconds")
    sliding = O.windowed(rows, "rt", "6 hours", ["channel"], F.count(F.lit(1)).alias("cnt"), slide="2 hours")
    return appended(spark, sliding, "sliding")


@query("win_session_stream", f"SELECT * FROM ({ORACLES['win_session_merge']}) WHERE window_end <= (SELECT max(ts) FROM events)")
def win_session_stream(spark, folder):
    """Activity sessions that have ended."""
    moment = F.timestamp_millis("action_time")
    rows = with_event_time(actions(spark, folder).withColumn("moment", moment), "moment", "0 seconds")
    return appended(spark, O.sessions(rows, "rt", "2 hours", ["guid"], *_counts()), "sessions")


@query("win_cumulate_stream", ORACLES["win_cumulate"])
def win_cumulate_stream(spark, folder):
    """Users and views of the day so far, hour by hour, kept current by a stream."""
    rows = with_event_time(actions(spark, folder), "ts", "1 hour")
    return O.growing(spark, rows, "rt", DAY, HOUR, ["channel"], ("uv", "guid"), {"pv": F.lit(1)})


@query("agg_word_count_stream", """SELECT word, count(*) AS cnt FROM (SELECT unnest(string_split(text, ' ')) AS word FROM conversations) GROUP BY word""")
def agg_word_count_stream(spark, folder):
    """Words of all conversation turns, counted as they come."""
    words = split_rows(table_stream(spark, folder, "conversations").select(F.col("text").alias("word")), "word", " ")
    return kept_current(spark, words.groupBy("word").agg(F.count(F.lit(1)).alias("cnt")), ["word"], "words")


@query("agg_count_distinct_stream", action_sql("SELECT channel, count(DISTINCT guid) AS uv FROM action_event GROUP BY channel"))
def agg_count_distinct_stream(spark, folder):
    """Exact distinct users: one row per channel and user is kept current, then counted."""
    per_user = actions(spark, folder).groupBy("channel", "guid").agg(F.count(F.lit(1)).alias("cnt"))
    current = kept_current(spark, per_user, ["channel", "guid"], "users")
    return current.groupBy("channel").agg(F.count(F.lit(1)).alias("uv"))


@query("st_first_seen_stream", action_sql("SELECT DISTINCT guid FROM action_event"))
def st_first_seen_stream(spark, folder):
    """Each user once, when first seen."""
    return appended(spark, O.new_keys(actions(spark, folder), ["guid"]), "firsts")


@query("topn_per_group_stream", ORACLES["topn_per_group"])
def topn_per_group_stream(spark, folder):
    """The users most often on each page, ranked over the totals the stream keeps current."""
    keys = ["page_id", "guid"]
    spent = actions(spark, folder).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("visits"), F.sum("action_timelong").alias("time_spent")
    )
    current = kept_current(spark, spent, keys, "totals")
    return top_n_per_group(current, ["page_id"], [F.desc("visits"), F.desc("time_spent"), F.asc("guid")], 4)


@query(
    "join_interval_stream",
    action_sql("""
    SELECT a.guid AS guid, a.log_id AS buy_id, b.log_id AS click_id
    FROM action_event a JOIN action_event b ON a.guid = b.guid AND a.event_id = 'purchase' AND b.event_id = 'click'
      AND a.ts BETWEEN b.ts AND b.ts + INTERVAL 6 HOUR"""),
)
def join_interval_stream(spark, folder):
    """Purchases with the clicks of the six hours before, stream to stream."""
    rows = actions(spark, folder)
    buys = rows.where("event_id = 'purchase'").select("guid", F.col("log_id").alias("buy_id"), "ts")
    clicks = rows.where("event_id = 'click'").select("guid", F.col("log_id").alias("click_id"), "ts")
    pairs = O.interval_join(
        with_event_time(buys, "ts", "1 hour", "buy_rt").drop("ts"),
        with_event_time(clicks, "ts", "1 hour", "click_rt").drop("ts"),
        ["guid"], "buy_rt", "click_rt", 6 * HOUR,
    )
    return appended(spark, pairs.select("guid", "buy_id", "click_id"), "pairs")


@query(
    "join_window_stream",
    action_sql("""
    SELECT time_bucket(INTERVAL 1 hour, a.ts) AS window_start, time_bucket(INTERVAL 1 hour, a.ts) + INTERVAL 1 hour AS window_end,
           a.guid, a.log_id AS click_id, b.log_id AS buy_id
    FROM action_event a JOIN action_event b ON a.guid = b.guid AND a.event_id = 'click' AND b.event_id = 'purchase'
      AND time_bucket(INTERVAL 1 hour, a.ts) = time_bucket(INTERVAL 1 hour, b.ts)"""),
)
def join_window_stream(spark, folder):
    """Clicks and purchases of a user in the same hour, stream to stream."""
    rows = actions(spark, folder)
    clicks = rows.where("event_id = 'click'").select("guid", F.col("log_id").alias("click_id"), "ts")
    buys = rows.where("event_id = 'purchase'").select("guid", F.col("log_id").alias("buy_id"), "ts")
    joined = O.window_join(
        with_event_time(clicks, "ts", "1 hour", "click_rt").drop("ts"),
        with_event_time(buys, "ts", "1 hour", "buy_rt").drop("ts"),
        ["guid"], "click_rt", "buy_rt", "1 hour",
    )
    return appended(spark, joined, "same-hour")


@query("join_lookup_stream", ORACLES["join_lookup_left"])
def join_lookup_stream(spark, folder):
    """Events with the customer record current when they are read."""
    dimension = table(spark, folder, "customer").where("c_mktsegment <> 'BUILDING'").select(
        F.col("c_custkey").alias("user_id"), "c_name", "c_mktsegment"
    )
    rows = table_stream(spark, folder, "events").select("event_id", "user_id")
    return appended(spark, rows.join(dimension, "user_id", "left").select("event_id", "user_id", "c_name", "c_mktsegment"), "looked-up")


@query(
    "set_union_stream_live",
    action_sql("""SELECT log_id, guid, event_id FROM action_event WHERE event_id IN ('click', 'error')"""),
)
def set_union_stream_live(spark, folder):
    """Two streams of one type as one."""
    rows = actions(spark, folder).select("log_id", "guid", "event_id")
    return appended(spark, rows.where("event_id = 'click'").unionByName(rows.where("event_id = 'error'")), "union")


def _running(rows, keys, output, *values):
    return K.in_order(rows, keys, ORDER, "0 seconds", output, K.RunningValues, list(values))


@query("running_count_stream", ORACLES["running_count"])
def running_count_stream(spark, folder):
    """Running counts in Spark's state store, over runs."""

    def counted(rows):
        ready = rows.select("channel", *ORDER, F.lit(1).alias("one"), F.col("event_id").eqNullSafe("view").cast("int").alias("view"))
        return _running(
            ready, ["channel"], "log_id BIGINT, cnt BIGINT, views BIGINT", K.Value("cnt", "sum", "one"), K.Value("views", "sum", "view")
        )

    return appended_in_parts(spark, folder, "counts", counted)


def _summed_up(rows):
    ready = rows.select("guid", *ORDER, F.col("action_timelong").alias("value"))
    return _running(ready, ["guid"], "log_id BIGINT, total BIGINT", K.Value("total", "sum", "value"))


@query("running_sum_stream", ORACLES["running_sum"])
def running_sum_stream(spark, folder):
    """Running sums in Spark's state store, over runs."""
    return appended_in_parts(spark, folder, "sums", _summed_up)


@query("st_recovery", ORACLES["running_sum"])
def st_recovery(spark, folder):
    """Running sums of a stream that fails while it writes its second batch, and goes on from the checkpoint."""
    base, failed = scratch_folder(spark, "recovered"), []

    def write(batch, number):
        append_batch(batch, f"{base}/rows", number)
        if number > 1 and not failed:
            failed.append(number)
            raise RuntimeError("stopped after the write, before the state was committed")

    for events in parts_of(spark, folder, base):
        try:
            each_batch(_summed_up(action_event(events)), write, f"{base}/checkpoint", "append", keyed=True)
        except StreamingQueryException:
            each_batch(_summed_up(action_event(events)), write, f"{base}/checkpoint", "append", keyed=True)
    return read_batches(spark, f"{base}/rows")


@query("st_restart_source", action_sql("SELECT log_id, guid FROM action_event"))
def st_restart_source(spark, folder):
    """A source that goes on from its committed offsets: started three times, read once."""
    base = scratch_folder(spark, "offsets")
    rows = actions(spark, folder).select("log_id", "guid")
    for _ in range(3):
        append_to(rows, f"{base}/rows", f"{base}/checkpoint")
    return spark.read.schema(rows.schema).parquet(f"{base}/rows")


@query(
    "running_count_state",
    action_sql("SELECT channel, event_id, count(*) AS cnt FROM action_event GROUP BY ALL"),
)
def running_count_state(spark, folder):
    """Counts per channel and event in user-defined state."""
    keys = ["channel", "event_id"]
    counted = O.counts_in_state(actions(spark, folder), keys, "channel STRING, event_id STRING", "cnt", "log_id")
    return kept_current(spark, counted, [*keys, "part"], "state").groupBy(*keys).agg(F.sum("cnt").alias("cnt"))


@query("st_pattern_ttl_stream", ORACLES["st_pattern_ttl"])
def st_pattern_ttl_stream(spark, folder):
    """The view, click, purchase pattern in state that is gone a day after a user's last view."""
    return appended_in_parts(
        spark, folder, "pattern",
        lambda rows: K.in_order(
            rows.where("guid IS NOT NULL").select("guid", *ORDER, "event_id"), ["guid"], ORDER, "0 seconds", "log_id BIGINT, guid BIGINT",
            K.SequenceWithin, "event_id", "view", "click", "purchase", DAY,
        ),
    )


@query("st_value_ttl_stream", ORACLES["st_value_ttl"])
def st_value_ttl_stream(spark, folder):
    """The counter in state that is gone three hours after a user's last row."""
    return appended_in_parts(
        spark, folder, "counter",
        lambda rows: K.in_order(
            rows.select("guid", *ORDER), ["guid"], ORDER, "0 seconds", "log_id BIGINT, cnt BIGINT",
            K.ExpiringCounter, 3 * HOUR, "cnt",
        ),
    )


@query(
    "st_timer_alert_stream",
    f"SELECT * FROM ({ORACLES['st_timer_alert']}) WHERE alert_time <= (SELECT epoch_ms(max(ts)) FROM events)",
)
def st_timer_alert_stream(spark, folder):
    """Timers five seconds after each error, set in one run and gone off in it or in a later one."""
    return appended_in_parts(
        spark, folder, "due",
        lambda rows: K.due_alerts(
            rows.withColumn("failed", F.col("event_id") == "error"), ["guid"], "action_time", "failed", 5000, "0 seconds"
        ),
    )


@query(
    "st_timer_cancel_stream",
    f"SELECT * FROM ({ORACLES['st_timer_cancel']}) WHERE alert_time < (SELECT epoch_ms(max(ts)) FROM events)",
)
def st_timer_cancel_stream(spark, folder):
    """A timer an hour after each click, moved or deleted by what follows, also in a later run."""
    return appended_in_parts(
        spark, folder, "silence",
        lambda rows: K.silence_alerts(
            rows.select("guid", *ORDER, (F.col("event_id") == "click").alias("clicked")),
            ["guid"], ORDER, "clicked", HOUR, "0 seconds",
        ),
    )


@query(
    "st_silence_session_stream",
    f"SELECT guid, action_time, log_id FROM ({ORACLES['st_timer_cancel']}) WHERE make_timestamp((action_time + {HOUR} + 1) * 1000) <= (SELECT max(ts) - INTERVAL 1 millisecond FROM events)",
)
def st_silence_session_stream(spark, folder):
    """The same alerts without timers, as the ends of activity sessions."""
    rows = actions(spark, folder).select("guid", *ORDER, "event_id", F.timestamp_millis("action_time").alias("moment"))
    marked = with_event_time(rows, "moment", "0 seconds")
    ended = O.silence(marked, "rt", ["guid"], ORDER, HOUR, "event_id")
    return appended(spark, ended, "silence").where("event_id = 'click'").drop("event_id")


def _summed(name: str = "total"):
    def function(rows, window):
        spent = rows.groupby(window)["action_timelong"]
        return pd.DataFrame({name: spent.sum(min_count=1), "held": spent.size()}).reset_index()

    return function


@query("win_count_tumble_stream", ORACLES["win_count_tumble"])
def win_count_tumble_stream(spark, folder):
    """Action time of each five rows of a channel, the rows of an unfinished window kept from run to run."""
    return appended_in_parts(
        spark, folder, "fives",
        lambda rows: K.row_windows(
            rows.select("channel", *ORDER, "action_timelong"), ["channel"], ORDER, "0 seconds",
            "channel STRING, window_no BIGINT, total BIGINT", "window_no", _summed(), K.CountTumble, size=5,
        ),
    )


@query("win_trigger_evict_stream", ORACLES["win_trigger_evict"])
def win_trigger_evict_stream(spark, folder):
    """A window that fires every two rows and keeps the newest four, across runs."""
    return appended_in_parts(
        spark, folder, "evicted",
        lambda rows: K.row_windows(
            rows.select("channel", *ORDER, "action_timelong"), ["channel"], ORDER, "0 seconds",
            "channel STRING, firing BIGINT, total BIGINT, held BIGINT", "firing", _summed(), K.CountSlide,
            fire_every=2, keep_last=4,
        ),
    )


@query(
    "win_marker_trigger_stream",
    action_sql("""
    WITH marked AS (SELECT *, coalesce(count(*) FILTER (WHERE event_id = 'purchase') OVER
           (PARTITION BY guid ORDER BY action_time, log_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS window_no FROM action_event),
         placed AS (SELECT *, row_number() OVER (PARTITION BY guid, window_no ORDER BY action_time DESC, log_id DESC) AS place,
           max(CASE WHEN event_id = 'purchase' THEN 1 ELSE 0 END) OVER (PARTITION BY guid, window_no) AS fired FROM marked)
    SELECT guid, window_no, string_agg(event_id, ':' ORDER BY place DESC) AS joined FROM placed
    WHERE fired = 1 AND place <= 5 GROUP BY guid, window_no"""),
)
def win_marker_trigger_stream(spark, folder):
    """Windows of a user that a purchase closes, each giving its newest five events, across runs."""

    def joined(rows, window):
        # One call per user and batch, for a few rows: plain lists take a third of the time of a grouped frame.
        texts = {}
        for number, kind in zip(rows[window].tolist(), rows["event_id"].tolist()):
            if kind is not None:
                texts.setdefault(number, []).append(kind)
        return pd.DataFrame({window: list(texts), "joined": [":".join(t) for t in texts.values()]})

    return appended_in_parts(
        spark, folder, "marked",
        lambda rows: K.row_windows(
            rows.select("guid", *ORDER, "event_id", F.col("event_id").eqNullSafe("purchase").alias("closes")),
            ["guid"], ORDER, "0 seconds", "guid BIGINT, window_no BIGINT, joined STRING", "window_no", joined,
            K.MarkerWindows, marker="closes", keep_last=5,
        ),
    )


@query(
    "join_temporal_stream",
    f"SELECT j.* FROM ({ORACLES['join_temporal']}) j JOIN events ON event_id = log_id WHERE ts <= (SELECT max(ts) FROM events)",
)
def join_temporal_stream(spark, folder):
    """Purchases with the page the user had viewed last by then, each held until no older view can come."""

    def joined(rows):
        buys = rows.where("event_id = 'purchase'").select("guid", *ORDER)
        views = rows.where("event_id = 'view'").select(
            "guid", F.col("action_time").alias("seen_at"), F.col("log_id").alias("seen_id"), F.col("page_id").alias("seen_page")
        )
        found = K.as_of_join(buys, views, ["guid"], ORDER, ["seen_at", "seen_id"], ["seen_at", "seen_page"], "0 seconds")
        return found.select("log_id", "guid", "seen_at", "seen_page")

    return appended_in_parts(spark, folder, "as-of", joined)


@query(
    "join_broadcast_stream",
    action_sql("""
    WITH parted AS (SELECT *, CASE WHEN day(ts) <= 9 THEN 0 WHEN day(ts) <= 20 THEN 1 ELSE 2 END AS part FROM action_event),
         signups AS (SELECT *, coalesce(lead(part) OVER (PARTITION BY guid ORDER BY action_time, log_id), 3) AS until
                     FROM parted WHERE event_id = 'signup')
    SELECT a.log_id, a.guid, n.page_id AS last_page FROM parted a
    LEFT JOIN signups n ON a.guid = n.guid AND a.part >= n.part AND a.part < n.until WHERE a.event_id = 'view'"""),
)
def join_broadcast_stream(spark, folder):
    """Views with the newest signup of the user, from a dimension that a second stream moves on between batches."""
    base, dimension = scratch_folder(spark, "running"), None
    for events in parts_of(spark, folder, base):
        rows = action_event(events)
        updates = rows.where("event_id = 'signup'").select("guid", F.col("page_id").alias("last_page"), *ORDER)
        dimension = dimension or RunningDimension(spark, f"{base}/dimension", ["guid"], ORDER, updates.schema)
        each_batch(updates, dimension.update, f"{base}/updates", "append")
        views = rows.where("event_id = 'view'").select("log_id", "guid")
        each_batch(views, dimension.lookup(f"{base}/rows", f"{base}/pins"), f"{base}/checkpoint", "append")
    return read_batches(spark, f"{base}/rows")


@query(
    "out_changelog_stream",
    action_sql("""
    WITH n AS (SELECT channel, event_id, count(*) FILTER (WHERE day(ts) <= 9) AS a,
                      count(*) FILTER (WHERE day(ts) <= 20) AS b, count(*) AS c FROM action_event GROUP BY ALL),
         steps AS (SELECT channel, event_id, 0 AS old, a AS new FROM n UNION ALL SELECT channel, event_id, a, b FROM n
                   UNION ALL SELECT channel, event_id, b, c FROM n)
    SELECT channel, event_id, CASE WHEN old = 0 THEN '+I' ELSE '+U' END AS op, new AS cnt FROM steps WHERE new > old
    UNION ALL SELECT channel, event_id, '-U', old FROM steps WHERE new > old AND old > 0"""),
)
def out_changelog_stream(spark, folder):
    """Changes of a grouped count over three batches, the counts in Spark's state store."""
    keys = ["channel", "event_id"]
    return appended_in_parts(
        spark, folder, "feed",
        lambda rows: K.in_order(
            rows.select(*keys, *ORDER), keys, ORDER, "0 seconds", "channel STRING, event_id STRING, op STRING, cnt BIGINT",
            K.CountChanges, "cnt",
        ),
    )


@query("out_changelog_rows_stream", ORACLES["out_changelog_rows"])
def out_changelog_rows_stream(spark, folder):
    """Row-by-row changes of the running count, the count in Spark's state store."""

    def changed(rows):
        ready = rows.select("guid", *ORDER, F.lit(1).alias("one"))
        counted = _running(
            ready, ["guid"], "guid BIGINT, action_time BIGINT, log_id BIGINT, cnt BIGINT", K.Value("cnt", "sum", "one")
        )
        return C.count_changes(counted, "cnt")

    return appended_in_parts(spark, folder, "changes", changed)


@query("dw_session_split_stream", ORACLES["dw_session_split"])
def dw_session_split_stream(spark, folder):
    """Sessions split while the stream runs, each user's visit in Spark's state store."""
    base, schema = scratch_folder(spark, "visits"), None
    for events in parts_of(spark, folder, base):
        split = V.split_sessions_stream(warehouse.visits_of(app_log(events)), "0 seconds")
        schema = split.schema
        append_to(split, f"{base}/rows", f"{base}/checkpoint", keyed=True)
    return spark.read.schema(schema).parquet(f"{base}/rows")


@query("sink_two_phase", action_sql("SELECT guid, count(*) AS cnt, CAST(sum(action_timelong) AS BIGINT) AS total FROM action_event GROUP BY guid"))
def sink_two_phase(spark, folder):
    """Rows through a sink whose tasks stage files that a commit publishes, started anew for each part."""
    base = scratch_folder(spark, "committed")
    for events in parts_of(spark, folder, base):
        rows = action_event(events).select("guid", "action_timelong")
        commit_to(rows, f"{base}/table", f"{base}/checkpoint")
    return read_committed(spark, f"{base}/table", rows.schema).groupBy("guid").agg(*_counts())


@query(
    "src_watch_changed",
    action_sql("""SELECT log_id, count(*) AS times FROM (
      SELECT log_id FROM action_event WHERE day(ts) <= 9 UNION ALL SELECT log_id FROM action_event WHERE day(ts) <= 20) GROUP BY log_id"""),
)
def src_watch_changed(spark, folder):
    """A folder whose files are replaced by longer ones between two runs: what changed is read again, whole."""
    base = scratch_folder(spark, "changing")
    rows = action_event(table(spark, folder, "events"))
    for last_day in (9, 20):
        rows.where(F.day("ts") <= last_day).select(F.col("log_id").cast("string")).write.mode("overwrite").text(f"{base}/in")
        for _ in range(2):
            append_to(watch_changing_lines(spark, f"{base}/in"), f"{base}/rows", f"{base}/checkpoint")
    lines = spark.read.schema("value string").parquet(f"{base}/rows")
    return lines.groupBy(F.col("value").cast("long").alias("log_id")).agg(F.count("*").alias("times"))


@query(
    "sink_exactly_once",
    action_sql("SELECT guid, count(*) AS cnt, CAST(sum(action_timelong) AS BIGINT) AS total FROM action_event GROUP BY guid"),
)
def sink_exactly_once(spark, folder):
    """Rows through a batch sink that fails once after it has written: none lost, none twice."""
    base, failed = scratch_folder(spark, "once"), []

    def write(batch, number):
        append_batch(batch, f"{base}/rows", number)
        if number == 1 and not failed:
            failed.append(number)
            raise RuntimeError("stopped after the write, before the batch was committed")

    for events in parts_of(spark, folder, base):
        rows = action_event(events).select("guid", "action_timelong")
        try:
            each_batch(rows, write, f"{base}/checkpoint", "append")
        except StreamingQueryException:
            each_batch(rows, write, f"{base}/checkpoint", "append")
    return read_batches(spark, f"{base}/rows").groupBy("guid").agg(*_counts())
