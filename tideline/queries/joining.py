"""Join, union and per-key state queries."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline.functions.timing import bucket, local_time
from tideline.operators import changes as C
from tideline.operators import joins as J
from tideline.operators import state as S
from tideline.operators.rows import complete_rows, parse_delimited
from tideline.plans.orders import cents
from tideline.queries.registry import query
from tideline.queries.relational import DAY, HOUR, action_sql, actions
from tideline.queries.views import ACTION_EVENT, ORDER_CHANGES, with_views
from tideline.sources.behaviour import order_changes
from tideline.sources.tables import table

ORDER = ["action_time", "log_id"]

# Regular joins: customers against the action totals of the user with the same number.

_SIDES = """
totals AS (SELECT guid, CAST(sum(action_timelong) AS BIGINT) AS total FROM action_event GROUP BY guid),
people AS (SELECT c_custkey, c_mktsegment FROM customer)"""


def _sides(spark, folder):
    rows, customers = actions(spark, folder), table(spark, folder, "customer")
    return customers.select("c_custkey", "c_mktsegment"), rows.groupBy("guid").agg(F.sum("action_timelong").alias("total"))


def _regular(how: str, sql_how: str, doc: str):
    @query(
        f"join_{how}",
        with_views(
            f"SELECT c_custkey, c_mktsegment, guid, total FROM people {sql_how} JOIN totals ON c_custkey = guid",
            ACTION_EVENT, _SIDES,
        ),
    )
    def run(spark, folder):
        people, totals = _sides(spark, folder)
        return people.join(totals, people.c_custkey == totals.guid, how)

    run.__doc__ = doc


_regular("inner", "INNER", "Only matching rows.")
_regular("left", "LEFT", "All customers, with totals where there are any.")
_regular("right", "RIGHT", "All totals, with the customer where there is one.")
_regular("full", "FULL", "All rows of both sides.")


def _of(spark, folder, event, prefix):
    rows = actions(spark, folder).where(F.col("event_id") == event)
    return rows.select(
        "guid", F.col("action_time").alias(f"{prefix}_time"), F.col("log_id").alias(f"{prefix}_id"),
        F.col("page_id").alias(f"{prefix}_page"),
    )


@query(
    "join_interval",
    action_sql(f"""
    SELECT a.guid, a.log_id AS buy_id, b.log_id AS click_id, a.action_time - b.action_time AS gap
    FROM action_event a JOIN action_event b ON a.guid = b.guid AND a.event_id = 'purchase' AND b.event_id = 'click'
      AND a.action_time BETWEEN b.action_time AND b.action_time + {6 * HOUR}"""),
)
def join_interval(spark, folder):
    """Purchases with the clicks of the six hours before."""
    pairs = J.interval_join(
        _of(spark, folder, "purchase", "buy"), _of(spark, folder, "click", "click"), ["guid"],
        "buy_time", "click_time", 0, 6 * HOUR,
    )
    return pairs.select("guid", "buy_id", "click_id", (F.col("buy_time") - F.col("click_time")).alias("gap"))


@query(
    "join_interval_mirror",
    action_sql(f"""
    SELECT a.guid, a.log_id AS buy_id, b.log_id AS click_id, b.action_time - a.action_time AS gap
    FROM action_event a JOIN action_event b ON a.guid = b.guid AND a.event_id = 'purchase' AND b.event_id = 'click'
      AND a.action_time BETWEEN b.action_time - {6 * HOUR} AND b.action_time"""),
)
def join_interval_mirror(spark, folder):
    """Purchases with the clicks of the six hours after."""
    pairs = J.interval_join(
        _of(spark, folder, "purchase", "buy"), _of(spark, folder, "click", "click"), ["guid"],
        "buy_time", "click_time", -6 * HOUR, 0,
    )
    return pairs.select("guid", "buy_id", "click_id", (F.col("click_time") - F.col("buy_time")).alias("gap"))


_WINDOW_SIDES = f"""
lefts AS (SELECT guid, log_id AS click_id, action_time // {DAY} AS d FROM action_event WHERE event_id = 'click'),
rights AS (SELECT guid, log_id AS buy_id, d FROM (SELECT *, action_time // {DAY} AS d,
    row_number() OVER (PARTITION BY guid, action_time // {DAY} ORDER BY action_time DESC, log_id DESC) AS rn
  FROM action_event WHERE event_id = 'purchase') WHERE rn = 1)"""


def _window_pairs(spark, folder):
    """Clicks with the user's newest purchase of the same day."""
    buys = _of(spark, folder, "purchase", "buy").withColumn("day", bucket(F.col("buy_time"), DAY))
    newest = J.newest_per_key(buys, ["guid", "day"], ["buy_time", "buy_id"]).drop("day", "buy_page")
    clicks = _of(spark, folder, "click", "click")
    return J.window_join(clicks, newest, ["guid"], "click_time", "buy_time", DAY)


@query(
    "join_window",
    with_views(
        f"""SELECT l.guid, l.click_id, r.buy_id, make_timestamp(l.d * {DAY * 1000}) AS window_start,
              make_timestamp((l.d + 1) * {DAY * 1000}) AS window_end
            FROM lefts l JOIN rights r ON l.guid = r.guid AND l.d = r.d""",
        ACTION_EVENT, _WINDOW_SIDES,
    ),
)
def join_window(spark, folder):
    """Two streams joined inside one-day windows."""
    return _window_pairs(spark, folder).select(
        "guid", "click_id", "buy_id",
        local_time(F.col("window_start")).alias("window_start"), local_time(F.col("window_end")).alias("window_end"),
    )


@query(
    "join_window_flat",
    with_views(
        """SELECT l.guid, n || ':' || l.click_id || ',' || r.buy_id AS message
           FROM lefts l JOIN rights r ON l.guid = r.guid AND l.d = r.d, (SELECT unnest([1, 2]) AS n)""",
        ACTION_EVENT, _WINDOW_SIDES,
    ),
)
def join_window_flat(spark, folder):
    """The same join giving two rows per pair."""
    numbered = _window_pairs(spark, folder).withColumn("n", F.explode(F.array(F.lit(1), F.lit(2))))
    return numbered.select("guid", F.format_string("%d:%d,%d", "n", "click_id", "buy_id").alias("message"))


@query(
    "join_temporal",
    action_sql("""
    WITH buys AS (SELECT * FROM action_event WHERE event_id = 'purchase'),
         versions AS (SELECT guid, action_time AS seen_at, page_id AS seen_page FROM action_event WHERE event_id = 'view')
    SELECT b.log_id, b.guid, v.seen_at, v.seen_page
    FROM buys b ASOF LEFT JOIN versions v ON b.guid = v.guid AND b.action_time >= v.seen_at"""),
)
def join_temporal(spark, folder):
    """Purchases with the page the user had viewed last by then."""
    rows = actions(spark, folder)
    buys = rows.where("event_id = 'purchase'").select("guid", *ORDER)
    versions = rows.where("event_id = 'view'").select(
        "guid", F.col("action_time").alias("seen_at"), F.col("log_id").alias("seen_id"), F.col("page_id").alias("seen_page")
    )
    joined = J.as_of_join(buys, versions, ["guid"], ORDER, ["seen_at", "seen_id"], ["seen_at", "seen_page"])
    return joined.select("log_id", "guid", "seen_at", "seen_page")


@query(
    "join_lookup",
    "SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, p_name, p_type FROM lineitem JOIN part ON p_partkey = l_partkey",
)
def join_lookup(spark, folder):
    """Item rows with the product they name."""
    products = table(spark, folder, "part").select(F.col("p_partkey").alias("l_partkey"), "p_name", "p_type")
    rows = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    return J.lookup_join(rows, products, ["l_partkey"])


@query(
    "join_lookup_left",
    """SELECT event_id, user_id, c_name, c_mktsegment FROM events
       LEFT JOIN (SELECT * FROM customer WHERE c_mktsegment <> 'BUILDING') ON c_custkey = user_id""",
)
def join_lookup_left(spark, folder):
    """Events with the customer record, where one is in the dimension."""
    dimension = table(spark, folder, "customer").where("c_mktsegment <> 'BUILDING'").select(
        F.col("c_custkey").alias("user_id"), "c_name", "c_mktsegment"
    )
    rows = table(spark, folder, "events").select("event_id", "user_id")
    return J.lookup_join(rows, dimension, ["user_id"], "left")


@query(
    "join_broadcast",
    action_sql("""
    WITH newest AS (SELECT guid, page_id AS last_page FROM (SELECT *, row_number() OVER (PARTITION BY guid ORDER BY action_time DESC, log_id DESC) AS rn
                    FROM action_event WHERE event_id = 'signup') WHERE rn = 1)
    SELECT a.log_id, a.guid, n.last_page FROM action_event a LEFT JOIN newest n ON a.guid = n.guid WHERE a.event_id = 'view'"""),
)
def join_broadcast(spark, folder):
    """Views with the newest dimension update of the user; none gives null."""
    rows = actions(spark, folder)
    updates = rows.where("event_id = 'signup'").select("guid", F.col("page_id").alias("last_page"), *ORDER)
    views = rows.where("event_id = 'view'").select("log_id", "guid")
    return J.latest_dimension_join(views, updates, ["guid"], ORDER)


@query(
    "cogroup_window",
    action_sql(f"""
    SELECT make_timestamp(action_time // {DAY} * {DAY * 1000}) AS day, guid,
           nullif(count(*) FILTER (WHERE event_id = 'click'), 0) AS clicks,
           nullif(count(*) FILTER (WHERE event_id = 'purchase'), 0) AS buys,
           CAST(sum(action_timelong) FILTER (WHERE event_id = 'purchase') AS BIGINT) AS buy_total
    FROM action_event WHERE event_id IN ('click', 'purchase') GROUP BY ALL"""),
)
def cogroup_window(spark, folder):
    """Clicks and purchases of a user and day side by side."""
    rows = actions(spark, folder).withColumn("day", F.window("ts", "1 day")["start"])
    return J.co_group(
        rows.where("event_id = 'click'"), rows.where("event_id = 'purchase'"), ["day", "guid"],
        [F.count(F.lit(1)).alias("clicks")],
        [F.count(F.lit(1)).alias("buys"), F.sum("action_timelong").alias("buy_total")],
    )


@query(
    "set_union_stream",
    action_sql("""SELECT log_id, guid, event_id FROM action_event WHERE event_id = 'click'
                  UNION ALL SELECT log_id, guid, event_id FROM action_event WHERE event_id IN ('click', 'view')"""),
)
def set_union_stream(spark, folder):
    """Two inputs of one type, one after the other, nothing removed."""
    rows = actions(spark, folder).select("log_id", "guid", "event_id")
    return rows.where("event_id = 'click'").unionByName(rows.where("event_id IN ('click', 'view')"))


@query(
    "connect_comap",
    action_sql("""SELECT guid AS id, event_id AS name, channel AS gender, CAST(action_timelong AS DOUBLE) AS score
                  FROM action_event WHERE event_id IN ('click', 'view') AND action_timelong > 6000"""),
)
def connect_comap(spark, folder):
    """Two inputs in different encodings, parsed to one type, then filtered."""
    schema = T.StructType.fromDDL("id BIGINT, name STRING, gender STRING, score DOUBLE")
    fields = ["guid", "event_id", "channel", "action_timelong"]
    rows = actions(spark, folder)

    def parsed(event: str, separator: str):
        lines = rows.where(F.col("event_id") == event).select(F.concat_ws(separator, *fields).alias("value"))
        return complete_rows(parse_delimited(lines, "value", schema, separator))

    return parsed("click", ",").unionByName(parsed("view", ":")).where("score > 6000")


# Per-key state


def pattern_job():
    job = S.sequence_within(["guid"], ORDER, "event_id", "view", "click", "purchase", DAY)
    return replace(job, finish=lambda rows: job.finish(rows).select("log_id", "guid"))


@query(
    "st_pattern_ttl",
    action_sql(f"""
    SELECT d.log_id, d.guid FROM action_event d WHERE d.event_id = 'purchase' AND EXISTS (
      SELECT 1 FROM action_event b JOIN action_event h ON b.guid = h.guid
      WHERE b.guid = d.guid AND b.event_id = 'view' AND h.event_id = 'click'
        AND (b.action_time, b.log_id) < (h.action_time, h.log_id)
        AND (h.action_time, h.log_id) < (d.action_time, d.log_id) AND b.action_time > d.action_time - {DAY})"""),
)
def st_pattern_ttl(spark, folder):
    """Purchases after a view and then a click, all within a day."""
    rows = actions(spark, folder).select("guid", *ORDER, "event_id")
    return pattern_job().over(rows)


@query(
    "st_value_ttl",
    action_sql(f"""
    WITH gaps AS (SELECT *, CASE WHEN action_time - lag(action_time) OVER w < {3 * HOUR} THEN 0 ELSE 1 END AS fresh
                  FROM action_event WINDOW w AS (PARTITION BY guid ORDER BY action_time, log_id)),
         islands AS (SELECT *, sum(fresh) OVER (PARTITION BY guid ORDER BY action_time, log_id) AS no FROM gaps)
    SELECT log_id, row_number() OVER (PARTITION BY guid, no ORDER BY action_time, log_id) AS cnt FROM islands"""),
)
def st_value_ttl(spark, folder):
    """Rows of a user since the last three silent hours."""
    rows = actions(spark, folder).select("guid", *ORDER)
    return S.counter_with_expiry(["guid"], ORDER, 3 * HOUR, "cnt").over(rows).select("log_id", "cnt")


@query(
    "st_timer_alert",
    action_sql("SELECT DISTINCT guid, action_time + 5000 AS alert_time FROM action_event WHERE event_id = 'error'"),
)
def st_timer_alert(spark, folder):
    """An alert five seconds after each error."""
    rows = actions(spark, folder)
    return S.delayed_alerts(rows, ["guid"], "action_time", F.col("event_id") == "error", 5000)


@query(
    "st_timer_cancel",
    action_sql(f"""
    SELECT guid, action_time, log_id, action_time + {HOUR} AS alert_time FROM (
      SELECT *, lead(action_time) OVER (PARTITION BY guid ORDER BY action_time, log_id) AS next_time FROM action_event)
    WHERE event_id = 'click' AND (next_time IS NULL OR next_time > action_time + {HOUR})"""),
)
def st_timer_cancel(spark, folder):
    """An alert for a click with nothing after it for an hour."""
    rows = actions(spark, folder).select("guid", *ORDER, "event_id")
    return S.silence_alerts(rows, ["guid"], ORDER, F.col("event_id") == "click", HOUR)


@query(
    "st_first_seen",
    action_sql("""SELECT log_id, CAST(row_number() OVER (PARTITION BY guid ORDER BY action_time, log_id) = 1 AS INTEGER) AS is_first
                  FROM action_event"""),
)
def st_first_seen(spark, folder):
    """Whether a row is its user's first."""
    rows = actions(spark, folder).select("guid", *ORDER)
    return S.mark_first_seen(["guid"], ORDER, "is_first").over(rows).select("log_id", "is_first")


_LATENESS = f"""
arrived AS (SELECT *, action_time + guid % 7 * {HOUR} AS arrival FROM action_event),
replayed AS (SELECT *, max(action_time) OVER (ORDER BY arrival, log_id) - {HOUR} AS mark,
    (action_time // {HOUR} + 1) * {HOUR} AS window_end FROM arrived),
judged AS (SELECT *, CASE WHEN window_end > mark THEN 'on_time' WHEN window_end + {2 * HOUR} > mark THEN 'refire' ELSE 'late' END AS lateness
  FROM replayed)"""


def arrived(rows):
    """Rows with an arrival time up to six hours after the event."""
    arrival = F.col("action_time") + F.col("guid") % 7 * HOUR
    return rows.select("guid", *ORDER, "channel", arrival.alias("arrival"))


def lateness_job():
    return S.lateness(["arrival", "log_id"], "action_time", HOUR, HOUR, 2 * HOUR)


def _judged(spark, folder):
    return lateness_job().over(arrived(actions(spark, folder)))


@query(
    "late_side_output",
    with_views("SELECT log_id, guid, action_time FROM judged WHERE lateness = 'late'", ACTION_EVENT, _LATENESS),
)
def late_side_output(spark, folder):
    """Rows that arrive too late for their hour, kept apart."""
    return _judged(spark, folder).where("lateness = 'late'").select("log_id", "guid", "action_time")


@query(
    "late_allowed",
    with_views(
        f"""SELECT make_timestamp(action_time // {HOUR} * {HOUR * 1000}) AS window_start,
              count(*) FILTER (WHERE lateness = 'on_time') AS on_time, count(*) FILTER (WHERE lateness = 'refire') AS refired
            FROM judged WHERE lateness <> 'late' GROUP BY ALL""",
        ACTION_EVENT, _LATENESS,
    ),
)
def late_allowed(spark, folder):
    """Hourly counts, with the rows that made a closed hour fire again."""
    kept = _judged(spark, folder).where("lateness <> 'late'")
    start = local_time(bucket(F.col("action_time"), HOUR) * F.lit(HOUR))
    return kept.groupBy(start.alias("window_start")).agg(
        F.count_if(F.col("lateness") == "on_time").alias("on_time"),
        F.count_if(F.col("lateness") == "refire").alias("refired"),
    )


# Changes


@query(
    "out_changelog_rows",
    action_sql("""
    WITH counted AS (SELECT guid, action_time, log_id, count(*) OVER (PARTITION BY guid ORDER BY action_time, log_id) AS n FROM action_event)
    SELECT guid, action_time, log_id, '+I' AS op, n AS cnt FROM counted WHERE n = 1
    UNION ALL SELECT guid, action_time, log_id, '-U', n - 1 FROM counted WHERE n > 1
    UNION ALL SELECT guid, action_time, log_id, '+U', n FROM counted WHERE n > 1"""),
)
def out_changelog_rows(spark, folder):
    """The running count per user as inserts and updates, row by row."""
    rows = actions(spark, folder).select("guid", *ORDER, F.lit(1).cast("long").alias("one"))
    return C.running_total_changes(["guid"], ORDER, "one", "cnt").over(rows)


@query(
    "out_changelog",
    action_sql("""
    WITH a AS (SELECT channel, page_id, count(*) AS cnt FROM action_event WHERE day(ts) <= 20 GROUP BY ALL),
         b AS (SELECT channel, page_id, count(*) AS cnt FROM action_event WHERE day(ts) > 10 GROUP BY ALL),
         j AS (SELECT coalesce(a.channel, b.channel) AS channel, coalesce(a.page_id, b.page_id) AS page_id, a.cnt AS old, b.cnt AS new
               FROM a FULL JOIN b ON a.channel = b.channel AND a.page_id = b.page_id)
    SELECT channel, page_id, '+I' AS op, new AS cnt FROM j WHERE old IS NULL
    UNION ALL SELECT channel, page_id, '-D', old FROM j WHERE new IS NULL
    UNION ALL SELECT channel, page_id, '-U', old FROM j WHERE old <> new
    UNION ALL SELECT channel, page_id, '+U', new FROM j WHERE old <> new"""),
)
def out_changelog(spark, folder):
    """The changes between two states of a result table."""
    rows = actions(spark, folder)

    def state(condition: str):
        return rows.where(condition).groupBy("channel", "page_id").agg(F.count(F.lit(1)).alias("cnt"))

    old, new = state("day(ts) <= 20"), state("day(ts) > 10")
    return C.snapshot_changes(old, new, ["channel", "page_id"], ["cnt"])


@query(
    "src_cdc",
    with_views("SELECT op, count(*) AS cnt, round(sum(amount), 2) AS amount FROM order_changes GROUP BY op", ORDER_CHANGES),
)
def src_cdc(spark, folder):
    """The change feed by kind of change."""
    return order_changes(table(spark, folder, "orders")).groupBy("op").agg(
        F.count(F.lit(1)).alias("cnt"), (F.sum(cents(F.col("amount"))) / 100).alias("amount")
    )
