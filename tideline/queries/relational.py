"""Projection, filter, aggregation and ranking queries."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline.functions.timing import bucket, day_of, local_time, not_blank
from tideline.operators import aggregates as A
from tideline.operators.ranking import top_n, top_n_per_group
from tideline.operators.rows import branch, parse_delimited, route, split_rows
from tideline.queries.registry import query
from tideline.queries.views import ACTION_EVENT, APP_LOG, with_views
from tideline.sources.behaviour import action_event, app_log
from tideline.sources.tables import table

HOUR = 3_600_000
DAY = 24 * HOUR


def actions(spark, folder):
    return action_event(table(spark, folder, "events"))


def action_sql(body: str) -> str:
    return with_views(body, ACTION_EVENT)


# Projection and filter


@query(
    "proj_select",
    action_sql("SELECT log_id, channel, page_id, action_timelong / 60.0 AS minutes FROM action_event WHERE event_id <> 'error' AND action_timelong >= 30"),
)
def proj_select(spark, folder):
    """Pick, compute and filter columns."""
    long_enough = (F.col("event_id") != "error") & (F.col("action_timelong") >= 30)
    return actions(spark, folder).where(long_enough).select(
        "log_id", "channel", "page_id", (F.col("action_timelong") / 60.0).alias("minutes")
    )


@query(
    "proj_computed_cols",
    action_sql("""
    SELECT log_id, upper(event_id) AS event_upper, CAST(guid AS VARCHAR) AS guid_text,
           make_timestamp(action_time * 1000) AS action_time_ltz,
           CAST(action_timelong AS DOUBLE) / 100 AS seconds FROM action_event"""),
)
def proj_computed_cols(spark, folder):
    """Computed columns and casts on top of the physical ones."""
    return actions(spark, folder).select(
        "log_id",
        F.upper("event_id").alias("event_upper"),
        F.col("guid").cast("string").alias("guid_text"),
        local_time(F.col("action_time")).alias("action_time_ltz"),
        (F.col("action_timelong").cast("double") / 100).alias("seconds"),
    )


@query(
    "filter_pred",
    action_sql("""
    SELECT log_id, channel, event_id FROM action_event
    WHERE log_id % 2 = 0 AND channel LIKE 'w%' AND action_timelong >= 300 AND event_id <> 'error'
      AND length(trim(page_id)) > 0"""),
)
def filter_pred(spark, folder):
    """Comparison, modulo, prefix, inequality and not-blank tests."""
    return actions(spark, folder).where(
        (F.col("log_id") % 2 == 0)
        & F.col("channel").startswith("w")
        & (F.col("action_timelong") >= 300)
        & (F.col("event_id") != "error")
        & not_blank(F.col("page_id"))
    ).select("log_id", "channel", "event_id")


@query(
    "map_parse",
    action_sql("SELECT guid, event_id, channel, action_time AS ts, action_timelong AS stay_long FROM action_event"),
)
def map_parse(spark, folder):
    """Comma-separated text to a typed row."""
    lines = actions(spark, folder).select(
        F.concat_ws(",", "guid", "event_id", "channel", "action_time", "action_timelong").alias("value")
    )
    schema = T.StructType.fromDDL("guid BIGINT, event_id STRING, channel STRING, ts BIGINT, stay_long BIGINT")
    return parse_delimited(lines, "value", schema, ",")


@query(
    "flatmap_split",
    """SELECT doc_id, part FROM (
         SELECT doc_id, unnest(string_split(text, '. ')) AS part FROM documents)""",
)
def flatmap_split(spark, folder):
    """One row per separated part of a packed record."""
    packed = table(spark, folder, "documents").select("doc_id", F.col("text").alias("part"))
    return split_rows(packed, "part", ". ")


@query(
    "split_by_filter",
    action_sql("""
    SELECT log_id, 'odd' AS branch, guid * 10 AS mapped FROM action_event WHERE guid % 2 = 1
    UNION ALL SELECT log_id, 'even', guid * 100 FROM action_event WHERE guid % 2 = 0"""),
)
def split_by_filter(spark, folder):
    """Filtered branches of one input, each mapped in its own way."""
    rows = actions(spark, folder)
    odd = rows.where("guid % 2 = 1").select("log_id", F.lit("odd").alias("branch"), (F.col("guid") * 10).alias("mapped"))
    even = rows.where("guid % 2 = 0").select("log_id", F.lit("even").alias("branch"), (F.col("guid") * 100).alias("mapped"))
    return odd.unionByName(even)


@query(
    "split_side_output",
    action_sql("""
    SELECT 'main' AS output, count(*) AS cnt, CAST(sum(action_timelong) AS BIGINT) AS total FROM action_event
      WHERE event_id NOT IN ('error', 'signup')
    UNION ALL SELECT 'error', count(*), NULL FROM action_event WHERE event_id = 'error'
    UNION ALL SELECT 'signup', count(DISTINCT guid), NULL FROM action_event WHERE event_id = 'signup'"""),
)
def split_side_output(spark, folder):
    """Rows routed to a main output and two tagged ones of other shapes."""
    routed = route(
        actions(spark, folder),
        {"error": F.col("event_id") == "error", "signup": F.col("event_id") == "signup"},
        otherwise="main",
    )
    none = F.lit(None).cast("long").alias("total")
    main = branch(routed, "main").agg(F.count(F.lit(1)).alias("cnt"), F.sum("action_timelong").alias("total"))
    errors = branch(routed, "error").agg(F.count(F.lit(1)).alias("cnt"))
    signups = branch(routed, "signup").agg(F.count_distinct("guid").alias("cnt"))
    return (
        main.select(F.lit("main").alias("output"), "cnt", "total")
        .unionByName(errors.select(F.lit("error").alias("output"), "cnt", none))
        .unionByName(signups.select(F.lit("signup").alias("output"), "cnt", none))
    )


_QUALITY = """trim(deviceid) <> '' AND trim(eventid) <> '' AND timestamp > 1000000000000 AND page IS NOT NULL"""


@query(
    "filter_quality",
    with_views(f"SELECT log_id, CASE WHEN {_QUALITY} THEN 'kept' ELSE 'rejected' END AS outcome FROM app_log", APP_LOG),
)
def filter_quality(spark, folder):
    """The gate of the cleaning job, with the rejected rows kept apart."""
    from tideline.plans.detail import passes_gate

    logs = app_log(table(spark, folder, "events"))
    return route(logs, {"kept": passes_gate()}, "rejected", "outcome").select("log_id", "outcome")


@query(
    "with_cte",
    action_sql("""
    WITH per_user AS (SELECT channel, guid, sum(action_timelong) AS total FROM action_event GROUP BY channel, guid),
         best AS (SELECT channel, max(total) AS total FROM per_user GROUP BY channel)
    SELECT p.channel, p.guid, CAST(p.total AS BIGINT) AS total
    FROM per_user p JOIN best b ON p.channel = b.channel AND p.total = b.total"""),
)
def with_cte(spark, folder):
    """Named steps in one SQL statement, run by Spark SQL over a view."""
    return spark.sql(
        """
        WITH per_user AS (
          SELECT channel, guid, sum(action_timelong) AS total FROM {action_event} GROUP BY channel, guid),
        best AS (SELECT channel, max(total) AS total FROM per_user GROUP BY channel)
        SELECT p.channel, p.guid, p.total FROM per_user p JOIN best b ON p.channel = b.channel AND p.total = b.total
        """,
        action_event=actions(spark, folder),
    )


@query(
    "temp_views",
    action_sql("SELECT channel, event_id, count(*) AS cnt FROM action_event GROUP BY channel, event_id"),
)
def temp_views(spark, folder):
    """A view registered once, read by a second view and a query; both names go when the query is made."""
    first, second = (f"tideline_{uuid.uuid4().hex}" for _ in range(2))
    actions(spark, folder).createOrReplaceTempView(first)
    spark.sql(f"SELECT channel, event_id FROM {first}").createOrReplaceTempView(second)
    counted = spark.sql(f"SELECT channel, event_id, count(*) AS cnt FROM {second} GROUP BY channel, event_id")
    for name in (first, second):
        spark.catalog.dropTempView(name)
    return counted


@query(
    "fn_scalar_suite",
    action_sql("""
    SELECT log_id, upper(channel) AS up, guid || '-' || event_id AS joined, substr(page_id, 3, 2) AS piece,
      guid || ':' || event_id || '/' || channel AS formatted,
      CASE WHEN event_id = 'view' THEN 1 ELSE 0 END AS is_view,
      coalesce(CASE WHEN event_id = 'error' THEN NULL ELSE event_id END, 'none') AS filled,
      strftime(make_timestamp(action_time * 1000), '%Y-%m-%d') AS day_text,
      CAST(make_timestamp(action_time * 1000) AS DATE) AS day,
      CAST(make_timestamp(action_time * 1000) AS DATE) - 1 AS day_before,
      CAST(make_timestamp(action_time * 1000) AS DATE) = DATE '2024-01-15' AS same_day,
      page_id AS looked_up, '{"pageId":"' || page_id || '"}' AS props_json,
      '{"guid":' || guid || ',"channel":"' || channel || '"}' AS row_json
    FROM action_event"""),
)
def fn_scalar_suite(spark, folder):
    """Every scalar function in use, over each row."""
    from tideline.functions.timing import same_day

    time = F.col("action_time")
    props = F.create_map(F.lit("pageId"), F.col("page_id"))
    return actions(spark, folder).select(
        "log_id",
        F.upper("channel").alias("up"),
        F.concat_ws("-", "guid", "event_id").alias("joined"),
        F.substring("page_id", 3, 2).alias("piece"),
        F.format_string("%d:%s/%s", "guid", "event_id", "channel").alias("formatted"),
        F.when(F.col("event_id") == "view", 1).otherwise(0).alias("is_view"),
        F.coalesce(F.when(F.col("event_id") != "error", F.col("event_id")), F.lit("none")).alias("filled"),
        F.date_format(F.from_unixtime((time / 1000).cast("long")), "yyyy-MM-dd").alias("day_text"),
        day_of(time).alias("day"),
        F.date_add(day_of(time), -1).alias("day_before"),
        same_day(time, "2024-01-15").alias("same_day"),
        F.element_at(props, "pageId").alias("looked_up"),
        F.to_json(props).alias("props_json"),
        F.to_json(F.struct("guid", "channel")).alias("row_json"),
    )


# Aggregation


@query(
    "agg_word_count",
    r"""SELECT word, count(*) AS cnt FROM (
          SELECT unnest(regexp_split_to_array(text, '[ \t\n\x0B\f\r]+')) AS word FROM documents)
        WHERE word <> '' GROUP BY word""",
)
def agg_word_count(spark, folder):
    """Words of all documents and how often each occurs."""
    return A.word_count(table(spark, folder, "documents"), "text", r"[ \t\n\x0B\f\r]+")


@query("agg_sum", action_sql("SELECT page_id, CAST(sum(action_timelong) AS BIGINT) AS time_spent FROM action_event GROUP BY page_id"))
def agg_sum(spark, folder):
    """Time spent on each page."""
    return actions(spark, folder).groupBy("page_id").agg(F.sum("action_timelong").alias("time_spent"))


@query("agg_min", action_sql("SELECT channel, min(action_timelong) AS min_actiontime FROM action_event GROUP BY channel"))
def agg_min(spark, folder):
    """Shortest action of each channel."""
    return actions(spark, folder).groupBy("channel").agg(F.min("action_timelong").alias("min_actiontime"))


@query("agg_max", action_sql("SELECT channel, max(action_timelong) AS max_actiontime FROM action_event GROUP BY channel"))
def agg_max(spark, folder):
    """Longest action of each channel."""
    return actions(spark, folder).groupBy("channel").agg(F.max("action_timelong").alias("max_actiontime"))


def _extreme_sql(direction: str) -> str:
    return action_sql(f"""
    SELECT channel, log_id, guid, event_id, action_time, action_timelong FROM (
      SELECT *, row_number() OVER (PARTITION BY channel ORDER BY action_timelong {direction}, log_id) AS rn
      FROM action_event) WHERE rn = 1""")


def _extreme(spark, folder, largest):
    rows = actions(spark, folder).select("channel", "log_id", "guid", "event_id", "action_time", "action_timelong")
    return A.extreme_row(rows, ["channel"], "action_timelong", "log_id", largest)


@query("agg_min_by", _extreme_sql("ASC"))
def agg_min_by(spark, folder):
    """The whole row of the shortest action per channel."""
    return _extreme(spark, folder, largest=False)


@query("agg_max_by", _extreme_sql("DESC"))
def agg_max_by(spark, folder):
    """The whole row of the longest action per channel."""
    return _extreme(spark, folder, largest=True)


@query(
    "agg_global",
    action_sql("""SELECT max(action_timelong) AS max_long, min(action_timelong) AS min_long,
                  CAST(sum(action_timelong) AS BIGINT) AS sum_long, count(*) AS cnt FROM action_event"""),
)
def agg_global(spark, folder):
    """All rows as one group; each task sends one partial row."""
    long = "action_timelong"
    return actions(spark, folder).agg(
        F.max(long).alias("max_long"), F.min(long).alias("min_long"),
        F.sum(long).alias("sum_long"), F.count(F.lit(1)).alias("cnt"),
    )


@query(
    "agg_stats",
    action_sql("""SELECT guid, min(action_timelong) AS lo, max(action_timelong) AS hi, count(*) AS cnt,
                  CAST(sum(action_timelong) AS BIGINT) / count(*) AS mean FROM action_event GROUP BY guid"""),
)
def agg_stats(spark, folder):
    """Minimum, maximum, average and count per user."""
    long = "action_timelong"
    return actions(spark, folder).groupBy("guid").agg(
        F.min(long).alias("lo"), F.max(long).alias("hi"), F.count(F.lit(1)).alias("cnt"),
        (F.sum(long) / F.count(F.lit(1))).alias("mean"),
    )


@query(
    "agg_reduce_sum",
    action_sql("""
    SELECT f.guid, f.first_event, l.last_event, s.total FROM
      (SELECT guid, event_id AS first_event FROM (SELECT *, row_number() OVER (PARTITION BY guid ORDER BY action_time, log_id) AS r FROM action_event) WHERE r = 1) f
      JOIN (SELECT guid, event_id AS last_event FROM (SELECT *, row_number() OVER (PARTITION BY guid ORDER BY action_time DESC, log_id DESC) AS r FROM action_event) WHERE r = 1) l ON f.guid = l.guid
      JOIN (SELECT guid, CAST(sum(action_timelong) AS BIGINT) AS total FROM action_event GROUP BY guid) s ON f.guid = s.guid"""),
)
def agg_reduce_sum(spark, folder):
    """Summed field with the other fields of the first row, and of the last row."""
    rows = actions(spark, folder).select("guid", "event_id", "action_time", "log_id", "action_timelong")
    order = F.struct("action_time", "log_id")
    return rows.groupBy("guid").agg(
        F.min_by("event_id", order).alias("first_event"),
        F.max_by("event_id", order).alias("last_event"),
        F.sum("action_timelong").alias("total"),
    )


@query(
    "agg_reduce_concat",
    action_sql("""WITH placed AS (SELECT *, row_number() OVER (PARTITION BY guid ORDER BY action_time, log_id) AS pos FROM action_event)
                  SELECT guid, (pos - 1) // 20 AS part, string_agg(event_id, '|' ORDER BY pos) AS joined FROM placed GROUP BY ALL"""),
)
def agg_reduce_concat(spark, folder):
    """Event names of each user in order, twenty to a part."""
    rows = actions(spark, folder).select("guid", "event_id", "action_time", "log_id")
    return A.concat_in_order(rows, ["guid"], "event_id", ["action_time", "log_id"], 20, "|")


@query(
    "agg_reduce_product",
    action_sql(f"""SELECT guid, action_time // {HOUR} AS hour, product(1 + action_timelong % 7) AS prod
                   FROM action_event GROUP BY ALL"""),
)
def agg_reduce_product(spark, folder):
    """Product of a score per user and hour."""
    return actions(spark, folder).groupBy("guid", bucket(F.col("action_time"), HOUR).alias("hour")).agg(
        F.product((1 + F.col("action_timelong") % 7).cast("double")).alias("prod")
    )


@query(
    "agg_count_distinct",
    action_sql("""SELECT channel, count(DISTINCT guid) AS uv, count(DISTINCT event_id) AS events FROM action_event GROUP BY channel
                  UNION ALL SELECT 'all', count(DISTINCT guid), count(DISTINCT event_id) FROM action_event"""),
)
def agg_count_distinct(spark, folder):
    """Exact distinct users and event kinds, per channel and overall."""
    channel = F.col("channel")
    counted = actions(spark, folder).groupingSets([[channel], []], channel).agg(
        F.count_distinct("guid").alias("uv"), F.count_distinct("event_id").alias("events"), F.grouping_id().alias("gid")
    )
    return counted.select(F.when(F.col("gid") == 1, "all").otherwise(channel).alias("channel"), "uv", "events")


@query(
    "agg_approx_distinct",
)
def agg_approx_distinct(spark, folder):
    """Distinct users by a sketch of 3 % standard error; a test holds it against the exact number."""
    return actions(spark, folder).groupBy("channel").agg(F.approx_count_distinct("guid", 0.03).alias("uv"))


@query("agg_bitmap_distinct", action_sql("SELECT channel, count(DISTINCT guid) AS uv FROM action_event GROUP BY channel"))
def agg_bitmap_distinct(spark, folder):
    """Exact distinct users per channel through bitmaps."""
    return A.distinct_by_bitmap(actions(spark, folder), ["channel"], "guid", "uv")


@query(
    "agg_bitmap_and",
    action_sql("""SELECT count(*) AS common FROM (
      SELECT guid FROM action_event GROUP BY guid
      HAVING count(*) FILTER (WHERE event_id = 'purchase' AND channel = 'app') > 0
         AND count(*) FILTER (WHERE event_id = 'error' AND channel = 'web') > 0)"""),
)
def agg_bitmap_and(spark, folder):
    """Users in both of two sets, by AND of their bitmaps."""
    event, channel = F.col("event_id"), F.col("channel")
    return A.common_by_bitmap(
        actions(spark, folder),
        (event == "purchase") & (channel == "app"),
        (event == "error") & (channel == "web"),
        "guid",
    )


@query("agg_count_if", action_sql("SELECT channel, count(*) FILTER (WHERE event_id = 'view') AS views, count(*) AS cnt FROM action_event GROUP BY channel"))
def agg_count_if(spark, folder):
    """Conditional count beside the plain one."""
    return actions(spark, folder).groupBy("channel").agg(
        F.count_if(F.col("event_id") == "view").alias("views"), F.count(F.lit(1)).alias("cnt")
    )


@query(
    "agg_cube",
    action_sql("""SELECT channel, event_id, count(DISTINCT guid) AS uv, CAST(grouping(channel, event_id) AS BIGINT) AS gid
                  FROM action_event GROUP BY CUBE (channel, event_id)"""),
)
def agg_cube(spark, folder):
    """Distinct users for every subset of channel and event."""
    return actions(spark, folder).cube("channel", "event_id").agg(
        F.count_distinct("guid").alias("uv"), F.grouping_id().alias("gid")
    )


@query(
    "agg_grouping_sets",
    action_sql("""SELECT channel, event_id, page_id, count(*) AS cnt, count(DISTINCT guid) AS uv,
                  CAST(grouping(channel, event_id, page_id) AS BIGINT) AS gid
                  FROM action_event GROUP BY GROUPING SETS ((), (channel), (channel, event_id), (page_id))"""),
)
def agg_grouping_sets(spark, folder):
    """Chosen subsets of the keys in one pass."""
    channel, event, page = F.col("channel"), F.col("event_id"), F.col("page_id")
    return actions(spark, folder).groupingSets(
        [[], [channel], [channel, event], [page]], channel, event, page
    ).agg(F.count(F.lit(1)).alias("cnt"), F.count_distinct("guid").alias("uv"), F.grouping_id().alias("gid"))


@query(
    "agg_rollup",
    action_sql("""SELECT channel, event_id, count(*) AS cnt, CAST(sum(action_timelong) AS BIGINT) AS total,
                  CAST(grouping(channel, event_id) AS BIGINT) AS gid FROM action_event GROUP BY ROLLUP (channel, event_id)"""),
)
def agg_rollup(spark, folder):
    """Subtotals along the channel, event hierarchy."""
    return actions(spark, folder).rollup("channel", "event_id").agg(
        F.count(F.lit(1)).alias("cnt"), F.sum("action_timelong").alias("total"), F.grouping_id().alias("gid")
    )


@query("agg_table_api", action_sql("SELECT guid, CAST(sum(action_timelong) AS BIGINT) * 2 AS doubled FROM action_event GROUP BY guid"))
def agg_table_api(spark, folder):
    """Group, aggregate, then select over the aggregate."""
    return actions(spark, folder).groupBy("guid").agg(F.sum("action_timelong").alias("s")).select(
        "guid", (F.col("s") * 2).alias("doubled")
    )


# Ranking


@query(
    "topn_per_group",
    action_sql("""
    WITH spent AS (SELECT page_id, guid, count(*) AS visits, CAST(sum(action_timelong) AS BIGINT) AS time_spent
                   FROM action_event GROUP BY ALL)
    SELECT page_id, guid, visits, time_spent FROM spent
    QUALIFY row_number() OVER (PARTITION BY page_id ORDER BY visits DESC, time_spent DESC, guid) <= 4"""),
)
def topn_per_group(spark, folder):
    """The four users who were most often, and then longest, on each page."""
    spent = actions(spark, folder).groupBy("page_id", "guid").agg(
        F.count(F.lit(1)).alias("visits"), F.sum("action_timelong").alias("time_spent")
    )
    return top_n_per_group(spent, ["page_id"], [F.desc("visits"), F.desc("time_spent"), F.asc("guid")], 4)


@query(
    "topk_global",
    action_sql("""SELECT page_id, count(*) AS pv, count(DISTINCT guid) AS uv FROM action_event
                  GROUP BY page_id ORDER BY pv DESC, page_id LIMIT 20"""),
)
def topk_global(spark, folder):
    """The twenty most viewed pages."""
    pages = actions(spark, folder).groupBy("page_id").agg(
        F.count(F.lit(1)).alias("pv"), F.count_distinct("guid").alias("uv")
    )
    return top_n(pages, [F.desc("pv"), F.asc("page_id")], 20)
