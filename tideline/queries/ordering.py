"""Queries that depend on row order: frames, running values, count and marker windows."""

from __future__ import annotations

from pyspark.sql import functions as F

from tideline.operators.ordered import ordered, range_sums, row_frames, running_count, running_sum
from tideline.operators.ranking import top_n_per_group
from tideline.operators.rows import tasks_for
from tideline.operators.windows import (
    count_slide,
    count_tumble,
    hop_sums,
    marker_windows,
)
from tideline.plans.orders import cents
from tideline.queries.registry import query
from tideline.queries.relational import DAY, action_sql, actions
from tideline.queries.views import ORDER_ITEM, SHOP_ORDER, with_views
from tideline.functions.timing import epoch_millis
from tideline.sources.behaviour import order_item, shop_order
from tideline.sources.tables import table

ORDER = ["action_time", "log_id"]
LONG = "action_timelong"


def _top_window(name: str, key: str, measure: str) -> None:
    """Register the top three of ``key`` by ``measure`` over the last four weeks, moved on each week."""
    week = 7 * DAY
    sql = f"""
        WITH joined AS (SELECT *, CAST(round(price * 100) AS BIGINT) * quantity AS c_cents,
             CAST(round(coalesce(coupon_amount, 0) * 100) AS BIGINT) AS c_coupon
             FROM shop_order JOIN order_item ON order_id = id),
        weeks AS (SELECT {key}, quantity, c_cents, c_coupon,
             make_timestamp((epoch_us(create_time) // {week * 1000} - j) * {week * 1000}) AS window_start
             FROM joined, (SELECT unnest(range(0, 4)) AS j)),
        sums AS (SELECT window_start, {key}, CAST(sum(quantity) AS BIGINT) AS qty, CAST(sum(c_cents) AS BIGINT) AS cents,
             CAST(sum(c_coupon) AS BIGINT) AS coupon_cents FROM weeks GROUP BY ALL)
        SELECT *, row_number() OVER (PARTITION BY window_start ORDER BY {measure} DESC, {key}) AS rn FROM sums
        QUALIFY rn <= 3"""

    @query(name, with_views(sql, SHOP_ORDER, ORDER_ITEM))
    def run(spark, folder):
        orders = shop_order(table(spark, folder, "orders"))
        lines = table(spark, folder, "lineitem")
        # Products in a week are almost as many as items, categories are few.
        tasks = tasks_for(lines) if key == "product_id" else None
        items = order_item(lines, table(spark, folder, "part"), tasks)
        if tasks:
            items, orders = items.repartition(tasks, "order_id"), orders.repartition(tasks, "id").hint("merge")
        joined = items.join(orders.select("id", "create_time"), items.order_id == orders.id)
        amounts = {
            "qty": F.col("quantity"),
            "cents": cents(F.col("price")) * F.col("quantity"),
            "coupon_cents": cents(F.coalesce(F.col("coupon_amount").cast("double"), F.lit(0.0))),
        }
        sums = hop_sums(joined, epoch_millis(F.col("create_time")), 4 * week, week, [key], amounts, tasks)
        ranked = top_n_per_group(sums, ["window_start"], [F.desc(measure), F.asc(key)], 3, rank="rn")
        return ranked.select("window_start", key, *amounts, F.col("rn").cast("long").alias("rn"))


_top_window("topn_window", "product_category", "cents")
_top_window("topn_window_category_qty", "product_category", "qty")
_top_window("topn_window_product_amount", "product_id", "cents")
_top_window("topn_window_product_qty", "product_id", "qty")
_top_window("topn_window_product_coupon", "product_id", "coupon_cents")


@query(
    "over_rows",
    action_sql("""SELECT log_id, CAST(sum(action_timelong) OVER w AS BIGINT) AS sum_long,
                  CAST(sum(action_timelong) OVER w AS BIGINT) / count(*) OVER w AS avg_long FROM action_event
                  WINDOW w AS (PARTITION BY guid ORDER BY action_time, log_id ROWS BETWEEN 4 PRECEDING AND CURRENT ROW)"""),
)
def over_rows(spark, folder):
    """Sum and average over the last five rows of a user."""
    rows = actions(spark, folder).select("guid", *ORDER, "action_timelong")
    framed = row_frames(
        rows, ["guid"], ORDER, 4,
        lambda w: {
            "sum_long": F.sum(LONG).over(w),
            "avg_long": F.sum(LONG).over(w) / F.count(F.lit(1)).over(w),
        },
        counted=True,
    )
    return framed.select("log_id", "sum_long", "avg_long")


@query(
    "over_range",
    action_sql(f"""SELECT log_id, CAST(sum(action_timelong) OVER w AS BIGINT) AS sum_long,
                  CAST(sum(action_timelong) OVER w AS BIGINT) / count(*) OVER w AS avg_long FROM action_event
                  WINDOW w AS (PARTITION BY guid ORDER BY action_time RANGE BETWEEN {DAY} PRECEDING AND CURRENT ROW)"""),
)
def over_range(spark, folder):
    """Sum and average over a user's last day up to each row."""
    rows = actions(spark, folder).select("guid", *ORDER, "action_timelong")
    framed = range_sums(rows, ["guid"], ORDER, DAY, {"sum_long": LONG, "rows": F.lit(1)}, counted=True)
    return framed.select("log_id", "sum_long", (F.col("sum_long") / F.col("rows")).alias("avg_long"))


@query(
    "last_n_concat",
    action_sql("""SELECT log_id, string_agg(event_id, '') OVER
                    (ORDER BY action_time, log_id ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS joined
                  FROM action_event"""),
)
def last_n_concat(spark, folder):
    """Each element joined to the two before it, over the whole sequence."""
    rows = actions(spark, folder).select(*ORDER, "event_id")
    framed = row_frames(rows, [], ORDER, 2, lambda w: {"joined": F.array_join(F.collect_list("event_id").over(w), "")}, counted=True)
    return framed.select("log_id", "joined")


@query(
    "last_n_per_key",
    action_sql("""SELECT log_id, channel || ',' || string_agg(event_id, ',') OVER
                    (PARTITION BY channel ORDER BY action_time, log_id ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS joined
                  FROM action_event"""),
)
def last_n_per_key(spark, folder):
    """The last three events of the channel at each row."""
    rows = actions(spark, folder).select("channel", *ORDER, "event_id")
    framed = row_frames(
        rows, ["channel"], ORDER, 2,
        lambda w: {"joined": F.concat_ws(",", "channel", F.array_join(F.collect_list("event_id").over(w), ","))},
        counted=True,
    )
    return framed.select("log_id", "joined")


@query(
    "running_count",
    action_sql("""SELECT log_id, count(*) OVER (PARTITION BY channel ORDER BY action_time, log_id) AS cnt,
                  count(*) FILTER (WHERE event_id = 'view') OVER (PARTITION BY channel ORDER BY action_time, log_id) AS views
                  FROM action_event"""),
)
def running_counts(spark, folder):
    """Rows, and views, of a channel up to each row."""
    rows = actions(spark, folder).select("channel", *ORDER, "event_id")
    return ordered(rows, ["channel"], ORDER, counted=True).scan(
        running_count("cnt"), running_count("views", F.col("event_id") == "view")
    ).rows().select("log_id", "cnt", "views")


@query(
    "running_count_by_event",
    action_sql("""SELECT log_id, channel || ',' || event_id || ' : ' ||
                    count(*) OVER (PARTITION BY channel, event_id ORDER BY action_time, log_id) AS message
                  FROM action_event"""),
)
def running_count_by_event(spark, folder):
    """Rows of a channel and event up to each row, as a message."""
    rows = actions(spark, folder).select("channel", "event_id", *ORDER)
    counted = ordered(rows, ["channel", "event_id"], ORDER, counted=True).scan(running_count("cnt")).rows()
    return counted.select("log_id", F.format_string("%s,%s : %d", "channel", "event_id", "cnt").alias("message"))


@query(
    "running_sum",
    action_sql("""SELECT log_id, CAST(sum(action_timelong) OVER (PARTITION BY guid ORDER BY action_time, log_id) AS BIGINT) AS total
                  FROM action_event"""),
)
def running_sums(spark, folder):
    """Action time of a user up to each row."""
    rows = actions(spark, folder).select("guid", *ORDER, "action_timelong")
    return ordered(rows, ["guid"], ORDER, counted=True).scan(running_sum("total", F.col(LONG))).rows().select("log_id", "total")


_NUMBERED = """WITH placed AS (SELECT *, row_number() OVER ({part} ORDER BY action_time, log_id) AS pos FROM action_event)"""


@query(
    "batch_every_n",
    action_sql(_NUMBERED.format(part="") + """
      SELECT (pos - 1) // 5 AS window_no, string_agg(event_id, '' ORDER BY pos) AS joined FROM placed
      GROUP BY window_no HAVING count(*) = 5"""),
)
def batch_every_n(spark, folder):
    """Each five elements of the whole sequence joined to one text."""
    rows = actions(spark, folder).select(*ORDER, "event_id")
    entries = F.array_sort(F.collect_list(F.struct(*ORDER, "event_id")))
    joined = F.array_join(F.transform(entries, lambda e: e["event_id"]), "")
    return count_tumble(rows, [], ORDER, 5, joined.alias("joined"))


@query(
    "win_count_tumble",
    action_sql(_NUMBERED.format(part="PARTITION BY channel") + """
      SELECT channel, (pos - 1) // 5 AS window_no, CAST(sum(action_timelong) AS BIGINT) AS total FROM placed
      GROUP BY channel, window_no HAVING count(*) = 5"""),
)
def win_count_tumble(spark, folder):
    """Action time of each five rows of a channel."""
    rows = actions(spark, folder).select("channel", *ORDER, "action_timelong")
    return count_tumble(rows, ["channel"], ORDER, 5, F.sum(LONG).alias("total"))


@query(
    "win_count_slide",
    action_sql(_NUMBERED.format(part="") + """, framed AS (SELECT pos, CAST(sum(action_timelong) OVER
        (ORDER BY pos ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS BIGINT) AS total FROM placed)
      SELECT pos // 2 AS firing, total FROM framed WHERE pos % 2 = 0"""),
)
def win_count_slide(spark, folder):
    """Every two rows, the action time of the last five."""
    rows = actions(spark, folder).select(*ORDER, "action_timelong")
    return count_slide(rows, [], ORDER, 2, 5, F.sum(LONG).alias("total"))


@query(
    "win_trigger_evict",
    action_sql(_NUMBERED.format(part="PARTITION BY channel") + """, framed AS (SELECT channel, pos,
        CAST(sum(action_timelong) OVER w AS BIGINT) AS total, count(*) OVER w AS held
        FROM placed WINDOW w AS (PARTITION BY channel ORDER BY pos ROWS BETWEEN 3 PRECEDING AND CURRENT ROW))
      SELECT channel, pos // 2 AS firing, total, held FROM framed WHERE pos % 2 = 0"""),
)
def win_trigger_evict(spark, folder):
    """A window that fires every two rows and keeps the newest four, per channel."""
    rows = actions(spark, folder).select("channel", *ORDER, "action_timelong")
    return count_slide(
        rows, ["channel"], ORDER, 2, 4, F.sum(LONG).alias("total"), F.count(F.lit(1)).alias("held")
    )


@query(
    "win_marker_trigger",
    action_sql("""
    WITH marked AS (SELECT *, coalesce(count(*) FILTER (WHERE event_id = 'purchase') OVER
           (ORDER BY action_time, log_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS window_no FROM action_event),
         placed AS (SELECT *, row_number() OVER (PARTITION BY window_no ORDER BY action_time DESC, log_id DESC) AS place,
           max(CASE WHEN event_id = 'purchase' THEN 1 ELSE 0 END) OVER (PARTITION BY window_no) AS fired FROM marked)
    SELECT window_no, string_agg(event_id, ':' ORDER BY place DESC) AS joined FROM placed
    WHERE fired = 1 AND place <= 5 GROUP BY window_no"""),
)
def win_marker_trigger(spark, folder):
    """Windows closed by a purchase, each giving its newest five events."""
    rows = actions(spark, folder).select(*ORDER, "event_id")
    kept = marker_windows(rows, [], ORDER, F.col("event_id") == "purchase", 5)
    entries = F.sort_array(F.collect_list(F.struct("place", "event_id")), asc=False)
    joined = F.array_join(F.transform(entries, lambda e: e["event_id"]), ":")
    return kept.groupBy("window_no").agg(joined.alias("joined"))
