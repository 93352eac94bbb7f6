"""The warehouse jobs: cleaning, identity, areas, visits, reports, orders, change rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from tideline.operators.changes import current_rows, insert_rows
from tideline.operators.rows import tasks_for
from tideline.plans import detail as D
from tideline.plans import geo as G
from tideline.plans import identity as I
from tideline.plans import orders as R
from tideline.plans import traffic as V
from tideline.queries.registry import query
from tideline.queries.relational import DAY, HOUR
from tideline.queries.views import (
    APP_LOG,
    AREAS,
    MEMBERS,
    ORDER_CHANGES,
    ORDER_ITEM,
    SHOP_ORDER,
    geohash5,
    with_views,
)
from tideline.sources import behaviour as B
from tideline.sources.tables import table

MINUTE = 60_000
AS_OF = "2024-01-15"

GATED = """
gated AS (SELECT * FROM app_log WHERE trim(deviceid) <> '' AND trim(eventid) <> ''
          AND timestamp > 1000000000000 AND page IS NOT NULL)"""


def logs(spark, folder):
    return B.app_log(table(spark, folder, "events"))


def members(spark, folder):
    return B.members(table(spark, folder, "customer"))


def areas(spark, folder):
    return B.areas(*[table(spark, folder, t) for t in ("region", "nation", "supplier", "customer")])


# Areas

GEO_PATHS = f"""
tree AS (SELECT p.area_name AS province, c.area_name AS city, r.area_name AS region, r.id AS region_id, r.lat, r.lng
         FROM areas r JOIN areas c ON r.level = 3 AND r.parent_id = c.id JOIN areas p ON c.parent_id = p.id),
paths AS (SELECT t.province, t.city, t.region, s.lat, s.lng, 0 AS part, s.id AS source_id
          FROM areas s JOIN tree t ON s.level = 4 AND s.parent_id = t.region_id
          UNION ALL SELECT province, city, region, lat, lng, 1, region_id FROM tree)"""

GEO_DICT = f"""
geo_dict AS (SELECT geohash, province, city, region FROM (
    SELECT *, row_number() OVER (PARTITION BY geohash ORDER BY part DESC, source_id DESC) AS rn
    FROM (SELECT *, {geohash5('lat', 'lng')} AS geohash FROM paths)) WHERE rn = 1)"""


@query("join_multi_self", with_views("SELECT province, city, region, lat, lng, source_id FROM paths", AREAS, GEO_PATHS))
def join_multi_self(spark, folder):
    """The area tree joined to itself three deep, and the union of its two lowest levels."""
    return G.area_paths(areas(spark, folder)).drop("part")


@query("set_union_all", with_views("SELECT part, count(*) AS cnt FROM paths GROUP BY part", AREAS, GEO_PATHS))
def set_union_all(spark, folder):
    """How many positions each branch of the union gives."""
    return G.area_paths(areas(spark, folder)).groupBy("part").agg(F.count(F.lit(1)).alias("cnt"))


@query("dw_geohash", with_views(f"SELECT log_id, {geohash5('latitude', 'longitude')} AS geohash FROM app_log", APP_LOG))
def dw_geohash(spark, folder):
    """Geohash of every log row's position."""
    return G.located(logs(spark, folder)).select("log_id", "geohash")


@query("dw_geo_dict", with_views("SELECT * FROM geo_dict", AREAS, GEO_PATHS, GEO_DICT))
def dw_geo_dict(spark, folder):
    """Area names by geohash."""
    return G.geo_dictionary(areas(spark, folder))


ENRICHED = f"""
hashed AS (SELECT *, {geohash5('latitude', 'longitude')} AS geohash FROM app_log),
enriched AS (SELECT h.log_id, h.geohash, h.latitude, h.longitude, coalesce(d.province, '未知') AS province,
    coalesce(d.city, '未知') AS city, coalesce(d.region, '未知') AS region,
    d.geohash IS NULL AND h.geohash <> '' AS area_missing
  FROM hashed h LEFT JOIN geo_dict d ON d.geohash = h.geohash)"""


@query(
    "dw_area_enrich",
    with_views("SELECT log_id, geohash, province, city, region, area_missing FROM enriched", APP_LOG, AREAS, GEO_PATHS, GEO_DICT, ENRICHED),
)
def dw_area_enrich(spark, folder):
    """Log rows with area names, unknown where the dictionary has none."""
    dictionary = G.geo_dictionary(areas(spark, folder))
    enriched = G.enrich_area(G.located(logs(spark, folder)), dictionary)
    return enriched.select("log_id", "geohash", "province", "city", "region", "area_missing")


@query(
    "dw_unknown_gps",
    with_views("SELECT log_id, longitude || ',' || latitude AS position FROM enriched WHERE area_missing", APP_LOG, AREAS, GEO_PATHS, GEO_DICT, ENRICHED),
)
def dw_unknown_gps(spark, folder):
    """Positions the dictionary does not know."""
    dictionary = G.geo_dictionary(areas(spark, folder))
    return G.unknown_positions(G.enrich_area(G.located(logs(spark, folder)), dictionary))


# Identity. The check restates the rule row by row: the weight of an account at a row is its
# own events so far minus the other accounts' events since its first one.

IDENTITY = """
known AS (SELECT g.*, m.account AS reg, m.id AS member, m.create_time FROM gated g LEFT JOIN members m ON m.account = g.account),
acct AS (SELECT deviceid, reg, member, create_time, timestamp AS t, log_id FROM known WHERE reg IS NOT NULL),
first_bind AS (SELECT deviceid, reg, min((t, log_id)) AS bound FROM acct GROUP BY ALL),
anon AS (SELECT deviceid, timestamp AS t, log_id FROM known WHERE reg IS NULL),
weights AS (SELECT n.log_id, b.reg,
    count(*) FILTER (WHERE a.reg = b.reg) - count(*) FILTER (WHERE a.reg <> b.reg AND (a.t, a.log_id) > b.bound) AS weight
  FROM anon n JOIN first_bind b ON b.deviceid = n.deviceid AND b.bound < (n.t, n.log_id)
       JOIN acct a ON a.deviceid = n.deviceid AND (a.t, a.log_id) < (n.t, n.log_id)
  GROUP BY ALL),
best AS (SELECT log_id, reg FROM (SELECT *, row_number() OVER (PARTITION BY log_id ORDER BY weight DESC, reg) AS rn
         FROM weights WHERE weight > 0) WHERE rn = 1),
fallback AS (SELECT n.deviceid, min((n.t, n.log_id)) AS since, min(n.t) AS first_time FROM anon n
             LEFT JOIN best b ON b.log_id = n.log_id WHERE b.reg IS NULL GROUP BY ALL),
temp AS (SELECT *, 100000000 + row_number() OVER (ORDER BY first_time, deviceid) AS temp_guid FROM fallback),
mapped AS (SELECT k.* EXCLUDE (account, create_time),
    CASE WHEN k.reg IS NULL AND (f.since IS NULL OR f.since > (k.timestamp, k.log_id)) THEN b.reg ELSE k.account END AS account,
    CASE WHEN k.reg IS NOT NULL THEN k.member WHEN f.since <= (k.timestamp, k.log_id) THEN f.temp_guid ELSE m.id END AS guid,
    CASE WHEN k.reg IS NOT NULL THEN k.create_time WHEN f.since <= (k.timestamp, k.log_id) THEN NULL ELSE m.create_time END AS register_time,
    CASE WHEN k.reg IS NULL AND f.since <= (k.timestamp, k.log_id) THEN f.first_time END AS first_access_time
  FROM known k LEFT JOIN temp f ON f.deviceid = k.deviceid LEFT JOIN best b ON b.log_id = k.log_id
       LEFT JOIN members m ON m.account = b.reg)"""

_IDENTITY_VIEWS = (APP_LOG, MEMBERS, GATED, IDENTITY)


@query(
    "dw_id_mapping",
    with_views("SELECT log_id, deviceid, account, guid, register_time, first_access_time FROM mapped", *_IDENTITY_VIEWS),
)
def dw_id_mapping(spark, folder):
    """Every cleaned row with the person it belongs to."""
    gated = logs(spark, folder).where(D.passes_gate())
    slim = gated.select("log_id", "deviceid", "account", "timestamp")
    return I.map_identity(slim, members(spark, folder)).drop("timestamp")


@query(
    "dw_id_mapping_incremental",
    with_views("SELECT log_id, deviceid, account, guid, register_time, first_access_time FROM mapped", *_IDENTITY_VIEWS),
)
def dw_id_mapping_incremental(spark, folder):
    """The same mapping made in three runs, each of which goes on from the state of the one before."""
    gated = logs(spark, folder).where(D.passes_gate()).select("log_id", "deviceid", "account", "timestamp")
    day = F.day(F.timestamp_millis("timestamp"))
    mapped, state = None, None
    for part in (day <= 9, (day > 9) & (day <= 20), day > 20):
        rows, state = I.continue_identity(gated.where(part), members(spark, folder), state)
        state = state.written()
        mapped = rows if mapped is None else mapped.unionByName(rows)
    return mapped.drop("timestamp")


@query(
    "dw_device_binding",
    with_views(
        """SELECT b.deviceid, b.reg AS account,
             count(*) FILTER (WHERE a.reg = b.reg) - count(*) FILTER (WHERE a.reg <> b.reg AND (a.t, a.log_id) > b.bound) AS weight
           FROM first_bind b JOIN acct a ON a.deviceid = b.deviceid GROUP BY ALL""",
        *_IDENTITY_VIEWS,
    ),
)
def dw_device_binding(spark, folder):
    """Binding weight of each account on each device."""
    gated = logs(spark, folder).where(D.passes_gate())
    return I.device_bindings(gated, members(spark, folder))


@query(
    "dw_temp_guid",
    with_views(
        """SELECT deviceid, first_time, 100000000 + row_number() OVER (ORDER BY first_time, deviceid) AS guid
           FROM (SELECT deviceid, min(timestamp) AS first_time FROM gated GROUP BY deviceid)""",
        APP_LOG, GATED,
    ),
)
def dw_temp_guid(spark, folder):
    """A numbered id per device in the order of first visits."""
    gated = logs(spark, folder).where(D.passes_gate())
    first = gated.groupBy("deviceid").agg(F.min("timestamp").alias("first_time"))
    return I.temporary_ids(first)


@query(
    "dw_new_user_flag",
    with_views(
        f"""SELECT log_id, coalesce(CAST(CAST(make_timestamp(coalesce(nullif(first_access_time, 0), register_time) * 1000) AS DATE)
                   = DATE '{AS_OF}' AS INTEGER), 0) AS is_new FROM mapped""",
        *_IDENTITY_VIEWS,
    ),
)
def dw_new_user_flag(spark, folder):
    """Whether the person of a row was first known on the report day."""
    gated = logs(spark, folder).where(D.passes_gate())
    slim = gated.select("log_id", "deviceid", "account", "timestamp")
    return D.with_new_flag(I.map_identity(slim, members(spark, folder)), AS_OF).select("log_id", "is_new")


@query(
    "dw_ods_to_dwd",
    with_views(
        f"""SELECT p.log_id, p.eventid, p.guid, p.releasechannel, p.account, p.appid, p.appversion, p.carrier, p.deviceid,
              p.devicetype, p.ip, p.latitude, p.longitude, p.nettype, p.osname, p.osversion, p.resolution, p.sessionid,
              p.timestamp, p.register_time, p.first_access_time,
              coalesce(CAST(CAST(make_timestamp(coalesce(nullif(p.first_access_time, 0), p.register_time) * 1000) AS DATE)
                   = DATE '{AS_OF}' AS INTEGER), 0) AS is_new,
              e.geohash, e.province, e.city, e.region, '{{"pageId":"' || p.page || '"}}' AS props_json,
              strftime(make_timestamp(p.timestamp * 1000), '%Y-%m-%d') AS dw_date
            FROM mapped p JOIN enriched e ON e.log_id = p.log_id""",
        *_IDENTITY_VIEWS, AREAS, GEO_PATHS, GEO_DICT, ENRICHED,
    ),
)
def dw_ods_to_dwd(spark, folder):
    """The whole cleaning job, from raw log to detail table."""
    dictionary = G.geo_dictionary(areas(spark, folder))
    rows = D.build_detail(logs(spark, folder), members(spark, folder), dictionary, AS_OF)
    return rows.select("log_id", *D.DETAIL_COLUMNS)


# Visits. The user is taken from the session id here, so that these checks stand alone.

VISITS = """
visits AS (SELECT *, CAST(substr(sessionid, 2) AS BIGINT) AS guid,
    CASE WHEN latitude < 0 THEN 'nowhere' ELSE 'p' || CAST(substr(sessionid, 2) AS BIGINT) % 3 END AS province,
    'c' || CAST(substr(sessionid, 2) AS BIGINT) % 6 AS city, 'r' || CAST(substr(sessionid, 2) AS BIGINT) % 12 AS region,
    CAST(CAST(substr(sessionid, 2) AS BIGINT) % 2 AS INTEGER) AS is_new FROM gated)"""


def visits(spark, folder):
    return visits_of(logs(spark, folder))


def visits_of(rows):
    gated = rows.where(D.passes_gate())
    user = F.substring("sessionid", 2, 20).cast("long")
    return gated.select(
        "log_id", "sessionid", "eventid", "timestamp", "properties", "devicetype", "releasechannel",
        user.alias("guid"),
        F.when(F.col("latitude") < 0, "nowhere").otherwise(F.concat(F.lit("p"), (user % 3).cast("string"))).alias("province"),
        F.concat(F.lit("c"), (user % 6).cast("string")).alias("city"),
        F.concat(F.lit("r"), (user % 12).cast("string")).alias("region"),
        (user % 2).cast("int").alias("is_new"),
    )


TRAFFIC = f"""
placed AS (SELECT *, row_number() OVER w AS rn, lead(timestamp) OVER w AS next_ts FROM visits
           WINDOW w AS (PARTITION BY guid ORDER BY timestamp, log_id)),
marked AS (SELECT *, eventid IN ('applaunch', 'wakeup') OR rn = 1 AS starts FROM placed),
state AS (SELECT *, last_value(CASE WHEN starts THEN log_id END IGNORE NULLS) OVER up_to AS start_log,
    last_value(CASE WHEN eventid = 'pageload' THEN page END IGNORE NULLS) OVER up_to AS cur_page,
    last_value(CASE WHEN eventid = 'pageload' THEN page END IGNORE NULLS) OVER before AS old_page,
    max(CASE WHEN starts OR eventid = 'pageload' THEN timestamp END) OVER up_to AS cur_load,
    max(CASE WHEN starts OR eventid = 'pageload' THEN timestamp END) OVER before AS old_load
  FROM marked WINDOW
    up_to AS (PARTITION BY guid ORDER BY timestamp, log_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
    before AS (PARTITION BY guid ORDER BY timestamp, log_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
split AS (SELECT guid, log_id, start_log, eventid AS event_id, timestamp AS ts, cur_page AS page_id, cur_load AS page_load_time FROM state
  UNION ALL SELECT guid, log_id, start_log, 'flag', timestamp, old_page, old_load FROM state WHERE eventid = 'pageload' AND NOT starts),
beats AS (SELECT guid, log_id, start_log, 'x001' AS event_id, timestamp + n * {5 * MINUTE} AS ts, cur_page AS page_id, cur_load AS page_load_time
  FROM state, (SELECT unnest(range(1, 13)) AS n) WHERE eventid NOT IN ('putback', 'appclose')
    AND (next_ts IS NULL OR timestamp + n * {5 * MINUTE} < next_ts)),
dims AS (SELECT log_id AS start_log, sessionid, sessionid || ':' || timestamp AS split_session_id, province, city, region, devicetype, is_new, releasechannel FROM gated JOIN visits USING (log_id, sessionid, timestamp, devicetype, releasechannel)),
traffic AS (SELECT t.* EXCLUDE (start_log), d.* EXCLUDE (start_log)
  FROM (SELECT * FROM split UNION ALL SELECT * FROM beats) t JOIN dims d USING (start_log))"""

_TRAFFIC_VIEWS = (APP_LOG, GATED, VISITS, TRAFFIC)


def traffic(spark, folder):
    return V.traffic(visits(spark, folder), 5 * MINUTE, 60 * MINUTE)


@query("dw_session_split", with_views("SELECT * FROM traffic WHERE event_id <> 'x001'", *_TRAFFIC_VIEWS))
def dw_session_split(spark, folder):
    """Log rows in their sub-sessions, with rows that close the page left."""
    return V.split_sessions(V.visit_rows(visits(spark, folder)))


@query("dw_heartbeat", with_views("SELECT * FROM traffic WHERE event_id = 'x001'", *_TRAFFIC_VIEWS))
def dw_heartbeat(spark, folder):
    """A row per five silent minutes, for an hour at most."""
    return V.heartbeats(V.visit_rows(visits(spark, folder)), 5 * MINUTE, 60 * MINUTE)


SESSIONS = """
sessions AS (SELECT guid, split_session_id, province, city, region, devicetype, is_new, releasechannel,
    max(ts) - min(ts) AS session_time, count(*) FILTER (WHERE event_id = 'pageload') AS session_pv, max(ts) AS session_end
  FROM traffic GROUP BY ALL)"""


@query("dw_session_agg", with_views("SELECT * FROM sessions", *_TRAFFIC_VIEWS, SESSIONS))
def dw_session_agg(spark, folder):
    """Length and page views of each sub-session."""
    return V.session_summary(traffic(spark, folder))


@query(
    "dw_session_time",
    with_views(
        """SELECT guid, sessionid, CAST(sum(part_time) AS BIGINT) AS session_time FROM (
             SELECT guid, sessionid, split_session_id, max(ts) - min(ts) AS part_time FROM traffic GROUP BY ALL)
           GROUP BY ALL""",
        *_TRAFFIC_VIEWS,
    ),
)
def dw_session_time(spark, folder):
    """Time spent per session."""
    return V.session_time(traffic(spark, folder))


@query(
    "dw_traffic_sets",
    with_views(
        """SELECT province, city, region, devicetype, is_new, releasechannel, count(DISTINCT guid) AS uv,
             CAST(sum(session_pv) AS BIGINT) AS pv, CAST(sum(session_time) AS BIGINT) AS total_time, count(*) AS session_cnt,
             CAST(grouping(province, city, region, devicetype, is_new, releasechannel) AS BIGINT) AS gid
           FROM sessions GROUP BY GROUPING SETS ((), (releasechannel), (releasechannel, is_new), (devicetype), (province, city, region))""",
        *_TRAFFIC_VIEWS, SESSIONS,
    ),
)
def dw_traffic_sets(spark, folder):
    """Users, views, time and sessions for five dimension sets."""
    return V.traffic_report(V.session_summary(traffic(spark, folder)))


def _cumulative(size: int, step: int) -> str:
    parts = []
    for i, names in enumerate(V.REPORT_SETS[1:]):
        columns = ", ".join(
            c if c in names else f"CAST(NULL AS {'INTEGER' if c == 'is_new' else 'VARCHAR'}) AS {c}" for c in V.DIMENSIONS
        )
        parts.append(f"SELECT {i} AS set_no, {columns}, guid, session_pv, session_time, session_end FROM sessions")
    dims = ", ".join(V.DIMENSIONS)
    same = " AND ".join(f"g.{c} IS NOT DISTINCT FROM a.{c}" for c in V.DIMENSIONS)
    return f"""
    WITH copies AS ({' UNION ALL '.join(parts)}),
    seen AS (SELECT set_no, {dims}, session_end // {size} AS win, min(session_end % {size} // {step}) AS first_step FROM copies GROUP BY ALL),
    grid AS (SELECT * EXCLUDE (first_step), unnest(range(first_step, {size // step})) AS at_step FROM seen)
    SELECT make_timestamp(g.win * {size * 1000}) AS window_start,
           make_timestamp(g.win * {size * 1000} + (g.at_step + 1) * {step * 1000}) AS window_end,
           g.set_no, {', '.join('g.' + c for c in V.DIMENSIONS)},
           count(DISTINCT a.guid) AS uv, CAST(sum(a.session_pv) AS BIGINT) AS pv,
           CAST(sum(a.session_time) AS BIGINT) AS total_time, count(*) AS session_cnt
    FROM grid g JOIN copies a ON a.set_no = g.set_no AND {same} AND a.session_end // {size} = g.win
         AND a.session_end % {size} // {step} <= g.at_step
    GROUP BY ALL"""


@query("dw_traffic_cumulate", with_views(_cumulative(DAY, 4 * HOUR), *_TRAFFIC_VIEWS, SESSIONS))
def dw_traffic_cumulate(spark, folder):
    """The report of the day so far, every four hours."""
    return V.cumulative_report(V.session_summary(traffic(spark, folder)), DAY, 4 * HOUR)


@query(
    "win_cumulate_sets",
    with_views(_cumulative(12 * HOUR, 2 * HOUR), *_TRAFFIC_VIEWS, SESSIONS),
)
def win_cumulate_sets(spark, folder):
    """The same with half-day windows that grow by two hours."""
    return V.cumulative_report(V.session_summary(traffic(spark, folder)), 12 * HOUR, 2 * HOUR)


PAGES = """
pages_seen AS (SELECT page_id, CAST(sum(stay) AS BIGINT) AS page_time, count(DISTINCT split_session_id) AS session_cnt,
    count(*) AS page_pv, count(DISTINCT guid) AS page_uv
  FROM (SELECT page_id, page_load_time, split_session_id, guid, max(ts) - min(ts) AS stay FROM traffic
        WHERE page_id IS NOT NULL GROUP BY ALL) GROUP BY page_id)"""


@query("dw_page_stats", with_views("SELECT * FROM pages_seen", *_TRAFFIC_VIEWS, PAGES))
def dw_page_stats(spark, folder):
    """Stay, sessions, views and users per page."""
    return V.page_report(traffic(spark, folder))


def _top_pages(measure: str):
    @query(
        f"dw_page_topk_{measure}",
        with_views(f"SELECT * FROM pages_seen ORDER BY page_{measure} DESC, page_id LIMIT 20", *_TRAFFIC_VIEWS, PAGES),
    )
    def top(spark, folder):
        return V.top_pages(V.page_report(traffic(spark, folder)), f"page_{measure}")


for _measure in ("pv", "uv", "time"):
    _top_pages(_measure)


def _retention_sql() -> str:
    measures = ", ".join(
        f"count(*) FILTER (WHERE age = {n}) AS rows_{n}day, count(DISTINCT guid) FILTER (WHERE age = {n}) AS users_{n}day"
        for n in range(1, 8)
    )
    return f"""
    WITH active AS (SELECT *, DATE '{AS_OF}' - CAST(make_timestamp(coalesce(register_time, first_access_time) * 1000) AS DATE) AS age
      FROM mapped WHERE CAST(make_timestamp(timestamp * 1000) AS DATE) = DATE '{AS_OF}')
    SELECT DATE '{AS_OF}' AS calc_date, releasechannel, devicetype, {measures} FROM active GROUP BY ALL"""


@query("dw_retention", with_views(_retention_sql(), *_IDENTITY_VIEWS))
def dw_retention(spark, folder):
    """People active on the report day by how many days ago they were first known."""
    gated = logs(spark, folder).where(D.passes_gate())
    slim = gated.select("log_id", "deviceid", "account", "timestamp", "releasechannel", "devicetype")
    mapped = I.map_identity(slim, members(spark, folder))
    first = F.coalesce("register_time", "first_access_time")
    return V.retention(mapped.withColumn("first_time", first), AS_OF)


# Orders and their change rows


def orders(spark, folder):
    return B.shop_order(table(spark, folder, "orders"))


def items(spark, folder, tasks=None):
    return B.order_item(table(spark, folder, "lineitem"), table(spark, folder, "part"), tasks)


def changes(spark, folder):
    return B.order_changes(table(spark, folder, "orders"))


@query("dw_order_total", with_views("SELECT count(*) AS order_cnt, round(sum(amount), 2) AS order_amt FROM shop_order", SHOP_ORDER))
def dw_order_total(spark, folder):
    """All orders so far."""
    return R.order_total(orders(spark, folder))


@query(
    "dw_order_total_pay",
    with_views("SELECT pay_type, count(*) AS order_cnt, round(sum(amount), 2) AS order_amt FROM shop_order GROUP BY pay_type", SHOP_ORDER),
)
def dw_order_total_pay(spark, folder):
    """All orders so far by pay type."""
    return R.order_total(orders(spark, folder), keys=["pay_type"])


@query(
    "dw_order_total_category",
    with_views(
        """SELECT product_category, count(DISTINCT id) AS order_cnt, round(sum(quantity * price), 2) AS order_amt
           FROM shop_order JOIN order_item ON order_id = id GROUP BY product_category""",
        SHOP_ORDER, ORDER_ITEM,
    ),
)
def dw_order_total_category(spark, folder):
    """All orders so far by product category."""
    tasks = tasks_for(table(spark, folder, "lineitem"))
    return R.category_total(orders(spark, folder), items(spark, folder, tasks), tasks)


@query(
    "dw_order_today",
    with_views("SELECT count(*) AS order_cnt, round(coalesce(sum(amount), 0), 2) AS order_amt FROM shop_order WHERE CAST(create_time AS DATE) = DATE '1998-07-15'", SHOP_ORDER),
)
def dw_order_today(spark, folder):
    """The orders of one day."""
    return R.order_total(orders(spark, folder), "1998-07-15")


def _hop(source: str, keys: str, count: str, amount: str, size: int) -> str:
    return f"""
    SELECT make_timestamp((epoch_us(create_time) // {DAY * 1000} - i) * {DAY * 1000}) AS window_start,
           make_timestamp((epoch_us(create_time) // {DAY * 1000} - i + {size}) * {DAY * 1000}) AS window_end,
           {keys} {count} AS order_cnt, round(sum({amount}), 2) AS order_amt
    FROM {source}, (SELECT unnest(range(0, {size})) AS i) GROUP BY ALL"""


@query("dw_order_hop", with_views(_hop("shop_order", "", "count(*)", "amount", 6), SHOP_ORDER))
def dw_order_hop(spark, folder):
    """Orders of the last six days, day by day."""
    return R.recent_orders(orders(spark, folder), 6 * DAY, DAY, [])


@query("dw_order_hop_pay", with_views(_hop("shop_order", "pay_type,", "count(*)", "amount", 5), SHOP_ORDER))
def dw_order_hop_pay(spark, folder):
    """Orders of the last five days by pay type."""
    return R.recent_orders(orders(spark, folder), 5 * DAY, DAY, ["pay_type"])


@query(
    "dw_order_category",
    with_views(
        _hop("(SELECT * FROM shop_order JOIN order_item ON order_id = id)", "pay_type, product_category,", "count(DISTINCT id)", "quantity * price", 10),
        SHOP_ORDER, ORDER_ITEM,
    ),
)
def dw_order_category(spark, folder):
    """Orders of the last ten days by pay type and category."""
    return R.recent_categories(orders(spark, folder), items(spark, folder), 10 * DAY, DAY)


@query(
    "join_order_items",
    with_views(
        """SELECT pay_type, product_category, count(DISTINCT id) AS order_cnt, CAST(sum(quantity) AS BIGINT) AS pieces
           FROM shop_order JOIN order_item ON order_id = id GROUP BY ALL""",
        SHOP_ORDER, ORDER_ITEM,
    ),
)
def join_order_items(spark, folder):
    """Orders joined to their items, by pay type and category."""
    joined = items(spark, folder).join(orders(spark, folder), F.col("order_id") == F.col("id"))
    return joined.groupBy("pay_type", "product_category").agg(
        F.count_distinct("id").alias("order_cnt"), F.sum("quantity").alias("pieces")
    )


@query("dw_cdc_inserts", with_views("SELECT count(*) AS cnt, round(sum(amount), 2) AS amount FROM order_changes WHERE op = '+I'", ORDER_CHANGES))
def dw_cdc_inserts(spark, folder):
    """Only the inserted rows of the change feed."""
    return insert_rows(changes(spark, folder)).agg(
        F.count(F.lit(1)).alias("cnt"), (F.sum(R.cents(F.col("amount"))) / 100).alias("amount")
    )


@query(
    "dw_cdc_mirror",
    with_views(
        """SELECT id, member_id, pay_type, create_time, seq, amount FROM (
             SELECT *, row_number() OVER (PARTITION BY id ORDER BY seq DESC) AS rn FROM order_changes)
           WHERE rn = 1 AND op <> '-D'""",
        ORDER_CHANGES,
    ),
)
def dw_cdc_mirror(spark, folder):
    """The order table that the change feed leads to."""
    return current_rows(changes(spark, folder), ["id"], ["seq"])
