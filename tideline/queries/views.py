"""SQL text of the derived records, shared by the checks (DuckDB dialect)."""

_K = "CAST(props->>'$.k' AS INTEGER)"

ACTION_EVENT = f"""
action_event AS (
  SELECT event_id AS log_id, user_id AS guid, ts, epoch_us(ts) // 1000 AS action_time,
         event_type AS event_id, CAST(round(value * 100) AS BIGINT) AS action_timelong,
         CASE {_K} % 4 WHEN 0 THEN 'app' WHEN 1 THEN 'wxapp' WHEN 2 THEN 'h5' ELSE 'web' END AS channel,
         'pg' || lpad(CAST({_K} AS VARCHAR), 3, '0') AS page_id
  FROM events)"""

APP_LOG = f"""
raw_log AS (SELECT *, {_K} AS k FROM events),
app_log AS (
  SELECT event_id AS log_id,
    CASE WHEN user_id % 5 = 0 OR event_id % 3 = 0 THEN ''
         WHEN user_id % 17 = 3 THEN 'guest-' || user_id
         ELSE 'Customer#' || lpad(CAST(user_id AS VARCHAR), 9, '0') END AS account,
    'tide.shop' AS appid, '8.' || (k % 5) AS appversion,
    CASE user_id % 3 WHEN 0 THEN 'carrier-a' WHEN 1 THEN 'carrier-b' ELSE 'carrier-c' END AS carrier,
    CASE WHEN event_id % 97 = 0 THEN '  '
         WHEN user_id % 5 = 0 THEN 'solo' || lpad(CAST(user_id AS VARCHAR), 6, '0')
         ELSE 'dev' || lpad(CAST(user_id // 3 AS VARCHAR), 6, '0') END AS deviceid,
    CASE user_id % 4 WHEN 0 THEN 'phone-a' WHEN 1 THEN 'phone-b' WHEN 2 THEN 'pad-a' ELSE 'pad-b' END AS devicetype,
    CASE WHEN event_id % 101 = 0 THEN '' WHEN event_type = 'signup' THEN 'applaunch'
         WHEN event_type = 'view' THEN 'pageload' WHEN event_type = 'click' THEN 'click'
         WHEN event_type = 'purchase' THEN 'addcart' WHEN event_id // 7 % 3 = 0 THEN 'putback'
         WHEN event_id // 7 % 3 = 1 THEN 'wakeup' ELSE 'appclose' END AS eventid,
    '10.0.' || (user_id % 256) || '.' || k AS ip,
    CASE WHEN event_id % 50 = 7 THEN CAST(95 AS DOUBLE)
         WHEN event_id % 4 = 0 THEN CAST(-30 AS DOUBLE) - (user_id % 10)
         ELSE CAST(20 AS DOUBLE) + CAST(user_id * 37 % 3000 AS DOUBLE) / 100 END AS latitude,
    CAST(80 AS DOUBLE) + CAST(user_id * 53 % 4500 AS DOUBLE) / 100 AS longitude,
    CASE k % 2 WHEN 0 THEN 'WIFI' ELSE '5G' END AS nettype,
    CASE user_id % 2 WHEN 0 THEN 'ios' ELSE 'android' END AS osname,
    '1' || (user_id % 4) AS osversion,
    CASE WHEN event_id % 103 != 0 THEN 'pg' || lpad(CAST(k AS VARCHAR), 3, '0') END AS page,
    CASE k % 4 WHEN 0 THEN 'app' WHEN 1 THEN 'wxapp' WHEN 2 THEN 'h5' ELSE 'web' END AS releasechannel,
    '1024*768' AS resolution, 's' || user_id AS sessionid, epoch_us(ts) // 1000 AS timestamp
  FROM raw_log)"""

MEMBERS = """
members AS (
  SELECT c_custkey AS id, c_name AS account,
         1704067200000 + (c_custkey % 30) * 86400000 AS create_time
  FROM customer)"""


def _position(key: str) -> str:
    return (
        f"CAST(20 AS DOUBLE) + CAST(({key}) * 37 % 3000 AS DOUBLE) / 100 AS lat, "
        f"CAST(80 AS DOUBLE) + CAST(({key}) * 53 % 4500 AS DOUBLE) / 100 AS lng"
    )


AREAS = f"""
areas AS (
  SELECT 1000000000000 + r_regionkey AS id, r_name AS area_name, CAST(NULL AS BIGINT) AS parent_id,
         1 AS level, CAST(NULL AS DOUBLE) AS lat, CAST(NULL AS DOUBLE) AS lng FROM region
  UNION ALL SELECT 2000000000000 + n_nationkey, n_name, 1000000000000 + n_regionkey, 2, NULL, NULL FROM nation
  UNION ALL SELECT 3000000000000 + s_suppkey, s_name, 2000000000000 + s_nationkey, 3, {_position('s_suppkey + 7')} FROM supplier
  UNION ALL SELECT 4000000000000 + c_custkey, c_name, 3000000000000 + c_custkey // 15, 4, {_position('c_custkey')} FROM customer)"""


def geohash5(lat: str, lng: str) -> str:
    """The five-character geohash written out bit by bit."""
    x = f"least(CAST(floor(({lng} + 180) / 360 * 8192) AS BIGINT), 8191)"
    y = f"least(CAST(floor(({lat} + 90) / 180 * 4096) AS BIGINT), 4095)"
    bits = []
    for i in range(25):
        axis, shift = (x, 12 - i // 2) if i % 2 == 0 else (y, 11 - i // 2)
        bits.append(f"(({axis}) >> {shift}) & 1")
    chars = []
    for c in range(5):
        index = " + ".join(f"({bits[5 * c + i]}) * {16 >> i}" for i in range(5))
        chars.append(f"substr('0123456789bcdefghjkmnpqrstuvwxyz', CAST({index} AS INTEGER) + 1, 1)")
    inside = f"{lat} BETWEEN -90 AND 90 AND {lng} BETWEEN -180 AND 180"
    return f"CASE WHEN {inside} THEN {' || '.join(chars)} ELSE '' END"


SHOP_ORDER = """
shop_order AS (
  SELECT o_orderkey AS id, o_custkey AS member_id, o_totalprice AS amount, o_orderpriority AS pay_type,
         o_orderstatus AS order_status, o_orderdate AS create_time
  FROM orders)"""

ORDER_ITEM = """
order_item AS (
  SELECT l_orderkey AS order_id, l_partkey AS product_id, l_extendedprice AS price,
         CAST(l_quantity AS BIGINT) AS quantity, CAST(round(l_discount * 100) AS BIGINT) AS coupon_amount,
         p_type AS product_category
  FROM lineitem JOIN part ON p_partkey = l_partkey)"""

ORDER_CHANGES = """
order_changes AS (
  SELECT o_orderkey AS id, o_custkey AS member_id, o_orderpriority AS pay_type, o_orderdate AS create_time,
         '+I' AS op, 0 AS seq, o_totalprice AS amount FROM orders
  UNION ALL SELECT o_orderkey, o_custkey, o_orderpriority, o_orderdate, '-U', 1, o_totalprice
    FROM orders WHERE o_orderstatus <> 'O'
  UNION ALL SELECT o_orderkey, o_custkey, o_orderpriority, o_orderdate, '+U', 2, o_totalprice + 1
    FROM orders WHERE o_orderstatus <> 'O'
  UNION ALL SELECT o_orderkey, o_custkey, o_orderpriority, o_orderdate, '-D', 3, o_totalprice + 1
    FROM orders WHERE o_orderstatus = 'F' AND o_orderkey % 10 = 0)"""


def with_views(body: str, *views: str) -> str:
    """``body`` may itself open with further named steps, written as ``WITH a AS (...)``."""
    text = body.strip()
    if text[:5].upper() == "WITH ":
        return "WITH " + ",".join(views) + ", " + text[5:]
    return "WITH " + ",".join(views) + "\n" + text
