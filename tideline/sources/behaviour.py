"""The behaviour, order and area records, derived from the given tables.

The given tables hold no channel, device, account, position or session. Each is a fixed
rule on the row's own columns, so the derived records grow with the tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.functions.timing import epoch_millis

# Channel names by props.k modulo 4 and phone models by user modulo 4.
CHANNELS = ["app", "wxapp", "h5", "web"]
MODELS = ["phone-a", "phone-b", "pad-a", "pad-b"]

# First ids of the area tree's levels.
LEVEL_BASE = 1_000_000_000_000


def _with_k(events: DataFrame) -> DataFrame:
    """Adds the number held by the JSON text, as a column of its own so it is parsed once."""
    return events.withColumn("k", F.get_json_object("props", "$.k").cast("int"))


def _pick(names: list[str], index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(n) for n in names]), index.cast("int") + 1)


def _padded(prefix: str, number: Column, width: int) -> Column:
    return F.concat(F.lit(prefix), F.lpad(number.cast("string"), width, "0"))


def latitude(key: Column) -> Column:
    return F.lit(20.0) + (key * 37 % 3000).cast("double") / 100


def longitude(key: Column) -> Column:
    return F.lit(80.0) + (key * 53 % 4500).cast("double") / 100


def action_event(events: DataFrame) -> DataFrame:
    """User actions: who, when, what, how long (hundredths of a second), which channel."""
    return _with_k(events).select(
        F.col("event_id").alias("log_id"),
        F.col("user_id").alias("guid"),
        F.col("ts"),
        epoch_millis(F.col("ts")).alias("action_time"),
        F.col("event_type").alias("event_id"),
        F.round(F.col("value") * 100).cast("long").alias("action_timelong"),
        _pick(CHANNELS, F.col("k") % 4).alias("channel"),
        _padded("pg", F.col("k"), 3).alias("page_id"),
    )


def app_log(events: DataFrame) -> DataFrame:
    """Raw application log lines, with the gaps and faults the cleaning job has to handle."""
    user, log, k, kind = F.col("user_id"), F.col("event_id"), F.col("k"), F.col("event_type")
    turn = F.floor(log / 7) % 3
    action = (
        F.when(log % 101 == 0, "")
        .when(kind == "signup", "applaunch")
        .when(kind == "view", "pageload")
        .when(kind == "click", "click")
        .when(kind == "purchase", "addcart")
        .when(turn == 0, "putback")
        .when(turn == 1, "wakeup")
        .otherwise("appclose")
    )
    account = (
        F.when((user % 5 == 0) | (log % 3 == 0), "")
        .when(user % 17 == 3, F.concat(F.lit("guest-"), user.cast("string")))
        .otherwise(_padded("Customer#", user, 9))
    )
    device = (
        F.when(log % 97 == 0, "  ")
        .when(user % 5 == 0, _padded("solo", user, 6))
        .otherwise(_padded("dev", F.floor(user / 3).cast("long"), 6))
    )
    lat = F.when(log % 50 == 7, 95.0).when(log % 4 == 0, F.lit(-30.0) - (user % 10)).otherwise(latitude(user))
    return _with_k(events).select(
        log.alias("log_id"),
        account.alias("account"),
        F.lit("tide.shop").alias("appid"),
        F.concat(F.lit("8."), (k % 5).cast("string")).alias("appversion"),
        _pick(["carrier-a", "carrier-b", "carrier-c"], user % 3).alias("carrier"),
        device.alias("deviceid"),
        _pick(MODELS, user % 4).alias("devicetype"),
        action.alias("eventid"),
        F.concat(F.lit("10.0."), (user % 256).cast("string"), F.lit("."), k.cast("string")).alias("ip"),
        lat.alias("latitude"),
        longitude(user).alias("longitude"),
        _pick(["WIFI", "5G"], k % 2).alias("nettype"),
        _pick(["ios", "android"], user % 2).alias("osname"),
        F.concat(F.lit("1"), (user % 4).cast("string")).alias("osversion"),
        F.when(log % 103 != 0, F.create_map(F.lit("pageId"), _padded("pg", k, 3))).alias("properties"),
        _pick(CHANNELS, k % 4).alias("releasechannel"),
        F.lit("1024*768").alias("resolution"),
        F.concat(F.lit("s"), user.cast("string")).alias("sessionid"),
        epoch_millis(F.col("ts")).alias("timestamp"),
    )


def members(customer: DataFrame) -> DataFrame:
    """Registered accounts with their numeric id and registration time."""
    day = F.lit(86_400_000).cast("long")
    return customer.select(
        F.col("c_custkey").alias("id"),
        F.col("c_name").alias("account"),
        (F.lit(1_704_067_200_000) + (F.col("c_custkey") % 30) * day).alias("create_time"),
    )


def areas(region: DataFrame, nation: DataFrame, supplier: DataFrame, customer: DataFrame) -> DataFrame:
    """Four-level area tree; levels three and four carry a reference position."""

    def level(frame, number, key, name, parent, lat=None, lng=None):
        none = F.lit(None).cast("double")
        return frame.select(
            (F.lit(number * LEVEL_BASE) + F.col(key)).alias("id"),
            F.col(name).alias("area_name"),
            parent.cast("long").alias("parent_id"),
            F.lit(number).alias("level"),
            (none if lat is None else lat).alias("lat"),
            (none if lng is None else lng).alias("lng"),
        )

    supp, cust = F.col("s_suppkey"), F.col("c_custkey")
    return (
        level(region, 1, "r_regionkey", "r_name", F.lit(None))
        .unionByName(level(nation, 2, "n_nationkey", "n_name", F.col("n_regionkey") + F.lit(LEVEL_BASE)))
        .unionByName(
            level(
                supplier, 3, "s_suppkey", "s_name", F.col("s_nationkey") + F.lit(2 * LEVEL_BASE),
                latitude(supp + 7), longitude(supp + 7),
            )
        )
        .unionByName(
            level(
                customer, 4, "c_custkey", "c_name", F.floor(cust / 15) + F.lit(3 * LEVEL_BASE),
                latitude(cust), longitude(cust),
            )
        )
    )


def shop_order(orders: DataFrame) -> DataFrame:
    return orders.select(
        F.col("o_orderkey").alias("id"),
        F.col("o_custkey").alias("member_id"),
        F.col("o_totalprice").alias("amount"),
        F.col("o_orderpriority").alias("pay_type"),
        F.col("o_orderstatus").alias("order_status"),
        F.col("o_orderdate").alias("create_time"),
    )


def order_item(lineitem: DataFrame, part: DataFrame, tasks: int | None = None) -> DataFrame:
    """Items with their product's category; ``tasks`` deals both sides to that number and broadcasts neither."""
    category = part.select(
        F.col("p_partkey").alias("product_id"), F.col("p_type").alias("product_category")
    )
    item = lineitem.select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_extendedprice").alias("price"),
        F.col("l_quantity").cast("long").alias("quantity"),
        F.round(F.col("l_discount") * 100).cast("long").alias("coupon_amount"),
    )
    if tasks:
        item, category = item.repartition(tasks, "product_id"), category.repartition(tasks, "product_id").hint("merge")
    return item.join(category, "product_id")


def order_changes(orders: DataFrame) -> DataFrame:
    """Change rows of the order table: each order is inserted, some are updated or deleted.

    An update comes as its old row (``-U``) and its new row (``+U``), numbered by ``seq``.
    """
    status, key = F.col("o_orderstatus"), F.col("o_orderkey")

    def change(op: str, seq: int, amount: Column) -> Column:
        return F.struct(F.lit(op).alias("op"), F.lit(seq).alias("seq"), amount.alias("amount"))

    old, new = F.col("o_totalprice"), F.col("o_totalprice") + 1
    inserted = F.array(change("+I", 0, old))
    updated = F.when(
        status != "O", F.array(change("-U", 1, old), change("+U", 2, new))
    ).otherwise(F.array().cast("array<struct<op:string,seq:int,amount:double>>"))
    deleted = F.when(
        (status == "F") & (key % 10 == 0), F.array(change("-D", 3, new))
    ).otherwise(F.array().cast("array<struct<op:string,seq:int,amount:double>>"))
    return orders.select(
        key.alias("id"),
        F.col("o_custkey").alias("member_id"),
        F.col("o_orderpriority").alias("pay_type"),
        F.col("o_orderdate").alias("create_time"),
        F.explode(F.concat(inserted, updated, deleted)).alias("change"),
    ).select("id", "member_id", "pay_type", "create_time", "change.*")
