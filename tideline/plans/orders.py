"""Order reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.functions.timing import epoch_millis
from tideline.operators.windows import hop_sums


def cents(amount: Column) -> Column:
    """Money in whole cents: sums of these do not depend on the order of summing."""
    return F.round(amount * 100).cast("long")


def order_total(orders: DataFrame, day: str | None = None, keys: list[str] = ()) -> DataFrame:
    """Number and amount of all orders, or of one day's, in all or by ``keys``."""
    if day:
        orders = orders.where(
            (F.col("create_time") >= F.lit(day).cast("timestamp_ntz"))
            & (F.col("create_time") < F.date_add(F.lit(day).cast("date"), 1).cast("timestamp_ntz"))
        )
    return orders.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("order_cnt"),
        (F.coalesce(F.sum(cents(F.col("amount"))), F.lit(0)) / 100).alias("order_amt"),
    )


def category_total(orders: DataFrame, items: DataFrame, tasks: int | None = None) -> DataFrame:
    """Orders so far and their amount by product category; an order counts once in a category.

    ``tasks`` (``rows.tasks_for``) deals the items and orders to that number of tasks.
    """
    if tasks:
        items, orders = items.repartition(tasks, "order_id"), orders.repartition(tasks, "id").hint("merge")
    joined = items.select("order_id", "product_category", "quantity", "price").join(
        orders.select("id"), F.col("order_id") == F.col("id")
    )
    per_order = joined.groupBy("id", "product_category").agg(
        F.sum(F.col("quantity") * cents(F.col("price"))).alias("amount")
    )
    return per_order.groupBy("product_category").agg(
        F.count(F.lit(1)).alias("order_cnt"), (F.sum("amount") / 100).alias("order_amt")
    )


def recent_orders(orders: DataFrame, size: int, slide: int, keys: list[str], whole: bool = False) -> DataFrame:
    """Number and amount of the orders of the last ``size`` ms, moved on each ``slide``.

    ``whole`` says that amounts are cents already.
    """
    sums = hop_sums(
        orders, epoch_millis(F.col("create_time")), size, slide, keys,
        {"order_cnt": F.lit(1), "order_amt": F.col("amount") if whole else cents(F.col("amount"))},
    )
    return sums.withColumn("order_amt", F.col("order_amt") / 100)


def recent_categories(orders: DataFrame, items: DataFrame, size: int, slide: int) -> DataFrame:
    """Orders and amount by pay type and category over sliding windows.

    One row per order and category is formed first, on the partitioning of the join; an
    order has one time, so counting those rows per window counts distinct orders.
    """
    joined = items.select("order_id", "product_category", "quantity", "price").join(
        orders.select("id", "pay_type", "create_time"), F.col("order_id") == F.col("id")
    )
    per_order = joined.groupBy("id", "pay_type", "create_time", "product_category").agg(
        F.sum(F.col("quantity") * cents(F.col("price"))).alias("amount")
    )
    return recent_orders(per_order, size, slide, ["pay_type", "product_category"], whole=True)
