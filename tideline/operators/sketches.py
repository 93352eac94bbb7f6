"""Distinct counts from sketches that are kept: one per day and key, united over any days and keys later.

A sketch is a value of a few kilobytes, whatever it has seen. Uniting is a union of sets: the order does not matter
and uniting a sketch with itself changes nothing. HyperLogLog sketches unite; theta sketches also intersect.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Binary logarithm of the number of registers; the relative standard error is about 1.04 / sqrt(2 ** LG_REGISTERS).
LG_REGISTERS = 12


def standard_error(lg: int = LG_REGISTERS) -> float:
    return 1.04 / (1 << lg) ** 0.5


def sketched(frame: DataFrame, day: str, keys: list[str], item: str, lg: int = LG_REGISTERS) -> DataFrame:
    """One sketch of ``item`` per day and key, combined before the shuffle; nulls are no items."""
    return frame.groupBy(day, *keys).agg(F.hll_sketch_agg(item, lg).alias("sketch"))


def united(sketches: DataFrame, keys: list[str]) -> DataFrame:
    """One sketch per key over all days and other keys that ``sketches`` has."""
    return sketches.groupBy(*keys).agg(F.hll_union_agg("sketch").alias("sketch"))


def estimate(sketch: str = "sketch") -> Column:
    return F.hll_sketch_estimate(sketch)


def store_days(sketches: DataFrame, path: str, day: str) -> None:
    """Keep the sketches, a folder per day; a day that is stored again replaces the old one."""
    (
        sketches.repartition(day)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(day)
        .parquet(path)
    )


def common_estimate(frame: DataFrame, keys: list[str], side_a: Column, side_b: Column, item: str, lg: int = 14) -> DataFrame:
    """About how many items occur on both sides per key, by theta sketches of each side."""
    both = frame.groupBy(*keys).agg(
        F.theta_sketch_agg(F.when(side_a, F.col(item)), lg).alias("a"),
        F.theta_sketch_agg(F.when(side_b, F.col(item)), lg).alias("b"),
    )
    return both.select(*keys, F.theta_sketch_estimate(F.theta_intersection("a", "b")).alias("common"))
