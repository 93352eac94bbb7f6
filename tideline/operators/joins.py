"""Joins in time: interval, window, as-of, lookup and co-grouped windows.

No side is broadcast by hand. Spark broadcasts a side whose measured size is under its
threshold and otherwise shuffles, splitting skewed partitions at run time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.functions.timing import bucket
from tideline.operators.ordered import MAX_ROWS, ordered, running_last


def newest_per_key(frame: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The newest row of each key, combined before the shuffle."""
    rest = [c for c in frame.columns if c not in keys]
    newest = F.max_by(F.struct(*rest), F.struct(*order))
    return frame.groupBy(*keys).agg(newest.alias("__row")).select(*keys, "__row.*")


def interval_join(
    left: DataFrame, right: DataFrame, keys: list[str], left_time: str, right_time: str, lower: int, upper: int
) -> DataFrame:
    """Pairs with equal keys and ``left_time`` in ``right_time + [lower, upper]`` (ms, inclusive).

    The time bucket joins as an equal key, so a large key is spread over its buckets; a
    right row goes to the at most two buckets its interval touches. Column names of the
    two sides must differ except for the keys.
    """
    width = max(upper - lower, 1)
    low = bucket(F.col(right_time) + lower, width)
    high = bucket(F.col(right_time) + upper, width)
    near = right.withColumn("__bucket", F.explode(F.sequence(low, high)))
    placed = left.withColumn("__bucket", bucket(F.col(left_time), width))
    pairs = placed.join(near, [*keys, "__bucket"]).drop("__bucket")
    distance = F.col(left_time) - F.col(right_time)
    return pairs.where(distance.between(lower, upper))


def window_join(
    left: DataFrame, right: DataFrame, keys: list[str], left_time: str, right_time: str, size: int
) -> DataFrame:
    """Pairs with equal keys whose times fall into the same fixed window."""
    a = left.withColumn("window_start", bucket(F.col(left_time), size) * F.lit(size))
    b = right.withColumn("window_start", bucket(F.col(right_time), size) * F.lit(size))
    joined = a.join(b, [*keys, "window_start"])
    return joined.withColumn("window_end", F.col("window_start") + F.lit(size))


def as_of_join(
    left: DataFrame,
    versions: DataFrame,
    keys: list[str],
    left_order: list[str],
    version_order: list[str],
    columns: list[str],
    max_rows: int = MAX_ROWS,
) -> DataFrame:
    """Left join to the newest version with a time not after the row's own.

    Both sides become one sequence per key and the newest version is carried forward, so
    the cost is one ordered scan; no pair of row and version is ever formed. The columns of
    a version are null where none is old enough, or where a key is null.
    """
    versions = versions.dropna(subset=keys)
    kept = [c for c in left.columns if c not in keys]
    version = F.struct(*[F.col(c) for c in columns])
    left_rows = left.select(
        *keys,
        F.col(left_order[0]).alias("__t"),
        F.lit(1).alias("__side"),
        F.col(left_order[1]).cast("long").alias("__id"),
        F.struct(*kept).alias("__left"),
    )
    version_rows = versions.select(
        *keys,
        F.col(version_order[0]).alias("__t"),
        F.lit(0).alias("__side"),
        F.col(version_order[1]).cast("long").alias("__id"),
        version.alias("__version"),
    )
    sequence = left_rows.unionByName(version_rows, allowMissingColumns=True)
    carried = (
        ordered(sequence, keys, ["__t", "__side", "__id"], max_rows, counted=True)
        .scan(running_last("__seen", F.col("__version")))
        .rows()
    )
    return carried.where(F.col("__side") == 1).select(*keys, "__left.*", "__seen.*")


def lookup_join(rows: DataFrame, dimension: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Rows against the current state of a dimension."""
    return rows.join(dimension, keys, how)


def latest_dimension_join(
    rows: DataFrame, updates: DataFrame, keys: list[str], order: list[str]
) -> DataFrame:
    """Rows against the newest update per key; a miss leaves nulls."""
    newest = newest_per_key(updates, keys, order).drop(*order)
    return rows.join(newest, keys, "left")


def co_group(
    left: DataFrame,
    right: DataFrame,
    keys: list[str],
    left_aggregates: list[Column],
    right_aggregates: list[Column],
) -> DataFrame:
    """Both sides grouped alike and put side by side; a group may lack one side."""
    return left.groupBy(*keys).agg(*left_aggregates).join(
        right.groupBy(*keys).agg(*right_aggregates), keys, "full"
    )
