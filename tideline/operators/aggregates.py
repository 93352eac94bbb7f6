"""Grouped aggregation. All of it uses aggregates that combine before the shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.operators.ordered import MAX_ROWS, ordered, running_count


def word_count(frame: DataFrame, column: str, pattern: str = r"\s+") -> DataFrame:
    words = frame.select(F.explode(F.split(F.col(column), pattern)).alias("word"))
    return words.where(F.col("word") != "").groupBy("word").agg(F.count(F.lit(1)).alias("cnt"))


def extreme_row(
    frame: DataFrame, keys: list[str], value: str, tie: str, largest: bool = True
) -> DataFrame:
    """The whole row holding the extreme value of each key; ``tie`` ascending decides.

    ``value`` is a number. A row without it is no extreme; a key with such rows only has nulls.
    """
    rest = [c for c in frame.columns if c not in keys]
    rank = -F.col(value) if largest else F.col(value)
    best = F.min_by(F.struct(*rest), F.when(F.col(value).isNotNull(), F.struct(rank, F.col(tie))))
    return frame.groupBy(*keys).agg(best.alias("__row")).select(*keys, "__row.*")


def sum_keeping_row(
    frame: DataFrame, keys: list[str], value: str, order: list[str], keep: str
) -> DataFrame:
    """Sum one field per key and keep the other fields of the first or the last row."""
    rest = [c for c in frame.columns if c not in keys and c != value]
    pick = {"first": F.min_by, "last": F.max_by}[keep]
    grouped = frame.groupBy(*keys).agg(
        F.sum(value).alias(value), pick(F.struct(*rest), F.struct(*order)).alias("__row")
    )
    return grouped.select(*keys, value, "__row.*")


def concat_in_order(
    frame: DataFrame,
    keys: list[str],
    text: str,
    order: list[str],
    rows_per_part: int,
    separator: str,
    max_rows: int = MAX_ROWS,
) -> DataFrame:
    """Join strings per key in order, ``rows_per_part`` rows to a result.

    A key's whole text has no bound, so it comes in numbered parts; read in part order they
    are the text of the key.
    """
    placed = ordered(frame, keys, order, max_rows, counted=True).scan(running_count("__at")).rows()
    part = F.floor((F.col("__at") - 1) / F.lit(rows_per_part)).cast("long")
    entry = F.struct(*order, F.col(text).alias("__text"))
    joined = F.array_join(
        F.transform(F.array_sort(F.collect_list(entry)), lambda e: e["__text"]), separator
    )
    return placed.groupBy(*keys, part.alias("part")).agg(joined.alias("joined"))


def distinct_by_bitmap(frame: DataFrame, keys: list[str], number: str, name: str) -> DataFrame:
    """Exact distinct count of a BIGINT column through fixed-size bitmaps per bucket."""
    per_bucket = (
        frame.where(F.col(number).isNotNull())
        .groupBy(*keys, F.bitmap_bucket_number(number).alias("__bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position(number)).alias("__bits"))
    )
    return per_bucket.groupBy(*keys).agg(F.sum(F.bitmap_count("__bits")).alias(name))


def common_by_bitmap(frame: DataFrame, condition_a: Column, condition_b: Column, number: str) -> DataFrame:
    """How many numbers occur under both conditions: bitmaps of each side, then AND."""

    def bits(condition: Column) -> DataFrame:
        return (
            frame.where(condition)
            .groupBy(F.bitmap_bucket_number(number).alias("__bucket"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position(number)).alias("__bits"))
        )

    both = bits(condition_a).unionByName(bits(condition_b)).groupBy("__bucket").agg(
        F.bitmap_and_agg("__bits").alias("__bits"), F.count(F.lit(1)).alias("__sides")
    )
    return both.where(F.col("__sides") == 2).agg(
        F.coalesce(F.sum(F.bitmap_count("__bits")), F.lit(0)).cast("long").alias("common")
    )


def counts_as_text(frame: DataFrame, keys: list[str], item: str) -> DataFrame:
    """Counts per item as ``a=1,b=2``, items in name order.

    Counting first leaves one row per (key, item), so only the distinct items are collected.
    """
    counted = frame.groupBy(*keys, item).agg(F.count(F.lit(1)).alias("__n"))
    pairs = F.map_from_entries(F.array_sort(F.collect_list(F.struct(item, "__n"))))
    text = F.array_join(
        F.transform(
            F.map_entries("__map"),
            lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string")),
        ),
        ",",
    )
    return counted.groupBy(*keys).agg(pairs.alias("__map")).select(*keys, text.alias("counts"))
