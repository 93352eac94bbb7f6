"""Top rows, overall and per group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_n_per_group(
    frame: DataFrame, groups: list[str], order: list[Column], n: int, rank: str | None = None
) -> DataFrame:
    """The first ``n`` rows of each group.

    Spark keeps only ``n`` rows per group and map task before the shuffle when the filter
    on ``row_number`` follows directly, so a large group never travels whole.
    """
    name = rank or "__rank"
    ranked = frame.withColumn(
        name, F.row_number().over(Window.partitionBy(*groups).orderBy(*order))
    ).where(F.col(name) <= n)
    return ranked if rank else ranked.drop(name)


def top_n(frame: DataFrame, order: list[Column], n: int) -> DataFrame:
    """The first ``n`` rows overall; each task sends at most ``n``."""
    return frame.orderBy(*order).limit(n)
