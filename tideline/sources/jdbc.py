"""Database tables over JDBC: dimensions and column stores that speak it.

The driver jar must be on the class path. Reads are split on a numeric column, so a large
table comes in through many tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def jdbc_options(
    url: str,
    table: str,
    user: str,
    password: str,
    split: tuple[str, int, int, int] | None = None,
    rows_per_trip: int = 10_000,
) -> dict[str, str]:
    """Options for reading or writing; ``split`` is (column, lowest, highest, parts)."""
    options = {
        "url": url,
        "dbtable": table,
        "user": user,
        "password": password,
        "fetchsize": str(rows_per_trip),
        "batchsize": str(rows_per_trip),
    }
    if split:
        column, low, high, parts = split
        options.update(
            partitionColumn=column, lowerBound=str(low), upperBound=str(high), numPartitions=str(parts)
        )
    return options


def read_table(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    return spark.read.format("jdbc").options(**options).load()
