"""Row-wise work: parsing, routing and splitting, all as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def parse_delimited(frame: DataFrame, column: str, schema: T.StructType, separator: str) -> DataFrame:
    """Split text into typed columns; a part that does not fit its type becomes null."""
    parts = F.split(F.col(column), f"\\Q{separator}\\E")
    fields = [
        F.get(parts, F.lit(i)).try_cast(field.dataType).alias(field.name)
        for i, field in enumerate(schema)
    ]
    return frame.select(*fields)


def complete_rows(frame: DataFrame) -> DataFrame:
    """Drop rows in which any column failed to parse."""
    return frame.dropna("any")


def split_rows(frame: DataFrame, column: str, separator: str) -> DataFrame:
    """One row per separated part of a packed text column."""
    return frame.withColumn(column, F.explode(F.split(F.col(column), f"\\Q{separator}\\E")))


def route(frame: DataFrame, rules: dict[str, Column], otherwise: str, column: str = "route") -> DataFrame:
    """Name the first rule each row meets. A branch is then a filter on that name."""
    choice = None
    for name, condition in rules.items():
        choice = F.when(condition, name) if choice is None else choice.when(condition, name)
    return frame.withColumn(column, choice.otherwise(otherwise))


def branch(frame: DataFrame, name: str, column: str = "route") -> DataFrame:
    return frame.where(F.col(column) == name).drop(column)


#: Rows a task of a sort or a grouping by many keys gets.
ROWS_PER_TASK = 100_000


def tasks_for(frame: DataFrame, rows: int | None = None) -> int:
    """How many tasks give each about ``rows`` rows of a frame, which is counted: cheap for a table, not for a join.

    Merging of small partitions goes by their compressed size and by the number of cores, so what a task holds in
    memory could grow with the input.
    """
    return tasks_of(frame.count(), rows)


def tasks_of(count: int, rows: int | None = None) -> int:
    """How many tasks give each about ``rows`` of ``count`` rows."""
    return max(1, -(-count // (rows or ROWS_PER_TASK)))
