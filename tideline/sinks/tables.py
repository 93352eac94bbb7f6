"""Tables: console, dated warehouse tables, catalog tables and keyed tables.

A keyed table is kept as one folder per batch holding that batch's newest row per key, and
is merged when read. Writing a batch costs the batch, not the table; writing it again
replaces its folder, so a replayed batch changes nothing. ``compact`` merges old folders.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tideline.operators.joins import newest_per_key


def print_rows(frame: DataFrame, n: int = 20) -> None:
    frame.show(n, truncate=False)


def write_dated(frame: DataFrame, path: str, day: str = "dw_date") -> None:
    """Write one folder per day, replacing only the days that ``frame`` holds.

    Rows are dealt by day first, so a day has few files; Spark splits a day that is large.
    """
    (
        frame.hint("rebalance", day)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(day)
        .parquet(path)
    )


def insert_into(frame: DataFrame, name: str, path: str | None = None) -> None:
    """Append to a catalog table, which is created on first use."""
    writer = frame.write.mode("append").format("parquet")
    (writer.option("path", path) if path else writer).saveAsTable(name)


def write_jdbc(frame: DataFrame, options: dict[str, str]) -> None:
    """Append rows over JDBC in batches of ``batchsize``."""
    frame.write.format("jdbc").mode("append").options(**options).save()


def _folder(path: str, batch: int) -> str:
    return f"{path}/batch={batch}"


def upsert_batch(frame: DataFrame, path: str, keys: list[str], order: list[str], batch: int) -> None:
    """Store a batch of new and changed rows; running it again for the batch is harmless."""
    newest_per_key(frame, keys, order).write.mode("overwrite").parquet(_folder(path, batch))


def read_keyed(spark: SparkSession, path: str, keys: list[str], order: list[str]) -> DataFrame:
    """The newest row of each key over all batches."""
    rows = spark.read.parquet(path)
    return newest_per_key(rows, keys, ["batch", *order]).drop("batch")


def compact(spark: SparkSession, path: str, target: str, keys: list[str], order: list[str]) -> None:
    """Write the merged table as batch 0 of a new place, from which upserts go on."""
    read_keyed(spark, path, keys, order).write.mode("overwrite").parquet(_folder(target, 0))


def append_batch(frame: DataFrame, path: str, batch: int) -> None:
    """Store a batch of an append-only result; running it again replaces it."""
    frame.write.mode("overwrite").parquet(_folder(path, batch))


def read_batches(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).drop("batch")
