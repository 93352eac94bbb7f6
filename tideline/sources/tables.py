"""Reading the given Parquet tables, as a batch frame or as a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def table_stream(
    spark: SparkSession, folder: str, name: str, files_per_batch: int | None = None
) -> DataFrame:
    """The same table as a stream of files, each read once.

    The path ends in a one-letter glob so that a table held in a single file and a
    table held in a folder of part files are both accepted by the file source.
    ``files_per_batch`` bounds a micro-batch.
    """
    path = f"{folder}/{name}.parquet"
    reader = spark.readStream.schema(spark.read.parquet(path).schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(f"{path[:-1]}[t]")
