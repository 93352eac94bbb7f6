"""Text, delimited and JSON files, read at once or watched."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Each line of a file or folder as ``value``."""
    return spark.read.text(path)


def watch_lines(spark: SparkSession, folder: str, files_per_batch: int | None = None) -> DataFrame:
    """Lines of the files that appear in a folder.

    A file is read once. Unlike a source that re-reads changed files whole, one that grows
    after it was read is not read again, so producers should write new files.
    """
    reader = spark.readStream
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.text(folder)


def read_delimited(spark: SparkSession, path: str, schema: T.StructType, separator: str = ",") -> DataFrame:
    """Delimited rows with a declared schema; rows that do not fit it are skipped.

    Each line is read in full, whatever columns are asked for later, so the same rows are there for a count and for
    any choice of columns. A field cannot hold a line break.
    """
    broken = "__broken_line"
    full = T.StructType([*schema.fields, T.StructField(broken, T.StringType())])
    options = {"sep": separator, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": broken}
    lines = spark.read.text(path).where(F.col("value") != "")
    read = lines.select(F.from_csv("value", full.simpleString()[7:-1].replace(":", " "), options).alias("row"))
    return read.where(F.col(f"row.{broken}").isNull()).select("row.*").drop(broken)


def from_json_lines(frame: DataFrame, schema: T.StructType, column: str = "value") -> DataFrame:
    """JSON text to typed columns; text that is no JSON gives a row of nulls."""
    return frame.select(F.from_json(F.col(column), schema).alias("record")).select("record.*")


def file_metadata(frame: DataFrame) -> list[Column]:
    """Where a row of a file source comes from."""
    return [
        F.col("_metadata.file_name").alias("file_name"),
        F.col("_metadata.file_block_start").alias("block_start"),
        F.col("_metadata.file_modification_time").alias("modified_at"),
    ]


def sequence(spark: SparkSession, first: int, last: int) -> DataFrame:
    """The numbers ``first`` to ``last`` as ``id``."""
    return spark.range(first, last + 1)


def collection(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    return spark.createDataFrame(rows, schema)
