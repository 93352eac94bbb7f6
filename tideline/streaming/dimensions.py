"""A dimension that a stream of updates keeps current, and streams that look it up.

The updates of each micro-batch are one folder of a keyed table; its number is the version. A micro-batch of the rows
reads the version that is complete when the batch first runs and writes that number down before anything else, so the
batch sees the same dimension when it is run again. Spark broadcasts the snapshot if its measured size allows it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline.operators.joins import newest_per_key
from tideline.sinks.tables import append_batch, upsert_batch


class RunningDimension:
    """``keys`` to their newest row by ``order``, in the folder ``path``; ``schema`` is that of the updates."""

    def __init__(self, spark: SparkSession, path: str, keys: list[str], order: list[str], schema: T.StructType):
        self.spark, self.path, self.keys, self.order = spark, path, keys, order
        self.schema = T.StructType([schema[k] for k in keys] + [f for f in schema if f.name not in keys])

    def update(self, batch: DataFrame, number: int) -> None:
        """``foreachBatch`` work of the update stream; a batch that is run again replaces its folder."""
        upsert_batch(batch, f"{self.path}/rows", self.keys, self.order, number)
        # From here on the version can be seen.
        append_batch(_number(self.spark, number), f"{self.path}/versions", number)

    def version(self) -> int:
        """The newest complete version; -1 before the first."""
        return _newest(self.spark, f"{self.path}/versions", -1)

    def as_of(self, version: int) -> DataFrame:
        """The dimension as it was after the updates of ``version``; folders of later ones are not read."""
        if version < 0:
            return self.spark.createDataFrame([], self.schema)
        batches = T.StructType([*self.schema, T.StructField("batch", T.IntegerType())])
        rows = self.spark.read.schema(batches).parquet(f"{self.path}/rows").where(F.col("batch") <= version)
        return newest_per_key(rows, self.keys, ["batch", *self.order]).drop("batch")

    def lookup(self, results: str, pins: str, how: str = "left") -> Callable[[DataFrame, int], None]:
        """``foreachBatch`` work that joins each batch to the version it is pinned to and appends to ``results``."""

        def work(batch: DataFrame, number: int) -> None:
            place = f"{pins}/pin={number}"
            pinned = _newest(self.spark, place, None)
            if pinned is None:
                pinned = self.version()
                _number(self.spark, pinned).write.mode("overwrite").parquet(place)
            dimension = self.as_of(pinned).drop(*self.order)
            append_batch(batch.join(dimension, self.keys, how), results, number)

        return work


def _number(spark: SparkSession, number: int) -> DataFrame:
    return spark.range(1).select(F.lit(number).cast("long").alias("number"))


def _newest(spark: SparkSession, path: str, default: int | None) -> int | None:
    """The largest number stored below ``path``, or ``default`` where nothing complete is."""
    try:
        found = spark.read.schema("number long").parquet(path).agg(F.max("number")).first()[0]
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return default
    return default if found is None else found
