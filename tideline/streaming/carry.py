"""Ordered jobs over streams.

Each micro-batch is an ordinary frame, cut and scanned like a whole table. What a key has
reached goes into a small table per batch, which the next batch reads. Both that table and
the result are folders named by the batch number and replaced when a batch is run again, so
a restart repeats no row.

Rows must arrive in order from batch to batch; inside a batch they are sorted.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tideline.operators.ordered import MAX_ROWS, OrderedJob, ordered, totals
from tideline.session import scratch_folder
from tideline.sinks.tables import append_batch, read_batches
from tideline.streaming.run import each_batch


def batch_work(
    job: OrderedJob, results: str, state: str, max_rows: int = MAX_ROWS
) -> Callable[[DataFrame, int], None]:
    """The ``foreachBatch`` function that runs ``job`` on each batch after the ones before."""

    def work(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        # Read by the count, by each stage's totals and by the result.
        batch.persist()
        cut = ordered(batch, job.keys, job.order, max_rows, counted=True)
        for i, stage in enumerate(job.stages):
            cut = cut.transform(stage.prepare)
            running = stage.running()
            place = f"{state}/stage={i}"
            since = spark.read.parquet(f"{place}/batch={number - 1}") if number else None
            reached = totals(cut.frame, job.keys, job.order, running, since)
            reached.write.mode("overwrite").parquet(f"{place}/batch={number}")
            cut = cut.scan(*running, since=since)
        append_batch(job.finish(cut.rows()), results, number)
        batch.unpersist()

    return work


def ordered_stream(
    spark: SparkSession, frame: DataFrame, job: OrderedJob, base: str | None = None, max_rows: int = MAX_ROWS
) -> DataFrame:
    """Run the job over what is there now; a given ``base`` lets a later run go on from here."""
    base = base or scratch_folder(spark, "ordered")
    each_batch(frame, batch_work(job, f"{base}/rows", f"{base}/state", max_rows), f"{base}/checkpoint", "append")
    return read_batches(spark, f"{base}/rows")
