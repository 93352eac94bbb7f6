"""A stream sink in two phases: tasks stage files, and a commit publishes them all at once.

Staged files have names of their own and are invisible. A batch's commit writes one manifest, which names the files,
under a name made from the batch number, in one rename. A batch that is run again after its manifest exists is
committed already: what it staged this time is removed. So a failure before, in or after a commit neither loses nor
repeats a row.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceStreamArrowWriter, WriterCommitMessage


@dataclass
class Staged(WriterCommitMessage):
    """The file a task has staged; no name if it had no rows."""

    name: str
    rows: int


class CommittedWriter(DataSourceStreamArrowWriter):
    def __init__(self, path: str):
        self.path = path

    def _place(self, *names: str) -> tuple[fs.FileSystem, str]:
        system, root = fs.FileSystem.from_uri(self.path)
        return system, "/".join([root.rstrip("/"), *names])

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Staged:
        writer, rows, name = None, 0, f"{uuid.uuid4().hex}.parquet"
        system, target = self._place("data", name)
        try:
            for batch in iterator:
                if not batch.num_rows:
                    continue
                if writer is None:
                    system.create_dir(self._place("data")[1], recursive=True)
                    writer = pq.ParquetWriter(target, batch.schema, filesystem=system)
                writer.write_batch(batch)
                rows += batch.num_rows
        finally:
            if writer is not None:
                writer.close()
        return Staged(name if rows else "", rows)

    def commit(self, messages: list[Staged | None], batchId: int) -> None:
        system, target = self._place("manifests", f"{batchId:012d}.json")
        if system.get_file_info(target).type != fs.FileType.NotFound:
            self.abort(messages, batchId)
            return
        staged = [m for m in messages if m and m.name]
        content = {"batch": batchId, "rows": sum(m.rows for m in staged), "files": [m.name for m in staged]}
        _, draft = self._place("manifests", f"_{batchId:012d}-{uuid.uuid4().hex}")
        system.create_dir(self._place("manifests")[1], recursive=True)
        with system.open_output_stream(draft) as out:
            out.write(json.dumps(content).encode())
        system.move(draft, target)

    def abort(self, messages: list[Staged | None], batchId: int) -> None:
        """Remove what was staged, unless the batch's manifest names it: Spark also gives up batches whose commit failed
        after it had published them."""
        system, manifest = self._place("manifests", f"{batchId:012d}.json")
        kept: set[str] = set()
        if system.get_file_info(manifest).type != fs.FileType.NotFound:
            with system.open_input_stream(manifest) as stream:
                kept = set(json.loads(stream.read())["files"])
        for message in messages:
            if message and message.name and message.name not in kept:
                _, place = self._place("data", message.name)
                if system.get_file_info(place).type != fs.FileType.NotFound:
                    system.delete_file(place)


class CommittedTable(DataSource):
    """``stream.writeStream.format("committed_table").option("path", folder)``"""

    @classmethod
    def name(cls) -> str:
        return "committed_table"

    def streamWriter(self, schema: T.StructType, overwrite: bool) -> CommittedWriter:
        return CommittedWriter(self.options["path"])


def manifests(spark: SparkSession, path: str) -> DataFrame | None:
    """What has been committed: batch, rows and files; None before the first commit."""
    try:
        return spark.read.schema("batch LONG, rows LONG, files ARRAY<STRING>").json(f"{path}/manifests")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def read_committed(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The rows of all committed batches. The driver holds file names, as it does for any table."""
    found = manifests(spark, path)
    files = [] if found is None else [r["f"] for r in found.select(F.explode("files").alias("f")).collect()]
    if not files:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*[f"{path}/data/{name}" for name in files])


def remove_uncommitted(spark: SparkSession, path: str) -> int:
    """Delete staged files that no manifest names; only while no stream writes to the table. Returns how many."""
    found = manifests(spark, path)
    named = set() if found is None else {r["f"] for r in found.select(F.explode("files").alias("f")).collect()}
    system, root = fs.FileSystem.from_uri(path)
    left = [
        f.path
        for f in system.get_file_info(fs.FileSelector(f"{root.rstrip('/')}/data", allow_not_found=True))
        if f.base_name not in named
    ]
    for place in left:
        system.delete_file(place)
    return len(left)


def commit_to(frame: DataFrame, path: str, checkpoint: str, source: type[DataSource] = CommittedTable) -> None:
    """Process what is there and commit each micro-batch to the table."""
    frame.sparkSession.dataSource.register(source)
    query = (
        frame.writeStream.format(source.name())
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
