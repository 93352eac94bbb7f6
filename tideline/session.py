"""Session settings and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKS_DB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def build_session(app: str = "tideline", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the jobs assume; ``conf`` overrides any of them.

    On a cluster a shuffle starts with many partitions, which Spark merges to about the advisory
    size, so that neither a small nor a very large input needs another setting. In one process
    (tests, benchmarks) there are as many as cores.
    """
    if master and master.startswith("local"):
        cores = master.removeprefix("local").strip("[]").split(",")[0]
        sizes = {"spark.sql.shuffle.partitions": cores if cores.isdigit() else str(os.cpu_count())}
    else:
        sizes = {
            "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "20000",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
        }
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        # Sessions of a large key are merged in each task before they are brought together.
        "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
        STATE_STORE: ROCKS_DB,
        **sizes,
        **conf,
    }
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_folder(spark: SparkSession, purpose: str) -> str:
    """A new, empty path below the shared folder named by ``spark.checkpoint.dir``.

    Executors write there, so a machine-local folder is used only when Spark itself
    runs in one process (tests) and no shared folder is configured.
    """
    context = spark.sparkContext
    base = context.getConf().get("spark.checkpoint.dir") or context.getCheckpointDir()
    if not base:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="tideline-")
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def stored(frame: DataFrame) -> DataFrame:
    """The frame written to the shared folder and read back: its lineage ends there."""
    path = scratch_folder(frame.sparkSession, "stored")
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)
