"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    # Keys remembered by a stream live on disk, not in the executor's heap.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    # Recording the Python line of every Column costs more than planning does.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(
    app: str = "lakemart",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    **extra: str,
) -> SparkSession:
    """A session with adaptive execution on and the zone pinned to UTC.

    ``shuffle_partitions`` is only an upper start value: adaptive execution
    merges small partitions, so give it generously on a large cluster.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder for stream checkpoints and interim tables.

    It lies in the cluster's shared ``spark.checkpoint.dir``.  Only a local
    session may go without that setting and gets a temporary folder: on a
    cluster each machine would write to its own.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    name = f"{label}-{uuid.uuid4().hex[:12]}"
    if shared:
        return f"{shared.rstrip('/')}/{name}"
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
    return tempfile.mkdtemp(prefix=f"{name}-")
