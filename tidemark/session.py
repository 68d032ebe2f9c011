"""Where written intermediates live, and the session settings the feed expects."""

import tempfile
import uuid

from pyspark.sql import SparkSession

#: Keeps streaming state (one hash per distinct body) on disk instead of on the heap.
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def configure(builder: SparkSession.Builder) -> SparkSession.Builder:
    """Settings that results or plans depend on; sizes stay with the cluster."""
    return (
        builder.config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # a scan task meets few assets: keep their writers open instead of sorting its rows
        .config("spark.sql.maxConcurrentOutputFileWriters", "64")
        .config("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    )


def shared_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only a local-mode session without the setting gets a folder of its own; on a
    cluster a machine-local folder would be lost with its machine.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    context = spark.sparkContext
    if not context.getCheckpointDir():
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="tidemark-"))
    return context.getCheckpointDir().rstrip("/")


def scratch(spark: SparkSession, name: str) -> str:
    """A new, unused folder below the shared one."""
    app = spark.sparkContext.applicationId
    return f"{shared_dir(spark)}/tidemark/{app}/{name}-{uuid.uuid4().hex}"
