"""Session helpers."""

from __future__ import annotations

import tempfile
import time
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"
RUNS = "tidemark-runs"


# Settings the jobs are laid out for; everything else is left to the cluster.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Stream state on executor disks instead of in executor heaps.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}


def create_session(name: str = "tidemark", **settings: str) -> SparkSession:
    """Session for a cluster: master, memory and checkpoint folder come from its defaults."""
    builder = SparkSession.builder.appName(name)
    for key, value in {**SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def local_session(cores: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """Session for tests and the benchmark."""
    return create_session(
        **{
            "spark.master": f"local[{cores}]",
            "spark.sql.shuffle.partitions": str(shuffle_partitions),
            "spark.driver.memory": "8g",
            "spark.ui.enabled": "false",
        }
    )


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach: the session's checkpoint folder.

    Only a local session may go without one; it gets a temporary folder.
    """
    folder = spark.conf.get(CHECKPOINT_SETTING, None)
    if folder:
        return folder.rstrip("/")
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        if not context.master.startswith("local"):
            raise ValueError(f"set {CHECKPOINT_SETTING} to a folder shared by the cluster")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="tidemark-"))
    return context.getCheckpointDir()


def run_folder(spark: SparkSession, name: str) -> str:
    """A new, never used path below the shared folder."""
    return f"{shared_folder(spark)}/{RUNS}/{name}-{uuid.uuid4().hex}"


def clean_runs(spark: SparkSession, older_than_seconds: float) -> int:
    """Remove the run folders that have not changed for so long; how many there were.

    Frames that still read such a folder stop working, so give it longer than any job takes.
    """
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(f"{shared_folder(spark)}/{RUNS}")
    store = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not store.exists(root):
        return 0
    oldest = (time.time() - older_than_seconds) * 1000
    old = [s for s in store.listStatus(root) if s.getModificationTime() <= oldest]
    for status in old:
        store.delete(status.getPath(), True)
    return len(old)
