"""Session settings and the shared working folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Runtime settings every job relies on. All of them can be set on a live session.
RUNTIME = {
    # DATE, DATE_TRUNC and HOUR follow the session zone.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}

# State lives off-heap and is shipped as change logs, not as whole snapshots.
STREAMING = {
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def build_session(
    app: str = "gridsky",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    **extra: str,
) -> SparkSession:
    """A session with the settings above.

    On a cluster leave ``master`` and ``shuffle_partitions`` unset and let
    spark-submit supply them; both are for local runs.
    """
    builder = SparkSession.builder.appName(app).config("spark.ui.enabled", "false")
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    # Recording the Python line of every column costs several calls per operator.
    builder = builder.config("spark.python.sql.dataFrameDebugging.enabled", "false")
    for name, value in {**RUNTIME, **STREAMING, **extra}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def apply_runtime(spark: SparkSession) -> SparkSession:
    for name, value in RUNTIME.items():
        spark.conf.set(name, value)
    return spark


def streaming_session(spark: SparkSession, state_partitions: int | None = None) -> SparkSession:
    """A sibling session for streaming queries; the caller's settings stay as they are.

    The shuffle width is frozen into a checkpoint at the first run, and AQE does
    not coalesce stateful shuffles. It is the session's width, or ``state_partitions``.
    """
    child = spark.newSession()
    width = state_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    for name, value in {**RUNTIME, **STREAMING}.items():
        child.conf.set(name, value)
    child.conf.set("spark.sql.shuffle.partitions", str(width))
    return child


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, named by ``spark.checkpoint.dir``.

    Only a local-mode session without that setting gets a temporary folder: there the
    driver's folders are the executors' too.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    folder = tempfile.mkdtemp(prefix="gridsky-")
    spark.sparkContext.setCheckpointDir(folder)
    return shared_dir(spark)


def fresh_dir(spark: SparkSession, label: str) -> str:
    """A path under the shared folder that no other run uses. Not created here."""
    return os.path.join(shared_dir(spark), "gridsky", f"{label}-{uuid.uuid4().hex}")
