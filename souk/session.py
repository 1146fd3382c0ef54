"""Session set-up and the shared folder for written intermediate tables."""

from __future__ import annotations

import contextlib
import os
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession


#: State of streams on local disk and in the checkpoint, not on the executors' heap.
STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextlib.contextmanager
def rocksdb_state(spark: SparkSession) -> Iterator[None]:
    """Streams started inside keep their state in RocksDB, whatever the session says otherwise."""
    before = spark.conf.get(STATE_STORE, None)
    spark.conf.set(STATE_STORE, ROCKSDB)
    try:
        yield
    finally:
        spark.conf.set(STATE_STORE, before) if before else spark.conf.unset(STATE_STORE)


#: Removes a query's shuffle files when it ends; else they stay until the driver collects its garbage.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextlib.contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Queries that run inside leave no shuffle files behind."""
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before) if before else spark.conf.unset(SHUFFLE_CLEANUP)


def build_session(app: str = "souk", master: str | None = None, shuffle_partitions: int | None = None) -> SparkSession:
    """A session with the settings the operators rely on (UTC clock, AQE with skew-join splitting)."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config(STATE_STORE, ROCKSDB)
    )
    if master:
        builder = builder.master(master).config("spark.ui.enabled", "false")
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return builder.getOrCreate()


def shared_root(spark: SparkSession) -> str:
    """The folder every executor can reach, as the session names it in ``spark.checkpoint.dir``; without it, an error."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder."""
    return os.path.join(shared_root(spark), "souk", f"{name}-{uuid.uuid4().hex}")


def drop_path(spark: SparkSession, path: str) -> None:
    """Deletes an intermediate table that its writer has replaced and nobody else reads."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder, so that re-runs of lost tasks read the same rows."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_root(df.sparkSession))
    return df.checkpoint(eager=True)
