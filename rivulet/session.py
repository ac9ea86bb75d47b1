"""Session setup, table loading and shared scratch locations."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# The state store of streams with keyed state of their own.
_STATE_STORE = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # Commit RocksDB state by uploading change logs instead of full snapshots.
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}
# Settings every rivulet session wants. Cluster deployments pass their own
# sizes (shuffle partitions, memory); these are only applied when unset.
_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    **_STATE_STORE,
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # Coalesce small shuffle partitions less eagerly than the 1 MB default:
    # joins that expand rows (reach, windows) need the parallelism.
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "256k",
}


def get_spark(master: str | None = None, app: str = "rivulet",
              shuffle_partitions: int | None = None,
              extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with rivulet's defaults.

    ``master`` is only honoured when no session exists yet; on a cluster the
    launcher decides it.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(_DEFAULTS)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and intermediate tables.

    Read from the session (``spark.checkpoint.dir`` / the context's checkpoint
    dir). Only when nothing is configured and the master is local (tests) is a
    private temporary folder created and registered; on a cluster, executors
    would not see it, so a missing setting is an error there.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not re.fullmatch(r"local(\[[^]]*\])?", sc.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="rivulet-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def keyed_state_store(spark: SparkSession) -> None:
    """The store that ``transformWithState`` needs, in a session made without
    :func:`get_spark`: Spark's own default holds no timers or named values and fails
    the query. A store that the caller has chosen stays."""
    provider = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    if provider.endswith("HDFSBackedStateStoreProvider"):
        for key, value in _STATE_STORE.items():
            spark.conf.set(key, value)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique location under the shared checkpoint folder."""
    base = checkpoint_dir(spark)
    return os.path.join(base, "rivulet", f"{name}-{uuid.uuid4().hex[:12]}")


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet under the shared checkpoint folder and
    read it back: several consumers then scan the result (with column
    pruning) instead of recomputing it, and the lineage is cut there."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


_SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """What is executed inside removes its shuffle files when it ends, on all executors.
    Otherwise they stay until the driver happens to collect its garbage."""
    before = spark.conf.get(_SHUFFLE_CLEANUP, "false")
    spark.conf.set(_SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(_SHUFFLE_CLEANUP, before)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Load one of the driver tables (``{sf_dir}/{name}.parquet``, a file or a
    folder of part files) as it is split."""
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))
