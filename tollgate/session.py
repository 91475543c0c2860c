"""Spark session settings used by the library, the tests and the benchmark.

Everything here is ordinary session configuration: adaptive execution (runtime
coalescing and skew-join splitting), UTC session time, no web UI, and a shared
checkpoint directory that is only filled in when the cluster did not name one.
"""

from __future__ import annotations

import atexit
import os
import re
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

# Session settings the library relies on.  AQE re-plans joins at runtime (size-checked
# broadcast, skewed-partition splitting); forceOptimizeSkewedJoin lets AQE split a hot
# entity even when the join is followed by an aggregation on the same key (the cascade
# shape), paying one extra shuffle of already partially aggregated rows.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.showConsoleProgress": "false",
    # checkpoint files of tables no longer referenced are removed by the context cleaner
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    # stream-stream cascade joins keep (window + delay) of anchors in state: keep it in
    # RocksDB (off-heap, spills to local disk, incremental changelog checkpoints)
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # sessions of a hot key are merged within each task before the shuffle
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def build_session(master: str | None = None, app: str = "tollgate",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    apply_runtime_conf(spark)
    return spark


def apply_runtime_conf(spark: SparkSession) -> None:
    """Set the SQL settings that the session's owner left unset (a session the driver
    built may carry its own: those stay)."""
    own = dict(spark.conf.getAll)
    for k, v in DEFAULT_CONF.items():
        if k.startswith("spark.sql.") and k not in own and spark.conf.isModifiable(k):
            spark.conf.set(k, v)
    checkpoint_dir(spark)


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the deployment sets it (a shared file system), and we refuse to guess
    one.  Only a local session without it gets a temporary folder, recorded in the session
    so that every later call sees the same.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        master = spark.sparkContext.master
        if not re.fullmatch(r"local(\[[^\]]*\])?", master):
            raise RuntimeError(f"set spark.checkpoint.dir to a folder that all executors of {master} share")
        path = tempfile.mkdtemp(prefix="tollgate-ckpt-")
        atexit.register(shutil.rmtree, path, ignore_errors=True)
        spark.conf.set("spark.checkpoint.dir", path)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(path)
    return path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder for written tables/streams."""
    return os.path.join(checkpoint_dir(spark), f"{name}-{uuid.uuid4().hex[:12]}")
