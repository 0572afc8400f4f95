"""Spark session and shared-folder helpers."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import SparkSession

# Settings every rivulet job relies on: UTC session time (event time is epoch
# based), ANSI casts (strict parsing is explicit via try_cast), AQE for
# runtime broadcast/skew decisions.
_DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # the store that stateful processors need; checkpoints stay in the shared folder
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def get_spark(app: str = "rivulet", master: str | None = None,
              shuffle_partitions: int | None = None,
              conf: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with rivulet's defaults.

    ``master`` and ``shuffle_partitions`` are only for local runs; on a
    cluster leave them unset so that the submit-time settings win.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    for k, v in _DEFAULT_CONF.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (conf or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for checkpoints and written state.

    Read from ``spark.checkpoint.dir`` (the cluster names it).  Only when it
    is unset on a local master (tests) a fresh folder under the system temp
    dir is taken and registered, so that later calls agree; on a cluster an
    unset folder is an error, never a machine-local path.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = spark.sparkContext.getCheckpointDir()
    if not d:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
        import tempfile
        d = tempfile.mkdtemp(prefix="rivulet-ckpt-")
        spark.sparkContext.setCheckpointDir(d)
        d = spark.sparkContext.getCheckpointDir() or d
    return d.rstrip("/")


def new_folder(spark: SparkSession, *parts: str) -> str:
    """A new, never reused folder below the checkpoint root."""
    return "/".join([checkpoint_root(spark), *parts, uuid.uuid4().hex[:12]])


def local_path(path: str) -> str:
    """Strip a ``file:`` scheme so local test code can list a folder."""
    return path[5:] if path.startswith("file:") else path


def ensure_dir(path: str) -> None:
    p = local_path(path)
    if "://" not in p:
        os.makedirs(p, exist_ok=True)
