"""Session construction and shared-storage helpers.

All times are handled in UTC: the day partition of the stored tables, the
``date`` of the batch views and the one-minute windows of the speed layer all
assume ``spark.sql.session.timeZone=UTC``.
"""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.ansi.enabled": "true",
    "spark.ui.enabled": "false",
    # Streaming state is a RocksDB store: it spills to disk instead of
    # holding every open window on the JVM heap.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # Commit only the changes of a micro-batch instead of a full snapshot.
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # Skip the extra lookup per state write that only feeds a row-count metric.
    "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false",
}


def build_session(master: str | None = None, app_name: str = "strata",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for k, v in DEFAULT_CONF.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    return spark


def ensure_utc(spark: SparkSession) -> None:
    """The engine's date and window semantics are defined in UTC."""
    if spark.conf.get("spark.sql.session.timeZone", None) != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for checkpoints and intermediate tables.

    Taken from the session (``spark.checkpoint.dir`` or a directory already
    set on the context). Only a local-mode session without one gets a
    private temporary folder, which is what tests use; on a cluster the
    setting is required because executors must see the same path.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:  # a remote session has no local context
        sc = None
    if not root and sc is not None:
        root = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not root:
        master = sc.master if sc is not None else (spark.conf.get("spark.master", None) or "")
        if not re.fullmatch(r"local(\[[^\]]*\])?", master):  # one process; local-cluster is not
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        root = tempfile.mkdtemp(prefix="strata-ckpt-")
        if sc is not None:
            sc.setCheckpointDir(root)
    elif sc is not None and not sc.getCheckpointDir():
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never-reused folder under the shared checkpoint root."""
    return f"{checkpoint_root(spark)}/strata/{name}-{uuid.uuid4().hex[:12]}"


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder exists, in whatever store the path names."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def remove_path(spark: SparkSession, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def subfolders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders directly in ``path``."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    return sorted(f.getPath().getName() for f in fs.listStatus(p) if f.isDirectory()) if fs.exists(p) else []
