"""Streaming sinks and the serving-table read side.

Spark's file sinks accept only append mode, while the windowed views run in
update mode. ``ChangelogSink`` makes update mode durable and idempotent:
micro-batch ``batch_id`` overwrites exactly the folder
``run=<checkpoint id>/batch_id=<id>``, so a batch replayed after a failure
replaces its own earlier attempt. A changelog belongs to one checkpoint: with
a new one batch ids start again, so the sink refuses a folder that another
checkpoint has written. Readers take the newest row per key
(``read_latest``); ``compact`` folds the changelog into a snapshot.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.views import latest_per_key
from ..session import remove_path, subfolders


def checkpoint_id(spark: SparkSession, checkpoint: str) -> str:
    """The id of the query that owns a checkpoint; a restart keeps it."""
    return json.loads(spark.read.text(f"{checkpoint.rstrip('/')}/metadata").first()[0])["id"]


class ChangelogSink:
    """``checkpoint``: the query's checkpoint, whose id names the run.

    A micro-batch's updates are rebalanced, so few updates make one file and
    many make as many as their size asks for.

    With ``compact_every`` the changelog is folded into a snapshot, under
    ``snapshot``, after so many micro-batches, between two of them; what readers
    no longer need is removed, so the number of folders stays bounded however
    long the query runs."""

    def __init__(self, path: str, checkpoint: str | None = None, keys: list[str] | None = None,
                 snapshot: str | None = None, compact_every: int | None = None):
        if compact_every and not (keys and snapshot):
            raise ValueError("compact_every needs the table's keys and a folder for snapshots")
        self.path = path.rstrip("/")
        self.checkpoint = checkpoint
        self.keys, self.snapshot, self.compact_every = keys, snapshot, compact_every
        self.run: str | None = None

    def _run(self, spark: SparkSession) -> str:
        run = checkpoint_id(spark, self.checkpoint) if self.checkpoint else "none"
        others = [f for f in subfolders(spark, self.path) if f.startswith("run=") and f != f"run={run}"]
        if others:
            raise RuntimeError(f"{self.path} belongs to another checkpoint ({others[0]}); use a new folder")
        return run

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        if self.run is None:
            self.run = self._run(batch.sparkSession)
        batch.hint("rebalance").write.mode("overwrite").parquet(f"{self.path}/run={self.run}/batch_id={batch_id}")
        if self.compact_every and batch_id % self.compact_every == self.compact_every - 1:
            compact(batch.sparkSession, self.path, self.keys, self.snapshot, remove=True)


def _read_log(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("basePath", path).parquet(path).drop("run")


def _newest_snapshot(spark: SparkSession, path: str | None) -> str | None:
    found = [f for f in subfolders(spark, path) if f.startswith("upto=")] if path else []
    return f"{path.rstrip('/')}/{max(found, key=lambda f: int(f.split('=')[1].split('.')[0]))}" if found else None


def read_latest(spark: SparkSession, path: str, keys: list[str], snapshot: str | None = None) -> DataFrame:
    """Newest row per key. With a ``snapshot`` folder written by ``compact``,
    only the batches after it are read from the changelog (``batch_id`` is a
    partition column, so older batch folders are pruned, not scanned)."""
    log = _read_log(spark, path)
    newest = _newest_snapshot(spark, snapshot)
    if newest is not None:
        upto = int(newest.rsplit("=", 1)[1].split(".")[0])
        log = log.filter(F.col("batch_id") > upto).unionByName(spark.read.parquet(newest).select(*log.columns))
    values = [c for c in log.columns if c not in keys and c != "batch_id"]
    return latest_per_key(log, keys, "batch_id", values).drop("batch_id")


def compact(spark: SparkSession, path: str, keys: list[str], snapshot_path: str, remove: bool = False) -> DataFrame:
    """Fold the changelog into a new snapshot: the newest row per key with
    the batch it came from. It starts from the last snapshot and reads only
    the batches after it, and writes ``upto=<batch>`` beside it, so readers
    of the old snapshot are not disturbed.

    ``remove`` deletes what readers no longer need: snapshots before the last
    one and the batches that it held."""
    path, snapshot_path = path.rstrip("/"), snapshot_path.rstrip("/")
    log = _read_log(spark, path)
    last = _newest_snapshot(spark, snapshot_path)
    if last is not None:
        done = int(last.rsplit("=", 1)[1].split(".")[0])
        log = log.filter(F.col("batch_id") > done).unionByName(spark.read.parquet(last).select(*log.columns))
    upto = max((int(b.split("=")[1]) for r in subfolders(spark, path) if r.startswith("run=")
                for b in subfolders(spark, f"{path}/{r}") if b.startswith("batch_id=")), default=-1)
    values = [c for c in log.columns if c not in keys and c != "batch_id"]
    out = f"{snapshot_path}/upto={upto}.{uuid.uuid4().hex[:8]}"
    latest_per_key(log.filter(F.col("batch_id") <= upto), keys, "batch_id", values).write.parquet(out)
    if remove and last is not None:
        for f in subfolders(spark, snapshot_path):
            if f.startswith("upto=") and f not in (last.rsplit("/", 1)[1], out.rsplit("/", 1)[1]):
                remove_path(spark, f"{snapshot_path}/{f}")
        for r in subfolders(spark, path):
            for b in subfolders(spark, f"{path}/{r}"):
                if b.startswith("batch_id=") and int(b.split("=")[1]) <= done:
                    remove_path(spark, f"{path}/{r}/{b}")
    return spark.read.parquet(out)


class IndexSink:
    """Optional adapter: upsert micro-batches into a search index through
    its Spark connector (not installed here). The document id is the
    serving key, so a replayed batch overwrites the same documents."""

    def __init__(self, resource: str, id_column: str = "key", options: dict[str, str] | None = None,
                 fmt: str = "org.elasticsearch.spark.sql"):
        self.resource, self.id_column, self.options, self.fmt = resource, id_column, dict(options or {}), fmt

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        (batch.write.format(self.fmt).mode("append").options(**self.options)
         .option("es.mapping.id", self.id_column).option("es.write.operation", "upsert")
         .save(self.resource))
