"""Streaming ingest into the hour-partitioned store.

One query reads all topics once, parses each record once and writes stored
and quarantined rows together: micro-batch ``n`` is load
``<checkpoint id>-<n>``, which a replay after a failure replaces. Batch and
bootstrap loads use the same writer, so they share the store; no file-sink
log decides what readers see.

The bootstrap dump is a batch load of its own, written before the stream
starts; running it again replaces it.
"""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..operators.ingest import load_rows, route, write_load
from ..sources.bootstrap import ingest_bootstrap
from ..store import compact_store
from .sinks import checkpoint_id


def start_ingest(spark: SparkSession, envelope, base: str, checkpoint_base: str,
                 entities=("posts", "comments", "users"), bootstrap_dir: str | None = None,
                 available_now: bool = False, processing_time: str | None = None,
                 max_future: str | None = None, compact_every: int | None = None) -> dict[str, StreamingQuery]:
    """``envelope`` is one stream over all topics, or a function
    ``entity -> stream``, whose streams are then read by the one query.

    ``compact_every``: after so many micro-batches, days that more than so many
    loads have written are merged (between two micro-batches)."""
    if bootstrap_dir is not None:
        ingest_bootstrap(spark, bootstrap_dir, base, entities)
    source = envelope
    if callable(envelope):
        source = functools.reduce(DataFrame.unionByName, [envelope(e) for e in entities])
    checkpoint = f"{checkpoint_base}/ingest"

    def store(batch: DataFrame, batch_id: int) -> None:
        load = f"{checkpoint_id(batch.sparkSession, checkpoint)}-{batch_id}"
        write_load(load_rows(batch, load, entities, max_future), base, load)
        if compact_every and batch_id % compact_every == compact_every - 1:
            compact_store(batch.sparkSession, base, max_parts=compact_every)

    w = route(source).writeStream.option("checkpointLocation", checkpoint).foreachBatch(store)
    if available_now:
        w = w.trigger(availableNow=True)
    elif processing_time:
        w = w.trigger(processingTime=processing_time)
    return {"ingest": w.start()}
