"""Late records: which ones, and how much the views left out.

A windowed view leaves out a record whose window's end is not after the
watermark. ``LateSink`` finds those records in a query of its own over the same
stream, micro-batch by micro-batch, and writes them whole: nothing is lost
without a trace, and what was late can be counted again by the batch layer. A
view's own filter uses the watermark of the micro-batch before, so with equal
micro-batches each record that a view leaves out is among the late ones.

``DropCounter`` hears of every micro-batch of every query, also of those that
the session's list of recent progress no longer holds, and says so at once.
"""

from __future__ import annotations

import json
import logging
import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from ..session import remove_path
from ..store import newest_number, publish, read_text
from .sinks import ChangelogSink
from .speed import WATERMARK, WINDOW

log = logging.getLogger(__name__)


class LateSink(ChangelogSink):
    """``foreachBatch`` sink over decoded records (not aggregated, without a
    watermark): micro-batch ``n`` writes its late records, with ``window_end``
    and ``watermark``, to ``run=/batch_id=n``, replacing what an earlier attempt
    of it wrote. The highest event time up to each micro-batch is noted beside
    them, so a restart goes on from it and a replay finds the one it had.

    Records without an event time are in no window: neither seen nor late."""

    #: Notes that a replay may need again.
    KEPT = 20

    def __init__(self, path: str, checkpoint: str | None = None, watermark: str = WATERMARK, window: str = WINDOW):
        super().__init__(path, checkpoint)
        self.watermark, self.window = watermark, window
        #: Records seen and found late by this object.
        self.seen = self.late = 0

    def _highest(self, spark: SparkSession, notes: str, batch_id: int) -> int | None:
        """Milliseconds of the highest event time before a micro-batch."""
        number = newest_number(spark, notes)
        number = min(number, batch_id)  # note n is of micro-batch n - 1
        return json.loads(read_text(spark, f"{notes}/{number:09d}.json"))["highest"] if number else None

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if self.run is None:
            self.run = self._run(spark)
        notes = f"{self.path}/run={self.run}/_highest"
        highest = self._highest(spark, notes, batch_id)
        end = F.window("timestamp", self.window).getField("end")
        if highest is None:
            mark, late = F.lit(None).cast("timestamp"), F.lit(False)
        else:
            mark = F.timestamp_millis(F.lit(highest)) - F.expr(f"INTERVAL {self.watermark}")
            late = F.coalesce(F.col("window_end") <= F.col("watermark"), F.lit(False))
        rows = batch.withColumn("window_end", end).withColumn("watermark", mark)
        found = rows.agg(F.max(F.unix_millis("timestamp")).alias("highest"), F.count(F.lit(1)).alias("seen"),
                         F.count_if(late).alias("late")).first()
        if found["late"] or batch_id == 0:  # the first gives the table its columns
            rows.where(late).hint("rebalance").write.mode("overwrite").parquet(
                f"{self.path}/run={self.run}/batch_id={batch_id}")
        now = max((h for h in (highest, found["highest"]) if h is not None), default=None)
        if now is not None:
            publish(spark, notes, batch_id + 1, json.dumps({"highest": now}))
            if batch_id > self.KEPT:
                remove_path(spark, f"{notes}/{batch_id - self.KEPT:09d}.json")
        self.seen, self.late = self.seen + found["seen"], self.late + found["late"]
        if found["late"]:
            log.warning("micro-batch %d: %d of %d records were late", batch_id, found["late"], found["seen"])


def read_late(spark: SparkSession, path: str) -> DataFrame:
    """All late records that a ``LateSink`` has written, with ``batch_id``."""
    return spark.read.option("basePath", path).parquet(path).drop("run")


class DropCounter(StreamingQueryListener):
    """Rows that the stateful operators of each query run left out as late."""

    def __init__(self) -> None:
        self.dropped: dict[str, int] = {}
        self._lock = threading.Lock()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        n = sum(op.numRowsDroppedByWatermark for op in progress.stateOperators)
        if n:
            with self._lock:
                self.dropped[str(progress.runId)] = self.dropped.get(str(progress.runId), 0) + n
            log.warning("query %s, micro-batch %d: %d rows were later than the watermark allows",
                        progress.name or progress.id, progress.batchId, n)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def of(self, spark: SparkSession, q: StreamingQuery) -> int:
        """The rows a query run left out in all micro-batches that have ended."""
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(60_000)  # progress is told asynchronously
        with self._lock:
            return self.dropped.get(str(q.runId), 0)


_counters: list[tuple[object, DropCounter]] = []


def drop_counter(spark: SparkSession) -> DropCounter:
    """The session's counter, added to it by the first call."""
    context = spark.sparkContext
    for held, counter in _counters:
        if held is context:
            return counter
    counter = DropCounter()
    spark.streams.addListener(counter)
    _counters[:] = [*(c for c in _counters if c[0]._jsc is not None), (context, counter)]
    return counter
