"""Starting and driving streaming queries."""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..operators.ingest import decode_entity
from ..operators.views import scored_activity
from . import speed
from .late import LateSink, drop_counter
from .sinks import ChangelogSink

log = logging.getLogger(__name__)


def start(df: DataFrame, checkpoint: str, *, output_mode: str = "append", foreach_batch=None,
          path: str | None = None, fmt: str = "parquet", available_now: bool = False,
          processing_time: str | None = None, name: str | None = None) -> StreamingQuery:
    """Every query gets a checkpoint: offsets, commits and state survive a
    restart, so a restarted query resumes instead of reprocessing."""
    drop_counter(df.sparkSession)
    w = df.writeStream.outputMode(output_mode).option("checkpointLocation", checkpoint)
    if name:
        w = w.queryName(name)
    if available_now:
        w = w.trigger(availableNow=True)
    elif processing_time:
        w = w.trigger(processingTime=processing_time)
    if foreach_batch is not None:
        return w.foreachBatch(foreach_batch).start()
    if fmt == "console":
        return w.format("console").option("truncate", "false").start()
    return w.format(fmt).option("path", path).start()


def dropped_rows(q: StreamingQuery, spark: SparkSession | None = None) -> int:
    """Rows that stateful operators left out as later than the watermark
    allows, over all micro-batches of this run of the query. Windowed aggregates
    count rows after partial aggregation, so this tells that rows were lost; the
    records themselves are in the ``late`` view."""
    spark = spark or SparkSession.getActiveSession()
    return drop_counter(spark).of(spark, q)


def run_to_end(q: StreamingQuery, late: str = "report") -> StreamingQuery:
    """Wait for a query's end; its failure is raised. Rows dropped as late
    are logged, or with ``late="raise"`` an error."""
    q.awaitTermination()
    err = q.exception()
    if err is not None:
        raise RuntimeError(f"streaming query failed: {err}")
    _tell(dropped_rows(q), late)
    return q


def _tell(dropped: int, late: str) -> None:
    if dropped:
        said = f"{dropped} rows were later than the watermark allows and are not in the result"
        if late == "raise":
            raise RuntimeError(said)
        log.warning(said)


#: The fields that each speed view reads.
VIEW_FIELDS = {
    "posts": ["post_id", "subreddit", "score", "num_comments"],
    "comments": ["comment_id", "post_id"],
    "users": ["user_id", "username", "karma"],
    "panels": ["user_id"],
    "posts_per_day": ["post_id", "user_id", "subreddit", "title", "score", "num_comments"],
    "post_activity": ["post_id", "user_id", "score"],
    "comment_activity": ["comment_id", "user_id", "score"],
    "late_posts": ["post_id", "user_id", "subreddit", "score", "num_comments"],
    "late_comments": ["comment_id", "post_id", "user_id", "score"],
}

#: Key columns of the changelog tables that the speed views write.
VIEW_KEYS = {
    "posts_per_minute": ["window_start", "subreddit"],
    "comments_per_minute": ["window_start", "post_id"],
    **dict.fromkeys(["active_users", "throughput", "latency", "active_user_sketches"], ["window_start"]),
    "posts_per_day": ["subreddit", "date", "post_id", "title", "user_id"],
    "user_activity_per_day": ["user_id", "side", "date"],
}


def start_speed_views(envelope, out_base: str, checkpoint_base: str, *,
                      views=("posts", "comments", "users"), available_now: bool = False,
                      processing_time: str | None = None, serving: bool = False,
                      console: bool = False, compact_every: int | None = None) -> dict[str, StreamingQuery]:
    """Start the posts, comments and users views of the speed layer, and with
    the view ``panels`` active users, throughput and latency of the posts, and
    with ``totals`` the daily totals of posts and of users that the serving layer
    merges with the batch views. The
    view ``late`` keeps the posts and comments that came after their window
    had closed.

    ``envelope`` is one stream over all topics, or a function
    ``entity -> stream`` (e.g. a Kafka source subscribed to that entity's
    topic only). Windowed views go to changelog serving tables (update
    mode); the user feed is appended to a file sink. With ``console`` the
    comments and users views are printed instead.

    ``compact_every``: after so many micro-batches a view's changelog is folded
    into a snapshot under ``<out_base>/_snapshots/<view>``, from which
    ``read_latest`` goes on."""
    source = envelope if callable(envelope) else (lambda _entity: envelope)
    trig = dict(available_now=available_now, processing_time=processing_time)

    def decoded(entity: str, view: str | None = None) -> DataFrame:
        return decode_entity(source(entity), entity, fields=VIEW_FIELDS[view or entity])

    def changelog(name: str, df: DataFrame) -> StreamingQuery:
        checkpoint = f"{checkpoint_base}/{name}"
        sink = ChangelogSink(f"{out_base}/{name}", checkpoint, VIEW_KEYS[name], f"{out_base}/_snapshots/{name}", compact_every)
        return start(df, checkpoint, output_mode="update", foreach_batch=sink, **trig)

    queries = {}
    if "posts" in views:
        queries["posts"] = changelog("posts_per_minute", speed.posts_per_minute(decoded("posts"), serving=serving))
    if "comments" in views:
        per_minute = speed.comments_per_minute(decoded("comments"))
        queries["comments"] = (start(per_minute, f"{checkpoint_base}/comments_console", output_mode="update", fmt="console", **trig)
                               if console else changelog("comments_per_minute", per_minute))
    if "users" in views:
        feed = speed.user_feed(decoded("users"))
        queries["users"] = start(feed, f"{checkpoint_base}/user_feed{'_console' * console}", output_mode="append",
                                 path=f"{out_base}/user_feed", fmt="console" if console else "parquet", **trig)
    if "panels" in views:
        posts = decoded("posts", "panels")
        for name, df in (("active_users", speed.active_users_per_window(posts)),
                         ("throughput", speed.events_per_minute(posts)), ("latency", speed.latency_per_minute(posts)),
                         ("active_user_sketches", speed.active_user_sketches(posts))):
            queries[name] = changelog(name, df)
    if "totals" in views:
        activity = scored_activity(decoded("posts", "post_activity"), decoded("comments", "comment_activity"))
        for name, df in (("posts_per_day", speed.posts_per_day(decoded("posts", "posts_per_day"))),
                         ("user_activity_per_day", speed.user_activity_per_day(activity))):
            queries[name] = changelog(name, df)
    if "late" in views:
        for entity in ("posts", "comments"):
            name = f"late_{entity}"
            checkpoint = f"{checkpoint_base}/{name}"
            queries[name] = start(decoded(entity, name), checkpoint, foreach_batch=LateSink(f"{out_base}/{name}", checkpoint), **trig)
    return queries


def wait(spark: SparkSession, queries: dict[str, StreamingQuery], available_now: bool, late: str = "report") -> None:
    """Until the input ends, or until a query stops; on an interrupt all are
    stopped (their checkpoints let a restart resume). Rows dropped as late are
    logged micro-batch by micro-batch, and summed up at the end; with
    ``late="raise"`` they are then an error, also of a job that was stopped. A
    query that failed is raised."""
    if available_now:
        for q in queries.values():
            run_to_end(q, late)
        return
    try:
        # Not awaitAnyTermination: it also returns for queries that ended before.
        while all(q.isActive for q in queries.values()):
            next(iter(queries.values())).awaitTermination(1)
    except KeyboardInterrupt:
        pass
    finally:
        for q in queries.values():
            if q.isActive:
                q.stop()
    for q in queries.values():
        if q.exception() is not None:
            raise RuntimeError(f"streaming query failed: {q.exception()}")
    _tell(sum(dropped_rows(q, spark) for q in queries.values()), late)


def run_streaming_job(spark: SparkSession, envelope, out_base: str, checkpoint_base: str, late: str = "report",
                      **kw) -> None:
    """Start the speed views and wait for them."""
    wait(spark, start_speed_views(envelope, out_base, checkpoint_base, **kw), kw.get("available_now", False), late)
