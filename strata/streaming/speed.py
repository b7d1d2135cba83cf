"""Speed-layer views: event-time windows over decoded record streams.

The same functions accept a batch DataFrame (with a ``timestamp`` of type
timestamp): the watermark is then a no-op, which is how the stream result is
checked against the batch result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.quality import judged
from ..operators.views import USER_MEASURES, user_totals

# Lateness allowed before a window closes, and the window size.
WATERMARK = "10 minutes"
WINDOW = "1 minute"

#: The percentiles' rank error is below one in this many records of a window.
SKETCH_ACCURACY = 1_000
#: Size of the distinct-count sketches, as a power of two: a relative standard
#: error of about 1.04 / sqrt(2 ** 12), 1.6 %, and none for a few hundred users.
SKETCH_LG_K = 12
#: Groups over which the copies of one key are spread.
SPREAD = 32


def _flatten(df: DataFrame, *rest: str) -> DataFrame:
    return df.select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), *rest)


def posts_per_minute(posts: DataFrame, watermark: str = WATERMARK, window: str = WINDOW,
                     serving: bool = False) -> DataFrame:
    """Posts and score per (minute, subreddit).

    ``serving=True`` also carries ``total_comments`` and ``scored`` so the
    minute rows can later be rolled up and merged with the daily batch view
    without losing a measure or the exact average.
    """
    aggs = [F.count("post_id").alias("num_posts"), F.sum("score").alias("total_score")]
    if serving:
        aggs += [F.sum("num_comments").alias("total_comments"), F.count("score").alias("scored")]
    out = (posts.withWatermark("timestamp", watermark)
           .groupBy(F.window("timestamp", window), F.col("subreddit"))
           .agg(*aggs))
    names = [a for a in ("num_posts", "total_score", "total_comments", "scored") if a in out.columns]
    return _flatten(out, "subreddit", *names)


def comments_per_minute(comments: DataFrame, watermark: str = WATERMARK, window: str = WINDOW) -> DataFrame:
    out = (comments.withWatermark("timestamp", watermark)
           .groupBy(F.window("timestamp", window), F.col("post_id"))
           .agg(F.count("comment_id").alias("num_comments")))
    return _flatten(out, "post_id", "num_comments")


def user_feed(users: DataFrame) -> DataFrame:
    """Users record by record (append)."""
    return users.select("user_id", "username", "karma", "created_utc", "timestamp")


def active_users_per_window(records: DataFrame, watermark: str = WATERMARK, window: str = "1 hour") -> DataFrame:
    """Streaming form of active users: distinct counts are not supported on
    streams, so the HyperLogLog++ estimate is used (bounded state)."""
    out = (records.withWatermark("timestamp", watermark)
           .groupBy(F.window("timestamp", window))
           .agg(F.approx_count_distinct("user_id").alias("active_users")))
    return _flatten(out, "active_users")


def events_per_minute(records: DataFrame, watermark: str = WATERMARK, window: str = WINDOW) -> DataFrame:
    """Streaming throughput: records per event-time minute and per second."""
    out = (records.withWatermark("timestamp", watermark)
           .groupBy(F.window("timestamp", window))
           .agg(F.count(F.lit(1)).alias("events")))
    return _flatten(out, "events").withColumn("per_second", F.col("events") / F.lit(60.0))


def latency_per_minute(records: DataFrame, watermark: str = WATERMARK, window: str = WINDOW) -> DataFrame:
    """Streaming pipeline latency: broker arrival minus event time, per
    event-time minute: count, mean, max and the 50th and 95th percentile. The
    state of a minute is a quantile sketch of bounded size, whatever the number
    of records; partial sketches of all tasks and micro-batches are merged."""
    lat_ms = (F.unix_micros(F.col("_arrival")) - F.unix_micros(F.col("timestamp"))) / F.lit(1000.0)
    out = (records.withWatermark("timestamp", watermark)
           .groupBy(F.window("timestamp", window))
           .agg(F.count(lat_ms).alias("n"), F.avg(lat_ms).alias("avg_ms"), F.max(lat_ms).alias("max_ms"),
                F.percentile_approx(lat_ms, [0.5, 0.95], SKETCH_ACCURACY).alias("q"))
           .withColumns({"p50_ms": F.col("q")[0], "p95_ms": F.col("q")[1]}))
    return _flatten(out, "n", "avg_ms", "max_ms", "p50_ms", "p95_ms")


def active_user_sketches(records: DataFrame, watermark: str = WATERMARK, window: str = "1 hour") -> DataFrame:
    """Distinct users of each window as a sketch (``users``, binary), which other
    layers and longer windows can merge; of a stream or of a batch."""
    out = (records.withWatermark("timestamp", watermark).where("user_id IS NOT NULL")
           .groupBy(F.window("timestamp", window))
           .agg(F.hll_sketch_agg(F.col("user_id").cast("string"), SKETCH_LG_K).alias("users")))
    return _flatten(out, "users")


def posts_per_day(posts: DataFrame, watermark: str = WATERMARK) -> DataFrame:
    """Totals per post and day, as the batch view of top posts has them. The
    state is the open day's posts; a day closes with the watermark."""
    out = (posts.withWatermark("timestamp", watermark)
           .groupBy(F.window("timestamp", "1 day"), "subreddit", "post_id", "title", "user_id")
           .agg(F.sum("score").alias("total_score"), F.sum("num_comments").alias("total_comments")))
    return out.select("subreddit", F.to_date("window.start").alias("date"), "post_id", "title", "user_id",
                      "total_score", "total_comments")


def user_activity_per_day(records: DataFrame, watermark: str = WATERMARK) -> DataFrame:
    """Activity per user and day from (data_type, user_id, id, score, timestamp)
    records of posts and comments. The state is the open day's users."""
    out = user_totals(records.withWatermark("timestamp", watermark), [F.window("timestamp", "1 day")])
    return out.select("user_id", "side", F.to_date("window.start").alias("date"), *USER_MEASURES)


def dedup_within_watermark(records: DataFrame, keys: list[str], watermark: str = WATERMARK) -> DataFrame:
    """Drop redelivered records. An id alone is not unique (producers
    restart their counters), so keys include the event time; state for a
    key is kept until the watermark passes it.

    Streaming deduplication has no map-side step: all copies of one key in a
    micro-batch meet in one task. Where a redelivery storm of one key is
    possible, use ``dedup_spread``; the batch form
    (``operators.quality.dedup``) pre-aggregates."""
    return records.withWatermark("timestamp", watermark).dropDuplicatesWithinWatermark(keys)


def dedup_spread(records: DataFrame, keys: list[str], watermark: str = WATERMARK, spread: int = SPREAD) -> DataFrame:
    """``dedup_within_watermark`` in two steps, for records that still have their
    place in the log (``_topic``, ``_partition``, ``_offset``): the copies of a key
    are first spread over ``spread`` groups by that place, which keep one each, so
    the second step gets at most ``spread`` copies of a key however often it was
    delivered. The place, unlike a random number, is the same in a retried task.

    A key delivered ``n`` times within the watermark holds min(n, spread) + 1
    entries of state; the result is that of the plain form."""
    group = F.pmod(F.xxhash64("_topic", "_partition", "_offset"), F.lit(spread))
    return (records.withWatermark("timestamp", watermark).withColumn("_group", group)
            .dropDuplicatesWithinWatermark([*keys, "_group"]).drop("_group")
            .dropDuplicatesWithinWatermark(keys))


def reconcile_within_watermark(produced: DataFrame, landed: DataFrame, key: str, watermark: str = WATERMARK) -> DataFrame:
    """``quality.reconcile`` of two streams of (key, timestamp), as their event
    time closes: the keys that were produced and landed a different number of
    times, with their event time.

    Both streams are counted together, in one state per key and event time (a
    key alone is not unique), with a map-side step, so a hot key costs one row a
    task. A join of two counts would keep each count in its own state and in the
    join's. Both watermarks bound the state: a key is judged once, when the slower
    stream's watermark has passed it. A copy that lands later still is not counted
    (it is among the late records). Records without an event time are on neither
    side; those without a key match none of the other side."""
    def side(records: DataFrame, name: str) -> DataFrame:
        return (records.where("timestamp IS NOT NULL").withWatermark("timestamp", watermark)
                .select(key, "timestamp", F.lit(name).alias("_side")))
    apart = F.when(F.col(key).isNull(), F.col("_side")).alias("_apart")
    counts = (side(produced, "produced").unionByName(side(landed, "landed")).groupBy(key, "timestamp", apart)
              .agg(*(F.count_if(F.col("_side") == name).alias(name) for name in ("produced", "landed"))))
    return judged(counts.drop("_apart"))
