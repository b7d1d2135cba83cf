"""Serving: incremental batch recompute and the batch + speed merge."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.time import midnight, on_dates, parse_day
from ..operators import views
from ..session import remove_path
from ..sources.partitioned import read_partitioned
from ..store import newest_number, publish, touched_days

MEASURES = ["num_posts", "total_score", "total_comments", "scored"]

# Key columns of each serving table.
SERVING_KEYS = {
    "top_posts": ["subreddit", "date", "post_id", "title", "user_id"],
    "top_k_posts": ["subreddit", "date", "rank"],
    "user_activity": ["user_id", "side"],
    "subreddit_activity": ["subreddit", "date"],
    "posts_per_minute": ["window_start", "subreddit"],
    "comments_per_minute": ["window_start", "post_id"],
    "posts_per_day": ["subreddit", "date", "post_id", "title", "user_id"],
    "user_activity_per_day": ["user_id", "side", "date"],
}


def with_serving_key(df: DataFrame, keys: list[str]) -> DataFrame:
    """Add ``key``: the key columns joined by ``|``, usable as a document id.

    Different keys give different texts: ``\\`` and ``|`` inside a value are
    escaped with ``\\``, and a NULL is spelled ``\\N``, which no value is."""
    def part(k: str):
        text = F.col(k).cast("string")
        return F.coalesce(F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("|"), F.lit("\\|")), F.lit("\\N"))
    return df.withColumn("key", F.concat_ws("|", *(part(k) for k in keys if k in df.columns)))


def serving_tables(views_by_name: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Views with their ``key`` column. Minute tables expose ``window_start`` as
    their ``event_time``, the time field a dashboard reads."""
    out = {name: with_serving_key(df, SERVING_KEYS[name]) for name, df in views_by_name.items()}
    return {name: df.withColumn("event_time", F.col("window_start")) if "window_start" in df.columns else df
            for name, df in out.items()}


def load_serving(views_by_name: dict[str, DataFrame], path: str, one_day: bool = False) -> None:
    """Write views as serving tables with a ``key`` column, in place; tables with a
    ``date`` are partitioned by it, and ``one_day`` replaces only the days at
    hand. ``published.publish_views`` of ``serving_tables`` leaves no gap."""
    for name, out in serving_tables(views_by_name).items():
        if "date" in out.columns:
            w = out.hint("rebalance", "date").write.partitionBy("date")
        else:
            w = out.write
        mode = "dynamic" if one_day and "date" in out.columns else "static"
        w.mode("overwrite").option("partitionOverwriteMode", mode).parquet(f"{path.rstrip('/')}/{name}")


def write_daily(posts: DataFrame, path: str, days=None) -> None:
    """Write the additive daily measures partitioned by ``date``.

    With ``days`` exactly those day partitions are replaced: the hourly job
    touches the days that received data and leaves every other day as it is.
    A day without any rows left loses its partition. Rerunning it is
    idempotent.
    """
    path = path.rstrip("/")
    if days is not None:
        days = [parse_day(d) for d in days]
        posts = on_dates(posts, days)
    measures = views.daily_measures(posts)
    if days is not None:  # a few rows for each day and community
        measures = measures.where(F.col("date").isin(days))
    (measures.hint("rebalance", "date").write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic" if days is not None else "static").partitionBy("date").parquet(path))
    if days is not None:
        spark = posts.sparkSession
        held = {r["date"] for r in posts.select(F.to_date("timestamp").alias("date")).distinct().collect()}
        for d in set(days) - held:  # only of the days asked for
            remove_path(spark, f"{path}/date={d.isoformat()}")


def refresh_daily(spark: SparkSession, store: str, path: str) -> list[str]:
    """Bring the daily table up to the store's newest version: the days that
    its loads changed since the last refresh are counted anew, from their own
    folders, and all others are left as they are. The days refreshed.

    The version reached is noted beside the table after the days are written, so
    an interrupted refresh is done again."""
    noted = f"{path.rstrip('/')}/_refreshed"
    days, version = touched_days(spark, store, "posts", since=newest_number(spark, noted))
    if days:
        write_daily(read_partitioned(spark, store, "posts", days=days, version=version), path, days=days)
    if version > newest_number(spark, noted):
        publish(spark, noted, version, "{}")
    return days


def read_daily(spark: SparkSession, path: str) -> DataFrame:
    return views.finish_daily(spark.read.parquet(path))


def merge_batch_and_speed(batch_daily: DataFrame, speed_minutes: DataFrame, cutoff) -> DataFrame:
    """One daily view: closed days (before the UTC midnight ``cutoff``) from
    the batch layer, later days from speed-layer minutes rolled up to the
    day. The ranges are disjoint, measures are summed and the average is
    re-derived from sum and count, never averaged twice."""
    cut = parse_day(cutoff)
    b = batch_daily.filter(F.col("date") < F.lit(cut)).select("subreddit", "date", *MEASURES)
    s = (speed_minutes.filter(F.col("window_start") >= midnight(cut, speed_minutes.schema["window_start"].dataType))
         .select("subreddit", F.to_date("window_start").alias("date"), *MEASURES))
    merged = (b.unionByName(s).groupBy("subreddit", "date")
              .agg(*[F.sum(m).alias(m) for m in MEASURES]))
    return views.finish_daily(merged)


def merge_top_posts(batch_totals: DataFrame, speed_days: DataFrame, cutoff, k: int | None = None) -> DataFrame:
    """Top posts of both layers: days before ``cutoff`` from the batch view's
    totals, later ones from ``speed.posts_per_day``; with ``k`` the best of each
    subreddit and day. The layers share no day, so nothing is added twice, and
    each task sends on at most ``k`` rows of a group."""
    cut = F.lit(parse_day(cutoff))
    columns = ["subreddit", "date", "post_id", "title", "user_id", "total_score", "total_comments"]
    both = (batch_totals.where(F.col("date") < cut).select(*columns)
            .unionByName(speed_days.where(F.col("date") >= cut).select(*columns)))
    return both if k is None else views.best_posts(both, k)


def write_user_days(records: DataFrame, path: str, days=None) -> None:
    """The batch side of user activity: what adds up, per user and day, from
    (data_type, user_id, id, score, timestamp) records, partitioned by ``date``;
    with ``days`` only those partitions are written."""
    if days is not None:
        records = on_dates(records, days)
    (views.user_day_totals(records).where("date IS NOT NULL").hint("rebalance", "date").write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic" if days is not None else "static").partitionBy("date").parquet(path))


def merge_user_activity(batch_days: DataFrame, speed_days: DataFrame, cutoff) -> DataFrame:
    """User activity of both layers, unordered: a user's days before ``cutoff``
    from ``write_user_days``, later ones from ``speed.user_activity_per_day``."""
    cut = F.lit(parse_day(cutoff))
    columns = ["user_id", "side", *views.USER_MEASURES]
    return views.finish_user_totals(batch_days.where(F.col("date") < cut).select(*columns).unionByName(
        speed_days.where(F.col("date") >= cut).select(*columns)))


def merge_active_users(batch: DataFrame, speed: DataFrame, cutoff, window: str = "1 hour") -> DataFrame:
    """Distinct users per window of both layers' hourly sketches (``users``), by
    merging them: windows of any multiple of an hour, also across the cutoff."""
    def side(df: DataFrame, before: bool) -> DataFrame:
        at = midnight(parse_day(cutoff), df.schema["window_start"].dataType)
        return df.where(F.col("window_start") < at if before else F.col("window_start") >= at).select("window_start", "users")
    return (side(batch, True).unionByName(side(speed, False))
            .groupBy(F.window("window_start", window).getField("start").alias("window_start"))
            .agg(F.hll_sketch_estimate(F.hll_union_agg("users")).alias("active_users")))
