"""Batch views over decoded records.

Every function is a pure ``DataFrame -> DataFrame`` transformation: nothing
here writes, so each view runs unchanged on a stored table, on a binding of
the test tables, and (where it has no global sort) on a micro-batch.

Input records carry the fields of ``strata.schemas`` with ``timestamp``
already parsed into a timestamp (``timestamp`` or ``timestamp_ntz``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.time import as_wall_clock, day_of, on_date


# --- V1 ---------------------------------------------------------------------------------------

def post_totals(posts: DataFrame, date_filter=None) -> DataFrame:
    """Totals per post and day (unordered form of ``top_posts``)."""
    if date_filter is not None:
        posts = on_date(posts, date_filter)
    return (posts.withColumn("date", day_of("timestamp"))
            .groupBy("subreddit", "date", "post_id", "title", "user_id")
            .agg(F.sum("score").alias("total_score"),
                 F.sum("num_comments").alias("total_comments")))


def top_posts(posts: DataFrame, date_filter=None) -> DataFrame:
    """Per-post totals per subreddit and day, newest day first, then
    subreddit, then highest score (every group is kept: this is the full
    ranking, ``top_k_posts`` cuts it)."""
    return post_totals(posts, date_filter).orderBy(
        F.col("date").desc(), F.col("subreddit"), F.col("total_score").desc())


def top_k_posts(posts: DataFrame, k: int = 3, date_filter=None) -> DataFrame:
    """The k best posts per (subreddit, day); ties go to the lower post_id,
    then user_id and title (ids are reused), so the order is total.

    Written as ``row_number() <= k`` so the planner inserts a partial
    ``WindowGroupLimit`` before the shuffle: a (subreddit, day) holding a
    large share of all posts sends at most k rows per map task.
    """
    if k < 1:
        raise ValueError("k must be >= 1")
    return best_posts(post_totals(posts, date_filter), k)


def best_posts(totals: DataFrame, k: int) -> DataFrame:
    """The k best of each subreddit and day, of ``post_totals`` rows."""
    w = Window.partitionBy("subreddit", "date").orderBy(F.col("total_score").desc(), "post_id", "user_id", "title")
    return totals.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


# --- V2 ---------------------------------------------------------------------------------------

#: What adds up over a user's days.
USER_MEASURES = ["num_posts", "post_score", "num_comments", "comment_score"]


def scored_activity(posts: DataFrame, comments: DataFrame) -> DataFrame:
    """Posts and comments as one (data_type, user_id, id, score, timestamp) table."""
    return (posts.select(F.lit("posts").alias("data_type"), "user_id", F.col("post_id").alias("id"), "score", "timestamp")
            .unionByName(comments.select(F.lit("comments").alias("data_type"), "user_id",
                                         F.col("comment_id").alias("id"), "score", "timestamp")))


def user_totals(records: DataFrame, by: list | None = None) -> DataFrame:
    """Activity per user (and ``by``, if given) from (data_type, user_id, id,
    score) records: one aggregation with one exchange. A user seen on one side
    only has zeros on the other. Records without a user are not one user's: they
    come out as one row a side, told apart by ``side`` (NULL for every real user)."""
    def measure(kind: str, number: Column) -> Column:
        return F.coalesce(F.sum(F.when(F.col("data_type") == kind, number)), F.lit(0))
    counted = F.col("id").isNotNull().cast("bigint")
    return (records.withColumn("side", F.when(F.col("user_id").isNull(), F.col("data_type")))
            .groupBy("user_id", "side", *(by or [])).agg(
                measure("posts", counted).alias("num_posts"), measure("posts", F.col("score")).alias("post_score"),
                measure("comments", counted).alias("num_comments"),
                measure("comments", F.col("score")).alias("comment_score"))
            .withColumn("total_activity", F.col("num_posts") + F.col("num_comments"))
            .withColumn("total_score", F.col("post_score") + F.col("comment_score")))


def user_activity_unordered(posts: DataFrame, comments: DataFrame) -> DataFrame:
    return user_totals(scored_activity(posts, comments))


def user_day_totals(records: DataFrame) -> DataFrame:
    """``user_totals`` per day, without what is derived: rows that add up."""
    return user_totals(records.withColumn("date", day_of("timestamp")), ["date"]).select(
        "user_id", "side", "date", *USER_MEASURES)


def finish_user_totals(days: DataFrame) -> DataFrame:
    """``user_totals`` of all days from rows per user and day."""
    return (days.groupBy("user_id", "side").agg(*(F.sum(m).alias(m) for m in USER_MEASURES))
            .withColumn("total_activity", F.col("num_posts") + F.col("num_comments"))
            .withColumn("total_score", F.col("post_score") + F.col("comment_score")))


def order_activity(totals: DataFrame) -> DataFrame:
    """Most active first. Equally active users are ordered by id, so the sort
    deals them over its tasks instead of putting all ties into one."""
    return totals.orderBy(F.col("total_activity").desc(), F.col("user_id").asc_nulls_last(), "side").drop("side")


def user_activity(posts: DataFrame, comments: DataFrame) -> DataFrame:
    return order_activity(user_activity_unordered(posts, comments))


def user_days(posts: DataFrame, comments: DataFrame) -> DataFrame:
    """Posts and comments per user and day: a full outer join of the two
    sides' daily counts, zeros where a user has only one of them that day."""
    def side(df: DataFrame, name: str) -> DataFrame:
        return df.groupBy("user_id", day_of("timestamp").alias("date")).agg(
            F.count(F.lit(1)).alias(f"num_{name}"), F.sum("score").alias(f"{name}_score"))
    both = side(posts, "posts").join(side(comments, "comments"), ["user_id", "date"], "full_outer")
    return both.fillna(0, subset=["num_posts", "posts_score", "num_comments", "comments_score"])


def top_contributors(posts: DataFrame, comments: DataFrame, k: int = 10) -> DataFrame:
    """Global top-k users by activity, user_id breaking ties (a
    ``TakeOrderedAndProject``: k rows per task reach the driver)."""
    return best_contributors(user_activity_unordered(posts, comments), k)


def best_contributors(totals: DataFrame, k: int = 10) -> DataFrame:
    return order_activity(totals).limit(k).select(
        "user_id", "num_posts", "num_comments", "total_activity", "total_score")


# --- V3 ---------------------------------------------------------------------------------------

def daily_measures(posts: DataFrame) -> DataFrame:
    """Additive measures per (subreddit, day). ``scored`` (non-NULL scores)
    lets a merge of several sources re-derive the average exactly."""
    return (posts.withColumn("date", day_of("timestamp"))
            .groupBy("subreddit", "date")
            .agg(F.count("post_id").alias("num_posts"),
                 F.sum("score").alias("total_score"),
                 F.sum("num_comments").alias("total_comments"),
                 F.count("score").alias("scored")))


def finish_daily(measures: DataFrame) -> DataFrame:
    return measures.select(
        "subreddit", "date", "num_posts", "total_score", "total_comments",
        (F.col("total_score").cast("double") / F.nullif(F.col("scored"), F.lit(0))).alias("avg_score"))


def subreddit_activity_unordered(posts: DataFrame) -> DataFrame:
    return (posts.withColumn("date", day_of("timestamp"))
            .groupBy("subreddit", "date")
            .agg(F.count("post_id").alias("num_posts"),
                 F.sum("score").alias("total_score"),
                 F.sum("num_comments").alias("total_comments"),
                 F.avg("score").alias("avg_score")))


def subreddit_activity(posts: DataFrame) -> DataFrame:
    return subreddit_activity_unordered(posts).orderBy(F.col("date").desc(), F.col("num_posts").desc())


# --- trends, rankings, activity (documented views) ----------------------------------------------

def subreddit_trend(posts: DataFrame) -> DataFrame:
    """Daily posts per subreddit and the change against the previous day
    with posts. The window runs over the daily series (days x subreddits
    rows), never over raw posts."""
    daily = subreddit_activity_unordered(posts)
    w = Window.partitionBy("subreddit").orderBy("date")
    return daily.select("subreddit", "date", "num_posts",
                        (F.col("num_posts") - F.lag("num_posts").over(w)).alias("delta"))


def user_activity_daily(posts: DataFrame, comments: DataFrame) -> DataFrame:
    return daily_user_activity(activity(posts, comments))


def daily_user_activity(records: DataFrame) -> DataFrame:
    """Posts and comments per user and day from (data_type, user_id,
    timestamp) records in one aggregation, plus the change against the
    user's previous active day (a window over per-day rows only)."""
    is_post = (F.col("data_type") == "posts").cast("int")
    daily = (records.select("user_id", day_of("timestamp").alias("date"), is_post.alias("is_post"))
             .groupBy("user_id", "date").agg(
                 F.sum("is_post").alias("num_posts"),
                 F.sum(1 - F.col("is_post")).alias("num_comments"),
                 F.count(F.lit(1)).alias("total_activity")))
    w = Window.partitionBy("user_id").orderBy("date")
    return daily.withColumn("delta", F.col("total_activity") - F.lag("total_activity").over(w))


def top_subreddits(posts: DataFrame, k: int = 5) -> DataFrame:
    return (posts.groupBy("subreddit").agg(F.count("post_id").alias("num_posts"))
            .orderBy(F.col("num_posts").desc(), F.col("subreddit").asc_nulls_last())
            .limit(k))


def activity(posts: DataFrame, comments: DataFrame) -> DataFrame:
    """Posts and comments as one (data_type, user_id, timestamp) stream."""
    return (posts.select(F.lit("posts").alias("data_type"), "user_id", "timestamp")
            .unionByName(comments.select(F.lit("comments").alias("data_type"), "user_id", "timestamp")))


def active_users(records: DataFrame, unit: str = "hour") -> DataFrame:
    """Distinct active users per time bucket. Spark expands the distinct
    into (bucket, user) partial aggregates, so a busy bucket or user never
    lands whole in one task."""
    return (records.filter(F.col("timestamp").isNotNull())
            .groupBy(as_wall_clock(F.date_trunc(unit, "timestamp")).alias("window_start"))
            .agg(F.countDistinct("user_id").alias("active_users")))


def throughput_per_minute(records: DataFrame) -> DataFrame:
    """Records per minute of event time and the implied rate per second."""
    return (records.filter(F.col("timestamp").isNotNull())
            .groupBy(as_wall_clock(F.date_trunc("minute", "timestamp")).alias("window_start"))
            .agg(F.count(F.lit(1)).alias("events"))
            .withColumn("per_second", F.col("events") / F.lit(60.0)))


def load_summary(posts: DataFrame, comments: DataFrame, users: DataFrame) -> DataFrame:
    """Row count per entity: three global aggregates (one partial count per
    task each) unioned, instead of three separate actions."""
    def one(df, name):
        return df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("data_type"), "n")
    return one(posts, "posts").unionByName(one(comments, "comments")).unionByName(one(users, "users"))


def partition_counts(table: DataFrame) -> DataFrame:
    """Landed rows per stored hour partition."""
    return table.groupBy("year", "month", "day", "hour").agg(F.count(F.lit(1)).alias("n"))


def latest_per_key(df: DataFrame, keys: list[str], order_col: str, values: list[str]) -> DataFrame:
    """Most recent row per key, as an aggregate (``max_by``) rather than a
    sort: partial aggregation keeps one candidate per key per task."""
    packed = F.struct(*[F.col(v) for v in values])
    return (df.groupBy(*keys)
            .agg(F.max(order_col).alias(order_col), F.max_by(packed, F.col(order_col)).alias("_v"))
            .select(*keys, order_col, "_v.*"))
