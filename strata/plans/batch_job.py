"""The batch layer as a job: load the store, count, write the three views."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators import views
from ..sources.partitioned import read_partitioned
from .published import publish_views
from .serving import load_serving, serving_tables


def compute_views(posts: DataFrame, comments: DataFrame, date_filter=None,
                  top_k: int | None = None) -> dict[str, DataFrame]:
    """The three batch views, unordered (a stored table has no order;
    readers sort with the ordered forms in ``operators.views``), plus the
    k best posts per subreddit and day when ``top_k`` is given."""
    out = {
        "top_posts": views.post_totals(posts, date_filter),
        "user_activity": views.user_activity_unordered(posts, comments),
        "subreddit_activity": views.subreddit_activity_unordered(posts),
    }
    if top_k:
        out["top_k_posts"] = views.top_k_posts(posts, k=top_k, date_filter=date_filter)
    return out


def write_views(computed: dict[str, DataFrame], output: str, fmt: str = "parquet",
                one_day: bool = False) -> None:
    """Replace each view in place (``publish_views`` leaves no gap). Views with a day are partitioned by it; when they
    were computed for one day only (``one_day``) the other days stay."""
    for name, df in computed.items():
        if "date" in df.columns:
            # one task per day (split if large) instead of every task writing every day
            w = df.hint("rebalance", "date").write.partitionBy("date")
        else:
            w = df.write
        mode = "dynamic" if one_day and "date" in df.columns else "static"
        w.mode("overwrite").option("partitionOverwriteMode", mode).format(fmt).save(f"{output.rstrip('/')}/{name}")


def run_batch_job(spark: SparkSession, store: str, output: str, fmt: str = "parquet",
                  date_filter=None, store_format: str = "parquet", top_k: int | None = None,
                  serving_path: str | None = None, versions: bool = False) -> DataFrame:
    """Load posts, comments and users from the store, write the views (and
    with ``serving_path`` their serving tables with keys) and
    return the load summary (one job for all three counts). With ``versions``
    the views are shown all at once as the next version of ``output`` (and of
    ``serving_path``) instead of being written over the ones before.

    Nothing is cached: each view reads only the Parquet columns it needs
    (users only for their count), which at scale is cheaper than holding
    a full copy of the posts table in executor memory or local disk."""
    posts = read_partitioned(spark, store, "posts", store_format)
    comments = read_partitioned(spark, store, "comments", store_format)
    users = read_partitioned(spark, store, "users", store_format)
    summary = views.load_summary(posts, comments, users)
    computed = compute_views(posts, comments, date_filter, top_k)
    if versions:
        days = None if date_filter is None else [date_filter]
        publish_views(spark, computed, output, fmt, days)
        if serving_path is not None:
            publish_views(spark, serving_tables(computed), serving_path, days=days)
        return summary
    write_views(computed, output, fmt, one_day=date_filter is not None)
    if serving_path is not None:
        load_serving(computed, serving_path, one_day=date_filter is not None)
    return summary
