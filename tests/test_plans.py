"""Physical-plan assertions: pushdown, pruning, top-k limits, shuffles, no UDFs."""

import re

import pytest
from pyspark.sql import functions as F

from strata.functions.time import on_date
from strata.operators import ingest, views
from strata.plans.registry import REGISTRY
from strata.sources import bindings as B
from strata.sources.partitioned import read_partitioned
from tests.helpers import envelope, plan_text, post

SF = "/root/testdata/sf0.001"
STREAMING_OR_WRITING = {"scan_partitioned", "partition_counts", "bootstrap_load_posts", "ingest_quarantine",
                        "stream_ingest_quarantine", "ingest_bootstrap_and_live", "posts_per_minute_batches",
                        "dedup_events_batches", "serving_top_posts", "batch_job_views", "streaming_job_views",
                        "reconcile_missing", "posts_per_minute", "comments_per_minute", "user_feed",
                        "stream_decode", "dedup_events", "latest_window", "incremental_subreddit_activity",
                        "serving_merge"}


def test_top_k_plans_a_partial_window_group_limit(spark):
    plan = plan_text(views.top_k_posts(B.posts(spark, SF), k=3), "simple")
    # partial limit below the shuffle on (subreddit, date), final one above it
    partial = plan.index("row_number(), 3, Partial")
    final = plan.index("row_number(), 3, Final")
    exchange = plan.index("Exchange hashpartitioning(subreddit")
    assert final < exchange < partial


def test_event_type_filter_and_column_pruning_reach_the_scan(spark):
    plan = plan_text(views.subreddit_activity(B.posts(spark, SF)))
    assert "PushedFilters: [IsNotNull(event_type), In(event_type, [purchase,signup,view])]" in plan or \
        "In(event_type, [purchase,signup,view])" in plan
    schema = re.search(r"ReadSchema: struct<([^>]*)>", plan).group(1)
    assert "user_id" not in schema and "event_id" in schema


def test_date_filter_is_a_range_on_the_raw_time_column(spark):
    plan = plan_text(views.top_posts(B.posts(spark, SF), date_filter="2024-01-10"))
    pushed = [ln for ln in plan.splitlines() if "PushedFilters" in ln]
    assert any("GreaterThanOrEqual(ts," in ln and "LessThan(ts," in ln for ln in pushed)


def test_date_filter_prunes_stored_partitions(spark, tmp):
    ingest.ingest_batch(envelope(spark, [post("a"), post("b", ts="2024-01-02T00:00:00Z")]), tmp,
                        entities=("posts",))
    plan = plan_text(on_date(read_partitioned(spark, tmp, "posts"), "2024-01-02"))
    pf = re.search(r"PartitionFilters: \[([^\]]*)\]", plan).group(1)
    assert "year" in pf and "month" in pf and "day" in pf


def test_user_activity_is_one_scan_and_one_exchange(spark):
    plan = plan_text(views.user_totals(B.activity(spark, SF)), "simple")
    assert plan.count("FileScan parquet") == 1 and plan.count("Exchange ") == 1
    assert "partial_sum" in plan


def test_equally_active_users_are_sorted_in_several_tasks(spark):
    users = spark.range(40_000).select(F.lit("posts").alias("data_type"), F.col("id").alias("user_id"), "id",
                                       F.lit(1).alias("score"))
    old = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        ranked = views.order_activity(views.user_totals(users))
        sizes = [r["count"] for r in ranked.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", old)
    assert len(sizes) > 4 and max(sizes) < 20_000


def test_speed_views_decode_only_the_fields_they_use(spark, tmp):
    from strata.streaming.runner import VIEW_FIELDS
    envelope(spark, [post("a")]).write.parquet(tmp)
    df = ingest.decode_entity(spark.read.parquet(tmp), "posts", fields=VIEW_FIELDS["posts"])
    plan = plan_text(df, "simple")
    assert "title" not in plan and "content" not in plan and "subreddit" in plan


def test_writes_name_no_fixed_width():
    import pathlib
    import strata
    for path in pathlib.Path(strata.__file__).parent.rglob("*.py"):
        if "llm" not in path.parts:
            text = path.read_text()
            assert not re.search(r"repartition\(\d|coalesce\(\d", text), path


def test_wire_record_is_parsed_once(spark, tmp):
    envelope(spark, [post("a")]).write.parquet(tmp)
    df = ingest.decode_entity(spark.read.parquet(tmp), "posts")
    plan = plan_text(df, "simple")
    assert plan.count("from_json(") == 1


@pytest.mark.parametrize("name", sorted(set(REGISTRY) - STREAMING_OR_WRITING))
def test_registered_queries_have_no_python_udf(spark, name):
    plan = plan_text(REGISTRY[name](spark, SF))
    assert "PythonUDF" not in plan and "EvalPython" not in plan and "MapInPandas" not in plan


def test_entity_routing_prunes_other_topics(spark, tmp):
    from strata.schemas import ENVELOPE
    from strata.sources.kafka import write_envelope
    from tests.helpers import comment
    write_envelope(envelope(spark, [post("a")]).unionByName(envelope(spark, [comment("c")], "comments")), tmp)
    landed = spark.read.schema(ENVELOPE).parquet(tmp)
    plan = plan_text(ingest.decode_entity(landed, "posts"))
    pf = re.search(r"PartitionFilters: \[(.*)\]", plan).group(1)
    assert "topic" in pf
    assert [r.post_id for r in ingest.decode_entity(landed, "posts").collect()] == ["a"]


def test_serving_merge_pushes_the_cutoff_into_the_changelog_scan(spark, tmp):
    import datetime as dt
    from strata.plans import serving
    from strata.streaming.sinks import ChangelogSink, read_latest
    minutes = spark.createDataFrame(
        [(dt.datetime(2024, 1, d), dt.datetime(2024, 1, d, 0, 1), "a", 1, 2, 3, 1) for d in range(1, 20)],
        "window_start timestamp, window_end timestamp, subreddit string, num_posts long, total_score long, "
        "total_comments long, scored long")
    ChangelogSink(f"{tmp}/log")(minutes, 0)
    views.daily_measures(B.posts(spark, SF)).write.parquet(f"{tmp}/daily")
    merged = serving.merge_batch_and_speed(spark.read.parquet(f"{tmp}/daily"),
                                           read_latest(spark, f"{tmp}/log", ["window_start", "subreddit"]),
                                           "2024-01-16")
    plan = plan_text(merged)
    assert re.search(r"PushedFilters: \[[^\n]*GreaterThanOrEqual\(window_start,2024-01-16", plan)
    assert re.search(r"PushedFilters: \[[^\n]*LessThan\(date,2024-01-16\)", plan)


def test_latency_query_parses_each_record_once(spark):
    """The envelope is a union of the post and comment renderings; the parse
    is pushed into each branch, so there is one parse per scanned input."""
    plan = plan_text(REGISTRY["latency_stats"](spark, SF), "simple")
    assert plan.count("from_json(") == plan.count("FileScan parquet") == 2
