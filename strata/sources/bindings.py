"""Bindings of the driver's test tables to the forum entities.

``events`` holds both posts (types view, purchase, signup) and comments
(types click, error); ``customer`` holds the users. The bindings are plain
projections, so Catalyst prunes the Parquet read to the columns a view
uses and pushes the ``event_type`` filter into the scan.

The ``*_json`` / ``envelope`` helpers render the same rows the way they
arrive on the wire (one JSON object per record inside a Kafka-style
envelope) so that the ingest and streaming paths run over data Spark
derives from the test tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.time import iso_string
from ..schemas import TOPIC_PREFIX

# Fixed values of the binding: which event types are posts and which are
# comments, and the text patterns of generated titles and contents.
POST_TYPES = ["view", "purchase", "signup"]
COMMENT_TYPES = ["click", "error"]
TITLE_PREFIX = "Post title "
USERS_SINCE = "2024-01-01 00:00:00"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _score() -> Column:
    return F.round(F.col("value") * 100).cast("bigint")


def _k() -> Column:
    return F.get_json_object("props", "$.k").cast("bigint")


def posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    return ev.filter(F.col("event_type").isin(POST_TYPES)).select(
        F.col("event_id").alias("post_id"), "user_id", F.col("event_type").alias("subreddit"),
        F.concat(F.lit(TITLE_PREFIX), F.col("event_id").cast("string")).alias("title"),
        _score().alias("score"), _k().alias("num_comments"), F.col("ts").alias("timestamp"))


def comments(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    return ev.filter(F.col("event_type").isin(COMMENT_TYPES)).select(
        F.col("event_id").alias("comment_id"), _k().alias("post_id"), "user_id",
        _score().alias("score"), F.col("ts").alias("timestamp"))


def activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Posts and comments as (data_type, user_id, id, score, timestamp) in one
    scan of ``events`` (the union of the two bindings would scan it twice)."""
    ev = table(spark, sf_dir, "events")
    kind = F.when(F.col("event_type").isin(POST_TYPES), F.lit("posts")).otherwise(F.lit("comments"))
    return ev.filter(F.col("event_type").isin(POST_TYPES + COMMENT_TYPES)).select(
        kind.alias("data_type"), "user_id", F.col("event_id").alias("id"), _score().alias("score"),
        F.col("ts").alias("timestamp"))


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    cu = table(spark, sf_dir, "customer")
    return cu.select(F.col("c_custkey").alias("user_id"), F.col("c_name").alias("username"),
                     F.round("c_acctbal").cast("bigint").alias("karma"))


# --- wire format ------------------------------------------------------------------------------

def _s(c: str) -> Column:
    return F.col(c).cast("string")


def post_json(ev: DataFrame) -> DataFrame:
    """events (post types) → (id, event_time, value JSON) in the post schema."""
    t = iso_string(F.col("ts"))
    rec = F.struct(_s("event_id").alias("post_id"), _s("user_id").alias("user_id"),
                   F.col("event_type").alias("subreddit"),
                   F.concat(F.lit(TITLE_PREFIX), _s("event_id")).alias("title"),
                   F.concat(F.lit("About "), F.col("event_type"), F.lit(" "), _s("event_id")).alias("content"),
                   _score().alias("score"), _k().alias("num_comments"),
                   t.alias("created_utc"), t.alias("timestamp"))
    return ev.filter(F.col("event_type").isin(POST_TYPES)).select(
        "event_id", "ts", F.lit("posts").alias("data_type"), F.to_json(rec).alias("json"))


def comment_json(ev: DataFrame) -> DataFrame:
    t = iso_string(F.col("ts"))
    rec = F.struct(_s("event_id").alias("comment_id"), _k().cast("string").alias("post_id"),
                   _s("user_id").alias("user_id"),
                   F.concat(F.lit("On "), _k().cast("string")).alias("content"),
                   _score().alias("score"), t.alias("created_utc"), t.alias("timestamp"))
    return ev.filter(F.col("event_type").isin(COMMENT_TYPES)).select(
        "event_id", "ts", F.lit("comments").alias("data_type"), F.to_json(rec).alias("json"))


def user_json(cu: DataFrame) -> DataFrame:
    """customer → users; user ``n`` joined ``n`` minutes after a fixed time."""
    joined = F.timestamp_add("MINUTE", F.col("c_custkey"), F.lit(USERS_SINCE).cast("timestamp_ntz"))
    t = iso_string(joined)
    rec = F.struct(_s("c_custkey").alias("user_id"), F.col("c_name").alias("username"),
                   F.round("c_acctbal").cast("bigint").alias("karma"), t.alias("created_utc"), t.alias("timestamp"))
    return cu.select(F.col("c_custkey").alias("event_id"), joined.alias("ts"),
                     F.lit("users").alias("data_type"), F.to_json(rec).alias("json"))


def arrival_delay_ms(event_id: str = "event_id") -> Column:
    """Simulated broker delay of the test envelope (a fixed rule of the
    fixture): 0 to 1999 ms, derived from the event id. The latency queries
    measure this delay."""
    return F.pmod(F.col(event_id), F.lit(2000))


def to_envelope(recs: DataFrame) -> DataFrame:
    """(event_id, ts, data_type, json) → Kafka envelope columns.

    The broker timestamp is the event time plus ``arrival_delay_ms``; the
    offset is the event id (monotone per topic, like a log offset).
    """
    topic = F.concat(F.lit(TOPIC_PREFIX), "data_type")
    arrival = F.timestamp_add("MILLISECOND", arrival_delay_ms(), F.col("ts").cast("timestamp"))
    key = F.col("event_id").cast("string")
    return recs.select(
        F.encode(key, "UTF-8").alias("key"), F.encode(F.col("json"), "UTF-8").alias("value"),
        topic.alias("topic"), F.lit(0).alias("partition"),
        F.col("event_id").alias("offset"), arrival.alias("timestamp"), F.lit(0).alias("timestampType"))


def envelope(spark: SparkSession, sf_dir: str, entities=("posts", "comments", "users")) -> DataFrame:
    parts = []
    ev = table(spark, sf_dir, "events")
    if "posts" in entities:
        parts.append(post_json(ev))
    if "comments" in entities:
        parts.append(comment_json(ev))
    if "users" in entities:
        parts.append(user_json(table(spark, sf_dir, "customer")))
    recs = parts[0]
    for p in parts[1:]:
        recs = recs.unionByName(p)
    return to_envelope(recs)


#: Topic of the fault fixture that belongs to no entity.
UNKNOWN_TYPE = "votes"


def damaged_events_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Posts and comments of ``events`` on the wire with deterministic
    faults injected, to drive the quarantine path over the whole table.

    Fixed fault rule, by the divisor of event_id (the first that fits): 97
    record cut short, 89 both times empty, 83 unparsable time, 79 a second
    object behind the record, 73 a time without a date, 53 brackets closed behind
    the record, 37 a second list behind it, 71 a score that is no whole number,
    67 a field of no entity, 31 a field sent twice. Besides, 61: unknown topic.
    """
    ev = table(spark, sf_dir, "events")
    recs = post_json(ev).unionByName(comment_json(ev))
    j = F.col("json")

    def times(value: str) -> Column:
        return F.regexp_replace(j, r'"(created_utc|timestamp)":"[^"]*"', f'"$1":"{value}"')
    faults = [(97, F.expr("substring(json, 1, length(json) - 1)")), (89, times("")), (83, times("garbage")),
              (79, F.concat(j, j)), (73, times("12:30:45")),
              (53, F.concat(j, F.lit("]}"))), (37, F.concat(j, F.lit("] ["), j)),
              (71, F.regexp_replace(j, r'"score":-?\d+', '"score":1.5')),
              (67, F.regexp_replace(j, r"\}$", ',"awards":["x"]}')),
              (31, F.regexp_replace(j, r'("score":-?\d+)', "$1,$1"))]
    damaged = j
    for divisor, text in reversed(faults):
        damaged = F.when(F.col("event_id") % divisor == 0, text).otherwise(damaged)
    kind = F.when(F.col("event_id") % 61 == 0, F.lit(UNKNOWN_TYPE)).otherwise(F.col("data_type"))
    return recs.withColumns({"json": damaged, "data_type": kind})
