"""Record schemas shared by the batch and the speed layer.

Both layers use one fixed schema per entity (no inference): strings stay
strings, every integer is a long so a large score is kept by both layers,
and both times travel as ISO-8601 strings that are parsed after decoding.
"""

from pyspark.sql import types as T

S, L = T.StringType(), T.LongType()


def _struct(*fields):
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


POST = _struct(("post_id", S), ("user_id", S), ("subreddit", S), ("title", S), ("content", S),
               ("score", L), ("num_comments", L), ("created_utc", S), ("timestamp", S))

COMMENT = _struct(("comment_id", S), ("post_id", S), ("user_id", S), ("content", S),
                  ("score", L), ("created_utc", S), ("timestamp", S))

USER = _struct(("user_id", S), ("username", S), ("karma", L), ("created_utc", S), ("timestamp", S))

ENTITY_SCHEMAS = {"posts": POST, "comments": COMMENT, "users": USER}

# The fields of all entities: how a load of several entities is written.
RECORD = _struct(("post_id", S), ("comment_id", S), ("user_id", S), ("username", S), ("subreddit", S), ("title", S),
                 ("content", S), ("score", L), ("num_comments", L), ("karma", L), ("created_utc", S), ("timestamp", S))

# Primary id of each entity.
ENTITY_IDS = {"posts": "post_id", "comments": "comment_id", "users": "user_id"}

# The topic of each record stream (the entity is the last
# dotted part of the name).
TOPIC_PREFIX = "reddit."
TOPICS = {"posts": "reddit.posts", "comments": "reddit.comments", "users": "reddit.users"}

# Columns of Spark's Kafka source; the file-stream test double has the same.
ENVELOPE = T.StructType([
    T.StructField("key", T.BinaryType(), True),
    T.StructField("value", T.BinaryType(), True),
    T.StructField("topic", S, True),
    T.StructField("partition", T.IntegerType(), True),
    T.StructField("offset", L, True),
    T.StructField("timestamp", T.TimestampType(), True),
    T.StructField("timestampType", T.IntegerType(), True),
])

PARTITION_COLUMNS = ["year", "month", "day", "hour"]

# Partition folders of the store above the hours.
PART_COLUMNS = ["data_type", "status", "year", "month", "day"]

# Where a quarantined record came from.
META_FIELDS = [
    T.StructField("_key", S, True),
    T.StructField("_topic", S, True),
    T.StructField("_partition", T.IntegerType(), True),
    T.StructField("_offset", L, True),
    T.StructField("_arrival", T.TimestampType(), True),
]
