"""Record shapes (the reference's own test subjects) and time parsing."""

import datetime as dt

from pyspark.sql import types as T

from strata.schemas import COMMENT, ENTITY_IDS, ENVELOPE, POST, USER
from tests.helpers import comment, decoded, post, user


def test_post_shape():
    assert [f.name for f in POST.fields] == ["post_id", "user_id", "subreddit", "title", "content", "score",
                                            "num_comments", "created_utc", "timestamp"]
    assert POST["score"].dataType == T.LongType() and POST["num_comments"].dataType == T.LongType()
    assert all(f.nullable for f in POST.fields)


def test_comment_and_user_shape():
    assert [f.name for f in COMMENT.fields] == ["comment_id", "post_id", "user_id", "content", "score",
                                               "created_utc", "timestamp"]
    assert [f.name for f in USER.fields] == ["user_id", "username", "karma", "created_utc", "timestamp"]
    assert ENTITY_IDS == {"posts": "post_id", "comments": "comment_id", "users": "user_id"}


def test_envelope_matches_kafka_source_columns():
    assert [f.name for f in ENVELOPE.fields] == ["key", "value", "topic", "partition", "offset", "timestamp",
                                                "timestampType"]


def test_records_round_trip_through_decode(spark):
    p = decoded(spark, [post("post1", "user1", "python")]).collect()[0]
    assert (p.post_id, p.user_id, p.subreddit) == ("post1", "user1", "python")
    c = decoded(spark, [comment("comment1", "post1", "user1")], "comments").collect()[0]
    assert (c.comment_id, c.post_id, c.user_id) == ("comment1", "post1", "user1")
    u = decoded(spark, [user("user1")], "users").collect()[0]
    assert (u.user_id, u.username) == ("user1", "user1")


def test_iso_time_parses_to_utc_instant(spark):
    p = decoded(spark, [post("p", ts="2024-01-15T10:30:00.123456+00:00")]).collect()[0]
    assert p.timestamp.replace(tzinfo=None) == dt.datetime(2024, 1, 15, 10, 30, 0, 123456)


def test_scratch_folders_live_under_the_session_checkpoint_dir(spark):
    from strata.session import checkpoint_root, scratch_path
    root = checkpoint_root(spark)
    assert root == (spark.conf.get("spark.checkpoint.dir", None) or root)
    a, b = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert a != b and a.startswith(root)
