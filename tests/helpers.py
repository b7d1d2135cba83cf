"""Small builders for hand-written wire records."""

from __future__ import annotations

import contextlib
import datetime as dt
import io
import json

from pyspark.sql import functions as F

from strata.operators import ingest
from strata.schemas import ENTITY_SCHEMAS, ENVELOPE, TOPICS

T0 = "2024-01-01T00:00:00.000000Z"


def _record(entity, values, ts, created=None, **kw):
    """A wire record of an entity: its fields in schema order, ``values`` set."""
    times = {"created_utc": ts if created is None else created, "timestamp": ts}
    return {f.name: {**values, **times}.get(f.name) for f in ENTITY_SCHEMAS[entity].fields} | kw


def post(post_id, user_id="user_1", subreddit="python", score=10, num_comments=1, ts=T0, created=None, **kw):
    return _record("posts", {"post_id": post_id, "user_id": user_id, "subreddit": subreddit, "score": score,
                             "num_comments": num_comments, "title": f"On {post_id}", "content": "..."}, ts, created, **kw)


def comment(comment_id, post_id="p1", user_id="user_1", score=1, ts=T0, **kw):
    return _record("comments", {"comment_id": comment_id, "post_id": post_id, "user_id": user_id, "score": score,
                                "content": "..."}, ts, **kw)


def user(user_id, karma=5, ts=T0):
    return _record("users", {"user_id": user_id, "username": user_id, "karma": karma}, ts)


def text(rec) -> str:
    return rec if isinstance(rec, str) else json.dumps(rec)


def envelope(spark, records, entity="posts", arrival=None):
    """Records (dicts or raw text) → an envelope DataFrame on one topic."""
    arrival = arrival or dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)
    rows = [(str(i).encode(), text(r).encode(), TOPICS[entity], 0, i, arrival, 0) for i, r in enumerate(records)]
    return spark.createDataFrame(rows, ENVELOPE)


def parsed(spark, records, entity="posts"):
    env = envelope(spark, records, entity)
    return ingest.parse(ingest.route(env), entity, keep=["data_type"])


def decoded(spark, records, entity="posts"):
    """Only the rows that pass ingest, as the batch views see them."""
    return parsed(spark, records, entity).filter(F.col("_status") == ingest.OK)


def plan_text(df, mode="formatted") -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode=mode)
    return buf.getvalue()
