"""Batch view semantics on hand-written rows (FIXTURES §5)."""

import datetime as dt

from strata.operators import quality, views
from tests.helpers import comment, decoded, post


def P(spark, recs):
    return decoded(spark, recs)


def C(spark, recs):
    return decoded(spark, recs, "comments")


def test_top_posts_sums_per_post_and_orders(spark):
    posts = P(spark, [post("a", subreddit="python", score=5, ts="2024-01-01T01:00:00Z"),
                      post("b", subreddit="python", score=9, ts="2024-01-01T02:00:00Z"),
                      post("c", subreddit="ai", score=1, ts="2024-01-01T03:00:00Z"),
                      post("d", subreddit="ai", score=7, ts="2024-01-02T03:00:00Z")])
    got = [(r.date.isoformat(), r.subreddit, r.post_id) for r in views.top_posts(posts).collect()]
    # date desc, subreddit asc, total_score desc
    assert got == [("2024-01-02", "ai", "d"), ("2024-01-01", "ai", "c"),
                   ("2024-01-01", "python", "b"), ("2024-01-01", "python", "a")]


def test_duplicate_delivery_doubles_without_dedup(spark):
    recs = [post("a", score=5), post("a", score=5)]
    posts = P(spark, recs)
    assert views.top_posts(posts).collect()[0].total_score == 10
    once = quality.dedup(posts, ["post_id", "timestamp"])
    assert views.top_posts(once).collect()[0].total_score == 5


def test_reused_post_id_at_another_time_stays_two_events(spark):
    posts = P(spark, [post("a", ts="2024-01-01T00:00:00Z"), post("a", ts="2024-01-01T05:00:00Z")])
    assert quality.dedup(posts, ["post_id", "timestamp"]).count() == 2


def test_top_k_ties_go_to_lower_post_id(spark):
    posts = P(spark, [post("p3", score=5), post("p1", score=5), post("p2", score=5), post("p4", score=9)])
    got = [(r.post_id, r.rank) for r in views.top_k_posts(posts, k=3).orderBy("rank").collect()]
    assert got == [("p4", 1), ("p1", 2), ("p2", 3)]


def test_user_activity_outer_join_fills_zeros_and_keeps_null_users_apart(spark):
    posts = P(spark, [post("a", user_id="only_posts", score=3), post("b", user_id="both", score=1),
                      post("n", user_id=None, score=2)])
    comments = C(spark, [comment("c1", user_id="only_comments", score=-4), comment("c2", user_id="both", score=-1),
                         comment("cn", user_id=None, score=6)])
    rows = views.user_activity(posts, comments).collect()
    by = {r.user_id: r for r in rows if r.user_id is not None}
    assert (by["only_posts"].num_comments, by["only_posts"].comment_score) == (0, 0)
    assert (by["only_comments"].num_posts, by["only_comments"].post_score) == (0, 0)
    assert by["only_comments"].total_score == -4  # negative comment scores sum negative
    assert (by["both"].total_activity, by["both"].total_score) == (2, 0)
    nulls = [r for r in rows if r.user_id is None]
    assert len(nulls) == 2
    assert sorted((r.num_posts, r.num_comments) for r in nulls) == [(0, 1), (1, 0)]
    # ordered by total_activity desc
    acts = [r.total_activity for r in rows]
    assert acts == sorted(acts, reverse=True)


def test_all_null_scores(spark):
    posts = P(spark, [post("a", user_id="u", score="x"), post("b", user_id="u", score=None)])
    daily = views.subreddit_activity(posts).collect()[0]
    assert daily.total_score is None and daily.avg_score is None and daily.num_posts == 2
    ua = views.user_activity(posts, C(spark, [])).collect()[0]
    assert ua.post_score == 0  # zero only after the user join


def test_subreddit_activity_measures_and_order(spark):
    posts = P(spark, [post("a", subreddit="x", score=2, num_comments=3, ts="2024-01-01T01:00:00Z"),
                      post("b", subreddit="x", score=4, num_comments=5, ts="2024-01-01T02:00:00Z"),
                      post("c", subreddit="y", score=1, num_comments=1, ts="2024-01-01T02:00:00Z"),
                      post("d", subreddit="y", score=1, num_comments=1, ts="2024-01-02T02:00:00Z")])
    rows = views.subreddit_activity(posts).collect()
    assert [(r.date.isoformat(), r.subreddit) for r in rows] == [
        ("2024-01-02", "y"), ("2024-01-01", "x"), ("2024-01-01", "y")]
    x = rows[1]
    assert (x.num_posts, x.total_score, x.total_comments, x.avg_score) == (2, 6, 8, 3.0)


def test_trend_delta(spark):
    posts = P(spark, [post("a", ts="2024-01-01T00:00:00Z"), post("b", ts="2024-01-02T00:00:00Z"),
                      post("c", ts="2024-01-02T01:00:00Z")])
    got = [(r.num_posts, r.delta) for r in views.subreddit_trend(posts).orderBy("date").collect()]
    assert got == [(1, None), (2, 1)]


def test_user_activity_daily(spark):
    posts = P(spark, [post("a", user_id="u", ts="2024-01-01T00:00:00Z")])
    comments = C(spark, [comment("c", user_id="u", ts="2024-01-01T03:00:00Z"),
                         comment("d", user_id="u", ts="2024-01-03T03:00:00Z")])
    got = [(r.date.isoformat(), r.num_posts, r.num_comments, r.total_activity, r.delta)
           for r in views.user_activity_daily(posts, comments).orderBy("date").collect()]
    assert got == [("2024-01-01", 1, 1, 2, None), ("2024-01-03", 0, 1, 1, -1)]


def test_active_users_and_throughput(spark):
    posts = P(spark, [post("a", user_id="u1", ts="2024-01-01T00:10:00Z"),
                      post("b", user_id="u1", ts="2024-01-01T00:20:00Z"),
                      post("c", user_id="u2", ts="2024-01-01T01:20:00Z")])
    comments = C(spark, [comment("x", user_id="u3", ts="2024-01-01T00:10:30Z")])
    act = views.activity(posts, comments)
    au = [(r.window_start, r.active_users) for r in views.active_users(act).orderBy("window_start").collect()]
    assert au == [(dt.datetime(2024, 1, 1, 0), 2), (dt.datetime(2024, 1, 1, 1), 1)]
    tp = {(r.window_start.hour, r.window_start.minute): (r.events, r.per_second)
          for r in views.throughput_per_minute(act).collect()}
    assert tp == {(0, 10): (2, 2 / 60), (0, 20): (1, 1 / 60), (1, 20): (1, 1 / 60)}


def test_global_top_k_tie_break(spark):
    posts = P(spark, [post("a", subreddit="b"), post("b", subreddit="a"), post("c", subreddit="c"),
                      post("d", subreddit="c")])
    assert [r.subreddit for r in views.top_subreddits(posts, k=2).collect()] == ["c", "a"]
    comments = C(spark, [comment("x", user_id="z")])
    top = views.top_contributors(P(spark, [post("p", user_id="y")]), comments, k=1).collect()
    assert [r.user_id for r in top] == ["y"]


def test_load_summary_counts_empty_tables_too(spark):
    got = {r.data_type: r.n for r in views.load_summary(P(spark, [post("a")]), C(spark, []),
                                                        decoded(spark, [], "users")).collect()}
    assert got == {"posts": 1, "comments": 0, "users": 0}


def test_latest_per_key(spark):
    df = spark.createDataFrame([("a", 1, 10), ("a", 3, 30), ("a", 2, 20), ("b", 1, 5)], "k string, v int, x int")
    got = sorted(tuple(r) for r in views.latest_per_key(df, ["k"], "v", ["x"]).collect())
    assert got == [("a", 3, 30), ("b", 1, 5)]


def test_reconcile_both_directions_and_duplicates(spark):
    produced = spark.createDataFrame([("1",), ("2",), ("3",), ("4",)], "id string")
    landed = spark.createDataFrame([("1",), ("3",), ("3",), ("5",)], "id string")
    got = sorted((r.id, r.status) for r in quality.reconcile(produced, landed, "id").collect())
    assert got == [("2", "missing"), ("3", "duplicated"), ("4", "missing"), ("5", "unexpected")]


def test_latency_stats_from_arrival(spark):
    df = spark.createDataFrame(
        [("posts", dt.datetime(2024, 1, 1, 0, 0, 0), dt.datetime(2024, 1, 1, 0, 0, 1)),
         ("posts", dt.datetime(2024, 1, 1, 0, 0, 0), dt.datetime(2024, 1, 1, 0, 0, 3))],
        "data_type string, timestamp timestamp, _arrival timestamp")
    r = quality.latency_stats(df, ["data_type"], quantiles=True).collect()[0]
    assert (r.n, r.avg_ms, r.max_ms) == (2, 2000.0, 3000.0)
    assert r.p95_ms == 3000.0
