"""Batch job, incremental recompute and the batch + speed merge."""

from pyspark.sql import functions as F

from strata.operators import ingest, views
from strata.plans import batch_job, serving
from strata.sources.partitioned import read_partitioned
from strata.streaming import speed
from tests.helpers import comment, decoded, envelope, post, user


def day_posts(spark):
    recs = [post(f"p{d}_{i}", subreddit=["a", "b"][i % 2], score=d * 10 + i, num_comments=i,
                 ts=f"2024-01-{d:02d}T{i:02d}:15:00Z") for d in range(1, 5) for i in range(6)]
    return recs, decoded(spark, recs)


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_incremental_recompute_touches_only_given_days(spark, tmp):
    recs, posts = day_posts(spark)
    serving.write_daily(posts, tmp)
    full = rows(serving.read_daily(spark, tmp))
    # late data arrives for day 2; only that day is recomputed
    more = decoded(spark, recs + [post("late", subreddit="a", score=1000, ts="2024-01-02T23:00:00Z")])
    serving.write_daily(more, tmp, days=["2024-01-02"])
    serving.write_daily(more, tmp, days=["2024-01-02"])  # idempotent
    after = {(r.subreddit, r.date.isoformat()): r for r in serving.read_daily(spark, tmp).collect()}
    before = {(r[0], r[1].isoformat()): r for r in full}
    assert len(after) == len(before)
    assert after[("a", "2024-01-02")].num_posts == before[("a", "2024-01-02")][2] + 1
    assert tuple(after[("b", "2024-01-03")]) == before[("b", "2024-01-03")]


def test_merge_of_batch_and_speed_equals_full_batch(spark):
    _, posts = day_posts(spark)
    batch_daily = views.daily_measures(posts)
    minutes = speed.posts_per_minute(posts, serving=True)
    merged = serving.merge_batch_and_speed(batch_daily, minutes, "2024-01-03")
    assert rows(merged) == rows(views.finish_daily(batch_daily))
    want = rows(views.subreddit_activity_unordered(posts))
    assert rows(merged) == want


def test_batch_job_writes_three_views(spark, tmp):
    env = (envelope(spark, [post("a", user_id="u1", ts="2024-01-01T01:00:00Z"),
                            post("b", user_id="u2", ts="2024-01-02T01:00:00Z")], "posts")
           .unionByName(envelope(spark, [comment("c", user_id="u1", ts="2024-01-01T02:00:00Z")], "comments"))
           .unionByName(envelope(spark, [user("u1"), user("u2")], "users")))
    ingest.ingest_batch(env, f"{tmp}/store")
    summary = {r.data_type: r.n for r in batch_job.run_batch_job(spark, f"{tmp}/store", f"{tmp}/out").collect()}
    assert summary == {"posts": 2, "comments": 1, "users": 2}
    tp = spark.read.parquet(f"{tmp}/out/top_posts")
    assert tp.count() == 2 and "date" in tp.columns
    ua = {r.user_id: r.total_activity for r in spark.read.parquet(f"{tmp}/out/user_activity").collect()}
    assert ua == {"u1": 2, "u2": 1}
    sa = spark.read.parquet(f"{tmp}/out/subreddit_activity")
    assert sa.agg(F.sum("num_posts")).collect()[0][0] == 2
    assert read_partitioned(spark, f"{tmp}/store", "users").count() == 2


def test_load_serving_adds_keys(spark, tmp):
    _, posts = day_posts(spark)
    serving.load_serving(batch_job.compute_views(posts, decoded(spark, [], "comments")), tmp)
    sa = spark.read.parquet(f"{tmp}/subreddit_activity")
    assert sa.select("key").distinct().count() == sa.count() == 8
    assert sa.filter(F.col("key") == "a|2024-01-01").count() == 1


def test_a_day_without_rows_loses_its_partition(spark, tmp):
    recs, posts = day_posts(spark)
    serving.write_daily(posts, tmp)
    left = decoded(spark, [r for r in recs if not r["timestamp"].startswith("2024-01-02")])
    serving.write_daily(left, tmp, days=["2024-01-02", "2024-01-03"])
    assert {r.date.day for r in serving.read_daily(spark, tmp).collect()} == {1, 3, 4}


def test_one_day_batch_keeps_the_other_days(spark, tmp):
    _, posts = day_posts(spark)
    none = decoded(spark, [], "comments")
    batch_job.write_views(batch_job.compute_views(posts, none), tmp)
    batch_job.write_views(batch_job.compute_views(posts, none, date_filter="2024-01-02"), tmp, one_day=True)
    for view in ("top_posts", "subreddit_activity"):
        assert {r.date.day for r in spark.read.parquet(f"{tmp}/{view}").select("date").distinct().collect()} == {1, 2, 3, 4}


def test_serving_keys_tell_rows_apart(spark, tmp):
    rows = spark.createDataFrame([("a|b", "c"), ("a", "b|c"), (None, "x"), ("null", "x"), ("\\N", "x"), ("a\\", "b")],
                                 "p string, q string")
    keyed = serving.with_serving_key(rows, ["p", "q"])
    assert keyed.select("key").distinct().count() == 6
    posts = decoded(spark, [post("p1", title="one"), post("p1", title="two"), post("p2", user_id=None)])
    comments = decoded(spark, [comment("c1", user_id=None)], "comments")
    serving.load_serving(batch_job.compute_views(posts, comments), tmp)
    for view in ("top_posts", "user_activity"):
        served = spark.read.parquet(f"{tmp}/{view}")
        assert served.select("key").distinct().count() == served.count() == 3


CUT = "2024-01-03"


def _layers(spark, tmp, recs):
    """Each (post or comment) row decoded, as the batch and as the speed layer have it."""
    posts = decoded(spark, [r for r in recs if "comment_id" not in r])
    comments = decoded(spark, [r for r in recs if "comment_id" in r], "comments")
    return posts, comments


def _recs():
    out = [post(f"p{i % 7}", user_id=f"u{i % 4}", ts=f"2024-01-0{1 + i % 5}T0{i % 9}:59:59Z", score=i) for i in range(40)]
    out += [comment(f"c{i}", user_id=f"u{i % 6}", ts=f"2024-01-0{1 + i % 5}T23:00:00Z", score=-i) for i in range(30)]
    return out + [post("none", user_id=None, ts="2024-01-04T00:00:00Z"), comment("nobody", user_id=None, ts="2024-01-02T00:00:00Z")]


def test_top_posts_of_both_layers_equal_the_full_view(spark, tmp):
    posts, _ = _layers(spark, tmp, _recs())
    full, fast = views.post_totals(posts), speed.posts_per_day(posts)
    for k in (None, 2):
        want = full if k is None else views.top_k_posts(posts, k=k)
        # What each layer holds beyond its own days does not matter.
        got = serving.merge_top_posts(full.unionByName(full.where("date >= '2024-01-03'")), fast, CUT, k=k)
        assert sorted(map(tuple, got.select(*want.columns).collect()), key=str) == sorted(map(tuple, want.collect()), key=str)


def test_user_activity_of_both_layers_equals_the_full_view(spark, tmp):
    posts, comments = _layers(spark, tmp, _recs())
    records = views.scored_activity(posts, comments)
    serving.write_user_days(records, f"{tmp}/days")
    got = serving.merge_user_activity(spark.read.parquet(f"{tmp}/days"), speed.user_activity_per_day(records), CUT)
    want = views.user_activity_unordered(posts, comments)
    assert sorted(map(tuple, got.select(*want.columns).collect()), key=str) == sorted(map(tuple, want.collect()), key=str)


def test_active_users_merge_across_layers_and_into_longer_windows(spark, tmp):
    n = 30_000
    rows = spark.range(n).select(F.pmod("id", F.lit(20_000)).alias("user_id"),
                                 F.timestamp_add("SECOND", F.col("id") * 5, F.lit("2024-01-02T00:00:00Z").cast("timestamp")).alias("timestamp"))
    held = speed.active_user_sketches(rows)
    whole = {r.window_start: r.active_users for r in serving.merge_active_users(held, held, CUT, "30 days").collect()}
    (estimate,) = whole.values()  # one window over both sides of the cutoff
    assert abs(estimate - 20_000) < 4 * 20_000 * 1.04 / 64
    hours = serving.merge_active_users(held, held, CUT).collect()
    assert len(hours) == 42 and all(abs(r.active_users - 720) <= 4 * 720 * 1.04 / 64 for r in hours[:-1] if r.active_users > 500)
