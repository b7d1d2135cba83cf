"""Randomised checks against brute force on small fixtures."""

import collections
import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from strata.operators import quality, views
from strata.plans import serving
from strata.streaming import speed

SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))

post_rows = st.lists(
    st.tuples(st.integers(0, 30),                      # post id
              st.sampled_from(["a", "b", "c"]),         # subreddit
              st.integers(-5, 5),                       # score (ties and negatives likely)
              st.integers(0, 3),                        # day offset
              st.integers(0, 1439)),                    # minute of day
    min_size=1, max_size=40)


def posts_df(spark, rows):
    base = dt.datetime(2024, 1, 1)
    data = [(pid, "u", sub, f"t{pid}", score, 1, base + dt.timedelta(days=d, minutes=m))
            for pid, sub, score, d, m in rows]
    return spark.createDataFrame(
        data, "post_id long, user_id string, subreddit string, title string, score long, "
              "num_comments long, timestamp timestamp")


@SETTINGS
@given(rows=post_rows, k=st.integers(1, 4))
def test_top_k_matches_brute_force(spark, rows, k):
    got = sorted((r.subreddit, r.date.isoformat(), r.post_id, r.rank)
                 for r in views.top_k_posts(posts_df(spark, rows), k=k).collect())
    totals = collections.defaultdict(int)
    for pid, sub, score, d, _ in rows:
        totals[(sub, (dt.date(2024, 1, 1) + dt.timedelta(days=d)).isoformat(), pid)] += score
    groups = collections.defaultdict(list)
    for (sub, day, pid), tot in totals.items():
        groups[(sub, day)].append((-tot, pid))
    want = sorted((sub, day, pid, i + 1) for (sub, day), g in groups.items()
                  for i, (_, pid) in enumerate(sorted(g)[:k]))
    assert got == want


@SETTINGS
@given(rows=post_rows, cut=st.integers(0, 4))
def test_merge_equals_full_batch_for_any_cutoff(spark, rows, cut):
    posts = posts_df(spark, rows)
    merged = serving.merge_batch_and_speed(views.daily_measures(posts),
                                           speed.posts_per_minute(posts, serving=True),
                                           dt.date(2024, 1, 1) + dt.timedelta(days=cut))
    want = sorted(tuple(r) for r in views.subreddit_activity_unordered(posts).collect())
    assert sorted(tuple(r) for r in merged.collect()) == want


@SETTINGS
@given(produced=st.lists(st.integers(0, 9), max_size=20), landed=st.lists(st.integers(0, 9), max_size=20))
def test_reconcile_matches_counters(spark, produced, landed):
    p = spark.createDataFrame([(str(i),) for i in produced], "id string")
    lnd = spark.createDataFrame([(str(i),) for i in landed], "id string")
    got = {r.id: (r.produced, r.landed) for r in quality.reconcile(p, lnd, "id").collect()}
    cp, cl = collections.Counter(map(str, produced)), collections.Counter(map(str, landed))
    want = {k: (cp[k], cl[k]) for k in set(cp) | set(cl) if cp[k] != cl[k]}
    assert got == want
