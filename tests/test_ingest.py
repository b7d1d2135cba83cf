"""Ingest edge rows (FIXTURES §5), quarantine, routing, store round trip."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from strata.functions.time import on_date
from strata.operators import ingest, views
from strata.schemas import ENVELOPE, TOPICS
from strata.sources.bootstrap import bootstrap_load
from strata.sources.partitioned import read_partitioned, read_quarantine
from tests.helpers import envelope, parsed, plan_text, post, text


def test_malformed_json_is_quarantined_not_a_null_row(spark):
    good = text(post("p"))
    rows = parsed(spark, ["{bad", "", "[1]", "null", good + " trailing", good + good, good + "," + good, good + "]"]).collect()
    assert [r._status for r in rows] == ["malformed_json"] * 8


def test_wrong_typed_fields_keep_the_row(spark):
    rows = {r.post_id: r for r in parsed(spark, [post("a", score="7"), post("b", score=1.5),
                                                 post("c", score=99999999999)]).collect()}
    assert rows["a"].score == 7 and rows["a"]._status == "ok"  # a number sent as text is read
    assert rows["b"].score is None and rows["b"]._status == "ok"
    assert rows["c"].score == 99999999999


def test_time_falls_back_to_created_utc_per_row(spark):
    r = parsed(spark, [post("p", ts="", created="2024-01-03T04:05:06Z")]).collect()[0]
    assert r._status == "ok"
    assert r.timestamp.replace(tzinfo=None) == dt.datetime(2024, 1, 3, 4, 5, 6)


def test_missing_and_bad_time(spark):
    rows = {r.post_id: r._status for r in parsed(spark, [post("none", ts="", created=""),
                                                        post("absent", ts=None, created=None),
                                                        post("bad", ts="garbage", created="garbage"),
                                                        post("hour", ts="12:30:45", created="12:30:45"),
                                                        post("year", ts="2024", created="2024"),
                                                        post("month", ts="2024-03", created="2024-03")]).collect()}
    assert rows == {"none": "missing_time", "absent": "missing_time", "bad": "bad_time", "hour": "bad_time",
                    "year": "bad_time", "month": "bad_time"}


def test_offsets_normalise_to_utc_and_partition_by_utc_day(spark):
    recs = [post("z", ts="2024-01-02T02:00:00Z"), post("o", ts="2024-01-02T02:00:00+00:00"),
            post("i", ts="2024-01-02T02:00:00+05:30")]
    rows = {r.post_id: r for r in ingest.stored_rows(parsed(spark, recs), "posts").collect()}
    assert rows["z"].timestamp == rows["o"].timestamp
    assert rows["i"].timestamp.replace(tzinfo=None) == dt.datetime(2024, 1, 1, 20, 30)
    assert (rows["i"].day, rows["i"].hour) == ("01", "20")
    assert (rows["z"].year, rows["z"].month, rows["z"].day, rows["z"].hour) == ("2024", "01", "02", "02")


def test_identical_timestamps_all_land(spark, tmp):
    """Many posts with one timestamp must not collide on file names."""
    recs = [post(f"p{i}", ts="2024-01-05T12:00:00Z") for i in range(1000)]
    ingest.ingest_batch(envelope(spark, recs), tmp, entities=("posts",))
    back = read_partitioned(spark, tmp, "posts")
    assert back.count() == 1000
    assert back.select("year", "month", "day", "hour").distinct().collect()[0].asDict() == \
        {"year": 2024, "month": 1, "day": 5, "hour": 12}


def test_rows_in_equal_stored_plus_quarantined(spark, tmp):
    recs = [post("a"), "{bad", post("b", ts="", created=""), post("c", ts="garbage", created="x"),
            post("d", ts="2024-01-02T00:00:00Z")]
    ingest.ingest_batch(envelope(spark, recs), tmp, entities=("posts",))
    stored = read_partitioned(spark, tmp, "posts")
    q = read_quarantine(spark, tmp)
    assert stored.count() == 2
    assert sorted(r.reason for r in q.collect()) == ["bad_time", "malformed_json", "missing_time"]
    assert stored.count() + q.count() == len(recs)


def test_route_by_topic_suffix(spark):
    rows = [(b"k", text(post("p")).encode(), t, 0, 0, dt.datetime(2024, 1, 1), 0)
            for t in (TOPICS["posts"], TOPICS["comments"], TOPICS["users"], "a.b.c.posts")]
    env = spark.createDataFrame(rows, ENVELOPE)
    assert sorted(r.data_type for r in ingest.route(env).collect()) == ["comments", "posts", "posts", "users"]


def test_partition_pruning_on_stored_table(spark, tmp):
    recs = [post(f"p{d}", ts=f"2024-01-{d:02d}T05:00:00Z") for d in range(1, 6)]
    ingest.ingest_batch(envelope(spark, recs), tmp, entities=("posts",))
    t = read_partitioned(spark, tmp, "posts")
    got = on_date(t, "2024-01-03")
    assert [r.post_id for r in got.collect()] == ["p3"]
    assert views.top_posts(t, date_filter="2024-01-03").count() == 1


def test_bad_date_filter_is_rejected_early(spark):
    t = parsed(spark, [post("p")])
    with pytest.raises(ValueError):
        on_date(t, "2024-13-45")


def test_bootstrap_skips_missing_file(spark, tmp):
    spark.createDataFrame([(text(post("p1")),), ("{bad",)], "value string").write.text(f"{tmp}/posts.json")
    got = bootstrap_load(spark, tmp)
    assert set(got) == {"posts"}
    assert sorted(r._status for r in got["posts"].collect()) == ["malformed_json", "ok"]


def test_json_store_round_trip(spark, tmp):
    recs = [post(f"p{i}", ts=f"2024-01-01T0{i}:00:00Z") for i in range(5)]
    rows = ingest.stored_rows(parsed(spark, recs), "posts")
    ingest.write_partitioned(rows, f"{tmp}/posts", fmt="json")
    back = read_partitioned(spark, tmp, "posts", fmt="json")
    assert back.count() == 5
    assert sorted(r.hour for r in back.collect()) == [0, 1, 2, 3, 4]
    assert back.filter(F.col("timestamp").isNull()).count() == 0


def test_hot_hour_is_split_over_several_write_tasks(spark, tmp):
    """One hour holding most rows is written by several tasks (AQE splits the
    skewed rebalance partition), while every row still lands."""
    import glob
    import hashlib
    noise = [hashlib.sha256(str(i).encode()).hexdigest() * 4 for i in range(3000)]  # does not compress away
    recs = [post(f"h{i}", content=noise[i], ts="2024-01-07T09:00:00Z") for i in range(3000)]
    recs += [post(f"c{i}", ts=f"2024-01-0{1 + i % 5}T0{i % 9}:00:00Z") for i in range(100)]
    rows = ingest.stored_rows(parsed(spark, recs).repartition(8), "posts")
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    old = spark.conf.get(key)
    spark.conf.set(key, "64k")
    try:
        ingest.write_partitioned(rows, f"{tmp}/posts")
    finally:
        spark.conf.set(key, old)
    hot = glob.glob(f"{tmp}/posts/year=2024/month=01/day=07/hour=09/*.parquet")
    assert len(hot) > 1
    assert read_partitioned(spark, tmp, "posts").count() == 3100


def test_future_event_times_can_be_quarantined(spark):
    recs = [post("now", ts="2024-01-01T00:30:00Z"), post("future", ts="2024-01-05T00:00:00Z")]
    env = envelope(spark, recs)  # arrival 2024-01-01T00:00Z
    keep = ["data_type"] + ingest.META
    off = {r.post_id: r._status for r in ingest.parse(ingest.route(env), "posts", keep=keep).collect()}
    assert off == {"now": "ok", "future": "ok"}
    on = {r.post_id: r._status for r in ingest.parse(ingest.route(env), "posts", keep=keep,
                                                     max_future="1 day").collect()}
    assert on == {"now": "ok", "future": "future_time"}
    assert [r.post_id for r in ingest.decode_entity(env, "posts", max_future="1 day").collect()] == ["now"]
    with pytest.raises(ValueError):
        ingest.parse(ingest.route(env), "posts", keep=keep, max_future="1 day; drop")


def test_ingest_of_one_entity_ignores_other_topics(spark, tmp):
    from tests.helpers import user
    env = envelope(spark, [post("a")]).unionByName(envelope(spark, [user("u", ts="")], "users"))
    ingest.ingest_batch(env, tmp, entities=("posts",))
    assert read_partitioned(spark, tmp, "posts").count() == 1
    assert read_quarantine(spark, tmp).count() == 0


def test_reads_an_existing_json_store_with_one_record_per_file(spark, tmp):
    """A store laid out as JSON files with two-digit partition folders, one
    record per file and ISO times with an offset, reads back with parsed
    times and int partition columns."""
    import json
    import os
    for i, (day, hour) in enumerate([(1, 3), (1, 3), (2, 10)]):
        folder = f"{tmp}/posts/year=2024/month=01/day={day:02d}/hour={hour:02d}"
        os.makedirs(folder, exist_ok=True)
        rec = post(f"p{i}", ts=f"2024-01-{day:02d}T{hour:02d}:15:00.123456+00:00")
        with open(f"{folder}/data_{i}.json", "w") as f:
            f.write(json.dumps(rec) + "\n")
    t = read_partitioned(spark, tmp, "posts", fmt="json")
    rows = sorted((r.post_id, r.timestamp.replace(tzinfo=None), r.day, r.hour) for r in t.collect())
    assert rows == [("p0", dt.datetime(2024, 1, 1, 3, 15, 0, 123456), 1, 3),
                    ("p1", dt.datetime(2024, 1, 1, 3, 15, 0, 123456), 1, 3),
                    ("p2", dt.datetime(2024, 1, 2, 10, 15, 0, 123456), 2, 10)]
    assert views.top_posts(t, date_filter="2024-01-02").count() == 1
    # a record with only created_utc gets its time from it
    folder = f"{tmp}/posts/year=2024/month=01/day=03/hour=00"
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/data_9.json", "w") as f:
        f.write(json.dumps({"post_id": "old", "created_utc": "2024-01-03T00:05:00+00:00"}) + "\n")
        f.write("{broken\n")
    old = read_partitioned(spark, tmp, "posts", fmt="json").filter("day = 3")  # the broken line is no row
    assert old.collect()[0].timestamp.replace(tzinfo=None) == dt.datetime(2024, 1, 3, 0, 5)


def test_narrow_classification_agrees_with_the_entity_parse(spark):
    recs = [post("a"), post("b", score="7"), "{bad", "", "[1]", post("c", ts="", created=""),
            post("d", ts="garbage", created="x"), post("e", ts="", created="2024-01-02T00:00:00Z")]
    env = envelope(spark, recs)
    full = sorted((r._offset, r._status) for r in ingest.parse(ingest.route(env), "posts", keep=ingest.META).collect())
    narrow = sorted((r._offset, r._status) for r in ingest.classify(env).collect())
    assert full == narrow
    assert [s for _, s in full] == ["ok", "ok", "malformed_json", "malformed_json", "malformed_json",
                                    "missing_time", "bad_time", "ok"]


def test_on_dates_selects_exactly_the_given_days(spark, tmp):
    from strata.functions.time import on_dates
    recs = [post(f"p{d}", ts=f"2024-01-{d:02d}T23:59:59Z") for d in range(1, 6)]
    ingest.ingest_batch(envelope(spark, recs), tmp, entities=("posts",))
    t = read_partitioned(spark, tmp, "posts")
    assert sorted(r.post_id for r in on_dates(t, ["2024-01-02", "2024-01-04"]).collect()) == ["p2", "p4"]
    assert on_dates(t, []).count() == 0
    # the same on the unpartitioned binding form (range on the raw time column)
    assert sorted(r.post_id for r in on_dates(parsed(spark, recs), ["2024-01-05"]).collect()) == ["p5"]


def test_the_same_load_replaces_itself_and_another_adds(spark, tmp):
    env = envelope(spark, [post("a"), "{bad"])
    ingest.ingest_batch(env, tmp, load="one")
    ingest.ingest_batch(env, tmp, load="one")
    assert (read_partitioned(spark, tmp, "posts").count(), read_quarantine(spark, tmp).count()) == (1, 1)
    ingest.ingest_batch(env, tmp, load="two")
    assert (read_partitioned(spark, tmp, "posts").count(), read_quarantine(spark, tmp).count()) == (2, 2)


def test_unknown_topics_are_quarantined(spark, tmp):
    env = envelope(spark, [post("a")]).unionByName(
        envelope(spark, ["x"]).withColumn("topic", F.lit("reddit.votes")))
    ingest.ingest_batch(env, tmp, entities=("posts",))
    q = read_quarantine(spark, tmp).collect()
    assert [(r.data_type, r.reason, r.value) for r in q] == [("votes", "unknown_topic", "x")]
    assert read_partitioned(spark, tmp, "posts").count() == 1


def test_records_that_hold_more_than_their_columns_are_rescued(spark, tmp):
    import json
    recs = [post("plain"), post("text", score="7"), post("fraction", score=1.5), post("extra", awards=["x"]),
            post("other", karma=3)]
    ingest.ingest_batch(envelope(spark, recs), tmp, entities=("posts",))
    got = {r.post_id: r._rescued for r in read_partitioned(spark, tmp, "posts", rescued=True).collect()}
    assert got["plain"] is None and got["text"] is None
    assert json.loads(got["fraction"])["score"] == 1.5
    assert json.loads(got["extra"])["awards"] == ["x"]
    assert json.loads(got["other"])["karma"] == 3


def test_a_store_without_an_entity_is_empty_and_no_store_is_an_error(spark, tmp):
    ingest.ingest_batch(envelope(spark, [post("a")]), tmp)
    assert read_partitioned(spark, tmp, "users").count() == 0
    assert read_quarantine(spark, tmp).count() == 0
    with pytest.raises(FileNotFoundError):
        read_partitioned(spark, f"{tmp}/nothing", "posts")


def test_bootstrap_reads_plain_files_and_joins_the_store(spark, tmp):
    import os
    import re

    from strata.sources.bootstrap import ingest_bootstrap
    from tests.helpers import user
    folder = re.sub("^file:", "", tmp) + "/dump"
    os.makedirs(folder)
    for name, recs in (("posts", [post("p1"), "{bad"]), ("users", [user("u1")])):  # no comments
        with open(f"{folder}/{name}.json", "w") as f:
            f.write("\n".join(text(r) for r in recs) + "\n")
    for _ in range(2):
        ingest_bootstrap(spark, f"{tmp}/dump", f"{tmp}/store")
    ingest.ingest_batch(envelope(spark, [post("live")]), f"{tmp}/store")
    assert sorted(r.post_id for r in read_partitioned(spark, f"{tmp}/store", "posts").collect()) == ["live", "p1"]
    assert read_partitioned(spark, f"{tmp}/store", "users").count() == 1
    assert [r.reason for r in read_quarantine(spark, f"{tmp}/store").collect()] == ["malformed_json"]


def test_consecutive_days_are_one_range(spark):
    from strata.functions.time import on_dates
    from tests.helpers import plan_text
    df = parsed(spark, [post("a")])
    plan = plan_text(on_dates(df, [f"2024-01-{d:02d}" for d in range(1, 29)]), "simple")
    assert " OR " not in plan


def test_a_record_is_judged_once_however_many_columns_ask(spark):
    env = envelope(spark, [post("p1"), "{", post("p2", ts="12:30:45")])
    plans = [plan_text(ingest.load_rows(ingest.route(env), "load")), plan_text(ingest.decode_entity(env, "posts"))]
    # the record's whole text is looked at once, and its time read once for the status and once as a column
    assert all(p.count(r"^\s*\{") == 1 and p.count(r"^\s*\d{4}") <= 2 for p in plans)
    got = {r.status for r in ingest.load_rows(ingest.route(env), "load").collect()}
    assert got == {"ok", "malformed_json", "bad_time"}
