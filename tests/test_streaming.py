"""Speed layer on a file stream with Kafka's envelope columns."""

import datetime as dt

from pyspark.sql import functions as F

from strata.operators import ingest
from strata.sources.kafka import file_envelope_source, write_envelope
from strata.streaming import speed
from strata.streaming.runner import run_to_end, start, start_speed_views
from strata.streaming.sinks import ChangelogSink, read_latest
from tests.helpers import decoded, envelope, plan_text, post, user

KEYS = ["window_start", "subreddit"]


def land(spark, path, records, entity="posts"):
    envelope(spark, records, entity).coalesce(1).write.mode("append").parquet(path)


def run_ppm(spark, base):
    src = file_envelope_source(spark, f"{base}/in")
    view = speed.posts_per_minute(ingest.decode_entity(src, "posts"))
    return run_to_end(start(view, f"{base}/ck", output_mode="update",
                            foreach_batch=ChangelogSink(f"{base}/out", f"{base}/ck"), available_now=True))


def latest(spark, base):
    return {(r.window_start.replace(tzinfo=None), r.subreddit): (r.num_posts, r.total_score)
            for r in read_latest(spark, f"{base}/out", KEYS).collect()}


def ts(minute, second=0, hour=0):
    return f"2024-01-01T{hour:02d}:{minute:02d}:{second:02d}Z"


def test_stream_result_equals_batch_result(spark, tmp):
    recs = [post(f"p{i}", subreddit=["a", "b"][i % 2], score=i, ts=ts(i % 5, i)) for i in range(40)]
    land(spark, f"{tmp}/in", recs)
    run_ppm(spark, tmp)
    batch = speed.posts_per_minute(decoded(spark, recs))
    want = {(r.window_start.replace(tzinfo=None), r.subreddit): (r.num_posts, r.total_score)
            for r in batch.collect()}
    assert latest(spark, tmp) == want
    assert sum(v[0] for v in want.values()) == 40


def test_null_event_time_is_ignored_by_windows(spark, tmp):
    land(spark, f"{tmp}/in", [post("ok", ts=ts(1)), post("nt", ts="", created=""), "{bad"])
    run_ppm(spark, tmp)
    assert latest(spark, tmp) == {(dt.datetime(2024, 1, 1, 0, 1), "python"): (1, 10)}


def test_late_rows_against_the_watermark_and_restart(spark, tmp):
    land(spark, f"{tmp}/in", [post("a", ts=ts(0))])
    run_ppm(spark, tmp)
    land(spark, f"{tmp}/in", [post("b", ts=ts(30))])
    run_ppm(spark, tmp)  # watermark is now 00:20
    land(spark, f"{tmp}/in", [post("late", ts=ts(0, 30)), post("in_time", ts=ts(25))])
    q = run_ppm(spark, tmp)
    got = latest(spark, tmp)
    assert got[(dt.datetime(2024, 1, 1, 0, 0), "python")] == (1, 10)  # late row dropped
    assert got[(dt.datetime(2024, 1, 1, 0, 25), "python")] == (1, 10)  # behind max time, ahead of watermark
    dropped = sum(sum(op.get("numRowsDroppedByWatermark", 0) for op in p["stateOperators"])
                  for p in q.recentProgress)
    assert dropped == 1
    # a restart with no new input reprocesses nothing
    before = spark.read.parquet(f"{tmp}/out").count()
    q = run_ppm(spark, tmp)
    assert sum(p["numInputRows"] for p in q.recentProgress) == 0
    assert spark.read.parquet(f"{tmp}/out").count() == before


def test_update_mode_changelog_keeps_latest_value(spark, tmp):
    land(spark, f"{tmp}/in", [post("a", ts=ts(1, 1))])
    run_ppm(spark, tmp)
    land(spark, f"{tmp}/in", [post("b", ts=ts(1, 2), score=5)])
    run_ppm(spark, tmp)
    assert latest(spark, tmp) == {(dt.datetime(2024, 1, 1, 0, 1), "python"): (2, 15)}


def test_replayed_batch_overwrites_itself(spark, tmp):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1), "a", 1)], "window_start timestamp, subreddit string, n int")
    sink = ChangelogSink(f"{tmp}/out")
    sink(df, 7)
    sink(df, 7)
    assert spark.read.parquet(f"{tmp}/out").count() == 1
    assert read_latest(spark, f"{tmp}/out", KEYS).count() == 1


def test_user_feed_appends_records_and_drops_malformed(spark, tmp):
    land(spark, f"{tmp}/in", [user("u1"), user("u2", karma=7), "{bad"], entity="users")
    src = file_envelope_source(spark, f"{tmp}/in")
    run_to_end(start(speed.user_feed(ingest.decode_entity(src, "users")), f"{tmp}/ck", path=f"{tmp}/feed",
                     available_now=True))
    got = sorted((r.user_id, r.karma) for r in spark.read.parquet(f"{tmp}/feed").collect())
    assert got == [("u1", 5), ("u2", 7)]


def test_stream_dedup_within_watermark(spark, tmp):
    recs = [post("a", ts=ts(1)), post("b", ts=ts(2)), post("a", ts=ts(3))]
    land(spark, f"{tmp}/in", recs)
    land(spark, f"{tmp}/in", recs)  # every record delivered twice
    src = file_envelope_source(spark, f"{tmp}/in")
    rows = speed.dedup_within_watermark(ingest.decode_entity(src, "posts"), ["post_id", "timestamp"])
    run_to_end(start(rows.select("post_id", "timestamp"), f"{tmp}/ck", path=f"{tmp}/rows", available_now=True))
    assert spark.read.parquet(f"{tmp}/rows").count() == 3


def test_streaming_active_users(spark, tmp):
    land(spark, f"{tmp}/in", [post("a", user_id="u1", ts=ts(1)), post("b", user_id="u2", ts=ts(2)),
                              post("c", user_id="u1", ts=ts(3))])
    src = file_envelope_source(spark, f"{tmp}/in")
    view = speed.active_users_per_window(ingest.decode_entity(src, "posts"))
    run_to_end(start(view, f"{tmp}/ck", output_mode="update", foreach_batch=ChangelogSink(f"{tmp}/out"),
                     available_now=True))
    got = read_latest(spark, f"{tmp}/out", ["window_start"]).collect()
    assert [r.active_users for r in got] == [2]


def test_speed_job_starts_all_views(spark, tmp):
    envelope(spark, [post("a", ts=ts(1))], "posts").write.parquet(f"{tmp}/in")
    envelope(spark, [user("u1")], "users").write.mode("append").parquet(f"{tmp}/in")
    src = file_envelope_source(spark, f"{tmp}/in")
    qs = start_speed_views(src, f"{tmp}/views", f"{tmp}/ck", available_now=True)
    for q in qs.values():
        run_to_end(q)
    assert read_latest(spark, f"{tmp}/views/posts_per_minute", KEYS).count() == 1
    assert spark.read.parquet(f"{tmp}/views/user_feed").count() == 1
    assert spark.read.parquet(f"{tmp}/views/comments_per_minute").filter(F.col("num_comments") > 0).count() == 0


def test_streaming_ingest_with_bootstrap_is_exactly_once(spark, tmp):
    from strata.sources.partitioned import read_partitioned, read_quarantine
    from strata.streaming.ingest_stream import start_ingest
    from tests.helpers import text
    spark.createDataFrame([(text(post("boot1", ts=ts(5))),), ("{bad",)], "value string") \
        .write.text(f"{tmp}/dump/posts.json")
    spark.createDataFrame([(text(user("u9")),)], "value string").write.text(f"{tmp}/dump/users.json")
    spark.createDataFrame([], "value string").write.text(f"{tmp}/dump/comments.json")
    land(spark, f"{tmp}/in", [post("live1", ts=ts(6, hour=3)), post("nt", ts="", created="")])

    def run():
        src = file_envelope_source(spark, f"{tmp}/in")
        for q in start_ingest(spark, src, f"{tmp}/store", f"{tmp}/ck", bootstrap_dir=f"{tmp}/dump",
                              available_now=True).values():
            run_to_end(q)

    run()
    run()  # restart: nothing is ingested twice
    posts = read_partitioned(spark, f"{tmp}/store", "posts")
    assert sorted((r.post_id, r.hour) for r in posts.collect()) == [("boot1", 0), ("live1", 3)]
    assert read_partitioned(spark, f"{tmp}/store", "users").count() == 1
    q = read_quarantine(spark, f"{tmp}/store")
    assert sorted(r.reason for r in q.collect()) == ["malformed_json", "missing_time"]


def test_console_sink_and_compaction(spark, tmp):
    from strata.streaming.sinks import IndexSink, compact
    land(spark, f"{tmp}/in", [post("a", ts=ts(1)), post("b", ts=ts(2))])
    src = file_envelope_source(spark, f"{tmp}/in")
    view = speed.comments_per_minute(ingest.decode_entity(src, "comments"))
    run_to_end(start(view, f"{tmp}/ck_console", output_mode="update", fmt="console", available_now=True))
    run_ppm(spark, tmp)
    land(spark, f"{tmp}/in", [post("c", ts=ts(2, 5))])
    run_ppm(spark, tmp)
    snap = compact(spark, f"{tmp}/out", KEYS, f"{tmp}/snapshot")
    assert sorted((r.window_start.minute, r.num_posts) for r in snap.collect()) == [(1, 1), (2, 2)]
    # a batch after the snapshot: reading snapshot + newer batches equals reading the whole log
    land(spark, f"{tmp}/in", [post("d", ts=ts(2, 9)), post("e", ts=ts(3))])
    run_ppm(spark, tmp)
    via_snapshot = read_latest(spark, f"{tmp}/out", KEYS, snapshot=f"{tmp}/snapshot")
    whole = read_latest(spark, f"{tmp}/out", KEYS)
    assert sorted(tuple(r) for r in via_snapshot.collect()) == sorted(tuple(r) for r in whole.collect())
    assert sorted((r.window_start.minute, r.num_posts) for r in whole.collect()) == [(1, 1), (2, 3), (3, 1)]
    assert "batch_id" in " ".join(plan_text(via_snapshot).split("PartitionFilters")[1:2])
    # the index adapter only sets the id options; any writer format can stand in for the connector
    df = read_latest(spark, f"{tmp}/out", KEYS).withColumn("key", F.col("subreddit"))
    IndexSink(f"{tmp}/index", fmt="parquet")(df, 0)
    assert spark.read.parquet(f"{tmp}/index").count() == 3


def test_late_filter_lags_the_watermark_by_one_batch(spark, tmp):
    """One file per trigger in a single run: the late-row filter uses the
    watermark of the previous batch, so a row arriving one batch after the
    watermark moved is still merged and one arriving two batches after is
    dropped."""
    for name, recs in [("1", [post("a", ts=ts(0))]), ("2", [post("b", ts=ts(30))]),
                       ("3", [post("late1", ts=ts(0, 30))]), ("4", [post("c", ts=ts(31))]),
                       ("5", [post("late2", ts=ts(0, 40))])]:
        land(spark, f"{tmp}/in", recs)
    src = file_envelope_source(spark, f"{tmp}/in", max_files_per_trigger=1)
    view = speed.posts_per_minute(ingest.decode_entity(src, "posts"))
    q = run_to_end(start(view, f"{tmp}/ck", output_mode="update", foreach_batch=ChangelogSink(f"{tmp}/out"),
                         available_now=True))
    assert latest(spark, tmp)[(dt.datetime(2024, 1, 1, 0, 0), "python")] == (2, 20)  # a + late1, not late2
    dropped = sum(sum(op.get("numRowsDroppedByWatermark", 0) for op in p["stateOperators"])
                  for p in q.recentProgress)
    assert dropped == 1


def test_streaming_throughput_and_latency_panels(spark, tmp):
    land(spark, f"{tmp}/in", [post("a", ts=ts(1, 10)), post("b", ts=ts(1, 20)), post("c", ts=ts(2))])
    src = ingest.decode_entity(file_envelope_source(spark, f"{tmp}/in"), "posts")
    for name, view in [("tp", speed.events_per_minute(src)), ("lat", speed.latency_per_minute(src))]:
        run_to_end(start(view, f"{tmp}/ck_{name}", output_mode="update",
                         foreach_batch=ChangelogSink(f"{tmp}/{name}"), available_now=True))
    tp = {r.window_start.minute: (r.events, r.per_second)
          for r in read_latest(spark, f"{tmp}/tp", ["window_start"]).collect()}
    assert tp == {1: (2, 2 / 60), 2: (1, 1 / 60)}
    # helpers.envelope stamps every arrival at 2024-01-01T00:00Z, i.e. before these event times
    lat = {r.window_start.minute: (r.n, r.max_ms) for r in read_latest(spark, f"{tmp}/lat", ["window_start"]).collect()}
    assert lat == {1: (2, -70000.0), 2: (1, -120000.0)}


def test_a_changelog_refuses_another_checkpoint(spark, tmp):
    import pytest
    land(spark, f"{tmp}/in", [post("a", ts=ts(1))])
    run_ppm(spark, tmp)
    view = speed.posts_per_minute(ingest.decode_entity(file_envelope_source(spark, f"{tmp}/in"), "posts"))
    with pytest.raises(Exception, match="another checkpoint"):
        run_to_end(start(view, f"{tmp}/ck2", output_mode="update", available_now=True,
                         foreach_batch=ChangelogSink(f"{tmp}/out", f"{tmp}/ck2")))
    assert latest(spark, tmp) == {(dt.datetime(2024, 1, 1, 0, 1), "python"): (1, 10)}


def test_dropped_rows_are_reported_or_raised(spark, tmp):
    import pytest

    from strata.streaming.runner import dropped_rows
    for minute in (0, 30):
        land(spark, f"{tmp}/in", [post(f"p{minute}", ts=ts(minute))])
        run_ppm(spark, tmp)
    land(spark, f"{tmp}/in", [post("late", ts=ts(1))])
    src = file_envelope_source(spark, f"{tmp}/in")
    view = speed.posts_per_minute(ingest.decode_entity(src, "posts"))
    q = start(view, f"{tmp}/ck", output_mode="update", available_now=True,
              foreach_batch=ChangelogSink(f"{tmp}/out", f"{tmp}/ck"))
    with pytest.raises(RuntimeError, match="later than the watermark"):
        run_to_end(q, late="raise")
    assert dropped_rows(q) == 1


def test_batch_bootstrap_and_stream_share_a_store(spark, tmp):
    from strata.sources.partitioned import read_partitioned
    from strata.streaming.ingest_stream import start_ingest
    ingest.ingest_batch(envelope(spark, [post("batch1")]), f"{tmp}/store")
    land(spark, f"{tmp}/in", [post("live1")])
    for _ in range(2):
        for q in start_ingest(spark, file_envelope_source(spark, f"{tmp}/in"), f"{tmp}/store", f"{tmp}/ck",
                              available_now=True).values():
            run_to_end(q)
    ingest.ingest_batch(envelope(spark, [post("batch2")]), f"{tmp}/store", load="later")
    assert sorted(r.post_id for r in read_partitioned(spark, f"{tmp}/store", "posts").collect()) == [
        "batch1", "batch2", "live1"]
    # a new checkpoint reads its input again, as loads of its own
    for q in start_ingest(spark, file_envelope_source(spark, f"{tmp}/in"), f"{tmp}/store", f"{tmp}/ck2",
                          available_now=True).values():
        run_to_end(q)
    assert read_partitioned(spark, f"{tmp}/store", "posts").count() == 4


def test_compaction_goes_on_from_the_last_snapshot(spark, tmp):
    from strata.streaming.sinks import compact
    for minute in (1, 2, 3):
        land(spark, f"{tmp}/in", [post(f"p{minute}", ts=ts(minute))])
        run_ppm(spark, tmp)
        compact(spark, f"{tmp}/out", KEYS, f"{tmp}/snap", remove=True)
        via = read_latest(spark, f"{tmp}/out", KEYS, snapshot=f"{tmp}/snap")
        assert sorted(r.window_start.minute for r in via.collect()) == list(range(1, minute + 1))


def test_panels_and_console(spark, tmp):
    land(spark, f"{tmp}/in", [post("a", ts=ts(1))])
    src = file_envelope_source(spark, f"{tmp}/in")
    qs = start_speed_views(src, f"{tmp}/v", f"{tmp}/ck", views=("comments", "users", "panels"), console=True,
                           available_now=True)
    for q in qs.values():
        run_to_end(q)
    assert set(qs) == {"comments", "users", "active_users", "throughput", "latency", "active_user_sketches"}
    for name in ("active_users", "throughput", "latency", "active_user_sketches"):
        assert read_latest(spark, f"{tmp}/v/{name}", ["window_start"]).count() == 1


def _late_query(spark, tmp, **options):
    from strata.streaming.late import LateSink
    rows = ingest.decode_entity(file_envelope_source(spark, f"{tmp}/in", **options), "posts")
    sink = LateSink(f"{tmp}/late", f"{tmp}/late_ck")
    run_to_end(start(rows, f"{tmp}/late_ck", foreach_batch=sink, available_now=True))
    return sink


def test_late_records_are_kept_whole_and_counted(spark, tmp):
    from strata.streaming.late import read_late
    counts = []
    for recs in ([post("a", ts=ts(0))], [post("b", ts=ts(30)), post("none", ts="", created="")],
                 [post("late", ts=ts(19, 59), score=7), post("edge", ts=ts(20)), post("late2", ts=ts(3))],
                 [post("c", ts=ts(31))], [post("late3", ts=ts(19, 59)), post("late3", ts=ts(19, 59))]):
        land(spark, f"{tmp}/in", recs)
        sink = _late_query(spark, tmp)
        counts.append((sink.seen, sink.late))
    assert counts == [(1, 0), (1, 0), (3, 2), (1, 0), (2, 2)]  # without a time: in no window
    got = sorted((r.post_id, r.score, r.batch_id, r.watermark.minute, r.window_end.minute)
                 for r in read_late(spark, f"{tmp}/late").collect())
    assert got == [("late", 7, 2, 20, 20), ("late2", 10, 2, 20, 4), ("late3", 10, 4, 21, 20), ("late3", 10, 4, 21, 20)]


def test_what_a_view_leaves_out_is_among_the_late_records(spark, tmp):
    """The same micro-batches for both: of every post either the view counts it or it is a late record."""
    from strata.streaming.late import read_late
    for minute, recs in ((0, 3), (40, 2), (5, 4), (50, 1), (6, 5), (45, 2)):
        land(spark, f"{tmp}/in", [post(f"p{minute}-{i}", ts=ts(minute)) for i in range(recs)])
        run_ppm(spark, tmp)
        _late_query(spark, tmp)
    late = read_late(spark, f"{tmp}/late").count()
    assert late == 9 and sum(n for n, _ in latest(spark, tmp).values()) == 17 - late


def test_a_replayed_micro_batch_finds_the_same_late_records(spark, tmp):
    from strata.streaming.late import LateSink, read_late
    sink = LateSink(f"{tmp}/late")
    batches = [ingest.decode_entity(envelope(spark, [post(f"p{m}", ts=ts(m))]), "posts") for m in (0, 30, 5, 59)]
    for n in (0, 1, 2, 2, 3, 3):
        sink(batches[n], n)
    sink = LateSink(f"{tmp}/late")
    sink(batches[2], 2)  # the notes of later micro-batches are not looked at
    assert [(r.post_id, r.batch_id) for r in read_late(spark, f"{tmp}/late").collect()] == [("p5", 2)]


def test_drops_are_counted_beyond_the_list_of_recent_progress(spark, tmp):
    from strata.streaming.runner import dropped_rows
    for i in range(12):
        land(spark, f"{tmp}/in", [post(f"p{i}", ts=ts(50 if i % 2 else 1 + i))])
    key = "spark.sql.streaming.numRecentProgressUpdates"
    old = spark.conf.get(key)
    spark.conf.set(key, "2")
    try:
        src = file_envelope_source(spark, f"{tmp}/in", max_files_per_trigger=1)
        view = speed.posts_per_minute(ingest.decode_entity(src, "posts"))
        q = run_to_end(start(view, f"{tmp}/ck", output_mode="update", foreach_batch=ChangelogSink(f"{tmp}/out"),
                             available_now=True))
        counted = sum(n for n, _ in latest(spark, tmp).values())
        assert len(q.recentProgress) <= 2 and counted < 12
        assert dropped_rows(q, spark) == 12 - counted
    finally:
        spark.conf.set(key, old)


def test_a_live_job_is_interrupted_and_goes_on(spark, tmp):
    """A running job (processing-time trigger) is stopped between records and
    started again: each record is counted once, and the late one is kept."""
    import threading
    import time

    import pytest

    from strata.streaming.late import read_late
    from strata.streaming.runner import start_speed_views, wait

    def job(records, late, until):
        land(spark, f"{tmp}/in", records)
        queries = start_speed_views(file_envelope_source(spark, f"{tmp}/in"), f"{tmp}/out", f"{tmp}/ck",
                                    views=("posts", "late"), processing_time="200 milliseconds")
        def watch():
            end = time.time() + 40
            while time.time() < end:
                try:
                    if until():
                        break
                except Exception:  # noqa: BLE001  the tables do not exist yet
                    pass
                time.sleep(0.3)
            for q in queries.values():
                q.stop()
        stop = threading.Thread(target=watch)
        stop.start()
        try:
            wait(spark, queries, available_now=False, late=late)
        finally:
            stop.join()

    def total():
        return sum(r.num_posts for r in read_latest(spark, f"{tmp}/out/posts_per_minute", ["window_start", "subreddit"]).collect())
    job([post("a", ts=ts(0))], "raise", lambda: total() == 1)
    job([post("b", ts=ts(40))], "raise", lambda: total() == 2)
    with pytest.raises(RuntimeError, match="later than the watermark"):
        job([post("late", ts=ts(1)), post("c", ts=ts(41))], "raise",
            lambda: total() == 3 and read_late(spark, f"{tmp}/out/late_posts").count() == 1)
    assert total() == 3
    assert [r.post_id for r in read_late(spark, f"{tmp}/out/late_posts").collect()] == ["late"]


def test_streaming_percentiles_stay_within_the_sketch_error(spark, tmp):
    """One minute with many records over three micro-batches and restarts: the
    percentiles' ranks are within one in SKETCH_ACCURACY (and one for ties)."""
    n = 30_000
    late = F.pmod(F.col("id") * 7919, F.lit(n))  # every delay once
    for part in range(3):
        rows = spark.range(part * n // 3, (part + 1) * n // 3).select(
            F.lit(None).cast("binary").alias("key"),
            F.encode(F.to_json(F.struct(F.col("id").cast("string").alias("post_id"), F.lit(ts(3)).alias("timestamp"))), "UTF-8").alias("value"),
            F.lit("reddit.posts").alias("topic"), F.lit(0).alias("partition"), F.col("id").alias("offset"),
            F.timestamp_add("MILLISECOND", late, F.lit(ts(3)).cast("timestamp")).alias("timestamp"), F.lit(0).alias("timestampType"))
        rows.write.mode("append").parquet(f"{tmp}/in")
        src = ingest.decode_entity(file_envelope_source(spark, f"{tmp}/in"), "posts")
        run_to_end(start(speed.latency_per_minute(src), f"{tmp}/ck", output_mode="update", available_now=True,
                         foreach_batch=ChangelogSink(f"{tmp}/out", f"{tmp}/ck")))
    r = read_latest(spark, f"{tmp}/out", ["window_start"]).first()
    assert r.n == n and r.max_ms == n - 1
    off = n / speed.SKETCH_ACCURACY + 1
    assert abs(r.p50_ms - n * 0.5) <= off and abs(r.p95_ms - n * 0.95) <= off


def _operators(q, metric):
    """A metric of the stateful operators over a run, by operator."""
    out = {}
    for p in q.recentProgress:
        for i, op in enumerate(p["stateOperators"]):
            out[i] = out.get(i, 0) + op["customMetrics"].get(metric, 0)
    return out


def _run_spread(spark, tmp, spread):
    rows = ingest.decode_entity(file_envelope_source(spark, f"{tmp}/in"), "posts")
    once = speed.dedup_spread(rows, ["post_id", "timestamp"], spread=spread)
    return run_to_end(start(once.select("post_id", "timestamp"), f"{tmp}/ck", path=f"{tmp}/rows", available_now=True))


def test_a_redelivery_storm_is_spread_before_it_meets(spark, tmp):
    env = envelope(spark, [post("hot", ts=ts(1))] * 2000 + [post(f"p{i}", ts=ts(i % 5, i % 60)) for i in range(100)])
    env.coalesce(1).write.mode("append").parquet(f"{tmp}/in")
    q = _run_spread(spark, tmp, spread=16)
    got = sorted(r.post_id for r in spark.read.parquet(f"{tmp}/rows").collect())
    assert got == sorted(["hot", *(f"p{i}" for i in range(100))])
    dropped = _operators(q, "numDroppedDuplicateRows")
    # the first step keeps one copy for each of 16 groups, the second meets only those
    assert sorted(dropped.values()) == [15, 2000 - 16]
    # again after a restart: the state of both steps knows the keys
    env.coalesce(1).write.mode("append").parquet(f"{tmp}/in")
    _run_spread(spark, tmp, spread=16)
    assert spark.read.parquet(f"{tmp}/rows").count() == 101


def test_spread_dedup_equals_the_plain_form(spark, tmp):
    recs = [post(f"p{i % 7}", ts=ts(i % 3)) for i in range(60)]
    land(spark, f"{tmp}/in", recs)
    _run_spread(spark, tmp, spread=4)
    rows = ingest.decode_entity(file_envelope_source(spark, f"{tmp}/in"), "posts")
    plain = speed.dedup_within_watermark(rows, ["post_id", "timestamp"]).select("post_id", "timestamp")
    run_to_end(start(plain, f"{tmp}/ck2", path=f"{tmp}/plain", available_now=True))
    key = lambda r: (r.post_id, r.timestamp)
    got = sorted(map(key, spark.read.parquet(f"{tmp}/rows").collect()))
    assert got == sorted(map(key, spark.read.parquet(f"{tmp}/plain").collect())) and len(got) == 21


def test_reconciling_two_streams_as_their_time_closes(spark, tmp):
    def at(minute):
        return dt.datetime(2024, 1, 1, minute // 60, minute % 60, tzinfo=dt.timezone.utc)

    def put(side, rows):
        spark.createDataFrame(rows, "id string, timestamp timestamp").coalesce(1).write.mode("append").parquet(f"{tmp}/{side}")

    def run():
        a, b = (spark.readStream.schema("id string, timestamp timestamp").parquet(f"{tmp}/{s}") for s in ("sent", "got"))
        run_to_end(start(speed.reconcile_within_watermark(a, b, "id"), f"{tmp}/ck", path=f"{tmp}/rows", available_now=True))
        return {(r.id, r.timestamp.minute): (r.produced, r.landed, r.status) for r in spark.read.parquet(f"{tmp}/rows").collect()}
    put("sent", [("a", at(0)), ("b", at(0)), ("c", at(1)), ("c", at(1)), ("a", at(2)), ("n", None)])
    put("got", [("a", at(0)), ("x", at(1)), ("c", at(1)), ("a", at(2)), ("a", at(2)), ("n", None)])
    assert run() == {}  # nothing has closed
    put("sent", [("z", at(40))])
    assert run() == {}  # the other stream may still bring what is missing
    put("sent", [("y", at(40))])  # after a restart Spark knows the watermark of a stream from its next record on
    put("got", [("z", at(40)), ("y", at(40)), ("b", at(35))])
    want = {("b", 0): (1, 0, "missing"), ("c", 1): (2, 1, "short"), ("x", 1): (0, 1, "unexpected"), ("a", 2): (1, 2, "duplicated")}
    assert run() == want
    put("sent", [("end", at(90))])
    put("got", [("end", at(90))])
    assert run() == want | {("b", 35): (0, 1, "unexpected")}  # an id of another time is another record


def test_a_storm_is_written_by_the_tasks_that_hold_it(spark, tmp):
    from strata.session import path_exists
    env = envelope(spark, [post("hot", ts=ts(1))] * 400).repartition(4)
    before = spark.conf.get("spark.sql.maxConcurrentOutputFileWriters")
    write_envelope(env.unionByName(env.withColumn("topic", F.lit("reddit.comments"))), f"{tmp}/in")
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == before
    files = spark.read.parquet(f"{tmp}/in").groupBy("topic", F.input_file_name().alias("file")).count().collect()
    # equal records are small in a shuffle, after which one task got them all
    assert sorted(r["topic"] for r in files) == ["reddit.comments"] * 4 + ["reddit.posts"] * 4
    assert sum(r["count"] for r in files) == 800 and max(r["count"] for r in files) < 110
    write_envelope(env.withColumn("slice", F.col("offset") % 2), f"{tmp}/by", by=("slice", "topic"))
    assert path_exists(spark, f"{tmp}/by/slice=1/topic=reddit.posts") and spark.read.parquet(f"{tmp}/by").count() == 400


def test_reconciling_keeps_one_state_per_id_and_time(spark, tmp):
    minute = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)
    rows = {"sent": [("a", minute), ("b", minute), (None, minute), (None, minute)],
            "got": [("a", minute), (None, minute), (None, minute)]}
    for side, own in rows.items():
        beat = [("end", minute + dt.timedelta(hours=1))]
        spark.createDataFrame(own + beat, "id string, timestamp timestamp").coalesce(1).write.parquet(f"{tmp}/{side}")
    a, b = (spark.readStream.schema("id string, timestamp timestamp").parquet(f"{tmp}/{s}") for s in ("sent", "got"))
    q = run_to_end(start(speed.reconcile_within_watermark(a, b, "id"), f"{tmp}/ck", path=f"{tmp}/rows", available_now=True))
    assert [o["operatorName"] for o in q.lastProgress["stateOperators"]] == ["stateStoreSave"]
    got = sorted((r.id or "", r.produced, r.landed, r.status) for r in spark.read.parquet(f"{tmp}/rows").collect())
    # no id is equal to none of the other side
    assert got == [("", 0, 2, "unexpected"), ("", 2, 0, "missing"), ("b", 1, 0, "missing")]


def test_changelogs_are_folded_while_the_job_runs(spark, tmp):
    from strata.session import subfolders
    want = {}
    for i in range(7):
        land(spark, f"{tmp}/in", [post(f"p{i}", subreddit="ab"[i % 2], score=i, ts=ts(i))])
        want[(dt.datetime(2024, 1, 1, 0, i), "ab"[i % 2])] = (1, i)
        qs = start_speed_views(file_envelope_source(spark, f"{tmp}/in"), f"{tmp}/out", f"{tmp}/ck", views=("posts",),
                               available_now=True, compact_every=2)
        run_to_end(qs["posts"])
    name = f"{tmp}/out/posts_per_minute"
    got = {(r.window_start.replace(tzinfo=None), r.subreddit): (r.num_posts, r.total_score)
           for r in read_latest(spark, name, KEYS, snapshot=f"{tmp}/out/_snapshots/posts_per_minute").collect()}
    assert got == want
    run, = (f for f in subfolders(spark, name) if f.startswith("run="))
    assert len(subfolders(spark, f"{name}/{run}")) <= 4
    assert len(subfolders(spark, f"{tmp}/out/_snapshots/posts_per_minute")) <= 2
