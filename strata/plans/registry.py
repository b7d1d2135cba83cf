"""Named queries over the driver's test tables.

Each entry takes ``(spark, sf_dir)`` and returns a DataFrame over the whole
tables. Streaming entries land the tables in the envelope format (a Spark
write), run the real streaming query to the end of its input
(``availableNow``) into a fresh folder under the shared checkpoint root,
and return the serving table they produced.
"""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import store
from ..functions.time import as_wall_clock, iso_string, on_dates, parse_day
from ..operators import ingest, quality, views
from ..schemas import ENTITY_IDS, ENVELOPE, TOPICS
from ..session import ensure_utc, remove_path, scratch_path
from ..sources import bindings as B
from ..sources.bootstrap import bootstrap_load
from ..sources.kafka import file_envelope_source, write_envelope
from ..sources.partitioned import read_partitioned, read_quarantine
from ..streaming import speed
from ..streaming.late import LateSink, read_late
from ..streaming.runner import VIEW_FIELDS, run_streaming_job, run_to_end, start
from ..streaming.ingest_stream import start_ingest
from ..streaming.sinks import ChangelogSink, read_latest
from . import serving
from .batch_job import compute_views, run_batch_job
from .published import publish_views, read_view, vacuum_views

REGISTRY: dict = {}

# Fixed parameters of the registered queries.
DATE_FILTER = "2024-01-10"
SERVING_CUTOFF = "2024-01-16"
TOP_K_POSTS = 3
TOP_K_USERS = 10
TOP_K_SUBREDDITS = 2
SLICES = 4
OUT_OF_ORDER = (0, 2, 1, 3)
EMPTIED_DAY = "2023-01-01"


def query(fn):
    @functools.wraps(fn)
    def wrapped(spark: SparkSession, sf_dir: str) -> DataFrame:
        ensure_utc(spark)
        return fn(spark, sf_dir)
    REGISTRY[fn.__name__] = wrapped
    return wrapped


def _posts(spark, sf):
    return B.posts(spark, sf)


def _comments(spark, sf):
    return B.comments(spark, sf)


# --- batch views --------------------------------------------------------------------------------

@query
def subreddit_activity(spark, sf):
    return views.subreddit_activity(_posts(spark, sf))


@query
def top_posts(spark, sf):
    return views.top_posts(_posts(spark, sf))


@query
def top_posts_on_date(spark, sf):
    return views.top_posts(_posts(spark, sf), date_filter=DATE_FILTER)


@query
def top_k_posts(spark, sf):
    return views.top_k_posts(_posts(spark, sf), k=TOP_K_POSTS)


@query
def user_activity(spark, sf):
    return views.order_activity(views.user_totals(B.activity(spark, sf)))


@query
def user_activity_daily_join(spark, sf):
    """Users who only post or only comment on a day are common, so this is
    the full outer join whose unmatched rows count."""
    return views.user_days(_posts(spark, sf), _comments(spark, sf))


@query
def top_contributors(spark, sf):
    return views.best_contributors(views.user_totals(B.activity(spark, sf)), k=TOP_K_USERS)


@query
def load_summary(spark, sf):
    return views.load_summary(_posts(spark, sf), _comments(spark, sf), B.users(spark, sf))


@query
def active_users_hourly(spark, sf):
    return views.active_users(B.activity(spark, sf), "hour")


@query
def top_subreddits(spark, sf):
    return views.top_subreddits(_posts(spark, sf), k=TOP_K_SUBREDDITS)


@query
def throughput_per_minute(spark, sf):
    return views.throughput_per_minute(B.activity(spark, sf))


@query
def subreddit_trend(spark, sf):
    return views.subreddit_trend(_posts(spark, sf))


@query
def user_activity_daily(spark, sf):
    return views.daily_user_activity(B.activity(spark, sf))


# --- ingest and the stored table -----------------------------------------------------------------

def _ingested(spark, sf, entities, envelope=None):
    """Land the test tables as wire records, then batch-ingest them into a
    fresh store."""
    base = scratch_path(spark, "store")
    env = envelope if envelope is not None else B.envelope(spark, sf, entities)
    write_envelope(env, f"{base}/_landed")
    _ingest_landed(spark, f"{base}/_landed", base, entities)
    remove_path(spark, f"{base}/_landed")
    return base


def _ingest_landed(spark, path, base, entities):
    ingest.ingest_batch(spark.read.schema(ENVELOPE).parquet(path), base, entities=entities)


@query
def scan_partitioned(spark, sf):
    base = _ingested(spark, sf, ("posts",))
    t = read_partitioned(spark, base, "posts")
    return t.select("post_id", "score", as_wall_clock(F.col("timestamp")).alias("timestamp"),
                    "year", "month", "day", "hour")


@query
def store_compacted(spark, sf):
    """A store of many loads, merged while loads go on: a load that first came
    with another's records and is sent again, one that is sent again after it
    was merged, and one after the merge; old versions are removed at the end."""
    base = scratch_path(spark, "store")
    write_envelope(B.envelope(spark, sf, ("posts",)), f"{base}/_landed")
    landed = spark.read.schema(ENVELOPE).parquet(f"{base}/_landed")
    part = [landed.filter(F.col("offset") % SLICES == i) for i in range(SLICES)]
    ingest.ingest_batch(part[1], base, load="slice-0")
    for i in range(SLICES - 1):
        ingest.ingest_batch(part[i], base, load=f"slice-{i}")
    store.compact_store(spark, base)
    ingest.ingest_batch(part[1], base, load="slice-1")
    ingest.ingest_batch(part[SLICES - 1], base, load=f"slice-{SLICES - 1}")
    store.compact_store(spark, base)
    store.vacuum(spark, base, keep=1)
    remove_path(spark, f"{base}/_landed")
    return read_partitioned(spark, base, "posts").select(
        "post_id", "score", as_wall_clock(F.col("timestamp")).alias("timestamp"), "year", "month", "day", "hour")


@query
def partition_counts(spark, sf):
    base = _ingested(spark, sf, ("posts",))
    return views.partition_counts(read_partitioned(spark, base, "posts"))


@query
def batch_job_views(spark, sf):
    """The batch job as it runs: ingest all entities, load the store, write
    the views; the daily view as written."""
    base = _ingested(spark, sf, ("posts", "comments", "users"))
    run_batch_job(spark, base, f"{base}/_views")
    return spark.read.parquet(f"{base}/_views/subreddit_activity").select(
        "subreddit", "date", "num_posts", "total_score", "total_comments", "avg_score")


@query
def ingest_route(spark, sf):
    return ingest.route(B.envelope(spark, sf)).groupBy("data_type").agg(F.count(F.lit(1)).alias("n"))


@query
def bootstrap_load_posts(spark, sf):
    d = scratch_path(spark, "bootstrap")
    ev = B.table(spark, sf, "events")
    B.post_json(ev).select("json").write.text(f"{d}/posts.json")
    B.comment_json(ev).select("json").write.text(f"{d}/comments.json")
    # users.json is absent on purpose: a missing entity file is skipped
    loaded = bootstrap_load(spark, d)
    return loaded["posts"].select("post_id", "user_id", "subreddit", "score",
                                  as_wall_clock(F.col("timestamp")).alias("timestamp"))


def _damaged_envelope(spark, sf):
    return B.to_envelope(B.damaged_events_json(spark, sf))


def _status_counts(spark, base):
    """Stored rows of posts and comments as ``ok``, those of them that keep
    their whole text as ``rescued``, and quarantined rows by reason."""
    stored = (read_partitioned(spark, base, "posts", rescued=True).select(ingest.RESCUED)
              .unionByName(read_partitioned(spark, base, "comments", rescued=True).select(ingest.RESCUED)))
    ok = stored.agg(F.count(F.lit(1)).alias("ok"), F.count(ingest.RESCUED).alias("rescued"))
    ok = ok.selectExpr("stack(2, 'ok', ok, 'rescued', rescued) AS (status, n)")
    bad = (read_quarantine(spark, base).groupBy(F.col("reason").alias("status"))
           .agg(F.count(F.lit(1)).alias("n")))
    return ok.unionByName(bad)


@query
def ingest_quarantine(spark, sf):
    base = _ingested(spark, sf, ("posts", "comments"), envelope=_damaged_envelope(spark, sf))
    return _status_counts(spark, base)


@query
def stream_ingest_quarantine(spark, sf):
    """The same faulty records through the streaming ingest."""
    d = scratch_path(spark, "stream_store")
    write_envelope(_damaged_envelope(spark, sf), f"{d}/envelope")
    src = file_envelope_source(spark, f"{d}/envelope")
    for q in start_ingest(spark, src, f"{d}/store", f"{d}/checkpoint", entities=("posts", "comments"),
                          available_now=True).values():
        run_to_end(q)
    return _status_counts(spark, f"{d}/store")


@query
def ingest_bootstrap_and_live(spark, sf):
    """One store for history and live records: every other record (and all
    users) from a dump, the rest through the stream, then both once more.
    Each record is stored once."""
    d = scratch_path(spark, "bootstrap_live")
    ev = B.table(spark, sf, "events")
    old = ev.filter(F.col("event_id") % 2 == 0)
    B.post_json(old).select("json").write.text(f"{d}/dump/posts.json")
    B.comment_json(old).select("json").write.text(f"{d}/dump/comments.json")
    B.user_json(B.table(spark, sf, "customer")).select("json").write.text(f"{d}/dump/users.json")
    new = ev.filter(F.col("event_id") % 2 == 1)
    write_envelope(B.to_envelope(B.post_json(new).unionByName(B.comment_json(new))), f"{d}/envelope")
    for _ in range(2):
        for q in start_ingest(spark, file_envelope_source(spark, f"{d}/envelope"), f"{d}/store", f"{d}/checkpoint",
                              bootstrap_dir=f"{d}/dump", available_now=True).values():
            run_to_end(q)
    out = None
    for entity, key in ENTITY_IDS.items():
        ids = read_partitioned(spark, f"{d}/store", entity).select(
            F.lit(entity).alias("data_type"), F.col(key).alias("id"), as_wall_clock(F.col("timestamp")).alias("timestamp"))
        out = ids if out is None else out.unionByName(ids)
    return out


@query
def reconcile_missing(spark, sf):
    """What was produced against what a store holds. Records with faults are
    missing; besides, by the divisor of event_id: 59 not in the producer's
    log (unexpected), 47 delivered twice (duplicated), 43 produced twice but
    delivered once (short)."""
    wire = _damaged_envelope(spark, sf)
    again = wire.filter(F.col("offset") % 47 == 0)
    base = _ingested(spark, sf, ("posts", "comments"), envelope=wire.unionByName(again))
    events = (B.table(spark, sf, "events").filter(F.col("event_type").isin(B.POST_TYPES + B.COMMENT_TYPES))
              .select("event_id").filter(F.col("event_id") % 59 != 0))
    twice = events.unionByName(events.filter(F.col("event_id") % 43 == 0))
    produced = twice.select(F.col("event_id").cast("string").alias("id"))
    landed = (read_partitioned(spark, base, "posts").select(F.col("post_id").alias("id"))
              .unionByName(read_partitioned(spark, base, "comments").select(F.col("comment_id").alias("id"))))
    return quality.reconcile(produced, landed, "id")


@query
def latency_stats(spark, sf):
    # one narrow parse of both topics: latency needs only the type, event time and arrival
    env = B.envelope(spark, sf, ("posts", "comments"))
    rows = ingest.classify(env).filter(F.col("_status") == ingest.OK)
    return quality.latency_stats(rows.select("data_type", "timestamp", "_arrival"), ["data_type"], quantiles=True)


# --- streaming ---------------------------------------------------------------------------------

def _landed_envelope(spark, sf, entities, name, copies=1):
    d = scratch_path(spark, name)
    env = B.envelope(spark, sf, entities)
    for _ in range(copies):
        write_envelope(env, f"{d}/envelope")
    return d, file_envelope_source(spark, f"{d}/envelope")


def _slice_of(spark, sf, at):
    """The slice of the events' time that a time lies in."""
    low, high = B.table(spark, sf, "events").agg(F.min("ts").cast("timestamp"), F.max("ts").cast("timestamp")).first()
    return F.floor((F.unix_micros(at) - F.unix_micros(F.lit(low))) * SLICES
                   / (F.unix_micros(F.lit(high)) - F.unix_micros(F.lit(low)) + 1))


def _sliced(spark, sf, env, path):
    """A function slice -> the envelope's records in it; they are rendered once,
    to ``path``, and not again for each slice."""
    arrived = F.timestamp_add("MILLISECOND", -B.arrival_delay_ms("offset"), F.col("timestamp"))
    write_envelope(env.withColumn("slice", _slice_of(spark, sf, arrived)), path, by=("slice", "topic"))
    staged = spark.read.schema(f"{ENVELOPE.toDDL()}, slice long").parquet(path)
    return lambda i: staged.filter(F.col("slice") == i).drop("slice")


def _in_slices(spark, sf, entities, d, run, copies=1, order=None, late="raise"):
    """Land the records in slices of event time (ascending, or in the given
    order) and run the query to the end after each, from its checkpoint: the
    result must not depend on how the input was cut into micro-batches."""
    records = _sliced(spark, sf, B.envelope(spark, sf, entities), f"{d}/_slices")
    for i in order or range(SLICES):
        for _ in range(copies):
            write_envelope(records(i), f"{d}/envelope")
        run_to_end(run(file_envelope_source(spark, f"{d}/envelope")), late=late)
    remove_path(spark, f"{d}/_slices")


def _start_posts_per_minute(src, d, serving_measures=False):
    decoded = ingest.decode_entity(src, "posts", fields=VIEW_FIELDS["posts"])
    return start(speed.posts_per_minute(decoded, serving=serving_measures), f"{d}/checkpoint", output_mode="update",
                 foreach_batch=ChangelogSink(f"{d}/serving", f"{d}/checkpoint"), available_now=True)


def _run_posts_per_minute(spark, sf, serving_measures=False):
    d, src = _landed_envelope(spark, sf, ("posts",), "posts_per_minute")
    run_to_end(_start_posts_per_minute(src, d, serving_measures), late="raise")
    return read_latest(spark, f"{d}/serving", ["window_start", "subreddit"])


def _wall(df, *cols):
    return df.withColumns({c: as_wall_clock(F.col(c)) for c in cols})


@query
def posts_per_minute(spark, sf):
    out = _run_posts_per_minute(spark, sf)
    return _wall(out, "window_start", "window_end").select(
        "window_start", "window_end", "subreddit", "num_posts", "total_score")


@query
def posts_per_minute_batches(spark, sf):
    d = scratch_path(spark, "posts_per_minute_batches")
    _in_slices(spark, sf, ("posts",), d, lambda src: _start_posts_per_minute(src, d))
    out = read_latest(spark, f"{d}/serving", ["window_start", "subreddit"])
    return _wall(out, "window_start", "window_end").select(
        "window_start", "window_end", "subreddit", "num_posts", "total_score")


@query
def late_records(spark, sf):
    """The posts that came after their minute had closed, when the second and
    third quarter of the time change places: each slice is a micro-batch after
    a restart."""
    d = scratch_path(spark, "late_records")

    def late(src):
        rows = ingest.decode_entity(src, "posts", fields=VIEW_FIELDS["late_posts"])
        return start(rows, f"{d}/checkpoint", foreach_batch=LateSink(f"{d}/late", f"{d}/checkpoint"), available_now=True)
    _in_slices(spark, sf, ("posts",), d, late, order=OUT_OF_ORDER)
    return _wall(read_late(spark, f"{d}/late"), "timestamp", "window_end", "watermark").select(
        "post_id", "subreddit", "score", "timestamp", "window_end", "watermark")


@query
def comments_per_minute(spark, sf):
    d, src = _landed_envelope(spark, sf, ("comments",), "comments_per_minute")
    view = speed.comments_per_minute(ingest.decode_entity(src, "comments", fields=VIEW_FIELDS["comments"]))
    run_to_end(start(view, f"{d}/checkpoint", output_mode="update",
                     foreach_batch=ChangelogSink(f"{d}/serving", f"{d}/checkpoint"), available_now=True), late="raise")
    out = read_latest(spark, f"{d}/serving", ["window_start", "post_id"])
    return _wall(out, "window_start", "window_end").select(
        "window_start", "window_end", "post_id", "num_comments")


@query
def user_feed(spark, sf):
    d, src = _landed_envelope(spark, sf, ("users",), "user_feed")
    view = speed.user_feed(ingest.decode_entity(src, "users"))
    run_to_end(start(view, f"{d}/checkpoint", output_mode="append", path=f"{d}/feed", available_now=True))
    return spark.read.parquet(f"{d}/feed").select("user_id", "username", "karma")


@query
def streaming_job_views(spark, sf):
    """The speed job as it runs, with its panels: rows of each view, and the
    records that they add up to."""
    d, src = _landed_envelope(spark, sf, ("posts", "comments", "users"), "streaming_job")
    run_streaming_job(spark, src, f"{d}/views", f"{d}/checkpoint", late="raise", available_now=True,
                      views=("posts", "comments", "users", "panels"))
    counted = {"posts_per_minute": (["window_start", "subreddit"], "num_posts"),
               "comments_per_minute": (["window_start", "post_id"], "num_comments"),
               "throughput": (["window_start"], "events"), "latency": (["window_start"], "n")}
    out = spark.read.parquet(f"{d}/views/user_feed").agg(
        F.lit("user_feed").alias("view"), F.count(F.lit(1)).alias("n"), F.count("user_id").alias("records"))
    for name, (keys, total) in counted.items():
        out = out.unionByName(read_latest(spark, f"{d}/views/{name}", keys).agg(
            F.lit(name).alias("view"), F.count(F.lit(1)).alias("n"), F.sum(total).alias("records")))
    return out


@query
def stream_decode(spark, sf):
    d, src = _landed_envelope(spark, sf, ("posts",), "stream_decode")
    rows = ingest.decode_entity(src, "posts").select(
        "post_id", "user_id", "subreddit", "score", "num_comments", "timestamp")
    run_to_end(start(rows, f"{d}/checkpoint", output_mode="append", path=f"{d}/rows", available_now=True))
    return _wall(spark.read.parquet(f"{d}/rows"), "timestamp")


def _start_dedup(src, d, dedup=speed.dedup_within_watermark):
    p = dedup(ingest.decode_entity(src, "posts", fields=["post_id"]), ["post_id", "timestamp"])
    c = dedup(ingest.decode_entity(src, "comments", fields=["comment_id"]), ["comment_id", "timestamp"])
    rows = (p.select(F.col("post_id").alias("id"), "timestamp")
            .unionByName(c.select(F.col("comment_id").alias("id"), "timestamp")))
    return start(rows, f"{d}/checkpoint", output_mode="append", path=f"{d}/rows", available_now=True)


def _deduped(spark, d):
    out = spark.read.parquet(f"{d}/rows")
    return out.select(F.col("id").cast("bigint").alias("event_id"), as_wall_clock(F.col("timestamp")).alias("ts"))


@query
def dedup_events(spark, sf):
    """Every record delivered twice; the stream keeps one copy per
    (id, event time)."""
    d, src = _landed_envelope(spark, sf, ("posts", "comments"), "dedup_events", copies=2)
    run_to_end(_start_dedup(src, d), late="raise")
    return _deduped(spark, d)


@query
def dedup_events_batches(spark, sf):
    d = scratch_path(spark, "dedup_events_batches")
    _in_slices(spark, sf, ("posts", "comments"), d, lambda src: _start_dedup(src, d), copies=2)
    return _deduped(spark, d)


@query
def dedup_events_storm(spark, sf):
    """Every record delivered twice, and the last post once more for each record
    there is, so that it makes up a third of the stream."""
    d, src = _landed_envelope(spark, sf, ("posts", "comments"), "dedup_storm", copies=2)
    env = B.envelope(spark, sf, ("posts",))
    last = env.agg(F.max_by(F.struct("key", "value", "timestamp"), "offset").alias("r")).first()["r"]  # one record
    if last is not None:
        storm = B.envelope(spark, sf, ("posts", "comments")).withColumns(
            {"topic": F.lit(TOPICS["posts"]), "offset": -1 - F.col("offset"),
             **{c: F.lit(last[c]) for c in ("key", "value", "timestamp")}})
        write_envelope(storm, f"{d}/envelope")
    run_to_end(_start_dedup(src, d, speed.dedup_spread), late="raise")
    return _deduped(spark, d)


@query
def reconcile_stream(spark, sf):
    """``reconcile_missing`` while both logs come in: four slices of event time,
    the job restarted between them, and at the end a heartbeat on each log,
    which closes the last minutes."""
    d = scratch_path(spark, "reconcile_stream")
    wire = _sliced(spark, sf, _damaged_envelope(spark, sf), f"{d}/_slices")
    sent = (B.table(spark, sf, "events").filter(F.col("event_type").isin(B.POST_TYPES + B.COMMENT_TYPES))
            .filter(F.col("event_id") % 59 != 0).select(F.col("event_id").alias("n"), F.col("ts").cast("timestamp").alias("timestamp")))
    sent = sent.unionByName(sent.filter(F.col("n") % 43 == 0)).select(F.col("n").cast("string").alias("id"), "timestamp")

    def land(records, log):
        write_envelope(records, f"{d}/wire")
        log.hint("rebalance").write.mode("append").parquet(f"{d}/log")
        src = file_envelope_source(spark, f"{d}/wire")
        landed = [ingest.decode_entity(src, e, fields=[key]).select(F.col(key).alias("id"), "timestamp")
                  for e, key in ENTITY_IDS.items() if e != "users"]
        view = speed.reconcile_within_watermark(spark.readStream.schema(sent.schema).parquet(f"{d}/log"),
                                                functools.reduce(DataFrame.unionByName, landed), "id")
        run_to_end(start(view, f"{d}/checkpoint", path=f"{d}/rows", available_now=True), late="raise")
    went = _slice_of(spark, sf, F.col("timestamp"))
    for i in range(SLICES):
        land(wire(i).unionByName(wire(i).filter(F.col("offset") % 47 == 0)), sent.filter(went == i))
    remove_path(spark, f"{d}/_slices")
    beat = B.table(spark, sf, "events").agg((F.max("ts") + F.expr("INTERVAL 1 DAY")).alias("ts")).select(
        F.lit(-1).cast("bigint").alias("event_id"), "ts", F.lit("posts").alias("data_type"),
        F.to_json(F.struct(F.lit("-1").alias("post_id"), iso_string(F.col("ts")).alias("timestamp"))).alias("json"))
    land(B.to_envelope(beat), beat.select(F.lit("-1").alias("id"), F.col("ts").cast("timestamp").alias("timestamp")))
    return spark.read.parquet(f"{d}/rows").select("id", "produced", "landed", "status")


@query
def latest_window(spark, sf):
    out = _run_posts_per_minute(spark, sf)
    latest = views.latest_per_key(out, ["subreddit"], "window_start", ["num_posts", "total_score"])
    return _wall(latest, "window_start")


# --- serving -----------------------------------------------------------------------------------

@query
def incremental_subreddit_activity(spark, sf):
    """A daily table with wrong scores and a day that no post belongs to;
    refreshing its days makes it right."""
    path = scratch_path(spark, "daily")
    posts = _posts(spark, sf)
    moved = posts.withColumn("timestamp", F.lit(EMPTIED_DAY).cast("timestamp_ntz"))
    wrong = posts.withColumn("score", F.col("score") + 1).unionByName(moved)
    serving.write_daily(wrong, path)
    days = [r["date"] for r in spark.read.parquet(path).select("date").distinct().collect()]  # one a day
    serving.write_daily(posts, path, days=days)
    return serving.read_daily(spark, path)


@query
def refresh_touched_days(spark, sf):
    """The daily table kept up with a store: after each load the days that it
    changed, found in the store's manifest, are counted anew."""
    d = scratch_path(spark, "touched")
    write_envelope(B.envelope(spark, sf, ("posts",)), f"{d}/landed")
    landed = spark.read.schema(ENVELOPE).parquet(f"{d}/landed")
    cut = F.lit(DATE_FILTER).cast("timestamp")
    even, early = F.col("offset") % 2 == 0, F.col("timestamp") < cut
    for load, which in (("even", even), ("early", ~even & early), ("late", ~even & ~early)):
        ingest.ingest_batch(landed.filter(which), f"{d}/store", load=load)
        serving.refresh_daily(spark, f"{d}/store", f"{d}/daily")
    return serving.read_daily(spark, f"{d}/daily")


@query
def serving_top_posts(spark, sf):
    path = scratch_path(spark, "serving")
    serving.load_serving({"top_posts": views.post_totals(_posts(spark, sf))}, path)
    return spark.read.parquet(f"{path}/top_posts").select("key", "post_id", "total_score", "total_comments")


@query
def published_views(spark, sf):
    """Views published with wrong scores, then made right in two versions, the
    days before the cutoff and the rest; the daily view as the newest version
    has it."""
    base = scratch_path(spark, "published")
    posts, comments = _posts(spark, sf), _comments(spark, sf)
    wrong = posts.withColumn("score", F.col("score") + 1)
    publish_views(spark, compute_views(wrong, comments), base)
    days = [r["date"] for r in read_view(spark, base, "subreddit_activity").select("date").distinct().collect()]  # one a day
    cutoff = parse_day(SERVING_CUTOFF)
    for some in ([d for d in days if d < cutoff], [d for d in days if d >= cutoff]):
        publish_views(spark, compute_views(on_dates(posts, some), comments), base, days=some)
    vacuum_views(spark, base, keep=1)
    return read_view(spark, base, "subreddit_activity").select(
        "subreddit", "date", "num_posts", "total_score", "total_comments", "avg_score")


@query
def serving_merge(spark, sf):
    path = scratch_path(spark, "daily")
    serving.write_daily(_posts(spark, sf), path)
    minutes = _run_posts_per_minute(spark, sf, serving_measures=True)
    return serving.merge_batch_and_speed(spark.read.parquet(path), minutes, SERVING_CUTOFF)


def _both_layers(spark, sf, name, views_):
    """A store of all posts and comments, and the speed views over the same
    landed records as a stream: (store, folder of the speed views)."""
    base, entities = scratch_path(spark, "store"), ("posts", "comments")
    d, src = _landed_envelope(spark, sf, entities, name)
    _ingest_landed(spark, f"{d}/envelope", base, entities)
    run_streaming_job(spark, src, f"{d}/views", f"{d}/checkpoint", late="raise", available_now=True, views=views_)
    return base, f"{d}/views"


@query
def serving_merge_top_posts(spark, sf):
    """The best posts of each subreddit and day, before the cutoff from the
    batch job's view and after it from the stream."""
    base, speed_views = _both_layers(spark, sf, "merge_top", ("totals",))
    run_batch_job(spark, base, f"{base}/_views")
    days = read_latest(spark, f"{speed_views}/posts_per_day", serving.SERVING_KEYS["posts_per_day"])
    return serving.merge_top_posts(spark.read.parquet(f"{base}/_views/top_posts"), days, SERVING_CUTOFF, k=TOP_K_POSTS)


@query
def serving_merge_user_activity(spark, sf):
    """All users' activity, before the cutoff from the batch side's days and
    after it from the stream."""
    base, speed_views = _both_layers(spark, sf, "merge_users", ("totals",))
    records = views.scored_activity(read_partitioned(spark, base, "posts"), read_partitioned(spark, base, "comments"))
    serving.write_user_days(records, f"{base}/_user_days")
    days = read_latest(spark, f"{speed_views}/user_activity_per_day", serving.SERVING_KEYS["user_activity_per_day"])
    return serving.merge_user_activity(spark.read.parquet(f"{base}/_user_days"), days, SERVING_CUTOFF).drop("side")


@query
def serving_merge_active_users(spark, sf):
    """Users active in each hour, from stored sketches of the batch layer before
    the cutoff and the stream's after it."""
    base, speed_views = _both_layers(spark, sf, "merge_active", ("panels",))
    speed.active_user_sketches(read_partitioned(spark, base, "posts")).write.parquet(f"{base}/_sketches")
    hours = read_latest(spark, f"{speed_views}/active_user_sketches", ["window_start"])
    return _wall(serving.merge_active_users(spark.read.parquet(f"{base}/_sketches"), hours, SERVING_CUTOFF), "window_start")


@query
def latency_percentiles_per_minute(spark, sf):
    """Median and 95th percentile of the delay of each minute's posts, from the
    sketches that the stream keeps."""
    d, src = _landed_envelope(spark, sf, ("posts",), "latency_percentiles")
    view = speed.latency_per_minute(ingest.decode_entity(src, "posts", fields=VIEW_FIELDS["panels"]))
    run_to_end(start(view, f"{d}/checkpoint", output_mode="update",
                     foreach_batch=ChangelogSink(f"{d}/serving", f"{d}/checkpoint"), available_now=True), late="raise")
    return _wall(read_latest(spark, f"{d}/serving", ["window_start"]), "window_start").select(
        "window_start", "n", "max_ms", "p50_ms", "p95_ms")
