"""Command line: the batch job, the speed job, ingest, incremental refresh, serving merge.

    python -m strata batch STORE OUTPUT [--date YYYY-MM-DD] [--format parquet|json] [--store-format ...]
    python -m strata stream (--kafka SERVERS | --envelope DIR) --out DIR --checkpoint DIR
    python -m strata ingest (--kafka SERVERS | --envelope DIR) --store DIR --checkpoint DIR [--bootstrap DIR]
    python -m strata load --envelope DIR --store DIR --name LOAD [--bootstrap DIR]
    python -m strata incremental --store DIR --daily DIR --days 2024-01-10,2024-01-11
    python -m strata serve --daily DIR --speed DIR --cutoff YYYY-MM-DD --out DIR [--snapshot DIR]
    python -m strata compact --changelog DIR --keys window_start,subreddit --snapshot DIR

Streaming commands run until stopped, or with ``--available-now`` until
their input is consumed. Checkpoint folders must be on storage shared by
the cluster.
"""

from __future__ import annotations

import argparse
import sys

from .operators.ingest import ingest_batch
from .plans import batch_job, serving
from .plans.published import vacuum_views
from .schemas import ENVELOPE, TOPICS
from .session import build_session, ensure_utc
from .sources.bootstrap import ingest_bootstrap
from .sources.kafka import file_envelope_source, kafka_source
from .sources.partitioned import read_partitioned
from .store import compact_store, vacuum
from .streaming.ingest_stream import start_ingest
from .streaming.runner import run_streaming_job, wait
from .streaming.sinks import compact, read_latest


def _source(spark, args, topics=None):
    if args.kafka:
        return kafka_source(spark, args.kafka, topics=topics, starting_offsets=args.starting_offsets,
                            max_offsets_per_trigger=args.max_offsets_per_trigger,
                            min_partitions=args.min_partitions)
    return file_envelope_source(spark, args.envelope)


def _stream_args(p):
    src = p.add_mutually_exclusive_group(required=True)
    src.add_argument("--kafka", help="bootstrap servers")
    src.add_argument("--envelope", help="folder of envelope Parquet files (test double)")
    p.add_argument("--starting-offsets", default="latest")
    p.add_argument("--max-offsets-per-trigger", type=int)
    p.add_argument("--min-partitions", type=int)
    p.add_argument("--checkpoint", required=True)
    p.add_argument("--available-now", action="store_true")
    p.add_argument("--trigger", help="processing-time trigger, e.g. '10 seconds'")


def parser() -> argparse.ArgumentParser:
    ap = argparse.ArgumentParser(prog="strata")
    ap.add_argument("--master")
    ap.add_argument("--shuffle-partitions", type=int,
                    help="width of shuffles; AQE joins small ones, so size it for the largest (streaming state keeps "
                         "the width of its first start)")
    sub = ap.add_subparsers(dest="cmd", required=True)

    b = sub.add_parser("batch", help="load the store, write the three batch views")
    b.add_argument("store")
    b.add_argument("output")
    b.add_argument("--date")
    b.add_argument("--format", default="parquet", choices=["parquet", "json"], help="format of the written views")
    b.add_argument("--store-format", default="parquet", choices=["parquet", "json"])
    b.add_argument("--top-k", type=int, help="also write the k best posts per subreddit and day")
    b.add_argument("--serving", help="also write serving tables with keys to this folder")
    b.add_argument("--versions", type=int, metavar="KEEP", help="show the views at once as a new version, in the place of "
                   "writing over them, and keep the newest KEEP versions")

    s = sub.add_parser("stream", help="posts, comments and users views of the speed layer")
    _stream_args(s)
    s.add_argument("--out", required=True)
    s.add_argument("--panels", action="store_true", help="also active users, throughput and latency")
    s.add_argument("--totals", action="store_true", help="also the daily totals of posts and users that serving merges")
    s.add_argument("--late-records", action="store_true", help="also keep the posts and comments that came too late")
    s.add_argument("--compact-every", type=int, help="fold each view's changelog into a snapshot after so many micro-batches")
    s.add_argument("--console", action="store_true", help="print the comments and users views")
    s.add_argument("--late", default="report", choices=["report", "raise"],
                   help="what to do at the end when rows were dropped as late")

    i = sub.add_parser("ingest", help="records (and a bootstrap dump) into the hour-partitioned store")
    _stream_args(i)
    i.add_argument("--store", required=True)
    i.add_argument("--bootstrap")
    i.add_argument("--compact-every", type=int, help="merge the store's day folders after so many micro-batches")
    i.add_argument("--max-future", help="quarantine event times this far past arrival, e.g. '1 day'")

    d = sub.add_parser("load", help="landed envelope files or a bootstrap dump into the store, as one named load")
    d.add_argument("--envelope")
    d.add_argument("--bootstrap")
    d.add_argument("--store", required=True)
    d.add_argument("--name", help="load of the envelope files; the same name again replaces its rows")
    d.add_argument("--max-future")

    n = sub.add_parser("incremental", help="recompute the daily view for the given or touched days")
    n.add_argument("--store", required=True)
    n.add_argument("--daily", required=True)
    n.add_argument("--days", help="the days; without it those that loads changed since the last refresh")

    v = sub.add_parser("serve", help="merge the daily batch view with the speed layer's minutes")
    v.add_argument("--daily", required=True)
    v.add_argument("--speed", required=True, help="posts_per_minute changelog folder")
    v.add_argument("--cutoff", required=True)
    v.add_argument("--out", required=True)
    v.add_argument("--snapshot", help="snapshot of the speed changelog written by 'compact'")

    c = sub.add_parser("compact", help="fold a changelog serving table into a snapshot")
    c.add_argument("--changelog", required=True)
    c.add_argument("--keys", required=True)
    c.add_argument("--snapshot", required=True)
    c.add_argument("--remove", action="store_true", help="delete folded batches and snapshots before the last")

    m = sub.add_parser("compact-store", help="merge the day folders that many loads have written")
    m.add_argument("--store", required=True)
    m.add_argument("--max-parts", type=int, default=1, help="merge days that more than so many loads have written")
    m.add_argument("--days")
    m.add_argument("--vacuum", type=int, metavar="KEEP", help="then remove all but the newest KEEP versions")
    return ap


def main(argv=None, spark=None) -> int:
    args = parser().parse_args(argv)
    spark = spark or build_session(master=args.master, app_name=f"strata-{args.cmd}",
                                   shuffle_partitions=args.shuffle_partitions)
    ensure_utc(spark)
    if args.cmd == "batch":
        summary = batch_job.run_batch_job(spark, args.store, args.output, fmt=args.format, date_filter=args.date,
                                          store_format=args.store_format, top_k=args.top_k,
                                          serving_path=args.serving, versions=args.versions is not None)
        for base in filter(None, (args.output, args.serving)) if args.versions else ():
            vacuum_views(spark, base, keep=args.versions)
        for row in summary.collect():  # three rows
            print(f"{row.data_type}: {row.n}")
    elif args.cmd == "stream":
        # the posts view carries the measures the serving merge needs
        per_topic = (lambda entity: _source(spark, args, topics=[TOPICS[entity]])) if args.kafka else _source(spark, args)
        run_streaming_job(spark, per_topic, args.out, args.checkpoint, late=args.late, serving=True,
                          views=("posts", "comments", "users") + ("panels",) * args.panels
                          + ("late",) * args.late_records + ("totals",) * args.totals, console=args.console,
                          compact_every=args.compact_every, available_now=args.available_now, processing_time=args.trigger)
    elif args.cmd == "ingest":
        queries = start_ingest(spark, _source(spark, args), args.store, args.checkpoint, bootstrap_dir=args.bootstrap,
                               available_now=args.available_now, processing_time=args.trigger,
                               max_future=args.max_future, compact_every=args.compact_every)
        wait(spark, queries, args.available_now)
    elif args.cmd == "load":
        if args.bootstrap:
            ingest_bootstrap(spark, args.bootstrap, args.store)
        if args.envelope:
            if not args.name:
                raise SystemExit("--envelope needs --name")
            ingest_batch(spark.read.schema(ENVELOPE).parquet(args.envelope), args.store, max_future=args.max_future,
                         load=args.name)
    elif args.cmd == "incremental":
        if args.days:
            days = args.days.split(",")
            serving.write_daily(read_partitioned(spark, args.store, "posts", days=days), args.daily, days=days)
        else:
            print(" ".join(serving.refresh_daily(spark, args.store, args.daily)))
    elif args.cmd == "serve":
        minutes = read_latest(spark, args.speed, ["window_start", "subreddit"], snapshot=args.snapshot)
        merged = serving.merge_batch_and_speed(spark.read.parquet(args.daily), minutes, args.cutoff)
        merged.write.mode("overwrite").parquet(args.out)
    elif args.cmd == "compact":
        compact(spark, args.changelog, args.keys.split(","), args.snapshot, remove=args.remove)
    elif args.cmd == "compact-store":
        compact_store(spark, args.store, args.max_parts, args.days.split(",") if args.days else None)
        if args.vacuum:
            vacuum(spark, args.store, keep=args.vacuum)
    return 0


if __name__ == "__main__":
    sys.exit(main())
