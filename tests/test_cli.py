"""The command line end to end: ingest, batch views, speed views, refresh, merge."""

from strata.cli import main
from strata.sources.kafka import write_envelope
from strata.sources.partitioned import read_partitioned
from strata.streaming.sinks import read_latest
from tests.helpers import comment, envelope, post, user


def test_cli_end_to_end(spark, tmp, capsys):
    recs = [post(f"p{d}{i}", user_id=f"u{i}", subreddit=["a", "b"][i % 2], score=i,
                 ts=f"2024-01-0{d}T0{i}:1{i}:00Z") for d in (1, 2, 3) for i in range(4)]
    env = (envelope(spark, recs).unionByName(envelope(spark, [comment("c1", user_id="u1")], "comments"))
           .unionByName(envelope(spark, [user("u1")], "users")))
    write_envelope(env, f"{tmp}/env")

    assert main(["ingest", "--envelope", f"{tmp}/env", "--store", f"{tmp}/store",
                 "--checkpoint", f"{tmp}/ck/ingest", "--available-now"], spark=spark) == 0
    assert read_partitioned(spark, f"{tmp}/store", "posts").count() == 12

    main(["batch", f"{tmp}/store", f"{tmp}/views", "--top-k", "1"], spark=spark)
    assert "posts: 12" in capsys.readouterr().out
    assert spark.read.parquet(f"{tmp}/views/subreddit_activity").count() == 6
    best = {(r.subreddit, r.date.day): r.post_id for r in spark.read.parquet(f"{tmp}/views/top_k_posts").collect()}
    assert best == {("a", 1): "p12", ("b", 1): "p13", ("a", 2): "p22", ("b", 2): "p23", ("a", 3): "p32", ("b", 3): "p33"}

    main(["stream", "--envelope", f"{tmp}/env", "--out", f"{tmp}/speed", "--checkpoint", f"{tmp}/ck/speed",
          "--available-now"], spark=spark)
    assert read_latest(spark, f"{tmp}/speed/posts_per_minute", ["window_start", "subreddit"]).count() == 12

    main(["incremental", "--store", f"{tmp}/store", "--daily", f"{tmp}/daily", "--days",
          "2024-01-01,2024-01-02,2024-01-03"], spark=spark)
    main(["compact", "--changelog", f"{tmp}/speed/posts_per_minute", "--keys", "window_start,subreddit",
          "--snapshot", f"{tmp}/speed_snapshot"], spark=spark)
    main(["serve", "--daily", f"{tmp}/daily", "--speed", f"{tmp}/speed/posts_per_minute", "--cutoff",
          "2024-01-03", "--out", f"{tmp}/served", "--snapshot", f"{tmp}/speed_snapshot"], spark=spark)
    served = sorted(tuple(r) for r in spark.read.parquet(f"{tmp}/served").collect())
    batch = sorted(tuple(r) for r in spark.read.parquet(f"{tmp}/views/subreddit_activity").select(
        "subreddit", "date", "num_posts", "total_score", "total_comments", "avg_score").collect())
    assert served == batch
