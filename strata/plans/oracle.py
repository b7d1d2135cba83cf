"""Independent DuckDB SQL for each registered query.

Each entry is ``PRELUDE`` + body over the pre-registered test tables. Ids
that travel through JSON are strings on our side, hence the VARCHAR casts;
integer sums are cast to BIGINT (DuckDB widens them to HUGEINT).
"""

PRELUDE = """
WITH posts AS (
  SELECT event_id AS post_id, user_id, event_type AS subreddit, 'Post title ' || event_id AS title,
         CAST(round(value * 100) AS BIGINT) AS score,
         CAST(json_extract(props, '$.k') AS BIGINT) AS num_comments, ts
  FROM events WHERE event_type IN ('view', 'purchase', 'signup')),
comments AS (
  SELECT event_id AS comment_id, CAST(json_extract(props, '$.k') AS BIGINT) AS post_id, user_id,
         CAST(round(value * 100) AS BIGINT) AS score, ts
  FROM events WHERE event_type IN ('click', 'error')),
post_totals AS (
  SELECT subreddit, CAST(ts AS DATE) AS date, post_id, title, user_id,
         CAST(sum(score) AS BIGINT) AS total_score, CAST(sum(num_comments) AS BIGINT) AS total_comments
  FROM posts GROUP BY ALL),
daily AS (
  SELECT subreddit, CAST(ts AS DATE) AS date, count(post_id) AS num_posts,
         CAST(sum(score) AS BIGINT) AS total_score, CAST(sum(num_comments) AS BIGINT) AS total_comments,
         avg(score) AS avg_score
  FROM posts GROUP BY 1, 2),
ua AS (
  SELECT user_id, coalesce(num_posts, 0) AS num_posts, coalesce(post_score, 0) AS post_score,
         coalesce(num_comments, 0) AS num_comments, coalesce(comment_score, 0) AS comment_score
  FROM (SELECT user_id, count(post_id) AS num_posts, CAST(sum(score) AS BIGINT) AS post_score
        FROM posts GROUP BY 1) p
  FULL JOIN (SELECT user_id, count(comment_id) AS num_comments, CAST(sum(score) AS BIGINT) AS comment_score
        FROM comments GROUP BY 1) c USING (user_id)),
activity AS (
  SELECT user_id, ts, 1 AS is_post FROM posts UNION ALL SELECT user_id, ts, 0 AS is_post FROM comments),
ppm AS (
  SELECT date_trunc('minute', ts) AS window_start, date_trunc('minute', ts) + INTERVAL 1 MINUTE AS window_end,
         subreddit, count(post_id) AS num_posts, CAST(sum(score) AS BIGINT) AS total_score
  FROM posts GROUP BY ALL),
slices AS (
  SELECT p.*, (epoch_us(ts) - low) * 4 // (high - low + 1) AS slice
  FROM posts p, (SELECT epoch_us(min(ts)) AS low, epoch_us(max(ts)) AS high FROM events)),
fault AS (
  SELECT event_id, event_type, CASE WHEN event_id % 61 = 0 THEN 'unknown_topic'
                        WHEN event_id % 97 = 0 THEN 'malformed_json' WHEN event_id % 89 = 0 THEN 'missing_time'
                        WHEN event_id % 83 = 0 THEN 'bad_time' WHEN event_id % 79 = 0 THEN 'malformed_json'
                        WHEN event_id % 73 = 0 THEN 'bad_time'
                        WHEN event_id % 53 = 0 OR event_id % 37 = 0 THEN 'malformed_json' ELSE 'ok' END AS status
  FROM events WHERE event_type IN ('view', 'purchase', 'signup', 'click', 'error')),
fault_counts AS (
  SELECT status, count(*) AS n FROM fault GROUP BY 1
  UNION ALL SELECT 'rescued', count(*) FROM fault WHERE status = 'ok'
    AND (event_id % 71 = 0 OR event_id % 67 = 0 OR event_id % 31 = 0))
"""

BODIES = {
    "subreddit_activity": "SELECT * FROM daily",
    "top_posts": "SELECT * FROM post_totals",
    "top_posts_on_date": "SELECT * FROM post_totals WHERE date = DATE '2024-01-10'",
    "top_k_posts": """
        SELECT * FROM (
          SELECT *, CAST(row_number() OVER (PARTITION BY subreddit, date
                                            ORDER BY total_score DESC, post_id, user_id, title) AS INT) AS rank
          FROM post_totals) WHERE rank <= 3""",
    "user_activity": """
        SELECT *, num_posts + num_comments AS total_activity, post_score + comment_score AS total_score FROM ua""",
    "user_activity_daily_join": """
        SELECT user_id, date, coalesce(num_posts, 0) AS num_posts, coalesce(posts_score, 0) AS posts_score,
               coalesce(num_comments, 0) AS num_comments, coalesce(comments_score, 0) AS comments_score
        FROM (SELECT user_id, CAST(ts AS DATE) AS date, count(*) AS num_posts, CAST(sum(score) AS BIGINT) AS posts_score
              FROM posts GROUP BY 1, 2) p
        FULL JOIN (SELECT user_id, CAST(ts AS DATE) AS date, count(*) AS num_comments,
                          CAST(sum(score) AS BIGINT) AS comments_score
              FROM comments GROUP BY 1, 2) c USING (user_id, date)""",
    "top_contributors": """
        SELECT user_id, num_posts, num_comments, num_posts + num_comments AS total_activity,
               post_score + comment_score AS total_score
        FROM ua ORDER BY total_activity DESC, user_id ASC NULLS LAST LIMIT 10""",
    "load_summary": """
        SELECT 'posts' AS data_type, count(*) AS n FROM posts
        UNION ALL SELECT 'comments', count(*) FROM comments
        UNION ALL SELECT 'users', count(*) FROM customer""",
    "active_users_hourly": """
        SELECT date_trunc('hour', ts) AS window_start, count(DISTINCT user_id) AS active_users
        FROM activity GROUP BY 1""",
    "top_subreddits": """
        SELECT subreddit, count(post_id) AS num_posts FROM posts GROUP BY 1
        ORDER BY num_posts DESC, subreddit ASC NULLS LAST LIMIT 2""",
    "throughput_per_minute": """
        SELECT date_trunc('minute', ts) AS window_start, count(*) AS events,
               CAST(count(*) AS DOUBLE) / 60.0 AS per_second FROM activity GROUP BY 1""",
    "subreddit_trend": """
        SELECT subreddit, date, num_posts,
               num_posts - lag(num_posts) OVER (PARTITION BY subreddit ORDER BY date) AS delta FROM daily""",
    "user_activity_daily": """
        SELECT user_id, date, num_posts, num_comments, total_activity,
               total_activity - lag(total_activity) OVER (PARTITION BY user_id ORDER BY date) AS delta
        FROM (SELECT user_id, CAST(ts AS DATE) AS date, CAST(sum(is_post) AS BIGINT) AS num_posts,
                     CAST(sum(1 - is_post) AS BIGINT) AS num_comments, count(*) AS total_activity
              FROM activity GROUP BY 1, 2)""",
    "scan_partitioned": """
        SELECT CAST(post_id AS VARCHAR) AS post_id, score, ts AS timestamp,
               CAST(year(ts) AS INT) AS year, CAST(month(ts) AS INT) AS month,
               CAST(day(ts) AS INT) AS day, CAST(hour(ts) AS INT) AS hour FROM posts""",
    "store_compacted": """
        SELECT CAST(post_id AS VARCHAR) AS post_id, score, ts AS timestamp,
               CAST(year(ts) AS INT) AS year, CAST(month(ts) AS INT) AS month,
               CAST(day(ts) AS INT) AS day, CAST(hour(ts) AS INT) AS hour FROM posts""",
    "partition_counts": """
        SELECT CAST(year(ts) AS INT) AS year, CAST(month(ts) AS INT) AS month, CAST(day(ts) AS INT) AS day,
               CAST(hour(ts) AS INT) AS hour, count(*) AS n FROM posts GROUP BY 1, 2, 3, 4""",
    "ingest_route": """
        SELECT CASE WHEN event_type IN ('click', 'error') THEN 'comments' ELSE 'posts' END AS data_type,
               count(*) AS n FROM events WHERE event_type IN ('view', 'purchase', 'signup', 'click', 'error')
        GROUP BY 1
        UNION ALL SELECT 'users', count(*) FROM customer""",
    "bootstrap_load_posts": """
        SELECT CAST(post_id AS VARCHAR) AS post_id, CAST(user_id AS VARCHAR) AS user_id, subreddit, score,
               ts AS timestamp FROM posts""",
    "ingest_quarantine": "SELECT * FROM fault_counts",
    "stream_ingest_quarantine": "SELECT * FROM fault_counts",
    "batch_job_views": "SELECT * FROM daily",
    "streaming_job_views": """
        SELECT 'user_feed' AS view, count(*) AS n, count(*) AS records FROM customer
        UNION ALL SELECT 'posts_per_minute', count(*), CAST(sum(num_posts) AS BIGINT) FROM ppm
        UNION ALL SELECT 'comments_per_minute', count(DISTINCT (date_trunc('minute', ts), post_id)), count(*) FROM comments
        UNION ALL SELECT 'throughput', count(DISTINCT date_trunc('minute', ts)), count(*) FROM posts
        UNION ALL SELECT 'latency', count(DISTINCT date_trunc('minute', ts)), count(*) FROM posts""",
    "ingest_bootstrap_and_live": """
        SELECT CASE WHEN event_type IN ('click', 'error') THEN 'comments' ELSE 'posts' END AS data_type,
               CAST(event_id AS VARCHAR) AS id, ts AS timestamp
        FROM events WHERE event_type IN ('view', 'purchase', 'signup', 'click', 'error')
        UNION ALL SELECT 'users', CAST(c_custkey AS VARCHAR),
               TIMESTAMP '2024-01-01 00:00:00' + to_minutes(CAST(c_custkey AS BIGINT)) FROM customer""",
    "reconcile_missing": """
        SELECT *, CASE WHEN landed = 0 THEN 'missing' WHEN produced = 0 THEN 'unexpected'
                       WHEN landed > produced THEN 'duplicated' ELSE 'short' END AS status
        FROM (SELECT CAST(event_id AS VARCHAR) AS id,
                     CAST(CASE WHEN event_id % 59 = 0 THEN 0 WHEN event_id % 43 = 0 THEN 2 ELSE 1 END AS BIGINT) AS produced,
                     CAST(CASE WHEN status <> 'ok' THEN 0 WHEN event_id % 47 = 0 THEN 2 ELSE 1 END AS BIGINT) AS landed
              FROM fault) WHERE produced <> landed""",
    "reconcile_stream": """
        SELECT *, CASE WHEN landed = 0 THEN 'missing' WHEN produced = 0 THEN 'unexpected'
                       WHEN landed > produced THEN 'duplicated' ELSE 'short' END AS status
        FROM (SELECT CAST(event_id AS VARCHAR) AS id,
                     CAST(CASE WHEN event_id % 59 = 0 THEN 0 WHEN event_id % 43 = 0 THEN 2 ELSE 1 END AS BIGINT) AS produced,
                     CAST(CASE WHEN status <> 'ok' THEN 0 WHEN event_id % 47 = 0 THEN 2 ELSE 1 END AS BIGINT) AS landed
              FROM fault) WHERE produced <> landed""",
    "latency_stats": """
        SELECT CASE WHEN event_type IN ('click', 'error') THEN 'comments' ELSE 'posts' END AS data_type,
               count(*) AS n, avg(event_id % 2000) AS avg_ms, CAST(max(event_id % 2000) AS DOUBLE) AS max_ms,
               CAST(quantile_disc(event_id % 2000, 0.5) AS DOUBLE) AS p50_ms,
               CAST(quantile_disc(event_id % 2000, 0.95) AS DOUBLE) AS p95_ms
        FROM events WHERE event_type IN ('view', 'purchase', 'signup', 'click', 'error') GROUP BY 1""",
    "posts_per_minute": "SELECT * FROM ppm",
    "posts_per_minute_batches": "SELECT * FROM ppm",
    "late_records": """
        SELECT CAST(p.post_id AS VARCHAR) AS post_id, subreddit, score, p.ts AS timestamp,
               date_trunc('minute', p.ts) + INTERVAL 1 MINUTE AS window_end, m.watermark
        FROM (SELECT *, CASE slice WHEN 1 THEN 2 WHEN 2 THEN 1 ELSE slice END AS turn FROM slices) p
        JOIN (SELECT turn, max(max(date_trunc('millisecond', ts))) OVER (ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
                     - INTERVAL 10 MINUTE AS watermark
              FROM (SELECT CASE slice WHEN 1 THEN 2 WHEN 2 THEN 1 ELSE slice END AS turn, ts FROM slices) GROUP BY turn) m
          USING (turn)
        WHERE date_trunc('minute', p.ts) + INTERVAL 1 MINUTE <= m.watermark""",
    "comments_per_minute": """
        SELECT date_trunc('minute', ts) AS window_start, date_trunc('minute', ts) + INTERVAL 1 MINUTE AS window_end,
               CAST(post_id AS VARCHAR) AS post_id, count(comment_id) AS num_comments FROM comments GROUP BY ALL""",
    "user_feed": """
        SELECT CAST(c_custkey AS VARCHAR) AS user_id, c_name AS username,
               CAST(round(c_acctbal) AS BIGINT) AS karma FROM customer""",
    "stream_decode": """
        SELECT CAST(post_id AS VARCHAR) AS post_id, CAST(user_id AS VARCHAR) AS user_id, subreddit, score,
               num_comments, ts AS timestamp FROM posts""",
    "dedup_events": """
        SELECT event_id, ts FROM events WHERE event_type IN ('view', 'purchase', 'signup', 'click', 'error')""",
    "dedup_events_batches": """
        SELECT event_id, ts FROM events WHERE event_type IN ('view', 'purchase', 'signup', 'click', 'error')""",
    "dedup_events_storm": """
        SELECT event_id, ts FROM events WHERE event_type IN ('view', 'purchase', 'signup', 'click', 'error')""",
    "latest_window": """
        SELECT subreddit, max(window_start) AS window_start, arg_max(num_posts, window_start) AS num_posts,
               arg_max(total_score, window_start) AS total_score FROM ppm GROUP BY 1""",
    "incremental_subreddit_activity": "SELECT * FROM daily",
    "refresh_touched_days": "SELECT * FROM daily",
    "published_views": "SELECT * FROM daily",
    "serving_merge": "SELECT * FROM daily",
    "serving_merge_top_posts": """
        SELECT * FROM (
          SELECT subreddit, date, CAST(post_id AS VARCHAR) AS post_id, title, CAST(user_id AS VARCHAR) AS user_id,
                 total_score, total_comments,
                 CAST(row_number() OVER (PARTITION BY subreddit, date ORDER BY total_score DESC, CAST(post_id AS VARCHAR),
                                         CAST(user_id AS VARCHAR), title) AS INT) AS rank
          FROM post_totals) WHERE rank <= 3""",
    "serving_merge_user_activity": """
        SELECT CAST(user_id AS VARCHAR) AS user_id, num_posts, post_score, num_comments, comment_score,
               num_posts + num_comments AS total_activity, post_score + comment_score AS total_score FROM ua""",
    "serving_merge_active_users": """
        SELECT date_trunc('hour', ts) AS window_start, count(DISTINCT user_id) AS active_users FROM posts GROUP BY 1""",
    "latency_percentiles_per_minute": """
        SELECT date_trunc('minute', ts) AS window_start, count(*) AS n, CAST(max(post_id % 2000) AS DOUBLE) AS max_ms,
               CAST(quantile_disc(post_id % 2000, 0.5) AS DOUBLE) AS p50_ms,
               CAST(quantile_disc(post_id % 2000, 0.95) AS DOUBLE) AS p95_ms FROM posts GROUP BY 1""",
    "serving_top_posts": """
        SELECT concat_ws('|', subreddit, CAST(date AS VARCHAR), CAST(post_id AS VARCHAR), title, CAST(user_id AS VARCHAR)) AS key,
               post_id, total_score, total_comments FROM post_totals""",
}

ORACLE_SQL = {name: PRELUDE + body for name, body in BODIES.items()}
