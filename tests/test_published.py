"""Views as versions: shown whole, replaced by day, kept when a write fails."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from strata.cli import main
from strata.plans import batch_job
from strata.plans.published import publish_views, read_view, vacuum_views, view_versions
from strata.operators import ingest
from strata.session import subfolders
from tests.helpers import comment, envelope, post


def days(spark, rows):
    return spark.createDataFrame([(dt.date.fromisoformat(d) if d else None, n) for d, n in rows], "date date, n long")


def held(df):
    return sorted(((str(r.date) if r.date else None, r.n) for r in df.collect()), key=str)


def test_all_views_of_a_job_come_in_one_version(spark, tmp):
    one = spark.range(3)
    assert publish_views(spark, {"a": days(spark, [("2024-01-01", 1)]), "b": one}, tmp) == 1
    assert publish_views(spark, {"a": days(spark, [("2024-01-02", 2)]), "b": one.limit(1)}, tmp) == 2
    assert held(read_view(spark, tmp, "a")) == [("2024-01-02", 2)] and read_view(spark, tmp, "b").count() == 1
    assert held(read_view(spark, tmp, "a", version=1)) == [("2024-01-01", 1)]
    assert publish_views(spark, {"c": one}, tmp) == 3  # the others stay
    assert held(read_view(spark, tmp, "a")) == [("2024-01-02", 2)]
    with pytest.raises(ValueError):
        read_view(spark, tmp, "d")


def test_a_failed_write_leaves_the_version_before(spark, tmp):
    publish_views(spark, {"a": days(spark, [("2024-01-01", 1)]), "b": spark.range(2)}, tmp)
    before = {n: subfolders(spark, f"{tmp}/{n}") for n in "ab"}
    reader = read_view(spark, tmp, "a")
    broken = spark.range(2).withColumn("id", F.raise_error(F.lit("no")).cast("long"))
    with pytest.raises(Exception, match="no"):
        publish_views(spark, {"a": days(spark, [("2024-01-01", 9)]), "b": broken}, tmp)
    assert view_versions(spark, tmp)[0] == 1 and held(read_view(spark, tmp, "a")) == held(reader) == [("2024-01-01", 1)]
    assert {n: subfolders(spark, f"{tmp}/{n}") for n in "ab"} == before


def test_days_are_replaced_emptied_and_kept(spark, tmp):
    publish_views(spark, {"a": days(spark, [("2024-01-01", 1), ("2024-01-02", 2), ("2024-01-03", 3), (None, 4)]),
                          "b": spark.range(2)}, tmp)
    # 2024-01-04 was not asked for, 2024-01-02 has no rows left
    publish_views(spark, {"a": days(spark, [("2024-01-01", 7), ("2024-01-04", 8)]), "b": spark.range(5)}, tmp,
                  days=["2024-01-01", "2024-01-02"])
    assert held(read_view(spark, tmp, "a")) == [("2024-01-01", 7), ("2024-01-03", 3), (None, 4)]
    assert read_view(spark, tmp, "b").count() == 5
    assert held(read_view(spark, tmp, "a", days=["2024-01-03"])) == [("2024-01-03", 3)]
    assert held(read_view(spark, tmp, "a", days=["2023-01-03"])) == []
    with pytest.raises(ValueError):
        publish_views(spark, {"a": days(spark, []).withColumn("more", F.lit(1))}, tmp, days=["2024-01-01"])


def test_readers_keep_their_version_until_it_is_removed(spark, tmp):
    for n in range(4):
        publish_views(spark, {"a": days(spark, [("2024-01-01", n), ("2024-01-02", n)][:2 if n == 0 else 1])}, tmp,
                      days=["2024-01-01"] if n else None)
    reader = read_view(spark, tmp, "a", version=3)
    assert vacuum_views(spark, tmp, keep=2) == 2
    assert held(reader) == [("2024-01-01", 2), ("2024-01-02", 0)]
    assert held(read_view(spark, tmp, "a")) == [("2024-01-01", 3), ("2024-01-02", 0)]
    assert len(subfolders(spark, f"{tmp}/a")) == 3  # of the first the second day is still shown
    assert vacuum_views(spark, tmp, keep=2) == 0


def test_of_two_writers_the_later_adds_to_the_other(spark, tmp, monkeypatch):
    from strata.plans import published
    publish_views(spark, {"a": days(spark, [("2024-01-01", 1)])}, tmp)
    real, calls = published.publish, []

    def slower(*args):
        if not calls:
            calls.append(1)
            monkeypatch.setattr(published, "publish", real)
            publish_views(spark, {"b": spark.range(3)}, tmp)
        return real(*args)
    monkeypatch.setattr(published, "publish", slower)
    assert publish_views(spark, {"a": days(spark, [("2024-01-01", 2)])}, tmp) == 3
    assert held(read_view(spark, tmp, "a")) == [("2024-01-01", 2)] and read_view(spark, tmp, "b").count() == 3


def test_the_batch_job_publishes_its_views_and_serving_tables(spark, tmp, capsys):
    env = envelope(spark, [post("a", ts="2024-01-01T01:00:00Z"), post("b", ts="2024-01-02T01:00:00Z")]).unionByName(
        envelope(spark, [comment("c")], "comments"))
    ingest.ingest_batch(env, f"{tmp}/store")
    for _ in range(3):
        main(["batch", f"{tmp}/store", f"{tmp}/views", "--serving", f"{tmp}/served", "--versions", "2"], spark=spark)
    ingest.ingest_batch(envelope(spark, [post("n", ts="2024-01-02T03:00:00Z")]), f"{tmp}/store", load="more")
    batch_job.run_batch_job(spark, f"{tmp}/store", f"{tmp}/views", date_filter="2024-01-02", versions=True)
    assert {r.post_id for r in read_view(spark, f"{tmp}/views", "top_posts").collect()} == {"a", "b", "n"}
    assert {r.key.split("|")[2] for r in read_view(spark, f"{tmp}/served", "top_posts").collect()} == {"a", "b"}
    assert view_versions(spark, f"{tmp}/views")[0] == 4
