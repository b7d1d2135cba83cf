"""The store's manifest: loads, merging, versions, touched days."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from strata import store
from strata.operators import ingest
from strata.plans import serving
from strata.session import subfolders
from strata.sources.partitioned import read_partitioned, read_quarantine
from tests.helpers import comment, envelope, post


def at(day, hour=0):
    return f"2024-01-{day:02d}T{hour:02d}:00:00Z"


def load(spark, base, name, *recs):
    ingest.ingest_batch(envelope(spark, list(recs)), base, load=name)


def ids(df):
    return sorted(r.post_id for r in df.collect())


def test_merging_keeps_rows_and_bounds_what_a_day_lists(spark, tmp):
    for n in range(6):
        load(spark, tmp, f"run-{n}", post(f"a{n}", ts=at(1, n)), post(f"b{n}", ts=at(2)), "{bad")
    rows = sorted(map(tuple, read_partitioned(spark, tmp, "posts", rescued=True).collect()))
    bad = sorted((r.value, r.reason) for r in read_quarantine(spark, tmp).collect())
    assert len(rows) == 12 and len(bad) == 6
    assert len(read_partitioned(spark, tmp, "posts", days=["2024-01-01"]).inputFiles()) == 6
    store.compact_store(spark, tmp, hour_bytes=0)
    assert sorted(map(tuple, read_partitioned(spark, tmp, "posts", rescued=True).collect())) == rows
    assert sorted((r.value, r.reason) for r in read_quarantine(spark, tmp).collect()) == bad
    assert {p.key for p in store.load_manifest(spark, tmp).parts} == {
        ("posts", "ok", "2024-01-01"), ("posts", "ok", "2024-01-02"), ("posts", "malformed_json", None)}
    assert len(store.load_manifest(spark, tmp).parts) == 3
    assert len(read_partitioned(spark, tmp, "posts", days=["2024-01-02"]).inputFiles()) == 1
    files = read_partitioned(spark, tmp, "posts", days=["2024-01-01"]).inputFiles()
    assert len(files) == 6 and all("/hour=0" in f for f in files)  # one for each hour now, however many loads
    for n in range(6, 12):
        load(spark, tmp, f"run-{n}", post(f"a{n}", ts=at(1, n % 6)))
        store.compact_store(spark, tmp, hour_bytes=0 if n < 10 else store.HOUR_BYTES)
        assert len(read_partitioned(spark, tmp, "posts", days=["2024-01-01"]).inputFiles()) == (6 if n < 10 else 1)
    assert len(ids(read_partitioned(spark, tmp, "posts"))) == 18
    assert store.compact_store(spark, tmp) is None


def test_a_reader_sees_one_version_through_merging_and_loads(spark, tmp):
    load(spark, tmp, "one", post("a"))
    load(spark, tmp, "two", post("b"))
    before = read_partitioned(spark, tmp, "posts")
    version = store.load_manifest(spark, tmp).version
    store.compact_store(spark, tmp)
    during = read_partitioned(spark, tmp, "posts")
    load(spark, tmp, "one", post("c"))
    assert ids(before) == ["a", "b"] and ids(during) == ["a", "b"]
    assert ids(read_partitioned(spark, tmp, "posts")) == ["b", "c"]
    assert ids(read_partitioned(spark, tmp, "posts", version=version)) == ["a", "b"]
    kept = read_partitioned(spark, tmp, "posts")
    assert store.vacuum(spark, tmp, keep=1) > 0
    assert ids(kept) == ["b", "c"] == ids(read_partitioned(spark, tmp, "posts"))
    shown = {p.path.split("/")[0] for p in store.load_manifest(spark, tmp).parts}
    assert {f for f in subfolders(spark, tmp) if f.startswith("part=")} == shown


def test_a_load_that_runs_again_with_other_input_leaves_nothing_behind(spark, tmp):
    load(spark, tmp, "x", post("a", ts=at(1)), post("b", ts=at(2)), "{bad")
    load(spark, tmp, "y", post("c", ts=at(1)))
    load(spark, tmp, "x", post("d", ts=at(3)))
    assert ids(read_partitioned(spark, tmp, "posts")) == ["c", "d"] and read_quarantine(spark, tmp).count() == 0
    store.compact_store(spark, tmp, max_parts=0)  # single folders too
    load(spark, tmp, "y", post("e", ts=at(1)))
    assert ids(read_partitioned(spark, tmp, "posts")) == ["d", "e"]


def test_a_replayed_micro_batch_is_found_in_merged_folders(spark, tmp):
    for n in (0, 1, 2, 10):
        load(spark, tmp, f"q-{n}", post(f"p{n}"))
    store.compact_store(spark, tmp)
    (part,) = store.load_manifest(spark, tmp).parts
    assert part.loads == {"q": {"named": False, "ranges": [[0, 2], [10, 10]]}}
    load(spark, tmp, "q-2", post("again"))
    assert ids(read_partitioned(spark, tmp, "posts")) == ["again", "p0", "p1", "p10"]
    load(spark, tmp, "q-3", post("p3"))
    assert len(ids(read_partitioned(spark, tmp, "posts"))) == 5


def test_names_of_loads():
    held = {}
    names = ["2024-01-01", "a-0", "a-1", "a-3", "a", "b-01", "-7", "7"]
    for n in names:
        store.add_load(held, n)
    assert all(store.holds(held, n) for n in names)
    assert not any(store.holds(held, n) for n in ["a-2", "b-1", "b", "2024-01", "2024-01-1", "", "a-"])
    assert held["a"] == {"named": True, "ranges": [[0, 1], [3, 3]]}


def test_of_two_writers_of_a_version_both_are_shown(spark, tmp, monkeypatch):
    load(spark, tmp, "zero", post("z"))
    publish, other = store._publish, []

    def late(spark_, base, m):
        if not other:
            other.append(1)
            load(spark, tmp, "other", post("o"))
        return publish(spark_, base, m)
    monkeypatch.setattr(store, "_publish", late)
    load(spark, tmp, "mine", post("m"))
    assert ids(read_partitioned(spark, tmp, "posts")) == ["m", "o", "z"]
    assert store.load_manifest(spark, tmp).version == 3
    assert not store.publish(spark, f"{tmp}/_versions", 3, "{}") and len(store.load_manifest(spark, tmp).parts) == 3


@pytest.mark.parametrize("meanwhile", ["one", "three"])
def test_merging_meets_loads_that_come_meanwhile(spark, tmp, monkeypatch, meanwhile):
    load(spark, tmp, "one", post("a"))
    load(spark, tmp, "two", post("b"))
    publish, other = store._publish, []

    def late(spark_, base, m):
        if not other:
            other.append(1)
            load(spark, tmp, meanwhile, post("c"))
        return publish(spark_, base, m)
    monkeypatch.setattr(store, "_publish", late)
    store.compact_store(spark, tmp)
    assert ids(read_partitioned(spark, tmp, "posts")) == (["b", "c"] if meanwhile == "one" else ["a", "b", "c"])


def test_a_failed_load_changes_nothing(spark, tmp):
    load(spark, tmp, "x", post("a"))
    rows = ingest.load_rows(ingest.route(envelope(spark, [post("b")])), "x")
    with pytest.raises(Exception, match="broken"):
        ingest.write_load(rows.withColumn("title", F.raise_error(F.lit("broken")).cast("string")), tmp, "x")
    assert ids(read_partitioned(spark, tmp, "posts")) == ["a"] and store.load_manifest(spark, tmp).version == 1
    store.new_part(tmp)
    parts = lambda: [f for f in subfolders(spark, tmp) if f.startswith("part=")]
    store.vacuum(spark, tmp, orphans_after=dt.timedelta(days=1))
    assert ids(read_partitioned(spark, tmp, "posts")) == ["a"]
    store.vacuum(spark, tmp, orphans_after=dt.timedelta(0))
    assert len(parts()) == 1 and ids(read_partitioned(spark, tmp, "posts")) == ["a"]


def test_refresh_finds_the_days_itself(spark, tmp):
    base, daily = f"{tmp}/store", f"{tmp}/daily"
    load(spark, base, "one", post("a", ts=at(1)), post("b", ts=at(2)))
    ingest.ingest_batch(envelope(spark, [comment("c", ts=at(9))], "comments"), base, load="comments")
    assert serving.refresh_daily(spark, base, daily) == ["2024-01-01", "2024-01-02"]
    load(spark, base, "two", post("c", ts=at(2)), post("d", ts=at(3)))
    store.compact_store(spark, base)  # merging changes no day
    assert serving.refresh_daily(spark, base, daily) == ["2024-01-02", "2024-01-03"]
    assert serving.refresh_daily(spark, base, daily) == []
    load(spark, base, "one", post("b", ts=at(2)))  # the first day loses its only post
    assert serving.refresh_daily(spark, base, daily) == ["2024-01-01", "2024-01-02"]
    got = sorted((str(r.date), r.num_posts) for r in serving.read_daily(spark, daily).collect())
    assert got == [("2024-01-02", 2), ("2024-01-03", 1)]


def test_stream_merges_as_it_goes(spark, tmp):
    from strata.sources.kafka import file_envelope_source, write_envelope
    from strata.streaming.ingest_stream import start_ingest
    from strata.streaming.runner import run_to_end
    for n in range(5):
        write_envelope(envelope(spark, [post(f"p{n}")]), f"{tmp}/envelope")
        for q in start_ingest(spark, file_envelope_source(spark, f"{tmp}/envelope"), f"{tmp}/store", f"{tmp}/checkpoint",
                              available_now=True, compact_every=2).values():
            run_to_end(q)
    assert ids(read_partitioned(spark, f"{tmp}/store", "posts")) == [f"p{n}" for n in range(5)]
    assert len(store.load_manifest(spark, f"{tmp}/store").parts) <= 3
