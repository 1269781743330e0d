"""The manifest store: commits, filters, races, upserts, compaction, streams."""

import glob
import os
import random

import pytest
from pyspark.sql import functions as F

from lokum.plans import store
from lokum.streaming import jobs

SF = "/root/testdata/sf0.001"
SCHEMA = ("external_id string, title string, price_pln double, sqm double, rooms int, district string, "
          "description string, url string")
SITES = {"olx": "olx.pl", "fb": "facebook.com", "mzn": "morizon.pl"}


def rows(*ids, title="t"):
    return [(i, title, 1.0, 2.0, 1, "d", None, f"https://www.{SITES[i.split('-')[0]]}/oferta/{i}") for i in ids]


def frame(spark, *ids, title="t"):
    return spark.createDataFrame(rows(*ids, title=title), SCHEMA)


def files(base):
    return {p: os.stat(p).st_mtime_ns for p in glob.glob(f"{base}/rows/**/*.parquet", recursive=True)}


def state(spark, base):
    version, df = store.current(spark, base)
    return version, sorted((r.external_id, r.title, r.since) for r in df.collect())


def test_a_commit_writes_its_own_groups_only(spark, tmp_path):
    base = str(tmp_path / "s")
    store.ingest(spark, base, frame(spark, *[f"olx-{k}" for k in range(300)]))
    before = files(base)
    assert store.ingest(spark, base, frame(spark, "olx-7", "fb-1", "fb-2", title="new")) == 2
    after = files(base)
    assert before.items() <= after.items() and len(after) - len(before) <= 2
    manifest = store.read_manifest(spark, base)
    assert sum(g.rows for g in manifest.groups if g.version == 2) == 2
    version, got = state(spark, base)
    assert version == 2 and len(got) == 302 and ("olx-7", "t", 1) in got and ("fb-1", "new", 2) in got
    # an older version stays as it was; an empty batch is a version without groups
    old = store.read_manifest(spark, base, 1)
    assert store.read_rows(spark, base, old).count() == 300
    assert store.ingest(spark, base, frame(spark, "olx-1").limit(0)) == 3 and state(spark, base)[1] == got


def test_orphans_are_not_read(spark, tmp_path):
    base = str(tmp_path / "s")
    store.ingest(spark, base, frame(spark, "olx-1"))
    now = store.read_manifest(spark, base)
    lost = store._write(spark, base, now, store.store_record(frame(spark, "olx-2").withColumn("portal", F.lit("olx"))))
    assert lost.version == 2 and state(spark, base) == (1, [("olx-1", "t", 1)])
    assert store.ingest(spark, base, frame(spark, "olx-2")) == 2
    assert [g[0] for g in state(spark, base)[1]] == ["olx-1", "olx-2"]


def test_filters_skip_groups_and_the_store_is_not_shuffled(spark, tmp_path):
    base = str(tmp_path / "s")
    ids = [f"olx-{k}" for k in range(2000)]
    for k in range(4):
        store.ingest(spark, base, frame(spark, *ids[500 * k:500 * (k + 1)]))
    manifest = store.read_manifest(spark, base)
    assert len(manifest.of_kind("rows")) == 4 * store.BUCKETS
    none = store.existing_keys(spark, base, manifest, frame(spark, *[f"olx-{k}" for k in range(9000, 9010)]))
    assert none.keys.count() == 0 and none.opened <= 4 and none.groups == 4 * store.BUCKETS
    one = store.existing_keys(spark, base, manifest, frame(spark, "olx-3", "olx-5000"))
    assert [r.external_id for r in one.keys.collect()] == ["olx-3"] and 1 <= one.opened <= 4
    plan = one.keys._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    asked = frame(spark, *ids[::3], *[f"fb-{k}" for k in range(500)])
    for few in (10, store.BROADCAST_KEYS):  # with and without a broadcast
        got = store.existing_keys(spark, base, manifest, asked, broadcast_keys=few).keys
        assert sorted(r.external_id for r in got.collect()) == sorted(ids[::3])
    wrong = store.existing_keys(spark, base, manifest, frame(spark, *[f"fb-{k}" for k in range(3000)]))
    assert wrong.keys.count() == 0


def test_the_loser_of_a_race_starts_again(spark, tmp_path, monkeypatch):
    base = str(tmp_path / "s")
    store.ingest(spark, base, frame(spark, "olx-1"))
    publish, raced = store.publish, []

    def second(spark_, base_, manifest):
        if not raced:  # another writer is faster, with one key in common
            raced.append(True)
            store.ingest(spark, base, frame(spark, "olx-2", "olx-3", title="winner"))
        publish(spark_, base_, manifest)

    monkeypatch.setattr(store, "publish", second)
    assert store.ingest(spark, base, frame(spark, "olx-3", "olx-4", title="loser")) == 3
    assert state(spark, base)[1] == [("olx-1", "t", 1), ("olx-2", "winner", 2), ("olx-3", "winner", 2), ("olx-4", "loser", 3)]
    with pytest.raises(store.Conflict):
        publish(spark, base, store.Manifest(version=3))
    assert not glob.glob(f"{base}/manifest/.*.tmp")


def test_upserts_and_compaction_against_a_dictionary(spark, tmp_path):
    base, rng, want = str(tmp_path / "s"), random.Random(3), {}
    store.ingest(spark, base, frame(spark, *[f"olx-{k}" for k in range(40)]))
    want = {f"olx-{k}": "t" for k in range(40)}
    columns = store.current(spark, base)[1].drop("since").columns
    for turn in range(4):
        ids = rng.sample([f"olx-{k}" for k in range(60)], 9)
        new = store.store_record(frame(spark, *ids, title=f"u{turn}").withColumn("portal", F.lit("olx")))
        store.upsert(spark, base, new.select(*columns))
        want |= {i: f"u{turn}" for i in ids}
        assert {(i, t) for i, t, _ in state(spark, base)[1]} == set(want.items())
        assert len(state(spark, base)[1]) == len(want)
        if turn == 2:
            before = state(spark, base)
            untouched = {g for g in store.read_manifest(spark, base).groups}
            version = store.compact(spark, base)
            after = store.read_manifest(spark, base)
            assert version == before[0] + 1 and not after.of_kind("deletes") and state(spark, base)[1] == before[1]
            assert all(g in untouched for g in after.groups if g.version < version)
            assert store.compact(spark, base) == version  # nothing left to do


def test_three_arrivals_and_a_replay_equal_the_batch_load(spark, tmp_path):
    landing, base, job = (str(tmp_path / n) for n in ("landing", "s", "job"))
    parts = [("olx-1", "olx-2"), ("olx-2", "fb-3"), ("fb-3", "mzn-4", "olx-1")]
    for k, ids in enumerate(parts):
        frame(spark, *ids, title=f"f{k}").coalesce(1).write.mode("append").parquet(landing)
        assert jobs.stream_listings(spark, landing, base, SCHEMA, base=job) == k + 1
    want = [("fb-3", "f1", 2), ("mzn-4", "f2", 3), ("olx-1", "f0", 1), ("olx-2", "f0", 1)]
    assert state(spark, base) == (3, want)
    # the stream loses its log of the last batch after the store has committed it
    for name in ("2", ".2.crc"):
        os.remove(f"{job}/ckpt/commits/{name}")
    assert jobs.stream_listings(spark, landing, base, SCHEMA, base=job) == 3
    assert state(spark, base) == (3, want) and store.read_manifest(spark, base).jobs == {"listings": 2}
    whole = str(tmp_path / "whole")
    store.ingest(spark, whole, spark.read.schema(SCHEMA).parquet(landing))
    assert [r[0] for r in state(spark, whole)[1]] == [r[0] for r in want]


def events(spark, path, *days):
    (spark.createDataFrame([(k, f"2024-01-{d:02d} 10:00:00", k, "view") for k, d in enumerate(days)],
                           "event_id long, t string, user_id long, event_type string")
     .selectExpr("event_id", "CAST(t AS timestamp_ntz) AS ts", "user_id", "event_type", "0D AS value", "'' AS props")
     .coalesce(1).write.mode("append").parquet(path))


def test_counts_go_on_until_closed(spark, tmp_path):
    landing, base = str(tmp_path / "landing"), str(tmp_path / "job")

    def counts(**options):
        got = jobs.stream_counts(spark, landing, base=base, files=None, **options)
        return {r.window_start[:10]: r.n for r in got.collect()}

    events(spark, landing, 1, 1, 2)
    assert counts(complete=False) == {}
    events(spark, landing, 2, 5, 6)  # any file name, a second arrival
    assert counts(complete=False) == {"2024-01-01": 2, "2024-01-02": 2}
    assert counts() == {"2024-01-01": 2, "2024-01-02": 2, "2024-01-05": 1, "2024-01-06": 1}
    assert counts() == {"2024-01-01": 2, "2024-01-02": 2, "2024-01-05": 1, "2024-01-06": 1}
    with pytest.raises(ValueError):
        counts(complete=False)


def test_delta_reads_every_file_of_a_landing_folder(spark, tmp_path):
    landing, base = str(tmp_path / "landing"), str(tmp_path / "job")
    events(spark, landing, 1, 2)
    first = {r.external_id for r in jobs.stream_delta(spark, SF, base=base, landing=landing).collect()}
    events(spark, landing, *range(3, 28))
    (spark.createDataFrame([(900_001, "click")], "user_id long, event_type string").selectExpr(
        "1L AS event_id", "timestamp_ntz'2024-02-01' AS ts", "user_id", "event_type", "0D AS value", "'' AS props")
     .coalesce(1).write.mode("append").parquet(landing))
    second = {r.external_id for r in jobs.stream_delta(spark, SF, base=base, landing=landing).collect()}
    assert first < second and "ev-900001-click" in second
