"""Stores: whole versions, replays, crashes, compaction, bounded reads."""

import random

import pytest
from pyspark.sql import functions as F

from tallyspan.sources import store as s


def frame(spark, rows):
    return spark.createDataFrame(rows, "id string, x long")


def content(store):
    return {r["id"]: r["x"] for r in store.read().collect()}


def files_of(store):
    at = store.manifest()
    return {b: f for b, f in at.base.items()}


def test_batches_replays_and_compaction(spark, tmp_path):
    store = s.Store(spark, str(tmp_path / "v"), "id", buckets=4, max_deltas=3)
    with pytest.raises(ValueError, match="Nothing"):
        store.read()
    truth, pick = {}, random.Random(1)
    for batch in range(11):
        rows = [(f"k{pick.randrange(12)}", 100 * batch + n) for n in range(3)]
        rows = list(dict(rows).items())
        truth |= dict(rows)
        for _ in range(2):  # each batch is written twice, as a replay does
            store.append(frame(spark, [*rows, (None, 1)]), batch)
        assert content(store) == truth
        assert len(store.manifest().deltas) < 3
    assert store.manifest().folded >= 8
    before = store.manifest().version
    store.append(frame(spark, [("k0", -1)]), 2)  # long folded
    assert store.manifest().version == before and content(store) == truth
    # data folders do not grow with the number of batches
    assert len(list((tmp_path / "v" / "data").iterdir())) <= 4 + 3 * s.KEEP + 3
    assert len(list((tmp_path / "v" / "manifests").glob("[0-9]*"))) == s.KEEP
    with pytest.raises(ValueError, match="columns"):
        store.append(spark.createDataFrame([("k0", "text")], "id string, x string"), 99)


def test_readers_see_whole_versions_and_crashes_change_nothing(spark, tmp_path, monkeypatch):
    store = s.Store(spark, str(tmp_path / "v"), "id", buckets=4, max_deltas=100)
    store.replace(frame(spark, [("a", 1), ("b", 2)]))
    store.append(frame(spark, [("b", 3), ("c", 4)]), 0)
    resolved = store.read()  # a reader that began before the writes below
    publish = s.Store._publish

    def dies(self, manifest):
        raise RuntimeError("lost")

    monkeypatch.setattr(s.Store, "_publish", dies)
    for write in (store.compact, lambda: store.append(frame(spark, [("a", 9)]), 1), lambda: store.replace(frame(spark, [("z", 0)]))):
        with pytest.raises(RuntimeError):
            write()
        assert content(store) == {"a": 1, "b": 3, "c": 4}
    monkeypatch.setattr(s.Store, "_publish", publish)
    assert len(store.vacuum()) == 3 and content(store) == {"a": 1, "b": 3, "c": 4}
    store.replace(frame(spark, [("z", 0)]))
    assert content(store) == {"z": 0}
    assert {r["id"]: r["x"] for r in resolved.collect()} == {"a": 1, "b": 3, "c": 4}
    # two writers from one version: the second is told
    at = store.manifest()
    store._publish(at)
    with pytest.raises(s.Conflict):
        store._publish(at)
    assert content(store) == {"z": 0}


def test_upsert_leaves_untouched_buckets_alone(spark, tmp_path):
    store = s.Store(spark, str(tmp_path / "v"), "id", buckets=16)
    rows = spark.range(200).select(F.concat(F.lit("k"), "id").alias("id"), F.col("id").alias("x"), F.lit(1.0).alias("y"))
    store.upsert(rows)
    before = files_of(store)
    store.upsert(frame(spark, [("k7", None), ("new", 5)]), ["x"])
    after = files_of(store)
    assert 1 <= sum(before.get(b) != f for b, f in after.items()) <= 2 and len(after) >= 15
    got = {r["id"]: (r["x"], r["y"]) for r in store.read().collect()}
    assert len(got) == 201 and got["k7"] == (None, 1.0) and got["new"] == (5, None) and got["k8"] == (8, 1.0)


def test_empty_batches(spark, tmp_path):
    store = s.Store(spark, str(tmp_path / "v"), "id", buckets=4, max_deltas=2)
    for batch in range(4):
        store.append(frame(spark, []), batch)
    assert content(store) == {}
    store.append(frame(spark, [("a", 1)]), 9)
    assert content(store) == {"a": 1} and store.compact() and content(store) == {"a": 1}
