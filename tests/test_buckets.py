"""State in hash buckets: only touched buckets are rewritten, racing writers conflict, versions stay readable."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from gleaner.sources import buckets, state
from gleaner.streaming import incremental

SCHEMA = "k string, n long"


def add(old, new):
    return old.unionByName(new).groupBy("k").agg(F.sum("n").alias("n"))


def rows(spark, counts):
    return spark.createDataFrame(list(counts.items()), SCHEMA)


def test_a_merge_rewrites_only_its_buckets(spark, tmp_path):
    root, rng, held = f"file://{tmp_path}/s", random.Random(1), {}
    assert buckets.current(spark, root) == buckets.Version()
    before = None
    for step in range(4):
        new = {f"k{rng.randrange(400)}": 1 for _ in range(300 if step == 0 else 3)}
        for k in new:
            held[k] = held.get(k, 0) + 1
        version = buckets.merge_into(spark, root, "t", rows(spark, new), ["k"], add, 32)
        assert dict(map(tuple, buckets.load(spark, root, version, "t", SCHEMA).collect())) == held
        if before:
            changed = [b for b, f in version.tables["t"]["buckets"].items() if before.tables["t"]["buckets"].get(b) != f]
            assert 1 <= len(changed) <= 3
            assert buckets.load(spark, root, before, "t", SCHEMA).agg(F.sum("n")).first()[0] == sum(held.values()) - len(new)
        before = version
    assert buckets.current(spark, root) == version and version.seq == 4
    same = buckets.merge_into(spark, root, "t", rows(spark, {"k0": 1}).limit(0), ["k"], add, 32)
    assert same.tables == version.tables
    gone = buckets.merge_into(spark, root, "t", rows(spark, dict.fromkeys(held, 0)), ["k"], lambda old, new: old.where("false"))
    assert gone.tables["t"]["buckets"] == {} and buckets.load(spark, root, gone, "t", SCHEMA).count() == 0


def test_one_of_two_writers_loses(spark, tmp_path):
    root = f"file://{tmp_path}/s"
    buckets.merge_into(spark, root, "t", rows(spark, {"a": 1, "b": 1}), ["k"], add, 8)
    seen = buckets.current(spark, root)
    mine, theirs = (buckets.staged(spark, root, seen, "t", rows(spark, {k: 1}), ["k"], add) for k in "ab")
    buckets.commit(spark, root, seen, {"t": theirs})
    with pytest.raises(buckets.Conflict):
        buckets.commit(spark, root, seen, {"t": mine})
    assert dict(map(tuple, buckets.load(spark, root, buckets.current(spark, root), "t", SCHEMA).collect())) == {"a": 1, "b": 2}
    assert not list((tmp_path / "s/manifests").glob("*.draft"))
    raced = []

    def slow(old, new):
        if not raced:  # another writer is first, once
            raced.append(1)
            buckets.merge_into(spark, root, "t", rows(spark, {"c": 5}), ["k"], add)
        return add(old, new)

    buckets.merge_into(spark, root, "t", rows(spark, {"a": 1, "c": 1}), ["k"], slow)
    assert dict(map(tuple, buckets.load(spark, root, buckets.current(spark, root), "t", SCHEMA).collect())) == {"a": 2, "b": 2, "c": 6}
    with pytest.raises(ValueError, match="kept by"):
        buckets.merge_into(spark, root, "t", rows(spark, {"a": 1}), ["n"], add)
    with pytest.raises(ValueError, match="schema version"):
        buckets.commit(spark, root, seen, {}, 3)


def test_a_stream_into_buckets(spark, tmp_path):
    schema = "event_id string, fingerprint string, published_at timestamp, verification string"
    root, day, source = f"file://{tmp_path}/s", dt.datetime(2026, 7, 1), f"{tmp_path}/in"
    spark.createDataFrame([("a", "f1", day, "verified"), ("b", "f1", day, "verified"), ("c", "f2", day, "verified")], schema).write.parquet(source)
    for run in (1, 2):  # the same input twice leaves the same state
        incremental.keep_bucketed(spark.readStream.schema(schema).parquet(source), root, f"{tmp_path}/c{run}").awaitTermination()
        got = buckets.load(spark, root, buckets.current(spark, root), "events", schema)
        assert sorted(r.event_id for r in got.collect()) == ["a", "c"]
    assert state.VERSIONS[-1] == 2
