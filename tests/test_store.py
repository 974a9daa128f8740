"""Versioned store and committing sink: failures leave the old version, readers see whole commits."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from dataprism import profile
from dataprism.operators import store as store_module
from dataprism.operators.publish import publish, read_store
from dataprism.operators.store import ProfileStore
from dataprism.session import scratch_path
from dataprism.sources import sink
from dataprism.sources.manifest import CommitConflict, Manifest
from conftest import collect_dicts


def _profiles(spark, days, offset=0):
    rows = [(i + offset, dt.datetime(2024, 1 + d // 40, 1 + d % 28, 5)) for d in days for i in range(3)]
    df = spark.createDataFrame(rows, "x bigint, t timestamp_ntz")
    return profile(df, "t", columns=["x"], serialize=True)


def _shown(df):
    return sorted((r.day, r.profile["columns"]["x"]["int_max"]) for r in df.collect())


def test_replace_days_is_one_commit(spark):
    path = scratch_path(spark, "store")
    assert all(r.result == "Ok" for r in publish(_profiles(spark, [1, 2, 50]), path, dataset_id="a", versioned=True)
               .collect())
    before = _shown(read_store(spark, path))
    assert len(before) == 3
    publish(_profiles(spark, [2], 100), path, dataset_id="a", replace_days=True)
    after = _shown(read_store(spark, path))
    assert [d for d, _ in after] == [d for d, _ in before] and [x for _, x in after] == [2, 102, 2]
    store = ProfileStore(spark, path)
    assert store.version() == 2 and _shown(store.read(1)) == before
    # Other datasets and months keep their files.
    publish(_profiles(spark, [1], 7), path, dataset_id="b", replace_days=True)
    assert _shown(read_store(spark, path, dataset_id="a")) == after
    assert _shown(read_store(spark, path, dataset_id="b")) == [("2024-01-02", 9)]
    assert [d for d, _ in _shown(read_store(spark, path, dataset_id="a", start_day="2024-02-01"))] == ["2024-02-23"]
    assert store.vacuum() > 0 and _shown(store.read(dataset_id="a")) == after
    with pytest.raises(ValueError, match="no version 1"):
        store.read(1)


def test_failure_between_write_and_commit_leaves_the_old_store(spark, monkeypatch):
    path = scratch_path(spark, "store")
    publish(_profiles(spark, [1, 2]), path, dataset_id="a", versioned=True)
    before = _shown(read_store(spark, path))

    def broken(self, base, files):
        raise OSError("the disk is gone")

    with monkeypatch.context() as m:
        m.setattr(store_module.Manifest, "commit", broken)
        r = publish(_profiles(spark, [1, 2], 50), path, dataset_id="a", replace_days=True).collect()
    assert {x.result for x in r} == {None} and "the disk is gone" in r[0].error
    assert _shown(read_store(spark, path)) == before
    assert ProfileStore(spark, path).vacuum() > 0
    assert _shown(read_store(spark, path)) == before


def test_second_writer_goes_on_from_the_first(spark, monkeypatch):
    path = scratch_path(spark, "store")
    publish(_profiles(spark, [1, 2]), path, dataset_id="a", versioned=True)
    plain, calls = Manifest.commit, []

    def late(self, base, files):
        if not calls:  # another writer commits between this one's read and its commit
            calls.append(1)
            publish(_profiles(spark, [3], 10), path, dataset_id="a")
        return plain(self, base, files)

    with monkeypatch.context() as m:
        m.setattr(store_module.Manifest, "commit", late)
        publish(_profiles(spark, [1], 50), path, dataset_id="a", replace_days=True)
    assert _shown(read_store(spark, path)) == [("2024-01-02", 52), ("2024-01-03", 2), ("2024-01-04", 12)]


def test_commits_conflict(tmp_path):
    m = Manifest(str(tmp_path))
    base = m.read()
    assert base.number == 0 and not m.exists()
    m.commit(base, [{"path": "data/a"}])
    with pytest.raises(CommitConflict):
        m.commit(base, [{"path": "data/b"}])
    assert [f["path"] for f in m.read().files] == ["data/a"]


def test_plain_store_is_not_taken_over(spark):
    path = scratch_path(spark, "store")
    publish(_profiles(spark, [1]), path, dataset_id="a")
    r = publish(_profiles(spark, [2]), path, dataset_id="a", versioned=True).collect()
    assert r[0].result is None and "no version lists" in r[0].error
    assert len(_shown(read_store(spark, path))) == 1


def test_delivery_is_one_commit(spark):
    path = scratch_path(spark, "sink")
    p = _profiles(spark, range(1, 20)).select("profile_view", "segment", "segment_partition")
    bad = spark.createDataFrame([("junk", None, None)], p.schema)
    r = collect_dicts(sink.deliver(p.unionByName(bad).repartition(5), path, dataset_id="a"))
    assert sorted(str(x["result"]) for x in r) == ["None"] + ["Ok"] * 19
    got = sink.read_delivered(spark, path)
    assert got.count() == 19
    ok = sorted(x["dataset_timestamp"] for x in r if x["result"] == "Ok")
    assert sorted(x.dataset_timestamp for x in got.collect()) == ok
    files = Manifest(path).read().files
    assert len(files) <= 5 and sum(f["profiles"] for f in files) == 19  # many profiles a file
    sink.deliver(p.limit(2), path, dataset_id="b")
    assert sink.read_delivered(spark, path).count() == 21 and sink.read_delivered(spark, path, 1).count() == 19
    sink.deliver(p.limit(3), path, dataset_id="b", overwrite=True)
    assert sink.read_delivered(spark, path).count() == 3
    assert sink.read_delivered(spark, scratch_path(spark, "none")).count() == 0


def test_file_size_is_bounded(spark):
    path = scratch_path(spark, "sink")
    sink.deliver(_profiles(spark, range(1, 20)).repartition(1), path, dataset_id="a", file_bytes=1)
    assert sink.read_delivered(spark, path).count() == 19


def test_failed_task_leaves_no_profile(spark):
    """A task that fails after it has written: the other tasks' files are not published, nor are its own."""
    path = scratch_path(spark, "sink")
    sink.register(spark)
    rows = spark.range(0, 40, 1, 4).select(
        F.lit("a").alias("dataset_id"), F.col("id").alias("dataset_timestamp"),
        F.lit(None).cast("string").alias("segment_partition"), F.lit(None).cast("string").alias("segment"),
        F.when(F.col("id") == 39, F.raise_error(F.lit("lost"))).otherwise(F.col("id").cast("string"))
        .alias("profile_view"))
    with pytest.raises(Exception, match="lost"):
        rows.write.format(sink.SINK).option("path", path).mode("append").save()
    assert sink.read_delivered(spark, path).count() == 0
    rows.filter("id < 39").write.format(sink.SINK).option("path", path).mode("append").save()
    assert sink.read_delivered(spark, path).count() == 39


def test_delivery_needs_its_columns(spark):
    sink.register(spark)
    with pytest.raises(Exception, match="a delivery has the columns"):
        spark.range(3).write.format(sink.SINK).option("path", scratch_path(spark, "sink")).mode("append").save()
