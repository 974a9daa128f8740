import base64
import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from dataprism import profile
from dataprism.operators.publish import FileProfileWriter, RECEIPT_COLUMNS, publish, read_store
from dataprism.session import scratch_path
from dataprism.sources.profile_files import read_profiles
from conftest import collect_dicts

T0 = dt.datetime(2024, 1, 3, 10, 0)


def _profiles(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, "b")], "x bigint, s string")
    df = df.withColumn("ts", F.lit(T0).cast("timestamp_ntz"))
    return profile(df, "ts", segments="s", serialize=True)


def test_receipts_one_per_row_with_damaged_payloads(spark):
    p = _profiles(spark).select("profile_view", "segment_partition", "segment")
    good = p.collect()
    junk_json = base64.b64encode(b'{"hello": 1}').decode()
    rows = [(r.profile_view, r.segment_partition, r.segment) for r in good] + [
        (None, None, None),
        ("%%% not base64 %%%", None, None),
        (junk_json, None, None),
        (good[0].profile_view, "s", '{"t":"a"}'),  # segment does not match its partition
    ]
    src = spark.createDataFrame(rows, "profile_view string, segment_partition string, segment string")
    r = publish(src, scratch_path(spark, "store"), dataset_id="ds-1")
    assert r.columns == RECEIPT_COLUMNS
    got = collect_dicts(r, ["result", "segment", "error"])
    assert len(got) == 6
    ok = [g for g in got if g["result"] == "Ok"]
    assert sorted(g["segment"] for g in ok) == ['{"s":"a"}', '{"s":"b"}']
    assert all(g["error"] is None and g["dataset_timestamp"] == 1704240000000 for g in ok)
    bad = [g for g in got if g["result"] is None]
    assert len(bad) == 4
    assert all(g["segment"] == "Error" and g["dataset_timestamp"] == -1 for g in bad)
    assert any(g["error"].endswith("profile payload is missing") for g in bad)
    # The payload itself never appears in an error text.
    assert not any("not base64" in g["error"] for g in bad)


def test_store_holds_valid_profiles_partitioned(spark):
    path = scratch_path(spark, "store")
    r = publish(_profiles(spark), path, dataset_id="ds-2")
    assert {x.result for x in r.collect()} == {"Ok"}
    s = read_store(spark, path, dataset_id="ds-2", start_day="2024-01-03", end_day="2024-01-03")
    rows = s.collect()
    assert len(rows) == 2
    assert {row.day for row in rows} == {"2024-01-03"}
    assert sorted(rows[0].profile["columns"].keys()) == ["s", "ts", "x"]
    assert read_store(spark, path, dataset_id="other").count() == 0


def test_failed_store_write_gives_failure_receipts(spark, tmp_path):
    blocker = tmp_path / "not-a-dir"
    blocker.write_text("x")
    r = publish(_profiles(spark), str(blocker / "store"), dataset_id="ds-3").collect()
    assert len(r) == 2
    assert all(x.result is None and x.error.startswith("Error uploading: ") for x in r)
    assert all(x.dataset_timestamp == 1704240000000 for x in r)


def test_writer_mode_routes_and_reports_failures(spark):
    root = scratch_path(spark, "files")
    src = _profiles(spark).withColumn("ds", F.when(F.col("segment").contains('"a"'), F.lit("")).otherwise("good"))
    r = collect_dicts(publish(src, writer_factory=FileProfileWriter.factory(root), dataset_id="ds"), ["dataset_id"])
    assert [x["result"] for x in r] == [None, "Ok"]
    assert "invalid dataset id" in r[0]["error"]
    files = read_profiles(spark, root).collect()
    assert len(files) == 1 and files[0].valid
    assert json.loads(json.dumps(sorted(files[0].profile["columns"].keys()))) == ["s", "ts", "x"]


def test_exactly_one_target(spark):
    with pytest.raises(ValueError):
        publish(_profiles(spark), dataset_id="x")


def test_replace_days_makes_republish_idempotent(spark):
    path = scratch_path(spark, "store")
    p = _profiles(spark)
    publish(p, path, dataset_id="ds-4").collect()
    publish(p, path, dataset_id="ds-4").collect()
    assert read_store(spark, path, dataset_id="ds-4").count() == 4  # append: duplicated
    publish(p, path, dataset_id="ds-4", replace_days=True).collect()
    assert read_store(spark, path, dataset_id="ds-4").count() == 2
    publish(p, path, dataset_id="ds-5", replace_days=True).collect()
    assert read_store(spark, path).count() == 4  # other datasets untouched


def test_read_profiles_flags_junk(spark, tmp_path):
    good = _profiles(spark).select("profile_view").collect()[0].profile_view
    (tmp_path / "a.b64").write_text(good + "\n" + "not a profile\n\n")
    r = read_profiles(spark, str(tmp_path)).collect()
    assert sorted(x.valid for x in r) == [False, True]


def test_publish_accepts_profile_structs(spark):
    df = spark.createDataFrame([(1, "a")], "x bigint, s string").withColumn("ts", F.lit(T0).cast("timestamp_ntz"))
    r = publish(profile(df, "ts", segments="s"), scratch_path(spark, "store"), dataset_id="ds-6").collect()
    assert [(x.result, x.segment) for x in r] == [("Ok", '{"s":"a"}')]


def test_store_profiles_merge_to_whole(spark):
    """Profiles of two halves published separately, read back and merged, equal the profile of the whole."""
    from dataprism import merge_profiles, profile_summary
    from dataprism.sources.tables import table
    from conftest import SF_SMALL

    ev = table(spark, SF_SMALL, "events")
    path = scratch_path(spark, "store")
    for half in (F.col("event_id") % 2 == 0, F.col("event_id") % 2 == 1):
        publish(profile(ev.filter(half), "ts", segments="event_type", serialize=True), path, dataset_id="m").collect()
    merged = merge_profiles(read_store(spark, path, dataset_id="m"), ["dataset_timestamp", "segment"], rows_col=None)
    direct = profile(ev, "ts", segments="event_type")

    def exact(p):
        s = profile_summary(p, keys=["dataset_timestamp", "segment"], sketches=False)
        return sorted((r.dataset_timestamp, r.segment, r.column_name, r["count"], r.null_count, r["min"], r["max"],
                       None if r.mean is None else round(r.mean, 9), None if r.stddev is None else round(r.stddev, 9),
                       r.min_str, r.max_str, r.min_len, r.max_len, r.min_ts, r.max_ts) for r in s.collect())

    assert exact(merged) == exact(direct)
