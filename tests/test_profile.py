import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from dataprism import profile, profile_summary
from dataprism.functions import envelope as E
from dataprism.sources.tables import table
from conftest import SF_SMALL, collect_dicts

T0 = dt.datetime(2024, 1, 3, 10, 0)


def _frame(spark, rows, schema="a bigint, b string"):
    return spark.createDataFrame(rows, schema).withColumn("ts", F.lit(T0).cast("timestamp_ntz"))


def test_profile_serialization_roundtrip(spark):
    """A 3-row frame: serialize -> deserialize keeps the profiled column keys."""
    df = _frame(spark, [(1, "a"), (2, "b"), (3, "c")])
    p = profile(df, "ts", serialize=True)
    dec = p.select(E.deserialize_profile(F.col("profile_view")).alias("p")).collect()[0].p
    assert sorted(dec["columns"].keys()) == ["a", "b", "ts"]
    assert dec["metadata"]["integration"] == "spark"
    assert dec["dataset_timestamp"] == 1704240000000


def test_segment_serialization(spark):
    """Segments on ``b`` of a 4-row frame give 3 profiles; the segment key survives the round trip."""
    df = _frame(spark, [(1, "a"), (2, "b"), (3, "c"), (3, "c")])
    p = profile(df, "ts", segments="b")
    rows = collect_dicts(p.select("segment", "segment_partition", "segment_rows", "rows_processed"), ["segment"])
    assert len(rows) == 3
    assert [json.loads(r["segment"])["b"] for r in rows] == ["a", "b", "c"]
    assert [r["segment_rows"] for r in rows] == [1, 1, 2]
    assert {r["rows_processed"] for r in rows} == {4}
    assert {r["segment_partition"] for r in rows} == {"b"}
    back = p.select(F.from_json("segment", "b string").getField("b").alias("b")).collect()
    assert sorted(r.b for r in back) == ["a", "b", "c"]


def test_output_columns(spark):
    df = _frame(spark, [(1, "a")])
    p = profile(df, "ts", partition_by=["b"], passthrough={"c": "string"}, serialize=True)
    assert p.columns == ["b", "c", "dataset_timestamp", "segment_partition", "segment", "rows_processed",
                         "segment_rows", "group_count", "debug_info", "profile_view"]
    r = p.collect()[0]
    assert r.c is None and r.segment is None and r.segment_partition is None


def test_null_timestamps_dropped_unsegmented(spark):
    df = spark.createDataFrame([(1, T0), (2, None), (3, T0)], "a bigint, ts timestamp_ntz")
    r = profile(df, "ts").collect()
    assert len(r) == 1 and r[0].rows_processed == 2


def test_all_null_timestamps_yield_nothing(spark):
    df = spark.createDataFrame([(1, None)], "a bigint, ts timestamp_ntz")
    assert profile(df, "ts").count() == 0


def test_null_timestamps_fail_segmented(spark):
    df = spark.createDataFrame([(1, "x", T0), (2, "y", None)], "a bigint, b string, ts timestamp_ntz")
    with pytest.raises(Exception, match="without an event time"):
        profile(df, "ts", segments="b").collect()


def test_epoch_ms_event_time(spark):
    df = spark.createDataFrame([(1, 1704240000123), (2, 1704326400000)], "a bigint, DATASET_TIMESTAMP bigint")
    p = profile(df, "DATASET_TIMESTAMP").orderBy("dataset_timestamp").collect()
    assert [r.dataset_timestamp for r in p] == [1704240000000, 1704326400000]
    # the control column is not profiled
    assert sorted(p[0].profile["columns"].keys()) == ["a"]


def test_control_columns_dropped(spark):
    df = _frame(spark, [(1, "a")]).withColumn("SEGMENT_COLUMNS", F.lit("b")).withColumn("group_by_frequency", F.lit("D"))
    cols = profile(df, "ts").collect()[0].profile["columns"]
    assert sorted(cols.keys()) == ["a", "b", "ts"]


def test_unknown_segment_column(spark):
    with pytest.raises(ValueError, match="not found"):
        profile(_frame(spark, [(1, "a")]), "ts", segments="nope")


def test_bad_frequency(spark):
    with pytest.raises(ValueError):
        profile(_frame(spark, [(1, "a")]), "ts", freq="B")


def test_segment_names_trimmed_and_case_insensitive(spark):
    df = _frame(spark, [(1, "a")])
    r = profile(df, "ts", segments=" A , ,B ").collect()[0]
    assert r.segment_partition == "a,b"
    assert json.loads(r.segment) == {"a": 1, "b": "a"}


def test_null_segment_value_is_a_segment(spark):
    df = _frame(spark, [(1, None), (2, "x"), (3, None)])
    rows = collect_dicts(profile(df, "ts", segments="b").select("segment", "segment_rows"), ["segment"])
    assert rows == [{"segment": '{"b":"x"}', "segment_rows": 1}, {"segment": '{"b":null}', "segment_rows": 2}]


def test_group_count_counts_empty_bins(spark):
    days = [dt.datetime(2024, 1, d, 12) for d in (1, 2, 10, 28)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(days)], "a bigint, ts timestamp_ntz")
    p = profile(df, "ts").collect()
    assert len(p) == 4
    assert {r.group_count for r in p} == {28}
    assert all(r.debug_info == "group_count: 28" for r in p)


def test_rows_processed_is_bucket_rows(spark):
    ev = table(spark, SF_SMALL, "events")
    p = profile(ev, "ts", segments="event_type", partition_by=[F.date_trunc("DAY", "ts").alias("day")])
    bad = p.groupBy("day", "dataset_timestamp").agg(F.sum("segment_rows").alias("s"), F.min("rows_processed").alias("a"),
                                                   F.max("rows_processed").alias("b")).filter("s != a or a != b")
    assert bad.count() == 0


def test_origin_depends_on_partition(spark):
    rows = [("k1", dt.datetime(2024, 1, 1, 5)), ("k1", dt.datetime(2024, 1, 6, 5)),
            ("k2", dt.datetime(2024, 1, 2, 5)), ("k2", dt.datetime(2024, 1, 7, 5))]
    df = spark.createDataFrame(rows, "k string, ts timestamp_ntz")
    p = collect_dicts(profile(df, "ts", freq="5D", partition_by=["k"]).select("k", "dataset_timestamp"),
                      ["k", "dataset_timestamp"])
    day = lambda d: int(dt.datetime(2024, 1, d, tzinfo=dt.timezone.utc).timestamp() * 1000)
    assert p == [{"k": "k1", "dataset_timestamp": day(1)}, {"k": "k1", "dataset_timestamp": day(6)},
                 {"k": "k2", "dataset_timestamp": day(2)}, {"k": "k2", "dataset_timestamp": day(7)}]


def test_numeric_edge_values(spark):
    vals = [1.0, None, float("nan"), float("inf"), float("-inf"), 3.0]
    df = spark.createDataFrame([(v, T0) for v in vals], "x double, ts timestamp_ntz")
    s = profile_summary(profile(df, "ts", columns=["x"])).collect()[0]
    assert (s["count"], s.null_count, s.nan_count, s.inf_count) == (6, 1, 1, 2)
    assert s["min"] == float("-inf") and s["max"] == float("inf")
    assert s.mean == 2.0
    assert s.n_fractional == 5


def test_all_null_column(spark):
    df = spark.createDataFrame([(None, T0), (None, T0)], "x string, ts timestamp_ntz")
    s = profile_summary(profile(df, "ts", columns=["x"])).collect()[0]
    assert (s["count"], s.null_count, s.min_str, s.mean_len, s.distinct_est) == (2, 2, None, None, 0.0)
    assert s.top_items == []


def test_types_profiled(spark):
    df = spark.sql(
        "SELECT 1 AS i, CAST(2.5 AS DECIMAL(10,2)) AS d, true AS b, 'xy' AS s, X'0102' AS bin, "
        "DATE'2024-01-01' AS day, array(1,2) AS arr, TIMESTAMP_NTZ'2024-01-03 10:00:00' AS ts")
    s = {r.column_name: r for r in profile_summary(profile(df, "ts")).collect()}
    assert s["i"].n_integral == 1 and s["i"]["max"] == 1.0
    assert s["d"].n_fractional == 1 and s["d"].mean == 2.5
    assert s["b"].n_boolean == 1 and s["b"].top_items[0]["item"] == "true"
    assert s["s"].n_string == 1 and s["s"].max_len == 2
    assert s["bin"].n_string == 1 and s["bin"].max_len == 2
    assert s["day"].n_temporal == 1 and s["day"].min_ts == dt.datetime(2024, 1, 1)
    assert s["arr"].n_other == 1 and s["arr"].distinct_est is None


def test_salted_equals_unsalted(spark):
    ev = table(spark, SF_SMALL, "events")
    keys = ["dataset_timestamp", "segment", "column_name"]
    cols = ["count", "null_count", "min", "max", "min_str", "max_str", "min_len", "max_len"]
    a = profile_summary(profile(ev, "ts", segments="event_type")).select(*keys, *cols, F.round("mean", 6).alias("m"),
                                                                       F.round("stddev", 6).alias("sd"))
    b = profile_summary(profile(ev, "ts", segments="event_type", salt=4)).select(
        *keys, *cols, F.round("mean", 6).alias("m"), F.round("stddev", 6).alias("sd"))
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_exact_distinct_with_salt(spark):
    df = spark.range(0, 400, 1, 8).select((F.col("id") % 3).cast("string").alias("k"), (F.col("id") % 11).alias("v"),
                                          F.lit(T0).cast("timestamp_ntz").alias("ts"))
    p = profile(df, "ts", segments="k", columns=["v", "k"], salt=4, exact=True)
    got = {(r.segment, r.column_name): r.distinct_exact for r in profile_summary(p).collect()}
    assert got == {(f'{{"k":"{i}"}}', c): n for i in range(3) for c, n in (("v", 11), ("k", 1))}
    plan = p._jdf.queryExecution().toString()
    assert "Expand" not in plan


def test_building_a_plan_starts_no_job(spark):
    """Over an aggregate, whose shuffle would run if the plan looked at partitions."""
    df = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).agg(F.count(F.lit(1)).alias("n")) \
        .withColumn("ts", F.lit(T0).cast("timestamp_ntz"))
    group = "no-jobs"
    spark.sparkContext.setJobGroup(group, "plan building")
    try:
        profile(df, "ts", freq="7h", partition_by=["k"], segments="n", exact=True, salt=3)
        profile(df, "ts", columns_per_pass=1)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert not list(spark.sparkContext.statusTracker().getJobIdsForGroup(group))


def test_wide_table_profiled_in_chunks(spark):
    """Several aggregations of a few columns each give the same profile."""
    df = spark.range(0, 300, 1, 4).select(
        *[(F.col("id") * (i + 1) % 17).alias(f"c{i}") for i in range(7)],
        (F.col("id") % 3).cast("string").alias("k"), F.lit(T0).cast("timestamp_ntz").alias("ts"))
    whole = profile(df, "ts", segments="k", partition_by=["c0"], serialize=True)
    chunked = profile(df, "ts", segments="k", partition_by=["c0"], serialize=True, columns_per_pass=3)
    assert chunked.columns == whole.columns

    def exact(p):
        dec = p.select("c0", "segment", "rows_processed", "segment_rows", "group_count",
                       E.deserialize_profile(F.col("profile_view")).alias("profile"))
        s = profile_summary(dec, keys=["c0", "segment", "rows_processed", "segment_rows", "group_count"],
                            sketches=False)
        return sorted(tuple(r) for r in s.collect())

    got = exact(chunked)
    assert got == exact(whole)
    assert {r[5] for r in got} == {"c0", "c1", "c2", "c3", "c4", "c5", "c6", "k", "ts"}
