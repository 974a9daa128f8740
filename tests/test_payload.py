
import pytest
from pyspark.sql import functions as F

from dataprism.operators.payload import make_payload, payload_schema, payload_stats, profile_payload
from conftest import collect_dicts

MS = 1704276000000  # 2024-01-03 10:00 UTC


def _events(spark):
    return spark.createDataFrame(
        [("TX", 1, MS, "a"), ("TX", 2, MS, "b"), ("CA", 3, MS + 86_400_000, "b")],
        "state string, x bigint, t bigint, s string",
    )


def test_variant_payload_keys_and_segments(spark):
    df = _events(spark)
    src = df.select("state", make_payload(df.drop("t"), dataset_timestamp=F.col("t"), segment_columns="s")
                    .alias("data"))
    assert [f.name for f in payload_schema(src, "data").fields] == ["DATASET_TIMESTAMP", "SEGMENT_COLUMNS", "s",
                                                                   "state", "x"]
    p = profile_payload(src, "data", partition_by=["state"])
    rows = collect_dicts(p.select("state", "dataset_timestamp", "segment", "rows_processed", "segment_rows"),
                         ["state", "segment"])
    assert [(r["state"], r["segment"], r["rows_processed"], r["segment_rows"]) for r in rows] == [
        ("CA", '{"s":"b"}', 1, 1), ("TX", '{"s":"a"}', 2, 1), ("TX", '{"s":"b"}', 2, 1)]
    # The partition key of the same name as a payload key is a key; the payload's own value is profiled.
    assert sorted(p.first().profile["columns"].keys()) == ["s", "state", "x"]


def test_map_payload(spark):
    df = _events(spark)
    src = df.select("state", F.create_map(F.lit("DATASET_TIMESTAMP"), F.col("t"), F.lit("x"), F.col("x"))
                    .alias("data"))
    p = profile_payload(src, "data", partition_by=["state"]).collect()
    assert len(p) == 2
    assert sorted(p[0].profile["columns"].keys()) == ["x"]


def test_config_must_agree_within_partition(spark):
    df = _events(spark)
    src = df.select("state", make_payload(df, dataset_timestamp=F.col("t"), freq=F.col("s")).alias("data"))
    with pytest.raises(ValueError, match="same in all rows of a partition"):
        profile_payload(src, "data", partition_by=["state"])


def test_missing_event_time_key(spark):
    df = _events(spark)
    with pytest.raises(ValueError, match="DATASET_TIMESTAMP"):
        profile_payload(df.select("state", make_payload(df).alias("data")), "data", partition_by=["state"])


def test_map_payload_counts_absent_keys_as_nulls(spark):
    df = spark.createDataFrame([("a", {"DATASET_TIMESTAMP": float(MS), "x": 1.0}),
                                ("a", {"DATASET_TIMESTAMP": float(MS), "y": 2.0}),
                                ("b", {"DATASET_TIMESTAMP": float(MS)})], "k string, data map<string,double>")
    p = {r.k: r.profile["columns"] for r in profile_payload(df, "data", partition_by=["k"]).collect()}
    assert {n: (c["count"], c["null_count"], c["num_max"]) for n, c in p["a"].items()} == {"x": (2, 1, 1.0),
                                                                                        "y": (2, 1, 2.0)}
    assert p["b"] == {}


def test_map_control_keys_match_in_any_case(spark):
    ts = str(MS)
    df = spark.createDataFrame([
        ("a", {"dataset_timestamp": ts, "segment_columns": "s", "group_by_frequency": "h", "s": "p", "x": "1"}),
        ("a", {"Dataset_Timestamp": ts, "Segment_Columns": "s", "GROUP_BY_FREQUENCY": "h", "s": "q", "x": "2"}),
        ("b", {"DATASET_TIMESTAMP": ts, "dataset_timestamp": "0", "x": "3"})], "k string, data map<string,string>")
    p = profile_payload(df, "data", partition_by=["k"]).collect()
    assert sorted((r.k, r.dataset_timestamp, r.segment or "", sorted(r.profile["columns"])) for r in p) == [
        ("a", MS, '{"s":"p"}', ["s", "x"]), ("a", MS, '{"s":"q"}', ["s", "x"]), ("b", MS - 10 * 3_600_000, "", ["x"])]


def test_map_without_event_time_key(spark):
    df = spark.createDataFrame([("a", {"x": 1.0}), ("b", None)], "k string, data map<string,double>")
    with pytest.raises(ValueError, match="DATASET_TIMESTAMP"):
        profile_payload(df, "data", partition_by=["k"])


def test_map_columns(spark):
    df = spark.createDataFrame([({"DATASET_TIMESTAMP": float(MS), "x": 1.0, "y": 2.0},)], "data map<string,double>")
    assert [sorted(profile_payload(df, "data", columns=c).first().profile["columns"]) for c in (["X"], [], None)] \
        == [["x"], [], ["x", "y"]]


def test_value_that_does_not_cast_is_not_a_null(spark):
    from pyspark.sql import types as T

    df = spark.sql(f"""SELECT parse_json(j) AS data FROM VALUES ('{{"DATASET_TIMESTAMP": {MS}, "v": 1}}'),
                       ('{{"DATASET_TIMESTAMP": {MS}, "v": "x"}}'), ('{{"DATASET_TIMESTAMP": {MS}, "v": null}}'),
                       ('{{"DATASET_TIMESTAMP": {MS}}}') AS t(j)""")
    schema = T.StructType([T.StructField("DATASET_TIMESTAMP", T.LongType()), T.StructField("v", T.LongType())])
    c = profile_payload(df, "data", schema=schema).first().profile["columns"]["v"]
    assert (c["count"], c["null_count"], c["n_integral"], c["n_other"]) == (4, 2, 1, 1)


def test_many_configurations_are_one_plan(spark):
    """Hundreds of segment lists, one plan; each partition is segmented by its own list."""
    n = 300
    df = spark.range(n).select(
        F.col("id").alias("k"),
        F.struct(F.lit(MS).alias("DATASET_TIMESTAMP"), (F.col("id") % 2).alias("a"), (F.col("id") % 5).alias("b"),
                 F.when(F.col("id") % 3 == 0, F.concat(F.lit(" a ,"), F.repeat(F.lit(" "), F.col("id").cast("int"))))
                 .when(F.col("id") % 3 == 1, F.lit("B,a")).alias("SEGMENT_COLUMNS"),
                 F.concat((F.col("id") + 1).cast("string"), F.lit("min")).alias("GROUP_BY_FREQUENCY")).alias("data"))
    p = profile_payload(df, "data", partition_by=["k"], columns=["a"], sketches=False)
    got = {r.k: (r.segment_partition, r.segment) for r in p.collect()}
    assert got == {i: [("a", f'{{"a":{i % 2}}}'), ("b,a", f'{{"b":{i % 5},"a":{i % 2}}}'), (None, None)][i % 3]
                   for i in range(n)}


def test_payload_rows_and_types_are_made_once(spark):
    """No filter below the payload makes each row a second time, and no statistic asks a value's type by itself."""
    df = spark.createDataFrame([(1, 2.5), (2, None)], "a int, b double")
    data = make_payload(df, dataset_timestamp=F.when(F.col("a") > 0, F.lit(0)))
    out = payload_stats(df.select(data.alias("data")), "data", sketches=False)
    plan = out._jdf.queryExecution().optimizedPlan().toString().split("\n")
    assert not [x for x in plan if "Filter" in x and "to_variant_object" in x]
    assert not [x for x in plan if "Aggregate" in x and "schemaOfVariant" in x]
    got = {r.column: (r.segment_rows, r.stats.null_count, r.stats.num_n, r.stats.num_max) for r in out.collect()}
    assert got == {"a": (2, 0, 2, 2.0), "b": (2, 1, 1, 2.5)}
