"""Exact distinct states, reproducible histograms, long payloads and one-pass facts."""

import datetime as dt
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from dataprism import merge_profiles, profile, profile_payload
from dataprism.operators import distinct, histogram
from dataprism.operators.payload import make_payload, payload_stats
from dataprism.session import scratch_path

T0 = dt.datetime(2024, 1, 3)
KEYS = ["dataset_timestamp", "segment"]


def _rows(n=600, seed=2):
    r = random.Random(seed)
    out = []
    for i in range(n):
        out.append((i, r.choice([None, r.randrange(-40_000, 40_000)]), r.choice([0.0, -0.0, 1.5, None, r.random()]),
                    r.choice(["a", "b", None, f"s{r.randrange(500)}"]), r.choice([True, False, None]),
                    T0 + dt.timedelta(days=r.randrange(3)), r.choice(["x", "y", None]), 2**62 - r.randrange(3)))
    return out


@pytest.fixture(scope="module")
def data(spark):
    rows = _rows()
    df = spark.createDataFrame(rows, "id bigint, i int, f double, s string, b boolean, t timestamp_ntz, g string, "
                                     "big bigint").coalesce(2).cache()
    return rows, df


def _expected(rows):
    out = {}
    for i, v, f, s, b, t, g, big in rows:
        key = (t, g)
        for name, x in (("id", i), ("i", v), ("f", f), ("s", s), ("b", b), ("big", big)):
            if x is not None:
                out.setdefault((key, name), set()).add(x)
    return {k: len(v) for k, v in out.items()}


def _got(counts):
    return {((T0 + dt.timedelta(milliseconds=r.dataset_timestamp - 1704240000000),
              None if r.segment == '{"g":null}' else r.segment[6:-2]), r.column): r.exact_distinct
            for r in counts.collect()}


COLUMNS = ["id", "i", "f", "s", "b", "big"]


def test_exact_distinct_merges(data):
    rows, df = data
    how = {"segments": "g", "columns": COLUMNS}
    expected = _expected(rows)
    state = distinct.distinct_state(df, "t", **how)
    assert _got(distinct.distinct_counts(state, KEYS)) == expected
    parts = distinct.distinct_state(df, "t", partition_by=[(F.col("id") % 5).alias("cut")], **how)
    merged = distinct.merge_distinct(parts, KEYS).cache()
    assert _got(distinct.distinct_counts(merged, KEYS)) == expected
    # A merged state merges again, with overlapping states too.
    again = distinct.merge_distinct(merged.unionByName(state.select(merged.columns)), KEYS)
    assert _got(distinct.distinct_counts(again, KEYS)) == expected


def test_dense_and_sparse_parts(spark):
    """Integers that lie together are bitmaps, others lists; a part that is both merges to a bitmap."""
    df = spark.range(0, 70_000).select("id", F.lit(T0).cast("timestamp_ntz").alias("t"),
                                       (F.col("id") % 3).alias("cut")).filter("cut < 2 OR id < 900")
    parts = distinct.distinct_state(df, "t", columns=["id"], partition_by=["cut"]).cache()
    assert parts.filter("bits IS NOT NULL").count() and parts.filter("run IS NOT NULL").count()
    assert parts.filter("(bits IS NULL) = (run IS NULL)").count() == 0
    merged = distinct.merge_distinct(parts)
    assert distinct.distinct_counts(merged).first().exact_distinct == df.count()
    assert merged.filter("bits IS NOT NULL").count() >= 2
    negative = spark.range(-70_000, 0).select(F.col("id"), F.lit(T0).cast("timestamp_ntz").alias("t"))
    assert distinct.distinct_counts(distinct.distinct_state(negative, "t", columns=["id"])).first()[-1] == 70_000


def test_counts_in_profiles(data):
    rows, df = data
    how = {"segments": "g", "columns": [*COLUMNS, "t"]}
    p = profile(df, "t", exact=True, **how).select(*KEYS, "profile")
    plain = merge_profiles(profile(df, "t", partition_by=[(F.col("id") % 3).alias("cut")], **how), KEYS)
    assert plain.select(F.col("profile")["columns"]["i"]["exact_distinct"]).distinct().collect() == [(None,)]
    put = distinct.with_exact_distinct(plain, distinct.distinct_counts(distinct.distinct_state(df, "t", **how), KEYS),
                                       KEYS)

    def shown(x):
        return sorted((r.dataset_timestamp, r.segment, n, c["exact_distinct"]) for r in x.collect()
                      for n, c in r.profile["columns"].items())

    assert shown(put) == shown(p)


def test_state_of_nothing_and_clashing_names(spark, data):
    _, df = data
    none = df.filter("id < 0")
    assert distinct.distinct_state(none, "t").count() == 0
    assert distinct.merge_distinct(distinct.distinct_state(none, "t")).count() == 0
    assert distinct.distinct_state(df.select("t", F.array("i").alias("x")), "t", columns=["x"]).count() == 0
    assert histogram.quantile_state(none, "t").count() == 0
    assert histogram.quantile_state(df, "t", columns=["s"]).count() == 0
    for f in (distinct.distinct_state, histogram.quantile_state):
        with pytest.raises(ValueError, match="give it another name"):
            f(df.withColumn("n", F.lit(1)), "t", partition_by=["n"])
    with pytest.raises(ValueError, match="accuracy"):
        histogram.quantile_state(df, "t", accuracy=1.5)


# --- histograms -----------------------------------------------------------------------------------------------------

def _numbers(spark):
    r = random.Random(5)
    values = [r.lognormvariate(0, 4) for _ in range(2000)] + [-r.lognormvariate(2, 3) for _ in range(1500)] \
        + [0.0, -0.0, 0.0, 1e300, -1e300, 1e-300]
    rows = [(i, x, i % 7) for i, x in enumerate(values)]
    odd = [(-1, float("nan"), 1), (-2, float("inf"), 1), (-3, float("-inf"), 2), (-4, None, 3)]
    df = spark.createDataFrame(rows + odd, "id bigint, x double, cut int").withColumn(
        "t", F.lit(T0).cast("timestamp_ntz"))
    return np.array(values), df


def test_histogram_is_the_same_for_every_cut(spark):
    values, df = _numbers(spark)
    state = histogram.quantile_state(df, "t", columns=["x"])
    first = state.collect()
    assert first == histogram.quantile_state(df.repartition(9), "t", columns=["x"]).collect()
    assert first[0].n == len(values) == sum(b.n for b in first[0].buckets)
    for cut in ("cut", F.spark_partition_id().alias("p")):
        parts = histogram.quantile_state(df.repartition(5), "t", columns=["x"], partition_by=[cut])
        merged = histogram.merge_quantiles(parts).collect()[0]
        assert (merged.n, merged.buckets) == (first[0].n, first[0].buckets)


@pytest.mark.parametrize("accuracy", [0.005, 0.05])
def test_quantiles_are_near(spark, accuracy):
    values, df = _numbers(spark)
    levels = [0, 0.001, 0.01, 0.25, 0.4, 0.5, 0.75, 0.95, 0.999, 1]
    state = histogram.quantile_state(df, "t", columns=["x"], accuracy=accuracy)
    got = histogram.quantiles(state, levels).first().quantiles
    ordered = np.sort(values)
    for q, x in zip(levels, got):
        at = q * (len(ordered) - 1)
        lo, hi = ordered[math.floor(at)], ordered[math.ceil(at)]
        exact = lo + (hi - lo) * (at - math.floor(at))
        assert abs(x - exact) <= accuracy * 1.0001 * max(abs(lo), abs(hi))
    with pytest.raises(ValueError, match="levels"):
        histogram.quantiles(state, [2])


# --- payloads and facts ---------------------------------------------------------------------------------------------

def test_map_and_variant_are_equal_in_long_form(spark):
    r = random.Random(3)
    rows = [(i, {"DATASET_TIMESTAMP": 1704276000000.0 + i, **{f"k{r.randrange(300)}": r.random() for _ in range(4)}})
            for i in range(200)]
    df = spark.createDataFrame(rows, "i int, data map<string,double>")
    same = df.select("i", F.to_variant_object("data").alias("data"))

    def shown(x):
        return sorted((r.column, r.segment_rows, r.stats["count"], r.stats["null_count"], r.stats["num_min"],
                       r.stats["num_max"], r.stats["num_n"], round(r.stats["num_mean"], 12)) for r in x.collect())

    expected = shown(payload_stats(df))
    assert len(expected) > 250
    assert shown(payload_stats(same)) == expected
    assert shown(payload_stats(df, salt=4, min_partitions=5)) == expected
    plan = payload_stats(same)._jdf.queryExecution().toString()
    assert "schema_of_variant_agg" not in plan
    assert [r[2:] for r in shown(payload_stats(df, columns=["K7"]))] == [e[2:] for e in expected if e[0] == "k7"]
    whole = profile_payload(same, long=True).first().profile["columns"]
    assert {k: c["num_max"] for k, c in whole.items()} == {e[0]: e[5] for e in expected}
    with pytest.raises(TypeError, match="variant or map"):
        payload_stats(df.select(F.struct("i").alias("data")))


def test_variants_that_are_no_objects_have_no_keys(spark):
    df = spark.sql("SELECT parse_json(j) AS data FROM VALUES ('{\"DATASET_TIMESTAMP\": 1704276000000, \"x\": 1}'), "
                   "('[1]'), ('3'), ('null'), (NULL) AS t(j)")
    assert [(r.column, r.segment_rows) for r in payload_stats(df).collect()] == [("x", 1)]


def test_map_segments_by_each_rows_spelling(spark):
    at = "1704276000000"
    df = spark.createDataFrame([({"DATASET_TIMESTAMP": at, "SEGMENT_COLUMNS": "state", k: v},) for k, v in
                                [("State", "CA"), ("state", "CA"), ("state", "TX"), ("STATE", "CA")]],
                               "data map<string,string>")
    got = {r.segment: r.segment_rows for r in profile_payload(df, "data").collect()}
    assert got == {'{"STATE":"CA"}': 3, '{"STATE":"TX"}': 1}


def test_map_payload_takes_the_profile_arguments(spark):
    rows = [({"DATASET_TIMESTAMP": 1704276000000.0, "x": float(i % 4), "y": float(i)},) for i in range(40)]
    df = spark.createDataFrame(rows, "data map<string,double>")
    for how in ({}, {"salt": 3}, {"min_partitions": 3}, {"columns_per_pass": 1}):
        c = profile_payload(df, "data", exact=True, **how).first().profile["columns"]
        assert {n: (s["count"], s["exact_distinct"], s["num_max"]) for n, s in c.items()} == {
            "x": (40, 4, 3.0), "y": (40, 40, 39.0)}
    with pytest.raises(ValueError, match="salt"):
        profile_payload(df, "data", salt=0)


def _scans(df, word):
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    return plan.count(word)


def test_one_pass_reads_the_rows_once(spark):
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    path = scratch_path(spark, "json")
    ev.write.json(path)
    text = spark.read.schema(ev.schema).json(path)
    day = F.to_date("ts").alias("day")
    how = {"segments": "event_type", "partition_by": [day]}
    payload = ev.select(F.to_date("ts").alias("day"), make_payload(
        ev, dataset_timestamp=F.unix_millis(F.col("ts").cast("timestamp")), segment_columns="event_type").alias("data"))
    for made, word in ((lambda one: profile(text, "ts", one_pass=one, **how), "FileScan json"),
                       (lambda one: profile_payload(payload, "data", partition_by=["day"], one_pass=one),
                        "FileScan parquet")):
        assert _scans(made(True), word) == 1 and _scans(made(False), word) == 2
        facts = ["day", "dataset_timestamp", "segment", "rows_processed", "segment_rows", "group_count"]
        assert sorted(made(True).select(facts).collect()) == sorted(made(False).select(facts).collect())
    salted = profile(text, "ts", one_pass=True, salt=3, columns=[], **how)
    assert sorted(salted.select("rows_processed").collect()) == sorted(
        profile(text, "ts", columns=[], **how).select("rows_processed").collect())
