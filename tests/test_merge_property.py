import datetime as dt
import math

from hypothesis import HealthCheck, Phase, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from dataprism import merge_profiles, profile, profile_summary

T0 = dt.datetime(2024, 1, 3, 10, 0)

values = st.one_of(st.none(), st.floats(allow_nan=True, allow_infinity=True, width=32),
                   st.floats(min_value=-1e6, max_value=1e6))
rows = st.lists(st.tuples(st.sampled_from(["a", "b", None]), values, st.one_of(st.none(), st.text(max_size=4)),
                          st.integers(0, 1)), min_size=1, max_size=40)


def _norm(x):
    if isinstance(x, float):
        # 12 significant digits: merged moments differ from direct ones only in the last bits (Chan vs one pass).
        return "nan" if math.isnan(x) else float(f"{x:.12g}")
    return x


def _exact(p, keys):
    s = profile_summary(p, keys=keys, sketches=False)
    return sorted(tuple(_norm(r[c]) for c in [*keys, "column_name", "count", "null_count", "nan_count", "inf_count",
                                               "min", "max", "mean", "stddev", "min_str", "max_str", "min_len",
                                               "max_len"]) for r in s.collect())


@settings(max_examples=6, deadline=None, phases=[Phase.generate],
          suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(data=rows)
def test_merge_of_parts_equals_profile_of_whole(spark, data):
    df = spark.createDataFrame(data, "k string, v double, s string, part int").withColumn(
        "ts", F.lit(T0).cast("timestamp_ntz"))
    whole = profile(df, "ts", segments="k", columns=["v", "s"])
    parts = profile(df, "ts", segments="k", partition_by=["part"], columns=["v", "s"])
    merged = merge_profiles(parts, ["dataset_timestamp", "segment"])
    a, b = _exact(merged, ["dataset_timestamp", "segment"]), _exact(whole, ["dataset_timestamp", "segment"])
    assert a == b, repr([(x[5:], y[5:]) for x, y in zip(a, b) if x != y][:1])
    got = {r.segment: r.segment_rows for r in merged.collect()}
    assert got == {r.segment: r.segment_rows for r in whole.collect()}
