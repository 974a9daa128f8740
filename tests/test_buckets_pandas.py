"""Bucket labels and row counts against pandas' time grouper, which defines the frequency semantics."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from dataprism import profile
from dataprism.functions import buckets as B

FREQS = ["D", "h", "15min", "6h", "W", "W-MON", "W-WED", "ME", "MS", "QE", "QS", "YE", "YS", "5D", "7h", "36h",
         "B", "2SME", "SMS", "2W", "QE-JAN"]
CALENDAR = ["B", "3B", "10B", "SME", "2SME", "SMS", "3SMS", "W", "W-WED", "2W", "3W-WED", "5W-SAT", "ME", "2ME", "5ME",
            "MS", "2MS", "7MS", "QE", "QE-JAN", "QE-FEB", "2QE", "2QE-NOV", "QS", "QS-FEB", "QS-DEC", "3QS-MAR", "YE",
            "YE-JUN", "2YE", "2YE-JAN", "YS", "YS-APR", "2YS-JUL"]
STARTS = ["2022-11-03T05:17:00", "2023-01-31T00:00:00", "2023-06-30T23:59:59.999999", "2024-02-10T12:00:00",
          "2023-04-15T00:00:00"]


def _times(spark, first):
    rng = np.random.default_rng(7)
    start = np.datetime64(first, "us")
    offsets = np.append(rng.integers(0, 3 * 365 * 86_400_000_000, size=400), 0)
    ts = pd.to_datetime(np.sort(start + offsets.astype("timedelta64[us]")))
    df = spark.createDataFrame(pd.DataFrame({"t": ts.strftime("%Y-%m-%d %H:%M:%S.%f")})).select(
        F.col("t").cast("timestamp_ntz").alias("ts"))
    return ts, df


def _expected(ts, freq):
    grouped = pd.Series(1, index=ts).groupby(pd.Grouper(freq=freq))
    return {int(label.value // 1_000_000): int(n) for label, n in grouped.sum().items() if n > 0}, grouped.ngroups


@pytest.fixture(scope="module")
def sample(spark):
    return _times(spark, STARTS[0])


@pytest.mark.parametrize("freq", FREQS)
def test_labels_match_pandas_grouper(sample, freq):
    ts, df = sample
    expected, bins = _expected(ts, freq)
    rows = profile(df, "ts", freq=freq.replace("ME", "M"), columns=[]).collect()
    assert {r.dataset_timestamp: r.rows_processed for r in rows} == expected
    # group_count: every bin from the first to the last, empty ones included (the grouper's group count).
    assert {r.group_count for r in rows} == {bins}


@pytest.mark.parametrize("first", STARTS)
def test_calendar_labels_from_any_first_row(spark, first):
    """Labels and numbers of bins of all calendar frequencies, whatever the earliest row, in one pass."""
    ts, df = _times(spark, first)
    origin = F.lit(str(ts[0].normalize())).cast("timestamp_ntz")
    columns = []
    for i, freq in enumerate(CALENDAR):
        f = B.parse_freq(freq)
        label = B.bucket_label(F.col("ts"), f, origin)
        columns += [B.epoch_ms(label).alias(f"l{i}"), B.bucket_ordinal(label, f).alias(f"o{i}")]
    got = df.select(*columns).toPandas()
    for i, freq in enumerate(CALENDAR):
        expected, bins = _expected(ts, freq)
        assert got.groupby(f"l{i}").size().to_dict() == expected, freq
        assert got[f"o{i}"].max() - got[f"o{i}"].min() + 1 == bins, freq
