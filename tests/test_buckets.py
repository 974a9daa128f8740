import datetime as dt

import pytest
from pyspark.sql import functions as F

from dataprism.functions import buckets as B


@pytest.mark.parametrize("text", ["D", "h", "H", "15min", "15 min", "6h", "5D", "7h", "36h", "7min", "30s", "W",
                                  "W-MON", "W-SAT", "M", "ME", "MS", "Q", "QE", "QS", "Y", "YE", "A", "YS", "AS",
                                  "B", "SM", "SME", "SMS", "2W", "3W-THU", "2MS", "3M", "Q-JAN", "2QS-FEB", "A-JUN",
                                  "YS-APR", "10B", "2SM"])
def test_parse_accepts(text):
    B.parse_freq(text)


@pytest.mark.parametrize("text", [None, "", "BME", "SM-10", "0W", "W-XYZ", "0D", "fortnight", 5, "Q-XYZ",
                                  "M-JAN", "D-MON", "B-FRI", "-2W"])
def test_parse_rejects(text):
    with pytest.raises(ValueError):
        B.parse_freq(text)


def test_origin_dependent_flags():
    assert not B.parse_freq("D").origin_dependent
    assert not B.parse_freq("6h").origin_dependent
    assert not B.parse_freq("15min").origin_dependent
    assert B.parse_freq("5D").origin_dependent
    assert B.parse_freq("7h").origin_dependent


CASES = [
    # (timestamp, freq, expected label)
    ("2024-01-03 13:45:10", "D", "2024-01-03 00:00:00"),
    ("2024-01-03 13:45:10", "h", "2024-01-03 13:00:00"),
    ("2024-01-03 13:45:10", "15min", "2024-01-03 13:45:00"),
    ("2024-01-03 13:44:59", "15min", "2024-01-03 13:30:00"),
    ("2024-01-03 13:45:10", "6h", "2024-01-03 12:00:00"),
    # 2024-01-01 is a Monday: the W (=W-SUN) bucket closes on Sunday 2024-01-07, labelled with that day.
    ("2024-01-01 00:00:00", "W", "2024-01-07 00:00:00"),
    ("2024-01-07 23:59:59", "W", "2024-01-07 00:00:00"),
    ("2024-01-08 00:00:00", "W", "2024-01-14 00:00:00"),
    ("2024-01-01 10:00:00", "W-MON", "2024-01-01 00:00:00"),
    ("2024-01-02 10:00:00", "W-MON", "2024-01-08 00:00:00"),
    ("2024-02-10 10:00:00", "M", "2024-02-29 00:00:00"),
    ("2024-02-29 23:00:00", "M", "2024-02-29 00:00:00"),
    ("2024-02-10 10:00:00", "MS", "2024-02-01 00:00:00"),
    ("2024-05-10 10:00:00", "Q", "2024-06-30 00:00:00"),
    ("2024-05-10 10:00:00", "QS", "2024-04-01 00:00:00"),
    ("2024-05-10 10:00:00", "Y", "2024-12-31 00:00:00"),
    ("2024-05-10 10:00:00", "YS", "2024-01-01 00:00:00"),
]


@pytest.mark.parametrize("ts,freq,label", CASES)
def test_labels(spark, ts, freq, label):
    df = spark.createDataFrame([(dt.datetime.fromisoformat(ts),)], "t timestamp_ntz")
    got = df.select(B.bucket_label(F.col("t"), B.parse_freq(freq)).alias("b")).collect()[0].b
    assert got == dt.datetime.fromisoformat(label)


def test_rebucket_from_origin(spark):
    fq = B.parse_freq("5D")
    df = spark.createDataFrame([(dt.datetime(2024, 1, 2, 5), dt.datetime(2024, 1, 7, 1), dt.datetime(2024, 1, 1))],
                               "a timestamp_ntz, b timestamp_ntz, o timestamp_ntz")
    r = df.select(B.origin_label(F.col("a"), F.col("o"), fq.width_ms).alias("x"),
                  B.origin_label(F.col("b"), F.col("o"), fq.width_ms).alias("y")).collect()[0]
    assert r.x == dt.datetime(2024, 1, 1)
    assert r.y == dt.datetime(2024, 1, 6)


def test_epoch_ms_roundtrip(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 0, 0, 7, 179575),)], "t timestamp_ntz")
    r = df.select(B.epoch_ms(F.col("t")).alias("ms")).collect()[0]
    assert r.ms == 1704067207179
    back = df.select(B.from_epoch_ms(B.epoch_ms(F.col("t"))).alias("b")).collect()[0].b
    assert back == dt.datetime(2024, 1, 1, 0, 0, 7, 179000)


@pytest.mark.parametrize("zone", ["America/New_York", "Asia/Kolkata"])
def test_labels_independent_of_session_zone(spark, zone):
    """Labels and epoch values are wall-clock arithmetic: another session zone (DST included) changes nothing."""
    from dataprism import profile

    rows = [(dt.datetime(2024, 3, 10, 2, 30),), (dt.datetime(2024, 11, 3, 1, 30),), (dt.datetime(2024, 1, 3, 23, 59),)]
    df = spark.createDataFrame([(r[0].isoformat(sep=" "),) for r in rows], "t string").select(
        F.col("t").cast("timestamp_ntz").alias("ts"))

    def labels():
        out = set()
        for freq in ("D", "h", "MS", "QS", "W", "YS"):
            out |= {(freq, r.dataset_timestamp) for r in profile(df, "ts", freq=freq).collect()}
        return out

    expected = labels()
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", zone)
        assert labels() == expected
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert ("D", 1710028800000) in expected and ("h", 1710037800000 - 1800000) in expected
