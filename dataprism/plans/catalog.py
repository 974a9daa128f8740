"""Query catalogue: the operators applied to the test tables.

Every query reads whole tables and returns a DataFrame whose columns match its oracle in ``plans.oracle_queries``.
Profiles are shown through ``exact_summary`` (exact statistics, floats rounded to 4 places, times as epoch numbers);
sketch statistics are shown as bound checks against exact values computed by Spark on the same rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dataprism.functions import buckets as B
from dataprism.functions import envelope as E
from dataprism.operators.filters import filter_days
from dataprism.operators.merge import merge_profiles
from dataprism.operators.payload import make_payload, profile_payload
from dataprism.operators.profile import profile
from dataprism.operators.publish import FileProfileWriter, publish, read_store
from dataprism.operators.quantiles import exact_quantiles
from dataprism.operators.summary import QUANTILES, profile_summary
from dataprism.plans import state_queries
from dataprism.plans.sql_api import register_profile_view, register_receipts_view
from dataprism.session import scratch_path
from dataprism.sources.datagen import amplify, employees_from, write_employees
from dataprism.sources.profile_files import read_profiles
from dataprism.sources.tables import table

Query = Callable[[SparkSession, str], DataFrame]

EXACT_FIELDS = ["column_name", "column_type", "count", "null_count", "nan_count", "inf_count", "min", "max", "mean",
                "stddev", "min_str", "max_str", "min_len", "max_len", "mean_len", "min_ts_us", "max_ts_us"]
TYPE_COUNT_FIELDS = ["n_integral", "n_fractional", "n_boolean", "n_string", "n_temporal", "n_other"]


def _us(c: Column) -> Column:
    """Microseconds since the epoch of a wall-clock time (zone-free)."""
    return B.epoch_us(c)


def stable_round(c: Column | str, digits: int = 4) -> Column:
    """Round for comparison across engines: a relative nudge of 1e-12 (far above floating-point noise, far below the
    rounding step) settles exact decimal ties the same way whatever the last bit of the sum was."""
    c = F.col(c) if isinstance(c, str) else c
    return F.round(c * F.lit(1 + 1e-12), digits)


def exact_summary(profiles: DataFrame, keys: list[str], type_counts: bool = False,
                  profile_col: str = "profile") -> DataFrame:
    """Exact statistics of each (profile, column), in the oracle's column layout."""
    s = profile_summary(profiles, keys=keys, profile_col=profile_col, sketches=False)
    cols = [
        *keys, "column_name", "column_type", "count", "null_count", "nan_count", "inf_count", "min", "max",
        stable_round("mean").alias("mean"), stable_round("stddev").alias("stddev"), "min_str", "max_str",
        "min_len", "max_len", stable_round("mean_len").alias("mean_len"),
        _us(F.col("min_ts")).alias("min_ts_us"), _us(F.col("max_ts")).alias("max_ts_us"),
    ]
    if type_counts:
        cols += TYPE_COUNT_FIELDS
    return s.select(*cols)


def _day_ms(ts: str) -> Column:
    return B.epoch_ms(F.to_date(F.col(ts))).alias("day")


# ---------------------------------------------------------------------------------------------------------------
# Profiles: grouping, segments, partitions
# ---------------------------------------------------------------------------------------------------------------

def profile_daily(spark: SparkSession, d: str) -> DataFrame:
    """Unsegmented daily profiles of every column of ``events``."""
    p = profile(table(spark, d, "events"), "ts", freq="D")
    return exact_summary(p, ["dataset_timestamp", "segment", "rows_processed"])


def profile_daily_segmented(spark: SparkSession, d: str) -> DataFrame:
    """Partition by day, segment on event type: ``rows_processed`` is the day's rows on every segment."""
    ev = table(spark, d, "events")
    p = profile(ev, "ts", segments="event_type", partition_by=[_day_ms("ts")])
    return exact_summary(p, ["day", "dataset_timestamp", "segment", "rows_processed", "segment_rows"])


def profile_day_state(spark: SparkSession, d: str) -> DataFrame:
    """Partition by (day, event type) and segment on event type — the canonical profile query."""
    ev = table(spark, d, "events")
    p = profile(ev, "ts", segments="event_type", partition_by=[_day_ms("ts"), "event_type"])
    return exact_summary(p, ["day", "event_type", "dataset_timestamp", "segment", "rows_processed"])


def profile_two_segments(spark: SparkSession, d: str) -> DataFrame:
    """Monthly lineitem profiles segmented on (return flag, line status), names given as CSV with blanks."""
    li = table(spark, d, "lineitem")
    p = profile(li, "l_shipdate", freq="MS", segments=" l_returnflag, ,l_linestatus ")
    return exact_summary(p, ["dataset_timestamp", "segment_partition", "segment", "rows_processed", "segment_rows"])


def profile_column_chunks(spark: SparkSession, d: str) -> DataFrame:
    """All 11 lineitem columns profiled in passes of 4 columns, column maps joined per profile."""
    li = table(spark, d, "lineitem")
    p = profile(li, "l_shipdate", freq="QS", segments="l_linestatus", partition_by=["l_returnflag"],
                columns_per_pass=4)
    return exact_summary(p, ["l_returnflag", "dataset_timestamp", "segment", "rows_processed", "segment_rows"])


def profile_partition_nonkey(spark: SparkSession, d: str) -> DataFrame:
    """A requested non-key column comes back as a typed NULL."""
    ev = table(spark, d, "events")
    p = profile(ev, "ts", partition_by=[_day_ms("ts")], passthrough={"event_type": "string"}, columns=["value"])
    return exact_summary(p, ["day", "event_type", "dataset_timestamp", "rows_processed"])


def _events_null_type(spark: SparkSession, d: str) -> DataFrame:
    ev = table(spark, d, "events")
    return ev.withColumn("event_type", F.when(F.col("event_id") % 7 == 0, F.lit(None)).otherwise(F.col("event_type")))


def profile_null_segment(spark: SparkSession, d: str) -> DataFrame:
    """NULL is a segment value of its own."""
    p = profile(_events_null_type(spark, d), "ts", segments=["event_type"], columns=["event_type", "value"])
    return exact_summary(p, ["dataset_timestamp", "segment", "rows_processed", "segment_rows"])


# ---------------------------------------------------------------------------------------------------------------
# Time buckets
# ---------------------------------------------------------------------------------------------------------------

def _bucket_query(tbl: str, ts: str, freq: str, columns: list[str], partition: str | None = None) -> Query:
    def q(spark: SparkSession, d: str) -> DataFrame:
        keys = [partition] if partition else []
        p = profile(table(spark, d, tbl), ts, freq=freq, columns=columns, partition_by=keys)
        return exact_summary(p, keys + ["dataset_timestamp", "rows_processed"])

    q.__doc__ = f"{tbl} bucketed at {freq!r}" + (f" per {partition}" if partition else "")
    return q


bucket_hour = _bucket_query("events", "ts", "h", ["value", "user_id"])
bucket_15min = _bucket_query("events", "ts", "15min", ["value"])
bucket_6h = _bucket_query("events", "ts", "6H", ["value", "event_type"])
bucket_week_end = _bucket_query("orders", "o_orderdate", "W", ["o_totalprice", "o_orderstatus"])
bucket_week_mon = _bucket_query("orders", "o_orderdate", "W-MON", ["o_totalprice", "o_orderstatus"])
bucket_month_end = _bucket_query("orders", "o_orderdate", "M", ["o_totalprice", "o_orderpriority"])
bucket_month_start = _bucket_query("orders", "o_orderdate", "MS", ["o_totalprice", "o_orderpriority"])
bucket_quarter_end = _bucket_query("orders", "o_orderdate", "Q", ["o_totalprice", "o_orderdate"])
bucket_quarter_start = _bucket_query("orders", "o_orderdate", "QS", ["o_totalprice", "o_orderdate"])
bucket_year_end = _bucket_query("orders", "o_orderdate", "Y", ["o_totalprice", "o_custkey"])
bucket_year_start = _bucket_query("orders", "o_orderdate", "YS", ["o_totalprice", "o_custkey"])
bucket_5d_origin = _bucket_query("events", "ts", "5D", ["value", "user_id"], partition="event_type")
bucket_7h_origin = _bucket_query("events", "ts", "7h", ["value"], partition="event_type")
bucket_97min_origin = _bucket_query("events", "ts", "97min", ["value"], partition="event_type")
bucket_36h_origin = _bucket_query("lineitem", "l_shipdate", "36h", ["l_quantity"], partition="l_returnflag")


def bucket_group_count(spark: SparkSession, d: str) -> DataFrame:
    """Daily order profiles per priority: empty days emit nothing, ``group_count`` spans first to last day."""
    p = profile(table(spark, d, "orders"), "o_orderdate", freq="D", partition_by=["o_orderpriority"],
                columns=["o_totalprice"])
    return p.select("o_orderpriority", "dataset_timestamp", "rows_processed", "group_count")


# ---------------------------------------------------------------------------------------------------------------
# Filters
# ---------------------------------------------------------------------------------------------------------------

def filter_day_eq(spark: SparkSession, d: str) -> DataFrame:
    """One day, partition by (day, event type), segment on event type."""
    ev = filter_days(table(spark, d, "events"), "ts", day="2024-01-03")
    p = profile(ev, "ts", segments="event_type", partition_by=[_day_ms("ts"), "event_type"])
    return exact_summary(p, ["day", "event_type", "dataset_timestamp", "segment", "rows_processed"])


def filter_redundant(spark: SparkSession, d: str) -> DataFrame:
    """``day = d AND day > a AND day <= b``: one range reaches the scan."""
    ev = filter_days(table(spark, d, "events"), "ts", day="2024-01-03", start="2024-01-01", end="2024-01-03",
                     include_start=False)
    return exact_summary(profile(ev, "ts", columns=["value", "event_type"]), ["dataset_timestamp", "rows_processed"])


def filter_day_half_open(spark: SparkSession, d: str) -> DataFrame:
    """``day > 2024-01-01 AND day <= 2024-01-03``, partition by day, unsegmented."""
    ev = filter_days(table(spark, d, "events"), "ts", start="2024-01-01", end="2024-01-03", include_start=False,
                     include_end=True)
    p = profile(ev, "ts", partition_by=[_day_ms("ts")])
    return exact_summary(p, ["day", "dataset_timestamp", "rows_processed"])


def filter_day_closed(spark: SparkSession, d: str) -> DataFrame:
    """``day >= 2024-01-20 AND day <= 2024-01-22``, partition by (day, event type, salt): partial profiles."""
    ev = filter_days(table(spark, d, "events"), "ts", start="2024-01-20", end="2024-01-22")
    ev = ev.withColumn("salt", F.pmod(F.col("event_id"), F.lit(10)))
    p = profile(ev, "ts", segments="event_type", partition_by=[_day_ms("ts"), "event_type", "salt"],
                columns=["value", "user_id"])
    return exact_summary(p, ["day", "event_type", "salt", "dataset_timestamp", "segment", "rows_processed"])


def filter_day_and_key(spark: SparkSession, d: str) -> DataFrame:
    """``count(1)`` of one day and one event type."""
    ev = filter_days(table(spark, d, "events"), "ts", day="2024-01-03").filter(F.col("event_type") == "click")
    return ev.agg(F.count(F.lit(1)).alias("n"))


def count_all(spark: SparkSession, d: str) -> DataFrame:
    """``count(1)`` of a whole table."""
    return table(spark, d, "lineitem").agg(F.count(F.lit(1)).alias("n"))


# ---------------------------------------------------------------------------------------------------------------
# Statistics
# ---------------------------------------------------------------------------------------------------------------

def _events_null_ts(spark: SparkSession, d: str) -> DataFrame:
    ev = table(spark, d, "events")
    return ev.withColumn("ts", F.when(F.col("event_id") % 11 == 0, F.lit(None)).otherwise(F.col("ts")))


def null_ts_dropped(spark: SparkSession, d: str) -> DataFrame:
    """Rows without event time leave every bucket of an unsegmented profile."""
    p = profile(_events_null_ts(spark, d), "ts", columns=["event_id", "ts", "value"])
    return exact_summary(p, ["dataset_timestamp", "rows_processed"])


def _events_bad_values(spark: SparkSession, d: str) -> DataFrame:
    ev = table(spark, d, "events")
    v = (
        F.when(F.col("event_id") % 7 == 0, F.lit(None).cast("double"))
        .when(F.col("event_id") % 11 == 0, F.lit(float("nan")))
        .when(F.col("event_id") % 13 == 0, F.lit(float("inf")))
        .when(F.col("event_id") % 17 == 0, F.lit(float("-inf")))
        .otherwise(F.col("value"))
    )
    return ev.withColumn("value", v).withColumn("props", F.lit(None).cast("string"))


def stats_null_nan(spark: SparkSession, d: str) -> DataFrame:
    """Null / NaN / ±Inf counts; extrema skip NaN, moments use finite values only; an all-null column."""
    p = profile(_events_bad_values(spark, d), "ts", segments="event_type", columns=["value", "props"])
    return exact_summary(p, ["dataset_timestamp", "segment"])


def stats_moments(spark: SparkSession, d: str) -> DataFrame:
    """Yearly moments of the lineitem measures per return flag."""
    p = profile(table(spark, d, "lineitem"), "l_shipdate", freq="YS", segments="l_returnflag",
                columns=["l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linenumber"])
    return exact_summary(p, ["dataset_timestamp", "segment", "segment_rows"])


def stats_strings(spark: SparkSession, d: str) -> DataFrame:
    """String extrema and length statistics of customer columns per market segment."""
    cu = table(spark, d, "customer").withColumn("since", F.lit("2024-01-01 00:00:00").cast("timestamp_ntz"))
    p = profile(cu, "since", segments="c_mktsegment", columns=["c_name", "c_mktsegment", "c_acctbal", "c_nationkey"])
    return exact_summary(p, ["dataset_timestamp", "segment"])


def _since(df: DataFrame) -> DataFrame:
    """Tables without an event time are profiled as one snapshot (a fixed time)."""
    return df.withColumn("since", F.lit("2024-01-01 00:00:00").cast("timestamp_ntz"))


def profile_documents(spark: SparkSession, d: str) -> DataFrame:
    """Whole documents (texts up to 20,000 words) profiled per language and source: string extrema over entire
    texts, length statistics, counts."""
    p = profile(_since(table(spark, d, "documents")), "since", segments="lang,source",
                columns=["doc_id", "text", "lang", "source", "n_chars"])
    return exact_summary(p, ["dataset_timestamp", "segment", "rows_processed", "segment_rows"])


def profile_conversations(spark: SparkSession, d: str) -> DataFrame:
    """Conversation turns partitioned by role and segmented by turn number."""
    p = profile(_since(table(spark, d, "conversations")), "since", segments="turn", partition_by=["role"],
                columns=["conv_id", "turn", "text"])
    return exact_summary(p, ["role", "dataset_timestamp", "segment", "rows_processed", "segment_rows"])


def stats_temporal(spark: SparkSession, d: str) -> DataFrame:
    """Temporal extrema of order dates per year and status."""
    p = profile(table(spark, d, "orders"), "o_orderdate", freq="YS", segments="o_orderstatus",
                columns=["o_orderdate", "o_orderstatus"])
    return exact_summary(p, ["dataset_timestamp", "segment"])


def type_counts(spark: SparkSession, d: str) -> DataFrame:
    """Values per type class of every events column."""
    p = profile(table(spark, d, "events"), "ts", freq="W")
    return exact_summary(p, ["dataset_timestamp"], type_counts=True)


def stats_exact_distinct(spark: SparkSession, d: str) -> DataFrame:
    """Exact distinct counts per yearly lineitem profile."""
    p = profile(table(spark, d, "lineitem"), "l_shipdate", freq="YS", exact=True,
                columns=["l_orderkey", "l_partkey", "l_quantity", "l_returnflag", "l_shipdate"])
    s = profile_summary(p, keys=["dataset_timestamp"], sketches=False)
    return s.select("dataset_timestamp", "column_name", "count", "distinct_exact")


# ---------------------------------------------------------------------------------------------------------------
# Sketch bound checks (Spark compares each sketch read-out with the exact value on the same rows)
# ---------------------------------------------------------------------------------------------------------------

KLL_RANK_EPS = 0.03
HLL_REL_EPS = 0.05


def kll_within_bound(spark: SparkSession, d: str) -> DataFrame:
    """Every KLL quantile lies within ``KLL_RANK_EPS`` of its level in rank (ties widen the rank interval)."""
    li = table(spark, d, "lineitem")
    cols = ["l_quantity", "l_extendedprice", "l_discount"]
    p = profile(li, "l_shipdate", freq="YS", segments="l_returnflag", columns=cols)
    s = profile_summary(p, keys=["dataset_timestamp", "segment"])
    qs = s.select("dataset_timestamp", "segment", "column_name", "quantiles")
    # Rows in long form (bucket, segment, column, value) joined to their group's quantile array (one row per
    # group, a small table), then one pass of conditional counts for the rank interval of every level.
    ts_ms = B.epoch_ms(B.bucket_label(F.col("l_shipdate"), B.parse_freq("YS")))
    seg = E.segment_json(["l_returnflag"], [F.col("l_returnflag")])
    long = li.select(ts_ms.alias("dataset_timestamp"), seg.alias("segment"),
                     F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("double").alias("x"))
                                         for c in cols])).alias("cv"))
    long = long.select("dataset_timestamp", "segment", "cv.column_name", "cv.x").filter(F.col("x").isNotNull())
    j = long.join(qs, ["dataset_timestamp", "segment", "column_name"])
    aggs = [F.count(F.lit(1)).alias("n")]
    for i in range(len(QUANTILES)):
        v = F.col("quantiles")[i]
        aggs += [F.count_if(F.col("x") < v).alias(f"lt{i}"), F.count_if(F.col("x") <= v).alias(f"le{i}")]
    r = j.groupBy("dataset_timestamp", "segment", "column_name").agg(*aggs)
    ok = F.lit(True)
    for i, q in enumerate(QUANTILES):
        lo = F.col(f"lt{i}") / F.col("n")
        hi = F.col(f"le{i}") / F.col("n")
        ok = ok & (lo - KLL_RANK_EPS <= F.lit(q)) & (F.lit(q) <= hi + KLL_RANK_EPS)
    return r.select("dataset_timestamp", "segment", "column_name", ok.alias("within_bound"))


def hll_within_bound(spark: SparkSession, d: str) -> DataFrame:
    """HLL distinct estimates within ``HLL_REL_EPS`` (plus one) of the exact distinct count."""
    p = profile(table(spark, d, "events"), "ts", freq="D", segments="event_type", exact=True,
                columns=["event_id", "user_id", "value", "props"])
    s = profile_summary(p, keys=["dataset_timestamp", "segment"])
    ok = F.abs(F.col("distinct_est") - F.col("distinct_exact")) <= F.col("distinct_exact") * HLL_REL_EPS + 1
    return s.select("dataset_timestamp", "segment", "column_name", ok.alias("within_bound"))


def topk_within_bound(spark: SparkSession, d: str) -> DataFrame:
    """Frequent-item counts against exact counts; the first item is a true most-frequent one (within bound)."""
    ev = table(spark, d, "events").withColumn("hour", F.hour("ts").cast("bigint")).withColumn("day", F.to_date("ts"))
    cols = ["event_type", "props", "hour", "day"]
    p = profile(ev, "ts", freq="D", columns=cols, topk_capacity=256)
    s = profile_summary(p, keys=["dataset_timestamp"], top_items=5)
    items = s.select("dataset_timestamp", "column_name", "count", F.posexplode("top_items").alias("pos", "it"))
    items = items.select("dataset_timestamp", "column_name", "count", "pos", F.col("it.item").alias("item"),
                         F.col("it.count").alias("est"))
    day = B.epoch_ms(F.to_date(F.col("ts"))).alias("dataset_timestamp")
    exact = (
        ev.select(day, F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("item"))
                                             for c in cols])).alias("ci"))
        .select("dataset_timestamp", "ci.column_name", "ci.item")
        .groupBy("dataset_timestamp", "column_name", "item").agg(F.count(F.lit(1)).alias("true_count"))
    )
    top = exact.groupBy("dataset_timestamp", "column_name").agg(F.max("true_count").alias("max_count"))
    # A left join: an item that is not in the data at all has no true count, which is out of bounds.
    j = items.join(exact, ["dataset_timestamp", "column_name", "item"], "left") \
        .join(top, ["dataset_timestamp", "column_name"])
    bound = F.floor(F.col("count") * 4 / F.lit(256))
    ok_item = F.coalesce(F.abs(F.col("est") - F.col("true_count")) <= bound, F.lit(False))
    ok_top = (F.col("pos") != 0) | (F.col("true_count") >= F.col("max_count") - bound)
    return j.groupBy("dataset_timestamp", "column_name").agg(F.bool_and(ok_item & ok_top).alias("within_bound"))


# ---------------------------------------------------------------------------------------------------------------
# Merge, envelope, summary
# ---------------------------------------------------------------------------------------------------------------

def salted_merge_equals_direct(spark: SparkSession, d: str) -> DataFrame:
    """Profiles of 10 salted partitions per (day, event type), merged, equal the direct profile."""
    ev = table(spark, d, "events").withColumn("salt", F.pmod(F.col("event_id"), F.lit(10)))
    parts = profile(ev, "ts", segments="event_type", partition_by=["salt"], columns=["value", "user_id", "props"])
    merged = merge_profiles(parts, ["dataset_timestamp", "segment"])
    return exact_summary(merged, ["dataset_timestamp", "segment", "segment_rows"])


def salted_profile(spark: SparkSession, d: str) -> DataFrame:
    """Two-level (salted) aggregation gives the same exact statistics as the one-level plan."""
    p = profile(table(spark, d, "lineitem"), "l_shipdate", freq="YS", segments="l_returnflag,l_linestatus", salt=8)
    return exact_summary(p, ["dataset_timestamp", "segment", "rows_processed", "segment_rows"])


def merge_schema_change(spark: SparkSession, d: str) -> DataFrame:
    """Parts with differing columns, sketch capacities and metadata merge: rows are summed over profiles, a column
    counts the parts that have it, custom metadata stays."""
    ev = table(spark, d, "events")
    old = profile(ev.filter("event_id % 3 = 0"), "ts", columns=["value"], topk_capacity=64, metadata={"origin": "old"})
    new = profile(ev.filter("event_id % 3 <> 0"), "ts", columns=["value", "props"], metadata={"origin": "old"})
    none = profile(ev, "ts", columns=[], metadata={"origin": "old"})
    merged = merge_profiles(old.unionByName(new).unionByName(none), ["dataset_timestamp"])
    s = profile_summary(merged, keys=["dataset_timestamp", "segment_rows"], sketches=False, metadata=True)
    return s.select("dataset_timestamp", "segment_rows", F.col("metadata")["origin"].alias("origin"), "column_name",
                    "count", "null_count", "min", "max", stable_round("mean").alias("mean"),
                    stable_round("stddev").alias("stddev"))


def stats_big_integers(spark: SparkSession, d: str) -> DataFrame:
    """Integers beyond 2**53 and wide decimals keep their exact extrema."""
    li = table(spark, d, "lineitem").select(
        "l_shipdate", "l_returnflag", (F.lit(1152921504606846977) + F.col("l_orderkey")).alias("big"),
        (F.lit(-1152921504606846977) - F.col("l_orderkey")).alias("low"),
        (F.col("l_orderkey").cast("decimal(38,4)") * F.lit(-1) - F.expr("123456789012345678901234567.8901BD"))
        .cast("decimal(38,4)").alias("wide"))
    p = profile(li, "l_shipdate", freq="YS", segments="l_returnflag", columns=["big", "low", "wide"])
    s = profile_summary(p, keys=["dataset_timestamp", "segment"], sketches=False)
    return s.select("dataset_timestamp", "segment", "column_name", "min_exact", "max_exact")


def profile_odd_names(spark: SparkSession, d: str) -> DataFrame:
    """Columns of any spelling: dots, blanks, quotes and backticks, as values, segments, keys and event time."""
    ev = table(spark, d, "events")
    odd = ev.select(F.col("ts").alias("event.time"), F.col("event_type").alias("a.b"), F.col("value").alias("it's `x`"),
                    F.col("user_id").alias("user id"))
    p = profile(odd, "event.time", segments="a.b", partition_by=["a.b"], columns=["it's `x`", "user id"])
    s = profile_summary(p, keys=["a.b", "dataset_timestamp", "segment"], sketches=False)
    return s.select(F.col("`a.b`").alias("event_type"), "dataset_timestamp", "segment", "column_name", "count",
                    "min", "max")


def profile_ltz(spark: SparkSession, d: str) -> DataFrame:
    """An instant (TIMESTAMP) event time is bucketed in UTC whatever the session zone: the same plan run under Los
    Angeles and Tokyo time."""
    ev = table(spark, d, "events").select(F.timestamp_micros(B.epoch_us(F.col("ts"))).alias("at"), "value")
    zone = spark.conf.get("spark.sql.session.timeZone")
    parts = []
    try:
        for z in ("America/Los_Angeles", "Asia/Tokyo"):
            spark.conf.set("spark.sql.session.timeZone", z)
            p = profile(ev, "at", freq="D", columns=["value", "at"])
            out = exact_summary(p, ["dataset_timestamp", "rows_processed"]).withColumn("zone", F.lit(z))
            path = scratch_path(spark, "ltz")
            out.write.parquet(path)  # runs under this zone
            parts.append(spark.read.schema(out.schema).parquet(path))
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    return parts[0].unionByName(parts[1])


def segment_timestamp(spark: SparkSession, d: str) -> DataFrame:
    """Segment values one microsecond apart stay two segments, by their text too."""
    ev = table(spark, d, "events").withColumn(
        "at", F.timestamp_add("MICROSECOND", F.col("event_id") % 3, F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")))
    p = profile(ev, "ts", freq="MS", segments="at", columns=["value"])
    return p.select("dataset_timestamp", "segment", "segment_rows")


def epoch_ms_far(spark: SparkSession, d: str) -> DataFrame:
    """The last and first representable times of a day, millennia away, keep their millisecond and their day."""
    ev = table(spark, d, "events").select("event_id")
    late = F.timestamp_add("MICROSECOND", -1 - F.col("event_id") % 5, F.lit("9999-12-31 23:59:59.999999").cast("timestamp_ntz"))
    early = F.timestamp_add("MICROSECOND", F.col("event_id") % 5, F.lit("0001-01-02 00:00:00").cast("timestamp_ntz"))
    day = B.parse_freq("D")
    return ev.select("event_id", B.epoch_ms(late).alias("late_ms"), B.epoch_ms(B.bucket_label(late, day)).alias("late_day"),
                     B.epoch_ms(early).alias("early_ms"), B.bucket_ordinal(B.bucket_label(early, day), day).alias("early_day"))


def stats_exact_quantiles(spark: SparkSession, d: str) -> DataFrame:
    """Exact quantiles of the lineitem measures per return flag."""
    q = exact_quantiles(table(spark, d, "lineitem"), ["l_quantity", "l_extendedprice", "l_discount"],
                        [0.0, 0.01, 0.25, 0.5, 0.75, 0.99, 1.0], ["l_returnflag"])
    return q.select("l_returnflag", "column_name", *[stable_round(F.col("quantiles")[i]).alias(f"q{i}") for i in range(7)])


def debug_texts(spark: SparkSession, d: str) -> DataFrame:
    """The debug text of each profile: bins of its partition and segment key."""
    p = profile(table(spark, d, "events"), "ts", segments="event_type", partition_by=["event_type"], columns=["value"])
    return p.select("event_type", "dataset_timestamp", "debug_info")


def segment_json_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    """The segment text decodes back to the segment value."""
    p = profile(table(spark, d, "events"), "ts", segments="event_type", columns=["value"])
    dec = F.from_json("segment", "event_type string")
    return p.select("dataset_timestamp", "segment", dec.getField("event_type").alias("event_type"), "segment_rows")


def envelope_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    """Serialized profiles decode back to the same statistics."""
    p = profile(table(spark, d, "events"), "ts", segments="event_type", serialize=True)
    dec = p.select("dataset_timestamp", "segment", E.deserialize_profile(F.col("profile_view")).alias("profile"))
    dec = dec.select("segment", F.col("profile").getField("dataset_timestamp").alias("dataset_timestamp"), "profile")
    return exact_summary(dec, ["dataset_timestamp", "segment"])


def summary_all_stats(spark: SparkSession, d: str) -> DataFrame:
    """The long summary of monthly order profiles with type counts."""
    p = profile(table(spark, d, "orders"), "o_orderdate", freq="MS", segments="o_orderstatus")
    return exact_summary(p, ["dataset_timestamp", "segment", "rows_processed"], type_counts=True)


def epoch_ms_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    """Timestamp -> epoch ms -> timestamp -> epoch ms is stable; bucket label of each row."""
    ev = table(spark, d, "events")
    ms = B.epoch_ms(F.col("ts"))
    back = B.epoch_ms(B.from_epoch_ms(ms))
    return ev.select("event_id", ms.alias("ts_ms"), (back == ms).alias("roundtrip_ok"),
                     B.epoch_ms(B.bucket_label(F.col("ts"), B.parse_freq("D"))).alias("day_ms"))


# ---------------------------------------------------------------------------------------------------------------
# Row payloads (one object per row with control keys)
# ---------------------------------------------------------------------------------------------------------------

def _event_ms(ev: DataFrame) -> Column:
    return B.epoch_ms(F.col("ts"))


def profile_payload_variant(spark: SparkSession, d: str) -> DataFrame:
    """``object_insert(object_construct(*), DATASET_TIMESTAMP, SEGMENT_COLUMNS)`` as a VARIANT per row, partitioned
    by day: keys and types discovered from the data, the raw time column profiled like any other value."""
    ev = table(spark, d, "events")
    src = ev.select(_day_ms("ts"), make_payload(ev, dataset_timestamp=_event_ms(ev), segment_columns="EVENT_TYPE")
                    .alias("data"))
    p = profile_payload(src, "data", partition_by=["day"])
    return exact_summary(p, ["day", "dataset_timestamp", "segment", "rows_processed"])


def profile_payload_config(spark: SparkSession, d: str) -> DataFrame:
    """Struct payload partitioned by event type whose GROUP_BY_FREQUENCY differs by partition (weekly for clicks
    and views, daily otherwise): one plan per distinct configuration."""
    ev = table(spark, d, "events")
    freq = F.when(F.col("event_type").isin("click", "view"), F.lit("W")).otherwise(F.lit("D"))
    src = ev.select("event_type", make_payload(ev, dataset_timestamp=_event_ms(ev), freq=freq, as_variant=False)
                    .alias("data"))
    p = profile_payload(src, "data", partition_by=["event_type"])
    return exact_summary(p, ["event_type", "dataset_timestamp", "rows_processed"])


def payload_config_empty(spark: SparkSession, d: str) -> DataFrame:
    """Partitions whose segment list is a name, empty or NULL, and whose frequency is W, empty or NULL, in one plan:
    blank control values count as absent and no partition is lost."""
    ev = table(spark, d, "events")
    segs = F.when(F.col("event_type").isin("click", "view"), F.lit("event_type")) \
        .when(F.col("event_type") == "signup", F.lit(None)).otherwise(F.lit(" "))
    freq = F.when(F.col("event_type") == "click", F.lit("W")).when(F.col("event_type") == "view", F.lit(""))
    src = ev.select("event_type", make_payload(ev, dataset_timestamp=_event_ms(ev), segment_columns=segs, freq=freq)
                    .alias("data"))
    p = profile_payload(src, "data", partition_by=["event_type"], columns=["value", "user_id"])
    return exact_summary(p, ["event_type", "dataset_timestamp", "segment", "rows_processed"])


def type_counts_variant(spark: SparkSession, d: str) -> DataFrame:
    """A payload key with values of several types: every value counts under its own type."""
    ev = table(spark, d, "events")
    data = F.when(F.col("event_id") % 5 == 0, F.to_variant_object(F.struct(F.col("user_id").alias("v"), _event_ms(ev).alias("DATASET_TIMESTAMP")))) \
        .when(F.col("event_id") % 5 == 1, F.to_variant_object(F.struct(F.col("event_type").alias("v"), _event_ms(ev).alias("DATASET_TIMESTAMP")))) \
        .when(F.col("event_id") % 5 == 2, F.to_variant_object(F.struct(F.col("value").alias("v"), _event_ms(ev).alias("DATASET_TIMESTAMP")))) \
        .when(F.col("event_id") % 5 == 3, F.to_variant_object(F.struct((F.col("event_id") % 2 == 0).alias("v"), _event_ms(ev).alias("DATASET_TIMESTAMP")))) \
        .otherwise(F.to_variant_object(F.struct(_event_ms(ev).alias("DATASET_TIMESTAMP"))))
    s = profile_summary(profile_payload(ev.select(data.alias("data")), "data"), keys=["dataset_timestamp"], sketches=False)
    return s.select("dataset_timestamp", "column_name", "count", "null_count", *TYPE_COUNT_FIELDS, "min", "max",
                    "min_str", "max_str")


# ---------------------------------------------------------------------------------------------------------------
# Sample data
# ---------------------------------------------------------------------------------------------------------------

def table_replace(spark: SparkSession, d: str) -> DataFrame:
    """Create the employees table, then replace it by half of its rows: only the new rows are there."""
    e = employees_from(table(spark, d, "events"), "event_id", "ts")
    path = scratch_path(spark, "employees")
    write_employees(e, path)
    half = employees_from(table(spark, d, "events").filter("event_id % 2 = 0"), "event_id", "ts")
    return write_employees(half, path).groupBy("state").agg(F.count(F.lit(1)).alias("n"), F.sum("salary").alias("salary"))


def datagen_employees(spark: SparkSession, d: str) -> DataFrame:
    """One synthetic employee per event (fields from the event id, hire date = event time), typed by cast."""
    e = employees_from(table(spark, d, "events"), "event_id", "ts")
    return e.select(*[c for c in e.columns if c != "hire_date"], _us(F.col("hire_date")).alias("hire_date_us"))


def datagen_amplified(spark: SparkSession, d: str) -> DataFrame:
    """Employees amplified by three doublings (8 copies of every row), profiled daily per state."""
    e = amplify(employees_from(table(spark, d, "events"), "event_id", "ts"), 3)
    p = profile(e, "hire_date", segments="state", columns=["salary", "years_xp", "hire_date"])
    return exact_summary(p, ["dataset_timestamp", "segment", "segment_rows"])


# ---------------------------------------------------------------------------------------------------------------
# Publish, profile store, profile files
# ---------------------------------------------------------------------------------------------------------------

def _receipt_time(ts_ms: Column) -> Column:
    """Receipt time as text (``to_timestamp`` of the epoch-ms value)."""
    return F.date_format(B.from_epoch_ms(ts_ms), "yyyy-MM-dd HH:mm:ss.SSS")


def publish_receipts(spark: SparkSession, d: str) -> DataFrame:
    """Profile (day, event type) partitions segmented on event type, damage the profiles of days 5, 10, ..., publish
    to a profile store: one receipt per profile, ``Ok`` or the decode error."""
    ev = table(spark, d, "events")
    p = profile(ev, "ts", segments="event_type", partition_by=[_day_ms("ts"), "event_type"], serialize=True)
    damaged = F.dayofmonth(B.from_epoch_ms(F.col("dataset_timestamp"))) % 5 == 0
    p = p.withColumn("profile_view", F.when(damaged, F.concat(F.lit("corrupt:"), F.col("segment")))
                     .otherwise(F.col("profile_view")))
    r = publish(p, scratch_path(spark, "store"), dataset_id="store-eu")
    return r.select(*r.columns, _receipt_time(F.col("dataset_timestamp")).alias("receipt_time"))


def _require_delivered(receipts: DataFrame) -> None:
    if receipts.filter(F.col("result").isNull()).limit(1).count():
        raise RuntimeError("publish failed for some profiles")


def publish_bad_payload(spark: SparkSession, d: str) -> DataFrame:
    """Every way a profile can be undeliverable, one event type each: no dataset id, a segment without a partition
    name, a segment of another partition; and a segment column whose name holds a comma, which is fine."""
    ev = table(spark, d, "events").withColumn("kind, raw", F.col("event_type"))
    p = profile(ev, "ts", segments=["kind, raw"], partition_by=["event_type"], columns=["value"])
    kind = F.col("event_type")
    bad = p.withColumn("segment_partition", F.when(kind == "click", F.lit(None)).when(kind == "view", F.lit("other"))
                       .otherwise(F.col("segment_partition")))
    ds = F.when(kind == "purchase", F.lit(None)).otherwise(F.lit("store-eu"))
    return publish(bad, scratch_path(spark, "store"), dataset_id=ds)


def writer_partials(spark: SparkSession, d: str) -> DataFrame:
    """Ten salted partial profiles per (day, type), unsegmented, delivered to one dataset as files: as many files as
    receipts, and merged they are the profiles of the days."""
    ev = table(spark, d, "events").withColumn("salt", F.pmod(F.col("event_id"), F.lit(10)))
    p = profile(ev, "ts", partition_by=["event_type", "salt"], columns=["value"], serialize=True)
    root = scratch_path(spark, "files")
    receipts = publish(p, writer_factory=FileProfileWriter.factory(root), dataset_id="parts")
    _require_delivered(receipts)
    files = read_profiles(spark, root)
    merged = merge_profiles(files, ["dataset_timestamp"], rows_col=None)
    s = profile_summary(merged, keys=["dataset_timestamp"], sketches=False)
    return s.select("dataset_timestamp", "column_name", "count", "min", "max", stable_round("mean").alias("mean"),
                    files.agg(F.count(F.lit(1))).scalar().alias("files"),
                    receipts.agg(F.count(F.lit(1))).scalar().alias("receipts"))


def publish_store_readback(spark: SparkSession, d: str) -> DataFrame:
    """Unsegmented daily profiles per event type, routed to dataset ``m-<event type>``, read back from the store."""
    ev = table(spark, d, "events")
    p = profile(ev, "ts", partition_by=["event_type"], serialize=True)
    p = p.withColumn("dataset_id", F.concat(F.lit("m-"), F.col("event_type")))
    path = scratch_path(spark, "store")
    _require_delivered(publish(p, path))
    return exact_summary(read_store(spark, path), ["dataset_id", "dataset_timestamp", "segment"])


def publish_writer_receipts(spark: SparkSession, d: str) -> DataFrame:
    """Per-row delivery through a writer cached per task and dataset id; an invalid dataset id ('' for clicks) gives
    a delivery-failure receipt, every other profile ``Ok``."""
    ev = table(spark, d, "events")
    p = profile(ev, "ts", partition_by=["event_type"], serialize=True, columns=["value", "user_id"])
    ds = F.when(F.col("event_type") == "click", F.lit("")).otherwise(F.concat(F.lit("m-"), F.col("event_type")))
    return publish(p.withColumn("ds", ds), writer_factory=FileProfileWriter.factory(scratch_path(spark, "files")),
                   dataset_id="ds")


def _files_readback(encoding: str) -> Query:
    def q(spark: SparkSession, d: str) -> DataFrame:
        ev = table(spark, d, "events")
        p = profile(ev, "ts", partition_by=["event_type"], serialize=True)
        root = scratch_path(spark, "files")
        _require_delivered(publish(p.withColumn("dataset_id", F.concat(F.lit("m-"), F.col("event_type"))),
                                   writer_factory=FileProfileWriter.factory(root, encoding)))
        files = read_profiles(spark, root, encoding=encoding)
        files = files.withColumn("dataset_id", F.regexp_extract("source_file", r"/([^/]+)/[^/]+$", 1))
        return exact_summary(files, ["dataset_id", "dataset_timestamp"])

    q.__doc__ = f"Profiles delivered as one {encoding} file each, read back as one DataFrame."
    return q


def sql_cte_receipts(spark: SparkSession, d: str) -> DataFrame:
    """The profile-and-publish pipeline written in SQL: raw rows of days (2024-01-01, 2024-01-03] → daily profiles
    partitioned by day → delivered to dataset store-eu → receipts with their time as text."""
    table(spark, d, "events").createOrReplaceTempView("dp_events")
    register_profile_view(
        spark, "dp_profiled",
        "SELECT to_date(ts) AS day, * FROM dp_events "
        "WHERE ts >= TIMESTAMP_NTZ'2024-01-02 00:00:00' AND ts < TIMESTAMP_NTZ'2024-01-04 00:00:00'",
        "ts", partition_by=["day"], columns=["event_id", "ts", "user_id", "event_type", "value", "props"],
        serialize=True)
    register_receipts_view(
        spark, "dp_receipts",
        "SELECT day, 'store-eu' AS dataset_id, profile_view, segment_partition, segment FROM dp_profiled",
        path=scratch_path(spark, "store"))
    return spark.sql(
        "SELECT dataset_id, result, error, dataset_timestamp, "
        "date_format(timestampadd(MILLISECOND, dataset_timestamp, TIMESTAMP_NTZ'1970-01-01 00:00:00'), "
        "'yyyy-MM-dd HH:mm:ss') AS receipt_time, segment FROM dp_receipts")


profile_files_base64 = _files_readback("base64")
profile_files_raw = _files_readback("raw")


QUERIES: dict[str, Query] = {
    "profile_daily": profile_daily,
    "profile_daily_segmented": profile_daily_segmented,
    "profile_day_state": profile_day_state,
    "profile_two_segments": profile_two_segments,
    "profile_column_chunks": profile_column_chunks,
    "profile_partition_nonkey": profile_partition_nonkey,
    "profile_null_segment": profile_null_segment,
    "bucket_hour": bucket_hour,
    "bucket_15min": bucket_15min,
    "bucket_6h": bucket_6h,
    "bucket_week_end": bucket_week_end,
    "bucket_week_mon": bucket_week_mon,
    "bucket_month_end": bucket_month_end,
    "bucket_month_start": bucket_month_start,
    "bucket_quarter_end": bucket_quarter_end,
    "bucket_quarter_start": bucket_quarter_start,
    "bucket_year_end": bucket_year_end,
    "bucket_year_start": bucket_year_start,
    "bucket_5d_origin": bucket_5d_origin,
    "bucket_7h_origin": bucket_7h_origin,
    "bucket_36h_origin": bucket_36h_origin,
    "bucket_group_count": bucket_group_count,
    "filter_day_eq": filter_day_eq,
    "filter_day_half_open": filter_day_half_open,
    "filter_day_closed": filter_day_closed,
    "filter_day_and_key": filter_day_and_key,
    "count_all": count_all,
    "null_ts_dropped": null_ts_dropped,
    "stats_null_nan": stats_null_nan,
    "stats_moments": stats_moments,
    "stats_strings": stats_strings,
    "stats_temporal": stats_temporal,
    "profile_documents": profile_documents,
    "profile_conversations": profile_conversations,
    "type_counts": type_counts,
    "stats_exact_distinct": stats_exact_distinct,
    "kll_within_bound": kll_within_bound,
    "hll_within_bound": hll_within_bound,
    "topk_within_bound": topk_within_bound,
    "salted_merge_equals_direct": salted_merge_equals_direct,
    "salted_profile": salted_profile,
    "segment_json_roundtrip": segment_json_roundtrip,
    "envelope_roundtrip": envelope_roundtrip,
    "summary_all_stats": summary_all_stats,
    "epoch_ms_roundtrip": epoch_ms_roundtrip,
    "profile_payload_variant": profile_payload_variant,
    "profile_payload_config": profile_payload_config,
    "datagen_employees": datagen_employees,
    "datagen_amplified": datagen_amplified,
    "publish_receipts": publish_receipts,
    "sql_cte_receipts": sql_cte_receipts,
    "publish_store_readback": publish_store_readback,
    "publish_writer_receipts": publish_writer_receipts,
    "profile_files_base64": profile_files_base64,
    "profile_files_raw": profile_files_raw,
    "filter_redundant": filter_redundant,
    "bucket_97min_origin": bucket_97min_origin,
    "merge_schema_change": merge_schema_change,
    "stats_big_integers": stats_big_integers,
    "profile_odd_names": profile_odd_names,
    "profile_ltz": profile_ltz,
    "segment_timestamp": segment_timestamp,
    "epoch_ms_far": epoch_ms_far,
    "stats_exact_quantiles": stats_exact_quantiles,
    "debug_texts": debug_texts,
    "payload_config_empty": payload_config_empty,
    "type_counts_variant": type_counts_variant,
    "table_replace": table_replace,
    "publish_bad_payload": publish_bad_payload,
    "writer_partials": writer_partials,
}

QUERIES.update(state_queries.QUERIES)
