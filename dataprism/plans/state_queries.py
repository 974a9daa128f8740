"""Queries of the mergeable states, the committing stores, long payloads and the calendar frequencies, each with its
DuckDB SQL beside it. ``plans.catalog`` and ``plans.oracle_queries`` take them in."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dataprism.functions import envelope as E
from dataprism.operators.distinct import distinct_counts, distinct_state, merge_distinct, with_exact_distinct
from dataprism.operators.histogram import merge_quantiles, quantile_state, quantiles
from dataprism.operators.merge import merge_profiles
from dataprism.operators.payload import payload_stats, profile_payload
from dataprism.operators.profile import profile
from dataprism.operators.publish import publish, read_store
from dataprism.operators.summary import QUANTILES, profile_summary
from dataprism.session import scratch_path
from dataprism.sources.sink import deliver, read_delivered
from dataprism.sources.tables import table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def _register(sql: str) -> Callable[[Query], Query]:
    def add(q: Query) -> Query:
        QUERIES[q.__name__] = q
        ORACLES[q.__name__] = sql
        return q
    return add


# --- payloads in long form ------------------------------------------------------------------------------------------

_MAP_ROWS = """
WITH e AS (SELECT event_id % 2 AS half, epoch_ms(date_trunc('day', ts)) AS b, event_type, value, user_id,
    CASE WHEN event_id % 5 = 0 THEN NULL ELSE event_type END AS seg, event_id % 3 = 0 AS odd FROM events),
g AS (SELECT half, b, seg, count(*) AS n FROM e GROUP BY 1, 2, 3),
v AS (SELECT half, b, seg, 'user' AS name, user_id::VARCHAR AS v FROM e
  UNION ALL SELECT half, b, seg, 'Kind', seg FROM e WHERE odd AND seg IS NOT NULL
  UNION ALL SELECT half, b, seg, 'kind', seg FROM e WHERE NOT odd AND seg IS NOT NULL
  UNION ALL SELECT half, b, seg, 'rare', value::INT::VARCHAR FROM e WHERE event_type = 'click' AND odd)
SELECT v.half, v.b AS dataset_timestamp, json_object('Kind', v.seg)::VARCHAR AS segment, n::BIGINT AS segment_rows, name AS "column",
  n::BIGINT AS count, (n - count(v.v))::BIGINT AS null_count, min(v.v) AS min_str, max(v.v) AS max_str,
  count(DISTINCT v.v)::BIGINT AS exact_distinct
FROM v JOIN g ON v.half = g.half AND v.b = g.b AND v.seg IS NOT DISTINCT FROM g.seg GROUP BY v.half, v.b, v.seg, n, name
"""


@_register(_MAP_ROWS)
def profile_payload_map(spark: SparkSession, d: str) -> DataFrame:
    """Map payloads segmented by a key that rows spell in two ways and some lack, in two partitions, salted, with exact
    counts."""
    ev = table(spark, d, "events")
    seg = F.when(F.col("event_id") % 5 != 0, F.col("event_type"))
    entries = F.array(
        F.struct(F.lit("DATASET_TIMESTAMP"), F.unix_millis(F.col("ts").cast("timestamp")).cast("string")),
        F.struct(F.lit("segment_columns"), F.lit(" KIND ")),
        F.struct(F.lit("user"), F.col("user_id").cast("string")),
        F.struct(F.when(F.col("event_id") % 3 == 0, F.lit("Kind")).otherwise(F.lit("kind")), seg),
        F.struct(F.lit("rare"), F.when((F.col("event_type") == "click") & (F.col("event_id") % 3 == 0),
                                       F.bround("value").cast("int").cast("string"))))
    # Absent keys are absent, not null.
    data = F.map_from_entries(F.filter(entries, lambda x: x.getField("col2").isNotNull()))
    src = ev.select((F.col("event_id") % 2).alias("half"), data.alias("data"))
    p = profile_payload(src, "data", partition_by=["half"], salt=3, exact=True, min_partitions=4)
    s = profile_summary(p, keys=["half", "dataset_timestamp", "segment", "segment_rows"], sketches=False)
    return s.select("half", "dataset_timestamp", "segment", "segment_rows", F.col("column_name").alias("column"),
                    "count", "null_count", "min_str", "max_str", F.col("distinct_exact").alias("exact_distinct"))


_WIDE = """
WITH l AS (SELECT epoch_ms(date_trunc('day', l_shipdate)) AS b, l_orderkey || '-' || l_linenumber AS id, l_quantity AS q,
    l_extendedprice AS p, l_tax AS t FROM lineitem),
v AS (SELECT b, 'q' || id AS k, q AS x FROM l UNION ALL SELECT b, 'p' || id, p FROM l UNION ALL SELECT b, 'tax', t FROM l),
n AS (SELECT b, count(*) AS n FROM l GROUP BY 1)
SELECT v.b AS dataset_timestamp, k AS "column", n::BIGINT AS segment_rows, n::BIGINT AS count,
  (n - count(*))::BIGINT AS null_count, min(x) AS min, max(x) AS max, count(*)::BIGINT AS num_n
FROM v JOIN n ON v.b = n.b GROUP BY v.b, k, n
"""


@_register(_WIDE)
def payload_unbounded_keys(spark: SparkSession, d: str) -> DataFrame:
    """Variant payloads with two keys of their own in every row (a hundred thousand and more): keys are rows, so there
    is no schema pass and no row that holds them all."""
    li = table(spark, d, "lineitem")
    own = F.concat(F.col("l_orderkey").cast("string"), F.lit("-"), F.col("l_linenumber").cast("string"))
    data = F.create_map(F.lit("DATASET_TIMESTAMP"), F.unix_millis(F.col("l_shipdate").cast("timestamp")).cast("double"),
                        F.concat(F.lit("q"), own), F.col("l_quantity"), F.concat(F.lit("p"), own),
                        F.col("l_extendedprice"), F.lit("tax"), F.col("l_tax"))
    s = payload_stats(li.select(F.to_variant_object(data).alias("data")), "data", sketches=False)
    return s.select("dataset_timestamp", "column", "segment_rows", "stats.count", "stats.null_count",
                    F.col("stats.num_min").alias("min"), F.col("stats.num_max").alias("max"), "stats.num_n")


# --- states that merge exactly --------------------------------------------------------------------------------------

_DISTINCT_COLUMNS = ["event_id", "user_id", "event_type", "value", "props", "ts"]
_DISTINCT = " UNION ALL ".join(
    f"SELECT epoch_ms(date_trunc('month', ts)) AS dataset_timestamp, json_object('event_type', event_type)::VARCHAR "
    f"AS segment, '{c}' AS \"column\", count(DISTINCT {c})::BIGINT AS direct, count(DISTINCT {c})::BIGINT AS merged, "
    f"count(DISTINCT {c})::BIGINT AS in_profile FROM events GROUP BY 1, 2" for c in _DISTINCT_COLUMNS)


@_register(_DISTINCT)
def merge_exact_distinct(spark: SparkSession, d: str) -> DataFrame:
    """Exact distinct counts of parts, merged, are those of the whole: from the state, and put into merged profiles."""
    ev = table(spark, d, "events")
    keys = ["dataset_timestamp", "segment"]
    how = {"freq": "MS", "segments": "event_type", "columns": _DISTINCT_COLUMNS}
    direct = distinct_counts(distinct_state(ev, "ts", **how), keys)
    part = F.pmod(F.xxhash64("event_id"), F.lit(7)).alias("slice")
    states = distinct_state(ev, "ts", partition_by=[part], **how)
    merged = distinct_counts(merge_distinct(states, keys), keys)
    parts = profile(ev, "ts", partition_by=[part], sketches=False, **how)
    whole = with_exact_distinct(merge_profiles(parts, keys, sketches=False), merged, keys)
    shown = profile_summary(whole, keys=keys, sketches=False).select(*keys, F.col("column_name").alias("column"),
                                                                     F.col("distinct_exact").alias("in_profile"))
    by = [*keys, "column"]
    return direct.withColumnRenamed("exact_distinct", "direct") \
        .join(merged.withColumnRenamed("exact_distinct", "merged"), by).join(shown, by)


_QUANTILE_COLUMNS = ["l_quantity", "l_extendedprice", "l_discount", "l_orderkey"]
_QUANTILES = " UNION ALL ".join(
    f"SELECT epoch_ms(date_trunc('year', l_shipdate)) AS dataset_timestamp, json_object('l_returnflag', l_returnflag)"
    f"::VARCHAR AS segment, '{c}' AS \"column\", count(*)::BIGINT AS n, true AS same_bytes, true AS within "
    f"FROM lineitem GROUP BY 1, 2" for c in _QUANTILE_COLUMNS)


@_register(_QUANTILES)
def quantiles_reproducible(spark: SparkSession, d: str) -> DataFrame:
    """Histograms of the whole and merged from two different cuts are the same bytes; all levels lie within 1 % of the
    exact quantiles."""
    li = table(spark, d, "lineitem")
    keys = ["dataset_timestamp", "segment"]
    how = {"freq": "YS", "segments": "l_returnflag", "columns": _QUANTILE_COLUMNS}
    direct = quantile_state(li, "l_shipdate", **how)

    def merged(parts: int) -> DataFrame:
        part = F.pmod(F.xxhash64("l_orderkey", F.lit(parts)), F.lit(parts)).alias("part")
        m = merge_quantiles(quantile_state(li, "l_shipdate", partition_by=[part], **how), keys)
        return m.select(*keys, "column", F.col("buckets").alias(f"b{parts}"))

    flat = li.select(F.unix_millis(F.trunc(F.col("l_shipdate").cast("date"), "year").cast("timestamp"))
                     .alias("dataset_timestamp"),
                     F.to_json(F.struct("l_returnflag")).alias("segment"),
                     F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("x"))
                                         for c in _QUANTILE_COLUMNS])).alias("e")).select(*keys, "e.*")
    exact = flat.groupBy(*keys, "column").agg(F.percentile("x", F.array(*[F.lit(q) for q in QUANTILES])).alias("exact"))
    by = [*keys, "column"]
    rows = quantiles(direct).join(merged(3), by).join(merged(8), by).join(exact, by)
    near = F.forall(F.arrays_zip("quantiles", "exact"),
                    lambda z: F.abs(z.getField("quantiles") - z.getField("exact")) <= 0.01 * F.abs(z.getField("exact")))
    return rows.select(*by, "n", ((F.col("buckets") == F.col("b3")) & (F.col("buckets") == F.col("b8")))
                       .alias("same_bytes"), near.alias("within"))


# --- commits --------------------------------------------------------------------------------------------------------

_DELIVERED = """
SELECT 'm-' || event_type AS dataset_id, epoch_ms(date_trunc('day', ts)) AS dataset_timestamp, NULL::VARCHAR AS segment,
  count(*)::BIGINT AS rows, 'Ok' AS result FROM events GROUP BY 1, 2
"""


@_register(_DELIVERED)
def sink_commit(spark: SparkSession, d: str) -> DataFrame:
    """Profiles delivered through the committing data source, with a second delivery on top, read back beside their
    receipts."""
    ev = table(spark, d, "events")
    p = profile(ev, "ts", partition_by=["event_type"], columns=["value"], serialize=True) \
        .withColumn("dataset_id", F.concat(F.lit("m-"), F.col("event_type")))
    path = scratch_path(spark, "sink")
    first = F.col("event_type") < "m"
    receipts = deliver(p.filter(first), path).unionByName(deliver(p.filter(~first), path))
    back = read_delivered(spark, path).select(
        "dataset_id", "dataset_timestamp", "segment",
        E.deserialize_profile(F.col("profile_view"))["columns"]["value"]["count"].alias("rows"))
    by = ["dataset_id", "dataset_timestamp"]
    return back.join(receipts.select(*by, "result"), by, "full")


_REPLACED = """
SELECT CASE WHEN ts < TIMESTAMP '2024-01-11' THEN 'new' ELSE 'old' END AS origin,
  epoch_ms(date_trunc('day', ts)) AS dataset_timestamp, json_object('event_type', event_type)::VARCHAR AS segment,
  (count(*) * CASE WHEN ts < TIMESTAMP '2024-01-11' THEN 2 ELSE 1 END)::BIGINT AS rows,
  3::BIGINT AS version, count(*)::BIGINT AS rows_before
FROM events GROUP BY ts < TIMESTAMP '2024-01-11', 2, 3
"""


@_register(_REPLACED)
def store_replace_atomic(spark: SparkSession, d: str) -> DataFrame:
    """Ten days of a versioned store replaced in one commit: the new version and, beside it, the one before."""
    from dataprism.operators.store import ProfileStore

    ev = table(spark, d, "events")
    early = F.col("ts") < F.lit("2024-01-11").cast("timestamp_ntz")
    path = scratch_path(spark, "store")

    def send(df: DataFrame, origin: str, **kw) -> None:
        p = profile(df, "ts", segments="event_type", columns=["value"], metadata={"origin": origin}, serialize=True)
        if publish(p, path, dataset_id="store-eu", versioned=True, **kw).filter("result IS NULL").count():
            raise RuntimeError("a delivery failed")

    send(ev.filter(~early), "old")
    send(ev.filter(early), "old")
    twice = ev.filter(early)
    send(twice.unionByName(twice), "new", replace_days=True)
    count = F.col("profile")["columns"]["value"]["count"]
    keys = ["dataset_timestamp", "segment"]
    store = ProfileStore(spark, path)
    before = store.read(2).select(*keys, count.alias("rows_before"))
    now = read_store(spark, path).select(F.col("profile")["metadata"]["origin"].alias("origin"), *keys,
                                         count.alias("rows"))
    return now.join(before, keys, "full").withColumn("version", F.lit(store.version()).cast("bigint"))


# --- calendar frequencies -------------------------------------------------------------------------------------------

def _bucket(name: str, freq: str, label: str, bins: str) -> None:
    """A query at ``freq`` per priority and its SQL: ``label`` gives a row's label (a date) from its day ``d`` and the
    partition's first day ``f``; ``bins`` the number of bins from the labels ``lo`` and ``hi``."""
    def q(spark: SparkSession, d: str) -> DataFrame:
        p = profile(table(spark, d, "orders"), "o_orderdate", freq=freq, partition_by=["o_orderpriority"],
                    columns=["o_totalprice"], one_pass=True)
        s = profile_summary(p, keys=["o_orderpriority", "dataset_timestamp", "rows_processed", "group_count"],
                            sketches=False)
        return s.select("o_orderpriority", "dataset_timestamp", "rows_processed", "group_count", "min", "max")

    q.__doc__ = f"orders bucketed at {freq!r} per priority, with the number of bins"
    QUERIES[name] = q
    ORACLES[name] = f"""
WITH o AS (SELECT o_orderpriority, o_totalprice, o_orderdate::DATE AS d,
    min(o_orderdate::DATE) OVER (PARTITION BY o_orderpriority) AS f FROM orders),
l AS (SELECT o_orderpriority, ({label})::DATE AS lab, count(*)::BIGINT AS n, min(o_totalprice) AS lo_price,
    max(o_totalprice) AS hi_price FROM o GROUP BY 1, 2),
b AS (SELECT *, min(lab) OVER (PARTITION BY o_orderpriority) AS lo, max(lab) OVER (PARTITION BY o_orderpriority) AS hi FROM l)
SELECT o_orderpriority, epoch_ms(lab::TIMESTAMP) AS dataset_timestamp, n AS rows_processed, ({bins})::BIGINT AS group_count,
  lo_price AS min, hi_price AS max FROM b
"""


_MI = "(year({0}) * 12 + month({0}) - 1)"
_MONTHS_APART = "((year(hi) - year(lo)) * 12 + month(hi) - month(lo))"
_SUNDAY = "({0} + CAST((7 - dayofweek({0})) % 7 AS INTEGER))"
_D, _F = _SUNDAY.format("d"), _SUNDAY.format("f")
_STEPS = f"({_MI.format('d')} - {_MI.format('f')})"

_bucket("bucket_2w_origin", "2W", f"{_F} + CAST(ceil(({_D} - {_F}) / 14.0) * 14 AS INTEGER)", "(hi - lo) // 14 + 1")
_bucket("bucket_business", "B", "d - CASE dayofweek(d) WHEN 6 THEN 1 WHEN 0 THEN 2 ELSE 0 END",
        "len(list_filter(generate_series(lo::TIMESTAMP, hi::TIMESTAMP, INTERVAL 1 DAY), lambda x: isodow(x) < 6))")
_bucket("bucket_semi_month", "SM",
        "CASE WHEN d = last_day(d) THEN d WHEN day(d) >= 15 THEN date_trunc('month', d) + INTERVAL 14 DAY "
        "ELSE date_trunc('month', d) - INTERVAL 1 DAY END",
        f"2 * {_MONTHS_APART} + CASE WHEN day(hi) > 15 THEN 1 ELSE 0 END - CASE WHEN day(lo) > 15 THEN 1 ELSE 0 END + 1")
_bucket("bucket_semi_month_start", "SMS",
        "date_trunc('month', d) + CASE WHEN day(d) >= 15 THEN INTERVAL 14 DAY ELSE INTERVAL 0 DAY END",
        f"2 * {_MONTHS_APART} + CASE WHEN day(hi) = 15 THEN 1 ELSE 0 END - CASE WHEN day(lo) = 15 THEN 1 ELSE 0 END + 1")
_bucket("bucket_quarter_jan", "Q-JAN",
        "last_day((date_trunc('month', d) + to_months(CAST((4 - month(d) % 3) % 3 AS INTEGER)))::DATE)",
        f"{_MONTHS_APART} // 3 + 1")
_bucket("bucket_quarter_start_feb", "QS-FEB", "date_trunc('month', d) - to_months(CAST((month(d) + 1) % 3 AS INTEGER))",
        f"{_MONTHS_APART} // 3 + 1")
_bucket("bucket_year_june", "A-JUN", "make_date(year(d) + CASE WHEN month(d) > 6 THEN 1 ELSE 0 END, 6, 30)",
        "year(hi) - year(lo) + 1")
_bucket("bucket_3ms_origin", "3MS", f"date_trunc('month', f) + to_months(CAST(floor({_STEPS} / 3.0) * 3 AS INTEGER))",
        f"{_MONTHS_APART} // 3 + 1")
_bucket("bucket_2m_origin", "2M",
        f"last_day((date_trunc('month', f) + to_months(CAST(ceil({_STEPS} / 2.0) * 2 AS INTEGER)))::DATE)",
        f"{_MONTHS_APART} // 2 + 1")


_JOINED = """
SELECT epoch_ms(date_trunc('month', o_orderdate)) AS dataset_timestamp,
  json_object('o_orderstatus', o_orderstatus)::VARCHAR AS segment,
  sum(count(*)) OVER (PARTITION BY date_trunc('month', o_orderdate))::BIGINT AS rows_processed,
  count(*)::BIGINT AS segment_rows, count(*)::BIGINT AS count, min(l_quantity) AS min, max(l_quantity) AS max
FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY date_trunc('month', o_orderdate), o_orderstatus
"""


@_register(_JOINED)
def profile_one_pass(spark: SparkSession, d: str) -> DataFrame:
    """Profiles over a join that runs once: the buckets' rows come from the profiles' own partial aggregates."""
    j = table(spark, d, "orders").join(table(spark, d, "lineitem"), F.col("o_orderkey") == F.col("l_orderkey"))
    p = profile(j, "o_orderdate", freq="MS", segments="o_orderstatus", columns=["l_quantity"], one_pass=True)
    keys = ["dataset_timestamp", "segment", "rows_processed", "segment_rows"]
    return profile_summary(p, keys=keys, sketches=False).select(*keys, "count", "min", "max")
