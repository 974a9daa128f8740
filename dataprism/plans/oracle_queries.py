"""Oracle SQL (DuckDB) for each catalogue query; keys match ``plans.catalog.QUERIES``."""

from __future__ import annotations

from dataprism.plans import state_queries
from dataprism.plans.oracle import profile_sql, stat_select
from dataprism.sources import datagen as G

DAY = "epoch_ms(date_trunc('day', ts))"


def ms(ts: str) -> str:
    """Epoch milliseconds, truncated like Spark's ``unix_millis`` (DuckDB's ``epoch_ms`` rounds)."""
    return f"(epoch_us({ts}) // 1000)"


def _ms(expr: str) -> str:
    return f"epoch_ms(({expr})::TIMESTAMP)"


def _origin_source(table: str, ts: str, key: str) -> str:
    """Rows with ``__o``: midnight (epoch ms) of the earliest row of their partition."""
    return (
        f"(SELECT t.*, epoch_ms(date_trunc('day', o.__mn)) AS __o FROM {table} t "
        f"JOIN (SELECT {key}, min({ts}) AS __mn FROM {table} GROUP BY {key}) o USING ({key}))"
    )


def _origin_bucket(ts: str, width_ms: int) -> str:
    return f"(__o + (({ms(ts)} - __o) // {width_ms}) * {width_ms})"


def _bounds(parts: list[tuple[str, str, str]]) -> str:
    """``SELECT DISTINCT <key exprs>, '<col>' AS column_name, true AS within_bound`` arms, one per column."""
    arms = []
    for table, keys, col in parts:
        arms.append(f"SELECT DISTINCT {keys}, '{col}' AS column_name, true AS within_bound FROM {table}")
    return "\nUNION ALL\n".join(arms)


def _bucket(table: str, bucket: str, columns: list[str], key: str | None = None, source: str | None = None) -> str:
    return profile_sql(source or table, table, bucket, keys=[(key, key)] if key else None, columns=columns,
                       rows_processed=True)


NULL_TYPE_EVENTS = "(SELECT * REPLACE (CASE WHEN event_id % 7 = 0 THEN NULL ELSE event_type END AS event_type) FROM events)"
NULL_TS_EVENTS = "(SELECT * REPLACE (CASE WHEN event_id % 11 = 0 THEN NULL ELSE ts END AS ts) FROM events)"
BAD_VALUE_EVENTS = (
    "(SELECT * REPLACE (CASE WHEN event_id % 7 = 0 THEN NULL WHEN event_id % 11 = 0 THEN 'NaN'::DOUBLE "
    "WHEN event_id % 13 = 0 THEN 'Infinity'::DOUBLE WHEN event_id % 17 = 0 THEN '-Infinity'::DOUBLE "
    "ELSE value END AS value, NULL::VARCHAR AS props) FROM events)"
)
EV_SEG = "json_object('event_type', event_type)::VARCHAR"


def _list(words: list[str]) -> str:
    return "[" + ", ".join(f"'{w}'" for w in words) + "]"


def employees_sql(source: str, key: str, time: str) -> str:
    """The generator's rows in SQL: one employee per row of ``source``."""
    def h(field: str) -> str:
        i = G.FIELD[field]
        return f"((({key} % {G.MOD}) * {G.MULT[i]} + {G.ADD[i]}) % {G.MOD})"

    def pick(words: list[str], x: str) -> str:
        return f"{_list(words)}[({x}) % {len(words)} + 1]"

    def digits(x: str, w: int) -> str:
        return f"lpad((({x}) % {10 ** w})::VARCHAR, {w}, '0')"

    first = pick(G.FIRST_NAMES, h("name"))
    last = pick(G.LAST_NAMES, f"{h('name')} // {len(G.FIRST_NAMES)}")
    return (
        f"SELECT {first} || ' ' || {last} AS name, "
        f"({G.SALARY_MIN} + {h('salary')} % {G.SALARY_MAX - G.SALARY_MIN + 1})::BIGINT AS salary, "
        f"{pick(G.JOBS, h('job'))} AS job, {pick(G.STATES, h('state'))} AS state, "
        f"lower({first}) || '.' || lower({last}) || {key}::VARCHAR || '@example.com' AS email, "
        f"{digits(h('phone'), 3)} || '-' || {digits(h('phone') + ' // 1000', 3)} || '-' || {digits(key, 4)} AS phone, "
        f"strftime(DATE '{G.DOB_ORIGIN}' + ({h('dob')} % {G.DOB_SPAN_DAYS})::INTEGER, '%Y-%m-%d') AS dob, "
        f"(100 + {h('ssn')} % 900)::VARCHAR || '-' || {digits(h('ssn') + ' // 900', 2)} || '-' || {digits(key, 4)} AS ssn, "
        f"{time} AS hire_date, ({h('years_xp')} % {G.YEARS_XP_MAX + 1})::BIGINT AS years_xp "
        f"FROM {source}"
    )


def oracle_queries() -> dict[str, str]:
    q: dict[str, str] = {}
    q["profile_daily"] = profile_sql("events", "events", DAY, segment_col=True, rows_processed=True)
    q["profile_daily_segmented"] = profile_sql(
        "events", "events", DAY, keys=[("day", DAY)], segments=["event_type"], segment_col=True,
        rows_processed=True, segment_rows=True)
    q["profile_day_state"] = profile_sql(
        "events", "events", DAY, keys=[("day", DAY), ("event_type", "event_type")], segments=["event_type"],
        segment_col=True, rows_processed=True)
    q["profile_two_segments"] = profile_sql(
        "lineitem", "lineitem", "epoch_ms(date_trunc('month', l_shipdate))", segments=["l_returnflag", "l_linestatus"],
        segment_col=True, segment_partition=True, rows_processed=True, segment_rows=True)
    q["profile_column_chunks"] = profile_sql(
        "lineitem", "lineitem", "epoch_ms(date_trunc('quarter', l_shipdate))", keys=[("l_returnflag", "l_returnflag")],
        segments=["l_linestatus"], segment_col=True, rows_processed=True, segment_rows=True)
    q["profile_partition_nonkey"] = profile_sql(
        "events", "events", DAY, keys=[("day", DAY), ("event_type", "NULL::VARCHAR")], columns=["value"],
        rows_processed=True)
    q["profile_null_segment"] = profile_sql(
        NULL_TYPE_EVENTS, "events", DAY, segments=["event_type"], columns=["event_type", "value"], segment_col=True,
        rows_processed=True, segment_rows=True)

    q["bucket_hour"] = _bucket("events", "epoch_ms(date_trunc('hour', ts))", ["value", "user_id"])
    q["bucket_15min"] = _bucket("events", f"({ms('ts')} // 900000) * 900000", ["value"])
    q["bucket_6h"] = _bucket("events", f"({ms('ts')} // 21600000) * 21600000", ["value", "event_type"])
    od = "o_orderdate"
    q["bucket_week_end"] = _bucket("orders", f"epoch_ms(date_trunc('week', {od}) + INTERVAL 6 DAY)",
                                   ["o_totalprice", "o_orderstatus"])
    q["bucket_week_mon"] = _bucket("orders", _ms(f"{od}::DATE + ((1 - dayofweek({od}) + 7) % 7)::INTEGER"),
                                   ["o_totalprice", "o_orderstatus"])
    q["bucket_month_end"] = _bucket("orders", _ms(f"last_day({od})"), ["o_totalprice", "o_orderpriority"])
    q["bucket_month_start"] = _bucket("orders", f"epoch_ms(date_trunc('month', {od}))",
                                      ["o_totalprice", "o_orderpriority"])
    q["bucket_quarter_end"] = _bucket(
        "orders", f"epoch_ms(date_trunc('quarter', {od}) + INTERVAL 3 MONTH - INTERVAL 1 DAY)",
        ["o_totalprice", "o_orderdate"])
    q["bucket_quarter_start"] = _bucket("orders", f"epoch_ms(date_trunc('quarter', {od}))",
                                        ["o_totalprice", "o_orderdate"])
    q["bucket_year_end"] = _bucket("orders", _ms(f"make_date(year({od}), 12, 31)"), ["o_totalprice", "o_custkey"])
    q["bucket_year_start"] = _bucket("orders", f"epoch_ms(date_trunc('year', {od}))", ["o_totalprice", "o_custkey"])
    q["bucket_5d_origin"] = _bucket("events", _origin_bucket("ts", 5 * 86_400_000), ["value", "user_id"],
                                    key="event_type", source=_origin_source("events", "ts", "event_type"))
    q["bucket_7h_origin"] = _bucket("events", _origin_bucket("ts", 7 * 3_600_000), ["value"],
                                    key="event_type", source=_origin_source("events", "ts", "event_type"))
    q["bucket_36h_origin"] = _bucket("lineitem", _origin_bucket("l_shipdate", 36 * 3_600_000), ["l_quantity"],
                                     key="l_returnflag", source=_origin_source("lineitem", "l_shipdate", "l_returnflag"))
    q["bucket_group_count"] = (
        "WITH b AS (SELECT o_orderpriority, epoch_ms(date_trunc('day', o_orderdate)) AS dataset_timestamp, "
        "count(*)::BIGINT AS rows_processed FROM orders GROUP BY 1, 2) "
        "SELECT o_orderpriority, dataset_timestamp, rows_processed, "
        "((max(dataset_timestamp) OVER (PARTITION BY o_orderpriority) - "
        "min(dataset_timestamp) OVER (PARTITION BY o_orderpriority)) // 86400000 + 1)::BIGINT AS group_count FROM b"
    )

    day_of = "date_trunc('day', ts)"
    q["filter_day_eq"] = profile_sql(
        "events", "events", DAY, keys=[("day", DAY), ("event_type", "event_type")], segments=["event_type"],
        segment_col=True, rows_processed=True, where=f"{day_of} = TIMESTAMP '2024-01-03'")
    q["filter_day_half_open"] = profile_sql(
        "events", "events", DAY, keys=[("day", DAY)], rows_processed=True,
        where=f"{day_of} <= TIMESTAMP '2024-01-03' AND {day_of} > TIMESTAMP '2024-01-01'")
    q["filter_day_closed"] = profile_sql(
        "events", "events", DAY, keys=[("day", DAY), ("event_type", "event_type"), ("salt", "event_id % 10")],
        segments=["event_type"], columns=["value", "user_id"], segment_col=True, rows_processed=True,
        where=f"{day_of} >= TIMESTAMP '2024-01-20' AND {day_of} <= TIMESTAMP '2024-01-22'")
    q["filter_day_and_key"] = (
        f"SELECT count(1)::BIGINT AS n FROM events WHERE {day_of} = TIMESTAMP '2024-01-03' AND event_type = 'click'"
    )
    q["count_all"] = "SELECT count(1)::BIGINT AS n FROM lineitem"

    q["null_ts_dropped"] = profile_sql(NULL_TS_EVENTS, "events", DAY, columns=["event_id", "ts", "value"],
                                       rows_processed=True, where="ts IS NOT NULL")
    q["stats_null_nan"] = profile_sql(BAD_VALUE_EVENTS, "events", DAY, segments=["event_type"],
                                      columns=["value", "props"], segment_col=True)
    q["stats_moments"] = profile_sql(
        "lineitem", "lineitem", "epoch_ms(date_trunc('year', l_shipdate))", segments=["l_returnflag"],
        columns=["l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linenumber"], segment_col=True,
        segment_rows=True)
    q["stats_strings"] = profile_sql(
        "customer", "customer", "epoch_ms(TIMESTAMP '2024-01-01')", segments=["c_mktsegment"],
        columns=["c_name", "c_mktsegment", "c_acctbal", "c_nationkey"], segment_col=True)
    q["stats_temporal"] = profile_sql(
        "orders", "orders", "epoch_ms(date_trunc('year', o_orderdate))", segments=["o_orderstatus"],
        columns=["o_orderdate", "o_orderstatus"], segment_col=True)
    snap = "epoch_ms(TIMESTAMP '2024-01-01')"
    q["profile_documents"] = profile_sql("documents", "documents", snap, segments=["lang", "source"], segment_col=True,
                                         rows_processed=True, segment_rows=True)
    q["profile_conversations"] = profile_sql(
        "conversations", "conversations", snap, keys=[("role", "role")], segments=["turn"],
        columns=["conv_id", "turn", "text"], segment_col=True, rows_processed=True, segment_rows=True)
    q["type_counts"] = profile_sql("events", "events", "epoch_ms(date_trunc('week', ts) + INTERVAL 6 DAY)",
                                   type_counts=True)
    yr = "epoch_ms(date_trunc('year', l_shipdate))"
    q["stats_exact_distinct"] = "\nUNION ALL\n".join(
        f"SELECT {yr} AS dataset_timestamp, '{c}' AS column_name, count(*)::BIGINT AS count, "
        f"count(DISTINCT {c})::BIGINT AS distinct_exact FROM lineitem GROUP BY 1"
        for c in ["l_orderkey", "l_partkey", "l_quantity", "l_returnflag", "l_shipdate"]
    )

    li_keys = f"{yr} AS dataset_timestamp, json_object('l_returnflag', l_returnflag)::VARCHAR AS segment"
    q["kll_within_bound"] = _bounds([("lineitem", li_keys, c) for c in ["l_quantity", "l_extendedprice", "l_discount"]])
    ev_keys = f"{DAY} AS dataset_timestamp, {EV_SEG} AS segment"
    q["hll_within_bound"] = _bounds([("events", ev_keys, c) for c in ["event_id", "user_id", "value", "props"]])
    q["topk_within_bound"] = _bounds([("events", f"{DAY} AS dataset_timestamp", c) for c in ["event_type", "props"]])

    q["salted_merge_equals_direct"] = profile_sql(
        "events", "events", DAY, segments=["event_type"], columns=["value", "user_id", "props"], segment_col=True,
        segment_rows=True)
    q["salted_profile"] = profile_sql(
        "lineitem", "lineitem", yr, segments=["l_returnflag", "l_linestatus"], segment_col=True, rows_processed=True,
        segment_rows=True)
    q["segment_json_roundtrip"] = (
        f"SELECT {DAY} AS dataset_timestamp, {EV_SEG} AS segment, event_type, count(*)::BIGINT AS segment_rows "
        "FROM events GROUP BY ALL"
    )
    q["envelope_roundtrip"] = profile_sql("events", "events", DAY, segments=["event_type"], segment_col=True)
    q["summary_all_stats"] = profile_sql(
        "orders", "orders", "epoch_ms(date_trunc('month', o_orderdate))", segments=["o_orderstatus"],
        segment_col=True, rows_processed=True, type_counts=True)
    q["epoch_ms_roundtrip"] = (
        f"SELECT event_id, {ms('ts')} AS ts_ms, true AS roundtrip_ok, {DAY} AS day_ms FROM events"
    )

    q["profile_payload_variant"] = profile_sql(
        "events", "events", DAY, keys=[("day", DAY)], segments=["event_type"], segment_col=True, rows_processed=True)
    week_or_day = (f"CASE WHEN event_type IN ('click', 'view') THEN epoch_ms(date_trunc('week', ts) + INTERVAL 6 DAY) "
                   f"ELSE {DAY} END")
    q["profile_payload_config"] = profile_sql("events", "events", week_or_day, keys=[("event_type", "event_type")],
                                              rows_processed=True)

    emp = employees_sql("events", "event_id", "ts")
    q["datagen_employees"] = (
        "SELECT name, salary, job, state, email, phone, dob, ssn, epoch_us(hire_date) AS hire_date_us, years_xp "
        f"FROM ({emp})"
    )
    amplified = f"(SELECT e.*, unnest(range(8)) AS __copy FROM ({emp}) e)"
    q["datagen_amplified"] = profile_sql(
        amplified, "employees", "epoch_ms(date_trunc('day', hire_date))", segments=["state"],
        columns=["salary", "years_xp", "hire_date"], segment_col=True, segment_rows=True)

    damaged = "dayofmonth(date_trunc('day', ts)) % 5 = 0"
    bad_view = f"'corrupt:' || {EV_SEG}"
    err = (f"'Error uploading: profile payload could not be decoded (' || length({bad_view}) || "
           f"' characters, md5 ' || md5({bad_view}) || ')'")
    ts_ms = f"CASE WHEN {damaged} THEN -1 ELSE {DAY} END"
    q["publish_receipts"] = (
        f"SELECT 'store-eu' AS dataset_id, CASE WHEN {damaged} THEN NULL ELSE 'Ok' END AS result, "
        f"CASE WHEN {damaged} THEN {err} END AS error, ({ts_ms})::BIGINT AS dataset_timestamp, "
        f"CASE WHEN {damaged} THEN 'Error' ELSE {EV_SEG} END AS segment, "
        f"strftime(make_timestamp(({ts_ms}) * 1000), '%Y-%m-%d %H:%M:%S.%g') AS receipt_time "
        "FROM events GROUP BY date_trunc('day', ts), event_type"
    )
    q["publish_store_readback"] = profile_sql("events", "events", DAY, keys=[("dataset_id", "'m-' || event_type")],
                                              segment_col=True)
    bad_id = "'Error uploading: ValueError: invalid dataset id ' || chr(39) || chr(39)"
    q["publish_writer_receipts"] = (
        "SELECT CASE WHEN event_type = 'click' THEN '' ELSE 'm-' || event_type END AS dataset_id, "
        "CASE WHEN event_type = 'click' THEN NULL ELSE 'Ok' END AS result, "
        f"CASE WHEN event_type = 'click' THEN {bad_id} END AS error, "
        f"{DAY} AS dataset_timestamp, NULL::VARCHAR AS segment FROM events GROUP BY event_type, {DAY}"
    )
    q["sql_cte_receipts"] = (
        f"SELECT 'store-eu' AS dataset_id, 'Ok' AS result, NULL::VARCHAR AS error, {DAY} AS dataset_timestamp, "
        "strftime(date_trunc('day', ts), '%Y-%m-%d %H:%M:%S') AS receipt_time, NULL::VARCHAR AS segment "
        "FROM events WHERE date_trunc('day', ts) <= TIMESTAMP '2024-01-03' AND date_trunc('day', ts) > TIMESTAMP '2024-01-01' "
        "GROUP BY date_trunc('day', ts)"
    )
    q["topk_within_bound"] = _bounds([("events", f"{DAY} AS dataset_timestamp", c)
                                      for c in ["event_type", "props", "hour", "day"]])
    q["filter_redundant"] = profile_sql(
        "events", "events", DAY, columns=["value", "event_type"], rows_processed=True,
        where=f"{day_of} = TIMESTAMP '2024-01-03' AND {day_of} > TIMESTAMP '2024-01-01' AND {day_of} <= TIMESTAMP '2024-01-03'")
    q["bucket_97min_origin"] = _bucket("events", _origin_bucket("ts", 97 * 60_000), ["value"], key="event_type",
                                       source=_origin_source("events", "ts", "event_type"))
    q["merge_schema_change"] = (
        f"WITH e AS (SELECT *, {DAY} AS t FROM events) "
        "SELECT t AS dataset_timestamp, (2 * count(*))::BIGINT AS segment_rows, 'old' AS origin, 'value' AS column_name, "
        "count(*)::BIGINT AS count, count(*) FILTER (WHERE value IS NULL)::BIGINT AS null_count, min(value) AS min, "
        "max(value) AS max, round(avg(value) * (1 + 1e-12), 4) AS mean, round(stddev_samp(value) * (1 + 1e-12), 4) AS stddev "
        "FROM e GROUP BY t UNION ALL "
        "SELECT t, (2 * count(*))::BIGINT, 'old', 'props', count(*) FILTER (WHERE event_id % 3 <> 0)::BIGINT, "
        "count(*) FILTER (WHERE event_id % 3 <> 0 AND props IS NULL)::BIGINT, NULL, NULL, NULL, NULL FROM e GROUP BY t")
    wide = "(-l_orderkey::DECIMAL(38,4) - 123456789012345678901234567.8901::DECIMAL(38,4))"
    q["stats_big_integers"] = " UNION ALL ".join(
        f"SELECT epoch_ms(date_trunc('year', l_shipdate)) AS dataset_timestamp, "
        f"json_object('l_returnflag', l_returnflag)::VARCHAR AS segment, '{n}' AS column_name, "
        f"min({x})::VARCHAR AS min_exact, max({x})::VARCHAR AS max_exact FROM lineitem GROUP BY ALL"
        for n, x in (("big", "(1152921504606846977 + l_orderkey)"), ("low", "(-1152921504606846977 - l_orderkey)"),
                     ("wide", wide)))
    q["profile_odd_names"] = " UNION ALL ".join(
        f"SELECT event_type, {DAY} AS dataset_timestamp, json_object('a.b', event_type)::VARCHAR AS segment, "
        f"{n} AS column_name, count(*)::BIGINT AS count, min({c})::DOUBLE AS min, max({c})::DOUBLE AS max "
        "FROM events GROUP BY ALL" for n, c in (("'it''s `x`'", "value"), ("'user id'", "user_id")))
    ltz = "(SELECT ts, ts AS at, value FROM events)"
    arms = []
    for col, cls, kind in (("value", "F", "double"), ("at", "T", "timestamp")):
        arms.append(f"SELECT {DAY} AS dataset_timestamp, count(*)::BIGINT AS rows_processed, "
                    f"{stat_select(col, cls, kind)} FROM {ltz} GROUP BY {DAY}")
    q["profile_ltz"] = (f"SELECT s.*, z.zone FROM ({' UNION ALL '.join(arms)}) s, "
                        "(SELECT unnest(['America/Los_Angeles', 'Asia/Tokyo']) AS zone) z")
    q["segment_timestamp"] = (
        "SELECT epoch_ms(date_trunc('month', ts)) AS dataset_timestamp, "
        "'{\"at\":\"2024-01-01T00:00:00.00000' || (event_id % 3) || '\"}' AS segment, count(*)::BIGINT AS segment_rows "
        "FROM events GROUP BY ALL")
    late = "(253402300799999999 - 1 - event_id % 5)"
    first_day = "(datediff('day', DATE '1970-01-01', DATE '0001-01-02'))"
    q["epoch_ms_far"] = (
        f"SELECT event_id, ({late} // 1000)::BIGINT AS late_ms, (253402300799999999 // 86400000000 * 86400000)::BIGINT "
        f"AS late_day, ({first_day} * 86400000)::BIGINT AS early_ms, {first_day}::BIGINT AS early_day FROM events")
    levels = "[0.0, 0.01, 0.25, 0.5, 0.75, 0.99, 1.0]"
    q["stats_exact_quantiles"] = " UNION ALL ".join(
        f"SELECT l_returnflag, '{c}' AS column_name, " + ", ".join(
            f"round(quantile_cont({c}, {levels})[{i + 1}] * (1 + 1e-12), 4) AS q{i}" for i in range(7))
        + " FROM lineitem GROUP BY 1" for c in ("l_quantity", "l_extendedprice", "l_discount"))
    q["debug_texts"] = (
        f"WITH b AS (SELECT event_type, {DAY} AS dataset_timestamp FROM events GROUP BY ALL) "
        "SELECT *, 'group_count: ' || ((max(dataset_timestamp) OVER (PARTITION BY event_type) - min(dataset_timestamp) "
        "OVER (PARTITION BY event_type)) // 86400000 + 1) || chr(10) || 'segment_key: ' || "
        "json_object('event_type', event_type)::VARCHAR AS debug_info FROM b")
    week_click = f"CASE WHEN event_type = 'click' THEN epoch_ms(date_trunc('week', ts) + INTERVAL 6 DAY) ELSE {DAY} END"
    seg_some = f"CASE WHEN event_type IN ('click', 'view') THEN {EV_SEG} END"
    q["payload_config_empty"] = "WITH r AS (" + profile_sql(
        "events", "events", week_click, keys=[("event_type", "event_type")], columns=["value", "user_id"],
        rows_processed=True) + f") SELECT r.*, {seg_some} AS segment FROM r"
    kind = "event_id % 5"
    n = "count(*) FILTER (WHERE {})::BIGINT"
    q["type_counts_variant"] = (
        f"SELECT {DAY} AS dataset_timestamp, 'v' AS column_name, count(*)::BIGINT AS count, "
        f"{n.format(f'{kind} = 4 OR ({kind} = 2 AND value IS NULL)')} AS null_count, {n.format(f'{kind} = 0')} AS n_integral, "
        f"{n.format(f'{kind} = 2 AND value IS NOT NULL')} AS n_fractional, {n.format(f'{kind} = 3')} AS n_boolean, "
        f"{n.format(f'{kind} = 1')} AS n_string, 0::BIGINT AS n_temporal, 0::BIGINT AS n_other, "
        f"min(CASE {kind} WHEN 0 THEN user_id::DOUBLE WHEN 2 THEN value END) AS min, "
        f"max(CASE {kind} WHEN 0 THEN user_id::DOUBLE WHEN 2 THEN value END) AS max, "
        f"min(event_type) FILTER (WHERE {kind} = 1) AS min_str, max(event_type) FILTER (WHERE {kind} = 1) AS max_str "
        f"FROM events GROUP BY {DAY}")
    q["table_replace"] = (f"SELECT state, count(*)::BIGINT AS n, sum(salary)::BIGINT AS salary FROM "
                          f"({employees_sql('(SELECT * FROM events WHERE event_id % 2 = 0)', 'event_id', 'ts')}) GROUP BY 1")
    fails = {"click": "segment has no segment partition", "view": "segment does not match its segment partition",
             "purchase": "dataset id is missing"}
    bad = "event_type IN (" + ", ".join(f"'{k}'" for k in fails) + ")"
    q["publish_bad_payload"] = (
        "SELECT CASE WHEN event_type <> 'purchase' THEN 'store-eu' END AS dataset_id, "
        f"CASE WHEN NOT {bad} THEN 'Ok' END AS result, CASE event_type "
        + " ".join(f"WHEN '{k}' THEN 'Error uploading: {v}'" for k, v in fails.items())
        + f" END AS error, CASE WHEN {bad} THEN -1 ELSE {DAY} END AS dataset_timestamp, "
        f"CASE WHEN {bad} THEN 'Error' ELSE json_object('kind, raw', event_type)::VARCHAR END AS segment "
        f"FROM (SELECT DISTINCT event_type, date_trunc('day', ts) AS ts FROM events)")
    q["writer_partials"] = (
        f"WITH e AS (SELECT *, {DAY} AS t FROM events), "
        "k AS (SELECT count(*)::BIGINT AS n FROM (SELECT DISTINCT t, event_type, event_id % 10 AS s FROM e)) "
        "SELECT t AS dataset_timestamp, 'value' AS column_name, count(*)::BIGINT AS count, min(value) AS min, "
        "max(value) AS max, round(avg(value) * (1 + 1e-12), 4) AS mean, (SELECT n FROM k) AS files, "
        "(SELECT n FROM k) AS receipts FROM e GROUP BY t")
    for enc in ("base64", "raw"):
        q[f"profile_files_{enc}"] = profile_sql("events", "events", DAY, keys=[("dataset_id", "'m-' || event_type")])
    return {**q, **state_queries.ORACLES}
