"""DuckDB oracle SQL for the query catalogue.

Each query of ``plans.catalog`` has here an independent formulation in plain SQL over the same tables (views named
like the tables). Profiles are compared through their exact statistics: one row per (profile, column) with counts,
extrema, rounded mean/stddev and string lengths; bucket labels and timestamps as epoch numbers so no timestamp type
can differ between engines. The per-column statistics are written once per column as a ``UNION ALL`` arm; the text
is generated from the table schemas below.
"""

from __future__ import annotations

# Type class and Spark type name of every test-table column used by the catalogue.
SCHEMAS: dict[str, list[tuple[str, str, str]]] = {
    "events": [
        ("event_id", "I", "bigint"),
        ("ts", "T", "timestamp_ntz"),
        ("user_id", "I", "bigint"),
        ("event_type", "S", "string"),
        ("value", "F", "double"),
        ("props", "S", "string"),
    ],
    "orders": [
        ("o_orderkey", "I", "bigint"),
        ("o_custkey", "I", "bigint"),
        ("o_orderstatus", "S", "string"),
        ("o_totalprice", "F", "double"),
        ("o_orderdate", "T", "timestamp_ntz"),
        ("o_orderpriority", "S", "string"),
    ],
    "lineitem": [
        ("l_orderkey", "I", "bigint"),
        ("l_partkey", "I", "bigint"),
        ("l_suppkey", "I", "bigint"),
        ("l_linenumber", "I", "int"),
        ("l_quantity", "F", "double"),
        ("l_extendedprice", "F", "double"),
        ("l_discount", "F", "double"),
        ("l_tax", "F", "double"),
        ("l_returnflag", "S", "string"),
        ("l_linestatus", "S", "string"),
        ("l_shipdate", "T", "timestamp_ntz"),
    ],
    "employees": [
        ("name", "S", "string"),
        ("salary", "I", "bigint"),
        ("job", "S", "string"),
        ("state", "S", "string"),
        ("email", "S", "string"),
        ("phone", "S", "string"),
        ("dob", "S", "string"),
        ("ssn", "S", "string"),
        ("hire_date", "T", "timestamp_ntz"),
        ("years_xp", "I", "bigint"),
    ],
    "documents": [
        ("doc_id", "I", "bigint"),
        ("text", "S", "string"),
        ("lang", "S", "string"),
        ("source", "S", "string"),
        ("n_chars", "I", "bigint"),
    ],
    "conversations": [
        ("conv_id", "I", "bigint"),
        ("turn", "I", "bigint"),
        ("role", "S", "string"),
        ("text", "S", "string"),
    ],
    "customer": [
        ("c_custkey", "I", "bigint"),
        ("c_name", "S", "string"),
        ("c_nationkey", "I", "int"),
        ("c_acctbal", "F", "double"),
        ("c_mktsegment", "S", "string"),
    ],
}


def columns_of(table: str, names: list[str] | None = None) -> list[tuple[str, str, str]]:
    cols = SCHEMAS[table]
    if names is None:
        return cols
    by = {c[0]: c for c in cols}
    return [by[n] for n in names]


def r4(expr: str) -> str:
    """Rounding matched to ``catalog.stable_round``."""
    return f"round(({expr}) * (1 + 1e-12), 4)"


def stat_select(col: str, cls: str, spark_type: str, type_counts: bool = False) -> str:
    """Exact statistics of one column as SELECT items (names match ``catalog.exact_summary``)."""
    c = f'"{col}"'
    nullc = f"count(*) FILTER (WHERE {c} IS NULL)::BIGINT"
    parts = [f"'{col}' AS column_name", f"'{spark_type}' AS column_type", "count(*)::BIGINT AS count",
             f"{nullc} AS null_count"]
    if cls == "F":
        parts += [
            f"count(*) FILTER (WHERE isnan({c}))::BIGINT AS nan_count",
            f"count(*) FILTER (WHERE isinf({c}))::BIGINT AS inf_count",
            f"min({c}) FILTER (WHERE NOT isnan({c}))::DOUBLE AS min",
            f"max({c}) FILTER (WHERE NOT isnan({c}))::DOUBLE AS max",
            f"{r4(f'avg({c}) FILTER (WHERE isfinite({c}))')} AS mean",
            f"{r4(f'stddev_samp({c}) FILTER (WHERE isfinite({c}))')} AS stddev",
        ]
    elif cls == "I":
        parts += [
            "0::BIGINT AS nan_count", "0::BIGINT AS inf_count",
            f"min({c})::DOUBLE AS min", f"max({c})::DOUBLE AS max",
            f"{r4(f'avg({c}::DOUBLE)')} AS mean", f"{r4(f'stddev_samp({c}::DOUBLE)')} AS stddev",
        ]
    else:
        parts += ["0::BIGINT AS nan_count", "0::BIGINT AS inf_count", "NULL::DOUBLE AS min", "NULL::DOUBLE AS max",
                  "NULL::DOUBLE AS mean", "NULL::DOUBLE AS stddev"]
    if cls == "S":
        parts += [
            f"min({c}) AS min_str", f"max({c}) AS max_str",
            f"min(length({c}))::BIGINT AS min_len", f"max(length({c}))::BIGINT AS max_len",
            f"{r4(f'avg(length({c}))')} AS mean_len",
        ]
    else:
        parts += ["NULL::VARCHAR AS min_str", "NULL::VARCHAR AS max_str", "NULL::BIGINT AS min_len",
                  "NULL::BIGINT AS max_len", "NULL::DOUBLE AS mean_len"]
    if cls == "T":
        parts += [f"epoch_us(min({c}))::BIGINT AS min_ts_us", f"epoch_us(max({c}))::BIGINT AS max_ts_us"]
    else:
        parts += ["NULL::BIGINT AS min_ts_us", "NULL::BIGINT AS max_ts_us"]
    if type_counts:
        nonnull = f"count({c})::BIGINT"
        for k, name in (("I", "n_integral"), ("F", "n_fractional"), ("B", "n_boolean"), ("S", "n_string"),
                        ("T", "n_temporal"), ("O", "n_other")):
            parts.append(f"{nonnull if k == cls else '0::BIGINT'} AS {name}")
    return ", ".join(parts)


def profile_sql(source: str, table: str, bucket: str, *, keys: list[tuple[str, str]] | None = None,
                segments: list[str] | None = None, columns: list[str] | None = None, segment_col: bool = False,
                segment_partition: bool = False, rows_processed: bool = False, segment_rows: bool = False,
                type_counts: bool = False, where: str | None = None) -> str:
    """Exact-statistics oracle of a profile.

    ``source`` is a relation (table name or parenthesised subquery) with the columns of ``table``; ``bucket`` a SQL
    expression giving the bucket label as epoch milliseconds; ``keys`` (output name, SQL expression) the partition
    keys; ``segments`` the segment column names. The flags add the optional output columns.
    """
    keys = keys or []
    segments = segments or []
    seg = ("json_object(" + ", ".join(f"'{s}', \"{s}\"" for s in segments) + ")::VARCHAR") if segments else "NULL::VARCHAR"
    inner = (
        f"SELECT *, {bucket} AS __b, {seg} AS __seg"
        + "".join(f", {expr} AS __k_{name}" for name, expr in keys)
        + f" FROM {source}"
        + (f" WHERE {where}" if where else "")
    )
    group = ["__b", "__seg"] + [f"__k_{name}" for name, _ in keys]
    part = ", ".join(["__b"] + [f"__k_{name}" for name, _ in keys])
    arms = []
    for col, cls, st in columns_of(table, columns):
        items = [f"__k_{name} AS {name}" for name, _ in keys] + ["__b AS dataset_timestamp"]
        if segment_col:
            items.append("__seg AS segment")
        if segment_partition:
            items.append(f"'{','.join(segments)}' AS segment_partition")
        if rows_processed:
            items.append(f"sum(count(*)) OVER (PARTITION BY {part})::BIGINT AS rows_processed")
        if segment_rows:
            items.append("count(*)::BIGINT AS segment_rows")
        items.append(stat_select(col, cls, st, type_counts))
        arms.append(f"SELECT {', '.join(items)} FROM src GROUP BY {', '.join(group)}")
    return f"WITH src AS ({inner})\n" + "\nUNION ALL\n".join(arms)
