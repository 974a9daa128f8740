"""Per-column statistics as aggregate expressions.

Every profiled column gets one struct of type ``STATS_TYPE``; all statistics are *mergeable*: counts add, extrema
take min/max, moments are kept as (n, mean, M2) and combined with Chan et al.'s pairwise formula, and the three
sketches (KLL quantiles, HyperLogLog distinct count, frequent items) have merge aggregates of their own. So one
``agg`` computes profiles of any group, and ``merge_stats`` combines profiles of sub-groups into the profile of their
union without touching the rows again.

Statistics by declared type class:

============  ======================================================================================
all           count, null_count, type counts, distinct sketch (not for nested types)
integral      numeric min/max/moments, exact bigint min/max, KLL, frequent items
fractional    NaN / ±Inf counts, numeric min/max over non-NaN, moments over finite values, KLL; exact min/max of
              decimals
boolean       frequent items
string        min/max (binary order), length min/max/sum, frequent items (texts over ``LONG_ITEM`` characters as
              their hash, so that a sketch never holds whole documents)
binary        length min/max/sum, frequent items of the hex text
temporal      min/max as timestamp_ntz in UTC, frequent items
variant       each value counts under its own type; numbers, strings and frequent items as above
other         counts only (arrays, maps, structs, intervals)
============  ======================================================================================
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Frequent-items sketch capacity: each partial keeps at most this many counters per column.
DEFAULT_TOPK_CAPACITY = 256
# KLL accuracy parameter (DataSketches default); normalized rank error about 1.65 % at k=200.
DEFAULT_KLL_K = 200
# Longer texts are frequent items by hash.
LONG_ITEM = 256

TOPK_STATE_TYPE = T.StructType(
    [
        T.StructField("sketch", T.BinaryType(), False),
        T.StructField("maxItemsTracked", T.IntegerType(), False),
        T.StructField("itemDataType", T.StringType(), True),
        T.StructField("itemDataTypeDDL", T.StringType(), False),
    ]
)

STATS_FIELDS: list[tuple[str, T.DataType]] = [
    ("col_type", T.StringType()),
    ("count", T.LongType()),
    ("null_count", T.LongType()),
    ("nan_count", T.LongType()),
    ("inf_count", T.LongType()),
    ("n_integral", T.LongType()),
    ("n_fractional", T.LongType()),
    ("n_boolean", T.LongType()),
    ("n_string", T.LongType()),
    ("n_temporal", T.LongType()),
    ("n_other", T.LongType()),
    ("num_min", T.DoubleType()),
    ("num_max", T.DoubleType()),
    ("num_n", T.LongType()),
    ("num_mean", T.DoubleType()),
    ("num_m2", T.DoubleType()),
    ("str_min", T.StringType()),
    ("str_max", T.StringType()),
    ("ts_min", T.TimestampNTZType()),
    ("ts_max", T.TimestampNTZType()),
    ("len_min", T.LongType()),
    ("len_max", T.LongType()),
    ("len_sum", T.LongType()),
    ("kll", T.BinaryType()),
    ("hll", T.BinaryType()),
    ("topk", TOPK_STATE_TYPE),
    ("exact_distinct", T.LongType()),
    # Exact extrema beyond the 53 bits of a double: integers, and unscaled values of decimals (scale: col_type).
    ("int_min", T.LongType()),
    ("int_max", T.LongType()),
    ("dec_min", T.DecimalType(38, 0)),
    ("dec_max", T.DecimalType(38, 0)),
]

STATS_TYPE = T.StructType([T.StructField(n, t, True) for n, t in STATS_FIELDS])
STATS_DDL = STATS_TYPE.simpleString()

TYPE_CLASSES = ("integral", "fractional", "boolean", "string", "temporal", "other")


def type_class(dt: T.DataType) -> str:
    """Type class of a declared Spark type."""
    if isinstance(dt, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return "integral"
    if isinstance(dt, (T.FloatType, T.DoubleType, T.DecimalType)):
        return "fractional"
    if isinstance(dt, T.BooleanType):
        return "boolean"
    if isinstance(dt, (T.StringType, T.VarcharType, T.CharType)):
        return "string"
    if isinstance(dt, T.BinaryType):
        return "binary"
    if isinstance(dt, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return "temporal"
    if isinstance(dt, T.VariantType):
        return "variant"
    return "other"


_FIELD_DDL = {n: t.simpleString() for n, t in STATS_FIELDS}

# The one expression of every field, per type class, in Spark SQL. ``{c}`` is the column, ``{x}`` its
# double value, ``{o}`` the value with NaN removed (ordered), ``{f}`` the finite value.
_INF = "CAST('Infinity' AS DOUBLE)"
_EPOCH = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def _null_sql(field: str) -> str:
    return f"CAST(NULL AS {_FIELD_DDL[field]})"


def column_stats_sql(name: str, dt: T.DataType, *, topk_capacity: int = DEFAULT_TOPK_CAPACITY,
                     sketches: bool = True, present: str | None = None, parts: dict[str, str] | None = None) -> str:
    """SQL text of the aggregate expression giving the ``STATS_TYPE`` struct of column ``name`` over a group.

    Built as text so a column costs one call into the JVM, whatever the number of statistics. ``present``: SQL text
    that tells whether the row had a value before it was cast to ``dt``; a value that did not cast counts under
    ``n_other``, not as a null. ``parts``: names of columns that hold a variant's ``variant_parts``, which every
    statistic otherwise takes from the variant by itself.
    """
    cls = type_class(dt)
    c = f"`{name}`"
    out: dict[str, str] = {
        "col_type": f"'{dt.simpleString()}'",
        "count": "count(1)",
        # Derived from counts the struct needs anyway (count(1), count(c)): no conditional count per column.
        "null_count": f"count(1) - count({c})",
        "nan_count": "0L",
        "inf_count": "0L",
    }
    for k in TYPE_CLASSES:
        out[f"n_{k}"] = "0L"
    number = c if cls in ("integral", "fractional") else None
    whole = c if cls == "integral" else None
    text = c if cls in ("string", "binary") else None
    if cls == "variant":
        own = variant_parts(name) if parts is None else {k: f"`{v}`" for k, v in parts.items()}
        kind, number, whole, text = own["kind"], own["number"], own["whole"], own["text"]
        scalar = f"{kind} NOT RLIKE '^(VOID|ARRAY|OBJECT)'"
        out["null_count"] = f"count_if({c} IS NULL OR {kind} = 'VOID')"
        out["n_integral"] = f"count_if({kind} = 'BIGINT')"
        out["n_fractional"] = f"count_if({kind} RLIKE '^(DECIMAL|DOUBLE|FLOAT)')"
        out["n_boolean"] = f"count_if({kind} = 'BOOLEAN')"
        out["n_string"] = f"count_if({kind} IN ('STRING', 'BINARY'))"
        out["n_temporal"] = f"count_if({kind} RLIKE '^(DATE|TIMESTAMP)')"
        out["n_other"] = f"count_if({kind} RLIKE '^(ARRAY|OBJECT)')"
        c_item = f"CASE WHEN {scalar} THEN variant_get({c}, '$', 'string') END"
    else:
        # binary values are counted with strings: both are byte sequences to the statistics.
        out[f"n_{'string' if cls == 'binary' else cls}"] = f"count({c})"
        if present is not None:
            out["null_count"] = f"count(1) - count_if({present})"
            out["n_other"] = f"count_if({present} AND {c} IS NULL)" if cls != "other" else f"count_if({present})"
        c_item = _item_sql(c, cls)

    if number is not None:
        x = f"CAST({number} AS DOUBLE)"
        if cls == "integral":
            ordered = finite = x
            out["num_n"] = f"count({x})"
        else:
            out["nan_count"] = f"count_if(isnan({x}))"
            out["inf_count"] = f"count_if(abs({x}) = {_INF})"
            ordered = f"CASE WHEN NOT isnan({x}) THEN {x} END"
            finite = f"CASE WHEN NOT isnan({x}) AND abs({x}) != {_INF} THEN {x} END"
            out["num_n"] = f"count({number}) - count_if(isnan({x})) - count_if(abs({x}) = {_INF})"
        out["num_min"] = f"min({ordered})"
        out["num_max"] = f"max({ordered})"
        out["num_mean"] = f"avg({finite})"
        out["num_m2"] = f"var_pop({finite}) * ({out['num_n']})"
        if sketches:
            out["kll"] = f"kll_sketch_agg_double({ordered}, {DEFAULT_KLL_K})"
    if whole is not None:
        out["int_min"], out["int_max"] = f"min({whole})", f"max({whole})"
    if isinstance(dt, T.DecimalType):
        # The text of a decimal has exactly its scale's digits, so without the point it is the unscaled value.
        out["dec_min"], out["dec_max"] = (f"CAST(replace(CAST({f}({c}) AS STRING), '.', '') AS DECIMAL(38, 0))"
                                          for f in ("min", "max"))
    if cls == "temporal":
        for field in ("min", "max"):
            # An instant is shown as UTC wall-clock time, whatever the session zone.
            out[f"ts_{field}"] = f"timestampadd(MICROSECOND, unix_micros({field}({c})), {_EPOCH})" \
                if isinstance(dt, T.TimestampType) else f"CAST({field}({c}) AS TIMESTAMP_NTZ)"
    if text is not None:
        if cls != "binary":
            out["str_min"] = f"min({text})"
            out["str_max"] = f"max({text})"
        ln = f"CAST(length({text}) AS BIGINT)"
        out["len_min"] = f"min({ln})"
        out["len_max"] = f"max({ln})"
        out["len_sum"] = f"sum({ln})"

    key = distinct_key_sql(c, cls)
    if key is not None and sketches:
        out["hll"] = f"hll_sketch_agg({key})"
    if sketches:
        # NULL would count as an item in the sketch, so only non-null values are fed (all-null -> empty list).
        # Columns without frequent items get an empty string-typed state (folded to a constant by the optimizer):
        # the combine aggregate cannot take NULL states, and one state type keeps every column mergeable.
        cond = "false" if c_item is None else f"{c_item} IS NOT NULL" if cls == "variant" else f"{c} IS NOT NULL"
        out["topk"] = (
            f"approx_top_k_accumulate({c_item or 'CAST(NULL AS STRING)'}, {int(topk_capacity)}) FILTER (WHERE {cond})"
        )
    fields = ", ".join(
        f"'{field}', CAST({out.get(field, 'NULL')} AS {_FIELD_DDL[field]})" if field not in ("topk",)
        else f"'{field}', {out.get(field, _null_sql(field))}"
        for field, _ in STATS_FIELDS
    )
    return f"named_struct({fields})"


def variant_parts(name: str, kind: str | None = None) -> dict[str, str]:
    """SQL text of what the statistics of variant column ``name`` are made of: the type of each value, and the value as
    a number, a whole number or a text if it is one. ``kind``: the column that holds the type, if there is one."""
    c = f"`{name}`"
    kind = f"schema_of_variant({c})" if kind is None else f"`{kind}`"
    return {"kind": kind,
            "number": f"CASE WHEN {kind} RLIKE '^(BIGINT|DECIMAL|DOUBLE|FLOAT)' THEN variant_get({c}, '$', 'double') END",
            "whole": f"CASE WHEN {kind} = 'BIGINT' THEN variant_get({c}, '$', 'bigint') END",
            "text": f"CASE WHEN {kind} = 'STRING' THEN variant_get({c}, '$', 'string') END"}


def column_stats(name: str, dt: T.DataType, **kwargs) -> Column:
    """Aggregate expression: the ``STATS_TYPE`` struct of column ``name`` (a plain identifier) over a group."""
    return F.expr(column_stats_sql(name, dt, **kwargs))


def distinct_key_sql(c: str, cls: str) -> str | None:
    """Value the distinct sketch sees. The sketch takes int, bigint, string and binary and hashes them itself, so
    those go in as they are; every other type as its 64-bit xxhash (cheaper than a string per value; a collision is
    negligible next to the sketch's own error)."""
    if cls == "integral":
        return f"CAST({c} AS BIGINT)"
    if cls in ("string", "binary"):
        return c
    if cls in ("fractional", "boolean", "temporal"):
        return f"CASE WHEN {c} IS NOT NULL THEN xxhash64({c}) END"
    if cls == "variant":
        return f"to_json({c})"
    return None


def exact_value(value: Column, dt: T.DataType) -> Column:
    """The value by which exact counts tell values apart: -0.0 is 0.0."""
    return F.when(value == 0, F.lit(0).cast(dt)).otherwise(value) if type_class(dt) == "fractional" else value


def _item_sql(c: str, cls: str) -> str | None:
    """SQL text of the value the frequent-items sketch sees; fractions are described by the quantile sketch."""
    if cls in ("integral", "boolean", "temporal"):
        return f"CAST({c} AS STRING)"
    if cls in ("string", "binary"):
        text = c if cls == "string" else f"hex({c})"
        return f"CASE WHEN length({text}) <= {LONG_ITEM} THEN {text} ELSE concat('xxhash64:', hex(xxhash64({c}))) END"
    return None


def merge_stats_sql(name: str, sketches: bool = True, topk_capacity: int = DEFAULT_TOPK_CAPACITY) -> str:
    """SQL text of the aggregate combining the ``STATS_TYPE`` structs in column ``name`` (sub-groups) into the struct
    of their union.

    Counts, extrema and sketches combine before the shuffle. Moments travel as (n, mean, M2) triples of 24 bytes a
    part and are folded pairwise (Chan et al.), which is exact without a second pass for the group's mean.
    """
    s = f"`{name}`"
    folded = (
        f"aggregate(collect_list(CASE WHEN {s}.num_n > 0 THEN named_struct('n', CAST({s}.num_n AS DOUBLE), "
        f"'m', {s}.num_mean, 's', {s}.num_m2) END), named_struct('n', 0D, 'm', 0D, 's', 0D), "
        "(a, x) -> named_struct('n', a.n + x.n, 'm', a.m + (x.m - a.m) * x.n / (a.n + x.n), "
        "'s', a.s + x.s + (x.m - a.m) * (x.m - a.m) * a.n * x.n / (a.n + x.n)))"
    )
    n = f"sum({s}.num_n)"
    out = {
        "col_type": f"max({s}.col_type)",
        "num_min": f"min({s}.num_min)",
        "num_max": f"max({s}.num_max)",
        "num_n": n,
        "num_mean": f"CASE WHEN {n} > 0 THEN {folded}.m END",
        "num_m2": f"CASE WHEN {n} > 0 THEN {folded}.s END",
        "str_min": f"min({s}.str_min)",
        "str_max": f"max({s}.str_max)",
        "ts_min": f"min({s}.ts_min)",
        "ts_max": f"max({s}.ts_max)",
        "len_min": f"min({s}.len_min)",
        "len_max": f"max({s}.len_max)",
        "len_sum": f"sum({s}.len_sum)",
        "int_min": f"min({s}.int_min)",
        "int_max": f"max({s}.int_max)",
        "dec_min": f"min({s}.dec_min)",
        "dec_max": f"max({s}.dec_max)",
        # Profiles made without sketches carry NULL states, which the merge aggregates do not accept.
        "kll": f"kll_merge_agg_double({s}.kll) FILTER (WHERE {s}.kll IS NOT NULL)",
        "hll": f"hll_union_agg({s}.hll, true) FILTER (WHERE {s}.hll IS NOT NULL)",
        # An explicit capacity lets parts of different capacities combine.
        "topk": f"approx_top_k_combine({s}.topk, {int(topk_capacity)}) FILTER (WHERE {s}.topk IS NOT NULL)",
        # An exact distinct count cannot be combined from parts.
        "exact_distinct": "NULL",
    }
    for field in ("count", "null_count", "nan_count", "inf_count") + tuple(f"n_{k}" for k in TYPE_CLASSES):
        out[field] = f"sum({s}.{field})"
    if not sketches:
        for field in ("kll", "hll", "topk"):
            out[field] = _null_sql(field)
    fields = ", ".join(
        f"'{field}', CAST({out[field]} AS {_FIELD_DDL[field]})" if field != "topk" else f"'{field}', {out[field]}"
        for field, _ in STATS_FIELDS
    )
    return f"named_struct({fields})"


def merge_stats(name: str, sketches: bool = True, topk_capacity: int = DEFAULT_TOPK_CAPACITY) -> Column:
    """Aggregate expression merging the ``STATS_TYPE`` structs of column ``name``; see ``merge_stats_sql``.
    ``sketches=False`` when the parts were made without sketches (their states are NULL)."""
    return F.expr(merge_stats_sql(name, sketches, topk_capacity))
