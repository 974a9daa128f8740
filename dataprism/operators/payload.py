"""Profiles of row payloads: one object per row holding the values and the control keys.

Some pipelines hand the profiler one object per row (``object_construct(*)`` plus inserted keys) instead of typed
columns. The object may be a ``VARIANT`` (``to_variant_object(struct(*))``), a ``STRUCT`` or a ``MAP<string, T>``.
Control keys inside it:

* ``DATASET_TIMESTAMP`` — event time as epoch milliseconds (required);
* ``SEGMENT_COLUMNS`` — CSV of segment names (optional);
* ``GROUP_BY_FREQUENCY`` — frequency string (optional, default ``D``).

Every other key is profiled with the type it has in the data. A variant's keys and types are discovered with one
``schema_of_variant_agg`` pass over the payload column (pass ``schema=`` to skip it); a key with values of several
types stays a variant, whose values count under their own types. With ``schema=``, a value that does not cast counts
under ``n_other``, not as a null. A map's keys are never listed: its entries are profiled in long form, one group per
(profile, key), and so are a variant's with ``long=True``, whose keys then need no pass of their own and no schema. The
number of keys is unbounded in this form up to the profile row, which holds all of its keys; ``payload_stats`` gives one
row per (profile, key) instead and holds none together. Control keys and segment names match in any case, in each row
of a map by itself; of several spellings in one map, the first in code point order counts (upper case first).

Control values are per partition: all rows of a partition must agree (Spark has no "first row"). One small aggregate
checks that and lists the frequencies and segment names in use; blank values count as absent. The profile is then one
plan for all configurations: the frequency is a row value and the bucket a CASE over the frequencies in use, and the
segment of a row is put together from the columns that its own list names.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dataprism.functions import buckets as B
from dataprism.functions import envelope as E
from dataprism.functions.stats import (DEFAULT_TOPK_CAPACITY, column_stats, exact_value, merge_stats, type_class,
                                       variant_parts)
from dataprism.operators.config import DEFAULT_FREQ, col, is_control_column
from dataprism.operators.joins import join_on_keys
from dataprism.operators.profile import Bucketing, Segmenting, _attach_bucket_facts, envelope_columns, profile_rows

# Control keys of a payload.
TS_KEY = "DATASET_TIMESTAMP"
SEGMENTS_KEY = "SEGMENT_COLUMNS"
FREQ_KEY = "GROUP_BY_FREQUENCY"



def make_payload(df: DataFrame, *, dataset_timestamp: Column | None = None, segment_columns: str | Column | None = None,
                 freq: str | Column | None = None, as_variant: bool = True) -> Column:
    """``object_insert(object_construct(*), ...)``: every column of ``df`` plus the control keys given."""
    fields = [col(c) for c in df.columns]
    if dataset_timestamp is not None:
        fields.append(dataset_timestamp.cast("bigint").alias(TS_KEY))
    for key, v in ((SEGMENTS_KEY, segment_columns), (FREQ_KEY, freq)):
        if v is not None:
            fields.append((v if isinstance(v, Column) else F.lit(v)).cast("string").alias(key))
    s = F.struct(*fields)
    return F.to_variant_object(s) if as_variant else s


def _quote_path(key: str) -> str:
    return "$['" + key.replace("\\", "\\\\").replace("'", "\\'") + "']"


def payload_schema(df: DataFrame, data: str) -> T.StructType:
    """Keys and types of a variant payload column (one aggregate over that column)."""
    ddl = df.agg(F.expr(f"schema_of_variant_agg(`{data}`)")).first()[0]
    if ddl is None:
        return T.StructType([])
    if not ddl.startswith("OBJECT<"):
        raise TypeError(f"payload column {data!r} must hold objects, found {ddl}")
    parsed = T._parse_datatype_string("STRUCT<" + ddl[len("OBJECT<"):])
    return T.StructType([
        T.StructField(f.name, T.StringType() if isinstance(f.dataType, T.NullType) else f.dataType, True)
        for f in parsed.fields
    ])


def expand_payload(df: DataFrame, data: str = "data", *, schema: T.StructType | None = None
                   ) -> list[tuple[str, Column, T.DataType, Column | None]]:
    """The keys of a struct or variant payload as (name, value, type, whether the value was there before a cast)."""
    dt = df.schema[data].dataType
    body = col(data)
    if isinstance(dt, T.StructType):
        return [(f.name, body.getField(f.name), f.dataType, None) for f in dt.fields]
    if not isinstance(dt, T.VariantType):
        raise TypeError(f"payload column {data!r} must be a variant, struct or map, not {dt.simpleString()}")
    out = []
    for f in (schema if schema is not None else payload_schema(df, data)).fields:
        raw = F.try_variant_get(body, _quote_path(f.name), "variant")
        if isinstance(f.dataType, T.VariantType):
            out.append((f.name, raw, f.dataType, None))
        else:
            value = F.try_variant_get(body, _quote_path(f.name), f.dataType.simpleString())
            there = raw.isNotNull() & ~F.is_variant_null(raw) if schema is not None else None
            out.append((f.name, value, f.dataType, there))
    return out


def _text(value: Column | None, kind: T.DataType | None) -> Column:
    """A control value as text; blanks are absent."""
    if value is None:
        return F.lit(None).cast("string")
    if isinstance(kind, T.VariantType):
        value = F.try_variant_get(value, "$", "string")
    return F.nullif(F.trim(value.cast("string")), F.lit(""))


def _map_key(body: Column, key: str) -> Column:
    """The spelling of a control key in a map; null in maps without it. Upper case is the first in code point order, so
    other spellings are looked for only in maps without it."""
    return F.when(F.map_contains_key(body, key), F.lit(key)).otherwise(
        F.array_min(F.filter(F.map_keys(body), lambda k: F.upper(k) == key)))


def _configs(rows: DataFrame, keys: list[str], present: list[str]) -> tuple[list[str], list[str]]:
    """Frequencies and segment names in use, after checking that a partition holds one value per control column, and
    that a row has the event-time key if ``rows`` say which ones do (``__timed``).

    One job: minimum, maximum and count per partition, then one row over all partitions. None when no control column
    is present."""
    if not present:
        return [], []
    timed = ["__timed"] if "__timed" in rows.columns else []
    per = rows.groupBy(*[F.col(k) for k in keys]).agg(
        F.count(F.lit(1)).alias("__all"), *[F.max(t).alias(t) for t in timed],
        *[a for c in present for a in (F.min(c).alias(f"{c}_lo"), F.max(c).alias(f"{c}_hi"),
                                       F.count(c).alias(f"{c}_n"))])
    clash = F.lit(False)
    for c in present:
        clash = clash | (F.col(f"{c}_lo") != F.col(f"{c}_hi")) | ((F.col(f"{c}_n") > 0) & (F.col(f"{c}_n") < F.col("__all")))
    clash = F.coalesce(clash, F.lit(False))
    row = per.agg(
        F.min(F.when(clash, F.to_json(F.struct(*keys, *[f"{c}_lo" for c in present], *[f"{c}_hi" for c in present]))))
        .alias("bad"), *[F.max(t).alias(t) for t in timed],
        *([F.collect_set("__freq_lo").alias("freqs")] if "__freq" in present else []),
        *([F.array_distinct(F.flatten(F.collect_set(F.split("__segs_lo", ",")))).alias("names")]
          if "__segs" in present else [])).first().asDict()
    if timed and not row["__timed"]:
        raise ValueError(f"payload has no {TS_KEY} key in any row")
    if row["bad"] is not None:
        raise ValueError(f"control values must be the same in all rows of a partition; partition {row['bad']} differs")
    names = sorted({n.strip().lower() for n in row.get("names") or [] if n.strip()})
    return sorted(row.get("freqs") or []), names


def profile_payload(df: DataFrame, data: str = "data", *, partition_by: Sequence[str] = (),
                    schema: T.StructType | None = None, columns: Sequence[str] | None = None, long: bool = False,
                    **profile_kwargs) -> DataFrame:
    """Profile the objects in column ``data`` per partition (``partition_by`` columns of ``df``), bucket and segment.

    Output as ``profile`` (partition keys first). Control keys are never profiled; the event-time key becomes the
    bucket time. A NULL or blank segment list means unsegmented, a NULL or blank frequency the default ``D``.
    ``long`` profiles a variant's keys in long form, without a schema; maps always are. ``profile_kwargs`` pass through
    (``serialize``, ``exact``, ``salt``, ``min_partitions`` ...).
    """
    df = _as_map(df, data) if long else df
    ts, bucketing, segment, keys, fields = _payload_plan(df, data, partition_by, schema)
    wanted = None if columns is None else {c.lower() for c in columns}
    if isinstance(df.schema[data].dataType, T.MapType):
        return _profile_map(df, data, ts, bucketing, segment, keys, wanted, **profile_kwargs)
    values = [f for f in fields if not is_control_column(f[0]) and (wanted is None or f[0].lower() in wanted)]
    # Rows of a payload are dear to make, so they are read once unless the caller says otherwise.
    return profile_rows(df, ts, bucketing, segment, keys, values, **{"one_pass": True, **profile_kwargs})


def payload_stats(df: DataFrame, data: str = "data", *, partition_by: Sequence[str] = (),
                  columns: Sequence[str] | None = None, sketches: bool = True,
                  topk_capacity: int = DEFAULT_TOPK_CAPACITY, salt: int | None = None, exact: bool = False,
                  min_partitions: int | None = None) -> DataFrame:
    """The statistics of map or variant payloads as one row per (profile, key): partition keys, ``dataset_timestamp``,
    ``segment_partition``, ``segment``, ``segment_rows``, ``column`` and ``stats`` (see ``STATS_TYPE``). Nothing holds
    the keys of a profile together, so their number has no bound."""
    df = _as_map(df, data)
    ts, bucketing, segment, keys, _ = _payload_plan(df, data, partition_by, None)
    wanted = None if columns is None else {c.lower() for c in columns}
    long, _, _, _, alias = _long_stats(df, data, ts, bucketing, segment, keys, wanted, sketches, topk_capacity, salt,
                                       exact, min_partitions)
    return long.select(*[F.col(a).alias(n) for (n, _), a in zip(keys, alias)],
                       B.epoch_ms(F.col("__bucket")).alias("dataset_timestamp"),
                       segment.partition.alias("segment_partition"), segment.text.alias("segment"),
                       F.col("__n").alias("segment_rows"), F.col("__name").alias("column"), F.col("__s").alias("stats"))


def _as_map(df: DataFrame, data: str) -> DataFrame:
    """Variant objects as maps of variants, so that their keys are rows of an explode; anything else in a variant has
    no keys."""
    kind = df.schema[data].dataType
    if isinstance(kind, T.MapType):
        return df
    if not isinstance(kind, T.VariantType):
        raise TypeError(f"payload column {data!r} must be a variant or map for the long form, not {kind.simpleString()}")
    return df.withColumn(data, F.try_variant_get(col(data), "$", "map<string,variant>"))


def _payload_plan(df: DataFrame, data: str, partition_by: Sequence[str], schema: T.StructType | None) -> tuple:
    """Event time, bucketing, segmentation, partition keys and fields of a payload column."""
    keys = [(k, col(k)) for k in partition_by]
    is_map = isinstance(df.schema[data].dataType, T.MapType)
    if is_map:
        inner = df.schema[data].dataType.valueType
        fields = [(k, F.element_at(col(data), _map_key(col(data), k)), inner, None)
                  for k in (TS_KEY, SEGMENTS_KEY, FREQ_KEY)]
    else:
        fields = expand_payload(df, data, schema=schema)
    by = {n.upper(): (v, t) for n, v, t, _ in fields}
    if TS_KEY not in by:
        raise ValueError(f"payload has no {TS_KEY} key; keys: {[n for n, *_ in fields]}")
    ts, kind = by[TS_KEY]
    ms = F.try_variant_get(ts, "$", "double") if isinstance(kind, T.VariantType) else ts
    ts = B.from_epoch_ms(ms.cast("double").cast("bigint") if isinstance(kind, (T.VariantType, T.StringType))
                         else ms.cast("bigint"))
    segs, freq = (_text(*by.get(k, (None, None))) for k in (SEGMENTS_KEY, FREQ_KEY))
    names = [f"__key{i}" for i in range(len(keys))]
    control = df.select(*[c.alias(n) for (_, c), n in zip(keys, names)], segs.alias("__segs"), freq.alias("__freq"),
                        *([_map_key(col(data), TS_KEY).isNotNull().alias("__timed")] if is_map else []))
    present = [c for c, k in (("__segs", SEGMENTS_KEY), ("__freq", FREQ_KEY)) if k in by]
    freqs, segment_names = _configs(control, names, present)
    which = F.coalesce(freq, F.lit(DEFAULT_FREQ))
    parsed = {f: B.parse_freq(f) for f in freqs} | {DEFAULT_FREQ: B.parse_freq(DEFAULT_FREQ)}
    segment = _row_segments(segs, segment_names, fields if not is_map else [
        # Every row's own spelling gives the value, the smallest spelling in the data the name.
        (n, F.element_at(col(data), _map_key(col(data), n.upper())), inner, None)
        for n in _map_names(df, data, segment_names)])
    return ts, Bucketing(tuple(parsed.values()), which), segment, keys, fields


def _map_names(df: DataFrame, data: str, lower_names: list[str]) -> list[str]:
    """Spellings in the data of the segment names in use (as many rows as names)."""
    if not lower_names:
        return []
    found = df.select(F.explode(F.map_keys(col(data))).alias("k")).filter(F.lower("k").isin(lower_names)) \
        .groupBy(F.lower("k").alias("l")).agg(F.min("k").alias("k")).collect()
    return [r.k for r in found]


def _row_segments(segs: Column, names: list[str], fields: list[tuple]) -> Segmenting:
    """Segmentation by each row's own list: its text is the JSON object of the listed columns, in list order."""
    by = {n.lower(): (n, v) for n, v, _, _ in fields}
    unknown = [n for n in names if n not in by]
    if unknown:
        raise ValueError(f"segment column {unknown[0]!r} not found; available columns: {sorted(by)}")
    listed = F.filter(F.transform(F.split(segs, ","), lambda s: F.trim(s)), lambda s: s != "")
    applies = F.coalesce(F.size(listed) > 0, F.lit(False))
    if not names:
        return Segmenting([], [], F.lit(False), F.lit(None).cast("string"), F.lit(None).cast("string"))
    parts = F.create_map(*[x for n in names for x in (
        F.lit(n), F.regexp_extract(E.segment_json([by[n][0]], [by[n][1]]), r"(?s)^\{(.*)\}$", 1))])
    spelled = F.create_map(*[x for n in names for x in (F.lit(n), F.lit(by[n][0]))])
    text = F.concat(F.lit("{"), F.array_join(F.transform(listed, lambda s: F.element_at(parts, F.lower(s))), ","),
                    F.lit("}"))
    partition = F.array_join(F.transform(listed, lambda s: F.element_at(spelled, F.lower(s))), ",")
    return Segmenting([F.when(applies, text).alias("__seg"), F.when(applies, partition).alias("__segpart")],
                      ["__seg", "__segpart"], applies, F.col("__seg"), F.col("__segpart"))


def _profile_map(df: DataFrame, data: str, ts: Column, bucketing: Bucketing, segment: Segmenting,
                 keys: list[tuple[str, Column]], wanted: set[str] | None, *, serialize: bool = False, sketches: bool = True,
                 topk_capacity: int = DEFAULT_TOPK_CAPACITY, metadata: dict[str, str] | None = None,
                 passthrough: dict[str, str] | None = None, salt: int | None = None, exact: bool = False,
                 min_partitions: int | None = None, columns_per_pass: int | None = None,
                 one_pass: bool = False) -> DataFrame:
    """Profiles of map payloads, put together from the long form. ``columns_per_pass`` has no effect (the long form has
    one column whatever the number of keys), nor has ``one_pass`` (counting rows and exploding keys are two passes)."""
    long, whole, pre, bucketing, alias = _long_stats(df, data, ts, bucketing, segment, keys, wanted, sketches,
                                                     topk_capacity, salt, exact, min_partitions)
    group = [*alias, "__fq", "__bucket", *segment.names]
    maps = long.groupBy(*group).agg(F.map_from_entries(F.collect_list(F.struct("__name", "__s"))).alias("__map"))
    l1 = join_on_keys(whole, maps, group, "left")
    narrow_keys = [*alias, "__fq", "__bucket"]
    narrow = pre.groupBy(*narrow_keys).agg(F.count(F.lit(1)).cast("bigint").alias("__rows"))
    prof = _attach_bucket_facts(l1, narrow, alias, narrow_keys, bucketing)
    none = F.create_map().cast(prof.schema["__map"].dataType)
    return prof.select(*[F.col(a).alias(n) for (n, _), a in zip(keys, alias)],
                       *envelope_columns(F.col("__bucket"), F.coalesce("__map", none), segment, passthrough, metadata,
                                         serialize))


def _long_stats(df: DataFrame, data: str, ts: Column, bucketing: Bucketing, segment: Segmenting,
                keys: list[tuple[str, Column]], wanted: set[str] | None, sketches: bool, topk_capacity: int,
                salt: int | None, exact: bool, min_partitions: int | None) -> tuple:
    """(group, __name, __s, __n): one statistics group per (profile, map key), however many keys there are; the rows of
    each group; the rows before. A row without a key counts as a null of that column, as a missing object key does."""
    if salt is not None and (not isinstance(salt, int) or salt < 1):
        raise ValueError("salt must be a positive integer")
    value_type = df.schema[data].dataType.valueType
    alias = [f"__k{i}" for i in range(len(keys))]
    pre = df.select(*[c.alias(a) for (_, c), a in zip(keys, alias)], *segment.columns, bucketing.which.alias("__fq"),
                    ts.alias("__ts"), segment.applies.alias("__segmented"), col(data).alias("__data"))
    bucketing = Bucketing(bucketing.freqs, F.col("__fq"))
    # Rows of a payload are dear to make: a filter is not pushed below a generator, where it would make each row anew.
    pre = pre.select(F.inline(F.array(F.struct(*pre.columns)))) \
        .filter(F.col("__segmented") | F.col("__ts").isNotNull())
    if min_partitions is not None:
        pre = pre.repartition(min_partitions, F.monotonically_increasing_id())
    if bucketing.needs_origin:
        first = B.to_ntz(F.to_date(F.min("__ts"))).alias("__origin")
        pre = join_on_keys(pre, pre.groupBy(*alias).agg(first), alias) if alias \
            else pre.withColumn("__origin", pre.agg(first).scalar())
    pre = pre.withColumn("__bucket", F.when(F.col("__ts").isNull(), F.raise_error(F.lit("payload without an event time")))
                         .otherwise(bucketing.label(F.col("__ts"), F.col("__origin"))))
    group = [*alias, "__fq", "__bucket", *segment.names]
    whole = pre.groupBy(*group).agg(F.count(F.lit(1)).cast("bigint").alias("__n"))
    entries = pre.select(*group, F.explode("__data").alias("__name", "__v")) \
        .filter(~F.upper("__name").isin(TS_KEY, SEGMENTS_KEY, FREQ_KEY)) \
        .filter(F.lit(True) if wanted is None else F.lower("__name").isin(sorted(wanted)))
    parts = None
    if type_class(value_type) == "variant":
        # Once a value, not once a statistic.
        parts = {k: f"__v_{k}" for k in variant_parts("__v")}
        entries = entries.withColumn(parts["kind"], F.expr(variant_parts("__v")["kind"]))
        entries = entries.withColumns({parts[k]: F.expr(x) for k, x in variant_parts("__v", parts["kind"]).items()
                                       if k != "kind"})
    stats = column_stats("__v", value_type, topk_capacity=topk_capacity, sketches=sketches, parts=parts).alias("__s")
    if salt and salt > 1:
        long = entries.groupBy(*group, "__name", F.pmod(F.spark_partition_id(), F.lit(salt)).alias("__salt")).agg(stats) \
            .groupBy(*group, "__name").agg(merge_stats("__s", sketches, topk_capacity).alias("__s"))
    else:
        long = entries.groupBy(*group, "__name").agg(stats)
    if exact and type_class(value_type) not in ("other", "variant"):
        pairs = entries.filter(F.col("__v").isNotNull()).select(*group, "__name", exact_value(F.col("__v"), value_type)
                                                                .alias("__x")).distinct()
        counts = pairs.groupBy(*group, "__name").agg(F.count(F.lit(1)).alias("__d"))
        long = join_on_keys(long, counts, [*group, "__name"], "left").withColumn(
            "__s", F.col("__s").withField("exact_distinct", F.coalesce("__d", F.lit(0)).cast("bigint"))).drop("__d")
    long = join_on_keys(long, whole, group)
    absent = F.col("__n") - F.col("__s").getField("count")
    full = F.col("__s").withField("null_count", F.col("__s").getField("null_count") + absent) \
        .withField("count", F.col("__n"))
    return long.withColumn("__s", full), whole, pre, bucketing, alias
