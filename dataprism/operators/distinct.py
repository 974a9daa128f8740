"""Exact distinct counts that can be merged: segmented bitmaps of integers, runs of hashes of everything else.

A profile's distinct sketch merges but estimates; its exact count does not merge. ``distinct_state`` gives the state
behind an exact count as a table beside the profiles: one row per (profile, column, part), where a part is a range of
32,768 integers or a slice of the 128-bit hashes. A part of integers is a bitmap, or the list of its few places while
there are at most ``SPARSE`` (4 KB of bits for a handful of values would be waste). ``merge_distinct`` combines states
of other days, salts or loads, part by part; ``distinct_counts`` adds up the parts, and ``with_exact_distinct`` puts
the counts into profiles.

Plan: one scan for all columns; values are exploded to (column, part, place) rows that are made unique in each task
before the one shuffle by all of them, and gathered by part, so neither a hot value nor a column of many values ends in
one task. A merge moves parts, never rows. The state of n distinct integers that lie together is n/8 bytes, of others
8 to 16 bytes a value.

Rules: nulls are no value; -0.0 is 0.0; arrays, maps, structs and variants have no distinct count. Values of two states
are comparable when the column has the same type class in both (integers of any width are).
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dataprism.functions import buckets as B
from dataprism.functions import envelope as E
from dataprism.functions.stats import exact_value, type_class
from dataprism.operators.config import DEFAULT_FREQ, col, is_control_column, parse_segments, resolve_names
from dataprism.operators.joins import join_on_keys
from dataprism.operators.profile import Bucketing, Segmenting, _key, _timestamp, grouped_rows

PROFILE_KEYS = ("dataset_timestamp", "segment_partition", "segment")
STATE_COLUMNS = ("column", "kind", "part", "n", "bits", "run")
HASH_PARTS = 4096
SPARSE = 256
_INT, _HASH = "int", "hash"


def _places(value: Column, dt: T.DataType) -> Column:
    """(part, a, b) of a value: bucket and bit of an integer (b null), slice and 128 bits of the hash of others."""
    if type_class(dt) == "integral":
        whole = value.cast("bigint")
        return F.struct(F.bitmap_bucket_number(whole).alias("part"), F.bitmap_bit_position(whole).alias("a"),
                        F.lit(None).cast("bigint").alias("b"))
    v = exact_value(value, dt)
    first = F.xxhash64(v)
    return F.struct(F.pmod(first, F.lit(HASH_PARTS).cast("bigint")).alias("part"), first.alias("a"),
                    F.xxhash64(F.lit(7), v).alias("b"))


def _gather(singles: DataFrame, by: list[str]) -> DataFrame:
    """Rows (by.., a, b), each once, as one row per part: ``n``, and ``bits`` of a dense part of integers or the
    ``run`` of a sparse one or of hashes."""
    whole = singles.filter(F.col("kind") == _INT).groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"), F.bitmap_construct_agg("a").alias("bits"),
        F.array_sort(F.collect_list(F.struct("a", "b"))).alias("run"))
    dense = F.col("n") > SPARSE
    whole = whole.select(*by, "n", F.when(dense, F.col("bits")).alias("bits"),
                         F.when(~dense, F.col("run")).alias("run"))
    hashed = singles.filter(F.col("kind") == _HASH).groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"), F.array_sort(F.collect_list(F.struct("a", "b"))).alias("run"))
    return whole.unionByName(hashed.withColumn("bits", F.lit(None).cast("binary")).select(*by, "n", "bits", "run"))


def distinct_state(df: DataFrame, ts: str | Column, *, freq: str = DEFAULT_FREQ,
                   segments: str | Iterable[str] | None = None, partition_by: Sequence[str | Column] | None = None,
                   columns: Sequence[str] | None = None, min_partitions: int | None = None) -> DataFrame:
    """The exact-distinct state of the profiles that ``profile`` makes with the same arguments: partition keys,
    ``dataset_timestamp``, ``segment_partition``, ``segment``, ``column``, ``kind``, ``part``, ``n``, ``bits``,
    ``run``."""
    seg_names = resolve_names(df, parse_segments(segments), "segment column")
    names = [c for c in df.columns if not is_control_column(c)] if columns is None \
        else resolve_names(df, columns, "profiled column")
    names = [n for n in names if type_class(df.schema[n].dataType) not in ("other", "variant")]
    alias = [f"__s{i}" for i in range(len(seg_names))]
    segment = Segmenting([col(n).alias(a) for n, a in zip(seg_names, alias)], alias, F.lit(bool(seg_names)),
                         E.segment_json(seg_names, [F.col(a) for a in alias]), E.segment_partition_name(seg_names))
    keys = [_key(df, c) for c in partition_by or []]
    taken = sorted({k.lower() for k, _ in keys} & {*PROFILE_KEYS, *STATE_COLUMNS})
    if taken:
        raise ValueError(f"partition column {taken[0]!r} is a column of the state; give it another name")
    kinds = [df.schema[n].dataType for n in names]
    pre, _, key_alias, group = grouped_rows(df, _timestamp(df, ts), Bucketing((B.parse_freq(freq),)), segment, keys,
                                            [(n, col(n), k, None) for n, k in zip(names, kinds)], min_partitions)
    entry = "array<struct<i:int,kind:string,part:bigint,a:bigint,b:bigint>>"
    each = F.array(*[F.struct(F.lit(i).alias("i"),
                              F.when(F.col(f"__v{i}").isNotNull(),
                                     F.lit(_INT if type_class(k) == "integral" else _HASH)).alias("kind"),
                              _places(F.col(f"__v{i}"), k).alias("p")) for i, k in enumerate(kinds)])
    flat = F.transform(each, lambda x: F.struct(x.i.alias("i"), x.kind.alias("kind"), x.p.part.alias("part"),
                                                x.p.a.alias("a"), x.p.b.alias("b"))) if kinds else F.array()
    singles = pre.select(*group, F.explode(flat.cast(entry)).alias("e")).select(*group, "e.*") \
        .filter(F.col("kind").isNotNull()).distinct()
    out = _gather(singles, [*group, "i", "kind", "part"])
    name = F.element_at(F.array(*[F.lit(n) for n in names]).cast("array<string>"), F.col("i") + 1)
    return out.select(*[F.col(a).alias(n) for (n, _), a in zip(keys, key_alias)],
                      B.epoch_ms(F.col("__bucket")).alias("dataset_timestamp"),
                      segment.partition.alias("segment_partition"), segment.text.alias("segment"),
                      name.alias("column"), "kind", "part", "n", "bits", "run")


def merge_distinct(states: DataFrame, keys: Sequence[str] = PROFILE_KEYS) -> DataFrame:
    """The state of the union of all states of each ``keys`` tuple."""
    names = list(keys)
    alias = [f"__k{i}" for i in range(len(names))]
    by = [*alias, "column", "kind", "part"]
    rows = states.select(*[col(k).alias(a) for k, a in zip(names, alias)], "column", "kind", "part", "bits", "run")
    singles = rows.filter(F.col("run").isNotNull()).select(*by, F.explode("run").alias("r")) \
        .select(*by, "r.*").distinct()
    sparse = _gather(singles, by)
    # Where some state of a part is a bitmap, the singles join it as bits; where none is, they stay what they are.
    dense = rows.filter(F.col("bits").isNotNull()).groupBy(*by).agg(F.bitmap_or_agg("bits").alias("bits"))
    loose = join_on_keys(singles.filter(F.col("kind") == _INT), dense.select(*by), by, "left_semi") \
        .groupBy(*by).agg(F.bitmap_construct_agg("a").alias("bits"))
    dense = dense.unionByName(loose).groupBy(*by).agg(F.bitmap_or_agg("bits").alias("bits"))
    dense = dense.select(*by, F.bitmap_count("bits").alias("n"), "bits",
                         F.lit(None).cast(sparse.schema["run"].dataType).alias("run"))
    out = join_on_keys(sparse, dense.select(*by), by, "left_anti").unionByName(dense)
    return out.select(*[F.col(a).alias(n) for n, a in zip(names, alias)], "column", "kind", "part", "n", "bits", "run")


def distinct_counts(states: DataFrame, keys: Sequence[str] = PROFILE_KEYS) -> DataFrame:
    """``keys``, ``column``, ``exact_distinct`` of a state with one row per part (as ``distinct_state`` and
    ``merge_distinct`` give)."""
    return states.groupBy(*[col(k) for k in keys], "column").agg(F.sum("n").cast("bigint").alias("exact_distinct"))


def with_exact_distinct(profiles: DataFrame, counts: DataFrame, keys: Sequence[str] = PROFILE_KEYS, *,
                        profile_col: str = "profile") -> DataFrame:
    """``profiles`` with the counts in their columns' ``exact_distinct``; a column without any value gets 0 if it is of
    a type that is counted."""
    names = list(keys)
    known = counts.groupBy(*[col(k) for k in names]).agg(
        F.map_from_entries(F.collect_list(F.struct("column", "exact_distinct"))).alias("__d"))
    out = join_on_keys(profiles, known, names, "left")
    found = F.coalesce("__d", F.create_map().cast("map<string,bigint>"))

    def put(name: Column, stats: Column) -> Column:
        counted = ~stats.getField("col_type").rlike("^(array|map|struct|variant|interval)")
        return stats.withField("exact_distinct", F.coalesce(F.element_at(found, name),
                                                            F.when(counted, F.lit(0).cast("bigint"))))

    body = col(profile_col)
    return out.withColumn(profile_col, body.withField("columns", F.transform_values(body.getField("columns"), put))) \
        .drop("__d")
