"""Reproducible quantiles: histograms of logarithmic buckets with integer counts.

A quantile sketch gives another answer on every run. Here a value x falls in bucket ceil(ln|x| / ln g) of its sign,
with g = (1 + a) / (1 - a); the middle 2 g^i / (g + 1) of a bucket is within the share ``a`` of every value in it
(published as DDSketch). Buckets are counted with integers, so the histogram of a group is the same bytes on every run,
for every salt and merge order, and histograms merge exactly by adding counts.

``quantile_state`` gives one row per (profile, numeric column): ``n`` and ``buckets``, an array of (sign, index, count)
in order of value; ``merge_quantiles`` adds histograms up; ``quantiles`` reads levels off. A level q is taken as linear
interpolation between the two ranks next to q (n - 1), as exact continuous quantiles are, so for a column of one sign
the result is within the share ``a`` of the exact one (with both signs, of the larger neighbour's size).

Plan: one scan for all columns, exploded to (column, bucket) and counted in each task before the shuffle, so a hot value
or group sends one row a task. A histogram holds at most a few thousand buckets for values of a few dozen orders of
magnitude, whatever the number of rows; it is gathered from counted buckets, never from rows.

Rules: nulls, NaN and infinities are left out; 0 (and -0.0) has a bucket of its own; a column without finite values
has no row.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dataprism.functions import buckets as B
from dataprism.functions import envelope as E
from dataprism.functions.stats import type_class
from dataprism.operators.config import DEFAULT_FREQ, col, is_control_column, parse_segments, resolve_names
from dataprism.operators.distinct import PROFILE_KEYS
from dataprism.operators.profile import Bucketing, Segmenting, _key, _timestamp, grouped_rows
from dataprism.operators.summary import QUANTILES

#: Relative error of a bucket's middle.
ACCURACY = 0.005
STATE_COLUMNS = ("column", "accuracy", "n", "buckets")
_BUCKETS = "array<struct<sign:int,i:int,n:bigint>>"


def _log_width(accuracy: float) -> float:
    return math.log((1 + accuracy) / (1 - accuracy))


def _bucket(value: Column, accuracy: float) -> Column:
    """(sign, i) of a finite value; null of others."""
    x = value.cast("double")
    finite = x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    i = F.when(x == 0, F.lit(0)).otherwise(F.ceil(F.log(F.abs(x)) / F.lit(_log_width(accuracy))))
    return F.when(finite, F.struct(F.signum(x).cast("int").alias("sign"), i.cast("int").alias("i")))


def _gather(counted: DataFrame, by: list[str]) -> DataFrame:
    """Counted buckets (by.., sign, i, n) as one row per group, in order of value."""
    order = F.struct("sign", (F.col("sign") * F.col("i")).alias("o"), "i", "n")
    rows = counted.groupBy(*by).agg(F.sum("n").cast("bigint").alias("n"),
                                    F.array_sort(F.collect_list(order)).alias("b"))
    plain = F.transform("b", lambda b: F.struct(b.sign.alias("sign"), b.i.alias("i"), b.n.alias("n")))
    return rows.select(*by, "n", plain.cast(_BUCKETS).alias("buckets"))


def quantile_state(df: DataFrame, ts: str | Column, *, freq: str = DEFAULT_FREQ,
                   segments: str | Iterable[str] | None = None, partition_by: Sequence[str | Column] | None = None,
                   columns: Sequence[str] | None = None, accuracy: float = ACCURACY,
                   min_partitions: int | None = None) -> DataFrame:
    """The histograms of the numeric columns of the profiles that ``profile`` makes with the same arguments: partition
    keys, ``dataset_timestamp``, ``segment_partition``, ``segment``, ``column``, ``accuracy``, ``n``, ``buckets``."""
    if not 0 < accuracy < 1:
        raise ValueError("accuracy must lie between 0 and 1")
    seg_names = resolve_names(df, parse_segments(segments), "segment column")
    names = [c for c in df.columns if not is_control_column(c)] if columns is None \
        else resolve_names(df, columns, "profiled column")
    names = [n for n in names if type_class(df.schema[n].dataType) in ("integral", "fractional")]
    alias = [f"__s{i}" for i in range(len(seg_names))]
    segment = Segmenting([col(n).alias(a) for n, a in zip(seg_names, alias)], alias, F.lit(bool(seg_names)),
                         E.segment_json(seg_names, [F.col(a) for a in alias]), E.segment_partition_name(seg_names))
    keys = [_key(df, c) for c in partition_by or []]
    taken = sorted({k.lower() for k, _ in keys} & {*PROFILE_KEYS, *STATE_COLUMNS})
    if taken:
        raise ValueError(f"partition column {taken[0]!r} is a column of the state; give it another name")
    pre, _, key_alias, group = grouped_rows(df, _timestamp(df, ts), Bucketing((B.parse_freq(freq),)), segment, keys,
                                            [(n, col(n), df.schema[n].dataType, None) for n in names], min_partitions)
    each = F.array(*[F.struct(F.lit(i).alias("c"), _bucket(F.col(f"__v{i}"), accuracy).alias("b"))
                     for i in range(len(names))]).cast("array<struct<c:int,b:struct<sign:int,i:int>>>")
    counted = pre.select(*group, F.explode(each).alias("e")).filter(F.col("e.b").isNotNull()) \
        .groupBy(*group, F.col("e.c").alias("c"), F.col("e.b.sign").alias("sign"), F.col("e.b.i").alias("i")) \
        .agg(F.count(F.lit(1)).alias("n"))
    name = F.element_at(F.array(*[F.lit(n) for n in names]).cast("array<string>"), F.col("c") + 1)
    return _gather(counted, [*group, "c"]).select(
        *[F.col(a).alias(n) for (n, _), a in zip(keys, key_alias)],
        B.epoch_ms(F.col("__bucket")).alias("dataset_timestamp"), segment.partition.alias("segment_partition"),
        segment.text.alias("segment"), name.alias("column"), F.lit(accuracy).alias("accuracy"), "n", "buckets")


def merge_quantiles(states: DataFrame, keys: Sequence[str] = PROFILE_KEYS) -> DataFrame:
    """The histograms of the union of all states of each ``keys`` tuple; states of different accuracy stay apart."""
    names = list(keys)
    alias = [f"__k{i}" for i in range(len(names))]
    by = [*alias, "column", "accuracy"]
    counted = states.select(*[col(k).alias(a) for k, a in zip(names, alias)], "column", "accuracy",
                            F.explode("buckets").alias("b")) \
        .groupBy(*by, F.col("b.sign").alias("sign"), F.col("b.i").alias("i")) \
        .agg(F.sum("b.n").cast("bigint").alias("n"))
    return _gather(counted, by).select(*[F.col(a).alias(n) for n, a in zip(names, alias)], "column", "accuracy", "n",
                                       "buckets")


def quantiles(states: DataFrame, levels: Sequence[float] = QUANTILES) -> DataFrame:
    """``states`` with ``quantiles``, one double for each level."""
    if any(not 0 <= q <= 1 for q in levels):
        raise ValueError("quantile levels lie between 0 and 1")
    # The bucket of a rank is the first whose running count exceeds it: one walk over the buckets for each rank.
    width = 2 * F.atanh("accuracy")  # ln g

    def value(rank: Column) -> Column:
        start = F.struct(F.lit(0).cast("bigint").alias("upto"), F.lit(None).cast("int").alias("sign"),
                         F.lit(None).cast("int").alias("i"))

        def step(s: Column, x: Column) -> Column:
            here = s.sign.isNull() & (s.upto + x.n > rank)
            return F.struct((s.upto + x.n).alias("upto"), F.when(here, x.sign).otherwise(s.sign).alias("sign"),
                            F.when(here, x.i).otherwise(s.i).alias("i"))

        def read(s: Column) -> Column:
            middle = F.exp(s.i * width) * 2 / (F.exp(width) + 1)
            return F.when(s.sign == 0, F.lit(0.0)).otherwise(s.sign * middle)

        return F.aggregate("buckets", start, step, read)

    def level(q: float) -> Column:
        at = F.lit(float(q)) * (F.col("n") - 1)
        low, high = value(F.floor(at)), value(F.ceil(at))
        return low + (high - low) * (at - F.floor(at))

    return states.withColumn("quantiles", F.array(*[level(q) for q in levels]))
