"""``profile``: one statistical profile per (partition key × time bucket × segment), in one distributed aggregation.

Plan (all JVM-side built-in expressions, no Python in the row path)::

    scan (pruned to the profiled columns, filters pushed)
      -> project keys, bucket, segment values[, salt]
      -> HashAggregate/ObjectHashAggregate partial (map-side combine, one partial per task and group)
      -> Exchange hashpartitioning(group keys)
      -> final aggregate: one stats struct per column                         [L1]
      -> (salt only) merge of the small partials                              [L2]
      -> rows_processed / group_count: narrow per-(key, bucket) counts of the same projection (key and time
         columns only, keyed without segments), and their span per key, joined back

One plan serves every input size; nothing is decided from partition counts. ``salt=n`` is an explicit argument: it
adds ``pmod(spark_partition_id(), n)`` to the L1 key. A task still emits at most one partial per group, but a hot
group's partials are spread over ``n`` reducers, and L2 merges at most ``n`` partials per group. Use it where a group
is present in very many input splits.

Origin-dependent frequencies (``5D``, ``7h`` ...) bucket from midnight of the partition's earliest row. The origins
(one small row per partition key, from a narrow pass over keys and time) are joined to the rows, so every row gets its
bucket at once and there is one statistics group per profile. Spark broadcasts the origins when their measured size
allows.

``exact=True`` adds exact distinct counts: per column, rows are reduced to distinct (group, value) pairs before and
after one shuffle by (group, value), then counted; a hot group is spread over its values. ``columns_per_pass`` splits
wide column sets into several aggregations joined per group.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dataprism.functions import buckets as B
from dataprism.functions import envelope as E
from dataprism.functions.stats import DEFAULT_TOPK_CAPACITY, column_stats, exact_value, merge_stats, type_class
from dataprism.operators.config import DEFAULT_FREQ, col, is_control_column, parse_segments, resolve_names
from dataprism.operators.joins import join_on_keys

NULL_TS_MESSAGE = "Rows without an event time cannot be profiled by segment; filter them out first."

PROFILE_COLUMNS = ["dataset_timestamp", "segment_partition", "segment", "rows_processed", "debug_info"]


@dataclass(frozen=True)
class Bucketing:
    """The frequencies of an input: one for all rows, or several told apart by the text column ``which``.

    However many fixed widths there are, they are one branch whose width is looked up by the row's frequency; the
    calendar frequencies are a branch each, and there are few of those."""

    freqs: tuple[B.Freq, ...]
    which: Column | None = None

    def _choose(self, aligned: Callable[[int | Column], Column], origin: Callable[[int | Column], Column],
                calendar: Callable[[B.Freq], Column]) -> Column:
        def one(f: B.Freq, width: int | Column) -> Column:
            return calendar(f) if f.kind != "tick" else origin(width) if f.origin_dependent else aligned(width)

        if self.which is None:
            return one(self.freqs[0], self.freqs[0].width_ms)
        branches: dict[tuple, list[B.Freq]] = {}
        for f in self.freqs:
            several = f.mult if f.kind != "tick" else 1
            branches.setdefault((f.kind, f.anchor, several, f.origin_dependent), []).append(f)
        out = None
        for same_kind in branches.values():
            width = F.lit(None)
            if same_kind[0].kind == "tick":
                width = F.element_at(F.create_map(*[x for f in same_kind for x in (
                    F.lit(f.text), F.lit(f.width_ms).cast("bigint"))]), self.which)
            when = (F if out is None else out).when
            out = when(self.which.isin([f.text for f in same_kind]), one(same_kind[0], width))
        return out

    @property
    def needs_origin(self) -> bool:
        return any(f.origin_dependent for f in self.freqs)

    def label(self, ts: Column, origin: Column) -> Column:
        day = B.parse_freq(DEFAULT_FREQ)
        aligned = lambda w: B.bucket_label(ts, day) if w == day.width_ms else B.floor_ms(ts, w)
        if self.which is not None:
            aligned = lambda w: B.floor_ms(ts, w)
        return self._choose(aligned, lambda w: B.origin_label(ts, origin, w), lambda f: B.bucket_label(ts, f, origin))

    def ordinal(self, label: Column) -> Column:
        ticks = lambda w: B.floor_div(B.epoch_ms(label), w)
        return self._choose(ticks, ticks, lambda f: B.bucket_ordinal(label, f))


def _key(df: DataFrame, c: str | Column) -> tuple[str, Column]:
    if isinstance(c, str):
        name = resolve_names(df, [c], "partition column")[0]
        return name, col(name)
    return df.select(c).columns[0], c


def _timestamp(df: DataFrame, ts: str | Column) -> Column:
    """Event time as timestamp_ntz in UTC; numbers are epoch milliseconds."""
    if isinstance(ts, str):
        name = resolve_names(df, [ts], "event-time column")[0]
        c = col(name)
        dt = df.schema[name].dataType
    else:
        c = ts
        dt = df.select(ts).schema[0].dataType
    if isinstance(dt, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return B.from_epoch_ms(c.cast("bigint"))
    if isinstance(dt, (T.FloatType, T.DoubleType, T.DecimalType)):
        return B.from_epoch_ms(F.floor(c).cast("bigint"))
    if isinstance(dt, T.TimestampType):
        return B.utc_ntz(c)
    if isinstance(dt, (T.TimestampNTZType, T.DateType)):
        return c.cast("timestamp_ntz")
    raise TypeError(f"event-time column must be a timestamp, date or epoch-millisecond number, not {dt.simpleString()}")


def profile(
    df: DataFrame,
    ts: str | Column,
    *,
    freq: str = DEFAULT_FREQ,
    segments: str | Iterable[str] | None = None,
    partition_by: Sequence[str | Column] | None = None,
    passthrough: dict[str, str] | None = None,
    columns: Sequence[str] | None = None,
    salt: int | None = None,
    exact: bool = False,
    sketches: bool = True,
    topk_capacity: int = DEFAULT_TOPK_CAPACITY,
    metadata: dict[str, str] | None = None,
    serialize: bool = False,
    min_partitions: int | None = None,
    columns_per_pass: int | None = None,
    one_pass: bool = False,
) -> DataFrame:
    """Profile ``df`` per partition key, time bucket of ``ts`` at ``freq``, and segment.

    Output columns: the partition keys, ``passthrough`` columns (typed NULL: a summary of many rows has no single
    value for a non-key column), ``dataset_timestamp`` (bucket label, epoch ms), ``segment_partition`` (CSV of
    segment names or NULL), ``segment`` (JSON of the segment values or NULL), ``rows_processed`` (rows of the bucket
    in the partition — on every segment row, as the whole bucket was handed to the profiler), ``segment_rows``
    (rows of this profile), ``group_count`` (bins from the partition's first to last bucket, empty ones included),
    ``debug_info`` and ``profile`` (struct, see ``envelope.PROFILE_TYPE``) or, with ``serialize=True``,
    ``profile_view`` (its base64 text).

    Profiled columns: every column of ``df`` except the control columns, including the event-time and segment
    columns; ``columns`` narrows the set (and the scan).

    ``min_partitions``: hash-spread the rows over that many partitions first, for an input of few, unsplittable
    files. It shuffles every profiled column, so it is never done unasked.

    ``one_pass``: take ``rows_processed`` and ``group_count`` from the profiles' own partial aggregates instead of a
    second, narrow pass over the input. The right choice where rows are dear to make (a join, JSON, a variant); over
    columnar files the narrow pass costs less than merging the partials twice.
    """
    fq = B.parse_freq(freq)
    seg_names = resolve_names(df, parse_segments(segments), "segment column")
    if columns is None:
        names = [c for c in df.columns if not is_control_column(c)]
    else:
        names = resolve_names(df, columns, "profiled column")
    values = [(n, col(n), df.schema[n].dataType, None) for n in names]
    seg_alias = [f"__s{i}" for i in range(len(seg_names))]
    segment = Segmenting([col(n).alias(a) for n, a in zip(seg_names, seg_alias)], seg_alias,
                         F.lit(bool(seg_names)), E.segment_json(seg_names, [F.col(a) for a in seg_alias]),
                         E.segment_partition_name(seg_names))
    return profile_rows(df, _timestamp(df, ts), Bucketing((fq,)), segment, [_key(df, c) for c in partition_by or []],
                        values, passthrough=passthrough, salt=salt, exact=exact, sketches=sketches,
                        topk_capacity=topk_capacity, metadata=metadata, serialize=serialize,
                        min_partitions=min_partitions, columns_per_pass=columns_per_pass, one_pass=one_pass)


@dataclass(frozen=True)
class Segmenting:
    """How rows are segmented: the segment columns (aliased to ``names``), whether a row is segmented, and the
    segment's text and its partition's name as expressions over ``names``."""

    columns: list[Column]
    names: list[str]
    applies: Column
    text: Column
    partition: Column


def grouped_rows(df: DataFrame, ts: Column, bucketing: Bucketing, segment: Segmenting, keys: list[tuple[str, Column]],
                 values: list[tuple[str, Column, T.DataType, Column | None]], min_partitions: int | None = None
                 ) -> tuple[DataFrame, Bucketing, list[str], list[str]]:
    """The rows with their profile's keys (``__k*``, ``__fq``, ``__bucket``, segment names) and values (``__v*``), the
    bucketing over them, the names of the partition keys and of all keys."""
    # One projection with positional aliases: column names of any spelling stay safe inside SQL fragments.
    key_alias = [f"__k{i}" for i in range(len(keys))]
    which = [bucketing.which.alias("__fq")] if bucketing.which is not None else []
    pre = df.select(
        *[c.alias(a) for (_, c), a in zip(keys, key_alias)],
        *segment.columns, *which, ts.alias("__ts"), segment.applies.alias("__segmented"),
        *[v.alias(f"__v{i}") for i, (_, v, _, _) in enumerate(values)],
        *[p.alias(f"__p{i}") for i, (_, _, _, p) in enumerate(values) if p is not None],
    )
    if which:
        bucketing = Bucketing(bucketing.freqs, F.col("__fq"))
    pre = pre.filter(F.col("__segmented") | F.col("__ts").isNotNull())
    if min_partitions is not None:
        # Row ids are stable per input partition, so a retried task sends every row to the same place.
        pre = pre.repartition(min_partitions, F.monotonically_increasing_id())
    if bucketing.needs_origin:
        first = B.to_ntz(F.to_date(F.min("__ts"))).alias("__origin")
        if key_alias:
            pre = join_on_keys(pre, pre.groupBy(*key_alias).agg(first), key_alias)
        else:
            # A global aggregate is exactly one row: attached as a scalar subquery, no join.
            pre = pre.withColumn("__origin", pre.agg(first).scalar())
    label = bucketing.label(F.col("__ts"), F.col("__origin"))
    # Inside the grouping key the check always runs; segmented rows without event time fail the job.
    bucket = F.when(F.col("__ts").isNull(), F.raise_error(F.lit(NULL_TS_MESSAGE))).otherwise(label)
    pre = pre.withColumn("__bucket", bucket)
    return pre, bucketing, key_alias, [*key_alias, *(["__fq"] if which else []), "__bucket", *segment.names]


def profile_rows(df: DataFrame, ts: Column, bucketing: Bucketing, segment: Segmenting,
                 keys: list[tuple[str, Column]], values: list[tuple[str, Column, T.DataType, Column | None]], *,
                 passthrough: dict[str, str] | None = None, salt: int | None = None, exact: bool = False,
                 sketches: bool = True, topk_capacity: int = DEFAULT_TOPK_CAPACITY,
                 metadata: dict[str, str] | None = None, serialize: bool = False, min_partitions: int | None = None,
                 columns_per_pass: int | None = None, one_pass: bool = False) -> DataFrame:
    """``profile`` over expressions. ``values``: (name, value, type, whether the value was there before a cast)."""
    if salt is not None and (not isinstance(salt, int) or salt < 1):
        raise ValueError("salt must be a positive integer")
    pre, bucketing, key_alias, group = grouped_rows(df, ts, bucketing, segment, keys, values, min_partitions)
    which = ["__fq"] if bucketing.which is not None else []
    salted = [*group, "__salt"] if salt and salt > 1 else group
    if salt and salt > 1:
        pre = pre.withColumn("__salt", F.pmod(F.spark_partition_id(), F.lit(salt)))

    def stats(i: int) -> Column:
        _, _, kind, present = values[i]
        return column_stats(f"__v{i}", kind, topk_capacity=topk_capacity, sketches=sketches,
                            present=f"`__p{i}`" if present is not None else None).alias(f"__c{i}")

    size = columns_per_pass or max(1, len(values))
    chunks = [range(at, min(at + size, len(values))) for at in range(0, max(1, len(values)), size)]
    l1 = None
    for chunk in chunks:
        part = pre.groupBy(*salted).agg(F.count(F.lit(1)).cast("bigint").alias("__n"), *[stats(i) for i in chunk])
        l1 = part if l1 is None else join_on_keys(l1, part.drop("__n"), salted)
    # Rows per (partition, bucket), by default from the same projection. Catalyst prunes it to a narrow pass over the key and time
    # columns with map-side partial counts, keyed without segments (tiny even for high-cardinality segments).
    narrow_keys = [*key_alias, *which, "__bucket"]
    narrow = pre.groupBy(*narrow_keys).agg(F.count(F.lit(1)).cast("bigint").alias("__rows"))
    if salt and salt > 1:
        l1 = l1.groupBy(*group).agg(
            F.sum("__n").cast("bigint").alias("__n"),
            *[merge_stats(f"__c{i}", sketches, topk_capacity).alias(f"__c{i}") for i in range(len(values))])
    if one_pass:
        narrow = bucket_rows(l1, narrow_keys, [f"__c{i}" for i in range(len(values))])
    if exact:
        l1 = _with_exact_distinct(l1, pre, group, values)
    prof = _attach_bucket_facts(l1, narrow, key_alias, narrow_keys, bucketing)

    if values:
        cmap = F.create_map(*[x for i, (n, _, _, _) in enumerate(values) for x in (F.lit(n), F.col(f"__c{i}"))])
    else:
        cmap = F.create_map().cast(T.MapType(T.StringType(), E.STATS_TYPE))
    return prof.select(*[F.col(a).alias(n) for (n, _), a in zip(keys, key_alias)],
                       *envelope_columns(F.col("__bucket"), cmap, segment, passthrough, metadata, serialize))


def bucket_rows(prof: DataFrame, bucket_keys: list[str], stats: list[str]) -> DataFrame:
    """``__rows`` of every (partition, bucket), summed over the profiles in it. Their statistics are read too (as a hash
    that is never null), so that this aggregate has the same input as the profiles and shares their exchange: the rows
    are read once. Without that, Catalyst would prune it to a count and read the rows again."""
    rows = F.sum("__n").cast("bigint")
    if not stats:
        return prof.groupBy(*bucket_keys).agg(rows.alias("__rows"))
    out = prof.groupBy(*bucket_keys).agg(rows.alias("__sum"), F.max(F.xxhash64(*stats)).alias("__all"))
    return out.select(*bucket_keys, F.when(F.col("__all").isNotNull(), F.col("__sum")).alias("__rows"))


def envelope_columns(bucket: Column, columns: Column, segment: Segmenting, passthrough: dict[str, str] | None,
                     metadata: dict[str, str] | None, serialize: bool) -> list[Column]:
    """The output columns after the partition keys."""
    ts_ms = B.epoch_ms(bucket)
    body = E.profile_struct(ts_ms, columns, E.metadata_map(metadata))
    return [
        *[F.lit(None).cast(ddl).alias(name) for name, ddl in (passthrough or {}).items()],
        ts_ms.alias("dataset_timestamp"),
        segment.partition.alias("segment_partition"),
        segment.text.alias("segment"),
        F.col("__rows").alias("rows_processed"),
        F.col("__n").alias("segment_rows"),
        F.col("__gc").alias("group_count"),
        E.debug_info(F.col("__gc"), segment.text).alias("debug_info"),
        (E.serialize_profile(body).alias("profile_view") if serialize else body.alias("profile")),
    ]


def _with_exact_distinct(prof: DataFrame, pre: DataFrame, group: list[str],
                         values: list[tuple[str, Column, T.DataType, Column | None]]) -> DataFrame:
    """``prof`` with the exact distinct count of each column: distinct (group, value) pairs, made unique in each task
    before one shuffle by the pair, then counted by group. Every column's pass reads that column and the keys."""
    counts = []
    for i, (_, _, kind, _) in enumerate(values):
        if type_class(kind) in ("other", "variant"):
            continue
        pairs = pre.select(*group, exact_value(F.col(f"__v{i}"), kind).alias("__x")).filter(F.col("__x").isNotNull()).distinct()
        counts.append(pairs.groupBy(*group).agg(F.count(F.lit(1)).alias("__d")).withColumn("__i", F.lit(i)))
    if not counts:
        return prof
    long = reduce(DataFrame.unionByName, counts)
    wide = long.groupBy(*group).agg(*[F.max(F.when(F.col("__i") == i, F.col("__d"))).alias(f"__d{i}")
                                      for i in range(len(values))])
    prof = join_on_keys(prof, wide, group, "left")
    for i, (_, _, kind, _) in enumerate(values):
        if type_class(kind) not in ("other", "variant"):
            prof = prof.withColumn(f"__c{i}", F.col(f"__c{i}").withField(
                "exact_distinct", F.coalesce(f"__d{i}", F.lit(0)).cast("bigint")))
    return prof.drop(*[f"__d{i}" for i in range(len(values))])


def _attach_bucket_facts(prof: DataFrame, rows: DataFrame, key_alias: list[str], bucket_keys: list[str],
                         bucketing: Bucketing) -> DataFrame:
    """``__rows`` = rows of (partition, bucket); ``__gc`` = bins from the partition's first to last bucket.

    Both come from the narrow per-(partition, bucket) counts and a second aggregate of those per partition; the span
    branch reuses the first one's exchange. They are joined back on their keys (NULL-safe); AQE broadcasts them when
    the measured size allows and keeps a shuffle join otherwise. No window collects a partition's profiles into one
    task.
    """
    ordinal = bucketing.ordinal(F.col("__bucket"))
    # Referencing ``__rows`` keeps the span branch's subtree identical to the rows branch, so the two share one
    # exchange (and one narrow scan) instead of Catalyst collapsing the span into a second pass over the input.
    gc = F.when(F.sum("__rows") >= 0, F.max(ordinal) - F.min(ordinal) + 1).cast("bigint").alias("__gc")
    prof = join_on_keys(prof, rows, bucket_keys)
    if key_alias:
        return join_on_keys(prof, rows.groupBy(*key_alias).agg(gc), key_alias)
    # A global aggregate is exactly one row: attached as a scalar subquery, no join.
    return prof.withColumn("__gc", rows.agg(gc).scalar())
