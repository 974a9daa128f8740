"""``merge_profiles``: combine profiles of parts into the profile of the whole.

Salted partitions, per-task partials, or profiles written on different days for the same bucket all merge here:
counts add, extrema combine, moments are folded pairwise, and the sketches use their own merge aggregates.
``merge(profile(a), profile(b)) == profile(a ∪ b)`` holds exactly for the exact statistics.

Plan: explode the column maps (rows = profiles × columns, small), one aggregate per (keys, column) that combines parts
before the shuffle, and a regroup per keys whose ``collect_list`` is bounded by the number of columns of a profile.
Row counts and metadata come from the profiles themselves, so profiles without columns, or with differing columns,
count too. Where parts disagree on a metadata entry the smaller value is kept.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dataprism.functions import envelope as E
from dataprism.functions.stats import DEFAULT_TOPK_CAPACITY, STATS_TYPE, merge_stats
from dataprism.operators.config import col
from dataprism.operators.joins import join_on_keys

DEFAULT_KEYS = ("dataset_timestamp", "segment_partition", "segment")


def merge_profiles(profiles: DataFrame, keys: Sequence[str] = DEFAULT_KEYS, *, profile_col: str = "profile",
                   rows_col: str | None = "segment_rows", topk_capacity: int = DEFAULT_TOPK_CAPACITY,
                   sketches: bool = True) -> DataFrame:
    """One merged profile per distinct ``keys`` tuple; ``rows_col`` (if present) is summed. ``topk_capacity`` is the
    capacity of the merged frequent-items sketches, whatever the parts had; ``sketches=False`` for profiles made without
    sketches. Exact distinct counts do not merge; see ``operators.distinct``."""
    names = list(keys)
    alias = [f"__k{i}" for i in range(len(names))]
    has_rows = rows_col is not None and rows_col in profiles.columns
    body = col(profile_col)
    src = profiles.select(*[col(k).alias(a) for k, a in zip(names, alias)], body.alias("__p"),
                          (col(rows_col) if has_rows else F.lit(0)).alias("__rows"))
    merged = src.select(*alias, F.explode(F.col("__p").getField("columns")).alias("__name", "__stats")) \
        .groupBy(*alias, "__name").agg(merge_stats("__stats", sketches, topk_capacity).alias("__stats")) \
        .groupBy(*alias).agg(F.map_from_entries(F.collect_list(F.struct("__name", "__stats"))).alias("__cols"))
    meta = src.select(*alias, F.explode(F.col("__p").getField("metadata")).alias("__m", "__v")) \
        .groupBy(*alias, "__m").agg(F.min("__v").alias("__v")) \
        .groupBy(*alias).agg(F.map_from_entries(F.collect_list(F.struct("__m", "__v"))).alias("__meta"))
    out = src.groupBy(*alias).agg(F.sum("__rows").cast("bigint").alias("__rows"),
                                  F.min(F.col("__p").getField("dataset_timestamp")).alias("__ts"))
    out = join_on_keys(join_on_keys(out, merged, alias, "left"), meta, alias, "left")
    ts = F.col(alias[names.index("dataset_timestamp")]) if "dataset_timestamp" in names else F.col("__ts")
    none = F.create_map().cast(T.MapType(T.StringType(), STATS_TYPE))
    whole = E.profile_struct(ts, F.coalesce("__cols", none), F.coalesce("__meta", E.metadata_map()))
    return out.select(*[F.col(a).alias(k) for k, a in zip(names, alias)],
                      *([F.col("__rows").alias(rows_col)] if has_rows else []), whole.alias(profile_col))
