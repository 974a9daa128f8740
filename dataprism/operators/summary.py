"""``profile_summary``: profiles as a long table, one row per (profile, column).

The printable form of a profile: counts, extrema, moments, length statistics, and the sketch read-outs (KLL
quantiles, HLL distinct estimate, frequent items). Works on every profile at once — ``explode`` of the column map —
so inspecting thousands of stored profiles is one distributed job, not a loop.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dataprism.operators.config import col

# Quantile levels reported for numeric columns.
QUANTILES = (0.01, 0.05, 0.25, 0.5, 0.75, 0.95, 0.99)
DEFAULT_TOP_ITEMS = 10


def _stat(name: str) -> Column:
    return F.col("__stats").getField(name)


def exact_extremum(which: str) -> Column:
    """Text of the exact extremum of integers and decimals (``min``/``max`` are doubles, good for 53 bits)."""
    whole, unscaled = _stat(f"int_{which}"), _stat(f"dec_{which}")
    scale = F.regexp_extract(_stat("col_type"), r"^decimal\(\d+,(\d+)\)$", 1)
    scale = F.when(scale == "", F.lit(0)).otherwise(scale.cast("int"))
    digits = F.lpad(F.abs(unscaled).cast("string"), F.greatest(scale + 1, F.length(F.abs(unscaled).cast("string"))), "0")
    point = F.length(digits) - scale
    text = F.concat(F.when(unscaled < 0, F.lit("-")).otherwise(F.lit("")), F.substring(digits, F.lit(1), point),
                    F.when(scale > 0, F.concat(F.lit("."), F.substring(digits, point + 1, scale))).otherwise(F.lit("")))
    return F.coalesce(whole.cast("string"), text)


def stats_columns(top_items: int = DEFAULT_TOP_ITEMS, sketches: bool = True) -> list[Column]:
    """Summary expressions over a ``STATS_TYPE`` column named ``__stats``."""
    n = _stat("num_n")
    nonnull = _stat("count") - _stat("null_count")
    kll_ok = _stat("kll").isNotNull() & (F.kll_sketch_get_n_double(_stat("kll")) > 0)
    out = [
        _stat("col_type").alias("column_type"),
        _stat("count").alias("count"),
        _stat("null_count").alias("null_count"),
        _stat("nan_count").alias("nan_count"),
        _stat("inf_count").alias("inf_count"),
        _stat("n_integral").alias("n_integral"),
        _stat("n_fractional").alias("n_fractional"),
        _stat("n_boolean").alias("n_boolean"),
        _stat("n_string").alias("n_string"),
        _stat("n_temporal").alias("n_temporal"),
        _stat("n_other").alias("n_other"),
        _stat("num_min").alias("min"),
        _stat("num_max").alias("max"),
        _stat("num_mean").alias("mean"),
        F.when(n > 1, F.sqrt(F.greatest(_stat("num_m2"), F.lit(0.0)) / (n - 1))).alias("stddev"),
        _stat("str_min").alias("min_str"),
        _stat("str_max").alias("max_str"),
        _stat("ts_min").alias("min_ts"),
        _stat("ts_max").alias("max_ts"),
        _stat("len_min").alias("min_len"),
        _stat("len_max").alias("max_len"),
        F.when(nonnull > 0, _stat("len_sum") / nonnull).alias("mean_len"),
        _stat("exact_distinct").alias("distinct_exact"),
        exact_extremum("min").alias("min_exact"),
        exact_extremum("max").alias("max_exact"),
    ]
    if sketches:
        out += [
            F.when(_stat("hll").isNotNull(), F.hll_sketch_estimate(_stat("hll"))).alias("distinct_est"),
            F.when(kll_ok, F.kll_sketch_get_quantile_double(_stat("kll"), F.array(*[F.lit(q) for q in QUANTILES])))
            .alias("quantiles"),
            F.when(
                _stat("topk").isNotNull(),
                F.call_function("approx_top_k_estimate", _stat("topk"), F.lit(top_items)),
            ).alias("top_items"),
        ]
    return out


def profile_summary(profiles: DataFrame, keys: Sequence[str] | None = None, *, profile_col: str = "profile",
                    top_items: int = DEFAULT_TOP_ITEMS, sketches: bool = True, metadata: bool = False) -> DataFrame:
    """Long table of ``profiles``: ``keys`` (default: every non-profile column), the profile's ``metadata`` map if
    asked for, ``column_name`` and statistics."""
    if keys is None:
        keys = [c for c in profiles.columns if c not in (profile_col, "debug_info")]
    exploded = profiles.select(
        *[col(k) for k in keys],
        col(profile_col).getField("metadata").alias("__metadata"),
        F.explode(col(profile_col).getField("columns")).alias("column_name", "__stats"),
    )
    extra = [F.col("__metadata").alias("metadata")] if metadata else []
    return exploded.select(*[col(k) for k in keys], *extra, "column_name", *stats_columns(top_items, sketches))
