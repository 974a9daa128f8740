"""Joins of small per-key aggregates back onto a table, NULL keys included."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dataprism.operators.config import col


def join_on_keys(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join on ``keys`` where NULL matches NULL (``<=>``); still a hash/sort-merge join, keys kept once."""
    keys = list(keys)
    renamed = right.select(*[col(k).alias(f"__r{i}") for i, k in enumerate(keys)],
                           *[col(c) for c in right.columns if c not in keys])
    cond = [col(k).eqNullSafe(F.col(f"__r{i}")) for i, k in enumerate(keys)]
    return left.join(renamed, cond, how).drop(*[f"__r{i}" for i in range(len(keys))])
