"""SQL access: profiles and receipts as temporary views, so a pipeline can be written as SQL end to end.

    CREATE raw view (any SELECT)  ->  register_profile_view  ->  SELECT ... FROM <profiled view>
                                  ->  register_receipts_view ->  SELECT ... FROM <receipts view>

The views are DataFrame plans (the profile aggregation stays one Catalyst plan with pushed filters and pruned columns);
only the receipts view is backed by the staged table ``publish`` writes, because delivery is an action.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from dataprism.operators.profile import profile
from dataprism.operators.publish import publish


def _relation(spark: SparkSession, source: str | DataFrame) -> DataFrame:
    if isinstance(source, DataFrame):
        return source
    text = source.strip()
    if " " in text or text.lower().startswith(("select", "with", "(")):
        return spark.sql(text)
    return spark.table(text)


def register_profile_view(spark: SparkSession, view: str, source: str | DataFrame, ts: str, *,
                          partition_by: Sequence[str] = (), **profile_kwargs) -> DataFrame:
    """``CREATE TEMP VIEW view AS profile(source)``; ``source`` is a table/view name, a SELECT, or a DataFrame."""
    df = profile(_relation(spark, source), ts, partition_by=list(partition_by), **profile_kwargs)
    df.createOrReplaceTempView(view)
    return df


def register_receipts_view(spark: SparkSession, view: str, source: str | DataFrame, **publish_kwargs) -> DataFrame:
    """Publish the profiles selected by ``source`` and expose one receipt per row as ``view``."""
    receipts = publish(_relation(spark, source), **publish_kwargs)
    receipts.createOrReplaceTempView(view)
    return receipts
