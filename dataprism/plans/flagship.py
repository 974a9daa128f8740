"""The flagship query: the canonical profile job end to end.

``events`` → rows of one day (filter on the raw time column, pushed to the scan) → partition by (day, event type) →
daily buckets → segment on event type → one profile per partition and segment, serialized, with the partition keys
beside the profile rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dataprism.operators.filters import filter_days
from dataprism.operators.profile import profile
from dataprism.sources.tables import table

FLAGSHIP_DAY = "2024-01-03"


def flagship(spark: SparkSession, sf_dir: str, day: str = FLAGSHIP_DAY) -> DataFrame:
    ev = filter_days(table(spark, sf_dir, "events"), "ts", day=day)
    p = profile(
        ev,
        "ts",
        freq="D",
        segments="event_type",
        partition_by=[F.to_date(F.col("ts")).cast("timestamp_ntz").alias("day"), "event_type"],
        serialize=True,
    )
    return p.select("day", "event_type", "profile_view", "dataset_timestamp", "segment_partition", "segment",
                    "rows_processed", "debug_info")
