"""Profile envelope: the profile struct, its text form, segment keys and debug text.

A profile is ``struct<dataset_timestamp bigint, metadata map<string,string>, columns map<string, STATS_TYPE>>``.
Its serialized form (``profile_view``) is ``base64(to_json(profile))`` with the line breaks Spark's ``base64`` adds
removed; sketches are binary fields, which JSON carries as base64 and ``from_json`` restores as working sketches.
A segment is stored as the JSON object of its column values (not as a pickled object: decoding table data must never
run code), and the segmented partition's name is the comma-joined list of segment column names.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dataprism.functions.stats import STATS_TYPE
from dataprism.version import INTEGRATION_NAME, __version__

PROFILE_TYPE = T.StructType(
    [
        T.StructField("dataset_timestamp", T.LongType(), True),
        T.StructField("metadata", T.MapType(T.StringType(), T.StringType(), True), True),
        T.StructField("columns", T.MapType(T.StringType(), STATS_TYPE, True), True),
    ]
)
PROFILE_DDL = PROFILE_TYPE.simpleString()

# Timestamps inside the JSON keep microseconds (the default JSON format stops at milliseconds).
JSON_OPTIONS = {
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
}


def metadata_map(extra: dict[str, str] | None = None) -> Column:
    """Metadata attached to every profile: integration name and version, plus caller entries."""
    entries = {**(extra or {}), "integration": INTEGRATION_NAME, "integration_version": __version__}
    args: list[Column] = []
    for k, v in entries.items():
        args += [F.lit(k), F.lit(str(v))]
    return F.create_map(*args)


def profile_struct(dataset_timestamp: Column, columns: Column, metadata: Column | None = None) -> Column:
    return F.struct(
        dataset_timestamp.cast("bigint").alias("dataset_timestamp"),
        (metadata if metadata is not None else metadata_map()).alias("metadata"),
        columns.alias("columns"),
    )


def serialize_profile(profile: Column) -> Column:
    """``profile`` struct -> base64 text (single line)."""
    return F.regexp_replace(F.base64(F.to_json(profile, JSON_OPTIONS).cast("binary")), r"\s", "")


def decode_profile_bytes(view: Column) -> Column:
    """base64 text -> bytes, or NULL when the text is not valid base64."""
    return F.try_to_binary(F.regexp_replace(view, r"\s", ""), F.lit("base64"))


def deserialize_profile(view: Column) -> Column:
    """base64 text -> ``PROFILE_TYPE`` struct; NULL for text that is not base64 (JSON junk gives NULL fields)."""
    return F.from_json(decode_profile_bytes(view).cast("string"), PROFILE_TYPE, JSON_OPTIONS)


def is_valid_profile(decoded: Column) -> Column:
    """A decoded profile is usable when its required fields are present."""
    return (
        decoded.isNotNull()
        & decoded.getField("dataset_timestamp").isNotNull()
        & decoded.getField("columns").isNotNull()
    )


def segment_json(names: list[str], values: list[Column]) -> Column:
    """Segment key as a JSON object, nulls kept (``{"a":null}``)."""
    if not names:
        return F.lit(None).cast("string")
    return F.to_json(F.struct(*[v.alias(n) for n, v in zip(names, values)]), {**JSON_OPTIONS, "ignoreNullFields": "false"})


def segment_partition_name(names: list[str]) -> Column:
    return F.lit(",".join(names)) if names else F.lit(None).cast("string")


def debug_info(group_count: Column, segment: Column) -> Column:
    """``key: value`` lines: the number of bins of the partition and, when segmented, the segment key."""
    return F.concat_ws("\n", F.concat(F.lit("group_count: "), group_count.cast("string")),
                       F.concat(F.lit("segment_key: "), segment))
