"""Profile files as a source: many serialized profiles read as one DataFrame of profile structs.

Two encodings:

* ``base64``: text files, one base64 profile per line (what ``FileProfileWriter`` and ``profile_view`` hold);
  read with the text source, so large folders split across tasks.
* ``raw``: one profile per file as its raw serialized bytes (the JSON text), read with the ``binaryFile`` source.

Rows that do not decode come back with ``valid = false`` and a NULL profile instead of failing the job.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dataprism.functions import envelope as E


def read_profiles(spark: SparkSession, path: str, *, encoding: str = "base64", recursive: bool = True) -> DataFrame:
    """``source_file, dataset_timestamp, valid, profile`` for every profile under ``path``."""
    if encoding == "base64":
        raw = spark.read.option("recursiveFileLookup", str(recursive).lower()).text(path)
        raw = raw.filter(F.length(F.trim("value")) > 0)
        decoded = E.deserialize_profile(F.col("value"))
        src = F.input_file_name()
    elif encoding == "raw":
        raw = (
            spark.read.format("binaryFile")
            .option("recursiveFileLookup", str(recursive).lower())
            .load(path)
        )
        decoded = F.from_json(F.col("content").cast("string"), E.PROFILE_TYPE, E.JSON_OPTIONS)
        src = F.col("path")
    else:
        raise ValueError(f"unknown profile file encoding {encoding!r}: use 'base64' or 'raw'")
    out = raw.select(src.alias("source_file"), decoded.alias("profile"))
    valid = E.is_valid_profile(F.col("profile"))
    return out.select(
        "source_file",
        F.col("profile").getField("dataset_timestamp").alias("dataset_timestamp"),
        valid.alias("valid"),
        F.when(valid, F.col("profile")).alias("profile"),
    )

