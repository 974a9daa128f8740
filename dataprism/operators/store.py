"""``ProfileStore``: a Parquet profile store whose writes are commits.

Rows are written as files of their own, ``data/commit=<id>/dataset_id=<d>/month=<m>/``, and appear with the commit of a
new list of files (see ``sources.manifest``). ``append`` adds files. ``replace_days`` replaces the (dataset, day) pairs
that the rows hold: the other days of their months are written again next to them, and the commit swaps the months'
files. Readers see the version before or after, never neither; a job that fails or a driver that dies between writing
and committing leaves the old version and some files that no version lists, which ``vacuum`` deletes.

What goes through the driver are file names, one a (dataset, month) and commit where rows fit one file. Two writers at
once: the second sees the conflict, takes the new version as its base and tries again.
"""

from __future__ import annotations

import uuid
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dataprism.functions import envelope as E
from dataprism.sources.manifest import DATA, CommitConflict, Manifest, Version

# Fixed value: columns of the store; the last two are folders.
STORE_SCHEMA = T.StructType([
    T.StructField("dataset_timestamp", T.LongType(), True), T.StructField("segment_partition", T.StringType(), True),
    T.StructField("segment", T.StringType(), True), T.StructField("profile", E.PROFILE_TYPE, True),
    T.StructField("day", T.StringType(), True), T.StructField("dataset_id", T.StringType(), True),
    T.StructField("month", T.StringType(), True)])
_NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"
ATTEMPTS = 5


class ProfileStore:
    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.manifest = spark, Manifest(path)

    def version(self) -> int:
        return self.manifest.read().number

    def read(self, version: int | None = None, *, dataset_id: str | None = None, start_day: str | None = None,
             end_day: str | None = None) -> DataFrame:
        """The profiles of a version (the latest by default); dataset id and day bounds choose files before any is
        opened."""
        files = [f for f in self.manifest.read(version).files
                 if (dataset_id is None or f["dataset_id"] == dataset_id)
                 and (start_day is None or (f["month"] or "") >= start_day[:7])
                 and (end_day is None or (f["month"] or "") <= end_day[:7])]
        df = self._read_files(files)
        if dataset_id is not None:
            df = df.filter(F.col("dataset_id") == dataset_id)
        if start_day is not None:
            df = df.filter(F.col("day") >= start_day)
        if end_day is not None:
            df = df.filter(F.col("day") <= end_day)
        return df

    def _read_files(self, files: list[dict]) -> DataFrame:
        if not files:
            return self.spark.createDataFrame([], STORE_SCHEMA)
        return self.spark.read.schema(T.StructType([*STORE_SCHEMA.fields, T.StructField("commit", T.StringType())])) \
            .option("basePath", self.manifest.uri(DATA)).parquet(*[self.manifest.uri(f["path"]) for f in files]) \
            .drop("commit").select(*STORE_SCHEMA.names)

    def _write(self, rows: DataFrame) -> list[dict]:
        """The rows as files that no version lists yet."""
        folder = f"{DATA}/commit={uuid.uuid4().hex}"
        # One writer per (dataset, month) instead of every task writing into every folder; AQE coalesces small folders
        # and splits a skewed one.
        rows.select(*STORE_SCHEMA.names).hint("rebalance", "dataset_id", "month") \
            .sortWithinPartitions("dataset_id", "month", "day") \
            .write.partitionBy("dataset_id", "month").parquet(self.manifest.uri(folder))
        return [_described(p) for p in self.manifest.listed(folder)]

    def append(self, rows: DataFrame) -> Version:
        """Add rows (``STORE_SCHEMA``)."""
        new = self._write(rows)
        for _ in range(ATTEMPTS):
            base = self.manifest.read()
            try:
                return self.manifest.commit(base, [*base.files, *new])
            except CommitConflict:
                continue
        raise CommitConflict(f"no commit in {ATTEMPTS} attempts")

    def replace_days(self, rows: DataFrame) -> Version:
        """Put rows in the place of what the store has of their (dataset, day) pairs."""
        new = self._write(rows)
        fresh = self._read_files(new)
        months = {(f["dataset_id"], f["month"]) for f in new}
        days = fresh.select(F.col("dataset_id").alias("__d"), F.col("day").alias("__y")).distinct()
        for _ in range(ATTEMPTS):
            base = self.manifest.read()
            touched = [f for f in base.files if (f["dataset_id"], f["month"]) in months]
            same_day = F.col("dataset_id").eqNullSafe(F.col("__d")) & F.col("day").eqNullSafe(F.col("__y"))
            kept = self._write(self._read_files(touched).join(days, same_day, "left_anti")) if touched else []
            left = [f for f in base.files if (f["dataset_id"], f["month"]) not in months]
            try:
                return self.manifest.commit(base, [*left, *kept, *new])
            except CommitConflict:
                continue
        raise CommitConflict(f"no commit in {ATTEMPTS} attempts")

    def vacuum(self, keep: int = 1) -> int:
        return self.manifest.vacuum(keep)


def _described(path: str) -> dict:
    parts = dict(p.split("=", 1) for p in path.split("/")[:-1] if "=" in p)
    value = {k: None if parts[k] == _NULL_FOLDER else unquote(parts[k]) for k in ("dataset_id", "month")}
    return {"path": path, **value}
