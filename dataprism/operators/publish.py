"""``publish``: deliver serialized profiles to a profile store and return one receipt per input row.

Input: the output of ``profile(..., serialize=True)`` (or any frame with ``profile_view`` and optionally
``segment_partition`` / ``segment``) plus a dataset id (column name, literal or Column).

Plan::

    input ─► decode + validate (built-in expressions; profile structs go straight through)
          ├► store: valid rows, one Parquet write partitioned by (dataset_id, month)      [store mode]
          │   or per-row delivery through a writer inside mapInPandas                      [writer mode]
          └► receipts: one narrow row per input row, written to the shared folder

In store mode the validated rows are persisted (memory and disk of the executors) between the two writes, so the
profile job runs once, and a lost executor's part is computed again. In writer mode they are written to the shared
folder first, so that a delivery that is tried again sends the same bytes; that table is deleted afterwards.

Receipts have the columns ``dataset_id, result, error, dataset_timestamp, segment``:

* delivered: ``result='Ok'``, ``error`` NULL, the profile's epoch-ms timestamp, the segment text (NULL unsegmented);
* payload that does not decode (not base64, not a profile, required fields missing), a segment that does not match
  its partition or has none, a missing dataset id: ``result`` NULL, an error text of its own (of a payload its length
  and md5, never the payload), ``dataset_timestamp = -1``, ``segment = 'Error'``;
* delivery failure: ``result`` NULL, the error text, the profile's timestamp (as bigint) and segment.

Deviations from a per-partition handler (kept deliberately): exactly one receipt per input row; the mode
(segmented or not) is decided per row by ``segment IS NOT NULL`` (and nothing else); a multi-column segment partition keeps all its
columns; in store mode a failed write job fails every delivery of that call (a Spark write is all-or-nothing), and
the receipts say so. Writer mode is at-least-once: a retried task re-sends its rows, so receivers should key profiles
by (dataset id, timestamp, segment, content).
"""

from __future__ import annotations

import base64
import hashlib
import logging
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.storagelevel import StorageLevel

from dataprism.functions import envelope as E
from dataprism.functions.buckets import from_epoch_ms
from dataprism.operators.config import col, resolve_names
from dataprism.operators.store import STORE_SCHEMA, ProfileStore
from dataprism.session import drop_path, path_exists, scratch_path, ship_package
from dataprism.sources.manifest import Manifest

log = logging.getLogger(__name__)

RECEIPT_SCHEMA = T.StructType(
    [
        T.StructField("dataset_id", T.StringType(), True),
        T.StructField("result", T.StringType(), True),
        T.StructField("error", T.StringType(), True),
        T.StructField("dataset_timestamp", T.LongType(), True),
        T.StructField("segment", T.StringType(), True),
    ]
)
RECEIPT_COLUMNS = [f.name for f in RECEIPT_SCHEMA.fields]

# Receipt texts.
OK = "Ok"
ERROR_SEGMENT = "Error"
ERROR_PREFIX = "Error uploading: "


def _optional(df: DataFrame, name: str) -> Column:
    found = [c for c in df.columns if c.lower() == name.lower()]
    return col(found[0]) if found else F.lit(None).cast("string")


def _dataset_id(df: DataFrame, dataset_id: str | Column | None) -> Column:
    if dataset_id is None:
        found = [c for c in df.columns if c.lower() == "dataset_id"]
        if not found:
            raise ValueError(f"dataset id column not found in input with columns: {df.columns}")
        return col(found[0]).cast("string")
    if isinstance(dataset_id, Column):
        return dataset_id.cast("string")
    if dataset_id in df.columns or dataset_id.lower() in (c.lower() for c in df.columns):
        return col(resolve_names(df, [dataset_id], "dataset id column")[0]).cast("string")
    return F.lit(dataset_id)


def segment_matches_partition(segment: Column, segment_partition: Column) -> Column:
    """A segment JSON object whose keys, joined by commas, are the name of its partition (order kept; blanks around
    commas don't count, so names may hold commas themselves)."""
    def plain(c: Column) -> Column:
        return F.trim(F.regexp_replace(c, r"\s*,\s*", ","))

    keys = F.array_join(F.map_keys(F.from_json(segment, "map<string,string>")), ",")
    return F.coalesce(plain(keys) == plain(segment_partition), F.lit(False))


def decode_error(view: Column) -> Column:
    """Error text of a payload that does not decode: its length and md5, not the payload."""
    return F.when(view.isNull(), F.lit(ERROR_PREFIX + "profile payload is missing")).otherwise(
        F.concat(
            F.lit(ERROR_PREFIX + "profile payload could not be decoded ("),
            F.length(view).cast("string"),
            F.lit(" characters, md5 "),
            F.md5(view.cast("binary")),
            F.lit(")"),
        )
    )


def stage(profiles: DataFrame, dataset_id: str | Column | None = None, *, profile_col: str = "profile_view",
          text: bool = False) -> DataFrame:
    """One row per input row: dataset id, validity, the profile and the receipt fields.

    Takes serialized profiles (``profile_view`` text) or, when that column is absent, the ``profile`` struct of
    ``profile(..., serialize=False)``. ``text`` keeps the serialized form (for writers) instead of the struct."""
    if profile_col not in profiles.columns and "profile" in profiles.columns:
        body, view = F.col("profile"), F.lit(None).cast("string")
        out = E.serialize_profile(body) if text else body
        unreadable = F.when(body.isNull(), F.lit(ERROR_PREFIX + "profile payload is missing")) \
            .otherwise(F.lit(ERROR_PREFIX + "profile has no timestamp or columns"))
    else:
        view = col(resolve_names(profiles, [profile_col], "profile column")[0])
        body = E.deserialize_profile(view)
        out = view if text else body
        unreadable = decode_error(view)
    part, seg, dataset = _optional(profiles, "segment_partition"), _optional(profiles, "segment"), _dataset_id(
        profiles, dataset_id)
    error = F.when(~E.is_valid_profile(body), unreadable) \
        .when(dataset.isNull(), F.lit(ERROR_PREFIX + "dataset id is missing")) \
        .when(seg.isNotNull() & part.isNull(), F.lit(ERROR_PREFIX + "segment has no segment partition")) \
        .when(seg.isNotNull() & ~segment_matches_partition(seg, part),
              F.lit(ERROR_PREFIX + "segment does not match its segment partition"))
    s = profiles.select(dataset.alias("dataset_id"), part.alias("__part"), seg.alias("__seg"), error.alias("decode_error"),
                        body.getField("dataset_timestamp").alias("__ts"), out.alias("__profile"))
    valid = F.col("decode_error").isNull()
    return s.select(
        "dataset_id",
        valid.alias("valid"),
        F.when(valid, F.col("__ts")).otherwise(F.lit(-1)).cast("bigint").alias("dataset_timestamp"),
        F.when(valid & F.col("__seg").isNotNull(), F.col("__part")).alias("segment_partition"),
        F.when(valid, F.col("__seg")).otherwise(F.lit(ERROR_SEGMENT)).alias("segment"),
        "decode_error",
        F.when(valid, F.col("__profile")).alias("profile_view" if text else "profile"),
    )


def write_scratch(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """A table in the shared folder, and its path."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def _day(ts_ms: Column) -> Column:
    return F.date_format(from_epoch_ms(ts_ms), "yyyy-MM-dd")


def publish(profiles: DataFrame, path: str | None = None, *, dataset_id: str | Column | None = None,
            writer_factory: Callable[[str], object] | None = None, profile_col: str = "profile_view",
            receipts_path: str | None = None, replace_days: bool = False, versioned: bool = False) -> DataFrame:
    """Deliver ``profiles`` and return the receipts DataFrame (one row per input row).

    Store mode (``path``): valid profiles are appended to a Parquet profile store partitioned by ``dataset_id`` and
    ``month``, sorted by ``day`` within files (see ``read_store``); ``replace_days=True`` replaces exactly the
    (dataset, day) pairs that this call delivers, so re-running a publish does not duplicate profiles. ``versioned`` (once
    given, the store stays so) makes each call one commit: readers see the store before or after it, also when days are
    replaced and when a job fails half-way (see ``operators.store``). Writer mode
    (``writer_factory``): each valid profile is handed to ``writer_factory(dataset_id).write(...)`` inside the
    executors; writers are cached per task and dataset id.
    """
    if (path is None) == (writer_factory is None):
        raise ValueError("give exactly one of path (profile store) or writer_factory (per-row delivery)")
    if writer_factory is not None:
        ship_package(profiles.sparkSession)
        staged = stage(profiles, dataset_id, profile_col=profile_col, text=True)
        # Delivery is per row and bound by the receiver, not the CPU: spread the profiles over all cores (hash of the
        # profile key, so a retried task gets the same rows) instead of the few partitions a profile job ends with.
        staged = staged.repartition(staged.sparkSession.sparkContext.defaultParallelism,
                                    "dataset_id", "dataset_timestamp", "segment")
        staged, staged_path = write_scratch(staged, "publish-staged")
        receipts, _ = write_scratch(_deliver_with_writer(staged, writer_factory), "publish-receipts")
        drop_path(staged.sparkSession, staged_path)
    else:
        staged = stage(profiles, dataset_id, profile_col=profile_col).persist(StorageLevel.MEMORY_AND_DISK)
        failure = None
        try:
            _write_store(staged, path, replace_days, versioned or is_versioned(path))
        except Exception as e:  # noqa: BLE001 - a failed write job becomes failure receipts, as delivery errors do
            failure = failure_text(e)
        receipts = receipts_of(staged, failure)
        staged.unpersist()
    if receipts_path is not None:
        receipts.write.mode("append").parquet(receipts_path)
    return receipts


def failure_text(e: Exception) -> str:
    """The receipts' text of a delivery that failed; the trace goes to the log."""
    log.warning("delivery failed", exc_info=e)
    return f"{ERROR_PREFIX}{type(e).__name__}: {str(e).splitlines()[0] if str(e) else ''}"


def receipts_of(staged: DataFrame, failure: str | None) -> DataFrame:
    """The receipts of a delivery of all valid rows that went well or failed as one."""
    return write_scratch(staged.select(
        "dataset_id",
        F.when(F.col("valid") & F.lit(failure is None), F.lit(OK)).alias("result"),
        F.when(F.col("valid"), F.lit(failure).cast("string")).otherwise(F.col("decode_error")).alias("error"),
        "dataset_timestamp",
        "segment",
    ), "publish-receipts")[0]


def is_versioned(path: str) -> bool:
    """Whether a store's files are listed in versions; a path that only Spark's file systems open has none."""
    try:
        return Manifest(path).exists()
    except (OSError, ValueError, ImportError):
        return False


def _write_store(staged: DataFrame, path: str, replace_days: bool, versioned: bool = False) -> None:
    """Append the valid rows to the store, or replace the (dataset, day) pairs they hold."""
    day = _day(F.col("dataset_timestamp"))
    rows = staged.filter("valid").select(
        "dataset_timestamp", "segment_partition", "segment", "profile", day.alias("day"), "dataset_id",
        F.substring(day, 1, 7).alias("month"))
    spark = staged.sparkSession
    if versioned:
        if path_exists(spark, path) and not is_versioned(path):
            raise ValueError("the store has files that no version lists; publish to a new path")
        store = ProfileStore(spark, path)
        store.replace_days(rows) if replace_days else store.append(rows)
        return
    kept_path = None
    if replace_days and path_exists(spark, path):
        # The other days of the months that are written again, set aside before those months are overwritten.
        months = rows.select(F.col("dataset_id").alias("__d"), F.col("month").alias("__m")).distinct()
        days = rows.select(F.col("dataset_id").alias("__d"), F.col("day").alias("__y")).distinct()
        kept, kept_path = write_scratch(
            read_store(spark, path)
            .join(months, (F.col("dataset_id") == F.col("__d")) & (F.col("month") == F.col("__m")), "left_semi")
            .join(days, (F.col("dataset_id") == F.col("__d")) & (F.col("day") == F.col("__y")), "left_anti"),
            "publish-kept")
        rows = rows.unionByName(kept)
    # One writer per (dataset, month) instead of every task writing into every folder (files = tasks x folders); AQE
    # coalesces small folders and splits a skewed one.
    rows.hint("rebalance", "dataset_id", "month").sortWithinPartitions("dataset_id", "month", "day") \
        .write.mode("overwrite" if replace_days else "append").option("partitionOverwriteMode", "dynamic") \
        .partitionBy("dataset_id", "month").parquet(path)
    if kept_path:
        drop_path(spark, kept_path)


def _deliver_with_writer(staged: DataFrame, writer_factory: Callable[[str], object]) -> DataFrame:
    """Per-row delivery in the executors: one delivery per row per successful task."""
    fields = ["dataset_id", "valid", "dataset_timestamp", "segment_partition", "segment", "decode_error",
              "profile_view"]

    def deliver(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        writers: dict[str, object] = {}
        for b in batches:
            out = {k: [] for k in RECEIPT_COLUMNS}
            for ds, ok, ts, part, seg, err, view in zip(*(b[f] for f in fields)):
                result, error = None, err
                if ok:
                    try:
                        if ds not in writers:
                            writers[ds] = writer_factory(ds)
                        writers[ds].write(dataset_timestamp=int(ts), segment_partition=part, segment=seg,
                                          profile_view=view)
                        result, error = OK, None
                    except Exception as e:  # noqa: BLE001 - a failed delivery is a receipt, not a task failure
                        error = f"{ERROR_PREFIX}{type(e).__name__}: {e}"
                out["dataset_id"].append(ds)
                out["result"].append(result)
                out["error"].append(error)
                out["dataset_timestamp"].append(int(ts))
                out["segment"].append(seg)
            yield pd.DataFrame(out)
        for w in writers.values():
            close = getattr(w, "close", None)
            if close is not None:
                close()

    return staged.select(*fields).mapInPandas(deliver, RECEIPT_SCHEMA)


def read_store(spark: SparkSession, path: str, *, dataset_id: str | None = None, start_day: str | None = None,
               end_day: str | None = None) -> DataFrame:
    """Profiles from a store written by ``publish``; dataset id and day bounds prune partitions (months) and row
    groups (days). Partition values keep their text type whatever they look like."""
    if is_versioned(path):
        return ProfileStore(spark, path).read(dataset_id=dataset_id, start_day=start_day, end_day=end_day)
    df = spark.read.schema(STORE_SCHEMA).option("basePath", path).parquet(path)
    if dataset_id is not None:
        df = df.filter(F.col("dataset_id") == F.lit(dataset_id))
    if start_day is not None:
        df = df.filter((F.col("month") >= F.lit(start_day[:7])) & (F.col("day") >= F.lit(start_day)))
    if end_day is not None:
        df = df.filter((F.col("month") <= F.lit(end_day[:7])) & (F.col("day") <= F.lit(end_day)))
    return df


class FileProfileWriter:
    """A writer for ``publish(writer_factory=...)`` that stores each profile as one file under ``root``.

    Files are ``<root>/<dataset_id>/<dataset_timestamp>-<segment md5>-<profile md5>.<ext>`` holding either the base64 profile
    text on one line (``encoding="base64"``, ext ``b64``) or the raw serialized bytes (``encoding="raw"``, ext
    ``json``); both are readable with ``sources.profile_files.read_profiles``. Works on any file system pyarrow opens
    by URI (local, HDFS, object stores), so the same writer runs on a cluster against the shared folder. A file is
    named by its key and content: a re-sent profile overwrites its own file, and partial profiles of one key (other
    partitions or salts) never each other's.
    """

    def __init__(self, root: str, dataset_id: str, encoding: str = "base64"):
        import pyarrow.fs as pafs

        if not dataset_id or "/" in dataset_id or dataset_id in (".", ".."):
            raise ValueError(f"invalid dataset id {dataset_id!r}")
        if encoding not in ("base64", "raw"):
            raise ValueError(f"unknown encoding {encoding!r}")
        if root.startswith("file:") and not root.startswith("file://"):
            root = "file://" + root[len("file:"):]
        self.fs, base = pafs.FileSystem.from_uri(root)
        self.encoding = encoding
        self.dir = f"{base.rstrip('/')}/{dataset_id}"
        self.fs.create_dir(self.dir, recursive=True)

    def write(self, *, dataset_timestamp: int, segment_partition: str | None, segment: str | None,
              profile_view: str) -> None:
        key = "-".join(hashlib.md5(x.encode()).hexdigest() for x in (segment or "", profile_view))
        if self.encoding == "raw":
            data, ext = base64.b64decode(profile_view, validate=True), "json"
        else:
            data, ext = profile_view.encode(), "b64"
        with self.fs.open_output_stream(f"{self.dir}/{dataset_timestamp}-{key}.{ext}") as f:
            f.write(data)

    @staticmethod
    def factory(root: str, encoding: str = "base64") -> Callable[[str], "FileProfileWriter"]:
        return lambda dataset_id: FileProfileWriter(root, dataset_id, encoding)
