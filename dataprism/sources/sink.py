"""``dataprism_profiles``: a Spark data source that delivers serialized profiles with one commit.

Each task writes its profiles to files of its own, many profiles a file, and returns their names as its commit message;
the driver's commit publishes the files of all tasks at once as a new version of the folder (see
``sources.manifest``). So a task that fails after writing, is tried again or runs twice leaves nothing that readers
see, and a delivery is there whole or not at all. ``mode("append")`` adds to the last version, ``mode("overwrite")``
replaces it.

Columns: dataset_id, dataset_timestamp, segment_partition, segment, profile_view (base64 text). ``deliver`` validates
like ``publish``, delivers the valid rows and returns the receipts; ``read_delivered`` reads the committed profiles.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from dataprism.session import ship_package
from dataprism.sources.manifest import DATA, CommitConflict, Manifest

SINK = "dataprism_profiles"
SINK_DDL = ("dataset_id string, dataset_timestamp bigint, segment_partition string, segment string, "
            "profile_view string")
#: A file is closed when its profiles have this many bytes.
FILE_BYTES = 128 << 20
ATTEMPTS = 5


@dataclass
class Written(WriterCommitMessage):
    files: list[dict]


class ProfileSink(DataSource):
    @classmethod
    def name(cls) -> str:
        return SINK

    def schema(self) -> str:
        return SINK_DDL

    def writer(self, schema, overwrite: bool) -> "ProfileSinkWriter":
        wanted = [x.split()[0] for x in SINK_DDL.split(", ")]
        if schema.names != wanted:
            raise ValueError(f"a delivery has the columns {wanted}, not {schema.names}")
        return ProfileSinkWriter(self.options["path"], int(self.options.get("fileBytes", FILE_BYTES)), overwrite)


class ProfileSinkWriter(DataSourceArrowWriter):
    def __init__(self, path: str, file_bytes: int, overwrite: bool) -> None:
        self.path, self.file_bytes, self.overwrite = path, file_bytes, overwrite

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        import pyarrow.parquet as pq

        manifest = Manifest(self.path)
        manifest.fs.create_dir(f"{manifest.base}/{DATA}", recursive=True)
        files, out, stream, size = [], None, None, 0
        for batch in iterator:
            if not batch.num_rows:
                continue
            if out is None:
                files.append({"path": f"{DATA}/{uuid.uuid4().hex}.parquet", "profiles": 0})
                stream = manifest.fs.open_output_stream(f"{manifest.base}/{files[-1]['path']}")
                out, size = pq.ParquetWriter(stream, batch.schema), 0
            out.write_batch(batch)
            files[-1]["profiles"] += batch.num_rows
            size += batch.nbytes
            if size >= self.file_bytes:
                out.close()
                stream.close()
                out = None
        if out is not None:
            out.close()
            stream.close()
        return Written(files)

    def commit(self, messages: list[Written | None]) -> None:
        manifest = Manifest(self.path)
        new = [f for m in messages if m is not None for f in m.files]
        for _ in range(ATTEMPTS):
            base = manifest.read()
            try:
                manifest.commit(base, new if self.overwrite else [*base.files, *new])
                return
            except CommitConflict:
                continue
        raise CommitConflict(f"no commit in {ATTEMPTS} attempts")

    def abort(self, messages: list[Written | None]) -> None:
        manifest = Manifest(self.path)
        for m in messages:
            for f in m.files if m is not None else []:
                manifest._delete(f"{manifest.base}/{f['path']}")


def register(spark: SparkSession) -> None:
    """Make the sink known to the session (``df.write.format("dataprism_profiles")``)."""
    from dataprism.session import ship_package

    ship_package(spark)
    spark.dataSource.register(ProfileSink)


def deliver(profiles: DataFrame, path: str, *, dataset_id: str | Column | None = None,
            profile_col: str = "profile_view", overwrite: bool = False, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Deliver ``profiles`` to the folder ``path`` in one commit and return the receipts, one per input row.

    The rows are staged in the shared folder first, so what is delivered and what the receipts say come from the same
    bytes. A delivery that fails gives failure receipts for all its valid rows and leaves the folder as it was."""
    from dataprism.operators.publish import failure_text, receipts_of, stage, write_scratch

    staged, _ = write_scratch(stage(profiles, dataset_id, profile_col=profile_col, text=True), "deliver-staged")
    spark = profiles.sparkSession
    register(spark)
    failure = None
    try:
        staged.filter("valid").select(*[x.split()[0] for x in SINK_DDL.split(", ")]) \
            .write.format(SINK).option("path", path).option("fileBytes", str(file_bytes)) \
            .mode("overwrite" if overwrite else "append").save()
    except Exception as e:  # noqa: BLE001 - a failed delivery becomes failure receipts
        failure = failure_text(e)
    return receipts_of(staged, failure)


def read_delivered(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The committed profiles of a version (the latest by default)."""
    manifest = Manifest(path)
    files = manifest.read(version).files
    if not files:
        return spark.createDataFrame([], SINK_DDL)
    return spark.read.schema(SINK_DDL).parquet(*[manifest.uri(f["path"]) for f in files])
