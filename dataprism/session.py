"""Session and shared-folder helpers.

Everything the library computes is a DataFrame plan; the helpers here only make sure a session has the settings the
profile semantics rely on (UTC session zone, AQE) and locate the shared checkpoint folder for jobs that cut lineage.
"""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    # Bucket labels are naive UTC; date_trunc and casts must not shift them.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # Profiles aggregate sketch buffers (object aggregates); the default switches a task to sort-based aggregation
    # after 128 groups, which segmented daily profiles exceed. Buffers are a few KB per column and group.
    "spark.sql.objectHashAggregate.sortBased.fallbackThreshold": "1024",
}


def get_session(master: str | None = None, app_name: str = "dataprism", conf: dict | None = None) -> SparkSession:
    """Build (or fetch) a session with the settings profiles depend on.

    On a cluster pass ``master=None`` and let spark-submit decide; tests pass ``local[*]``.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULT_CONF, **(conf or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    ensure_utc(spark)
    return spark


def ensure_utc(spark: SparkSession) -> None:
    """Pin the session zone to UTC; labels and epoch milliseconds are defined in UTC."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in the Python workers (``addPyFile``), once a session."""
    sc = spark.sparkContext
    if getattr(sc, "_dataprism_zipped", False):
        return
    root = Path(__file__).resolve().parent
    target = os.path.join(tempfile.mkdtemp(prefix="dataprism-"), "dataprism.zip")
    with zipfile.ZipFile(target, "w") as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f.relative_to(root.parent))
    sc.addPyFile(target)
    sc._dataprism_zipped = True


def shared_dir(spark: SparkSession) -> str:
    """The shared folder for lineage cuts and written intermediate tables.

    Read from the session (``spark.checkpoint.dir`` or the context's checkpoint dir). Only when neither is set and
    the master is local (tests), a fresh private folder is made and registered; on a cluster that is an error.
    """
    sc = spark.sparkContext
    found = sc.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        found = sc.getCheckpointDir()
    if found:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(found)
        return found.rstrip("/")
    if not sc.master.startswith("local"):
        # A driver-local folder is invisible to executors on other machines; the cluster must name a shared one.
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach (HDFS, object store, NFS)")
    local = tempfile.mkdtemp(prefix="dataprism-ckpt-")
    sc.setCheckpointDir(local)
    return local


def scratch_path(spark: SparkSession, name: str) -> str:
    """A unique path under the shared folder for a written intermediate table."""
    return os.path.join(shared_dir(spark), f"{name}-{uuid.uuid4().hex[:12]}")


def _path(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete a written intermediate table."""
    p, fs = _path(spark, path)
    fs.delete(p, True)


def path_exists(spark: SparkSession, path: str) -> bool:
    p, fs = _path(spark, path)
    return fs.exists(p)
