"""Labelled rows for the classifiers, and models fitted to all that may be learned from by averaging over slices."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from dataprism.llm.common import release, ship_package


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id's text modulo ``folds``; a null id is the empty text."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))), F.lit(folds)).cast("int")


def read_labels(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """(doc_id, label): one row per labelled document; where rows disagree, 1 wins; null labels are left out."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return labels.select(F.col("doc_id").cast("long"), F.col(name).cast("int").alias("label")) \
        .filter("doc_id IS NOT NULL AND label IS NOT NULL").groupBy("doc_id").agg(F.max("label").alias("label"))


def sample(labels: DataFrame, learn: Column, per_class: int) -> DataFrame:
    """At most ``per_class`` rows of each label among those to ``learn`` from: the smallest hashes of the id, taken by
    a top-k in each task first. For a look at the labels; the classifiers learn from all rows."""
    rows = labels.filter(learn).withColumn("__h", F.xxhash64("doc_id"))
    parts = [rows.filter(F.col("label") == v if v == 1 else F.col("label") != 1).orderBy("__h", "doc_id")
             .limit(per_class) for v in (0, 1)]
    return parts[0].unionByName(parts[1]).select("doc_id", "label")


def with_texts(docs: DataFrame, chosen: DataFrame, columns: list[Column]) -> DataFrame:
    """The chosen rows' ``columns``, ids and labels. Of documents that repeat an id, the one with the smallest hash is
    the example, so there are at most as many rows as chosen ids."""
    rows = docs.select(F.col("doc_id").cast("long").alias("__id"), *columns)
    names = rows.columns[1:]
    return rows.join(chosen.withColumnRenamed("doc_id", "__chosen"), F.col("__id") == F.col("__chosen")) \
        .groupBy("__id", "label").agg(F.min(F.struct(F.xxhash64(*names).alias("__h"), *names)).alias("__r")) \
        .select("__id", *[F.col("__r").getField(n).alias(n) for n in names], "label")


# --- models fitted to all rows ---------------------------------------------------------------------------------------

SLICE_ROWS = 4000
MOST_SLICES = 48  # each is a stream, so that more rows cost time and no memory
_BLOCK = 2048  # rows of a state that are averaged together


def averaged(rows: DataFrame, n: int, state: tuple[np.ndarray, np.ndarray], epochs: int,
             learn: Callable[[np.ndarray, np.ndarray, Iterator[pa.RecordBatch]], int]) -> tuple[np.ndarray, np.ndarray]:
    """A model's state after ``epochs`` over all ``n`` ``rows`` (with ``__id``), by averaging.

    In each epoch the rows are dealt anew into slices by hash, and every slice's task changes a copy of the state in
    place while its rows stream by in the hash's order (``learn``, which returns how many rows it saw). The state is
    (rows of which a text touches few, the rest): a row becomes the mean over the slices that changed it, the rest the
    mean over all. Averages are made by Spark in blocks; the driver gets one state an epoch, whose size is fixed."""
    sc = rows.sparkSession.sparkContext
    ship_package(rows.sparkSession)
    ddl = "block int, part int, n long, places binary, change binary"
    kinds = to_arrow_schema(T.StructType.fromDDL(ddl))
    k = max(1, min(MOST_SLICES, -(-n // SLICE_ROWS)))
    for epoch in range(epochs):
        shared = sc.broadcast(state)
        width = state[0].shape[1]

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            few, rest = (x.copy() for x in shared.value)
            seen = learn(few, rest, batches)
            if not seen:
                return
            part = TaskContext.get().partitionId()
            moved = np.flatnonzero((few != shared.value[0]).any(1)).astype(np.int32)
            out = [(-1, part, seen, b"", (rest - shared.value[1]).tobytes())]
            for b in np.unique(moved // _BLOCK).tolist():
                at = moved[moved // _BLOCK == b]
                out.append((b, part, seen, at.tobytes(), (few[at] - shared.value[0][at]).tobytes()))
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), kinds)], schema=kinds)

        def mean(found: pa.Table) -> pa.Table:
            found = found.sort_by("part")
            block = found["block"][0].as_py()
            n_rows = found["n"].to_pylist()
            changes = [np.frombuffer(x, np.float32) for x in found["change"].to_pylist()]
            if block < 0:
                places = np.empty(0, np.int32)
                change = sum(c * np.float64(s) for c, s in zip(changes, n_rows)) / sum(n_rows)
            else:
                total, times = np.zeros((_BLOCK, width)), np.zeros(_BLOCK)
                for at, c in zip(found["places"].to_pylist(), changes):
                    at = np.frombuffer(at, np.int32) - block * _BLOCK
                    total[at] += c.reshape(-1, width)
                    times[at] += 1
                at = np.flatnonzero(times)
                places, change = (at + block * _BLOCK).astype(np.int32), total[at] / times[at, None]
            row = (block, 0, sum(n_rows), places.tobytes(), change.astype(np.float32).tobytes())
            return pa.Table.from_arrays([pa.array([v], f.type) for v, f in zip(row, kinds)], schema=kinds)

        order = F.xxhash64("__id", F.lit(epoch))
        dealt = rows.withColumn("__order", order).withColumn("__slice", F.pmod("__order", F.lit(k)).cast("int")) \
            .repartitionById(k, F.col("__slice")).sortWithinPartitions("__order", "__id").drop("__order", "__slice")
        found = dealt.mapInArrow(run, ddl).groupBy("block").applyInArrow(mean, ddl).toArrow()
        few, rest = (x.copy() for x in state)
        for block, places, change in zip(*(found[c].to_pylist() for c in ("block", "places", "change"))):
            change = np.frombuffer(change, np.float32)
            if block < 0:
                rest += change
            else:
                few[np.frombuffer(places, np.int32)] += change.reshape(-1, width)
        state = few, rest
        shared.destroy()
        release(rows.sparkSession)
    return state


def label_counts(rows: DataFrame) -> tuple[int, int]:
    """How many ``rows`` have label 1, and another."""
    r = rows.agg(F.count_if(F.col("label") == 1), F.count_if(F.col("label") != 1)).first()
    return int(r[0]), int(r[1])


def label_weights(labels: np.ndarray, ones: int, others: int) -> np.ndarray:
    """Weights by which both labels weigh the same over all rows, 1 on the average."""
    return np.where(labels == 1, 0.5 / max(1, ones), 0.5 / max(1, others)) * (ones + others)
