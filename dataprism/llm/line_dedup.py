"""Line deduplication over levelled sorted runs of line hashes.

The texts are hashed once, into a table of (row, document, line hash). A line's key is the line stripped of
``[\\x20\\x09-\\x0D]`` at both ends with A-Z lower-cased, its hash has 128 bits. ``LineIndex`` holds how many documents
have a line, as runs: tables bucketed and sorted by hash, so that joining runs is a merge of sorted files, bucket by
bucket, with no exchange of a run. Each new batch of documents is merge-anti-joined with the lines that the runs know
to be frequent (they need no more counting), takes over what the runs have counted of its other lines, and adds its
own run; a line whose count reaches ``min_docs`` is frequent from then on. When a level has ``fanout`` runs, they are
compacted: merged into one run of the next level, which holds the counts of lines still open and the frequent lines
of the level.

Defined results: a null or empty text is one empty line, which is never dropped (its key has no code point); a
document is a ``doc_id``, so rows that repeat one count once for each line; null ids are one document; a very long text
is split and hashed whole, and a task holds one Arrow batch or one such text; lines tied at the limit are all dropped;
an empty table gives no rows; other columns, whatever their names, are ignored, and kept by the pipeline stage.
"""

from __future__ import annotations

import hashlib
import struct
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dataprism.llm.common import Scratch, append_columns, arrow_map, documents, plain_extras, raw_texts

STRIP = b" \t\n\r\x0b\f"
MIN_DOCS = 10
BATCHES = 4
FANOUT = 3


def line_key(line: bytes) -> bytes:
    return line.strip(STRIP).lower()  # bytes.lower() changes A-Z only


def _hash(key: bytes) -> tuple[int, int]:
    return struct.unpack("<qq", hashlib.blake2b(key, digest_size=16).digest())


def lines_of(docs: DataFrame) -> DataFrame:
    """(row, doc_id, hi, lo): the distinct keys of each row's lines, hashed; keys without a code point are left out.
    ``row`` is a hash of the id and the text. Rows that meet by chance share their hits, which are frequent lines all."""
    def split(batch: pa.RecordBatch) -> list:
        at, hi, lo = [], [], []
        for i, raw in enumerate(raw_texts(batch.column(2))):
            hashes = [_hash(k) for k in set(map(line_key, raw.split(b"\n"))) if k]
            at.extend([i] * len(hashes))
            hi.extend([h for h, _ in hashes])
            lo.extend([l for _, l in hashes])
        rows = pa.array(at, pa.int32())
        return [batch.column(0).take(rows), batch.column(1).take(rows), hi, lo]

    return arrow_map(docs.select(_row_key().alias("row"), F.col("doc_id").cast("long"), F.col("text").cast("string")),
                     split, "row long, doc_id long, hi long, lo long", rows=500)


def _row_key() -> Column:
    return F.xxhash64(F.col("doc_id").cast("long"), F.col("text").cast("string"))


class Run:
    """A bucketed table of (hi, lo, n, frequent), sorted by (hi, lo) in each bucket and split by ``frequent``."""

    def __init__(self, spark: SparkSession, counted: DataFrame, path: str, buckets: int, min_docs: int) -> None:
        self.spark, self.path, self.name = spark, path, f"line_run_{uuid.uuid4().hex}"
        counted.withColumn("frequent", F.col("n") >= min_docs).write.partitionBy("frequent") \
            .bucketBy(buckets, "hi", "lo").sortBy("hi", "lo").option("path", path).saveAsTable(self.name)

    def lines(self, frequent: bool) -> DataFrame:
        return self.spark.table(self.name).filter(F.col("frequent") == frequent).select("hi", "lo", "n").hint("merge")

    def drop(self) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")


class LineIndex:
    """Levelled runs of lines with their document counts. A line that is not frequent yet has in each run its count in
    the batches that the run was made of; a frequent one has its full count in the run that found it."""

    KEY = ["hi", "lo"]

    def __init__(self, spark: SparkSession, min_docs: int = MIN_DOCS, fanout: int = FANOUT) -> None:
        self.spark, self.scratch, self.min_docs, self.fanout = spark, Scratch(spark, "line-runs"), min_docs, fanout
        # As many buckets as an exchange has partitions: what was counted is in its buckets already.
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: list[list[Run]] = []

    def runs(self) -> list[Run]:
        """All runs, the oldest first."""
        return [run for level in reversed(self.levels) for run in level]

    def _run(self, counted: DataFrame) -> Run:
        with _sorted_buckets(self.spark):
            return Run(self.spark, counted, self.scratch.path(), self.buckets, self.min_docs)

    def add(self, docs: DataFrame) -> None:
        """Count a batch of documents that no other batch holds."""
        self.add_lines(lines_of(docs))

    def add_lines(self, lines: DataFrame) -> None:
        """Count a batch of the rows of ``lines_of``."""
        # Distinct (line, document) pairs; a line of a third of all documents has one row a task in the second step.
        counted = lines.select("doc_id", "hi", "lo").distinct().groupBy("hi", "lo").agg(F.count(F.lit(1)).alias("n"))
        for run in self.runs():
            counted = counted.join(run.lines(True), self.KEY, "left_anti")
        for i, run in enumerate(self.runs()):
            known = run.lines(False).withColumnRenamed("n", f"n{i}")
            counted = counted.join(known, self.KEY, "left")
        if self.levels:
            # A run's count stands for the batches that the run was made of, so the counts add up.
            counted = counted.select(*self.KEY, sum((F.coalesce(f"n{i}", F.lit(0)) for i in range(len(self.runs()))),
                                                    F.col("n")).alias("total"), "n")
            counted = counted.select(*self.KEY, F.when(F.col("total") >= self.min_docs, F.col("total"))
                                     .otherwise(F.col("n")).alias("n"))
        self._place(0, self._run(counted))

    def _place(self, level: int, run: Run) -> None:
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(run)
        if len(self.levels[level]) >= self.fanout:
            runs, self.levels[level] = self.levels[level], []
            self._place(level + 1, self._compact(runs))

    def _compact(self, runs: list[Run]) -> Run:
        """One run of several of a level: counts added up; a line that one of them has as frequent has its full count
        there."""
        merged = None
        for run in runs:
            both = self.spark.table(run.name).select("hi", "lo", "n", "frequent").hint("merge")
            if merged is None:
                merged = both
                continue
            a, b = merged.alias("a"), both.alias("b")
            merged = a.join(b, (F.col("a.hi") == F.col("b.hi")) & (F.col("a.lo") == F.col("b.lo")), "full").select(
                F.coalesce("a.hi", "b.hi").alias("hi"), F.coalesce("a.lo", "b.lo").alias("lo"),
                F.when(F.col("b.frequent"), F.col("b.n")).when(F.col("a.frequent"), F.col("a.n"))
                .otherwise(F.coalesce("a.n", F.lit(0)) + F.coalesce("b.n", F.lit(0))).alias("n"),
                (F.coalesce("a.frequent", F.lit(False)) | F.coalesce("b.frequent", F.lit(False))).alias("frequent"))
        out = self._run(merged.select("hi", "lo", "n"))
        for run in runs:
            run.drop()
            self.scratch.drop(run.path)
        return out

    def frequent(self) -> DataFrame:
        """The hashes of all lines in at least ``min_docs`` documents; each once."""
        found = [self.spark.read.schema("hi long, lo long, n long, frequent boolean").parquet(run.path)
                 .filter("frequent").select("hi", "lo") for run in self.runs()]
        return reduce(DataFrame.unionByName, found) if found else self.spark.createDataFrame([], "hi long, lo long")

    def close(self) -> None:
        """Forget the runs' table names; the files stay for what still reads ``frequent``."""
        for run in self.runs():
            run.drop()


@contextmanager
def _sorted_buckets(spark: SparkSession) -> Iterator[None]:
    """Let Spark rely on the order within the buckets (it does where a bucket is one file)."""
    name = "spark.sql.legacy.bucketedTableScan.outputOrdering"
    before = spark.conf.get(name)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def index_lines(lines: DataFrame, min_docs: int = MIN_DOCS, batches: int = BATCHES) -> DataFrame:
    """The frequent lines of a written table of ``lines_of``, added to an index in batches of whole documents."""
    index = LineIndex(lines.sparkSession, min_docs)
    part = F.pmod(F.xxhash64("doc_id"), F.lit(batches))
    for b in range(batches):
        index.add_lines(lines.filter(part == b))
    index.close()
    return index.frequent()


def frequent_lines(docs: DataFrame, min_docs: int = MIN_DOCS, batches: int = BATCHES) -> DataFrame:
    """The frequent lines of a table."""
    lines, _ = Scratch(docs.sparkSession, "lines").write(lines_of(docs))
    return index_lines(lines, min_docs, batches)


def _hits(lines: DataFrame, frequent: DataFrame) -> DataFrame:
    """(__id, __hit): the frequent lines that each row has. The join by hash has one row for each frequent line on one
    side, and Spark splits the skewed partitions of the other."""
    return lines.select("row", "hi", "lo").join(frequent, ["hi", "lo"]).groupBy(F.col("row").alias("__id")) \
        .agg(F.collect_set(F.struct("hi", "lo")).alias("__hit"))


def _keep(raw: bytes, hits: list[dict] | None) -> tuple[int, list[bytes]]:
    lines = raw.split(b"\n")
    if not hits:
        return len(lines), lines
    bad = {(h["hi"], h["lo"]) for h in hits}
    return len(lines), [x for x in lines if not (k := line_key(x)) or _hash(k) not in bad]


def drop_lines(docs: DataFrame, frequent: DataFrame, lines: DataFrame | None = None,
               without: tuple[str, ...] = ()) -> DataFrame:
    """``docs`` less the columns ``without``, with ``__n_lines``, ``__n_dropped`` and ``__kept``, the text without lines
    whose hashes are ``frequent``. The hashes that a row's text has (from ``lines``, its ``lines_of``) are joined to
    it, so memory follows one text."""
    hits = _hits(lines_of(docs) if lines is None else lines, frequent)
    rows = docs.withColumn("__text", F.col("text").cast("string")) \
        .join(hits, _row_key() == F.col("__id"), "left").drop("__id")
    if "text" in without:
        rows = rows.drop("text")

    def keep(batch: pa.RecordBatch) -> list:
        n_lines, n_dropped, kept = [], [], []
        for raw, hits in zip(raw_texts(batch.column(0)), batch.column(1).to_pylist()):
            n, rest = _keep(raw, hits)
            n_lines.append(n)
            n_dropped.append(n - len(rest))
            kept.append(b"\n".join(rest).decode())
        return [n_lines, n_dropped, kept]

    return append_columns(rows, ["__text", "__hit"], keep, "__n_lines long, __n_dropped long, __kept string",
                          (*without, "__text", "__hit"), rows=500)


def _dropped(docs: DataFrame) -> DataFrame:
    """``drop_lines`` on the frequent lines of ``docs`` itself; the texts are hashed once and don't come back."""
    lines, _ = Scratch(docs.sparkSession, "lines").write(lines_of(docs))
    return drop_lines(docs, index_lines(lines), lines, without=("text",))


def op1_line_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _dropped(documents(spark, sf_dir).select("doc_id", "text")).select(
        "doc_id", F.col("__n_lines").alias("n_lines"), F.col("__n_dropped").alias("n_dropped"),
        F.sha2("__kept", 256).alias("kept_sha256"))


@plain_extras
def without_frequent_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: every document without its frequent lines; ``n_chars`` follows the text, a null text stays."""
    out = _dropped(docs.withColumn("__null", F.col("text").isNull()))
    text = F.when(~F.col("__null"), F.col("__kept"))
    made = {"text": text}
    if "n_chars" in docs.columns:
        made["n_chars"] = F.length(text).cast(docs.schema["n_chars"].dataType)
    return out.select(*[made[c].alias(c) if c in made else F.col(f"`{c}`") for c in docs.columns])


ORACLE = f"""
WITH l AS (SELECT doc_id, rid, k, line, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM (SELECT doc_id, rid, unnest(ls) AS line, generate_subscripts(ls, 1) AS k
        FROM (SELECT doc_id, row_number() OVER () AS rid, string_split(coalesce(text, ''), chr(10)) AS ls
              FROM documents))),
f AS (SELECT key FROM l WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT doc_id) >= {MIN_DOCS})
SELECT doc_id, count(*)::BIGINT AS n_lines, count(f.key)::BIGINT AS n_dropped,
  sha256(coalesce(string_agg(CASE WHEN f.key IS NULL THEN line END, chr(10) ORDER BY k), '')) AS kept_sha256
FROM l LEFT JOIN f ON l.key = f.key GROUP BY doc_id, rid
"""
