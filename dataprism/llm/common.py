"""Helpers shared by the operators: column expressions, scratch tables and Arrow batches.

Words are runs of characters outside ``[\\x20\\x09-\\x0D]``, in SQL and in Python alike (``bytes.split()`` splits on
exactly those six bytes).
"""

from __future__ import annotations

import functools
import gc
import os
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from dataprism.session import scratch_path

SPACE = "[\\x20\\x09-\\x0D]"
NOT_SPACE = "[^\\x20\\x09-\\x0D]"


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(f"`{name}`").cast("string"), F.lit(""))


def words(text: Column) -> Column:
    """The words of a text, as an array."""
    return F.filter(F.split(text, SPACE + "+"), lambda w: w != "")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once per row, however often the body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def same(a: Column, b: Column) -> Column:
    return a.eqNullSafe(b)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def plain_extras(stage: Callable) -> Callable:
    """A pipeline stage whose extra columns, whatever their names, don't clash with those that operators make."""
    @functools.wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        known = ("doc_id", "text", "lang", "source", "n_chars")
        plain = docs.toDF(*[c if c in known else f"own{i}" for i, c in enumerate(docs.columns)])
        return stage(spark, plain, sf_dir).toDF(*docs.columns)
    return run


def release(spark: SparkSession) -> None:
    """Let the cluster delete the shuffle files of finished steps now: Spark does so when the driver has collected
    the plans that made them."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


class Scratch:
    """Written tables of one run, in a folder of their own under the shared checkpoint folder.

    A table cuts the lineage: what reads it never recomputes what made it, also after executors are lost. Tables that
    later ones replace are dropped at once; those a lazy result still reads stay until the folder is cleared.
    """

    def __init__(self, spark: SparkSession, name: str) -> None:
        self.spark, self.root, self.n = spark, scratch_path(spark, name), 0

    def path(self) -> str:
        """The place of the run's next table."""
        self.n += 1
        return f"{self.root}/{self.n - 1}"

    def write(self, df: DataFrame, codec: str = "snappy") -> tuple[DataFrame, str]:
        path = self.path()
        df.write.option("compression", codec).parquet(path)
        return self.spark.read.schema(df.schema).parquet(path), path

    def drop(self, path: str) -> None:
        jvm = self.spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


#: Arrow batches between the JVM and the Python workers. Spark's own setting of 64 MB is held several times over on
#: either side (growing vectors, received batch, values, results), for each task of an executor.
BATCH_BYTES = 4 << 20
_MAX_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in the Python workers (``addPyFile``) and bound the Arrow batches in bytes (unless
    the session's owner has), once a session."""
    sc = spark.sparkContext
    if getattr(sc, "_dataprism_shipped", False):
        return
    if sc.getConf().get(_MAX_BYTES, None) is None:
        spark.conf.set(_MAX_BYTES, str(BATCH_BYTES))
    root = Path(__file__).resolve().parents[1]
    target = os.path.join(tempfile.mkdtemp(prefix="dataprism-"), "dataprism.zip")
    with zipfile.ZipFile(target, "w") as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f.relative_to(root.parent))
    sc.addPyFile(target)
    sc._dataprism_shipped = True


def arrow_map(df: DataFrame, fn: Callable[[pa.RecordBatch], list], schema: str | T.StructType,
              rows: int = 2000) -> DataFrame:
    """``mapInArrow`` in slices of at most ``rows`` input rows; batches come in at ``BATCH_BYTES`` (or one row), so
    memory follows the batch in bytes and its longest text. ``fn`` gets a slice and returns the output columns in the
    order of ``schema``. What the allocator holds is given back after each batch."""
    kinds = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema

    out = to_arrow_schema(kinds)
    ship_package(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, rows):
                cols = fn(batch.slice(at, rows))
                yield pa.RecordBatch.from_arrays([_array(c, f.type) for c, f in zip(cols, out)], schema=out)
                del cols
            pa.default_memory_pool().release_unused()

    return df.mapInArrow(run, kinds)


def _array(c: object, kind: pa.DataType) -> pa.Array:
    if not isinstance(c, pa.Array):
        return pa.array(c, kind)
    return c if c.type == kind else c.cast(kind)


def append_columns(df: DataFrame, use: list[str], fn: Callable[[pa.RecordBatch], list], schema: str,
                   without: tuple[str, ...] = (), rows: int = 2000) -> DataFrame:
    """``df`` less the columns ``without``, plus those that ``fn`` makes of the columns ``use``, whatever the names and
    types of the others. Each column goes to the workers once, and only what stays comes back."""
    kinds = T.StructType.fromDDL(schema)
    names = df.columns
    kept = [i for i, c in enumerate(names) if c not in without]
    places = [names.index(c) for c in use]
    fields = [T.StructField(f"__own{i}", df.schema.fields[i].dataType) for i in kept] + list(kinds.fields)

    def run(batch: pa.RecordBatch) -> list:
        cut = pa.RecordBatch.from_arrays([batch.column(i) for i in places], names=[f"i{i}" for i in places])
        return [*[batch.column(i) for i in kept], *fn(cut)]

    out = arrow_map(df.toDF(*[f"__own{i}" for i in range(len(names))]), run, T.StructType(fields), rows)
    return out.select(*[F.col(f"__own{i}").alias(names[i]) for i in kept], *[f.name for f in kinds.fields])


class Memo:
    """Results of short keys met before, at most ``limit`` bytes of them: when half of that is full, the older half is
    forgotten. ``make`` gives the result of a key that isn't known."""

    EACH = 180  # bytes of a dict entry and two small objects

    def __init__(self, make: Callable, limit: int = 32 << 20, longest: int = 64) -> None:
        self.make, self.half, self.longest = make, limit // 2, longest
        self.new: dict = {}
        self.old: dict = {}
        self.size = 0

    def __call__(self, key):
        """The result of a key that ``new`` doesn't hold."""
        out = self.old.get(key)
        if out is None:
            out = self.make(key)
        if len(key) <= self.longest:
            self.size += self.EACH + 2 * len(key) + (len(out) if hasattr(out, "__len__") else 0)
            if self.size > self.half:
                self.new, self.old, self.size = {}, self.new, 0
            self.new[key] = out
        return out


def int_lists(packed: list[bytes]) -> pa.Array:
    """A list<int> array of packed little-endian 32-bit numbers."""
    ends = np.cumsum([0] + [len(x) // 4 for x in packed], dtype=np.int64).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(packed), np.int32)))


def raw_texts(column: pa.Array) -> list[bytes]:
    """The texts as UTF-8 bytes; a null is an empty text."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


# A-Z lower-cased and ASCII punctuation as space, for ``bytes.translate``.
PLAIN = bytes(ord(" ") if chr(b) in "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~" else b + 32 if 65 <= b <= 90 else b
               for b in range(256))

# --- word hashes by numpy ---------------------------------------------------------------------------------------

_U = np.uint64
_MUL = _U(0x9E3779B97F4A7C15)  # any odd number is invertible modulo 2**64
_INV = _U(pow(0x9E3779B97F4A7C15, -1, 2**64))
_BLOCK = 1 << 20


def _byte_values(seed: int) -> np.ndarray:
    return np.random.default_rng(seed).integers(1, 2**63, 256, dtype=np.uint64)


_BYTES = _byte_values(1)
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[9, 10, 11, 12, 13, 32]] = True


def _powers(base: np.uint64, n: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(n, base, np.uint64))])


_POW, _POW_INV = _powers(_MUL, _BLOCK), _powers(_INV, _BLOCK)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: spreads every input bit over the output."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def word_hashes(raw: bytes, first: int | None = None) -> np.ndarray:
    """One 64-bit hash per word of ``raw``, in order; of its ``first`` bytes only, if given.

    A word's hash is the polynomial sum of its bytes' random values, taken from a running sum over the text and
    shifted to the word's start, so that all words are hashed by a few vector operations. Texts longer than a block
    are cut at spaces; a single word longer than a block is summed up by itself.
    """
    if len(raw) >= _BLOCK:
        cut = max(raw.rfind(s, 0, _BLOCK - 1) for s in (b" ", b"\n", b"\t", b"\r", b"\x0b", b"\x0c"))
        if cut >= 0:
            return np.concatenate([word_hashes(p, first) for p in _pieces(raw)])
        if not raw.split():
            return np.empty(0, np.uint64)
        head, *rest = raw.split(None, 1)
        return np.concatenate([[_long_word(head[:first])], word_hashes(rest[0], first) if rest
                               else np.empty(0, np.uint64)]).astype(np.uint64)
    b = np.frombuffer(raw, np.uint8)
    inside = np.zeros(len(b) + 2, bool)
    inside[1:-1] = ~_IS_SPACE[b]
    edge = np.flatnonzero(inside[1:] != inside[:-1])
    start, end = edge[::2], edge[1::2]
    if first:
        end = np.minimum(end, start + first)
    total = np.zeros(len(b) + 1, np.uint64)
    np.cumsum(_BYTES[b] * _POW[:len(b)], out=total[1:])
    return mix((total[end] - total[start]) * _POW_INV[start] + (end - start).astype(np.uint64))


def _pieces(raw: bytes) -> Iterator[bytes]:
    """``raw`` cut at spaces into pieces under a block where its words allow."""
    at = 0
    while at < len(raw):
        end = len(raw)
        if end - at >= _BLOCK:
            cut = max(raw.rfind(s, at, at + _BLOCK - 1) for s in (b" ", b"\n", b"\t", b"\r", b"\x0b", b"\x0c"))
            if cut < 0:
                nexts = [p for s in (b" ", b"\n", b"\t", b"\r", b"\x0b", b"\x0c") if (p := raw.find(s, at)) >= 0]
                cut = min(nexts, default=end)
            end = max(cut, at + 1)
        yield raw[at:end]
        at = end


def _long_word(word: bytes) -> np.uint64:
    total = _U(0)
    with np.errstate(over="ignore"):
        for at in range(0, len(word), _BLOCK):
            b = np.frombuffer(word[at:at + _BLOCK], np.uint8)
            shift = _U(pow(int(_MUL), at, 2**64))
            total = total + np.sum(_BYTES[b] * _POW[:len(b)], dtype=np.uint64) * shift
        return mix(np.array([total + _U(len(word))]))[0]


def batch_hashes(raws: list[bytes], first: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """The word hashes of several texts one after the other, and where each text's words begin (with the end)."""
    each, at = [], 0
    groups: list[list[bytes]] = [[]]
    for raw in raws:  # texts joined into blocks: fewer and longer vector operations
        if at + len(raw) >= _BLOCK // 2 and groups[-1]:
            groups.append([])
            at = 0
        groups[-1].append(raw)
        at += len(raw) + 1
    counts = []
    for group in groups:
        if len(group) == 1:
            h = word_hashes(group[0], first)
            each.append(h)
            counts.append(np.array([len(h)]))
            continue
        if not group:
            continue
        joined = b"\n".join(group)
        h = word_hashes(joined, first)
        b = np.frombuffer(joined, np.uint8)
        starts = ~_IS_SPACE[b]
        starts[1:] &= _IS_SPACE[b[:-1]]
        begin = np.cumsum([0] + [len(x) + 1 for x in group])
        before = np.concatenate([[0], np.cumsum(starts)])
        n = np.diff(before[np.minimum(begin, len(b))])
        each.append(h)
        counts.append(n)
    offsets = np.concatenate([[0], np.cumsum(np.concatenate(counts))]) if counts else np.zeros(1, np.int64)
    return (np.concatenate(each) if each else np.empty(0, np.uint64)), offsets.astype(np.int64)


def window_hashes(h: np.ndarray, k: int) -> np.ndarray:
    """The hash of every ``k`` consecutive word hashes (windows over text borders are the caller's to leave out)."""
    n = len(h) - k + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    g = np.zeros(n, np.uint64)
    for j in range(k):
        g *= _MUL
        g += h[j:j + n]
    return mix(g)
