"""Hard negatives by exact integer scores, computed the Four-Russians way.

Components are made integers, floor(256 * x). Rows are packed in blocks of bit planes: for each plane of the two's
complement and each group of eight dimensions, one byte a row. For a block of anchors the sums over all 256 subsets of
each group of eight components are tabulated; a plane's contribution to the scores of a row with all anchors is then a
look-up by the row's byte, added over the groups, and planes are put together by doubling and adding. The result is
the full, exact inner product.

Anchors are queries against all rows, in blocks. Blocks are in order of label, so the first pass, which finds an
anchor's positives, meets only blocks whose labels overlap; the second takes every block, with the positives' scores
as limits. A cell of the grid (a strip of anchor blocks and a slice of row blocks) is a unit of the shuffle; a task
keeps the best of each anchor over the blocks it has met and sends on at most ``k`` rows for each anchor and limit.

Defined results: rows with a null id, label, vector or component or a component that is not finite take no part; an
empty vector scores 0, and of vectors of different lengths the missing components count as 0; another row is one with
another id, so rows that repeat an id are no positives of each other but stand for themselves otherwise, and an anchor
that repeats is mined for each of its rows; ties go to the smaller id; an anchor without positives or a positive
without negatives gives no row; an empty table gives no rows; other columns, whatever their names, are ignored. Scores
beyond 2**48 in size fail.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from dataprism.llm.common import Scratch, ship_package

SCALE = 256
GROUP = 8
BLOCK_ROWS = 2048
BLOCK_ANCHORS = 256
SLICE_BLOCKS = 4
STRIP_BLOCKS = 8
HELD_BLOCKS = 16

_BLOCK = "pid int, seq int, lo long, hi long, labs array<long>, size int, width int, ids binary, labels binary, {data}"


def subset_sums(values: np.ndarray) -> np.ndarray:
    """(group, subset, anchor): sums of the anchors' components over all subsets of each eight dimensions.
    ``values`` is (dimension, anchor), of a multiple of eight dimensions."""
    groups = len(values) // GROUP
    out = np.zeros((groups, 1 << GROUP, values.shape[1]), values.dtype)
    for j in range(GROUP):
        np.add(out[:, :1 << j], values[j::GROUP][:, None], out=out[:, 1 << j:2 << j])
    return out


def bit_planes(values: np.ndarray) -> np.ndarray:
    """(plane, group, row): the bytes of the two's complement planes of (row, dimension) integers, lowest plane first;
    bit j of a byte is dimension j of its group."""
    top = max(int(values.max(initial=0)), -int(values.min(initial=0)) - 1, 0)
    planes = top.bit_length() + 1
    bits = (values[None] >> np.arange(planes)[:, None, None]) & 1
    return np.packbits(bits.astype(np.uint8), axis=2, bitorder="little").transpose(0, 2, 1).copy()


def table_scores(tables: np.ndarray, planes: np.ndarray, chunk: int = 512) -> np.ndarray:
    """(row, anchor) inner products: shifted sums of table look-ups by the rows' bytes."""
    groups = min(len(tables), planes.shape[1])
    n = planes.shape[2]
    out = np.zeros((n, tables.shape[2]), tables.dtype)
    found = np.empty((min(chunk, n), tables.shape[2]), tables.dtype)
    for at in range(0, n, chunk):
        acc = out[at:at + chunk]
        look = found[:len(acc)]
        for b in range(len(planes) - 1, -1, -1):
            for g in range(groups):
                np.take(tables[g], planes[b, g, at:at + chunk], axis=0, out=look)
                acc += look
            if b == len(planes) - 1:
                np.negative(acc, out=acc)
            if b:
                acc += acc
    return out


def quantised(vectors: pa.Array) -> np.ndarray:
    """(row, dimension) floor(256 * x) of lists of doubles, filled up with 0 to a multiple of eight dimensions."""
    size = np.diff(vectors.offsets.to_numpy())
    width = -(-int(size.max(initial=1)) // GROUP) * GROUP
    out = np.zeros((len(vectors), max(width, GROUP)), np.int64)
    flat = np.floor(SCALE * vectors.flatten().to_numpy(zero_copy_only=False))
    if len(flat) and np.abs(flat).max() >= 2.0**48:
        raise OverflowError("components are too large for exact scores")
    out[np.arange(out.shape[1]) < size[:, None]] = flat.astype(np.int64)
    return out


def take_part(df: DataFrame, label: Column) -> DataFrame:
    """(vec_id, label, vector) of the rows that take part."""
    number = F.col("embedding").cast("array<double>")
    finite = F.forall(number, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    rows = df.select(F.col("vec_id").cast("long").alias("vec_id"), label.cast("long").alias("label"),
                     number.alias("vector"), finite.alias("whole"))
    return rows.filter("vec_id IS NOT NULL AND label IS NOT NULL AND vector IS NOT NULL AND whole") \
        .select("vec_id", "label", "vector")


def _blocks(rows: DataFrame, size: int, data: str, pack) -> DataFrame:
    """Blocks of ``size`` rows, in order of label and id over the partitions and within them."""
    ship_package(rows.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pid, seq, held, n = TaskContext.get().partitionId(), 0, [], 0

        def block(table: pa.Table) -> pa.RecordBatch:
            ids, labels = table["vec_id"].to_numpy(), table["label"].to_numpy()
            vectors = table["vector"].combine_chunks()
            values = quantised(vectors.chunk(0) if isinstance(vectors, pa.ChunkedArray) else vectors)
            row = {"pid": pid, "seq": seq, "lo": int(labels[0]), "hi": int(labels[-1]),
                   "labs": np.unique(labels).tolist(), "size": len(ids), "width": values.shape[1] // GROUP,
                   "ids": ids.tobytes(), "labels": labels.tobytes(), **pack(values)}
            return pa.RecordBatch.from_pylist([row], schema=out)

        for batch in batches:
            while batch.num_rows:
                part = batch.slice(0, size - n)
                batch = batch.slice(part.num_rows)
                held.append(part)
                n += part.num_rows
                if n == size:
                    yield block(pa.Table.from_batches(held))
                    seq, held, n = seq + 1, [], 0
        if n:
            yield block(pa.Table.from_batches(held))

    schema = T.StructType.fromDDL(_BLOCK.format(data=data))
    out = to_arrow_schema(schema)
    return rows.repartitionByRange("label", "vec_id").sortWithinPartitions("label", "vec_id").mapInArrow(run, schema)


def _numbered(blocks: DataFrame) -> tuple[DataFrame, int]:
    """``blocks`` with a running number ``j`` in order of label, and how many there are. The driver sees one count for
    each partition."""
    counts = sorted(map(tuple, blocks.groupBy("pid").agg(F.count(F.lit(1)).alias("n")).collect()))
    offsets = np.cumsum([0] + [n for _, n in counts]).tolist()
    starts = blocks.sparkSession.createDataFrame([(p, o) for (p, _), o in zip(counts, offsets)], "pid int, start long")
    return blocks.join(starts, "pid").withColumn("j", F.col("start") + F.col("seq")).drop("pid", "seq", "start"), \
        offsets[-1]


class _Best:
    """The best ``k`` (score, id) of each slot, higher scores and then smaller ids first."""

    def __init__(self, k: int) -> None:
        self.k = k
        self.slot, self.score, self.id = (np.empty(0, np.int64) for _ in range(3))

    def add(self, slot: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        slot, score, ids = (np.concatenate(x) for x in ((self.slot, slot), (self.score, score), (self.id, ids)))
        order = np.lexsort((ids, -score, slot))
        slot = slot[order]
        rank = np.arange(len(slot)) - np.searchsorted(slot, slot, "left")
        order = order[rank < self.k]
        self.slot, self.score, self.id = slot[rank < self.k], score[order], ids[order]


def _positives(s: np.ndarray, a: dict, c: dict, best: _Best) -> None:
    """Rows of the anchor's label and another id."""
    row, col = np.nonzero((c["labels"][:, None] == a["labels"]) & (c["ids"][:, None] != a["ids"]))
    score, ids = s[row, col].astype(np.int64), c["ids"][row]
    keep = np.lexsort((ids, -score, col))
    rank = np.arange(len(keep)) - np.searchsorted(col[keep], col[keep], "left")
    keep = keep[rank < best.k]
    best.add(col[keep], score[keep], ids[keep])


def _negatives(s: np.ndarray, a: dict, c: dict, best: _Best, low: int, high: int) -> None:
    """Rows of other labels within the limits of each positive. Slot ``anchor * k + positive``."""
    limit, has = a["limits"], a["has"]  # (anchor, positive)
    top = np.where(has, limit, -(2**50)).max(1)
    least = np.where(has & (limit >= 0), -(-low * limit // high), 2**50).min(1)
    row, col = np.nonzero((s <= top) & (s >= least) & (c["labels"][:, None] != a["labels"]))
    if not len(row):
        return
    score, ids = s[row, col].astype(np.int64), c["ids"][row]
    order = np.lexsort((ids, -score, col))
    score, ids, col = score[order], ids[order], col[order]
    most = int(score.max())
    span = most - int(score.min()) + 2
    key = col * span + (most - score)
    which, k = np.nonzero(has)
    p = limit[which, k]
    # From the first row whose score is not above the positive's.
    start = np.searchsorted(key, which * span + np.clip(most - p, 0, span - 1), "left")
    at = start[:, None] + np.arange(best.k)
    ok = at < len(key)
    at = np.minimum(at, len(key) - 1)
    ok &= (col[at] == which[:, None]) & (high * score[at] >= low * p[:, None]) & (score[at] <= p[:, None])
    i, _ = np.nonzero(ok)
    best.add(which[i] * limit.shape[1] + k[i], score[at[ok]], ids[at[ok]])


def _scored(pairs: DataFrame, anchors: DataFrame, rows: DataFrame, overlap: bool, out: str, k: int, collect,
            emit) -> DataFrame:
    """The best rows of the cells ``pairs`` (strip, c), as ``emit`` writes them."""
    spark = rows.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    c = rows.select(F.floor(F.col("j") / SLICE_BLOCKS).alias("c"), F.col("lo").alias("clo"), F.col("hi").alias("chi"),
                    F.struct("size", "width", "ids", "labels", "planes", "data").alias("rows"))
    extra = [x for x in ("positives",) if x in anchors.columns]
    a = anchors.select(F.floor(F.col("j") / STRIP_BLOCKS).alias("strip"), F.col("lo").alias("alo"),
                       F.col("hi").alias("ahi"),
                       F.struct("j", "size", "width", "ids", "labels", "data", *extra).alias("anchors"))
    # Cells are work, not bytes: a fixed number of partitions, which Spark does not merge by their size.
    cells = pairs.join(c, "c").repartition(n, "strip", "c").join(
        pairs.join(a, "strip").repartition(n, "strip", "c"), ["strip", "c"])
    if overlap:
        cells = cells.filter("alo <= chi AND clo <= ahi")
    schema = T.StructType.fromDDL(out)
    kinds = to_arrow_schema(schema)
    ship_package(spark)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, tuple[dict, np.ndarray, _Best]] = {}

        def flush() -> Iterator[pa.RecordBatch]:
            for block, _, best in held.values():
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in emit(block, best)], schema=kinds)
            held.clear()

        for batch in batches:
            for i in range(batch.num_rows):
                x, y = batch.column(0)[i].as_py(), batch.column(1)[i].as_py()
                if x["j"] not in held:
                    if len(held) >= HELD_BLOCKS:
                        yield from flush()
                    held[x["j"]] = (block := _anchor_block(x, k), subset_sums(block["values"]), _Best(k))
                block, tables, best = held[x["j"]]
                planes = np.frombuffer(y["data"], np.uint8).reshape(y["planes"], y["width"], y["size"])
                most = block["most"] << (y["planes"] - 1)
                if most >= 2**48:
                    raise OverflowError("scores are too large")
                if most < 2**31 and tables.dtype != np.int32:
                    tables = tables.astype(np.int32)
                    held[x["j"]] = (block, tables, best)
                elif most >= 2**31 and tables.dtype != np.int64:
                    tables = subset_sums(block["values"])
                row = {"ids": np.frombuffer(y["ids"], np.int64), "labels": np.frombuffer(y["labels"], np.int64)}
                collect(table_scores(tables, planes), block, row, best)
        yield from flush()

    return cells.select("anchors", "rows").mapInArrow(run, schema)


def _anchor_block(x: dict, k: int) -> dict:
    values = np.frombuffer(x["data"], np.int64).reshape(x["width"] * GROUP, x["size"])
    out = {"j": x["j"], "ids": np.frombuffer(x["ids"], np.int64), "labels": np.frombuffer(x["labels"], np.int64),
           "values": values, "most": int(np.abs(values).sum(0).max(initial=0))}
    if "positives" in x:
        out["limits"] = np.zeros((x["size"], k), np.int64)
        out["has"] = np.zeros((x["size"], k), bool)
        out["positive_ids"] = np.zeros((x["size"], k), np.int64)
        for p in x["positives"]:
            out["limits"][p["anchor"], p["r"]] = p["score"]
            out["positive_ids"][p["anchor"], p["r"]] = p["id"]
            out["has"][p["anchor"], p["r"]] = True
    return out


def _first(df: DataFrame, keys: list[str], k: int, rank: str) -> DataFrame:
    """The best ``k`` rows of each key by (score, id), with their rank from 1."""
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), F.asc("id"))
    return df.withColumn(rank, F.row_number().over(order)).filter(F.col(rank) <= k)


def mine(rows: DataFrame, anchor: Column, k: int = 5, low: int = 80, high: int = 100) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score and negative_score: for each anchor (rows of
    ``take_part`` for which ``anchor`` holds) and each of its ``k`` best other rows of its label, the ``k`` best rows
    of other labels with low * positive_score <= high * negative_score <= high * positive_score."""
    spark = rows.sparkSession
    scratch = Scratch(spark, "hard-negatives")
    table, total = _numbered(scratch.write(_blocks(
        rows, BLOCK_ROWS, "planes int, data binary",
        lambda v: {"planes": len(p := bit_planes(v)), "data": p.tobytes()}))[0])
    anchors, queries = _numbered(scratch.write(_blocks(
        rows.filter(anchor), BLOCK_ANCHORS, "data binary", lambda v: {"data": v.T.tobytes()}))[0])

    span = table.select(F.explode("labs").alias("label"), "j").groupBy("label").agg(
        F.min("j").alias("first"), F.max("j").alias("last"))
    begin = span.select(F.col("label").alias("lo"), "first")
    end = span.select(F.col("label").alias("hi"), "last")
    ranges = anchors.select(F.floor(F.col("j") / STRIP_BLOCKS).alias("strip"), "lo", "hi").join(begin, "lo") \
        .join(end, "hi").groupBy("strip").agg(F.min("first").alias("first"), F.max("last").alias("last"))
    near = ranges.select("strip", F.explode(F.sequence(F.floor(F.col("first") / SLICE_BLOCKS),
                                                       F.floor(F.col("last") / SLICE_BLOCKS))).alias("c"))
    found = _scored(near, anchors, table, True, "j long, anchor int, score long, id long", k, _positives,
                    lambda block, best: [np.full(len(best.slot), block["j"]), best.slot.astype(np.int32), best.score,
                                         best.id])
    positives, _ = scratch.write(_first(found, ["j", "anchor"], k, "r").groupBy("j").agg(
        F.collect_list(F.struct("anchor", (F.col("r") - 1).alias("r"), "score", "id")).alias("positives")))

    slices, strips = -(-total // SLICE_BLOCKS), -(-queries // STRIP_BLOCKS)
    c = F.sequence(F.lit(0).cast("long"), F.lit(max(0, slices - 1)).cast("long"))
    every = spark.range(strips).select(F.col("id").alias("strip"), F.explode(c).alias("c"))

    def negatives(block: dict, best: _Best) -> list:
        a, p = best.slot // k, best.slot % k
        return [np.full(len(a), block["j"]), a.astype(np.int32), p.astype(np.int32), block["ids"][a],
                block["positive_ids"][a, p], block["limits"][a, p], best.score, best.id]

    out = _scored(every, anchors.join(positives, "j"), table, False,
                  "j long, anchor int, p int, anchor_id long, positive_id long, positive_score long, score long, "
                  "id long", k, lambda s, a, c, best: _negatives(s, a, c, best, low, high), negatives)
    return _first(out, ["j", "anchor", "p"], k, "rank").select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("negative_id"),
        "positive_score", F.col("score").alias("negative_score"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.col("label").cast("long")
    label = F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label)
    rows = take_part(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), label)
    return mine(rows, F.col("vec_id") % 100 == 0)


ORACLE = """
WITH e AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label::BIGINT + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x::DOUBLE))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, e.vec_id, a.label = e.label AS same_label,
         list_inner_product(a.q, e.q)::BIGINT AS score
  FROM e a JOIN e ON a.vec_id % 100 = 0),
p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same_label AND vec_id <> anchor_id
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
n AS (
  SELECT p.anchor_id, positive_id, positive_score, vec_id AS negative_id, score AS negative_score,
         row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, vec_id) AS rank
  FROM p JOIN s ON p.anchor_id = s.anchor_id AND NOT same_label
    AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score)
SELECT anchor_id, positive_id, rank::INTEGER AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 5
"""
