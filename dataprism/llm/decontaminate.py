"""Benchmark decontamination by greedy string tiling.

Words are compared with A-Z lower-cased and ASCII punctuation taken as space. Every window of ``MIN_MATCH`` words of a
text is looked up among the benchmark's windows (shared-token seeds); only the items a text shares a seed with are
tiled. Tiling marks the longest common non-overlapping matches first: matches of a search length are found by rolling
hashes (running Karp-Rabin), extended word by word, marked from long to short, and the search length falls until it
is the minimum. The share of an item's words under tiles is its coverage, whatever the order of the tiles in the
text; an item covered by ``MIN_COVERAGE`` or more contaminates the text.

The benchmark is a table like the documents and never passes through the driver. Its distinct seeds are joined with the
documents' seeds, equal texts counting once; a bitmap of the seeds, of ``FILTER_BITS`` bits at most (16 MB), is broadcast
so that windows which no item has are not shuffled at all. Each (text, item) pair that shares seeds then meets the
item's words, together with the words under its shared seeds (only these can lie in a tile), and is tiled. So a task
holds pairs, neither the benchmark nor texts, and the texts themselves are not shuffled.

Defined results: a null or empty text (or one without words) matches nothing; items without words match nothing;
items shorter than ``MIN_MATCH`` words must be matched whole; equal items are all reported, an id once; an item without
an id counts for the coverage alone; a very long text is hashed in blocks and its pairs hold the words under shared
seeds; repeated rows get equal results; an empty documents table gives no rows, an empty benchmark no matches; other
columns, whatever their names, are ignored, and kept by the pipeline stage.
"""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dataprism.llm.common import (PLAIN, Scratch, arrow_map, batch_hashes, documents, plain_extras, raw_texts,
                                  window_hashes)

MIN_MATCH = 5
MIN_COVERAGE = 0.5
FILTER_BITS = 27


def _tokens(raws: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    return batch_hashes([x.translate(PLAIN) for x in raws])


def _matches(text: list[int], item: list[int], text_free: list[bool], item_free: list[bool], size: int) -> list:
    """(length, place in item, place in text) of the longest unmarked matches that begin with ``size`` equal words.

    Rolling hashes of the text's free windows are looked up among those of the item; a window that begins inside a
    match of the same diagonal found before is skipped."""
    base, mod = 1_000_003, (1 << 61) - 1
    top = pow(base, size - 1, mod)

    def rolled(words: list[int], free: list[bool]) -> list[tuple[int, int]]:
        out, h, run = [], 0, 0
        for i, w in enumerate(words):
            if not free[i]:
                h, run = 0, 0
                continue
            if run == size:
                h = (h - (words[i - size] % mod) * top) % mod
                run -= 1
            h = (h * base + w) % mod
            run += 1
            if run == size:
                out.append((h, i - size + 1))
        return out

    at = defaultdict(list)
    for h, p in rolled(item, item_free):
        at[h].append(p)
    found, ends = [], {}
    for h, t in rolled(text, text_free):
        for p in at.get(h, ()):
            if ends.get(t - p, -1) > t:
                continue
            n = 0
            while p + n < len(item) and t + n < len(text) and item_free[p + n] and text_free[t + n] \
                    and item[p + n] == text[t + n]:
                n += 1
            if n >= size:
                found.append((n, p, t))
                ends[t - p] = t + n
    return found


def tile(text: list[int], item: list[int], min_match: int = MIN_MATCH) -> list[tuple[int, int, int]]:
    """The tiles (length, place in item, place in text) of greedy string tiling; negative numbers match nothing."""
    text_free, item_free = [w >= 0 for w in text], [True] * len(item)
    tiles: list[tuple[int, int, int]] = []
    size = max(min_match, len(item) // 2)
    while True:
        found = _matches(text, item, text_free, item_free, size)
        longest = max((n for n, _, _ in found), default=0)
        if longest >= 2 * size and size < longest:
            size = longest
            continue
        occluded = False
        for n, p, t in sorted(found, key=lambda x: (-x[0], x[1], x[2])):
            if all(item_free[p:p + n]) and all(text_free[t:t + n]):
                tiles.append((n, p, t))
                item_free[p:p + n] = [False] * n
                text_free[t:t + n] = [False] * n
            else:
                occluded = True
        if occluded:
            continue  # what is left free of overlapped matches may still match at this length
        if size == min_match:
            return tiles
        size = max(min_match, size // 2)


def _items(benchmark: DataFrame) -> DataFrame:
    """(item_id, i1, i2, k, words, seeds) of the items that have words; ``i1, i2`` is a hash of the words."""
    def run(batch: pa.RecordBatch) -> list:
        h, off = _tokens(raw_texts(batch.column(1)))
        ids, k, words, seeds = [], [], [], []
        for item_id, a, b in zip(batch.column(0).to_pylist(), off.tolist(), off[1:].tolist()):
            if b > a:
                ids.append(item_id)
                k.append(min(MIN_MATCH, b - a))
                words.append((h[a:b] >> np.uint64(1)).tobytes())
                seeds.append(np.unique(window_hashes(h[a:b], k[-1])).view(np.int64))
        ends = np.cumsum([0] + [len(x) for x in seeds]).astype(np.int32)
        return [ids, k, words, pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(
            [*seeds, np.empty(0, np.int64)])))]

    found = arrow_map(benchmark.select(F.col("item_id").cast("long"), F.col("text").cast("string")), run,
                      "item_id long, k int, words binary, seeds array<long>", rows=500)
    return found.select("item_id", F.xxhash64("words").alias("i1"), F.xxhash64(F.lit(7), "words").alias("i2"), "k",
                        "words", "seeds")


def _seed_filter(seeds: DataFrame) -> np.ndarray:
    """One bit for each value of the seeds' low bits: sixteen bits a seed, ``2**FILTER_BITS`` at most."""
    n = seeds.agg(F.approx_count_distinct("seed")).first()[0]
    size = 1 << max(15, min(FILTER_BITS, int(16 * n).bit_length()))
    at = F.pmod(F.col("seed"), F.lit(size).cast("long")) + 1
    parts = seeds.groupBy(F.bitmap_bucket_number(at).alias("b")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(at)).alias("bits")).collect()
    out = np.zeros(size // 8, np.uint8)
    for r in parts:
        out[(r.b - 1) * 4096:r.b * 4096] = np.frombuffer(r.bits, np.uint8)
    return out


def _shared_windows(docs: DataFrame, kinds: list[int], bits: np.ndarray) -> DataFrame:
    """(t1, t2, k, place, seed, words): the windows of each text whose hashes pass the filter."""
    shared = docs.sparkSession.sparkContext.broadcast(bits)

    def run(batch: pa.RecordBatch) -> list:
        marks = shared.value
        h, off = _tokens(raw_texts(batch.column(2)))
        doc, size, place, seed, words = [], [], [], [], []
        for k in kinds:
            g = window_hashes(h, k)
            low = (g & np.uint64(8 * len(marks) - 1)).astype(np.int64)
            at = np.flatnonzero(marks[low >> 3] >> (low & 7).astype(np.uint8) & 1)
            d = np.searchsorted(off, at, "right") - 1
            inside = at + k <= off[d + 1]
            at, d = at[inside], d[inside]
            doc.append(d)
            size.append(np.full(len(at), k, np.int32))
            place.append(at - off[d])
            seed.append(g[at].view(np.int64))
            words.extend((h[at[:, None] + np.arange(k)] >> np.uint64(1)).view(f"V{8 * k}").ravel().tolist()
                         if len(at) else [])
        rows = pa.array(np.concatenate(doc))
        return [batch.column(0).take(rows), batch.column(1).take(rows), np.concatenate(size), np.concatenate(place),
                np.concatenate(seed), pa.array(words, pa.binary())]

    keys = _text_key(F.col("text").cast("string"))
    return arrow_map(docs.select(*keys, F.col("text").cast("string")), run,
                     "t1 long, t2 long, k int, place long, seed long, words binary", rows=500)


def _text_key(text: Column) -> list[Column]:
    return [F.xxhash64(text).alias("t1"), F.xxhash64(F.lit(7), text).alias("t2")]


def _coverage(hits: list[dict], k: int, item: list[int]) -> float:
    """The share of the item's words under tiles of the text whose words under shared seeds are ``hits``."""
    text, end = [], -1
    for hit in sorted(hits, key=lambda x: x["place"]):
        p = hit["place"]
        words = np.frombuffer(hit["words"], np.int64).tolist()
        if p > end:
            text.append(-1)
        text.extend(words[max(p, end) - p:])
        end = p + k
    return sum(n for n, _, _ in tile(text, item, k)) / len(item)


def find_items(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(t1, t2, items, coverage): for each contaminated text, by its hash, the ids of the items found and the largest
    coverage."""
    scratch = Scratch(docs.sparkSession, "tiling")
    items, _ = scratch.write(_items(benchmark))
    whole = items.groupBy("i1", "i2", "k").agg(F.min("words").alias("item"))
    seeds = items.select("i1", "i2", "k", F.explode("seeds").alias("seed")).distinct()
    kinds = sorted(r.k for r in items.select("k").distinct().collect())  # MIN_MATCH numbers at most
    empty = "t1 long, t2 long, items array<long>, coverage double"
    if not kinds:
        return docs.sparkSession.createDataFrame([], empty)
    # Copies of a text have the same windows, which count once.
    windows = _shared_windows(docs, kinds, _seed_filter(seeds)).groupBy("t1", "t2", "k", "place", "seed") \
        .agg(F.min("words").alias("words"))
    pairs = windows.join(seeds, ["seed", "k"]).groupBy("t1", "t2", "i1", "i2", "k").agg(
        F.collect_list(F.struct("place", "words")).alias("hits"))

    def tiled(batch: pa.RecordBatch) -> list:
        share = [_coverage(hits, k, np.frombuffer(item, np.int64).tolist()) for k, hits, item in zip(
            *(batch.column(i).to_pylist() for i in (4, 5, 6)))]
        return [*batch.columns[:4], share]

    found = arrow_map(pairs.join(whole, ["i1", "i2", "k"]).select("t1", "t2", "i1", "i2", "k", "hits", "item"), tiled,
                      "t1 long, t2 long, i1 long, i2 long, coverage double", rows=200) \
        .filter(F.col("coverage") >= MIN_COVERAGE)
    ids = items.select("i1", "i2", "item_id").distinct()
    out = found.join(ids, ["i1", "i2"]).groupBy("t1", "t2").agg(
        F.array_sort(F.collect_set("item_id")).alias("items"), F.max("coverage").alias("coverage"))
    return scratch.write(out)[0]


def mark_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` with ``__items`` (ids of the items found, sorted) and ``__coverage`` (the largest coverage found)."""
    found = find_items(docs, benchmark).select(
        F.col("t1").alias("__t1"), F.col("t2").alias("__t2"), F.col("items").alias("__items"),
        F.col("coverage").alias("__coverage"))
    t1, t2 = _text_key(F.col("text").cast("string"))
    out = docs.join(found, (t1 == F.col("__t1")) & (t2 == F.col("__t2")), "left").drop("__t1", "__t2")
    return out.withColumns({"__items": F.coalesce("__items", F.array().cast("array<long>")),
                            "__coverage": F.coalesce("__coverage", F.lit(0.0))})


def op4_tiling(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    found = find_items(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    keys = docs.select("doc_id", *_text_key(F.col("text").cast("string")))  # the texts don't meet the results
    out = keys.join(found, ["t1", "t2"], "left")
    coverage = F.coalesce("coverage", F.lit(0.0))
    return out.select("doc_id", (coverage >= MIN_COVERAGE).alias("contaminated"), coverage.alias("coverage"),
                      F.array_join(F.coalesce("items", F.array().cast("array<long>")), ",").alias("items"))


@plain_extras
def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: the documents without a benchmark item in them, with their own columns."""
    found = find_items(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).select(
        F.col("t1").alias("__t1"), F.col("t2").alias("__t2"))
    t1, t2 = _text_key(F.col("text").cast("string"))
    return docs.join(found, (t1 == F.col("__t1")) & (t2 == F.col("__t2")), "left_anti")
