"""Near-duplicates by MinHash: many universal hash minima with banding, signature verification, exact confirmation
and connected components.

A document's set is its distinct ``k``-word shingles (words with A-Z lower-cased), as 64-bit hashes. Documents with
equal sets form a class, represented by its smallest id, so copies are never compared. The representatives' minima of
``BANDS * ROWS`` universal hashes are cut into bands; those that agree in a band share a bucket. A pair of a bucket is
confirmed on its full sets if the sizes allow the similarity and the signatures come near it. Two documents at the
similarity of 0.8 miss each other in all bands with a probability below 4e-6, and fail the signature check
below 1e-9.

Not all pairs of a bucket are compared: only links that join two components matter. First every member meets the pivot
it shares most bands with, and components are formed; most buckets are one component then. The members of buckets that
still hold several go on by an exact way. Two sets at the similarity share one of their rarest shingles (of a set of
n, the first n - ceil(0.8 n) + 1 by their number of such members), so members are grouped by those, and groups that
share members form a cluster; documents that share no more than a common passage have rare shingles of their own and
drop out. The members of a cluster outside its largest component are then held against all members of other
components, on the full sets. A cluster of more than ``CLUSTER_ROWS`` members is dealt out as blocks against blocks,
so a task's memory is bounded and no link between components is lost; no pair becomes a row unless it is a link.

Defined results: a null or empty text (or one without words) has an empty set and is linked with nothing, as is a null
``doc_id``; texts of fewer than ``k`` words have their whole sequence as one shingle; rows that repeat an id are one
document with the links of all its texts; an empty table gives no rows; other columns are ignored, and kept by the
pipeline stage.
"""

from __future__ import annotations

import hashlib
import struct

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dataprism.llm.common import (Scratch, arrow_map, batch_hashes, documents, mix, plain_extras, raw_texts, release, same,
                                  window_hashes)
from dataprism.llm.components import components

BANDS = 32
ROWS = 5
PERCENT = 80
SLACK = 0.2  # six standard deviations of the estimate at 0.8
CLUSTER_ROWS = 4000

_rng = np.random.default_rng(20)
_MULTIPLIERS = _rng.integers(0, 2**63, BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ADDENDS = _rng.integers(0, 2**63, BANDS * ROWS, dtype=np.uint64)


def shingle_sets(raws: list[bytes], k: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    h, off = batch_hashes([x.lower() for x in raws])
    g = window_hashes(h, k)
    out = []
    for a, b in zip(off.tolist(), off[1:].tolist()):
        if b - a >= k:
            out.append(np.unique(g[a:b - k + 1]))
        else:
            out.append(window_hashes(h[a:b], b - a) if b > a else np.empty(0, np.uint64))
    return out


def minima(sets: list[np.ndarray], block: int = 1 << 17) -> np.ndarray:
    """(set, hash) the smallest value of every universal hash over each set; all ones for an empty set."""
    out = np.full((len(sets), len(_MULTIPLIERS)), np.uint64(2**64 - 1))
    at = 0
    while at < len(sets):
        end, total = at, 0
        while end < len(sets) and (end == at or total + len(sets[end]) <= block):
            total += len(sets[end])
            end += 1
        some = [i for i in range(at, end) if len(sets[i])]
        if some:
            flat = np.concatenate([sets[i] for i in some])
            starts = np.concatenate([[0], np.cumsum([len(sets[i]) for i in some])[:-1]])
            value = np.empty_like(flat)
            for j, (m, a) in enumerate(zip(_MULTIPLIERS, _ADDENDS)):
                np.multiply(flat, m, out=value)
                value += a
                out[some, j] = np.minimum.reduceat(value, starts)
        at = end
    return out >> np.uint64(32)


def sketches(docs: DataFrame, k: int) -> DataFrame:
    """(doc_id, n, hi, lo, bands, sig): set size, 128-bit hash of the set, band hashes and one byte of each minimum."""
    def run(batch: pa.RecordBatch) -> list:
        sets = shingle_sets(raw_texts(batch.column(1)), k)
        m = minima(sets)
        bands = np.zeros((len(sets), BANDS), np.uint64)
        for r in range(ROWS):
            bands = mix(bands + m[:, r::ROWS] + np.uint64(r + 1))
        sig = (mix(m) & np.uint64(255)).astype(np.uint8)
        hi, lo = zip(*[struct.unpack("<qq", hashlib.blake2b(s.tobytes(), digest_size=16).digest()) for s in sets])
        return [batch.column(0), [len(s) for s in sets], list(hi), list(lo),
                pa.ListArray.from_arrays(pa.array(np.arange(0, bands.size + 1, BANDS, dtype=np.int32)),
                                         pa.array(bands.view(np.int64).ravel())),
                [s.tobytes() for s in sig]]

    return arrow_map(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), run,
                     "doc_id long, n long, hi long, lo long, bands array<long>, sig binary", rows=500)


def _near(pairs: DataFrame, sigs: DataFrame, percent: int) -> DataFrame:
    """The pairs whose signatures come near the similarity."""
    rows = pairs.join(sigs.select(F.col("rep").alias("a"), F.col("sig").alias("sa")), "a") \
        .join(sigs.select(F.col("rep").alias("b"), F.col("sig").alias("sb")), "b")

    def run(batch: pa.RecordBatch) -> list:
        sa = np.frombuffer(b"".join(batch.column(2).to_pylist()), np.uint8).reshape(batch.num_rows, -1)
        sb = np.frombuffer(b"".join(batch.column(3).to_pylist()), np.uint8).reshape(batch.num_rows, -1)
        equal = (sa == sb).mean(1) if batch.num_rows else np.empty(0)
        keep = (equal - 1 / 256) * 256 / 255 >= percent / 100 - SLACK
        return [batch.column(0), batch.column(1), keep]

    return arrow_map(rows.select("a", "b", "sa", "sb"), run, "a long, b long, near boolean") \
        .filter("near").select("a", "b").distinct()


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs whose full sets have the similarity."""
    rows = pairs.join(sets.select(F.col("rep").alias("a"), F.col("shingles").alias("sa")), "a") \
        .join(sets.select(F.col("rep").alias("b"), F.col("shingles").alias("sb")), "b")

    def run(batch: pa.RecordBatch) -> list:
        keep = []
        for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
            x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
            both = np.concatenate([x, y])
            both.sort()
            common = int((both[1:] == both[:-1]).sum())
            keep.append(100 * common >= percent * (len(both) - common))
        return [batch.column(0), batch.column(1), keep]

    return arrow_map(rows.select("a", "b", "sa", "sb"), run, "a long, b long, linked boolean", rows=500) \
        .filter("linked").select("a", "b").distinct()


def _sized(percent: int):
    return 100 * F.least("na", "nb") >= percent * F.greatest("na", "nb")


def _open_members(members: DataFrame, state: DataFrame) -> DataFrame:
    """(rep): the members of buckets that hold several components."""
    now = members.join(state.withColumnRenamed("node", "rep"), "rep", "left") \
        .withColumn("component", F.coalesce("component", "rep"))
    several = now.groupBy("band", "key").agg(F.min("component").alias("c1"), F.max("component").alias("c2")) \
        .filter("c1 < c2").select("band", "key")
    return now.join(several, ["band", "key"]).select("rep").distinct()


def _rare_groups(members: DataFrame, sets: DataFrame, percent: int, scratch: Scratch) -> DataFrame:
    """(token, rep): the rarest shingles of each member that others may share, in groups of two or more. An id that
    repeats with several texts is a member with several sets, each with a prefix of its own."""
    def explode(batch: pa.RecordBatch) -> list:
        each = [np.frombuffer(x, np.int64) for x in batch.column(2).to_pylist()]
        size = np.array([len(x) for x in each], np.int64)
        rows = pa.array(np.repeat(np.arange(len(each)), size))
        return [batch.column(0).take(rows), batch.column(1).take(rows), np.repeat(size, size),
                np.concatenate([*each, np.empty(0, np.int64)])]

    opened, _ = scratch.write(members)
    tokens = arrow_map(opened.join(sets.withColumnRenamed("rep", "r"), F.col("rep") == F.col("r"))
                       .select("rep", F.xxhash64("shingles").alias("set"), "shingles"), explode,
                       "rep long, set long, n long, token long")
    counts = tokens.groupBy(F.col("token").alias("t")).agg(F.count(F.lit(1)).alias("df")).filter("df > 1")
    # Shingles that no other member has come first in the order and are in nobody's group.
    own = tokens.join(counts, F.col("token") == F.col("t")).groupBy("rep", "set", "n").agg(
        F.array_sort(F.collect_list(F.struct("df", "token"))).alias("shared"))
    prefix = F.col("n") - F.call_function("div", F.col("n") * percent + 99, F.lit(100)) + 1
    rare = (prefix - (F.col("n") - F.size("shared"))).cast("int")
    groups, _ = scratch.write(own.filter(rare > 0).select(
        "rep", F.explode(F.slice("shared", F.lit(1), rare)).alias("s")).select(F.col("s.token").alias("token"), "rep"))
    return groups


def _cluster_links(groups: DataFrame, state: DataFrame, reps: DataFrame, sets: DataFrame, percent: int,
                   scratch: Scratch) -> DataFrame:
    """Links (a, b) between components, among members whose groups hang together."""
    heads = groups.groupBy("token").agg(F.min("rep").alias("b"))
    stars = groups.join(heads, "token").filter("rep <> b").select(F.col("rep").alias("a"), "b").distinct()
    clusters, _ = components(stars, scratch)
    found = clusters.select(F.col("node").alias("rep"), F.col("component").alias("cluster")) \
        .join(state.withColumnRenamed("node", "rep"), "rep", "left") \
        .withColumn("component", F.coalesce("component", "rep"))
    blocks = found.groupBy(F.col("cluster").alias("k")).agg(
        F.min("component").alias("c1"), F.max("component").alias("c2"), F.count(F.lit(1)).alias("size")) \
        .filter("c1 < c2").select("k", (1 + F.col("size") / CLUSTER_ROWS).cast("int").alias("blocks"))
    rows = found.join(blocks, F.col("cluster") == F.col("k")) \
        .join(sets.withColumnRenamed("rep", "r"), F.col("rep") == F.col("r")) \
        .join(reps.select(F.col("rep").alias("s"), "sig"), F.col("rep") == F.col("s"))
    rows = rows.withColumn("own", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int")) \
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rows = rows.select("cluster", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own",
                       "rep", "component", "shingles", "sig")
    # The work of a task grows with the square of its rows, so small partitions are not merged.
    rows = rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), "cluster", "i", "j")
    return rows.groupBy("cluster", "i", "j").applyInArrow(
        lambda table: _links_between(table, percent), "a long, b long").distinct()


def _links_between(table: pa.Table, percent: int) -> pa.Table:
    """Links that join components, between the two blocks of a task or within its only one.

    Members are in order of set size, so a pivot's partners by size stand together; those of other components whose
    signatures come near are held against the pivot on the full sets, all at once."""
    raw = [np.frombuffer(x, np.uint64) for x in table["shingles"].to_pylist()]
    order = np.argsort([len(x) for x in raw], kind="stable")
    raw = [raw[k] for k in order.tolist()]
    rep, own = table["rep"].to_numpy()[order], table["own"].to_numpy()[order]
    sig = np.frombuffer(b"".join(table["sig"].to_pylist()), np.uint8).reshape(len(rep), -1)[order]
    _, component = np.unique(table["component"].to_numpy()[order], return_inverse=True)
    size = np.array([len(x) for x in raw])
    words, flat = np.unique(np.concatenate(raw), return_inverse=True)
    start = np.cumsum(size) - size
    within = table["i"][0].as_py() == table["j"][0].as_py()
    if within:
        pivots = np.flatnonzero(component != np.bincount(component).argmax())
    else:  # the smaller block's members against the other's
        first = own == table["i"][0].as_py()
        pivots = np.flatnonzero(first if first.sum() * 2 <= len(own) else ~first)
    a, b = [], []
    mark = np.zeros(len(words), bool)
    for p in pivots.tolist():
        lo = np.searchsorted(size, -(-percent * size[p] // 100), "left")
        hi = np.searchsorted(size, 100 * size[p] // percent, "right")
        wanted = component[lo:hi] != component[p]
        if not within:
            wanted &= own[lo:hi] != own[p]
        some = lo + np.flatnonzero(wanted)
        equal = (sig[some] == sig[p]).mean(1)
        some = some[(equal - 1 / 256) * 256 / 255 >= percent / 100 - SLACK]
        if not len(some):
            continue
        mine = flat[start[p]:start[p] + size[p]]
        mark[mine] = True
        ends = np.cumsum(size[some])
        places = np.arange(ends[-1]) + np.repeat(start[some] - ends + size[some], size[some])
        common = np.add.reduceat(mark[flat[places]], ends - size[some], dtype=np.int64)
        mark[mine] = False
        for q in some[100 * common >= percent * (size[some] + size[p] - common)].tolist():
            if component[q] != component[p]:
                a.append(max(rep[p], rep[q]))
                b.append(min(rep[p], rep[q]))
                component[component == component[q]] = component[p]
    return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})


def near_duplicates(docs: DataFrame, k: int = 5, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id and kept for every row; documents are linked when 100 * intersection is at
    least ``percent`` * union of their sets."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "minhash")
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    table, _ = scratch.write(sketches(docs, k))
    full = table.filter("doc_id IS NOT NULL AND n > 0")
    # One representative for each class of equal sets; partial minima collapse copies before the shuffle.
    reps, _ = scratch.write(full.groupBy("hi", "lo").agg(
        F.min(F.struct("doc_id", "n", "bands", "sig")).alias("r")).select(
        "hi", "lo", F.col("r.doc_id").alias("rep"), "r.n", "r.bands", "r.sig"))
    buckets = reps.select("rep", "n", F.posexplode("bands").alias("band", "key"))
    shared = buckets.groupBy("band", "key").agg(F.min("rep").alias("lo_rep"), F.max("rep").alias("hi_rep")) \
        .filter("lo_rep < hi_rep").select("band", "key")
    members, _ = scratch.write(buckets.join(shared, ["band", "key"]))
    wanted = members.select(F.col("rep").alias("w")).distinct()

    def set_bytes(batch: pa.RecordBatch) -> list:
        return [batch.column(0), [s.tobytes() for s in shingle_sets(raw_texts(batch.column(1)), k)]]

    sets, _ = scratch.write(arrow_map(
        docs.join(wanted, F.col("doc_id") == F.col("w"), "left_semi"), set_bytes,
        "rep long, shingles binary", rows=500).filter(F.length("shingles") > 0).distinct())

    # Ids in several classes (rows that repeat an id) link the classes.
    member_of = full.select("doc_id", "hi", "lo").join(reps.select("hi", "lo", "rep"), ["hi", "lo"])
    several = member_of.groupBy("doc_id").agg(F.min("rep").alias("b"), F.max("rep").alias("z")).filter("b < z")
    links = member_of.join(several.select(F.col("doc_id").alias("d"), "b"), F.col("doc_id") == F.col("d")) \
        .filter("rep <> b").select(F.col("rep").alias("a"), "b").distinct()

    pivot = members.groupBy("band", "key").agg(F.min(F.struct("rep", "n")).alias("p"))
    first = members.join(pivot, ["band", "key"]).select(
        F.col("p.rep").alias("a"), F.col("rep").alias("b"), F.col("p.n").alias("na"), F.col("n").alias("nb")) \
        .filter("a <> b").filter(_sized(percent)).groupBy("a", "b").agg(F.count(F.lit(1)).alias("bands")) \
        .groupBy("b").agg(F.max(F.struct("bands", "a")).alias("best")).select(F.col("best.a").alias("a"), "b")
    release(spark)
    found = _confirmed(_near(first, reps, percent), sets, percent)
    linked, link_path = scratch.write(links.unionByName(found))
    state, state_path = components(linked, scratch)
    groups = _rare_groups(_open_members(members, state), sets, percent, scratch)
    release(spark)
    more, _ = scratch.write(_cluster_links(groups, state, reps, sets, percent, scratch))
    if not more.isEmpty():
        merged = state.filter("node <> component").select(F.col("node").alias("a"), F.col("component").alias("b"))
        state, _ = components(merged.unionByName(more), scratch)
    release(spark)
    scratch.drop(link_path)
    classes = reps.select("hi", "lo", "rep").join(state, F.col("rep") == F.col("node"), "left") \
        .select(F.col("hi").alias("h"), F.col("lo").alias("l"), F.coalesce("component", "rep").alias("c"))
    out = table.select("doc_id", "n", "hi", "lo").join(classes, (F.col("hi") == F.col("h")) & (F.col("lo") == F.col("l")),
                                                       "left")
    component = F.when((F.col("n") > 0) & F.col("doc_id").isNotNull(), F.col("c")).otherwise(F.col("doc_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"),
                      same(F.col("doc_id"), component).alias("kept"))


def op5_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(documents(spark, sf_dir), k=2)


@plain_extras
def keep_one(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: the smallest id of each group of near-duplicates, with its own columns."""
    drop = near_duplicates(docs).filter("NOT kept").select(F.col("doc_id").alias("__drop")).distinct()
    return docs.join(drop, F.col("doc_id").cast("long") == F.col("__drop"), "left_anti")
