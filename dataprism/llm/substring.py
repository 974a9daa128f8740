"""Substring deduplication by repeated-phrase automata.

A window is ``WINDOW`` consecutive words. A word goes when a window over it also starts in a document with a smaller
id. The steps, each one Spark job over written tables in the shared folder:

1. *Candidates.* The smallest hash of the ``ANCHOR``-word phrases in a window is its anchor, and equal windows have
   equal anchors; about a fifth of all phrases are anchors. Windows whose anchor occurs in one document only are
   dismissed. What is left are segments of documents.
2. *Recurring passages are confirmed.* Each window of a segment is hashed; the smallest document that has it owns it
   if another document has it, too. Runs of owned windows in the owner's text are the passages.
3. *Sharded automata.* Passages are dealt out by owner to shards of about ``SHARD_WORDS`` words, and each document's
   segments go to the shards of the owners whose windows it has. A shard's task compiles an Aho-Corasick automaton
   over the opening phrases of the passages' windows and streams the segments through it; each place that it finds is
   confirmed on the whole window, so every occurrence of every window is found. A shard to which many documents go is
   copied over as many tasks as their size needs.
4. *Removal.* The covered words are joined to the documents.

Windows are counted with partial minima before the shuffle, and the joins by hash have one row a key on one side, so a
passage in a third of all documents is split by Spark's skew handling. No task holds an unbounded group.

Defined results: a null or empty text has no words; texts under ``WINDOW`` words lose nothing; a null ``doc_id`` has
no order, so its rows neither own windows nor lose words; rows that repeat an id are one document, which doesn't
remove its own repeats; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dataprism.llm.common import (Scratch, arrow_map, batch_hashes, documents, raw_texts, release,
                                  window_hashes)

WINDOW = 13
ANCHOR = 4
SHARD_WORDS = 30_000  # of passages; an automaton has up to PHRASE nodes for each
DIGIT = 192
PHRASE = 6
SYMBOLS = 96
OTHER = chr(1 + SYMBOLS)  # a word that no passage has
TASK_BYTES = 8 << 20


def _anchors(h: np.ndarray) -> np.ndarray:
    """The anchor of every window over word hashes: the smallest hash of its phrases."""
    m = window_hashes(h, ANCHOR)
    need, have = WINDOW - ANCHOR + 1, 1
    while have < need:  # minima over 2, 4, 8 ... phrases, the last step overlapping
        step = min(have, need - have)
        m = np.minimum(m[:len(m) - step], m[step:]) if len(m) > step else m[:0]
        have += step
    return m


def _lists(values: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    return (np.concatenate([*values, np.empty(0, np.int64)]),
            np.concatenate([[0], np.cumsum([len(v) for v in values])]))


def anchor_rows(docs: DataFrame) -> DataFrame:
    """(h, doc_id, t): the distinct anchors of each row."""
    def run(batch: pa.RecordBatch) -> list:
        h, off = batch_hashes(raw_texts(batch.column(2)))
        m = _anchors(h)
        each = [np.unique(m[a:b - WINDOW + 1]).view(np.int64) for a, b in zip(off.tolist(), off[1:].tolist())
                if b - a >= WINDOW]
        which = np.flatnonzero(np.diff(off) >= WINDOW)
        rows = np.repeat(which, [len(v) for v in each])
        return [_lists(each)[0], batch.column(0).take(pa.array(rows)), batch.column(1).take(pa.array(rows))]

    return arrow_map(docs, run, "h long, doc_id long, t long")


def segment_rows(docs: DataFrame) -> DataFrame:
    """(doc_id, t, start, text): the words under windows whose anchor is among ``hs``, from word number ``start``."""
    def run(batch: pa.RecordBatch) -> list:
        raws = raw_texts(batch.column(2))
        h, off = batch_hashes(raws)
        m = _anchors(h)
        ids, ts, starts, texts = [], [], [], []
        for i, (a, b) in enumerate(zip(off.tolist(), off[1:].tolist())):
            hs = batch.column(3)[i].values
            if b - a < WINDOW or hs is None:
                continue
            hit = np.flatnonzero(np.isin(m[a:b - WINDOW + 1], hs.to_numpy().view(np.uint64)))
            w = raws[i].split()
            for x, y in _runs(hit, WINDOW):
                ids.append(batch.column(0)[i].as_py())
                ts.append(batch.column(1)[i].as_py())
                starts.append(x)
                texts.append(b" ".join(w[x:y + WINDOW]).decode())
        return [ids, ts, starts, texts]

    return arrow_map(docs, run, "doc_id long, t long, start long, text string", rows=1000)


def _runs(places: np.ndarray, gap: int) -> list[tuple[int, int]]:
    """First and last of the runs of sorted ``places`` that are at most ``gap`` apart."""
    if not len(places):
        return []
    cut = np.flatnonzero(np.diff(places) > gap)
    return list(zip(places[np.concatenate([[0], cut + 1])].tolist(),
                    places[np.concatenate([cut, [len(places) - 1]])].tolist()))


def window_rows(segments: DataFrame) -> DataFrame:
    """(w, doc_id): the windows of each segment, hashed."""
    def run(batch: pa.RecordBatch) -> list:
        h, off = batch_hashes(raw_texts(batch.column(1)))
        g = window_hashes(h, WINDOW)
        each = [np.unique(g[a:b - WINDOW + 1]).view(np.int64) for a, b in zip(off.tolist(), off[1:].tolist())]
        rows = np.repeat(np.arange(len(each)), [len(v) for v in each])
        return [_lists(each)[0], batch.column(0).take(pa.array(rows))]

    return arrow_map(segments.select("doc_id", "text"), run, "w long, doc_id long")


def passage_rows(owned: DataFrame) -> DataFrame:
    """(owner, n, passage): runs of owned windows in the owner's segments, as text of ``n`` words."""
    def run(batch: pa.RecordBatch) -> list:
        raws = raw_texts(batch.column(1))
        h, off = batch_hashes(raws)
        g = window_hashes(h, WINDOW)
        owners, sizes, texts = [], [], []
        for i, (a, b) in enumerate(zip(off.tolist(), off[1:].tolist())):
            hit = np.flatnonzero(np.isin(g[a:b - WINDOW + 1], batch.column(2)[i].values.to_numpy().view(np.uint64)))
            w = raws[i].split()
            for x, y in _runs(hit, 1):
                owners.append(batch.column(0)[i].as_py())
                sizes.append(y + WINDOW - x)
                texts.append(b" ".join(w[x:y + WINDOW]).decode())
        return [owners, sizes, texts]

    return arrow_map(owned.select("doc_id", "text", "ws"), run, "owner long, n long, passage string", rows=1000)


class PhraseAutomaton:
    """An Aho-Corasick automaton over the opening phrases (``PHRASE`` words) of the windows of passages; a window has
    one owner only.

    The automaton reads a symbol a word, one of ``SYMBOLS`` by the word's hash: nodes have few children, which it
    searches one by one. Where it finds a phrase, the whole window is confirmed by the numbers of its words, which tell
    all words of the passages apart."""

    def __init__(self, passages: list[tuple[int, bytes]]) -> None:
        import ahocorasick

        texts = [text.split() for _, text in passages]
        vocabulary = set().union(*texts)
        self.digits = 1
        while DIGIT**self.digits <= len(vocabulary):
            self.digits += 1
        self.unknown = self._number(0)
        self.numbers = {w: self._number(n) for n, w in enumerate(vocabulary, 1)}
        self.symbols = {w: chr(1 + crc32(w) % SYMBOLS) for w in vocabulary}
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_LENGTH)
        self.owners: dict[str, int] = {}
        add, k = self.automaton.add_word, self.digits
        for (owner, _), w in zip(passages, texts):
            symbols, numbers = self._write(w, self.symbols, OTHER), self._write(w, self.numbers, self.unknown)
            for at in range(len(w) - WINDOW + 1):
                add(symbols[at:at + PHRASE])
                self.owners[numbers[at * k:(at + WINDOW) * k]] = owner
        self.automaton.make_automaton()

    def _number(self, n: int) -> str:
        return "".join(chr(n // DIGIT**k % DIGIT) for k in range(self.digits))

    @staticmethod
    def _write(words: list[bytes], table: dict[bytes, str], other: str) -> str:
        return "".join([table.get(w, other) for w in words])

    def covered(self, doc_id: int, text: bytes) -> list[tuple[int, int]]:
        """The (first, end) words under windows owned by smaller documents, joined where they touch."""
        words = text.split()
        starts = [last + 1 - PHRASE for last, _ in self.automaton.iter(self._write(words, self.symbols, OTHER))]
        if not starts:
            return []
        numbers, k, owner = self._write(words, self.numbers, self.unknown), self.digits, self.owners.get
        found = [at for at in starts if owner(numbers[at * k:(at + WINDOW) * k], doc_id) < doc_id]
        return [(x, y + WINDOW) for x, y in _runs(np.array(found, np.int64), WINDOW)]


def _automata(passages: pa.Table) -> Iterator[PhraseAutomaton]:
    """Automata over the passages of a shard, each of at most ``SHARD_WORDS`` words, one after the other: a shard of
    one very long document costs time, not memory. Cut passages overlap, so no window is lost."""
    part: list[tuple[int, bytes]] = []
    size = 0
    for owner, text in zip(passages["owner"].to_pylist(), passages["passage"].to_pylist()):
        w = text.encode().split()
        for at in range(0, max(1, len(w) - WINDOW + 1), SHARD_WORDS):
            piece = w[at:at + SHARD_WORDS + WINDOW - 1]
            if part and size + len(piece) > 2 * SHARD_WORDS:
                yield PhraseAutomaton(part)
                part, size = [], 0
            part.append((owner, b" ".join(piece)))
            size += len(piece)
    if part:
        yield PhraseAutomaton(part)


def _occurrences(passages: pa.Table, segments: pa.Table) -> pa.Table:
    found: dict[str, list[int]] = {"doc_id": [], "t": [], "first": [], "end": []}
    if segments.num_rows:
        rows = list(zip(*(segments[c].to_pylist() for c in ("doc_id", "t", "start", "text"))))
        for auto in _automata(passages):
            for doc_id, t, start, text in rows:
                for first, end in auto.covered(doc_id, text.encode()):
                    for name, v in zip(found, (doc_id, t, start + first, start + end)):
                        found[name].append(v)
    return pa.table({k: pa.array(v, pa.int64()) for k, v in found.items()})


def repeated_spans(docs: DataFrame) -> DataFrame:
    """(doc_id, t, first, end): the words of each row (t: hash of its text) that occur in smaller documents."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "phrases")
    rows = docs.select(F.col("doc_id").cast("long"), F.xxhash64(F.col("text").cast("string")).alias("t"),
                       F.col("text").cast("string")).filter("doc_id IS NOT NULL AND text IS NOT NULL")
    anchors = anchor_rows(rows)
    seen, seen_path = scratch.write(anchors.groupBy("h").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
                                    .select(F.col("h").alias("k")))
    release(spark)
    hits, hits_path = scratch.write(anchors.join(seen, F.col("h") == F.col("k")).select("doc_id", "t", "h"))
    release(spark)
    per_row = hits.groupBy(F.col("doc_id").alias("d"), F.col("t").alias("u")).agg(F.collect_set("h").alias("hs"))
    segments, _ = scratch.write(segment_rows(
        rows.join(per_row, (F.col("doc_id") == F.col("d")) & (F.col("t") == F.col("u")))
        .select("doc_id", "t", "text", "hs")), codec="zstd")
    scratch.drop(seen_path)
    scratch.drop(hits_path)
    release(spark)
    windows = window_rows(segments)
    owned, _ = scratch.write(windows.groupBy("w").agg(F.min("doc_id").alias("owner"), F.max("doc_id").alias("z"))
                             .filter("owner < z").select(F.col("w").alias("k"), "owner"))
    release(spark)
    per_owner = owned.groupBy("owner").agg(F.collect_list("k").alias("ws"))
    passages, _ = scratch.write(passage_rows(
        segments.join(per_owner, F.col("doc_id") == F.col("owner")).select("doc_id", "text", "ws")), codec="zstd")
    release(spark)
    shards = 1 + (passages.agg(F.sum("n")).first()[0] or 0) // SHARD_WORDS
    shard = F.pmod(F.xxhash64("owner"), F.lit(shards)).alias("shard")
    routes, _ = scratch.write(windows.join(owned, F.col("w") == F.col("k")).filter("owner < doc_id")
                              .select(F.col("doc_id").alias("d"), shard).distinct())
    release(spark)
    sent, _ = scratch.write(segments.join(routes, F.col("doc_id") == F.col("d")).drop("d"), codec="zstd")
    release(spark)
    copies = sent.groupBy("shard").agg((1 + F.sum(F.octet_length("text")) / TASK_BYTES).cast("long").alias("copies"))
    left = passages.withColumn("shard", shard).join(copies, "shard") \
        .withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)))
    right = sent.join(copies, "shard").withColumn("copy", F.pmod(F.xxhash64("doc_id", "t", "start"), F.col("copies")))
    return left.select("shard", "copy", "owner", "passage").groupBy("shard", "copy") \
        .cogroup(right.select("shard", "copy", "doc_id", "t", "start", "text").groupBy("shard", "copy")) \
        .applyInArrow(_occurrences, "doc_id long, t long, first long, end long")


def remove_repeats(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed and the kept text (words joined by a space) of every row."""
    spans = repeated_spans(docs).groupBy(F.col("doc_id").alias("d"), F.col("t").alias("u")) \
        .agg(F.collect_set(F.struct("first", "end")).alias("s"))
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")) \
        .withColumn("t", F.xxhash64("text"))
    rows = rows.join(spans, (F.col("doc_id") == F.col("d")) & (F.col("t") == F.col("u")), "left") \
        .select("doc_id", "text", F.col("s.first").alias("first"), F.col("s.end").alias("end"))

    def run(batch: pa.RecordBatch) -> list:
        n_words, n_removed, kept = [], [], []
        for raw, first, end in zip(raw_texts(batch.column(1)), batch.column(2).to_pylist(),
                                   batch.column(3).to_pylist()):
            w = raw.split()
            rest = w
            if first:
                keep = np.ones(len(w), bool)
                for x, y in zip(first, end):
                    keep[x:y] = False
                rest = [w[i] for i in np.flatnonzero(keep).tolist()]
            n_words.append(len(w))
            n_removed.append(len(w) - len(rest))
            kept.append(b" ".join(rest).decode())
        return [batch.column(0), n_words, n_removed, kept]

    return arrow_map(rows, run, "doc_id long, n_words long, n_removed long, kept string")


def op9_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = remove_repeats(documents(spark, sf_dir))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))
