"""Alignment of two tokenizers' tokens by pointer jumping, and corpus-wide counts of aligned pairs.

Tokenizer A (byte-level BPE) reads a space and the text, tokenizer B (pieces) the text, before which it puts a space
itself; the bytes of their tokens are the same string, cut differently. Tokens that overlap belong together. Every
token points to its farthest-right overlapping token: the one of the other tokenizer that holds its last byte, or, if
both end there, the A token. Replacing every pointer by its target's, all at once, doubles the steps that it stands
for; after a logarithm of the longest chain all point to their component's terminal token, which labels the group.
Where a group ends an A and a B token end together: this pair is a link.

Both tokenizers work on words: neither has tokens over a single space between two characters that are no white space.
So texts are split at spaces, words met before are remembered with both tokenizers' ids (up to a bound), and only new
ones are encoded. Texts with other white space at a word's end, or words that do not come back as their own bytes, are
encoded whole.

The texts of a batch of about half a megabyte are one array. A batch becomes one row of a written table: its documents'
numbers, its links as numbers of the batch's different pairs, and these pairs with their counts. So what is shuffled to
count pairs over the corpus, and back, is a row for each pair and batch, not for each link; a pair that every document
has is one row a batch.

Defined results: null and empty texts, and texts whose tokens' joined bytes differ from space and text, have no
tokens: all numbers are 0 and the groups are empty; a very long text is given to the tokenizers in pieces of about ``PIECE``
characters, cut at spaces that no token goes on over (if the piece vocabulary has such tokens, whole); strings of special tokens are ordinary text; repeated rows count again; ties for a B token's highest count are all
best; an empty table gives no rows; other columns, whatever their names, are ignored.
"""

from __future__ import annotations

import hashlib
import json
import os
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from dataprism.llm.byte_bpe import pieces_at_spaces
from dataprism.llm.common import Scratch, arrow_map, documents, int_lists, ship_package

PIECE = 1 << 18
SLICE_BYTES = 1 << 19
MEMO_BYTES = 16 << 20
TOGETHER = 100  # words encoded as one text
LONGEST = 64  # characters of a remembered word
MARK = "▁"


def default_files() -> tuple[str, bytes, str]:
    """The installed byte-level tokenizer (JSON) and piece model, and the pattern by which the first splits texts."""
    import public_tokenizers

    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as a, \
            open(public_tokenizers.path("piece_bpe_32k.model"), "rb") as b:
        return a.read(), b.read(), public_tokenizers.PATTERN


def jump(succ: np.ndarray) -> np.ndarray:
    """The end of every chain of pointers, by doubling."""
    while True:
        further = succ[succ]
        if np.array_equal(further, succ):
            return succ
        succ = further


class Alignment:
    """Tokens of several texts, one after the other: ids and ends of A and B, their groups, and the links."""

    def __init__(self, a: np.ndarray, b: np.ndarray, a_end: np.ndarray, b_end: np.ndarray) -> None:
        self.a, self.b = a, b
        n = len(a)
        over = np.searchsorted(b_end, a_end, "left")  # the B token that holds the A token's last byte
        self.last_a = b_end[over] == a_end if n else np.empty(0, bool)
        succ = np.concatenate([np.where(self.last_a, np.arange(n), n + over), np.searchsorted(a_end, b_end, "left")])
        number = np.cumsum(self.last_a) - 1
        group = number[jump(succ)]
        self.a_group, self.b_group = group[:n], group[n:]
        self.last_b = np.append(self.b_group[1:] != self.b_group[:-1], [True] * bool(len(b)))
        # The last A and the last B token of each group end together.
        self.links = a[self.last_a].astype(np.int64) << 32 | b[self.last_b]


class Aligner:
    def __init__(self, a_json: str, b_model: bytes, pattern: str = "") -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallel unit
        import sentencepiece
        from tokenizers import Tokenizer

        spec = json.loads(a_json)
        first = spec.get("pre_tokenizer") or {}
        plain = first.get("type") == "ByteLevel" and first.get("use_regex", True) and not first.get("add_prefix_space")
        plain = plain and not spec.get("normalizer") and all(x["special"] for x in spec.get("added_tokens") or [])
        self.a = Tokenizer.from_str(a_json)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_proto=b_model)
        # The byte-level alphabet: printable bytes stand for themselves, the others for 256 and up.
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        byte_of = {chr(x): x for x in shown}
        byte_of |= {chr(256 + i): x for i, x in enumerate(x for x in range(256) if x not in set(shown))}
        vocabulary = self.a.get_vocab(with_added_tokens=True)
        self.a_bytes = [b""] * (1 + max(vocabulary.values()))
        for token, i in vocabulary.items():
            self.a_bytes[i] = bytes(byte_of[c] for c in token) if all(c in byte_of for c in token) else token.encode()
        pieces = [self.b.id_to_piece(i) for i in range(len(self.b))]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(MARK, " ").encode()
                        for i, p in enumerate(pieces)]
        self.cut = not any(MARK in p.lstrip(MARK) for p in pieces)
        self.by_words = bool(pattern) and plain and self.cut
        self.known: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.size = 0
        self.a_size, self.b_size = (np.array([len(x) for x in t], np.int64) for t in (self.a_bytes, self.b_bytes))
        self.a_space, self.b_space = (np.array([x[:1] == b" " for x in t]) for t in (self.a_bytes, self.b_bytes))
        self.a_text, self.b_text = (
            [np.array([b"%d%s" % (i, end) for i in range(len(t))], object) for end in (b",", mark)]
            for t, mark in ((self.a_bytes, b"|"), (self.b_bytes, b";")))

    def _learn(self, words: list[str]) -> None:
        """Remember the ids of words without spaces, A's and then the complements of B's, as both tokenizers give them
        after a space. Neither's tokens go on over a space between two characters that are no white space, so words are
        encoded some as one text and cut at the tokens that begin with a space. Words that have no such ids (white space
        at an end, other bytes than their own) are remembered as nothing."""
        whole = " ".join(words)
        some = [" ".join(words[at:at + TOGETHER]) for at in range(0, len(words), TOGETHER)]
        a = self.a.encode_batch_fast([" " + x for x in some], add_special_tokens=False)
        a = np.concatenate([np.array(x.ids, np.int32) for x in a])
        b = np.array(list(chain.from_iterable(self.b.encode(some, num_threads=1))), np.int32)
        raw = (" " + whole).encode()
        a_word, b_word = np.cumsum(self.a_space[a]), np.cumsum(self.b_space[b])
        # As many tokens that begin with a space as there are spaces: each has one, the others none.
        if not (len(a) and len(b) and a_word[-1] == b_word[-1] == len(words)
                and b"".join(map(self.a_bytes.__getitem__, a.tolist())) == raw
                and b"".join(map(self.b_bytes.__getitem__, b.tolist())) == raw):
            if len(words) == 1:
                self.known[words[0]] = b""
                return
            for part in (words[:len(words) // 2], words[len(words) // 2:]):
                self._learn(part)
            return
        out = np.empty(len(a) + len(b), np.int32)
        out[np.arange(len(a)) + np.searchsorted(b_word, a_word, "left")] = a
        out[np.arange(len(b)) + np.searchsorted(a_word, b_word, "right")] = ~b
        ends = 4 * np.cumsum(np.bincount(a_word, minlength=len(words) + 1)
                             + np.bincount(b_word, minlength=len(words) + 1))
        packed, ends = out.tobytes(), ends.tolist()
        self.known.update((w, packed[lo:hi]) for w, lo, hi in zip(words, ends, ends[1:]))

    def _recall(self, texts: list[list[str]]) -> list[list[bytes]]:
        """The remembered ids of the words of each text; new words go to the tokenizers. When half of ``MEMO_BYTES``
        is full, words that were not met since the last time are forgotten."""
        if self.size > MEMO_BYTES // 2:
            self.known, self.old, self.size = {}, self.known, 0
        known, old = self.known, self.old
        new = set().union(*texts).difference(known)
        again = new.intersection(old)
        known.update((w, old[w]) for w in again)
        whole = new.intersection(map(str.strip, new))
        known.update(dict.fromkeys(new - whole | {""}, b""))
        words = list(whole - again - {""})
        if words:
            self._learn(words)
        out = [list(map(known.__getitem__, ws)) for ws in texts]
        for w in [w for w in new if len(w) > LONGEST]:
            del known[w]
            new.remove(w)
        self.size += 160 * len(new) + sum(2 * len(w) + len(known[w]) for w in new)
        return out

    def _encode(self, parts: list[tuple[str, str]]) -> Iterator[tuple[np.ndarray, np.ndarray, bool]]:
        """A's and B's ids of each text (given as A and as B reads it), and whether they surely are the text's bytes."""
        found = self._recall([y.split(" ") for _, y in parts]) if self.by_words else [[b""]] * len(parts)
        for (x, y), ids in zip(parts, found):
            if all(ids):
                flat = np.frombuffer(b"".join(ids), np.int32)
                yield flat[flat >= 0], ~flat[flat < 0], True
            else:
                yield (np.array(self.a.encode(x, add_special_tokens=False).ids, np.int32),
                       np.array(self.b.encode(y), np.int32), False)

    def _ids(self, texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray, bool]]:
        """A's and B's ids of each text, and whether they surely are the text's bytes. The tokenizers get about
        ``PIECE`` characters at a time, so what they return (some hundred bytes a token) stays small; long texts go
        through in pieces."""
        parts: list[tuple[bool, str, str]] = []
        size = 0
        held: tuple[list, list, list] = ([], [], [])
        for i, t in enumerate(texts):
            pieces = list(pieces_at_spaces(t, PIECE)) if self.cut and len(t) > PIECE else [t]
            for k, x in enumerate(pieces):
                # A piece after the first begins with a space, which B puts there itself.
                parts.append((k == len(pieces) - 1, x if k else " " + x, x[1:] if k else x))
                size += len(x)
                if size >= PIECE or (i == len(texts) - 1 and k == len(pieces) - 1):
                    for (last, *_), out in zip(parts, self._encode([(x, y) for _, x, y in parts])):
                        for h, v in zip(held, out):
                            h.append(v)
                        if last:
                            yield np.concatenate(held[0]), np.concatenate(held[1]), all(held[2])
                            held = ([], [], [])
                    parts, size = [], 0

    def align(self, texts: list[str | None]) -> tuple[Alignment, np.ndarray, np.ndarray]:
        """The alignment of all texts, and how many A and B tokens each has."""
        some = [i for i, t in enumerate(texts) if t]
        n_a, n_b = np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64)
        a, b = [np.empty(0, np.int32)], [np.empty(0, np.int32)]
        a_bytes, b_bytes = self.a_bytes.__getitem__, self.b_bytes.__getitem__
        for i, (x, y, sure) in zip(some, self._ids([texts[i] for i in some])):
            raw = b"" if sure else b" " + texts[i].encode()
            if sure or b"".join(map(a_bytes, x.tolist())) == raw and b"".join(map(b_bytes, y.tolist())) == raw:
                a.append(x)
                b.append(y)
                n_a[i], n_b[i] = len(x), len(y)
        flat_a, flat_b = np.concatenate(a), np.concatenate(b)
        return Alignment(flat_a, flat_b, np.cumsum(self.a_size[flat_a]), np.cumsum(self.b_size[flat_b])), n_a, n_b

    def texts(self, x: Alignment, n_a: np.ndarray, n_b: np.ndarray) -> Iterator[bytes]:
        """The groups of each text: A's ids, a bar, B's ids; groups divided by semicolons."""
        a_end, b_end = np.cumsum(n_a).tolist(), np.cumsum(n_b).tolist()
        at = 0
        while at < len(n_a):  # texts of about PIECE tokens at a time
            end = at + 1
            a0, b0 = (a_end[at - 1], b_end[at - 1]) if at else (0, 0)
            while end < len(n_a) and a_end[end] - a0 <= PIECE:
                end += 1
            yield from self._texts(x, slice(a0, a_end[end - 1]), slice(b0, b_end[end - 1]), n_a[at:end] + n_b[at:end])
            at = end

    def _texts(self, x: Alignment, a: slice, b: slice, n: np.ndarray) -> Iterator[bytes]:
        a_group, b_group = x.a_group[a], x.b_group[b]
        out = np.empty(len(a_group) + len(b_group), object)
        ids, last = x.a[a], x.last_a[a]
        out[np.arange(len(ids)) + np.searchsorted(b_group, a_group, "left")] = np.where(
            last, self.a_text[1][ids], self.a_text[0][ids])
        ids, last = x.b[b], x.last_b[b]
        out[np.arange(len(ids)) + np.searchsorted(a_group, b_group, "right")] = np.where(
            last, self.b_text[1][ids], self.b_text[0][ids])
        ends = np.cumsum(n)
        for lo, hi in zip((ends - n).tolist(), ends.tolist()):
            yield b"".join(out[lo:hi].tolist())[:-1]


_BUILT: dict[str, Aligner] = {}


def _aligner(shared, name: str) -> Aligner:
    if name not in _BUILT:
        _BUILT.clear()
        _BUILT[name] = Aligner(*shared.value)
    return _BUILT[name]


def _share(df: DataFrame, files: tuple[str, bytes, str]):
    """The tokenizers' files as a broadcast; their size is fixed and does not follow the data."""
    shared = df.sparkSession.sparkContext.broadcast(files)
    return shared, f"{id(shared)}-{len(files[0])}"


def align_texts(docs: DataFrame, files: tuple[str, bytes, str]) -> DataFrame:
    """doc_id, a_ids and b_ids of every row, and a_groups and b_groups: the number of each token's group, from 0."""
    shared, name = _share(docs, files)

    def run(batch: pa.RecordBatch) -> list:
        x, n_a, n_b = _aligner(shared, name).align(batch.column(1).to_pylist())
        a_at, b_at = np.cumsum(n_a) - n_a, np.cumsum(n_b) - n_b
        first = x.a_group[np.minimum(a_at, max(0, len(x.a) - 1))] if len(x.a) else np.zeros(len(n_a), np.int64)
        out = []
        for ids, at, n in ((x.a, a_at, n_a), (x.b, b_at, n_b), (x.a_group - np.repeat(first, n_a), a_at, n_a),
                           (x.b_group - np.repeat(first, n_b), b_at, n_b)):
            out.append(int_lists([ids[i:i + k].astype(np.int32).tobytes() for i, k in zip(at.tolist(), n.tolist())]))
        return [batch.column(0), *out]

    return arrow_map(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), run,
                     "doc_id long, a_ids array<int>, b_ids array<int>, a_groups array<int>, b_groups array<int>",
                     rows=500)


_BATCH = ("batch long, doc_id array<long>, n_a array<long>, n_b array<long>, n_links array<long>, "
          "groups_sha256 array<string>, links binary, pairs array<long>, counts array<long>")


def _batches(docs: DataFrame, files: tuple[str, bytes, str]) -> DataFrame:
    """One row for each batch of documents (about ``SLICE_BYTES`` of text, so that no row is large in a worker or the
    JVM); ``links`` are numbers of ``pairs``, which are in order."""
    shared, name = _share(docs, files)
    ship_package(docs.sparkSession)
    schema = T.StructType.fromDDL(_BATCH)
    kinds = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            if not batch.num_rows:
                continue
            aligner = _aligner(shared, name)
            sizes = batch.column(1).cast(pa.binary())
            sizes = np.cumsum(np.nan_to_num(pc.binary_length(sizes).to_numpy(zero_copy_only=False)))
            at = 0
            while at < batch.num_rows:  # texts of about SLICE_BYTES at a time
                before = sizes[at - 1] if at else 0
                end = max(at + 1, int(np.searchsorted(sizes, before + SLICE_BYTES, "right")))
                x, n_a, n_b = aligner.align(batch.column(1).slice(at, end - at).to_pylist())
                hashes = [hashlib.sha256(g).hexdigest() if g else "" for g in aligner.texts(x, n_a, n_b)]
                ends = np.concatenate([[0], np.cumsum(x.last_a)])
                n_links = ends[np.cumsum(n_a)] - ends[np.cumsum(n_a) - n_a]
                pairs, links, counts = np.unique(x.links, return_inverse=True, return_counts=True)
                row = [[number], [batch.column(0).slice(at, end - at).to_pylist()], [n_a], [n_b], [n_links], [hashes],
                       [links.astype(np.int32).tobytes()], [pairs], [counts]]
                yield pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(row, kinds)], schema=kinds)
                number += 1
                at = end
            pa.default_memory_pool().release_unused()

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, schema)


def link_scores(docs: DataFrame, files: tuple[str, bytes, str]) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best (links whose pair is the most frequent of its B token), count_sum
    (sum of the links' pair counts over the corpus) and groups_sha256 of every row."""
    scratch = Scratch(docs.sparkSession, "alignment")
    table, _ = scratch.write(_batches(docs, files))
    pairs = table.select("batch", F.explode(F.arrays_zip("pairs", "counts")).alias("p")) \
        .select("batch", F.col("p.pairs").alias("pair"), F.col("p.counts").alias("n"))
    counts = pairs.groupBy("pair").agg(F.sum("n").alias("count"))
    # A B token has at most as many pairs as A has tokens.
    top = F.max("count").over(Window.partitionBy(F.col("pair").bitwiseAND(F.lit(0xFFFFFFFF))))
    known, _ = scratch.write(counts.select("pair", "count", (F.col("count") == top).alias("best")))
    back = pairs.select("batch", "pair").join(known, "pair").groupBy("batch").agg(
        F.array_sort(F.collect_list(F.struct("pair", "count", "best"))).alias("known"))
    rows = table.drop("pairs", "counts").join(back, "batch", "left").select(
        "doc_id", "n_a", "n_b", "n_links", "groups_sha256", "links",
        F.col("known.count").alias("count"), F.col("known.best").alias("best"))

    def run(batch: pa.RecordBatch) -> list:
        out: list[list] = [[] for _ in range(8)]
        for i in range(batch.num_rows):
            doc_id, n_a, n_b, n_links, sha, links, count, best = (c[i] for c in batch.columns)
            n = np.array(n_links.as_py(), np.int64)
            at = np.frombuffer(links.as_py(), np.int32)
            sums = []
            for values in (best, count):
                v = np.array(values.as_py() or [], np.int64)[at]
                total = np.concatenate([[0], np.cumsum(v)])
                sums.append(total[np.cumsum(n)] - total[np.cumsum(n) - n])
            for o, v in zip(out, (doc_id.as_py(), n_a.as_py(), n_b.as_py(), n.tolist(), n.tolist(), *sums, sha.as_py())):
                o.extend(v)
        return out

    return arrow_map(rows, run, "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, "
                                "count_sum long, groups_sha256 string", rows=4)


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link_scores(documents(spark, sf_dir), default_files())
