"""SentencePiece encoding by an Aho-Corasick automaton and a single-pass Viterbi, and decoding.

The automaton holds all ordinary pieces of the vocabulary. One walk over a text visits every end position in order;
the output links there name all pieces that end at it, and each relaxes the best score of that position from the best
score where the piece starts. A character without a piece of its own is an unknown of the lowest score less 10 and is
written as byte pieces. The result is the segmentation with the largest sum of piece scores (ties: longer last piece).
No piece has the space mark after another character, so the best segmentation of a text is that of its chunks (space
marks and what follows them) one after the other, and each worker remembers the chunks it has met, up to a bound.

Spaces are written as U+2581 and one is put in front of a text that isn't empty; decoding undoes both, so a text comes
back unchanged but for U+2581 itself, which comes back as a space.

Defined results: a null or empty text has no pieces; a very long text is encoded whole, chunk after chunk, and a chunk
without spaces in parts cut where no piece crosses (16 bytes a character of the longest part); repeated rows get equal pieces; an empty table gives no rows;
other columns are ignored.
"""

from __future__ import annotations

import math
import re
import struct
from array import array
from itertools import chain, pairwise

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dataprism.llm.common import Memo, arrow_map, documents, int_lists

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
UNKNOWN_PENALTY = 10.0
PIECE_OF_CHUNK = 1 << 16
MEMO_BYTES = 96 << 20


def read_pieces(path: str = MODEL, ranks: bool = True) -> list[tuple[str, float, int]]:
    """(piece, score, kind) in order of id; kind 0 is an ordinary piece, 1 a byte, 2 a control or unknown.

    ``ranks``: the file's scores are negative ranks (a model of merges), which don't add up over a text; a piece of
    rank r gets the score -ln(r + 2), its logarithmic frequency by Zipf's law. Else the scores are taken as they are.
    """
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    score = (lambda i: -math.log(2 - sp.get_score(i))) if ranks else sp.get_score
    return [(sp.id_to_piece(i), score(i), 1 if sp.is_byte(i) else 2 if sp.is_control(i) or sp.is_unknown(i) else 0)
            for i in range(len(sp))]


class Encoder:
    def __init__(self, pieces: list[tuple[str, float, int]]) -> None:
        import ahocorasick

        self.automaton = ahocorasick.Automaton()
        self.bytes: dict[int, int] = {}
        self.single = set()
        self.table: list[bytes] = []
        self.splits = True
        for i, (piece, score, kind) in enumerate(pieces):
            if kind == 0:
                self.automaton.add_word(piece, (i, len(piece), score))
                self.splits &= MARK not in piece.lstrip(MARK)
                if len(piece) == 1:
                    self.single.add(piece)
            elif kind == 1:
                self.bytes[int(piece[1:-1], 16)] = i
            self.table.append(piece.replace(MARK, " ").encode() if kind == 0
                              else bytes([int(piece[1:-1], 16)]) if kind == 1 else b"")
        if len(self.bytes) != 256:
            raise ValueError("the vocabulary needs all 256 byte pieces")
        self.automaton.make_automaton()
        self.unknown = min(score for _, score, kind in pieces if kind == 0) - UNKNOWN_PENALTY
        self.longest = max((len(p) for p, _, kind in pieces if kind == 0), default=1)
        self.memo = Memo(self._packed, MEMO_BYTES)
        # A character that is in no piece is always a segment of its own; the usual ones are cut off at once.
        alone = "".join(c for c in "\n\t\r" if not any(c in p for p, _, kind in pieces if kind == 0))
        self.chunks = re.compile(f"{MARK}*[^{MARK}{alone}]+|{MARK}+" + (f"|[{alone}]" if alone else ""))

    def cuts(self, chunk: str) -> list[int]:
        """Places, about ``PIECE_OF_CHUNK`` apart, that no piece crosses: the best segmentations of the parts, one
        after the other, are that of the chunk. A stretch without such a place is one part."""
        out, at, reach = [], PIECE_OF_CHUNK, self.longest
        while at < len(chunk):
            begin = max(0, at - 2 * reach)
            window = chunk[begin:at + 2 * reach]
            crossed = bytearray(len(window) + 1)
            for last, (_, size, _) in self.automaton.iter(window):
                crossed[last + 2 - size:last + 1] = b"\1" * (size - 1)
            # Matches that cross a place in the middle of the window lie in the window.
            free = crossed.find(0, reach, min(3 * reach, len(window)))
            if free >= 0:
                out.append(begin + free)
                at = out[-1] + PIECE_OF_CHUNK
            else:
                at += reach
        return out

    def best(self, chunk: str) -> list[int]:
        """The ids of the best segmentation of ``chunk``."""
        if len(chunk) > PIECE_OF_CHUNK:
            ids: list[int] = []
            for a, b in pairwise([0, *self.cuts(chunk), len(chunk)]):
                ids.extend(self._best(chunk[a:b]))
            return ids
        return self._best(chunk)

    def _best(self, chunk: str) -> list[int]:
        n = len(chunk)
        score = array("d", [0.0]) + array("d", [-math.inf]) * n
        size_of, id_of = array("i", bytes(4 * (n + 1))), array("i", bytes(4 * (n + 1)))
        if self.single.issuperset(chunk):  # no unknown character: pieces alone
            for last, (i, size, piece_score) in self.automaton.iter(chunk):
                end = last + 1
                s = score[end - size] + piece_score
                if s > score[end]:
                    score[end], size_of[end], id_of[end] = s, size, i
        else:
            done = 0  # positions up to here have their final score
            for last, (i, size, piece_score) in chain(self.automaton.iter(chunk), [(n, (-1, 0, 0.0))]):
                while done < last:
                    if chunk[done] not in self.single and (s := score[done] + self.unknown) > score[done + 1]:
                        score[done + 1], size_of[done + 1], id_of[done + 1] = s, 1, -1
                    done += 1
                if i >= 0 and (s := score[last + 1 - size] + piece_score) > score[last + 1]:
                    score[last + 1], size_of[last + 1], id_of[last + 1] = s, size, i
        ids: list[int] = []
        while n:
            start, i = n - size_of[n], id_of[n]
            if i >= 0:
                ids.append(i)
            else:
                ids.extend(self.bytes[b] for b in reversed(chunk[start:n].encode()))
            n = start
        return ids[::-1]

    def _packed(self, chunk: str) -> bytes:
        ids = self.best(chunk)
        return struct.pack(f"<{len(ids)}i", *ids)

    def encode(self, text: str) -> bytes:
        """The ids of a text's pieces, packed as 32-bit numbers."""
        if not text:
            return b""
        marked = MARK + text.replace(" ", MARK)
        chunks = self.chunks.findall(marked) if self.splits else [marked]
        memo = self.memo
        return b"".join([memo.new.get(c) or memo(c) for c in chunks])

    def decode(self, ids: list[int]) -> str:
        """The text of a list of ids."""
        raw = b"".join(map(self.table.__getitem__, ids))
        return raw[1:].decode() if raw.startswith(b" ") else raw.decode()


_BUILT: dict[str, Encoder] = {}


def _encoder(shared, name: str) -> Encoder:
    if name not in _BUILT:
        _BUILT.clear()
        _BUILT[name] = Encoder(shared.value)
    return _BUILT[name]


def _share(df: DataFrame, pieces: list[tuple[str, float, int]]):
    shared = df.sparkSession.sparkContext.broadcast(pieces)
    return shared, f"{id(shared)}-{len(pieces)}"


def encode_texts(docs: DataFrame, pieces: list[tuple[str, float, int]]) -> DataFrame:
    """doc_id, ids, n_pieces and round_trip (decoding the ids gives the text) of every row; one pass, no shuffle.
    The vocabulary is broadcast: its size is fixed and does not follow the data."""
    shared, name = _share(docs, pieces)

    def encode(batch: pa.RecordBatch) -> list:
        enc = _encoder(shared, name)
        packed, same = [], []
        for text in batch.column(1).to_pylist():
            text = text or ""
            ids = enc.encode(text)
            packed.append(ids)
            same.append(enc.decode(memoryview(ids).cast("i").tolist()) == text.replace(MARK, " "))
        return [batch.column(0), int_lists(packed), [len(p) // 4 for p in packed], same]

    return arrow_map(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), encode,
                     "doc_id long, ids array<int>, n_pieces long, round_trip boolean", rows=500)


def decode_texts(encoded: DataFrame, pieces: list[tuple[str, float, int]]) -> DataFrame:
    """doc_id and the text of ``ids``; a null list is an empty text."""
    shared, name = _share(encoded, pieces)

    def decode(batch: pa.RecordBatch) -> list:
        enc = _encoder(shared, name)
        return [batch.column(0), [enc.decode(x or []) for x in batch.column(1).to_pylist()]]

    return arrow_map(encoded.select(F.col("doc_id").cast("long"), F.col("ids").cast("array<int>")), decode,
                     "doc_id long, text string", rows=500)


def op7_sentencepiece(spark: SparkSession, sf_dir: str, model: str = MODEL) -> DataFrame:
    return encode_texts(documents(spark, sf_dir), read_pieces(model))


def encode_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: the pieces of every document."""
    return encode_texts(docs, read_pieces())
