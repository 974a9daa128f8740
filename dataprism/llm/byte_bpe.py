"""Byte-level BPE encoding and decoding by recursive DuckDB queries, one in-process database a Python worker.

A text is split by the pattern, and each word that the worker has not met before becomes rows (word, position, token),
one for each byte. A recursive query contracts them: token rows next to each other are joined with the merge table, a
word's pair of the lowest rank, leftmost first, becomes one token, and words without such a pair leave the recursion;
the fixpoint is a word's encoding. In long words all pairs of the lowest rank, leftmost first and not overlapping, are
contracted in one round, which is the same: the token made is part of no pair of its rank or lower (where the
vocabulary has such a pair, the leftmost goes alone). Decoding joins token rows with the vocabulary and aggregates the bytes in order.

The merge table holds every pair of tokens whose bytes together are a token, with that token's rank, so the result is
that of merging by rank of the concatenation. A word that is a token is that token. Words are cut in advance between
two bytes that follow each other in no token, since no merge can cross such a place.

Memory: DuckDB runs on one thread without a temporary folder. A recursion keeps all its rounds, so it gets at most
``GROUP_ROWS`` rows (or one longer word) and stops when its rounds have ``ROUND_ROWS`` rows; words not at their
fixpoint then go on from their last round. Texts are split in pieces of about ``PIECE`` characters at spaces that no
match crosses. The words a worker remembers are bounded in bytes.

Defined results: a null or empty text has no ids and decodes to no bytes; a very long text is encoded whole, piece by
piece, a very long word in as many rounds as it has different ranks; strings of special tokens are ordinary text;
repeated rows get equal results; an empty table gives no rows; other columns, whatever their names, are ignored. A
null list of ids decodes to no bytes, an id that is not in the vocabulary fails.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dataprism.llm.common import arrow_map, documents, int_lists

GROUP_ROWS = 400_000
ROUND_ROWS = 8_000_000
LONG_WORD = 64  # bytes, from which on all pairs of the lowest rank are contracted in one round
MEMO_BYTES = 64 << 20
PIECE = 1 << 20

# Positions rise from word to word, so one order by position serves all words of a query.
_ROUNDS = """
WITH RECURSIVE state(round, w, p, t) AS (
  SELECT 0, w, p, t FROM start
  UNION ALL
  SELECT * FROM (
    WITH pairs AS (
      SELECT w, p, t, lead(t) OVER line AS nt, lead(p) OVER line AS np, lead(w) OVER line AS nw,
             row_number() OVER line AS k
      FROM state WINDOW line AS (ORDER BY p)),
    {contract} AND s.round < {rounds}))
SELECT w, p, t, round FROM state QUALIFY round = max(round) OVER (PARTITION BY w) ORDER BY p
"""

# The leftmost pair of the lowest rank of each word.
_LEFTMOST = """
    best AS (
      SELECT w, min(rank::BIGINT << 32 | p) AS first, arg_min(np, rank::BIGINT << 32 | p) AS gone
      FROM pairs JOIN merges ON t = l AND nt = r AND nw = w GROUP BY w)
    SELECT s.round + 1, s.w, s.p, CASE WHEN s.p = (first & 4294967295) THEN (first >> 32)::INTEGER ELSE s.t END
    FROM state s JOIN best ON s.w = best.w WHERE s.p <> gone
"""

# All pairs of the lowest rank of each word, of overlapping ones every other; only the leftmost where the token made
# could be part of a pair of lower rank.
_EVERY = """
    ranked AS (
      SELECT w, p, np, k, rank, alone FROM pairs JOIN merges ON t = l AND nt = r AND nw = w),
    best AS (
      SELECT w, min(rank) AS rank FROM ranked GROUP BY w),
    hits AS (
      SELECT w, p, np, rank, alone, k - row_number() OVER (ORDER BY p) AS island FROM ranked JOIN best USING (w, rank)),
    chosen AS (
      SELECT w, p, np, rank FROM hits
      QUALIFY CASE WHEN alone THEN p = min(p) OVER (PARTITION BY w)
                   ELSE row_number() OVER (PARTITION BY w, island ORDER BY p) % 2 = 1 END)
    SELECT s.round + 1, s.w, s.p, coalesce(c.rank, s.t)
    FROM state s JOIN best ON s.w = best.w LEFT JOIN chosen c ON s.p = c.p LEFT JOIN chosen gone ON s.p = gone.np
    WHERE gone.w IS NULL
"""

_DECODE = """
SELECT d, unhex(string_agg(piece, '' ORDER BY p)) AS bytes FROM tokens JOIN vocabulary USING (t) GROUP BY d ORDER BY d
"""


def default_vocabulary() -> tuple[list[bytes], str]:
    """The tokens in order of rank, and the pattern, of the installed byte-level vocabulary."""
    import public_tokenizers

    return read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken")), public_tokenizers.PATTERN


def read_ranks(path: str) -> list[bytes]:
    """The tokens of a rank file (base64 token and rank in each line), in order of rank."""
    with open(path, "rb") as f:
        rows = [line.split() for line in f if line.strip()]
    out: list[bytes] = [b""] * (1 + max((int(r) for _, r in rows), default=-1))
    for token, rank in rows:
        out[int(rank)] = base64.b64decode(token)
    return out


def pieces_at_spaces(text: str, size: int) -> Iterator[str]:
    """``text`` in pieces of about ``size`` characters, cut before a space that follows a character which is no white
    space: no match of the usual patterns goes on over such a place."""
    at = 0
    while len(text) - at > size:
        found = _CUT.search(text, at + size)
        if not found:
            break
        yield text[at:found.end()]
        at = found.end()
    yield text[at:]


_CUT = re.compile(r"\S(?= )")


class Codec:
    """Encodes and decodes by ``ranks`` (tokens in order of rank; an empty one is no token) and ``pattern``."""

    def __init__(self, ranks: list[bytes], pattern: str) -> None:
        import duckdb
        import regex

        self.rank = {token: i for i, token in enumerate(ranks) if token}
        if any(bytes([b]) not in self.rank for b in range(256)):
            raise ValueError("the vocabulary needs all 256 bytes")
        self.split = regex.compile(pattern).findall
        self.byte_rank = np.array([self.rank[bytes([b])] for b in range(256)], np.int32)
        rows = [(self.rank[a], self.rank[b], i) for token, i in self.rank.items() for at in range(1, len(token))
                if (a := token[:at]) in self.rank and (b := token[at:]) in self.rank]
        merges = np.array(rows, np.int32).reshape(-1, 3)
        # Tokens that are part of a token of a lower rank.
        alone = np.zeros(len(ranks), bool)
        for side in (0, 1):
            alone[merges[merges[:, 2] < merges[:, side], side]] = True
        inside = np.zeros(1 << 16, bool)
        for token in self.rank:
            for x, y in zip(token, token[1:]):
                inside[x << 8 | y] = True
        self.inside = inside
        self.valid = np.array([bool(token) for token in ranks])
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.size = 0
        self.db = duckdb.connect(":memory:", config={"threads": 1, "memory_limit": "1GB", "temp_directory": ""})
        self._table("merges", l=merges[:, 0], r=merges[:, 1], rank=merges[:, 2], alone=alone[merges[:, 2]])
        self._table("vocabulary", t=np.array(list(self.rank.values()), np.int32),
                    piece=[token.hex() for token in self.rank])

    def _table(self, name: str, **columns) -> None:
        self.db.register("given", pa.table(columns))
        self.db.execute(f"CREATE TABLE {name} AS SELECT * FROM given")
        self.db.unregister("given")

    def _learn(self, words: list[str]) -> None:
        """Put words that ``known`` doesn't have into it."""
        rest = []
        for w in words:
            if (ids := self.older.get(w)) is not None:
                self.known[w] = ids
            elif (i := self.rank.get(x := w.encode())) is not None:
                self.known[w] = i.to_bytes(4, "little")
            else:
                rest.append((w, x))
        for long in (False, True):
            group: list[tuple[str, bytes]] = []
            rows = 0
            for pair in rest:
                if (len(pair[1]) > LONG_WORD) != long:
                    continue
                if group and rows + len(pair[1]) > GROUP_ROWS:
                    self._learn_group(group, long)
                    group, rows = [], 0
                group.append(pair)
                rows += len(pair[1])
            if group:
                self._learn_group(group, long)

    def _learn_group(self, group: list[tuple[str, bytes]], long: bool) -> None:
        b = np.frombuffer(b"".join(x for _, x in group), np.uint8)
        begin = np.zeros(len(b), bool)
        begin[np.cumsum([0] + [len(x) for _, x in group[:-1]])] = True
        word = np.cumsum(begin) - 1
        cut = begin.copy()
        cut[1:] |= ~self.inside[b[:-1].astype(np.int32) << 8 | b[1:]]
        part = np.cumsum(cut) - 1
        at, ids = self._fixpoint(part.astype(np.int32), np.arange(len(b), dtype=np.int32), self.byte_rank[b], long)
        ends = np.searchsorted(word[at], np.arange(len(group)), "right")
        for (w, _), lo, hi in zip(group, [0, *ends.tolist()], ends.tolist()):
            self.known[w] = ids[lo:hi].tobytes()

    def _fixpoint(self, w: np.ndarray, p: np.ndarray, t: np.ndarray, long: bool) -> tuple[np.ndarray, np.ndarray]:
        """(position, id) of the tokens that remain, in order of position."""
        done = []
        while len(w):
            rounds = max(4, ROUND_ROWS // len(w))
            self.db.register("start", pa.table({"w": w, "p": p, "t": t}))
            got = self.db.execute(_ROUNDS.format(rounds=rounds, contract=_EVERY if long else _LEFTMOST)).fetchnumpy()
            self.db.unregister("start")
            w, p, t = (np.asarray(got[c], np.int32) for c in "wpt")
            more = np.asarray(got["round"]) >= rounds
            done.append((p[~more], t[~more]))
            w, p, t = w[more], p[more], t[more]
        at, ids = np.concatenate([d[0] for d in done]), np.concatenate([d[1] for d in done])
        order = np.argsort(at, kind="stable")
        return at[order], ids[order]

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text, as packed 32-bit numbers."""
        words = [self.split(t) for t in texts]
        met = {w for ws in words for w in ws}
        if self.size > MEMO_BYTES:  # the words of this call and the last ones are kept
            self.older, self.known, self.size = self.known, {}, 0
        new = [w for w in met if w not in self.known]
        self._learn(new)
        self.size += sum(map(len, new)) * 5 + 200 * len(new)
        known = self.known
        return [b"".join([known[w] for w in ws]) for ws in words]

    def encode_text(self, text: str) -> bytes:
        return b"".join(b"".join(self.encode([piece])) for piece in pieces_at_spaces(text, PIECE))

    def decode(self, packed: list[bytes]) -> list[bytes]:
        """The bytes of each list of ids (packed 32-bit numbers)."""
        out = [b""] * len(packed)
        lists = [np.frombuffer(x, np.int32) for x in packed]
        at = 0
        while at < len(lists):  # about a million tokens at a time; a longer list in parts, one after the other
            end, rows = at, 0
            while end < len(lists) and (end == at or rows + len(lists[end]) <= PIECE):
                rows += len(lists[end])
                end += 1
            parts = [(i, x[k:k + PIECE]) for i, x in enumerate(lists[at:end], at) for k in range(0, len(x), PIECE)]
            for i in range(0, len(parts), max(1, len(parts) if rows <= PIECE else 1)):
                self._decode(parts[i:i + max(1, len(parts) if rows <= PIECE else 1)], out)
            at = end
        return out

    def _decode(self, parts: list[tuple[int, np.ndarray]], out: list[bytes]) -> None:
        t = np.concatenate([x for _, x in parts])
        if len(t) and (t.min() < 0 or t.max() >= len(self.valid) or not self.valid[t].all()):
            raise ValueError("an id is not in the vocabulary")
        d = np.repeat(np.array([i for i, _ in parts], np.int32), [len(x) for _, x in parts])
        self.db.register("tokens", pa.table({"d": d, "p": np.arange(len(t), dtype=np.int32), "t": t}))
        got = self.db.execute(_DECODE).fetchall()
        self.db.unregister("tokens")
        for i, raw in got:
            out[i] += raw


_BUILT: dict[str, Codec] = {}


def _codec(shared, name: str) -> Codec:
    if name not in _BUILT:
        _BUILT.clear()
        _BUILT[name] = Codec(*shared.value)
    return _BUILT[name]


def _share(df: DataFrame, ranks: list[bytes], pattern: str):
    """The vocabulary as a broadcast; its size is fixed and does not follow the data."""
    shared = df.sparkSession.sparkContext.broadcast((ranks, pattern))
    return shared, f"{id(shared)}-{len(ranks)}"


def _encoded(codec: Codec, texts: list[str | None]) -> list[bytes]:
    short = [t if t and len(t) <= PIECE else "" for t in texts]
    return [codec.encode_text(t) if t and len(t) > PIECE else x for t, x in zip(texts, codec.encode(short))]


def encode_texts(docs: DataFrame, ranks: list[bytes], pattern: str, decode: bool = False) -> DataFrame:
    """doc_id and ids of every row, and with ``decode`` the bytes that the ids decode to; one pass, no shuffle."""
    shared, name = _share(docs, ranks, pattern)

    def run(batch: pa.RecordBatch) -> list:
        codec = _codec(shared, name)
        packed = _encoded(codec, batch.column(1).to_pylist())
        out = [batch.column(0), int_lists(packed)]
        return [*out, codec.decode(packed)] if decode else out

    return arrow_map(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), run,
                     "doc_id long, ids array<int>" + (", decoded binary" if decode else ""), rows=20_000)


def decode_ids(encoded: DataFrame, ranks: list[bytes], pattern: str) -> DataFrame:
    """doc_id and the bytes of ``ids``."""
    shared, name = _share(encoded, ranks, pattern)

    def run(batch: pa.RecordBatch) -> list:
        packed = [np.array(x or [], np.int32).tobytes() for x in batch.column(1).to_pylist()]
        return [batch.column(0), _codec(shared, name).decode(packed)]

    return arrow_map(encoded.select(F.col("doc_id").cast("long"), F.col("ids").cast("array<int>")), run,
                     "doc_id long, decoded binary", rows=500)


def op12_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = encode_texts(documents(spark, sf_dir), *default_vocabulary(), decode=True)
    ids = F.array_join(F.col("ids").cast("array<string>"), " ")
    return out.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(ids, 256).alias("ids_sha256"),
                      F.sha2("decoded", 256).alias("decoded_sha256"))
