"""Word-piece counts by a linear longest-match automaton.

The vocabulary is a trie over bytes. A node's failure link leads to the node that matching goes on from when no edge
fits, after the longest tokens of what was read have been popped; the number of popped tokens is computed with the
link. Counting the greedy longest-match pieces of a word is then one walk over its bytes, without building a piece.
Words carry a leading space byte, as the vocabulary's word-starting tokens do; a word that cannot be covered counts as
one unknown token.

Defined results: a null or empty text has 0 words and 0 tokens; a very long text or word is read whole, in one walk
without pieces; repeated rows get equal counts; an empty table gives no rows; other columns are ignored; with an empty
vocabulary every word is one unknown token.
"""

from __future__ import annotations

import base64

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dataprism.llm.common import Memo, arrow_map, documents, raw_texts

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"


def read_vocabulary(path: str = VOCABULARY) -> list[bytes]:
    """The tokens of a rank file: base64 token and rank in each line."""
    with open(path, "rb") as f:
        return [base64.b64decode(line.split()[0]) for line in f if line.strip()]


class Automaton:
    """``edges[node]`` maps a byte to a node; ``fail`` and ``popped`` are the failure links and popped counts."""

    def __init__(self, tokens: list[bytes]) -> None:
        self.edges: list[dict[int, int]] = [{}]
        is_token = [False]
        for token in tokens:
            node = 0
            for byte in token:
                nxt = self.edges[node].get(byte)
                if nxt is None:
                    nxt = len(self.edges)
                    self.edges[node][byte] = nxt
                    self.edges.append({})
                    is_token.append(False)
                node = nxt
            is_token[node] = node != 0
        # In order of depth: a token's node pops itself and fails to the root; another node pops what its parent pops
        # and then what is popped until the byte that leads to it can be read.
        self.fail: list[int] = [-1] * len(self.edges)
        self.popped = [0] * len(self.edges)
        queue = [0]
        for node in queue:
            for byte, child in self.edges[node].items():
                queue.append(child)
                if is_token[child]:
                    self.fail[child], self.popped[child] = 0, 1
                    continue
                at, n = self.fail[node], self.popped[node]
                while at >= 0 and byte not in self.edges[at]:
                    n += self.popped[at]
                    at = self.fail[at]
                if at >= 0:
                    self.fail[child], self.popped[child] = self.edges[at][byte], n

    def count(self, word: bytes) -> int:
        """The number of greedy longest-match pieces of ``word``; 1 if it cannot be covered, 0 if it is empty."""
        node, n = 0, 0
        edges, fail, popped = self.edges, self.fail, self.popped
        for byte in word:
            while byte not in edges[node]:
                if fail[node] < 0:
                    return 1
                n += popped[node]
                node = fail[node]
            node = edges[node][byte]
        while node:
            if fail[node] < 0:
                return 1
            n += popped[node]
            node = fail[node]
        return n


_BUILT: dict[str, Memo] = {}


def token_counts(docs: DataFrame, tokens: list[bytes]) -> DataFrame:
    """doc_id, n_words and n_tokens of every row: one pass, no shuffle. The vocabulary is broadcast (its size is
    fixed and does not follow the data); each Python worker builds the automaton once."""
    shared = docs.sparkSession.sparkContext.broadcast(tokens)
    name = f"{id(shared)}-{len(tokens)}"

    def count(batch: pa.RecordBatch) -> list:
        memo = _BUILT.get(name)
        if memo is None:
            _BUILT.clear()
            automaton = Automaton(shared.value)
            memo = _BUILT[name] = Memo(lambda word: automaton.count(b" " + word))
        n_words, n_tokens = [], []
        for raw in raw_texts(batch.column(1)):
            w = raw.split()
            n_words.append(len(w))
            n_tokens.append(sum([memo.new.get(x) or memo(x) for x in w]))
        return [batch.column(0), n_words, n_tokens]

    return arrow_map(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), count,
                     "doc_id long, n_words long, n_tokens long")


def op6_token_counts(spark: SparkSession, sf_dir: str, vocabulary: str = VOCABULARY) -> DataFrame:
    return token_counts(documents(spark, sf_dir), read_vocabulary(vocabulary))
