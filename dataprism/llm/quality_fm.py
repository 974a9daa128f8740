"""Quality scores by a factorisation machine, trained in numpy.

Features are hashed words (A-Z lower-cased, ASCII punctuation taken as space) with damped counts scaled to length 1,
statistics of the text's structure, and metadata (``n_chars``). The pairwise interactions of all features have rank
``RANK`` and are summed in linear time: for each factor, half of the squared sum less the sum of squares.

All rows that may be learned from are learned from, none is left out: by slices in parallel, whose machines Spark
averages after each epoch (``labelled.averaged``). Their features are written once. Scoring is one pass over all
documents without a shuffle.

Defined results: a null or empty text has no words and structure statistics of 0; a null ``n_chars`` counts as the
text's length; equal texts with equal ``n_chars`` get equal scores; without labels every score is 0; an empty table
gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dataprism.llm.common import PLAIN, Scratch, arrow_map, batch_hashes, documents, raw_texts
from dataprism.llm.labelled import averaged, fold, label_counts, label_weights, read_labels, with_texts

BUCKETS = 1 << 15
RANK = 8
EPOCHS = 8
BATCH = 64

_CLASSES = {"upper": range(65, 91), "digit": range(48, 58), "symbol": b"#*$%&|<>{}[]=_~^@\\/+",
            "mark": b".,;:!?'\"()-", "space": b" \t\n\r\x0b\f", "high": range(128, 256)}
_CLASS_OF = np.full(256, len(_CLASSES), np.int64)
for _i, _bytes in enumerate(_CLASSES.values()):
    _CLASS_OF[list(_bytes)] = _i
N_STRUCTURE = len(_CLASSES) + 6


def structure(raw: bytes, n_chars: int | None, hashes: np.ndarray) -> list[float]:
    """Shares of byte classes, repetition, shape of lines and words, and the size by metadata."""
    n = len(raw)
    share = np.bincount(_CLASS_OF[np.frombuffer(raw, np.uint8)], minlength=len(_CLASSES) + 1)[:len(_CLASSES)] \
        / max(1, n)
    words = len(hashes)
    lines = raw.split(b"\n")
    pairs = hashes[1:] + hashes[:-1] * np.uint64(3)
    return [*share.tolist(), 1 - len(np.unique(hashes)) / words if words else 0.0,
            1 - len(np.unique(pairs)) / len(pairs) if words > 1 else 0.0,
            1 - len(set(lines)) / len(lines), min(n / words / 10, 3.0) if words else 0.0,
            np.log1p(words) / 10, np.log1p(n_chars if n_chars is not None else len(raw.decode())) / 10]


class Features:
    """(bucket, value) pairs of texts one after the other, where each begins, and the structure columns."""

    def __init__(self, raws: list[bytes], n_chars: list[int | None]) -> None:
        h, off = batch_hashes([x.translate(PLAIN) for x in raws])
        doc = np.repeat(np.arange(len(raws)), np.diff(off))
        key, count = np.unique(doc * BUCKETS + (h % np.uint64(BUCKETS)).astype(np.int64), return_counts=True)
        self.doc, self.ids = key // BUCKETS, (key % BUCKETS).astype(np.int32)
        value = np.log1p(count)
        norm = np.sqrt(np.bincount(self.doc, value * value, len(raws)))
        self.values = (value / norm[self.doc]).astype(np.float32)
        self.off = np.searchsorted(self.doc, np.arange(len(raws) + 1))
        self.structure = np.array([structure(r, n, h[a:b]) for r, n, a, b in zip(raws, n_chars, off, off[1:])],
                                  np.float32).reshape(len(raws), N_STRUCTURE)


class Machine:
    """Weights and factors of the buckets, then of the structure columns (standardised). Its ``state`` is one array with
    a row for each of these (weight, factors, and the summed squares of their steps) and one of the rest; all else are
    views into them."""

    def __init__(self, mean: np.ndarray, spread: np.ndarray, seed: int = 7,
                 state: tuple[np.ndarray, np.ndarray] | None = None) -> None:
        self.mean, self.spread = mean, spread
        if state is None:
            few = np.full((BUCKETS + N_STRUCTURE, 2 + 2 * RANK), 1e-4, np.float32)
            few[:, 0] = 0
            few[:, 1:1 + RANK] = np.random.default_rng(seed).normal(0, 0.05, (BUCKETS + N_STRUCTURE, RANK))
            state = few, np.array([0, 1e-4], np.float32)
        self.state = state
        few, rest = state
        self.weight, self.factors = few[:, 0], few[:, 1:1 + RANK]
        self.gw, self.gv = few[:, 1 + RANK], few[:, 2 + RANK:]
        self.const, self.gc = rest[:1], rest[1:]

    def __reduce__(self) -> tuple:
        return Machine, (self.mean, self.spread, 7, self.state)

    def standard(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.spread, -4, 4) / 2

    def margins(self, ids: np.ndarray, values: np.ndarray, doc: np.ndarray, x: np.ndarray) -> tuple:
        """The margin of each text, and its sums of factors."""
        n = len(x)
        vx = self.factors[ids] * values[:, None]
        sums, squares = np.zeros((n, RANK), np.float64), np.zeros((n, RANK), np.float64)
        for f in range(RANK):
            sums[:, f] = np.bincount(doc, vx[:, f], n)
            squares[:, f] = np.bincount(doc, vx[:, f] ** 2, n)
        # Sums over a row instead of matrix products: equal texts get equal scores in whatever batch.
        own = x[:, :, None].astype(np.float64) * self.factors[BUCKETS:]
        sums += own.sum(1)
        squares += (own * own).sum(1)
        linear = np.bincount(doc, self.weight[ids] * values, n) + (x * self.weight[BUCKETS:]).sum(1)
        return self.const + linear + 0.5 * (sums**2 - squares).sum(1), sums

    def scores(self, f: Features) -> np.ndarray:
        z, _ = self.margins(f.ids, f.values, f.doc, self.standard(f.structure))
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def learn_batch(net: Machine, ids: np.ndarray, values: np.ndarray, doc: np.ndarray, x: np.ndarray, labels: np.ndarray,
                weight: np.ndarray) -> None:
    """A step of AdaGrad on the weighted logistic loss with a small decay of what is used."""
    z, sums = net.margins(ids, values, doc, x)
    dz = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - labels) * weight / len(labels)
    slot, inverse = np.unique(ids, return_inverse=True)
    d = dz[doc] * values
    w = np.concatenate([np.bincount(inverse, d, len(slot)), dz @ x])
    rows = np.concatenate([slot, np.arange(BUCKETS, BUCKETS + N_STRUCTURE)])
    v = np.zeros((len(rows), RANK))
    for k in range(RANK):
        v[:len(slot), k] = np.bincount(inverse, d * (sums[doc, k] - net.factors[ids, k] * values), len(slot))
    v[len(slot):] = x.T @ (dz[:, None] * sums) - (dz @ (x * x))[:, None] * net.factors[BUCKETS:]
    w += 1e-4 * net.weight[rows]
    v += 1e-4 * net.factors[rows]
    net.gw[rows] += w * w
    net.gv[rows] += v * v
    net.gc += dz.sum() ** 2
    net.weight[rows] -= 0.1 * w / np.sqrt(net.gw[rows])
    net.factors[rows] -= 0.03 * v / np.sqrt(net.gv[rows])
    net.const -= 0.1 * dz.sum() / np.sqrt(net.gc)


def train(f: Features, labels: np.ndarray, seed: int = 7) -> Machine:
    """A machine of a few texts in memory; both labels weigh the same."""
    net = Machine(f.structure.mean(0), f.structure.std(0) + 1e-3, seed)
    x_all = net.standard(f.structure).astype(np.float32)
    rng = np.random.default_rng(seed)
    weight = label_weights(labels, int((labels == 1).sum()), int((labels == 0).sum()))
    for _ in range(EPOCHS):
        order = rng.permutation(len(labels))
        for at in range(0, len(order), BATCH):
            some = order[at:at + BATCH]
            take = np.concatenate([np.arange(f.off[i], f.off[i + 1]) for i in some])
            doc = np.repeat(np.arange(len(some)), [f.off[i + 1] - f.off[i] for i in some])
            learn_batch(net, f.ids[take], f.values[take], doc, x_all[some], labels[some], weight[some])
    return net


def train_rows(rows: DataFrame, seed: int = 7) -> Machine | None:
    """The machine after ``EPOCHS`` over all ``rows`` (__id, label, ids, vals, structure); None without rows."""
    ones, others = label_counts(rows)
    if not ones + others:
        return None
    column = [F.col("structure")[i] for i in range(N_STRUCTURE)]
    r = rows.agg(*[F.avg(c) for c in column], *[F.stddev_pop(c) for c in column]).first()
    mean, spread = np.array(r, np.float32).reshape(2, N_STRUCTURE)
    spread = spread + np.float32(1e-3)

    def learn(few: np.ndarray, rest: np.ndarray, batches: Iterator[pa.RecordBatch]) -> int:
        net = Machine(mean, spread, state=(few, rest))
        seen, held = 0, []

        def step() -> None:
            labels, ids, vals, x = zip(*held)
            y = np.array(labels, np.float64)
            learn_batch(net, np.concatenate(ids), np.concatenate(vals), np.repeat(np.arange(len(ids)), [len(i) for i in ids]),
                        net.standard(np.stack(x)).astype(np.float32), y, label_weights(y, ones, others))
            held.clear()

        for batch in batches:
            for label, *parts in zip(batch.column(1).to_pylist(), *batch.columns[2:]):
                held.append((label, *(p.values.to_numpy() for p in parts)))
                if len(held) == BATCH:
                    step()
            seen += batch.num_rows
        if held:
            step()
        return seen

    start = Machine(mean, spread, seed).state
    return Machine(mean, spread, state=averaged(rows.select("__id", "label", "ids", "vals", "structure"), ones + others,
                                                start, EPOCHS, learn))


def fit(docs: DataFrame, labels: DataFrame, learn) -> Machine | None:
    """The machine from all of ``labels`` that ``learn`` allows."""
    def features(batch: pa.RecordBatch) -> list:
        f = Features(raw_texts(batch.column(1)), batch.column(2).to_pylist())
        off = pa.array(f.off.astype(np.int32))
        shape = pa.array(N_STRUCTURE * np.arange(batch.num_rows + 1, dtype=np.int32))
        return [batch.column(0), pc.equal(batch.column(3), 1).cast(pa.int32()),
                pa.ListArray.from_arrays(off, pa.array(f.ids)), pa.ListArray.from_arrays(off, pa.array(f.values)),
                pa.ListArray.from_arrays(shape, pa.array(f.structure.ravel()))]

    chosen = with_texts(docs, labels.filter(learn), [F.col("text").cast("string"), F.col("n_chars").cast("long")])
    scratch = Scratch(docs.sparkSession, "quality")
    rows, path = scratch.write(arrow_map(
        chosen.select("__id", "text", "n_chars", "label"), features,
        "__id long, label int, ids array<int>, vals array<float>, structure array<float>", rows=500), codec="zstd")
    net = train_rows(rows)
    scratch.drop(path)
    return net


def score_quality(docs: DataFrame, net: Machine | None) -> DataFrame:
    """doc_id, score and predicted (score >= 0.5)."""
    shared = docs.sparkSession.sparkContext.broadcast(net)

    def run(batch: pa.RecordBatch) -> list:
        if shared.value is None:
            s = np.zeros(batch.num_rows)
        else:
            s = shared.value.scores(Features(raw_texts(batch.column(1)), batch.column(2).to_pylist()))
        return [batch.column(0), s, (s >= 0.5).astype(np.int32)]

    return arrow_map(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"),
                                 F.col("n_chars").cast("long")), run,
                     "doc_id long, score double, predicted int", rows=1000)


def op3_quality_fm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    net = fit(docs, read_labels(spark, sf_dir, "quality"), fold(F.col("doc_id"), 3) != 1)
    return score_quality(docs, net).select(
        "doc_id", (fold(F.col("doc_id"), 3) == 1).alias("held_out"), "score", "predicted")
