"""Classifiers, decontamination, token counts, SentencePiece and the pipeline."""

import random
from collections import Counter

import numpy as np
import pytest

from dataprism.llm import common, decontaminate, labelled, quality_fm, sentencepiece_ac, token_counts, toxicity
from dataprism.llm.labelled import fold, read_labels, sample, with_texts
from pyspark.sql import functions as F
from tests.conftest import SF_CHECK, SF_SMALL
from tests.llm.data import frame, rows, words

SF_LEARN = "/root/testdata/sf0.1"  # the smallest size with some hundred toxic rows to learn from


@pytest.fixture(scope="module")
def docs(spark):
    return frame(spark).cache()


@pytest.fixture(scope="module")
def none(spark):
    return frame(spark, [])


def test_word_hashes_follow_words():
    r = random.Random(3)
    parts = [b"a", b"b", b"ab", b" ", b"\n", b"\x0b", b"\xc2\xa0", b"xyz", "é".encode()]
    raws = [b"".join(r.choice(parts) for _ in range(r.randrange(60))) for _ in range(500)]
    raws += [b"", b" ", b"q" * 2_500_000 + b" tail " + b"z w " * 700_000, b"\n" * 1_200_000 + b"end"]
    for first in (None, 2):
        h, off = common.batch_hashes(raws, first)
        seen = {}
        for i, raw in enumerate(raws):
            w = raw.split()
            assert off[i + 1] - off[i] == len(w)
            for x, y in zip(w, h[off[i]:off[i + 1]].tolist()):
                assert seen.setdefault(x[:first], y) == y
        assert len(set(seen.values())) == len(seen)


def test_labels_are_sampled_within_bounds(spark):
    labels = read_labels(spark, SF_CHECK, "toxic")
    learn = fold(F.col("doc_id"), 5) != 0
    got = sample(labels, learn, 10).collect()
    assert Counter(r.label for r in got) == {0: 10, 1: 10}
    assert got == sample(labels, learn, 10).collect()


def test_scores_cover_hard_cases(spark, docs, none):
    net, limits = toxicity.Network(), {None: 0.5, "en": 0.7}
    f = quality_fm.Features([b"a b", b"c"], [3, 1])
    machine = quality_fm.train(f, np.array([1.0, 0.0]))
    for out, empty in ((toxicity.score_toxicity(docs, net, limits), toxicity.score_toxicity(none, net, limits)),
                       (quality_fm.score_quality(docs, machine), quality_fm.score_quality(none, machine))):
        data = out.collect()
        assert Counter(r.doc_id for r in data) == Counter(r[0] for r in rows())
        assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in data)
        assert len({r.score for r in data if r.doc_id == 100}) <= 2
        assert empty.count() == 0
    unlabelled = toxicity.score_toxicity(docs, None, {None: 0.5}).union(
        quality_fm.score_quality(docs, None).withColumn("flagged", F.lit(False)))
    assert {(r.score, r.predicted) for r in unlabelled.collect()} == {(0.0, 0)}


def test_network_pieces_equal_whole(monkeypatch):
    net = toxicity.Network()
    ids, off = toxicity.bucket_ids([b"a b c d e f g h i j k", b"", b"z", b"m n o p q"])
    whole = net.scores(ids, off, net.tables())
    monkeypatch.setattr(toxicity, "PIECE", 3)
    assert np.allclose(net.scores(ids, off, net.tables()), whole)


def test_network_responses_equal_plain_convolution():
    net = toxicity.Network()
    ids, off = toxicity.bucket_ids([b"a b c d", b"e"])
    got = net.responses(ids, off, net.tables())
    for d in range(2):
        e = net.emb[ids[off[d]:off[d + 1]]].sum(1)
        e = np.concatenate([e, np.zeros((2, toxicity.SIZE), np.float32)])
        for i, w in enumerate(toxicity.WIDTHS):
            r = [sum(e[p + j] @ net.conv[i][j] for j in range(w)) for p in range(off[d + 1] - off[d])]
            cols = slice(i * toxicity.FILTERS, (i + 1) * toxicity.FILTERS)
            assert np.allclose(got[d, cols], np.maximum(np.max(r, 0) + net.bias[cols], 0), atol=1e-5)


def test_factorisation_identity():
    f = quality_fm.Features([b"a b c a", b"d e", b""], [7, 3, 0])
    m = quality_fm.train(f, np.array([1.0, 0.0, 1.0]))
    z, _ = m.margins(f.ids, f.values, f.doc, x := m.standard(f.structure))
    for d in range(3):
        a, b = f.off[d], f.off[d + 1]
        at = np.concatenate([f.ids[a:b], np.arange(quality_fm.BUCKETS, quality_fm.BUCKETS + quality_fm.N_STRUCTURE)])
        v = np.concatenate([f.values[a:b], x[d]])
        pairs = sum(v[i] * v[j] * (m.factors[at[i]] @ m.factors[at[j]])
                    for i in range(len(at)) for j in range(i))
        assert abs(z[d] - (m.const + m.weight[at] @ v + pairs)) < 1e-4


@pytest.mark.parametrize("name, query, sf, least", [("toxic", toxicity.op2_toxicity_cnn, SF_LEARN, 0.85),
                                                    ("quality", quality_fm.op3_quality_fm, SF_CHECK, 0.9)])
def test_held_out_accuracy(spark, name, query, sf, least):
    """Balanced accuracy on the rows that were not learned from."""
    out = query(spark, sf).cache()
    both = out.filter("held_out").join(read_labels(spark, sf, name), "doc_id").collect()
    assert out.count() == spark.read.parquet(f"{sf}/documents.parquet").count()
    rates = [np.mean([r.predicted == v for r in both if r.label == v]) for v in (0, 1)]
    assert np.mean(rates) >= least


def slow_tiles(text, item, least):
    """Greedy string tiling by comparing everything with everything."""
    free_t, free_i, total = [w >= 0 for w in text], [True] * len(item), 0
    while True:
        best, found = 0, []
        for p in range(len(item)):
            for t in range(len(text)):
                n = 0
                while p + n < len(item) and t + n < len(text) and free_i[p + n] and free_t[t + n] \
                        and item[p + n] == text[t + n]:
                    n += 1
                if n > best:
                    best, found = n, [(p, t)]
                elif n == best:
                    found.append((p, t))
        if best < least:
            return total
        for p, t in found:
            if all(free_i[p:p + best]) and all(free_t[t:t + best]):
                total += best
                free_i[p:p + best] = free_t[t:t + best] = [False] * best


def test_tiles_equal_slow_tiles():
    r = random.Random(2)
    for _ in range(500):
        item = [r.randrange(4) for _ in range(r.randrange(1, 16))]
        text = [r.randrange(-1, 4) for _ in range(r.randrange(1, 25))]
        assert sum(n for n, _, _ in decontaminate.tile(text, item, 2)) == slow_tiles(text, item, 2)


def test_decontamination(spark, docs, none, monkeypatch):
    r = random.Random(4)
    word = lambda: f"b{r.randrange(900)}"
    items = [(i, " ".join(word() for _ in range(40))) for i in range(6)] + [(7, "only three words"), (8, ""),
                                                                           (9, None)]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    w = [t.split() for _, t in items[:6]]
    planted = {
        1000: ([0], "start, " + items[0][1].upper() + ". the end"),
        1001: ([1], " filler ".join(" ".join(w[1][k:k + 10]) for k in (30, 10, 0, 20))),  # reordered
        1002: ([], "some " + " ".join(w[2][:12])),  # too little
        1003: ([3, 4], items[3][1] + "\n" + items[4][1]),
        1004: ([], " ".join(w[5][::-1])),
        1005: ([7], "there are only, three WORDS here"),
        1006: ([], "only three"),
    }
    more = [(i, t, "en", "s9", len(t)) for i, (_, t) in planted.items()]
    both = docs.unionByName(frame(spark, more))
    for bits in (27, 15):  # filters of any size let all seeds through
        monkeypatch.setattr(decontaminate, "FILTER_BITS", bits)
        out = decontaminate.mark_contaminated(both, benchmark)
        found = {r.doc_id: sorted(r["__items"]) for r in out.collect() if r["__items"]}
        assert found == {i: ids for i, (ids, _) in planted.items() if ids}
        assert out.columns[:len(both.columns)] == both.columns
    assert decontaminate.mark_contaminated(none, benchmark).count() == 0
    nothing = decontaminate.mark_contaminated(docs, benchmark.limit(0))
    assert nothing.filter("__coverage > 0").count() == 0 and nothing.count() == len(rows())


def greedy(tokens, word):
    n, at = 0, 0
    while at < len(word):
        end = next((e for e in range(len(word), at, -1) if word[at:e] in tokens), None)
        if end is None:
            return 1
        n, at = n + 1, end
    return n


def test_automaton_counts_greedy_pieces():
    r = random.Random(5)
    for _ in range(400):
        tokens = {bytes(r.choice(b"abc") for _ in range(r.randrange(1, 6))) for _ in range(r.randrange(1, 12))}
        if r.random() < 0.6:
            tokens |= {b"a", b"b", b"c"}
        a = token_counts.Automaton(sorted(tokens))
        for _ in range(8):
            w = bytes(r.choice(b"abc") for _ in range(r.randrange(14)))
            assert a.count(w) == greedy(tokens, w)


def test_token_counts(spark, docs, none):
    vocabulary = token_counts.read_vocabulary()
    tokens = set(vocabulary)
    out = token_counts.token_counts(docs, vocabulary)
    assert Counter(map(tuple, out.collect())) == Counter(
        (i, len(w := words(t)), sum(greedy(tokens, b" " + x) for x in w)) for i, t, *_ in rows() if i != 9) \
        + Counter([(9, 1, greedy(tokens, b" " + b"y" * 3000))])
    assert token_counts.token_counts(none, vocabulary).count() == 0


def best_score(pieces, unknown, text):
    scores = {p: s for p, s, kind in pieces if kind == 0}
    best = [0.0] + [float("-inf")] * len(text)
    for end in range(1, len(text) + 1):
        for start in range(max(0, end - 16), end):
            if (s := scores.get(text[start:end])) is not None:
                best[end] = max(best[end], best[start] + s)
        if text[end - 1] not in scores:
            best[end] = max(best[end], best[end - 1] + unknown)
    return best[-1]


def test_viterbi_finds_the_best_segmentation():
    pieces = sentencepiece_ac.read_pieces()
    enc = sentencepiece_ac.Encoder(pieces)
    r = random.Random(6)
    for _ in range(300):
        text = "".join(r.choice("the andé\n日本語x\U0001f600ing.") for _ in range(r.randrange(1, 20)))
        ids = memoryview(enc.encode(text)).cast("i").tolist()
        assert enc.decode(ids) == text
        marked = sentencepiece_ac.MARK + text.replace(" ", sentencepiece_ac.MARK)
        raw = bytes(int(pieces[i][0][1:-1], 16) for i in ids if pieces[i][2] == 1).decode()
        total = sum(pieces[i][1] for i in ids if pieces[i][2] == 0) + enc.unknown * len(raw)
        assert abs(total - best_score(pieces, enc.unknown, marked)) < 1e-6


def test_long_chunks_are_cut_where_no_piece_crosses(monkeypatch):
    enc = sentencepiece_ac.Encoder(sentencepiece_ac.read_pieces())
    r = random.Random(8)
    texts = ["".join(r.choice("日本語のテスト漢字") for _ in range(3000)), "a" * 3000,
             "".join(r.choice("theand😀é=-") for _ in range(3000))]
    whole = [enc.best(t) for t in texts]
    monkeypatch.setattr(sentencepiece_ac, "PIECE_OF_CHUNK", 100)
    assert len(enc.cuts(texts[0])) > 5
    assert [enc.best(t) for t in texts] == whole


def test_memo_is_bounded_and_right():
    made = []
    memo = common.Memo(lambda x: made.append(x) or x * 2, limit=4000)
    keys = [b"%d" % (i % 37) for i in range(500)]
    assert [memo.new.get(k) or memo(k) for k in keys] == [k * 2 for k in keys]
    assert len(memo.new) + len(memo.old) < 25 and memo(b"y" * 100) == b"y" * 200 and b"y" * 100 not in memo.new


def test_encode_and_decode(spark, docs, none):
    pieces = sentencepiece_ac.read_pieces()
    out = sentencepiece_ac.encode_texts(docs, pieces).cache()
    assert out.filter("NOT round_trip OR size(ids) <> n_pieces").count() == 0
    back = sentencepiece_ac.decode_texts(out, pieces)
    assert Counter(map(tuple, back.collect())) == Counter((i, t or "") for i, t, *_ in rows())
    assert sentencepiece_ac.encode_texts(none, pieces).count() == 0


def test_pipeline(spark):
    import corpus_pipeline

    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality_rules", "line_dedup", "near_duplicates", "decontamination", "sentencepiece"]
    out = corpus_pipeline.run(spark, SF_SMALL).collect()
    assert out and all(r.round_trip for r in out)
    assert len({r.doc_id for r in out}) == len(out)


def test_one_example_per_chosen_id(spark):
    docs = spark.createDataFrame([(1, f"text {i}", i) for i in range(50)] + [(2, None, None), (3, "c", 1)],
                                 "doc_id long, text string, n_chars long")
    chosen = spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, label int")
    out = with_texts(docs, chosen, [F.col("text"), F.col("n_chars").cast("long")])
    assert out.columns == ["__id", "text", "n_chars", "label"]
    first, = {tuple(r) for d in (docs, docs.repartition(7)) for r in with_texts(
        d, chosen, [F.col("text"), F.col("n_chars")]).filter("__id = 1").collect()}
    assert first[1] == f"text {first[2]}" and first[3] == 1
    assert {tuple(r) for r in out.collect()} == {first, (2, None, None, 0)} and out.count() == 2


def test_averaged_state_sees_every_row_once_an_epoch(spark, monkeypatch):
    """Rows that a slice changed are averaged over the slices that did, the rest over all."""
    monkeypatch.setattr(labelled, "SLICE_ROWS", 10)
    rows = spark.range(95).select(F.col("id").alias("__id"))

    def learn(few, rest, batches):
        ids = np.concatenate([np.empty(0, np.int64), *[b.column(0).to_numpy() for b in batches]])
        few[ids, 0] += 1
        few[ids, 1] += ids
        rest += len(ids) > 0
        return len(ids)

    few, rest = labelled.averaged(rows, 95, (np.zeros((5000, 2), np.float32), np.zeros(3, np.float32)), 2, learn)
    assert few[:95].tolist() == [[2, 2 * i] for i in range(95)] and not few[95:].any()
    assert rest.tolist() == [2, 2, 2]


@pytest.mark.parametrize("name", ["toxicity", "quality"])
def test_models_learn_from_all_rows(spark, name):
    """What only the last of many rows show, by the order in which a bounded sample was taken, is learned, too."""
    last = F.xxhash64("doc_id") > int(0.75 * 2**63)
    made = spark.range(8000).select(
        F.col("id").alias("doc_id"), (F.col("id") % 2).cast("int").alias("label"), F.lit("en").alias("lang"),
        F.lit(9).cast("long").alias("n_chars"),
        F.when(F.col("id") % 2 == 0, F.lit("plain words")).when(last, F.lit("omega words"))
        .otherwise(F.lit("alpha words")).alias("text")).cache()
    probe = spark.createDataFrame([(1, "omega words", "en", 9), (2, "other words", "en", 9), (3, "plain words", "en", 9)],
                                  "doc_id long, text string, lang string, n_chars long")
    labels = made.select("doc_id", "label")
    if name == "toxicity":
        net, limits = toxicity.fit(made, labels, F.lit(True))
        assert set(limits) == {None, "en"}
        out = toxicity.score_toxicity(probe, net, limits)
        assert {r.doc_id for r in out.filter("flagged").collect()} >= {1}
    else:
        out = quality_fm.score_quality(probe, quality_fm.fit(made, labels, F.lit(True)))
    score = {r.doc_id: r.score for r in out.collect()}
    assert score[1] > 0.8 and score[3] < 0.2 and score[1] > score[2] + 0.1


def test_thresholds_from_all_rows(spark):
    """The best F1 over the grid, by language and for all."""
    r = random.Random(8)
    data = [(lang, y, r.randrange(1500, 2600) + 400 * y) for lang in ("a", "b", None, "") for y in (0, 0, 1)
            for _ in range(60)] + [("c", 1, 2000)] * 30
    got = toxicity.calibrate(spark.createDataFrame(data, "lang string, label int, bin int"))

    def best(some):
        f1 = {}
        for b in {x[2] for x in some}:
            hit = sum(y for _, y, x in some if x >= b)
            f1[b] = (2 * hit / (sum(x >= b for *_, x in some) + sum(y for _, y, _ in some)), b)
        return float(toxicity.GRID[max(f1.values())[1]])

    assert got == {None: best(data)} | {k: best([x for x in data if x[0] == k]) for k in "ab"}
    assert toxicity.calibrate(spark.createDataFrame(data, "lang string, label int, bin int").filter("label = 0")) == {None: 0.5}
