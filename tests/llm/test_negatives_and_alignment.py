"""Hard negatives, byte-level BPE and tokenizer alignment against brute force."""

import hashlib
import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from dataprism.llm import alignment, byte_bpe, hard_negatives
from tests.llm.data import frame, rows

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    return frame(spark).cache()


@pytest.fixture(scope="module")
def none(spark):
    return frame(spark, [])


# --- hard negatives ----------------------------------------------------------------------------------------------

VECTORS = ("vec_id long, embedding array<float>, label int, j int, c string, strip int, score string, rank int, "
           "id string, `a.b` int, anchors int, rows int")


def vectors(n=260, dims=11, seed=3):
    r = random.Random(seed)
    out = [(i, [r.choice((-1, 1)) * r.randrange(0, 40) / 64 for _ in range(dims)], r.choice((0, 0, 0, 1, 2, 9)))
           for i in range(n)]
    for i in range(10, n, 13):  # copies, under other labels too
        out[i] = (i, out[i - 10][1], r.choice((0, 1)))
    out += [(300, None, 1), (400, [0.5] * dims, None), (None, [0.5] * dims, 0), (500, [0.5, None] + [0.1] * 9, 0),
            (600, [float("nan")] * dims, 0), (700, [float("inf")] * dims, 0), (800, [], 0), (801, [0.7] * 3, 1),
            (900, [0.5] * 19, 0), (901, [-3.75] * 19, 0), (20, out[20][1], out[20][2]), (20, out[20][1], out[20][2]),
            (40, [0.25] * dims, 2), (-100, [0.3] * dims, 4)]
    return out


def vector_frame(spark, data):
    return spark.createDataFrame([(*r, 1, "c", 2, "s", 3, "i", 4, 5, 6) for r in data], VECTORS).repartition(3)


def brute_negatives(data, is_anchor, k, low=80, high=100):
    kept = []
    for i, v, label in data:
        if i is None or v is None or label is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        kept.append((i, [math.floor(256 * float(np.float32(x))) for x in v], label))
    out = Counter()
    for i, v, label in kept:
        if not is_anchor(i):
            continue
        scored = [(-sum(x * y for x, y in zip(v, w)), j, other) for j, w, other in kept]
        best = sorted((s, j) for s, j, other in scored if other == label and j != i)[:k]
        for ps, p in best:
            found = sorted((s, j) for s, j, other in scored if other != label
                           and low * -ps <= high * -s <= high * -ps)[:k]
            out.update((i, p, r, j, -ps, -s) for r, (s, j) in enumerate(found, 1))
    return out


@pytest.mark.parametrize("sizes", [(2048, 256, 4, 8, 16), (16, 3, 2, 2, 1)])
def test_hard_negatives(spark, monkeypatch, sizes):
    for name, size in zip(("BLOCK_ROWS", "BLOCK_ANCHORS", "SLICE_BLOCKS", "STRIP_BLOCKS", "HELD_BLOCKS"), sizes):
        monkeypatch.setattr(hard_negatives, name, size)
    data = vectors()
    part = hard_negatives.take_part(vector_frame(spark, data), F.col("label"))
    expected = brute_negatives(data, lambda i: i % 20 == 0, 5)
    assert len(expected) > 100 and max(expected.values()) > 1  # anchor 20 has several rows
    out = hard_negatives.mine(part, F.col("vec_id") % 20 == 0)
    assert Counter(map(tuple, out.collect())) == expected
    assert out.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def test_hard_negatives_other_limits(spark):
    data = vectors(90, 8, 5)
    part = hard_negatives.take_part(vector_frame(spark, data), F.col("label"))
    out = hard_negatives.mine(part, F.col("vec_id") % 10 == 0, k=3, low=1, high=2)
    assert Counter(map(tuple, out.collect())) == brute_negatives(data, lambda i: i % 10 == 0, 3, 1, 2)


def test_hard_negatives_of_nothing(spark):
    for data, anchor in (([], F.lit(True)), (vectors(30), F.lit(False)), ([(1, [0.5], 1)], F.lit(True))):
        part = hard_negatives.take_part(vector_frame(spark, data), F.col("label"))
        assert hard_negatives.mine(part, anchor).count() == 0


def test_equal_vectors_are_ties(spark):
    """One vector that a third of all rows have: ties go to the smaller ids, whatever the blocks."""
    data = [(i, [0.5, 0.25], i % 3 // 2) for i in range(300)] + [(i, [0.6, 0.1], 1) for i in range(300, 600)]
    part = hard_negatives.take_part(vector_frame(spark, data), F.col("label"))
    out = hard_negatives.mine(part, F.col("vec_id") % 50 == 0)
    assert Counter(map(tuple, out.collect())) == brute_negatives(data, lambda i: i % 50 == 0, 5)


def test_table_scores_are_inner_products():
    rng = np.random.default_rng(1)
    for top, kind in ((100, np.int32), (2**20, np.int64), (1, np.int32)):
        a, c = rng.integers(-top, top, (40, 24)), rng.integers(-top, top, (700, 24))
        c[0], c[1] = -top, top
        got = hard_negatives.table_scores(hard_negatives.subset_sums(a.T.astype(kind)), hard_negatives.bit_planes(c), 64)
        assert (got == c @ a.T).all()
    assert (hard_negatives.table_scores(hard_negatives.subset_sums(a.T), hard_negatives.bit_planes(c * 0)) == 0).all()


def test_scores_too_large_fail(spark):
    part = hard_negatives.take_part(vector_frame(spark, [(0, [1e30], 1), (1, [1e30], 1)]), F.col("label"))
    with pytest.raises(Exception, match="too large"):
        hard_negatives.mine(part, F.lit(True)).collect()


# --- byte-level BPE ----------------------------------------------------------------------------------------------

HARD = ["", "hello world", "y" * 700, "  a \n\n b\t\tc ", "日本語のテキスト" * 20, "=-" * 150 + "!" * 77,
        "\x1c\x1d x\x85y\xa0z᠎​　 q", "<|endoftext|>", "don't we'll I'M", "é" * 90, "\U0001f600" * 40]


@pytest.fixture(scope="module")
def reference():
    import tiktoken

    ranks, pattern = byte_bpe.default_vocabulary()
    return tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks={t: i for i, t in enumerate(ranks)},
                             special_tokens={})


def ids_of(packed):
    return np.frombuffer(packed, np.int32).tolist()


@pytest.mark.parametrize("long_word, round_rows", [(64, 8_000_000), (0, 2000), (10_000, 2000)])
def test_codec_equals_reference(reference, monkeypatch, long_word, round_rows):
    monkeypatch.setattr(byte_bpe, "LONG_WORD", long_word)
    monkeypatch.setattr(byte_bpe, "ROUND_ROWS", round_rows)
    monkeypatch.setattr(byte_bpe, "GROUP_ROWS", 500)
    codec = byte_bpe.Codec(*byte_bpe.default_vocabulary())
    r = random.Random(4)
    texts = HARD + ["".join(r.choice("ab cde\nxyzéAB'st1 92") for _ in range(r.randrange(200))) for _ in range(60)]
    got = codec.encode(texts)
    assert [ids_of(x) for x in got] == [reference.encode_ordinary(t) for t in texts]
    assert codec.decode(got) == [t.encode() for t in texts]
    assert codec.decode([]) == [] and codec.decode([b"", b""]) == [b"", b""]


def plain_merge(ranks, word):
    """Merge the leftmost pair of the lowest rank until there is none."""
    if word in ranks:
        return [ranks[word]]
    parts = [word[i:i + 1] for i in range(len(word))]
    while True:
        pairs = [(ranks[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in ranks]
        if not pairs:
            return [ranks[p] for p in parts]
        _, i = min(pairs)
        parts[i:i + 2] = [parts[i] + parts[i + 1]]


@pytest.mark.parametrize("long_word", [0, 10_000])
def test_codec_follows_any_ranks(monkeypatch, long_word):
    """Vocabularies in which a token may have a lower rank than its parts."""
    monkeypatch.setattr(byte_bpe, "LONG_WORD", long_word)
    r = random.Random(9)
    for _ in range(6):
        tokens = {"".join(r.choice("abc") for _ in range(r.randrange(2, 6))).encode() for _ in range(40)}
        ranks = [bytes([b]) for b in range(256)] + r.sample(sorted(tokens), len(tokens))
        codec = byte_bpe.Codec(ranks, "[a-z]+| ")
        at = {t: i for i, t in enumerate(ranks)}
        words = ["".join(r.choice("aabc") for _ in range(r.randrange(1, 40))) for _ in range(60)]
        assert [ids_of(x) for x in codec.encode(words)] == [plain_merge(at, w.encode()) for w in words]


def test_known_words_are_bounded(monkeypatch, reference):
    monkeypatch.setattr(byte_bpe, "MEMO_BYTES", 20_000)
    codec = byte_bpe.Codec(*byte_bpe.default_vocabulary())
    for k in range(12):
        texts = [f"common word{k * 7 + i} uncommonword{i}" for i in range(30)]
        assert [ids_of(x) for x in codec.encode(texts)] == [reference.encode_ordinary(t) for t in texts]
    assert len(codec.known) + len(codec.older) < 400


def test_encode_and_decode_tables(spark, docs, none, reference, monkeypatch):
    monkeypatch.setattr(byte_bpe, "PIECE", 5000)
    vocabulary = byte_bpe.default_vocabulary()
    out = byte_bpe.encode_texts(docs, *vocabulary, decode=True).cache()
    expected = Counter((i, tuple(reference.encode_ordinary(t or "")), (t or "").encode()) for i, t, *_ in rows())
    assert Counter((r.doc_id, tuple(r.ids), bytes(r.decoded)) for r in out.collect()) == expected
    back = byte_bpe.decode_ids(out.select("doc_id", "ids", F.lit(1).alias("decoded")), *vocabulary)
    assert Counter((r.doc_id, bytes(r.decoded)) for r in back.collect()) == Counter(
        (i, (t or "").encode()) for i, t, *_ in rows())
    assert byte_bpe.encode_texts(none, *vocabulary).count() == 0
    odd = spark.createDataFrame([(1, None), (2, [])], "doc_id long, ids array<int>")
    assert [bytes(r.decoded) for r in byte_bpe.decode_ids(odd, *vocabulary).collect()] == [b"", b""]
    with pytest.raises(Exception, match="vocabulary"):
        byte_bpe.decode_ids(spark.createDataFrame([(1, [60_000])], odd.schema), *vocabulary).collect()


def test_vocabulary_needs_all_bytes():
    with pytest.raises(ValueError, match="256 bytes"):
        byte_bpe.Codec([b"a", b"b"], ".")


def test_op12_rows(spark, reference):
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    out = byte_bpe.op12_byte_bpe(spark, SF_SMALL).collect()
    assert len(out) == len(docs)
    for r in out:
        ids = reference.encode_ordinary(docs[r.doc_id])
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (
            len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
            hashlib.sha256(docs[r.doc_id].encode()).hexdigest())


# --- alignment ---------------------------------------------------------------------------------------------------

def brute_alignment(aligner, texts):
    """For each text: the groups as (A's ids, B's ids), or none."""
    out = []
    for t in texts:
        groups = []
        if t:
            a = aligner.a.encode(" " + t, add_special_tokens=False).ids
            b = aligner.b.encode(t)
            raw = (" " + t).encode()
            x, y = [aligner.a_bytes[i] for i in a], [aligner.b_bytes[i] for i in b]
            if b"".join(x) == raw and b"".join(y) == raw:
                a_ends, b_ends = np.cumsum([len(v) for v in x]).tolist(), np.cumsum([len(v) for v in y]).tolist()
                a_at, b_at = ({e: k + 1 for k, e in enumerate(ends)} for ends in (a_ends, b_ends))
                i = j = 0
                for cut in sorted(set(a_ends) & set(b_ends)):
                    p, q = a_at[cut], b_at[cut]
                    groups.append((a[i:p], b[j:q]))
                    i, j = p, q
        out.append(groups)
    return out


def brute_scores(ids, found):
    counts = Counter((a[-1], b[-1]) for groups in found for a, b in groups)
    top = {}
    for (_, b), n in counts.items():
        top[b] = max(n, top.get(b, 0))
    out = Counter()
    for i, groups in zip(ids, found):
        links = [(a[-1], b[-1]) for a, b in groups]
        text = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups)
        out[(i, sum(len(a) for a, _ in groups), sum(len(b) for _, b in groups), len(groups), len(links),
             sum(counts[x] == top[x[1]] for x in links), sum(counts[x] for x in links),
             hashlib.sha256(text.encode()).hexdigest() if text else "")] += 1
    return out


ODD = ["x▁y", "<s> </s><unk> <0x0A> <|endoftext|>", "  a  b \n c\t", "日本語のテスト é\U0001f600", " ", "\n", "▁", "\x00z"]


@pytest.mark.parametrize("piece", [alignment.PIECE, 200])
def test_alignment(spark, docs, none, monkeypatch, piece):
    monkeypatch.setattr(alignment, "PIECE", piece)
    files = alignment.default_files()
    aligner = alignment.Aligner(*files)
    data = [(i, t) for i, t, *_ in rows()] + list(enumerate(ODD, 2000))
    found = brute_alignment(aligner, [t for _, t in data])
    assert not found[len(rows())] and found[len(rows()) + 1]
    odd = frame(spark, [(i, t, "en", "s", 1) for i, t in enumerate(ODD, 2000)])
    out = alignment.link_scores(docs.unionByName(odd), files)
    assert out.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert Counter(map(tuple, out.collect())) == brute_scores([i for i, _ in data], found)
    if piece == 200:
        return
    assert alignment.link_scores(none, files).count() == 0
    each = alignment.align_texts(odd, files).collect()
    assert len(each) == len(ODD)
    for r in each:
        groups = found[len(rows()) + r.doc_id - 2000]
        assert list(zip(r.a_ids, r.a_groups)) == [(i, g) for g, (a, _) in enumerate(groups) for i in a]
        assert list(zip(r.b_ids, r.b_groups)) == [(i, g) for g, (_, b) in enumerate(groups) for i in b]


def test_pointer_jumping_labels_chains():
    """Tokens that overlap each other alternately hang together in one group, however long the chain."""
    n = 5000
    a_end, b_end = np.arange(2, 2 * n + 2, 2), np.append(np.arange(1, 2 * n, 2), 2 * n)
    x = alignment.Alignment(np.arange(n, dtype=np.int32), np.arange(n + 1, dtype=np.int32), a_end, b_end)
    assert set(x.a_group) == set(x.b_group) == {0} and x.links.tolist() == [(n - 1) << 32 | n]
    r = random.Random(2)
    for _ in range(200):
        total = r.randrange(1, 40)
        ends = [np.array(sorted({*r.sample(range(1, total + 1), r.randrange(1, total + 1)), total})) for _ in "ab"]
        x = alignment.Alignment(*[np.arange(len(e), dtype=np.int32) for e in ends], *ends)
        cuts = np.array(sorted(set(ends[0]) & set(ends[1])))
        for group, e in zip((x.a_group, x.b_group), ends):
            assert group.tolist() == np.searchsorted(cuts, e, "left").tolist()
        assert len(x.links) == len(cuts)


def test_op13_rows(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()
    aligner = alignment.Aligner(*alignment.default_files())
    expected = brute_scores([r.doc_id for r in docs], brute_alignment(aligner, [r.text for r in docs]))
    assert Counter(map(tuple, alignment.op13_alignment(spark, SF_SMALL).collect())) == expected


def test_alignment_rows_stay_small(spark):
    """A written row holds about SLICE_BYTES of text, however many documents an Arrow batch has."""
    docs = spark.createDataFrame([(i, f"some words {i} " * 12_000) for i in range(12)], "doc_id long, text string") \
        .coalesce(1)
    got = alignment._batches(docs, alignment.default_files()).select("batch", "doc_id").collect()
    size = {r.doc_id: len(r.text) for r in docs.collect()}
    assert sorted(d for r in got for d in r.doc_id) == list(range(12))
    assert len({r.batch for r in got}) == len(got)
    assert all(sum(size[d] for d in r.doc_id) <= alignment.SLICE_BYTES for r in got)


def test_aligner_remembers_words_of_both_tokenizers(monkeypatch):
    """Words met before go to neither tokenizer again, and ids by words are those of whole texts."""
    aligner = alignment.Aligner(*alignment.default_files())
    r = random.Random(7)
    parts = [*"aé日😀▁'", "'s", "don't", "x.\ny", "\u00a0", "\x1c", "\u3000", "\t", "\n", "12,5", "<s>", "Ġ", "w" * 70]
    texts = ["".join(r.choice([*parts, " ", " ", " "]) for _ in range(r.randrange(1, 30))) for _ in range(1500)]
    texts += [" ".join(r.choice(parts) for _ in range(r.randrange(1, 30))) for _ in range(500)]
    texts += [" ".join(f"w{r.randrange(3000)}" for _ in range(40)) for _ in range(300)] + ODD
    for bound in (alignment.MEMO_BYTES, 100_000):
        monkeypatch.setattr(alignment, "MEMO_BYTES", bound)
        for _ in range(2):
            for at in range(0, len(texts), 300):
                some = texts[at:at + 300]
                x, n_a, n_b = aligner.align(some)
                found = brute_alignment(aligner, some)
                assert n_a.tolist() == [sum(len(a) for a, _ in g) for g in found]
                assert x.a.tolist() == [i for g in found for a, _ in g for i in a]
                assert x.b.tolist() == [i for g in found for _, b in g for i in b]
        size = sum(len(w) + len(v) for d in (aligner.known, aligner.old) for w, v in d.items())
        assert size < 2 * bound and not any(len(w) > alignment.LONGEST for w in aligner.known)

    class Counted:
        n = 0

        def __init__(self, inner):
            self.inner = inner

        def encode(self, text, **options):
            Counted.n += 1
            return self.inner.encode(text, **options)

        def encode_batch_fast(self, texts, **options):
            Counted.n += 1
            return self.inner.encode_batch_fast(texts, **options)

    monkeypatch.undo()
    aligner = alignment.Aligner(*alignment.default_files())
    aligner.a, aligner.b = Counted(aligner.a), Counted(aligner.b)
    first, *_ = aligner.align(["one two three's words", "two words"])
    assert 0 < Counted.n <= 2 and len(first.a)
    aligner.align(["words three's two", "one"])
    assert Counted.n <= 2
