"""The corpus pipeline against a plain version of every stage, on documents with every hard case."""

import random
from collections import Counter, defaultdict

import pyarrow as pa
import pyarrow.parquet as pq

import corpus_pipeline
from dataprism.llm import decontaminate, sentencepiece_ac
from dataprism.llm.common import PLAIN
from tests.llm.data import SPACES, lower, rows, texts
from tests.llm.test_exact_operators import jaccard_components, quality_stats

FOOTER = "All rights reserved  by the Site"


def documents():
    """(doc_id, text, lang, source, n_chars): random texts with copies, near copies, shared lines and passages, a footer
    that 25 documents of a host have, items of the benchmark, and the hard rows."""
    r = random.Random(4)
    out = [(i, t, "en", s, len(t)) for i, (t, s) in enumerate(texts(4, 120), 5000)]
    for i in range(25):
        own = " ".join(f"own{i}.{k}" for k in range(2 if i % 5 == 0 else 30))
        t = "\n".join([FOOTER.upper() if i % 2 else FOOTER, own, "\t" + FOOTER])
        out.append((6000 + i, t, "de", "shop", len(t)))
    for i, (_, item) in enumerate(benchmark()):
        w = (item or "").split()
        at = r.randrange(1 + len(w))
        filler = [f"f{i}.{k}" for k in range(25)]
        t = " ".join([*w[at:], *filler, *w[:at]] if i % 2 else [*filler, *w[:max(1, len(w) // 3)]])
        out.append((7000 + i, t, "fr", "leaks", len(t)))
    return out + rows(9)


def benchmark():
    r = random.Random(6)
    made = [(i, " ".join(f"b{r.randrange(300)}" for _ in range(r.randrange(12, 40)))) for i in range(12)]
    return [*made, (12, "Three short words"), (13, ""), (14, None), (14, made[0][1]), (None, made[1][1])]


def normal(line):
    return " ".join(lower(line).split())


def plain_quality(docs):
    held = defaultdict(set)
    for i, t, _, s, _ in docs:
        for x in (t or "").split("\n"):
            held[s, normal(x)].add(i)
    out = []
    for i, t, lang, s, n in docs:
        n_words, *_, failed = quality_stats(t)
        lines = (t or "").split("\n")
        bad = [bool(normal(x)) and len(held[s, normal(x)]) >= 20 for x in lines]
        lost = sum(len(normal(x).split(" ")) for x, b in zip(lines, bad) if b)
        if failed or n_words - lost < 0.2 * n_words:
            continue
        if any(bad):
            t = "\n".join(x for x, b in zip(lines, bad) if not b)
            n = len(t)
        out.append((i, t, lang, s, n))
    return out


def plain_lines(docs):
    held = defaultdict(set)
    for i, t, *_ in docs:
        for x in (t or "").split("\n"):
            held[lower(x.strip(SPACES))].add(i)
    out = []
    for i, t, lang, s, _ in docs:
        kept = None if t is None else "\n".join(
            x for x in t.split("\n") if not (k := lower(x.strip(SPACES))) or len(held[k]) < 10)
        out.append((i, kept, lang, s, None if kept is None else len(kept)))
    return out


def plain_copies(docs):
    gone = {i for i, _, _, kept in jaccard_components(docs, 5) if not kept and i is not None}
    return [d for d in docs if d[0] not in gone]


def numbers(text, known):
    return [known.setdefault(w, len(known) + 1) for w in (text or "").encode().translate(PLAIN).split()]


def plain_leaks(docs):
    known = {}
    items = [w for _, t in benchmark() if (w := numbers(t, known))]
    out = []
    for d in docs:
        w = numbers(d[1], known)
        covered = [sum(n for n, _, _ in decontaminate.tile(w, item, min(5, len(item)))) / len(item) for item in items]
        if max(covered, default=0) < 0.5:
            out.append(d)
    return out


def test_pipeline_equals_plain_stages(spark, tmp_path):
    docs = documents()
    columns = list(zip(*docs))
    kinds = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64()]
    made = pa.table([pa.array(c, k) for c, k in zip(columns, kinds)], ["doc_id", "text", "lang", "source", "n_chars"])
    # Names that operators use or return themselves.
    for name in ("kept", "hi", "row", "__text", "a.b", "component_id"):
        made = made.append_column(name, pa.array(["x"] * len(docs)))
    pq.write_table(made, tmp_path / "documents.parquet")
    pq.write_table(pa.table({"item_id": pa.array([i for i, _ in benchmark()], pa.int64()),
                             "text": pa.array([t for _, t in benchmark()], pa.string())}), tmp_path / "benchmark.parquet")
    sf_dir = str(tmp_path)
    now = spark.read.parquet(f"{sf_dir}/documents.parquet")
    plain, sizes = docs, [len(docs)]
    for (name, stage), simple in zip(corpus_pipeline.STAGES, (plain_quality, plain_lines, plain_copies, plain_leaks)):
        after, path = stage(spark, now, sf_dir), str(tmp_path / name)
        assert after.schema.names == now.schema.names, name
        after.write.parquet(path)
        now, plain = spark.read.schema(now.schema).parquet(path), simple(plain)
        assert Counter(map(tuple, now.select("doc_id", "text", "lang", "source", "n_chars").collect())) == \
            Counter(plain), name
        sizes.append(len(plain))
    assert all(a > b for a, b in zip(sizes, sizes[1:]) if (a, b) != (sizes[1], sizes[2])), sizes
    enc = sentencepiece_ac.Encoder(sentencepiece_ac.read_pieces())
    expected = Counter((i, tuple(memoryview(enc.encode(t or "")).cast("i").tolist()), True) for i, t, *_ in plain)
    out = corpus_pipeline.run(spark, sf_dir)
    assert Counter((r.doc_id, tuple(r.ids), r.round_trip) for r in out.collect()) == expected


def test_pipeline_of_nothing(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long") \
        .write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
