"""Line dedup, near-duplicates, sharding, substring dedup and quality rules against brute force."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from dataprism.llm import line_dedup, minhash, quality_rules, sharding, substring
from dataprism.llm.common import Scratch
from dataprism.llm.components import components
from tests.llm.data import SPACES, frame, lower, rows, words


@pytest.fixture(scope="module")
def docs(spark):
    return frame(spark).cache()


@pytest.fixture(scope="module")
def none(spark):
    return frame(spark, [])


def got(df, *columns):
    return Counter(tuple(r) for r in df.select(*columns).collect())


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_line_dedup(docs, none):
    per, keys = defaultdict(set), {}
    for i, t, *_ in rows():
        for line in (t or "").split("\n"):
            k = keys[line] = lower(line.strip(SPACES))
            if k:
                per[k].add(i)
    bad = {k for k, ids in per.items() if len(ids) >= 10}
    assert bad
    expected = Counter()
    for i, t, *_ in rows():
        lines = (t or "").split("\n")
        rest = [x for x in lines if keys[x] not in bad]
        expected[(i, len(lines), len(lines) - len(rest), sha("\n".join(rest)))] += 1
    out = line_dedup.drop_lines(docs, line_dedup.frequent_lines(docs))
    assert out.columns[:len(docs.columns)] == docs.columns
    assert got(out, "doc_id", "__n_lines", "__n_dropped", F.sha2("__kept", 256)) == expected
    assert line_dedup.drop_lines(none, line_dedup.frequent_lines(none)).count() == 0


def test_line_stage_keeps_columns(spark, docs):
    out = line_dedup.without_frequent_lines(spark, docs, "")
    assert out.schema == docs.schema
    assert out.filter("text IS NULL").count() == 2
    assert out.filter("text IS NOT NULL AND n_chars <> length(text)").count() == 0


def test_line_hits_follow_one_text(spark):
    """An id (null included) that holds many rows gives each row the frequent lines of its own text only."""
    data = [(None if i % 2 else 7, f"line {i % 20}\nown {i}\nline {(i + 1) % 20}") for i in range(40)]
    df = spark.createDataFrame(data, "doc_id long, text string")
    bad = {line_dedup._hash(b"line %d" % i) for i in range(0, 20, 2)}
    frequent = spark.createDataFrame(list(bad), "hi long, lo long")
    assert line_dedup._hits(line_dedup.lines_of(df), frequent).agg(F.max(F.size("__hit"))).first()[0] == 1
    assert got(line_dedup.drop_lines(df, frequent), "doc_id", "__n_dropped", "__kept") == Counter(
        (i, 1, "\n".join(x for x in t.split("\n") if line_dedup._hash(x.encode()) not in bad)) for i, t in data)


def test_line_index_levels(spark):
    index = line_dedup.LineIndex(spark, min_docs=3, fanout=2)
    for batch in range(5):
        data = [(batch * 10 + i, "everywhere\nhere\nonly %d" % batch) for i in range(1 if batch else 2)]
        index.add(spark.createDataFrame(data, "doc_id long, text string"))
        assert all(len(level) < 2 for level in index.levels)
    expected = {line_dedup._hash(b"everywhere"), line_dedup._hash(b"here")}
    assert {tuple(r) for r in index.frequent().collect()} == expected


def test_line_runs_merge_without_exchange(spark, docs):
    """Joining the runs is a merge of sorted buckets: the plan exchanges and sorts the new batch alone."""
    index = line_dedup.LineIndex(spark, min_docs=3, fanout=9)
    plans = []
    run = index._run
    index._run = lambda counted: plans.append(counted) or run(counted)
    for part in range(3):
        index.add(docs.filter(F.pmod("doc_id", F.lit(3)) == part))
    with line_dedup._sorted_buckets(spark):
        plan = plans[2].select("*")._jdf.queryExecution().executedPlan().toString()
    joins = plan.count("SortMergeJoin")
    assert joins == 4 and "Broadcast" not in plan and plan.count("Bucketed: true") == 4
    # One exchange and one sort for each step of the batch's own counting, none above a run's scan.
    assert plan.count("Exchange hashpartitioning") == 2 and plan.count("+- Sort") <= 3, plan


@pytest.mark.parametrize("fanout", [2, 3, 9])
def test_line_index_equals_one_count(docs, fanout):
    lines = line_dedup.lines_of(docs)
    index = line_dedup.LineIndex(docs.sparkSession, min_docs=4, fanout=fanout)
    for part in range(5):
        index.add_lines(lines.filter(F.pmod(F.xxhash64("doc_id"), F.lit(5)) == part))
    expected = got(lines.groupBy("hi", "lo").agg(F.countDistinct(F.coalesce("doc_id", F.lit(-1))).alias("n"))
                   .filter("n >= 4"), "hi", "lo")
    assert expected and got(index.frequent(), "hi", "lo") == expected
    index.close()


def jaccard_components(data, k, percent=80):
    sets = []
    for i, t, *_ in data:
        w = lower(t).encode().split()
        s = {tuple(w[j:j + k]) for j in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())
        sets.append((i, s))
    parent = {i: i for i, _ in sets}

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for x, (i, s) in enumerate(sets):
        for j, t in sets[:x]:
            if None not in (i, j) and s and t and 100 * len(s & t) >= percent * len(s | t):
                a, b = sorted((find(i), find(j)))
                parent[b] = a
    return Counter((i, len(s), find(i), i == find(i)) for i, s in sets)


@pytest.mark.parametrize("k", [2, 5])
def test_near_duplicates(docs, none, k):
    out = minhash.near_duplicates(docs, k=k)
    assert got(out, "doc_id", "n_shingles", "component_id", "kept") == jaccard_components(rows(), k)
    if k == 2:
        assert minhash.near_duplicates(none).count() == 0


def test_near_duplicate_chain(spark):
    """A chain in which each text is near the next only: one component, though the ends share little."""
    base = [f"c{i}" for i in range(60)]
    data = [(50 - i, " ".join(base[3 * i:] + [f"d{i}.{j}" for j in range(0)] + [f"t{j}" for j in range(3 * i)]))
            for i in range(12)]
    df = spark.createDataFrame(data, "doc_id long, text string")
    assert got(minhash.near_duplicates(df, k=1), "doc_id", "n_shingles", "component_id", "kept") \
        == jaccard_components(data, 1)


def test_rare_shingles_of_an_id_with_two_texts(spark):
    """Id 1 has a set of 100 with 10 shared shingles and one of 50 shared ones: the second keeps its own prefix."""
    sets = {(1, 0): range(100), (1, 1): range(1000, 1050), (2, 0): range(1000, 1050), (3, 0): range(90, 190)}
    rows = [(r, np.array(x, np.int64).tobytes()) for (r, _), x in sets.items()]
    members = spark.createDataFrame([(1, 100), (2, 50), (3, 100)], "rep long, n long")
    groups = minhash._rare_groups(members, spark.createDataFrame(rows, "rep long, shingles binary"), 80,
                                  Scratch(spark, "test"))
    assert got(groups, "rep", "token") == Counter((r, t) for r in (1, 2) for t in range(1000, 1011))


def test_components(spark):
    links = [(5, 4), (4, 3), (9, 8), (3, 2), (20, 9), (20, 30), (2, 1)]
    out, _ = components(spark.createDataFrame(links, "a long, b long"), Scratch(spark, "test"))
    assert dict(map(tuple, out.collect())) == {1: 1, 2: 1, 3: 1, 4: 1, 5: 1, 8: 8, 9: 8, 20: 8, 30: 8}


def test_keep_one_keeps_columns(spark, docs):
    out = minhash.keep_one(spark, docs, "")
    kept = {i for i, _, _, k in jaccard_components(rows(), 5) if k}
    assert out.schema == docs.schema
    assert {r[0] for r in out.select("doc_id").collect()} == kept


def test_sharding_laws(docs, none):
    tree = sharding.TREE
    out = sharding.shard_documents(docs, tree, sharding.grow(tree, 40), slot_rows=1).cache()
    data = out.collect()
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in data) == Counter(
        (i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t, *_ in rows())
    slots = defaultdict(list)
    for r in data:
        slots[r.shard].append(r.slot)
        assert 0 <= r.shard < 40 and r.grown_shard in (r.shard, 40) and r.law == "key"
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    assert len({(r.doc_id, r.shard) for r in data}) == len({r.doc_id for r in data})
    assert sharding.shard_documents(none, tree, sharding.grow(tree, 40)).count() == 0


def test_sharding_follows_weights(spark):
    """Shares follow weights; a changed weight moves rows only between its own subtrees and others."""
    n = 20_000
    keys = spark.range(n).select(F.col("id").cast("string").alias("__key"))
    old = sharding.tree(3, 2, 2)
    heavy = sharding.Node("s0", shard=0, own_weight=3.0)
    rack = sharding.Node("g0r0", (heavy, *old.children[0].children[0].children[1:]))
    new = sharding.Node("root", (sharding.Node("g0", (rack, *old.children[0].children[1:])), *old.children[1:]))
    out = sharding.assign(sharding.assign(keys, old, "a"), new, "b").groupBy("a", "b").count().collect()
    share = Counter()
    for r in out:
        share[r.b] += r["count"] / n
        if r.a // 4 != r.b // 4:
            assert r.b // 4 == 0  # another region's rows move only into the region that grew
        elif r.a != r.b:
            assert r.a // 4 == 0 and r.b // 2 == 0  # within it, only into the rack that grew
    assert abs(share[0] - 3 / 14) < 0.02 and abs(share[5] - 1 / 14) < 0.02


def test_substring_dedup(docs, none):
    first = {}
    data = sorted((r for r in rows() if r[0] is not None), key=lambda r: r[0])
    for i, t, *_ in data:
        w = words(t)
        for p in range(len(w) - 12):
            first.setdefault(tuple(w[p:p + 13]), i)
    expected = Counter()
    for i, t, *_ in rows():
        w = words(t)
        keep = [True] * len(w)
        for p in range(len(w) - 12):
            if i is not None and first[tuple(w[p:p + 13])] < i:
                keep[p:p + 13] = [False] * 13
        rest = [x for x, k in zip(w, keep) if k]
        expected[(i, len(w), len(w) - len(rest), hashlib.sha256(b" ".join(rest)).hexdigest())] += 1
    out = substring.remove_repeats(docs)
    assert got(out, "doc_id", "n_words", "n_removed", F.sha2("kept", 256)) == expected
    assert sum(r[2] * c for r, c in expected.items()) > 100
    assert substring.remove_repeats(none).count() == 0


def quality_stats(t):
    w = [x.decode() for x in words(t)]
    lines = [x for x in (t or "").split("\n") if x.strip(SPACES)]
    places = defaultdict(list)
    for p in range(len(w) - 4):
        places[tuple(w[p:p + 5])].append(p)
    covered = {q for v in places.values() if len(v) > 1 for p in v for q in range(p, p + 5)}
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t or ""), len(lines) - len(set(lines)),
            len(covered), len(w) < 10 or 100 * len(covered) > 20 * len(w))


def test_quality_rules(docs, none):
    per, lines = defaultdict(set), {}
    for i, t, _, s, _ in rows():
        lines[t] = Counter(k for x in (t or "").split("\n") if (k := " ".join(lower(x).split())))
        for k in lines[t]:
            per[s, k].add(i)
    expected = Counter()
    for i, t, _, s, _ in rows():
        stats = quality_stats(t)
        lost = sum(n * len(k.split(" ")) for k, n in lines[t].items() if len(per[s, k]) >= 3)
        expected[(i, *stats, not stats[-1] and stats[0] - lost >= 0.5 * stats[0], lost)] += 1
    assert any(r[-1] for r in expected)
    out = quality_rules.quality_rules(docs, min_docs=3, min_rest=0.5)
    assert got(out, "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
               "kept", "n_common_words") == expected
    assert quality_rules.quality_rules(none).count() == 0


def test_depleted_documents_are_rejected(spark):
    """Documents that the base rules keep and whose words are mostly in lines that many documents of their host have;
    copies under other ids count, rows of one id don't, and the size of the host doesn't matter."""
    menu = [" ".join(f"menu{j}.{k}" for k in range(6)) for j in range(5)]

    def text(i):
        return "\n".join([*menu, " ".join(f"own{i}.{k}" for k in range(5 if i % 2 else 40))])

    data = [(i, text(i), "site") for i in range(19)] + [(100 + i, text(3), "site") for i in range(2)]
    data += [(1000, text(1000 + i), "one id") for i in range(40)]
    data += [(2000 + i, " ".join(f"word{i}.{k}" for k in range(30)), "site") for i in range(300)]
    df = spark.createDataFrame(data, "doc_id long, text string, source string")
    out = {(r.doc_id, r.host): r for r in quality_rules.quality_rules(df).collect()}
    rejected = {i for (i, _), r in out.items() if not r.kept}
    assert rejected == {i for i in range(19) if i % 2} | {100, 101} and not any(r.base_failed for r in out.values())
    assert out[4, "site"].n_common_words == 30 and out[1000, "one id"].n_common_words == 0


def test_quality_rules_are_native(docs):
    plan = quality_rules.quality_rules(docs)._jdf.queryExecution().toString()
    plan += sharding.shard_documents(docs, sharding.TREE, sharding.grow(sharding.TREE, 40)) \
        ._jdf.queryExecution().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow", "RDDScan"))


def test_quality_stage_keeps_columns(spark, docs):
    out = quality_rules.keep_clean(spark, docs, "")
    assert out.schema == docs.schema
    assert got(out, "doc_id", "text") == Counter((i, t) for i, t, *_ in rows() if not quality_stats(t)[-1])


def test_quality_stage_removes_common_lines(spark):
    """Lines that are equal only after white space and case are made alike go, wherever a kept document holds them."""
    def own(i):
        return [" ".join(f"own{i}.{j}.{k}" for k in range(8)) for j in range(2)]

    spelled = ["Visit  our \tÉCOLE", " visit our école ", "Visit our École"]
    data = [(i, "\n".join([spelled[i % 3], *own(i)[:1], "", *own(i)[1:], spelled[(i + 1) % 3]]), "h") for i in range(24)]
    data += [(100, data[0][1], "h"), (101, data[0][1], "other"), (102, "short", "h"), (103, None, "h"),
             (104, "\n".join(own(104) + own(104)[:1]), None),
             (105, "\n".join([spelled[0]] * 8 + ["left over words"]), "h")]
    df = spark.createDataFrame([(i, t, s, len(t or "")) for i, t, s in data],
                               "doc_id long, text string, source string, n_chars int")
    out = quality_rules.keep_clean(spark, df, "")
    assert out.schema == df.schema
    expected = Counter()
    for i, t, s in data:
        if i < 24 or i == 100:
            t = "\n".join(x for x in t.split("\n") if x not in spelled)
        if i not in (102, 103, 104, 105):
            expected[i, t, s, len(t)] += 1
    assert got(out, "doc_id", "text", "source", "n_chars") == expected
    assert not any(word in out._jdf.queryExecution().toString() for word in ("Python", "Pandas", "Arrow", "RDDScan\n"))


def test_links_between_components():
    """Within one block and between two, the links found join exactly the components that any link joins."""
    import random

    import numpy as np
    import pyarrow as pa

    from dataprism.llm.common import mix
    from dataprism.llm.minhash import _links_between, minima

    r = random.Random(0)
    for _ in range(150):
        n, two = r.randrange(2, 40), r.random() < 0.5
        sets = []
        for _ in range(n):
            if sets and r.random() < 0.6:
                s = set(r.choice(sets))
                for _ in range(r.randrange(12)):
                    s.add(r.randrange(10**6))
                    if len(s) > 3 and r.random() < 0.5:
                        s.discard(r.choice(sorted(s)))
            else:
                s = {r.randrange(10**6) for _ in range(r.randrange(3, 60))}
            sets.append(s)
        component = [r.randrange(n) if r.random() < 0.3 else i for i in range(n)]
        own = [r.randrange(2) if two else 0 for _ in range(n)]
        arrays = [np.array(sorted(s), np.uint64) for s in sets]
        sig = (mix(minima([mix(a) for a in arrays])) & np.uint64(255)).astype(np.uint8)
        out = _links_between(pa.table({
            "i": [0] * n, "j": [int(two)] * n, "own": own, "rep": list(range(n)), "component": component,
            "shingles": [a.tobytes() for a in arrays], "sig": [x.tobytes() for x in sig]}), 80)
        links = {(i, j) for i in range(n) for j in range(i) if (not two or own[i] != own[j])
                 and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])}
        found = set(zip(out["a"].to_pylist(), out["b"].to_pylist()))
        assert found <= links

        def joined(edges, n=n, component=component):
            parent = list(range(n))

            def find(x):
                while parent[x] != x:
                    x = parent[x]
                return x

            first = {}
            for a, b in [*((i, first.setdefault(component[i], i)) for i in range(n)), *edges]:
                a, b = find(a), find(b)
                parent[max(a, b)] = min(a, b)
            return [find(i) for i in range(n)]

        assert joined(found) == joined(links)


def test_near_duplicates_in_blocks(docs, monkeypatch):
    """Clusters dealt out as blocks against blocks give the same components."""
    monkeypatch.setattr(minhash, "CLUSTER_ROWS", 2)
    out = minhash.near_duplicates(docs, k=2)
    assert got(out, "doc_id", "n_shingles", "component_id", "kept") == jaccard_components(rows(), 2)


def test_phrase_automaton_writes_a_word_in_two_symbols():
    """A shard's words have at most two symbols each, whatever their number; unknown words match nothing."""
    r = random.Random(4)
    vocabulary = [b"w%d" % i for i in range(substring.SHARD_WORDS)]
    texts = [b" ".join(vocabulary[i:i + 100]) for i in range(0, len(vocabulary), 100)]
    auto = substring.PhraseAutomaton(list(enumerate(texts)))
    assert auto.digits == 2
    for _ in range(50):
        at, n = r.randrange(80), r.randrange(13, 21)
        words_ = texts[7].split()[at:at + n]
        got = auto.covered(1000, b"new " + b" ".join(words_) + b" w1 other")
        assert got == ([(1, 1 + len(words_))] if len(words_) >= 13 else [])
    assert auto.covered(7, texts[7]) == [] and auto.covered(8, texts[7]) == [(0, 100)]


def test_phrase_automaton_is_small_and_exact():
    """An automaton has a few nodes for a word of the passages, not one for each word of each window; words that look
    alike to it, and windows that open alike, are told apart."""
    r = random.Random(4)
    vocabulary = [b"v%d" % i for i in range(3000)]
    texts = [b" ".join(r.choices(vocabulary, k=100)) for _ in range(60)]
    auto = substring.PhraseAutomaton(list(enumerate(texts)))
    assert auto.automaton.get_stats()["nodes_count"] < 8 * 60 * 100

    # Few words, of which many share a symbol, so windows open alike and differ by one word.
    few = [b"w%d" % i for i in range(300)]
    passages, owner_of = [], {}
    base = r.choices(few, k=30)
    for owner in range(40):
        w = list(base)
        for _ in range(2):
            w[r.randrange(len(w))] = r.choice(few)
        new = [p for p in range(len(w) - 12) if tuple(w[p:p + 13]) not in owner_of]
        for first, last in substring._runs(np.array(new), 1):
            passages.append((owner, b" ".join(w[first:last + 13])))
        owner_of.update({tuple(w[p:p + 13]): owner for p in new})
    auto = substring.PhraseAutomaton(passages)
    hits = 0
    for _ in range(600):
        w = list(base) * 2
        for _ in range(r.randrange(5)):
            w[r.randrange(len(w))] = r.choice([*few, b"unseen", "é　".encode()])
        doc_id = r.randrange(45)
        expected = {q for p in range(len(w) - 12) if owner_of.get(tuple(w[p:p + 13]), doc_id) < doc_id
                    for q in range(p, p + 13)}
        spans = auto.covered(doc_id, b" ".join(w))
        assert {q for a, b in spans for q in range(a, b)} == expected
        hits += bool(expected)
    assert hits > 100
    assert auto.covered(9, b"") == []
