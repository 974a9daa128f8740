"""Small documents with every hard case, and the brute-force results they are held against."""

import random

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, "
          # names that the operators use themselves or return
          "kept string, n_words string, score string, shard int, component_id string, `a.b` string, __in0 string, "
          "h string, t string, rep string, hi string, lo string, n string, bands string, word string")
EXTRA = ("k", "w", "s", 7, "c", "dotted", "in0", "h", "t", "r", "hi", "lo", "n", "b", "w")


def texts(seed=1, n=60):
    """Random texts over a small vocabulary with copies, near copies, shared lines and shared passages."""
    r = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)] + ["École", "naïve", "日本", "UPPER", "x" * 70, "a-b,", "%%", "#"]
    passage = " ".join(r.choice(vocabulary) for _ in range(60))
    line = "Shared  line of\tthe site"
    out = []
    for i in range(n):
        words = [r.choice(vocabulary) for _ in range(r.randrange(1, 120))]
        t = " ".join(words)
        if i % 5 == 1:
            t = t + " " + passage
        if i % 4 == 2:
            t = f"  {line.upper() if i % 8 == 2 else line} \n{t}\n\n{line}"
        if i % 9 == 3 and out:
            t = out[r.randrange(len(out))][0]
        if i % 11 == 4 and out:
            other = out[r.randrange(len(out))][0].split(" ")
            if len(other) > 30:
                other[len(other) // 2] = "changed"
            t = " ".join(other)
        out.append((t, f"s{i % 3}"))
    return out


def rows(seed=1):
    """(doc_id, text, lang, source, n_chars, extras): ids shuffled against the order of texts."""
    made = texts(seed)
    ids = list(range(100, 100 + len(made)))
    random.Random(seed).shuffle(ids)
    out = [(i, t, "en", s, len(t)) for i, (t, s) in zip(ids, made)]
    long_text = " ".join(f"v{i * 7 % 5003}" for i in range(30_000))
    out += [
        (1, None, None, None, None), (2, "", "en", "s0", 0), (3, " \n\t ", "de", None, 4), (4, "one", "en", "s1", 3),
        (5, "One", "en", "s1", 3), (6, "a a a a a a a a a a a a a a a a a a a a", "en", "s1", 39),
        (7, long_text, "en", "s2", len(long_text)), (8, "\n".join(["same line here"] * 40), "fr", "s2", 599),
        (9, "y" * 3000, "en", "s0", 3000), (10, "tab\x0bvt\x0cff\rcr nbsp\xa0joined", "en", "s0", 22),
        (100, made[0][0], "en", "s0", 1), (100, made[0][0], "en", "s0", 1), (11, made[1][0], "en", "s1", 1),
        (12, made[1][0], "en", "s1", 1), (None, made[2][0], "en", "s1", 1), (None, None, None, None, None),
    ]
    return out


def frame(spark, data=None):
    data = rows() if data is None else data
    return spark.createDataFrame([(*r, *EXTRA) for r in data], SCHEMA).repartition(3)


SPACES = " \t\n\x0b\x0c\r"


def words(text):
    return (text or "").encode().split()


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
