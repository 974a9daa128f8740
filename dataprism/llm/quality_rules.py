"""Quality rules in DataFrame expressions: text statistics and cross-document line frequency per host.

Lines are normalised (white space collapsed and stripped, lower case) and hashed; for each host the distinct documents
that hold a line are counted. A line in ``min_docs`` or more of its host's documents is boilerplate: the limit is a
number, so a large host is judged like a small one. A document whose words outside boilerplate lines are less than
``min_rest`` of all its words is depleted and rejected, as is one that fails the base rules (fewer than 10 words, or
over 20 % of words in repeated five-word windows). ``clean_documents`` removes the boilerplate lines from the texts that
are kept.

Defined results: a null or empty text has no words and fails the base rules; a document is a ``doc_id`` (null ids are
one), so rows that repeat one count once for a line and copies under other ids count each; a null host is a host of its
own; very long texts are split and compared whole, in memory linear in the text; a line at the limit is boilerplate on
all rows that have it; repeated rows get equal results; an empty table gives no rows; other columns, whatever their
names, are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dataprism.llm.common import NOT_SPACE, SPACE, documents, let, plain_extras, same, text_or_empty, words

WINDOW = 5
MIN_DOCS = 20
MIN_REST = 0.20


def repeated_words(word_list: Column, k: int = WINDOW) -> Column:
    """How many words lie in ``k``-word windows that occur twice or more in the text.

    Windows are compared by hash. Texts with a repeated window sort (window, position) pairs: equal neighbours mark
    repeated positions, and the sum of gaps, each at most ``k``, counts the covered words. Linear in memory and
    n log n in time, whatever the text's length.
    """
    def count_covered(windows: Column) -> Column:
        def marked(pairs: Column) -> Column:
            hit = F.filter(pairs, lambda p, i: F.coalesce(p.w == F.get(pairs, i - 1).w, F.lit(False))
                           | F.coalesce(p.w == F.get(pairs, i + 1).w, F.lit(False)))
            return let(F.array_sort(F.transform(hit, lambda p: p.i)), lambda at: F.aggregate(
                F.transform(at, lambda x, i: F.least(F.lit(k), F.coalesce(F.get(at, i + 1) - x, F.lit(k)))),
                F.lit(0).cast("long"), lambda acc, x: acc + x))
        pairs = F.array_sort(F.transform(windows, lambda x, i: F.struct(x.alias("w"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(windows)) < F.size(windows), let(pairs, marked)) \
            .otherwise(F.lit(0).cast("long"))

    def of_hashes(h: Column) -> Column:
        at = F.when(F.size(h) >= k, F.sequence(F.lit(0), F.size(h) - k)).otherwise(F.array().cast("array<int>"))
        windows = F.transform(at, lambda i: F.xxhash64(*[F.get(h, i + j) for j in range(k)]))
        return let(windows, count_covered)

    return let(F.transform(word_list, lambda w: F.xxhash64(w)), of_hashes)


def base_rules(docs: DataFrame, keep: list[str]) -> DataFrame:
    """``keep`` and the text statistics with their verdict; a projection, no shuffle."""
    text = text_or_empty()
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(NOT_SPACE))
    stats = docs.select(*keep, let(words(text), lambda w: F.struct(
        F.size(w).cast("long").alias("n_words"),
        F.aggregate(w, F.lit(0).cast("long"), lambda acc, x: acc + F.length(x)).alias("word_chars"),
        F.regexp_count(text, F.lit("[#*$%&|<>]")).cast("long").alias("n_symbols"),
        let(lines, lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("long")).alias("n_dup_lines"),
        repeated_words(w).alias("n_repeat_words"))).alias("__s"))
    return stats.select(*keep, "__s.*").withColumn(
        "base_failed", (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words")))


def _normalised(line: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(line), SPACE + "+", " "))


def _line_key(norm: Column) -> list[Column]:
    return [F.xxhash64(norm).alias("__l1"), F.xxhash64(F.lit(7), norm).alias("__l2")]


def common_lines(docs: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """(host, line) hashes of the lines in ``min_docs`` or more documents of a host. (line, document) pairs are made
    unique before they are counted, and counted in each task before the shuffle, so a line that a third of all documents
    share arrives as one row a task."""
    lines = F.array_distinct(F.transform(F.split(text_or_empty(), "\n"), _normalised))
    pairs = docs.select(F.col("source").cast("string").alias("__host"), F.col("doc_id").cast("long").alias("__doc"),
                        F.explode(lines).alias("__norm")).filter(F.col("__norm") != "")
    return pairs.select("__host", "__doc", *_line_key(F.col("__norm"))).distinct() \
        .groupBy("__host", "__l1", "__l2").agg(F.count(F.lit(1)).alias("__docs")) \
        .filter(F.col("__docs") >= min_docs)


def line_places(docs: DataFrame) -> DataFrame:
    """One row per (host, line, text): the line's hash, the text's hash, the words of the text in such lines and the
    places of these lines."""
    text = text_or_empty()
    n = F.size(F.split(F.col("__norm"), " ")).cast("long")
    rows = docs.select(F.col("source").cast("string").alias("__host"), *_text_key(text),
                       F.posexplode(F.split(text, "\n")).alias("__at", "__line"))
    rows = rows.select("__host", "__t1", "__t2", "__at", _normalised(F.col("__line")).alias("__norm")) \
        .filter(F.col("__norm") != "")
    rows = rows.select("__host", "__t1", "__t2", "__at", *_line_key(F.col("__norm")), n.alias("__n"))
    # Copies of a text have the same lines at the same places: its first place's rows stand for all of them, and a
    # line repeated within the text counts as often as it has places.
    return rows.groupBy("__host", "__l1", "__l2", "__t1", "__t2").agg(
        F.max("__n").alias("__each"), F.collect_set("__at").alias("__places")) \
        .select("__host", "__l1", "__l2", "__t1", "__t2", (F.col("__each") * F.size("__places")).alias("__n"),
                "__places")


def _text_key(text: Column) -> list[Column]:
    return [F.xxhash64(text).alias("__t1"), F.xxhash64(F.lit(7), text).alias("__t2")]


def quality_rules(docs: DataFrame, min_docs: int = MIN_DOCS, min_rest: float = MIN_REST) -> DataFrame:
    """doc_id, text statistics, base_failed, n_common_words (words in boilerplate lines), kept and common_at (places
    of the boilerplate lines; null without any), for every row. Shuffles hold hashes and counts, never texts."""
    text = text_or_empty()
    lines = line_places(docs)
    common = common_lines(docs, min_docs).select(F.col("__host").alias("__ch"), F.col("__l1").alias("__c1"),
                                                 F.col("__l2").alias("__c2"))
    lost = lines.join(common, (F.col("__l1") == F.col("__c1")) & (F.col("__l2") == F.col("__c2"))
                      & same(F.col("__host"), F.col("__ch"))) \
        .groupBy(F.col("__host").alias("__lh"), F.col("__t1").alias("__x1"), F.col("__t2").alias("__x2")) \
        .agg(F.sum("__n").alias("__lost"), F.flatten(F.collect_list("__places")).alias("__at"))
    base = base_rules(docs.select("doc_id", "text", F.col("source").cast("string").alias("__host"),
                                  *_text_key(text)), ["doc_id", "__host", "__t1", "__t2"])
    out = base.join(lost, (F.col("__t1") == F.col("__x1")) & (F.col("__t2") == F.col("__x2"))
                    & same(F.col("__host"), F.col("__lh")), "left")
    rest = F.col("n_words") - F.coalesce("__lost", F.lit(0))
    return out.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & (rest >= min_rest * F.col("n_words"))).alias("kept"),
        F.coalesce("__lost", F.lit(0)).cast("long").alias("n_common_words"),
        F.col("__host").alias("host"), F.col("__t1").alias("text_hash"), F.col("__t2").alias("text_hash2"),
        F.col("__at").alias("common_at"))


def op10_quality_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(documents(spark, sf_dir)).drop("host", "text_hash", "text_hash2", "common_at")


def without_lines(text: Column, at: Column) -> Column:
    """``text`` without the lines at the places ``at``; linear in the number of lines."""
    def rest(lines: Column) -> Column:
        left = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), at)
        return F.array_join(F.transform(left, lambda i: F.get(lines, i)), "\n")
    return let(F.split(text, "\n"), rest)


def clean_documents(docs: DataFrame, min_docs: int = MIN_DOCS, min_rest: float = MIN_REST) -> DataFrame:
    """The documents that the rules keep, without their boilerplate lines; ``n_chars`` follows a text that changes.

    Verdicts meet the texts once per (host, text), so a row's array of places never exceeds the lines of its text."""
    verdict = quality_rules(docs, min_docs, min_rest).filter(
        ~F.col("kept") | F.col("common_at").isNotNull()).select(
        F.col("host").alias("__h"), F.col("text_hash").alias("__x1"), F.col("text_hash2").alias("__x2"),
        F.col("kept").alias("__kept"), F.array_sort("common_at").alias("__at")).distinct()
    t1, t2 = _text_key(text_or_empty())
    out = docs.join(verdict, (t1 == F.col("__x1")) & (t2 == F.col("__x2"))
                    & same(F.col("source").cast("string"), F.col("__h")), "left") \
        .filter(F.coalesce("__kept", F.lit(True)))
    changed = F.col("__at").isNotNull()
    text = F.when(changed, without_lines(text_or_empty(), F.col("__at"))).otherwise(F.col("text"))
    if "n_chars" in docs.columns:
        n_chars = F.length("__text").cast(docs.schema["n_chars"].dataType)
        out = out.withColumn("__text", text).withColumn("n_chars", F.when(changed, n_chars).otherwise(F.col("n_chars")))
        text = F.col("__text")
    return out.withColumn("text", text).drop("__h", "__x1", "__x2", "__kept", "__at", "__text")


@plain_extras
def keep_clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: the documents that the rules keep, without their boilerplate lines, with their own columns."""
    return clean_documents(docs)


ORACLE = f"""
WITH d AS (SELECT doc_id, source AS host, coalesce(text, '') AS text FROM documents),
w AS (SELECT *, list_filter(regexp_split_to_array(text, '{SPACE}+'), lambda x: x <> '') AS ws,
             list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '{NOT_SPACE}')) AS ls FROM d),
u AS (SELECT text, any_value(ws) AS ws, row_number() OVER () AS k FROM w GROUP BY text),
grams AS (SELECT k, i, hash(ws[i+1], ws[i+2], ws[i+3], ws[i+4], ws[i+5]) AS g
  FROM (SELECT k, ws, unnest(range(len(ws) - 4)) AS i FROM u WHERE len(ws) >= 5)),
rep AS (SELECT k, i, lead(i) OVER (PARTITION BY k ORDER BY i) AS nx FROM (
          SELECT k, i, count(*) OVER (PARTITION BY k, g) AS c FROM grams) WHERE c > 1),
cov AS (SELECT text, n FROM u JOIN (SELECT k, sum(least(5, coalesce(nx - i, 5))) AS n FROM rep GROUP BY 1) USING (k)),
base AS (SELECT doc_id, host, w.text, len(ws) AS n_words,
    coalesce(list_sum([length(x) for x in ws]), 0) AS word_chars,
    length(w.text) - length(regexp_replace(w.text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
    len(ls) - len(list_distinct(ls)) AS n_dup_lines, coalesce(n, 0) AS n_repeat_words
  FROM w LEFT JOIN cov ON w.text = cov.text),
lines AS (SELECT host, text, trim(regexp_replace(lower(l), '{SPACE}+', ' ', 'g'), ' ') AS l
  FROM (SELECT DISTINCT host, text, unnest(string_split(text, chr(10))) AS l, generate_subscripts(string_split(text, chr(10)), 1) AS k FROM d)),
per AS (SELECT host, text, l, count(*) * len(string_split(l, ' ')) AS n FROM lines WHERE l <> '' GROUP BY 1, 2, 3),
held AS (SELECT DISTINCT host, doc_id, trim(regexp_replace(lower(l), '{SPACE}+', ' ', 'g'), ' ') AS l
  FROM (SELECT host, doc_id, unnest(string_split(text, chr(10))) AS l FROM d)),
common AS (SELECT host, l FROM held WHERE l <> '' GROUP BY 1, 2 HAVING count(*) >= {MIN_DOCS}),
lost AS (SELECT per.host, text, sum(n) AS lost FROM per JOIN common ON per.l = common.l
  AND per.host IS NOT DISTINCT FROM common.host GROUP BY 1, 2)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
  n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words,
  (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AS base_failed,
  NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words)
    AND n_words - coalesce(lost, 0) >= {MIN_REST} * n_words AS kept,
  coalesce(lost, 0)::BIGINT AS n_common_words
FROM base LEFT JOIN lost ON base.text = lost.text AND base.host IS NOT DISTINCT FROM lost.host
"""
