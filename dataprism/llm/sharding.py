"""Sharding by a hierarchical weighted hash tree (regions, racks, shards), in DataFrame expressions only.

A row descends the tree: at each level every child draws ``-ln(u) / weight`` from a hash of the level, the child's
name and the row's ``doc_id``, and the smallest draw wins. A child's share is its part of the weights. When a weight
changes, only draws of that child change, so rows move only into or out of the subtrees whose weights changed; a new
subtree takes rows only into itself. ``grow`` adds a shard as a subtree of its own and so keeps every other row where
it is.

Defined results: a null ``doc_id`` is a key of its own; a null text has no bytes (size 16) and the CRC of the empty
string; equal ``doc_id``s share a shard; repeated rows get slots of their own; an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dataprism.llm.common import documents

DRAW_BITS = 52
SLOT_ROWS = 100_000


@dataclass(frozen=True)
class Node:
    """A subtree: ``children`` for regions and racks, ``shard`` for a leaf."""

    name: str
    children: tuple[Node, ...] = ()
    shard: int | None = None
    own_weight: float = 1.0

    @property
    def weight(self) -> float:
        return sum(c.weight for c in self.children) if self.children else self.own_weight


def tree(regions: int, racks: int, shards: int) -> Node:
    """An even tree; shard numbers run through it from 0."""
    return Node("root", tuple(
        Node(f"g{g}", tuple(
            Node(f"g{g}r{r}", tuple(
                Node(f"s{n}", shard=n) for s in range(shards) for n in [(g * racks + r) * shards + s]))
            for r in range(racks)))
        for g in range(regions)))


def grow(root: Node, shard: int, weight: float = 1.0) -> Node:
    """The tree with one more shard, in a region and rack of its own."""
    leaf = Node(f"s{shard}", shard=shard, own_weight=weight)
    return Node(root.name, (*root.children, Node(f"x{shard}", (Node(f"x{shard}r0", (leaf,)),))))


def hash52(text: Column) -> Column:
    """The first 52 bits of a text's MD5, as a number."""
    return F.conv(F.substring(F.md5(text), 1, DRAW_BITS // 4), 16, 10).cast("long")


def _level(parents: Sequence[Node], position: Column, key: Column) -> Column:
    """Of the children of the parent at ``position``, the one with the smallest draw: its place among all children
    of this level's parents, or its shard number where the children are leaves."""
    tables, place = [], 0
    for parent in parents:
        rows = []
        for child in parent.children:
            target = place if child.children else child.shard
            rows.append(F.struct(F.lit(child.name).alias("name"), F.lit(float(child.weight)).alias("weight"),
                                 F.lit(target).alias("to")))
            place += 1
        tables.append(F.array(*rows))
    draws = F.transform(F.get(F.array(*tables), position), lambda c: F.struct(
        (-F.log((hash52(F.concat_ws("/", c["name"], key)) + 0.5) / 2.0**DRAW_BITS) / c["weight"]).alias("draw"),
        c["to"].alias("to")))
    return F.array_min(draws)["to"]


def assign(df: DataFrame, root: Node, column: str, key: str = "__key") -> DataFrame:
    """``df`` with the shard of each row: a projection, no shuffle. Each level draws among the children of the
    subtree that the level above chose, so a row costs the sum of the fan-outs, not the number of shards."""
    parents, at = [root], F.lit(0)
    while parents[0].children:
        df = df.withColumn(column, _level(parents, at, F.col(key)))
        at, parents = F.col(column), [c for p in parents for c in p.children]
    return df


def shard_documents(docs: DataFrame, root: Node, grown: Node, slot_rows: int = SLOT_ROWS) -> DataFrame:
    """The placement of every row: size, checksum, shard, slot in the shard, and shard in the grown tree.

    Only these narrow columns are shuffled, never texts. Slots follow a hash of the row: a shard's rows are split by
    ranges of that hash into buckets of about ``slot_rows`` rows, each numbered by itself and shifted by the sizes of
    the buckets before it, so that no task holds a shard. Equal rows of one input partition are counted before the
    shuffle and numbered together.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(
        F.col("doc_id"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null")).alias("__key"),
        (F.octet_length(text) + 16).cast("long").alias("size"), F.crc32(text).cast("long").alias("text_crc32"))
    n = rows.count()
    buckets = max(1, n // (len(_leaves(root)) * slot_rows))
    rows = assign(assign(rows, root, "shard"), grown, "grown_shard")
    order = F.concat_ws("/", "__key", "size", "text_crc32")
    rows = rows.withColumn("__order", hash52(order)).withColumn("__part", F.spark_partition_id())
    bucket = F.floor(F.col("__order") / 2.0**DRAW_BITS * buckets).cast("int")
    rows = rows.withColumn("__bucket", bucket)
    same = rows.groupBy("shard", "__bucket", "__order", "doc_id", "size", "text_crc32", "grown_shard", "__part") \
        .agg(F.count(F.lit(1)).alias("__n")).repartition(F.col("shard"), F.col("__bucket"))
    sizes = rows.groupBy("shard", "__bucket").agg(F.count(F.lit(1)).alias("__rows"))
    before = sizes.selectExpr(
        "shard", "__bucket",
        "coalesce(sum(__rows) over (partition by shard order by __bucket"
        " rows between unbounded preceding and 1 preceding), 0) as __before")
    numbered = same.selectExpr(
        "*", "coalesce(sum(__n) over (partition by shard, __bucket order by __order, doc_id, size, text_crc32, __part"
        " rows between unbounded preceding and 1 preceding), 0) as __first")
    out = numbered.join(before, ["shard", "__bucket"])
    out = out.withColumn("__i", F.explode(F.sequence(F.lit(0).cast("long"), F.col("__n") - 1)))
    return out.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard",
                      (F.col("__before") + F.col("__first") + F.col("__i")).cast("long").alias("slot"), "grown_shard")


def _leaves(node: Node) -> list[Node]:
    return [x for c in node.children for x in _leaves(c)] if node.children else [node]


TREE = tree(4, 2, 5)


def op8_shard_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(documents(spark, sf_dir), TREE, grow(TREE, 40))


def _sql_winner(children: Sequence[Node]) -> str:
    draws = ", ".join(
        f"{{'d': -ln((('0x' || substr(md5(concat_ws('/', '{c.name}', k)), 1, 13))::BIGINT + 0.5) / 4503599627370496.0)"
        f" / {float(c.weight)}, 'i': {i}}}" for i, c in enumerate(children))
    return f"(list_min([{draws}])).i"


def _sql_shard(root: Node, name: str) -> str:
    """A subquery body that adds column ``name`` to the rows it reads from."""
    rack = " ".join(f"WHEN {i} THEN {_sql_winner(g.children) if len(g.children) > 1 else 0}"
                    for i, g in enumerate(root.children))
    leaf = " ".join(
        f"WHEN {i * 100 + j} THEN list_extract([{', '.join(str(z.shard) for z in r.children)}],"
        f" 1 + {_sql_winner(r.children) if len(r.children) > 1 else 0})"
        for i, g in enumerate(root.children) for j, r in enumerate(g.children))
    return (f"SELECT * EXCLUDE (g, r), CAST(CASE g * 100 + r {leaf} END AS INTEGER) AS {name} FROM"
            f" (SELECT *, CASE g {rack} END AS r FROM (SELECT *, {_sql_winner(root.children)} AS g FROM")


ORACLE = f"""
WITH crc_table AS (
  SELECT list(v ORDER BY i) AS t FROM (
    SELECT i, list_reduce(list_prepend(i, [x::BIGINT for x in range(8)]),
      lambda c, s: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END) AS v
    FROM (SELECT unnest(range(256)) AS i))),
sized AS (
  SELECT doc_id, coalesce(doc_id::VARCHAR, 'null') AS k, octet_length(encode(coalesce(text, ''))) + 16 AS size,
    xor(list_reduce(list_prepend(4294967295::BIGINT,
      [('0x' || h)::BIGINT for h in regexp_extract_all(hex(encode(coalesce(text, ''))), '..')]),
      lambda c, b: xor(c // 256, t[1 + (xor(c, b) & 255)])), 4294967295) AS text_crc32
  FROM documents, crc_table),
a AS ({_sql_shard(TREE, 'shard')} sized))),
b AS ({_sql_shard(grow(TREE, 40), 'grown_shard')} a)))
SELECT doc_id, size::BIGINT AS size, text_crc32::BIGINT AS text_crc32, 'key' AS law, shard,
  row_number() OVER (PARTITION BY shard ORDER BY
    ('0x' || substr(md5(concat_ws('/', k, size, text_crc32)), 1, 13))::BIGINT, doc_id, size, text_crc32) - 1 AS slot,
  grown_shard
FROM b
"""
