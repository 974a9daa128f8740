"""Connected components by alternating large-star and small-star steps on tables of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dataprism.llm.common import Scratch


def _large_star(links: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the smallest of the node and its neighbours."""
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy(F.col("a").alias("m")).agg(F.min("b").alias("least"))
    return both.join(least, F.col("a") == F.col("m")).filter("b > a") \
        .select(F.col("b").alias("a"), F.least("a", "least").alias("b")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, are linked to the smallest of them."""
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy(F.col("a").alias("m")).agg(F.min("b").alias("least"))
    out = down.join(least, F.col("a") == F.col("m"))
    return out.select(F.col("b").alias("a"), F.col("least").alias("b")).filter("a <> b") \
        .unionByName(least.select(F.col("m").alias("a"), F.col("least").alias("b"))).distinct()


def components(links: DataFrame, scratch: Scratch) -> tuple[DataFrame, str]:
    """(node, component) for every node of ``links`` (a, b: integers, a <> b); a component is its smallest node.

    Each step is written to the shared folder, so its lineage stays short; the steps end when all links are stars, which
    no step changes. Every step sends a node one row for each link at most, and its smallest neighbour is found by
    partial minima.
    """
    now, path = scratch.write(_small_star(_large_star(links)))
    while not _all_stars(now):
        after, after_path = scratch.write(_small_star(_large_star(now)))
        scratch.drop(path)
        now, path = after, after_path
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots), path


def _all_stars(links: DataFrame) -> bool:
    """Whether every node is linked to one smaller node that is linked to none."""
    ends = links.select(F.col("a").alias("node"), F.lit(1).alias("up")).unionByName(
        links.select(F.col("b").alias("node"), F.lit(0).alias("up")))
    wrong = ends.groupBy("node").agg(F.sum("up").alias("ups"), F.min("up").alias("least")) \
        .filter("ups > 1 OR (ups = 1 AND least = 0)")
    return wrong.isEmpty()
