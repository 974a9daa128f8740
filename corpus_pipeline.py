"""The corpus pipeline: raw documents to piece ids, each stage one of the operators of ``dataprism.llm``.

A stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read again as the next
stage's docs, so a lost executor costs at most tasks of the running stage. All stages but the last keep the columns of
documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from dataprism.llm.common import Scratch, documents
from dataprism.llm.decontaminate import drop_contaminated
from dataprism.llm.line_dedup import without_frequent_lines
from dataprism.llm.minhash import keep_one
from dataprism.llm.quality_rules import keep_clean
from dataprism.llm.sentencepiece_ac import encode_stage

STAGES = [
    ("quality_rules", keep_clean),
    ("line_dedup", without_frequent_lines),
    ("near_duplicates", keep_one),
    ("decontamination", drop_contaminated),
    ("sentencepiece", encode_stage),
]

# Tiling, near-duplicate components and piece segmentation have no SQL form; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    scratch = Scratch(spark, "pipeline")
    docs, path = documents(spark, sf_dir), None
    for _, stage in STAGES[:-1]:
        docs, after = scratch.write(stage(spark, docs, sf_dir))
        if path:
            scratch.drop(path)
        path = after
    return STAGES[-1][1](spark, docs, sf_dir)
