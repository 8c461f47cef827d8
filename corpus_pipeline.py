"""The training-text pipeline: quality rules, exact and near duplicates, source mixture, packing.

Every stage reads all rows its predecessor wrote, takes an empty table, and keeps extra columns whatever their names (but the
last, which returns its own).
"""

from __future__ import annotations

import os
import sys

from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from sluiceway.llm import digest_index, minhash, mixing, packing, quality  # noqa: E402
from sluiceway.llm.graph import store  # noqa: E402
from sluiceway.llm.pipeline_sql import PIPELINE_SQL  # noqa: E402


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the quality rules accept; null, empty and blank texts go, every row is judged on its own."""
    return quality.keep_good(docs)


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each text: the one with the largest doc_id.

    Null and empty texts are equal; rows that repeat both id and text stay or go together.
    """
    index = digest_index.fresh_index(spark)
    kept = digest_index.drop_exact_duplicates(docs, index)
    index.close()
    return kept


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each near-duplicate group: the one with the smallest doc_id.

    Texts without words and rows without an id stay.  Very long texts are hashed in pieces.
    """
    return minhash.drop_near_duplicates(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows repeated so that the sources have their temperature weights; none is left out.

    A null source is a source; texts without words are read once; rows that repeat id and source are read together.
    """
    return mixing.mix(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Batch and slot of every row, also of repeated ones and of those without words."""
    return packing.pack(docs)


STAGES = [
    ("quality_rules", quality_stage),
    ("exact_dedup", exact_stage),
    ("minhash_near_dedup", near_stage),
    ("source_mixing", mixing_stage),
    ("packing", packing_stage),
]

ORACLE_SQL = PIPELINE_SQL


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; each result is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = store(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
