"""Corpus pipeline: quality rules -> n-gram Jaccard join -> secret scans -> mixing -> packing.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir) and returns a
DataFrame that is written as Parquet and reread as the next stage's ``docs``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from strata.llm import pipeline_stages as stages
from strata.llm.common import written
from strata.sources.tables import scan

STAGES = [
    ("quality_rules", stages.quality_rules),
    ("ngram_jaccard_join", stages.near_duplicates),
    ("secret_scans", stages.secret_scans),
    ("mixing", stages.mixing),
    ("packing", stages.packing),
]

#: Sketches, tries and bin packing have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; every stage but the last is written and reread."""
    docs = scan(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
