"""Stages of the corpus pipeline, each one operator applied to all its predecessor kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import ship

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the adaptive quality rules keep."""
    ship(spark)
    from strata.llm.quality_rules import judge, measure
    from strata.llm.common import written

    measured = written(measure(docs.select(*COLUMNS)), "stage-quality")
    return judge(measured).where("kept").select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: the one with the smallest doc_id (of
    rows that share it, one). Documents without words or id stand alone."""
    ship(spark)
    from strata.llm.jaccard_join import keep_one

    return keep_one(docs.select(*COLUMNS))


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, with its secrets masked and ``n_chars`` counted anew."""
    ship(spark)
    from strata.llm.secret_scan import redact

    return (redact(docs.select(*COLUMNS))
            .withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it: ceil(words taken / words) rows."""
    ship(spark)
    from strata.llm.mixing import repeated

    return repeated(docs.select(*COLUMNS)).select(*COLUMNS)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents packed into training sequences."""
    ship(spark)
    from strata.llm.packing import PACKING_LIMITS, digest, pack_documents

    return digest(pack_documents(docs.select("doc_id", "text"), **PACKING_LIMITS))
