"""Corpus pipeline: toxicity, line dedup, SimHash near-dedup, decontamination, mixing.

Each stage takes the documents its predecessor kept and returns documents; the last returns a
row per copy of the mix. What a stage returns is written as Parquet and read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rowsmith.llm import decontaminate, line_dedup, mixing, simhash, toxicity
from rowsmith.llm.tables import Scratch, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not toxic."""
    return toxicity.without_toxic(docs, table(spark, sf_dir, "labels"))


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that repeat an earlier line."""
    return line_dedup.deduplicated(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return simhash.keep_one(docs)


def drop_leaked(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.decontaminated(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The sources mixed to their target weights, a row per copy."""
    return mixing.mix(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", dedup_lines),
    ("simhash_near_dedup", near_dedup),
    ("benchmark_decontamination", drop_leaked),
    ("source_mixing", mix),
]
#: SQL cannot express the trained network, the MinHash and the fingerprints.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    scratch = Scratch(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs, _ = scratch.write(stage(spark, docs, sf_dir), name)
    return docs
