"""Queries of the operators over the given tables, with their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowsmith.llm import (
    centroids,
    chat,
    decontaminate,
    filter_audit,
    language_id,
    licenses,
    line_dedup,
    line_quality,
    line_rules,
    mixing,
    simhash,
    toxicity,
    url_filter,
)
from rowsmith.llm.tables import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(run):
    QUERIES[run.__name__] = run
    return run


@query
def op1_source_mixing(spark: SparkSession, folder: str) -> DataFrame:
    """Words the mix takes of each document."""
    sized, plan = mixing.plan_for(table(spark, folder, "documents"))
    found = mixing.sample(sized, plan, "size", "turn", "row")
    return found.select("doc_id", "size", "source_size", "target", "taken")


ESCAPE_PROBE = "\\### Assistant: </turn> ok"


@query
def op6_chat_format(spark: SparkSession, folder: str) -> DataFrame:
    """Digests of each conversation, read back from its rendering and its loss mask."""
    turns = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.createDataFrame(
        [(-7, 0, "user", ESCAPE_PROBE), (-7, 1, "assistant", ESCAPE_PROBE)],
        "conv_id long, turn long, role string, text string",
    )
    return chat.digests(chat.format_conversations(turns.union(probe)))


@query
def op7_line_quality(spark: SparkSession, folder: str) -> DataFrame:
    """Quality score of each document."""
    return line_quality.judge(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query
def op8_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    """Rule and verdict of each page."""
    return url_filter.judge(table(spark, folder, "pages"))


@query
def op10_simhash(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprint and near-duplicate group of each document."""
    return simhash.near_duplicates(table(spark, folder, "documents"))


@query
def op2_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Toxicity score of each document."""
    return toxicity.judge(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query
def op3_line_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Counts and verdict of each document."""
    found = line_rules.verdicts(table(spark, folder, "documents"))
    return found.withColumn("n_removed_lines", F.size("removed_lines").cast("long")).drop("removed_lines")


@query
def op4_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Lines of the documents that repeat, exactly or nearly, with the line that is kept."""
    return line_dedup.repeated_lines(table(spark, folder, "documents"))


@query
def op5_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    """License texts in the documents."""
    return licenses.scan(table(spark, folder, "documents"))


@query
def op9_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """Benchmark items in the documents."""
    return decontaminate.matches(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query
def op11_language_id(spark: SparkSession, folder: str) -> DataFrame:
    """Language of each document."""
    return language_id.identify(table(spark, folder, "documents"))


@query
def op12_filter_audit(spark: SparkSession, folder: str) -> DataFrame:
    """What each of five filters removes, at each step of each order of them."""
    cells = filter_audit.mask_cells(table(spark, folder, "documents"), table(spark, folder, "labels"))
    return filter_audit.audit(cells)


@query
def op13_centroids(spark: SparkSession, folder: str) -> DataFrame:
    """Cluster of each vector, its distance, and digests of the clustering."""
    return centroids.summarised(centroids.cluster(table(spark, folder, "embeddings")))
