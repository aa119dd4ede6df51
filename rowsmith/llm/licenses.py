"""License scan: MinHash bands over overlapping text windows, then exact containment.

Templates are cut into segments of at most ``SEGMENT`` shingles. A window has twice as many
and starts every ``SEGMENT`` shingles, so every segment lies whole in some window, and the
similarity of the two sets is at least 1 / (2 * SEGMENT). A band is the smallest shingle under
one permutation; with ``BANDS`` bands a segment of one shingle meets its window in at least one
band with the probability that ``guarantee`` gives, a longer one almost surely. What the bands
retrieve is verified by containment of the template's shingles in the text around the window.

All of it is DataFrame expressions; the templates are a bounded list and are broadcast.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowsmith.llm.license_templates import TEMPLATES
from rowsmith.llm.shingles import is_contained, permutations, with_shingles
from rowsmith.llm.tables import Scratch, quoted

SEGMENT = 4
WINDOW = 2 * SEGMENT
BANDS = 48
MAX_TEMPLATE_CHARS = 1_000_000


def guarantee(bands: int = BANDS, shingles: int = 1) -> float:
    """Probability that a segment meets the window that holds it in one band or more."""
    return 1 - (1 - shingles / WINDOW) ** bands


def template_table(spark, templates: Mapping[str, str] = TEMPLATES) -> DataFrame:
    """(license, n, template, key): distinct shingles of a template, a row per segment and band."""
    if sum(map(len, templates.values())) > MAX_TEMPLATE_CHARS:
        raise ValueError("the templates are too large to broadcast")
    rows = spark.createDataFrame(list(templates.items()), "license string, text string")
    sets = with_shingles(rows, F.col("text"))
    starts = F.sequence(F.lit(0), F.greatest(F.size("shingles") - 1, F.lit(0)), F.lit(SEGMENT))
    segments = F.transform(starts, lambda s: F.slice("shingles", s + 1, SEGMENT))
    constants = F.array(*[F.lit(c) for c in permutations(BANDS)])
    minima = F.transform(
        constants, lambda c: F.array_min(F.transform("segment", lambda x: x.bitwiseXOR(c)))
    )
    return (
        sets.select("license", F.array_distinct("shingles").alias("template"), F.explode(segments).alias("segment"))
        .select("license", "template", F.size("template").alias("n"), F.explode(minima).alias("key"))
        .filter("n > 0")
        .distinct()
    )


def scan(
    docs: DataFrame,
    templates: Mapping[str, str] = TEMPLATES,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """(doc_id, license, n_shingles, matched) of documents that hold a license text.

    A license is found where at least 4/5 of the distinct five-word shingles of its template
    lie close together; words are lower-cased runs of letters and digits. Null texts, texts
    without words and templates without words match nothing. Rows that share an id give one
    row with their best match.
    """
    spark = docs.sparkSession
    known, _ = Scratch(spark).write(template_table(spark, templates), "license_bands")
    plain = docs.select(quoted(doc_id).alias("doc_id"), quoted(text).alias("text"))
    windows = with_shingles(plain, F.col("text")).select(
        "doc_id",
        "shingles",
        F.explode_outer(F.sequence(F.lit(0), F.greatest(F.size("shingles") - 1, F.lit(0)), F.lit(SEGMENT))).alias("start"),
    )
    inside = [F.get("shingles", F.col("start") + i).alias(f"s{i}") for i in range(WINDOW)]
    constants = F.array(*[F.lit(c) for c in permutations(BANDS)])
    # One constant per band; a band's smallest shingle is compared as it is under the constant.
    bands = windows.select("doc_id", "shingles", "start", *inside, F.explode(constants).alias("c"))
    smallest = F.least(*[F.col(f"s{i}").bitwiseXOR(F.col("c")) for i in range(WINDOW)])
    hits = bands.withColumn("band", smallest).join(F.broadcast(known), F.col("band") == F.col("key"))
    # An occurrence that meets the window ends at most a template's length away from it.
    low = F.greatest(F.col("start") - F.col("n"), F.lit(0))
    around = F.slice("shingles", low + 1, F.col("start") - low + WINDOW + F.col("n"))
    checked = hits.select(
        "doc_id", "license", F.col("n").alias("n_shingles"),
        F.size(F.array_intersect("template", around)).alias("matched"),
    )
    return (
        checked.filter(is_contained(F.col("matched"), F.col("n_shingles")))
        .groupBy("doc_id", "license")
        .agg(F.max("n_shingles").cast("long").alias("n_shingles"), F.max("matched").cast("long").alias("matched"))
    )
