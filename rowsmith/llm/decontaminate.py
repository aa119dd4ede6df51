"""Benchmark decontamination: short test items inside long documents.

Containment MinHash. An item is sketched by its smallest shingles under one random order, and a
sketched shingle hits a document if it is among the document's: the chance that all of them miss
depends on the containment alone, however long the document is. Items are partitioned by size;
each partition has as many draws as its items need to be found with ``MIN_RECALL`` at the lowest
accepted containment, which for small items is certainty. Hits are verified by exact containment
of the whole shingle sets. Items of fewer words than a shingle are sought as shingles of their own
length.

The sketches are broadcast in blocks of a measured size. Documents stay where they are; only
verified pairs are shuffled. All of it is DataFrame expressions.
"""

from __future__ import annotations

import math
from functools import cache

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowsmith.llm.shingles import SHARE, SHINGLE_WORDS, broadcast_blocks, is_contained, permutations, shingles, with_shingles, words
from rowsmith.llm.tables import Scratch, numbered, quoted, rows_of

MIN_RECALL = 0.99999
#: Smallest number of shingles of each partition by size.
SIZE_PARTITIONS = (1, 5, 10, 15, 25, 50, 100, 200)


def miss(n: int, draws: int) -> float:
    """Chance that ``draws`` of ``n`` shingles are all among those that a containing text may lack."""
    lacking = n - -(-n * SHARE[0] // SHARE[1])
    return math.comb(lacking, draws) / math.comb(n, draws)


@cache
def draws_for(partition: int) -> int:
    """Draws of the items of a partition: the fewest with which none of its sizes falls below ``MIN_RECALL``."""
    low, high = (*SIZE_PARTITIONS, 20 * SIZE_PARTITIONS[-1])[partition : partition + 2]
    return max(next(m for m in range(1, n + 1) if miss(n, m) <= 1 - MIN_RECALL) for n in range(low, high))


def sketches(items: DataFrame, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """(item_id, k, n, shingles, sketch): distinct shingles of ``k`` words, and those that are drawn.

    ``k`` is the length of a shingle, or that of the item if it has fewer words.
    """
    plain = items.select(quoted(item_id).alias("item_id"), quoted(text).alias("text")).filter("item_id is not null")
    sized = plain.withColumn("k", F.least(F.size(words(F.col("text"))), F.lit(SHINGLE_WORDS)))
    by_length = F.lit(None).cast("array<long>")
    for k in range(1, SHINGLE_WORDS + 1):
        by_length = F.when(F.col("k") == k, shingles(F.col("text"), k)).otherwise(by_length)
    sets = (
        sized.filter("k > 0")
        .select("item_id", "k", F.array_distinct(by_length).alias("shingles"))
        .withColumn("n", F.size("shingles"))
    )
    order = F.lit(permutations(1)[0])
    mixed = F.array_sort(F.transform("shingles", lambda x: x.bitwiseXOR(order)))
    draws = F.lit(0)
    for partition, smallest in enumerate(SIZE_PARTITIONS):
        draws = F.when(F.col("n") >= smallest, draws_for(partition)).otherwise(draws)
    return sets.withColumn("sketch", F.transform(F.slice(mixed, 1, draws), lambda x: x.bitwiseXOR(order)))


def _pairs(docs: DataFrame, items: DataFrame, doc_id: str, text: str, item_id: str, item_text: str) -> DataFrame:
    """(doc_id, item_id, n_shingles, matched, whole) per verified hit; whole: the item is all of the text."""
    known, _ = Scratch(docs.sparkSession).write(sketches(items, item_id, item_text), "item_sketches")
    plain = docs.select(quoted(doc_id).alias("doc_id"), quoted(text).alias("text"))
    longs = F.size("sketch") * (F.col("n") + 2)
    found = None
    for k in sorted(r["k"] for r in known.select("k").distinct().collect()) or [SHINGLE_WORDS]:
        each = with_shingles(plain, F.col("text"), k=k).select(
            "doc_id", "shingles", F.explode_outer("shingles").alias("shingle")
        )
        for block in broadcast_blocks(known.filter(F.col("k") == k), longs, "item_id"):
            drawn = block.select("item_id", "n", F.col("shingles").alias("item"), F.explode("sketch").alias("drawn"))
            hits = each.join(F.broadcast(drawn), F.col("shingle") == F.col("drawn"))
            large_enough = is_contained(F.size("shingles"), F.col("n"))
            checked = hits.filter(large_enough).select(
                "doc_id", "item_id", F.col("n").alias("n_shingles"),
                F.size(F.array_intersect("item", "shingles")).alias("matched"),
                (F.size("shingles") == 1).alias("whole") if k < SHINGLE_WORDS else F.lit(True).alias("whole"),
            )
            pairs = checked.filter(is_contained(F.col("matched"), F.col("n_shingles")))
            found = pairs if found is None else found.union(pairs)
    return found


def matches(
    docs: DataFrame,
    items: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """(doc_id, item_id, n_shingles, matched) of documents that contain an item.

    An item is contained if the document has at least 4/5 of its distinct five-word shingles;
    words are lower-cased runs of letters and digits. An item of fewer words is one shingle of its
    own length, found wherever these words follow each other. Null texts and texts without words
    contain nothing and are in nothing; items without an id are left out. Rows that share an id
    give one row with their best match; documents without an id share a row without an id.
    """
    found = _pairs(docs, items, doc_id, text, item_id, item_text)
    return found.groupBy("doc_id", "item_id").agg(
        F.max("n_shingles").cast("long").alias("n_shingles"), F.max("matched").cast("long").alias("matched")
    )


def decontaminated(
    docs: DataFrame,
    items: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """``docs`` without the documents that contain an item. Each row is judged by its own text, whatever its id.

    A few words that follow each other are no sign of a leak: an item of fewer words than a
    shingle removes only the documents that consist of it.
    """
    rows, row = numbered(docs)
    found = _pairs(rows, items, row, text, item_id, item_text).filter("whole")
    leaked, _ = Scratch(docs.sparkSession).write(found.select("doc_id").distinct(), "leaked")
    return rows_of(rows, leaked, row, "left_anti").drop(row)
