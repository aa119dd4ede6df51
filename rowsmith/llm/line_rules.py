"""Quality rules: counts per text, and lines that many documents of a host share.

One pass over the texts counts words, symbols and repeats and hashes each normalised line.
Distinct texts per host and line are counted in two steps, so that no line, however frequent,
meets in one task. Lines above the limit are boilerplate; a document that loses too much to
them is depleted and rejected. Exact copies of a text are one document to the counts, or each
copied document would make its own lines frequent.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowsmith.llm.tables import Scratch, quoted

MIN_WORDS = 50
#: Percentage of words inside repeated three-word windows above which a text fails.
MAX_REPEAT_PERCENT = 50
#: A line is removed above this many documents of a host, however large the host is.
MAX_DOCUMENTS = 20
#: A document is depleted if removed lines hold more than this percentage of its words.
MAX_REMOVED_PERCENT = 50
_SYMBOLS = "#*$%&|<>"
_SPACES = " \t\n\v\f\r"
_DIGITS = bytes.maketrans(b"0123456789", b"0000000000")


def repeat_words(words: list[bytes]) -> int:
    """Words covered by three-word windows that occur twice or more."""
    n = len(words)
    if n < 4:
        return 0
    known: dict[bytes, int] = {}
    ids = np.fromiter((known.setdefault(w, len(known)) for w in words), np.int64, n)
    _, pairs = np.unique(ids[:-1] * len(known) + ids[1:], return_inverse=True)
    _, at, counts = np.unique(pairs[:-1] * len(known) + ids[2:], return_inverse=True, return_counts=True)
    twice = np.flatnonzero(counts[at] > 1)
    covered = np.zeros(n, bool)
    for i in range(3):
        covered[twice + i] = True
    return int(covered.sum())


def text_counts(text: str) -> tuple[int, int, int, int, int, list[int], list[int]]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, and hash and words per line."""
    words = text.encode("utf-8", "surrogatepass").split()
    lines = text.split("\n")
    seen: set[str] = set()
    duplicates, hashes, lengths = 0, [], []
    for line in lines:
        parts = line.encode("utf-8", "surrogatepass").lower().split()
        if parts and line in seen:
            duplicates += 1
        seen.add(line)
        hashes.append(xxhash.xxh64_intdigest(b" ".join(parts).translate(_DIGITS)) - 2**63 if parts else 0)
        lengths.append(len(parts))
    return (
        len(words),
        len(text) - sum(map(text.count, _SPACES)),
        sum(map(text.count, _SYMBOLS)),
        duplicates,
        repeat_words(words),
        hashes,
        lengths,
    )


def counts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", host: str = "source") -> DataFrame:
    """(doc_id, host, same, counts of ``text_counts``) per row; same is a hash of the text."""
    narrow = docs.select(quoted(doc_id).alias("doc_id"), quoted(host).alias("host"), quoted(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or "" for t in batch.column(2).to_pylist()]
            found = list(zip(*map(text_counts, texts))) or [[]] * 7
            same = [xxhash.xxh64_intdigest(t.encode("utf-8", "surrogatepass")) - 2**63 for t in texts]
            columns = [pa.array(c, pa.int64()) for c in (same, *found[:5])]
            lists = [pa.array(found[5], pa.list_(pa.int64())), pa.array(found[6], pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *columns, *lists], names)

    kinds = [docs.schema[c].dataType.simpleString() for c in (doc_id, host)]
    measures = ["same", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    names = ["doc_id", "host", *measures, "lines", "line_words"]
    schema = f"doc_id {kinds[0]}, host {kinds[1]}, " + ", ".join(f"{m} long" for m in measures)
    return narrow.mapInArrow(run, f"{schema}, lines array<long>, line_words array<int>")


def frequent_lines(counted: DataFrame, max_documents: int = MAX_DOCUMENTS) -> DataFrame:
    """(host, line) found in more distinct texts of the host than the limit allows."""
    return (
        counted.select("host", "same", F.explode("lines").alias("line"))
        .filter("line <> 0")
        .distinct()
        .groupBy("host", "line")
        .agg(F.count(F.lit(1)).alias("documents"))
        .filter(F.col("documents") > max_documents)
        .select("host", "line")
    )


def verdicts(
    docs: DataFrame,
    max_documents: int = MAX_DOCUMENTS,
    doc_id: str = "doc_id",
    text: str = "text",
    host: str = "source",
) -> DataFrame:
    """(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, removed_lines, kept).

    One row per row of ``docs``; removed_lines has the numbers, from 0, of the boilerplate
    lines. A null text is empty and fails for want of words. A null host is a host. No
    documents: no rows.
    """
    scratch = Scratch(docs.sparkSession)
    marked = counts(docs, doc_id, text, host).withColumn("row", F.monotonically_increasing_id())
    counted, _ = scratch.write(marked, "line_counts")
    frequent, _ = scratch.write(frequent_lines(counted, max_documents), "frequent_lines")
    each = counted.select(
        "row", F.col("host").alias("of"),
        F.explode(F.arrays_zip("lines", "line_words", F.sequence(F.lit(0), F.size("lines") - 1).alias("number"))).alias("l"),
    )
    found = each.join(frequent, F.col("of").eqNullSafe(F.col("host")) & (F.col("l.lines") == F.col("line")))
    removed = found.groupBy(F.col("row").alias("removed_row")).agg(
        F.sum("l.line_words").alias("removed_words"), F.sort_array(F.collect_list("l.number")).alias("removed_lines")
    )
    lost = F.coalesce("removed_words", F.lit(0))
    depleted = (lost * 100 > F.col("n_words") * MAX_REMOVED_PERCENT) | (F.col("n_words") - lost < MIN_WORDS)
    failed = (F.col("n_words") < MIN_WORDS) | (
        F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEAT_PERCENT
    )
    return counted.join(removed, F.col("row") == F.col("removed_row"), "left").select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"),
        F.coalesce("removed_lines", F.array().cast("array<int>")).alias("removed_lines"),
        (~failed & ~depleted).alias("kept"),
    )
