"""How filters interact: what each removes, in every order, from one pass over the texts.

Every document becomes a mask of the filters it fails, and documents are counted per part and
mask. A Gray-code walk then visits all sets of active filters, toggling one filter at a time:
each mask cell counts how many active filters it fails, and a cell whose counter leaves or
reaches zero is taken from or given back to the running survivors. The survivors of each set
are stored, and every step of every order is the difference of two of these states.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import permutations
from math import factorial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowsmith.llm.tables import GAP, Scratch, quoted

MIN_WORDS = 50
MIN_DISTINCT_PERCENT = 65
MAX_CAPITALS_PERCENT = 5
SYMBOLS = "[#$%&*|]"
#: The filters by letter; the last one, copies, depends on the other documents.
FILTERS = "ABCDE"
_PARTS_AT_ONCE = 256


def text_failures(text: Column) -> Column:
    """Booleans: too few words, too few distinct ones, too many capitals, a symbol. Null is empty."""
    whole = F.coalesce(text, F.lit(""))

    def sizes(words: Column) -> Column:
        return F.struct(F.size(words).alias("all"), F.size(F.array_distinct(words)).alias("distinct"))

    # Bound to a variable, so that the words are split once.
    counted = F.get(F.transform(F.array(F.array_remove(F.split(whole, GAP), "")), sizes), 0)
    counts = F.struct(
        counted.alias("words"), F.regexp_count(whole, F.lit("[A-Z]")).alias("capitals"), F.length(whole).alias("chars")
    )

    def tests(c: Column) -> Column:
        return F.array(
            c["words"]["all"] < MIN_WORDS,
            c["words"]["distinct"].cast("long") * 100 < c["words"]["all"].cast("long") * MIN_DISTINCT_PERCENT,
            c["capitals"].cast("long") * 100 > c["chars"].cast("long") * MAX_CAPITALS_PERCENT,
            whole.rlike(SYMBOLS),
        )

    return F.get(F.transform(F.array(counts), tests), 0)


def mask_of(failures: Column, n: int) -> Column:
    """An array of ``n`` booleans as a number, the first in the lowest bit."""
    bits = F.zip_with(failures, F.array(*[F.lit(1 << i) for i in range(n)]), lambda f, bit: F.when(f, bit).otherwise(0))
    return F.aggregate(bits, F.lit(0), lambda a, b: a + b)


def mask_cells(
    docs: DataFrame,
    labels: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    part: str = "source",
    good: str = "quality",
    toxic: str = "toxic",
) -> DataFrame:
    """(part, mask, n, n_good, n_toxic): documents per part and set of failed filters.

    A null part is the empty part. A copy has the text of a document with a smaller id; a row
    without an id is no copy, has no copies and no labels. An id is good or toxic if any of its
    labels says 1. Repeated rows count one by one.

    Equal rows are counted together before anything is joined, and the join that finds copies
    goes by text and id at once, so neither a frequent text nor a frequent id meets in a task.
    """
    scratch = Scratch(docs.sparkSession)
    facts = docs.select(
        quoted(doc_id).alias("doc_id"),
        F.coalesce(quoted(part).cast("string"), F.lit("")).alias("part"),
        F.unhex(F.sha2(F.coalesce(quoted(text), F.lit("")), 256)).alias("same"),
        mask_of(text_failures(quoted(text)), len(FILTERS) - 1).alias("mask"),
    )
    rows, path = scratch.write(
        facts.groupBy("doc_id", "part", "same", "mask").agg(F.count(F.lit(1)).alias("n")), "audit_rows"
    )
    first = rows.filter("doc_id is not null").groupBy("same").agg(F.min("doc_id").alias("first_id"))
    found = rows.join(
        first.withColumnRenamed("same", "same_text"),
        (F.col("same") == F.col("same_text")) & (F.col("doc_id") == F.col("first_id")),
        "left",
    )
    is_copy = F.col("first_id").isNull() & F.col("doc_id").isNotNull()
    masked = found.withColumn("mask", F.col("mask") + F.when(is_copy, 1 << (len(FILTERS) - 1)).otherwise(0))
    per_id = masked.groupBy("doc_id", "part", "mask").agg(F.sum("n").alias("n"))
    known = (
        labels.select(quoted(doc_id).alias("labelled"), quoted(good).alias("good"), quoted(toxic).alias("toxic"))
        .filter("labelled is not null")
        .groupBy("labelled")
        .agg(*[F.max(F.coalesce(F.col(c) == 1, F.lit(False))).alias(c) for c in ("good", "toxic")])
    )
    joined = per_id.join(known, F.col("doc_id") == F.col("labelled"), "left")
    cells = joined.groupBy("part", "mask").agg(
        F.sum("n").alias("n"),
        *[F.coalesce(F.sum(F.when(F.col(c), F.col("n"))), F.lit(0)).alias(f"n_{c}") for c in ("good", "toxic")],
    )
    written, _ = scratch.write(cells, "audit_cells")
    scratch.drop(path)
    return written


def survivors(cells: np.ndarray, n_filters: int) -> np.ndarray:
    """Documents left by each set of filters, for cells of shape (parts, masks, measures).

    Sets and masks are numbers whose bits are the filters.
    """
    masks = np.arange(1 << n_filters)
    failing = np.zeros(len(masks), np.int64)
    running = cells.sum(axis=1)
    states = np.empty_like(cells)
    states[:, 0] = running
    active = 0
    for step in range(1, len(masks)):
        bit = step & -step  # the bit in which the Gray codes of step - 1 and step differ
        fails = masks & bit != 0
        if active & bit:
            failing[fails] -= 1
            running = running + cells[:, fails & (failing == 0)].sum(axis=1)
        else:
            running = running - cells[:, fails & (failing == 0)].sum(axis=1)
            failing[fails] += 1
        active ^= bit
        states[:, active] = running
    return states


def steps(cells: np.ndarray, filters: Sequence[str]) -> dict[str, np.ndarray]:
    """Per column an array of (parts, orders * filters): each step of each order."""
    k = len(filters)
    states = survivors(cells, k)
    orders = np.array(list(permutations(range(k))))
    bits = 1 << orders
    after = np.cumsum(bits, axis=1)  # the set of filters that have run
    before = after - bits
    gone = states[:, before] - states[:, after]
    everything = (1 << k) - 1
    failing = states[:, 0, None, 0] - states[:, [1 << i for i in range(k)], 0]
    alone = states[:, [everything ^ (1 << i) for i in range(k)], 0] - states[:, everything, None, 0]
    removed = gone[..., 0]
    total = np.stack([(removed * (orders == i)).sum(axis=(1, 2)) for i in range(k)], axis=1)
    found = {
        "kept": states[:, after, 0], "removed": removed, "redundant": failing[:, orders] - removed,
        "unique_fails": alone[:, orders], "good_lost": gone[..., 1], "toxic_lost": gone[..., 2],
        "shapley": total[:, orders],
    }
    return {name: values.reshape(len(cells), -1) for name, values in found.items()}


def audit(cells: DataFrame, filters: Sequence[str] = FILTERS) -> DataFrame:
    """(part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley).

    A row per part, order of the filters and step in it, zeros included. No cells: no rows.
    """
    k = len(filters)
    names = [f.name for f in cells.schema.fields if f.name.startswith("n")]
    orders = ["".join(filters[i] for i in order) for order in permutations(range(k))]
    rows = factorial(k) * k
    columns = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, _PARTS_AT_ONCE):
                part = batch.slice(at, _PARTS_AT_ONCE)
                table = np.zeros((part.num_rows, 1 << k, len(names)), np.int64)
                for i, found in enumerate(part.column(1).to_pylist()):
                    for cell in found:
                        table[i, cell["mask"]] = [cell[name] for name in names]
                measures = steps(table, filters)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0).take(pa.array(np.repeat(np.arange(part.num_rows), rows))),
                        pa.array([order for order in orders for _ in range(k)] * part.num_rows),
                        pa.array(np.tile(np.arange(1, k + 1), part.num_rows * len(orders)), pa.int32()),
                        *[pa.array(measures[c].ravel()) for c in columns],
                    ],
                    ["part", "filter_order", "step", *columns],
                )

    # At most as many cells per part as there are sets of filters.
    per_part = cells.groupBy("part").agg(F.collect_list(F.struct("mask", *names)).alias("cells"))
    longs = ", ".join(f"{c} long" for c in columns)
    return per_part.mapInArrow(run, f"part string, filter_order string, step int, {longs}")
