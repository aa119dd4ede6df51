"""The subset walk against masks applied one by one, and the failure conditions at their borders."""

from collections import Counter
from itertools import permutations

import numpy as np
import pytest
from pyspark.sql import functions as F
from rowsmith.llm import filter_audit


@pytest.mark.parametrize("k", [1, 2, 3, 5])
def test_walk_equals_counting_each_subset(k):
    cells = np.random.default_rng(k).integers(0, 50, (4, 1 << k, 3))
    states = filter_audit.survivors(cells, k)
    for active in range(1 << k):
        left = [m for m in range(1 << k) if not m & active]
        assert (states[:, active] == cells[:, left].sum(axis=1)).all()


def test_steps_equal_running_the_filters():
    cells = np.random.default_rng(7).integers(0, 9, (2, 32, 3))
    found = filter_audit.steps(cells, "ABCDE")
    for part in range(2):
        at, shapley, rows = 0, Counter(), []
        for order in permutations(range(5)):
            left = {m: cells[part, m] for m in range(32)}
            for f in order:
                gone = [m for m in left if m >> f & 1]
                lost = sum((left.pop(m) for m in gone), np.zeros(3, int))
                shapley[f] += lost[0]
                failing = sum(cells[part, m, 0] for m in range(32) if m >> f & 1)
                rows.append((f, sum(c[0] for c in left.values()), *lost, failing - lost[0], cells[part, 1 << f, 0]))
        names = ("kept", "removed", "good_lost", "toxic_lost", "redundant", "unique_fails")
        for f, *row in rows:
            assert [found[n][part, at] for n in names] == row
            assert found["shapley"][part, at] == shapley[f]
            at += 1
        assert at == 600


def words(n, distinct=None):
    return " ".join(f"w{chr(97 + i % (distinct or n) // 26)}{chr(97 + i % (distinct or n) % 26)}" for i in range(n))


BORDERS = [
    (words(50), ""), (words(49), "A"), (words(100, 65), ""), (words(100, 64), "B"), (words(50) + " x#", "D"),
    ("", "A"), (None, "A"), (" ".join(["ab"] * 60), "A"), ("Ä" * 400 + " " + words(50), ""), ("\x0b".join(["ab"] * 60), "B"),
]


def test_failure_conditions_at_their_borders(spark):
    rows = [(i, t) for i, (t, _) in enumerate(BORDERS)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    masks = frame.select("doc_id", filter_audit.mask_of(filter_audit.text_failures(frame["text"]), 4).alias("m")).collect()
    found = {r["doc_id"]: "".join(f for i, f in enumerate("ABCD") if r["m"] >> i & 1) for r in masks}
    assert found == {i: fails for i, (_, fails) in enumerate(BORDERS)}
    capitals = [("A" * n + "b" * (100 - n)) for n in (5, 6)]
    frame = spark.createDataFrame([(t,) for t in capitals], "text string")
    masks = [r[0] >> 2 & 1 for r in frame.select(filter_audit.mask_of(filter_audit.text_failures(frame["text"]), 4)).collect()]
    assert masks == [0, 1]


def test_copies_labels_and_parts(spark):
    one, two = words(60), words(70)
    docs = spark.createDataFrame(
        [(5, one, "a", "x"), (5, one, "b", "x"), (3, two, None, "x"), (9, one, "a", "x"), (9, one, "a", "x"), (None, one, "", "x"),
         (None, one, "", "x"), (4, two, "", "x"), (1, None, "a", "x"), (2, "", "a", "x")],
        "doc_id long, text string, source string, mask string",
    )
    labels = spark.createDataFrame(
        [(5, 1, None), (5, 0, 1), (9, 0, 0), (None, 1, 1), (4, 1, 1), (4, None, None), (2, 7, 1)],
        "doc_id long, quality int, toxic int",
    )
    found = {(r["part"], r["mask"]): (r["n"], r["n_good"], r["n_toxic"]) for r in filter_audit.mask_cells(docs, labels).collect()}
    assert found == {
        ("a", 0): (1, 1, 1), ("b", 0): (1, 1, 1), ("a", 16): (2, 0, 0), ("", 0): (3, 0, 0), ("", 16): (1, 1, 1),
        ("a", 1): (1, 0, 0), ("a", 17): (1, 0, 1),
    }
    rows = filter_audit.audit(filter_audit.mask_cells(docs, labels)).collect()
    assert Counter(r["part"] for r in rows) == {"a": 600, "b": 600, "": 600}


def test_a_text_or_id_with_a_third_of_all_rows_is_spread(spark):
    n = 30_000
    docs = spark.range(n).select(
        F.when(F.col("id") % 3 == 1, 7).otherwise(F.col("id")).alias("doc_id"),
        F.when(F.col("id") % 3 == 0, F.lit("same")).otherwise(F.concat(F.lit("t"), F.col("id"))).alias("text"),
        F.lit("s").alias("source"),
    )
    labels = spark.range(n).select(F.col("id").alias("doc_id"), F.lit(1).alias("quality"), F.lit(0).alias("toxic"))
    cells = {r["mask"]: (r["n"], r["n_good"]) for r in filter_audit.mask_cells(docs, labels).collect()}
    copies = n // 3 - 1
    assert cells == {1: (n - copies, n - copies), 17: (copies, copies)}
