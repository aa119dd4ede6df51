"""Connected components by alternating large-star and small-star rounds.

Each round is a minimum per node and a join of the edges with these minima, so neither the
driver nor a task ever holds a component. The minima have one row per node: Spark's skew
join can split the edges of a hot node, and the minimum is combined before the shuffle.
Rounds are written to the shared folder, which ends the lineage; the round before is deleted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowsmith.llm.tables import Scratch


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) for every node of an edge; the component is its smallest node.

    Edges have no direction; loops, repeated edges and edges with a null end add nothing.
    No edges: no rows.
    """
    scratch = Scratch(edges.sparkSession)
    pairs = edges.select(F.col(a).alias("a"), F.col(b).alias("b"))
    current, path = scratch.write(_downward(pairs), "components")
    seen = _state(current)
    while seen[0]:
        after, new_path = scratch.write(_small_star(_large_star(current)), "components")
        scratch.drop(path)
        current, path, before = after, new_path, seen
        seen = _state(current)
        if seen == before:
            break
    # Now a star: every edge leads straight to the smallest node.
    roots = current.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return current.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots)


def _downward(pairs: DataFrame) -> DataFrame:
    """Edges from the larger to the smaller node, each once."""
    return (
        pairs.filter("a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct()
    )


def _large_star(edges: DataFrame) -> DataFrame:
    """Link each larger neighbour of a node to the node's smallest neighbour."""
    both = edges.union(edges.select("b", "a"))
    smallest = both.groupBy(F.col("a").alias("centre")).agg(F.min("b").alias("low"))
    moved = edges.join(smallest, F.col("b") == F.col("centre")).select(
        "a", F.least("low", "b").alias("b")
    )
    return moved.distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Link a node and its smaller neighbours to the smallest of them."""
    smallest = edges.groupBy(F.col("a").alias("centre")).agg(F.min("b").alias("low"))
    moved = edges.join(smallest, F.col("a") == F.col("centre")).select(
        F.col("b").alias("a"), F.col("low").alias("b")
    )
    own = smallest.select(F.col("centre").alias("a"), F.col("low").alias("b"))
    return _downward(moved.union(own))


def _state(edges: DataFrame) -> tuple:
    mixed = F.xxhash64("a", "b")
    row = edges.agg(
        F.count(F.lit(1)), F.bit_xor(mixed), F.sum(F.shiftrightunsigned(mixed, 32))
    ).first()
    return tuple(row)
