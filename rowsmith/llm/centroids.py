"""Exact Lloyd clustering of whole-number vectors, with heap-ordered bounds.

Vectors become whole numbers, packed into blocks of one Arrow batch each; nothing of them is
shuffled. A block keeps one heap per cluster. The key of a vector is its gap, a lower bound of
the distance to every other centroid minus an upper bound of the distance to its own, plus the
drift its cluster had accumulated when the gap was measured. When centroids move, only the
accumulated drift of each cluster grows; vectors whose key it reaches are popped and compared
with all centroids again, all others stay unread. Gaps are rounded down and drifts up, and
distances are whole numbers, so the result is that of a full scan, ties included.

A round writes the blocks with their heaps and, per block, how sums and counts of the clusters
changed. Only these changes, ``k`` times the dimension numbers, reach the driver.
"""

from __future__ import annotations

import hashlib
import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowsmith.llm.tables import Scratch, quoted

CLUSTERS = 16
ROUNDS = 3
DIMENSION = 64
SCALE = 64
#: Largest whole component whose squared distances over 64 components fit a long.
MAX_COMPONENT = 2**27
_EXACT_IN_DOUBLE = 2**22  # up to here sums of 64 products are exact in doubles
_SLACK = 1e-9  # far above the rounding of a square root or a sum of a few of them
_CHUNK = 2_048
_STATE = "vectors binary, width int, keys binary, members binary, sizes array<int>, scanned long, sums array<long>, counts array<long>"


@dataclass(frozen=True)
class Clusters:
    """Final centroids, and a row (vec_id, cluster, distance) per vector, written."""

    assigned: DataFrame
    centroids: list[list[int]]
    #: Vectors compared with all centroids, per assignment.
    scanned: list[int]


def whole_vector(vector: Column, scale: int = SCALE) -> Column:
    """floor(scale * x) of each component as long."""
    return F.transform(vector.cast("array<double>"), lambda x: F.floor(x * scale))


def usable(vector: Column, dimension: int = DIMENSION, scale: int = SCALE) -> Column:
    """Has the vector exactly ``dimension`` components, all numbers within the exact range?"""
    bound = MAX_COMPONENT / scale
    fits = F.forall(vector.cast("array<double>"), lambda x: F.coalesce((x >= -bound) & (x < bound), F.lit(False)))
    return F.coalesce((F.size(vector) == dimension) & fits, F.lit(False))


def squared_distances(vectors: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Exact squared distances, a row per vector and a column per centroid."""
    found = np.empty((len(vectors), len(centroids)), np.int64)
    in_double = max(np.abs(vectors).max(initial=0), np.abs(centroids).max(initial=0)) <= _EXACT_IN_DOUBLE
    for at in range(0, len(vectors), _CHUNK):
        part = vectors[at : at + _CHUNK].astype(np.int64)
        if in_double:
            x, c = part.astype(float), centroids.astype(float)
            found[at : at + _CHUNK] = (x * x).sum(1)[:, None] - 2 * (x @ c.T) + (c * c).sum(1)
        else:
            for j, c in enumerate(centroids):
                found[at : at + _CHUNK, j] = ((part - c) ** 2).sum(1)
    return found


class Block:
    """The vectors of a block and a heap of (key, vector) per cluster."""

    def __init__(self, vectors: np.ndarray, heaps: list[list[tuple[float, int]]]):
        self.vectors, self.heaps = vectors, heaps

    @classmethod
    def of_row(cls, row: dict, dimension: int) -> Block:
        vectors = np.frombuffer(row["vectors"], f"<i{row['width']}").reshape(-1, dimension)
        keys, members = np.frombuffer(row["keys"], np.float64), np.frombuffer(row["members"], np.int32)
        cuts = np.cumsum([0, *row["sizes"]])
        pairs = [zip(keys[s:e].tolist(), members[s:e].tolist()) for s, e in zip(cuts, cuts[1:])]
        # Written in the order of the heap, so they are heaps as they are.
        return cls(vectors, [list(p) for p in pairs])

    def clusters(self) -> np.ndarray:
        found = np.full(len(self.vectors), -1, np.int64)
        for j, heap in enumerate(self.heaps):
            found[[i for _, i in heap]] = j
        return found

    def reassign(self, centroids: np.ndarray, drift: list[float]) -> tuple[int, np.ndarray, np.ndarray]:
        """Move the vectors whose gap has expired; (vectors scanned, changes of sums, of counts)."""
        k = len(centroids)
        if self.heaps:
            expired, before = [], []
            for j, heap in enumerate(self.heaps):
                while heap and heap[0][0] - drift[j] <= _SLACK * (1 + abs(heap[0][0])):
                    expired.append(heapq.heappop(heap)[1])
                    before.append(j)
        else:
            self.heaps = [[] for _ in range(k)]
            expired, before = range(len(self.vectors)), [-1] * len(self.vectors)
        at, old = np.array(expired, np.int64), np.array(before, np.int64)
        distance = squared_distances(self.vectors[at], centroids)
        nearest = distance.argmin(axis=1) if len(at) else old  # of equal ones the first
        rows = np.arange(len(at))
        own = np.sqrt(distance[rows, nearest])
        distance[rows, nearest] = np.iinfo(np.int64).max
        other = np.sqrt(distance.min(axis=1, initial=np.iinfo(np.int64).max))
        gaps = other - own - _SLACK * (other + own)
        for gap, i, j in zip(gaps.tolist(), at.tolist(), nearest.tolist()):
            heapq.heappush(self.heaps[j], (gap + drift[j], i))
        moved = old != nearest
        sums, counts = np.zeros((k, self.vectors.shape[1]), np.int64), np.zeros(k, np.int64)
        for labels, sign in ((nearest[moved], 1), (old[moved], -1)):
            known = labels >= 0
            np.add.at(counts, labels[known], sign)
            np.add.at(sums, labels[known], sign * self.vectors[at[moved][known]].astype(np.int64))
        return len(at), sums, counts

    def row(self, scanned: int, sums: np.ndarray, counts: np.ndarray) -> dict:
        pairs = [pair for heap in self.heaps for pair in heap]
        return {
            "vectors": self.vectors.tobytes(), "width": self.vectors.dtype.itemsize,
            "keys": np.array([key for key, _ in pairs], np.float64).tobytes(),
            "members": np.array([i for _, i in pairs], np.int32).tobytes(),
            "sizes": [len(heap) for heap in self.heaps], "scanned": scanned,
            "sums": sums.ravel().tolist(), "counts": counts.tolist(),
        }


def _packed(vectors: np.ndarray) -> np.ndarray:
    """The same numbers in the narrowest type that holds them all."""
    most = max(abs(int(vectors.min(initial=0))), int(vectors.max(initial=0)))
    return vectors.astype("<i1" if most < 2**7 else "<i2" if most < 2**15 else "<i4")


def _blocks(kept: DataFrame, dimension: int) -> DataFrame:
    """A row per Arrow batch of (vec_id, whole): ids, packed vectors, and no heaps yet."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            values = batch.column(1).flatten().to_numpy(zero_copy_only=False)
            block = Block(_packed(values.reshape(-1, dimension)), [])
            yield _batch(batch.column(0), block.row(0, np.zeros(0, np.int64), np.zeros(0, np.int64)))

    kind = kept.schema["vec_id"].dataType.simpleString()
    return kept.mapInArrow(run, f"ids array<{kind}>, {_STATE}")


def _batch(ids: pa.Array, row: dict) -> pa.RecordBatch:
    kinds = [
        pa.binary(), pa.int32(), pa.binary(), pa.binary(), pa.list_(pa.int32()), pa.int64(),
        pa.list_(pa.int64()), pa.list_(pa.int64()),
    ]
    lists = pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids)
    return pa.RecordBatch.from_arrays(
        [lists, *[pa.array([value], kind) for value, kind in zip(row.values(), kinds)]], ["ids", *row]
    )


def _round(state: DataFrame, centroids: list[list[int]], drift: list[float], dimension: int) -> DataFrame:
    centres = np.array(centroids, np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = {name: batch.column(name)[i].as_py() for name in batch.schema.names if name != "ids"}
                block = Block.of_row(row, dimension)
                yield _batch(batch.column("ids")[i].values, block.row(*block.reassign(centres, drift)))

    return state.mapInArrow(run, state.schema)


def _assigned(state: DataFrame, centroids: list[list[int]], dimension: int) -> DataFrame:
    centres = np.array(centroids, np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = {name: batch.column(name)[i].as_py() for name in batch.schema.names if name != "ids"}
                block = Block.of_row(row, dimension)
                cluster = block.clusters()
                own = ((block.vectors.astype(np.int64) - centres[cluster]) ** 2).sum(axis=1)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("ids")[i].values, pa.array(cluster, pa.int32()), pa.array(own)],
                    ["vec_id", "cluster", "distance"],
                )

    kind = state.schema["ids"].dataType.elementType.simpleString()
    return state.mapInArrow(run, f"vec_id {kind}, cluster int, distance long")


def first_centroids(kept: DataFrame, k: int, seed: int) -> list[list[int]]:
    """The ``k`` vectors whose ids have the smallest sha256 of ``<seed>:<id>``, in its order."""
    order = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    drawn = kept.orderBy(order.asc_nulls_last(), "whole").limit(k).select("whole")
    return [r["whole"] for r in drawn.collect()]


def cluster(
    vectors: DataFrame,
    k: int = CLUSTERS,
    rounds: int = ROUNDS,
    seed: int = 1,
    dimension: int = DIMENSION,
    scale: int = SCALE,
    vec_id: str = "vec_id",
    vector: str = "embedding",
) -> Clusters:
    """Lloyd's algorithm over floor(scale * x) for a fixed number of rounds.

    Vectors of another length, and with a component that is null, not finite or beyond
    ``MAX_COMPONENT`` once scaled, are left out. Centroids start as the vectors with the smallest
    sha256 of their id (a null id last; equal ids by components) and become the floor of the
    mean; a centroid without vectors stays. Of equally near centroids the first wins. Repeated
    rows are vectors of their own. Fewer than ``k`` vectors make as many centroids; none make no
    rows. Sums of components and of squared distances must fit a long.
    """
    scratch = Scratch(vectors.sparkSession)
    kept = vectors.filter(usable(quoted(vector), dimension, scale)).select(
        quoted(vec_id).alias("vec_id"), whole_vector(quoted(vector), scale).alias("whole")
    )
    centroids = first_centroids(kept, k, seed)
    state, path = scratch.write(_blocks(kept, dimension), "centroid_blocks")
    drift, scanned = [0.0] * len(centroids), []
    sums, counts = [[0] * dimension for _ in centroids], [0] * len(centroids)
    for turn in range(rounds + 1 if centroids else 0):
        state, after = scratch.write(_round(state, centroids, drift, dimension), "centroid_blocks")
        scratch.drop(path)
        path = after
        scanned.append(state.agg(F.sum("scanned")).first()[0])
        if turn == rounds:
            break
        for at, change in _changes(state, "counts"):
            counts[at] += change
        for at, change in _changes(state, "sums"):
            sums[at // dimension][at % dimension] += change
        moved = [[x // n for x in total] if n else old for total, n, old in zip(sums, counts, centroids)]
        drift = _drifted(drift, centroids, moved)
        centroids = moved
    assigned, _ = scratch.write(_assigned(state, centroids, dimension), "centroid_members")
    scratch.drop(path)
    return Clusters(assigned, centroids, scanned)


def _changes(state: DataFrame, name: str) -> list[tuple[int, int]]:
    """Sums over all blocks, by place; as many as a block has."""
    each = state.select(F.posexplode(name).alias("at", "change")).filter("change <> 0")
    return [tuple(r) for r in each.groupBy("at").agg(F.sum("change")).collect()]


def _drifted(drift: list[float], before: list[list[int]], after: list[list[int]]) -> list[float]:
    """Accumulated drift per cluster: its own way and the longest of any other centroid."""
    ways = [math.dist(a, b) * (1 + _SLACK) for a, b in zip(before, after)]
    most = [max((w for i, w in enumerate(ways) if i != j), default=0.0) for j in range(len(ways))]
    return [d + w + m for d, w, m in zip(drift, ways, most)]


def summarised(found: Clusters) -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256) per vector."""
    sums = {r["cluster"]: r["s"] for r in found.assigned.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()}
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in found.centroids]

    def of_cluster(values: list, kind: str) -> Column:
        if not values:
            return F.lit(None).cast(kind)
        return F.element_at(F.array(*[F.lit(v) for v in values]), F.col("cluster") + 1).cast(kind)

    return found.assigned.select(
        "vec_id", "cluster", "distance",
        of_cluster([sums.get(j, 0) for j in range(len(digests))], "long").alias("cluster_inertia"),
        F.lit(sum(sums.values())).cast("long").alias("inertia"),
        of_cluster(digests, "string").alias("centroid_sha256"),
    )
