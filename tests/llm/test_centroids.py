"""Clustering against a plain Lloyd loop over Python numbers."""

import hashlib
import math
import random

import numpy as np
import pytest
from rowsmith.llm import centroids


def brute_force(rows, k, rounds, dimension, scale):
    """(vec_id, cluster, distance) per kept row and the final centroids."""
    kept = [
        (i, [math.floor(scale * float(x)) for x in v])
        for i, v in rows
        if v is not None and len(v) == dimension and all(x is not None and math.isfinite(x) for x in v)
    ]
    order = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"1:{r[0]}".encode()).hexdigest() if r[0] is not None else "", r[1]))
    centres = [v for _, v in order[:k]]

    def assign():
        found = []
        for i, v in kept:
            distances = [sum((a - b) ** 2 for a, b in zip(v, c)) for c in centres]
            found.append((i, distances.index(min(distances)), min(distances)))
        return found

    for _ in range(rounds):
        groups = {}
        for (_, cluster, _), (_, v) in zip(assign(), kept):
            groups.setdefault(cluster, []).append(v)
        centres = [[sum(c) // len(groups[j]) for c in zip(*groups[j])] if j in groups else old for j, old in enumerate(centres)]
    return assign(), centres


def frame(spark, rows, kind="array<float>"):
    return spark.createDataFrame(rows, f"vec_id long, embedding {kind}, cluster string, distance string, whole string")


def key(row):
    return (row[0] is None, row[0] or 0, row[1:])


def made(seed, n, dimension, spread):
    r = random.Random(seed)
    middles = [[r.gauss(0, 1) for _ in range(dimension)] for _ in range(12)]
    return [(i, [float(np.float32(m + r.gauss(0, spread))) for m in r.choice(middles)]) for i in range(n)]


@pytest.mark.parametrize("seed, n, k, dimension, scale, spread", [
    (1, 900, 16, 8, 64, 0.3), (2, 900, 7, 3, 2, 0.5), (3, 500, 16, 64, 64, 0.1), (4, 5, 16, 4, 64, 1), (5, 300, 1, 4, 64, 1),
    (6, 400, 16, 2, 1, 1), (7, 200, 5, 8, 200_000, 1), (8, 200, 5, 8, 20_000_000, 1),
])
def test_clusters_equal_brute_force(spark, seed, n, k, dimension, scale, spread):
    rows = made(seed, n, dimension, spread)
    found = centroids.cluster(frame(spark, [(*r, "a", "b", "c") for r in rows]).repartition(5), k, 3, 1, dimension, scale)
    expected, centres = brute_force(rows, k, 3, dimension, scale)
    assert found.centroids == centres
    assert sorted(map(tuple, found.assigned.collect())) == sorted(expected)


def test_vectors_that_are_left_out_ties_and_repeats(spark):
    good = made(9, 60, 4, 0.2)
    odd = [
        (100, None), (101, []), (102, [1.0] * 3), (103, [1.0] * 5), (104, [1.0, None, 0.0, 0.0]), (105, [math.nan] * 4),
        (106, [math.inf, 0.0, 0.0, 0.0]), (107, [-math.inf] * 4), (None, [0.5] * 4), (None, [0.25] * 4), (3, [0.0, -0.0, 0.0, 0.0]),
    ]
    rows = good + good[:5] + good[:1] * 40 + odd
    found = centroids.cluster(frame(spark, [(*r, None, None, None) for r in rows]), 16, 3, 1, 4)
    expected, centres = brute_force(rows, 16, 3, 4, 64)
    assert found.centroids == centres
    assert sorted(map(tuple, found.assigned.collect()), key=key) == sorted(expected, key=key)
    beyond = centroids.cluster(frame(spark, [(1, [1e30] * 4, None, None, None), (2, [1.0] * 4, None, None, None)]), 16, 3, 1, 4)
    assert [tuple(r) for r in beyond.assigned.collect()] == [(2, 0, 0)]


def test_only_expired_gaps_are_scanned(spark):
    rows = made(10, 4_000, 16, 0.05)
    found = centroids.cluster(frame(spark, [(*r, None, None, None) for r in rows]), 16, 6, 1, 16)
    assert found.scanned[0] == 4_000
    assert found.scanned[-1] < 1_200


def test_squared_distances_of_large_numbers_are_exact():
    big = centroids.MAX_COMPONENT - 1
    vectors = np.array([[big] * 64, [-big] * 64, [0] * 64])
    found = centroids.squared_distances(vectors, vectors)
    assert found.tolist() == [[64 * (a - b) ** 2 for b in (big, -big, 0)] for a in (big, -big, 0)]


def test_no_vectors(spark):
    empty = frame(spark, [])
    assert centroids.summarised(centroids.cluster(empty)).collect() == []
    short = frame(spark, [(1, [0.0] * 3, None, None, None)])
    assert centroids.summarised(centroids.cluster(short)).collect() == []
