"""SimHash fingerprints and all pairs of them within a few bits.

Texts become 64-bit fingerprints in one pass over Arrow batches. Equal fingerprints are one
node. Links between different fingerprints are searched in a forest of vantage-point trees:
two fingerprints that differ in at most ``d`` of 64 bits differ in at most ``d // parts``
bits of one of ``parts`` segments, so there is one tree per segment, with the Hamming
distance inside the segment as its metric and that small radius. A tree sends a fingerprint
to the leaf it lies in and, where the triangle bound cannot rule it out, to every leaf its
ball overlaps. Inside a leaf all home fingerprints meet all visitors and the full distance
decides, so every pair is found.

Trees are grown on a bounded sample of fingerprints (``SAMPLE``). The sample shapes the
leaves only: every fingerprint is placed and compared. A leaf larger than ``TILE`` is dealt
out as pairs of tiles, and a tile reports a spanning forest of its links, never all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowsmith.llm.components import components
from rowsmith.llm.tables import Scratch, keyed_by_row, numbered, quoted, rows_of
from rowsmith.operators.lookup import KeyTable, attach

SHINGLE_WORDS = 4
MAX_BITS = 4
HASH_SEED = 42
PARTS = 3
SAMPLE = 16_384
LEAF = 1_024
MAX_LEAVES = 4_096
TILE = 8_192
BROADCAST_BYTES = 16 * 1024 * 1024
_BLOCK = 1 << 22  # fingerprint pairs compared at once


def fingerprint(text: str | None, shingle_words: int = SHINGLE_WORDS) -> int:
    """SimHash of one text as unsigned 64-bit number; 0 without words."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    digest = xxhash.xxh64_intdigest
    if len(words) <= shingle_words:
        return digest(joined, HASH_SEED)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    spans = zip(starts[: len(words) - shingle_words + 1].tolist(), ends[shingle_words - 1 :].tolist())
    hashes = np.array([digest(joined[s:e], HASH_SEED) for s, e in spans], np.uint64)
    votes = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 15):
        octets = hashes[at : at + (1 << 15)].view(np.uint8).reshape(-1, 8)
        votes += np.unpackbits(octets, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * votes > len(hashes), bitorder="little")
    return int(bits.view(np.uint64)[0])


def fingerprints(
    docs: DataFrame, shingle_words: int = SHINGLE_WORDS, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(doc_id, fp) per row; fp is the fingerprint's 64 bits as a signed long.

    A-Z are lower-cased and words are runs of anything but ASCII white space. Fewer words
    than a shingle make one shingle; a text that is null or has no words has fp 0.
    """
    narrow = docs.select(quoted(doc_id).alias("doc_id"), quoted(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [fingerprint(t, shingle_words) for t in batch.column(1).to_pylist()]
            signed = np.array(found, np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(signed)], ["doc_id", "fp"])

    kind = docs.schema[doc_id].dataType.simpleString()
    return narrow.mapInArrow(run, f"doc_id {kind}, fp long")


def segments(parts: int) -> list[int]:
    """Bit masks that split 64 bits into ``parts`` runs."""
    cuts = [64 * i // parts for i in range(parts + 1)]
    return [((1 << high) - 1) ^ ((1 << low) - 1) for low, high in zip(cuts, cuts[1:])]


class VantageTree:
    """A vantage-point tree over one segment; its leaves are numbered from 0."""

    def __init__(self, sample: np.ndarray, mask: int, leaves: int, seed: int):
        self.mask = np.uint64(mask)
        self.nodes: list[tuple] = []  # (vantage, bound, left, right) or (leaf,)
        self.shares: list[float] = []
        random = np.random.default_rng(seed)
        self._grow(np.unique(sample & self.mask, return_counts=True), len(sample), leaves, random)

    def _grow(self, points, total: int, leaves: int, random) -> int:
        values, counts = points
        at = len(self.nodes)
        self.nodes.append(())
        split = self._split(values, counts, random) if leaves > 1 else None
        if split is None:
            self.nodes[at] = (len(self.shares),)
            self.shares.append(counts.sum() / max(1, total))
            return at
        vantage, bound, near = split
        left = self._grow((values[near], counts[near]), total, leaves // 2, random)
        right = self._grow((values[~near], counts[~near]), total, leaves - leaves // 2, random)
        self.nodes[at] = (vantage, bound, left, right)
        return at

    def _split(self, values, counts, random):
        """The most even of a few cuts; none if every point looks the same."""
        best = None
        for vantage in random.choice(values, min(5, len(values)), replace=False):
            distance = np.bitwise_count(values ^ vantage).astype(np.int64)
            levels, weight = np.unique(distance, return_inverse=True)
            if len(levels) < 2:
                continue
            mass = np.cumsum(np.bincount(weight, counts))[:-1]
            cut = int(np.argmin(np.abs(2 * mass - counts.sum())))
            uneven = abs(2 * mass[cut] - counts.sum())
            if best is None or uneven < best[0]:
                best = (uneven, vantage, int(levels[cut]), distance <= levels[cut])
        return best and best[1:]

    def place(self, fps: np.ndarray, radius: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(leaf, indices, is home) for all leaves that the balls around ``fps`` overlap."""
        masked = fps & self.mask
        waiting = [(0, np.arange(len(fps)), np.ones(len(fps), bool))]
        while waiting:
            node, rows, home = waiting.pop()
            if not len(rows):
                continue
            if len(self.nodes[node]) == 1:
                yield self.nodes[node][0], rows, home
                continue
            vantage, bound, left, right = self.nodes[node]
            distance = np.bitwise_count(masked[rows] ^ vantage).astype(np.int64)
            near = distance - radius <= bound
            far = distance + radius > bound
            inside = distance <= bound
            waiting.append((left, rows[near], (home & inside)[near]))
            waiting.append((right, rows[far], (home & ~inside)[far]))


def spanning_links(home: np.ndarray, others: np.ndarray, max_bits: int) -> list[tuple[int, int]]:
    """Pairs that connect exactly what the links between ``home`` and ``others`` connect."""
    values = np.unique(np.concatenate([home, others]))
    labels = np.arange(len(values))
    home_at, others_at = np.searchsorted(values, home), np.searchsorted(values, others)
    links = []
    step = max(1, _BLOCK // max(1, len(others)))
    for at in range(0, len(home), step):
        rows = home[at : at + step]
        close = np.bitwise_count(rows[:, None] ^ others[None, :]) <= max_bits
        for i in np.flatnonzero(close.sum(axis=1) > 1):
            found = np.unique(labels[others_at[close[i]]])
            found = np.union1d(found, labels[home_at[at + i]])
            if len(found) > 1:
                links += [(int(values[found[0]]), int(values[x])) for x in found[1:]]
                labels[np.isin(labels, found[1:])] = found[0]
        for i in np.flatnonzero(close.sum(axis=1) == 1):
            j = others_at[np.flatnonzero(close[i])[0]]
            one, two = labels[home_at[at + i]], labels[j]
            if one != two:
                links.append((int(values[min(one, two)]), int(values[max(one, two)])))
                labels[labels == max(one, two)] = min(one, two)
    return links


def links(distinct: DataFrame, max_bits: int = MAX_BITS, parts: int = PARTS) -> DataFrame:
    """(a, b): edges that connect what all pairs within ``max_bits`` bits connect.

    ``distinct`` has one row per fingerprint (column fp, signed long).
    """
    total = distinct.count()
    drawn = distinct.select("fp").orderBy(F.xxhash64("fp"), "fp").limit(SAMPLE).toPandas()
    sample = drawn["fp"].to_numpy(np.int64).view(np.uint64)
    leaves = int(min(MAX_LEAVES, max(1, -(-total // LEAF))))
    trees = [VantageTree(sample, m, leaves, i) for i, m in enumerate(segments(parts))]
    radius = max_bits // parts
    tiles = [
        [max(1, round(share * total / TILE)) for share in tree.shares] for tree in trees
    ]

    def place(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """A fingerprint for each tile pair of each leaf where it is at home or visits."""
        for frame in frames:
            fps = frame["fp"].to_numpy(np.int64).view(np.uint64)
            turn = (fps * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32)
            for part, tree in enumerate(trees):
                out = []
                for leaf, rows, home in tree.place(fps, radius):
                    n = tiles[part][leaf]
                    own = (turn[rows] % np.uint64(n)).astype(np.int64)
                    for other in range(n):
                        # Visitors (role 0) go to every row of tiles, homes (1) to every column.
                        out.append((leaf, other * n + own, fps[rows], np.zeros(len(rows), np.int8)))
                        at = rows[home]
                        out.append((leaf, own[home] * n + other, fps[at], np.ones(len(at), np.int8)))
                yield pd.DataFrame(
                    {
                        "part": np.int32(part),
                        "leaf": np.repeat([x[0] for x in out], [len(x[1]) for x in out]).astype(np.int32),
                        "tile": np.concatenate([x[1] for x in out] or [np.empty(0, np.int64)]),
                        "role": np.concatenate([x[3] for x in out] or [np.empty(0, np.int8)]),
                        "fp": np.concatenate([x[2] for x in out] or [np.empty(0, np.uint64)]).view(np.int64),
                    }
                )

    def compare(group: pd.DataFrame) -> pd.DataFrame:
        fps, home = group["fp"].to_numpy(np.int64).view(np.uint64), group["role"].to_numpy() == 1
        found = np.array(spanning_links(fps[home], fps[~home], max_bits), np.uint64).reshape(-1, 2)
        return pd.DataFrame(found.view(np.int64), columns=["a", "b"])

    placed = distinct.select("fp").mapInPandas(place, "part int, leaf int, tile long, role byte, fp long")
    return placed.groupBy("part", "leaf", "tile").applyInPandas(compare, "a long, b long")


def near_duplicates(
    docs: DataFrame,
    shingle_words: int = SHINGLE_WORDS,
    max_bits: int = MAX_BITS,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """(doc_id, fingerprint, component_id) per row of ``docs``.

    fingerprint has 16 lowercase hex digits; component_id is the smallest doc_id that links
    of at most ``max_bits`` bits reach, the row's own included (null if all are null).
    Repeated rows and equal ids give repeated rows. No documents: no rows.
    """
    scratch = Scratch(docs.sparkSession)
    prints, _ = scratch.write(fingerprints(docs, shingle_words, doc_id, text), "fingerprints")
    distinct, _ = scratch.write(
        prints.groupBy("fp").agg(F.min("doc_id").alias("first_id"), F.count(F.lit(1)).alias("n")),
        "distinct_fingerprints",
    )
    edges = links(distinct, max_bits)
    classes = components(edges).select(F.col("node").alias("fp"), "component")
    linked = distinct.join(classes, "fp")
    smallest = linked.groupBy("component").agg(F.min("first_id").alias("smallest"))
    moved = linked.join(smallest, "component").select(F.col("fp").alias("moved"), "smallest")
    known = distinct.join(moved, F.col("fp") == F.col("moved"), "left").select(
        F.col("fp").alias("key"), "n", F.coalesce("smallest", "first_id").alias("component_id")
    )
    written, _ = scratch.write(known, "fingerprint_classes")
    # Rows of a fingerprint that many texts share are spread over tasks.
    keyed = KeyTable.measured(written, ("component_id",))
    return attach(prints, F.col("fp"), keyed, broadcast_bytes=BROADCAST_BYTES).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def keep_one(
    docs: DataFrame,
    shingle_words: int = SHINGLE_WORDS,
    max_bits: int = MAX_BITS,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """One row of each group of ``docs``: the first by doc_id, a null id before all others, then by row."""
    rows, row = numbered(docs)
    groups = near_duplicates(keyed_by_row(rows, row, doc_id, text), shingle_words, max_bits)
    other = F.struct("component_id.file", "component_id.at") != F.struct("doc_id.file", "doc_id.at")
    gone, _ = Scratch(docs.sparkSession).write(groups.filter(other).select(F.struct("doc_id.file", "doc_id.at")), "near_copies")
    return rows_of(rows, gone, row, "left_anti").drop(row)
