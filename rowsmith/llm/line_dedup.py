"""Fuzzy line dedup: MinHash of character shingles, banding, exact Jaccard, union-find.

Lines that are equal once case and white space are ignored are one line, found by a 128-bit
hash; the first of them, by document and place, stands for all. A line gets a MinHash signature
of its character shingles, cut into bands, where the documents are read: hashes and bands are
shuffled, texts are not. Lines that agree in a band form a bucket: its smallest line is compared
with each of the others, and buckets in which that does not connect all members are compared in
full, tile by tile, without repeating what is connected already. The texts of members are fetched
from the documents by their hashes. Accepted pairs go through distributed union-find, and of each
component the first line is kept.

A bucket of m lines costs m comparisons with its smallest line. Buckets that this leaves in several
parts are compared in full up to ``MAX_TILES`` tiles; larger ones are first cut by the rarest shingles
of their lines, so that lines which share no more than the band do not meet again.
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
from rowsmith.llm.tables import (
    Scratch,
    fresh,
    in_slots,
    keyed_by_row,
    numbered,
    quoted,
    slot_set,
    without_places,
    word_count,
)

SIMILARITY = 0.8
#: Characters per shingle. Eight below 256 fill one 64-bit number exactly; others are hashed to one.
SHINGLE_CHARS = 8
_FILL = 0x110000  # no character; fills shorter lines, which are one shingle
BANDS = 9
ROWS = 4
TILE = 512
#: Buckets of more tiles are cut by shingles: a line then costs a row per shingle, not a copy per tile.
MAX_TILES = 64
#: A document with fewer of its words left goes: at least four fifths of it repeat other documents.
MIN_LEFT_PERCENT = 20
_CHUNK = 8_192  # shingles counted at once
_HEADS = 4_096  # sets of shingles kept by a task


def recall(similarity: float = SIMILARITY) -> float:
    """Probability that two lines of this similarity meet in a band."""
    return 1 - (1 - similarity**ROWS) ** BANDS


def normal_line(line: str) -> bytes:
    """Words of a line in lower case, joined by single spaces; empty without words."""
    return " ".join(line.lower().split()).encode("utf-8", "surrogatepass")


def _multipliers() -> np.ndarray:
    return np.random.default_rng(20_240_602).integers(1, 2**32, BANDS * ROWS, np.uint64).astype(np.uint32) | np.uint32(1)


def _points(line: bytes) -> np.ndarray:
    """Characters of a normalised line as numbers, filled up to one shingle; in bytes if all are below 256."""
    if not line.isascii():
        text = line.decode("utf-8", "surrogatepass")
        try:
            line = text.encode("latin-1")
        except UnicodeEncodeError:
            found = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
            return np.concatenate([found, np.full(max(0, SHINGLE_CHARS - len(found)), _FILL, np.uint32)])
    if len(line) < SHINGLE_CHARS:
        return np.concatenate([np.frombuffer(line, np.uint8), np.full(SHINGLE_CHARS - len(line), _FILL, np.uint32)])
    return np.frombuffer(line, np.uint8)


def shingles(points: np.ndarray) -> np.ndarray:
    """The shingle from each place on, as a number; places near the end have none.

    Eight characters below 256 are their bytes; others are hashed.
    """
    n = len(points) - SHINGLE_CHARS + 1
    if points.dtype == np.uint8:
        # A number from each byte on.
        return np.ndarray((n,), "<u8", np.ascontiguousarray(points), 0, (1,)).copy()
    exact, hashed, wide = np.zeros(n, np.uint64), np.zeros(n, np.uint64), np.zeros(n, bool)
    for i in range(SHINGLE_CHARS):
        part = points[i : i + n].astype(np.uint64)
        exact |= part << np.uint64(8 * i)
        hashed = (hashed ^ part) * np.uint64(0xD6E8FEB86659FD93)
        hashed ^= hashed >> np.uint64(32)
        wide |= part >= 256
    return np.where(wide, hashed, exact)


def shingle_set(line: bytes) -> np.ndarray:
    """Sorted different shingles of a line."""
    found = np.sort(shingles(_points(line)))
    fresh_ones = np.empty(len(found), bool)
    fresh_ones[:1] = True
    np.not_equal(found[1:], found[:-1], out=fresh_ones[1:])
    return found[fresh_ones]


def _mixed(numbers: np.ndarray) -> np.ndarray:
    """A 32-bit hash per shingle."""
    mixed = numbers * np.uint64(0x9E3779B97F4A7C15)
    mixed ^= mixed >> np.uint64(32)
    mixed *= np.uint64(0xBF58476D1CE4E5B9)
    mixed >>= np.uint64(32)
    return mixed.astype(np.uint32)


def signatures(lines: list[bytes], multipliers: np.ndarray) -> np.ndarray:
    """A 64-bit hash per line and band."""
    points = [_points(line) for line in lines]
    found = np.empty((len(lines), BANDS), np.uint64)
    # Lines in bytes and those with wider characters apart, each kind in one array.
    in_bytes = np.array([p.dtype == np.uint8 for p in points], bool)
    for kind in (in_bytes, ~in_bytes):
        at = np.flatnonzero(kind)
        if len(at):
            found[at] = _band_hashes([points[i] for i in at], multipliers)
    return found


def _band_hashes(points: list[np.ndarray], multipliers: np.ndarray) -> np.ndarray:
    lengths = np.fromiter(map(len, points), np.int64, len(points))
    ends = np.cumsum(lengths)
    low = _mixed(shingles(np.concatenate(points)))
    # The shingles of a line, then those that reach into the next line, which are left out.
    cuts = np.stack([ends - lengths, ends - SHINGLE_CHARS + 1], axis=1).ravel()[:-1]
    minima = np.empty((len(multipliers), len(points)), np.uint64)
    mixed = np.empty_like(low)
    for k, m in enumerate(multipliers):
        np.multiply(low, m, out=mixed)
        minima[k] = np.minimum.reduceat(mixed, cuts)[::2]
    bands = np.empty((BANDS, len(points)), np.uint64)
    for b in range(BANDS):
        value = np.full(len(points), b + 1, np.uint64)
        for k in range(b * ROWS, (b + 1) * ROWS):
            value = (value ^ minima[k]) * np.uint64(0x9E3779B97F4A7C15)
            value ^= value >> np.uint64(29)
        bands[b] = value
    return bands.T


def jaccard(one: np.ndarray, two: np.ndarray) -> float:
    """Exact similarity of two sorted sets of shingles."""
    both = np.sort(np.concatenate([one, two]))
    common = int((both[1:] == both[:-1]).sum())
    return common / (len(one) + len(two) - common)


def similar_pairs(rows: list[bytes], columns: list[bytes] | None = None) -> np.ndarray:
    """Which of ``rows`` and ``columns`` (``rows`` if none) are similar, by exact counts of common shingles."""
    sets = [shingle_set(line) for line in (*rows, *(columns or []))]
    sizes = np.array([len(x) for x in sets], np.float32)
    owner = np.repeat(np.arange(len(sets)), sizes.astype(np.int64))
    numbers, flat, held = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    # A shingle of one line is common to none.
    twice = held > 1
    owner, flat = owner[twice[flat]], (np.cumsum(twice) - 1)[flat[twice[flat]]]
    numbers = numbers[twice]
    n = len(rows)
    first, second = slice(0, n), slice(n if columns else 0, None)
    common = np.zeros((n, len(sizes[second])), np.float32)
    for at in range(0, len(numbers), _CHUNK):
        width = min(_CHUNK, len(numbers) - at)
        here = slice(None) if width == len(numbers) else (flat >= at) & (flat < at + width)
        has = np.zeros((len(sets), width), np.float32)
        has[owner[here], flat[here] - at] = 1
        common += has[first] @ has[second].T
    return common >= np.float32(SIMILARITY) * (sizes[first, None] + sizes[None, second] - common) - 1e-3


def _normal_lines(texts: list[str | None]) -> tuple[list[int], list[int], list[bytes], np.ndarray]:
    """Rows, places, lines and 128-bit hashes of the normalised lines that have a word."""
    rows, places, lines = [], [], []
    for row, value in enumerate(texts):
        # The case of a letter does not depend on other lines, so a text is lower-cased at once.
        for place, raw in enumerate((value or "").lower().split("\n")):
            words = raw.split()
            if words:
                rows.append(row)
                places.append(place)
                lines.append(" ".join(words).encode("utf-8", "surrogatepass"))
    digests = b"".join(xxhash.xxh3_128_digest(x) for x in lines)
    return rows, places, lines, np.frombuffer(digests, np.int64).reshape(-1, 2)


def _bands_of(lines: list[bytes], multipliers: np.ndarray) -> np.ndarray:
    """A row of band hashes per line; few long lines and many short ones take the same memory."""
    found, at = [np.empty((0, BANDS), np.int64)], 0
    while at < len(lines):
        end, size = at, 0
        while end < len(lines) and (end == at or size + len(lines[end]) <= 1 << 18):
            size += len(lines[end])
            end += 1
        found.append(signatures(lines[at:end], multipliers).view(np.int64))
        at = end
    return np.concatenate(found)


def lines_of(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, place, high, low, bands): normalised lines with their 128-bit hash; none without words."""
    narrow = docs.select(quoted(doc_id).alias("doc_id"), quoted(text).alias("text"))
    multipliers = _multipliers()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, places, lines, digests = _normal_lines(batch.column(1).to_pylist())
            first, at = _firsts(digests)
            bands = _bands_of([lines[i] for i in first], multipliers)[at].ravel()
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, bands.size + 1, BANDS), pa.int32()), pa.array(bands))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(rows, pa.int64())), pa.array(places, pa.int32()),
                    pa.array(digests[:, 0]), pa.array(digests[:, 1]), lists,
                ],
                ["doc_id", "place", "high", "low", "bands"],
            )

    kind = docs.schema[doc_id].dataType.simpleString()
    return narrow.mapInArrow(run, f"doc_id {kind}, place int, high long, low long, bands array<long>")


def _firsts(digests: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the different hashes, and for each hash which of them it equals."""
    _, first, at = np.unique(digests[:, 0], return_index=True, return_inverse=True)
    if (digests[first[at], 1] == digests[:, 1]).all():
        return first, at
    pairs = np.ascontiguousarray(digests).view([("high", np.int64), ("low", np.int64)]).ravel()
    _, first, at = np.unique(pairs, return_index=True, return_inverse=True)
    return first, at


def _texts_of(docs: DataFrame, wanted: DataFrame, text: str) -> DataFrame:
    """(node, line) of the lines in ``wanted`` (node, high, low), a written table."""
    shared = docs.sparkSession.sparkContext.broadcast(slot_set(wanted, "high"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, _, lines, digests = _normal_lines(batch.column(0).to_pylist())
            first, _ = _firsts(digests)
            first = first[in_slots(shared.value, digests[first, 0])]
            yield pa.RecordBatch.from_arrays(
                [pa.array(digests[first, 0]), pa.array(digests[first, 1]), pa.array([lines[i] for i in first], pa.binary())],
                ["high", "low", "line"],
            )

    found = docs.select(quoted(text)).mapInArrow(run, "high long, low long, line binary")
    one = found.groupBy("high", "low").agg(F.any_value("line").alias("line"))
    return one.join(wanted, ["high", "low"]).select("node", "line")


def _members(known: DataFrame, heads: DataFrame) -> DataFrame:
    """(value, head, node) of the lines in the buckets of ``heads``, a written table."""
    shared = known.sparkSession.sparkContext.broadcast(slot_set(heads, "value"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column(1).flatten().to_numpy()
            at = np.flatnonzero(in_slots(shared.value, values))
            nodes = batch.column(0).take(pa.array(at // BANDS))
            yield pa.RecordBatch.from_arrays([pa.array(values[at]), nodes], ["value", "node"])

    possible = known.select("node", "bands").mapInArrow(run, "value long, node long")
    return possible.join(heads, "value").select("value", "head", "node")


def _similar(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    heads: dict[int, np.ndarray] = {}
    for frame in frames:
        # Rows come by b, so its set is made once.
        good, last, own = [], None, None
        for a, b, line_a, line_b in zip(*(frame[c].tolist() for c in ("a", "b", "line_a", "line_b"))):
            if a not in heads:
                if len(heads) >= _HEADS:
                    heads.clear()
                heads[a] = shingle_set(line_a)
            if b != last:
                last, own = b, shingle_set(line_b)
            head = heads[a]
            # Sets of too different sizes are not similar.
            likely = min(len(head), len(own)) >= SIMILARITY * max(len(head), len(own)) - 1e-9
            good.append(likely and jaccard(head, own) >= SIMILARITY)
        yield frame.loc[good, ["a", "b"]]


def _connect(group: pa.Table) -> pa.Table:
    """Links between members of a tile pair that are not connected yet."""
    columns = [group.column(c).to_pylist() for c in ("side", "node", "root", "line")]
    sides = [{n: (r, x) for s, n, r, x in zip(*columns) if s == side} for side in (0, 1)]
    nodes = [list(side) for side in sides]
    label = {root: root for side in sides for root, _ in side.values()}

    def find(x: int) -> int:
        while label[x] != x:
            label[x] = x = label[label[x]]
        return x

    links = []
    # A tile that is paired with itself comes as rows alone.
    lines = [[x for _, x in side.values()] for side in sides]
    if lines[0]:
        close = similar_pairs(*lines)
        others = 1 if lines[1] else 0
        for i, j in zip(*np.nonzero(close)):
            a, b = nodes[0][i], nodes[others][j]
            one, two = find(sides[0][a][0]), find(sides[others][b][0])
            if one != two:
                label[two] = one
                links.append((a, b))
    return pa.table({"a": pa.array([a for a, _ in links], pa.int64()), "b": pa.array([b for _, b in links], pa.int64())})


def line_classes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> tuple[DataFrame, DataFrame, Scratch]:
    """(lines of all documents, first place per line that is not alone in its class, what holds both).

    The first table has (doc_id, place, high, low), the second (high, low, first_doc, first_place).
    """
    scratch = Scratch(docs.sparkSession)
    found, lines_path = scratch.write(lines_of(docs, doc_id, text), "lines")
    first = F.min(F.struct("doc_id", "place")).alias("first")
    distinct = found.groupBy("high", "low").agg(first, F.count(F.lit(1)).alias("n"), F.any_value("bands").alias("bands"))
    known, _ = scratch.write(distinct.withColumn("node", F.monotonically_increasing_id()), "distinct_lines")
    counted = (
        known.select("node", F.explode("bands").alias("value"))
        .groupBy("value").agg(F.min("node").alias("head"), F.count(F.lit(1)).alias("members"))
    )
    # Only buckets with company are kept; they are few against all bands.
    heads, heads_path = scratch.write(counted.filter("members > 1").select("value", "head"), "line_heads")
    members, _ = scratch.write(_members(known, heads), "line_buckets")
    scratch.drop(heads_path)
    nodes = members.select("node").distinct()
    wanted, wanted_path = scratch.write(known.select("node", "high", "low").join(nodes, "node"), "line_members")
    text_of, text_path = scratch.write(_texts_of(docs, wanted, text), "member_lines")
    scratch.drop(wanted_path)
    pairs = members.filter("node <> head").select(F.col("head").alias("a"), F.col("node").alias("b")).distinct()
    both = pairs.join(text_of.toDF("a", "line_a"), "a").join(text_of.toDF("b", "line_b"), "b")
    accepted, _ = scratch.write(both.mapInPandas(_similar, "a long, b long"), "line_pairs")
    star, _ = scratch.write(components(accepted), "line_components")
    late, _ = scratch.write(_further_links(members, star, text_of), "line_pairs")
    scratch.drop(text_path)
    grown = star.select(F.col("node").alias("a"), F.col("component").alias("b")).union(late)
    final, _ = scratch.write(components(grown), "line_components")
    rows_with = known.select("node", "high", "low", "n", "first").join(final, "node", "left")
    component = F.coalesce("component", "node")
    kept = rows_with.filter("component is not null or n > 1").withColumn("class", component)
    firsts = kept.groupBy("class").agg(F.min("first").alias("kept"))
    classes = kept.join(firsts, "class").select(
        "high", "low", F.col("kept.doc_id").alias("first_doc"), F.col("kept.place").alias("first_place")
    )
    written, path = scratch.write(classes, "line_classes")
    scratch.drop_all(but=[path, lines_path])
    return found.select("doc_id", "place", "high", "low"), written, scratch


def _further_links(members: DataFrame, star: DataFrame, text_of: DataFrame) -> DataFrame:
    """(a, b): links in the buckets that their smallest lines do not connect."""
    rooted = members.join(star, "node", "left").withColumn("root", F.coalesce("component", "node"))
    mixed = (
        rooted.groupBy("value")
        .agg(
            F.min("root").alias("low_root"), F.max("root").alias("high_root"), F.count(F.lit(1)).alias("members"),
            F.bit_xor(F.xxhash64("node")).alias("same"), F.bit_xor(F.xxhash64("node", F.lit(1))).alias("same_too"),
        )
        # All pairs of a bucket of two have been compared, and buckets of equal members are one.
        .filter("low_root <> high_root and members > 2")
        .groupBy("same", "same_too", "members")
        .agg(F.min("value").alias("value"))
    )
    scratch = Scratch(members.sparkSession)
    open_, _ = scratch.write(rooted.join(mixed.select("value", "members"), "value").select("value", "node", "root", "members"), "open_buckets")
    bound = TILE * MAX_TILES
    small, large = open_.filter(F.col("members") <= bound), open_.filter(F.col("members") > bound)
    if not large.isEmpty():
        parts, _ = scratch.write(_parted(large, text_of), "open_buckets")
        sizes = parts.groupBy("value").agg(F.count(F.lit(1)).alias("members"), F.min("root").alias("a"), F.max("root").alias("b"))
        small = small.union(parts.join(sizes.filter("a <> b"), "value").select("value", "node", "root", "members"))
    tiled = small.withColumn("tiles", F.ceil(F.col("members") / TILE).cast("int"))
    tile = F.pmod(F.xxhash64("node"), F.col("tiles")).cast("int")
    others = F.sequence(F.lit(0), F.col("tiles") - 1)
    rows = tiled.select("value", "node", "root", F.lit(0).alias("side"), tile.alias("i"), F.explode(others).alias("j"))
    columns = tiled.select("value", "node", "root", F.lit(1).alias("side"), F.explode(others).alias("i"), tile.alias("j"))
    tiles = rows.filter("i <= j").union(columns.filter("i < j")).join(text_of, "node")
    return tiles.groupBy("value", "i", "j").applyInArrow(_connect, "a long, b long")


def _parted(large: DataFrame, text_of: DataFrame) -> DataFrame:
    """(value, node, root): large buckets cut into parts such that similar lines share one.

    Of two lines with a similarity of at least 4/5, both hold one of the rarest fifth, and one
    more, of their own shingles in common, whatever the order, if it is the same for all lines of
    the bucket. Here it is how few lines of the bucket have the shingle. So a line goes to a part
    per rare shingle, and lines that share only what is common in the bucket do not meet.
    """
    lines = large.join(text_of, "node").select("value", "node", "root", "line")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingle_set(line).view(np.int64) for line in batch.column(3).to_pylist()]
            at = pa.array(np.repeat(np.arange(len(sets)), [len(x) for x in sets]))
            shingles_of = pa.array(np.concatenate([np.empty(0, np.int64), *sets]))
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(i).take(at) for i in range(3)], shingles_of], ["value", "node", "root", "shingle"]
            )

    each = lines.mapInArrow(run, "value long, node long, root long, shingle long")
    # Shingles that lie in one connected part of the bucket link nothing new.
    counts = each.groupBy("value", "shingle").agg(
        F.count(F.lit(1)).alias("n"), (F.min("root") != F.max("root")).alias("links")
    )
    ranked = (
        each.join(counts, ["value", "shingle"])
        .groupBy("value", "node", "root")
        .agg(F.array_sort(F.collect_list(F.struct("n", "shingle", "links"))).alias("all"))
    )
    size = F.size("all")
    rarest = F.slice("all", 1, size - F.ceil(size * 4 / 5).cast("int") + 1)
    kept = ranked.select("value", "node", "root", F.explode(rarest).alias("s")).filter("s.links")
    return kept.select(F.xxhash64("value", "s.shingle").alias("value"), "node", "root")


def repeated_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, line, first_doc, first_line, kept): all lines that are not alone in their class.

    Lines count from 0. ``kept`` marks the line that stays: the first by document and place,
    a null id before all others. Every line that has a word is compared, however short.
    Rows that share an id count as one document with the lines of all of them. No documents:
    no rows.
    """
    lines, classes, _ = line_classes(docs, doc_id, text)
    kept = F.col("doc_id").eqNullSafe(F.col("first_doc")) & (F.col("place") == F.col("first_place"))
    return lines.join(classes, ["high", "low"]).select(
        "doc_id", F.col("place").alias("line"), "first_doc", F.col("first_place").alias("first_line"), kept.alias("kept")
    )


def deduplicated(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", n_chars: str | None = "n_chars"
) -> DataFrame:
    """``docs`` with the repeated lines taken out of their texts, less the depleted documents.

    Each row is a document of its own, whatever its id: of equal or similar lines the first by
    (doc_id, row, place) stays, a null id before all others. A document is depleted, and goes, if
    less than ``MIN_LEFT_PERCENT`` of its words are left: all but these repeat lines that stay
    elsewhere, so it is a near copy. Documents that lose no line stay, those without words
    included; a null text stays null. ``n_chars``, if there is such a column, follows the new text.
    """
    scratch = Scratch(docs.sparkSession)
    rows, row = numbered(docs)
    keyed = keyed_by_row(rows, row, doc_id, text)
    places, classes, of_classes = line_classes(keyed)
    kept = (F.col("doc_id") == F.col("first_doc")) & (F.col("place") == F.col("first_place"))
    key, lines, before = fresh(rows, "__key"), fresh(rows, "__lines"), fresh(rows, "__before")
    # One row per document that loses a line, with at most as many numbers as it has lines.
    per_doc, _ = scratch.write(
        places.join(classes, ["high", "low"]).filter(~kept)
        .groupBy(F.struct("doc_id.file", "doc_id.at").alias(key)).agg(F.sort_array(F.collect_list("place")).alias(lines)),
        "removed_lines",
    )
    of_classes.drop_all()
    changed = F.col(lines).isNotNull()
    # Half of all documents may lose a line: the table grows with them and is never broadcast.
    found = rows.join(per_doc.hint("merge"), quoted(row) == F.col(key), "left").withColumns(
        {before: F.when(changed, word_count(quoted(text))), text: F.when(changed, without_places(quoted(text), F.col(lines))).otherwise(quoted(text))}
    )
    if n_chars in docs.columns:
        kind = docs.schema[n_chars].dataType
        found = found.withColumn(n_chars, F.when(changed, F.length(quoted(text)).cast(kind)).otherwise(quoted(n_chars)))
    depleted = changed & (word_count(quoted(text)) * 100 < F.col(before) * MIN_LEFT_PERCENT)
    return found.filter(~depleted).select(*[quoted(c) for c in docs.columns])
