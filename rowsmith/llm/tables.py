"""Helpers shared by the operators: free column names, written tables, document lookups."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rowsmith.operators.identity import identified
from rowsmith.storage import scratch_path

#: A word, as the contracts define it: a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
GAP = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def quoted(name: str) -> Column:
    """A column by its exact name, dots and back ticks included."""
    return F.col("`" + name.replace("`", "``") + "`")


def fresh(df: DataFrame, name: str) -> str:
    """``name``, with underscores in front until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def word_count(text: Column) -> Column:
    """Number of words as long; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def held_out(doc_id: Column, parts: int = 4, part: int = 2) -> Column:
    """Rows whose labels must not be learnt from; false for a null id."""
    remainder = F.pmod(F.crc32(doc_id.cast("string")), F.lit(parts))
    return F.coalesce(remainder == part, F.lit(False))


class Scratch:
    """Tables written below the shared folder; each can go once nothing reads it any more."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.paths: list[str] = []

    def write(self, df: DataFrame, name: str, compression: str = "snappy") -> tuple[DataFrame, str]:
        """Write ``df`` and return the scan of the files with their path. Ends the lineage."""
        path = scratch_path(self.spark, name)
        df.write.parquet(path, compression=compression)
        self.paths.append(path)
        return self.spark.read.schema(df.schema).parquet(path), path

    def drop(self, path: str) -> None:
        jvm = self.spark._jvm
        place = jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(place, True)
        self.paths = [p for p in self.paths if p != path]

    def drop_all(self, but: Sequence[str] = ()) -> None:
        """Delete what this object has written, except for ``but``."""
        for path in [p for p in self.paths if p not in but]:
            self.drop(path)


#: Bits of a slot set: 16 MB, whatever the size of the data.
SLOT_BITS = 27
#: A word of a slot set as it comes to the driver, and so many words per row.
_SLOT_WORD = np.dtype([("word", ">i4"), ("bits", ">i8")])
_ROW_WORDS = 1 << 10


def slot_set(rows: DataFrame, number: str) -> np.ndarray:
    """A set of 2 ** ``SLOT_BITS`` bits with the low bits of a long column, as 64-bit words.

    A number whose bit is missing is not among the rows; one whose bit is set may be, so an exact
    join must follow. The set has a fixed size: with more than some ten million different numbers
    it lets more and more others through, and the join after it has more to do. The words come to
    the driver as bytes, 12 for each: as rows of Python numbers they take some 500.
    """
    word = F.shiftright(F.col(number), 6).bitwiseAND(F.lit((1 << (SLOT_BITS - 6)) - 1)).alias("word")
    bit = F.expr(f"shiftleft(1L, cast(`{number}` & 63 as int))").alias("bit")
    found = rows.select(word, bit).groupBy("word").agg(F.bit_or("bit").alias("bits"))
    digits = F.concat(F.lpad(F.hex("word"), 8, "0"), F.lpad(F.hex("bits"), 16, "0"))
    packed = found.groupBy(F.floor(F.col("word") / _ROW_WORDS)).agg(
        F.unhex(F.array_join(F.collect_list(digits), "")).alias("words")
    )
    words = np.zeros(1 << (SLOT_BITS - 6), np.int64)
    for row in packed.select("words").collect():
        part = np.frombuffer(row["words"], _SLOT_WORD)
        words[part["word"]] = part["bits"]
    return words


def in_slots(words: np.ndarray, numbers: np.ndarray) -> np.ndarray:
    """Which of the numbers, as signed longs, may be in the set."""
    at = (numbers >> 6) & ((1 << (SLOT_BITS - 6)) - 1)
    return (words[at] >> (numbers & 63)) & 1 == 1


def numbered(docs: DataFrame) -> tuple[DataFrame, str]:
    """``docs`` with the identity (file, at) of each row, and the name of that column.

    Rows that come straight from files are known by their place there; others are written once.
    """
    return identified(docs, "__row")


def keyed_by_row(docs: DataFrame, row: str, doc_id: str, text: str) -> DataFrame:
    """(doc_id, text) with the row's identity in the key: rows differ, and ties are broken, by (doc_id, row)."""
    key = F.struct(quoted(doc_id).alias("id"), *[quoted(row)[part].alias(part) for part in ("file", "at")])
    return docs.select(key.alias("doc_id"), quoted(text).alias("text"))


#: Ids of at most this many rows are broadcast to filter a table that then stays in place.
BROADCAST_ROWS = 2_000_000


def rows_of(docs: DataFrame, ids: DataFrame, key: str = "doc_id", how: str = "left_semi") -> DataFrame:
    """Rows of ``docs`` whose key is (``left_semi``) or is not (``left_anti``) among ``ids``.

    ``ids`` is a written table of one column. A null key of ``docs`` is never found in it. It is
    counted, and broadcast up to ``BROADCAST_ROWS``; beyond that the join shuffles.
    """
    name = fresh(docs, "__key")
    wanted = ids.toDF(name).filter(F.col(name).isNotNull())
    small = wanted.count() <= BROADCAST_ROWS
    return docs.join(F.broadcast(wanted) if small else wanted, quoted(key) == F.col(name), how)


def without_places(text: Column, places: Column) -> Column:
    """``text`` without the lines at ``places``, sorted numbers from 0; linear in the length of the text."""

    def left(lines: Column) -> Column:
        n = F.size(places)

        def run(j: Column) -> Column:
            start = F.when(j == 0, 0).otherwise(F.get(places, j - 1) + 1)
            end = F.when(j == n, F.size(lines)).otherwise(F.get(places, j))
            return F.slice(lines, start + 1, end - start)

        return F.array_join(F.flatten(F.transform(F.sequence(F.lit(0), n), run)), "\n")

    # Bound to a variable, so that the text is split once.
    return F.get(F.transform(F.array(F.split(text, "\n", -1)), left), 0)
