"""Word shingles as DataFrame expressions, and exact containment of one set in another."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SHINGLE_WORDS = 5
#: Containment of at least 4/5, compared in whole numbers.
SHARE = (4, 5)
#: Pieces of a broadcast side; a larger side is joined in several passes of this size.
BROADCAST_BYTES = 32 * 1024 * 1024
_BREAK = r"[^\p{L}\p{N}]+"


def words(text: Column) -> Column:
    """Lower-cased runs of letters and digits; no words for null."""
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), _BREAK), "")


def shingles(text: Column, k: int = SHINGLE_WORDS) -> Column:
    """Hashes of the ``k``-word shingles in order; fewer words make one shingle, none no shingle.

    The words are bound to a variable, so that they are split once wherever Spark moves the
    expression. A filter on it, also one that Spark infers for explode(), would compute it twice.
    """

    def of(found: Column) -> Column:
        n = F.size(found)
        starts = F.sequence(F.lit(0), n - k)
        each = F.transform(starts, lambda i: F.xxhash64(*[F.get(found, i + j) for j in range(k)]))
        whole = F.array(F.xxhash64(F.concat_ws(" ", found)))
        return F.when(n >= k, each).when(n > 0, whole).otherwise(F.array().cast("array<long>"))

    return F.get(F.transform(F.array(words(text)), of), 0)


def with_shingles(df: DataFrame, text: Column, name: str = "shingles", k: int = SHINGLE_WORDS) -> DataFrame:
    return df.withColumn(name, shingles(text, k))


def permutations(n: int) -> list[int]:
    """``n`` fixed 64-bit constants. XOR with one of them permutes hashes at random."""
    found, state = [], 0x243F6A8885A308D3
    for _ in range(n):
        state = (state * 6364136223846793005 + 1442695040888963407) % 2**64
        mixed = (state ^ (state >> 29)) * 0xBF58476D1CE4E5B9 % 2**64
        found.append(((mixed ^ (mixed >> 32)) % 2**64) - 2**63)
    return found


def is_contained(matched: Column, n: Column) -> Column:
    return matched * SHARE[1] >= n * SHARE[0]


def broadcast_blocks(rows: DataFrame, n_longs: Column, key: str) -> list[DataFrame]:
    """``rows``, a written table, in parts that are small enough to broadcast."""
    size = rows.agg(F.sum(n_longs.cast("long") * 8 + 64)).first()[0] or 0
    n = -(-size // BROADCAST_BYTES)
    # Twice as many parts as the size asks for, so that uneven parts stay within the bound too.
    parts = 1 if n <= 1 else 2 * n
    return [rows.filter(F.pmod(F.xxhash64(key), F.lit(parts)) == i) for i in range(parts)]
