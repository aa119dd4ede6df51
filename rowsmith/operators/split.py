"""Train and test splits that come out the same on every run."""

from __future__ import annotations

from fractions import Fraction

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rowsmith.fixed_values import SPLIT_SEED, TRAIN_FRACTION
from rowsmith.functions.numbers import HASH_DIGITS, HASH_RANGE, key_hash
from rowsmith.operators.columns import quoted
from rowsmith.operators.lookup import BROADCAST_BYTES, KeyTable, attach
from rowsmith.storage import materialize

TRAIN, TEST = "train", "test"
# Hash digits added per pass: 16**3 buckets per class.
STEP_DIGITS = 3
DIGEST_DIGITS = 32
BOUNDARY_ROWS = 100_000

_CUTOFF = "__cutoff"
_ROW = "__row"


def random_split(
    df: DataFrame,
    key: str,
    fraction: str = TRAIN_FRACTION,
    seed: int = SPLIT_SEED,
    name: str = "split",
) -> DataFrame:
    """Mark about ``fraction`` of the rows as train by the hash of their key.

    No shuffle. A row keeps its side when a task runs again, so the sides never overlap. Rows
    with equal keys share a side; a row without a key is decided by all its other values.
    """
    bound = format(int(Fraction(fraction) * HASH_RANGE), f"0{HASH_DIGITS}x")
    own = F.concat(F.lit("row:"), F.xxhash64(*[quoted(c) for c in df.columns]).cast("string"))
    digest = key_hash(F.coalesce(quoted(key).cast("string"), own), seed)
    is_train = F.substring(digest, 1, HASH_DIGITS) < bound
    return df.withColumn(name, F.when(is_train, TRAIN).otherwise(TEST))


def stratified_split(
    df: DataFrame,
    label: str,
    key: str,
    fraction: str = TRAIN_FRACTION,
    seed: int | None = None,
    name: str = "split",
    boundary_rows: int = BOUNDARY_ROWS,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Mark exactly floor(fraction * n) rows of each class as train, in order of key hash.

    The rows stay where they are. What is searched is one cutoff hash per class: counts
    per hash prefix show in which prefix the cutoff lies, and only that prefix is looked
    into further. Rows that share a key share a side, at the cost of exact counts if a key
    repeats at the cutoff. Rows without a key are written, numbered and split one by one.
    """
    number = _ROW
    while number in df.columns:
        number = f"_{number}"
    columns = df.columns
    df = _numbered_without_key(df, key, number)
    digest = key_hash(F.coalesce(quoted(key).cast("string"), F.concat(F.lit("row:"), F.col(number))), seed)
    narrow = df.select(quoted(label).alias("key"), digest.alias("digest"))
    cutoffs = _cutoffs(narrow, Fraction(fraction), boundary_rows, broadcast_bytes)
    located = attach(df, quoted(label), cutoffs, True, broadcast_bytes)
    is_train = digest <= F.col(_CUTOFF)
    marked = located.withColumn(name, F.when(is_train, TRAIN).otherwise(TEST))
    return marked.select(*[quoted(c) for c in columns if c != name], quoted(name))


def _numbered_without_key(df: DataFrame, key: str, number: str) -> DataFrame:
    """``df`` with a number for every row that has no key; only these rows are written."""
    without = df.filter(quoted(key).isNull())
    with_key = df.withColumn(number, F.lit(None).cast("string"))
    # Parquet knows the nulls of a row group, so this reads little where there are none.
    if without.isEmpty():
        return with_key
    written = materialize(
        without.withColumn(number, F.monotonically_increasing_id().cast("string")), "rows_without_key"
    )
    return with_key.filter(quoted(key).isNotNull()).unionByName(written)


def _cutoffs(
    narrow: DataFrame, fraction: Fraction, boundary_rows: int, broadcast_bytes: int
) -> KeyTable:
    digits = STEP_DIGITS
    buckets = narrow.groupBy("key", _prefix(digits)).agg(F.count(F.lit(1)).alias("inside"))
    whole = Window.partitionBy("key")
    counted = buckets.withColumn("n", F.sum("inside").over(whole))
    wanted = F.expr(f"n * {fraction.numerator}L div {fraction.denominator}L")
    table = _boundary(counted.withColumn("need", wanted), "boundary")
    while True:
        size = table.agg(*KeyTable.size_columns(), F.max("inside").alias("widest")).first()
        known = KeyTable(
            table, ("prefix", "need", "n"), size["n_keys"], size["n_bytes"], size["total"]
        )
        if not size["widest"] or size["widest"] <= boundary_rows or digits >= DIGEST_DIGITS:
            break
        within = _in_boundary(narrow, known, digits, broadcast_bytes)
        digits += STEP_DIGITS
        finer = within.groupBy("key", "n", "need", _prefix(digits)).agg(
            F.count(F.lit(1)).alias("inside")
        )
        table = _boundary(finer, "boundary")
    within = _in_boundary(narrow, known, digits, broadcast_bytes)
    hashes = within.groupBy("key", "n", "need", "digest").agg(F.count(F.lit(1)).alias("inside"))
    by_digest = Window.partitionBy("key").orderBy("digest")
    upto = F.sum("inside").over(by_digest.rowsBetween(Window.unboundedPreceding, 0))
    cutoffs = (
        hashes.withColumn("upto", upto)
        .filter(F.col("upto") >= F.col("need"))
        .groupBy("key", "n")
        .agg(F.min("digest").alias(_CUTOFF))
    )
    # No more classes than in the measured boundary table.
    written = materialize(cutoffs, "split_cutoffs")
    return KeyTable(written, (_CUTOFF,), known.n_keys, known.n_bytes, known.total)


def _prefix(digits: int) -> Column:
    return F.substring("digest", 1, digits).alias("prefix")


def _boundary(buckets: DataFrame, name: str) -> DataFrame:
    """The bucket of each class in which its ``need``-th row lies; none for need 0."""
    by_prefix = Window.partitionBy("key").orderBy("prefix")
    upto = F.sum("inside").over(by_prefix.rowsBetween(Window.unboundedPreceding, 0))
    before = F.col("upto") - F.col("inside")
    found = (
        buckets.withColumn("upto", upto)
        .filter((before < F.col("need")) & (F.col("need") <= F.col("upto")))
        .select("key", "prefix", "inside", "n", (F.col("need") - before).alias("need"))
    )
    return materialize(found, name)


def _in_boundary(
    narrow: DataFrame, known: KeyTable, digits: int, broadcast_bytes: int
) -> DataFrame:
    located = attach(narrow, F.col("key"), known, True, broadcast_bytes)
    return located.filter(F.substring("digest", 1, digits) == F.col("prefix")).drop("prefix")


def parts(df: DataFrame, name: str = "split") -> tuple[DataFrame, DataFrame]:
    """Train and test rows of a marked table."""
    return (
        df.filter(quoted(name) == TRAIN).drop(name),
        df.filter(quoted(name) == TEST).drop(name),
    )
