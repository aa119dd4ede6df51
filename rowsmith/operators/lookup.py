"""Left join of a large table to tables of per-key values.

The per-key table is measured before it is joined. Up to ``broadcast_bytes`` it is
broadcast and the large side stays where it is; the lookups of several columns share one
such budget. Beyond that the join shuffles: keys that hold a large share of the rows are
answered from a broadcast of those few keys and their rows are spread, so that no key
decides the size of a task.

Several large tables are not joined one after the other, each time with the whole rows.
Their keys are joined once in long form, a narrow row per row and column, and the values
found come back to the rows in one shuffle.

Rows are spread by their identity, which is the same when a task runs again.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowsmith.operators.columns import quoted
from rowsmith.operators.identity import free_name, identified, salt
from rowsmith.storage import materialize

BROADCAST_BYTES = 128 * 1024 * 1024
ROW_OVERHEAD_BYTES = 64
# A key is hot if it holds more than a quarter of an even task's rows. There are at most
# MAX_HOT_KEYS such keys whatever the number of tasks, so their table can be broadcast.
HOT_PER_TASK = 4
MAX_HOT_KEYS = 50_000


@dataclass(frozen=True)
class KeyTable:
    """Per-key values with their measured size.

    ``rows`` has the columns ``key``, ``n`` (rows per key in the data it was counted
    on) and ``payload``; ``total`` is the sum of ``n``.
    """

    rows: DataFrame
    payload: tuple[str, ...]
    n_keys: int
    n_bytes: int
    total: int
    counted: bool = True

    @staticmethod
    def size_columns(key: str = "key", n: str = "n") -> list[Column]:
        """Aggregates that measure a table; read with ``from_measure``."""
        width = F.coalesce(F.octet_length(F.col(key).cast("string")), F.lit(0))
        return [
            F.count(F.lit(1)).alias("n_keys"),
            F.coalesce(F.sum(width + ROW_OVERHEAD_BYTES), F.lit(0)).alias("n_bytes"),
            F.coalesce(F.sum(n), F.lit(0)).alias("total"),
        ]

    @classmethod
    def measured(cls, rows: DataFrame, payload: tuple[str, ...]) -> KeyTable:
        """Measure a written table of (key, n, payload) with one small job."""
        size = rows.agg(*cls.size_columns()).first()
        return cls(rows, payload, size["n_keys"], size["n_bytes"], size["total"])

    @classmethod
    def of_values(cls, values: DataFrame, key: str, payload: tuple[str, ...]) -> KeyTable:
        """A dictionary table, one row per key, without counts of its own."""
        rows = values.select(quoted(key).alias("key"), F.lit(1).alias("n"), *payload)
        size = rows.agg(*cls.size_columns()).first()
        return cls(rows, payload, size["n_keys"], size["n_bytes"], size["total"], counted=False)


def broadcastable(sizes: dict, budget: int = BROADCAST_BYTES) -> set:
    """Names of the tables, smallest first, whose sizes together stay within the budget."""
    chosen = set()
    for name in sorted(sizes, key=sizes.__getitem__):
        if sizes[name] > budget:
            break
        budget -= sizes[name]
        chosen.add(name)
    return chosen


def attach(
    df: DataFrame,
    key: Column,
    table: KeyTable,
    null_safe: bool = False,
    broadcast_bytes: int = BROADCAST_BYTES,
    row: str | None = None,
) -> DataFrame:
    """Add the payload of ``table`` to each row of ``df``; null where the key is unknown.

    A null key finds nothing unless ``null_safe``, which lets it match a null key. Hot keys
    are those of the data the table was counted on; for a table without counts the keys of
    ``df`` are counted before a shuffled join. ``row`` names a column with the identity of the
    rows; without it a shuffled join takes that of ``identified``.
    """
    if table.n_bytes > broadcast_bytes:
        return _attach_shuffled(df, key, table, null_safe, row)
    name = free_name(df, "__key")
    values = table.rows.select(F.col("key").alias(name), *table.payload)
    joined = df.join(F.broadcast(values), _matches(key, quoted(name), null_safe), "left")
    return joined.drop(name)


def _is_hot(df: DataFrame, table: KeyTable) -> Column:
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return F.col("n") * min(HOT_PER_TASK * tasks, MAX_HOT_KEYS) >= table.total


def _attach_shuffled(df: DataFrame, key: Column, table: KeyTable, null_safe: bool, row: str | None) -> DataFrame:
    kept = df.columns
    if row is None:
        df, row = identified(df)
    table = table if table.counted else _counted(df, key, table)
    is_hot = _is_hot(df, table)
    names = {p: free_name(df, f"__hot_{p}") for p in table.payload}
    key_name, hot_name, salt_name = (free_name(df, n) for n in ("__key", "__hot", "__salt"))
    hot = table.rows.filter(is_hot).select(
        F.col("key").alias(key_name), F.lit(True).alias(hot_name), *[F.col(p).alias(new) for p, new in names.items()]
    )
    # Always 0, but taken from a column: a literal would be folded out of the join key
    # and the salt would no longer decide where a row goes.
    zero = F.least(F.col("n"), F.lit(0)).cast("long")
    cold_salt = free_name(df, "__salt_cold")
    cold = table.rows.filter(~is_hot).select(F.col("key").alias(key_name), zero.alias(cold_salt), *table.payload)
    answered = quoted(hot_name).isNotNull()
    if not null_safe:
        answered = answered | key.isNull()
    marked = (
        df.join(F.broadcast(hot), _matches(key, quoted(key_name), null_safe), "left")
        .drop(key_name)
        .withColumn(salt_name, F.when(answered, -1 - salt(row)).otherwise(F.lit(0).cast("long")))
    )
    joined = marked.join(
        cold, _matches(key, quoted(key_name), null_safe) & (quoted(salt_name) == quoted(cold_salt)), "left"
    )
    return joined.select(
        *[quoted(c) for c in kept], *[F.coalesce(quoted(new), quoted(p)).alias(p) for p, new in names.items()]
    )


@dataclass(frozen=True)
class Lookup:
    """One column to look up: its key, a text, and a table with one payload column."""

    key: Column
    table: KeyTable
    null_safe: bool = False


def attach_all(
    df: DataFrame, lookups: Sequence[Lookup], broadcast_bytes: int = BROADCAST_BYTES, row: str | None = None
) -> DataFrame:
    """Add the payload of every lookup to each row, in the order of the lookups.

    The smallest tables that together stay within ``broadcast_bytes`` are broadcast. One larger
    table is joined with the rows; several are joined in long form and their values brought back
    to the rows in one shuffle.
    """
    small = broadcastable({i: x.table.n_bytes for i, x in enumerate(lookups)}, broadcast_bytes)
    large = [x for i, x in enumerate(lookups) if i not in small]
    kept = df.columns
    if len(large) > 1:
        df = _attach_long(df, large, row)
    elif large:
        df = attach(df, large[0].key, large[0].table, large[0].null_safe, 0, row)
    for x in (x for i, x in enumerate(lookups) if i in small):
        df = attach(df, x.key, x.table, x.null_safe, max(broadcast_bytes, x.table.n_bytes), row)
    return df.select(*[quoted(c) for c in kept], *[quoted(x.table.payload[0]) for x in lookups])


def _attach_long(df: DataFrame, lookups: Sequence[Lookup], row: str | None) -> DataFrame:
    """Join the keys of several tables at once: (row, column, key) with (column, key, value)."""
    kept = df.columns
    if row is None:
        df, row = identified(df)
    keyed = ("column", "missing", "key")
    # A null key is marked, so that it is a key like any other, and left out where it finds nothing.
    entries = [
        F.struct(F.lit(i).alias("column"), x.key.isNull().alias("missing"), F.coalesce(x.key, F.lit("")).alias("key"))
        for i, x in enumerate(lookups)
    ]
    long = df.select(quoted(row).alias("row"), F.inline(F.array(*entries)))
    finds_null = [i for i, x in enumerate(lookups) if x.null_safe]
    long = long.filter(~F.col("missing") | F.col("column").isin(finds_null) if finds_null else ~F.col("missing"))
    tables = []
    for i, x in enumerate(lookups):
        table = x.table if x.table.counted else _counted(df, x.key, x.table)
        tables.append(
            table.rows.select(
                F.lit(i).alias("column"), F.col("key").isNull().alias("missing"), F.coalesce("key", F.lit("")).alias("key"),
                _is_hot(df, table).alias("hot"), F.col(table.payload[0]).alias(f"v{i}"),
            )
        )
    values = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)
    names = [f"v{i}" for i in range(len(lookups))]
    # At most MAX_HOT_KEYS keys per table; their rows need no join by key any more.
    hot = F.broadcast(values.filter("hot").select(*keyed, *names, F.lit(True).alias("answered")))
    marked = long.join(hot, list(keyed), "left")
    answered = marked.filter("answered").select("row", *names)
    rest = marked.filter("answered is null").select("row", *keyed).join(values.filter("not hot"), list(keyed)).select("row", *names)
    back = free_name(df, "__found")
    found = answered.union(rest).groupBy(F.col("row").alias(back)).agg(*[F.max(n).alias(f"__{n}") for n in names])
    found = found.select(back, *[F.col(f"__v{i}").alias(x.table.payload[0]) for i, x in enumerate(lookups)])
    joined = df.join(found, quoted(row) == quoted(back), "left")
    return joined.select(*[quoted(c) for c in kept], *[quoted(x.table.payload[0]) for x in lookups])


def _counted(df: DataFrame, key: Column, table: KeyTable) -> KeyTable:
    """``table`` with the rows of each key in ``df``; keys it lacks are added without values."""
    seen = df.groupBy(key.alias("seen")).agg(F.count(F.lit(1)).alias("n_seen"))
    # A null key of the table and the rows without a key are one key.
    rows = table.rows.drop("n").join(seen, F.col("key").eqNullSafe(F.col("seen")), "full")
    counted = rows.select(
        F.coalesce("key", "seen").alias("key"), F.coalesce("n_seen", F.lit(0)).alias("n"), *table.payload
    )
    return KeyTable.measured(materialize(counted, "lookup_counts"), table.payload)


def _matches(probe: Column, build: Column, null_safe: bool) -> Column:
    return probe.eqNullSafe(build) if null_safe else probe == build
