"""The identity of a row: what tells equal rows apart and is the same whenever a task runs again.

A number that counts the rows of a task is not: after a shuffle the rows of a task come in any
order, so a task that runs again would number them anew. Rows of Parquet files are known by their
file and their place in it, at no cost. Other rows are written once and then known by that.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowsmith.operators.columns import quoted
from rowsmith.storage import materialize

#: Nodes of a plan that keep every row of a scan the row it was, or drop it.
_KEEPS_ROWS = ("Project", "Filter", "SubqueryAlias")


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores in front until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def identified(df: DataFrame, name: str = "__row") -> tuple[DataFrame, str]:
    """``df`` with the identity of each row, a struct (file, at), and the name of that column.

    The file is a 64-bit hash of its path: two files of one table share it with a chance of one in
    tens of millions even among a million files.
    """
    name = free_name(df, name)
    if not is_file_scan(df):
        df = materialize(df, "identified")
    if "_metadata" in {c.lower() for c in df.columns}:
        place = F.struct(F.lit(0).cast("long").alias("file"), F.monotonically_increasing_id().alias("at"))
        return materialize(df.withColumn(name, place), "identified"), name
    place = F.struct(F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("at"))
    return df.withColumn(name, place), name


def is_file_scan(df: DataFrame) -> bool:
    """Is ``df`` a scan of Parquet files, at most with columns chosen and rows filtered?"""
    node = df._jdf.queryExecution().analyzed()
    while node.nodeName() in _KEEPS_ROWS:
        node = node.children().head()
    return node.nodeName() == "LogicalRelation" and node.toString().strip().lower().endswith("parquet")


def salt(row: str) -> Column:
    """A number of the row, not negative, that spreads rows over tasks."""
    return F.shiftrightunsigned(F.xxhash64(quoted(row)), 1)
