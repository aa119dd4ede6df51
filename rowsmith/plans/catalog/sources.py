"""Generated rows, and delimited files: a table of the folder written and scanned back."""

from __future__ import annotations

from pyspark.sql import functions as F

from rowsmith.operators.columns import cast_to_double
from rowsmith.plans.catalog.registry import query, table
from rowsmith.sources.delimited import read_delimited, read_headerless, write_delimited
from rowsmith.sources.generated import number_range
from rowsmith.storage import scratch_path

@query(
    "number_range",
    """select x, x * 2 as doubled, x % 2 = 0 as even, o_totalprice
    from (select unnest(range((select min(o_orderkey) from orders), (select max(o_orderkey) + 1 from orders))) as x)
    left join orders on o_orderkey = x""",
)
def numbers(spark, folder):
    """All numbers between the smallest and the largest order key, with the order of each."""
    orders = table(spark, folder, "orders").select("o_orderkey", "o_totalprice")
    low, high = orders.agg(F.min("o_orderkey"), F.max("o_orderkey")).first()
    x = F.col("x")
    rows = number_range(spark, low, high + 1).join(orders, x == F.col("o_orderkey"), "left")
    return rows.select("x", (x * 2).alias("doubled"), (x % 2 == 0).alias("even"), "o_totalprice")


ORDER_COLUMNS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority"]
ORDERS_SQL = f"select {', '.join(ORDER_COLUMNS)} from orders"


def _written(spark, folder, name, columns, header):
    path = scratch_path(spark, name)
    write_delimited(table(spark, folder, name).select(*columns), path, header=header)
    return path


@query("csv_with_schema", ORDERS_SQL)
def csv_with_schema(spark, folder):
    path = _written(spark, folder, "orders", ORDER_COLUMNS, header=True)
    schema = """o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double,
                o_orderpriority string"""
    return read_delimited(spark, path, schema)


@query("csv_inferred", ORDERS_SQL)
def csv_inferred(spark, folder):
    path = _written(spark, folder, "orders", ORDER_COLUMNS, header=True)
    rows = read_delimited(spark, path)
    return rows.withColumns({c: F.col(c).cast("bigint") for c in ("o_orderkey", "o_custkey")})


@query(
    "csv_unreadable_numbers",
    """select o_orderkey, cast(null as double) as o_orderstatus, o_totalprice from orders""",
)
def csv_unreadable_numbers(spark, folder):
    columns = ["o_orderkey", "o_orderstatus", "o_totalprice"]
    path = _written(spark, folder, "orders", columns, header=True)
    schema = "o_orderkey bigint, o_orderstatus double, o_totalprice double"
    return read_delimited(spark, path, schema)


@query(
    "csv_headerless",
    """select c_custkey::varchar as id, c_name as name, c_nationkey::varchar as nation,
       c_mktsegment as segment from customer""",
)
def csv_headerless(spark, folder):
    columns = ["c_custkey", "c_name", "c_nationkey", "c_mktsegment"]
    path = _written(spark, folder, "customer", columns, header=False)
    return read_headerless(spark, path, ["id", "name", "nation", "segment"])


@query(
    "csv_headerless_cast",
    """select c_custkey::double as id, c_acctbal as balance, c_mktsegment as segment
       from customer""",
)
def csv_headerless_cast(spark, folder):
    columns = ["c_custkey", "c_acctbal", "c_mktsegment"]
    path = _written(spark, folder, "customer", columns, header=False)
    rows = read_headerless(spark, path, ["id", "balance", "segment"])
    return cast_to_double(rows, keep=["segment"])
