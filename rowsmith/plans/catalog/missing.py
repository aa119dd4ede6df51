"""Missing values. The tables have no nulls, so they are planted."""

from __future__ import annotations

from pyspark.sql import functions as F

from rowsmith.operators import filters, missing
from rowsmith.plans.catalog.registry import query, table


def _planted(spark, folder):
    return table(spark, folder, "lineitem").select(
        "l_orderkey",
        "l_partkey",
        F.nullif(F.col("l_discount"), F.lit(0.0)).alias("l_discount"),
        F.when(F.col("l_tax") == 0, F.lit(float("nan"))).otherwise(F.col("l_tax")).alias("l_tax"),
        F.nullif(F.col("l_linenumber"), F.lit(1)).alias("l_linenumber"),
    )


PLANTED = """
    with planted as (
        select l_orderkey, l_partkey, nullif(l_discount, 0.0) as l_discount,
               nullif(l_tax, 0.0) as l_tax,
               cast(nullif(l_linenumber, 1) as double) as l_linenumber
        from lineitem)
"""
FILLED = ["l_discount", "l_tax", "l_linenumber"]


def _rounded(df):
    return df.withColumns({c: F.round(c, 8) for c in FILLED})


@query(
    "mean_fill",
    PLANTED
    + """, means as (select avg(l_discount) d, avg(l_tax) t, avg(l_linenumber) n from planted)
    select l_orderkey, l_partkey, round(coalesce(l_discount, d), 8) as l_discount,
           round(coalesce(l_tax, t), 8) as l_tax,
           round(coalesce(l_linenumber, n), 8) as l_linenumber
    from planted, means""",
)
def mean_fill(spark, folder):
    return _rounded(missing.fill_mean(_planted(spark, folder), FILLED))


@query(
    "median_fill",
    PLANTED
    + """, medians as (
        select median(l_discount) d, median(l_tax) t, median(l_linenumber) n from planted)
    select l_orderkey, l_partkey, round(coalesce(l_discount, d), 8) as l_discount,
           round(coalesce(l_tax, t), 8) as l_tax,
           round(coalesce(l_linenumber, n), 8) as l_linenumber
    from planted, medians""",
)
def median_fill(spark, folder):
    return _rounded(missing.fill_median(_planted(spark, folder), FILLED))


@query(
    "text_fill",
    """select c_custkey, coalesce(nullif(c_mktsegment, 'BUILDING'), 'Unknown') as c_mktsegment
       from customer""",
)
def text_fill(spark, folder):
    rows = table(spark, folder, "customer").select(
        "c_custkey", F.nullif(F.col("c_mktsegment"), F.lit("BUILDING")).alias("c_mktsegment")
    )
    return missing.fill_text(rows, ["c_mktsegment", "c_absent"])


@query(
    "nan_text_fill",
    """select o_orderkey, case when o_orderpriority in ('5-LOW', '2-HIGH') then 'Unknown'
       else o_orderpriority end as o_orderpriority from orders""",
)
def nan_text_fill(spark, folder):
    priority = F.col("o_orderpriority")
    planted = F.when(priority == "5-LOW", "nan").when(priority != "2-HIGH", priority)
    rows = table(spark, folder, "orders").select("o_orderkey", planted.alias("o_orderpriority"))
    return missing.replace_nan_text(rows, ["o_orderpriority"])


@query(
    "missing_profile",
    """with shares as (
        select count(*) filter (nullif(l_discount, 0.0) is null) * 100.0::double / count(*) as d,
               count(*) filter (nullif(l_linenumber, 1) is null) * 100.0::double / count(*) as n
        from lineitem)
    select 'l_discount' as feature, round(d, 6) as missing_percent from shares where d > 0
    union all select 'l_linenumber', round(n, 6) from shares where n > 0""",
)
def missing_profile(spark, folder):
    profile = missing.missing_profile(_planted(spark, folder))
    return profile.withColumn("missing_percent", F.round("missing_percent", 6))


@query(
    "drop_incomplete",
    PLANTED
    + """select l_orderkey, l_partkey, l_discount, l_tax from planted
    where l_discount is not null and l_tax is not null""",
)
def drop_incomplete(spark, folder):
    rows = _planted(spark, folder).drop("l_linenumber")
    return filters.drop_incomplete(rows, ["l_discount", "l_tax"])


@query(
    "incomplete_counts",
    PLANTED
    + """select count(*) as n_rows,
           count(*) filter (l_discount is not null and l_tax is not null) as kept,
           count(*) filter (l_discount is null or l_tax is null) as dropped from planted""",
)
def incomplete_counts(spark, folder):
    return filters.incomplete_counts(_planted(spark, folder), ["l_discount", "l_tax"])


@query(
    "replace_infinite",
    """select l_orderkey, l_partkey,
       case when l_tax > 0.01 then l_tax end as l_tax from lineitem""",
)
def replace_infinite(spark, folder):
    tax = F.col("l_tax")
    planted = (
        F.when(tax == 0, F.lit(float("inf")))
        .when(tax <= 0.01, F.lit(float("-inf")))
        .otherwise(tax)
    )
    rows = table(spark, folder, "lineitem").select(
        "l_orderkey", "l_partkey", planted.alias("l_tax")
    )
    return filters.replace_infinite(rows, ["l_tax"])
