"""Counts, sums, lists and weights."""

from __future__ import annotations

from pyspark.sql import functions as F

from rowsmith.operators import counts, missing, quantiles, sketches
from rowsmith.plans.catalog.registry import query, table
from rowsmith.storage import scratch_path


@query(
    "global_mean",
    """select round(avg(l_quantity), 6) as l_quantity,
       round(avg(nullif(l_discount, 0.0)), 6) as l_discount from lineitem""",
)
def global_mean(spark, folder):
    rows = table(spark, folder, "lineitem").select(
        "l_quantity", F.nullif(F.col("l_discount"), F.lit(0.0)).alias("l_discount")
    )
    means = missing.means(rows, ["l_quantity", "l_discount"])
    return means.select(*[F.round(c, 6).alias(c) for c in means.columns])


@query(
    "global_median",
    """select 'l_extendedprice' as feature, round(median(l_extendedprice), 6) as median from lineitem
       union all
       select 'l_discount', round(median(nullif(l_discount, 0.0)), 6) from lineitem
       union all
       select 'l_quantity', round(median(l_quantity), 6) from lineitem""",
)
def global_median(spark, folder):
    rows = table(spark, folder, "lineitem").select(
        "l_extendedprice",
        "l_quantity",
        F.nullif(F.col("l_discount"), F.lit(0.0)).alias("l_discount"),
    )
    found = quantiles.medians(rows, ["l_extendedprice", "l_discount", "l_quantity"])
    return found.select("feature", F.round("median", 6).alias("median"))


@query(
    "narrowed_median",
    """select 'l_extendedprice' as feature, round(median(l_extendedprice), 6) as median from lineitem
       union all
       select 'l_orderkey', round(median(l_orderkey::double), 6) from lineitem""",
)
def narrowed_median(spark, folder):
    rows = table(spark, folder, "lineitem").select("l_extendedprice", "l_orderkey")
    found = quantiles.medians(rows, ["l_extendedprice", "l_orderkey"], ranked_values=50)
    return found.select("feature", F.round("median", 6).alias("median"))


HALF_ZERO = """
    select 'price' as feature, median(case when l_orderkey % 2 = 0 then 0 else l_extendedprice end) as median
    from lineitem
"""


def _half_zero(spark, folder):
    price = F.when(F.col("l_orderkey") % 2 == 0, F.lit(0.0)).otherwise(F.col("l_extendedprice"))
    return table(spark, folder, "lineitem").select(price.alias("price"))


@query("median_half_zero", HALF_ZERO)
def median_half_zero(spark, folder):
    return quantiles.medians(_half_zero(spark, folder), ["price"])


@query("median_half_zero_narrowed", HALF_ZERO)
def median_half_zero_narrowed(spark, folder):
    return quantiles.medians(_half_zero(spark, folder), ["price"], ranked_values=50, grid=100)


@query("group_count", "select event_type, count(*) as n from events group by event_type")
def group_count(spark, folder):
    return counts.group_count(table(spark, folder, "events"), "event_type")


@query(
    "value_counts",
    """select 'p_brand' as feature, p_brand as value, count(*) as n from part group by p_brand
       union all
       select 'p_type', nullif(p_type, 'PROMO'), count(*) from part group by 2
       union all
       select 'p_size', p_size::varchar, count(*) from part group by p_size""",
)
def value_counts(spark, folder):
    rows = table(spark, folder, "part").withColumn(
        "p_type", F.nullif(F.col("p_type"), F.lit("PROMO"))
    )
    return counts.value_counts(rows, ["p_brand", "p_type", "p_size"])


@query(
    "class_distribution",
    """select o_orderpriority, count(*) as n,
       round(count(*) * 100.0::double / (select count(*) from orders), 6) as percent
       from orders group by o_orderpriority order by o_orderpriority""",
)
def class_distribution(spark, folder):
    found = counts.class_distribution(table(spark, folder, "orders"), "o_orderpriority")
    return found.withColumn("percent", F.round("percent", 6))


@query(
    "distinct_counts",
    """select 'l_returnflag' as feature, count(distinct l_returnflag) as n_distinct from lineitem
       union all select 'l_partkey', count(distinct l_partkey) from lineitem
       union all select 'l_linestatus', count(distinct nullif(l_linestatus, 'O')) from lineitem
       union all select 'l_shipdate', count(distinct l_shipdate) from lineitem""",
)
def distinct_counts(spark, folder):
    rows = table(spark, folder, "lineitem").withColumn(
        "l_linestatus", F.nullif(F.col("l_linestatus"), F.lit("O"))
    )
    return counts.distinct_counts(rows, ["l_returnflag", "l_partkey", "l_linestatus", "l_shipdate"])


@query("approximate_distinct_counts")
def approximate_distinct_counts(spark, folder):
    rows = table(spark, folder, "lineitem")
    return counts.distinct_counts(rows, ["l_returnflag", "l_partkey", "l_shipdate"], True)


@query("distinct_values", "select distinct p_name from part")
def distinct_values(spark, folder):
    return counts.distinct_values(table(spark, folder, "part"), "p_name")


@query(
    "sum_by_key",
    "select user_id, round(sum(value), 4) as total from events group by user_id",
)
def sum_by_key(spark, folder):
    sums = counts.sum_by_key(table(spark, folder, "events"), "user_id", "value")
    return sums.withColumn("total", F.round("total", 4))


GROUP_LISTS = """
    with sized as (
        select user_id, event_id, cast(round(value * 100) as bigint) as cents,
               cast(ceil(count(*) over (partition by user_id) / {chunk}::double) as bigint) as chunks
        from events),
    placed as (
        select user_id, cents, chunks,
               (row_number() over (partition by user_id order by cents, event_id) - 1) // {chunk} as chunk
        from sized)
    select user_id, chunks, chunk,
           string_agg(cents::varchar, ',' order by cents) as cents
    from placed group by user_id, chunks, chunk
"""


def _group_lists(spark, folder, chunk_rows):
    rows = table(spark, folder, "events").select(
        "user_id", "event_id", F.round(F.col("value") * 100).cast("long").alias("cents")
    )
    lists = counts.group_lists(rows, "user_id", "cents", "event_id", chunk_rows)
    joined = F.array_join(F.col("values").cast("array<string>"), ",")
    return lists.select("user_id", "chunks", "chunk", joined.alias("cents"))


@query("group_lists", GROUP_LISTS.format(chunk=100_000))
def group_lists(spark, folder):
    return _group_lists(spark, folder, 100_000)


@query("group_lists_in_chunks", GROUP_LISTS.format(chunk=40))
def group_lists_in_chunks(spark, folder):
    return _group_lists(spark, folder, 40)


@query(
    "class_weights",
    """select o_orderstatus, count(*) as n,
       round((select count(*) from orders) / count(*)::double, 6) as weight
       from orders group by o_orderstatus""",
)
def class_weights(spark, folder):
    found = counts.class_weights(table(spark, folder, "orders"), "o_orderstatus")
    return found.withColumn("weight", F.round("weight", 6))


@query(
    "rows_with_class_weight",
    """select o_orderkey, o_orderstatus, round((select count(*) from orders)
       / (count(*) over (partition by o_orderstatus))::double, 6) as weight from orders""",
)
def rows_with_class_weight(spark, folder):
    rows = table(spark, folder, "orders").select("o_orderkey", "o_orderstatus")
    weighted = counts.with_class_weight(rows, "o_orderstatus")
    return weighted.withColumn("weight", F.round("weight", 6))


@query("row_count", "select count(*) as n_rows from lineitem")
def row_count(spark, folder):
    return counts.row_count(table(spark, folder, "lineitem"))


SKETCHED = ["l_partkey", "l_extendedprice", "l_shipdate", "l_returnflag"]


def _stored(spark, folder):
    """Sketches of the line items per ship year: all years at once, then the last year once more."""
    rows = table(spark, folder, "lineitem")
    store = sketches.SketchStore(spark, scratch_path(spark, "sketches"))
    year = F.year("l_shipdate")
    store.add(rows, year, SKETCHED)
    store.add(rows.filter(year == rows.agg(F.max(year)).scalar()), year, SKETCHED)
    return store


@query(
    "stored_distinct_counts",
    "select feature, n, 0::bigint as n_missing, true as is_near from ("
    + " union all ".join(f"select '{c}' as feature, count({c}) as n from lineitem" for c in SKETCHED)
    + ")",
)
def stored_distinct_counts(spark, folder):
    """Merged sketches of the years against exact counts: within a twentieth."""
    merged = _stored(spark, folder).counts()
    exact = counts.distinct_counts(table(spark, folder, "lineitem"), SKETCHED).withColumnRenamed("n_distinct", "exact")
    off = F.abs(F.col("n_distinct") - F.col("exact"))
    return merged.join(exact, "feature").select("feature", "n", "n_missing", (off * 20 <= F.col("exact")).alias("is_near"))


@query(
    "stored_quantiles",
    """select feature, share::double as share, true as is_near
    from (values ('l_partkey'), ('l_extendedprice')) as f (feature), (values (0.1), (0.5), (0.9)) as s (share)""",
)
def stored_quantiles(spark, folder):
    """Merged sketches of the years: at most a hundredth of the rows lie between a quantile and its estimate."""
    found = _stored(spark, folder).quantiles([0.1, 0.5, 0.9])
    long = table(spark, folder, "lineitem").select(
        F.inline(F.array(*[F.struct(F.lit(c).alias("of"), F.col(c).cast("double").alias("x")) for c in SKETCHED[:2]]))
    )
    # Three rows per column are joined with all values.
    beside = long.join(F.broadcast(found), F.col("of") == F.col("feature"))
    upto, below = F.count_if(F.col("x") <= F.col("value")), F.count_if(F.col("x") < F.col("value"))
    n, share = F.count(F.lit(1)), F.col("share")
    near = (upto >= (share - 0.01) * n) & (below <= (share + 0.01) * n)
    return beside.groupBy("feature", "share").agg(near.alias("is_near"))
