"""Projections, filters, sorts."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from rowsmith.operators import columns as cols
from rowsmith.operators import filters, ordering
from rowsmith.plans.catalog.registry import query, table


@query(
    "flagship_part_of_day",
    """
    with hours as (
        select case when hour(ts) between 1 and 6 then 'Night'
                    when hour(ts) between 7 and 12 then 'Morning'
                    when hour(ts) between 13 and 18 then 'Afternoon'
                    else 'Evening' end as part_of_day,
               case when hour(ts) between 1 and 16 then 'Day' else 'Night' end as day_flag,
               count(*) over (partition by event_type) as event_type_freq
        from events)
    select part_of_day, day_flag, count(*) as n,
           round(avg(event_type_freq), 6) as mean_freq,
           round(count(*) * 100.0::double / (select count(*) from hours), 6) as percent
    from hours group by part_of_day, day_flag
    """,
)
def flagship_part_of_day(spark, folder):
    from rowsmith.functions import dates
    from rowsmith.operators.encode import FrequencyEncoder

    events = table(spark, folder, "events").select("ts", "event_type")
    hour = dates.hour_of(F.col("ts"))
    dated = cols.derive(events, part_of_day=dates.part_of_day(hour), day_flag=dates.day_flag(hour))
    encoded = FrequencyEncoder.fit(events, ["event_type"]).transform(dated)
    counts = encoded.groupBy("part_of_day", "day_flag").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.avg("event_type_freq"), 6).alias("mean_freq")
    )
    # The window sees one row per part of day and flag, so the events are read once after the fit.
    total = F.sum("n").over(Window.partitionBy())
    return counts.withColumn("percent", F.round(F.col("n") * 100.0 / total, 6))


@query(
    "drop_columns",
    "select o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority from orders",
)
def drop_columns(spark, folder):
    return cols.drop_columns(table(spark, folder, "orders"), ["o_orderdate", "o_absent"])


@query(
    "rename_by_position",
    """select c_custkey as id, c_name as name, c_nationkey as nation, c_acctbal as balance,
       c_mktsegment as segment from customer""",
)
def rename_by_position(spark, folder):
    names = ["id", "name", "nation", "balance", "segment"]
    return cols.rename_all(table(spark, folder, "customer"), names)


@query("rename_column", "select n_nationkey, n_name as nation, n_regionkey from nation")
def rename_column(spark, folder):
    return cols.rename_column(table(spark, folder, "nation"), "n_name", "nation")


@query(
    "select_except",
    "select s_suppkey, s_nationkey, s_acctbal from supplier",
)
def select_except(spark, folder):
    return cols.select_except(table(spark, folder, "supplier"), ["s_name"])


@query(
    "derive_columns",
    """select l_orderkey, l_linenumber, l_extendedprice,
       round(l_extendedprice * (1 - l_discount), 4) as net,
       round(abs(l_discount - l_tax) * 100, 4) as spread_percent,
       case when l_quantity > 25 then 'large' else 'small' end as size,
       coalesce(nullif(l_linestatus, 'O'), 'open') as status,
       cast(null as varchar) as remark
       from lineitem""",
)
def derive_columns(spark, folder):
    rows = table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_extendedprice", "l_discount", "l_tax", "l_quantity",
        "l_linestatus",
    )
    derived = cols.derive(
        rows,
        net=F.round(F.col("l_extendedprice") * (1 - F.col("l_discount")), 4),
        spread_percent=F.round(F.abs(F.col("l_discount") - F.col("l_tax")) * 100, 4),
        size=F.when(F.col("l_quantity") > 25, "large").otherwise("small"),
        status=F.coalesce(F.nullif(F.col("l_linestatus"), F.lit("O")), F.lit("open")),
        remark=F.lit(None).cast("string"),
    )
    return cols.drop_columns(derived, ["l_discount", "l_tax", "l_quantity", "l_linestatus"])


@query(
    "cast_to_double",
    """select cast(event_id as double) as event_id, event_type,
       try_cast(props as double) as props, value from events""",
)
def cast_to_double(spark, folder):
    texts = table(spark, folder, "events").select(
        F.col("event_id").cast("string").alias("event_id"),
        "event_type",
        "props",
        F.col("value").cast("string").alias("value"),
    )
    return cols.cast_to_double(texts, keep=["event_type"])


@query(
    "cast_columns",
    """select o_orderkey, cast(o_custkey as varchar) as o_custkey,
       cast(o_totalprice > 100000 as integer) as expensive from orders""",
)
def cast_columns(spark, folder):
    rows = table(spark, folder, "orders").select(
        "o_orderkey", "o_custkey", (F.col("o_totalprice") > 100000).alias("expensive")
    )
    return cols.cast_columns(rows, {"o_custkey": "string", "expensive": "int"})


@query(
    "drop_datetime",
    "select o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority from orders",
)
def drop_datetime(spark, folder):
    return cols.drop_datetime(table(spark, folder, "orders"))


@query("keep_numeric", "select p_partkey, p_size, p_retailprice from part")
def keep_numeric(spark, folder):
    return cols.keep_numeric(table(spark, folder, "part"))


@query("map_double", "select event_id, value * 2 as doubled from events")
def map_double(spark, folder):
    return table(spark, folder, "events").select(
        "event_id", (F.col("value") * 2).alias("doubled")
    )


@query("map_key_value", "select user_id, round(value, 2) as value from events")
def map_key_value(spark, folder):
    return table(spark, folder, "events").select(
        "user_id", F.round("value", 2).alias("value")
    )


@query("filter_above", "select event_id, user_id, value from events where value > 100")
def filter_above(spark, folder):
    rows = table(spark, folder, "events").select("event_id", "user_id", "value")
    return filters.above(rows, "value", 100)


@query("filter_even", "select event_id, value from events where event_id % 2 = 0")
def filter_even(spark, folder):
    return filters.divisible(table(spark, folder, "events").select("event_id", "value"), "event_id", 2)


@query(
    "predicates",
    """select o_orderkey, o_orderpriority in ('1-URGENT', '2-HIGH') as pressing,
       o_totalprice between 100000 and 200000 as mid_price,
       nullif(o_orderstatus, 'P') is null as pending,
       o_orderstatus = 'F' as finished from orders""",
)
def predicates(spark, folder):
    price = F.col("o_totalprice")
    return table(spark, folder, "orders").select(
        "o_orderkey",
        F.col("o_orderpriority").isin("1-URGENT", "2-HIGH").alias("pressing"),
        price.between(100000, 200000).alias("mid_price"),
        F.nullif(F.col("o_orderstatus"), F.lit("P")).isNull().alias("pending"),
        (F.col("o_orderstatus") == "F").alias("finished"),
    )


@query(
    "order_by_label",
    "select o_orderkey, o_orderstatus from orders order by o_orderstatus, o_orderkey",
)
def order_by_label(spark, folder):
    rows = table(spark, folder, "orders").select("o_orderkey", "o_orderstatus")
    return ordering.order_by_label(rows, "o_orderstatus", "o_orderkey")


@query(
    "label_shuffle",
    """select o_orderkey, o_orderstatus,
       row_number() over (order by o_orderstatus, md5('42:' || o_orderkey::varchar)) - 1
       as position from orders""",
)
def label_shuffle(spark, folder):
    from rowsmith.functions.numbers import key_hash

    rows = table(spark, folder, "orders").select("o_orderkey", "o_orderstatus")
    order = [F.col("o_orderstatus"), key_hash(F.col("o_orderkey"), 42)]
    return ordering.row_numbers(rows, order, "position")


@query(
    "label_shuffle_sorted",
    """select o_orderkey, o_orderstatus from orders
       order by o_orderstatus, md5('42:' || o_orderkey::varchar)""",
)
def label_shuffle_sorted(spark, folder):
    rows = table(spark, folder, "orders").select("o_orderkey", "o_orderstatus")
    return ordering.shuffle_within_label(rows, "o_orderstatus", "o_orderkey", 42)


@query(
    "first_rows",
    "select o_orderkey, o_totalprice from orders order by o_totalprice desc, o_orderkey limit 10",
)
def first_rows(spark, folder):
    rows = table(spark, folder, "orders").select("o_orderkey", "o_totalprice")
    return ordering.first_rows(rows, [F.col("o_totalprice").desc(), F.col("o_orderkey")], 10)
