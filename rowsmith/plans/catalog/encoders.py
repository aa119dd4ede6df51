"""Lookup joins and category encoders."""

from __future__ import annotations

from pyspark.sql import functions as F

from rowsmith.operators.encode import FrequencyEncoder, LabelIndexer, encode_all, one_hot, one_hot_vectors
from rowsmith.operators.features import sparse_entries, vector_values
from rowsmith.operators.lookup import KeyTable, attach
from rowsmith.plans.catalog.registry import query, table
from rowsmith.sources.generated import literal_rows

CUSTOMERS = """
    with planted as (
        select c_custkey, c_nationkey, nullif(c_mktsegment, 'BUILDING') as segment from customer)
"""


def _customers(spark, folder):
    segment = F.nullif(F.col("c_mktsegment"), F.lit("BUILDING"))
    return table(spark, folder, "customer").select(
        "c_custkey", "c_nationkey", segment.alias("segment")
    )


@query(
    "frequency_encode",
    CUSTOMERS
    + """select c_custkey, count(*) over (partition by c_nationkey) as c_nationkey_freq,
       case when segment is not null then count(*) over (partition by segment) end
       as segment_freq from planted""",
)
def frequency_encode(spark, folder):
    rows = _customers(spark, folder)
    return FrequencyEncoder.fit(rows, ["c_nationkey", "segment"]).transform(rows)


@query(
    "frequency_encode_nulls",
    CUSTOMERS
    + """select c_custkey, count(*) over (partition by c_nationkey) as c_nationkey_freq,
       count(*) over (partition by segment) as segment_freq from planted""",
)
def frequency_encode_nulls(spark, folder):
    rows = _customers(spark, folder)
    encoder = FrequencyEncoder.fit(rows, ["c_nationkey", "segment"], "count")
    return encoder.transform(rows)


HOT_ORDERS = """
    with planted as (
        select o_orderkey, case when o_orderkey % 3 = 0 then 7
               when o_orderkey % 5 <> 0 then o_custkey end as customer
        from orders)
"""


def _hot_orders(spark, folder):
    key = F.col("o_orderkey")
    customer = F.when(key % 3 == 0, 7).when(key % 5 != 0, F.col("o_custkey"))
    return table(spark, folder, "orders").select("o_orderkey", customer.alias("customer"))


@query(
    "frequency_encode_hot_key",
    HOT_ORDERS
    + """select o_orderkey, case when customer is not null
       then count(*) over (partition by customer) end as customer_freq from planted""",
)
def frequency_encode_hot_key(spark, folder):
    rows = _hot_orders(spark, folder)
    return FrequencyEncoder.fit(rows, ["customer"], broadcast_bytes=0).transform(rows)


@query(
    "frequency_encode_hot_key_nulls",
    HOT_ORDERS
    + "select o_orderkey, count(*) over (partition by customer) as customer_freq from planted",
)
def frequency_encode_hot_key_nulls(spark, folder):
    rows = _hot_orders(spark, folder)
    return FrequencyEncoder.fit(rows, ["customer"], "count", broadcast_bytes=0).transform(rows)


SIX_KEYS = {
    "part": "l_partkey", "supplier": "l_suppkey", "ship_day": "l_shipdate", "price": "l_extendedprice",
    "order": "case when l_orderkey % 3 = 0 then 7 else l_orderkey end", "mark": "nullif(l_returnflag, 'A')",
}
_SIX = ", ".join(f'{value} as "{name}"' for name, value in SIX_KEYS.items())


def _six_keys(spark, folder):
    """Line items with six keys; one value holds a third of the orders, and a third of the marks is null."""
    return table(spark, folder, "lineitem").selectExpr(
        "l_orderkey", "l_linenumber", "l_quantity", *[f"{value} as `{name}`" for name, value in SIX_KEYS.items()]
    )


@query(
    "frequency_encode_six_large",
    f"""with planted as (select l_orderkey, l_linenumber, l_quantity, {_SIX} from lineitem)
    select l_orderkey, l_linenumber, l_quantity, """
    + ", ".join(
        f'case when "{name}" is not null then count(*) over (partition by "{name}") end as "{name}_freq"' for name in SIX_KEYS
    )
    + " from planted",
)
def frequency_encode_six_large(spark, folder):
    """None of the six tables of counts is broadcast: they are joined at once."""
    rows = _six_keys(spark, folder)
    return FrequencyEncoder.fit(rows, list(SIX_KEYS), broadcast_bytes=0).transform(rows)


@query(
    "encode_together_large",
    f"""with planted as (select l_orderkey, l_linenumber, l_quantity, {_SIX} from lineitem),
    suppliers as (select supplier, row_number() over (order by count(*) desc, supplier::varchar) - 1 as i
                  from planted group by supplier),
    marks as (select mark, row_number() over (order by count(*) desc, mark) - 1 as i
              from planted where mark is not null group by mark)
    select l_orderkey, l_linenumber, l_quantity, "part", ship_day, price, s.i::double as supplier_idx,
           coalesce(m.i, (select count(*) from marks))::double as mark_idx,
           count(*) over (partition by "order") as order_freq
    from planted p join suppliers s on p.supplier = s.supplier left join marks m on p.mark = m.mark""",
)
def encode_together_large(spark, folder):
    """An index of two columns and the frequencies of a third, with one set of joins."""
    rows = _six_keys(spark, folder)
    indexer = LabelIndexer.fit(rows, ["supplier", "mark"])
    frequency = FrequencyEncoder.fit(rows, ["order"], "count")
    return encode_all(rows, [indexer, frequency], broadcast_bytes=0)


@query(
    "dictionary_lookup",
    """select o_orderkey, case o_orderpriority when '1-URGENT' then 1 when '2-HIGH' then 2
       when '3-MEDIUM' then 3 end as urgency from orders""",
)
def dictionary_lookup(spark, folder):
    urgencies = literal_rows(
        spark, [("1-URGENT", 1), ("2-HIGH", 2), ("3-MEDIUM", 3)], "priority string, urgency int"
    )
    dictionary = KeyTable.of_values(urgencies, "priority", ("urgency",))
    rows = table(spark, folder, "orders").select("o_orderkey", "o_orderpriority")
    return attach(rows, F.col("o_orderpriority"), dictionary).drop("o_orderpriority")


def _parts(spark, folder):
    kind = F.nullif(F.col("p_type"), F.lit("PROMO"))
    return table(spark, folder, "part").select("p_partkey", "p_brand", kind.alias("p_type"))


def _index_sql(order: str) -> str:
    return f"""
    with planted as (select p_partkey, p_brand, nullif(p_type, 'PROMO') as p_type from part),
    brands as (select p_brand as label, (row_number() over (order by {order}) - 1)::double as i
               from (select p_brand, p_brand as label, count(*) as n from planted group by p_brand)),
    kinds as (select p_type as label, (row_number() over (order by {order}) - 1)::double as i
              from (select p_type, p_type as label, count(*) as n from planted
                    where p_type is not null group by p_type))
    select p_partkey, b.i as p_brand_idx,
           coalesce(k.i, (select count(*) from kinds)::double) as p_type_idx
    from planted join brands b on b.label = p_brand left join kinds k on k.label = p_type
    """


@query("index_by_frequency", _index_sql("n desc, label"))
def index_by_frequency(spark, folder):
    rows = _parts(spark, folder)
    return LabelIndexer.fit(rows, ["p_brand", "p_type"]).transform(rows)


@query("index_by_alphabet", _index_sql("label"))
def index_by_alphabet(spark, folder):
    rows = _parts(spark, folder)
    return LabelIndexer.fit(rows, ["p_brand", "p_type"], "alphabet").transform(rows)


@query(
    "index_many_labels",
    """with labels as (
        select o_custkey, (row_number() over (order by n desc, o_custkey::varchar) - 1)::double as i
        from (select o_custkey, count(*) as n from orders group by o_custkey))
    select o_orderkey, i as o_custkey_idx from orders join labels using (o_custkey)""",
)
def index_many_labels(spark, folder):
    rows = table(spark, folder, "orders").select("o_orderkey", "o_custkey")
    indexer = LabelIndexer.fit(rows, ["o_custkey"], ranked_labels=100, broadcast_bytes=0)
    return indexer.transform(rows)


@query(
    "index_skip_invalid",
    """with kinds as (select p_type, (row_number() over (order by count(*) desc, p_type) - 1)::double
               as i from part where p_type <> 'PROMO' group by p_type)
    select p_partkey, p_brand, i as p_type_idx from part join kinds using (p_type)""",
)
def index_skip_invalid(spark, folder):
    rows = _parts(spark, folder)
    return LabelIndexer.fit(rows, ["p_type"], handle_invalid="skip").transform(rows)


@query(
    "one_hot",
    """select event_id,
       (event_type = 'click')::integer as event_type_click,
       (event_type = 'error')::integer as event_type_error,
       (event_type = 'purchase')::integer as event_type_purchase,
       (event_type = 'view')::integer as event_type_view from events""",
)
def one_hot_columns(spark, folder):
    kind = F.nullif(F.col("event_type"), F.lit("signup"))
    rows = table(spark, folder, "events").select("event_id", kind.alias("event_type"))
    return one_hot(rows, ["event_type"])


@query(
    "one_hot_vectors",
    """with kinds as (select event_type,
           row_number() over (order by count(*) desc, event_type) - 1 as i
           from events group by event_type)
    select event_id, (i = 0)::integer::double as k0, (i = 1)::integer::double as k1,
       (i = 2)::integer::double as k2, (i = 3)::integer::double as k3,
       (i = 4)::integer::double as k4
    from events join kinds using (event_type)""",
)
def one_hot_as_vectors(spark, folder):
    rows = table(spark, folder, "events").select("event_id", "event_type")
    indexed = LabelIndexer.fit(rows, ["event_type"]).transform(rows)
    vectors = one_hot_vectors(indexed, ["event_type_idx"]).drop("event_type_idx")
    return vector_values(vectors, "event_type_idx_vec", [f"k{i}" for i in range(5)])


@query(
    "one_hot_many",
    """with labels as (
        select o_custkey, row_number() over (order by count(*) desc, o_custkey::varchar) - 1 as i
        from orders group by o_custkey)
    select o_orderkey, i as position, 1.0::double as total,
           (select count(*) from labels) + 1 as width
    from orders join labels using (o_custkey)""",
)
def one_hot_many(spark, folder):
    rows = table(spark, folder, "orders").select("o_orderkey", "o_custkey")
    indexed = LabelIndexer.fit(rows, ["o_custkey"]).transform(rows)
    vectors = one_hot_vectors(indexed, ["o_custkey_idx"])
    entries = sparse_entries(vectors, "o_custkey_idx_vec", ["o_orderkey"])
    return entries.select("o_orderkey", "position", F.col("value").alias("total"), "width")
