"""Splits, feature vectors and scaling."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.sql import functions as F

from rowsmith.operators import counts, features, split
from rowsmith.plans.catalog.registry import query, table

STRATIFIED = """
    with ranked as (
        select o_orderkey, o_orderpriority,
               row_number() over (partition by o_orderpriority
                                  order by md5(o_orderkey::varchar), o_orderkey) as rn,
               count(*) over (partition by o_orderpriority) as n
        from orders),
    marked as (
        select o_orderkey, o_orderpriority,
               case when rn * 10 <= n * 7 then 'train' else 'test' end as split from ranked)
"""


def _orders(spark, folder):
    return table(spark, folder, "orders").select("o_orderkey", "o_orderpriority")


@query(
    "random_split",
    """select o_orderkey, o_orderpriority,
       case when substr(md5('42:' || o_orderkey::varchar), 1, 8) < 'b3333333'
       then 'train' else 'test' end as split from orders""",
)
def random_split(spark, folder):
    return split.random_split(_orders(spark, folder), "o_orderkey")


@query("stratified_split", STRATIFIED + "select * from marked")
def stratified_split(spark, folder):
    return split.stratified_split(_orders(spark, folder), "o_orderpriority", "o_orderkey")


@query("stratified_split_narrowed", STRATIFIED + "select * from marked")
def stratified_split_narrowed(spark, folder):
    return split.stratified_split(
        _orders(spark, folder), "o_orderpriority", "o_orderkey", boundary_rows=0, broadcast_bytes=0
    )


@query(
    "stratified_split_null_keys",
    """with sized as (select o_orderpriority, count(*) as n from orders group by o_orderpriority)
    select o_orderpriority, 'train' as split, n * 7 // 10 as n from sized
    union all select o_orderpriority, 'test', n - n * 7 // 10 from sized""",
)
def stratified_split_null_keys(spark, folder):
    missing = F.when(F.col("o_orderkey") % 4 != 0, F.col("o_orderkey"))
    rows = table(spark, folder, "orders").select(missing.alias("o_orderkey"), "o_orderpriority")
    marked = split.stratified_split(rows, "o_orderpriority", "o_orderkey")
    return counts.split_class_counts(marked, "split", "o_orderpriority")


@query(
    "split_class_counts",
    STRATIFIED + "select split, o_orderpriority, count(*) as n from marked group by all",
)
def split_class_counts(spark, folder):
    marked = split.stratified_split(_orders(spark, folder), "o_orderpriority", "o_orderkey")
    return counts.split_class_counts(marked, "split", "o_orderpriority")


@query(
    "scale_with_train_statistics",
    """with marked as (
        select o_orderkey, o_totalprice,
               case when substr(md5('42:' || o_orderkey::varchar), 1, 8) < 'b3333333'
               then 'train' else 'test' end as split from orders),
    train as (select avg(o_totalprice) m, stddev_samp(o_totalprice) s from marked
              where split = 'train')
    select o_orderkey, split, round((o_totalprice - m) / s, 6) + 0.0::double as o_totalprice
    from marked, train""",
)
def scale_with_train_statistics(spark, folder):
    rows = table(spark, folder, "orders").select("o_orderkey", "o_totalprice")
    marked = split.random_split(rows, "o_orderkey")
    train, _ = split.parts(marked)
    scaled = features.ColumnScaler.fit(train, ["o_totalprice"]).transform(marked)
    return scaled.withColumn("o_totalprice", F.round("o_totalprice", 6))


NUMBERS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
KEYS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]


def _lineitem(spark, folder):
    return table(spark, folder, "lineitem").select(*KEYS, *NUMBERS)


@query("assemble", f"select {', '.join(KEYS + NUMBERS)} from lineitem")
def assemble(spark, folder):
    vectors = features.assemble(_lineitem(spark, folder), [*NUMBERS, "l_absent"])
    return features.vector_values(vectors.drop(*NUMBERS), "features", NUMBERS)


@query(
    "assemble_skip",
    f"select {', '.join(KEYS + NUMBERS)} from lineitem where l_discount <> 0 and l_tax <> 0",
)
def assemble_skip(spark, folder):
    rows = _lineitem(spark, folder).withColumns(
        {
            "l_discount": F.nullif(F.col("l_discount"), F.lit(0.0)),
            "l_tax": F.when(F.col("l_tax") == 0, F.lit(float("nan"))).otherwise(F.col("l_tax")),
        }
    )
    vectors = features.assemble(rows, NUMBERS, handle_invalid="skip")
    return features.vector_values(vectors.drop(*NUMBERS), "features", NUMBERS)


def _scaled_sql(spread: str) -> str:
    statistics = ", ".join(f"avg({c}) as m_{c}, {spread}({c}) as s_{c}" for c in NUMBERS)
    # Adding zero turns the negative zero that round() may give into zero.
    scaled = ", ".join(f"round(({c} - m_{c}) / s_{c}, 6) + 0.0::double as {c}" for c in NUMBERS)
    return f"""with statistics as (select {statistics} from lineitem)
    select {", ".join(KEYS)}, {scaled} from lineitem, statistics"""


def _rounded(df):
    return df.withColumns({c: F.round(c, 6) for c in NUMBERS})


@query("scale_vectors", _scaled_sql("stddev_samp"))
def scale_vectors(spark, folder):
    rows = _lineitem(spark, folder)
    stages = [features.assembler(rows, NUMBERS), features.scaler()]
    scaled = Pipeline(stages=stages).fit(rows).transform(rows)
    return _rounded(
        features.vector_values(scaled.drop("features", *NUMBERS), "scaled_features", NUMBERS)
    )


@query("scale_columns", _scaled_sql("stddev_samp"))
def scale_columns(spark, folder):
    return _rounded(features.scale_columns(_lineitem(spark, folder), NUMBERS))


@query("scale_columns_population", _scaled_sql("stddev_pop"))
def scale_columns_population(spark, folder):
    return _rounded(features.scale_columns(_lineitem(spark, folder), NUMBERS, population=True))
