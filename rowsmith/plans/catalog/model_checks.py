"""Properties of fitted models that SQL can compute without the model.

A label that is a threshold of a feature is predicted without error by the forest. An unregularised
logistic fit has, on its own training rows, the class shares as mean probabilities. Probabilities
sum to one and the prediction is the largest of them. Train rows are those of ``random_split``.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from rowsmith.operators import counts, models, split
from rowsmith.plans.catalog.registry import query, table

IS_TRAIN = "substr(md5('42:' || o_orderkey::varchar), 1, 8) < 'b3333333'"
FEATURES = ["price_step", "customer"]
UNREGULARISED = {"regParam": 0.0, "maxIter": 300, "tol": 1e-12}


def _orders(spark, folder):
    step = F.floor(F.col("o_totalprice") / 50_000).cast("double")
    rows = table(spark, folder, "orders").select(
        "o_orderkey",
        step.alias("price_step"),
        F.col("o_custkey").cast("double").alias("customer"),
        (step > 4).cast("int").alias("is_high"),
        F.substring("o_orderpriority", 1, 1).cast("int").alias("priority"),
    )
    return split.parts(split.random_split(rows, "o_orderkey"))


@query(
    "forest_on_threshold",
    f"select count(*) as n_test, 1.0::double as accuracy from orders where not ({IS_TRAIN})",
)
def forest_on_threshold(spark, folder):
    train, test = _orders(spark, folder)
    model = models.fit_model(train, FEATURES, models.forest("is_high"))
    predicted = model.transform(test)
    hit = (F.col("is_high") == F.col("prediction")).cast("double")
    return predicted.agg(F.count(F.lit(1)).alias("n_test"), F.avg(hit).alias("accuracy"))


@query(
    "logistic_mean_probability",
    f"""select priority, round(count(*) / sum(count(*)) over (), 3)::double as share
    from (select substr(o_orderpriority, 1, 1)::integer as priority from orders where {IS_TRAIN})
    group by priority""",
)
def logistic_mean_probability(spark, folder):
    train, _ = _orders(spark, folder)
    model = models.fit_model(train, FEATURES, models.logistic("priority", **UNREGULARISED))
    scored = models.scores(model.transform(train), ["priority"])
    each = scored.select(F.posexplode("probability").alias("priority", "p"))
    means = each.groupBy("priority").agg(F.round(F.avg("p"), 3).alias("share"))
    return means.filter("priority > 0")


@query(
    "binary_logistic_mean_probability",
    f"""select round(avg(case when o_orderpriority < '3' then 1 else 0 end), 3) as share
    from orders where {IS_TRAIN}""",
)
def binary_logistic_mean_probability(spark, folder):
    train, _ = _orders(spark, folder)
    urgent = train.withColumn("urgent", (F.col("priority") < 3).cast("int"))
    model = models.fit_model(urgent, FEATURES, models.binary_logistic("urgent", **UNREGULARISED))
    scored = models.scores(model.transform(urgent), ["urgent"])
    return scored.agg(F.round(F.avg(F.col("probability")[1]), 3).alias("share"))


@query(
    "probabilities_add_up",
    f"""select model, count(*) as n_rows, count(*) as n_sum_one, count(*) as n_largest
    from orders, (values ('forest'), ('logistic')) as m (model) where not ({IS_TRAIN}) group by model""",
)
def probabilities_add_up(spark, folder):
    train, test = _orders(spark, folder)
    found = None
    for name, estimator in (("forest", models.forest("priority")), ("logistic", models.logistic("priority"))):
        scored = models.scores(models.fit_model(train, FEATURES, estimator).transform(test), [])
        total = F.aggregate("probability", F.lit(0.0), lambda a, p: a + p)
        chosen = F.get("probability", F.col("prediction").cast("int"))
        checks = scored.agg(
            F.count(F.lit(1)).alias("n_rows"),
            F.count_if(F.abs(total - 1) < 1e-9).alias("n_sum_one"),
            F.count_if(chosen == F.array_max("probability")).alias("n_largest"),
        ).select(F.lit(name).alias("model"), "*")
        found = checks if found is None else found.unionByName(checks)
    return found


@query(
    "approximate_distinct_within_a_tenth",
    """select 'l_returnflag' as feature, count(distinct l_returnflag) as exact, true as is_near from lineitem
    union all select 'l_partkey', count(distinct l_partkey), true from lineitem
    union all select 'l_shipdate', count(distinct l_shipdate), true from lineitem""",
)
def approximate_distinct_within_a_tenth(spark, folder):
    names = ["l_returnflag", "l_partkey", "l_shipdate"]
    rows = table(spark, folder, "lineitem").select(*names)
    exact = counts.distinct_counts(rows, names).withColumnRenamed("n_distinct", "exact")
    near = counts.distinct_counts(rows, names, approximate=True)
    off = F.abs(F.col("n_distinct") - F.col("exact"))
    return exact.join(near, "feature").select("feature", "exact", (off * 10 <= F.col("exact")).alias("is_near"))
