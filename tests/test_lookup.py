"""Large lookups: the same rows whatever order a task sees, and few shuffles of whole rows."""

import re

import pytest
from pyspark.sql import functions as F

from rowsmith.operators import encode, identity
from rowsmith.operators.lookup import KeyTable, Lookup, attach, attach_all

KEYS = ["a", "b", "c", "d", "e", "f"]


@pytest.fixture
def shuffled(spark):
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    before = {key: spark.conf.get(key) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.set(key, value)


@pytest.fixture(scope="module")
def written(spark, tmp_path_factory):
    """Six keys, of which one value holds a third of the rows, beside a wide column."""
    n = F.col("id")
    rows = spark.range(30_000).select(
        n.alias("number"), F.concat(F.lit("wide "), n).alias("wide"),
        *[F.when(n % 3 == 0, "hot").when(n % 7 != i, (n * (i + 3) % (50 + 400 * i)).cast("string")).alias(c) for i, c in enumerate(KEYS)],
    )
    path = str(tmp_path_factory.mktemp("keys") / "rows")
    rows.repartition(6).write.parquet(path)
    return path


def exchanges_of(df, column):
    """Shuffles whose rows hold the column."""
    plan = df._jdf.queryExecution().explainString(df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    nodes = re.findall(r"\(\d+\) Exchange[^\n]*\nInput \[\d+\]: \[([^\]]*)\]", plan)
    return sum(bool(re.search(rf"\b{column}#", node)) for node in nodes)


def counted(rows, column, name):
    found = rows.groupBy(F.col(column).alias("key")).agg(F.count(F.lit(1)).alias("n")).withColumn(name, F.col("n"))
    return KeyTable.measured(found, (name,))


@pytest.mark.parametrize("null_policy", ["drop", "count"])
def test_six_large_keys_shuffle_whole_rows_once(spark, shuffled, written, null_policy):
    rows = spark.read.parquet(written)
    encoder = encode.FrequencyEncoder.fit(rows, KEYS, null_policy, broadcast_bytes=0)
    found = encoder.transform(rows)
    assert exchanges_of(found, "wide") == 1
    expected = encode.FrequencyEncoder.fit(rows, KEYS, null_policy).transform(rows)
    assert found.columns == expected.columns == ["number", "wide", *[f"{c}_freq" for c in KEYS]]
    assert found.count() == 30_000
    assert found.exceptAll(expected).count() == 0


def test_index_and_frequency_share_the_joins(spark, shuffled, written):
    rows = spark.read.parquet(written)
    encoders = [
        encode.LabelIndexer.fit(rows, ["a", "b"]), encode.LabelIndexer.fit(rows, ["c"], handle_invalid="skip"),
        encode.FrequencyEncoder.fit(rows, ["d", "e"], "count"), encode.FrequencyEncoder.fit(rows, ["f"], unseen_as_zero=True),
    ]
    found = encode.encode_all(rows, encoders, broadcast_bytes=0)
    assert exchanges_of(found, "wide") == 1
    assert found.exceptAll(encode.encode_all(rows, encoders)).count() == 0
    assert found.count() == rows.filter("c is not null").count()


def test_a_table_without_counts_and_unknown_keys(spark, written):
    rows = spark.read.parquet(written)
    words = spark.createDataFrame([("hot", 1), ("5", 2), ("never", 3)], "key string, word int")
    more = spark.createDataFrame([("hot", "x"), (None, "none")], "key string, mark string")
    lookups = [
        Lookup(F.col("a"), KeyTable.of_values(words, "key", ("word",))),
        Lookup(F.col("b"), KeyTable.of_values(more, "key", ("mark",)), null_safe=True),
    ]
    found = attach_all(rows, lookups, broadcast_bytes=0)
    expected = attach_all(rows, lookups)
    assert found.columns == expected.columns == [*rows.columns, "word", "mark"]
    assert found.count() == 30_000 and found.exceptAll(expected).count() == 0
    assert found.filter("mark = 'none'").count() == rows.filter("b is null").count() > 0


def test_identity_does_not_depend_on_how_tasks_see_the_rows(spark, written):
    seen = []
    for settings in ({}, {"spark.sql.files.maxPartitionBytes": "20000"}, {"spark.sql.parquet.enableVectorizedReader": "false"}):
        for key, value in settings.items():
            spark.conf.set(key, value)
        try:
            rows, row = identity.identified(spark.read.parquet(written))
            # Another shuffle, another order of the rows within a task.
            mixed = rows.repartition(3 + len(seen)).orderBy(F.rand(len(seen)))
            seen.append({r["number"]: (r[row], r["salt"]) for r in mixed.withColumn("salt", identity.salt(row)).collect()})
        finally:
            for key in settings:
                spark.conf.unset(key)
    assert seen[0] == seen[1] == seen[2]
    assert len({key for key, _ in seen[0].values()}) == 30_000


@pytest.mark.parametrize("keys", [["a"], KEYS])
def test_a_map_stage_that_runs_again_in_another_order_gives_the_same_rows(spark, shuffled, written, keys):
    """The join's map side, run over the same rows in two orders: no row may change its place or its values."""
    outcomes = []
    for turn in range(2):
        rows, row = identity.identified(spark.read.parquet(written))
        # What a second encoder in a chain reads: rows that were shuffled before.
        chained = rows.repartition(5, "number").sortWithinPartitions(F.xxhash64("number", F.lit(turn)))
        lookups = [Lookup(F.col(c), counted(spark.read.parquet(written), c, f"{c}_n"), True) for c in keys]
        found = attach_all(chained, lookups, 0, row)
        placed = found.withColumn("task", F.spark_partition_id())
        assert "monotonically_increasing_id" not in found._jdf.queryExecution().optimizedPlan().toString()
        outcomes.append(sorted(tuple(r) for r in placed.select("number", "task", *[f"{c}_n" for c in keys]).collect()))
    assert outcomes[0] == outcomes[1] and len(outcomes[0]) == 30_000


def test_rows_that_come_from_no_file_are_written_once(spark):
    rows = spark.range(1_000).select((F.col("id") % 5).alias("k"), F.lit("x").alias("__row"), F.lit("y").alias("__key"))
    known, row = identity.identified(rows)
    assert row == "___row" and known.select(row).distinct().count() == 1_000
    table = counted(rows, "k", "v")
    for limit in (0, 1 << 20):
        found = attach(rows, F.col("k"), table, broadcast_bytes=limit)
        assert found.columns == ["k", "__row", "__key", "v"]
        assert found.filter("v = 200").count() == 1_000
    hidden = spark.createDataFrame([(i, "own") for i in range(50)], "k long, _metadata string")
    known, row = identity.identified(hidden)
    assert known.select(row).distinct().count() == 50 and known.columns == ["k", "_metadata", row]


def test_scans_are_told_from_other_plans(spark, written):
    rows = spark.read.parquet(written)
    assert identity.is_file_scan(rows) and identity.is_file_scan(rows.filter("number > 5").select("number"))
    for other in (rows.union(rows), rows.distinct(), rows.select(F.explode(F.array("a", "b"))), rows.join(rows.select("a"), "a"), spark.range(3)):
        assert not identity.is_file_scan(other)
