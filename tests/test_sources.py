"""Files, generated rows, sinks and the shared folder."""

import datetime

import pytest
from pyspark.sql import functions as F

from rowsmith import storage
from rowsmith.fixed_values import ACCIDENT_SCHEMA, INTRUSION_COLUMNS
from rowsmith.operators import columns as cols
from rowsmith.plans import readings as readings_job
from rowsmith.sources import generated, sinks
from rowsmith.sources.delimited import read_delimited, read_headerless, write_delimited


def test_headered_file_with_bad_values(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_text("id,flag,x\n1,True,2.5\n2,false,oops\n3,,\n")
    df = read_delimited(spark, str(path), "id int, flag boolean, x double")
    rows = [tuple(r) for r in df.orderBy("id").collect()]
    assert rows == [(1, True, 2.5), (2, False, None), (3, None, None)]
    assert dict(read_delimited(spark, str(path)).dtypes) == {"id": "int", "flag": "boolean", "x": "string"}


def test_header_that_does_not_fit_the_schema(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_text("x,id\n2.5,1\n")
    with pytest.raises(Exception, match="(?i)header"):
        read_delimited(spark, str(path), "id int, x double").collect()


def test_headerless_file(spark, tmp_path):
    path = tmp_path / "a.txt"
    path.write_text("0,tcp\n1,udp\n")
    df = read_headerless(spark, str(path), ["n", "p"])
    assert df.dtypes == [("n", "string"), ("p", "string")]
    assert [tuple(r) for r in df.orderBy("n").collect()] == [("0", "tcp"), ("1", "udp")]
    with pytest.raises(ValueError):
        read_headerless(spark, str(path), ["n"])


def test_column_lists():
    assert len(INTRUSION_COLUMNS) == 43
    assert len(ACCIDENT_SCHEMA.split(",")) == 46


def test_written_file_reads_back(spark, tmp_path):
    df = spark.range(10).withColumn("Temperature(F)", F.col("id") / 4)
    write_delimited(df, str(tmp_path / "out"))
    back = read_delimited(spark, str(tmp_path / "out"), df.schema)
    assert back.exceptAll(df).count() == 0


def test_readings_repeat_and_stay_in_range(spark):
    first, second = generated.readings(spark, 3000), generated.readings(spark, 3000)
    assert first.exceptAll(second).count() == 0
    row = first.agg(
        F.min("TID"), F.max("TID"), F.min("UID"), F.max("UID"), F.min("val") >= 50,
        F.max("val") <= 250, F.min("time"), F.max("time"),
    ).first()
    assert tuple(row)[:6] == (1, 70, 101, 3100, True, True)
    assert datetime.date(2023, 1, 1) <= row[6] and row[7] <= datetime.date(2023, 12, 30)
    assert readings_job.high_readings(first).filter("val <= 100").count() == 0
    assert readings_job.totals(first).count() == 70


def test_literals_and_ranges(spark):
    rows = generated.literal_rows(spark, [(1, "a")], "n int, s string")
    assert [tuple(r) for r in rows.collect()] == [(1, "a")]
    numbers = generated.number_range(spark, 1, 6)
    doubled = numbers.select((F.col("x") * 2).alias("x"))
    assert sorted(r["x"] for r in doubled.collect()) == [2, 4, 6, 8, 10]


def test_metrics_sink(spark, tmp_path):
    table = spark.createDataFrame([("M", "f1", 0.80724)], "model string, metric string, value double")
    sinks.write_metrics(table, str(tmp_path / "m"))
    assert spark.read.text(str(tmp_path / "m" / "lines")).first()[0] == "M f1: 0.8072"
    assert spark.read.parquet(str(tmp_path / "m" / "table")).count() == 1


def test_materialized_table_keeps_names_and_rows(spark):
    df = spark.range(5).withColumn("Wind_Speed(mph)", F.col("id") * 1.5)
    written = storage.materialize(df, "test")
    assert written.dtypes == df.dtypes
    assert written.exceptAll(df).count() == 0
    assert storage.scratch_path(spark, "a") != storage.scratch_path(spark, "a")
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        assert storage.scratch_path(spark, "a").startswith(folder.rstrip("/"))


def test_projection_helpers(spark):
    df = spark.createDataFrame([(1, "a", 2.0)], "id int, s string, `x(y)` double")
    assert cols.drop_columns(df, ["s", "none"]).columns == ["id", "x(y)"]
    assert cols.select_except(df, ["id"]).columns == ["s", "x(y)"]
    assert cols.rename_column(df, "s", "t").columns == ["id", "t", "x(y)"]
    assert cols.keep_numeric(df).columns == ["id", "x(y)"]
    assert cols.present(df, ["x(y)", "none", "id"]) == ["x(y)", "id"]
    dated = df.withColumn("ts", F.current_timestamp())
    assert cols.drop_datetime(dated).columns == df.columns
    assert cols.cast_columns(df, {"id": "string"}).first()["id"] == "1"
