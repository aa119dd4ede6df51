"""Text maps, buckets and flags; date parts."""

from __future__ import annotations

from pyspark.sql import functions as F

from rowsmith.functions import dates, text
from rowsmith.operators import columns as cols
from rowsmith.operators import encode
from rowsmith.plans import readings as readings_job
from rowsmith.plans.catalog.registry import query, table
from rowsmith.sources.generated import readings_for

PRIORITIES = {"1-URGENT": "URGENT", "2-HIGH": "HIGH", "5-LOW": "LOW"}
PART_PATTERNS = {
    "Tool": "bolt|gear",
    "Warm": "red|HOT",
    "Ring": "Ring|anvil",
    "Small": "small",
}


@query(
    "value_map",
    """select o_orderkey, case o_orderpriority when '1-URGENT' then 'URGENT'
       when '2-HIGH' then 'HIGH' when '5-LOW' then 'LOW' else o_orderpriority end
       as o_orderpriority from orders""",
)
def value_map(spark, folder):
    rows = table(spark, folder, "orders").select("o_orderkey", "o_orderpriority")
    return cols.map_values(rows, PRIORITIES, ["o_orderpriority"])


@query(
    "regex_bucket_last",
    """select p_partkey, case when regexp_matches(p_name, '(?i)small') then 'Small'
       when regexp_matches(p_name, '(?i)Ring|anvil') then 'Ring'
       when regexp_matches(p_name, '(?i)red|HOT') then 'Warm'
       when regexp_matches(p_name, '(?i)bolt|gear') then 'Tool' end as bucket from part""",
)
def regex_bucket_last(spark, folder):
    bucket = text.bucket_last(F.col("p_name"), PART_PATTERNS)
    return table(spark, folder, "part").select("p_partkey", bucket.alias("bucket"))


@query(
    "regex_bucket_first",
    """select p_partkey, case when regexp_matches(p_name, '(?i)bolt|gear') then 'Tool'
       when regexp_matches(p_name, '(?i)red|HOT') then 'Warm'
       when regexp_matches(p_name, '(?i)Ring|anvil') then 'Ring'
       when regexp_matches(p_name, '(?i)small') then 'Small' else 'Unknown' end as bucket
       from part""",
)
def regex_bucket_first(spark, folder):
    bucket = text.bucket_first(F.col("p_name"), PART_PATTERNS)
    return table(spark, folder, "part").select("p_partkey", bucket.alias("bucket"))


@query(
    "lower_trimmed",
    "select c_custkey, lower(c_mktsegment) as segment from customer",
)
def lower_trimmed(spark, folder):
    padded = F.concat(F.lit(" \t"), F.col("c_mktsegment"), F.lit("\n "))
    return table(spark, folder, "customer").select(
        "c_custkey", text.lower_trimmed(padded).alias("segment")
    )


@query(
    "timestamp_text",
    "select event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') as ts_text from events",
)
def timestamp_text(spark, folder):
    full = F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS")
    return table(spark, folder, "events").select(
        "event_id", dates.timestamp_text(full).alias("ts_text")
    )


@query(
    "binary_flags",
    """select o_orderkey,
       case when o_orderkey % 4 < 3 then 1 else 0 end as answer_bin,
       case when o_orderstatus = 'F' then 1 else 0 end as finished_bin,
       case when o_orderpriority = '5-LOW' then 1 else 0 end as low_bin from orders""",
)
def binary_flags(spark, folder):
    answers = F.array(*[F.lit(v) for v in (" YES ", "true", "Day", "no")])
    rows = table(spark, folder, "orders").select(
        "o_orderkey",
        F.element_at(answers, (F.col("o_orderkey") % 4 + 1).cast("int")).alias("answer"),
        (F.col("o_orderstatus") == "F").alias("finished"),
        F.when(F.col("o_orderpriority") == "5-LOW", "1").alias("low"),
    )
    return encode.binary_flags(rows, ["answer", "finished", "low", "absent"], trim=True)


@query(
    "binary_label",
    """select event_id, case when event_type = 'view' then 0 else 1 end as outcome
       from events""",
)
def binary_label(spark, folder):
    kind = F.nullif(F.col("event_type"), F.lit("error"))
    return table(spark, folder, "events").select(
        "event_id", text.binary_label(kind, "view").alias("outcome")
    )


@query(
    "parse_timestamp",
    """select event_id, case when event_id % 10 <> 0
       then strftime(ts, '%Y-%m-%d %H:%M:%S') end as parsed from events""",
)
def parse_timestamp(spark, folder):
    full = F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS")
    planted = F.when(F.col("event_id") % 10 == 0, F.lit("bad")).otherwise(full)
    parsed = dates.parse_timestamp(planted)
    return table(spark, folder, "events").select(
        "event_id", F.date_format(parsed, "yyyy-MM-dd HH:mm:ss").alias("parsed")
    )


@query(
    "date_parts",
    """select event_id, hour(ts)::integer as hour, hour(ts)::integer + 1 as hour_from_1,
       dayofweek(ts)::integer + 1 as day_from_sunday, isodow(ts)::integer as day_from_monday,
       month(ts)::integer as month, year(ts)::integer as year from events""",
)
def date_parts(spark, folder):
    moment = F.col("ts")
    return table(spark, folder, "events").select(
        "event_id",
        dates.hour_of(moment).alias("hour"),
        dates.hour_of(moment, 1).alias("hour_from_1"),
        dates.day_of_week(moment).alias("day_from_sunday"),
        dates.day_of_week(moment, monday_first=True).alias("day_from_monday"),
        dates.month(moment).alias("month"),
        dates.year(moment).alias("year"),
    )


@query(
    "part_of_day",
    """with hours as (select event_id, hour(ts) as h from events),
    both_bases as (select event_id, h, h + 1 as h1 from hours)
    select event_id,
       case when h between 1 and 6 then 'Night' when h between 7 and 12 then 'Morning'
            when h between 13 and 18 then 'Afternoon' else 'Evening' end as part,
       case when h1 between 1 and 6 then 'Night' when h1 between 7 and 12 then 'Morning'
            when h1 between 13 and 18 then 'Afternoon' else 'Evening' end as part_from_1,
       case when event_id % 10 = 0 then 'Unknown' when h <= 6 then 'Night'
            when h <= 12 then 'Morning' when h <= 18 then 'Afternoon' else 'Evening' end as bin
    from both_bases""",
)
def part_of_day(spark, folder):
    hour = dates.hour_of(F.col("ts"))
    planted = F.when(F.col("event_id") % 10 != 0, hour)
    return table(spark, folder, "events").select(
        "event_id",
        dates.part_of_day(hour).alias("part"),
        dates.part_of_day(dates.hour_of(F.col("ts"), 1)).alias("part_from_1"),
        dates.part_of_day_bins(planted).alias("bin"),
    )


@query(
    "day_flag",
    """select event_id, case when hour(ts) between 1 and 16 then 'Day' else 'Night' end as flag,
       case when hour(ts) <= 16 then 'Day' else 'Night' end as open_flag from events""",
)
def day_flag(spark, folder):
    hour = dates.hour_of(F.col("ts"))
    return table(spark, folder, "events").select(
        "event_id",
        dates.day_flag(hour).alias("flag"),
        dates.day_flag(hour, None).alias("open_flag"),
    )


READINGS = """
    with drawn as (
        select o_orderkey,
               ('0x' || substr(md5('tid:' || o_orderkey::varchar), 1, 8))::bigint as t,
               ('0x' || substr(md5('val:' || o_orderkey::varchar), 1, 8))::bigint as v,
               ('0x' || substr(md5('date:' || o_orderkey::varchar), 1, 8))::bigint as d
        from orders),
    readings as (
        select cast(t % 70 + 1 as integer) as "TID", o_orderkey + 101 as "UID",
               round(v / 4294967296.0::double * 200 + 50, 2) as val,
               strftime(date '2023-01-01' + cast(d % 364 as integer), '%Y-%m-%d') as time
        from drawn)
"""


def _readings(spark, folder):
    return readings_for(table(spark, folder, "orders").select("o_orderkey"), "o_orderkey")


@query("readings", READINGS + 'select "TID", "UID", val, time from readings')
def readings(spark, folder):
    return cols.cast_columns(_readings(spark, folder), {"time": "string"})


@query("readings_high", READINGS + 'select "TID", "UID", val from readings where val > 100')
def readings_high(spark, folder):
    return readings_job.high_readings(_readings(spark, folder)).drop("time")


@query(
    "readings_totals",
    READINGS + 'select "TID", round(sum(val), 2) as total from readings group by "TID"',
)
def readings_totals(spark, folder):
    sums = readings_job.totals(_readings(spark, folder))
    return sums.withColumn("total", F.round("total", 2))
