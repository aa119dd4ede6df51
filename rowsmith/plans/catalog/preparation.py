"""Cleaning and feature stages of both jobs, each against SQL of its own."""

from __future__ import annotations

from pyspark.sql import functions as F

from rowsmith import fixed_values as fixed
from rowsmith.operators.columns import quoted
from rowsmith.plans import intrusion, severity
from rowsmith.plans.catalog.registry import query, table
from rowsmith.plans.catalog.derived_records import FLAG_PERIODS, WEATHER, WIND, accident_records, intrusion_records


def _sql_list(values) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


def _flag_sql(name: str) -> str:
    return f'(r % {FLAG_PERIODS[name]} = 0)::integer as "{name}_bin"'


CLEANED = f"""
    with numbers as (
        select event_id as r, ts, ((event_id * 31 + 7) % 1000) / 10.0::double as temperature,
               ((event_id * 41 + 7) % 300) / 10.0::double as wind_speed
        from events),
    records as (
        select *, 'A-' || r as id,
            1 + (temperature > 60)::integer + (wind_speed > 12)::integer
              + (r % 3 = 0 and temperature > 30)::integer as severity,
            case when r % 97 <> 0 and r % 89 <> 0 then ts end as started,
            case when r % 401 <> 0 then 'Street ' || ((r * 13 + 7) % 5003) end as street,
            case when r % 307 <> 0 then 'City ' || ((r * 17 + 7) % 401) end as city,
            case when r % 211 <> 0 then 'County ' || ((r * 19 + 7) % 97) end as county,
            case when r % 3 = 0 then 'CA' else 'S' || ((r * 23 + 7) % 48) end as state,
            case when r % 103 <> 0 then ((r * 29 + 7) % 9973)::varchar end as zipcode,
            case when r % 109 <> 0 then 'K' || ((r * 43 + 7) % 997) end as airport,
            case when r % 23 <> 0 then {_sql_list(WIND)}[(r * 5 + 7) % 12 + 1] end as wind,
            case when r % 29 <> 0 then {_sql_list(WEATHER)}[(r * 3 + 7) % 13 + 1] end as weather
        from numbers),
    dated as (select *, hour(started)::integer as h from records),
    cleaned as (
        select id as "ID", r, severity as "Severity",
            25 + ((r * 37 + 7) % 2400) / 100.0::double as "Start_Lat",
            ((r * 53 + 7) % 5700) / 100.0::double - 124 as "Start_Lng",
            coalesce(street, 'Unknown') as "Street", coalesce(city, 'Unknown') as "City",
            coalesce(county, 'Unknown') as "County", state as "State",
            coalesce(zipcode, 'Unknown') as "Zipcode",
            case when r % 113 <> 0 then
                ['US/Eastern', 'US/Central', 'US/Mountain', 'US/Pacific'][r % 4 + 1]
            end as "Timezone",
            coalesce(airport, 'Unknown') as "Airport_Code",
            case when r % 11 <> 0 then temperature end as "Temperature(F)",
            case when r % 4 <> 0 then temperature - 3 end as "Wind_Chill(F)",
            case when r % 13 <> 0 then ((r * 47 + 7) % 101)::double end as "Humidity(%)",
            case when r % 17 <> 0 then 25 + ((r * 59 + 7) % 600) / 100.0::double end
                as "Pressure(in)",
            case when r % 19 <> 0 then ((r * 61 + 7) % 11)::double end as "Visibility(mi)",
            case wind when 'North' then 'N' when 'NNE' then 'NE' when 'ENE' then 'E'
                when 'East' then 'E' when 'South' then 'S' when 'WSW' then 'W'
                when 'NNW' then 'NW' when 'Calm' then 'CALM' when 'Variable' then 'VAR'
                else coalesce(wind, 'Unknown') end as "Wind_Direction",
            case when r % 7 <> 0 then wind_speed end as "Wind_Speed(mph)",
            case when r % 3 <> 0 then ((r * 67 + 7) % 120) / 100.0::double end
                as "Precipitation(in)",
            case when weather in ('Fog', 'Fog / Rain') then 'Fog'
                when weather in ('Heavy Snow', 'Squalls') then 'Heavy_Snow'
                when weather = 'Light Snow' then 'Snow'
                when weather = 'Heavy Rain' then 'Heavy_Rain'
                when weather in ('Light Rain', 'Thunderstorm', 'T-Storm') then 'Rain'
                when weather in ('Mostly Cloudy', 'OVERCAST') then 'Cloud'
                when weather = 'Clear' then 'Clear' else 'Unknown' end as "Weather_Condition",
            h as "Hour", dayofweek(started)::integer + 1 as "Day",
            month(started)::integer as "Month", year(started)::integer as "Year",
            case when h between 1 and 6 then 'Night' when h between 7 and 12 then 'Morning'
                when h between 13 and 18 then 'Afternoon' else 'Evening' end as "Part_of_Day",
            coalesce(h between 1 and 16, false)::integer as "Sunrise_Sunset_bin",
            (r % 37 <> 0 and (r * 3 + 7) % 2 = 0)::integer as "Civil_Twilight_bin",
            (r % 41 <> 0 and r % 2 = 0)::integer as "Nautical_Twilight_bin",
            ((r * 5 + 7) % 2 = 0)::integer as "Astronomical_Twilight_bin",
            {", ".join(_flag_sql(name) for name in FLAG_PERIODS)}
        from dated)
"""


def _rounded(df):
    doubles = [name for name, kind in df.dtypes if kind == "double"]
    return df.withColumns({c: F.round(quoted(c), 6) for c in doubles})


@query(
    "accident_cleaning",
    CLEANED
    + """select * exclude (r) replace (
        round("Start_Lat", 6) as "Start_Lat", round("Start_Lng", 6) as "Start_Lng",
        round("Wind_Chill(F)", 6) as "Wind_Chill(F)", round("Pressure(in)", 6) as "Pressure(in)")
    from cleaned""",
)
def accident_cleaning(spark, folder):
    records = accident_records(table(spark, folder, "events"))
    return _rounded(severity.clean(records, severity.SeverityOptions(small_categories="one_hot")))


def _mean_filled(name: str) -> str:
    return f'round(coalesce("{name}", (select avg("{name}") from cleaned)), 6) as "{name}"'


def _frequency(name: str) -> str:
    return f'count(*) over (partition by "{name}") as "{name}_freq"'


FEATURES = (
    CLEANED
    + f""", parts as (
        select "Part_of_Day" as part,
               (row_number() over (order by count(*) desc, "Part_of_Day") - 1)::double as i
        from cleaned group by "Part_of_Day")
    select "Severity", round("Start_Lat", 6) as "Start_Lat", round("Start_Lng", 6) as "Start_Lng",
        {", ".join(_mean_filled(c) for c in fixed.ACCIDENT_NUMERIC if c != "Visibility(mi)")},
        "Hour", "Month", "Year", i as "Part_of_Day_idx",
        {", ".join(_frequency(c) for c in fixed.ACCIDENT_FREQUENCY)},
        "Sunrise_Sunset_bin", "Amenity_bin", "Crossing_bin", "Junction_bin", "No_Exit_bin",
        "Railway_bin", "Station_bin", "Stop_bin", "Traffic_Signal_bin",
        case when row_number() over (partition by "Severity" order by md5("ID"), "ID") * 10
                  <= count(*) over (partition by "Severity") * 7
             then 'train' else 'test' end as split
    from cleaned join parts on part = "Part_of_Day"
    """
)


@query("accident_features", FEATURES)
def accident_features(spark, folder):
    return _rounded(severity.features(accident_records(table(spark, folder, "events"))))


def _intrusion_sql() -> str:
    selected = []
    for place, name in enumerate(fixed.INTRUSION_COLUMNS):
        noise = f"(event_id * {2 * place + 3} + 7) % {101 + 2 * place}"
        if name in fixed.INTRUSION_TEXT:
            continue
        if name == fixed.INTRUSION_LABEL:
            value = "attack::integer"
        elif name == "num_outbound_cmds":
            value = "0::double"
        elif name.endswith("_rate"):
            lift = "(case when attack then 40 else 0 end)" if "serror" in name else "0"
            value = f"round(({noise} % 61 + {lift}) / 100.0::double, 2)"
        elif name == "src_bytes":
            value = f"({noise} * case when attack then 2 else 5 end)::double"
        else:
            value = f"({noise})::double"
        selected.append(f'{value} as "{name}"')
    return f"""
    with records as (select event_id, (event_id * 11 + 7) % 100 < 40 as attack from events)
    select event_id as row_id, {", ".join(selected)} from records
    """


@query("intrusion_cleaning", _intrusion_sql())
def intrusion_cleaning(spark, folder):
    records = intrusion_records(table(spark, folder, "events"))
    cleaned = intrusion.clean(records.withColumn("row_id", F.col("row_id").cast("string")))
    return cleaned.withColumn("row_id", F.col("row_id").cast("bigint"))
