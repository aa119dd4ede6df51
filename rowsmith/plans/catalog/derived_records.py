"""Accident and intrusion records derived from a table of events.

Neither job's files come with the library. These records have the same columns, and
their labels follow from their features, so that a model has something to learn. Whole
number arithmetic on the row id decides every value, which makes them easy to derive
again in SQL. One third of the accidents share one state.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowsmith.fixed_values import INTRUSION_COLUMNS

WEATHER = [
    "Clear", "Fair", "Mostly Cloudy", "OVERCAST", "Light Rain", "Heavy Rain", "Thunderstorm",
    "T-Storm", "Light Snow", "Heavy Snow", "Squalls", "Fog", "Fog / Rain",
]
WIND = ["North", "NNE", "NE", "ENE", "East", "South", "WSW", "NW", "NNW", "Calm", "Variable", "X"]
TIMEZONES = ["US/Eastern", "US/Central", "US/Mountain", "US/Pacific"]
FLAG_PERIODS = {
    "Amenity": 5, "Bump": 19, "Crossing": 7, "Give_Way": 23, "Junction": 4, "No_Exit": 9,
    "Railway": 13, "Roundabout": 31, "Station": 11, "Stop": 6, "Traffic_Calming": 29,
    "Traffic_Signal": 3,
}


def _step(row: Column, factor: int, modulus: int) -> Column:
    return (row * factor + 7) % modulus


def _but_null_every(row: Column, period: int, value: Column) -> Column:
    return F.when(row % period != 0, value)


def _pick(values: list[str], position: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (position + 1).cast("int"))


def _named(prefix: str, number: Column) -> Column:
    return F.concat(F.lit(prefix), number.cast("string"))


def multiplied(events: DataFrame, copies: int) -> DataFrame:
    """``row_id`` and ``ts`` of ``copies`` records per event."""
    copy = F.explode(F.sequence(F.lit(0), F.lit(copies - 1))) if copies > 1 else F.lit(0)
    numbered = events.select("event_id", "ts", copy.alias("copy"))
    return numbered.select((F.col("event_id") * copies + F.col("copy")).alias("row_id"), "ts")


def accident_records(events: DataFrame, copies: int = 1) -> DataFrame:
    """Accident records with nulls and unreadable times planted."""
    row = F.col("row_id")
    text_time = F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    long_time = F.concat(text_time, F.lit(".000000000"))
    start_time = F.when(row % 2 == 0, long_time).otherwise(text_time)
    temperature = _step(row, 31, 1000) / F.lit(10.0)
    wind_speed = _step(row, 41, 300) / F.lit(10.0)
    signal = row % FLAG_PERIODS["Traffic_Signal"] == 0
    severity = (
        1
        + (temperature > 60).cast("int")
        + (wind_speed > 12).cast("int")
        + (signal & (temperature > 30)).cast("int")
    )
    columns = {
        "ID": _named("A-", row),
        "Source": F.lit("Source1"),
        "Severity": severity,
        "Start_Time": F.when(row % 97 == 0, F.lit("bad")).when(row % 89 != 0, start_time),
        "End_Time": text_time,
        "Start_Lat": 25 + _step(row, 37, 2400) / F.lit(100.0),
        "Start_Lng": _step(row, 53, 5700) / F.lit(100.0) - 124,
        "End_Lat": F.lit(None).cast("double"),
        "End_Lng": F.lit(None).cast("double"),
        "Distance(mi)": _step(row, 3, 50) / F.lit(10.0),
        "Description": _named("Accident ", row),
        "Street": _but_null_every(row, 401, _named("Street ", _step(row, 13, 5003))),
        "City": _but_null_every(row, 307, _named("City ", _step(row, 17, 401))),
        "County": _but_null_every(row, 211, _named("County ", _step(row, 19, 97))),
        "State": F.when(row % 3 == 0, F.lit("CA")).otherwise(_named("S", _step(row, 23, 48))),
        "Zipcode": _but_null_every(row, 103, _step(row, 29, 9973).cast("string")),
        "Country": F.lit("US"),
        "Timezone": _but_null_every(row, 113, _pick(TIMEZONES, row % len(TIMEZONES))),
        "Airport_Code": _but_null_every(row, 109, _named("K", _step(row, 43, 997))),
        "Weather_Timestamp": text_time,
        "Temperature(F)": _but_null_every(row, 11, temperature),
        "Wind_Chill(F)": _but_null_every(row, 4, temperature - 3),
        "Humidity(%)": _but_null_every(row, 13, _step(row, 47, 101).cast("double")),
        "Pressure(in)": _but_null_every(row, 17, 25 + _step(row, 59, 600) / F.lit(100.0)),
        "Visibility(mi)": _but_null_every(row, 19, _step(row, 61, 11).cast("double")),
        "Wind_Direction": _but_null_every(row, 23, _pick(WIND, _step(row, 5, len(WIND)))),
        "Wind_Speed(mph)": _but_null_every(row, 7, wind_speed),
        "Precipitation(in)": _but_null_every(row, 3, _step(row, 67, 120) / F.lit(100.0)),
        "Weather_Condition": _but_null_every(row, 29, _pick(WEATHER, _step(row, 3, len(WEATHER)))),
        **{name: row % period == 0 for name, period in FLAG_PERIODS.items()},
        "Turning_Loop": F.lit(False),
        "Sunrise_Sunset": _but_null_every(row, 31, _pick(["Day", "Night"], row % 2)),
        "Civil_Twilight": _but_null_every(row, 37, _pick(["Day", "Night"], _step(row, 3, 2))),
        "Nautical_Twilight": _but_null_every(row, 41, _pick(["Day", "Night"], row % 2)),
        "Astronomical_Twilight": _pick(["Day", "Night"], _step(row, 5, 2)),
    }
    rows = multiplied(events, copies)
    return rows.select(*[value.alias(name) for name, value in columns.items()])


PROTOCOLS = ["tcp", "udp", "icmp"]
SERVICES = ["http", "smtp", "ftp", "domain_u", "private"]
FLAGS = ["SF", "S0", "REJ"]
ATTACKS = ["neptune", "smurf", "satan"]


def intrusion_records(events: DataFrame, copies: int = 1) -> DataFrame:
    """Intrusion records: an attack shows in the error rates and byte counts."""
    row = F.col("row_id")
    attack = _step(row, 11, 100) < 40
    columns = {}
    for place, name in enumerate(INTRUSION_COLUMNS):
        noise = _step(row, 2 * place + 3, 101 + 2 * place)
        if name == "protocol_type":
            value = _pick(PROTOCOLS, row % len(PROTOCOLS))
        elif name == "service":
            value = _pick(SERVICES, _step(row, 3, len(SERVICES)))
        elif name == "flag":
            value = _pick(FLAGS, _step(row, 5, len(FLAGS)))
        elif name == "outcome":
            value = F.when(attack, _pick(ATTACKS, row % len(ATTACKS))).otherwise("normal")
        elif name == "num_outbound_cmds":
            value = F.lit(0)
        elif name.endswith("_rate"):
            lift = F.when(attack & F.lit("serror" in name), 40).otherwise(0)
            value = F.round((noise % 61 + lift) / F.lit(100.0), 2)
        elif name == "src_bytes":
            value = noise * F.when(attack, 2).otherwise(5)
        else:
            value = noise
        columns[name] = value.cast("string")
    rows = multiplied(events, copies)
    return rows.select("row_id", *[value.alias(name) for name, value in columns.items()])
