"""Files of both jobs made from the orders: labels and features follow from the values of an order.

The grade of an accident and whether a record is an attack are steps of the order's price, and
several features follow the same steps, so that a good model makes no mistake and SQL can tell
from the orders what a whole job must find. All other columns are values of the order that say
nothing about its price.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowsmith.fixed_values import INTRUSION_COLUMNS

#: Prices above which an accident is one grade worse.
GRADE_PRICES = (125_000, 250_000, 375_000)
#: An order above this price is an attack.
ATTACK_PRICE = 250_000
#: Orders whose key is a multiple have a time that cannot be read.
UNREADABLE_EVERY = 97
GRADE_SQL = "1 + " + " + ".join(f"(o_totalprice > {p})::integer" for p in GRADE_PRICES)


def _text(prefix: str, value: Column) -> Column:
    return F.concat(F.lit(prefix), value.cast("string"))


def accidents_of(orders: DataFrame) -> DataFrame:
    """An accident record per order; its severity, 1 to 4, is the grade of the price."""
    key, customer, price = F.col("o_orderkey"), F.col("o_custkey"), F.col("o_totalprice")
    grade = F.lit(1)
    for bound in GRADE_PRICES:
        grade = grade + (price > bound).cast("int")
    moment = F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")
    nothing, number = F.lit(None).cast("double"), F.lit(0.0)
    columns = {
        "ID": _text("A-", key),
        "Source": F.col("o_orderstatus"),
        "Severity": grade,
        "Start_Time": F.when(key % UNREADABLE_EVERY == 0, "bad").otherwise(moment),
        "End_Time": moment,
        "Start_Lat": 25 + customer % 24 + number,
        "Start_Lng": -100 - customer % 19 + number,
        "End_Lat": nothing,
        "End_Lng": nothing,
        "Distance(mi)": customer % 7 + number,
        "Description": _text("Order ", key),
        "Street": _text("Street ", customer),
        "City": F.when(customer % 11 != 0, _text("City ", customer % 401)),
        "County": F.col("o_orderpriority"),
        "State": F.col("o_orderstatus"),
        "Zipcode": customer.cast("string"),
        "Country": F.lit("US"),
        "Timezone": F.when(customer % 5 != 0, _text("Zone ", customer % 4)),
        "Airport_Code": _text("K", customer % 97),
        "Weather_Timestamp": moment,
        "Temperature(F)": 20 * grade + customer % 5 + number,
        "Wind_Chill(F)": 20 * grade + customer % 3 + number,
        "Humidity(%)": 20 * grade + key % 4 + number,
        "Pressure(in)": 2 * grade + 20 + number,
        "Visibility(mi)": F.when(customer % 3 != 0, customer % 10 + number),
        "Wind_Direction": F.element_at(F.array(*map(F.lit, ("North", "East", "Calm"))), (customer % 3 + 1).cast("int")),
        "Wind_Speed(mph)": 10 * grade + customer % 2 + number,
        "Precipitation(in)": grade + number,
        "Weather_Condition": F.element_at(F.array(*map(F.lit, ("Clear", "Fog", "Light Rain"))), (key % 3 + 1).cast("int")),
        **{
            name: (customer % period) == 0
            for period, name in enumerate(
                ("Amenity", "Bump", "Crossing", "Give_Way", "Junction", "No_Exit", "Railway", "Roundabout", "Station",
                 "Stop", "Traffic_Calming", "Traffic_Signal"), 2,
            )
        },
        "Turning_Loop": F.lit(False),
        **{
            name: F.when(customer % period == 0, "Night").otherwise("Day")
            for period, name in enumerate(("Sunrise_Sunset", "Civil_Twilight", "Nautical_Twilight", "Astronomical_Twilight"), 2)
        },
    }
    return orders.select(*[value.alias(name) for name, value in columns.items()])


def intrusions_of(orders: DataFrame) -> DataFrame:
    """An intrusion record per order beside its key, all texts; those above ``ATTACK_PRICE`` are attacks."""
    customer, price = F.col("o_custkey"), F.col("o_totalprice")
    attack = price > ATTACK_PRICE
    columns = {}
    for place, name in enumerate(INTRUSION_COLUMNS):
        noise = customer * (2 * place + 3) % (101 + 2 * place)
        if name == "outcome":
            value = F.when(attack, F.lower("o_orderpriority")).otherwise("normal")
        elif name in ("protocol_type", "service", "flag"):
            value = F.col("o_orderstatus")
        elif name in ("src_bytes", "dst_bytes"):
            value = F.floor(price / 1_000) + F.when(attack, 500).otherwise(0)
        elif "serror" in name:
            value = (noise % 50 + F.when(attack, 50).otherwise(0)) / F.lit(100.0)
        else:
            value = noise
        columns[name] = value.cast("string")
    return orders.select(F.col("o_orderkey").alias("row_id"), *[value.alias(name) for name, value in columns.items()])
