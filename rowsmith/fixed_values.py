"""Lists, maps and patterns that decide results and so must not change."""

from __future__ import annotations

# Wind direction names and the compass point each one stands for.
COMPASS_POINTS = {
    "North": "N",
    "NNE": "NE",
    "NE": "NE",
    "ENE": "E",
    "East": "E",
    "ESE": "SE",
    "SE": "SE",
    "SSE": "S",
    "South": "S",
    "SSW": "SW",
    "SW": "SW",
    "WSW": "W",
    "West": "W",
    "WNW": "NW",
    "NW": "NW",
    "NNW": "NW",
    "Calm": "CALM",
    "Variable": "VAR",
}

# Weather groups and their patterns, in order of precedence.
WEATHER_PATTERNS = {
    "Clear": "Clear",
    "Cloud": "Cloud|Overcast",
    "Rain": "Rain|storm",
    "Heavy_Rain": "Heavy Rain|Rain Shower|Heavy T-Storm|Heavy Thunderstorms",
    "Snow": "Snow|Sleet|Ice",
    "Heavy_Snow": "Heavy Snow|Heavy Sleet|Heavy Ice Pellets|Snow Showers|Squalls",
    "Fog": "Fog",
}

# Texts that count as a set flag.
TRUE_TEXTS = ("true", "yes", "1", "day")

# Replacement for a missing category.
UNKNOWN = "Unknown"

# Timestamp layout of accident records.
TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss"
TIMESTAMP_LENGTH = 19

# Accident columns.
ACCIDENT_SCHEMA = """
    ID string, Source string, Severity int, Start_Time string, End_Time string,
    Start_Lat double, Start_Lng double, End_Lat double, End_Lng double, `Distance(mi)` double,
    Description string, Street string, City string, County string, State string, Zipcode string,
    Country string, Timezone string, Airport_Code string, Weather_Timestamp string,
    `Temperature(F)` double, `Wind_Chill(F)` double, `Humidity(%)` double, `Pressure(in)` double,
    `Visibility(mi)` double, Wind_Direction string, `Wind_Speed(mph)` double,
    `Precipitation(in)` double, Weather_Condition string, Amenity boolean, Bump boolean,
    Crossing boolean, Give_Way boolean, Junction boolean, No_Exit boolean, Railway boolean,
    Roundabout boolean, Station boolean, Stop boolean, Traffic_Calming boolean,
    Traffic_Signal boolean, Turning_Loop boolean, Sunrise_Sunset string, Civil_Twilight string,
    Nautical_Twilight string, Astronomical_Twilight string
"""
ACCIDENT_LABEL = "Severity"
ACCIDENT_UNUSED = [
    "ID", "Source", "Description", "Distance", "End_Time", "Distance(mi)", "End_Lng", "End_Lat",
    "Duration", "Weather_Timestamp", "Country", "Turning_Loop",
]
ACCIDENT_NUMERIC = [
    "Temperature(F)", "Wind_Chill(F)", "Humidity(%)", "Pressure(in)", "Visibility(mi)",
    "Wind_Speed(mph)", "Precipitation(in)",
]
ACCIDENT_TEXT = [
    "Street", "City", "Zipcode", "Weather_Condition", "Wind_Direction", "County", "State",
    "Airport_Code",
]
ACCIDENT_TEXT_SHORT = ["Street", "City", "Zipcode", "Weather_Condition", "Wind_Direction"]
ACCIDENT_INDEXED = ["Part_of_Day", "Wind_Direction"]
ACCIDENT_FREQUENCY = ["Street", "City", "Zipcode", "County", "Airport_Code", "State"]
ACCIDENT_ONE_HOT = ["Weather_Condition", "Timezone"]
ACCIDENT_FLAGS = [
    "Sunrise_Sunset", "Civil_Twilight", "Nautical_Twilight", "Astronomical_Twilight", "Amenity",
    "Bump", "Crossing", "Give_Way", "Junction", "No_Exit", "Railway", "Roundabout", "Station",
    "Stop", "Traffic_Calming", "Traffic_Signal",
]
ACCIDENT_LOW_CORRELATION = [
    "Civil_Twilight_bin", "Nautical_Twilight_bin", "Astronomical_Twilight_bin",
    "Traffic_Calming_bin", "Bump_bin", "Give_Way_bin", "Day", "Visibility(mi)", "Roundabout_bin",
    "Wind_Direction_idx",
]
ACCIDENT_FEATURES = [
    "Start_Lat", "Start_Lng", "Temperature(F)", "Wind_Chill(F)", "Humidity(%)", "Pressure(in)",
    "Wind_Speed(mph)", "Precipitation(in)", "Hour", "Month", "Year", "Part_of_Day_idx",
    "Street_freq", "City_freq", "Zipcode_freq", "County_freq", "Airport_Code_freq", "State_freq",
    "Sunrise_Sunset_bin", "Amenity_bin", "Crossing_bin", "Junction_bin", "No_Exit_bin",
    "Railway_bin", "Station_bin", "Stop_bin", "Traffic_Signal_bin",
]

# Correlation bounds below which a feature is noise or irrelevant.
NOISE_BOUND = 0.01
IRRELEVANT_BOUND = 0.05

# Intrusion columns in file order.
INTRUSION_COLUMNS = [
    "duration", "protocol_type", "service", "flag", "src_bytes", "dst_bytes", "land",
    "wrong_fragment", "urgent", "hot", "num_failed_logins", "logged_in", "num_compromised",
    "root_shell", "su_attempted", "num_root", "num_file_creations", "num_shells",
    "num_access_files", "num_outbound_cmds", "is_host_login", "is_guest_login", "count",
    "srv_count", "serror_rate", "srv_serror_rate", "rerror_rate", "srv_rerror_rate",
    "same_srv_rate", "diff_srv_rate", "srv_diff_host_rate", "dst_host_count",
    "dst_host_srv_count", "dst_host_same_srv_rate", "dst_host_diff_srv_rate",
    "dst_host_same_src_port_rate", "dst_host_srv_diff_host_rate", "dst_host_serror_rate",
    "dst_host_srv_serror_rate", "dst_host_rerror_rate", "dst_host_srv_rerror_rate", "outcome",
    "level",
]
INTRUSION_TEXT = ["protocol_type", "service", "flag"]
INTRUSION_LABEL = "outcome"
INTRUSION_NORMAL = "normal"
INTRUSION_DIFFICULTY = "level"

# Model settings.
FOREST_SETTINGS = {"numTrees": 10, "maxDepth": 12, "maxBins": 32, "seed": 42}
LOGISTIC_SETTINGS = {"maxIter": 50, "regParam": 0.0, "elasticNetParam": 0.0}
BINARY_LOGISTIC_SETTINGS = {"maxIter": 20}
TRAIN_FRACTION = "0.7"
SPLIT_SEED = 42

# Synthetic readings.
READING_TIDS = 70
READING_FIRST_UID = 101
READING_LOW, READING_HIGH = 50, 250
READING_FIRST_DAY, READING_DAYS = "2023-01-01", 364
