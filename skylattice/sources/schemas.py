"""Schemas of the flight, weather, station and airport tables.

Only the columns the operators use are listed; Parquet files may hold more.
"""

# The hourly measures of a weather reading, all stored as text.
WEATHER_MEASURES = [
    "HourlyAltimeterSetting",
    "HourlyDewPointTemperature",
    "HourlyDryBulbTemperature",
    "HourlyPrecipitation",
    "HourlyPresentWeatherType",
    "HourlyPressureChange",
    "HourlyPressureTendency",
    "HourlyRelativeHumidity",
    "HourlySkyConditions",
    "HourlySeaLevelPressure",
    "HourlyStationPressure",
    "HourlyVisibility",
    "HourlyWetBulbTemperature",
    "HourlyWindDirection",
    "HourlyWindGustSpeed",
    "HourlyWindSpeed",
]

# Measures that hold codes; they have no number statistics.
WEATHER_CODES = ["HourlyPresentWeatherType", "HourlySkyConditions"]

FLIGHTS = (
    "FL_DATE string, YEAR int, QUARTER int, MONTH int, DAY_OF_MONTH int, DAY_OF_WEEK int, "
    "CRS_DEP_TIME int, CRS_ARR_TIME int, DEP_TIME int, ARR_TIME int, ORIGIN string, "
    "DEST string, ORIGIN_AIRPORT_ID int, DEST_AIRPORT_ID int, ORIGIN_STATE_ABR string, "
    "TAIL_NUM string, OP_UNIQUE_CARRIER string, OP_CARRIER_FL_NUM int, DEP_DELAY double, "
    "DEP_DELAY_NEW double, ARR_DELAY double, ARR_DELAY_NEW double, DEP_DEL15 double, "
    "CANCELLED double, DIVERTED double, FLIGHTS double, DISTANCE double, DISTANCE_GROUP int"
)

WEATHER = "STATION string, DATE string, " + ", ".join(f"{m} string" for m in WEATHER_MEASURES)

STATIONS = (
    "station_id string, neighbor_call string, distance_to_neighbor double, "
    "neighbor_lat double, neighbor_lon double"
)

AIRPORTS = "ident string, type string, iso_region string, iata_code string"
