"""Column lists of the flight tables."""

# Known only after departure, so no feature may use them.
LEAKAGE = [
    "DEP_TIME",
    "DEP_DELAY_NEW",
    "DEP_DELAY_GROUP",
    "DEP_TIME_BLK",
    "TAXI_OUT",
    "WHEELS_OFF",
    "WHEELS_ON",
    "TAXI_IN",
    "ACTUAL_ELAPSED_TIME",
    "CRS_ELAPSED_TIME",
    "ARR_TIME",
    "ARR_DELAY",
    "ARR_DELAY_NEW",
    "ARR_DEL15",
    "ARR_DELAY_GROUP",
    "ARR_TIME_BLK",
    "CANCELLED",
    "CANCELLATION_CODE",
    "DIVERTED",
    "AIR_TIME",
    "CARRIER_DELAY",
    "WEATHER_DELAY",
    "NAS_DELAY",
    "SECURITY_DELAY",
    "LATE_AIRCRAFT_DELAY",
]

# Names of the station columns once joined to both airports.
STATION_RENAMES = {
    "origin_station_station_id": "origin_station_id",
    "origin_station_iata_code": "origin_iata_code",
    "origin_station_type": "origin_type",
    "origin_station_iso_region": "origin_region",
    "origin_station_neighbor_lat": "origin_airport_lat",
    "origin_station_neighbor_lon": "origin_airport_lon",
    "origin_station_distance_to_neighbor": "origin_station_dis",
    "dest_station_station_id": "dest_station_id",
    "dest_station_iata_code": "dest_iata_code",
    "dest_station_type": "dest_type",
    "dest_station_iso_region": "dest_region",
    "dest_station_neighbor_lat": "dest_airport_lat",
    "dest_station_neighbor_lon": "dest_airport_lon",
    "dest_station_distance_to_neighbor": "dest_station_dis",
    "depart_UTC": "sched_depart_date_time_UTC",
}

# Text, identifiers and times that are no model input.
UNINFORMATIVE = [
    "OP_CARRIER",
    "TAIL_NUM",
    "ORIGIN_CITY_NAME",
    "ORIGIN_STATE_ABR",
    "ORIGIN_STATE_NM",
    "DEST_CITY_NAME",
    "DEST_STATE_ABR",
    "DEST_STATE_NM",
    "origin_station_name",
    "origin_station_id",
    "origin_iata_code",
    "origin_region",
    "dest_station_name",
    "dest_station_id",
    "dest_iata_code",
    "dest_region",
    "STATION",
    "NAME",
    "REPORT_TYPE",
    "REM",
    "BackupDirection",
    "BackupDistanceUnit",
    "BackupElements",
    "BackupEquipment",
    "BackupName",
    "ORIGIN_AIRPORT_SEQ_ID",
    "ORIGIN_CITY_MARKET_ID",
    "ORIGIN_STATE_FIPS",
    "ORIGIN_WAC",
    "DEST_AIRPORT_SEQ_ID",
    "DEST_CITY_MARKET_ID",
    "DEST_STATE_FIPS",
    "DEST_WAC",
    "SOURCE",
    "BackupElevation",
    "LATITUDE",
    "LONGITUDE",
    "BackupLatitude",
    "BackupLongitude",
    "BackupDistance",
    "QUARTER",
    "OP_CARRIER_AIRLINE_ID",
    "ORIGIN_AIRPORT_ID",
    "DEST_AIRPORT_ID",
    "CRS_DEP_TIME",
    "CRS_ARR_TIME",
    "dest_station_lat",
    "dest_station_lon",
    "sched_depart_date_time_UTC",
    "Depart_2hrs_before",
    "DATE",
    "WindEquipmentChangeDate",
    "origin_station_lon",
    "origin_station_lat",
    "HourlySkyConditions",
    "HourlyPresentWeatherType",
]

CATEGORICAL = ["OP_UNIQUE_CARRIER", "DAY_OF_WEEK", "region", "origin_type"]
LABEL = "DEP_DEL15"
