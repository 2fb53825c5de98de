"""Declared schemas of the input feeds and of the published table."""

from __future__ import annotations

from pyspark.sql import types as T


def _text(names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names.split()])


# Column names and order of the CSV feeds, all read as text.
TRIPS = _text(
    "ride_id rideable_type started_at ended_at start_station_name start_station_id "
    "end_station_name end_station_id start_lat start_lng end_lat end_lng member_casual"
)
WEATHER = _text(
    "dt temp feels_like pressure humidity dew_point uvi clouds visibility wind_speed wind_deg "
    "pop snow_1h id main description icon loc lat lon timezone timezone_offset rain_1h"
)

# Columns kept in the silver tables, of the status feed and of the live weather
# feed, and the silver columns that are numbers.
SILVER_TRIPS = (
    "ride_id rideable_type started_at ended_at start_station_name start_station_id "
    "end_station_name end_station_id member_casual date time"
).split()
SILVER_WEATHER = (
    "dt temp feels_like humidity main date time wind_speed visibility pressure rain_1h"
).split()
STATUS_LEVELS = (
    "num_ebikes_available num_docks_available num_docks_disabled "
    "num_bikes_disabled num_bikes_available"
).split()
LIVE_WEATHER = "time temp humidity pressure wind_speed clouds".split()
SILVER_NUMBERS = "temp feels_like humidity wind_speed visibility pressure rain_1h".split()

# Published forecasts, one series per station.
GOLD = T.StructType(
    [
        T.StructField("station_id", T.StringType()),
        T.StructField("ds", T.TimestampNTZType()),
        T.StructField("y", T.DoubleType()),
        T.StructField("yhat", T.DoubleType()),
        T.StructField("model_type", T.StringType()),
        T.StructField("model_res", T.DoubleType()),
        T.StructField("error_mae", T.DoubleType()),
        T.StructField("num_bikes_available", T.DoubleType()),
    ]
)

# One row per model version of a station.
REGISTRY = T.StructType(
    [
        T.StructField("station_id", T.StringType()),
        T.StructField("version", T.IntegerType()),
        T.StructField("stage", T.StringType()),
        T.StructField("mae", T.DoubleType()),
        T.StructField("param_id", T.IntegerType()),
    ]
)

# Stored models, one row per term or parameter of a version.
MODELS = {
    "model_coefficients": T.StructType(
        [
            T.StructField("station_id", T.StringType()),
            T.StructField("version", T.IntegerType()),
            T.StructField("pos", T.IntegerType()),
            T.StructField("term", T.StringType()),
            T.StructField("value", T.DoubleType()),
        ]
    ),
    "model_parameters": T.StructType(
        [
            T.StructField("station_id", T.StringType()),
            T.StructField("version", T.IntegerType()),
            T.StructField("name", T.StringType()),
            T.StructField("value", T.StringType()),
        ]
    ),
}
