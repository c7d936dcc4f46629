"""Declared schemas. Nothing in this package infers a schema from data."""

from __future__ import annotations

from pyspark.sql.types import (
    BooleanType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)


def _struct(*fields: tuple[str, object]) -> StructType:
    return StructType([StructField(name, kind) for name, kind in fields])


# Wire messages: the typed form of the JSON envelope.
ENERGY_MESSAGE = _struct(
    ("time_stamp", LongType()),  # epoch milliseconds
    ("id", StringType()),
    ("value", DoubleType()),
    ("place", StringType()),
    ("generation", BooleanType()),
    ("type_gen", StringType()),
)
WEATHER_MESSAGE = _struct(
    ("time_stamp", LongType()),
    ("lat", DoubleType()),
    ("lon", DoubleType()),
    ("place", StringType()),
    ("temp", DoubleType()),
    ("dew_point", DoubleType()),
    ("uvi", DoubleType()),
    ("clouds", DoubleType()),
)

# Landed responses of the weather service: one document per poll.
WEATHER_DOCUMENT = _struct(
    ("place", StringType()),
    ("status", IntegerType()),
    ("body", StringType()),
)
WEATHER_BODY = _struct(
    ("lat", DoubleType()),
    ("lon", DoubleType()),
    (
        "current",
        _struct(
            ("temp", DoubleType()),
            ("dew_point", DoubleType()),
            ("uvi", DoubleType()),
            ("clouds", DoubleType()),
        ),
    ),
)

# Landed readings of the time-series store; the group key is ordinary columns.
SERIES = _struct(
    ("bucket", StringType()),
    ("_measurement", StringType()),
    ("ID", StringType()),
    ("_field", StringType()),
    ("_time", TimestampType()),
    ("_value", DoubleType()),
)
SERIES_KEY = ("bucket", "_measurement", "ID", "_field")

# Serving tables.
POINT_DATA = _struct(
    ("time_stamp", TimestampType()),
    ("id", StringType()),
    ("place", StringType()),
    ("generation", BooleanType()),
    ("type_gen", StringType()),
    ("kwh", DoubleType()),
)
WEATHER_DATA = _struct(
    ("time_stamp", TimestampType()),
    ("place", StringType()),
    ("temp", DoubleType()),
    ("dew_point", DoubleType()),
    ("uvi", DoubleType()),
    ("clouds", DoubleType()),
)
ENERGY_ANALYTICS = _struct(
    ("hour_group", TimestampType()),
    ("kwh_prod", DoubleType()),
    ("kwh_cons", DoubleType()),
    ("ratio", DoubleType()),
)
ENERGY_WEATHER_ANALYTICS = _struct(
    ("hour_group", TimestampType()),
    ("place", StringType()),
    ("kwh_cons_degree", DoubleType()),
    ("kwh_prod_with_rain_prob", DoubleType()),
    ("kwh_prod_with_no_rain_prob", DoubleType()),
)

SERVING = {
    "point_data": POINT_DATA,
    "weather_data": WEATHER_DATA,
    "energy_analytics": ENERGY_ANALYTICS,
    "energy_weather_analytics": ENERGY_WEATHER_ANALYTICS,
}

# Upsert keys. energy_weather_analytics has one row per bucket *and* place, so
# keying it on the bucket alone would keep an arbitrary place.
KEYS = {
    "point_data": ("time_stamp", "place", "id"),
    "weather_data": ("time_stamp", "place"),
    "energy_analytics": ("hour_group",),
    "energy_weather_analytics": ("hour_group", "place"),
}

# The column whose calendar day partitions each table on disk.
EVENT_TIME = {
    "point_data": "time_stamp",
    "weather_data": "time_stamp",
    "energy_analytics": "hour_group",
    "energy_weather_analytics": "hour_group",
}
