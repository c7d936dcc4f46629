"""Per-record projections: the rows of the point tables.

They are pass-through: a one-minute tumble with nothing aggregated groups
nothing, so no window is built and late rows are kept. Rows without event
time fall in no window and are dropped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def point_data(energy: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    return energy.filter(F.col("ts").isNotNull()).select(
        F.col("ts").alias("time_stamp"),
        "id",
        "place",
        "generation",
        "type_gen",
        F.col("value").alias("kwh"),
        *carry,
    )


def weather_data(weather: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    return weather.filter(F.col("ts").isNotNull()).select(
        F.col("ts").alias("time_stamp"), "place", "temp", "dew_point", "uvi", "clouds", *carry
    )
