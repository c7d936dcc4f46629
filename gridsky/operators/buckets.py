"""Ten-minute summaries and the energy-weather join.

Every aggregate here is a sum or an average, so Spark combines rows before the
shuffle: a bucket or place that holds most of the rows still sends one row per
task. Intermediate frames keep the ``window`` struct; on streams it carries the
watermark, which ``window.start`` does not, and the join state would never be
cleared without it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridsky.functions.numeric import guarded_ratio, ieee_div
from gridsky.functions.timing import BUCKET, bucket
from gridsky.schemas import ENERGY_WEATHER_ANALYTICS

# Rain labels.
RAIN = "Rain"
NO_RAIN = "No Rain"


def _sum_where(flag: Column, value: Column) -> Column:
    # A row on the other side, or with an unknown side, adds 0: a group with
    # rows but none on this side sums to 0, not to NULL.
    return F.sum(F.when(flag, value).otherwise(F.lit(0.0)))


def _production_and_consumption() -> list[Column]:
    value = F.col("value")
    return [
        _sum_where(F.col("generation"), value).alias("kwh_prod"),
        _sum_where(~F.col("generation"), value).alias("kwh_cons"),
    ]


def energy_analytics(energy: DataFrame, width: str = BUCKET) -> DataFrame:
    """Production, consumption and coverage ratio per bucket, over all places."""
    totals = energy.groupBy(bucket("ts", width)).agg(*_production_and_consumption())
    return totals.select(
        F.col("window.start").alias("hour_group"),
        "kwh_prod",
        "kwh_cons",
        guarded_ratio(F.col("kwh_prod"), F.col("kwh_cons")).alias("ratio"),
    )


def energy_window(energy: DataFrame, width: str = BUCKET) -> DataFrame:
    """Production and consumption per bucket and place."""
    return energy.groupBy(bucket("ts", width), "place").agg(*_production_and_consumption())


def weather_window(weather: DataFrame, width: str = BUCKET) -> DataFrame:
    """Average conditions and the rain label per bucket and place."""
    means = weather.groupBy(bucket("ts", width), "place").agg(
        *[F.avg(c).alias(c) for c in ("temp", "dew_point", "uvi", "clouds")]
    )
    return means.select(
        "window", "place", "temp", "dew_point", rain_label().alias("raining_prob"), "uvi", "clouds"
    )


def rain_label() -> Column:
    """From average temperature and dew point. A NULL average compares to NULL and falls to the second label."""
    saturated = F.col("temp") - F.col("dew_point") <= 0
    return F.when(saturated, F.lit(RAIN)).otherwise(F.lit(NO_RAIN))


def start_stamped(windowed: DataFrame) -> DataFrame:
    """Replace the ``window`` struct with its start, ``window_start``."""
    rest = [c for c in windowed.columns if c != "window"]
    return windowed.select(F.col("window.start").alias("window_start"), *rest)


def energy_weather_wide(
    energy: DataFrame, weather: DataFrame, width: str = BUCKET, null_on_zero: bool = False
) -> DataFrame:
    """Consumption per degree and production by rain label, per bucket and place.

    Both inputs of the join have one row per (window, place), so nothing is left
    to aggregate after it, and no place can skew it. The join reuses the
    partitioning of the two aggregates.
    """
    joined = energy_window(energy, width).join(weather_window(weather, width), ["window", "place"])
    return combine_windows(joined, F.col("window.start"), null_on_zero)


def combine_windows(joined: DataFrame, start: Column, null_on_zero: bool = False, keep: tuple[str, ...] = ()) -> DataFrame:
    """The columns of the wide result from joined summaries of energy and weather, and those of ``keep``."""
    rain = F.col("raining_prob") == RAIN
    return joined.select(
        *keep,
        start.alias("hour_group"),
        "place",
        ieee_div(F.col("kwh_cons"), F.col("temp"), null_on_zero).alias("kwh_cons_degree"),
        F.when(rain, F.col("kwh_prod")).otherwise(F.lit(0.0)).alias("kwh_prod_with_rain_prob"),
        F.when(~rain, F.col("kwh_prod")).otherwise(F.lit(0.0)).alias("kwh_prod_with_no_rain_prob"),
        "temp",
        "dew_point",
        "uvi",
        "clouds",
    )


def energy_weather_analytics(
    energy: DataFrame, weather: DataFrame, width: str = BUCKET, null_on_zero: bool = False
) -> DataFrame:
    """The wide result cut to the columns of its serving table."""
    wide = energy_weather_wide(energy, weather, width, null_on_zero)
    return wide.select(*ENERGY_WEATHER_ANALYTICS.names)
