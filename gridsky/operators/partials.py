"""Sums and counts by bucket and place that can be added up later.

The analytics are sums and averages, so what a load adds to a bucket is one row. Rows of any number
of loads are merged when read; a load that runs again replaces its own rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridsky.functions.numeric import guarded_ratio
from gridsky.functions.timing import BUCKET
from gridsky.operators.buckets import combine_windows, energy_window, rain_label, start_stamped
from gridsky.schemas import ENERGY_WEATHER_ANALYTICS

CONDITIONS = ("temp", "dew_point", "uvi", "clouds")


def energy_partials(energy: DataFrame, width: str = BUCKET) -> DataFrame:
    """Production and consumption by bucket start and place."""
    return start_stamped(energy_window(energy, width))


def weather_partials(weather: DataFrame, width: str = BUCKET) -> DataFrame:
    """Sum and count of each condition by bucket start and place."""
    sums = weather.groupBy(F.window("ts", width).alias("window"), "place").agg(
        *[f(c).alias(f"{c}_{name}") for c in CONDITIONS for name, f in (("sum", F.sum), ("count", F.count))]
    )
    return start_stamped(sums)


def _added(parts: DataFrame, *more: str) -> DataFrame:
    """One row per bucket and ``more``. ``day`` stays a key, so filters on it reach the folders."""
    keys = [*(["day"] if "day" in parts.columns else []), "window_start", *more]
    rest = [c for c in parts.columns if c not in (*keys, "place")]
    return parts.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in rest])


def merge_partials(parts: DataFrame) -> DataFrame:
    """Partials of several loads as those of one: same columns, a row per bucket and place."""
    return _added(parts, "place").select(*parts.columns)


def merged_energy_analytics(parts: DataFrame) -> DataFrame:
    """``energy_analytics`` from partials, with their ``day`` if they have one."""
    totals = _added(parts)
    return totals.select(
        F.col("window_start").alias("hour_group"),
        "kwh_prod",
        "kwh_cons",
        guarded_ratio(F.col("kwh_prod"), F.col("kwh_cons")).alias("ratio"),
        *(["day"] if "day" in totals.columns else []),
    )


def merged_energy_weather(energy: DataFrame, weather: DataFrame) -> DataFrame:
    """``energy_weather_analytics`` from partials of both sides, with their ``day`` if they have one."""
    day = ["day"] if "day" in energy.columns else []
    means = _added(weather, "place").select(
        *day,
        "window_start",
        "place",
        *[F.try_divide(F.col(f"{c}_sum"), F.col(f"{c}_count")).alias(c) for c in CONDITIONS],
    )
    joined = _added(energy, "place").join(
        means.withColumn("raining_prob", rain_label()), [*day, "window_start", "place"]
    )
    wide = combine_windows(joined, F.col("window_start"), keep=tuple(day))
    return wide.select(*ENERGY_WEATHER_ANALYTICS.names, *day)
