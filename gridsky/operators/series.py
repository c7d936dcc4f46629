"""Time-series helpers: range, windowed mean, last per group, site feeds."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridsky.operators.keyed import latest_by_key
from gridsky.schemas import SERIES_KEY


def _instant(at: datetime) -> Column:
    """A UTC wall-clock time as a literal, whatever the zone of session or machine."""
    micros = (at - datetime(1970, 1, 1)) // timedelta(microseconds=1)
    return F.timestamp_micros(F.lit(micros))


def series_range(
    series: DataFrame,
    now: datetime,
    lookback: timedelta,
    bucket: str | None = None,
    field: str | None = None,
    measurement: str | None = None,
    sensor: str | None = None,
) -> DataFrame:
    """Readings with ``now - lookback <= _time < now`` and the given tags.

    ``now`` is an argument, in UTC, so that a run can be repeated. The bounds are
    added as ``_start`` and ``_stop``. A ``day`` partition column is filtered too.
    """
    start, stop = _instant(now - lookback), _instant(now)
    wanted = {"bucket": bucket, "_field": field, "_measurement": measurement, "ID": sensor}
    for name, value in wanted.items():
        if value is not None:
            series = series.filter(F.col(name) == value)
    if "day" in series.columns:
        first, last = (now - lookback).date(), now.date()
        series = series.filter(F.col("day").between(F.lit(first), F.lit(last))).drop("day")
    return series.filter((F.col("_time") >= start) & (F.col("_time") < stop)).withColumns(
        {"_start": start, "_stop": stop}
    )


def series_window_mean(ranged: DataFrame, every: str, keys: tuple[str, ...] = SERIES_KEY) -> DataFrame:
    """Mean per series and epoch-aligned window, stamped with the window's end.

    Windows are cut to the range, so the last one ends at ``_stop``. Empty
    windows do not appear.
    """
    means = ranged.groupBy(*keys, "_start", "_stop", F.window("_time", every).alias("window")).agg(
        F.avg("_value").alias("_value")
    )
    return means.select(
        *keys,
        "_start",
        "_stop",
        F.least(F.col("window.end"), F.col("_stop")).alias("_time"),
        "_value",
    )


def series_last(
    series: DataFrame,
    group: tuple[str, ...] = SERIES_KEY,
    order: tuple[str, ...] = ("_time", "ID"),
) -> DataFrame:
    """The newest reading with a value in each group; equal times go by ID."""
    return latest_by_key(series.filter(F.col("_value").isNotNull()), group, order)


@dataclass(frozen=True)
class Site:
    """How one site's feed is read from the series store and labelled."""

    bucket: str
    field: str
    lookback: timedelta
    every: str
    last_by: tuple[str, ...]
    drop: tuple[str, ...]
    place: str
    generation: bool
    type_gen: str
    measurement: str | None = None
    sensor: str | None = None


# Field, range, window and labels of the three site feeds.
SITES = (
    Site(
        bucket="site_hydro",
        field="kW_tot",
        lookback=timedelta(minutes=30),
        every="31 minutes",
        last_by=("_measurement",),
        drop=("_start", "_stop", "_field"),
        place="hydro",
        generation=True,
        type_gen="hydro",
    ),
    Site(
        bucket="site_solar",
        field="kW_tot",
        lookback=timedelta(days=20),
        every="1 second",
        last_by=("_measurement",),
        drop=("_time",),
        place="solar",
        generation=True,
        type_gen="solar",
        measurement="MET01",
        sensor="MET01",
    ),
    Site(
        bucket="site_mall",
        field="kw_tot",
        lookback=timedelta(days=1),
        every="5 minutes",
        last_by=SERIES_KEY,
        drop=("_start", "_stop", "_field"),
        place="mall",
        generation=False,
        type_gen="-",
    ),
)


def tag_site(readings: DataFrame, place: str, generation: bool, type_gen: str) -> DataFrame:
    return readings.withColumns(
        {"place": F.lit(place), "generation": F.lit(generation), "type_gen": F.lit(type_gen)}
    )


def site_readings(series: DataFrame, site: Site, now: datetime) -> DataFrame:
    """Range, windowed mean, last per group, drop, tag: one site's current readings."""
    ranged = series_range(
        series, now, site.lookback, site.bucket, site.field, site.measurement, site.sensor
    )
    newest = series_last(series_window_mean(ranged, site.every), site.last_by)
    return tag_site(newest.drop(*site.drop), site.place, site.generation, site.type_gen)


def energy_feed(series: DataFrame, now: datetime, sites: tuple[Site, ...] = SITES) -> DataFrame:
    """The current readings of every site in one frame, ready for ``encode_energy``."""
    columns = ("ID", "_value", "place", "generation", "type_gen")
    return reduce(
        DataFrame.unionByName,
        [site_readings(series, site, now).select(*columns) for site in sites],
    )
