"""The four tables of the job, from decoded records.

The same frames run as one batch or as streams: a watermark is ignored on batch
input.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from gridsky.functions.timing import WATERMARK
from gridsky.operators.buckets import energy_analytics, energy_weather_analytics
from gridsky.operators.records import point_data, weather_data
from gridsky.streaming.idle import with_heartbeats


def once(timed: DataFrame, unique: str | None) -> DataFrame:
    """Each message once. On a stream its id is forgotten when the watermark has passed it."""
    if unique is None:
        return timed
    return timed.dropDuplicatesWithinWatermark([unique]) if timed.isStreaming else timed.dropDuplicates([unique])


def job_tables(
    energy: DataFrame,
    weather: DataFrame,
    carry: tuple[str, ...] = (),
    watermark: str = WATERMARK,
    beats: dict[str, Callable[[], DataFrame]] | None = None,
    unique: str | None = None,
) -> dict[str, DataFrame]:
    """Point tables keep late rows, so they read the records without a watermark.

    ``beats`` makes streams of heartbeats for ``energy`` and ``weather``, a new one for each query
    that reads it. ``unique`` names a
    column by which a message delivered again within the watermark is known; it then
    counts once in the buckets. The point tables need no such column: their keys see to it.
    """
    def timed(name: str, records: DataFrame) -> DataFrame:
        beat = (beats or {}).get(name)
        return once(with_heartbeats(records, beat and beat(), watermark), unique)

    return {
        "point_data": point_data(energy, carry),
        "weather_data": weather_data(weather, carry),
        "energy_analytics": energy_analytics(timed("energy", energy)),
        "energy_weather_analytics": energy_weather_analytics(timed("energy", energy), timed("weather", weather)),
    }
