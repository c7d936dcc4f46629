"""Weather service responses to flat rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridsky.schemas import WEATHER_BODY


def flatten_weather(documents: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    """Successful responses as (lat, lon, place, temp, dew_point, uvi, clouds).

    ``documents`` has place, status and the JSON ``body``. The body is parsed
    once, in a generator, for the same reason as in :mod:`gridsky.operators.decode`.
    """
    return (
        documents.filter(F.col("status") == 200)
        .select("place", *carry, F.inline(F.array(F.from_json("body", WEATHER_BODY))))
        .select(
            "lat",
            "lon",
            "place",
            "current.temp",
            "current.dew_point",
            "current.uvi",
            "current.clouds",
            *carry,
        )
    )
