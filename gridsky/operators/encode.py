"""JSON envelopes: records to the ``value`` column of a message stream."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def now_millis() -> Column:
    return F.unix_millis(F.current_timestamp())


def _envelope(
    rows: DataFrame, key: Column | None, payload: list[Column], carry: tuple[str, ...]
) -> DataFrame:
    # Absent values are written as null, not left out.
    value = F.to_json(F.struct(*payload), {"ignoreNullFields": "false"}).alias("value")
    named = [] if key is None else [key.cast("string").alias("key")]
    return rows.select(*named, value, *carry)


def encode_energy(
    readings: DataFrame,
    time_millis: Column | None = None,
    key: Column | None = None,
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """Series readings (``ID``, ``_value`` and the site tags) to energy messages.

    The event time of a message is the time it is sent, unless given. ``carry``
    names columns to keep beside the message.
    """
    return _envelope(
        readings,
        key,
        [
            (now_millis() if time_millis is None else time_millis).alias("time_stamp"),
            F.col("ID").alias("id"),
            F.col("_value").alias("value"),
            F.col("place"),
            F.col("generation"),
            F.col("type_gen"),
        ],
        carry,
    )


def encode_weather(
    conditions: DataFrame,
    time_millis: Column | None = None,
    key: Column | None = None,
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """Flattened weather conditions to weather messages."""
    return _envelope(
        conditions,
        key,
        [
            (now_millis() if time_millis is None else time_millis).alias("time_stamp"),
            *[F.col(c) for c in ("lat", "lon", "place", "temp", "dew_point", "uvi", "clouds")],
        ],
        carry,
    )
