"""Event time, tumbling buckets and calendar parts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Bucket width of the analytics, allowed out-of-orderness.
BUCKET = "10 minutes"
WATERMARK = "1 second"

# Largest epoch-millisecond value whose microseconds still fit a long.
_MAX_MILLIS = (2**63 - 1) // 1000


def event_time(millis: Column) -> Column:
    """Epoch milliseconds to an instant; values out of range give NULL, not an error."""
    in_range = millis.between(F.lit(-_MAX_MILLIS), F.lit(_MAX_MILLIS))
    return F.when(in_range, F.timestamp_millis(millis))


def bucket(ts: str | Column, width: str = BUCKET) -> Column:
    """Epoch-aligned tumbling window as a ``struct<start, end>`` named ``window``."""
    return F.window(ts, width).alias("window")


def calendar_day(ts: str) -> Column:
    return F.date_trunc("day", F.col(ts))
