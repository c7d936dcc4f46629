"""Last write per key, and last value per series."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest_by_key(rows: DataFrame, keys: tuple[str, ...], order: tuple[str, ...]) -> DataFrame:
    """The row with the greatest ``order`` for each key.

    An aggregate, so every task passes on one row per key and a key that holds
    most of the rows costs no more than any other; it needs no ordering within
    the key, as ``row_number`` would. ``order`` should be unique within a key.
    """
    rest = [c for c in rows.columns if c not in keys]
    newest = rows.groupBy(*keys).agg(
        F.max_by(F.struct(*rest), F.struct(*order)).alias("_newest")
    )
    return newest.select(
        *[F.col(c) if c in keys else F.col(f"_newest.{c}") for c in rows.columns]
    )


def last_not_null(
    rows: DataFrame, time: str, values: tuple[str, ...], keys: tuple[str, ...] = ()
) -> DataFrame:
    """For each value column, its newest non-NULL value: one row per key, or one in all."""
    newest = [
        F.max_by(F.col(v), F.when(F.col(v).isNotNull(), F.col(time))).alias(v) for v in values
    ]
    return rows.groupBy(*keys).agg(*newest) if keys else rows.agg(*newest)
