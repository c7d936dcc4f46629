"""The newest row per key of a stream, kept as one value per key.

State is a value per key with a time to live, whatever the length of the stream. Rows are combined in
each task before the shuffle, so a key that has most of the rows sends one row per Arrow batch. A key's newest
row is told whenever it changes, so the last one told is the newest.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import DataType, NumericType, StringType, TimestampType

JSON = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "ignoreNullFields": "false"}


def _sortable(name: str, kind: DataType) -> Column:
    """Text that sorts as the values do, nulls first."""
    if isinstance(kind, StringType):
        text = F.concat(F.col(name), F.lit("\0"))
    elif isinstance(kind, TimestampType) or (isinstance(kind, NumericType) and kind.typeName() in ("byte", "short", "integer", "long")):
        number = F.unix_micros(name) if isinstance(kind, TimestampType) else F.col(name)
        lifted = number.cast("decimal(20,0)") + F.lit(str(1 << 63)).cast("decimal(20,0)")
        text = F.lpad(lifted.cast("string"), 20, "0")
    else:
        raise TypeError(f"{name}: rows cannot be ordered by {kind.simpleString()}")
    return F.coalesce(F.concat(F.lit("1"), text), F.lit("0"))


class _Newest(StatefulProcessor):
    """One value per key: how the newest row sorts, and the row."""

    def __init__(self, ttl_ms: int | None, keys: list[str]):
        self.ttl_ms, self.keys = ttl_ms, keys

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.newest = handle.getValueState("newest", "place string, packed string", self.ttl_ms)

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        best = None
        for batch in rows:
            # Columns come by position: key, place, row.
            for found in zip(batch.iloc[:, 1], batch.iloc[:, 2]):
                best = found if best is None else max(best, found)
        known = self.newest.get() if self.newest.exists() else None
        if known is None or best > (known[0], known[1]):
            self.newest.update(best)
            yield pd.DataFrame([(*key, *best)], columns=[*self.keys, "_place", "_packed"])

    def close(self) -> None:
        pass


def stream_latest(
    rows: DataFrame, keys: tuple[str, ...], order: tuple[str, ...], ttl_ms: int | None = None
) -> DataFrame:
    """The row with the greatest ``order`` per key, each time that it changes; for update mode.

    Equal ``order`` goes by the rest of the row, so the result does not depend on how the stream is cut. Keys may be null.
    A key that has had no row for ``ttl_ms`` is forgotten, and an older row may then be told again.
    """
    kinds = {f.name: f.dataType for f in rows.schema}
    packed = rows.select(
        F.to_json(F.struct(*keys), JSON).alias("_key"),
        F.concat(*[_sortable(c, kinds[c]) for c in order]).alias("_place"),
        F.to_json(F.struct(*rows.columns), JSON).alias("_packed"),
    )

    def combine(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            best: dict[str, tuple] = {}
            for key, *found in zip(batch["_key"], batch["_place"], batch["_packed"]):
                best[key] = max(best.get(key, ("", "")), tuple(found))
            yield pd.DataFrame([(k, *v) for k, v in best.items()], columns=batch.columns)

    schema = "_key string, _place string, _packed string"
    newest = (
        packed.mapInPandas(combine, schema)
        .groupBy("_key")
        .transformWithStateInPandas(_Newest(ttl_ms, ["_key"]), schema, "Update", "None" if ttl_ms is None else "ProcessingTime")
    )
    told = F.from_json("_packed", rows.schema, JSON)
    return newest.select("_key", "_place", told.alias("r")).select("_key", "_place", "r.*")


def unpivoted(rows: DataFrame, time: str, values: tuple[str, ...], keys: tuple[str, ...] = ()) -> DataFrame:
    """(keys, column, time, value) of every value that is not null, as doubles: the last not null value
    of each column is then the newest row of (keys, column)."""
    pairs = F.array(*[F.struct(F.lit(v).alias("column"), F.col(v).cast("double").alias("value")) for v in values])
    told = rows.select(*keys, F.col(time), F.explode(pairs).alias("p")).select(*keys, "p.column", time, "p.value")
    return told.filter(F.col("value").isNotNull())


class LatestSink:
    """Keeps what ``stream_latest`` tells under ``path``; a batch written again replaces itself."""

    def __init__(self, path: str):
        self.path = path

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        batch.withColumn("batch", F.lit(batch_id).cast("bigint")).write.mode("overwrite").option(
            "partitionOverwriteMode", "dynamic"
        ).partitionBy("batch").parquet(self.path)


def read_latest(told: DataFrame) -> DataFrame:
    """One row per key from what a ``LatestSink`` has kept: the last that was told."""
    rest = [c for c in told.columns if c not in ("_key", "_place", "batch")]
    last = told.groupBy("_key").agg(F.max_by(F.struct(*rest), F.struct("_place", "batch")).alias("r"))
    return last.select("r.*")
