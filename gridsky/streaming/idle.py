"""Heartbeats for a source that has gone silent.

The watermark of a join waits for its slower side. While nothing lands of one side, a heartbeat
stands in for it: a row without data whose time is now - ``timeout``. It is merged
before the watermark is taken and filtered out after it. While the source delivers there are no heartbeats, so
a backlog with old event times is never overtaken.
"""

from __future__ import annotations

import time
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.types import BooleanType, NumericType, StringType

NAME = "gridsky_heartbeat"
#: The log that a streaming file sink keeps in its folder: a file for each batch that it has written.
SINK_LOG = "_spark_metadata"


@dataclass
class Beat(InputPartition):
    millis: int


def newest_change(folder: str) -> int:
    """Epoch milliseconds of the last batch landed in a folder, or of its newest file; 0 if there is nothing."""
    from pyarrow import fs

    if "://" in folder or folder.startswith("file:"):
        system, path = fs.FileSystem.from_uri(folder)
    else:
        system, path = fs.LocalFileSystem(), folder
    for place in (f"{path}/{SINK_LOG}", path):
        found = system.get_file_info(fs.FileSelector(place, allow_not_found=True))
        times = [f.mtime for f in found if f.type == fs.FileType.File and not f.base_name.startswith((".", "_"))]
        if times:
            return int(max(times).timestamp() * 1000)
    return 0


class HeartbeatReader(DataSourceStreamReader):
    """An offset is the time of the last beat. Reading a range again gives the same beat."""

    def __init__(self, options: dict[str, str]):
        self.folder = options["path"]
        self.timeout = int(options["timeoutms"])
        self.every = int(options.get("everyms", "1000"))
        self.started, self.beat, self.looked = self._now(), 0, 0

    @staticmethod
    def _now() -> int:
        return time.time_ns() // 1_000_000

    def initialOffset(self) -> dict:
        return {"beat": 0}

    def latestOffset(self) -> dict:
        now = self._now()
        # Spark asks every few milliseconds.
        if now - self.looked >= min(self.every, self.timeout) / 4:
            self.looked = now
            if now - self.beat >= self.every and now - max(self.started, newest_change(self.folder)) >= self.timeout:
                self.beat = now
        return {"beat": self.beat}

    def partitions(self, start: dict, end: dict) -> Sequence[InputPartition]:
        return [Beat(end["beat"] - self.timeout)] if end["beat"] > start["beat"] else []

    def read(self, partition: Beat) -> Iterator[tuple]:
        yield (datetime.fromtimestamp(partition.millis / 1000, timezone.utc),)


class HeartbeatSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        return "ts timestamp"

    def streamReader(self, schema) -> DataSourceStreamReader:
        return HeartbeatReader({k.lower(): v for k, v in self.options.items()})


def heartbeats(spark: SparkSession, folder: str, timeout_ms: int, every_ms: int = 1000) -> DataFrame:
    """A stream of ``ts`` = now - ``timeout_ms``, at most one each ``every_ms``, while nothing has landed in ``folder`` for ``timeout_ms``."""
    # A source registered anew shares nothing with those that other queries run.
    spark.dataSource.register(HeartbeatSource)
    options = {"path": folder, "timeoutMs": str(timeout_ms), "everyMs": str(every_ms)}
    return spark.readStream.format(NAME).options(**options).load()


def with_heartbeats(records: DataFrame, beats: DataFrame | None, watermark: str) -> DataFrame:
    """``records`` with a watermark that heartbeats move on as well; none of them is left in the result."""
    if beats is None:
        return records.withWatermark("ts", watermark)
    # Filters on other columns, as a join brings them along, are pushed below the watermark: beats must
    # pass them, so no simple column of theirs is null.
    filled = {
        f.name: F.lit("" if isinstance(f.dataType, StringType) else 0).cast(f.dataType)
        for f in records.schema
        if f.name != "ts" and isinstance(f.dataType, (StringType, NumericType, BooleanType))
    }
    both = records.withColumn("beat", F.lit(False)).unionByName(
        beats.withColumns({**filled, "beat": F.lit(True)}), allowMissingColumns=True
    )
    # A filter that needs the event time is not pushed below the watermark. Beats are of this century.
    earlier = F.col("ts") < F.lit("1970-01-02").cast("timestamp")
    return both.withWatermark("ts", watermark).filter(~F.col("beat") | earlier).drop("beat")
