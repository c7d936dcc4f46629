"""What streams drop, as a table: late, rejected and keyless rows of every micro-batch."""

from __future__ import annotations

import json
import threading
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming.listener import StreamingQueryListener

from gridsky.sources import files

SCHEMA = (
    "query string, run string, batch long, at timestamp, input_rows long, "
    "late long, malformed long, no_event_time long, keyless long"
)


class DropMetrics(StreamingQueryListener):
    """Lands a row per micro-batch that read or dropped anything, under ``path``.

    ``late`` counts what the stateful operators of a query dropped behind the watermark. Before an
    aggregation, late rows of one task and group are one; before a
    ``dropDuplicatesWithinWatermark`` each row counts. Rows are written ``every`` so many
    micro-batches, and when a query ends; a batch that is reported twice (run again) is told once.
    """

    def __init__(self, spark: SparkSession, path: str, every: int = 100):
        self.spark, self.path, self.every = spark, path, every
        self.rows: list[dict] = []
        self.lock = threading.Lock()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        self.flush()

    def onQueryProgress(self, event) -> None:
        p = event.progress
        observed = p.observedMetrics
        rejected, keyless = observed.get("rejected"), observed.get("keyless")
        row = {
            "query": p.name,
            "run": str(p.id),
            "batch": p.batchId,
            "at": p.timestamp,
            "input_rows": p.numInputRows,
            "late": sum(s.numRowsDroppedByWatermark for s in p.stateOperators),
            "malformed": rejected.malformed if rejected else 0,
            "no_event_time": rejected.no_event_time if rejected else 0,
            "keyless": keyless.keyless if keyless else 0,
        }
        if any(row[c] for c in ("input_rows", "late", "malformed", "no_event_time", "keyless")):
            with self.lock:
                self.rows.append(row)
            if len(self.rows) >= self.every:
                self.flush()

    def onQueryTerminated(self, event) -> None:
        self.flush()

    def flush(self) -> None:
        with self.lock:
            rows, self.rows = self.rows, []
        if rows:
            text = "\n".join(json.dumps(r) for r in rows)
            files.create_text(self.spark, f"{self.path}/drops-{uuid.uuid4().hex}.json", text)


def watch_drops(spark: SparkSession, path: str, every: int = 100) -> DropMetrics:
    """Start to land the counts; ``spark.streams.removeListener`` of what is returned ends it."""
    listener = DropMetrics(spark, path, every)
    spark.streams.addListener(listener)
    return listener


def read_drops(spark: SparkSession, path: str) -> DataFrame:
    """The landed counts, one row per query and micro-batch."""
    return spark.read.schema(SCHEMA).json(path).dropDuplicates(["query", "run", "batch"])
