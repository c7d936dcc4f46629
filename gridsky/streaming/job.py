"""Start and run the job as streams, one query per table. Its batch form is ``run_batch``."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from functools import partial, reduce
from operator import or_

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery
from pyspark.sql.streaming.readwriter import DataStreamWriter

from gridsky.operators.decode import (
    MALFORMED,
    NO_EVENT_TIME,
    Decoded,
    decode_energy,
    decode_weather,
    split_marked,
)
from gridsky.plans.job import job_tables
from gridsky.schemas import KEYS
from gridsky.sources.tables import ONE_ROW_PER_KEY
from gridsky.streaming.batch import run_batch
from gridsky.streaming.idle import heartbeats
from gridsky.streaming.sinks import BatchSink

__all__ = [
    "await_all",
    "count_rejects",
    "quarantine_rejects",
    "run_batch",
    "set_watermark_policy",
    "start_job",
    "start_tables",
]

Sink = Callable[[str], BatchSink]


def start_tables(
    tables: dict[str, DataFrame],
    sink: Sink,
    checkpoints: str,
    available_now: bool = False,
    interval: str | None = None,
) -> dict[str, StreamingQuery]:
    """Start one query per table, each with its own checkpoint under ``checkpoints``.

    ``available_now`` reads what is there and stops; ``interval`` paces the
    micro-batches; with neither, one follows the other.
    """
    started = {}
    for name, rows in tables.items():
        if name not in ONE_ROW_PER_KEY:
            missing = reduce(or_, [F.col(key).isNull() for key in KEYS[name]])
            rows = rows.observe("keyless", F.count_if(missing).alias("keyless"))
        writer = (
            rows.writeStream.queryName(name)
            .outputMode("append")
            .option("checkpointLocation", f"{checkpoints}/{name}")
            .foreachBatch(sink(name))
        )
        started[name] = _paced(writer, available_now, interval).start()
    return started


def _paced(
    writer: DataStreamWriter, available_now: bool, interval: str | None
) -> DataStreamWriter:
    if available_now:
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=interval) if interval else writer


def start_job(
    energy_messages: DataFrame,
    weather_messages: DataFrame,
    sink: Sink,
    checkpoints: str,
    rejects: str | None = None,
    records: str | None = None,
    available_now: bool = False,
    interval: str | None = None,
    retention: str | None = None,
    idle_timeout_ms: int | None = None,
    unique: str | None = None,
) -> dict[str, StreamingQuery]:
    """The whole job: decode both message streams and start a query per table.

    Messages come with their ``arrival`` from :mod:`gridsky.sources.messages`.
    Queries share nothing, so two of them parse each message once and land it, as
    typed columns or as text with the reason of its rejection, under ``records``
    (by default beside the checkpoints). The tables read their columns from
    there, one trigger later. The landing queries count what they reject, by
    reason, under the observation ``rejected``. With ``rejects`` set, the rejected messages
    are also kept by themselves under that path.

    With ``idle_timeout_ms``, a side of which nothing has landed for so long no longer holds back the
    join: its watermark follows the clock at that distance until it delivers again. ``unique`` names a column
    of the messages (``envelope``) by which a message sent twice counts once in the buckets.

    ``retention`` ("30 days") lets the landing's log forget files that old, for readers that
    start later too; without it the log keeps every file.
    """
    carry = ("arrival", unique) if unique else ("arrival",)
    records = records or f"{checkpoints}/records"
    inputs = {
        "energy": decode_energy(energy_messages, carry).marked,
        "weather": decode_weather(weather_messages, carry).marked,
    }
    started = {
        f"{name}_records": _to_parquet(
            count_rejects(marked),
            f"{records}/{name}_records",
            f"{checkpoints}/{name}_records",
            f"{name}_records",
            available_now,
            interval,
            retention,
        )
        for name, marked in inputs.items()
    }
    if available_now:
        await_all(started.values())
    landed = {
        name: split_marked(_landed(marked, f"{records}/{name}_records"))
        for name, marked in inputs.items()
    }
    if rejects:
        for name, decoded in landed.items():
            started[f"{name}_rejects"] = quarantine_rejects(
                decoded,
                f"{rejects}/{name}_rejects",
                f"{checkpoints}/{name}_rejects",
                f"{name}_rejects",
                available_now,
                interval,
            )
    beats = {}
    if idle_timeout_ms is not None:
        session = energy_messages.sparkSession
        beats = {
            name: partial(heartbeats, session, f"{records}/{name}_records", idle_timeout_ms) for name in landed
        }
    tables = job_tables(
        landed["energy"].records, landed["weather"].records, ("arrival",), beats=beats, unique=unique
    )
    started.update(start_tables(tables, sink, checkpoints, available_now, interval))
    return started


def _to_parquet(
    rows: DataFrame,
    path: str,
    checkpoint: str,
    name: str,
    available_now: bool,
    interval: str | None,
    retention: str | None = None,
) -> StreamingQuery:
    writer = (
        rows.writeStream.queryName(name)
        .outputMode("append")
        .format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
    )
    if retention:
        writer = writer.option("retention", retention)
    return _paced(writer, available_now, interval).start()


def _landed(rows: DataFrame, path: str) -> DataFrame:
    """Stream what ``_to_parquet`` writes; its log makes each of its batches appear whole.

    The folder and its log exist once that query has been started.
    """
    return rows.sparkSession.readStream.schema(rows.schema).parquet(path)


def count_rejects(rows: DataFrame) -> DataFrame:
    """Count rows by reason, under the observation ``rejected``."""
    return rows.observe(
        "rejected",
        F.count_if(F.col("reason") == MALFORMED).alias("malformed"),
        F.count_if(F.col("reason") == NO_EVENT_TIME).alias("no_event_time"),
    )


def quarantine_rejects(
    decoded: Decoded,
    path: str,
    checkpoint: str,
    name: str,
    available_now: bool = False,
    interval: str | None = None,
) -> StreamingQuery:
    """Keep the messages that gave no record, and count them by reason.

    The counts are in the query's progress, under the observation ``rejected``.
    """
    return _to_parquet(
        count_rejects(decoded.rejected).select("message", "reason"),
        path,
        checkpoint,
        name,
        available_now,
        interval,
    )


def await_all(queries: Iterable[StreamingQuery], poll: float = 0.5) -> None:
    """Wait until every query has ended. At the first failure the others are stopped and it is raised."""
    running = list(queries)
    while running:
        for query in list(running):
            try:
                if query.awaitTermination(poll / len(running)):
                    running.remove(query)
            except StreamingQueryException:
                for other in running:
                    if other is not query:
                        other.stop()
                raise


def set_watermark_policy(spark: SparkSession, policy: str) -> None:
    """``min`` waits for the slower source; ``max`` follows the faster one.

    With ``min`` an idle source holds back the join and its state. With ``max``
    it does not, but its rows are late when it resumes.
    """
    if policy not in ("min", "max"):
        raise ValueError(f"policy must be 'min' or 'max', not {policy!r}")
    spark.conf.set("spark.sql.streaming.multipleWatermarkPolicy", policy)
