"""Newest rows of a stream, and polled documents, across restarts."""

from __future__ import annotations

import glob
import json
import random
import time
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from gridsky.operators.keyed import last_not_null, latest_by_key
from gridsky.operators.weather_docs import flatten_weather
from gridsky.sources.documents import Ask, AnswerLog, DocumentReader, poll_documents
from gridsky.streaming.latest import LatestSink, read_latest, stream_latest, unpivoted
from tests.test_streaming import session  # noqa: F401

SCHEMA = "series string, at timestamp, id string, value double"


def readings(seed, count=200):
    rng = random.Random(seed)
    start = datetime(2024, 1, 1)
    return [
        (rng.choice(["a", "b", "c", None]), start + timedelta(microseconds=rng.randrange(50)), rng.choice("xyz"), rng.choice([None, rng.random()]))
        for _ in range(count)
    ]


def follow(session, spark, folder, build, out, checkpoint):  # noqa: F811
    """Take in what has landed, in files of one micro-batch each, and end."""
    stream = session.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(folder)
    query = (
        build(stream).writeStream.outputMode("update").option("checkpointLocation", checkpoint).trigger(availableNow=True)
        .foreachBatch(LatestSink(out)).start()
    )
    query.awaitTermination()
    return query


@pytest.mark.parametrize("cuts", [1, 5])
def test_newest_row_of_a_stream_equals_the_batch(spark, session, tmp_path, cuts):  # noqa: F811
    rows = readings(cuts)
    folder, out, cp = (str(tmp_path / n) for n in ("in", "out", "cp"))
    keys, order = ("series",), ("at", "id")
    batch = latest_by_key(spark.createDataFrame(rows, SCHEMA).filter("value IS NOT NULL"), keys, (*order, "value"))
    for k in range(cuts):
        spark.createDataFrame(rows[k::cuts], SCHEMA).coalesce(1).write.mode("append").parquet(folder)
        # Each time the query is started anew from its checkpoint.
        query = follow(session, spark, folder, lambda s: stream_latest(s.filter("value IS NOT NULL"), keys, order), out, cp)
    got = read_latest(spark.read.parquet(out))
    assert got.columns == batch.columns
    assert sorted(map(repr, got.collect())) == sorted(map(repr, batch.collect()))
    [state] = query.lastProgress["stateOperators"]
    assert state["numRowsTotal"] == 4


def test_last_value_of_each_column_of_a_stream(spark, session, tmp_path):  # noqa: F811
    rows = [("a", datetime(2024, 1, d), "x", v) for d, v in ((1, 1.0), (2, None), (3, None))] + [("b", datetime(2024, 1, 1), "x", None)]
    folder, out, cp = (str(tmp_path / n) for n in ("in", "out", "cp"))
    spark.createDataFrame(rows, SCHEMA).repartition(2).write.parquet(folder)
    follow(
        session, spark, folder,
        lambda s: stream_latest(unpivoted(s.withColumn("double", F.col("value") * 2), "at", ("value", "double"), ("series",)), ("series", "column"), ("at",)),
        out, cp,
    )
    got = {(r.series, r.column): r.value for r in read_latest(spark.read.parquet(out)).collect()}
    want = last_not_null(spark.createDataFrame(rows, SCHEMA).withColumn("double", F.col("value") * 2), "at", ("value", "double"), ("series",))
    flat = {(r.series, c): r[c] for r in want.collect() for c in ("value", "double") if r[c] is not None}
    assert got == flat == {("a", "value"): 1.0, ("a", "double"): 2.0}


def test_keys_are_forgotten_after_their_time(spark, session, tmp_path):  # noqa: F811
    folder, out, cp = (str(tmp_path / n) for n in ("in", "out", "cp"))

    def add(key):
        spark.createDataFrame([(key, datetime(2024, 1, 1), "x", 1.0)], SCHEMA).write.mode("append").parquet(folder)

    add("a")
    stream = stream_latest(session.readStream.schema(SCHEMA).parquet(folder), ("series",), ("at",), ttl_ms=500)
    query = stream.writeStream.outputMode("update").option("checkpointLocation", cp).foreachBatch(LatestSink(out)).start()
    try:
        def told():
            query.awaitTermination(0.3)
            landed = glob.glob(f"{out}/batch=*/*.parquet")
            return spark.read.parquet(out).count() if landed else 0

        end = time.monotonic() + 60
        while time.monotonic() < end and told() != 1:
            pass
        time.sleep(1)
        # The key has outlived its time: its row, come again, is news.
        add("a")
        while time.monotonic() < end and told() != 2:
            pass
        assert told() == 2 and read_latest(spark.read.parquet(out)).count() == 1
    finally:
        query.stop()


def test_rows_cannot_be_ordered_by_anything(spark):
    with pytest.raises(TypeError, match="cannot be ordered"):
        stream_latest(spark.createDataFrame([], SCHEMA), ("series",), ("value",))


def test_a_restart_repeats_and_loses_no_document(spark, session, tmp_path):  # noqa: F811
    log, out, cp = (str(tmp_path / n) for n in ("log", "out", "cp"))

    def poll(place):
        import uuid

        # A service that never answers twice alike, and is down for one place.
        body = {"lat": 1.0, "lon": 2.0, "current": {"temp": float(uuid.uuid4().int % 1000), "dew_point": 1.0, "uvi": 0.0, "clouds": 0.0}}
        return (500, "down") if place == "solar" else (200, json.dumps(body))

    def run(batches):
        stream = poll_documents(session, poll, ["mall", "hydro", "solar"], log, every_ms=100)
        query = stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", cp).trigger(processingTime="100 milliseconds").start()
        try:
            for _ in range(300):
                query.awaitTermination(0.2)
                if query.lastProgress and query.lastProgress["batchId"] >= batches:
                    break
        finally:
            query.stop()

    run(3)
    run(6)
    rows = spark.read.parquet(out).collect()
    polls = sorted({r.poll for r in rows})
    assert polls == list(range(1, max(polls) + 1)) and len(polls) >= 6
    assert len(rows) == 3 * len(polls) == len({(r.place, r.poll) for r in rows})
    assert flatten_weather(spark.read.parquet(out)).count() == 2 * len(polls)


def test_a_range_read_again_gives_the_same_answers(tmp_path):
    asked = []

    def poll(place):
        asked.append(place)
        return 200, f"{place} {len(asked)}"

    reader = DocumentReader(poll, ["b", "a/ä"], str(tmp_path / "log"), every_ms=10**6)
    assert reader.initialOffset() == {"poll": 0} and reader.latestOffset() == {"poll": 1} == reader.latestOffset()
    parts = reader.partitions({"poll": 0}, {"poll": 1})
    assert parts == [Ask(1, "b"), Ask(1, "a/ä")]
    first = [list(reader.read(p)) for p in parts]
    assert [list(reader.read(p)) for p in parts] == first and len(asked) == 2
    # A new reader goes on with the number after the last one.
    again = DocumentReader(poll, ["b"], str(tmp_path / "log"), every_ms=0)
    assert again.latestOffset() == {"poll": 2}
    again.commit({"poll": 2})
    log = AnswerLog(str(tmp_path / "log"))
    assert log.last() == 2 and log.read(parts[0]) is None
    assert log.write(Ask(2, "b"), (200, "x")) == (200, "x") == log.write(Ask(2, "b"), (500, "y"))
