"""The job as streams: the same rows as in batch, across restarts and late data.

Inputs are text files, one micro-batch each. The last file holds a row far in
the future, which moves the watermark past every other bucket.
"""

from __future__ import annotations

import json
import os
import time
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.errors import StreamingQueryException

from gridsky.operators.decode import decode_energy, decode_weather
from gridsky.operators.records import point_data
from gridsky.operators.relay import relay_json
from gridsky.plans.job import job_tables
from gridsky.schemas import KEYS
from gridsky.session import streaming_session
from gridsky.sources.messages import read_text_messages
from gridsky.sources.tables import read_live
from gridsky.streaming.job import (
    await_all,
    set_watermark_policy,
    start_job,
    start_tables,
)
from gridsky.streaming.sinks import PrintSink, TableSink
from tests.conftest import rows_of

START = datetime(2024, 6, 18, 16, tzinfo=timezone.utc)
FAR = 60 * 24 * 30
PLACES = ("hydro", "solar", "mall")


def _millis(minute: float) -> float:
    return (START + timedelta(minutes=minute)).timestamp() * 1000


def energy_message(minute: float, place: str = "hydro", value: float = 1.0, id: str = "g1") -> str:
    return json.dumps(
        {"time_stamp": _millis(minute), "id": id, "value": value, "place": place,
         "generation": place != "mall", "type_gen": "-"}
    )


def weather_message(minute: float, place: str = "hydro", temp: float = 20.0) -> str:
    return json.dumps(
        {"time_stamp": _millis(minute), "lat": 1.0, "lon": 2.0, "place": place, "temp": temp,
         "dew_point": 20.0, "uvi": 1.0, "clouds": 10.0}
    )


class Landing:
    """A folder of message files whose order of arrival is their number."""

    def __init__(self, path):
        self.path = path
        path.mkdir()
        self.count = 0

    def add(self, *messages: str) -> None:
        self.count += 1
        name = self.path / f"part-{self.count:04d}.txt"
        hidden = self.path / f".{name.name}"
        hidden.write_text("\n".join(messages))
        stamp = 1_700_000_000 + self.count
        os.utime(hidden, (stamp, stamp))
        hidden.rename(name)


@pytest.fixture
def landings(tmp_path):
    return Landing(tmp_path / "energy"), Landing(tmp_path / "weather")


@pytest.fixture
def session(spark):
    child = streaming_session(spark)
    child.conf.set("spark.sql.shuffle.partitions", "2")
    return child


def tables(session, landings, streaming=True):
    energy, weather = (
        read_text_messages(session, str(x.path), streaming=streaming, max_files=1) for x in landings
    )
    carry = ("arrival",)
    return job_tables(
        decode_energy(energy, carry).records, decode_weather(weather, carry).records, carry
    )


def run(session, landings, tmp_path, names=None, sink=None):
    wanted = tables(session, landings)
    if names:
        wanted = {n: wanted[n] for n in names}
    sink = sink or TableSink(str(tmp_path / "live"))
    queries = start_tables(wanted, sink, str(tmp_path / "checkpoints"), available_now=True)
    await_all(queries.values())
    return queries, sink


def fill(landings, minutes=80, step=10):
    energy, weather = landings
    for first in range(0, minutes, step):
        span = range(first, first + step)
        energy.add(*[energy_message(m, PLACES[m % 3], m * 0.5) for m in span])
        weather.add(*[weather_message(m + 0.5, PLACES[m % 3], 15.0 + m % 9) for m in span[::2]])


def close(landings):
    energy, weather = landings
    energy.add(energy_message(FAR))
    weather.add(weather_message(FAR))


def stored(spark, sink, name):
    return rows_of(read_live(spark, sink.path(name), name).drop("day"), *KEYS[name])


def test_streams_equal_batch(spark, session, landings, tmp_path):
    fill(landings)
    want = {n: rows_of(t.drop("arrival"), *KEYS[n])
            for n, t in tables(spark, landings, streaming=False).items()}
    close(landings)
    queries, sink = run(session, landings, tmp_path)
    assert {q.name for q in queries.values()} == set(KEYS)
    for name in ("energy_analytics", "energy_weather_analytics"):
        assert stored(spark, sink, name) == want[name]
    for name in ("point_data", "weather_data"):
        assert [r for r in stored(spark, sink, name) if r[0] < "2024-07"] == want[name]


def test_last_bucket_stays_open_without_newer_rows(spark, session, landings, tmp_path):
    fill(landings, minutes=30)
    _, sink = run(session, landings, tmp_path, ["energy_analytics"])
    assert [r[0][11:16] for r in stored(spark, sink, "energy_analytics")] == ["16:00", "16:10"]


def test_late_rows_miss_the_buckets_but_not_the_points(spark, session, landings, tmp_path):
    energy, _ = landings
    energy.add(energy_message(1, value=1.0))
    energy.add(energy_message(45, value=2.0))
    energy.add(energy_message(46, value=4.0))
    energy.add(energy_message(2, value=100.0))
    energy.add(energy_message(FAR))
    _, sink = run(session, landings, tmp_path, ["energy_analytics", "point_data"])
    assert [r[1] for r in stored(spark, sink, "energy_analytics")] == [1.0, 6.0]
    assert 100.0 in [r[5] for r in stored(spark, sink, "point_data")]


def test_out_of_order_rows_inside_the_bucket_count(spark, session, landings, tmp_path):
    energy, _ = landings
    energy.add(energy_message(8, value=1.0))
    energy.add(energy_message(3, value=2.0))
    energy.add(energy_message(FAR))
    _, sink = run(session, landings, tmp_path, ["energy_analytics"])
    assert stored(spark, sink, "energy_analytics")[0][1] == 3.0


def test_restart_goes_on_from_the_checkpoint(spark, session, landings, tmp_path):
    fill(landings, minutes=35, step=5)
    run(session, landings, tmp_path)
    fill_more = [(m, PLACES[m % 3]) for m in range(35, 60)]
    landings[0].add(*[energy_message(m, p, m * 0.5) for m, p in fill_more])
    landings[1].add(*[weather_message(m + 0.5, p) for m, p in fill_more])
    want = {n: rows_of(t.drop("arrival"), *KEYS[n])
            for n, t in tables(spark, landings, streaming=False).items()}
    close(landings)
    queries, sink = run(session, landings, tmp_path)
    assert queries["energy_analytics"].recentProgress[0]["batchId"] > 0
    for name in ("energy_analytics", "energy_weather_analytics"):
        assert stored(spark, sink, name) == want[name]


def test_replay_from_the_start_changes_nothing(spark, session, landings, tmp_path):
    fill(landings, minutes=40)
    close(landings)
    _, sink = run(session, landings, tmp_path)
    before = {n: stored(spark, sink, n) for n in KEYS}
    again = TableSink(sink.root, run=1)
    (tmp_path / "second").mkdir()
    run(session, landings, tmp_path / "second", sink=again)
    assert {n: stored(spark, sink, n) for n in KEYS} == before


class FailsAfterWriting:
    """Writes the first batch, then fails before the stream can record it as done."""

    def __init__(self, sink):
        self.sink = sink

    def __call__(self, table):
        write = self.sink(table)

        def write_and_fail(batch, batch_id):
            write(batch, batch_id)
            raise RuntimeError("lost after writing")

        return write_and_fail


def test_batch_lost_after_writing_is_written_once(spark, session, landings, tmp_path):
    fill(landings, minutes=40)
    close(landings)
    sink = TableSink(str(tmp_path / "live"))
    names = ["point_data", "energy_analytics"]
    for name in names:
        with pytest.raises(Exception, match="lost after writing"):
            run(session, landings, tmp_path, [name], FailsAfterWriting(sink))
    run(session, landings, tmp_path, names, sink)
    assert spark.read.parquet(sink.path("point_data")).count() == 41
    want = {n: rows_of(t.drop("arrival"), *KEYS[n])
            for n, t in tables(spark, landings, streaming=False).items()}
    assert stored(spark, sink, "point_data") == want["point_data"]
    assert stored(spark, sink, "energy_analytics") == want["energy_analytics"][:-1]


def test_repeated_key_keeps_the_last_arrival(spark, session, landings, tmp_path):
    energy, _ = landings
    energy.add(energy_message(1, value=1.0), energy_message(1, value=2.0))
    _, sink = run(session, landings, tmp_path, ["point_data"])
    assert [r[5] for r in stored(spark, sink, "point_data")] == [2.0]
    energy.add(energy_message(1, value=3.0), energy_message(2, value=7.0))
    run(session, landings, tmp_path, ["point_data"])
    assert [r[5] for r in stored(spark, sink, "point_data")] == [3.0, 7.0]


def test_join_state_is_cleared(session, landings, tmp_path):
    fill(landings)
    close(landings)
    queries, _ = run(session, landings, tmp_path, ["energy_weather_analytics"])
    last = queries["energy_weather_analytics"].lastProgress
    joins = [s for s in last["stateOperators"] if s["operatorName"] == "symmetricHashJoin"]
    assert [s["numRowsTotal"] for s in joins] == [0]


def test_idle_source_holds_the_join_under_min_and_not_under_max(spark, session, landings, tmp_path):
    energy, weather = landings
    weather.add(weather_message(1), weather_message(12))
    for first in range(0, 80, 10):
        energy.add(*[energy_message(m) for m in range(first, first + 10)])
    _, held = run(session, landings, tmp_path, ["energy_weather_analytics"])
    set_watermark_policy(session, "max")
    (tmp_path / "max").mkdir()
    _, freed = run(session, landings, tmp_path / "max", ["energy_weather_analytics"])
    name = "energy_weather_analytics"
    assert [r[0][11:16] for r in stored(spark, held, name)] == ["16:00"]
    assert [r[0][11:16] for r in stored(spark, freed, name)] == ["16:00", "16:10"]
    with pytest.raises(ValueError):
        set_watermark_policy(session, "avg")


def test_rows_without_key_are_quarantined(spark, session, landings, tmp_path):
    energy, _ = landings
    energy.add(energy_message(1), energy_message(2, place=None), energy_message(3, id=None))
    sink = TableSink(str(tmp_path / "live"), quarantine=str(tmp_path / "keyless"))
    run(session, landings, tmp_path, ["point_data"], sink)
    assert len(stored(spark, sink, "point_data")) == 1
    assert spark.read.parquet(str(tmp_path / "keyless" / "point_data")).count() == 2


def test_rejects_are_kept_and_counted(spark, session, landings, tmp_path):
    energy, weather = landings
    energy.add("not json", "{}", energy_message(1), "[1]")
    weather.add("", weather_message(1))
    inputs = [read_text_messages(session, str(x.path)) for x in landings]
    sink = TableSink(str(tmp_path / "live"))
    rejects = str(tmp_path / "rejects")
    queries = start_job(*inputs, sink, str(tmp_path / "cp"), rejects, available_now=True)
    await_all(queries.values())
    counts = [
        p.observedMetrics["rejected"]
        for p in queries["energy_rejects"].recentProgress
        if p.numInputRows
    ]
    assert [(c.malformed, c.no_event_time) for c in counts] == [(2, 1)]
    assert spark.read.parquet(f"{rejects}/energy_rejects").count() == 3
    # An empty line is an empty message, and counts as malformed.
    assert spark.read.parquet(f"{rejects}/weather_rejects").first().reason == "malformed"
    assert len(stored(spark, sink, "point_data")) == len(stored(spark, sink, "weather_data")) == 1


def test_tables_from_records_landed_once(spark, session, landings, tmp_path):
    fill(landings, minutes=40, step=20)
    close(landings)
    inputs = [read_text_messages(session, str(x.path)) for x in landings]
    direct = TableSink(str(tmp_path / "direct"))
    landed = TableSink(str(tmp_path / "landed"))
    await_all(
        start_job(*inputs, direct, str(tmp_path / "cp1"), available_now=True).values()
    )
    queries = start_job(
        *inputs, landed, str(tmp_path / "cp2"), records=str(tmp_path / "records"), available_now=True
    )
    await_all(queries.values())
    assert {"energy_records", "weather_records"} < set(queries)
    for name in KEYS:
        assert stored(spark, landed, name) == stored(spark, direct, name) != []


def test_landed_records_are_followed_while_they_grow(spark, session, landings, tmp_path):
    energy, weather = landings
    inputs = [read_text_messages(session, str(x.path)) for x in landings]
    sink = TableSink(str(tmp_path / "live"))
    queries = start_job(
        *inputs, sink, str(tmp_path / "cp"), records=str(tmp_path / "records"), interval="1 second"
    )
    try:
        for minute in (1, 2):
            energy.add(energy_message(minute))
            weather.add(weather_message(minute))
            for name in ("energy_records", "point_data"):
                queries[name].processAllAvailable()
        assert len(stored(spark, sink, "point_data")) == 2
    finally:
        for query in queries.values():
            query.stop()


def test_relay_runs_on_a_stream(spark, session, landings, tmp_path):
    energy, _ = landings
    energy.add('{"a":1}', '{"b":[2]}')
    relayed = relay_json(read_text_messages(session, str(energy.path))).select("value")
    query = (
        relayed.writeStream.format("text")
        .option("path", str(tmp_path / "out"))
        .option("checkpointLocation", str(tmp_path / "cp"))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    assert sorted(r.value for r in spark.read.text(str(tmp_path / "out")).collect()) == [
        '{"a":1}', '{"b":[2]}',
    ]


def test_dry_run_prints_rows_under_the_tables_name(spark, session, landings, tmp_path):
    energy, _ = landings
    energy.add(energy_message(1, value=123.25), energy_message(2, id=None))
    wanted = {"point_data": tables(session, landings)["point_data"]}
    queries, _ = run(session, landings, tmp_path, list(wanted), sink=PrintSink())
    assert queries["point_data"].lastProgress["numInputRows"] == 2
    batch = tables(spark, landings, streaming=False)["point_data"]
    assert [r.line for r in PrintSink.lines(batch, "point_data").collect()] == [
        'point_data> {"time_stamp":"2024-06-18T16:01:00.000Z","id":"g1","place":"hydro",'
        '"generation":true,"type_gen":"-","kwh":123.25}',
        'point_data> {"time_stamp":"2024-06-18T16:02:00.000Z","id":null,"place":"hydro",'
        '"generation":true,"type_gen":"-","kwh":1.0}',
    ]


def test_a_failure_stops_the_other_queries(spark, session, landings, tmp_path):
    """The first query is healthy and endless, the second one fails."""
    energy, weather = landings
    energy.add(energy_message(1))
    weather.add(weather_message(1))

    def keep(table):
        return lambda batch, batch_id: batch.count()

    def fail(table):
        def write(batch, batch_id):
            raise RuntimeError("sink is gone")

        return write

    wanted = tables(session, landings)

    def start(name, sink):
        return start_tables({name: wanted[name]}, sink, str(tmp_path / "cp"))[name]

    healthy = start("point_data", keep)
    try:
        failing = start("weather_data", fail)
        begun = time.monotonic()
        with pytest.raises(StreamingQueryException, match="sink is gone"):
            await_all([healthy, failing])
        assert time.monotonic() - begun < 30
        assert not healthy.isActive
    finally:
        healthy.stop()


def test_each_message_is_parsed_once(spark, session, landings, tmp_path):
    """Only the two landing queries read messages; tables and rejects read what they land."""
    energy, weather = landings
    energy.add("not json", energy_message(1), energy_message(2, place=None))
    weather.add(weather_message(1))
    inputs = [read_text_messages(session, str(x.path)) for x in landings]
    sink = TableSink(str(tmp_path / "live"))
    queries = start_job(
        *inputs, sink, str(tmp_path / "cp"), str(tmp_path / "rejects"), available_now=True
    )
    await_all(queries.values())
    read = {name: {s["description"] for s in q.lastProgress["sources"]} for name, q in queries.items()}
    messages = {n for n, s in read.items() if any(str(x.path) in d for d in s for x in landings)}
    assert messages == {"energy_records", "weather_records"}
    counts = queries["energy_records"].recentProgress[0]["observedMetrics"]["rejected"]
    assert (counts.malformed, counts.no_event_time) == (1, 0)
    # Rows without their key are kept by default.
    assert spark.read.parquet(sink.keyless("point_data")).count() == 1


def test_the_last_arrival_stays_however_the_batches_are_cut(spark, session, landings, tmp_path):
    energy, _ = landings
    for k in range(6):
        energy.add(*[energy_message(m, value=10.0 * k + m) for m in range(k, 8)], energy_message(k, value=0.5))
    found = []
    for cut in (1, 4, 100):
        records = decode_energy(read_text_messages(session, str(energy.path), max_files=cut), ("arrival",)).records
        sink = TableSink(str(tmp_path / f"live{cut}"))
        wanted = {"point_data": point_data(records, ("arrival",))}
        await_all(start_tables(wanted, sink, str(tmp_path / f"cp{cut}"), available_now=True).values())
        found.append(stored(spark, sink, "point_data"))
    # Every minute was sent up to seven times; each file ends with a repetition of its first minute.
    assert found[0] == found[1] == found[2]
    assert [r[5] for r in found[0]] == [0.5] * 6 + [56.0, 57.0]
