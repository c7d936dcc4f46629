from __future__ import annotations

import json

import pytest

from gridsky.operators.relay import relay_json
from gridsky.operators.weather_docs import flatten_weather
from gridsky.session import fresh_dir, shared_dir, streaming_session
from gridsky.sources.landed import read_weather_documents
from gridsky.sources.messages import (
    kafka_sink_options,
    kafka_source_options,
    read_text_messages,
    write_text_messages,
)
from tests.conftest import rows_of


def _messages(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def test_relay_passes_json_on_or_writes_it_again(spark):
    sent = '{"b":1,  "a":[1,2.50,null,true],"n":{"x":"\\u00f1"}}'
    assert relay_json(_messages(spark, sent)).first().value == sent
    got = relay_json(_messages(spark, sent), canonical=True).first().value
    assert got == '{"a":[1,2.5,null,true],"b":1,"n":{"x":"ñ"}}'


def test_relay_hook(spark):
    got = relay_json(_messages(spark, "abc", None), fn=str.upper)
    assert [r.value for r in got.collect()] == ["ABC", None]


def test_relay_error_policy(spark):
    bad = _messages(spark, "not json", "{}")
    assert [r.value for r in relay_json(bad, on_error="null").collect()] == [None, "{}"]
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        relay_json(bad).collect()
    with pytest.raises(ValueError):
        relay_json(bad, on_error="skip")


def test_only_successful_documents_are_flattened(spark, tmp_path):
    body = json.dumps(
        {"lat": 14.5, "lon": -90.25, "timezone": "x",
         "current": {"temp": 21, "dew_point": 10.5, "uvi": 0.0, "clouds": 40, "wind": 3}}
    )
    path = tmp_path / "docs"
    path.mkdir()
    lines = [
        {"place": "mall", "status": 200, "body": body},
        {"place": "hydro", "status": 401, "body": body},
        {"place": "solar", "status": 200, "body": '{"lat": 1.0, "lon": 2.0}'},
    ]
    (path / "a.json").write_text("\n".join(json.dumps(x) for x in lines))
    got = rows_of(flatten_weather(read_weather_documents(spark, str(path))), "place")
    assert got == [
        (14.5, -90.25, "mall", 21.0, 10.5, 0.0, 40.0),
        (1.0, 2.0, "solar", None, None, None, None),
    ]


def test_kafka_options():
    assert kafka_source_options("h:1", "energy", group_prefix="grid", max_offsets=10) == {
        "kafka.bootstrap.servers": "h:1",
        "subscribe": "energy",
        "startingOffsets": "earliest",
        "groupIdPrefix": "grid",
        "maxOffsetsPerTrigger": "10",
    }
    assert kafka_source_options("h:1", "t", starting="latest")["startingOffsets"] == "latest"
    assert kafka_sink_options("h:1", "weather") == {
        "kafka.bootstrap.servers": "h:1",
        "topic": "weather",
        "kafka.compression.type": "gzip",
        "kafka.acks": "1",
        "kafka.linger.ms": "100",
    }


def test_text_messages_keep_their_order(spark, tmp_path):
    path = str(tmp_path / "m")
    write_text_messages(_messages(spark, *[f"m{i}" for i in range(20)]).coalesce(1), path)
    back = read_text_messages(spark, path, streaming=False)
    assert back.select("arrival.modified", "arrival.path", "arrival.block").distinct().count() == 1
    assert [r.value for r in back.collect()] == [f"m{i}" for i in range(20)]


def test_shared_folder_comes_from_the_session(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    assert fresh_dir(spark, "x") != fresh_dir(spark, "x")


def test_streaming_session_leaves_the_caller_alone(spark):
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        # The width does not follow the cores that happen to be there.
        assert streaming_session(spark).conf.get("spark.sql.shuffle.partitions") == "64"
        assert streaming_session(spark, 6).conf.get("spark.sql.shuffle.partitions") == "6"
        assert spark.conf.get("spark.sql.shuffle.partitions") == "64"
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
