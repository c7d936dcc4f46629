from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from gridsky.operators.decode import decode_energy, decode_weather, split_null_keys
from gridsky.operators.encode import encode_energy, encode_weather
from tests.conftest import rows_of

GOOD = (
    '{"time_stamp": 1718727374098.123, "id": "GENERADOR 2", "value": 3.5, "place": "hydro",'
    ' "generation": true, "type_gen": "hydro"}'
)


def decoded(spark, *messages):
    return decode_energy(spark.createDataFrame([(m,) for m in messages], "value string"))


def test_float_epoch_is_cut_to_milliseconds(spark):
    row = rows_of(decoded(spark, GOOD).records)[0]
    assert row == (
        1718727374098,
        "GENERADOR 2",
        3.5,
        "hydro",
        True,
        "hydro",
        "2024-06-18 16:16:14.098",
    )


def test_scalars_in_quotes_are_read(spark):
    message = '{"time_stamp": "1718727374098", "value": "12.5", "generation": "true", "id": 7}'
    record = decoded(spark, message).records.first()
    assert (record.value, record.generation, record.id) == (12.5, True, "7")


@pytest.mark.parametrize("text,expected", [("yes", False), ("1", False), ("TRUE ", True)])
def test_only_true_is_true(spark, text, expected):
    message = json.dumps({"time_stamp": 1, "generation": text})
    assert decoded(spark, message).records.first().generation is expected


def test_missing_and_null_fields_are_null(spark):
    record = decoded(spark, '{"time_stamp": 0, "value": null}').records.first()
    assert (record.id, record.value, record.generation) == (None, None, None)


def test_bad_field_is_null_and_the_rest_is_kept(spark):
    record = decoded(spark, '{"time_stamp": 5, "id": "a", "value": {"a": 1}}').records.first()
    assert (record.id, record.value) == ("a", None)


@pytest.mark.parametrize("message", ["not json", "[1]", "null", "", "   ", None, '{"time_stamp": 1'])
def test_malformed_messages_are_rejected(spark, message):
    result = decoded(spark, message, GOOD)
    assert result.records.count() == 1
    assert [r.reason for r in result.rejected.collect()] == ["malformed"]


@pytest.mark.parametrize(
    "message", ["{}", '{"time_stamp": "x"}', '{"time_stamp": 1e300}', '{"time_stamp": 9e18}']
)
def test_messages_without_event_time_are_rejected(spark, message):
    result = decoded(spark, message)
    assert result.records.count() == 0
    assert rows_of(result.rejected) == [(message, "no_event_time")]


def test_records_and_rejects_cover_every_message(spark):
    result = decoded(spark, GOOD, "{}", "x", "[]", GOOD)
    assert result.records.count() + result.rejected.count() == 5


@pytest.mark.parametrize(
    "field,text,expected",
    [
        ("value", '"12.5"', 12.5),
        ("value", '" 7 "', 7.0),
        ("value", '""', None),
        ("value", "true", None),
        ("value", "[1]", None),
        ("value", "1e3", 1000.0),
        ("value", '"1e3"', 1000.0),
        ("value", "4", 4.0),
        ("generation", '"false"', False),
        ("generation", "1", False),
        ("generation", "null", None),
        ("id", "5", "5"),
        ("id", '{"a": 1}', '{"a":1}'),
        ("place", "true", "true"),
    ],
)
def test_one_odd_field_leaves_the_others(spark, field, text, expected):
    fields = {"time_stamp": "1718727374098.75", "id": '"g"', "value": "3.5", "place": '"p"',
              "generation": "true", "type_gen": '"-"'}
    usual = {"time_stamp": 1718727374098, "id": "g", "value": 3.5, "place": "p",
             "generation": True, "type_gen": "-"}
    message = ", ".join(f'"{k}": {v}' for k, v in {**fields, field: text}.items())
    record = decoded(spark, f"{{{message}}}").records.drop("ts").first()
    assert record.asDict() == {**usual, field: expected}


@pytest.mark.parametrize("text", ["NaN", '"NaN"', "Infinity", '"-Infinity"'])
def test_special_doubles_are_read(spark, text):
    value = decoded(spark, f'{{"time_stamp": 1, "value": {text}}}').records.first().value
    assert repr(value) == repr(float(text.strip('"')))


def test_message_is_parsed_as_often_as_needed(spark, tmp_path):
    """Once with types, once as text where that failed; never again in a filter."""
    path = str(tmp_path / "in")
    spark.createDataFrame([(GOOD,)], "value string").write.text(path)
    records = decode_energy(spark.read.text(path)).records.filter("value > 1")
    plan = records._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json") == 2
    assert plan.count("CASE WHEN (isnotnull(typed__corrupt") == 1


def test_carried_columns_stay(spark):
    messages = spark.createDataFrame([(GOOD, 9)], "value string, arrival int")
    assert decode_energy(messages, ("arrival",)).records.first().arrival == 9


def test_null_keys_are_split_off(spark):
    rows = spark.createDataFrame([("a", 1), (None, 2), ("b", None)], "place string, id int")
    whole, keyless = split_null_keys(rows, ("place", "id"))
    assert rows_of(whole) == [("a", 1)]
    assert keyless.count() == 2


def test_energy_round_trip(spark):
    readings = spark.createDataFrame(
        [("GENERADOR 1", 2.25, "hydro", True, "hydro"), ("ñ", None, None, None, "-")],
        "ID string, _value double, place string, generation boolean, type_gen string",
    )
    back = decode_energy(encode_energy(readings, F.lit(1718727374098))).records
    assert sorted(map(repr, rows_of(back.drop("time_stamp", "ts")))) == sorted(
        map(repr, rows_of(readings))
    )


def test_envelope_writes_nulls_and_key(spark):
    readings = spark.createDataFrame(
        [("a", None, "mall", False, "-")],
        "ID string, _value double, place string, generation boolean, type_gen string",
    )
    sent = encode_energy(readings, F.lit(5), key=F.lit("k")).first()
    assert sent.key == "k"
    assert json.loads(sent.value) == {
        "time_stamp": 5,
        "id": "a",
        "value": None,
        "place": "mall",
        "generation": False,
        "type_gen": "-",
    }


def test_default_event_time_is_now(spark):
    conditions = spark.createDataFrame(
        [(1.0, 2.0, "mall", 20.0, 10.0, 1.0, 5.0)],
        "lat double, lon double, place string, temp double, dew_point double, uvi double, clouds double",
    )
    back = decode_weather(encode_weather(conditions)).records
    age = back.select(F.unix_millis(F.current_timestamp()) - F.col("time_stamp")).first()[0]
    assert 0 <= age < 120_000
