from __future__ import annotations

import json
from datetime import date, datetime, timezone

import pytest
from pyspark.sql import functions as F

from gridsky.operators.decode import decode_energy, decode_weather
from gridsky.operators.encode import encode_energy, encode_weather
from gridsky.plans import dashboard
from gridsky.plans.job import job_tables
from gridsky.schemas import KEYS, SERVING
from gridsky.sources.messages import read_text_messages, write_text_messages
from gridsky.sources.tables import (
    append_batch,
    create_statement,
    days_between,
    jdbc_options,
    merge_statement,
    one_per_key,
    publish_days,
    read_current,
    read_days,
    read_live,
    read_serving,
    register_serving,
    unpublished_days,
    write_serving,
)
from gridsky.streaming.job import run_batch
from gridsky.streaming.sinks import JdbcSink
from tests.conftest import rows_of


def _points(spark, *rows):
    return spark.createDataFrame(
        rows, "t string, id string, place string, kwh double, arrival int"
    ).select(
        F.col("t").cast("timestamp").alias("time_stamp"),
        "id",
        "place",
        F.lit(True).alias("generation"),
        F.lit("-").alias("type_gen"),
        "kwh",
        "arrival",
    )


def test_one_per_key_keeps_the_last_arrival(spark):
    rows = _points(
        spark,
        ("2024-01-01", "a", "p", 1.0, 2),
        ("2024-01-01", "a", "p", 2.0, 3),
        ("2024-01-01", "a", "p", 3.0, 1),
        ("2024-01-01", None, "p", 4.0, 4),
        (None, "a", "p", 5.0, 5),
    )
    kept = one_per_key(rows, "point_data")
    assert kept.columns == SERVING["point_data"].names
    assert [r.kwh for r in kept.collect()] == [2.0]
    assert one_per_key(rows.drop("arrival"), "point_data").count() == 1


def test_later_batches_and_runs_win(spark, tmp_path):
    path = str(tmp_path / "live")

    def put(run, batch, *rows):
        append_batch(_points(spark, *rows).drop("arrival"), path, "point_data", run, batch)

    put(0, 9, ("2024-01-01", "a", "p", 1.0, 0), ("2024-01-02", "a", "p", 2.0, 0))
    put(0, 10, ("2024-01-01", "a", "p", 3.0, 0))
    live = read_live(spark, path, "point_data")
    assert [r.kwh for r in live.orderBy("time_stamp").collect()] == [3.0, 2.0]
    # A fresh start begins at batch 0 again, under a higher run.
    put(1, 0, ("2024-01-01", "a", "p", 4.0, 0))
    live = read_live(spark, path, "point_data")
    assert [r.kwh for r in live.orderBy("time_stamp").collect()] == [4.0, 2.0]


def test_replayed_batch_leaves_one_copy(spark, tmp_path):
    path = str(tmp_path / "live")
    rows = _points(spark, *[(f"2024-01-0{d}", "a", "p", 1.0, 0) for d in (1, 2, 3)]).drop("arrival")
    for _ in range(2):
        append_batch(rows, path, "point_data", 0, 5)
    assert spark.read.parquet(path).count() == 3


def test_live_table_prunes_days(spark, tmp_path):
    path = str(tmp_path / "live")
    rows = _points(spark, *[(f"2024-01-0{d}", "a", "p", 1.0, 0) for d in (1, 2, 3)]).drop("arrival")
    append_batch(rows, path, "point_data", 0, 0)
    some = read_live(spark, path, "point_data").filter(days_between("2024-01-02", "2024-01-03"))
    assert some.count() == 2
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "2024-01-02" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_closed_days_are_published_and_open_days_stay_live(spark, tmp_path):
    live, serving = str(tmp_path / "live"), str(tmp_path / "serving")

    def put(batch, *rows):
        append_batch(_points(spark, *rows).drop("arrival"), live, "point_data", 0, batch)

    put(0, ("2024-01-01", "a", "p", 1.0, 0), ("2024-01-02", "a", "p", 2.0, 0))
    put(1, ("2024-01-01", "a", "p", 3.0, 0), ("2024-01-03", "a", "p", 4.0, 0))
    for _ in range(2):
        publish_days(spark, live, serving, "point_data", "2024-01-01", "2024-01-02")
    put(2, ("2024-01-03", "a", "p", 5.0, 0))
    assert read_serving(spark, serving, "point_data").count() == 2
    current = read_current(spark, live, serving, "point_data", "2024-01-03")
    assert [r.kwh for r in current.orderBy("day").collect()] == [3.0, 2.0, 5.0]


@pytest.mark.parametrize("advisory,files", [("64MB", (1, 1)), ("4KB", (2, 4))])
def test_hot_day_is_split_and_small_days_are_not(spark, tmp_path, advisory, files):
    path = str(tmp_path / "t")
    rows = spark.range(0, 4000, 1, 4).select(
        F.timestamp_seconds(F.lit(1704067200) + F.col("id")).alias("time_stamp"),
        F.col("id").cast("string").alias("id"),
        F.lit("p").alias("place"),
        F.lit(True).alias("generation"),
        F.lit("-").alias("type_gen"),
        F.rand(1).alias("kwh"),
    )
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", advisory)
    try:
        write_serving(rows, path, "point_data")
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    stored = read_serving(spark, path, "point_data")
    assert stored.count() == 4000
    written = stored.select("_metadata.file_name").distinct().count()
    assert files[0] <= written <= files[1]


def test_rewriting_a_day_keeps_the_others(spark, tmp_path):
    path = str(tmp_path / "t")

    def put(*rows):
        write_serving(_points(spark, *rows).drop("arrival"), path, "point_data")

    put(("2024-01-01", "a", "p", 1.0, 0), ("2024-01-02", "a", "p", 2.0, 0))
    put(("2024-01-02", "a", "p", 9.0, 0))
    stored = read_serving(spark, path, "point_data").orderBy("day")
    assert [r.kwh for r in stored.collect()] == [1.0, 9.0]


def test_merge_statement_updates_by_key():
    assert merge_statement("energy_analytics", "s") == (
        "INSERT INTO energy_analytics (hour_group, kwh_prod, kwh_cons, ratio) "
        "SELECT hour_group, kwh_prod, kwh_cons, ratio FROM s ON CONFLICT (hour_group) "
        "DO UPDATE SET kwh_prod = EXCLUDED.kwh_prod, kwh_cons = EXCLUDED.kwh_cons, "
        "ratio = EXCLUDED.ratio"
    )
    assert KEYS["energy_weather_analytics"] == ("hour_group", "place")


def test_create_statement_has_the_merge_key():
    assert create_statement("energy_weather_analytics") == (
        "CREATE TABLE energy_weather_analytics (hour_group TIMESTAMP WITH TIME ZONE, "
        "place VARCHAR, kwh_cons_degree DOUBLE PRECISION, "
        "kwh_prod_with_rain_prob DOUBLE PRECISION, "
        "kwh_prod_with_no_rain_prob DOUBLE PRECISION, PRIMARY KEY (hour_group, place))"
    )
    assert "generation BOOLEAN" in create_statement("point_data")


def test_serving_tables_answer_sql(spark, tmp_path):
    for table, schema in SERVING.items():
        rows = spark.createDataFrame([], schema)
        if table == "point_data":
            rows = _points(spark, ("2024-01-01 05:00:00", "a", "hydro", 1.5, 0)).drop("arrival")
        write_serving(rows, str(tmp_path / table), table)
    register_serving(spark, str(tmp_path))
    question = "SELECT date_part('hour', time_stamp), kwh FROM point_data WHERE place = :place"
    got = spark.sql(question, {"place": "hydro"})
    assert rows_of(got) == [(5, 1.5)]
    assert spark.table("energy_analytics").count() == 0


def test_jdbc_options():
    base = {"url": "jdbc:x", "dbtable": "t", "user": "u", "password": "p"}
    assert jdbc_options("jdbc:x", "t", "u", "p") == base
    split = jdbc_options("jdbc:x", "t", "u", "p", "time_stamp", "2024-01-01", "2024-02-01", 31)
    assert split == {
        **base,
        "partitionColumn": "time_stamp",
        "lowerBound": "2024-01-01",
        "upperBound": "2024-02-01",
        "numPartitions": "31",
    }
    with pytest.raises(ValueError):
        jdbc_options("jdbc:x", "t", "u", "p", partitions=4)


def test_batch_job_writes_the_four_tables(spark, energy, weather, tmp_path):
    readings = energy([(m, "abc"[m % 3], m % 2 == 0, 1.0 * m) for m in range(60)]).withColumns(
        {"id": F.lit("g"), "type_gen": F.lit("-")}
    )
    sky = weather([(m, "ab"[m % 2], 20.0, 10.0) for m in range(0, 60, 3)]).withColumns(
        {"lat": F.lit(1.0), "lon": F.lit(2.0)}
    )
    millis = F.unix_millis("ts")
    sent = encode_energy(readings.withColumnsRenamed({"id": "ID", "value": "_value"}), millis)
    # The same reading twice, the later one with another value.
    raised = F.regexp_replace("value", '"value":[0-9.]+', '"value":500.0')
    again = sent.limit(1).select(raised.alias("value"))
    write_text_messages(sent.coalesce(1), str(tmp_path / "e"))
    write_text_messages(again, str(tmp_path / "e"))
    write_text_messages(encode_weather(sky, millis), str(tmp_path / "w"))
    run_batch(
        read_text_messages(spark, str(tmp_path / "e"), streaming=False),
        read_text_messages(spark, str(tmp_path / "w"), streaming=False),
        str(tmp_path / "out"),
    )
    stored = {n: read_serving(spark, str(tmp_path / "out" / n), n).drop("day") for n in SERVING}
    # The repeated key is one point row; the analytics count every message.
    assert stored["point_data"].count() == 60
    assert stored["point_data"].agg(F.max("kwh")).first()[0] == 500.0
    everything = job_tables(
        decode_energy(sent.union(again)).records, decode_weather(encode_weather(sky, millis)).records
    )
    for name in ("weather_data", "energy_analytics", "energy_weather_analytics"):
        order = KEYS[name]
        assert rows_of(stored[name], *order) == rows_of(everything[name], *order)


def _energy(minute, value, id="g", place="a", day=18):
    at = datetime(2024, 6, day, 16, minute, tzinfo=timezone.utc).timestamp() * 1000
    return json.dumps(
        {"time_stamp": at, "id": id, "value": value, "place": place, "generation": True, "type_gen": "-"}
    )


def _load(spark, out, load, *messages):
    rows = [(m, (load, k)) for k, m in enumerate(messages)]
    frame = spark.createDataFrame(rows, "value string, arrival struct<file: int, line: int>")
    return run_batch(frame, frame.limit(0), out, load=str(load))


def test_a_second_load_of_the_day_keeps_the_first(spark, tmp_path):
    out = str(tmp_path / "out")
    _load(spark, out, 1, _energy(1, 1.0), _energy(2, 2.0), _energy(2, 9.0, day=17))
    _load(spark, out, 2, _energy(3, 4.0), _energy(2, 8.0))
    points = read_serving(spark, f"{out}/point_data", "point_data").orderBy("time_stamp")
    assert [r.kwh for r in points.collect()] == [9.0, 1.0, 8.0, 4.0]
    # The bucket counts the messages of both loads.
    buckets = read_serving(spark, f"{out}/energy_analytics", "energy_analytics").orderBy("hour_group")
    assert [r.kwh_prod for r in buckets.collect()] == [9.0, 15.0]
    # A load that runs again changes nothing; an earlier one does not undo a later one.
    _load(spark, out, 1, _energy(1, 1.0), _energy(2, 2.0), _energy(2, 9.0, day=17))
    points = read_serving(spark, f"{out}/point_data", "point_data").orderBy("time_stamp")
    assert [r.kwh for r in points.collect()] == [9.0, 1.0, 8.0, 4.0]


def test_a_load_counts_what_it_does_not_keep(spark, tmp_path):
    out = str(tmp_path / "out")
    counts = _load(spark, out, 1, "not json", "{}", "", _energy(1, 1.0), _energy(2, 2.0, id=None))
    assert counts["energy_messages"] == 5 and counts["energy_records"] == 2
    assert counts["energy_malformed"] == 2 and counts["energy_no_event_time"] == 1
    assert counts["point_data_keyless"] == 1
    assert spark.read.parquet(f"{out}/keyless/point_data").count() == 1
    kept = spark.read.parquet(f"{out}/records/energy").filter("reason IS NOT NULL")
    assert sorted(r.message for r in kept.collect()) == ["", "not json", "{}"]
    assert _load(spark, out, 2, "not json")["energy_malformed"] == 1


def test_late_rows_of_a_published_day_are_seen(spark, tmp_path):
    live, serving = str(tmp_path / "live"), str(tmp_path / "serving")

    def put(batch, *rows):
        append_batch(_points(spark, *rows).drop("arrival"), live, "point_data", 0, batch)

    def current():
        return sorted(r.kwh for r in read_current(spark, live, serving, "point_data", "2024-01-05").collect())

    for d in (1, 2, 3, 4):
        put(d, (f"2024-01-0{d}", "a", "p", float(d), 0))
    publish_days(spark, live, serving, "point_data", "2024-01-01", "2024-01-04")
    put(5, ("2024-01-02", "b", "p", 9.0, 0), ("2024-01-05", "a", "p", 5.0, 0))
    assert current() == [1.0, 2.0, 3.0, 4.0, 5.0, 9.0]
    # Of the live form, only the open day and the day with late rows are listed.
    frame = read_current(spark, live, serving, "point_data", "2024-01-05")
    days = {p.split("day=")[1][:10] for p in frame.inputFiles() if "/live/" in p}
    assert days == {"2024-01-02", "2024-01-05"}
    publish_days(spark, live, serving, "point_data", "2024-01-02", "2024-01-02")
    assert unpublished_days(spark, live, serving, "2024-01-05") == [date(2024, 1, 5)]
    assert current() == [1.0, 2.0, 3.0, 4.0, 5.0, 9.0]


def test_newest_questions_go_by_the_notes(spark, tmp_path):
    path = str(tmp_path / "points")
    rows = _points(spark, *[(f"2024-01-0{d}", "GENERADOR 2", "hydro", float(d), 0) for d in range(1, 9)])
    write_serving(rows.drop("arrival"), path, "point_data")
    days = read_days(spark, path)
    assert days.count() == 8
    frame = dashboard.recent_days(read_serving(spark, path, "point_data"), known_days=days)
    assert [r.kwh for r in frame.collect()] == [8.0, 7.0, 6.0]
    plan = frame._jdf.queryExecution().executedPlan().toString()
    # The table is scanned once, for its rows; which days there are comes from the notes.
    assert plan.count(f"{path}]") + plan.count(f"{path},") <= plan.count("_days") + 2


def test_jdbc_sinks_do_not_share_a_staging_table(tmp_path):
    one, two = (JdbcSink({"url": "u", "user": "x", "password": "y"}, str(tmp_path)) for _ in range(2))
    assert one.staging("point_data") != two.staging("point_data")
    assert one.staging("point_data").startswith("point_data_staging_")
    assert JdbcSink({}, "q", job="j").staging("t") == "t_staging_j"
