"""Loads that replace and add to each other, and what readers see meanwhile."""

from __future__ import annotations

import glob
import json
import os
from datetime import date, datetime, timezone

import pytest
from pyspark.sql import functions as F

from gridsky.operators.buckets import energy_analytics, energy_weather_analytics
from gridsky.operators.partials import (
    energy_partials,
    merge_partials,
    merged_energy_analytics,
    merged_energy_weather,
    weather_partials,
)
from gridsky.schemas import KEYS, SERVING
from gridsky.sources import commits, files
from gridsky.sources.commits import Commit, commit_numbers, expire, publish, read_commit
from gridsky.sources.tables import read_committed, read_days, read_serving, register_serving, write_serving
from gridsky.streaming import batch
from gridsky.streaming.batch import FOLDED, fold_days, run_batch
from tests.conftest import rows_of

NOTHING = []


def millis(minute, day):
    return datetime(2024, 6, day, 16, minute, tzinfo=timezone.utc).timestamp() * 1000


def reading(minute, value, day=18, id="g", place="a"):
    return json.dumps(
        {"time_stamp": millis(minute, day), "id": id, "value": value, "place": place, "generation": True, "type_gen": "-"}
    )


def sky(minute, temp, day=18, place="a"):
    body = {"time_stamp": millis(minute, day), "lat": 1.0, "lon": 2.0, "place": place, "temp": temp}
    return json.dumps({**body, "dew_point": 1.0, "uvi": 0.0, "clouds": 0.0})


def load(spark, out, name, energy=NOTHING, weather=NOTHING, at=0):
    def frame(messages):
        rows = [(m, (at, k)) for k, m in enumerate(messages)]
        return spark.createDataFrame(rows, "value string, arrival struct<file: int, line: int>")

    return run_batch(frame(energy), frame(weather), out, load=name)


def answers(spark, out):
    return {t: rows_of(read_serving(spark, f"{out}/{t}", t), *KEYS[t]) for t in SERVING}


def values(spark, out, table="point_data", column="kwh"):
    return [r[column] for r in read_serving(spark, f"{out}/{table}", table).orderBy(*KEYS[table]).collect()]


def test_a_load_run_again_leaves_none_of_its_old_rows(spark, tmp_path):
    out = str(tmp_path / "out")
    first = load(spark, out, "1", [reading(1, 1.0), reading(2, 2.0, day=17), "bad"], [sky(1, 20.0)])
    assert (first["energy_records"], first["energy_malformed"], first["weather_records"]) == (2, 1, 1)
    load(spark, out, "2", [reading(3, 4.0)], at=1)
    again = load(spark, out, "1", [reading(1, 8.0)])
    assert (again["energy_records"], again["energy_malformed"], again["energy_messages"]) == (1, 0, 1)
    assert values(spark, out) == [8.0, 4.0]
    assert values(spark, out, "energy_analytics", "kwh_prod") == [12.0]
    assert values(spark, out, "weather_data", "temp") == []
    assert [r.day for r in read_days(spark, f"{out}/point_data").collect()] == [date(2024, 6, 18)]


def test_a_load_without_rows_empties_its_days(spark, tmp_path):
    out = str(tmp_path / "out")
    load(spark, out, "1", [reading(1, 1.0)], [sky(1, 20.0)])
    load(spark, out, "1")
    assert answers(spark, out) == {t: [] for t in SERVING}


@pytest.mark.parametrize("broken", ["point_data", "weather_sums", "publish"])
def test_a_job_that_stops_shows_only_the_old_state(spark, tmp_path, monkeypatch, broken):
    out = str(tmp_path / "out")
    load(spark, out, "1", [reading(1, 1.0)], [sky(1, 20.0)])
    before = answers(spark, out)

    def fails(*args):
        if broken in args or broken == "publish":
            raise OSError("lost")
        return commits.write_part(*args)

    monkeypatch.setattr(batch, "publish" if broken == "publish" else "write_part", fails)
    with pytest.raises(OSError):
        load(spark, out, "2", [reading(2, 2.0)], [sky(2, 30.0)], at=1)
    assert answers(spark, out) == before
    monkeypatch.undo()
    load(spark, out, "2", [reading(2, 2.0)], [sky(2, 30.0)], at=1)
    assert values(spark, out) == [1.0, 2.0] and values(spark, out, "weather_data", "temp") == [20.0, 30.0]
    # What the broken run has left is named by no commit, and goes with the older notes.
    assert expire(spark, out)
    assert values(spark, out) == [1.0, 2.0] and expire(spark, out) == []


def test_a_reader_keeps_the_state_that_it_began_with(spark, tmp_path):
    out = str(tmp_path / "out")
    load(spark, out, "1", [reading(1, 1.0)], [sky(1, 20.0)])
    commit = read_commit(spark, out)
    points = read_committed(spark, commit, "point_data")
    load(spark, out, "1", [reading(1, 5.0)], [sky(1, 40.0)])
    assert [r.kwh for r in points.collect()] == [1.0]
    assert [r.temp for r in read_committed(spark, commit, "weather_data").collect()] == [20.0]
    assert values(spark, out) == [5.0]
    register_serving(spark, out)
    assert spark.sql("SELECT kwh_cons_degree, kwh FROM energy_weather_analytics, point_data").collect()[0].kwh == 5.0


def test_a_load_reads_nothing_of_the_loads_before(spark, tmp_path):
    """The files of the first load are unreadable while the second one, of the same bucket, is taken in."""
    out = str(tmp_path / "out")
    load(spark, out, "1", [reading(m, 1.0) for m in range(5)], [sky(1, 20.0)])
    stored = {p: open(p, "rb").read() for p in glob.glob(f"{out}/**/*.parquet", recursive=True)}
    for path in stored:
        crc = os.path.join(os.path.dirname(path), f".{os.path.basename(path)}.crc")
        if os.path.exists(crc):
            os.remove(crc)
        with open(path, "wb") as file:
            file.write(b"not readable")
    load(spark, out, "2", [reading(6, 2.0), reading(1, 7.0)], at=1)
    for path, content in stored.items():
        with open(path, "wb") as file:
            file.write(content)
    assert values(spark, out) == [1.0, 7.0, 1.0, 1.0, 1.0, 2.0]
    assert values(spark, out, "energy_analytics", "kwh_prod") == [14.0]


def test_loads_in_any_order_and_cut_give_the_same_tables(spark, tmp_path):
    energy = [reading(m, m / 4, day=17 + m % 2, id="gh"[m % 2], place="ab"[m % 3 == 0]) for m in range(40)]
    weather = [sky(m, 10.0 + m, day=17 + m % 2, place="ab"[m % 3 == 0]) for m in range(0, 40, 3)]
    whole, cut = str(tmp_path / "whole"), str(tmp_path / "cut")
    load(spark, whole, "all", energy, weather)
    for k in (2, 0, 1):
        load(spark, cut, str(k), energy[k::3], weather[k::3])
    want = answers(spark, whole)
    assert answers(spark, cut) == want
    for d in (17, 18):
        assert fold_days(spark, cut, [date(2024, 6, d)]) > 0
    assert answers(spark, cut) == want
    assert all(set(p) == {FOLDED} for t in ("point_data", "energy_sums") for p in read_commit(spark, cut).tables[t].values())


def test_folded_days_take_new_loads_but_no_old_ones_again(spark, tmp_path):
    out = str(tmp_path / "out")
    load(spark, out, "1", [reading(1, 1.0), reading(9, 3.0, day=19)])
    load(spark, out, "2", [reading(2, 2.0), reading(1, 5.0)], at=1)
    fold_days(spark, out, [date(2024, 6, 18)])
    assert fold_days(spark, out, [date(2024, 6, 18)]) == 0
    with pytest.raises(ValueError, match="folded"):
        load(spark, out, "2", [reading(2, 9.0)])
    load(spark, out, "3", [reading(4, 4.0)], at=2)
    assert values(spark, out) == [5.0, 2.0, 4.0, 3.0]
    assert values(spark, out, "energy_analytics", "kwh_prod") == [12.0, 3.0]
    fold_days(spark, out, [date(2024, 6, 18)])
    assert values(spark, out) == [5.0, 2.0, 4.0, 3.0]
    with pytest.raises(ValueError):
        load(spark, out, "_x", [reading(2, 9.0)])


def test_a_second_writer_from_the_same_state_fails(spark, tmp_path):
    out = str(tmp_path / "out")
    state = read_commit(spark, out)
    assert state == Commit(out) and commit_numbers(spark, out) == []
    publish(spark, state)
    with pytest.raises(RuntimeError, match="another writer"):
        publish(spark, state)
    assert [n for n in files.names(spark, f"{out}/_commits") if not n.endswith(".crc")] == ["000000000001.json"]


def test_records_elsewhere_and_odd_load_names(spark, tmp_path):
    out, records = str(tmp_path / "out"), str(tmp_path / "records")
    frame = spark.createDataFrame([(reading(1, 1.0), (0,)), ("bad", (1,))], "value string, arrival struct<line: int>")
    run_batch(frame, frame.limit(0), out, records=records, load="a/b=c %")
    run_batch(frame.where("value <> 'bad'"), frame.limit(0), out, records=records, load="a/b=c %")
    assert values(spark, out) == [1.0]
    commit = read_commit(spark, records)
    assert [r.reason for r in commits.read_parts(spark, commit, "energy").collect()] == [None]


def test_keyless_rows_of_a_load_are_replaced(spark, tmp_path):
    out = str(tmp_path / "out")
    counts = load(spark, out, "1", [reading(1, 1.0, id=None), reading(2, 1.0)], [sky(1, 2.0, place=None)])
    assert counts["point_data_keyless"] == 1 and counts["weather_data_keyless"] == 1
    load(spark, out, "1", [reading(2, 1.0)])
    commit = read_commit(spark, out)
    assert commits.read_parts(spark, commit, "keyless/point_data") is None
    # Rows without a place still count in the totals of a bucket over all places.
    load(spark, out, "2", [reading(3, 2.0, place=None)])
    assert values(spark, out, "energy_analytics", "kwh_prod") == [3.0]


def test_partials_merge_to_the_whole(spark, energy, weather):
    readings = energy([(m, ["a", "b", None][m % 3], m % 2 == 0, None if m % 7 == 0 else m / 8) for m in range(60)])
    air = weather([(m, "ab"[m % 2], 20.0 + m, 25.0) for m in range(0, 60, 2)])
    halves = [readings.filter(F.minute("ts") % 2 == k) for k in (0, 1)]
    parts = energy_partials(halves[0]).unionByName(energy_partials(halves[1]))
    sky_parts = weather_partials(air.filter("temp < 40")).unionByName(weather_partials(air.filter("temp >= 40")))
    for p, s in ((parts, sky_parts), (merge_partials(parts), merge_partials(sky_parts))):
        assert rows_of(merged_energy_analytics(p), "hour_group") == rows_of(energy_analytics(readings), "hour_group")
        want = energy_weather_analytics(readings, air)
        assert rows_of(merged_energy_weather(p, s), "hour_group", "place") == rows_of(want, "hour_group", "place")


def test_write_serving_empties_touched_days(spark, tmp_path):
    path = str(tmp_path / "energy_analytics")

    def rows(*days):
        made = [(f"2024-01-0{d} 10:00:00", 1.0) for d in days]
        return spark.createDataFrame(made, "t string, v double").selectExpr(
            "cast(t AS timestamp) AS hour_group", "v AS kwh_prod", "v AS kwh_cons", "v AS ratio"
        )

    write_serving(rows(1, 2, 3), path, "energy_analytics")
    write_serving(rows(1), path, "energy_analytics", touched=[date(2024, 1, 1), date(2024, 1, 2)])
    left = [date(2024, 1, 1), date(2024, 1, 3)]
    assert sorted(r.day for r in read_serving(spark, path, "energy_analytics").collect()) == left
    assert sorted(r.day for r in read_days(spark, path).collect()) == left
