from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from gridsky.functions.numeric import guarded_ratio, ieee_div
from gridsky.operators.buckets import (
    energy_analytics,
    energy_weather_analytics,
    energy_weather_wide,
    energy_window,
    start_stamped,
    weather_window,
)
from gridsky.operators.records import point_data, weather_data
from tests.conftest import rows_of


def test_unknown_side_adds_nothing(energy):
    rows = energy([(1, "mall", None, 5.0), (2, "mall", True, 2.0), (3, "mall", False, 4.0)])
    assert rows_of(energy_analytics(rows)) == [("2024-06-18 16:00:00", 2.0, 4.0, 0.5)]


def test_only_null_values_on_one_side(energy):
    rows = energy([(1, "hydro", True, None), (2, "hydro", True, None)])
    assert rows_of(energy_analytics(rows)) == [("2024-06-18 16:00:00", None, 0.0, None)]


def test_no_consumption_gives_no_ratio(energy):
    assert energy_analytics(energy([(1, "hydro", True, 3.0)])).first().ratio is None


def test_bucket_edge_starts_the_next_bucket(energy):
    rows = energy([(29, "a", True, 1.0), (30, "a", True, 2.0), (39, "a", True, 4.0)])
    assert [r[:2] for r in rows_of(energy_analytics(rows), "hour_group")] == [
        ("2024-06-18 16:20:00", 1.0),
        ("2024-06-18 16:30:00", 6.0),
    ]


def test_rows_without_time_fall_in_no_bucket(energy):
    rows = energy([(None, "a", True, 1.0), (5, "a", True, 2.0)])
    assert energy_analytics(rows).first().kwh_prod == 2.0
    assert energy_window(rows).count() == 1


@pytest.mark.parametrize(
    "temp,dew,label",
    [(10.0, 10.0, "Rain"), (9.0, 10.0, "Rain"), (11.0, 10.0, "No Rain"), (None, 10.0, "No Rain")],
)
def test_rain_label(weather, temp, dew, label):
    assert weather_window(weather([(1, "mall", temp, dew)])).first().raining_prob == label


def test_zero_temperature(energy, weather):
    rows = energy([(1, "a", False, 5.0), (1, "b", True, 5.0), (1, "c", False, -1.0)])
    cold = weather([(2, p, 0.0, 0.0) for p in "abc"])
    got = {r.place: r.kwh_cons_degree for r in energy_weather_wide(rows, cold).collect()}
    assert got["a"] == math.inf and math.isnan(got["b"]) and got["c"] == -math.inf
    safe = energy_weather_wide(rows, cold, null_on_zero=True)
    assert {r.kwh_cons_degree for r in safe.collect()} == {None}


def test_ieee_division(spark):
    nan = float("nan")
    pairs = [(1.0, 0.0), (-1.0, 0.0), (0.0, 0.0), (nan, 0.0), (None, 0.0), (1.0, None), (6.0, 4.0)]
    frame = spark.createDataFrame([(i, *p) for i, p in enumerate(pairs)], "i int, a double, b double")
    got = [
        r[0] for r in frame.orderBy("i").select(ieee_div(F.col("a"), F.col("b"))).collect()
    ]
    assert got[0] == math.inf and got[1] == -math.inf
    assert math.isnan(got[2]) and math.isnan(got[3])
    assert got[4:] == [None, None, 1.5]
    guarded = [
        r[0] for r in frame.orderBy("i").select(guarded_ratio(F.col("a"), F.col("b"))).collect()
    ]
    assert guarded == [None] * 6 + [1.5]


def test_null_place_is_summed_but_never_joined(energy, weather):
    rows = energy([(1, None, True, 1.0), (1, "mall", True, 2.0)])
    sky = weather([(1, None, 20.0, 10.0), (1, "mall", 20.0, 10.0)])
    assert energy_window(rows).count() == 2
    assert [r.place for r in energy_weather_wide(rows, sky).collect()] == ["mall"]


def test_production_splits_by_label(energy, weather):
    rows = energy([(1, "a", True, 3.0), (2, "a", True, 4.0), (1, "b", True, 5.0)])
    sky = weather([(1, "a", 5.0, 6.0), (1, "b", 7.0, 6.0)])
    got = rows_of(energy_weather_analytics(rows, sky), "place")
    assert got == [
        ("2024-06-18 16:00:00", "a", 0.0, 7.0, 0.0),
        ("2024-06-18 16:00:00", "b", 0.0, 0.0, 5.0),
    ]


def test_projection_equals_grouping_after_the_join(energy, weather):
    """One row per group after the join: its averages and sums are the row itself."""
    rows = energy([(m, p, m % 3 > 0, m * 1.5) for m in range(60) for p in "abc"])
    sky = weather([(m, p, 15.0 + m % 7, 16.0) for m in range(0, 60, 4) for p in "ab"])
    joined = start_stamped(energy_window(rows)).join(
        start_stamped(weather_window(sky)), ["window_start", "place"]
    )
    rain, made = F.col("raining_prob") == "Rain", F.col("kwh_prod")
    grouped = (
        joined.groupBy(F.col("window_start").alias("hour_group"), "place")
        .agg(
            (F.avg("kwh_cons") / F.avg("temp")).alias("degree"),
            F.sum(F.when(rain, made).otherwise(0)).alias("wet"),
            F.sum(F.when(~rain, made).otherwise(0)).alias("dry"),
            *[F.avg(c).alias(c) for c in ("temp", "dew_point", "uvi", "clouds")],
        )
    )
    order = ("hour_group", "place")
    assert rows_of(energy_weather_wide(rows, sky), *order) == rows_of(grouped, *order)


def test_production_is_split_without_rest(energy, weather):
    rows = energy([(m, p, m % 3 > 0, m * 0.5) for m in range(60) for p in "abc"])
    sky = weather([(m, p, 15.0 + m % 7, 16.0) for m in range(0, 60, 4) for p in "abc"])
    split = energy_weather_analytics(rows, sky).agg(
        F.sum("kwh_prod_with_rain_prob") + F.sum("kwh_prod_with_no_rain_prob")
    )
    made = energy_window(rows).join(weather_window(sky), ["window", "place"]).agg(F.sum("kwh_prod"))
    assert split.first()[0] == pytest.approx(made.first()[0])


def test_join_adds_no_shuffle(spark, energy, weather):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = energy_weather_wide(
            energy([(1, "a", True, 1.0)]), weather([(1, "a", 1.0, 1.0)])
        )
        plan = joined._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange hashpartitioning") == 2


def test_produced_plus_consumed_is_the_total(energy):
    rows = energy([(m, "abc"[m % 3], (True, False, None)[m % 5 % 3], m * 0.25) for m in range(60)])
    total = rows.filter("generation is not null").agg(F.sum("value")).first()[0]
    parts = energy_window(rows).agg(F.sum("kwh_prod") + F.sum("kwh_cons")).first()[0]
    assert parts == pytest.approx(total)


def test_point_tables_pass_rows_through(spark, energy, weather):
    records = energy([(1, "mall", True, 1.0), (1, "mall", True, 1.0), (None, "mall", True, 2.0)])
    points = point_data(records.withColumns({"id": F.lit("x"), "type_gen": F.lit("-")}))
    assert points.columns == ["time_stamp", "id", "place", "generation", "type_gen", "kwh"]
    assert points.count() == 2
    assert weather_data(weather([(1, "mall", 1.0, 2.0)])).columns == [
        "time_stamp", "place", "temp", "dew_point", "uvi", "clouds",
    ]
