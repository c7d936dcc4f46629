from __future__ import annotations

import pytest
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gridsky.plans import dashboard
from gridsky.schemas import ENERGY_ANALYTICS, ENERGY_WEATHER_ANALYTICS
from gridsky.sources.tables import read_serving, write_serving
from tests.conftest import rows_of


@pytest.fixture
def points(spark):
    return spark.createDataFrame(
        [
            (f"2024-06-{d:02d} {h:02d}:00:00", i, p, p != "mall", "-", float(d * h))
            for d in (10, 11, 13, 17, 18)
            for h in (0, 7, 23)
            for i, p in (("GENERADOR 1", "hydro"), ("GENERADOR 2", "hydro"), ("GENERADOR 2", "mall"))
            if not (d == 18 and p == "hydro")
        ],
        "t string, id string, place string, generation boolean, type_gen string, kwh double",
    ).selectExpr("cast(t as timestamp) as time_stamp", "id", "place", "generation", "type_gen", "kwh")


@pytest.fixture
def buckets(spark):
    """Two buckets a day; the 13th is missing, the 15th repeats the 14th."""
    rows = [
        (f"2024-06-{d:02d} {h}:10:00", 1.0 * v + h, 2.0 * v, None if d == 11 else 0.5)
        for d, v in ((10, 3), (11, 5), (12, 4), (14, 6), (15, 6))
        for h in (10, 15)
    ]
    return spark.createDataFrame(
        rows, "t string, kwh_prod double, kwh_cons double, ratio double"
    ).selectExpr("cast(t as timestamp) as hour_group", "kwh_prod", "kwh_cons", "ratio")


def _by_membership(points):
    """The question as first stated: the row's day is among the newest three."""
    days = dashboard.newest_days(points).withColumnRenamed("day", "newest")
    mine = points.filter("place = 'hydro' AND id = 'GENERADOR 2'")
    kept = mine.join(days, F.to_date("time_stamp") == F.col("newest"), "left_semi")
    return kept.select("time_stamp", "kwh").orderBy(F.desc("time_stamp"))


def test_recent_days_counts_days_of_all_places(points):
    got = rows_of(dashboard.recent_days(points))
    # The newest three days are 13, 17 and 18; the plant has nothing on the 18th.
    assert [r[0][:10] for r in got] == ["2024-06-17"] * 3 + ["2024-06-13"] * 3
    assert got == sorted(got, reverse=True)
    assert got == rows_of(_by_membership(points))


def test_recent_days_binds_its_parameter(points):
    assert dashboard.recent_days(points, "x' OR '1'='1").count() == 0
    assert dashboard.recent_days(points, "GENERADOR 1", days=5).count() == 12


def test_recent_days_of_an_empty_table(points):
    assert dashboard.recent_days(points.limit(0)).count() == 0


def test_recent_days_prunes_folders(spark, points, tmp_path):
    path = str(tmp_path / "point_data")
    write_serving(points, path, "point_data")
    stored = read_serving(spark, path, "point_data")
    recent = dashboard.recent_days(stored)
    assert rows_of(recent) == rows_of(_by_membership(points))
    recent.collect()
    plan = recent._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan and "(day" in plan.split("PartitionFilters")[1]


def test_consumption_skips_producers_and_unknown(spark, points):
    got = rows_of(dashboard.consumption_by_time(points.withColumn("generation", F.expr(
        "CASE WHEN day(time_stamp) = 10 THEN NULL ELSE generation END"))))
    assert len(got) == 12 and got == sorted(got, reverse=True)


def test_latest_weather_is_the_newest(spark):
    rows = spark.createDataFrame(
        [("2024-01-01", "mall", 1.0), ("2024-01-03", "mall", 3.0), ("2024-01-04", "hydro", 4.0)],
        "t string, place string, temp double",
    ).selectExpr("cast(t as timestamp) as time_stamp", "place", "temp",
                 "0D as dew_point", "0D as uvi", "0D as clouds")
    got = dashboard.latest_weather(rows, "mall")
    assert got.columns == ["time_stamp", "temperature", "dewpoint", "uvi", "clouds"]
    assert got.first().temperature == 3.0


def test_newest_buckets(buckets):
    assert [r[0] for r in rows_of(dashboard.recent_balance(buckets))] == [
        "2024-06-15 15:10:00", "2024-06-15 10:10:00", "2024-06-14 15:10:00",
    ]
    assert rows_of(dashboard.latest_ratio(buckets)) == [("2024-06-15 15:10:00", 0.5)]


def test_newest_rows_of_a_partitioned_table(spark, buckets, tmp_path):
    path = str(tmp_path / "energy_analytics")
    # The newest day has one bucket: the other two are of the day before.
    short = buckets.filter("hour_group <> '2024-06-15 15:10:00'")
    write_serving(short, path, "energy_analytics")
    stored = read_serving(spark, path, "energy_analytics")
    for ask in (dashboard.recent_balance, dashboard.latest_ratio):
        got = ask(stored)
        assert got.columns == ask(short).columns
        assert rows_of(got) == rows_of(ask(short))
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert "(day" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_averages_over_nothing_are_one_row(spark):
    empty = spark.createDataFrame([], ENERGY_WEATHER_ANALYTICS)
    assert rows_of(dashboard.avg_per_degree(empty)) == [(None,)]
    assert rows_of(dashboard.avg_by_rain(empty)) == [(None, None)]
    assert dashboard.daily_change(spark.createDataFrame([], ENERGY_ANALYTICS)).count() == 0


def test_daily_change_labels_and_gap(buckets):
    change = dashboard.daily_change(buckets).withColumn("day", F.day("current_day"))
    got = {r.day: r for r in change.collect()}
    assert list(got) == [10, 11, 12, 14, 15]
    first, up, down, gap, same = got.values()
    assert (first.previous_kwh_consumed, first.consumption_difference_label) == (None, "DECREASE")
    assert (up.consumption_difference, up.consumption_difference_label) == (8.0, "INCREASE")
    assert (down.production_difference, down.production_difference_label) == (-2.0, "DECREASE")
    assert (gap.consumption_difference, gap.production_difference_label) == (None, "DECREASE")
    assert (same.consumption_difference, same.consumption_difference_label) == (0.0, "DECREASE")


def test_daily_change_equals_lag_with_a_gap_check(buckets):
    daily = buckets.groupBy(F.date_trunc("day", "hour_group").alias("day")).agg(
        F.sum("kwh_cons").alias("used")
    )
    w = W.orderBy("day")
    lagged = daily.select(
        "day",
        F.when(
            F.lag("day").over(w) + F.expr("interval 1 day") == F.col("day"), F.lag("used").over(w)
        ).alias("previous"),
    )
    got = dashboard.daily_change(buckets).select("current_day", "previous_kwh_consumed")
    assert rows_of(got) == rows_of(lagged, "day")


def test_daily_totals_are_computed_once(spark, buckets, tmp_path):
    path = str(tmp_path / "t")
    buckets.write.parquet(path)
    change = dashboard.daily_change(spark.read.schema(ENERGY_ANALYTICS).parquet(path))
    change.collect()
    assert "ReusedExchange" in change._jdf.queryExecution().executedPlan().toString()


def test_hourly_profile_equals_the_join_as_stated(spark, buckets):
    sky = spark.createDataFrame(
        [
            (f"2024-06-{d} {h}:{m}:00", p, None if m == 20 else d + h / 4, 1.0 * m, 2.0, 3.0 * d)
            for d in (10, 11, 12) for h in (10, 12, 15) for m in (10, 20, 45)
            for p in ("mall", "hydro")
        ],
        "t string, place string, temp double, dew_point double, uvi double, clouds double",
    ).withColumn("time_stamp", F.col("t").cast("timestamp"))
    pairs = sky.filter("place = 'mall'").join(
        buckets, F.hour("time_stamp") == F.hour("hour_group")
    )
    stated = pairs.groupBy(F.hour("time_stamp").cast("double").alias("hour")).agg(
        *[F.avg(c) for c in ("temp", "dew_point", "uvi", "clouds", "kwh_prod", "kwh_cons")]
    )
    got = rows_of(dashboard.hourly_profile(sky, buckets), "hour")
    want = rows_of(stated, "hour")
    assert [r[0] for r in got] == [10.0, 15.0]
    for a, b in zip(got, want, strict=True):
        assert a == pytest.approx(b)


def test_generator_choices_descend(points):
    assert rows_of(dashboard.generator_ids(points)) == [("GENERADOR 2",), ("GENERADOR 1",)]
