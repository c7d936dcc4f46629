"""The dashboard's questions over the serving tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridsky.functions.timing import calendar_day

# Default generator of the dashboard variable, trend labels.
DEFAULT_GENERATOR = "GENERADOR 2"
INCREASE = "INCREASE"
DECREASE = "DECREASE"


def newest_days(rows: DataFrame, count: int = 3, time: str = "time_stamp") -> DataFrame:
    """The newest calendar days with data, newest first, as ``day``."""
    day = F.col("day") if "day" in rows.columns else F.to_date(time)
    return (
        rows.select(day.alias("day"))
        .filter(F.col("day").isNotNull())
        .distinct()
        .orderBy(F.desc("day"))
        .limit(count)
    )


def _newest_rows(rows: DataFrame, time: str, count: int) -> DataFrame:
    """The ``count`` newest rows.

    Each day with data has a row, so they lie in the newest ``count`` days: on a
    day-partitioned table only those folders are read in full.
    """
    if "day" in rows.columns:
        oldest = newest_days(rows, count).agg(F.min("day"))
        rows = rows.filter(F.col("day") >= oldest.scalar()).drop("day")
    return rows.orderBy(F.desc(time)).limit(count)


def recent_days(
    point_data: DataFrame,
    generator: str = DEFAULT_GENERATOR,
    days: int = 3,
    known_days: DataFrame | None = None,
) -> DataFrame:
    """One generator's readings on the newest days of the whole table, newest first.

    Being on one of the newest days is the same as not being older than the
    oldest of them. Stated that way the membership test is a bound the scan can
    use: on a day-partitioned table only those days are read, elsewhere row
    groups are skipped by their time statistics. ``known_days`` are the days of a
    stored table, from its notes; without them they are found by reading it.
    """
    oldest = newest_days(point_data if known_days is None else known_days, days).agg(F.min("day").alias("day"))
    if "day" in point_data.columns:
        recent = F.col("day") >= oldest.scalar()
    else:
        recent = F.col("time_stamp") >= oldest.select(F.col("day").cast("timestamp")).scalar()
    return (
        point_data.filter(recent & (F.col("place") == "hydro") & (F.col("id") == F.lit(generator)))
        .select("time_stamp", "kwh")
        .orderBy(F.desc("time_stamp"))
    )


def consumption_by_time(point_data: DataFrame) -> DataFrame:
    """Total consumption at each instant, newest first."""
    return (
        point_data.filter(~F.col("generation"))
        .groupBy("time_stamp")
        .agg(F.sum("kwh").alias("sum"))
        .orderBy(F.desc("time_stamp"))
    )


def latest_weather(weather_data: DataFrame, place: str) -> DataFrame:
    """The last recorded conditions at a place."""
    recorded = weather_data.filter(F.col("place") == F.lit(place))
    return _newest_rows(recorded, "time_stamp", 1).select(
        "time_stamp",
        F.col("temp").alias("temperature"),
        F.col("dew_point").alias("dewpoint"),
        "uvi",
        "clouds",
    )


def latest_weather_stored(weather_data: DataFrame, known_days: DataFrame, place: str) -> DataFrame:
    """``latest_weather`` of a stored table: the newest day, then spans of twice as many, until the place is found.

    Most often that is one day's folder. A place that is found late, or never, costs a job for each doubling.
    """
    days = sorted((r.day for r in known_days.collect()), reverse=True)
    span = 1
    while days:
        newest, days, span = days[:span], days[span:], 2 * span
        own = weather_data.filter(F.col("day").between(F.lit(newest[-1]), F.lit(newest[0]))).drop("day")
        if not own.filter(F.col("place") == F.lit(place)).isEmpty():
            return latest_weather(own, place)
    return latest_weather(weather_data.drop("day").limit(0), place)


def recent_balance(energy_analytics: DataFrame) -> DataFrame:
    """Production and consumption of the three newest buckets."""
    return _newest_rows(energy_analytics, "hour_group", 3).select(
        "hour_group",
        F.col("kwh_prod").alias("produced"),
        F.col("kwh_cons").alias("consumed"),
    )


def latest_ratio(energy_analytics: DataFrame) -> DataFrame:
    """Coverage ratio of the newest bucket."""
    return _newest_rows(energy_analytics, "hour_group", 1).select("hour_group", "ratio")


def avg_per_degree(energy_weather: DataFrame) -> DataFrame:
    return energy_weather.agg(F.avg("kwh_cons_degree").alias("kwh_consumed_per_degree"))


def avg_by_rain(energy_weather: DataFrame) -> DataFrame:
    columns = ("kwh_prod_with_rain_prob", "kwh_prod_with_no_rain_prob")
    return energy_weather.agg(*[F.avg(c).alias(c) for c in columns])


def hourly_profile(
    weather_data: DataFrame, energy_analytics: DataFrame, place: str = "mall"
) -> DataFrame:
    """Average conditions at a place and average energy, by hour of the day.

    As stated, every weather row of an hour meets every bucket of that hour. Each
    side is then repeated equally often within the hour, which leaves its
    averages as they are, so both sides are averaged first and at most 24 rows
    meet 24.
    """
    weather = (
        weather_data.filter(F.col("place") == F.lit(place))
        .groupBy(F.hour("time_stamp").alias("hour"))
        .agg(*[F.avg(c).alias(c) for c in ("temp", "dew_point", "uvi", "clouds")])
    )
    energy = energy_analytics.groupBy(F.hour("hour_group").alias("hour")).agg(
        F.avg("kwh_prod").alias("kwh_production"), F.avg("kwh_cons").alias("kwh_consumed")
    )
    return weather.join(energy, "hour").withColumn("hour", F.col("hour").cast("double"))


def _trend(difference: Column) -> Column:
    # No previous day, or no change, counts as a decrease.
    return F.when(difference > 0, F.lit(INCREASE)).otherwise(F.lit(DECREASE))


def daily_change(energy_analytics: DataFrame) -> DataFrame:
    """Each day's totals against the day before, oldest first.

    The shift sits on the current side, so both sides of the join read the same
    plan and Spark computes the daily totals once.
    """
    daily = (
        energy_analytics.filter(F.col("hour_group").isNotNull())
        .groupBy(calendar_day("hour_group").alias("day"))
        .agg(F.sum("kwh_cons").alias("consumed"), F.sum("kwh_prod").alias("produced"))
        .filter(F.col("day").isNotNull())
    )
    day_before = F.col("current.day") - F.expr("INTERVAL '1' DAY")
    consumption = F.col("current.consumed") - F.col("previous.consumed")
    production = F.col("current.produced") - F.col("previous.produced")
    return (
        daily.alias("current")
        .join(daily.alias("previous"), day_before == F.col("previous.day"), "left")
        .select(
            F.col("current.day").alias("current_day"),
            F.col("current.consumed").alias("current_kwh_consumed"),
            F.col("previous.consumed").alias("previous_kwh_consumed"),
            consumption.alias("consumption_difference"),
            _trend(consumption).alias("consumption_difference_label"),
            F.col("current.produced").alias("current_kwh_produced"),
            F.col("previous.produced").alias("previous_kwh_produced"),
            production.alias("production_difference"),
            _trend(production).alias("production_difference_label"),
        )
        .orderBy("current_day")
    )


def generator_ids(point_data: DataFrame, place: str = "hydro") -> DataFrame:
    """The choices of the dashboard variable, in descending order."""
    return (
        point_data.filter(F.col("place") == F.lit(place))
        .select("id")
        .distinct()
        .orderBy(F.desc("id"))
    )
