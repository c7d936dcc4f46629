"""The dashboard's questions as SQL table functions with bound arguments.

``register_questions`` declares them over the views that ``register_serving`` names; they are then
asked as ``SELECT * FROM recent_days('GENERADOR 2')``. An argument is a value, never a piece of SQL text.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import SparkSession

from gridsky.plans.dashboard import DECREASE, DEFAULT_GENERATOR, INCREASE


@dataclass(frozen=True)
class Question:
    """Arguments, result columns and body of a table function."""

    arguments: str
    columns: str
    body: str


def _newest(table: str, time: str, rows: int) -> str:
    """The newest rows lie on as many of the newest days as there are rows, so older folders are not read."""
    return (
        f"(SELECT * FROM {table} WHERE day >= (SELECT min(day) FROM (SELECT DISTINCT day FROM {table} ORDER BY day DESC LIMIT {rows}))"
        f" ORDER BY {time} DESC LIMIT {rows})"
    )


def _change(column: str) -> str:
    return f"""c.{column} AS current_kwh_{column}, p.{column} AS previous_kwh_{column},
  c.{column} - p.{column} AS {{0}}_difference,
  CASE WHEN c.{column} - p.{column} > 0 THEN '{INCREASE}' ELSE '{DECREASE}' END AS {{0}}_difference_label"""


_DAILY = """(SELECT date_trunc('day', hour_group) AS day, sum(kwh_cons) AS consumed, sum(kwh_prod) AS produced
  FROM energy_analytics WHERE hour_group IS NOT NULL GROUP BY 1)"""

_CONDITIONS = ("temp", "dew_point", "uvi", "clouds")

QUESTIONS = {
    "recent_days": Question(
        f"generator STRING DEFAULT '{DEFAULT_GENERATOR}'",
        "time_stamp TIMESTAMP, kwh DOUBLE",
        """SELECT time_stamp, kwh FROM point_data
WHERE day >= (SELECT min(day) FROM (SELECT DISTINCT day FROM point_data ORDER BY day DESC LIMIT 3))
  AND place = 'hydro' AND id = recent_days.generator""",
    ),
    "consumption_by_time": Question(
        "", "time_stamp TIMESTAMP, sum DOUBLE", "SELECT time_stamp, sum(kwh) AS sum FROM point_data WHERE NOT generation GROUP BY time_stamp"
    ),
    "latest_weather": Question(
        "site STRING",
        "time_stamp TIMESTAMP, temperature DOUBLE, dewpoint DOUBLE, uvi DOUBLE, clouds DOUBLE",
        """SELECT max(time_stamp), max_by(temp, time_stamp), max_by(dew_point, time_stamp), max_by(uvi, time_stamp), max_by(clouds, time_stamp)
FROM weather_data WHERE place = latest_weather.site HAVING count(*) > 0""",
    ),
    "recent_balance": Question(
        "",
        "hour_group TIMESTAMP, produced DOUBLE, consumed DOUBLE",
        f"SELECT hour_group, kwh_prod, kwh_cons FROM {_newest('energy_analytics', 'hour_group', 3)}",
    ),
    "latest_ratio": Question(
        "", "hour_group TIMESTAMP, ratio DOUBLE", f"SELECT hour_group, ratio FROM {_newest('energy_analytics', 'hour_group', 1)}"
    ),
    "avg_per_degree": Question(
        "", "kwh_consumed_per_degree DOUBLE", "SELECT avg(kwh_cons_degree) FROM energy_weather_analytics"
    ),
    "avg_by_rain": Question(
        "",
        "kwh_prod_with_rain_prob DOUBLE, kwh_prod_with_no_rain_prob DOUBLE",
        "SELECT avg(kwh_prod_with_rain_prob), avg(kwh_prod_with_no_rain_prob) FROM energy_weather_analytics",
    ),
    "hourly_profile": Question(
        "site STRING DEFAULT 'mall'",
        "hour DOUBLE, temp DOUBLE, dew_point DOUBLE, uvi DOUBLE, clouds DOUBLE, kwh_production DOUBLE, kwh_consumed DOUBLE",
        f"""SELECT cast(hour AS DOUBLE), {', '.join(_CONDITIONS)}, kwh_production, kwh_consumed
FROM (SELECT hour(time_stamp) AS hour, {', '.join(f'avg({c}) AS {c}' for c in _CONDITIONS)}
      FROM weather_data WHERE place = hourly_profile.site GROUP BY 1)
JOIN (SELECT hour(hour_group) AS hour, avg(kwh_prod) AS kwh_production, avg(kwh_cons) AS kwh_consumed
      FROM energy_analytics GROUP BY 1) USING (hour)""",
    ),
    "daily_change": Question(
        "",
        """current_day TIMESTAMP, current_kwh_consumed DOUBLE, previous_kwh_consumed DOUBLE, consumption_difference DOUBLE,
consumption_difference_label STRING, current_kwh_produced DOUBLE, previous_kwh_produced DOUBLE, production_difference DOUBLE,
production_difference_label STRING""",
        f"""SELECT c.day, {_change('consumed').format('consumption')},
  {_change('produced').format('production')}
FROM {_DAILY} c LEFT JOIN {_DAILY} p ON c.day - INTERVAL '1' DAY = p.day""",
    ),
    "generator_ids": Question(
        "site STRING DEFAULT 'hydro'", "id STRING", "SELECT DISTINCT id FROM point_data WHERE place = generator_ids.site"
    ),
    "newest_days": Question(
        "", "day DATE", "SELECT DISTINCT day FROM point_data WHERE day IS NOT NULL ORDER BY day DESC LIMIT 3"
    ),
}


def register_questions(spark: SparkSession) -> None:
    """Declare the questions for the session. Their rows come in no order: ORDER BY stands in the statement that asks."""
    for name, q in QUESTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({q.arguments}) RETURNS TABLE ({q.columns}) RETURN {q.body}")
