"""DuckDB SQL for every named query, on the shared tables only."""

from __future__ import annotations

_SITE = "CASE user_id % 3 WHEN 0 THEN {0} WHEN 1 THEN {1} ELSE {2} END"
_PLACE = _SITE.format("'hydro'", "'solar'", "'mall'")

_VIEWS = f"""
energy_record AS (
  SELECT epoch_us(ts) // 1000 AS time_stamp,
         'GENERADOR ' || (user_id % 4 + 1)::VARCHAR AS id,
         value,
         {_PLACE} AS place,
         user_id % 3 <> 2 AS generation,
         {_SITE.format("'hydro'", "'solar'", "'-'")} AS type_gen,
         ts, event_id
  FROM events WHERE event_type IN ('click', 'view', 'purchase')),
weather_record AS (
  SELECT epoch_us(ts) // 1000 AS time_stamp,
         {_SITE.format("15.5", "14.5", "15.0")}::DOUBLE AS lat,
         {_SITE.format("-90.5", "-91.5", "-89.5")}::DOUBLE AS lon,
         {_PLACE} AS place,
         value / 10 AS temp,
         json_extract_string(props, '$.k')::DOUBLE / 5 AS dew_point,
         value / 100 AS uvi,
         json_extract_string(props, '$.k')::DOUBLE AS clouds,
         ts, event_id, event_type
  FROM events WHERE event_type IN ('signup', 'error')),
series_raw AS (
  SELECT CASE event_type WHEN 'view' THEN 'site_solar' WHEN 'purchase' THEN 'site_mall'
              ELSE 'site_hydro' END AS bucket,
         'MET0' || (user_id % 2 + 1)::VARCHAR AS _measurement,
         'MET0' || (user_id % 4 + 1)::VARCHAR AS "ID",
         CASE WHEN event_type = 'purchase' THEN 'kw_tot'
              WHEN event_type IN ('click', 'view') THEN 'kW_tot' ELSE 'V_avg' END AS _field,
         ts AS _time, value AS _value
  FROM events),
point_data AS (
  SELECT ts AS time_stamp, id, place, generation, type_gen, value AS kwh FROM energy_record),
weather_data AS (
  SELECT ts AS time_stamp, place, temp, dew_point, uvi, clouds FROM weather_record),
energy_bucketed AS (
  SELECT *, time_bucket(INTERVAL '10 minutes', ts, TIMESTAMP '1970-01-01') AS bucket
  FROM energy_record),
energy_window AS (
  SELECT bucket AS window_start, place,
         coalesce(sum(value) FILTER (generation), 0) AS kwh_prod,
         coalesce(sum(value) FILTER (NOT generation), 0) AS kwh_cons
  FROM energy_bucketed GROUP BY ALL),
weather_means AS (
  SELECT time_bucket(INTERVAL '10 minutes', ts, TIMESTAMP '1970-01-01') AS window_start, place,
         avg(temp) AS temp, avg(dew_point) AS dew_point, avg(uvi) AS uvi, avg(clouds) AS clouds
  FROM weather_record GROUP BY ALL),
weather_window AS (
  SELECT *, if(temp <= dew_point, 'Rain', 'No Rain') AS raining_prob FROM weather_means),
energy_sums AS (
  SELECT bucket AS hour_group,
         coalesce(sum(value) FILTER (generation), 0) AS kwh_prod,
         coalesce(sum(value) FILTER (NOT generation), 0) AS kwh_cons
  FROM energy_bucketed GROUP BY ALL),
energy_analytics AS (
  SELECT *, kwh_prod / nullif(kwh_cons, 0) AS ratio FROM energy_sums),
energy_weather_wide AS (
  SELECT window_start AS hour_group, place, kwh_cons / temp AS kwh_cons_degree,
         if(raining_prob = 'Rain', kwh_prod, 0) AS kwh_prod_with_rain_prob,
         if(raining_prob = 'Rain', 0, kwh_prod) AS kwh_prod_with_no_rain_prob,
         temp, dew_point, uvi, clouds
  FROM energy_window JOIN weather_window USING (window_start, place)),
energy_weather_analytics AS (
  SELECT hour_group, place, kwh_cons_degree, kwh_prod_with_rain_prob, kwh_prod_with_no_rain_prob
  FROM energy_weather_wide)
"""


def _feed(site: str, field: str, days: int, every: str, by: str, where: str = "TRUE") -> str:
    """Readings of one site: windowed mean, then the newest per group."""
    return f"""
  SELECT *, row_number() OVER (PARTITION BY {by} ORDER BY _time DESC, "ID" DESC) AS rn FROM (
    SELECT bucket, _measurement, "ID", _field,
           least(time_bucket(INTERVAL '{every}', _time, TIMESTAMP '1970-01-01')
                 + INTERVAL '{every}', TIMESTAMP '2024-01-31') AS _time,
           avg(_value) AS _value
    FROM series_raw
    WHERE bucket = '{site}' AND _field = '{field}' AND {where}
      AND _time >= TIMESTAMP '2024-01-31' - INTERVAL '{days} days'
      AND _time < TIMESTAMP '2024-01-31'
    GROUP BY bucket, _measurement, "ID", _field,
             time_bucket(INTERVAL '{every}', _time, TIMESTAMP '1970-01-01'))"""


_HYDRO = _feed("site_hydro", "kW_tot", 7, "31 minutes", "_measurement")
_SOLAR = _feed(
    "site_solar",
    "kW_tot",
    20,
    "1 second",
    "_measurement",
    "_measurement = 'MET01' AND \"ID\" = 'MET01'",
)
_MALL = _feed("site_mall", "kw_tot", 1, "5 minutes", 'bucket, _measurement, "ID", _field')

_BOUNDS = "TIMESTAMP '2024-01-24' AS _start, TIMESTAMP '2024-01-31' AS _stop"

_LATEST_WEATHER = """
  SELECT time_stamp, round(temp, 6) AS temperature, round(dew_point, 6) AS dewpoint,
         round(uvi, 6) AS uvi, round(clouds, 6) AS clouds
  FROM weather_data WHERE place = '{0}' ORDER BY time_stamp DESC LIMIT 1"""

_ENERGY_WEATHER = """
  SELECT hour_group, place, round(kwh_cons_degree, 6) AS kwh_cons_degree,
         round(kwh_prod_with_rain_prob, 6) AS kwh_prod_with_rain_prob,
         round(kwh_prod_with_no_rain_prob, 6) AS kwh_prod_with_no_rain_prob"""

_WEATHER_COLUMNS = """round(temp, 6) AS temp, round(dew_point, 6) AS dew_point,
         round(uvi, 6) AS uvi, round(clouds, 6) AS clouds"""

_POINTS = """
  SELECT date_trunc('milliseconds', time_stamp) AS time_stamp, id, place, generation, type_gen,
         round(kwh, 6) AS kwh"""

_ANALYTICS = """
  SELECT hour_group, round(kwh_prod, 6) AS kwh_prod, round(kwh_cons, 6) AS kwh_cons,
         round(ratio, 6) AS ratio
  FROM energy_analytics"""

# The messages of the accounting query, with the key parts as decoded.
_ACCOUNTED = """
  SELECT date_trunc('milliseconds', ts) AS ts, if(event_id % 7 = 0, NULL, place) AS place, id
  FROM energy_record
  UNION ALL
  SELECT date_trunc('milliseconds', ts), place, id
  FROM energy_record WHERE event_id % 11 = 0 AND event_id % 7 <> 0"""

_STATEMENTS = {
    "encode_energy": """
  SELECT '{"time_stamp":' || time_stamp::VARCHAR || ',"id":"' || id || '","value":'
         || value::VARCHAR || ',"place":"' || place || '","generation":' || generation::VARCHAR
         || ',"type_gen":"' || type_gen || '"}' AS value
  FROM energy_record""",
    "encode_weather": """
  SELECT '{"time_stamp":' || time_stamp::VARCHAR || ',"lat":' || lat::VARCHAR || ',"lon":'
         || lon::VARCHAR || ',"place":"' || place || '","temp":' || temp::VARCHAR
         || ',"dew_point":' || dew_point::VARCHAR || ',"uvi":'
         || replace(regexp_replace(uvi::VARCHAR, '^0\\.000(\\d)(\\d*)$', '\\1.\\2E-4'), '.E', '.0E')
         || ',"clouds":' || clouds::VARCHAR || '}' AS value
  FROM weather_record""",
    "decode_energy": """
  SELECT time_stamp, id, round(value, 6) AS value, place, generation, type_gen,
         date_trunc('milliseconds', ts) AS ts
  FROM energy_record""",
    "decode_weather": f"""
  SELECT time_stamp, round(lat, 6) AS lat, round(lon, 6) AS lon, place, {_WEATHER_COLUMNS},
         date_trunc('milliseconds', ts) AS ts
  FROM weather_record""",
    "decode_rejects": """
  SELECT CASE WHEN json_valid(message) THEN 'no_event_time' ELSE 'malformed' END AS reason,
         count(*) AS messages
  FROM (SELECT props AS message FROM events UNION ALL SELECT event_type FROM events)
  GROUP BY 1""",
    "flatten_weather": f"""
  SELECT round(lat, 6) AS lat, round(lon, 6) AS lon, place, {_WEATHER_COLUMNS}, event_id
  FROM weather_record WHERE event_type = 'signup'""",
    "relay_json": """
  SELECT event_id, if(json_valid(message), message, NULL) AS value
  FROM (SELECT event_id, unnest([props, ' ' || props || '  ', event_type]) AS message FROM events)""",
    "relay_json_canonical": """
  SELECT event_id, '{"k":' || json_extract_string(props, '$.k') || '.5,"n":"xéñ"}' AS value
  FROM events""",
    "relay_json_hook": """
  SELECT event_id, '{"k": ' || json_extract_string(props, '$.k') || ', "relayed": true}' AS value
  FROM events""",
    "series_range": f"""
  SELECT bucket, _measurement, "ID", _field, _time, round(_value, 6) AS _value, {_BOUNDS}
  FROM series_raw
  WHERE bucket = 'site_hydro' AND _field = 'kW_tot'
    AND _time >= TIMESTAMP '2024-01-24' AND _time < TIMESTAMP '2024-01-31'""",
    "series_window_mean": f"""
  SELECT bucket, _measurement, "ID", _field, {_BOUNDS}, _time, round(_value, 6) AS _value
  FROM ({_HYDRO})""",
    "series_last": f"""
  SELECT bucket, _measurement, "ID", _field, {_BOUNDS}, _time, round(_value, 6) AS _value
  FROM ({_HYDRO}) WHERE rn = 1""",
    "site_readings_hydro": f"""
  SELECT bucket, _measurement, "ID", _time, round(_value, 6) AS _value,
         'hydro' AS place, TRUE AS generation, 'hydro' AS type_gen
  FROM ({_HYDRO}) WHERE rn = 1""",
    "site_readings_solar": f"""
  SELECT bucket, _measurement, "ID", _field, TIMESTAMP '2024-01-11' AS _start,
         TIMESTAMP '2024-01-31' AS _stop, round(_value, 6) AS _value,
         'solar' AS place, TRUE AS generation, 'solar' AS type_gen
  FROM ({_SOLAR}) WHERE rn = 1""",
    "site_readings_mall": f"""
  SELECT bucket, _measurement, "ID", _time, round(_value, 6) AS _value,
         'mall' AS place, FALSE AS generation, '-' AS type_gen
  FROM ({_MALL}) WHERE rn = 1""",
    "energy_feed": f"""
  SELECT epoch_ms(TIMESTAMP '2024-01-31') AS time_stamp, "ID" AS id, round(_value, 6) AS value,
         place, generation, type_gen, TIMESTAMP '2024-01-31' AS ts
  FROM (SELECT *, 'hydro' AS place, TRUE AS generation, 'hydro' AS type_gen FROM ({_HYDRO})
        UNION ALL
        SELECT *, 'solar', TRUE, 'solar' FROM ({_SOLAR})
        UNION ALL
        SELECT *, 'mall', FALSE, '-' FROM ({_MALL}))
  WHERE rn = 1""",
    "point_data": """
  SELECT time_stamp, id, place, generation, type_gen, round(kwh, 6) AS kwh FROM point_data""",
    "weather_data": f"SELECT time_stamp, place, {_WEATHER_COLUMNS} FROM weather_data",
    "energy_analytics": """
  SELECT hour_group, round(kwh_prod, 6) AS kwh_prod, round(kwh_cons, 6) AS kwh_cons,
         round(ratio, 6) AS ratio
  FROM energy_analytics""",
    "energy_window": """
  SELECT window_start, place, round(kwh_prod, 6) AS kwh_prod, round(kwh_cons, 6) AS kwh_cons
  FROM energy_window""",
    "weather_window": f"""
  SELECT window_start, place, raining_prob, {_WEATHER_COLUMNS} FROM weather_window""",
    "energy_weather_wide": f"{_ENERGY_WEATHER}, {_WEATHER_COLUMNS} FROM energy_weather_wide",
    "energy_weather_analytics": f"{_ENERGY_WEATHER} FROM energy_weather_analytics",
    "latest_by_key": """
  SELECT time_stamp, id, round(value, 6) AS value, place, generation, type_gen, ts, event_id
  FROM (SELECT *, row_number() OVER (PARTITION BY place, id ORDER BY event_id DESC) AS rn
        FROM energy_record)
  WHERE rn = 1""",
    "last_not_null": """
  SELECT round(arg_max(kwh_prod, hour_group) FILTER (WHERE kwh_prod IS NOT NULL), 6) AS kwh_prod,
         round(arg_max(kwh_cons, hour_group) FILTER (WHERE kwh_cons IS NOT NULL), 6) AS kwh_cons,
         round(arg_max(ratio, hour_group) FILTER (WHERE ratio IS NOT NULL), 6) AS ratio
  FROM energy_analytics""",
    "recent_days": """
  SELECT time_stamp, round(kwh, 6) AS kwh
  FROM (SELECT *, dense_rank() OVER (ORDER BY time_stamp::DATE DESC) AS newest FROM point_data)
  WHERE newest <= 3 AND place = 'hydro' AND id = 'GENERADOR 2'""",
    "consumption_by_time": """
  SELECT time_stamp, round(sum(kwh), 6) AS sum FROM point_data
  WHERE NOT generation GROUP BY ALL""",
    "latest_weather_hydro": _LATEST_WEATHER.format("hydro"),
    "latest_weather_mall": _LATEST_WEATHER.format("mall"),
    "recent_balance": """
  SELECT hour_group, round(kwh_prod, 6) AS produced, round(kwh_cons, 6) AS consumed
  FROM energy_analytics ORDER BY hour_group DESC LIMIT 3""",
    "avg_per_degree": """
  SELECT round(avg(kwh_cons_degree), 6) AS kwh_consumed_per_degree
  FROM energy_weather_analytics""",
    "avg_by_rain": """
  SELECT round(avg(kwh_prod_with_rain_prob), 6) AS kwh_prod_with_rain_prob,
         round(avg(kwh_prod_with_no_rain_prob), 6) AS kwh_prod_with_no_rain_prob
  FROM energy_weather_analytics""",
    "latest_ratio": """
  SELECT hour_group, round(ratio, 6) AS ratio
  FROM energy_analytics ORDER BY hour_group DESC LIMIT 1""",
    # Joined row by row and averaged afterwards.
    "hourly_profile": """
  SELECT hour::DOUBLE AS hour,
         round(avg(temp), 8) AS temp, round(avg(dew_point), 8) AS dew_point,
         round(avg(uvi), 8) AS uvi, round(avg(clouds), 8) AS clouds,
         round(avg(kwh_prod), 8) AS kwh_production, round(avg(kwh_cons), 8) AS kwh_consumed
  FROM (SELECT *, hour(time_stamp) AS hour FROM weather_data WHERE place = 'mall')
  JOIN (SELECT *, hour(hour_group) AS hour FROM energy_analytics) USING (hour)
  GROUP BY ALL""",
    "daily_change": """
  SELECT day::TIMESTAMP AS current_day,
         round(used, 6) AS current_kwh_consumed, round(used_before, 6) AS previous_kwh_consumed,
         round(used - used_before, 6) AS consumption_difference,
         if(used > used_before, 'INCREASE', 'DECREASE') AS consumption_difference_label,
         round(made, 6) AS current_kwh_produced, round(made_before, 6) AS previous_kwh_produced,
         round(made - made_before, 6) AS production_difference,
         if(made > made_before, 'INCREASE', 'DECREASE') AS production_difference_label
  FROM (SELECT *,
               if(lag(day) OVER days = day - 1, lag(used) OVER days, NULL) AS used_before,
               if(lag(day) OVER days = day - 1, lag(made) OVER days, NULL) AS made_before
        FROM (SELECT hour_group::DATE AS day, sum(kwh_cons) AS used, sum(kwh_prod) AS made
              FROM energy_analytics GROUP BY ALL)
        WINDOW days AS (ORDER BY day))""",
    "generator_ids": """
  SELECT DISTINCT id FROM point_data WHERE place = 'hydro'""",
    "batch_upsert": f"""{_POINTS}
  FROM (SELECT ts AS time_stamp, *, value AS kwh,
               row_number() OVER (PARTITION BY date_trunc('milliseconds', ts), place, id
                                  ORDER BY arrival DESC) AS rn
        FROM (SELECT *, event_id AS arrival FROM energy_record WHERE event_id % 5 <> 0
              UNION ALL
              SELECT * REPLACE (value + 1 AS value), event_id + 1000000000 AS arrival
              FROM energy_record WHERE event_id % 3 = 0 OR event_id % 5 = 0))
  WHERE rn = 1""",
    "batch_upsert_buckets": _ANALYTICS,
    "batch_reload": f"{_ENERGY_WEATHER} FROM energy_weather_analytics",
    "batch_reload_points": f"{_POINTS} FROM point_data",
    "batch_accounting": f"""
  , accounted AS ({_ACCOUNTED}),
  conditions AS (
    SELECT date_trunc('milliseconds', ts) AS ts, if(event_id % 7 = 0, NULL, place) AS place FROM weather_record),
  counted AS (
    SELECT count(*) AS records, count(*) FILTER (place IS NULL) AS keyless,
           (SELECT count(*) FROM (SELECT DISTINCT ts, place, id FROM accounted WHERE place IS NOT NULL)) AS kept
    FROM accounted),
  measured AS (
    SELECT count(*) AS records_w, count(*) FILTER (place IS NULL) AS keyless_w,
           (SELECT count(*) FROM (SELECT DISTINCT ts, place FROM conditions WHERE place IS NOT NULL)) AS kept_w
    FROM conditions),
  other AS (
    SELECT count(*) FILTER (NOT json_valid(message)) AS malformed,
           count(*) FILTER (json_valid(message)) AS no_event_time
    FROM (SELECT props AS message FROM events UNION ALL SELECT event_type FROM events)),
  typed AS (
    SELECT count(*) FILTER (NOT json_valid(event_type)) AS malformed_w,
           count(*) FILTER (json_valid(event_type)) AS no_event_time_w FROM events)
  SELECT unnest(['energy_messages', 'energy_records', 'energy_malformed', 'energy_no_event_time',
                 'point_data_keyless', 'point_data_rows', 'point_data_repeated',
                 'weather_messages', 'weather_records', 'weather_malformed', 'weather_no_event_time',
                 'weather_data_keyless', 'weather_data_rows', 'weather_data_repeated']) AS item,
         unnest([records + malformed + no_event_time, records, malformed, no_event_time,
                 keyless, kept, records - keyless - kept,
                 records_w + malformed_w + no_event_time_w, records_w, malformed_w, no_event_time_w,
                 keyless_w, kept_w, records_w - keyless_w - kept_w]) AS messages
  FROM counted, measured, other, typed""",
    "serving_with_late_rows": """
  SELECT time_stamp, id, place, generation, type_gen, round(kwh, 6) AS kwh FROM point_data""",
    "stream_job": """
  SELECT 'point_data' AS table_name, count(*) AS rows, round(sum(kwh), 6) AS total
  FROM (SELECT arg_max(value, event_id) AS kwh FROM energy_record GROUP BY date_trunc('milliseconds', ts), place, id)
  UNION ALL
  SELECT 'weather_data', count(*), round(sum(figures), 6)
  FROM (SELECT arg_max(temp + dew_point + uvi + clouds, event_id) AS figures
        FROM weather_record GROUP BY date_trunc('milliseconds', ts), place)
  UNION ALL SELECT 'energy_analytics', count(*), round(sum(kwh_prod + kwh_cons), 6) FROM energy_analytics
  UNION ALL
  SELECT 'energy_weather_analytics', count(*), round(sum(kwh_prod_with_rain_prob + kwh_prod_with_no_rain_prob), 6)
  FROM energy_weather_analytics""",
    "stream_point_data": f"{_POINTS} FROM point_data",
    "stream_weather_data": f"""
  SELECT date_trunc('milliseconds', time_stamp) AS time_stamp, place, {_WEATHER_COLUMNS}
  FROM weather_data""",
    "stream_energy_analytics": _ANALYTICS,
    "stream_energy_weather": f"{_ENERGY_WEATHER} FROM energy_weather_analytics",
}

# The series as read from the store's own format, and kept on a stream.
_STATEMENTS["series_from_annotated"] = _STATEMENTS["series_range"]
_STATEMENTS["stream_series_last"] = _STATEMENTS["series_last"]

# Questions in SQL, with other arguments than the defaults.
_STATEMENTS["sql_recent_days"] = _STATEMENTS["recent_days"].replace("GENERADOR 2", "GENERADOR 3")
_STATEMENTS["sql_latest_weather"] = _LATEST_WEATHER.format("solar")
_STATEMENTS["sql_hourly_profile"] = _STATEMENTS["hourly_profile"].replace("'mall'", "'solar'").replace(", 8)", ", 10)")
_STATEMENTS["sql_daily_change"] = _STATEMENTS["daily_change"]

# The same questions asked of stored tables.
_STATEMENTS["serving_recent_days"] = _STATEMENTS["recent_days"]
_STATEMENTS["serving_latest_weather"] = _STATEMENTS["latest_weather_mall"]
_STATEMENTS["serving_recent_balance"] = _STATEMENTS["recent_balance"]


def all_oracles() -> dict[str, str]:
    return {name: f"WITH {_VIEWS} {body}" for name, body in _STATEMENTS.items()}
