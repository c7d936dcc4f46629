"""Energy, weather and series inputs read out of the shared ``events`` table.

``events`` = event_id, ts, user_id, event_type, value, props (``{"k": n}``).
The same mapping is written in SQL in :mod:`gridsky.registry.oracles`.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DoubleType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

EVENTS = StructType(
    [
        StructField("event_id", LongType()),
        StructField("ts", TimestampNTZType()),
        StructField("user_id", LongType()),
        StructField("event_type", StringType()),
        StructField("value", DoubleType()),
        StructField("props", StringType()),
    ]
)

# Coordinates of the three sites; any will do.
COORDINATES = {"mall": (15.0, -89.5), "solar": (14.5, -91.5), "hydro": (15.5, -90.5)}

# The day of the rows that end a stream, after all others.
SENTINEL_DAY = "2100-01-01"


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = spark.read.schema(EVENTS).parquet(f"{sf_dir}/events.parquet")
    return table.withColumn("ts", F.col("ts").cast("timestamp"))


def events_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The glob matches the table whether it is one file or a folder of parts; a
    # stream over a plain path must be a folder.
    return events_stream_at(spark, f"{sf_dir}/events.parque[t]")


def events_stream_at(spark: SparkSession, path: str) -> DataFrame:
    table = spark.readStream.schema(EVENTS).parquet(path)
    return table.withColumn("ts", F.col("ts").cast("timestamp"))


def sentinels(spark: SparkSession) -> DataFrame:
    """One energy and one weather event far in the future."""
    at = datetime.fromisoformat(SENTINEL_DAY)
    rows = [(-1, at, 0, "click", 0.0, '{"k": 0}'), (-2, at, 0, "signup", 0.0, '{"k": 0}')]
    return spark.createDataFrame(rows, EVENTS).coalesce(1)


def _by_site(hydro: object, solar: object, mall: object) -> str:
    return f"CASE user_id % 3 WHEN 0 THEN {hydro} WHEN 1 THEN {solar} ELSE {mall} END"


_PLACE = _by_site("'hydro'", "'solar'", "'mall'")
_LAT, _LON = (
    _by_site(*[f"{COORDINATES[p][axis]}D" for p in ("hydro", "solar", "mall")]) for axis in (0, 1)
)


def energy_record(events: DataFrame) -> DataFrame:
    return events.filter("event_type IN ('click', 'view', 'purchase')").selectExpr(
        "unix_millis(ts) AS time_stamp",
        "concat('GENERADOR ', user_id % 4 + 1) AS id",
        "value",
        f"{_PLACE} AS place",
        "user_id % 3 <> 2 AS generation",
        f"""{_by_site("'hydro'", "'solar'", "'-'")} AS type_gen""",
        "ts",
        "event_id",
    )


def weather_record(events: DataFrame) -> DataFrame:
    # k is a column of its own: used twice, Spark does not parse it twice.
    parsed = events.filter("event_type IN ('signup', 'error')").selectExpr(
        "*", "cast(get_json_object(props, '$.k') AS double) AS k"
    )
    return parsed.selectExpr(
        "unix_millis(ts) AS time_stamp",
        f"{_LAT} AS lat",
        f"{_LON} AS lon",
        f"{_PLACE} AS place",
        "value / 10 AS temp",
        "k / 5 AS dew_point",
        "value / 100 AS uvi",
        "k AS clouds",
        "ts",
        "event_id",
        "event_type",
    )


def series_raw(events: DataFrame) -> DataFrame:
    return events.selectExpr(
        """CASE event_type WHEN 'view' THEN 'site_solar' WHEN 'purchase' THEN 'site_mall'
           ELSE 'site_hydro' END AS bucket""",
        "concat('MET0', user_id % 2 + 1) AS _measurement",
        "concat('MET0', user_id % 4 + 1) AS ID",
        """CASE WHEN event_type = 'purchase' THEN 'kw_tot'
           WHEN event_type IN ('click', 'view') THEN 'kW_tot' ELSE 'V_avg' END AS _field""",
        "ts AS _time",
        "value AS _value",
    )


def weather_documents(events: DataFrame) -> DataFrame:
    """Service responses: a signup answered with 200, an error with 500."""
    return weather_record(events).selectExpr(
        "place",
        "if(event_type = 'signup', 200, 500) AS status",
        """to_json(named_struct('lat', lat, 'lon', lon, 'current',
             named_struct('temp', temp, 'dew_point', dew_point, 'uvi', uvi, 'clouds', clouds))) AS body""",
        "event_id",
    )


def float_millis() -> Column:
    """Epoch milliseconds with a fraction, the way the producer sends them."""
    return F.unix_micros("ts") / F.lit(1000.0)


def as_readings(energy: DataFrame) -> DataFrame:
    """Energy records under the names the encoder reads."""
    return energy.withColumnsRenamed({"id": "ID", "value": "_value"})
