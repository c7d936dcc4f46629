"""Landed inputs: weather responses and series readings, with declared schemas."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import DateType, StructField, StructType

from gridsky.schemas import SERIES, WEATHER_DOCUMENT


def read_weather_documents(spark: SparkSession, path: str, streaming: bool = False) -> DataFrame:
    """JSON lines of (place, status, body)."""
    reader = spark.readStream if streaming else spark.read
    return reader.schema(WEATHER_DOCUMENT).json(path)


def read_series(spark: SparkSession, path: str) -> DataFrame:
    """Parquet readings partitioned by ``day`` (the date of ``_time``)."""
    return spark.read.schema(
        StructType([*SERIES.fields, StructField("day", DateType())])
    ).parquet(path)
