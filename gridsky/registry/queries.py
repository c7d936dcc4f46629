"""Every operator and question as a named query over the shared tables.

The wrappers round doubles (sums depend on the order of addition) and give
times without zone; the operators do neither.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import replace
from datetime import datetime, timedelta
from functools import cached_property, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, TimestampType

from gridsky.operators import buckets, records
from gridsky.operators.decode import decode_energy, decode_weather
from gridsky.operators.encode import encode_energy, encode_weather
from gridsky.operators.keyed import last_not_null, latest_by_key
from gridsky.operators.relay import relay_json
from gridsky.operators.series import (
    SITES,
    Site,
    energy_feed,
    series_last,
    series_range,
    series_window_mean,
    site_readings,
)
from gridsky.operators.weather_docs import flatten_weather
from gridsky.plans import dashboard
from gridsky.functions.timing import WATERMARK
from gridsky.plans.job import job_tables
from gridsky.plans.questions import register_questions
from gridsky.registry import views
from gridsky.session import apply_runtime, fresh_dir, streaming_session
from gridsky.schemas import EVENT_TIME, KEYS, SERIES_KEY, SERVING
from gridsky.sources.annotated import annotated_rows, annotated_tables, read_answers, series_from_annotated
from gridsky.sources.commits import read_commit
from gridsky.sources.tables import (
    append_batch,
    publish_days,
    read_current,
    read_days,
    read_live,
    read_serving,
    register_serving,
    write_serving,
)
from gridsky.streaming.batch import fold_days
from gridsky.streaming.job import await_all, run_batch, start_job, start_tables
from gridsky.streaming.latest import LatestSink, read_latest, stream_latest
from gridsky.streaming.sinks import TableSink

Query = Callable[[SparkSession, str], DataFrame]

NOW = datetime(2024, 1, 31)
# The replays hold a few thousand buckets.
STATE_PARTITIONS = 4
# Arrivals of a later load.
LATER = 1_000_000_000
# Tables of one landed answer, which a task reads whole.
ANSWER_TABLES = 64
HYDRO, SOLAR, MALL = SITES
# Half an hour of the fixture holds one reading at most; a week makes a result.
HYDRO_WEEK = replace(HYDRO, lookback=timedelta(days=7))


def tidy(rows: DataFrame, digits: int = 6) -> DataFrame:
    shape = {DoubleType(): f"round(`{{0}}`, {digits})", TimestampType(): "cast(`{0}` AS timestamp_ntz)"}
    return rows.selectExpr(
        *[f"{shape.get(f.dataType, '`{0}`').format(f.name)} AS `{f.name}`" for f in rows.schema]
    )


class Tables:
    """The inputs of one call, as lazy frames."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.events = views.events(apply_runtime(spark), sf_dir)

    @cached_property
    def energy(self) -> DataFrame:
        return views.energy_record(self.events)

    @cached_property
    def weather(self) -> DataFrame:
        return views.weather_record(self.events)

    @cached_property
    def series(self) -> DataFrame:
        return views.series_raw(self.events)

    @cached_property
    def point_data(self) -> DataFrame:
        return records.point_data(self.energy)

    @cached_property
    def point_data_by_event(self) -> DataFrame:
        return records.point_data(self.energy, ("event_id",))

    @cached_property
    def weather_data(self) -> DataFrame:
        return records.weather_data(self.weather)

    @cached_property
    def energy_analytics(self) -> DataFrame:
        return buckets.energy_analytics(self.energy)

    @cached_property
    def energy_weather(self) -> DataFrame:
        return buckets.energy_weather_analytics(self.energy, self.weather)


def _over(build: Callable[[Tables], DataFrame], digits: int = 6) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return tidy(build(Tables(spark, sf_dir)), digits)

    return run


def _decoded_energy(t: Tables) -> DataFrame:
    sent = encode_energy(views.as_readings(t.energy), views.float_millis())
    return decode_energy(sent).records


def _decoded_weather(t: Tables) -> DataFrame:
    return decode_weather(encode_weather(t.weather, views.float_millis())).records


def _rejected(t: Tables) -> DataFrame:
    # props is JSON but no energy message: it has no event time. event_type is no JSON.
    messages = t.events.select(F.explode(F.array("props", "event_type")).alias("value"))
    return decode_energy(messages).rejected.groupBy("reason").agg(F.count("*").alias("messages"))


def _windowed(frame: DataFrame) -> DataFrame:
    return buckets.start_stamped(frame)


def _hydro_range(t: Tables) -> DataFrame:
    return series_range(t.series, NOW, HYDRO_WEEK.lookback, HYDRO.bucket, HYDRO.field)


def _hydro_means(t: Tables) -> DataFrame:
    return series_window_mean(_hydro_range(t), HYDRO.every)


def _energy_feed(t: Tables) -> DataFrame:
    return energy_feed(t.series, NOW, (HYDRO_WEEK, SOLAR, MALL))


def _sent_feed(t: Tables) -> DataFrame:
    millis = int((NOW - datetime(1970, 1, 1)).total_seconds()) * 1000
    return decode_energy(encode_energy(_energy_feed(t), F.lit(millis))).records


def _site(site: Site) -> Query:
    return _over(lambda t: site_readings(t.series, site, NOW))


def _served(table: str, ask: Callable[[DataFrame], DataFrame]) -> Query:
    """Write a serving table to the shared folder and ask the question of the stored one."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        path = fresh_dir(spark, table)
        write_serving(getattr(Tables(spark, sf_dir), table), path, table)
        return tidy(ask(read_serving(spark, path, table)))

    return run


def _served_newest(table: str, ask: Callable[[DataFrame, DataFrame], DataFrame]) -> Query:
    """As ``_served``, for questions that go by the notes on which days there are."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        path = fresh_dir(spark, table)
        write_serving(getattr(Tables(spark, sf_dir), table), path, table)
        return tidy(ask(read_serving(spark, path, table), read_days(spark, path)))

    return run


def _relayed(t: Tables) -> DataFrame:
    # Spaced JSON passes as it is; an event type is not JSON.
    sent = F.array("props", F.concat(F.lit(" "), F.col("props"), F.lit("  ")), "event_type")
    return relay_json(t.events.select("event_id", F.explode(sent).alias("value")), on_error="null")


def _relayed_canonical(t: Tables) -> DataFrame:
    k = F.get_json_object("props", "$.k")
    sent = F.concat(F.lit('{ "n" : "x\\u00e9ñ",  "k" :'), k, F.lit(".50 }"))
    return relay_json(t.events.select("event_id", sent.alias("value")), canonical=True)


def _relayed_with_hook(t: Tables) -> DataFrame:
    def mark(message):
        data = json.loads(message)
        data["relayed"] = True
        return json.dumps(data)

    return relay_json(t.events.select("event_id", F.col("props").alias("value")), mark)


def _arrived(records: DataFrame, offset: int = 0) -> DataFrame:
    """Records whose arrival is their event's number."""
    return records.withColumn("arrival", F.struct((F.col("event_id") + offset).alias("offset")))


def _energy_messages(energy: DataFrame, offset: int = 0) -> DataFrame:
    readings = views.as_readings(_arrived(energy, offset))
    return encode_energy(readings, views.float_millis(), carry=("arrival",))


def _weather_messages(weather: DataFrame) -> DataFrame:
    return encode_weather(_arrived(weather), views.float_millis(), carry=("arrival",))


def _stream_inputs(session: SparkSession, sf_dir: str, work: str) -> tuple[DataFrame, DataFrame]:
    """Energy and weather records as streams that end far in the future.

    The last rows move the watermark past every bucket with data.
    """
    views.sentinels(session).write.parquet(f"{work}/sentinels")
    events = views.events_stream(session, sf_dir).unionByName(
        views.events_stream_at(session, f"{work}/sentinels")
    )
    return views.energy_record(events), views.weather_record(events)


def _before_sentinels(rows: DataFrame, table: str) -> DataFrame:
    return rows.filter(F.col(EVENT_TIME[table]) < F.lit(views.SENTINEL_DAY).cast("timestamp"))


def _replay(table: str) -> Query:
    """Run one table of the job as a stream over ``events`` and read the result back.

    Records are encoded and decoded on the way, as if taken from a topic.
    """

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        session = streaming_session(apply_runtime(spark), STATE_PARTITIONS)
        work = fresh_dir(spark, table)
        energy, weather = _stream_inputs(session, sf_dir, work)
        carry = ("arrival",)
        tables = job_tables(
            decode_energy(_energy_messages(energy), carry).records,
            decode_weather(_weather_messages(weather), carry).records,
            carry,
        )
        sink = TableSink(f"{work}/live")
        running = start_tables(
            {table: tables[table]}, sink, f"{work}/checkpoints", available_now=True
        )
        await_all(running.values())
        return tidy(_before_sentinels(read_live(spark, sink.path(table), table), table).drop("day"))

    return run


def _stream_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All four tables in one job, each message parsed once: rows by table, and the total of their figures."""
    session = streaming_session(apply_runtime(spark), STATE_PARTITIONS)
    work = fresh_dir(spark, "job")
    energy, weather = _stream_inputs(session, sf_dir, work)
    sink = TableSink(f"{work}/live")
    running = start_job(
        _energy_messages(energy), _weather_messages(weather), sink, f"{work}/checkpoints", available_now=True
    )
    await_all(running.values())
    figures = {
        "point_data": "kwh",
        "weather_data": "temp + dew_point + uvi + clouds",
        "energy_analytics": "kwh_prod + kwh_cons",
        "energy_weather_analytics": "kwh_prod_with_rain_prob + kwh_prod_with_no_rain_prob",
    }
    counted = [
        _before_sentinels(read_live(spark, sink.path(t), t), t)
        .agg(F.count(F.lit(1)).alias("rows"), F.round(F.sum(F.expr(figures[t])), 6).alias("total"))
        .select(F.lit(t).alias("table_name"), "rows", "total")
        for t in KEYS
    ]
    return reduce(DataFrame.unionByName, counted)


def _batch_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two loads that share days and keys; the later one raises the values of what it repeats."""
    t = Tables(spark, sf_dir)
    out = fresh_dir(spark, "upsert")
    weather = _weather_messages(t.weather)
    run_batch(_energy_messages(t.energy.filter("event_id % 5 <> 0")), weather.limit(0), out, load="1")
    second = t.energy.filter("event_id % 3 = 0 OR event_id % 5 = 0")
    raised = second.withColumn("value", F.col("value") + 1)
    run_batch(_energy_messages(raised, LATER), weather, out, load="2")
    return tidy(read_serving(spark, f"{out}/point_data", "point_data").drop("day"))


def _batch_upsert_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Buckets whose messages come in two loads."""
    t = Tables(spark, sf_dir)
    out = fresh_dir(spark, "upsert")
    weather = _weather_messages(t.weather)
    for load in (0, 1):
        part = t.energy.filter(F.col("event_id") % 2 == load)
        run_batch(_energy_messages(part), weather.filter(F.lit(load == 1)), out, load=str(load))
    return tidy(read_serving(spark, f"{out}/energy_analytics", "energy_analytics").drop("day"))


def _reloaded(spark: SparkSession, sf_dir: str) -> str:
    """Three loads; the first is run again with other rows, and the older half of the days is folded."""
    t = Tables(spark, sf_dir)
    out = fresh_dir(spark, "reload")
    energy, weather = _energy_messages(t.energy), _weather_messages(t.weather)
    # The first attempt holds a third of the rows, all of them wrong.
    wrong = _energy_messages(t.energy.filter("event_id % 3 = 1").withColumn("value", F.lit(1e6)))
    run_batch(wrong, weather.filter("arrival.offset % 2 = 0"), out, load="1")
    run_batch(energy.filter("arrival.offset % 2 = 0"), weather.limit(0), out, load="2")
    run_batch(energy.filter("arrival.offset % 2 = 1"), weather, out, load="1")
    days = read_commit(spark, out).days("energy_sums")
    fold_days(spark, out, days[: len(days) // 2])
    return out


def _batch_reload(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = _reloaded(spark, sf_dir)
    return tidy(read_serving(spark, f"{out}/energy_weather_analytics", "energy_weather_analytics").drop("day"))


def _batch_reload_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = _reloaded(spark, sf_dir)
    return tidy(read_serving(spark, f"{out}/point_data", "point_data").drop("day"))


def _job_accounting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where the messages of a load went: kept, repeated, without key, or rejected by reason."""
    t = Tables(spark, sf_dir)
    out = fresh_dir(spark, "accounting")
    arrival = F.struct(F.col("event_id").alias("offset")).alias("arrival")

    def keyless(records: DataFrame) -> DataFrame:
        return records.withColumn("place", F.expr("if(event_id % 7 = 0, NULL, place)"))

    twice = t.energy.filter("event_id % 11 = 0 AND event_id % 7 <> 0")
    other = t.events.select(F.explode(F.array("props", "event_type")).alias("value"), arrival)
    energy = _energy_messages(keyless(t.energy)).unionByName(_energy_messages(twice, LATER)).unionByName(other)
    weather = _weather_messages(keyless(t.weather)).unionByName(t.events.select(F.col("event_type").alias("value"), arrival))
    counts = run_batch(energy, weather, out, load="1")
    for kind, table in (("energy", "point_data"), ("weather", "weather_data")):
        kept = read_serving(spark, f"{out}/{table}", table).count()
        counts[f"{table}_rows"] = kept
        counts[f"{table}_repeated"] = counts[f"{kind}_records"] - counts[f"{table}_keyless"] - kept
    return spark.createDataFrame(list(counts.items()), "item string, messages long")


def _series_from_annotated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The store's answer for every series and day, landed as annotated CSV and read back."""
    work = fresh_dir(spark, "annotated")
    ranged = _hydro_range(Tables(spark, sf_dir))
    daily = ranged.withColumn("day", F.to_date("_time").cast("string"))
    answers = annotated_tables(daily, (*SERIES_KEY, "_start", "_stop", "day"))
    answers.write.option("maxRecordsPerFile", ANSWER_TABLES).text(work)
    return tidy(series_from_annotated(annotated_rows(read_answers(spark, work))))


def _asked(table_function: str, *tables: str, digits: int = 6) -> Query:
    """The stored tables, asked in SQL with a bound argument."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        root = fresh_dir(spark, "questions")
        t = Tables(spark, sf_dir)
        built = {"energy_weather_analytics": "energy_weather"}
        for name in SERVING:
            rows = getattr(t, built.get(name, name))
            write_serving(rows if name in tables else rows.limit(0), f"{root}/{name}", name)
        # Views and functions of a session of their own, so that they change no one else's.
        session = spark.newSession()
        apply_runtime(session)
        register_serving(session, root)
        register_questions(session)
        return tidy(session.sql(f"SELECT * FROM {table_function}"), digits)

    return run


def _stream_series_last(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windowed means of a stream, then their newest row per series, kept as state; taken in with one restart."""
    session = streaming_session(apply_runtime(spark), STATE_PARTITIONS)
    work = fresh_dir(spark, "latest")
    views.sentinels(session).write.parquet(f"{work}/sentinels")
    events = views.events_stream(session, sf_dir).unionByName(views.events_stream_at(session, f"{work}/sentinels"))
    series = views.series_raw(events).withWatermark("_time", WATERMARK)
    ranged = series_range(series, NOW, HYDRO_WEEK.lookback, HYDRO.bucket, HYDRO.field)
    means = series_window_mean(ranged, HYDRO.every)
    landing = means.writeStream.format("parquet").option("path", f"{work}/means")
    landing.option("checkpointLocation", f"{work}/cp-means").trigger(availableNow=True).start().awaitTermination()
    stored = spark.read.schema(means.schema).parquet(f"{work}/means")
    for half in (0, 1):
        part = stored.filter(F.pmod(F.xxhash64("_time"), F.lit(2)) == half)
        part.write.mode("append").parquet(f"{work}/halves")
        landed = session.readStream.schema(means.schema).parquet(f"{work}/halves").filter("_value IS NOT NULL")
        newest = stream_latest(landed, HYDRO.last_by, ("_time", "ID")).writeStream.outputMode("update")
        newest = newest.option("checkpointLocation", f"{work}/cp-newest").trigger(availableNow=True)
        newest.foreachBatch(LatestSink(f"{work}/newest")).start().awaitTermination()
    return tidy(read_latest(spark.read.parquet(f"{work}/newest")))


def _current_with_late_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A tenth of the rows arrives after its day was published."""
    points = Tables(spark, sf_dir).point_data_by_event
    work = fresh_dir(spark, "late")
    live, serving = f"{work}/live", f"{work}/serving"
    early = points.filter("event_id % 10 <> 0").drop("event_id")
    append_batch(early, live, "point_data", 0, 0)
    publish_days(spark, live, serving, "point_data", "2024-01-01", "2024-01-24")
    append_batch(points.filter("event_id % 10 = 0").drop("event_id"), live, "point_data", 0, 1)
    return tidy(read_current(spark, live, serving, "point_data", "2024-01-25").drop("day"))


def all_queries() -> dict[str, Query]:
    return {
        # messages
        "encode_energy": _over(lambda t: encode_energy(views.as_readings(t.energy), F.col("time_stamp"))),
        "encode_weather": _over(lambda t: encode_weather(t.weather, F.col("time_stamp"))),
        "decode_energy": _over(_decoded_energy),
        "decode_weather": _over(_decoded_weather),
        "decode_rejects": _over(_rejected),
        "flatten_weather": _over(
            lambda t: flatten_weather(views.weather_documents(t.events), ("event_id",))
        ),
        "relay_json": _over(_relayed),
        "relay_json_canonical": _over(_relayed_canonical),
        "relay_json_hook": _over(_relayed_with_hook),
        # series
        "series_range": _over(_hydro_range),
        "series_window_mean": _over(_hydro_means),
        "series_last": _over(lambda t: series_last(_hydro_means(t), HYDRO.last_by)),
        "series_from_annotated": _series_from_annotated,
        "site_readings_hydro": _site(HYDRO_WEEK),
        "site_readings_solar": _site(SOLAR),
        "site_readings_mall": _site(MALL),
        "energy_feed": _over(_sent_feed),
        # tables of the job
        "point_data": _over(lambda t: t.point_data),
        "weather_data": _over(lambda t: t.weather_data),
        "energy_analytics": _over(lambda t: t.energy_analytics),
        "energy_window": _over(lambda t: _windowed(buckets.energy_window(t.energy))),
        "weather_window": _over(lambda t: _windowed(buckets.weather_window(t.weather))),
        "energy_weather_wide": _over(lambda t: buckets.energy_weather_wide(t.energy, t.weather)),
        "energy_weather_analytics": _over(lambda t: t.energy_weather),
        "latest_by_key": _over(
            lambda t: latest_by_key(t.energy, ("place", "id"), ("event_id",))
        ),
        "last_not_null": _over(
            lambda t: last_not_null(
                t.energy_analytics, "hour_group", ("kwh_prod", "kwh_cons", "ratio")
            )
        ),
        # dashboard
        "recent_days": _over(lambda t: dashboard.recent_days(t.point_data)),
        "consumption_by_time": _over(lambda t: dashboard.consumption_by_time(t.point_data)),
        "latest_weather_hydro": _over(lambda t: dashboard.latest_weather(t.weather_data, "hydro")),
        "latest_weather_mall": _over(lambda t: dashboard.latest_weather(t.weather_data, "mall")),
        "recent_balance": _over(lambda t: dashboard.recent_balance(t.energy_analytics)),
        "avg_per_degree": _over(lambda t: dashboard.avg_per_degree(t.energy_weather)),
        "avg_by_rain": _over(lambda t: dashboard.avg_by_rain(t.energy_weather)),
        "latest_ratio": _over(lambda t: dashboard.latest_ratio(t.energy_analytics)),
        # Averages of n readings with four decimals end exactly halfway between two
        # values of d digits when 2**(d - 3) divides n: more digits, fewer such ties.
        "hourly_profile": _over(
            lambda t: dashboard.hourly_profile(t.weather_data, t.energy_analytics), 8
        ),
        "daily_change": _over(lambda t: dashboard.daily_change(t.energy_analytics)),
        "generator_ids": _over(lambda t: dashboard.generator_ids(t.point_data)),
        # the dashboard over stored, day-partitioned tables
        "serving_recent_days": _served_newest(
            "point_data", lambda rows, days: dashboard.recent_days(rows, known_days=days)
        ),
        "serving_latest_weather": _served_newest(
            "weather_data", lambda rows, days: dashboard.latest_weather_stored(rows, days, "mall")
        ),
        "serving_recent_balance": _served("energy_analytics", dashboard.recent_balance),
        "serving_with_late_rows": _current_with_late_rows,
        # the dashboard in SQL
        "sql_recent_days": _asked("recent_days('GENERADOR 3')", "point_data"),
        "sql_latest_weather": _asked("latest_weather('solar')", "weather_data"),
        "sql_hourly_profile": _asked("hourly_profile('solar')", "weather_data", "energy_analytics", digits=10),
        "sql_daily_change": _asked("daily_change()", "energy_analytics"),
        # the job as a batch
        "batch_upsert": _batch_upsert,
        "batch_upsert_buckets": _batch_upsert_buckets,
        "batch_reload": _batch_reload,
        "batch_reload_points": _batch_reload_points,
        "batch_accounting": _job_accounting,
        # the job as streams
        "stream_job": _stream_job,
        "stream_point_data": _replay("point_data"),
        "stream_weather_data": _replay("weather_data"),
        "stream_energy_analytics": _replay("energy_analytics"),
        "stream_series_last": _stream_series_last,
        "stream_energy_weather": _replay("energy_weather_analytics"),
    }
