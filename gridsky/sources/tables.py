"""Serving tables: Parquet partitioned by day, or JDBC.

The live form of a table is an append-only folder ``day=/run=/batch=``: each
micro-batch owns its folders, so replaying a batch rewrites them and nothing
else, and a reader takes the newest write per key. Keys contain the event time,
so a filter on ``day`` prunes folders before rows are compared.
``write_serving`` turns the live form into a plain table with one row per key.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from datetime import date
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, IntegerType, LongType, StructField, StructType

from gridsky.operators.decode import split_null_keys
from gridsky.operators.keyed import latest_by_key
from gridsky.operators.partials import merged_energy_analytics, merged_energy_weather
from gridsky.schemas import EVENT_TIME, KEYS, SERVING
from gridsky.sources import files
from gridsky.sources.commits import (
    Commit,
    commit_numbers,
    expire,
    new_version,
    publish,
    read_commit,
    read_parts,
    write_part,
)

_DAY = StructField("day", DateType())
_WRITE = [StructField("run", IntegerType()), StructField("batch", LongType())]

# Tables whose rows are closed windows: the aggregation gives each key once.
ONE_ROW_PER_KEY = ("energy_analytics", "energy_weather_analytics")

# The sums that committed bucket tables are merged from, and how.
BUCKET_PARTS = {
    "energy_analytics": ("energy_sums",),
    "energy_weather_analytics": ("energy_sums", "weather_sums"),
}
MERGES = {"energy_analytics": merged_energy_analytics, "energy_weather_analytics": merged_energy_weather}


def one_per_key(rows: DataFrame, table: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """The rows a keyed table takes: full keys, and the last to arrive for each.

    Rows of equal ``arrival`` (lines of one file block) go by their order in the
    task that read them. Without that column any row of a key is kept. Columns of
    ``keep`` stay beside those of the table.
    """
    whole, _ = split_null_keys(rows, KEYS[table])
    if table not in ONE_ROW_PER_KEY:
        if "arrival" in rows.columns:
            numbered = whole.withColumn("_line", F.monotonically_increasing_id())
            whole = latest_by_key(numbered, KEYS[table], ("arrival", "_line"))
        else:
            whole = whole.dropDuplicates(list(KEYS[table]))
    return whole.select(*SERVING[table].names, *keep)


def by_day(rows: DataFrame) -> DataFrame:
    """Gather each day for writing, in partitions of the advisory size.

    With adaptive execution a rebalance joins small days into one task and splits
    a day that holds most of the rows over several.
    """
    return rows.hint("rebalance", "day")


@contextmanager
def adaptive(session: SparkSession) -> Iterator[None]:
    """Adaptive execution for the writes of a micro-batch.

    A streaming query turns it off in its own session, for the sake of stateful
    shuffles. The rows handed to ``foreachBatch`` are past those.
    """
    name = "spark.sql.adaptive.enabled"
    before = session.conf.get(name)
    session.conf.set(name, "true")
    try:
        yield
    finally:
        session.conf.set(name, before)


def with_day(rows: DataFrame, table: str) -> DataFrame:
    return rows.withColumn("day", F.to_date(EVENT_TIME[table]))


def append_batch(rows: DataFrame, path: str, table: str, run: int, batch: int) -> None:
    """Write one micro-batch of a live table; writing it again replaces it.

    A day the first attempt wrote and the second did not cannot exist: a batch
    is replayed from the same source offsets.
    """
    labels = {"run": F.lit(run).cast("int"), "batch": F.lit(batch).cast("bigint")}
    days = Observation()
    with adaptive(rows.sparkSession):
        (
            by_day(with_day(rows, table).observe(days, F.collect_set("day").alias("days")))
            .withColumns(labels)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("day", "run", "batch")
            .parquet(path)
        )
    _write_days(rows.sparkSession, f"{path}_batches/run={run}/batch={batch}", days)


def _write_days(spark: SparkSession, path: str, days: Observation) -> None:
    """Note the days that a write has touched."""
    try:
        found = [(d,) for d in sorted(days.get["days"])]
    except Py4JJavaError:
        # An empty frame is optimised away, and its observation with it.
        found = []
    spark.createDataFrame(found, StructType([_DAY])).coalesce(1).write.mode("overwrite").parquet(path)


def _noted(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """A table of notes; none if nothing has been noted."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def read_live(
    spark: SparkSession, path: str, table: str, days: Sequence[date] | None = None
) -> DataFrame:
    """The newest write per key of a live table, with its ``day``.

    With ``days`` only their folders are listed and read. Of compacted days the writes that went into them are left out.
    """
    schema = StructType([*SERVING[table].fields, _DAY, *_WRITE])
    commit = read_commit(spark, _compacted(path))
    compacted = read_parts(spark, commit, ROWS, commit.parts(ROWS, days))
    found = [] if compacted is None else [compacted.select(*schema.names)]
    wanted = None if days is None else [d for d in days if files.names(spark, f"{path}/day={d}")]
    if wanted is None and (compacted is None or files.names(spark, path)):
        folders = [path]
    else:
        folders = [f"{path}/day={d}" for d in wanted or ()]
    if folders:
        stored = spark.read.schema(schema).option("basePath", path).parquet(*folders)
        found.append(stored if compacted is None else _newer(stored, commit))
    if not found:
        return spark.createDataFrame([], schema).drop("run", "batch")
    # ``day`` follows from the key; naming it lets filters on it reach the scan.
    newest = latest_by_key(reduce(DataFrame.unionByName, found), ("day", *KEYS[table]), ("run", "batch"))
    return newest.drop("run", "batch")


#: The table of a compacted live form, and the write up to which each of its days goes.
ROWS, UPTO = "rows", "upto"


def _compacted(live: str) -> str:
    return f"{live}_compacted"


def _upto(commit: Commit) -> dict[str, tuple[int, int]]:
    """The write up to which each day is compacted."""
    return {d: max((int(r), int(b)) for r, b in own.items()) for d, own in commit.tables.get(UPTO, {}).items()}


def _newer(stored: DataFrame, commit: Commit) -> DataFrame:
    """Writes that are not compacted yet."""
    rows = [(date.fromisoformat(d), *w) for d, w in _upto(commit).items()]
    marks = stored.sparkSession.createDataFrame(rows, "done date, done_run int, done_batch long")
    after = F.struct("run", "batch") > F.struct("done_run", "done_batch")
    # One row for each day.
    joined = stored.join(F.broadcast(marks), F.col("day") == F.col("done"), "left")
    return joined.filter(F.col("done").isNull() | after).select(*stored.columns)


def compact_live(spark: SparkSession, live: str, table: str, first: str, last: str) -> list[date]:
    """Put the days ``first`` to ``last`` of a live table into few files, and tell which had new writes.

    The days become visible in their compacted form by one commit; writes that come later count as before. The
    many small folders stay until ``expire_live``, for readers that have listed them.
    """
    commit = read_commit(spark, _compacted(live))
    done = _upto(commit)
    noted = _batches(spark, live).filter(days_between(first, last))
    newest = noted.groupBy("day").agg(F.max(F.struct("run", "batch")).alias("upto")).collect()
    marks = {r.day: (r.upto.run, r.upto.batch) for r in newest if done.get(str(r.day), (-1, -1)) < (r.upto.run, r.upto.batch)}
    if not marks:
        return []
    rows = read_live(spark, live, table, sorted(marks))
    upto = spark.createDataFrame([(d, *w) for d, w in marks.items()], StructType([_DAY, *_WRITE]))
    version = new_version()
    tagged = rows.join(F.broadcast(upto), "day").select(*rows.columns, "run", "batch")
    days = write_part(tagged, commit.root, ROWS, "live", version, clustering(table), bloom_options(table))
    tables = {name: dict(own) for name, own in commit.tables.items()}
    # A day whose writes were all empty has no rows, and is done all the same.
    for day, (run, batch) in marks.items():
        tables.setdefault(UPTO, {})[str(day)] = {str(run): str(batch)}
        tables.setdefault(ROWS, {}).pop(str(day), None)
    for day in days:
        tables[ROWS][day] = {"live": version}
    publish(spark, Commit(commit.root, commit.number, tables))
    return sorted(marks)


def expire_live(spark: SparkSession, live: str, grace_ms: int = 3_600_000) -> int:
    """Delete folders and notes that compaction has replaced, ``grace_ms`` after their last change.

    The grace is for readers that listed them before. Of the notes, the newest of each day stays. Returns how many were deleted.
    """
    commit, limit = read_commit(spark, _compacted(live)), time.time_ns() // 1_000_000 - grace_ms
    done = _upto(commit)
    gone = []
    for day, upto in done.items():
        for run in files.names(spark, f"{live}/day={day}"):
            for batch in files.names(spark, f"{live}/day={day}/{run}"):
                if run.startswith("run=") and (int(run[4:]), int(batch[6:])) <= upto:
                    gone.append(f"{live}/day={day}/{run}/{batch}")
    notes = _batches(spark, live)
    newest = F.max(F.struct("run", "batch")).over(Window.partitionBy("day"))
    live_note = (F.struct("run", "batch") == F.col("newest")) | ~F.col("day").isin([date.fromisoformat(d) for d in done])
    kept = notes.withColumn("newest", newest).filter(live_note).select("run", "batch").distinct()
    needed = {(r.run, r.batch) for r in kept.collect()}
    for run in files.names(spark, f"{live}_batches"):
        for batch in files.names(spark, f"{live}_batches/{run}"):
            if run.startswith("run=") and (int(run[4:]), int(batch[6:])) not in needed:
                gone.append(f"{live}_batches/{run}/{batch}")
    old = [path for path in gone if files.modified(spark, path) <= limit]
    for path in old:
        files.delete(spark, path)
    return len(old) + len(expire(spark, commit.root, keep=1, tables=[ROWS]) if grace_ms <= 0 or old else [])


def compact_days(spark: SparkSession, path: str) -> int:
    """Put the notes on the days of a serving table into one. Returns how many there were."""
    notes = [n for n in files.names(spark, f"{path}_days") if n.startswith("write=")]
    if len(notes) > 1:
        _forget_days(spark, path, ())
    return len(notes)


#: How the rows of a day lie in their files: what questions ask for stands together, so that row
#: groups without it are skipped by their statistics, and by a Bloom filter on the columns of BLOOM.
CLUSTERED = {"point_data": ("place", "id", "time_stamp"), "weather_data": ("place", "time_stamp")}
BLOOM = {"point_data": ("id",)}


def clustering(table: str) -> tuple[str, ...]:
    return CLUSTERED.get(table, (EVENT_TIME[table],) if table in EVENT_TIME else ())


def bloom_options(table: str) -> dict[str, str]:
    return {f"parquet.bloom.filter.enabled#{c}": "true" for c in BLOOM.get(table, ())}


def write_serving(
    rows: DataFrame,
    path: str,
    table: str,
    touched: Sequence[date] | None = None,
    options: dict[str, str] | None = None,
) -> None:
    """Write ``rows``, one per key, as a plain day-partitioned table.

    Only the days present in ``rows`` are replaced; days of ``touched`` that have no row any more are
    emptied. Which days there are is noted beside the table, for questions about the newest ones.
    Days are replaced one after another: a reader meanwhile may see some old and some new ones. Loads
    that must appear whole go through :mod:`gridsky.sources.commits`.
    """
    spark = rows.sparkSession
    source = rows if "day" in rows.columns else with_day(rows, table)
    days = Observation()
    (
        by_day(source.observe(days, F.collect_set("day").alias("days")))
        .sortWithinPartitions("day", *clustering(table))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .options(**bloom_options(table), **(options or {}))
        .partitionBy("day")
        .parquet(path)
    )
    note = f"{path}_days/write={uuid.uuid4().hex}"
    _write_days(spark, note, days)
    if touched is not None:
        kept = {r.day for r in _noted(spark, note, StructType([_DAY])).collect()}
        emptied = sorted(set(touched) - kept)
        for day in emptied:
            files.delete(spark, f"{path}/day={day}")
        if emptied:
            _forget_days(spark, path, emptied)


def _forget_days(spark: SparkSession, path: str, gone: Sequence[date]) -> None:
    """Write the notes of a serving table anew without the days that were emptied."""
    left = [(r.day,) for r in read_days(spark, path).collect() if r.day not in set(gone)]
    old = files.names(spark, f"{path}_days")
    frame = spark.createDataFrame(left, StructType([_DAY])).coalesce(1)
    frame.write.parquet(f"{path}_days/write={uuid.uuid4().hex}")
    for name in old:
        files.delete(spark, f"{path}_days/{name}")


def _committed(path: str, table: str) -> str | None:
    """The folder of commit notes that ``path`` would belong to."""
    root, _, name = path.rstrip("/").rpartition("/")
    return root if root and name == table else None


def read_serving(spark: SparkSession, path: str, table: str) -> DataFrame:
    """A serving table with its ``day``: as the newest commit beside it says, else the folder as it is."""
    root = _committed(path, table)
    if root and commit_numbers(spark, root):
        return read_committed(spark, read_commit(spark, root), table)
    return spark.read.schema(StructType([*SERVING[table].fields, _DAY])).parquet(path)


def read_committed(spark: SparkSession, commit: Commit, table: str) -> DataFrame:
    """A serving table in the state of a commit; tables read with one commit belong together.

    Buckets are merged from the sums that loads have stored. Of points, days with one load are
    read as they are, and in days with more the last arrival per key is taken.
    """
    kept = [*SERVING[table].names, "day"]
    if table in BUCKET_PARTS:
        parts = [read_parts(spark, commit, p) for p in BUCKET_PARTS[table]]
        merged = None if None in parts else MERGES[table](*parts)
    else:
        by_day_parts = commit.parts(table)
        one = {d: p for d, p in by_day_parts.items() if len(p) == 1}
        several = {d: p for d, p in by_day_parts.items() if len(p) > 1}
        whole, shared = (read_parts(spark, commit, table, p) for p in (one, several))
        if shared is not None:
            shared = latest_by_key(shared, ("day", *KEYS[table]), ("arrival",)).select(*kept)
        found = [f.select(*kept) for f in (whole, shared) if f is not None]
        merged = reduce(DataFrame.unionByName, found) if found else None
    if merged is None:
        return spark.createDataFrame([], StructType([*SERVING[table].fields, _DAY]))
    return merged.select(*kept)


def read_days(spark: SparkSession, path: str) -> DataFrame:
    """The days of a serving table, from its notes: no folder of the table is listed."""
    root, _, table = path.rstrip("/").rpartition("/")
    if root and commit_numbers(spark, root):
        commit = read_commit(spark, root)
        days = set.intersection(*[set(commit.days(p)) for p in BUCKET_PARTS.get(table, (table,))])
        return spark.createDataFrame([(d,) for d in sorted(days)], StructType([_DAY]))
    return _noted(spark, f"{path}_days", StructType([_DAY])).distinct()


def publish_days(
    spark: SparkSession, live: str, serving: str, table: str, first: str, last: str
) -> None:
    """Write the days ``first`` to ``last`` of a live table to its serving table.

    Meant for days that have closed: many small files become few, and the work
    of finding the newest write is done once. It is noted up to which write each
    day is published. Running it again replaces the days, and takes in what has
    arrived late.
    """
    # The notes are taken first: what is written meanwhile counts as late.
    noted = _batches(spark, live).filter(days_between(first, last))
    newest = noted.groupBy("day").agg(F.max(F.struct("run", "batch")).alias("upto")).collect()
    write_serving(read_live(spark, live, table, sorted(r.day for r in newest)), serving, table)
    rows = [(r.day, r.upto.run, r.upto.batch) for r in newest]
    marks = spark.createDataFrame(rows, StructType([_DAY, *_WRITE])).coalesce(1)
    marks.write.mode("append").parquet(f"{serving}_published")


def _batches(spark: SparkSession, live: str) -> DataFrame:
    """(day, run, batch) of every write of a live table."""
    return _noted(spark, f"{live}_batches", StructType([_DAY, *_WRITE]))


def unpublished_days(spark: SparkSession, live: str, serving: str, open_from: str) -> list[date]:
    """Days from ``open_from`` on, and closed days written to since they were published."""
    published = _noted(spark, f"{serving}_published", StructType([_DAY, *_WRITE]))
    upto = published.groupBy("day").agg(F.max(F.struct("run", "batch")).alias("upto"))
    written = _batches(spark, live).groupBy("day").agg(F.max(F.struct("run", "batch")).alias("newest"))
    late = F.col("upto").isNull() | (F.col("newest") > F.col("upto"))
    open_day = F.col("day") >= F.lit(open_from).cast("date")
    return sorted(r.day for r in written.join(upto, "day", "left").filter(open_day | late).collect())


def read_current(
    spark: SparkSession, live: str, serving: str, table: str, open_from: str
) -> DataFrame:
    """The whole table: days from the live form if they are open or have late rows, else as published.

    Late rows of a published day show at once; publishing the day again makes it
    cheap again. Only the folders of such days are listed in the live form.
    """
    days = unpublished_days(spark, live, serving, open_from)
    published = read_serving(spark, serving, table).filter(F.col("day") < F.lit(open_from).cast("date"))
    if days:
        published = published.filter(~F.col("day").isin(days))
    return published.unionByName(read_live(spark, live, table, days))


def register_serving(spark: SparkSession, root: str) -> None:
    """Name the serving tables under ``root`` for use in ``spark.sql``, all in the state of one commit."""
    commit = read_commit(spark, root)
    for table in SERVING:
        if commit.number:
            rows = read_committed(spark, commit, table)
        else:
            rows = read_serving(spark, f"{root}/{table}", table)
        rows.createOrReplaceTempView(table)


def jdbc_options(
    url: str,
    table: str,
    user: str,
    password: str,
    partition_column: str | None = None,
    lower: str | None = None,
    upper: str | None = None,
    partitions: int | None = None,
) -> dict[str, str]:
    """Options of a JDBC read or write; the four last ones split a read into ranges."""
    options = {"url": url, "dbtable": table, "user": user, "password": password}
    split = {
        "partitionColumn": partition_column,
        "lowerBound": lower,
        "upperBound": upper,
        "numPartitions": partitions,
    }
    if any(v is not None for v in split.values()):
        if any(v is None for v in split.values()):
            raise ValueError("a split read needs column, bounds and number of partitions")
        options.update({k: str(v) for k, v in split.items()})
    return options


def read_jdbc(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    return spark.read.format("jdbc").options(**options).load()


def merge_statement(table: str, staging: str) -> str:
    """The statement that folds a staging table into its target by key."""
    columns = SERVING[table].names
    keys = KEYS[table]
    updates = ", ".join(f"{c} = EXCLUDED.{c}" for c in columns if c not in keys)
    listed = ", ".join(columns)
    return (
        f"INSERT INTO {table} ({listed}) SELECT {listed} FROM {staging} "
        f"ON CONFLICT ({', '.join(keys)}) DO UPDATE SET {updates}"
    )


# Column types of the relational targets.
_RELATIONAL = {
    "timestamp": "TIMESTAMP WITH TIME ZONE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "double": "DOUBLE PRECISION",
}


def create_statement(table: str) -> str:
    """The definition of a relational target, with the key the merge relies on."""
    columns = [f"{f.name} {_RELATIONAL[f.dataType.typeName()]}" for f in SERVING[table]]
    return f"CREATE TABLE {table} ({', '.join(columns)}, PRIMARY KEY ({', '.join(KEYS[table])}))"


def days_between(first: str, last: str) -> Column:
    """Predicate on the partition column for a span of days, both included."""
    return F.col("day").between(F.lit(first).cast("date"), F.lit(last).cast("date"))
