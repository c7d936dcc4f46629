"""The job as a batch, load by load.

What a load adds is stored by itself: its typed records, the last arrival per key among its points, and sums
and counts by bucket and place. Tables are merged from all loads when read, so a load costs what
it holds and reads nothing of the loads before. One commit note makes all of it visible at once.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from datetime import date, datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridsky.operators.decode import (
    MALFORMED,
    NO_EVENT_TIME,
    decode_energy,
    decode_weather,
    split_marked,
    split_null_keys,
)
from gridsky.operators.keyed import latest_by_key
from gridsky.operators.partials import energy_partials, merge_partials, weather_partials
from gridsky.operators.records import point_data, weather_data
from gridsky.schemas import KEYS, SERVING
from gridsky.sources.commits import Commit, new_version, publish, read_commit, read_parts, write_part
from gridsky.sources.tables import bloom_options, clustering, one_per_key, with_day

#: The part that holds days folded from several loads, and the list of loads that went into it.
FOLDED = "_folded"
POINTS = {"energy": "point_data", "weather": "weather_data"}
SUMS = {"energy": "energy_sums", "weather": "weather_sums"}


def run_batch(
    energy_messages: DataFrame,
    weather_messages: DataFrame,
    out: str,
    records: str | None = None,
    load: str | None = None,
) -> dict[str, int]:
    """Take landed messages into the four tables under ``out``; an upsert by key.

    Each message is parsed once and landed as typed columns under ``records`` (by default in
    ``out``); rejected messages stay there with their reason, and rows without
    their key go to ``keyless``. A key keeps its last arrival over all loads, and a bucket counts
    the messages of all loads. Running a load again under its name replaces all of
    its old rows. Until the commit at the end, and if the run breaks off before it, readers see the
    tables as they were; with ``records`` elsewhere, those have a commit of their own just before it.

    Returns the counts of this load: messages, rejects by reason, rows without key.
    """
    spark = energy_messages.sparkSession
    load = load or f"{datetime.now(timezone.utc):%Y%m%dT%H%M%S%f}-{uuid.uuid4().hex[:8]}"
    commit = read_commit(spark, out)
    _refuse_folded(commit, load)
    version = new_version()
    # Where the records are, and what they are called there.
    side = commit if records is None else read_commit(spark, records)
    folder = {k: k if records else f"records/{k}" for k in POINTS}
    # The order of lines within a file block is kept as a column: the stored
    # records may be read back in other pieces.
    position = F.struct("arrival", F.monotonically_increasing_id().alias("line"))

    def land(kind: str, messages: DataFrame, decode: Callable) -> tuple[list[str], DataFrame | None]:
        rows = decode(messages, ("arrival",)).marked
        rows = rows.withColumn("arrival", position).withColumn("day", F.to_date("ts"))
        days = write_part(rows, side.root, folder[kind], load, version)
        own = Commit(side.root, 0).with_part(folder[kind], load, version, days)
        return days, read_parts(spark, own, folder[kind])

    def count(kind: str, stored: DataFrame | None) -> dict[str, int]:
        found = {f"{kind}_{k}": 0 for k in ("records", MALFORMED, NO_EVENT_TIME)} | {f"{POINTS[kind]}_keyless": 0}
        if stored is not None:
            keyless = F.lit(False)
            for key in KEYS[POINTS[kind]]:
                keyless = keyless | F.col("ts" if key == "time_stamp" else key).isNull()
            usable = F.col("reason").isNull()
            for r in stored.groupBy("reason").agg(F.count("*").alias("n"), F.count_if(usable & keyless).alias("keyless")).collect():
                found[f"{kind}_{r.reason or 'records'}"] = r.n
                found[f"{POINTS[kind]}_keyless"] += r.keyless
        found[f"{kind}_messages"] = sum(found[f"{kind}_{k}"] for k in ("records", MALFORMED, NO_EVENT_TIME))
        return found

    def points(kind: str, stored: DataFrame) -> DataFrame:
        rows = split_marked(stored).records.drop("day")
        project = point_data if kind == "energy" else weather_data
        return project(rows, ("arrival",)).withColumn("arrival", F.struct("arrival", F.lit(load).alias("load")))

    def share(table: str, kind: str, stored: DataFrame, counts: dict[str, int]) -> list[str]:
        """Write one table's share of the load."""
        name = POINTS[kind]
        if table == f"keyless/{name}":
            if not counts[f"{name}_keyless"]:
                return []
            rows = split_null_keys(points(kind, stored), KEYS[name])[1].select(*SERVING[name].names)
            return write_part(with_day(rows, name), out, table, load, version)
        if table == name:
            rows = one_per_key(points(kind, stored), name, ("arrival",))
            return write_part(
                with_day(rows, name), out, table, load, version, clustering(name), bloom_options(name)
            )
        sums = (energy_partials if kind == "energy" else weather_partials)(split_marked(stored).records)
        return write_part(sums.withColumn("day", F.to_date("window_start")), out, table, load, version)

    inputs = {"energy": (energy_messages, decode_energy), "weather": (weather_messages, decode_weather)}
    counts: dict[str, int] = {}
    # Jobs that do not need each other run side by side.
    with ThreadPoolExecutor(8) as pool:
        landed = dict(zip(inputs, pool.map(lambda k: land(k, *inputs[k]), inputs)))
        for found in pool.map(lambda k: count(k, landed[k][1]), inputs):
            counts |= found
        wanted = [(t, k) for k in inputs for t in (POINTS[k], SUMS[k], f"keyless/{POINTS[k]}")]
        # A table to which this load adds nothing loses what the load had there before.
        written = pool.map(
            lambda w: share(*w, landed[w[1]][1], counts) if counts[f"{w[1]}_records"] else [], wanted
        )
        for (table, _), days in zip(wanted, written):
            commit = commit.with_part(table, load, version, days)
    for kind, (days, _) in landed.items():
        side = side.with_part(folder[kind], load, version, days)
        if records is None:
            commit = commit.with_part(folder[kind], load, version, days)
    if records is not None:
        publish(spark, side)
    publish(spark, commit)
    return counts


def _refuse_folded(commit: Commit, load: str) -> None:
    if load.startswith("_"):
        raise ValueError(f"{load!r}: names of loads do not begin with _")
    days = sorted(d for d, loads in commit.tables.get(FOLDED, {}).items() if load in loads)
    if days:
        raise ValueError(f"load {load!r} is folded into {', '.join(days)} and can no longer be replaced")


def fold_days(spark: SparkSession, out: str, days: Iterable[date]) -> int:
    """Merge the shares of all loads in closed days into one, in one commit; answers stay the same.

    Readers of such a day then open one folder for each table. The loads in it can no longer be replaced there,
    and say so when tried; new loads may still add to the day. Returns the number of shares merged.
    """
    commit = read_commit(spark, out)
    chosen, version, folded = list(days), new_version(), 0
    done = commit
    for table in (*POINTS.values(), *SUMS.values()):
        shares = {d: p for d, p in commit.parts(table, chosen).items() if len(p) > 1}
        rows = read_parts(spark, commit, table, shares)
        if rows is None:
            continue
        if table in SUMS.values():
            rows = merge_partials(rows)
        else:
            rows = latest_by_key(rows, ("day", *KEYS[table]), ("arrival",))
        written = write_part(rows, out, table, FOLDED, version, clustering(table), bloom_options(table))
        tables = {**done.tables, table: {**done.tables[table], **{d: {FOLDED: version} for d in written}}}
        noted = {d: dict(p) for d, p in done.tables.get(FOLDED, {}).items()}
        for d, p in shares.items():
            noted.setdefault(d, {}).update({load: version for load in p if load != FOLDED})
        done = Commit(out, done.number, {**tables, FOLDED: noted})
        folded += sum(len(p) for p in shares.values())
    if folded:
        publish(spark, done)
    return folded
