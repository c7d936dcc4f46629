"""Versioned day folders, and one commit note that says which of them count.

Each write of a table goes to a folder of its own, ``part=/version=/day=``, that is never changed. A
commit note names, for every table, the version of each part of each day. Writing the note is
the one step that makes new data visible, of all tables together; until then, and after a crash before it,
readers see the state of the note before. A reader holds on to the folders of one note.

A part is the share of one load, so a load that runs again takes the place of its old part and
of nothing else. One writer at a time; a second one that started from the same note fails.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field
from datetime import date
from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridsky.sources import files

NOTES = "_commits"
#: How Spark names the folder of a null.
NO_DAY = "__HIVE_DEFAULT_PARTITION__"


def new_version() -> str:
    return uuid.uuid4().hex[:16]


@dataclass(frozen=True)
class Commit:
    """A state of the tables under ``root``: versions by table, day and part."""

    root: str
    number: int = 0
    tables: dict[str, dict[str, dict[str, str]]] = field(default_factory=dict)

    def days(self, table: str) -> list[date]:
        return sorted(date.fromisoformat(d) for d in self.tables.get(table, {}) if d != NO_DAY)

    def parts(self, table: str, days: Iterable[date] | None = None) -> dict[str, dict[str, str]]:
        """part -> version of each day (all days, or those given)."""
        wanted = None if days is None else {str(d) for d in days}
        return {d: p for d, p in self.tables.get(table, {}).items() if wanted is None or d in wanted}

    def with_part(self, table: str, part: str, version: str, days: Iterable[str]) -> Commit:
        """The part has these days in this version, and no others."""
        kept = {
            day: {p: v for p, v in parts.items() if p != part} for day, parts in self.tables.get(table, {}).items()
        }
        for day in days:
            kept.setdefault(day, {})[part] = version
        return Commit(self.root, self.number, {**self.tables, table: {d: p for d, p in kept.items() if p}})


def _note(root: str, number: int) -> str:
    return f"{root}/{NOTES}/{number:012d}.json"


def commit_numbers(spark: SparkSession, root: str) -> list[int]:
    found = files.names(spark, f"{root}/{NOTES}")
    return [int(n[:-5]) for n in found if n.endswith(".json") and not n.startswith(".")]


def read_commit(spark: SparkSession, root: str, number: int | None = None) -> Commit:
    """The newest state of ``root``, or an earlier one that has not been expired; an empty one if there is none."""
    if number is None:
        number = max(commit_numbers(spark, root), default=0)
    if number == 0:
        return Commit(root)
    return Commit(root, number, json.loads(files.read_text(spark, _note(root, number))))


def publish(spark: SparkSession, commit: Commit) -> Commit:
    """Make a state that was derived from the newest one visible."""
    done = Commit(commit.root, commit.number + 1, commit.tables)
    try:
        files.create_text(spark, _note(done.root, done.number), json.dumps(done.tables, separators=(",", ":")))
    except FileExistsError as taken:
        raise RuntimeError(f"{commit.root}: another writer has published commit {done.number}") from taken
    return done


def _base(root: str, table: str, part: str, version: str) -> str:
    # Load names are free text; a folder name is not.
    return f"{root}/{table}/part={quote(part, safe='')}/version={version}"


def write_part(
    rows: DataFrame,
    root: str,
    table: str,
    part: str,
    version: str,
    order: Sequence[str] = (),
    options: dict[str, str] | None = None,
) -> list[str]:
    """Write a part, which has a column ``day``, to folders of its own, and tell its days.

    The rows of a file go by ``order``; ``options`` are the writer's. The part becomes visible when a commit that names it (``with_part``) is published.
    """
    path = _base(root, table, part, version)
    ordered = rows.hint("rebalance", "day").sortWithinPartitions("day", *order)
    ordered.write.options(**(options or {})).partitionBy("day").parquet(path)
    return [n[4:] for n in files.names(rows.sparkSession, path) if n.startswith("day=")]


def read_parts(
    spark: SparkSession, commit: Commit, table: str, parts: dict[str, dict[str, str]] | None = None
) -> DataFrame | None:
    """Rows of a table with their ``day`` and no other column of the folders; None if it has none."""
    chosen = commit.tables.get(table, {}) if parts is None else parts
    folders = [f"{_base(commit.root, table, p, v)}/day={d}" for d, own in sorted(chosen.items()) for p, v in sorted(own.items())]
    if not folders:
        return None
    rows = spark.read.option("basePath", f"{commit.root}/{table}").parquet(*folders)
    return rows.withColumn("day", F.col("day").cast("date")).drop("part", "version")


def expire(spark: SparkSession, root: str, keep: int = 1, tables: Iterable[str] | None = None) -> list[str]:
    """Delete the notes but the newest ``keep``, and every folder that none of those names.

    Not to be run beside a writer; readers of a deleted state fail. Returns what was deleted.
    """
    numbers = sorted(commit_numbers(spark, root))
    if not numbers:
        return []
    states = [read_commit(spark, root, n) for n in numbers[-max(1, keep) :]]
    gone = [_note(root, n) for n in numbers[: -max(1, keep)]]
    for table in tables if tables is not None else sorted({t for s in states for t in s.tables}):
        named = {(quote(p, safe=""), v) for s in states for own in s.tables.get(table, {}).values() for p, v in own.items()}
        for part in (n for n in files.names(spark, f"{root}/{table}") if n.startswith("part=")):
            for version in (n for n in files.names(spark, f"{root}/{table}/{part}") if n.startswith("version=")):
                if (part[5:], version[8:]) not in named:
                    gone.append(f"{root}/{table}/{part}/{version}")
    for path in gone:
        files.delete(spark, path)
    return gone
