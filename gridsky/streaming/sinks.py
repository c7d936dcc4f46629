"""Sinks of the job's tables.

A sink is a function ``(batch, batch_id) -> None`` for ``foreachBatch``. All of
them can be replayed: the same batch written twice leaves one copy.
"""

from __future__ import annotations

import logging
import uuid
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridsky.operators.decode import split_null_keys
from gridsky.schemas import KEYS, SERVING
from gridsky.sources.tables import ONE_ROW_PER_KEY, append_batch, merge_statement, one_per_key

log = logging.getLogger(__name__)

BatchSink = Callable[[DataFrame, int], None]


def _keyless(batch: DataFrame, table: str, path: str) -> int:
    """Keep the rows that lack part of their key under ``path``, and count them."""
    spark = batch.sparkSession
    _, keyless = split_null_keys(batch, KEYS[table])
    keyless.select(*SERVING[table].names).write.mode("overwrite").parquet(path)
    found = spark.read.schema(SERVING[table]).parquet(path).count()
    if found:
        log.warning("%s: %d rows without their key, kept in %s", table, found, path)
    return found


@dataclass(frozen=True)
class TableSink:
    """Upsert into a live Parquet table under ``root``.

    ``run`` orders writes across fresh starts: batch numbers restart with a new
    checkpoint, so a job that starts over must be given a higher run.
    Rows lacking part of the key are kept under ``quarantine``, by default beside
    the tables, and counted in the log.
    """

    root: str
    run: int = 0
    quarantine: str | None = None

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def keyless(self, table: str) -> str:
        return f"{self.quarantine or f'{self.root}/keyless'}/{table}"

    def __call__(self, table: str) -> BatchSink:
        # Windows have their keys by construction.
        windowed = table in ONE_ROW_PER_KEY

        def write(batch: DataFrame, batch_id: int) -> None:
            if windowed:
                self._append(batch, table, batch_id)
                return
            batch.persist()  # read by two writes
            try:
                self._append(batch, table, batch_id)
                _keyless(batch, table, f"{self.keyless(table)}/run={self.run}/batch={batch_id}")
            finally:
                batch.unpersist()

        return write

    def _append(self, batch: DataFrame, table: str, batch_id: int) -> None:
        append_batch(one_per_key(batch, table), self.path(table), table, self.run, batch_id)


@dataclass(frozen=True)
class PrintSink:
    """Dry run: every row goes to the output of the task that has it, after the table's name."""

    @staticmethod
    def lines(batch: DataFrame, table: str) -> DataFrame:
        row = F.to_json(F.struct(*SERVING[table].names), {"ignoreNullFields": "false"})
        return batch.select(F.concat(F.lit(f"{table}> "), row).alias("line"))

    def __call__(self, table: str) -> BatchSink:
        def print_lines(rows: Iterable) -> None:
            for row in rows:
                print(row.line, flush=True)

        def write(batch: DataFrame, batch_id: int) -> None:
            self.lines(batch, table).foreachPartition(print_lines)

        return write


@dataclass(frozen=True)
class JdbcSink:
    """Upsert into a relational table: stage the batch, then merge it by key.

    The rows go from the executors to the staging table; the driver only sends
    the merge statement.
    """

    options: dict[str, str]  # url, user, password and, if needed, driver
    quarantine: str  # folder for rows that lack part of their key
    job: str = field(default_factory=lambda: uuid.uuid4().hex[:12])

    def staging(self, table: str) -> str:
        """A name that no other sink uses, so that two jobs never share a staging table."""
        return f"{table}_staging_{self.job}"

    def __call__(self, table: str) -> BatchSink:
        def write(batch: DataFrame, batch_id: int) -> None:
            batch.persist()  # read by two writes
            try:
                (
                    one_per_key(batch, table)
                    .write.format("jdbc")
                    .options(**self.options, dbtable=self.staging(table), truncate="true")
                    .mode("overwrite")
                    .save()
                )
                self._execute(batch, merge_statement(table, self.staging(table)))
                _keyless(batch, table, f"{self.quarantine}/{table}/job={self.job}/batch={batch_id}")
            finally:
                batch.unpersist()

        return write

    def _execute(self, batch: DataFrame, statement: str) -> None:
        jvm = batch.sparkSession.sparkContext._jvm
        if "driver" in self.options:
            jvm.java.lang.Class.forName(self.options["driver"])
        connection = jvm.java.sql.DriverManager.getConnection(
            self.options["url"], self.options["user"], self.options["password"]
        )
        try:
            prepared = connection.createStatement()
            try:
                prepared.executeUpdate(statement)
            finally:
                prepared.close()
        finally:
            connection.close()
