"""Weather documents polled from a service, as a streaming source.

A poll is numbered, and every answer is kept in a log before it is handed on. The offset is the number of the
last poll; reading a range again, in a later attempt or after a restart, takes the answers from the
log. So no document is lost, and none comes twice, though the service answers differently each time.
"""

from __future__ import annotations

import json
import math
import time
import uuid
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

#: What a service is asked with: the place. What it answers: status and body.
Poll = Callable[[str], tuple[int, str]]


@dataclass
class Ask(InputPartition):
    number: int
    place: str


class AnswerLog:
    """Answers by poll and place, as files that appear whole; the first one written counts."""

    def __init__(self, folder: str):
        from pyarrow import fs

        self.system, self.base = fs.FileSystem.from_uri(folder) if "://" in folder else (fs.LocalFileSystem(), folder)
        self.kinds = fs.FileType
        self.selector = fs.FileSelector

    def last(self) -> int:
        """The number of the newest poll that has been announced; 0 if there is none."""
        found = self.system.get_file_info(self.selector(self.base, allow_not_found=True))
        return max((int(f.base_name) for f in found if f.base_name.isdigit()), default=0)

    def announce(self, number: int) -> None:
        self.system.create_dir(f"{self.base}/{number:012d}", recursive=True)

    def _path(self, ask: Ask) -> str:
        return f"{self.base}/{ask.number:012d}/{ask.place.encode().hex()}.json"

    def read(self, ask: Ask) -> tuple[int, str] | None:
        if self.system.get_file_info(self._path(ask)).type == self.kinds.NotFound:
            return None
        with self.system.open_input_stream(self._path(ask)) as stream:
            return tuple(json.loads(stream.read().decode()))

    def write(self, ask: Ask, answer: tuple[int, str]) -> tuple[int, str]:
        """Keep the answer unless there is one; returns the one that is kept."""
        draft = f"{self.base}/{ask.number:012d}/.{uuid.uuid4().hex}"
        with self.system.open_output_stream(draft) as stream:
            stream.write(json.dumps(answer).encode())
        # Attempts of a task do not run side by side unless it is speculated; then the answers are both true.
        known = self.read(ask)
        if known is not None:
            self.system.delete_file(draft)
            return known
        self.system.move(draft, self._path(ask))
        return answer

    def forget(self, upto: int) -> None:
        """Drop the answers of polls before ``upto``, which is itself kept, as the newest number."""
        found = self.system.get_file_info(self.selector(self.base, allow_not_found=True))
        for f in found:
            if f.base_name.isdigit() and int(f.base_name) < upto:
                self.system.delete_dir(f.path)


class DocumentReader(DataSourceStreamReader):
    """Announces a poll each ``every_ms``; a poll asks for every place, each in a task of its own."""

    def __init__(self, poll: Poll, places: Sequence[str], folder: str, every_ms: int):
        self.poll, self.places, self.folder, self.every_ms = poll, tuple(places), folder, every_ms
        # The clock's zero is any time: none has been announced yet.
        self.announced = -math.inf

    def initialOffset(self) -> dict:
        return {"poll": 0}

    def latestOffset(self) -> dict:
        log = AnswerLog(self.folder)
        number, now = log.last(), time.monotonic()
        if now - self.announced >= self.every_ms / 1000:
            number, self.announced = number + 1, now
            log.announce(number)
        return {"poll": number}

    def partitions(self, start: dict, end: dict) -> Sequence[InputPartition]:
        return [Ask(n, p) for n in range(start["poll"] + 1, end["poll"] + 1) for p in self.places]

    def read(self, partition: Ask) -> Iterator[tuple]:
        log = AnswerLog(self.folder)
        answer = log.read(partition)
        if answer is None:
            answer = log.write(partition, self.poll(partition.place))
        yield (partition.place, *answer, partition.number)

    def commit(self, end: dict) -> None:
        AnswerLog(self.folder).forget(end["poll"])


def poll_documents(
    spark: SparkSession, poll: Poll, places: Sequence[str], log: str, every_ms: int = 60_000
) -> DataFrame:
    """A stream of (place, status, body, poll): the answers of ``poll(place)`` for each place, every ``every_ms``.

    ``poll`` runs in tasks. ``log`` is a folder that all executors share; it holds the answers that are not yet processed.
    A stream is one query: two queries over the same log would take each other's polls.
    """

    class Documents(DataSource):
        @classmethod
        def name(cls) -> str:
            return "gridsky_documents"

        def schema(self) -> str:
            return "place string, status int, body string, poll long"

        def streamReader(self, schema) -> DataSourceStreamReader:
            return DocumentReader(poll, places, log, every_ms)

    spark.dataSource.register(Documents)
    return spark.readStream.format("gridsky_documents").load()
