"""Deterministic sharded WARC writer, and its reader.

Records are range-sorted by (page id, url, payload digest) and each range is written by one
task as a run of gzip files, one member per record, that roll at a compressed
size. The ranges come from exact sums: the space of keys is divided byte by byte wherever
more than a range lies, in ids, then urls, then digests, so crowded ids and far
ones make no difference, and the same pages always give the same files, byte for byte. Headers, lengths and
digests are made anew from the payload.

Of records with equal payloads of at least ``min_revisit`` bytes, the one that sorts first
is a ``response``; the others are ``revisit`` records, which name it and carry
no payload. Which is which is settled by an aggregate over digest and length with
a map side, so a payload that a third of the pages share is one row per task.

Commit: a task writes under a temporary name of its own and returns what it wrote.
Only the attempts that Spark accepted are known to the next step, which renames
their files; a rename done before counts as done, so it can be repeated. The
manifest is written last, under a temporary name, and renamed: without it the
archive does not exist for readers. Files left by lost attempts stay in the
temporary folder and are never read.

Cases: a null payload is empty; null urls become "about:blank"; null ids sort
last and are written as the text "null"; repeated rows are all written, with
numbered record ids; an empty table gives a manifest without files; other
columns are ignored, whatever their names; a folder that holds a manifest is not
written again.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import quote

import pandas as pd
from pyarrow import fs as arrow_fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridsky.llm.common import as_text, cast_back, small_batches, staged, text_or_empty, utf8

#: A file is closed once it holds this many compressed bytes.
ROLL_BYTES = 8 << 20
#: Payload bytes that a range holds, about; one page may hold more.
RANGE_BYTES = 64 << 20
#: Ranges of an archive, at most; beyond, each holds more.
MOST_RANGES = 100_000
#: The same date in each record, so that the bytes depend on the pages alone.
DATE = "2024-01-01T00:00:00Z"
MANIFEST = "manifest"

MANIFEST_SCHEMA = "name string, records long, bytes long, sha256 string"
#: Tasks that rename or read files, at most; a task takes its files one after the other.
MOST_TASKS = 5000
#: Records in one batch of the reader.
READ_ROWS = 256

# Fixed by the WARC format.
VERSION = "WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def base32_sha1(raw: bytes) -> str:
    return base64.b32encode(hashlib.sha1(raw).digest()).decode("ascii")


def record(
    name: str, url: str, payload: bytes, refers_to: str | None = None, refers_url: str | None = None
) -> bytes:
    """One WARC record; with ``refers_to`` a revisit, whose block is the HTTP header only."""
    http = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {len(payload)}\r\n\r\n"
    ).encode("ascii")
    block = http if refers_to else http + payload
    lines = [
        VERSION,
        f"WARC-Type: {'revisit' if refers_to else 'response'}",
        f"WARC-Record-ID: <urn:page:{name}>",
        f"WARC-Target-URI: {url}",
        f"WARC-Date: {DATE}",
        f"WARC-Payload-Digest: sha1:{base32_sha1(payload)}",
        f"WARC-Block-Digest: sha1:{base32_sha1(block)}",
    ]
    if refers_to:
        lines += [
            f"WARC-Profile: {PROFILE}",
            f"WARC-Refers-To: <urn:page:{refers_to}>",
            f"WARC-Refers-To-Target-URI: {refers_url}",
        ]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode("ascii") + b"\r\n\r\n" + block + b"\r\n\r\n"


def member(raw: bytes) -> bytes:
    """A gzip member with no time and no name."""
    squeeze = zlib.compressobj(6, zlib.DEFLATED, 31)
    return squeeze.compress(raw) + squeeze.flush()


def parse(raw: bytes) -> dict:
    """Header fields, HTTP length and payload of a record, its digests checked."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    first, *lines = head.decode("ascii").split("\r\n")
    fields = dict(line.split(": ", 1) for line in lines)
    size = int(fields["Content-Length"])
    block, end = rest[:size], rest[size:]
    if first != VERSION or len(block) != size or end != b"\r\n\r\n":
        raise ValueError(f"broken WARC record {fields.get('WARC-Record-ID')}")
    if fields["WARC-Block-Digest"] != f"sha1:{base32_sha1(block)}":
        raise ValueError(f"block digest differs in {fields['WARC-Record-ID']}")
    http, _, payload = block.partition(b"\r\n\r\n")
    length = int(re.search(rb"(?mi)^content-length: (\d+)\r?$", http)[1])
    if fields["WARC-Type"] == "response" and (
        len(payload) != length or fields["WARC-Payload-Digest"] != f"sha1:{base32_sha1(payload)}"
    ):
        raise ValueError(f"payload differs in {fields['WARC-Record-ID']}")
    return {**fields, "http_length": length, "payload": payload}


def members(stream, step: int = 1 << 20) -> Iterator[bytes]:
    """The gzip members of a stream, one at a time."""
    left = b""
    inflate, parts = zlib.decompressobj(31), []
    while True:
        data = left or stream.read(step)
        if not data:
            if parts or inflate.unconsumed_tail:
                raise ValueError("archive ends within a record")
            return
        parts.append(inflate.decompress(data))
        left = b""
        if inflate.eof:
            yield b"".join(parts)
            left, inflate, parts = inflate.unused_data, zlib.decompressobj(31), []


def _place(path: str) -> tuple[arrow_fs.FileSystem, str]:
    """The file system and path of a folder, by its URI or as a plain path."""
    return arrow_fs.FileSystem.from_uri(path)


@dataclass(frozen=True)
class Cell:
    """Keys that begin with ``prefix``: their bytes, and how many leading bytes all of them share."""

    prefix: bytes
    weight: int
    shared: int
    single: bool


def _key() -> Column:
    """Binary, in the order of (id with nulls last, url, payload digest)."""
    sign = F.lit(-(1 << 63)).cast("long")
    number = F.lpad(F.hex(F.col("id").bitwiseXOR(sign)), 16, "0")
    ident = F.when(F.col("id").isNull(), F.lit("01")).otherwise(F.concat(F.lit("00"), number))
    return F.unhex(F.concat(ident, F.hex(F.col("url").cast("binary")), F.lit("00"), F.col("sha")))


def _common(a: bytes, b: bytes) -> int:
    return next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))


def _divided(keys: DataFrame, cells: list[Cell], limit: int) -> list[Cell]:
    """The cells with those above the limit divided by the first byte in which their keys differ."""
    starts = [c.prefix for c in cells]

    def weigh(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found: dict[bytes, list] = {}
        for batch in batches:
            for key, weight in zip(batch["key"], batch["weight"]):
                cell = cells[bisect_right(starts, key) - 1]
                if cell.weight > limit and not cell.single:
                    own = found.setdefault(key[: cell.shared + 1], [0, key, key])
                    own[0] += weight
                    own[1], own[2] = min(own[1], key), max(own[2], key)
        yield pd.DataFrame([(p, *own) for p, own in found.items()], columns=["prefix", "weight", "low", "high"])

    made = keys.mapInPandas(weigh, "prefix binary, weight long, low binary, high binary")
    made = made.groupBy("prefix").agg(F.sum("weight").alias("weight"), F.min("low").alias("low"), F.max("high").alias("high"))
    kept = [c for c in cells if c.weight <= limit or c.single]
    children = [
        Cell(bytes(r.prefix), r.weight, _common(bytes(r.low), bytes(r.high)), bytes(r.low) == bytes(r.high)) for r in made.collect()
    ]
    return sorted(kept + children, key=lambda c: c.prefix)


def _range_starts(keys: DataFrame, range_bytes: int) -> list[bytes]:
    """The keys at which ranges of about ``range_bytes`` begin, from exact sums.

    Only cells that are too large are divided further, so what reaches the driver are at most 256 sums for each range.
    """
    whole = keys.agg(F.sum("weight").alias("weight"), F.min("key").alias("low"), F.max("key").alias("high")).first()
    if whole.weight is None:
        return [b""]
    limit = max(range_bytes, whole.weight // MOST_RANGES)
    low, high = bytes(whole.low), bytes(whole.high)
    cells = [Cell(b"", whole.weight, _common(low, high), low == high)]
    while any(c.weight > limit and not c.single for c in cells):
        cells = _divided(keys, cells, limit)
    starts, held = [b""], 0
    for cell in cells:
        if held and held + cell.weight > limit:
            starts.append(cell.prefix)
            held = 0
        held += cell.weight
    return starts


def write_warc(
    pages: DataFrame,
    path: str,
    id_col: str = "page_id",
    url_col: str = "url",
    payload_col: str = "html",
    min_revisit: int = 0,
    roll_bytes: int = ROLL_BYTES,
    range_bytes: int = RANGE_BYTES,
) -> None:
    """Write the pages as an archive under ``path``."""
    spark = pages.sparkSession
    system, base = _place(path)
    if system.get_file_info(f"{base}/{MANIFEST}").type != arrow_fs.FileType.NotFound:
        raise FileExistsError(f"{path} holds an archive")
    small_batches(spark)
    rows = pages.select(
        F.col(id_col).cast("long").alias("id"),
        F.coalesce(F.col(url_col).cast("string"), F.lit("about:blank")).alias("url"),
        text_or_empty(F.col(payload_col)).alias("payload"),
    ).select(
        "*",
        F.sha1(F.col("payload").cast("binary")).alias("sha"),
        F.octet_length("payload").cast("long").alias("bytes"),
    )
    keys = rows.select("id", "url", "sha", "bytes")
    first = F.struct(F.col("id").isNull().alias("unknown"), "id", "url")
    groups = (
        keys.where(F.col("bytes") >= min_revisit)
        .groupBy("sha", "bytes")
        .agg(F.min(first).alias("first"), F.count(F.lit(1)).alias("n"))
        .where("n > 1")
        .select("sha", "bytes", "n", F.col("first.id").alias("first_id"), F.col("first.url").alias("first_url"))
    )
    groups = staged(groups, "warc-groups")
    weights = staged(rows.select(_key().alias("key"), (F.col("bytes") + 512).alias("weight")), "warc-keys")
    starts = _range_starts(weights, range_bytes)

    @F.pandas_udf("int")
    def range_of(keys: pd.Series) -> pd.Series:
        return pd.Series([bisect_right(starts, k) - 1 for k in keys], dtype="int32")

    linked = rows.withColumn("range", range_of(_key())).join(groups, ["sha", "bytes"], "left")
    # Rows that repeat in id, url and payload are numbered by the writer, which sees them in a row.
    ordered = (
        linked.select("range", "id", "url", "sha", "payload", "n", "first_id", "first_url")
        .repartitionById(len(starts), "range")
        .sortWithinPartitions("range", F.col("id").asc_nulls_last(), "url", "sha")
        .select("range", *as_text("id"), "url", "sha", "payload", "n", *as_text("first_id"), "first_url")
    )
    folder = f"{path.rstrip('/')}/_temporary"

    def write(batches):
        system, base = _place(folder)
        yield from _write_files(batches, system, base, roll_bytes)

    schema = f"range int, part int, temporary string, {MANIFEST_SCHEMA}"
    _commit(staged(ordered.mapInPandas(write, schema), "warc-files"), path)


def _commit(written: DataFrame, path: str) -> None:
    """Give the accepted files their names, then publish the manifest."""
    files = written.count()
    system, base = _place(path)
    system.create_dir(f"{base}/data", recursive=True)

    def rename(batches):
        system, base = _place(path)
        for batch in batches:
            for temporary, name in zip(batch["temporary"], batch["name"]):
                target = f"{base}/data/{name}"
                there = system.get_file_info(target).type != arrow_fs.FileType.NotFound
                if system.get_file_info(temporary).type != arrow_fs.FileType.NotFound:
                    if there:  # left by a run that never published its manifest
                        system.delete_file(target)
                    system.move(temporary, target)
                elif not there:
                    raise FileNotFoundError(f"{name} is neither written nor committed")
            yield batch.drop(columns="temporary")

    renamed = written.repartition(max(1, min(files, MOST_TASKS)), "name").mapInPandas(
        rename, f"range int, part int, {MANIFEST_SCHEMA}"
    )
    pending = f"{path.rstrip('/')}/_temporary/{MANIFEST}"
    renamed.write.mode("overwrite").json(pending)
    system.move(f"{base}/_temporary/{MANIFEST}", f"{base}/{MANIFEST}")


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """range, part, name, records, bytes, sha256 of each file of a committed archive."""
    return spark.read.schema(f"range int, part int, {MANIFEST_SCHEMA}").json(f"{path.rstrip('/')}/{MANIFEST}")


def read_warc(spark: SparkSession, path: str, payload: bool = True) -> DataFrame:
    """page_id, url, payload_bytes, payload_digest, record_type, refers_to and, if asked for, payload.

    A revisit has no payload of its own, so its ``payload`` is null; length and
    digest are those of the full payload. Every record's digests, and every file's
    number of records and digest, are checked.
    """
    files = read_manifest(spark, path)
    spread = files.repartition(max(1, min(files.count(), MOST_TASKS)), "name")

    def read(batches):
        system, base = _place(path)
        for batch in batches:
            for name, records, sha in zip(batch["name"], batch["records"], batch["sha256"]):
                rows, seen, digest = [], 0, hashlib.sha256()
                with system.open_input_stream(f"{base}/data/{name}", compression=None) as stream:
                    for raw in members(_Hashed(stream, digest)):
                        rows.append(_row(parse(raw), payload))
                        seen += 1
                        if len(rows) >= READ_ROWS:
                            yield pd.DataFrame(rows, columns=names)
                            rows = []
                if seen != records or digest.hexdigest() != sha:
                    raise ValueError(f"{name} differs from the manifest")
                yield pd.DataFrame(rows, columns=names)

    schema = "page_id string, url string, payload_bytes long, payload_digest string, record_type string, refers_to string"
    schema += ", payload binary" * payload
    names = [part.split()[0] for part in schema.split(", ")]
    return cast_back(spread.mapInPandas(read, schema), page_id="long", refers_to="long")


class _Hashed:
    """A stream whose bytes are also digested."""

    def __init__(self, stream, digest):
        self.stream, self.digest = stream, digest

    def read(self, step: int) -> bytes:
        data = self.stream.read(step)
        self.digest.update(data)
        return data


def _page(uri: str | None) -> str | None:
    """The page id in a record id; None for "null"."""
    ident = re.fullmatch(r"<urn:page:(-?\d+|null)(?::\d+)?>", uri)[1] if uri else "null"
    return None if ident == "null" else ident


def _row(fields: dict, payload: bool) -> tuple:
    response = fields["WARC-Type"] == "response"
    row = (
        _page(fields["WARC-Record-ID"]),
        fields["WARC-Target-URI"],
        fields["http_length"],
        fields["WARC-Payload-Digest"].removeprefix("sha1:"),
        fields["WARC-Type"],
        _page(fields.get("WARC-Refers-To")),
    )
    return (*row, fields["payload"] if response else None) if payload else row


def _write_files(batches, system, base: str, roll_bytes: int):
    """Write the sorted rows of one task; a file ends at its size or with its range."""
    from pyspark import TaskContext

    context = TaskContext.get()
    attempt = f"{context.stageId()}-{context.taskAttemptId()}"
    system.create_dir(base, recursive=True)
    out, done, current = None, [], None
    last, repeat = None, 0

    def close():
        out["stream"].close()
        done.append(
            (out["range"], out["part"], out["path"], out["name"], out["records"], out["bytes"], out["sha"].hexdigest())
        )

    for batch in batches:
        for row in batch.itertuples(index=False):
            number = int(row.range)
            if out is None or number != out["range"] or out["bytes"] >= roll_bytes:
                part = out["part"] + 1 if out is not None and number == out["range"] else 0
                if out is not None:
                    close()
                name = f"pages-{number:06d}-{part:04d}.warc.gz"
                target = f"{base}/{attempt}-{name}"
                out = {
                    "range": number, "part": part, "path": target, "name": name, "records": 0, "bytes": 0,
                    "sha": hashlib.sha256(), "stream": system.open_output_stream(target, compression=None),
                }
            ident = row.id or "null"
            current = (ident, row.url, row.sha)
            repeat = repeat + 1 if current == last else 0
            last = current
            uri = quote(row.url, safe="!#$%&'()*+,/:;=?@[]~", errors="replace")
            refers, refers_uri = None, None
            if not pd.isna(row.n):
                refers = row.first_id or "null"
                refers_uri = quote(row.first_url, safe="!#$%&'()*+,/:;=?@[]~", errors="replace")
                if (ident, row.url) == (refers, row.first_url) and not repeat:
                    refers = None
            digest = "" if not repeat else f":{repeat}"
            packed = member(record(f"{ident}{digest}", uri, utf8(row.payload), refers, refers_uri))
            out["stream"].write(packed)
            out["sha"].update(packed)
            out["records"] += 1
            out["bytes"] += len(packed)
    if out is not None:
        close()
    yield pd.DataFrame(done, columns=["range", "part", "temporary", "name", "records", "bytes", "sha256"])
