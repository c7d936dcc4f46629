"""Helpers that several operators of this package share."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridsky.session import fresh_dir

# Fixed by the data contracts: the white space that separates words, as a pattern.
WHITE_SPACE = "[\\x20\\x09-\\x0D]+"

#: Rows in one Arrow batch; texts are long, so the default of 10,000 rows is far too many.
BATCH_ROWS = 256


#: Shuffle files of a write are deleted when it has ended, not when their objects are collected.
RELEASE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    """A setting of the session that holds for a block."""
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def staged_at(rows: DataFrame, label: str) -> tuple[DataFrame, str]:
    """``staged``, and where it is, for those who ``discard`` it."""
    path = fresh_dir(rows.sparkSession, label)
    with setting(rows.sparkSession, RELEASE, "true"):
        rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path), path


def staged(rows: DataFrame, label: str) -> DataFrame:
    """Write to the shared working folder and read again: cuts lineage, survives lost executors.

    Reading it again gives the same rows each time, also where ``rows`` itself
    would not (row tags, ties in a sort). What was shuffled to make it is deleted at once.
    """
    return staged_at(rows, label)[0]


def discard(spark: SparkSession, path: str) -> None:
    """Delete a staged table that no frame reads any more."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def small_batches(spark: SparkSession) -> None:
    """Keep Arrow batches small in this session. Only ever lowers the setting."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(name))
    if now <= 0 or now > BATCH_ROWS:
        spark.conf.set(name, str(BATCH_ROWS))


def width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def text_or_empty(text: Column) -> Column:
    return F.coalesce(text.cast("string"), F.lit(""))


#: The key of ``keyed_texts``.
KEY = ["k1", "k2"]


def keyed_texts(docs: DataFrame, id_col: str, text_col: str, *more: Column) -> DataFrame:
    """id, text and a key of 128 bits that tells (id, text) apart from all others, and ``more``."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"), *more)
    return rows.select("*", F.xxhash64("text").alias("k1"), F.xxhash64("id", "text").alias("k2"))


def as_text(*names: str) -> list[Column]:
    """Ids as text, for the way through pandas: a column of whole numbers with nulls becomes floats there."""
    return [F.col(n).cast("string").alias(n) for n in names]


def cast_back(rows: DataFrame, **kinds: str) -> DataFrame:
    return rows.withColumns({n: F.col(n).cast(kind) for n, kind in kinds.items()})


def utf8(text: str | None) -> bytes:
    """UTF-8 bytes of a text that came through Arrow; null is empty."""
    return b"" if text is None else text.encode("utf-8", "surrogatepass")


def words_of(raw: bytes) -> list[bytes]:
    """Lower-cased words: A-Z only, split at space and \\x09-\\x0D, as bytes.split() does."""
    return raw.lower().split()


def hash64(raw: bytes) -> int:
    """A signed 64-bit digest, the same on every machine."""
    return int.from_bytes(hashlib.blake2b(raw, digest_size=8).digest(), "big", signed=True)


#: An odd base for the polynomial hash modulo 2**64, and its inverse.
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: list[np.ndarray] = []


def base_powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, modulo 2**64; kept for the next call."""
    if not _powers or len(_powers[0]) < size:
        room = 1 << max(16, (size - 1).bit_length())
        made = []
        for base in (_BASE, _INVERSE):
            run = np.full(room, base, dtype=np.uint64)
            run[0] = 1
            made.append(np.multiply.accumulate(run))
        _powers[:] = made
    return _powers[0][:size], _powers[1][:size]


def running_hash(data: np.ndarray) -> np.ndarray:
    """Running polynomial of bytes: the string [a, b) hashes to (r[b] - r[a]) * inverse power a."""
    up, _ = base_powers(len(data))
    total = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up, out=total[1:])
    return total


def mix64(x: np.ndarray) -> np.ndarray:
    """Scatter the bits of uint64 values, one to one (shift-multiply rounds)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


#: Keys or numbers that may be broadcast, at most; one takes a few bytes.
BROADCAST_KEYS = 500_000


def checked_broadcast(keys: DataFrame, numbers: str | None = None) -> DataFrame:
    """Mark a staged table of keys for broadcast if it is small; otherwise leave the join to a shuffle.

    ``numbers`` names a column that holds an array; its elements count as well.
    """
    weight = F.lit(1) if numbers is None else F.size(numbers) + 1
    size = keys.agg(F.coalesce(F.sum(weight), F.lit(0))).first()[0]
    return F.broadcast(keys) if size <= BROADCAST_KEYS else keys


def without(docs: DataFrame, gone: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The rows of ``docs`` whose id and text hash are not in the staged table ``gone`` (id, t).

    Rows travel as structs, so their own columns may have any names.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    rows = docs.select(row.alias("row"), F.col(id_col).alias("own_id"), F.xxhash64(F.col(text_col).cast("string")).alias("own_t"))
    same = (F.col("own_t") == F.col("t")) & F.col("own_id").eqNullSafe(F.col("id"))
    return rows.join(checked_broadcast(gone), same, "left_anti").select("row.*")
