"""Small notes in the shared folder, through Spark's own file systems."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    return spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)


def _system(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def names(spark: SparkSession, path: str) -> list[str]:
    """What a folder holds, in order; nothing if there is no folder."""
    system, folder = _system(spark, path), _path(spark, path)
    if not system.exists(folder):
        return []
    return sorted(status.getPath().getName() for status in system.listStatus(folder))


def modified(spark: SparkSession, path: str) -> int:
    """Epoch milliseconds of the last change."""
    return _system(spark, path).getFileStatus(_path(spark, path)).getModificationTime()


def read_text(spark: SparkSession, path: str) -> str:
    stream = _system(spark, path).open(_path(spark, path))
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def create_text(spark: SparkSession, path: str, text: str) -> None:
    """Make a small file that appears whole or not at all; there must be none yet."""
    system, target = _system(spark, path), _path(spark, path)
    if system.exists(target):
        raise FileExistsError(path)
    folder, name = path.rsplit("/", 1)
    draft = _path(spark, f"{folder}/.{name}-{uuid.uuid4().hex}")
    stream = system.create(draft, False)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    if not system.rename(draft, target):
        system.delete(draft, False)
        raise FileExistsError(path)


def delete(spark: SparkSession, path: str) -> None:
    """Delete a file or folder, if there."""
    _system(spark, path).delete(_path(spark, path), True)
