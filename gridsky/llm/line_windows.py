"""Line dedup by overlapping windows of three lines.

Every run of three consecutive lines is hashed. Windows that occur more than
once anywhere are found by a count with a map side; all occurrences but the
earliest, by (id, hash of id and text, position), are later ones. The lines that a later window
covers go; overlapping windows merge, so a repeated passage of any length from
three lines on goes whole and its first occurrence stays, but for the lines in which it overlaps a
later occurrence of itself: of a, a, a, a the first stays. Windows are judged on the input.

A window that very many texts share leaves a task as one row; the join that
finds its later occurrences has two plain exchanges, so it can be split there.

Cases: null and empty texts have no windows, nor have texts of less than three
lines; windows of three lines without words are not compared, so blank lines stay; null
ids rank last; rows that repeat in id and text are the same document, neither
is later than the other, and all get the same result; an empty table gives an empty result;
very long texts are hashed line by line; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridsky.llm.common import KEY, as_text, cast_back, checked_broadcast, keyed_texts, small_batches, staged, utf8

#: Lines in a window.
WINDOW = 3


def windows(raw: bytes, size: int = WINDOW) -> list[tuple[int, bytes]]:
    """(position, digest) of each window that holds a word."""
    lines = raw.split(b"\n")
    if len(lines) < size:
        return []
    digests = [hashlib.blake2b(x, digest_size=16).digest() for x in lines]
    words = [bool(x.strip()) for x in lines]
    return [
        (i, hashlib.blake2b(b"".join(digests[i : i + size]), digest_size=16).digest())
        for i in range(len(lines) - size + 1)
        if any(words[i : i + size])
    ]


def _later(texts: DataFrame, size: int) -> DataFrame:
    """k1, k2, positions of the later windows of each text."""

    def scan(batches):
        for batch in batches:
            columns = [[] for _ in range(5)]
            for i, k1, k2, text in zip(batch["id"], batch["k1"], batch["k2"], batch["text"]):
                for row in windows(utf8(text), size):
                    for column, value in zip(columns, (i, k1, k2, *row)):
                        column.append(value)
            if columns[0]:
                yield pd.DataFrame(dict(zip(("id", "k1", "k2", "at", "w"), columns)))

    kind = dict(texts.dtypes)["id"]
    rows = texts.select(*as_text("id"), *KEY, "text")
    found = rows.mapInPandas(scan, "id string, k1 long, k2 long, at int, w binary")
    found = staged(cast_back(found, id=kind), "line-windows")
    # k2 tells different texts under one id apart, or under none.
    rank = F.struct(F.col("id").isNull().alias("unknown"), "id", "k2", "at")
    first = found.groupBy("w").agg(F.min(rank).alias("first"), F.count(F.lit(1)).alias("n"))
    first = staged(first.where("n > 1").select("w", "first"), "line-repeated")
    later = found.join(first, "w").where(rank != F.col("first"))
    return later.groupBy(*KEY).agg(F.collect_set("at").alias("positions"))


def dedup_lines(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    size: int = WINDOW,
    with_kept: bool = True,
) -> DataFrame:
    """``id_col``, n_lines, n_removed, n_spans, kept_sha256 and (``with_kept``) the text kept, for every row."""
    small_batches(docs.sparkSession)
    texts = keyed_texts(docs, id_col, text_col)
    later = staged(_later(texts, size), "line-later")
    joined = texts.join(checked_broadcast(later, "positions"), KEY, "left").select(*as_text("id"), "text", "positions")
    names = [id_col, "n_lines", "n_removed", "n_spans", "kept_sha256", "kept"][: 5 + with_kept]

    def cut(batches):
        for batch in batches:
            made = []
            for i, text, positions in zip(batch["id"], batch["text"], batch["positions"]):
                raw = utf8(text)
                lines = raw.split(b"\n") if raw else []
                gone = set() if positions is None else {p + k for p in positions for k in range(size)}
                kept = b"\n".join(x for k, x in enumerate(lines) if k not in gone)
                spans = sum(k - 1 not in gone for k in gone)
                row = (i, len(lines), len(gone), spans, hashlib.sha256(kept).hexdigest(), kept.decode("utf-8", "replace"))
                made.append(row[: len(names)])
            yield pd.DataFrame(made, columns=names)

    kind = dict(texts.dtypes)["id"]
    schema = f"`{id_col}` string, n_lines long, n_removed long, n_spans long, kept_sha256 string"
    return cast_back(joined.mapInPandas(cut, schema + ", kept string" * with_kept), **{id_col: kind})
