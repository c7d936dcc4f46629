"""Substring dedup by hashing lines or paragraphs.

A text is cut into units: lines, or paragraphs between blank lines. A unit is
normalised (lower case, each run of white space one space, none at the ends) and hashed.
Equal digests are grouped by an aggregate with a map side; the occurrence of the
lowest rank stays and all others go, with their byte offsets in the original
text. The rank is (``rank_col`` if given, id, hash of id and text, position), nulls last. Units of fewer
than ``min_words`` words are never compared; by default that leaves out blank ones only.

A unit that a third of the texts share leaves a task as one row; the join that finds its
other occurrences has two plain exchanges, so it can be split there. Texts meet their lists of
removed units in one exchange by (id, text), at every size alike.

Cases: null and empty texts have no units; rows that repeat in id and text are
the same document, and all get the same result; ties in ``rank_col`` go by id; an empty
table gives an empty result; a very long unit is hashed whole; other columns are ignored, whatever
their names.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridsky.llm.common import KEY, as_text, cast_back, keyed_texts, small_batches, staged, utf8

#: Words that a unit must have to be compared; blank units never are.
MIN_WORDS = 1
#: What separates units, as bytes.
SEPARATORS = {"line": rb"\n", "paragraph": rb"\n[\x20\x09\x0B-\x0D]*\n"}


def units(raw: bytes, unit: str = "line") -> Iterator[tuple[int, int]]:
    """Byte offsets (begin, end) of the units, without their separators."""
    begin = 0
    for found in re.finditer(SEPARATORS[unit], raw):
        yield begin, found.start()
        begin = found.end()
    yield begin, len(raw)


def unit_digest(raw: bytes, min_words: int = MIN_WORDS) -> bytes | None:
    """Digest of the normalised unit; None if it has too few words."""
    words = raw.decode("utf-8", "replace").lower().encode().split()
    return hashlib.blake2b(b" ".join(words), digest_size=16).digest() if len(words) >= min_words else None


def removed_units(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    unit: str = "line",
    min_words: int = MIN_WORDS,
    rank_col: str | None = None,
) -> DataFrame:
    """Every unit that goes: id, k1, k2, begin, end (bytes), and keep_id, keep_begin of the one that stays."""
    small_batches(docs.sparkSession)
    rank_by = F.col(rank_col) if rank_col else F.lit(0)
    texts = keyed_texts(docs, id_col, text_col, rank_by.alias("r"))
    kinds = dict(texts.dtypes)

    def scan(batches):
        for batch in batches:
            columns = [[] for _ in range(7)]
            for i, r, k1, k2, text in zip(*[batch[c] for c in ("id", "r", "k1", "k2", "text")]):
                raw = utf8(text)
                for begin, end in units(raw, unit):
                    digest = unit_digest(raw[begin:end], min_words)
                    if digest:
                        for column, value in zip(columns, (i, r, k1, k2, begin, end, digest)):
                            column.append(value)
            if columns[0]:
                yield pd.DataFrame(dict(zip(("id", "r", "k1", "k2", "begin", "end", "u"), columns)))

    rows = texts.where("text <> ''").select(*as_text("id", "r"), *KEY, "text")
    found = rows.mapInPandas(scan, "id string, r string, k1 long, k2 long, begin long, end long, u binary")
    found = staged(cast_back(found, id=kinds["id"], r=kinds["r"]), "units")
    # k2 tells different texts under one id apart, or under none.
    rank = F.struct(
        F.col("r").isNull().alias("unranked"), "r", F.col("id").isNull().alias("unknown"), "id", "k2", "begin"
    )
    first = found.groupBy("u").agg(F.min(rank).alias("first"), F.count(F.lit(1)).alias("n"))
    first = staged(first.where("n > 1").select("u", "first"), "units-repeated")
    return (
        found.join(first, "u")
        .where(rank != F.col("first"))
        .select("id", *KEY, "begin", "end", F.col("first.id").alias("keep_id"), F.col("first.begin").alias("keep_begin"))
    )


def dedup_units(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    unit: str = "line",
    min_words: int = MIN_WORDS,
    rank_col: str | None = None,
    with_kept: bool = True,
) -> DataFrame:
    """``id_col``, n_bytes, n_units, n_removed, removed, kept_sha256 and (``with_kept``) the text kept, for every row.

    n_removed counts units; ``removed`` lists their byte offsets in the original as
    "begin-end,..."; the text kept is the other units, lines joined by a line end, paragraphs by a blank line.
    """
    gone = removed_units(docs, id_col, text_col, unit, min_words, rank_col)
    lists = staged(gone.groupBy(*KEY).agg(F.collect_set("begin").alias("begins")), "units-removed")
    texts = keyed_texts(docs, id_col, text_col)
    joined = texts.join(lists.hint("merge"), KEY, "left").select(*as_text("id"), "text", "begins")
    names = [id_col, "n_bytes", "n_units", "n_removed", "removed", "kept_sha256", "kept"][: 6 + with_kept]

    def cut(batches):
        for batch in batches:
            made = []
            for i, text, begins in zip(batch["id"], batch["text"], batch["begins"]):
                raw = utf8(text)
                spans = list(units(raw, unit)) if raw else []
                out = set() if begins is None else set(begins)
                joint = b"\n" if unit == "line" else b"\n\n"
                kept = joint.join(raw[a:b] for a, b in spans if a not in out)
                listed = ",".join(f"{a}-{b}" for a, b in spans if a in out)
                row = (i, len(raw), len(spans), len(out), listed, hashlib.sha256(kept).hexdigest(), kept.decode("utf-8", "replace"))
                made.append(row[: len(names)])
            yield pd.DataFrame(made, columns=names)

    kind = dict(texts.dtypes)["id"]
    schema = f"`{id_col}` string, n_bytes long, n_units long, n_removed long, removed string, kept_sha256 string"
    return cast_back(joined.mapInPandas(cut, schema + ", kept string" * with_kept), **{id_col: kind})
