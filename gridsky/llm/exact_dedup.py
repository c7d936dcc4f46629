"""Exact dedup by skew-safe combining, in DataFrame functions only.

Texts are equal when they are identical after each run of white space is
replaced by one space. The row with the smallest id of a group stays.

1. Rows of one task with equal content are combined (the map side of the first
   aggregate), so a group of copies leaves a task as one row for each salt.
2. Salted groups (digest, salt, content) are merged; a hot group is spread over
   ``salts`` tasks.
3. The salts' winners are combined by (digest, content).

The content itself is a key of every stage, so a digest that two contents share
does no harm: the digest only spreads the rows. Decisions go back to the rows by
digest, for contested digests by digest and content.

Cases: a null text counts as empty; null ids come after all others, and a group
of null ids only has a null ``keep_id``; of repeated rows (same id and content)
one stays; an empty table gives an empty result; other columns are ignored,
whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridsky.llm.common import WHITE_SPACE, staged, text_or_empty

#: Tasks that a hot group of copies is spread over before its winners meet.
SALTS = 32


def normalised(text: Column) -> Column:
    return F.regexp_replace(text_or_empty(text), WHITE_SPACE, " ")


def sha256_hex(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def _classes(rows: DataFrame, salts: int) -> DataFrame:
    """(digest, content) -> keep_id, group_size, by local, salted and global combining."""
    salted = rows.groupBy("digest", (F.xxhash64("id") % salts).alias("salt"), "content").agg(
        F.min("id").alias("id"), F.count(F.lit(1)).alias("n")
    )
    return salted.groupBy("digest", "content").agg(
        F.min("id").alias("keep_id"), F.sum("n").alias("group_size")
    )


def exact_dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    digest: Callable[[Column], Column] = sha256_hex,
    salts: int = SALTS,
) -> DataFrame:
    """One row per input row: ``id_col``, keep_id, group_size, kept, text_sha256."""
    rows = docs.select(
        F.col(id_col).alias("id"), normalised(F.col(text_col)).alias("content")
    ).select("id", digest(F.col("content")).alias("digest"), "content")

    # The tag tells repeated rows apart; once written, it no longer changes.
    ids = staged(
        rows.select(
            "id",
            "digest",
            sha256_hex(F.col("content")).alias("text_sha256"),
            F.monotonically_increasing_id().alias("tag"),
        ),
        "dedup-rows",
    )
    classes = staged(
        _classes(rows, salts).select(
            "digest", sha256_hex(F.col("content")).alias("text_sha256"), "keep_id", "group_size"
        ),
        "dedup-classes",
    )
    key = ["digest", "text_sha256"]
    contested = staged(
        classes.groupBy(*key).count().where("count > 1").select(*key), "dedup-contested"
    )
    decided = ids.join(classes, key)
    if not contested.isEmpty():
        again = (
            rows.withColumn("text_sha256", sha256_hex(F.col("content")))
            .withColumn("tag", F.monotonically_increasing_id())
            .join(contested, key, "left_semi")
        )
        again = staged(again, "dedup-contested-rows")
        settled = again.join(_classes(again, salts), ["digest", "content"])
        decided = decided.join(contested, key, "left_anti").unionByName(settled.drop("content"))

    # Usually one row of a class has the class's id; repeated rows are settled by tag.
    first = (
        decided.where(F.col("id").eqNullSafe(F.col("keep_id")))
        .groupBy("digest", "text_sha256", "keep_id", "group_size")
        .agg(F.min("tag").alias("first_tag"))
        .select("first_tag")
    )
    return decided.join(first, F.col("tag") == F.col("first_tag"), "left").select(
        F.col("id").alias(id_col),
        "keep_id",
        "group_size",
        F.col("first_tag").isNotNull().alias("kept"),
        "text_sha256",
    )
