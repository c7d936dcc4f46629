"""Exact dedup against a plain grouping, with sound and with colliding digests."""

from __future__ import annotations

import hashlib
import re

import pytest
from pyspark.sql import functions as F

from gridsky.llm.exact_dedup import exact_dedup

SCHEMA = "doc_id long, text string, keep_id string, digest int, tag int, id int, content int"
ROWS = [
    (5, "a  b"), (3, "a\tb"), (9, "a b"), (1, " a b"), (2, ""), (7, None), (4, "  "), (8, " "),
    (6, "x" * 70_000), (10, "x" * 70_000), (11, "x" * 69_999), (12, "ä b"), (13, "ä\n\r b"),
    (20, "twice"), (20, "twice"), (None, "a b"), (None, "only null"), (None, "only null"), (30, "A b"),
]


def expected(rows):
    groups = {}
    for i, text in rows:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", text or ""), []).append(i)
    out = []
    for content, ids in groups.items():
        known = [i for i in ids if i is not None]
        keep = min(known) if known else None
        kept = False
        for i in ids:
            stays = i == keep and not kept
            kept = kept or stays
            out.append((i, keep, len(ids), stays, hashlib.sha256(content.encode()).hexdigest()))
    return sorted(map(repr, out))


def frame(spark, rows):
    return spark.createDataFrame([(*r, "k", 1, 2, 3, 4) for r in rows], SCHEMA)


def result(docs, **options):
    got = exact_dedup(docs, **options)
    assert got.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    return sorted(repr(tuple(r)) for r in got.collect())


def test_groups_and_edge_cases(spark):
    assert result(frame(spark, ROWS)) == expected(ROWS)


def test_digests_that_collide_do_not_merge_texts(spark):
    def weak(text):
        return F.lit("same")

    assert result(frame(spark, ROWS), digest=weak) == expected(ROWS)


def test_one_group_holds_most_rows(spark):
    rows = [(i, "copy  text" if i % 3 else f"own {i}") for i in range(600)]
    assert result(frame(spark, rows).repartition(7)) == expected(rows)


def test_empty_table(spark):
    assert exact_dedup(spark.createDataFrame([], SCHEMA)).count() == 0


@pytest.mark.parametrize("salts", [1, 64])
def test_salts_change_nothing(spark, salts):
    assert result(frame(spark, ROWS), salts=salts) == expected(ROWS)
