"""Vector codes against exhaustive search in Python's whole numbers."""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridsky.llm.grid_codes import Codebook, codebooks_digest, compress_vectors, decode, kept_vectors, train_codebooks, whole

SCHEMA = "vec_id long, embedding array<double>, label int"
LARGEST = (1 << 63) - 1


def brute(rows, parts=4, size=256, rounds=4):
    """Rows of (vec_id, code, error, label_error, digest)."""
    kept = [r for r in rows if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    kept = [r for r in kept if len(r[1]) == len(kept[0][1])]
    if not kept or not kept[0][1] or len(kept[0][1]) % parts:
        return []
    width = len(kept[0][1]) // parts
    numbers = [[int(x) * 1024 if abs(x) >= 2**53 else math.floor(x * 1024) for x in r[1]] for r in kept]
    cut = [[v[p * width : (p + 1) * width] for v in numbers] for p in range(parts)]
    books = [[list(x) for x in own[:size]] for own in cut]

    def nearest(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, y)), e) for e, y in enumerate(book))

    for _ in range(rounds):
        for own, book in zip(cut, books):
            members = {}
            for x in own:
                members.setdefault(nearest(x, book)[1], []).append(x)
            for e, xs in members.items():
                book[e] = [sum(c) // len(xs) for c in zip(*xs)]
    found = [[nearest(own[k], book) for own, book in zip(cut, books)] for k in range(len(kept))]
    digest = hashlib.sha256(",".join(str(c) for b in books for e in b for c in e).encode()).hexdigest()
    errors = [min(sum(d for d, _ in f), LARGEST) for f in found]
    by_label = {}
    for r, e in zip(kept, errors):
        by_label[r[2]] = by_label.get(r[2], 0) + e
    return sorted(
        [(r[0], "".join(f"{e:02x}" for _, e in f), x, min(by_label[r[2]], LARGEST), digest) for r, f, x in zip(kept, found, errors)], key=repr
    )


def compared(spark, rows, **options):
    got = compress_vectors(spark.createDataFrame(rows, SCHEMA).repartition(3), **options)
    assert sorted([tuple(r) for r in got.collect()], key=repr) == brute(rows, **options)


@pytest.mark.parametrize("size, rounds", [(256, 4), (7, 2)])
def test_codes_equal_search(spark, size, rounds):
    rng = np.random.default_rng(size)
    centres = rng.normal(size=(9, 8))
    rows = [(int(k), (centres[k % 9] + rng.normal(size=8) * 0.1).tolist(), None if k % 7 == 0 else int(k % 3)) for k in range(320)]
    compared(spark, rows, size=size, rounds=rounds)


def test_nulls_ties_copies_and_odd_lengths(spark):
    rows = [(k, [0.5, -0.25, 1.0, 2.0], 1) for k in range(40)]
    rows += [(k % 5, [k / 8, 0.0, -0.0, float(k % 2)], None) for k in range(30)] + [(None, [1.0, 1.0, 1.0, 1.0], 1)] * 2
    rows += [(90, None, 1), (91, [1.0, None, 2.0, 2.0], 1), (92, [1.0, math.nan, 2.0, 2.0], 1), (93, [1.0, -math.inf, 2.0, 2.0], 1)]
    rows += [(94, [1.0], 1), (95, [], 1)]
    compared(spark, rows, size=4)


def test_numbers_of_any_size_stay_exact(spark):
    rows = [(k, [k * 1e3, -1e300 if k == 5 else 0.1, 3e38 * (k % 2), float(k) / 1024], k % 2) for k in range(20)]
    compared(spark, rows, size=5)


def test_empty_tables_and_lengths_that_do_not_divide(spark):
    assert compress_vectors(spark.createDataFrame([], SCHEMA)).collect() == []
    assert compress_vectors(spark.createDataFrame([(1, [1.0, 2.0, 3.0], 1)], SCHEMA)).collect() == []
    assert compress_vectors(spark.createDataFrame([(1, None, 1), (2, [], 1)], SCHEMA)).collect() == []


def test_clashing_columns_and_kept_types(spark):
    frame = spark.createDataFrame(
        [("b", [1.0, 2.0], "x", 1, "c"), ("a", [3.0, 4.0], None, 2, "d")],
        "vec_id string, embedding array<float>, label string, error int, code string",
    ).withColumn("id", F.lit(1))
    got = compress_vectors(frame, parts=2)
    assert got.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    assert sorted((r.vec_id, r.code, r.error) for r in got.collect()) == [("a", "0000", 0), ("b", "0101", 0)]


def test_cells_leave_few_entries_and_lose_none():
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(256, 16)) * 0.3
    parts = whole(centres[rng.integers(0, 256, 2000)] + rng.normal(size=(2000, 16)) * 0.01)
    parts = np.concatenate([parts, parts[:500]])
    entries = whole(centres)
    want = ((parts[:, None, :] - entries[None]) ** 2).sum(axis=2)
    for cache in (10_000, 3):
        book = Codebook(entries.tolist(), cache=cache)
        index, distance = book.nearest(parts)
        assert (index == want.argmin(axis=1)).all() and (distance == want.min(axis=1)).all()
    assert book.evaluated < 0.2 * want.size


def test_a_code_stands_for_its_entries(spark):
    rows = spark.createDataFrame([(k, [float(k), 0.0, float(-k), 1.0], 0) for k in range(10)], SCHEMA)
    books = train_codebooks(kept_vectors(rows, "vec_id", "embedding", "label", 4))
    [row] = compress_vectors(rows).where("vec_id = 3").collect()
    assert decode(row.code, books) == [3072, 0, -3072, 1024] and row.codebooks_sha256 == codebooks_digest(books)
