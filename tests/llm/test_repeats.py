"""Maximal repeats against a table of all substrings."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from gridsky.llm import repeats
from gridsky.llm.repeats import anchors, bucket_cover, dedup_substrings, gram_hashes, intervals, maximal_repeats

SCHEMA = "doc_id long, text string, k1 long, h string, spans int"


def brute(rows, length):
    raws = [(i, (t or "").encode()) for i, t in rows]
    seen = Counter(r[s : s + length] for _, r in raws for s in range(len(r) - length + 1))
    out = []
    for i, r in raws:
        hit = [False] * len(r)
        for s in range(len(r) - length + 1):
            if seen[r[s : s + length]] > 1:
                hit[s : s + length] = [True] * length
        kept = bytes(b for b, h in zip(r, hit) if not h)
        runs = sum(h and (k == 0 or not hit[k - 1]) for k, h in enumerate(hit))
        out.append((i, len(r), sum(hit), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(map(repr, out))


def texts(seed, count=60):
    """Texts over few letters, with shared passages, copies, periods and edits."""
    rng = random.Random(seed)
    word = lambda n: "".join(rng.choices("abé", k=n))
    shared = [word(rng.randint(8, 40)) for _ in range(6)]
    rows = []
    for i in range(count):
        parts = [word(rng.randint(0, 25)) for _ in range(3)]
        for _ in range(rng.randint(0, 3)):
            parts.insert(rng.randrange(len(parts)), rng.choice(shared))
        rows.append((i, "".join(parts)))
    rows += [(100, "ab" * 50), (101, "a" * 60), (102, rows[0][1]), (103, rows[0][1][:-3] + "x" + rows[1][1])]
    rows += [(104, None), (105, ""), ((1 << 60) + 1, "short"), (None, rows[2][1]), (107, "twice " * 6), (107, "twice " * 6)]
    return rows


def got(spark, rows, **options):
    docs = spark.createDataFrame([(*r, 1, "h", 2) for r in rows], SCHEMA)
    found = dedup_substrings(docs, **options).drop("kept")
    return sorted(repr(tuple(r)) for r in found.collect())


@pytest.mark.parametrize("seed, cap", [(1, 1000), (2, 1)])
def test_spans_against_all_substrings(spark, seed, cap):
    """With a cap of one every bucket is settled by counting."""
    rows = texts(seed)
    assert got(spark, rows, length=12, gram=4, bucket_cap=cap) == brute(rows, 12)


def test_long_texts_are_scanned_in_blocks(spark, monkeypatch):
    # The workers are forked from the package on disk, so the block is cut here.
    monkeypatch.setattr(repeats, "BLOCK", 50)
    rows = texts(3)
    classes = Counter()
    found = {}
    for i, text in enumerate(t for _, t in rows):
        for h, c, first, left, right in repeats.text_anchors((text or "").encode(), 12, 4):
            classes[h, c] += 1
            found.setdefault(h, []).append((i, first, left, right))
    # Every start is owned once.
    owned = Counter((i, s) for f in found.values() for i, first, left, right in f for s in range(first, first + left + right - 11))
    assert set(owned.values()) <= {1}
    assert sum(owned.values()) == sum(max(0, len((t or "").encode()) - 11) for _, t in rows)


def test_anchors_are_leftmost_minima():
    rng = np.random.default_rng(0)
    for size in (5, 9, 60):
        hashes = rng.integers(0, 6, size).astype(np.uint64)
        for window in (1, 3, 5):
            owner = {}
            for place, first, last in anchors(hashes, window):
                for i in range(first, last + 1):
                    assert i not in owner
                    owner[i] = place
            assert owner == {i: i + int(hashes[i : i + window].argmin()) for i in range(size - window + 1)}


def test_equal_grams_hash_alike():
    data = np.frombuffer(b"abcabcabx", dtype=np.uint8)
    h = gram_hashes(data, 3)
    assert h[0] == h[3] and h[1] == h[4] and len(set(h.tolist())) == 4


def test_intervals_of_an_lcp_array():
    assert sorted(intervals([0, 2, 1, 1, 3])) == [(1, 0, 4), (2, 0, 1), (3, 3, 4)]


def test_bucket_cover_against_pairs():
    rng = random.Random(5)
    for _ in range(60):
        size = rng.randint(2, 9)
        contexts = []
        for _ in range(size):
            left = bytes(rng.choices(b"ab", k=rng.randint(0, 8)))
            right = b"XX" + bytes(rng.choices(b"ab", k=rng.randint(0, 8)))
            contexts.append((left + right, len(left)))
        want = {}
        for i, (a, x) in enumerate(contexts):
            for j, (b, y) in enumerate(contexts):
                if i == j:
                    continue
                l = next((k for k in range(min(x, y)) if a[x - 1 - k] != b[y - 1 - k]), min(x, y))
                n = min(len(a) - x, len(b) - y)
                r = next((k for k in range(n) if a[x + k] != b[y + k]), n)
                if l + r >= 7:
                    was = want.get(i, (0, 0))
                    want[i] = (max(was[0], l), max(was[1], r))
        assert bucket_cover(contexts, 7) == want


def test_groups_list_all_occurrences(spark):
    passage = "the quick brown fox jumps"
    rows = [(1, f"a {passage} b"), (2, f"{passage}!"), (3, f"zz{passage}"), (4, "nothing of the kind here")]
    docs = spark.createDataFrame([(*r, 1, "h", 2) for r in rows], SCHEMA)
    found = maximal_repeats(docs, length=12, gram=4).collect()
    text = dict(rows)
    groups = {}
    for r in found:
        groups.setdefault(r.group, []).append(text[r.doc_id][r.start : r.start + r.size])
    assert groups and all(len(g) >= 2 and len(set(g)) == 1 for g in groups.values())
    assert {r.doc_id for r in found} == {1, 2, 3}
    assert any(len(g) == 3 for g in groups.values())


def test_empty_table(spark):
    assert dedup_substrings(spark.createDataFrame([], SCHEMA)).count() == 0
