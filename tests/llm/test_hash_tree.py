"""Sharding: the law of the key, confinement of movement, gapless slots."""

from __future__ import annotations

import hashlib
import math
import os
import zlib
from collections import Counter

from gridsky.llm.hash_tree import HashTree, Leaf, place, shard_documents

SCHEMA = "doc_id long, text string, shard string, key string, bucket int, id int"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", 1, 2) for r in rows], SCHEMA)


def test_law_sizes_and_slots(spark):
    rows = [(i, f"text {i} ä" * (i % 5)) for i in range(3000)]
    rows += [(None, "n"), (None, None), (7, "same id"), (7, "same id"), (1 << 60, "z" * 100_000)]
    got = shard_documents(frame(spark, rows)).collect()
    assert len(got) == len(rows)
    where = {}
    slots = {}
    for r in got:
        assert r.law == "key" and 0 <= r.shard < 40
        # One more shard takes rows only into itself.
        assert r.grown_shard in (r.shard, 40)
        assert where.setdefault(r.doc_id, (r.shard, r.grown_shard)) == (r.shard, r.grown_shard)
        slots.setdefault(r.shard, []).append(r.slot)
    for found in slots.values():
        assert sorted(found) == list(range(len(found)))
    assert sorted((r.doc_id or -1, r.size, r.text_crc32) for r in got) == sorted(
        (i or -1, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t in rows
    )
    counts = Counter(r.shard for r in got)
    assert len(counts) == 40 and max(counts.values()) < 140
    assert 40 < sum(r.grown_shard == 40 for r in got) < 120


def descended(key, leaves):
    """The shard of a key, by a second descent: at each level the child with the least draw."""
    chosen = [("", leaves)]
    for name in (lambda x: x.region, lambda x: x.rack, lambda x: f"{x.rack}/s{x.shard}"):
        children = {}
        for leaf in chosen[0][1]:
            children.setdefault(name(leaf), []).append(leaf)
        draws = []
        for child, own in children.items():
            bits = int(hashlib.md5(f"{key}|{child}".encode()).hexdigest()[:13], 16)
            draws.append((-math.log((bits + 0.5) / 2**52) / sum(x.weight for x in own), child, own))
        chosen = [min(draws)[1:]]
    return chosen[0][1][0].shard


def test_every_row_against_a_second_descent(spark):
    sf = "/root/testdata/sf0.001/documents.parquet"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(sf).select("doc_id", "text").collect()] if os.path.exists(sf) else []
    rows += [(k * 7919 - 5000, "x") for k in range(300)] + [(None, "n"), (None, None), (-1, "ä"), (-1, "ä")]
    tree = HashTree.uniform()
    got = shard_documents(frame(spark, rows).repartition(3)).collect()
    want = Counter()
    for i, text in rows:
        key = "null" if i is None else str(i)
        raw = (text or "").encode()
        want[i, len(raw) + 16, zlib.crc32(raw), descended(key, tree.leaves), descended(key, tree.grown().leaves)] += 1
    assert Counter((r.doc_id, r.size, r.text_crc32, r.shard, r.grown_shard) for r in got) == want
    sizes = Counter(r.shard for r in got)
    assert all(sorted(r.slot for r in got if r.shard == s) == list(range(n)) for s, n in sizes.items())


def test_weights_set_the_shares_and_confine_movement(spark):
    rows = spark.range(6000).selectExpr("cast(id as string) as key")
    leaves = tuple(Leaf(f"r{s // 4}", f"r{s // 4}/k{s // 2}", s) for s in range(8))
    heavier = tuple(Leaf(x.region, x.rack, x.shard, 3.0 if x.shard == 0 else 1.0) for x in leaves)
    both = place(place(rows, "key", HashTree(leaves), "old"), "key", HashTree(heavier), "new").collect()
    share = Counter(r.new for r in both)
    assert abs(share[0] / len(both) - 0.3) < 0.03
    # Shards 4 to 7 are in the other region: rows only leave it, none moves within.
    assert all(r.new == r.old for r in both if r.new >= 4)
    # Shards 2 and 3 are in the other rack of the heavier region: rows come from outside, none moves within.
    assert all(r.new == r.old or r.old >= 4 for r in both if r.new in (2, 3))


def test_a_shard_without_weight_gets_nothing(spark):
    leaves = (Leaf("r", "r/k", 0, 0.0), Leaf("r", "r/k", 1, 1.0))
    rows = spark.range(50).selectExpr("cast(id as string) as key")
    assert {r.s for r in place(rows, "key", HashTree(leaves), "s").collect()} == {1}


def test_empty_table(spark):
    assert shard_documents(spark.createDataFrame([], SCHEMA)).count() == 0
