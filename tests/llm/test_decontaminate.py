"""Search with block bounds against scoring everything."""

from __future__ import annotations

import math
import random
from collections import Counter

import pytest

from gridsky.llm.decontaminate import (
    B, K1, BlockIndex, benchmark_matches, drop_contaminated, question_and_answer, shingles,
)

DOCS = "doc_id long, text string, id int, passages string, item_id string"
ITEMS = "item_id long, text string, doc_id int"


def brute(rows, items, threshold=0.5):
    """Every passage against every item."""
    split = [(i, (t or "").encode().lower().split()) for i, t in items]
    split = [(i, w) for i, w in split if w]
    df = Counter(w for _, x in split for w in set(x))
    mean = sum(len(x) for _, x in split) / len(split)
    longest = max(len(x) for _, x in split)
    out = []
    for d, text in rows:
        words = (text or "").encode().lower().split()
        starts = range(0, max(1, len(words) - longest), longest) if words else []
        for item, x in split:
            weight = {
                w: math.log(1 + (len(split) - df[w] + 0.5) / (df[w] + 0.5)) * n * (K1 + 1) / (n + K1 * (1 - B + B * len(x) / mean))
                for w, n in Counter(x).items()
            }
            hits = []
            for s in starts:
                passage = words[s : s + 2 * longest]
                if sum(weight[w] for w in set(passage) if w in weight) / sum(weight.values()) < threshold:
                    continue
                parts = [shingles(p, min(5, len(p))) for p in question_and_answer(x)]
                found = [len(p & shingles(passage, len(next(iter(p))))) for p in parts]
                if all(100 * f >= 75 * len(p) for f, p in zip(found, parts)):
                    hits.append(found)
            if hits:
                out.append((d, item, len(hits), max(h[0] for h in hits), max(h[1] for h in hits)))
    return sorted(map(repr, out))


def data(seed):
    rng = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(80)]
    text = lambda n: " ".join(rng.choice(vocabulary) + ("." if rng.random() < 0.15 else "") for _ in range(n))
    items = [(i, text(rng.randint(1, 25))) for i in range(40)] + [(50, None), (51, " "), (52, "single"), (53, "w1 w2"), (54, "w1 w2")]
    rows = []
    for i in range(60):
        words = text(rng.randint(0, 150)).split()
        for _ in range(rng.randint(0, 2)):
            planted = rng.choice(items[:40])[1].split()
            if rng.random() < 0.4:
                planted[rng.randrange(len(planted))] = "edited"
            at = rng.randint(0, len(words))
            words[at:at] = planted
        rows.append((i, " ".join(words).upper() if i % 7 == 0 else "\n".join(words)))
    return rows + [(100, None), (101, ""), ((1 << 60) + 1, items[5][1]), (None, items[3][1]), (102, rows[1][1]), (102, rows[1][1])], items


@pytest.mark.parametrize("seed, max_items", [(1, 2000), (2, 7)])
def test_matches_against_scoring_all(spark, seed, max_items):
    """With seven items to a part, the index is cut into several."""
    rows, items = data(seed)
    docs = spark.createDataFrame([(*r, 1, "p", "i") for r in rows], DOCS)
    got = benchmark_matches(docs, spark.createDataFrame([(*i, 1) for i in items], ITEMS), max_items=max_items)
    found = sorted(repr(tuple(r)) for r in got.collect())
    assert found == brute(rows, items) and len(found) > 20


def test_bounds_are_never_below_the_score():
    rows, items = data(3)
    split = [(i, (t or "").lower().split()) for i, t in items]
    df = Counter(w.encode() for _, x in split for w in set(x))
    totals = {"items": 44, "mean": 10.0, "longest": 25, "df": df}
    index = BlockIndex([(i, t) for i, t in items if t and t.strip()], totals)
    import numpy as np

    for _, text in rows[:20]:
        terms = {index.terms[w] for w in (text or "").encode().lower().split() if w in index.terms}
        if not terms:
            continue
        bound = index.bounds([np.array(sorted(terms))])[0]
        for block in range(index.blocks):
            score = Counter()
            for t in terms:
                for at, x in index.postings[block].get(t, ()):
                    score[at] += x
            assert max(score.values(), default=0) <= bound[block] + 1e-5
            assert set(index.walk(block, list(terms), 0.5)) == {a for a, s in score.items() if s >= 0.5}


def test_contaminated_rows_go(spark):
    rows, items = data(4)
    docs = spark.createDataFrame([(*r, 1, "p", "i") for r in rows], DOCS)
    bench = spark.createDataFrame([(*i, 1) for i in items], ITEMS)
    hit = {eval(r)[0] for r in brute(rows, items)}
    left = drop_contaminated(docs, bench)
    assert left.columns == docs.columns
    assert sorted(str(r.doc_id) for r in left.collect()) == sorted(str(i) for i, _ in rows if i not in hit)


def test_clean_rows_stay_beside_contaminated_ones_of_their_id(spark):
    bench = [(1, "alpha beta gamma delta epsilon zeta? eta theta"), (2, "unseen words only here? none")]
    leak = "before " + bench[0][1] + " after"
    rows = [(None, leak), (None, "clean text without id"), (None, None), (7, leak), (7, "another clean text"), (7, ""), (8, "clean")]
    docs = spark.createDataFrame([(*r, 1, "p", "i") for r in rows], DOCS)
    left = drop_contaminated(docs, spark.createDataFrame([(*i, 1) for i in bench], ITEMS))
    assert sorted(repr((r.doc_id, r.text)) for r in left.collect()) == sorted(repr(r) for r in rows if r[1] != leak)


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "w1 w2", 1, "p", "i")], DOCS)
    bench = spark.createDataFrame([(1, "w1 w2", 1)], ITEMS)
    assert benchmark_matches(docs, bench.limit(0)).count() == 0
    assert benchmark_matches(docs.limit(0), bench).count() == 0
    assert benchmark_matches(docs, bench).count() == 1
