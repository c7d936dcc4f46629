"""The join against all pairs."""

from __future__ import annotations

import random

import numpy as np
import pytest

from gridsky.llm import ngram_join
from gridsky.llm.ngram_join import Join, components, jaccard_components, one_per_component, shingle_set, signatures

SCHEMA = "doc_id long, text string, d long, sig long, root long, t string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, 2, 3, "t") for r in rows], SCHEMA)


def sets(text):
    words = (text or "").encode().lower().split()
    if len(words) < 5:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4))


def expected(rows):
    """doc_id, n_shingles, component_id for ids that are not null."""
    s = [sets(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(s[i] & s[j])
            if both and 100 * both >= 75 * (len(s[i]) + len(s[j]) - both):
                parent[find(i)] = find(j)
    least = {}
    for i, (k, _) in enumerate(rows):
        if k is not None:
            least[find(i)] = min(k, least.get(find(i), k))
    return sorted(
        (-1 if k is None else k, len(s[i]), -1 if least.get(find(i)) is None else least[find(i)]) if s[i] else (-1 if k is None else k, 0, -1 if k is None else k)
        for i, (k, _) in enumerate(rows)
    )


def got(spark, rows):
    found = jaccard_components(frame(spark, rows).repartition(3)).collect()
    return sorted((-1 if r.doc_id is None else r.doc_id, r.n_shingles, -1 if r.component_id is None else r.component_id) for r in found)


def corpus(seed):
    """Families of near copies of different closeness, shared passages, short texts, copies."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choices("abcdefgh", k=rng.randint(2, 6)))
    shared = [word() for _ in range(30)]
    texts = []
    for _ in range(12):
        base = [word() for _ in range(rng.randint(8, 90))]
        if rng.random() < 0.4:
            base[3:3] = shared
        for _ in range(rng.randint(1, 9)):
            copy = list(base)
            for _ in range(rng.randint(0, 5)):
                copy[rng.randrange(len(copy))] = word()
            texts.append(" ".join(copy))
    # A hot family: many different near copies, in a chain and around a core.
    core = [word() for _ in range(60)]
    for k in range(60):
        copy = list(core)
        for _ in range(k % 6):
            copy[rng.randrange(len(copy))] = word()
        texts.append((" " if k % 2 else "\n").join(copy).title())
    texts += ["a b c d e", "A  b c d e", "a b c", "a b c", "a b", None, "", " \n", "x", "a b c d e f g", "a b c d e f g h"]
    texts += [texts[0]] * 40
    rng.shuffle(texts)
    rows = list(enumerate(texts))
    return rows + [((1 << 60) + 1, "a big id of its own"), (None, texts[3]), (None, "lonely words without any id at all"), (5, texts[5])]


@pytest.mark.parametrize("seed", [1, 2])
def test_components_against_all_pairs(spark, seed):
    rows = corpus(seed)
    assert got(spark, rows) == expected(rows)


def test_frequent_tokens_are_met_in_pairs(spark):
    """A family so large that its tokens are frequent; its members meet by combinations."""
    rng = random.Random(3)
    core = [f"w{k}" for k in range(70)]
    rows = []
    for i in range(400):
        copy = list(core)
        for _ in range(i % 5):
            copy[rng.randrange(70)] = f"x{rng.randrange(10**6)}"
        rows.append((i, " ".join(copy)))
    rows += [(1000 + i, " ".join(f"y{rng.randrange(10**6)}" for _ in range(40))) for i in range(100)]
    run = Join(frame(spark, rows), "doc_id", "text")
    assert run._signed().where("pair").count() > 0
    assert got(spark, rows) == expected(rows)


def test_similar_sets_share_a_signature():
    """The prefix property, with any split into rare and frequent tokens."""
    rng = np.random.default_rng(1)
    for _ in range(400):
        size = int(rng.integers(3, 80))
        pool = rng.choice(1 << 62, size + 40, replace=False).astype(np.uint64)
        a = np.sort(pool[:size])
        drop = int(rng.integers(0, size // 4 + 1))
        add = int(rng.integers(0, 3))
        b = np.sort(np.concatenate([rng.permutation(a)[drop:], pool[size : size + add]]))
        both = len(np.intersect1d(a, b))
        if 100 * both < 75 * (len(a) + len(b) - both) or len(b) < 3 or np.array_equal(a, b):
            continue
        marked = set(rng.choice(pool, int(rng.integers(0, len(pool))), replace=False).tolist())
        of = lambda s: signatures(s, np.array([x in marked for x in s.tolist()], dtype=bool))  # noqa: E731, B023
        (ra, pa, *_), (rb, pb, *_) = of(a), of(b)
        assert np.intersect1d(ra, rb).size or np.intersect1d(pa, pb).size


def test_shingles_follow_the_contract():
    assert len(shingle_set("A b\tC d\x0be")) == 1 and (shingle_set("A b\tC d\x0be") == shingle_set("a B c D E")).all()
    assert len(shingle_set("Ä b c d e")) == 1 and (shingle_set("Ä b c d e") != shingle_set("ä b c d e")).all()
    assert len(shingle_set("a b c")) == 1 and len(shingle_set(" \n")) == 0 and len(shingle_set(None)) == 0


def test_components_of_links(spark):
    links = [(1, 2), (2, 3), (9, 8), (8, 7), (7, 3), (20, 21), (30, 31), (31, 32), (40, 40)]
    links += [(100 + i, 101 + i) for i in range(50)] + [(-5, 20)]
    found = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert found == {
        **dict.fromkeys((1, 2, 3, 7, 8, 9), 1), **dict.fromkeys((-5, 20, 21), -5),
        **dict.fromkeys((30, 31, 32), 30), **dict.fromkeys(range(100, 151), 100),
    }


def test_one_row_of_each_component_stays(spark):
    text = "one two three four five six seven eight"
    rows = [(4, text), (2, text + " nine"), (2, text + " nine"), (None, text), (7, "other words"), (8, ""), (9, None), (None, "no id here")]
    left = one_per_component(frame(spark, rows))
    assert left.columns == frame(spark, rows).columns
    assert sorted((r.doc_id or -1, r.text or "") for r in left.collect()) == sorted(
        [(2, text + " nine"), (7, "other words"), (8, ""), (9, ""), (-1, "no id here")]
    )


def test_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert jaccard_components(empty).count() == 0 and one_per_component(empty).count() == 0


def test_gaps_round_trip():
    for buckets in ([0, 1, 255, 65_535], [7], list(range(0, 60_000, 200))):
        x = np.array(buckets, dtype=np.uint64)
        assert (ngram_join._from_gaps(ngram_join._gaps(x)) == x).all()
