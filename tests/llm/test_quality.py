"""The factorisation machine: its identity, its accuracy on held-out rows, edge cases."""

from __future__ import annotations

import math
import os
import zlib

import numpy as np
import pytest

from gridsky.llm.quality_fm import FactorisationMachine, features, fit, keep_good, score_documents, train

SF = "/root/testdata/sf0.01"
DOCS = "doc_id long, text string, n_chars long, score string, label string, predicted string"
LABELS = "doc_id long, quality int, toxic int, text string"


def test_sum_of_squares_is_the_sum_over_pairs():
    rng = np.random.default_rng(0)
    model = FactorisationMachine(0.3, rng.normal(size=20).astype(np.float32), rng.normal(size=(20, 4)).astype(np.float32))
    rows = [(np.array([1, 5, 7], np.int32), np.array([1, 0.5, 2], np.float32)), (np.array([0], np.int32), np.array([1], np.float32))]
    for (index, x), got in zip(rows, model.raw(rows)):
        pairs = sum(
            float(model.v[index[a]] @ model.v[index[b]]) * x[a] * x[b] for a in range(len(x)) for b in range(a)
        )
        assert abs(got - (model.w0 + float(model.w[index] @ x) + pairs)) < 1e-4


def test_fit_learns_an_interaction():
    """Neither feature tells the classes apart, only both together."""
    one = np.ones(2, np.float32)
    rows = [(np.array(i, np.int32), one) for i in ((0, 2), (1, 3), (0, 3), (1, 2))] * 50
    model = fit(rows, [1, 1, 0, 0] * 50, 4, epochs=60)
    assert ((model.score(rows[:4]) > 0.5) == [True, True, False, False]).all()


@pytest.mark.skipif(not os.path.isdir(SF), reason="shared tables not present")
def test_held_out_rows_are_scored_well(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    rows = score_documents(docs, labels).collect()
    assert len(rows) == docs.count()
    known = {r.doc_id: r.quality for r in labels.collect()}
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in rows)
    held = [r for r in rows if r.held_out and r.doc_id in known]
    good = np.array([r.score for r in held if known[r.doc_id] == 1])
    bad = np.array([r.score for r in held if known[r.doc_id] == 0])
    assert (good[:, None] > bad).mean() > 0.97 and (good >= 0.5).mean() > 0.97 and (bad < 0.5).mean() > 0.7
    # The same fit again gives the same scores.
    assert {r.doc_id: r.score for r in score_documents(docs.repartition(5), labels).collect()} == {r.doc_id: r.score for r in rows}


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="shared tables not present")
def test_every_score_against_sums_over_pairs(spark):
    """The whole query, scored anew: each document by all pairs of its features, labels from their own file."""
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.001/{t}.parquet") for t in ("documents", "labels"))
    model = train(docs, labels)
    got = {r.doc_id: r for r in score_documents(docs, labels).collect()}
    rows = docs.select("doc_id", "text", "n_chars").collect()
    assert len(got) == len(rows)
    for r in rows:
        index, x = features(r.text, (r.n_chars,))
        vectors = model.v[index].astype(float) * x[:, None]
        gram = vectors @ vectors.T
        raw = model.w0 + float(model.w[index].astype(float) @ x) + float(np.triu(gram, 1).sum())
        score = 1 / (1 + math.exp(-max(-500.0, min(500.0, raw))))
        row = got[r.doc_id]
        assert abs(row.score - score) < 1e-3 and row.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
        assert row.predicted == int(row.score >= 0.5)


def test_edge_cases(spark):
    rows = [(i, f"fine words number {i}", 10) if i % 2 else (i, "### $$$ !!!", 5) for i in range(40)]
    rows += [(100, None, None), (101, "", 0), (None, "no id", 3), (102, "long " * 50_000, 250_000), (1, rows[1][1], 10)]
    docs = spark.createDataFrame([(*r, "s", "l", "p") for r in rows], DOCS)
    marks = [(i, i % 2, 0, "t") for i in range(40)] + [(3, 1, 0, "t"), (None, 1, 0, "t"), (5, None, 0, "t"), (7, 9, 0, "t")]
    labels = spark.createDataFrame(marks, LABELS)
    got = score_documents(docs, labels).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    assert [r.held_out for r in got if r.doc_id is None] == [False]
    same = [r.score for r in got if r.doc_id == 1]
    assert len(same) == 2 and same[0] == same[1]
    left = keep_good(docs, labels)
    assert left.columns == docs.columns and left.count() == sum(r.score >= 0.5 for r in got)


def test_no_labels_and_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a", 1, "s", "l", "p")], DOCS)
    none = spark.createDataFrame([], LABELS)
    assert [r.score for r in score_documents(docs, none).collect()] == [0.5]
    assert score_documents(docs.limit(0), none).count() == 0
    only = spark.createDataFrame([(1, 1, 0, "t")], LABELS)
    assert score_documents(docs, only).first().score > 0.5


def test_the_sample_is_bounded_and_deterministic(spark):
    index, values = features("b a b", (1.0,))
    again, _ = features("a b b", (1.0,))
    assert len(index) == len(values) and set(index[:2]) == set(again[:2])
