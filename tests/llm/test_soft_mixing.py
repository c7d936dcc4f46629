"""Mixing: the gradient against numpy, totals against targets, edge cases."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridsky.llm.soft_mixing import MAX_RATE, DomainModel, _rate, fit_rates, label_domains, mix_documents, take_mixture

DOCS = "doc_id long, text string, row int, copies int, hash string, tokens string"
LABELS = "doc_id long, quality int, toxic int"


def documents(spark, count=300):
    rng = random.Random(1)
    rows, marks = [], []
    for i in range(count):
        kind = rng.choice(["clean"] * 6 + ["toxic", "junk"])
        words = rng.choices(["alpha", "beta", "gamma", "delta"], k=rng.randint(5, 60))
        if kind == "toxic":
            words[::4] = ["vile"] * len(words[::4])
        if kind == "junk":
            words = [w.upper() + "!!" for w in words]
        rows.append((i, " ".join(words)))
        marks.append((i, int(kind != "junk"), int(kind == "toxic")))
    rows += [(900, None), (901, ""), (None, "alpha beta"), (902, "alpha"), (902, "alpha"), (903, "alpha " * 60)]
    marks += [(None, 1, 0), (5, None, None), (1, 0, 0)]
    return spark.createDataFrame([(*r, 1, 2, "h", "t") for r in rows], DOCS), spark.createDataFrame(marks, LABELS)


TARGETS = {"clean": 0.8, "toxic": 0.05, "junk": 0.15}


def test_totals_meet_the_targets(spark):
    docs, labels = documents(spark)
    got = mix_documents(docs, label_domains(labels), TARGETS).toPandas()
    assert len(got) == docs.count()
    tokens = got.tokens.sum()
    totals = {d: (got[f"p_{d}"] * got.tokens * got.rate).sum() / tokens for d in TARGETS}
    share = sum(got[f"p_{d}"] for d in TARGETS).mul(got.tokens).sum() / tokens
    assert all(abs(totals[d] - TARGETS[d] * share) < 0.01 for d in TARGETS)
    assert got.rate.between(0, MAX_RATE).all()
    assert ((got.copies - got.rate).abs() < 1).all()
    known = {r.doc_id: r.domain for r in label_domains(labels).collect() if r.domain and r.doc_id not in (None, 1)}
    best = {r.doc_id: max(TARGETS, key=lambda d: getattr(r, f"p_{d}")) for r in got.itertuples() if r.doc_id in known}  # noqa: B023
    assert np.mean([best[i] == known[i] for i in best]) > 0.95
    same = got[got.doc_id == 902]
    assert same.rate.nunique() == 1 and same.copies.nunique() == 1
    assert got[got.doc_id.isin([900, 901])].tokens.tolist() == [0, 0]


def test_steps_are_projected_gradient(spark):
    rng = np.random.default_rng(2)
    p = np.round(rng.dirichlet([1, 1, 1], 40), 2)
    n = rng.integers(1, 50, 40)
    model = DomainModel(("a", "b", "c"), (0.0,) * 3, {})
    rows = spark.createDataFrame([(x.tolist(), int(k)) for x, k in zip(p, n)], "posteriors array<double>, tokens long")
    steps = fit_rates(rows, model, {"a": 0.7, "b": 0.2, "c": 0.1}, iterations=4)
    start = (p * n[:, None]).sum(axis=0)
    rate, want = np.ones(40), start.sum() * np.array([0.7, 0.2, 0.1])
    for step in steps:
        off = ((p * (n * rate)[:, None]).sum(axis=0) - want) / start
        assert np.allclose(step, off, atol=1e-9)
        rate = np.clip(rate - p @ off, 0, MAX_RATE)
    assert len(steps) == 4
    got = rows.select("posteriors", _rate(F.col("posteriors"), steps).alias("r")).collect()
    by = {tuple(r.posteriors): r.r for r in got}
    assert np.allclose([by[tuple(x.tolist())] for x in p], rate)


def test_rows_are_taken_as_often_as_decided(spark):
    docs, labels = documents(spark)
    decided = mix_documents(docs, label_domains(labels), TARGETS).collect()
    taken = take_mixture(docs, label_domains(labels), TARGETS)
    assert taken.columns == docs.columns
    assert taken.count() == sum(r.copies for r in decided)


def test_no_labels_no_targets_empty_table(spark):
    docs, labels = documents(spark, 20)
    long = spark.createDataFrame([(950, "x " * 100_000, 1, 2, "h", "t")], DOCS)
    assert mix_documents(docs.unionByName(long), label_domains(labels), TARGETS).count() == docs.count() + 1
    none = label_domains(labels.limit(0))
    assert {(r.rate, r.copies) for r in mix_documents(docs, none, TARGETS).collect()} == {(1.0, 1)}
    assert {r.rate for r in mix_documents(docs, label_domains(labels), {}).collect()} == {1.0}
    assert mix_documents(docs.limit(0), label_domains(labels), TARGETS).count() == 0
    assert take_mixture(docs.limit(0), label_domains(labels), TARGETS).count() == 0


def profiles_of(spark, p, n):
    return spark.createDataFrame([(x.tolist(), int(k)) for x, k in zip(p, n)], "posteriors array<double>, tokens long")


def shares(spark, p, n, targets):
    """Token shares at the rates that ``fit_rates`` leads to."""
    model = DomainModel(tuple(targets), (0.0,) * len(targets), {})
    rows = profiles_of(spark, p, n)
    steps = fit_rates(rows, model, targets)
    got = np.array([r.r for r in rows.select(_rate(F.col("posteriors"), steps).alias("r")).collect()])
    assert (got >= 0).all()
    return (p * (n * got)[:, None]).sum(axis=0) / (p * n[:, None]).sum(), got


def nearest(p, n, want, rounds=200_000):
    """Token shares at the optimum, by accelerated projected gradient with restarts, run until the steps vanish."""
    n = n / n.sum()
    mass = (p * n[:, None]).sum(axis=0)
    rate, before, momentum = np.ones(len(n)), np.ones(len(n)), 1.0
    for _ in range(rounds):
        following = (1 + np.sqrt(1 + 4 * momentum**2)) / 2
        ahead = rate + (momentum - 1) / following * (rate - before)
        new = np.maximum(0, ahead - p @ (((p * (n * ahead)[:, None]).sum(axis=0) - want) / mass))
        if ((ahead - new) * (new - rate) * n).sum() > 0:
            following = 1.0
        if np.abs(new - rate).max() < 1e-13:
            break
        rate, before, momentum = new, rate, following
    return (p * (n * rate)[:, None]).sum(axis=0)


@pytest.mark.parametrize("alpha, reached", [((6, 1.5, 1.5), True), ((12, 4, 4), False)])
def test_overlapping_posteriors_end_at_the_optimum(spark, alpha, reached):
    rng = np.random.default_rng(3)
    p = np.round(rng.dirichlet(alpha, 400), 6)
    n = rng.integers(1, 500, 400)
    targets = {"a": 0.94, "b": 0.03, "c": 0.03}
    got, _ = shares(spark, p, n, targets)
    want = np.array(list(targets.values()))
    best = nearest(p, n, want)
    assert np.allclose(got, best, atol=3e-4)
    assert np.allclose(got, want, atol=2e-4) == reached


def test_a_scarce_domain_reaches_its_target(spark):
    """Its documents are taken twenty times and more."""
    p = np.array([[0.99, 0.005, 0.005], [0.005, 0.99, 0.005], [0.005, 0.005, 0.99]])
    n = np.array([100_000, 100, 100])
    got, rate = shares(spark, p, n, {"a": 0.7, "b": 0.15, "c": 0.15})
    assert np.allclose(got, [0.7, 0.15, 0.15], atol=5e-4)
    assert rate[1] > 20


def test_small_posteriors_are_not_lost(spark):
    """With each 0.4 percent toxic, the expected toxic tokens are 0.4 percent of all."""
    model = DomainModel(("clean", "toxic"), (float(np.log(0.996)), float(np.log(0.004))), {"w": (0.0, 0.0)})
    got = model.add(spark.createDataFrame([(["w"],)], "found array<string>")).first()
    assert np.allclose(got.posteriors, [0.996, 0.004], atol=1e-6)
