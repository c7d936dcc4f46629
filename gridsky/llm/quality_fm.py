"""Quality classifier: a factorisation machine over hashed words, structure and metadata.

A text becomes a sparse vector x: its distinct words, hashed, each worth
1/sqrt(their number), and one indicator for the bin that each structure
statistic and each metadata column falls in. The score is the logistic of

    w0 + sum w_i x_i + 1/2 sum_f [ (sum v_if x_i)^2 - sum v_if^2 x_i^2 ]

where the sum of squares gives all pairwise interactions in time linear in the
non-zero entries.

The machine is fitted on the driver, on at most ``max_train`` labelled rows: those
whose id hashes lowest among the rows with a label and outside the held-out fold.
Only their feature vectors reach the driver. All rows, and whole texts, are scored
on the executors; the model they get has a fixed size (``BUCKETS`` and the bins).

Cases: an empty or null text has no words and is scored by the remaining
features; null metadata has a bin of its own; rows with a null id are scored but
never trained on and not held out; of several labels of one id the lowest counts;
labels other than 0 and 1 are left out; with no labels every score is 0.5, with
one class only the machine learns that class; repeated rows get equal scores;
other columns pass through, whatever their names.
"""

from __future__ import annotations

import zlib
from collections.abc import Sequence
from dataclasses import dataclass
from operator import eq

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridsky.llm.common import small_batches, utf8, words_of

BUCKETS = 1 << 15
BINS = 16
#: Labelled rows that the machine is fitted on, at most.
MAX_TRAIN = 6000
FACTORS = 8

# Byte classes: 0 other, 1 upper case, 2 lower case, 3 digit, 4 white space, 5 line end, 6 mark.
_CLASS = np.zeros(256, dtype=np.uint8)
_CLASS[33:127] = 6
_CLASS[65:91] = 1
_CLASS[97:123] = 2
_CLASS[48:58] = 3
_CLASS[[9, 11, 12, 13, 32]] = 4
_CLASS[10] = 5


def structure(raw: bytes, words: list[bytes], distinct: int) -> list[float]:
    """Statistics of a text, each between 0 and 1."""
    size, count = max(1, len(raw)), max(1, len(words))
    kinds = np.bincount(_CLASS[np.frombuffer(raw, dtype=np.uint8)], minlength=7)
    letters = max(1, int(kinds[1] + kinds[2]))
    lines = raw.split(b"\n")
    return [
        min(1.0, np.log2(len(words) + 1) / BINS),
        kinds[1] / letters,
        kinds[3] / size,
        kinds[6] / size,
        raw.count(b"|") / count if count > raw.count(b"|") else 1.0,
        (kinds[4] + kinds[5]) / size,
        min(1.0, size / count / 32),
        distinct / count,
        sum(map(eq, words, words[1:])) / count,
        1 - len(set(lines)) / len(lines),
        min(1.0, len(lines) / count),
    ]


STATISTICS = len(structure(b"", [], 0))


def features(text: str | None, metadata: Sequence[float]) -> tuple[np.ndarray, np.ndarray]:
    """Indexes and values of the non-zero entries of one row."""
    raw = utf8(text)
    words = words_of(raw)
    hashed = np.unique(
        np.fromiter((zlib.crc32(w) & (BUCKETS - 1) for w in set(words)), dtype=np.int32)
    )
    # The square root gives small shares more bins.
    bins = [min(BINS - 1, int(BINS * s**0.5)) for s in structure(raw, words, len(set(words)))]
    bins += [
        BINS - 1 if m is None or m != m else min(BINS - 2, int(np.log2(1 + max(0.0, m)) * 0.6))
        for m in metadata
    ]
    flags = BUCKETS + BINS * np.arange(len(bins), dtype=np.int32) + np.array(bins, dtype=np.int32)
    values = np.ones(len(hashed) + len(bins), dtype=np.float32)
    values[: len(hashed)] /= max(1.0, len(hashed)) ** 0.5
    return np.concatenate([hashed, flags]).astype(np.int32), values


@dataclass
class FactorisationMachine:
    w0: float
    w: np.ndarray
    v: np.ndarray

    def raw(self, rows: Sequence[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        """Scores before the logistic; every row has an entry for each statistic."""
        index = np.concatenate([r[0] for r in rows])
        x = np.concatenate([r[1] for r in rows])
        starts = np.cumsum([0] + [len(r[0]) for r in rows[:-1]])
        vx = self.v[index] * x[:, None]
        sums = np.add.reduceat(vx, starts)
        squares = np.add.reduceat(vx * vx, starts)
        linear = np.add.reduceat(self.w[index] * x, starts)
        return self.w0 + linear + 0.5 * (sums * sums - squares).sum(axis=1)

    def score(self, rows: Sequence[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.raw(rows), -30, 30).astype(np.float64)))


def fit(
    rows: Sequence[tuple[np.ndarray, np.ndarray]],
    labels: Sequence[int],
    width: int,
    factors: int = FACTORS,
    epochs: int = 12,
    batch: int = 64,
    rate: float = 0.1,
    decay: float = 1e-4,
    seed: int = 7,
) -> FactorisationMachine:
    """Adagrad on the logistic loss, in a fixed order of mini-batches."""
    rng = np.random.default_rng(seed)
    model = FactorisationMachine(
        0.0, np.zeros(width, np.float32), rng.normal(0, 0.02, (width, factors)).astype(np.float32)
    )
    y = np.asarray(labels, dtype=np.float32)
    if not len(y):
        model.v[:] = 0
        return model
    share = float(np.clip(y.mean(), 0.01, 0.99))
    model.w0 = float(np.log(share / (1 - share)))
    seen_w, seen_v, seen_0 = np.full(width, 1e-3), np.full((width, factors), 1e-3), 1e-3
    for _ in range(epochs):
        order = rng.permutation(len(y))
        for at in range(0, len(order), batch):
            chosen = order[at : at + batch]
            part = [rows[i] for i in chosen]
            index = np.concatenate([r[0] for r in part])
            x = np.concatenate([r[1] for r in part])
            owner = np.repeat(np.arange(len(part)), [len(r[0]) for r in part])
            error = (model.score(part) - y[chosen]) / len(part)
            vx = model.v[index] * x[:, None]
            sums = np.add.reduceat(vx, np.searchsorted(owner, np.arange(len(part))))
            # d score / d v_if = x_i (sum_f - v_if x_i)
            by_entry = error[owner] * x
            places, inverse = np.unique(index, return_inverse=True)
            grad_w = np.bincount(inverse, by_entry, len(places)) + decay * model.w[places]
            grad_v = np.stack(
                [
                    np.bincount(inverse, by_entry * (sums[owner, f] - vx[:, f]), len(places))
                    for f in range(factors)
                ],
                axis=1,
            ) + decay * model.v[places]
            seen_w[places] += grad_w**2
            seen_v[places] += grad_v**2
            model.w[places] -= rate * grad_w / np.sqrt(seen_w[places])
            model.v[places] -= rate * grad_v / np.sqrt(seen_v[places])
            grad_0 = float(error.sum())
            seen_0 += grad_0**2
            model.w0 -= rate * grad_0 / seen_0**0.5
    return model


def held_out(id_col: Column) -> Column:
    """The fold that is never trained on: crc32 of the id's text leaves 1 when divided by 3."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def train(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    metadata: Sequence[str] = ("n_chars",),
    max_train: int = MAX_TRAIN,
) -> FactorisationMachine:
    """Fit on the labelled rows outside the held-out fold."""
    spark = docs.sparkSession
    small_batches(spark)
    marked = (
        labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label"))
        .where(F.col("id").isNotNull() & F.col("label").isin(0, 1) & ~held_out(F.col("id")))
        .groupBy("id")
        .agg(F.min("label").alias("label"))
    )
    known = marked.join(docs.select(F.col(id_col).alias("id")), "id", "left_semi")
    chosen = known.orderBy(F.xxhash64("id"), "id").limit(max_train)
    rows = docs.select(
        F.col(id_col).alias("id"),
        F.col(text_col).cast("string").alias("text"),
        *[F.col(m).cast("double").alias(f"meta{k}") for k, m in enumerate(metadata)],
    ).join(F.broadcast(chosen), "id")
    names = [f"meta{k}" for k in range(len(metadata))]

    def vectors(batches):
        for batch in batches:
            made = [features(t, m) for t, *m in zip(batch["text"], *[batch[n] for n in names])]
            yield pd.DataFrame(
                {
                    "id": batch["id"],
                    "label": batch["label"],
                    "at": [r[0].tobytes() for r in made],
                    "x": [r[1].tobytes() for r in made],
                }
            )

    schema = f"id {dict(rows.dtypes)['id']}, label int, at binary, x binary"
    # Repeated ids all count; the order is fixed, so that the fit is.
    found = sorted(rows.mapInPandas(vectors, schema).collect(), key=lambda r: (str(r.id), r.at))
    found = found[:max_train]
    entries = [(np.frombuffer(r["at"], np.int32), np.frombuffer(r.x, np.float32)) for r in found]
    size = BUCKETS + BINS * (STATISTICS + len(metadata))
    return fit(entries, [r.label for r in found], size)


def quality_score(
    model: FactorisationMachine, text: Column, metadata: Sequence[Column] = ()
) -> Column:
    """Probability of label 1."""

    @F.pandas_udf("double")
    def score(text: pd.Series, *metadata: pd.Series) -> pd.Series:
        out = np.empty(len(text))
        rows, at, entries = [], 0, 0
        for k, (t, *m) in enumerate(zip(text, *metadata)):
            rows.append(features(t, m))
            entries += len(rows[-1][0])
            if entries > 200_000 or k == len(text) - 1:
                out[at : k + 1] = model.score(rows)
                rows, at, entries = [], k + 1, 0
        return pd.Series(out)

    return score(text.cast("string"), *[m.cast("double") for m in metadata])


def score_documents(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    metadata: Sequence[str] = ("n_chars",),
    max_train: int = MAX_TRAIN,
) -> DataFrame:
    """``id_col``, held_out, score, predicted (1 where score >= 0.5) for every row."""
    model = train(docs, labels, id_col, text_col, label_col, metadata, max_train)
    score = quality_score(model, F.col(text_col), [F.col(m) for m in metadata])
    return docs.select(
        F.col(id_col), held_out(F.col(id_col)).alias("held_out"), score.alias("score")
    ).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = 0.5, **columns) -> DataFrame:
    """The rows of ``docs``, with their own columns, that score ``threshold`` or more."""
    text_col = columns.get("text_col", "text")
    metadata = columns.get("metadata", ("n_chars",))
    model = train(docs, labels, **columns)
    score = quality_score(model, F.col(text_col), [F.col(m) for m in metadata])
    return docs.where(score >= threshold)
