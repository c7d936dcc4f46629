"""Mixing to target weights with soft membership, in DataFrame functions only.

1. A classifier learned from a labelled table gives every document a posterior
   for each domain. It is a naive Bayes model over tokens: the presence of words
   that tell the domains apart, and the bins of some structure statistics. The
   words are chosen on at most ``sample`` labelled documents (those whose id hashes lowest); the model's
   counts are taken over all labelled documents.
2. Every document i has a rate r_i >= 0, one at first. Its n_i tokens count for
   each domain by the posterior, so a domain's expected total is T_d = sum r_i n_i p_id.
   The rates minimise sum (T_d - target_d)^2 / m_d, where m_d is the total at rate one.
   The gradient step is r_i <- max(0, r_i - s sum_d p_id (T_d - target_d) / m_d);
   there is no upper bound. With T as before the step, s = 1 is always short enough; such steps
   come first. Where posteriors overlap they hardly move, so the next ones take T as it
   is after the step, which allows any s (a proximal step); s grows until the totals are met or proven the nearest.
3. A step is as many numbers as there are domains, found by one aggregate, or a few where T
   is that after the step. A rate depends on the posterior only, so the state is the list of steps:
   nothing is kept per document, and the aggregates read a table with one
   row for each different posterior (they are rounded to ``DIGITS`` digits).
4. A document is taken floor(r) times, and once more with probability r - floor(r),
   drawn from a hash of its id and text.

Cases: null and empty texts have no tokens, the posterior of an empty text and rate 1, as they add to no total; null ids are mixed
like others; repeated rows get the same rate and the same copies; labels with a null id or domain do not
count, several labels of an id all do; a target for a domain without labels can't be met and is
left out, the rest keep their proportions; a labelled domain without a target
has target 0; without labels or targets every rate is 1; an empty table gives an
empty result; other columns pass through, whatever their names.
"""

from __future__ import annotations

import json
import logging
import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridsky.llm.common import WHITE_SPACE, checked_broadcast, staged, text_or_empty

#: Labelled documents on which words are chosen, at most, and words chosen for each domain.
SAMPLE, WORDS = 5000, 48
#: Parts in which the words of a domain are ranked before the best ones meet.
PARTS = 64
#: Digits to which posteriors are kept: the error of a total is far below ``TOLERANCE``.
DIGITS = 6
#: Steps at most, how many of them are plain ones, and the share of all tokens that a total may be off.
ITERATIONS, PLAIN, TOLERANCE = 40, 8, 1e-4
#: Each implicit step is so much longer than the one before, up to the longest; Newton moves in one at most.
LONGER, LONGEST, NEWTON = 100.0, 1e10, 100
#: Rates have no upper bound.
MAX_RATE = math.inf
BINS = 12
_log = logging.getLogger(__name__)
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_MARKS = "!\"#$%&'()*+,-./:;<=>?@[]^_{|}~"


def _words(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), WHITE_SPACE), lambda w: w != "")


def _bin(name: str, share: Column) -> Column:
    """A token for the bin of a share; the square root gives small shares more bins."""
    at = F.least(F.lit(BINS - 1), F.floor(F.sqrt(F.greatest(F.lit(0.0), share)) * BINS))
    return F.concat(F.lit(f"{name} "), at.cast("string"))


def _statistics(text: Column, words: Column) -> list[Column]:
    """Bins of structure statistics. Their names hold a blank, so no word equals one."""
    size = F.greatest(F.lit(1), F.length(text))
    count = F.greatest(F.lit(1), F.size(words))

    def share(marks: str) -> Column:
        return 1 - F.length(F.translate(text, marks, "")) / size

    return [
        _bin("upper", share(_UPPER)),
        _bin("marks", share(_MARKS)),
        _bin("distinct", F.size(F.array_distinct(words)) / count),
        _bin("length", F.length(text) / count / 24),
        F.concat(F.lit("count "), F.floor(F.log2(count.cast("double"))).cast("string")),
    ]


@dataclass(frozen=True)
class DomainModel:
    """Log odds by token, and the start of each domain."""

    domains: tuple[str, ...]
    start: tuple[float, ...]
    tokens: Mapping[str, tuple[float, ...]]

    def add(self, rows: DataFrame) -> DataFrame:
        """Add to (..., found) the column posteriors (rounded, an array by domain)."""
        weights = _constant(self.tokens, "map<string,array<double>>")
        zero = F.array_repeat(F.lit(0.0), len(self.domains))
        # Each step is a column of its own, so that no expression holds the one before more than once.
        scores = F.aggregate(
            "found",
            _constant(self.start, "array<double>"),
            # A token that no labelled document has tells nothing.
            lambda total, t: F.zip_with(total, F.coalesce(weights[t], zero), lambda a, b: a + b),
        )
        rows = rows.withColumn("scores", scores).withColumn("most", F.array_max("scores"))
        rows = rows.withColumn("odds", F.transform("scores", lambda x: F.exp(x - F.col("most"))))
        rows = rows.withColumn("sum", F.aggregate("odds", F.lit(0.0), lambda a, b: a + b))
        rounded = F.transform("odds", lambda x: F.round(x / F.col("sum"), DIGITS))
        return rows.withColumn("posteriors", rounded).drop("scores", "most", "odds", "sum")


def _constant(value, kind: str) -> Column:
    """A constant of any size as one expression."""
    return F.from_json(F.lit(json.dumps(value)), kind)


def _featured(texts: DataFrame, vocabulary: Sequence[str]) -> DataFrame:
    """id, hash, tokens (their number) and found (chosen words that occur, and bins) of (id, text)."""
    rows = texts.withColumn("words", _words(F.col("text")))
    chosen = F.array_intersect("words", _constant(list(vocabulary), "array<string>"))
    return rows.select(
        "id",
        F.xxhash64("text").alias("hash"),
        F.size("words").cast("long").alias("tokens"),
        F.concat(chosen, F.array(*_statistics(F.col("text"), F.col("words")))).alias("found"),
    )


def choose_words(texts: DataFrame, labelled: DataFrame, sample: int = SAMPLE, words: int = WORDS) -> list[str]:
    """Words that tell the domains apart, from at most ``sample`` labelled texts."""
    few = labelled.orderBy(F.xxhash64("id"), "id", "domain").limit(sample)
    # At most ``sample`` rows.
    sizes = staged(few.groupBy("domain").agg(F.count(F.lit(1)).alias("size")), "mix-sizes")
    few = texts.join(F.broadcast(few), "id").select("domain", F.explode(F.array_distinct(_words(F.col("text")))).alias("word"))
    counts = staged(few.groupBy("word", "domain").agg(F.count(F.lit(1)).alias("n")), "mix-words")
    # How much more often a word is met in this domain than in the others, times how often.
    total = Window.partitionBy("word")
    inside = counts.withColumn("others", F.sum("n").over(total) - F.col("n"))
    total_size = sizes.agg(F.sum("size")).first()[0] or 0
    scored = (
        inside.where("n >= 5")
        .join(F.broadcast(sizes), "domain")
        .withColumn("all", F.lit(float(total_size)) - F.col("size"))
        .withColumn(
            "gain",
            F.col("n") * F.log(((F.col("n") + 0.5) / (F.col("size") + 1)) / ((F.col("others") + 0.5) / F.greatest(F.col("all"), F.lit(1.0)))),
        )
    )
    # The best of each part of a domain's words, then the best of those: no task ranks a whole domain.
    scored = scored.withColumn("part", F.pmod(F.xxhash64("word"), F.lit(PARTS)))
    for group in (["domain", "part"], ["domain"]):
        place = F.row_number().over(Window.partitionBy(*group).orderBy(F.desc("gain"), "word"))
        scored = scored.withColumn("place", place).where(F.col("place") <= words)
    return sorted({r.word for r in scored.select("word").collect()})


def fit_domains(rows: DataFrame, labelled: DataFrame) -> DomainModel | None:
    """The model from the counts over all labelled rows of (id, found); None without labels."""
    marked = staged(rows.join(labelled, "id").select("domain", "found"), "mix-labelled")
    sizes = {r.domain: r.n for r in marked.groupBy("domain").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not sizes:
        return None
    names = tuple(sorted(sizes))
    counted = marked.select("domain", F.explode("found").alias("token")).groupBy("token").pivot("domain", list(names)).count()
    table = {r["token"]: [r[d] or 0 for d in names] for r in counted.collect()}
    everything = sum(sizes.values())
    start = [math.log(sizes[d] / everything) for d in names]
    odds = {}
    for token, found in table.items():
        share = [(n + 0.5) / (sizes[d] + 1) for n, d in zip(found, names)]
        if " " in token:
            odds[token] = tuple(map(math.log, share))
        else:
            # Presence adds to a start at which every word is absent.
            odds[token] = tuple(math.log(s / (1 - s)) for s in share)
            start = [a + math.log(1 - s) for a, s in zip(start, share)]
    return DomainModel(names, tuple(start), odds)


def _along(posteriors: Column, step: Column) -> Column:
    return F.aggregate(F.zip_with(posteriors, step, lambda p, g: p * g), F.lit(0.0), lambda a, b: a + b)


def _moved(posteriors: Column, rate: Column, step: Column) -> Column:
    """The rate after one more step."""
    return F.greatest(F.lit(0.0), rate - _along(posteriors, step))


def _rate(posteriors: Column, steps: Sequence[Sequence[float]]) -> Column:
    """The rate after these steps."""
    if not steps:
        return F.lit(1.0)
    path = _constant(steps, "array<array<double>>")
    return F.aggregate(path, F.lit(1.0), lambda rate, step: _moved(posteriors, rate, step))


def _implicit_step(rows: DataFrame, mass: np.ndarray, want: np.ndarray, length: float, exact: float) -> np.ndarray:
    """The step g with g_d = length * (T_d - want_d) / mass_d, where T are the totals of (posteriors, tokens, rate) after it.

    It is the least point of a convex function, piecewise quadratic in as many numbers as there are
    domains. Newton's method finds it; each trial is one aggregate.
    """
    size = range(len(mass))

    def at(step: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        own = rows.select("posteriors", "tokens", _moved(F.col("posteriors"), F.col("rate"), _constant(step.tolist(), "array<double>")).alias("rate"))
        p, n, rate = F.col("posteriors"), F.col("tokens"), F.col("rate")
        upper = [(d, e) for d in size for e in size if d <= e]
        found = own.where("rate > 0").agg(
            F.sum(n * rate * rate),
            *[F.sum(p[d] * n * rate) for d in size],
            *[F.sum(p[d] * p[e] * n) for d, e in upper],
        ).first()
        square, *others = [float(x or 0) for x in found]
        totals = np.array(others[: len(mass)])
        bend = np.diag(mass / length)
        for (d, e), x in zip(upper, others[len(mass) :]):
            bend[d, e] += x
            bend[e, d] += x if d != e else 0.0
        return float((mass * step * step).sum() / length + 2 * want @ step + square) / 2, mass * step / length + want - totals, bend

    step = np.zeros(len(mass))
    value, slope, bend = at(step)
    for _ in range(NEWTON):
        if np.abs(slope).max() <= exact:
            break
        live = mass > 0
        move = np.zeros(len(mass))
        move[live] = np.linalg.solve(bend[np.ix_(live, live)], -slope[live])
        share = 1.0
        while True:
            tried = at(step + share * move)
            # The second test is for values that differ by their rounding only.
            if tried[0] <= value + 1e-4 * share * (slope @ move) or np.abs(tried[1]).max() < 0.5 * np.abs(slope).max():
                break
            share /= 2
            if share < 1e-9:
                return step
        step = step + share * move
        value, slope, bend = tried
    return step


def _distance(rows: DataFrame, mass: np.ndarray, want: np.ndarray, totals: np.ndarray) -> float:
    """How far any total of (posteriors, tokens) can be from its place at the optimum, at most.

    For the gradient G of rates r and the best rates b >= 0, f(r) - f(b) <= G(r - b),
    and sum (T_d(r) - T_d(b))^2 / m_d is at most twice that.
    """
    live = mass > 0
    off = np.where(live, totals - want, 0.0)
    slope = np.divide(off, mass, out=np.zeros(len(mass)), where=live)
    along = _along(F.col("posteriors"), _constant(slope.tolist(), "array<double>"))
    lowest = rows.where("tokens > 0").agg(F.min(along)).first()[0] or 0.0
    # The tokens that the best rates take, at most; posteriors are rounded, hence the margin.
    most = 1.01 * (want.sum() + math.sqrt((off * slope).sum() * mass.sum()))
    gap = max(0.0, float(slope @ totals) + max(0.0, -lowest) * most)
    return math.sqrt(2 * mass.max() * gap)


def fit_rates(
    profiles: DataFrame,
    model: DomainModel,
    targets: Mapping[str, float],
    iterations: int = ITERATIONS,
    tolerance: float = TOLERANCE,
) -> list[list[float]]:
    """Projected gradient on (posteriors, tokens): the steps that lead to the rates.

    ``PLAIN`` steps at most take the gradient where they start. Where posteriors overlap these are far
    too short, so the others take it where they end, which allows any length. Ends once the totals are met,
    or are proven to lie within the tolerance of the nearest that rates >= 0 can reach. Warns if they are not met.
    """
    known = [max(0.0, targets.get(d, 0.0)) for d in model.domains]
    steps: list[list[float]] = []
    start, length = None, 1.0
    while sum(known) > 0:
        # The rates so far are kept by row, so that no trial replays the whole path.
        rows = profiles.withColumn("rate", _rate(F.col("posteriors"), steps))
        if len(steps) >= PLAIN:
            rows = staged(rows, "mix-rates")
        totals = rows.agg(
            *[
                F.coalesce(F.sum(F.col("posteriors")[d] * F.col("tokens") * F.col("rate")), F.lit(0.0)).alias(f"t{d}")
                for d in range(len(known))
            ]
        ).first()
        totals = np.array([float(x) for x in totals])
        start = totals if start is None else start
        budget = start.sum()
        if not budget:
            break
        want = budget * np.array(known) / sum(known)
        # A domain that no document belongs to can't be met.
        off = np.where(start > 0, totals - want, 0.0)
        if np.abs(off).max() <= tolerance * budget:
            break
        proven = len(steps) > PLAIN and _distance(profiles, start, want, totals) <= tolerance * budget
        if proven or len(steps) >= iterations:
            _log.warning(
                "mixture: token shares %s, not %s; %s",
                dict(zip(model.domains, (totals / budget).round(6).tolist())),
                dict(zip(model.domains, (want / budget).round(6).tolist())),
                "no rates come nearer" if proven else f"not proven to be the nearest after {len(steps)} steps",
            )
            break
        if len(steps) < PLAIN:
            step = np.divide(off, start, out=np.zeros(len(start)), where=start > 0)
        else:
            length = min(length * LONGER, LONGEST)
            step = _implicit_step(rows, start, np.where(start > 0, want, 0.0), length, 1e-10 * budget)
        steps.append(step.tolist())
    return steps


@dataclass(frozen=True)
class Mixture:
    """The fitted classifier, and the steps that lead to the rates."""

    model: DomainModel | None
    steps: list[list[float]]


def _document_rate(mixture: Mixture) -> Column:
    return F.when(F.col("tokens") > 0, _rate(F.col("posteriors"), mixture.steps)).otherwise(1.0)


def with_copies(rows: DataFrame) -> DataFrame:
    """Add to (id, hash, rate, ...) how often a document is taken."""
    draw = F.pmod(F.xxhash64(F.lit("copies"), "id", "hash"), F.lit(1 << 20)) / F.lit(float(1 << 20))
    whole = F.floor("rate")
    return rows.withColumn("copies", (whole + (draw < F.col("rate") - whole).cast("int")).cast("int"))


def fit_mixture(
    docs: DataFrame,
    domains: DataFrame,
    targets: Mapping[str, float],
    id_col: str = "doc_id",
    text_col: str = "text",
    domain_col: str = "domain",
    sample: int = SAMPLE,
) -> tuple[Mixture, DataFrame]:
    """The mixture, and a table of id, hash (of the text), tokens (their number), posteriors of all rows."""
    labelled = domains.select(F.col(id_col).alias("id"), F.col(domain_col).cast("string").alias("domain"))
    labelled = labelled.where("id IS NOT NULL AND domain IS NOT NULL").distinct()
    texts = docs.select(F.col(id_col).alias("id"), text_or_empty(F.col(text_col)).alias("text"))
    # The features of all rows are made once; the classifier is fitted to them and applied to them.
    rows = staged(_featured(texts, choose_words(texts, labelled, sample)), "mix-rows")
    model = fit_domains(rows, labelled)
    if model is None:
        return Mixture(None, []), rows.withColumn("posteriors", F.array().cast("array<double>"))
    rows = staged(model.add(rows).drop("found"), "mix-posteriors")
    profiles = staged(rows.groupBy("posteriors").agg(F.sum("tokens").alias("tokens")), "mix-profiles")
    return Mixture(model, fit_rates(profiles, model, targets)), rows


def mix_documents(docs: DataFrame, domains: DataFrame, targets: Mapping[str, float], **columns) -> DataFrame:
    """``id_col``, tokens, a posterior for each domain, rate and copies, for every row."""
    id_col = columns.get("id_col", "doc_id")
    mixture, rows = fit_mixture(docs, domains, targets, **columns)
    names = mixture.model.domains if mixture.model else ()
    return with_copies(rows.withColumn("rate", _document_rate(mixture))).select(
        F.col("id").alias(id_col),
        "tokens",
        *[F.col("posteriors")[d].alias(f"p_{name}") for d, name in enumerate(names)],
        F.round("rate", 6).alias("rate"),
        "copies",
    )


def take_mixture(docs: DataFrame, domains: DataFrame, targets: Mapping[str, float], **columns) -> DataFrame:
    """The rows of ``docs``, with their own columns, each as often as its rate says."""
    id_col, text_col = columns.get("id_col", "doc_id"), columns.get("text_col", "text")
    mixture, rows = fit_mixture(docs, domains, targets, **columns)
    taken = with_copies(rows.withColumn("rate", _document_rate(mixture)))
    # Decisions go back to the rows by id and hash; small tables of them without a shuffle.
    taken = taken.where("copies > 0").select(F.col("id").alias("to"), F.col("hash").alias("of"), "copies").distinct()
    keyed = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        F.col(id_col).alias("id"),
        F.xxhash64(text_or_empty(F.col(text_col))).alias("hash"),
    )
    same = (F.col("hash") == F.col("of")) & F.col("id").eqNullSafe(F.col("to"))
    chosen = keyed.join(checked_broadcast(staged(taken, "mix-taken")), same)
    return chosen.select("row", F.explode(F.array_repeat(F.lit(1), F.col("copies")))).select("row.*")


def label_domains(labels: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Domains from quality and toxicity labels: toxic, junk, clean."""
    domain = F.when(F.col("toxic") == 1, "toxic").when(F.col("quality") == 0, "junk").when(F.col("quality") == 1, "clean")
    return labels.select(F.col(id_col), domain.alias("domain"))
