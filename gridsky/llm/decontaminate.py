"""Benchmark decontamination: a BM25 index of test items, searched with block-max bounds.

The index holds the test items: for every word its items with their BM25 impact,
each item's impacts scaled to a sum of 1. Items are dealt into blocks, and a word
keeps its largest impact in each block.

Every training passage is a query. The words' block maxima add up to a bound for
each block; blocks whose bound stays below the threshold are skipped, which is the
pivot test of block-max WAND taken for all blocks at once. In the blocks left, a
weak-and walk takes the passage's words by falling block maximum and stops where the rest
can't lift an unseen item over the threshold. All items at or above the threshold are retrieved,
then verified: three quarters of the five-word shingles of the item's question,
and of its answer, must occur in the passage. The answer is the item's last
sentence, the question what precedes it; an item of one sentence is both. Parts of
fewer than five words count as one shingle of their length.

A passage is two neighbouring chunks of a text; a chunk is as long as the longest
item, so every span of an item's length lies whole in some passage.

The index is broadcast. Its size is checked first: beyond ``max_items`` items or ``max_bytes`` bytes of text it
is cut into parts, each of which meets all texts in a pass of its own.

Cases: null, empty and word-less texts match nothing; null or empty items are
left out; items with equal texts are all reported; repeated rows are each
reported; a null id is reported as null; no items or no texts give an empty
result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import math
import string
from collections import Counter
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridsky.llm.common import (
    WHITE_SPACE,
    as_text,
    cast_back,
    small_batches,
    staged,
    utf8,
    without,
    words_of,
)

SHINGLE = 5
#: Share of the shingles of question and answer that must occur, in percent.
OVERLAP = 75
#: Share of an item's BM25 mass that a passage must hold to be verified.
THRESHOLD = 0.5
#: BM25 constants.
K1, B = 1.2, 0.75
#: Items in one block of the index.
BLOCK = 8
#: Passages of a text that are bounded at once.
WINDOW = 512
#: Bounds of one broadcast part of the index. Its size follows its postings, of which there are as many as words at most.
MAX_ITEMS, MAX_BYTES = 2000, 8 << 20

Shingle = tuple[bytes, ...]


def shingles(words: Sequence[bytes], n: int = SHINGLE) -> set[Shingle]:
    return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)}


def question_and_answer(words: Sequence[bytes]) -> tuple[Sequence[bytes], Sequence[bytes]]:
    """Split before the last sentence; a sentence ends with a word that ends in . ? or !"""
    ends = [i + 1 for i, w in enumerate(words[:-1]) if w[-1:] in b".?!"]
    return (words[: ends[-1]], words[ends[-1] :]) if ends else (words, words)


class Part:
    """Question or answer of an item: its shingles, as long as it allows."""

    def __init__(self, words: Sequence[bytes]):
        self.n = min(SHINGLE, len(words))
        self.shingles = shingles(words, self.n)

    def hits(self, passage: dict[int, set[Shingle]], words: Sequence[bytes]) -> int:
        if self.n not in passage:
            passage[self.n] = shingles(words, self.n)
        return len(self.shingles & passage[self.n])

    def enough(self, hits: int) -> bool:
        return 100 * hits >= OVERLAP * len(self.shingles)


class BlockIndex:
    """Impacts by word and block, and block maxima, of a bounded set of items."""

    def __init__(self, items: Sequence[tuple[object, str]], totals: dict):
        split = [(i, words_of(utf8(t))) for i, t in items]
        split = [(i, w) for i, w in split if w]
        # Items of like length share a block, which keeps the block maxima tight.
        split.sort(key=lambda x: (len(x[1]), str(x[0])))
        self.ids = [i for i, _ in split]
        self.parts = [tuple(map(Part, question_and_answer(w))) for _, w in split]
        self.chunk = totals["longest"]
        self.terms: dict[bytes, int] = {}
        self.blocks = max(1, -(-len(split) // BLOCK))
        postings: dict[int, list[tuple[int, float]]] = {}
        for at, (_, words) in enumerate(split):
            counts = Counter(words)
            weight = {
                w: math.log(1 + (totals["items"] - totals["df"][w] + 0.5) / (totals["df"][w] + 0.5))
                * n * (K1 + 1) / (n + K1 * (1 - B + B * len(words) / totals["mean"]))
                for w, n in counts.items()
            }
            mass = sum(weight.values())
            for w, x in weight.items():
                t = self.terms.setdefault(w, len(self.terms))
                postings.setdefault(t, []).append((at, x / mass))
        #: For each block, the items of each word in it, and the largest impact that the word has there.
        self.postings: list[dict[int, list[tuple[int, float]]]] = [{} for _ in range(self.blocks)]
        self.tops: list[dict[int, float]] = [{} for _ in range(self.blocks)]
        for t, found in postings.items():
            for at, x in found:
                self.postings[at // BLOCK].setdefault(t, []).append((at, x))
                self.tops[at // BLOCK][t] = max(self.tops[at // BLOCK].get(t, 0.0), x)
        # Block maxima as rows of (block, impact), one run for each word: as many as postings at most. The last
        # run, of words that no item has, is empty.
        entries = sorted((t, block, most) for block, own in enumerate(self.tops) for t, most in own.items())
        self.starts = np.searchsorted([t for t, _, _ in entries], np.arange(len(self.terms) + 2))
        self.block_of = np.array([block for _, block, _ in entries], dtype=np.int64)
        self.most = np.array([most for _, _, most in entries], dtype=np.float64)

    def bounds(self, chunks: Sequence[np.ndarray]) -> np.ndarray:
        """For every chunk, given as distinct terms, the bound of each block."""
        terms = np.concatenate(chunks)
        sizes = self.starts[terms + 1] - self.starts[terms]
        owner = np.repeat(np.arange(len(chunks)), [len(c) for c in chunks])
        # Places of all runs, one after the other.
        ends = np.cumsum(sizes)
        places = np.arange(ends[-1]) + np.repeat(self.starts[terms] - ends + sizes, sizes)
        cells = np.repeat(owner, sizes) * self.blocks + self.block_of[places]
        return np.bincount(cells, self.most[places], len(chunks) * self.blocks).reshape(len(chunks), self.blocks)

    def walk(self, block: int, terms: Sequence[int], threshold: float) -> list[int]:
        """Items of a block that reach the threshold, by falling block maximum of the terms."""
        own, tops = self.postings[block], self.tops[block]
        cursors = sorted((t for t in terms if t in own), key=lambda t: -tops[t])
        left = sum(tops[t] for t in cursors)
        scores: dict[int, float] = {}
        for t in cursors:
            new = left + 1e-6 >= threshold  # an item not seen so far could still reach it
            for at, x in own[t]:
                if new or at in scores:
                    scores[at] = scores.get(at, 0.0) + x
            left -= tops[t]
        return [at for at, s in scores.items() if s >= threshold]

    def search(self, text: str | None, threshold: float = THRESHOLD) -> dict[int, list[int]]:
        """Verified items of a text: place -> [passages, question hits, answer hits]."""
        words = words_of(utf8(text))
        if not words or not self.ids:
            return {}
        n, none = self.chunk, len(self.terms)
        get = self.terms.get
        count = -(-len(words) // n)
        found: dict[int, list[int]] = {}
        # A passage is two neighbouring chunks; a long text is searched window by window, which share a chunk.
        for first in range(0, max(1, count - 1), WINDOW):
            last = min(count, first + WINDOW + 1)
            chunks = [
                np.fromiter({get(w, none) for w in set(words[k * n : (k + 1) * n])}, dtype=np.int64) for k in range(first, last)
            ]
            bounds = self.bounds(chunks)
            if count > 1:
                bounds = bounds[:-1] + bounds[1:]
            # The bound is a sum of rounded numbers, hence the margin.
            for at, block in zip(*np.nonzero(bounds >= threshold - 1e-3)):
                terms = set(np.concatenate(chunks[at : at + 2]).tolist()) - {none}
                cache: dict[int, set[Shingle]] = {}
                passage = words[(first + at) * n : (first + at + 2) * n]
                for item in self.walk(int(block), list(terms), threshold):
                    question, answer = self.parts[item]
                    q, a = question.hits(cache, passage), answer.hits(cache, passage)
                    if question.enough(q) and answer.enough(a):
                        best = found.setdefault(item, [0, 0, 0])
                        found[item] = [best[0] + 1, max(best[1], q), max(best[2], a)]
        return found


def _statistics(items: DataFrame) -> tuple[dict, DataFrame]:
    """Number, bytes, mean and greatest length of all items with words; each word's items."""
    # A-Z only, as bytes.lower() does.
    lowered = F.translate("text", string.ascii_uppercase, string.ascii_lowercase)
    words = F.filter(F.split(lowered, WHITE_SPACE), lambda w: w != "")
    split = items.select(F.octet_length("text").alias("bytes"), words.alias("words")).where("size(words) > 0")
    total = split.agg(
        F.count(F.lit(1)).alias("items"),
        F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes"),
        F.avg(F.size("words")).alias("mean"),
        F.max(F.size("words")).alias("longest"),
    ).first()
    df = split.select(F.explode(F.array_distinct("words")).alias("word")).groupBy("word").count()
    return total.asDict(), df


def _matches(
    docs: DataFrame,
    items: DataFrame,
    id_col: str,
    text_col: str,
    item_id: str,
    item_text: str,
    threshold: float,
    max_items: int,
    max_bytes: int,
) -> DataFrame:
    """id, t (hash of the text), item, passages, question_hits, answer_hits: one row per text and item."""
    spark = docs.sparkSession
    small_batches(spark)
    items = items.select(F.col(item_id).alias("id"), F.col(item_text).cast("string").alias("text"))
    items = items.where("text is not null")
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kinds = {"id": dict(texts.dtypes)["id"], "item": dict(items.dtypes)["id"]}
    names = ["id", "t", "item", "passages", "question_hits", "answer_hits"]
    schema = "id string, t long, item string, passages long, question_hits long, answer_hits long"
    totals, df = _statistics(items)
    if not totals["items"]:
        return cast_back(spark.createDataFrame([], schema), **kinds)
    texts = texts.select(*as_text("id"), F.xxhash64("text").alias("t"), "text")
    parts = max(-(-totals["items"] // max_items), -(-totals["bytes"] // max_bytes))
    out = None
    for part in range(parts):
        own = items.where(F.pmod(F.xxhash64("id", "text"), F.lit(parts)) == part)
        rows = [(r["id"], r["text"]) for r in own.select(*as_text("id"), "text").collect()]
        if not rows:
            continue
        vocabulary = spark.createDataFrame(
            [(w.decode("utf-8", "replace"),) for w in {w for _, t in rows for w in words_of(utf8(t))}] or [("",)],
            "word string",
        )
        counts = {r["word"].encode(): r["count"] for r in df.join(F.broadcast(vocabulary), "word", "left_semi").collect()}
        index = spark.sparkContext.broadcast(BlockIndex(rows, {**totals, "df": counts}))

        def scan(batches, index=index):
            ready = index.value
            for batch in batches:
                made = [
                    (i, t, ready.ids[at], *counts)
                    for i, t, text in zip(batch["id"], batch["t"], batch["text"])
                    for at, counts in ready.search(text, threshold).items()
                ]
                yield pd.DataFrame(made, columns=names)

        found = cast_back(texts.mapInPandas(scan, schema), **kinds)
        out = found if out is None else out.unionByName(found)
    return out


def benchmark_matches(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    threshold: float = THRESHOLD,
    max_items: int = MAX_ITEMS,
    max_bytes: int = MAX_BYTES,
) -> DataFrame:
    """``id_col``, ``item_id``, passages, question_hits, answer_hits: one row per text and item."""
    found = _matches(docs, items, id_col, text_col, item_id, item_text, threshold, max_items, max_bytes)
    counts = ("passages", "question_hits", "answer_hits")
    return found.select(F.col("id").alias(id_col), F.col("item").alias(item_id), *counts)


def drop_contaminated(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    threshold: float = THRESHOLD,
    max_items: int = MAX_ITEMS,
    max_bytes: int = MAX_BYTES,
) -> DataFrame:
    """The rows of ``docs`` whose text holds no test item, with their own columns.

    Rows are told apart by id and text, so a clean row stays where others with its id, or none, go.
    """
    hit = _matches(docs, items, id_col, text_col, item_id, item_text, threshold, max_items, max_bytes)
    hit = staged(hit.select("id", "t").distinct(), "contaminated")
    return without(docs, hit, id_col, text_col)
