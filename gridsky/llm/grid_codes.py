"""Vector code compression: product codes whose nearest entries are found through memoised grid cells.

Components become integers, floor(1024 x). A vector is cut into equal consecutive parts; each
part position has a codebook of at most 256 entries, the parts of the smallest ids, improved by
rounds of assignment and floored means. All of it is exact in whole numbers, so codes
are the same on any cluster.

The nearest entry of a part is found in its grid cell: components divided by ``CELL`` name the cell,
whose hash finds it in a cache. Over the box of a cell, an entry whose least distance exceeds another's
greatest one is never the nearest; the others are cached with the cell and only they are
evaluated exactly for the parts in it. Bounds are sums over components of small tables, one for each
coordinate met. A cache holds ``CACHE`` cells at most and starts anew beyond.

A round is one pass over the vectors, which sums parts by entry within each task; the sums of
all tasks, a row for each entry and task, are added up on Spark, and only the codebooks (256
entries at most) come to the driver. Sums beyond 64 bits stay exact.

Cases: a null vector or one with a null, infinite or NaN component is dropped; so is a vector whose
length differs from that of the kept row of the smallest id, and all rows go if that length is no multiple
of the parts or 0. Fewer than 256 rows give as many entries. Repeated ids each count;
among them the smaller vector ranks first. Null ids rank last and stay. Errors beyond 64
bits are given as the largest long. An empty table gives an empty result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridsky.llm.common import staged

SCALE = 1024
PARTS = 4
ENTRIES = 256
ROUNDS = 4
#: Side of a grid cell, in whole-number components.
CELL = 32
#: Cells kept by a process for one codebook.
CACHE = 20_000
#: Rows handled at once; bounds take ROWS x ENTRIES numbers.
ROWS = 512
LARGEST = (1 << 63) - 1
#: Components up to PLAIN keep squared distances of up to MOST components within 64 bits.
PLAIN, MOST = 1 << 23, 1 << 14


def whole(vectors: np.ndarray) -> np.ndarray:
    """floor(1024 x): 64-bit numbers, or Python's where one is too large for safe arithmetic."""
    vectors = np.asarray(vectors, dtype=np.float64)
    if np.abs(vectors).max(initial=0) < PLAIN / SCALE and vectors.shape[-1] <= MOST:
        return np.floor(vectors * SCALE).astype(np.int64)
    made = np.empty(vectors.shape, dtype=object)
    for at, x in np.ndenumerate(vectors):
        # A double from 2**53 on is a whole number.
        made[at] = int(x) * SCALE if abs(x) >= 1 << 53 else math.floor(x * SCALE)
    return made


class Codebook:
    """The entries of one part position, with the cache of grid cells."""

    def __init__(self, entries: list[list[int]], cell: int = CELL, cache: int = CACHE):
        large = max((abs(x) for e in entries for x in e), default=0) >= PLAIN
        self.entries = np.array(entries, dtype=object if large else np.int64)
        self.cell, self.room = cell, cache
        self.cells: dict[bytes | tuple, np.ndarray] = {}
        self.evaluated = 0

    def nearest(self, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of and squared distance to the nearest entry; the lower index of equals."""
        index = np.empty(len(parts), dtype=np.int64)
        distance = np.empty(len(parts), dtype=object if object in (parts.dtype, self.entries.dtype) else np.int64)
        for k in range(0, len(parts), ROWS):
            index[k : k + ROWS], distance[k : k + ROWS] = self._nearest(parts[k : k + ROWS])
        return index, distance

    def _nearest(self, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        grid = parts // self.cell
        names = [tuple(r) for r in grid.tolist()] if grid.dtype == object else [r.tobytes() for r in grid]
        missing = {name: k for k, name in enumerate(names) if name not in self.cells}
        if len(self.cells) + len(missing) > self.room:
            self.cells.clear()
            missing = {name: k for k, name in enumerate(names)}
        if missing:
            self.cells.update(zip(missing, self._undominated(grid[list(missing.values())])))
        chosen = [self.cells[name] for name in names]
        sizes = np.array([len(c) for c in chosen])
        starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        entry = np.concatenate(chosen)
        self.evaluated += len(entry)
        away = parts[np.repeat(np.arange(len(parts)), sizes)] - self.entries[entry]
        squares = (away * away).sum(axis=1)
        least = np.minimum.reduceat(squares, starts)
        # Entries of a cell ascend, so the first of equals has the lowest index.
        ties = np.where(squares == np.repeat(least, sizes), entry, len(self.entries))
        return np.minimum.reduceat(ties, starts), least

    def _undominated(self, grid: np.ndarray) -> list[np.ndarray]:
        """Entries of each cell that no other entry beats all over its box."""
        # Half as wide numbers, where the largest sum fits, are twice as fast.
        reach = max(int(np.abs(grid).max(initial=0)) * self.cell, int(np.abs(self.entries).max(initial=0))) * 2 + self.cell
        kind = np.int32 if reach * reach * grid.shape[1] < 1 << 31 else None
        near = far = 0
        for axis in range(grid.shape[1]):
            met, place = np.unique(grid[:, axis], return_inverse=True)
            low, at = (met * self.cell)[:, None], self.entries[:, axis][None, :]
            under, over = low - at, at - (low + self.cell - 1)
            outside = np.maximum(np.maximum(under, over), 0)
            away = np.maximum(np.abs(under), np.abs(over))
            least, most = (outside * outside, away * away) if kind is None else ((outside * outside).astype(kind), (away * away).astype(kind))
            near = near + least[place]
            far = far + most[place]
        stay = (near <= far.min(axis=1)[:, None]).astype(bool)
        rows, entries = np.nonzero(stay)
        ends = np.searchsorted(rows, np.arange(len(grid)), side="right").tolist()
        return [entries[a:b] for a, b in zip([0, *ends], ends)]


def kept_vectors(rows: DataFrame, id_col: str, vector_col: str, label_col: str, parts: int) -> DataFrame:
    """id, v and label of the rows that take part."""

    def finite(x: Column) -> Column:
        return x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < F.lit(math.inf))

    rows = rows.select(
        F.col(id_col).alias("id"), F.col(vector_col).alias("v"), F.col(label_col).alias("label")
    ).where(F.col("v").isNotNull() & F.forall("v", finite))
    first = rows.select("id", "v").orderBy(F.col("id").isNull(), "id", "v").first()
    length = 0 if first is None else len(first.v)
    return rows.where(F.size("v") == length) if length and length % parts == 0 else rows.where(F.lit(False))


def _split(vectors: pd.Series, parts: int) -> list[np.ndarray]:
    return np.split(whole(np.stack([np.asarray(v, dtype=np.float64) for v in vectors])), parts, axis=1)


def first_codebooks(rows: DataFrame, parts: int, size: int) -> list[list[list[int]]]:
    """The parts of the ``size`` smallest ids, by part."""
    first = rows.select("id", "v").orderBy(F.col("id").isNull(), "id", "v").limit(size).collect()
    if not first:
        return [[] for _ in range(parts)]
    return [part.tolist() for part in _split(pd.Series([r.v for r in first]), parts)]


def improved(rows: DataFrame, codebooks: list[list[list[int]]], cell: int) -> list[list[list[int]]]:
    """One round: floored means of the parts nearest to each entry; unused entries stay."""
    parts = len(codebooks)

    def sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        books = [Codebook(b, cell) for b in codebooks]
        counts, totals = {}, {}
        for batch in batches:
            if not len(batch):
                continue
            for k, part in enumerate(_split(batch["v"], parts)):
                index, _ = books[k].nearest(part)
                order = np.argsort(index, kind="stable")
                used, starts = np.unique(index[order], return_index=True)
                ends = [*starts[1:], len(order)]
                for e, a, b, total in zip(used.tolist(), starts, ends, np.add.reduceat(part[order], starts)):
                    key = (k, e)
                    counts[key] = counts.get(key, 0) + int(b - a)
                    more = [int(x) for x in total]
                    totals[key] = [x + y for x, y in zip(totals[key], more)] if key in totals else more
        made = [(k, e, n, [str(x) for x in totals[k, e]]) for (k, e), n in counts.items()]
        yield pd.DataFrame(made, columns=["part", "entry", "n", "total"])

    def added(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts, totals = {}, {}
        for batch in batches:
            for k, e, n, total in zip(batch["part"], batch["entry"], batch["n"], batch["total"]):
                key, more = (k, e), [int(x) for x in total]
                counts[key] = counts.get(key, 0) + n
                totals[key] = [x + y for x, y in zip(totals[key], more)] if key in totals else more
        made = [(k, e, n, [str(x // n) for x in totals[k, e]]) for (k, e), n in counts.items()]
        yield pd.DataFrame(made, columns=["part", "entry", "n", "total"])

    schema = "part int, entry int, n long, total array<string>"
    partial = rows.select("v").mapInPandas(sums, schema)
    # All sums of an entry meet in one task, which adds them as they come.
    means = partial.repartition("part", "entry").mapInPandas(added, schema).collect()
    books = [list(b) for b in codebooks]
    for r in means:
        books[r.part][r.entry] = [int(x) for x in r.total]
    return books


def train_codebooks(
    rows: DataFrame, parts: int = PARTS, size: int = ENTRIES, rounds: int = ROUNDS, cell: int = CELL
) -> list[list[list[int]]]:
    """Codebooks by part of the rows of ``kept_vectors``; at most ``parts`` x ``size`` entries."""
    books = first_codebooks(rows, parts, size)
    for _ in range(rounds):
        books = improved(rows, books, cell)
    return books


def encoded(rows: DataFrame, codebooks: list[list[list[int]]], cell: int = CELL) -> DataFrame:
    """id, label, code (two hex digits a part) and error (squared distance) of each row."""
    parts = len(codebooks)

    @F.pandas_udf("code string, error long")
    def encode(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        books = [Codebook(b, cell) for b in codebooks]
        for vectors in batches:
            codes, error = [""] * len(vectors), np.zeros(len(vectors), dtype=np.int64)
            for book, part in zip(books, _split(vectors, parts) if len(vectors) else ()):
                index, distance = book.nearest(part)
                codes = [c + f"{i:02x}" for c, i in zip(codes, index.tolist())]
                error = error + distance
            yield pd.DataFrame({"code": codes, "error": [min(int(x), LARGEST) for x in error]})

    return rows.select("id", "label", encode("v").alias("c")).select("id", "label", "c.code", "c.error")


def decode(code: str, codebooks: list[list[list[int]]]) -> list[int]:
    """The vector that a code stands for."""
    pairs = zip(codebooks, (int(code[k : k + 2], 16) for k in range(0, len(code), 2)))
    return [x for book, index in pairs for x in book[index]]


def codebooks_digest(codebooks: list[list[list[int]]]) -> str:
    return hashlib.sha256(",".join(str(x) for b in codebooks for e in b for x in e).encode()).hexdigest()


def compress_vectors(
    rows: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    parts: int = PARTS,
    size: int = ENTRIES,
    rounds: int = ROUNDS,
    cell: int = CELL,
) -> DataFrame:
    """``id_col``, code, error, label_error and codebooks_sha256 of every row that is kept."""
    if not 0 < size <= 256:
        raise ValueError("a code has two hex digits a part: 1 to 256 entries")
    vectors = staged(kept_vectors(rows, id_col, vector_col, label_col, parts), "vectors")
    books = train_codebooks(vectors, parts, size, rounds, cell)
    codes = staged(encoded(vectors, books, cell), "codes")
    # A label that very many rows share leaves each task as one row.
    exact = F.sum(F.col("error").cast("decimal(38,0)"))
    totals = codes.groupBy("label").agg(F.least(exact, F.lit(LARGEST)).cast("long").alias("label_error"))
    totals = totals.withColumnRenamed("label", "of")
    return codes.join(totals, F.col("label").eqNullSafe(F.col("of"))).select(
        F.col("id").alias(id_col), "code", "error", "label_error", F.lit(codebooks_digest(books)).alias("codebooks_sha256")
    )
