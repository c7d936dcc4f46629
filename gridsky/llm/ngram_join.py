"""N-gram Jaccard join by prefixes of tokens and token combinations.

A text's set holds its distinct five-word shingles (one shingle of all words
where there are fewer). Two texts link when the Jaccard similarity of their sets is 0.75 or
more; components follow the links. Copies share one set and count once.

1. Token classes. Every shingle of every text is counted, by the bucket that its
   hash falls in; there are about as many buckets as an eighth of all shingles. A shingle is frequent
   if its bucket holds far more than the mean, and rare otherwise. Only a bit per
   bucket is broadcast, at most ``MAX_BITS`` of them.
2. Prefixes. All tokens have one order: rare before frequent, then by hash. A set
   x can lack at most tau = |x| / 4 tokens of a similar set. Its prefix is extended until
   rare tokens + sum over groups of (frequent tokens in the group - 1) exceeds tau, where
   frequent tokens are dealt into groups by hash. Similar sets then share a rare
   token of both prefixes, or two frequent tokens of one group: single rare tokens and
   pairs of frequent tokens are indexed. How many groups there are follows from the size of
   the set to a power of two; a set that could match a larger one of the next power also
   enters its pairs for that one.
3. Rare tokens have few sets each, by their definition. Sets that share one are
   paired if their sizes allow it, and a pair is kept if the shared prefix tokens
   and all that follows the prefixes can reach the overlap needed.
4. Combinations may have very many sets: a group of near copies shares them
   all. There the sets meet a few cores (in each band of sizes the set with the fewest rare tokens).
   Only sets that are then still in different components are paired, the sets outside a combination's
   largest component with all others, and only if the frequent tokens of both, and what
   both have of a core, allow the overlap.
5. Pairs are verified on the whole sets; components come from alternating large
   and small stars.

Nothing is left out in 3 and 4: the bounds follow from the order (see
``overlap_bound``), and a pair within a component needs no link.

Shingles are compared by 64-bit hashes, sets by 128-bit digests.

Cases: a text without words has an empty set, links with nothing and is its own
component; sets of one or two shingles link with equal sets only; a null id
is a row of its own that never names a component unless all ids in it are null; repeated rows are copies;
an empty table gives an empty result; other columns are ignored, whatever their
names.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from functools import reduce
from operator import add

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridsky.llm.common import (
    as_text,
    base_powers,
    cast_back,
    checked_broadcast,
    discard,
    mix64,
    running_hash,
    small_batches,
    staged,
    staged_at,
    utf8,
    width,
    without,
    words_of,
)

WORDS = 5
#: Buckets of the frequency table: 2 to the power of these at least and at most (32 MiB of bits).
MIN_BITS, MAX_BITS = 16, 28
#: Buckets whose counts are added up in one piece.
PIECE_BITS = 16
#: Sizes in one band differ by this factor at most. It is above 4/3, so similar sets are in the same band or in neighbouring ones.
BAND = 1.34
#: First combinations that a set knows when pairs are met.
KNOWN = 16
#: Kinds of index rows: the set itself, a rare token, a pair of frequent tokens.
SET, RARE, PAIR = 0, 1, 2
#: Steps of sizes that go with a token: similar sets are at most NEAR steps of this factor apart.
STEP, NEAR = 1.05, 7
#: Shingles that a task gathers before it hands on their counts.
GATHER = 1_000_000


def shingle_set(text: str | None, n: int = WORDS) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's shingles."""
    words = words_of(utf8(text))
    if not words:
        return np.zeros(0, dtype=np.uint64)
    data = np.frombuffer(b" ".join(words), dtype=np.uint8)
    total = running_hash(data)
    _, down = base_powers(len(data))
    blanks = np.flatnonzero(data == 32)
    begins = np.concatenate([[0], blanks + 1])
    ends = np.concatenate([blanks, [len(data)]])
    n = min(n, len(words))
    begins, ends = begins[: len(words) - n + 1], ends[n - 1 :]
    return np.unique(mix64((total[ends] - total[begins]) * down[begins]))


def digest(shingles: np.ndarray) -> bytes:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


def short(set_digest: bytes) -> int:
    """The first 64 bits of a digest; sets that share them are told apart when verified."""
    return int.from_bytes(set_digest[:8], "little", signed=True)


def signatures(shingles: np.ndarray, frequent: np.ndarray) -> tuple[np.ndarray, np.ndarray, int, bool]:
    """Rare tokens of the prefix, hashed pairs of frequent tokens, the rest, and whether pairs were needed.

    The rest is what ``overlap_bound`` needs: the tokens behind the prefix, or all
    frequent tokens where pairs were needed. ``frequent`` marks the frequent tokens.
    """
    size = len(shingles)
    tau = size // 4
    rare = shingles[~frequent][: tau + 1]
    if len(rare) > tau:
        return rare, np.zeros(0, dtype=np.uint64), size - len(rare), False
    common = shingles[frequent]
    made = []
    for level in sorted({size.bit_length(), (4 * size // 3).bit_length()}):
        groups = max(1, 1 << level >> 5)
        group = mix64(common ^ np.uint64(0xA5A5A5A5)) % np.uint64(groups)
        gain = np.ones(len(common), dtype=np.int64)
        gain[np.unique(group, return_index=True)[1]] = 0
        cut = int(np.searchsorted(np.cumsum(gain), tau + 1 - len(rare))) + 1
        tokens, group = common[:cut], group[:cut]
        order = np.argsort(group, kind="stable")
        tokens, group = tokens[order], group[order]
        starts = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
        for begin, end in zip(starts, np.append(starts[1:], len(tokens))):
            a, b = np.triu_indices(int(end - begin), 1)
            own = tokens[begin:end]
            made.append(mix64(mix64(own[a] + np.uint64(level)) ^ own[b]))
    return rare, np.unique(np.concatenate(made)), len(common), True


def _gaps(buckets: np.ndarray) -> bytes:
    """Rising numbers below 2**16 by their distances, in a byte each if all fit; the first byte is the width."""
    gaps = np.diff(buckets.astype(np.int64), prepend=0)
    kind = np.uint8 if gaps.max() < 256 else np.uint16
    return bytes([kind().itemsize]) + gaps.astype(kind).tobytes()


def _from_gaps(raw: bytes) -> np.ndarray:
    return np.cumsum(np.frombuffer(raw[1:], np.uint8 if raw[0] == 1 else np.uint16), dtype=np.int64)


def _counts(batches, bits: int) -> Iterator[pd.DataFrame]:
    """One row for each text, and rows with counts for pieces of the frequency table."""
    names = ["id", "t", "n", "set", "d", "piece", "gaps", "counts"]
    held, size = [], 0

    def pieces():
        found, counts = np.unique(np.concatenate(held), return_counts=True)
        piece = found >> np.uint64(PIECE_BITS)
        starts = np.flatnonzero(np.concatenate([[True], piece[1:] != piece[:-1]]))
        rows = [
            (
                None, None, None, None, None, int(piece[a]),
                _gaps(found[a:b] & np.uint64((1 << PIECE_BITS) - 1)),
                counts[a:b].astype(np.uint32).tobytes() if counts[a:b].max() > 1 else b"",
            )
            for a, b in zip(starts, np.append(starts[1:], len(found)))
        ]
        return pd.DataFrame(rows, columns=names)

    for batch in batches:
        rows = []
        for i, t, text in zip(batch["id"], batch["t"], batch["text"]):
            s = shingle_set(text)
            name = digest(s)
            rows.append((i, t, len(s), name, short(name), None, None, None))
            if len(s):
                held.append(s >> np.uint64(64 - bits))
                size += len(s)
        yield pd.DataFrame(rows, columns=names)
        if size > GATHER:
            yield pieces()
            held, size = [], 0
    if held:
        yield pieces()


def _frequent(counted: DataFrame, bits: int) -> np.ndarray:
    """A bit for each bucket: set if it holds far more than the mean of its piece."""
    size = 1 << min(PIECE_BITS, bits)

    def add(batches):
        total, at = np.zeros(size, dtype=np.int64), None

        def done():
            mean = total.mean()
            return pd.DataFrame([(at, np.packbits(total > mean + 6 * math.sqrt(mean) + 8).tobytes())], columns=["piece", "bits"])

        for batch in batches:
            for piece, gaps, counts in zip(batch["piece"], batch["gaps"], batch["counts"]):
                if piece != at:
                    if at is not None:
                        yield done()
                    at = piece
                    total[:] = 0
                # Within one row a bucket comes once.
                total[_from_gaps(gaps)] += np.frombuffer(counts, np.uint32) if counts else 1
        if at is not None:
            yield done()

    rows = counted.where("piece IS NOT NULL").select("piece", "gaps", "counts")
    found = rows.repartition("piece").sortWithinPartitions("piece").mapInPandas(add, "piece int, bits binary")
    flags = np.zeros((max(1, (1 << bits) // size), size // 8), dtype=np.uint8)
    for row in found.collect():  # 2**bits / 8 bytes in all
        flags[row.piece] = np.frombuffer(row.bits, dtype=np.uint8)
    return flags.reshape(-1)


def _is_frequent(shingles: np.ndarray, flags: np.ndarray, bits: int) -> np.ndarray:
    bucket = shingles >> np.uint64(64 - bits)
    return (flags[bucket >> np.uint64(3)] >> (np.uint64(7) - (bucket & np.uint64(7))).astype(np.uint8)) & 1 == 1


def _pack(n: int, rest: int, mixed: bool) -> int:
    return n << 32 | rest << 1 | int(mixed)


def _unpacked(about: str) -> tuple[Column, Column, Column]:
    """n, rest and mixed of a packed column."""
    return F.shiftright(about, 32), F.shiftright(F.col(about).bitwiseAND(F.lit(0xFFFFFFFF)), 1), F.col(about) % 2 == 1


def _needed(a: Column, b: Column) -> Column:
    """Overlap of sets of these sizes that gives a similarity of 0.75: 3/7 of the sum."""
    return F.ceil((a + b) * 3 / F.lit(7.0))


def _sizes_allow(a: Column, b: Column) -> Column:
    return F.least(a, b) * 4 >= F.greatest(a, b) * 3


def overlap_bound(shared: Column, rest_a: Column, mixed_a: Column, rest_b: Column, mixed_b: Column) -> Column:
    """The largest overlap that two sets with ``shared`` common rare prefix tokens can have.

    Prefixes of rare tokens only: the common tokens up to the end of the prefix that ends
    first are shared ones; others lie behind the prefix of that set. If one set needed
    frequent tokens, the other's prefix ends first. If both did, the prefixes hold all their rare
    tokens, and others are frequent in both.
    """
    return shared + (
        F.when(mixed_a & mixed_b, F.least(rest_a, rest_b))
        .when(mixed_a, rest_b)
        .when(mixed_b, rest_a)
        .otherwise(F.greatest(rest_a, rest_b))
    )


def components(links: DataFrame, a: str = "a", b: str = "b", label: str = "components") -> DataFrame:
    """(node, root) for every node of the links; the root is the least node of its component.

    Alternating large and small stars until nothing changes.
    """
    spark = links.sparkSession
    edges, at = staged_at(
        links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct(), label
    )
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        # Large star: greater neighbours go to the least of the neighbourhood.
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        large, large_at = staged_at(large, label)
        # Small star: a node's lesser neighbours, and itself, go to the least of them.
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(low.select("u", F.col("m").alias("v")))
            .where("u <> v").distinct()
        )
        edges, small_at = staged_at(small, label)
        for old in (at, large_at):
            discard(spark, old)
        at = small_at
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
                edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
            )
        before = now


class Join:
    """One run of the join; its steps are staged in the shared folder."""

    def __init__(self, docs: DataFrame, id_col: str, text_col: str):
        spark = docs.sparkSession
        small_batches(spark)
        rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
        self.texts = rows.select("id", F.xxhash64("text").alias("t"), "text")
        # About one shingle a word; words take some six bytes with their blank.
        guess = (rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0) / 6
        self.bits = min(MAX_BITS, max(MIN_BITS, math.ceil(math.log2(max(1, guess / 8)))))
        bits = self.bits
        kind = dict(self.texts.dtypes)["id"]
        counted = self.texts.select(*as_text("id"), "t", "text").mapInPandas(
            lambda batches: _counts(batches, bits),
            "id string, t long, n long, set binary, d long, piece int, gaps binary, counts binary",
        )
        counted = staged(cast_back(counted, id=kind), "join-counts")
        self.rows = counted.where("piece IS NULL").select("id", "t", "n", "set", "d")
        self.known = spark.sparkContext.broadcast(_frequent(counted, bits))

    def _signed(self) -> DataFrame:
        """sig, d, about, pair: what each set is indexed by, and a row without ``pair`` for the set itself; ``about`` packs n, rest and mixed."""
        flags, bits = self.known, self.bits

        def scan(batches):
            known, seen = flags.value, set()
            for batch in batches:
                parts = []
                for text in batch["text"]:
                    s = shingle_set(text)
                    d = short(digest(s))
                    # Copies in this task are combined here; two shingles match only an equal set.
                    if len(s) < 3 or d in seen:
                        continue
                    seen.add(d)
                    rare, pairs, rest, mixed = signatures(s, _is_frequent(s, known, bits))
                    one = np.zeros(1, dtype=np.uint64)
                    for sigs, kind in ((one, SET), (rare, RARE), (pairs, PAIR)):
                        if len(sigs):
                            parts.append((sigs.view(np.int64), d, _pack(len(s), rest, mixed), kind))
                counts = [len(p[0]) for p in parts]
                yield pd.DataFrame(
                    {
                        "sig": np.concatenate([p[0] for p in parts]) if parts else np.zeros(0, np.int64),
                        **{
                            name: np.repeat(np.array([p[k] for p in parts], dtype=kind), counts)
                            for k, (name, kind) in enumerate((("d", np.int64), ("about", np.int64), ("kind", np.int8)), 1)
                        },
                    }
                )

        schema = "sig long, d long, about long, kind byte"
        rows = self.texts.select("text").mapInPandas(scan, schema)
        pair = F.when(F.col("kind") != SET, F.col("kind") == PAIR)
        signed, self.signed_at = staged_at(rows.select("sig", "d", "about", pair.alias("pair")), "join-signatures")
        return signed

    def _rare_pairs(self, signed: DataFrame) -> DataFrame:
        """Pairs that share rare prefix tokens and can still be similar."""
        # One exchange, by the token, serves the removal of copies and both sides of the join. It
        # carries more rows than any other, so they are narrow (of a set's size only a step) and
        # its partitions are made smaller.
        parts = 3 * width(signed.sparkSession)
        step = F.floor(F.log(_unpacked("about")[0]) / math.log(STEP)).cast("short")
        rare = signed.where("NOT pair").select("sig", "d", step.alias("step")).repartition(parts, "sig").distinct()
        a, b = rare.alias("a"), rare.alias("b")
        met = a.join(
            b, (F.col("a.sig") == F.col("b.sig")) & (F.col("a.d") < F.col("b.d")) & (F.abs(F.col("a.step") - F.col("b.step")) <= NEAR)
        )
        counted = met.select(F.col("a.d").alias("a"), F.col("b.d").alias("b")).groupBy("a", "b").agg(F.count(F.lit(1)).alias("shared"))
        about = signed.where("pair IS NULL").groupBy("d").agg(F.min("about").alias("about"))
        for side in "ab":
            counted = counted.join(about.select(F.col("d").alias(side), F.col("about").alias(f"about_{side}")), side)
        (n_a, *rest_a), (n_b, *rest_b) = _unpacked("about_a"), _unpacked("about_b")
        bound = overlap_bound(F.col("shared"), *rest_a, *rest_b)
        return counted.where(_sizes_allow(n_a, n_b) & (bound >= _needed(n_a, n_b))).select("a", "b")

    def _cores(self, pairs: DataFrame) -> DataFrame:
        """The core of each combination and band of sizes: sig, near (the band), core.

        The core is the set with the fewest rare tokens, of these the one that the most tasks found
        copies of. Combinations of a single set have none.
        """
        core = pairs.groupBy("sig", "band").agg(
            F.min(F.struct((F.col("n") - F.col("rest")).alias("rare"), -F.col("copies"), "d")).alias("core"),
            F.count(F.lit(1)).alias("sets"),
        )
        shared = core.groupBy("sig").agg(F.sum("sets").alias("all")).where("all > 1").select("sig")
        return staged(
            core.join(shared, "sig").select("sig", F.col("band").alias("near"), F.col("core.d").alias("core")), "join-cores"
        )

    def _core_pairs(self, pairs: DataFrame, cores: DataFrame) -> DataFrame:
        """For combinations: each set with the cores of its own band and of the bands beside it."""
        met = pairs.join(cores, "sig").where((F.abs(F.col("band") - F.col("near")) <= 1) & (F.col("d") != F.col("core")))
        return met.select(F.least("d", "core").alias("a"), F.greatest("d", "core").alias("b")).distinct()

    def _cross_pairs(self, pairs: DataFrame, cores: DataFrame, roots: DataFrame, compared: DataFrame) -> DataFrame:
        """For combinations: sets that share one and are in different components so far.

        Such sets share no rare token that is not found in step 3. What else they share is
        frequent, and lies in a core (at most the less of what both have of its frequent
        tokens) or outside of it (at most the less of what both have left).
        """
        placed = pairs.join(roots, pairs["d"] == roots["node"], "left").select(
            "sig", "d", "n", "rest", "band", F.coalesce("root", "d").alias("root")
        )
        placed = staged(placed, "join-placed")
        sizes = placed.groupBy("sig", "root").agg(F.count(F.lit(1)).alias("sets"))
        split = sizes.groupBy("sig").agg(F.max_by("root", F.struct("sets", "root")).alias("major"), F.count(F.lit(1)).alias("roots"))
        left = placed.join(staged(split.where("roots > 1").drop("roots"), "join-split"), "sig").join(cores, "sig")
        left = left.where(F.abs(F.col("band") - F.col("near")) <= 1)
        seen = compared.select(F.col("a").alias("seen_a"), F.col("b").alias("seen_b"), "frequent").distinct()
        left = left.join(
            seen,
            (F.least("d", "core") == F.col("seen_a")) & (F.greatest("d", "core") == F.col("seen_b")),
            "left",
        )
        inside = F.when(F.col("d") == F.col("core"), F.col("rest")).otherwise(F.col("frequent"))
        left = staged(left.select("sig", "d", "n", "rest", "band", "near", "root", "major", inside.alias("inside")), "join-left")
        # Sets that share one combination mostly share many. A set knows its first combinations, and a pair
        # that has met at one of them is not met again; beyond those, pairs that come again are made distinct.
        first = F.slice(F.array_sort(F.collect_set("sig")), 1, KNOWN)
        left = left.join(left.groupBy("d").agg(first.alias("known")), "d")
        # Most sets of a combination are in one component. The others meet all, each pair once: at the core of a's own band.
        a, b = left.where("band = near AND root <> major").alias("a"), left.alias("b")
        needed = _needed(F.col("a.n"), F.col("b.n"))
        outside = F.least(F.col("a.rest") - F.col("a.inside"), F.col("b.rest") - F.col("b.inside"))
        bound = F.least(F.col("a.inside"), F.col("b.inside")) + outside
        return (
            a.join(
                b,
                (F.col("a.sig") == F.col("b.sig"))
                & (F.col("a.near") == F.col("b.near"))
                & (F.col("a.root") != F.col("b.root"))
                & ((F.col("b.root") == F.col("b.major")) | (F.col("a.d") < F.col("b.d")))
                & _sizes_allow(F.col("a.n"), F.col("b.n"))
                & (F.least(F.col("a.rest"), F.col("b.rest")) >= needed)
                & (F.coalesce(bound, needed) >= needed)
                & (F.coalesce(F.array_min(F.array_intersect("a.known", "b.known")), F.col("a.sig")) >= F.col("a.sig")),
            )
            .select(F.least("a.d", "b.d").alias("a"), F.greatest("a.d", "b.d").alias("b"))
            .distinct()
        )

    def _sets(self, wanted: DataFrame) -> DataFrame:
        """The whole sets of ``wanted`` (d), from one row for each: d, rare, frequent (its two parts)."""
        flags, bits = self.known, self.bits
        # The row is found by its id and its text's hash.
        keys = (
            self.rows.join(wanted, "d", "left_semi")
            .groupBy("set")
            .agg(F.min(F.struct("t", "id")).alias("one"))
            .select(F.col("one.t").alias("key_t"), F.col("one.id").alias("key_id"))
        )
        keys = staged(keys, "join-keys")
        same = (F.col("t") == F.col("key_t")) & F.col("id").eqNullSafe(F.col("key_id"))
        texts = self.texts.join(checked_broadcast(keys), same, "left_semi").select("text")

        def scan(batches):
            seen = set()
            for batch in batches:
                new = []
                for s in map(shingle_set, batch["text"]):
                    d = short(digest(s))
                    if d not in seen:
                        seen.add(d)
                        often = _is_frequent(s, flags.value, bits)
                        new.append((d, s[~often].view(np.int64), s[often].view(np.int64)))
                yield pd.DataFrame(new, columns=["d", "rare", "frequent"])

        # Rows that repeat in other tasks give a set again; links are made distinct.
        return staged(texts.mapInPandas(scan, "d long, rare array<long>, frequent array<long>"), "join-sets")

    def _compared(self, candidates: DataFrame) -> DataFrame:
        """Shared, total and shared frequent shingles of the staged candidates, by their whole sets: a, b, shared, total, frequent."""
        wanted = candidates.select(F.col("a").alias("d")).unionByName(candidates.select(F.col("b").alias("d"))).distinct()
        sets = self._sets(wanted)

        def of(side: str) -> DataFrame:
            return sets.select(F.col("d").alias(side), F.col("rare").alias(f"rare_{side}"), F.col("frequent").alias(f"frequent_{side}"))

        both = candidates.join(of("a"), "a").join(of("b"), "b")
        # A shingle is rare or frequent in every set alike.
        frequent = F.size(F.array_intersect("frequent_a", "frequent_b"))
        rows = both.withColumn("frequent", frequent).withColumn("shared", F.size(F.array_intersect("rare_a", "rare_b")) + F.col("frequent"))
        size = reduce(add, [F.size(f"{part}_{side}") for part in ("rare", "frequent") for side in "ab"])
        return staged(rows.select("a", "b", "shared", (size - F.col("shared")).alias("total"), "frequent"), "join-compared")

    def links(self) -> DataFrame:
        """Similar pairs (a, b) of different sets; within a component some may be left out."""
        similar = F.col("shared") * 100 >= F.col("total") * 75
        signed = self._signed()
        n, rest, _ = _unpacked("about")
        pairs = signed.where("pair").groupBy("sig", "d", "about").agg(F.count(F.lit(1)).alias("copies"))
        pairs = pairs.select("sig", "d", n.cast("int").alias("n"), rest.cast("int").alias("rest"), "copies")
        pairs = staged(pairs.withColumn("band", F.floor(F.log("n") / math.log(BAND)).cast("int")), "join-pairs")
        cores = self._cores(pairs)
        candidates = staged(self._rare_pairs(signed).unionByName(self._core_pairs(pairs, cores)).distinct(), "join-candidates")
        discard(signed.sparkSession, self.signed_at)
        compared = self._compared(candidates)
        first = compared.where(similar).select("a", "b")
        if cores.isEmpty():
            return first
        cross = staged(self._cross_pairs(pairs, cores, components(first), compared), "join-candidates")
        return first.unionByName(self._compared(cross).where(similar).select("a", "b"))


def _placed(run: Join) -> DataFrame:
    """id, t, n, class_id, component_id and root (None for empty sets) of every row."""
    roots = components(run.links())
    classes = run.rows.where("n > 0").groupBy("set", "d").agg(F.min("id").alias("class_id"))
    placed = staged(
        classes.join(roots, classes["d"] == roots["node"], "left").select(
            "set", "class_id", F.coalesce("root", "d").alias("root")
        ),
        "join-classes",
    )
    least = placed.groupBy("root").agg(F.min("class_id").alias("component_id"))
    named = staged(placed.join(least, "root"), "join-components")
    return run.rows.join(named, "set", "left")


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, n_shingles, component_id, class_id (least id with the same set), for every row."""
    return _placed(Join(docs, id_col, text_col)).select(
        F.col("id").alias(id_col),
        F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("id")).alias("component_id"),
        F.when(F.col("n") > 0, F.col("class_id")).otherwise(F.col("id")).alias("class_id"),
    )


def one_per_component(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, with their own columns, one for each component; texts without words stay.

    The row with the least id stays (ids that are not null first, then by a hash of the
    text). Repeated rows of the row that stays become one.
    """
    run = Join(docs, id_col, text_col)
    rows = staged(_placed(run).where("n > 0").select("id", "t", "root"), "join-placed-rows")
    key = F.struct(F.col("id").isNull().alias("unknown"), "id", "t")
    first = staged(rows.groupBy("root").agg(F.min(key).alias("first"), F.count(F.lit(1)).alias("n")), "join-first")
    grouped = rows.join(first.where("n > 1"), "root")
    gone = staged(grouped.where(key != F.col("first")).select("id", "t").distinct(), "join-gone")
    left = without(docs, gone, id_col, text_col)
    again = rows.groupBy("root", "id", "t").count().where("count > 1")
    return left if again.isEmpty() else _without_repeats(left, again, id_col, text_col)


def _without_repeats(docs: DataFrame, again: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """One of the rows that repeat (id, t)."""
    own = [F.col(f"`{c}`") for c in docs.columns]
    keyed = docs.select(F.struct(*own).alias("row"), F.col(id_col).alias("id"), F.xxhash64(F.col(text_col).cast("string")).alias("t"))
    keys = staged(again.select(F.col("id").alias("again_id"), F.col("t").alias("again_t")), "join-again")
    same = (F.col("t") == F.col("again_t")) & F.col("id").eqNullSafe(F.col("again_id"))
    single = keyed.join(keys, same, "left_anti").select("row.*")
    # Rows that repeat are combined in their task first, and carry their columns as they are.
    one = keyed.join(keys, same, "left_semi").groupBy("id", "t").agg(F.min("row").alias("row")).select("row.*")
    return single.unionByName(one)
