"""Sharding by a hierarchical weighted hash tree, in DataFrame functions only.

A row descends region, rack and shard. At each level every child draws
``-ln(u) / weight`` with ``u`` hashed from the row's key and the child's name,
and the smallest draw wins, so a child is chosen in proportion to its weight.
A draw depends on nothing but the key, the name and the weight: where a weight
grows, rows move only into that child's subtree; where it shrinks, only out of
it; below unchanged nodes nothing moves. A new shard joins under a region of its
own, so it takes rows only into itself.

Rows get a gapless slot in their shard: they are numbered within small buckets
of the shard, after the counts of the buckets before, so no task sees a whole
shard.

Cases: null and repeated ids follow the law (equal ids share a shard, a null id
counts as the text "null"); a null text has no bytes; an empty table gives an
empty result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridsky.llm.common import staged, text_or_empty, width

#: Bytes that a record takes besides its text.
ROW_BYTES = 16


@dataclass(frozen=True)
class Leaf:
    region: str
    rack: str
    shard: int
    weight: float = 1.0


@dataclass(frozen=True)
class HashTree:
    """Shards with their place and weight; an inner node weighs as much as its shards."""

    leaves: tuple[Leaf, ...]

    @staticmethod
    def uniform(regions: int = 5, racks: int = 2, shards: int = 4) -> HashTree:
        number = iter(range(regions * racks * shards))
        return HashTree(
            tuple(
                Leaf(f"r{r}", f"r{r}/k{k}", next(number))
                for r in range(regions)
                for k in range(racks)
                for _ in range(shards)
            )
        )

    def grown(self, weight: float = 1.0) -> HashTree:
        """One more shard, in a region and rack of its own."""
        shard = max((x.shard for x in self.leaves), default=-1) + 1
        return HashTree((*self.leaves, Leaf(f"g{shard}", f"g{shard}/k0", shard, weight)))

    def levels(self) -> tuple[dict, dict, dict]:
        """Children by parent, as (name, weight), for the root, regions and racks."""
        regions, racks, shards = {"": {}}, {}, {}
        for x in self.leaves:
            if x.weight <= 0:
                continue
            for children, name in (
                (regions[""], x.region),
                (racks.setdefault(x.region, {}), x.rack),
                (shards.setdefault(x.rack, {}), f"{x.rack}/s{x.shard}"),
            ):
                children[name] = children.get(name, 0.0) + x.weight
        return regions, racks, shards


def _draw(key: Column, name: Column, weight: Column) -> Column:
    """-ln(u) / weight; u is in (0, 1), from the first 52 bits of the digest of key and name."""
    bits = F.conv(F.substring(F.md5(F.concat(key, F.lit("|"), name).cast("binary")), 1, 13), 16, 10)
    return -F.log((bits.cast("double") + F.lit(0.5)) / F.lit(float(1 << 52))) / weight


def _children(level: dict) -> Column:
    """The level as a constant map from the parent to its children; as large as the tree."""
    return F.create_map(
        *[
            part
            for parent, children in level.items()
            for part in (
                F.lit(parent),
                F.array(*[F.struct(F.lit(n).alias("name"), F.lit(w).alias("weight")) for n, w in children.items()]),
            )
        ]
    )


def place(rows: DataFrame, key: str, tree: HashTree, name: str) -> DataFrame:
    """Add the column ``name``: the shard to which each row descends."""
    at = F.lit("")
    for level in tree.levels():
        drawn = F.transform(
            _children(level)[at],
            lambda c: F.struct(
                _draw(F.col(key), c["name"], c["weight"]).alias("draw"), c["name"].alias("name")
            ),
        )
        rows = rows.withColumn(name, F.array_min(drawn)["name"])
        at = F.col(name)
    return rows.withColumn(name, F.regexp_extract(F.col(name), "s(\\d+)$", 1).cast("int"))


def shard_documents(
    docs: DataFrame,
    tree: HashTree | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``id_col``, size, text_crc32, law ("key"), shard, slot, grown_shard (with one shard more)."""
    tree = tree or HashTree.uniform()
    text = text_or_empty(F.col(text_col))
    rows = docs.select(
        F.col(id_col).alias("id"),
        F.coalesce(F.col(id_col).cast("string"), F.lit("null")).alias("key"),
        (F.octet_length(text) + ROW_BYTES).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
    )
    rows = place(place(rows, "key", tree, "shard"), "key", tree.grown(), "grown_shard")
    buckets = max(16, width(docs.sparkSession))
    # A row's bucket holds from here on, also where repeated rows are spread.
    rows = staged(
        rows.withColumn(
            "bucket", F.pmod(F.xxhash64("key", "text_crc32", F.monotonically_increasing_id()), F.lit(buckets)).cast("int")
        ),
        "shards",
    )
    counts = rows.groupBy("shard", "bucket").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("shard", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    numbered = rows.withColumn(
        "place", F.row_number().over(Window.partitionBy("shard", "bucket").orderBy("id", "text_crc32", "size"))
    )
    return numbered.join(starts, ["shard", "bucket"]).select(
        F.col("id").alias(id_col),
        "size",
        "text_crc32",
        F.lit("key").alias("law"),
        "shard",
        (F.col("start") + F.col("place") - 1).cast("long").alias("slot"),
        "grown_shard",
    )
