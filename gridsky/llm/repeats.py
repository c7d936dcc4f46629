"""Suffix-array dedup: maximal repeats from the common-prefix interval tree, bucket by bucket.

Every byte covered by a string of ``length`` bytes that also starts anywhere else
is found, in all texts together, matches within one text included.

1. Anchors. Over the hashes of all ``gram``-byte strings, the leftmost least in
   each window of ``length - gram + 1`` is an anchor. Each start of a long string
   belongs to exactly one anchor, and two equal strings have equal anchors at the same
   offset, so all occurrences of a long repeat meet under one anchor hash. An
   anchor owns a run of starts; its context is the bytes that these span.
2. Anchor hashes that occur once are dropped. Equal contexts are combined (a
   count with a map side): a context that occurs twice is a repeat as it stands, however many
   copies it has.
3. Different contexts under one hash form a bucket. Its suffixes from the anchor
   on are sorted: a sparse suffix array. A stack scan over its LCP values lists
   the intervals of the common-prefix tree; in each, the left extensions are
   sorted and scanned alike. Where they differ (left diversity) a maximal repeat
   ends, with all its occurrences.
4. Buckets of more than ``bucket_cap`` different contexts are settled without a
   bucket: the digest of every string that a context owns is counted, which
   gives the same answer and spreads over all tasks.

Nothing but the anchors' hashes and positions, and the contexts that share a
hash with a different one, is shuffled, besides the texts themselves.

Cases: a null text is empty; texts shorter than ``length`` are kept whole; a
very long text is scanned in blocks; repeated rows are texts of their own, so
each removes the other's bytes; null ids are kept as null; an empty table gives
an empty result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridsky.llm.common import (
    KEY,
    as_text,
    base_powers,
    cast_back,
    keyed_texts,
    mix64,
    running_hash,
    small_batches,
    staged,
    utf8,
)

LENGTH = 400
GRAM = 100
#: Different contexts in one bucket; larger buckets are settled by counting.
BUCKET_CAP = 1000
#: Starts scanned at a time, which bounds the memory that a long text takes.
BLOCK = 1 << 19

def gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    """Hash of every ``gram``-byte string, by differences of a running polynomial."""
    total = running_hash(data)
    _, down = base_powers(len(data) - gram + 1)
    return mix64((total[gram:] - total[:-gram]) * down)


def anchors(hashes: np.ndarray, window: int) -> Iterator[tuple[int, int, int]]:
    """(anchor, first window, last window) for the leftmost least hash of each window."""
    windows = len(hashes) - window + 1
    if windows <= 0:
        return
    at = 0
    place = int(hashes[:window].argmin())
    while True:
        # The least stays until a smaller one enters or it leaves on the left.
        entering = hashes[at + window : place + window] < hashes[place]
        step = int(entering.argmax()) if len(entering) else 0
        if len(entering) and entering[step]:
            following = at + 1 + step
            found = following + window - 1
        else:
            following = place + 1
            found = following + int(hashes[following : following + window].argmin()) if following < windows else 0
        yield place, at, min(following, windows) - 1
        if following >= windows:
            return
        at, place = following, found


def text_anchors(raw: bytes, length: int = LENGTH, gram: int = GRAM) -> Iterator[tuple[int, bytes, int, int, int]]:
    """(hash, context digest, start of the context, bytes left, bytes right of the anchor)."""
    for begin in range(0, len(raw) - length + 1, BLOCK):
        block = raw[begin : begin + BLOCK + length - 1]
        hashes = gram_hashes(np.frombuffer(block, dtype=np.uint8), gram)
        signed = hashes.view(np.int64)
        for place, first, last in anchors(hashes, length - gram + 1):
            left, right = place - first, last + length - place
            digest = hashlib.blake2b(block[first : last + length], digest_size=14)
            digest.update(left.to_bytes(4, "little"))
            yield int(signed[place]), digest.digest(), begin + first, left, right


def common(a: bytes, b: bytes) -> int:
    """Length of the common prefix."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    low, high = 0, n  # equal up to low, different within high
    while high - low > 1:
        mid = (low + high) // 2
        if a[low:mid] == b[low:mid]:
            low = mid
        else:
            high = mid
    return low


def intervals(lcp: Sequence[int]) -> Iterator[tuple[int, int, int]]:
    """LCP intervals (value, from, to) of a sorted list, children before parents.

    lcp[i] belongs to the neighbours i - 1 and i; lcp[0] is not used.
    """
    stack: list[tuple[int, int]] = []
    for i in range(1, len(lcp) + 1):
        value = lcp[i] if i < len(lcp) else -1
        begin = i - 1
        while stack and stack[-1][0] > value:
            high, begin = stack.pop()
            yield high, begin, i - 1
        if value >= 0 and (not stack or stack[-1][0] < value):
            stack.append((value, begin))


def bucket_repeats(
    contexts: Sequence[tuple[bytes, int]], length: int = LENGTH
) -> Iterator[tuple[int, int, list[int]]]:
    """Maximal repeats among different contexts of one anchor: (left, right, members).

    ``contexts`` are (bytes, bytes left of the anchor). A repeat reaches ``left``
    bytes before and ``right`` bytes from the anchor on; left + right >= length.
    """
    rights = [c[at:] for c, at in contexts]
    lefts = [c[:at][::-1] for c, at in contexts]
    order = sorted(range(len(contexts)), key=rights.__getitem__)
    rank = {m: i for i, m in enumerate(sorted(range(len(contexts)), key=lefts.__getitem__))}
    lcp = [0] + [common(rights[a], rights[b]) for a, b in zip(order, order[1:])]
    longest = max(map(len, lefts))
    for right, begin, end in intervals(lcp):
        if right + longest < length:
            continue
        members = sorted(order[begin : end + 1], key=rank.__getitem__)
        lce = [0] + [common(lefts[a], lefts[b]) for a, b in zip(members, members[1:])]
        place = None
        for left, low, high in intervals(lce):
            if left + right < length:
                continue
            group = members[low : high + 1]
            if place is None:
                place = {m: i for i, m in enumerate(order[begin : end + 1], begin)}
            # Not maximal to the right if all lie within one child of the interval.
            spots = [place[m] for m in group]
            if min(lcp[min(spots) + 1 : max(spots) + 1]) == right:
                yield left, right, group


def bucket_cover(contexts: Sequence[tuple[bytes, int]], length: int = LENGTH) -> dict[int, tuple[int, int]]:
    """For each member that shares a long string: bytes covered left of, and from, the anchor on."""
    cover: dict[int, tuple[int, int]] = {}
    for left, right, group in bucket_repeats(contexts, length):
        for m in group:
            was = cover.get(m, (0, 0))
            cover[m] = (max(was[0], left), max(was[1], right))
    return cover


def remove_spans(raw: bytes, spans: Sequence[tuple[int, int]]) -> tuple[int, int, bytes]:
    """Bytes removed, maximal runs removed, and what is left."""
    kept, removed, runs, at = [], 0, 0, 0
    end = -1
    for begin, stop in sorted(spans):
        if begin > end:
            runs += 1
            kept.append(raw[at:begin])
            removed += stop - begin
            end = at = stop
        elif stop > end:
            removed += stop - end
            end = at = stop
    kept.append(raw[at:])
    return removed, runs, b"".join(kept)


ANCHORS = "k1 long, k2 long, h long, c binary, first int, left int, right int"
def _anchored(texts: DataFrame, length: int, gram: int) -> DataFrame:
    def scan(batches):
        for batch in batches:
            columns = [[] for _ in range(7)]
            for k1, k2, text in zip(batch["k1"], batch["k2"], batch["text"]):
                for row in text_anchors(utf8(text), length, gram):
                    for column, value in zip(columns, (k1, k2, *row)):
                        column.append(value)
            yield pd.DataFrame(dict(zip(("k1", "k2", "h", "c", "first", "left", "right"), columns)))

    found = texts.where(F.octet_length("text") >= length).select(*KEY, "text")
    return found.mapInPandas(scan, ANCHORS)


def _contexts(texts: DataFrame, wanted: DataFrame) -> DataFrame:
    """Fetch the bytes of the contexts: h, c, d, left, context."""
    lists = wanted.groupBy("k1", "k2").agg(
        F.collect_list(F.struct("h", "c", "d", "first", "left", "right")).alias("list")
    )
    joined = texts.select(*KEY, "text").join(lists, KEY)

    def cut(batches):
        for batch in batches:
            rows = []
            for text, wanted in zip(batch["text"], batch["list"]):
                raw = utf8(text)
                for w in wanted:
                    begin = w["first"]
                    rows.append((w["h"], w["c"], w["d"], w["left"], raw[begin : begin + w["left"] + w["right"]]))
            yield pd.DataFrame(rows, columns=["h", "c", "d", "left", "context"])

    # A text that is there twice gives its contexts twice; the reader of a bucket skips those.
    return joined.mapInPandas(cut, "h long, c binary, d long, left int, context binary")


def _buckets(batches) -> Iterator[tuple[int, list[tuple[bytes, int, bytes]]]]:
    """Runs of one hash in sorted rows, across batches: (h, [(c, left, context)])."""
    h, rows, seen = None, [], set()
    for batch in batches:
        for row in batch.itertuples(index=False):
            if row.h != h:
                if rows:
                    yield h, rows
                h, rows, seen = row.h, [], set()
            if row.c not in seen:
                seen.add(row.c)
                rows.append((row.c, row.left, row.context))
    if rows:
        yield h, rows


class Repeats:
    """The staged steps of one run, from which spans and groups are read."""

    def __init__(self, texts: DataFrame, length: int, gram: int, bucket_cap: int):
        small_batches(texts.sparkSession)
        self.length, self.bucket_cap = length, bucket_cap
        every = staged(_anchored(texts, length, gram), "repeat-anchors")
        twice = every.groupBy("h").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("h")
        # Written, so that both sides of the joins by hash are plain exchanges, which can be split where a hash is hot.
        twice = staged(twice, "repeat-hashes")
        #: Anchors whose hash occurs again.
        self.anchors = staged(every.join(twice, "h"), "repeat-candidates")
        #: Different contexts, with how often each occurs.
        self.classes = staged(
            self.anchors.groupBy("h", "c").agg(
                F.count(F.lit(1)).alias("n"), F.min(F.struct("k1", "k2", "first", "left", "right")).alias("one")
            ),
            "repeat-classes",
        )
        sizes = staged(self.classes.groupBy("h").agg(F.count(F.lit(1)).alias("d")).where("d > 1"), "repeat-sizes")
        wanted = self.classes.join(sizes, "h").select("h", "c", "d", "one.*")
        self.contexts = staged(_contexts(texts, wanted), "repeat-contexts")

    def groups(self) -> DataFrame:
        """Members of maximal repeats: h, group, c, lo, hi (bytes left of, and from, the anchor on)."""
        length = self.length

        def scan(batches):
            for h, rows in _buckets(batches):
                found = bucket_repeats([(context, left) for _, left, context in rows], length)
                made = [
                    (h, f"{h & (1 << 64) - 1:016x}.{g}", rows[m][0], left, right)
                    for g, (left, right, group) in enumerate(found)
                    for m in group
                ]
                yield pd.DataFrame(made, columns=["h", "group", "c", "lo", "hi"])

        copies = self.classes.where("n > 1").select(
            "h",
            F.concat(F.lower(F.lpad(F.hex("h"), 16, "0")), F.lit("."), F.lower(F.hex("c"))).alias("group"),
            "c",
            F.col("one.left").alias("lo"),
            F.col("one.right").alias("hi"),
        )
        schema = "h long, group string, c binary, lo int, hi int"
        found = self._small().mapInPandas(scan, schema).unionByName(copies)
        large = self._large()
        if large is not None:
            found = found.unionByName(large.withColumn("group", F.lower(F.hex("digest"))).drop("digest"))
        return found

    def cover(self) -> DataFrame:
        """What is covered around the anchor of a context: h, c, lo, hi; several rows where needed."""
        length = self.length

        def scan(batches):
            made = []
            for h, rows in _buckets(batches):
                found = bucket_cover([(context, left) for _, left, context in rows], length)
                made += [(h, rows[m][0], lo, hi) for m, (lo, hi) in found.items()]
                if len(made) > 5000:
                    yield pd.DataFrame(made, columns=["h", "c", "lo", "hi"])
                    made = []
            yield pd.DataFrame(made, columns=["h", "c", "lo", "hi"])

        copies = self.classes.where("n > 1").select(
            "h", "c", F.col("one.left").alias("lo"), F.col("one.right").alias("hi")
        )
        found = self._small().mapInPandas(scan, "h long, c binary, lo int, hi int").unionByName(copies)
        large = self._large()
        return found if large is None else found.unionByName(large.drop("digest"))

    def _small(self) -> DataFrame:
        rows = self.contexts.where(F.col("d") <= self.bucket_cap).select("h", "c", "left", "context")
        return rows.repartition("h").sortWithinPartitions("h", "c")

    def _large(self) -> DataFrame | None:
        """Large buckets, by the digest of each string that their contexts own."""
        rows = self.contexts.where(F.col("d") > self.bucket_cap)
        if rows.isEmpty():
            return None
        length = self.length

        def starts(batches):
            for batch in batches:
                made = [
                    (hashlib.blake2b(context[s : s + length], digest_size=16).digest(), h, c, left - s, s + length - left)
                    for h, c, left, context in zip(batch["h"], batch["c"], batch["left"], batch["context"])
                    for s in range(len(context) - length + 1)
                ]
                yield pd.DataFrame(made, columns=["digest", "h", "c", "lo", "hi"])

        digests = staged(
            rows.select("h", "c", "left", "context").mapInPandas(
                starts, "digest binary, h long, c binary, lo int, hi int"
            ),
            "repeat-starts",
        )
        twice = digests.groupBy("digest").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("digest")
        return digests.join(staged(twice, "repeat-digests"), "digest")


def dedup_substrings(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    length: int = LENGTH,
    gram: int = GRAM,
    bucket_cap: int = BUCKET_CAP,
    with_kept: bool = True,
) -> DataFrame:
    """``id_col``, n_bytes, n_removed, n_spans, kept_sha256 and (``with_kept``) the bytes kept, for every row."""
    texts = keyed_texts(docs, id_col, text_col)
    run = Repeats(texts, length, gram, bucket_cap)
    # A span as one number: it is shorter than twice the length.
    scale = 2 * length
    spans = (
        run.anchors.join(run.cover(), ["h", "c"])
        .select(*KEY, (F.col("first") + F.col("left") - F.col("lo")).cast("long").alias("begin"), (F.col("lo") + F.col("hi")).alias("size"))
        .groupBy(*KEY)
        .agg(F.collect_set(F.col("begin") * scale + F.col("size")).alias("spans"))
    )
    joined = texts.join(spans, KEY, "left").select(*as_text("id"), "text", "spans")

    def cut(batches):
        for batch in batches:
            made = []
            for i, text, found in zip(batch["id"], batch["text"], batch["spans"]):
                raw = utf8(text)
                pairs = [] if found is None else [(int(s) // scale, int(s) // scale + int(s) % scale) for s in found]
                removed, runs, kept = remove_spans(raw, pairs)
                made.append((i, len(raw), removed, runs, hashlib.sha256(kept).hexdigest(), kept)[: len(names)])
            yield pd.DataFrame(made, columns=names)

    kind = dict(texts.dtypes)["id"]
    schema = f"`{id_col}` string, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    names = [id_col, "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"][: 5 + with_kept]
    return cast_back(joined.mapInPandas(cut, schema + ", kept binary" * with_kept), **{id_col: kind})


def maximal_repeats(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    length: int = LENGTH,
    gram: int = GRAM,
    bucket_cap: int = BUCKET_CAP,
) -> DataFrame:
    """Every occurrence of every maximal repeat: group, size, ``id_col``, start.

    Repeats are told around one anchor; one that reaches beyond a context comes in
    overlapping pieces, a group for each anchor.
    """
    texts = keyed_texts(docs, id_col, text_col)
    run = Repeats(texts, length, gram, bucket_cap)
    found = run.anchors.join(run.groups(), ["h", "c"]).select(
        "group",
        (F.col("lo") + F.col("hi")).alias("size"),
        *KEY,
        (F.col("first") + F.col("left") - F.col("lo")).alias("start"),
    )
    ids = texts.select("id", *KEY).distinct()
    return found.join(ids, KEY).select("group", "size", F.col("id").alias(id_col), "start").distinct()
