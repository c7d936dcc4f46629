"""Conversation structure repair by cost DP and prefix-doubling path ranking.

A conversation is in order when its roles' initials read ``(s?(ua)+)?``: a system row or none, then
pairs of user and assistant; or no row at all. Rows are edited: Keep costs 0, Rerole (to user or
assistant) 1, Delete 2, Insert (an empty user or assistant row, anywhere) 5; a row that
is cut off adds 5 unless deleted; blank rows and repeated ones must go. Of the cheapest edits those whose
initials come first in ASCII order are taken.

A node is a place between rows with one of four states: nothing yet, after s, after u, after a. State and
edit decide the next node, so the edits of a path are its name. A DP from the end gives
the cost to go of each node; the arcs that keep it are the optimal ones. They are ranked by the first
1, 2, 4, ... edits of the least path that begins with them: the rank for twice the length joins the
rank of an arc with that of the node where its path is after that length, found by a
pointer that doubles as well. Ranks choose each node's arc, and the doubled pointers
lay out the least path from any node without walking it.

A conversation of any length is dealt over tasks. Rows with equal turn, role and text become one
with a count; rows are sorted by range over the cluster and cut into pieces of ``PIECE`` rows. A piece
acts on the cost to go as a 4 x 4 matrix of least costs; a scan over the matrices from the end gives
each piece the cost to go behind it, after which all pieces are ranked independently, from each of the four
states. A last pass in order of rows takes the path that follows from the piece before,
and reads texts in a stream: a conversation's digest needs its rows in order, but never all at once.

Cases: a null id is a conversation of its own; null roles and texts are one space; null turns come
first; equal turns go by role, then text digest; repeated rows count as duplicates; an empty
role fits nowhere and is reroled or deleted; texts may have any length; an empty table gives an empty
result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridsky.llm.common import as_text, cast_back, small_batches, staged

#: Rows in a piece, and places between rows whose paths are ranked together.
PIECE = 4096
TOGETHER = 8192
#: Fixed by the contract: cost of each edit, and of a row that is cut off and stays.
KEEP, REROLE, DELETE, INSERT, CUT_OFF = 0, 1, 2, 5, 5
#: Fixed by the contract: pairs of initials that may follow each other.
LEGAL = {"su", "ua", "au"}
WHITE = " \t\n\x0b\x0c\r"
FAR = 1 << 60
LARGEST = (1 << 63) - 1

# States: nothing yet, after s, after u, after a. The state after each initial, if it is allowed there.
AFTER = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
#: The state after a row that is given the role wanted there.
WANTED = (2, 2, 3, 2)
ROLES = {2: "user", 3: "assistant"}
#: Cost to go where the rows end; inserts may still follow.
END = (0, 2 * INSERT, INSERT, 0)
CODES = {"D": 1, "I": 2, "K": 3, "R": 4}
LETTERS = b"\0DIKR"


def damaged(rows: DataFrame) -> DataFrame:
    """Rows of (conv_id, turn, role, text) with faults set by crc32 of "conv_id:turn", modulo 20:
    0 drops the row, 1 empties its text, 2 takes out ``.!?``, 3 repeats it, 4 makes it a user's."""
    space = F.lit(" ")
    conversation, turn = (F.coalesce(F.col(c).cast("string"), space) for c in ("conv_id", "turn"))
    key = F.concat(conversation, F.lit(":"), turn)
    fault = F.crc32(key.cast("binary")) % 20
    role, text = (F.coalesce(F.col(c).cast("string"), space) for c in ("role", "text"))
    return rows.where(fault != 0).select(
        "conv_id",
        "turn",
        F.when(fault == 4, "user").otherwise(role).alias("role"),
        F.when(fault == 1, "").when(fault == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        F.explode(F.sequence(F.lit(1), F.when(fault == 3, 2).otherwise(1))).alias("copy"),
    ).drop("copy")


def _digest(text: Column) -> Column:
    return F.unhex(F.sha2(text.cast("binary"), 256))


#: Order of rows within a conversation.
ORDER = ["turn", "role", "digest"]


def _named(rows: DataFrame) -> DataFrame:
    space = F.lit(" ")
    text = F.coalesce(F.col("text").cast("string"), space)
    return rows.select(
        "conv_id", "turn", F.coalesce(F.col("role").cast("string"), space).alias("role"), text.alias("text"), _digest(text).alias("digest")
    )


def faults(rows: DataFrame) -> DataFrame:
    """One row for each (conv_id, turn, role, digest of the text): how often it occurs (n), whether it
    is blank or cut off, and whether its first occurrence is the first of its role and text."""
    body = F.rtrim(F.col("text"), F.lit(WHITE))
    met = (
        _named(rows)
        .groupBy("conv_id", *ORDER)
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.max(body == "").alias("blank"),
            F.max(~F.substring(body, -1, 1).isin(".", "!", "?")).alias("cut_off"),
        )
    )
    met = staged(met, "conversation-rows")
    # The first turn with a text is marked through a key that no two rows share, so a text that
    # fills a conversation does not gather in a join.
    turn = F.struct(F.col("turn").isNotNull().alias("known"), "turn")
    firsts = met.groupBy("conv_id", "role", "digest").agg(F.min(turn).alias("t"))
    firsts = firsts.select("conv_id", F.col("t.turn").alias("turn"), "role", "digest", F.lit(True).alias("first"))
    both = met.withColumn("first", F.lit(False)).unionByName(firsts, allowMissingColumns=True)
    return both.groupBy("conv_id", *ORDER).agg(
        F.sum("n").alias("n"), F.max("blank").alias("blank"), F.max("cut_off").alias("cut_off"), F.max("first").alias("first")
    )


def _initial(role: Column) -> Column:
    first = F.substring(role, 1, 1)
    return F.when(first.isin("s", "u", "a"), first).otherwise("x")


def _must_go() -> Column:
    return F.col("blank") | ~F.col("first")


def _summary(met: DataFrame) -> DataFrame:
    """gaps, blank, duplicate, truncated of each conversation."""
    n, one = F.col("n"), F.when(F.col("first"), 1).otherwise(0)
    by_turn = met.groupBy("conv_id", "turn").agg(
        F.sum(F.when(F.col("blank"), n).otherwise(0)).alias("blank"),
        F.sum(F.when(F.col("blank"), 0).otherwise(n - one)).alias("duplicate"),
        F.sum(F.when(F.col("cut_off") & ~_must_go(), 1).otherwise(0)).alias("truncated"),
    )
    highest, lowest = (f("turn").cast("decimal(20,0)") for f in (F.max, F.min))
    gaps = F.coalesce(highest - lowest + 1 - F.count("turn"), F.lit(0))
    return by_turn.groupBy("conv_id").agg(
        F.least(gaps, F.lit(LARGEST)).cast("long").alias("gaps"), *[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated")]
    )


class Rows:
    """What a row does to the cost to go, remembered by row kind and cost pattern.

    A kind is an initial (s, u, a or x) and what its fault demands: ``-`` it must go, ``~`` it is cut off, ``+`` neither.
    """

    def __init__(self):
        self.known: dict[tuple, tuple] = {}

    def step(self, behind: tuple, kind: str) -> tuple[int, tuple, tuple]:
        """Least cost to go; the cost to go of each state above that; each state's optimal arcs as
        (letter code, rows read, state)."""
        got = self.known.get((behind, kind))
        if got is None:
            got = self.known[behind, kind] = self._step(behind, kind)
        return got

    def _step(self, behind: tuple, kind: str) -> tuple[int, tuple, tuple]:
        initial, fault = kind
        arcs = []
        for state in range(4):
            own = [(DELETE + behind[state], CODES["D"], 1, state)]
            if fault != "-":
                extra = CUT_OFF if fault == "~" else 0
                own.append((REROLE + extra + behind[WANTED[state]], CODES["R"], 1, WANTED[state]))
                if initial in AFTER[state]:
                    own.append((KEEP + extra + behind[AFTER[state][initial]], CODES["K"], 1, AFTER[state][initial]))
            arcs.append(own)
        return _closed(arcs)

    def end(self) -> tuple[tuple, tuple]:
        """Cost to go and arcs where the rows end."""
        _, costs, arcs = _closed([[(0, 0, 0, 0)], [], [], [(0, 0, 0, 3)]])
        return costs, arcs


def _closed(arcs: list[list[tuple]]) -> tuple[int, tuple, tuple]:
    """Add inserts to the arcs of a place, keep the optimal ones, and subtract the least cost."""
    costs = [min((a[0] for a in own), default=FAR) for own in arcs]
    for _ in range(3):
        costs = [min(c, INSERT + costs[WANTED[s]]) for s, c in enumerate(costs)]
    least = min(costs)
    best = []
    for state, own in enumerate(arcs):
        inserted = (INSERT + costs[WANTED[state]], CODES["I"], 0, WANTED[state])
        best.append(tuple(a[1:] for a in (*own, inserted) if a[0] == costs[state]))
    return least, tuple(FAR if c >= FAR // 2 else c - least for c in costs), tuple(best)


#: Shared by all pieces of a process: kinds and cost patterns are few.
ROWS = Rows()


def cost_matrix(kinds: list[str], counts: list[int]) -> list[list[int]]:
    """Least cost through the rows from each state to each state behind them."""
    columns = []
    more = DELETE * (sum(counts) - len(counts))
    for end in range(4):
        costs, total = tuple(0 if s == end else FAR for s in range(4)), more
        for kind in reversed(kinds):
            least, costs, _ = ROWS.step(costs, kind)
            total += least
        columns.append([FAR if c >= FAR // 2 else c + total for c in costs])
    return [list(r) for r in zip(*columns)]


def optimal_arcs(kinds: list[str], behind: list[int] | None) -> list[tuple]:
    """The optimal arcs of each place between rows, by state, as (letter code, rows read, state); those
    with letter 0 end a path. ``behind`` is the cost to go of each state behind the rows, None where they end."""
    if behind is None:
        costs, last = ROWS.end()
    else:
        costs = tuple(c - min(behind) for c in behind)
        last = tuple(((0, 0, s),) for s in range(4))
    places = [last]
    for kind in reversed(kinds):
        _, costs, arcs = ROWS.step(costs, kind)
        places.append(arcs)
    return places[::-1]


def least_paths(many: list[tuple[list[str], list[int] | None]]) -> list[list[tuple[bytes, int]]]:
    """For each (kinds, behind) and each state before the rows: the letters of the least of the
    cheapest paths, and the state it ends in."""
    made: list = [None] * len(many)
    order = sorted(range(len(many)), key=lambda k: len(many[k][0]))
    while order:
        # Paths of like length are ranked together.
        group = [order.pop()]
        while order and (len(group) + 1) * (len(many[group[0]][0]) + 1) <= TOGETHER:
            group.append(order.pop())
        source, letter, target, starts, nodes = [], [], [], [], 0
        for k in group:
            starts.append(nodes)
            # Node 4 i + s is state s before row i.
            for arcs in optimal_arcs(*many[k]):
                for state, own in enumerate(arcs):
                    for code, read, to in own:
                        source.append(nodes + state)
                        letter.append(code)
                        target.append(nodes + 4 * read + to)
                nodes += 4
        choice, pointers = rank_paths(np.array(source), np.array(letter), np.array(target), nodes)
        path = (np.array(starts)[:, None] + np.arange(4)).reshape(-1, 1)
        for pointer in pointers:
            # Doubled pointers lay out the path: from its first n nodes, the next n.
            path = np.concatenate([path, pointer[path]], axis=1)
        letters = np.frombuffer(LETTERS, dtype=np.uint8)[choice[path]]
        ends = pointers[-1][path[:, -1]] % 4
        for i, k in enumerate(group):
            rows = range(4 * i, 4 * i + 4)
            made[k] = [(letters[r].tobytes().rstrip(b"\0"), int(ends[r])) for r in rows]
    return made


def rank_paths(source: np.ndarray, letter: np.ndarray, target: np.ndarray, nodes: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """The letter of the arc that each node takes, and each node's place after 1, 2, 4, ... edits.

    Arcs are ranked by the first 1, 2, 4, ... letters of the least path that begins with them,
    until no path is longer; a path that has ended stays where it is and counts as letter 0.
    """
    rank, jump, pointers = letter.astype(np.int64), target, []
    while True:
        order = np.lexsort((rank, source))
        first = order[np.searchsorted(source[order], np.arange(nodes))]
        node_rank, node_jump = rank[first], jump[first]
        pointers.append(node_jump)
        if (node_jump[node_jump] == node_jump).all():
            return letter[first], pointers
        joined = rank * (node_rank.max() + 1) + node_rank[jump]
        _, rank = np.unique(joined, return_inverse=True)
        jump = node_jump[jump]


def pieces(met: DataFrame, size: int = PIECE) -> DataFrame:
    """Rows in order, cut into pieces: the place of its first row, kinds, counts, cost matrix, and
    the pairs of neighbours within it that are no legal ones."""
    kind = F.concat(_initial(F.col("role")), F.when(_must_go(), "-").when(F.col("cut_off"), "~").otherwise("+"))
    rows = staged(met.select("conv_id", *ORDER, "n", kind.alias("kind")), "conversation-kinds")
    kinds = dict(rows.dtypes)
    rows = rows.repartitionByRange("conv_id", *ORDER).sortWithinPartitions("conv_id", *ORDER)

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now: list = []

        def piece() -> tuple:
            names, counts = [r[4] for r in now], [int(r[5]) for r in now]
            pairs = sum(a[0] + b[0] not in LEGAL for a, b in zip(names, names[1:]))
            illegal = pairs + sum(counts) - len(counts)
            matrix = [x for r in cost_matrix(names, counts) for x in r]
            return (*now[0][:4], "".join(names), counts, matrix, illegal)

        columns = ["conv_id", *ORDER, "kinds", "counts", "matrix", "illegal"]
        for batch in batches:
            made = []
            for row in zip(*[batch[c] for c in ("conv_id", *ORDER, "kind", "n")]):
                if now and (len(now) == size or row[0] != now[0][0]):
                    made.append(piece())
                    now.clear()
                now.append(row)
            if made:
                yield pd.DataFrame(made, columns=columns)
        if now:
            yield pd.DataFrame([piece()], columns=columns)

    schema = "conv_id string, turn string, role string, digest binary, kinds string, counts array<long>, matrix array<long>, illegal long"
    made = rows.select(*as_text("conv_id", "turn"), "role", "digest", "kind", "n").mapInPandas(cut, schema)
    made = cast_back(made, conv_id=kinds["conv_id"], turn=kinds["turn"])
    return staged(made.withColumn("piece", F.monotonically_increasing_id()), "conversation-pieces")


def paths(cut: DataFrame) -> DataFrame:
    """Each piece with its least paths: letters and end for each state before it, and the cost from the
    first state to the end of the conversation."""

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        begun, conversation, behind = False, None, None
        for batch in batches:
            made = []
            for piece, conv, matrix in zip(batch["piece"], batch["conv_id"], batch["matrix"]):
                if not begun or conv != conversation:
                    begun, conversation, behind = True, conv, None
                after = END if behind is None else behind
                before = [min(int(m) + a for m, a in zip(matrix[4 * s : 4 * s + 4], after)) for s in range(4)]
                before = [min(c, INSERT + before[WANTED[s]]) for s, c in enumerate(before)]
                made.append((piece, behind, before[0]))
                behind = before
            yield pd.DataFrame(made, columns=["piece", "behind", "cost"])

    backwards = [F.desc_nulls_last("turn"), F.desc("role"), F.desc("digest")]
    ordered = cut.select("conv_id", *ORDER, "piece", "matrix").repartition("conv_id").sortWithinPartitions("conv_id", *backwards)
    scanned = ordered.select("piece", *as_text("conv_id"), "matrix").mapInPandas(scan, "piece long, behind array<long>, cost long")

    @F.pandas_udf("letters array<string>, ends array<int>")
    def ranked(kinds: pd.Series, behind: pd.Series) -> pd.DataFrame:
        many = [
            ([names[k : k + 2] for k in range(0, len(names), 2)], None if costs is None else [int(c) for c in costs])
            for names, costs in zip(kinds, behind)
        ]
        made = [([x.decode() for x, _ in found], [e for _, e in found]) for found in least_paths(many)]
        return pd.DataFrame(made, columns=["letters", "ends"])

    return cut.join(scanned, "piece").select(
        "conv_id", *ORDER, "kinds", "counts", "illegal", "cost", ranked("kinds", "behind").alias("p")
    )


class Replay:
    """Walks through a conversation's pieces and rows in order and tells its edits."""

    def __init__(self):
        self.state, self.audit, self.letters, self.at = 0, [], "", 0
        self.cost = self.illegal = 0
        self.last = None

    def piece(self, kinds: str, counts, illegal: int, cost: int, letters, ends) -> None:
        if self.last is None:
            self.cost = int(cost)
        elif self.last + kinds[0] not in LEGAL:
            self.illegal += 1
        self.illegal += int(illegal)
        self.last = kinds[-2]
        # The state at the piece's first row, by which its own rows are replayed.
        self.now, self.letters, self.at = self.state, letters[self.state], 0
        self.state = int(ends[self.state])
        copies = iter(counts)
        for letter in self.letters:
            self.audit.append(letter)
            if letter != "I":
                self.audit.append("D" * (int(next(copies)) - 1))

    def inserts(self) -> Iterator[tuple[str, str, str]]:
        """Rows inserted before the next row of the piece, or behind its last one."""
        while self.at < len(self.letters) and self.letters[self.at] == "I":
            self.at += 1
            self.now = WANTED[self.now]
            yield "I", ROLES[self.now], ""

    def row(self, role: str, text: str) -> Iterator[tuple[str, str, str]]:
        """(edit, role, text) of the rows that the next row becomes, with those inserted before it."""
        yield from self.inserts()
        letter = self.letters[self.at]
        self.at += 1
        if letter == "R":
            self.now = WANTED[self.now]
            yield letter, ROLES[self.now], text
        elif letter == "K":
            self.now = AFTER[self.now][role[0]]
            yield letter, role, text


def _replayed(rows: DataFrame, ids: DataFrame, size: int) -> DataFrame:
    """Heads (slot 0), then pieces and texts of every conversation, in order and in one task."""
    met = staged(faults(rows), "conversation-faults")
    head = ids.select("conv_id").distinct().join(
        _summary(met).withColumnRenamed("conv_id", "of"), F.col("conv_id").eqNullSafe(F.col("of")), "left"
    )
    head = head.drop("of").withColumn("slot", F.lit(0))
    planned = paths(pieces(met, size)).select("*", F.lit(1).alias("slot"), F.lit(0).alias("is_row"))
    texts = _named(rows).select("*", F.lit(1).alias("slot"), F.lit(1).alias("is_row"))
    both = head.unionByName(planned, allowMissingColumns=True).unionByName(texts, allowMissingColumns=True)
    ordered = both.repartition("conv_id").sortWithinPartitions("conv_id", "slot", *ORDER, "is_row")
    return ordered.select(
        *as_text("conv_id", "turn"),
        *["slot", "role", "digest", "text", "kinds", "counts", "p.letters", "p.ends"],
        # Whole numbers beside nulls would become floats on the way through pandas.
        *[F.coalesce(F.col(c), F.lit(0)).alias(c) for c in ("is_row", "illegal", "cost", *COUNTS)],
    )


COUNTS = ["gaps", "blank", "duplicate", "truncated"]


def _conversations(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[str, tuple, Replay, tuple | None]]:
    """("head" | "row" | "end", counts, replay, edited row): a conversation begins, has a row, ends."""
    replay, head, seen = None, None, None
    for batch in batches:
        for r in batch.itertuples(index=False):
            if r.slot == 0:
                if replay is not None:
                    for made in replay.inserts():
                        yield "row", head, replay, (None, *made)
                    yield "end", head, replay, None
                replay, head, seen = Replay(), (r.conv_id, *[int(getattr(r, c)) for c in COUNTS]), None
                yield "head", head, replay, None
            elif r.is_row == 0:
                for made in replay.inserts():
                    yield "row", head, replay, (None, *made)
                replay.piece(r.kinds, r.counts, r.illegal, r.cost, r.letters, r.ends)
            elif (r.turn, r.role, r.digest) != seen:
                # Copies of a row follow it and are deleted.
                seen = (r.turn, r.role, r.digest)
                for made in replay.row(r.role, r.text):
                    yield "row", head, replay, ((r.turn if made[0] != "I" else None), *made)
    if replay is not None:
        for made in replay.inserts():
            yield "row", head, replay, (None, *made)
        yield "end", head, replay, None


#: Rows that a mapper gathers before it hands them on.
OUT = 1000


def repair_report(rows: DataFrame, ids: DataFrame | None = None, size: int = PIECE) -> DataFrame:
    """One row for each conv_id of ``ids`` (default: of ``rows``): gaps, blank, duplicate, truncated, illegal,
    cost, audit (the edits' initials) and repaired_sha256 (of the repaired "role:text" lines)."""
    small_batches(rows.sparkSession)
    names = ["conv_id", *COUNTS, "illegal", "cost", "audit", "repaired_sha256"]

    def report(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        made, digest, joint = [], None, b""
        for what, head, replay, row in _conversations(batches):
            if what == "head":
                digest, joint = hashlib.sha256(), b""
            elif what == "row":
                digest.update(joint + f"{row[2]}:{row[3]}".encode("utf-8", "surrogatepass"))
                joint = b"\n"
            else:
                made.append((*head, replay.illegal, replay.cost, "".join(replay.audit), digest.hexdigest()))
                if len(made) >= OUT:
                    yield pd.DataFrame(made, columns=names)
                    made = []
        yield pd.DataFrame(made, columns=names)

    schema = "conv_id string, " + "".join(f"{c} long, " for c in (*COUNTS, "illegal", "cost")) + "audit string, repaired_sha256 string"
    kind = dict(rows.dtypes)["conv_id"]
    return cast_back(_replayed(rows, rows if ids is None else ids, size).mapInPandas(report, schema), conv_id=kind)


def repaired(rows: DataFrame, size: int = PIECE) -> DataFrame:
    """The repaired conversations: conv_id, place (from 0), turn (null if inserted), role, text and edit (K, R or I)."""
    small_batches(rows.sparkSession)
    names = ["conv_id", "place", "turn", "role", "text", "edit"]

    def tell(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        made, place = [], 0
        for what, head, _, row in _conversations(batches):
            if what == "head":
                place = 0
            elif what == "row":
                turn, edit, role, text = row
                made.append((head[0], place, turn, role, text, edit))
                place += 1
                if len(made) >= OUT:
                    yield pd.DataFrame(made, columns=names)
                    made = []
        yield pd.DataFrame(made, columns=names)

    kinds = dict(rows.dtypes)
    made = _replayed(rows, rows, size).mapInPandas(tell, "conv_id string, place long, turn string, role string, text string, edit string")
    return cast_back(made, conv_id=kinds["conv_id"], turn=kinds["turn"])
