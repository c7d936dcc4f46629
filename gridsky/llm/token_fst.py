"""Token counts by a compiled finite-state transducer.

The merges of a byte-fallback BPE vocabulary are compiled into a deterministic
transducer over characters. Every transition is annotated with the number of tokens that
it adds to the encoding of what was read so far (a character that completes a longer
token can take some back), so the sum along a path is the token count of the text.

A state holds every string that may still grow into a token, with the token that ends
before it. The last token of a text is the one piece that is a suffix of it and stands
next to the token before it without a merge across their border; whether two tokens
can stand side by side is found once, by replaying the merges of both against each other.
Two neighbouring characters that no piece holds side by side are a border that no merge
crosses: there the transducer is in the same state whatever came before.

Transitions are compiled when first met and kept, ``MAX_ARCS`` at most: beyond, they are dropped and
compiled again, which costs time and changes no count. A text is cut into chunks of ``CHUNK``
characters. The map of a chunk takes the state before it to the state after it and the
tokens added: the characters up to its first border depend on the state that comes in, all
after it does not. Maps compose associatively, and a prefix scan in doubling steps gives
the count at the end of every chunk.

Cases: null and empty texts have no bytes and no tokens; very long texts are cut into
chunks and counted whole; repeated rows are counted each; an empty table gives an empty
result; columns besides the id are not returned, whatever their names, and null ids stay.
Characters without a piece count as their UTF-8 bytes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridsky.llm.common import text_or_empty

#: Characters in a chunk.
CHUNK = 1 << 15
#: Transitions that a process keeps compiled, and pairs of tokens whose border it remembers.
MAX_ARCS = 600_000
#: Tokens beyond which a text is marked.
LIMIT = 4096
#: Fixed by the vocabulary's format: the mark that stands for a space.
SPACE = "▁"


class State(dict):
    """Transitions by character: (next state, tokens added). Missing ones are compiled."""

    __slots__ = ("machine", "last", "open")

    def __init__(self, machine: Transducer, last: str | None, open_: tuple):
        self.machine, self.last, self.open = machine, last, open_

    def __missing__(self, char: str) -> tuple[State, int]:
        return self.machine.compile(self, char)


class Transducer:
    """``scores`` maps each piece to its score; of the merges that a text allows, the
    highest score goes first, the leftmost of equals."""

    def __init__(self, scores: dict[str, float], max_arcs: int = MAX_ARCS):
        self.scores = scores
        self.max_arcs = max_arcs
        self.prefixes = {p[:k] for p in scores for k in range(1, len(p))}
        #: Characters that some piece holds side by side.
        self.joints = {p[k : k + 2] for p in scores for k in range(len(p) - 1)}
        self.start = State(self, None, (("", None, 0),))
        self._forget()

    def _forget(self) -> None:
        self.arcs = 0
        self.states: dict[tuple, State] = {}
        self.borders: dict[tuple[str, str], bool] = {}
        self.histories: dict[str, tuple | None] = {}
        self.start.clear()

    def history(self, piece: str) -> tuple | None:
        """The merges that make ``piece`` of its characters, as (score, first part, last part)
        after each; None if the merges end in more than one part."""
        if piece not in self.histories:
            parts, events = list(piece), []
            while len(parts) > 1:
                scored = [self.scores.get(a + b, -math.inf) for a, b in zip(parts, parts[1:])]
                best = max(scored)
                if best == -math.inf:
                    break
                k = scored.index(best)
                parts[k : k + 2] = [parts[k] + parts[k + 1]]
                events.append((best, parts[0], parts[-1]))
            self.histories[piece] = tuple(events) if len(parts) == 1 else None
        return self.histories[piece]

    def border(self, left: str | None, right: str) -> bool:
        """Whether the token ``right`` can follow ``left`` (None: a border that no merge crosses)."""
        known = self.borders.get((left, right))
        if known is None:
            if len(self.borders) >= self.max_arcs:
                self.borders.clear()
            known = self.borders[left, right] = self._border(left, right)
        return known

    def _border(self, left: str | None, right: str) -> bool:
        b = self.history(right)
        if b is None or left is None:
            return b is not None
        a = self.history(left)
        i = j = 0
        inner, outer = left[-1], right[0]
        while True:
            across = self.scores.get(inner + outer)
            on_left = a[i][0] if i < len(a) else -math.inf
            on_right = b[j][0] if j < len(b) else -math.inf
            if across is not None and across > on_left and across >= on_right:
                return False
            if i < len(a) and on_left >= on_right:
                inner = a[i][2]
                i += 1
            elif j < len(b):
                outer = b[j][1]
                j += 1
            else:
                return True

    def compile(self, state: State, char: str) -> tuple[State, int]:
        if self.arcs >= self.max_arcs:
            for old in self.states.values():
                old.clear()
            self._forget()
        if state.last is None:
            arc = self._fresh(char)
        elif state.last + char in self.joints:
            arc = self._longer(state, char)
        else:
            arc = self.start[char]
        self.arcs += 1
        state[char] = arc
        return arc

    def _fresh(self, char: str) -> tuple[State, int]:
        if char not in self.scores:
            return self.start, len(char.encode("utf-8", "surrogatepass"))
        grows = ((char, None, 1),) if char in self.prefixes else ()
        return self._state(char, (*grows, ("", char, 0))), 1

    def _longer(self, state: State, char: str) -> tuple[State, int]:
        token, added, grows = None, 0, []
        for string, before, back in state.open:
            longer = string + char
            if token is None and longer in self.scores and self.border(before, longer):
                token, added = longer, 1 - back
            if longer in self.prefixes:
                grows.append((longer, before, back))
        return self._state(char, (*[(s, t, back + added) for s, t, back in grows], ("", token, 0))), added

    def _state(self, last: str, open_: tuple) -> State:
        key = (last, open_)
        if key not in self.states:
            self.states[key] = State(self, last, open_)
        return self.states[key]

    def walk(self, state: State, text: str) -> tuple[State, int]:
        total = 0
        for char in text:
            state, added = state[char]
            total += added
        return state, total

    def chunk_map(self, chunk: str) -> ChunkMap:
        joints = self.joints
        for k in range(1, len(chunk)):
            if chunk[k - 1 : k + 1] not in joints:
                end, count = self.walk(self.start, chunk[k:])
                return ChunkMap(chunk[:k], count, end)
        return ChunkMap(chunk, 0, None)

    def compose(self, a: ChunkMap, b: ChunkMap) -> ChunkMap:
        """First ``a``, then ``b``."""
        if a.end is None:
            return ChunkMap(a.head + b.head, b.count, b.end)
        end, count = self.walk(a.end, b.head)
        return ChunkMap(a.head, a.count + count + b.count, end if b.end is None else b.end)

    def apply(self, state: State, m: ChunkMap) -> tuple[State, int]:
        end, count = self.walk(state, m.head)
        return (end if m.end is None else m.end), count + m.count

    def scan(self, maps: list[ChunkMap]) -> list[ChunkMap]:
        """Maps from before the first chunk to after each, in steps that double."""
        step = 1
        while step < len(maps):
            maps = maps[:step] + [self.compose(a, b) for a, b in zip(maps, maps[step:])]
            step *= 2
        return maps

    def running_counts(self, text: str, chunk: int = CHUNK) -> list[int]:
        """Tokens of the text up to the end of each chunk; the last one is the count."""
        if not text:
            return [0]
        marked = SPACE + text.replace(" ", SPACE)
        maps = [self.chunk_map(marked[k : k + chunk]) for k in range(0, len(marked), chunk)]
        return [self.apply(self.start, m)[1] for m in self.scan(maps)]

    def count(self, text: str, chunk: int = CHUNK) -> int:
        return self.running_counts(text, chunk)[-1]


@dataclass(frozen=True)
class ChunkMap:
    """What a chunk does to any state: ``head`` is read from that state; where the chunk has a
    border, ``count`` tokens follow and ``end`` is the state after it, else ``end`` is None."""

    head: str
    count: int
    end: State | None


def piece_scores(model_file: str) -> dict[str, float]:
    """Scores by piece of a BPE model with byte fallback that marks the start of a text and changes nothing else."""
    from sentencepiece import sentencepiece_model_pb2

    model = sentencepiece_model_pb2.ModelProto()
    with open(model_file, "rb") as file:
        model.ParseFromString(file.read())
    trained, normal = model.trainer_spec, model.normalizer_spec
    kinds = {"NORMAL": 1, "UNKNOWN": 2, "CONTROL": 3, "BYTE": 6}
    if (
        trained.model_type != 2
        or not trained.byte_fallback
        or trained.treat_whitespace_as_suffix
        or normal.precompiled_charsmap
        or normal.remove_extra_whitespaces
        or not normal.add_dummy_prefix
        or {p.type for p in model.pieces} - set(kinds.values())
    ):
        raise ValueError(f"{model_file}: not a plain BPE vocabulary with byte fallback")
    return {p.piece: p.score for p in model.pieces if p.type == kinds["NORMAL"]}


#: The machine of the last vocabulary that this process has counted with.
_machines: dict[int, Transducer] = {}


def token_count(spark: SparkSession, scores: dict[str, float], text: Column, chunk: int = CHUNK) -> Column:
    """Tokens of each text. The vocabulary is broadcast: a few MB, whatever the table."""
    shared = spark.sparkContext.broadcast(scores)
    name = hash(frozenset(scores.items()))

    @F.pandas_udf("long")
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        if name not in _machines:
            _machines.clear()
            _machines[name] = Transducer(shared.value)
        machine = _machines[name]
        for texts in batches:
            yield pd.Series([machine.count(t, chunk) for t in texts], dtype="int64")

    return count(text)


def token_counts(
    docs: DataFrame,
    scores: dict[str, float],
    id_col: str = "doc_id",
    text_col: str = "text",
    limit: int = LIMIT,
    chunk: int = CHUNK,
) -> DataFrame:
    """``id_col``, n_bytes, n_tokens and over_limit (more tokens than ``limit``) for every row."""
    text = text_or_empty(F.col(text_col))
    rows = docs.select(
        F.col(id_col).alias("id"),
        F.octet_length(text).cast("long").alias("n_bytes"),
        token_count(docs.sparkSession, scores, text, chunk).alias("n_tokens"),
    )
    return rows.select(F.col("id").alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
