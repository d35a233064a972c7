"""Repair of conversation structure at the least cost, by Four-Russians block tables.

A conversation is a word of symbols, one per turn: what its role starts with, whether it is cut short, or that
it must go. The cheapest edits (keep, rerole, delete, insert) that make the roles alternate come from costs to the
end, one per state of the wanted pattern, computed from the last turn to the first. Less their least one there
are only a few such vectors, so for every vector and every block of ``BLOCK`` symbols the vector in front
of the block and the cost added are looked up in tables made beforehand. Edits are traced from the front: a
block is expanded backwards from the vector behind it, and of equally cheap edits the least letter is taken,
which gives the least of all cheapest edit words.

Turns are sorted by range, so a long conversation is spread over tasks in parts. Conversations in one
part are repaired where they are. A part of a longer one is reduced to its effect on every vector; these effects
are chained from the back, the parts are traced from each state side by side, and the states chained
from the front. Only the hash of a repaired text, a chain by nature, streams a long conversation through one task,
a batch at a time.
"""

from __future__ import annotations

import functools
import hashlib
import itertools
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import SPACE_CHARS, prepare, stored
from tessera.operators import streams

# fixed values of the query's contract
DELETE, INSERT, REROLE, TRUNCATED = 4, 3, 3, 3
ENDS = ".!?"
LEGAL = ("su", "ua", "au")

BLOCK = 4                 # symbols of a block
WHOLE_BYTES = 8 << 20     # text of a conversation up to which one task holds it
START, AFTER_S, AFTER_U, AFTER_A = range(4)
GONE, PAD = 0, 9          # symbols: a turn that must go, 1..8 = initial x truncated, the filling of a last block
SYMBOLS = 10
INITIALS = "sua"          # symbols 1 + 2 * (0, 1, 2; 3 = any other) + truncated
LAST_RUN = (1 << 31) - 1  # behind every run

TURNS = "conv_id long, turn long, role string, text string, gone boolean"
RESULT = ("conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, "
          "repaired_sha256 string")
PARTS = ("conv_id long, run int, whole boolean, blank long, duplicate long, truncated long, illegal long, "
         "first_role string, last_role string, turns long, first_turn long, last_turn long, cost long, audit string, "
         "repaired_sha256 string, symbols binary, vectors array<int>, added array<long>")
CHAINED = PARTS + ", behind int, total long"
TRACED = CHAINED + ", ends array<int>, audits array<string>"
STORY = "conv_id long, run int, audit string, gaps long, blank long, duplicate long, truncated long, illegal long, cost long"


# -- the pattern (s?(ua)+)? ---------------------------------------------------------------------------------

def inserted(state: int) -> int:
    """The state behind an inserted turn, which is a user's unless the last turn is one."""
    return AFTER_A if state == AFTER_U else AFTER_U


def kept(state: int, initial: int) -> int | None:
    """The state behind a turn with this initial (an index of ``INITIALS``); None if the pattern has none."""
    if initial == 0:
        return AFTER_S if state == START else None
    if initial == 1:
        return AFTER_U if state != AFTER_U else None
    return AFTER_A if initial == 2 and state == AFTER_U else None


END = (0, 2 * INSERT, INSERT, 0)  # costs to the end where no turn is left


def choices(symbol: int, state: int) -> list[tuple[str, int, int]]:
    """(edit, cost, state behind) for a turn, in the order of the letters."""
    out = [("D", DELETE, state)]
    if symbol != GONE:
        initial, cut = divmod(symbol - 1, 2)
        after = kept(state, initial)
        if after is not None:
            out.append(("K", TRUNCATED * cut, after))
        out.append(("R", REROLE + TRUNCATED * cut, inserted(state)))
    return out


def before(symbol: int, behind: tuple[int, ...]) -> tuple[int, ...]:
    """Costs to the end in front of a turn, from those behind it; insertions in front of the turn included."""
    if symbol == PAD:
        return behind
    own = [min(cost + behind[after] for _, cost, after in choices(symbol, s)) for s in range(4)]
    u, a = min(own[AFTER_U], INSERT + own[AFTER_A]), min(own[AFTER_A], INSERT + own[AFTER_U])
    return min(own[START], INSERT + u), min(own[AFTER_S], INSERT + u), u, a


class Tables:
    """All normalised vectors that can occur, and per vector and block the one in front and the cost added."""

    def __init__(self) -> None:
        self.vectors = [END]
        known = {END: 0}
        step: list[list[tuple[int, int]]] = []
        for vector in self.vectors:  # grows while it is read
            row = []
            for symbol in range(SYMBOLS):
                found = before(symbol, vector)
                least = min(found)
                found = tuple(v - least for v in found)
                if found not in known:
                    known[found] = len(self.vectors)
                    self.vectors.append(found)
                row.append((known[found], least))
            step.append(row)
        self.step = np.array(step)
        one, added = self.step[:, :, 0], self.step[:, :, 1]
        self.front, self.added = one, added
        for _ in range(BLOCK - 1):  # one more symbol in front of every block
            self.front, self.added = (
                one[self.front].transpose(0, 2, 1).reshape(len(one), -1),
                (added[self.front] + self.added[:, :, None]).transpose(0, 2, 1).reshape(len(one), -1))
        self.front_of, self.added_of = self.front.tolist(), self.added.tolist()

    @functools.lru_cache(maxsize=1 << 18)
    def traced(self, behind: int, block: int, state: int) -> tuple[str, int]:
        """The least letters of the cheapest edits of a block from ``state`` on, and the state behind it."""
        word = [block // SYMBOLS ** i % SYMBOLS for i in range(BLOCK - 1, -1, -1)]
        costs = [self.vectors[behind]]
        for symbol in reversed(word):
            costs.append(before(symbol, costs[-1]))
        costs.reverse()
        out = []
        for i, symbol in enumerate(word):
            if symbol == PAD:
                continue
            while True:
                for edit, cost, after in (("D", DELETE, state), ("I", INSERT, inserted(state)), *choices(symbol, state)[1:]):
                    rest = costs[i][after] if edit == "I" else costs[i + 1][after]
                    if cost + rest == costs[i][state]:
                        break
                out.append(edit)
                state = after
                if edit != "I":
                    break
        return "".join(out), state


@functools.cache
def tables() -> Tables:
    return Tables()


def blocks(symbols: bytes) -> list[int]:
    """The numbers of a word's blocks; the last is filled with ``PAD``, which changes nothing."""
    word = np.frombuffer(symbols + bytes([PAD]) * (-len(symbols) % BLOCK), "u1").astype("int64").reshape(-1, BLOCK)
    return (word @ SYMBOLS ** np.arange(BLOCK - 1, -1, -1)).tolist()


def effect(symbols: bytes) -> tuple[list[int], list[int]]:
    """For every vector behind a word: the one in front of it, and the cost added."""
    t = tables()
    vectors, added = np.arange(len(t.vectors)), np.zeros(len(t.vectors), "int64")
    for block in reversed(blocks(symbols)):
        added += t.added[vectors, block]
        vectors = t.front[vectors, block]
    return vectors.tolist(), added.tolist()


def trace(symbols: bytes, behind: int, state: int, last: bool = False) -> tuple[str, int]:
    """The edit word from ``state`` on, with the vector ``behind`` the word, and the state behind; after
    the ``last`` symbol of a conversation what the pattern still wants is inserted."""
    t, numbers = tables(), blocks(symbols)
    borders = [behind]
    for block in reversed(numbers):
        borders.append(t.front_of[borders[-1]][block])
    out = []
    for block, border in zip(numbers, borders[-2::-1]):
        edits, state = t.traced(border, block, state)
        out.append(edits)
    while last and END[state]:
        out.append("I")
        state = inserted(state)
    return "".join(out), state


def total(symbols: bytes) -> int:
    """The least cost of repairing a whole word."""
    t, vector, cost = tables(), 0, 0
    for block in reversed(blocks(symbols)):
        cost += t.added_of[vector][block]
        vector = t.front_of[vector][block]
    return cost + t.vectors[vector][START]


class Repair:
    """Applies edit words to turns, in order; ``text`` pieces are newline-joined into the hash."""

    def __init__(self) -> None:
        self.state, self.sha, self.lines = START, hashlib.sha256(), 0

    def insert(self, edits: Iterator[str]) -> str | None:
        """Insertions up to the next other edit, which is returned (None at the end)."""
        for edit in edits:
            if edit != "I":
                return edit
            self.line(self.wanted(), "")
            self.state = inserted(self.state)
        return None

    def turn(self, edits: Iterator[str], role: str, text: str) -> None:
        edit = self.insert(edits)
        if edit == "K":
            self.state = kept(self.state, initial_of(role))
            self.line(role, text)
        elif edit == "R":
            role = self.wanted()
            self.state = inserted(self.state)
            self.line(role, text)

    def wanted(self) -> str:
        return "assistant" if self.state == AFTER_U else "user"

    def line(self, role: str, text: str) -> None:
        self.sha.update(f"{chr(10) if self.lines else ''}{role}:{text}".encode())
        self.lines += 1


# -- turns ---------------------------------------------------------------------------------------------------

def initial_of(role: str) -> int:
    found = INITIALS.find(role[:1]) if role else -1
    return 3 if found < 0 else found


class Part:
    """What is counted over turns that follow each other, and their symbols."""

    def __init__(self) -> None:
        self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.first_role: str | None = None
        self.last_role: str | None = None
        self.first_turn: int | None = None
        self.last_turn: int | None = None
        self.symbols = bytearray()

    def add(self, turn: int | None, role: str, text: str, seen: bool) -> None:
        bare = text.rstrip(SPACE_CHARS)
        cut = False
        if not bare:
            self.blank += 1
        elif seen:
            self.duplicate += 1
        elif bare[-1] not in ENDS:
            cut = True
            self.truncated += 1
        self.symbols.append(GONE if not bare or seen else 1 + 2 * initial_of(role) + cut)
        role = role[:1]
        if self.last_role is None:
            self.first_role = role
        else:
            self.illegal += self.last_role + role not in LEGAL
        self.last_role = role
        if turn is not None and turn != self.last_turn:
            self.turns += 1
            self.first_turn = turn if self.first_turn is None else self.first_turn
            self.last_turn = turn

    def gaps(self) -> int:
        return 0 if self.first_turn is None else self.last_turn - self.first_turn + 1 - self.turns

    def follow(self, other: dict) -> None:
        """The counts of a part that comes behind."""
        self.blank += other["blank"]
        self.duplicate += other["duplicate"]
        self.truncated += other["truncated"]
        self.illegal += other["illegal"]
        if other["first_role"] is not None:
            if self.last_role is not None:
                self.illegal += self.last_role + other["first_role"] not in LEGAL
            self.last_role = other["last_role"]
        if other["first_turn"] is not None:
            self.turns += other["turns"] - (other["first_turn"] == self.last_turn)
            self.first_turn = other["first_turn"] if self.first_turn is None else self.first_turn
            self.last_turn = other["last_turn"]


def _dicts(batches: Iterable[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        yield from batch.to_pylist()


def _repaired(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """A row of ``PARTS`` for a (conversation, run): marks (side 0: the conversation is long; side 1: a duplicate
    at this place) come in front of the turns they speak of."""
    part, held, seen, long = Part(), [], None, False
    for batch in batches:
        for side, at, turn, role, text, gone in zip(*(batch.column(batch.schema.get_field_index(c)).to_pylist()
                                                      for c in ("side", "at", "turn", "role", "text", "gone"))):
            if side == 0:
                long = True
            elif side == 1:
                seen = at
            elif not gone:
                part.add(turn, role, text, seen == at)
                if not long:
                    held.append((role, text))
    symbols = bytes(part.symbols)
    counts = (part.blank, part.duplicate, part.truncated, part.illegal)
    if long:
        yield (*key, False, *counts, part.first_role, part.last_role, part.turns, part.first_turn, part.last_turn,
               None, None, None, symbols, *effect(symbols))
        return
    audit, _ = trace(symbols, 0, START, last=True)
    repair, edits = Repair(), iter(audit)
    for role, text in held:
        repair.turn(edits, role, text)
    repair.insert(edits)
    yield (*key, True, *counts, None, None, part.gaps(), None, None, total(symbols), audit, repair.sha.hexdigest(),
           None, None, None)


def _chained(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """Parts of a long conversation, last first: with the vector behind each and the cost from it on."""
    vector, cost = 0, 0
    names = [f.split()[0] for f in PARTS.split(", ")]
    for row in _dicts(batches):
        behind = vector
        cost += row["added"][vector]
        vector = row["vectors"][vector]
        yield (*(row[n] for n in names), behind, cost + tables().vectors[vector][START])


def _story(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """Parts of a long conversation, first first: the edit word of each, then the counts of all."""
    state, whole, cost = START, Part(), None
    for row in _dicts(batches):
        cost = row["total"] if cost is None else cost
        whole.follow(row)
        yield (*key, row["run"], row["audits"][state], None, None, None, None, None, None)
        state = row["ends"][state]
    while END[state]:  # what the pattern still wants behind the last turn
        yield (*key, LAST_RUN, "I", None, None, None, None, None, None)
        state = inserted(state)
    yield (*key, None, None, whole.gaps(), whole.blank, whole.duplicate, whole.truncated, whole.illegal, cost)


def _told(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """The result of a long conversation from its counts, then per part its edit word and its turns."""
    repair, audit, edits, counts = Repair(), [], iter(()), None
    for batch in batches:
        columns = (batch.column(batch.schema.get_field_index(c)).to_pylist()
                   for c in ("side", "role", "text", "gone", "audit", "gaps", "blank", "duplicate", "truncated", "illegal", "cost"))
        for side, role, text, gone, word, *numbers in zip(*columns):
            if side == 0:
                counts = numbers
            elif side == 1:
                repair.insert(edits)
                audit.append(word)
                edits = iter(word)
            elif not gone:
                repair.turn(edits, role, text)
    repair.insert(edits)
    yield (*key, *counts, "".join(audit), repair.sha.hexdigest())


def repair(turns: DataFrame, whole_bytes: int = WHOLE_BYTES) -> DataFrame:
    """``RESULT`` for every conv_id of ``turns`` (see ``TURNS``; a row that is ``gone`` only names its conversation).

    Turns are taken by turn, nulls first, and within a turn by role and text; equal rows repeat each other. A null conv_id
    is a conversation; null roles and texts count as one space. A conversation without turns has zeros, an empty audit
    and the hash of the empty text. An empty table has no rows."""
    prepare(turns)
    clean = turns.select("conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"),
                         F.coalesce("text", F.lit(" ")).alias("text"), F.coalesce("gone", F.lit(False)).alias("gone"))
    order = [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), F.col("role"), F.col("text")]
    rows = streams.sorted_runs(clean, order)

    # what was said before: counted by a 128-bit hash of role and text, so no rows of a conversation meet
    said = F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"))
    slim = rows.where(~F.col("gone")).select("conv_id", "run", "at", F.unhex(said).alias("said"))
    again = (slim.groupBy("conv_id", "said").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n"))
             .where(F.col("n") > 1))
    seen = (slim.alias("l").join(again.alias("r"), F.col("l.conv_id").eqNullSafe(F.col("r.conv_id"))
                                 & (F.col("l.said") == F.col("r.said")) & (F.col("l.at") > F.col("r.first")))
            .select("l.conv_id", "l.run", F.lit(1).alias("side"), "l.at"))

    size = F.octet_length("text") + F.octet_length("role")
    parts = rows.groupBy("conv_id", "run").agg(F.sum(F.when(F.col("gone"), 0).otherwise(size)).alias("bytes"))
    long = (parts.groupBy("conv_id").agg(F.count(F.lit(1)).alias("parts"), F.sum("bytes").alias("bytes"))
            .where((F.col("parts") > 1) | (F.col("bytes") > whole_bytes)))
    spread = stored(parts.alias("l").join(long.alias("r"), F.col("l.conv_id").eqNullSafe(F.col("r.conv_id")))
                    .select("l.conv_id", "l.run"), "long-parts")

    marks = spread.select("conv_id", "run", F.lit(0).alias("side"), F.lit(-1).cast("long").alias("at")).union(seen)
    empty = [F.lit(None).cast(t).alias(c) for c, t in (("turn", "long"), ("role", "string"), ("text", "string"), ("gone", "boolean"))]
    told = marks.select("conv_id", "run", "side", "at", *empty).union(
        rows.select("conv_id", "run", F.lit(2), "at", "turn", "role", "text", "gone"))
    done = stored(streams.stream_groups(told, ["conv_id", "run"], _repaired, PARTS, ["at", "side"]), "conversation-parts")
    short = done.where("whole").select("conv_id", F.col("turns").alias("gaps"), "blank", "duplicate", "truncated", "illegal",
                                       "cost", "audit", "repaired_sha256")
    return short.union(_long(done.where("NOT whole"), rows, spread))


def _long(parts: DataFrame, rows: DataFrame, spread: DataFrame) -> DataFrame:
    chained = streams.stream_groups(parts, ["conv_id"], _chained, CHAINED, [F.desc("run")])
    out = streams.arrow_schema(TRACED)

    def traces(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found() -> Iterator[tuple]:
            for row in _dicts(batches):
                ways = [trace(row["symbols"], row["behind"], s) for s in range(4)]
                yield (*row.values(), [end for _, end in ways], [edits for edits, _ in ways])
        yield from streams.packed(found(), out)

    story = stored(streams.stream_groups(chained.mapInArrow(traces, TRACED), ["conv_id"], _story, STORY, ["run"]),
                   "conversation-story")
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    heads = story.select("conv_id", F.coalesce("run", F.lit(-1)).alias("run"), F.when(F.col("run").isNull(), 0).otherwise(1).alias("side"),
                         F.lit(-1).cast("long").alias("at"), F.lit(None).cast("string").alias("role"),
                         F.lit(None).cast("string").alias("text"), F.lit(False).alias("gone"), "audit", *counts)
    mine = (rows.alias("l").join(spread.alias("r"), F.col("l.conv_id").eqNullSafe(F.col("r.conv_id"))
                                 & (F.col("l.run") == F.col("r.run")), "left_semi")
            .select("conv_id", "run", F.lit(2), "at", "role", "text", "gone", F.lit(None).cast("string"),
                    *[F.lit(None).cast("long") for _ in counts]))
    return streams.stream_groups(heads.union(mine), ["conv_id"], _told, RESULT, ["run", "at", "side"])


# -- the drill -------------------------------------------------------------------------------------------------

def damaged(turns: DataFrame) -> DataFrame:
    """``TURNS`` with the faults that the query's contract plants by a checksum of conversation and turn."""
    def text_of(c: str) -> Column:
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))

    fault = F.crc32(F.concat(text_of("conv_id"), F.lit(":"), text_of("turn"))) % 20
    text = F.when(fault == 1, F.lit("")).when(fault == 2, F.regexp_replace(text_of("text"), r"[.!?]", "")).otherwise(text_of("text"))
    copies = F.explode(F.sequence(F.lit(1), F.when(fault == 3, 2).otherwise(1)))
    gone = fault == 0
    return turns.select("conv_id", "turn", F.when(fault == 4, F.lit("user")).otherwise(text_of("role")).alias("role"),
                        F.when(gone, F.lit("")).otherwise(text).alias("text"), gone.alias("gone"), copies.alias("copy")).drop("copy")


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation, damaged and repaired."""
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    return repair(damaged(turns.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text")))
