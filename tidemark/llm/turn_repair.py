"""Structure repair of conversations: the cheapest edits that give a legal sequence of roles.

Turns are told apart by the initial of their role. Legal is nothing at all, or an optional system turn followed by pairs
of user and assistant: ``(s?(ua)+)?``. Keeping a turn costs 0, giving it the role user or assistant 2, deleting it 3, an
empty user or assistant turn put in anywhere 2; blank turns and repeats have to go, and a truncated turn that stays costs
1 more. Of the cheapest edits those win whose initials (D, I, K, R, in order) are ASCII-least.

Turns are brought together by conversation and sorted by turn, and tasks stream over them: what is carried from batch to
batch is a dynamic program over four states (nothing yet, after s, after u, after a). Each state holds its cost and how
its edits so far rank among the four, which is all that ties need: no two of the four are beginnings of each other, as
all end with an edit of the same turn. Costs relative to the least take few values, so steps are looked up, not computed.

A conversation of up to ``HELD_TURNS`` turns and ``HELD_BYTES`` is finished where it is. A longer one spills four bytes a
turn (where each state came from) as blocks into the result table, which lies in the shared folder: its blocks are then
read backwards by a second pass, and its turns once more, with the edits chosen, by a third. So no task holds a
conversation, whatever its length, and a lost executor costs a rerun of its tasks only.

What a turn repeats may lie anywhere before it. Repeats within one turn number are neighbours in the order; the others
are found by grouping digests and sent along as marks, sorted just before the turns they are about.

Defined cases: null role and text count as empty; the null conversation id is a conversation of its own; null turn numbers
come first; rows of one turn number are ordered by role, then by digest, so equal rows are neighbours; roles with other
initials, the empty one included, are never kept; a conversation without turns (named by ``ids`` only) needs no edit and
has the empty text's digest; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
import io
from collections import deque
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import cut_lineage

HELD_TURNS = 20_000
HELD_BYTES = 8 << 20
# Turns whose backpointers make one block; turns sent on together, and their bytes.
BLOCK = 1 << 16
BATCH = 2_000
BATCH_BYTES = 4 << 20

DELETE, KEEP, REROLE = 0, 1, 2
LETTERS = "DKR"
COSTS = (3, 0, 2)
INSERT = 2
TRUNCATED = 1
# States: nothing yet, after a system turn, after a user turn, after an assistant turn. What a user or assistant turn
# makes of each (None: not legal there).
START, AFTER_S, AFTER_U, AFTER_A = range(4)
NEXT = {"s": (AFTER_S, None, None, None), "u": (AFTER_U, AFTER_U, None, AFTER_U), "a": (None, None, AFTER_A, None)}
ROLES = {AFTER_U: "user", AFTER_A: "assistant"}
NOWHERE = 255
BLANKS = " \t\n\x0b\x0c\r"


def inserted(state: int) -> int:
    """The state after one empty turn: whichever of user and assistant is legal there."""
    return AFTER_A if state == AFTER_U else AFTER_U


def step(now: tuple, initial: str, must_go: bool, truncated: bool) -> tuple[tuple, int, bytes]:
    """One turn: the states after it, what all of them cost more, and where each came from.

    ``now``: (cost above the least, rank) of each state, None where it can't be reached.
    """
    found: dict[int, tuple] = {}
    for state, held in enumerate(now):
        if held is None:
            continue
        at = state
        for inserts in range(3):
            before, spent = "I" * inserts, held[0] + INSERT * inserts
            for edit in (DELETE, KEEP, REROLE):
                if edit == DELETE:
                    targets = [at]
                elif must_go:
                    continue
                elif edit == KEEP:
                    targets = [NEXT[initial][at]] if initial in NEXT else []
                else:
                    targets = [NEXT["u"][at], NEXT["a"][at]]
                cost = spent + COSTS[edit] + (TRUNCATED if truncated and edit != DELETE else 0)
                for target in targets:
                    if target is None:
                        continue
                    way = (cost, held[1], before + LETTERS[edit], state, inserts, edit)
                    if target not in found or way[:3] < found[target][:3]:
                        found[target] = way
            at = inserted(at)
    least = min(way[0] for way in found.values())
    ranked = sorted(found, key=lambda t: found[t][1:3])
    after = tuple((found[t][0] - least, ranked.index(t)) if t in found else None for t in range(4))
    back = bytes(found[t][3] | found[t][4] << 2 | found[t][5] << 4 if t in found else NOWHERE for t in range(4))
    return after, least, back


class Steps(dict):
    """Steps worked out so far; there are some hundred different ones."""

    def __missing__(self, what: tuple) -> tuple:
        self[what] = step(*what)
        return self[what]


FRESH = ((0, 0), None, None, None)


def ending(now: tuple) -> tuple[int, int, int]:
    """Cost above the least, state and empty turns at the end, of the best way to a legal sequence."""
    ways = []
    for state, held in enumerate(now):
        if held is not None:
            at = state
            for inserts in range(3):
                if at in (START, AFTER_A):
                    ways.append((held[0] + INSERT * inserts, held[1], inserts, state))
                at = inserted(at)
    cost, _, inserts, state = min(ways)
    return cost, state, inserts


def trace(back: bytes, state: int) -> tuple[bytearray, int]:
    """Edits of a run of turns, one byte each (empty turns before it * 3 + edit), and the state before the run."""
    edits = bytearray(len(back) // 4)
    for i in range(len(edits) - 1, -1, -1):
        way = back[4 * i + state]
        edits[i] = (way >> 2 & 3) * 3 + (way >> 4)
        state = way & 3
    return edits, state


class Replay:
    """Carries chosen edits out, turn by turn: the repaired turns, their digest, the initials of the edits."""

    def __init__(self):
        self.state, self.place, self.audit, self.sha = START, 0, io.StringIO(), hashlib.sha256()

    def _out(self, edit: str, role: str, text: str) -> tuple:
        self.sha.update(f"{chr(10) if self.place else ''}{role}:{text}".encode())
        self.place += 1
        return self.place, edit, role, text

    def _empty(self, number: int) -> Iterator[tuple]:
        for _ in range(number):
            self.audit.write("I")
            self.state = inserted(self.state)
            yield self._out("I", ROLES[self.state], "")

    def turn(self, code: int, role: str, text: str) -> Iterator[tuple]:
        yield from self._empty(code // 3)
        edit = code % 3
        self.audit.write(LETTERS[edit])
        if edit == REROLE:
            self.state = inserted(self.state)
            yield self._out("R", ROLES[self.state], text)
        elif edit == KEEP:
            self.state = NEXT[role[:1]][self.state]
            yield self._out("K", role, text)

    def end(self, inserts: int) -> Iterator[tuple]:
        yield from self._empty(inserts)


CONV = ["no_conv", "conv"]
PLACE = ["no_turn", "turn", "role", "digest"]
COUNTS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
# kind: turn (a repaired one), report, back (a spilled block).
OUT = (
    "no_conv boolean, conv bigint, kind string, place bigint, edit string, no_turn boolean, turn bigint, role string, "
    "digest string, text string, " + ", ".join(f"{c} bigint" for c in COUNTS) + ", audit string, repaired_sha256 string, "
    "block bigint, back binary, final int"
)
EMPTY = dict(
    place=0, edit="", no_turn=False, turn=0, role="", digest="", text="", **dict.fromkeys(COUNTS, 0), audit="",
    repaired_sha256="", block=0, back=b"", final=-1,
)
NAMES = [part.split()[0] for part in OUT.split(", ")]


class Out:
    """Rows on their way out, a bounded batch of them at a time."""

    def __init__(self):
        self.rows, self.bytes = [], 0

    def add(self, conv: tuple, kind: str, **values) -> None:
        self.rows.append({"no_conv": conv[0], "conv": conv[1], "kind": kind, **EMPTY, **values})
        self.bytes += len(values.get("text", "")) + len(values.get("audit", "")) + len(values.get("back", b""))

    def full(self) -> bool:
        return len(self.rows) >= BATCH or self.bytes >= BATCH_BYTES

    def take(self) -> pd.DataFrame:
        frame = pd.DataFrame(self.rows, columns=NAMES)
        self.rows, self.bytes = [], 0
        return frame


class Forward:
    """One conversation on its first pass."""

    def __init__(self, conv: tuple, with_turns: bool, steps: Steps):
        self.conv, self.with_turns, self.steps = conv, with_turns, steps
        self.now, self.cost, self.back = FRESH, 0, bytearray()
        self.turns: list[tuple[str, str]] | None = []
        self.bytes, self.block, self.first = 0, 0, None
        self.seen = dict.fromkeys(COUNTS, 0)
        self.key = self.marked = self.initial = None
        self.low = self.high = self.number = None
        self.numbers = 0

    def turn(self, out: Out, no_turn: bool, turn: int, role: str, digest: str, text: str, blank: bool, truncated: bool) -> None:
        key = (no_turn, turn, role, digest)
        if not no_turn:
            if self.number != turn:
                self.numbers += 1
            self.number = self.high = turn
            self.low = turn if self.low is None else self.low
        duplicate = not blank and key in (self.key, self.marked)
        truncated = truncated and not blank and not duplicate
        self.seen["blank"] += blank
        self.seen["duplicate"] += duplicate
        self.seen["truncated"] += truncated
        initial = role[:1]
        if self.initial is not None and self.initial + initial not in ("su", "ua", "au"):
            self.seen["illegal"] += 1
        self.initial, self.key = initial, key
        self.now, more, back = self.steps[self.now, initial if initial in NEXT else "", blank or duplicate, truncated]
        self.cost += more
        if not self.back:
            self.first = key
        self.back += back
        if self.turns is not None:
            self.turns.append((role, text))
            self.bytes += len(text)
            if len(self.turns) > HELD_TURNS or self.bytes > HELD_BYTES:
                self.turns = None
        if self.turns is None and len(self.back) >= 4 * BLOCK:
            self.spill(out)

    def spill(self, out: Out, final: int = -1) -> None:
        no_turn, turn, role, digest = self.first
        out.add(self.conv, "back", no_turn=no_turn, turn=turn, role=role, digest=digest, block=self.block,
                back=bytes(self.back), final=final)
        self.block, self.back = self.block + 1, bytearray()

    def end(self, out: Out) -> Iterator[pd.DataFrame]:
        more, state, inserts = ending(self.now)
        self.seen["cost"] = self.cost + more
        if self.low is not None:
            self.seen["gaps"] = self.high - self.low + 1 - self.numbers
        if self.turns is None:
            # The last block says how it all ends; it may be empty.
            self.first = self.first if self.back else self.key
            self.spill(out, state << 2 | inserts)
            out.add(self.conv, "report", final=0, **self.seen)
            return
        edits, _ = trace(bytes(self.back), state)
        replay = Replay()
        for code, (role, text) in zip(edits, self.turns):
            for place, edit, role_now, text_now in replay.turn(code, role, text):
                if self.with_turns:
                    out.add(self.conv, "turn", place=place, edit=edit, role=role_now, text=text_now)
                    if out.full():
                        yield out.take()
        for place, edit, role_now, text_now in replay.end(inserts):
            if self.with_turns:
                out.add(self.conv, "turn", place=place, edit=edit, role=role_now, text=text_now)
        out.add(self.conv, "report", audit=replay.audit.getvalue(), repaired_sha256=replay.sha.hexdigest(), **self.seen)


IN = [*CONV, "kind", *PLACE, "text", "is_blank", "is_truncated"]
MARK, TURN, NONE = 1, 2, 3


def _forward(with_turns: bool):
    """First pass over sorted turns, marks and bare ids; the state goes on from batch to batch."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out, now, steps = Out(), None, Steps()
        for frame in frames:
            for no_conv, conv, kind, no_turn, turn, role, digest, text, blank, truncated in zip(*(frame[c].tolist() for c in IN)):
                if now is None or now.conv != (no_conv, conv):
                    if now is not None:
                        yield from now.end(out)
                    now = Forward((no_conv, conv), with_turns, steps)
                if kind == MARK:
                    now.marked = (no_turn, turn, role, digest)
                elif kind == TURN:
                    now.turn(out, no_turn, turn, role, digest, text, blank, truncated)
                if out.full():
                    yield out.take()
        if now is not None:
            yield from now.end(out)
        if out.rows:
            yield out.take()

    return run


def _backward(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Second pass: blocks of a conversation, last first, become its edits."""
    state = None
    for frame in frames:
        edits, tails = [], []
        for back, final in zip(frame["back"].tolist(), frame["final"].tolist()):
            if final >= 0:
                state = final >> 2
            found, state = trace(back, state)
            edits.append(bytes(found))
            tails.append(final & 3 if final >= 0 else 0)
        yield frame.assign(back=edits, final=tails)


def _replayed(with_turns: bool):
    """Third pass: turns with their edits, which come in blocks sorted before the first turn they are for."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out, conv, replay, blocks, tail = Out(), None, None, deque(), 0

        def emit(made) -> None:
            for place, edit, role, text in made:
                if with_turns:
                    out.add(conv, "turn", place=place, edit=edit, role=role, text=text)

        def end() -> None:
            emit(replay.end(tail))
            out.add(conv, "report", audit=replay.audit.getvalue(), repaired_sha256=replay.sha.hexdigest(), final=1)

        for frame in frames:
            columns = ("no_conv", "conv", "kind", "role", "text", "back", "final")
            for no_conv, number, kind, role, text, edits, final in zip(*(frame[c].tolist() for c in columns)):
                if conv != (no_conv, number):
                    if conv is not None:
                        end()
                    conv, replay, blocks, tail = (no_conv, number), Replay(), deque(), 0
                if kind != TURN:
                    blocks.append(iter(edits))
                    tail = tail or final
                    continue
                code = next(blocks[0], None)
                while code is None:
                    blocks.popleft()
                    code = next(blocks[0], None)
                emit(replay.turn(code, role, text))
                if out.full():
                    yield out.take()
        if conv is not None:
            end()
        if out.rows:
            yield out.take()

    return run


def _sorted(rows: DataFrame, *further: str) -> DataFrame:
    """Conversations whole in one partition each, in the order of their turns; null turn numbers first."""
    order = [*CONV, F.desc("no_turn"), "turn", "role", "digest", "kind", *further]
    return rows.repartition(*CONV).sortWithinPartitions(*order)


def _turns(turns: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """Turns with all the passes need and no nulls: ids and numbers are told from null by a flag."""
    number, ident = F.col(turn).cast("bigint"), F.col(conv).cast("bigint")
    plain = turns.select(
        ident.isNull().alias("no_conv"), F.coalesce(ident, F.lit(0)).alias("conv"), F.lit(TURN).alias("kind"),
        number.isNull().alias("no_turn"), F.coalesce(number, F.lit(0)).alias("turn"),
        F.coalesce(F.col(role).cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"),
    )
    end = F.rtrim("text", F.lit(BLANKS))
    return plain.select(
        *CONV, "kind", "no_turn", "turn", "role", F.md5("text").alias("digest"), "text", (end == "").alias("is_blank"),
        (~F.right(end, F.lit(1)).isin(".", "!", "?")).alias("is_truncated"),
    )


def _marks(turns: DataFrame) -> DataFrame:
    """Role and text of a later turn number that an earlier one has already."""
    narrow = turns.where(~F.col("is_blank")).select(*CONV, *PLACE).distinct()
    said = [*CONV, "role", "digest"]
    at = F.struct((~F.col("no_turn")).alias("n"), F.col("turn").alias("t"))
    first = narrow.groupBy(*said).agg(F.min(at).alias("first"), F.max(at).alias("last")).where("first < last").drop("last")
    return narrow.join(first, said).where(at > F.col("first")).select(
        *CONV, F.lit(MARK).alias("kind"), *PLACE, F.lit("").alias("text"), F.lit(False).alias("is_blank"),
        F.lit(False).alias("is_truncated"),
    )


def _passes(turns: DataFrame, ids: DataFrame | None, with_turns: bool) -> DataFrame:
    """Rows of ``OUT`` of all conversations; reports of those that were spilled come in two rows."""
    stream = turns.unionByName(_marks(turns))
    if ids is not None:
        bare = ids.select(F.col(ids.columns[0]).cast("bigint").alias("c")).distinct().select(
            F.col("c").isNull().alias("no_conv"), F.coalesce("c", F.lit(0)).alias("conv"), F.lit(NONE).alias("kind"),
            F.lit(True).alias("no_turn"), F.lit(0).cast("bigint").alias("turn"), F.lit("").alias("role"),
            F.lit("").alias("digest"), F.lit("").alias("text"), F.lit(False).alias("is_blank"),
            F.lit(False).alias("is_truncated"),
        )
        stream = stream.unionByName(bare)
    done = cut_lineage(_sorted(stream.select(*IN)).mapInPandas(_forward(with_turns), OUT))
    spilled = done.where("kind = 'back'")
    if spilled.isEmpty():
        return done
    backwards = spilled.repartition(*CONV).sortWithinPartitions(*CONV, F.desc("block"))
    edits = cut_lineage(backwards.mapInPandas(_backward, OUT))
    long = edits.select(*CONV).distinct()
    again = turns.join(long, CONV, "left_semi").select(
        *CONV, "kind", *PLACE, "text", F.lit(b"").alias("back"), F.lit(0).alias("final"), F.lit(0).cast("bigint").alias("block")
    )
    blocks = edits.select(*CONV, F.lit(0).alias("kind"), *PLACE, F.lit("").alias("text"), "back", "final", "block")
    replayed = cut_lineage(_sorted(again.unionByName(blocks), "block").mapInPandas(_replayed(with_turns), OUT))
    return done.where("kind <> 'back'").unionByName(replayed)


def repair(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """The repaired turns: conv_id, place (from 1), edit (K kept, R given a role, I put in), role, text."""
    done = _passes(_turns(turns, conv, turn, role, text), None, True).where("kind = 'turn'")
    return done.select(F.when(~F.col("no_conv"), F.col("conv")).alias(conv), "place", "edit", "role", "text")


def report(turns: DataFrame, ids: DataFrame | None = None, conv: str = "conv_id", turn: str = "turn", role: str = "role",
           text: str = "text") -> DataFrame:
    """One row per conversation: conv_id; gaps (missing turn numbers), blank, duplicate, truncated (turns by first fault),
    illegal (neighbours whose roles don't follow each other) and cost; audit, the initials of the edits; and
    repaired_sha256, of the repaired ``role:text``, newline-joined. ``ids`` (one column) names conversations to report
    even if they have no turn."""
    done = _passes(_turns(turns, conv, turn, role, text), ids, False).where("kind = 'report'")
    # A spilled conversation has its counts in one row and what its edits came to in another; all others have one row.
    counted, told = F.col("final") <= 0, F.col("final") != 0
    merged = done.where("final = -1").select(*CONV, *COUNTS, "audit", "repaired_sha256").unionByName(
        done.where("final >= 0").groupBy(*CONV).agg(
            *[F.max(F.when(counted, F.col(c))).alias(c) for c in COUNTS],
            *[F.max(F.when(told, F.col(c))).alias(c) for c in ("audit", "repaired_sha256")],
        )
    )
    return merged.select(F.when(~F.col("no_conv"), F.col("conv")).alias(conv), *COUNTS, "audit", "repaired_sha256")
