"""Conversation structure repair by a Viterbi search whose survivors coalesce.

A conversation is repaired by the cheapest edits (keep, rerole, delete, insert) after which
its role initials read ``(s?(ua)+)?``; of equally cheap ones the audit string that is least
in ASCII wins.  The states of the search are what came out so far: nothing, a system turn, a
user turn, an assistant turn.

Survivors are leaves of a backpointer tree with reference counts.  A branch that no survivor
needs is freed at once; where all survivors share an ancestor, the edits up to it are final
and leave the tree.  A survivor always ends with the edit of a row, so none is the beginning
of another one, and the order of complete unresolved suffixes follows from the order one row
earlier: it is kept as the survivors' rank, and ties are decided by it.  A survivor goes
early only if another can do whatever it can for strictly less.

Rows are range-partitioned by conversation and turn, so a conversation of any size is spread
over many tasks.  What a task cannot decide (the conversation it begins in the middle of, the
unresolved rest of the one it ends with) it leaves open, with a summary: the cost of each way
from state to state.  The summaries of a conversation, at most four for each task, are
composed in order, and tell each open stretch its first and last state.
"""

from __future__ import annotations

import hashlib
from collections import deque
from functools import lru_cache

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise

NOTHING, SYSTEM, USER, ASSISTANT = range(4)
KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
#: Costs of the edits; an undeleted truncated row adds TRUNCATED.
COST = {KEEP: 0, REROLE: 2, DELETE: 3, INSERT: 2}
TRUNCATED_COST = 1
#: Faults of a row; GONE marks a row that was dropped and only names its conversation.
FINE, TRUNCATED, BLANK, DUPLICATE, GONE = range(5)
BLANKS = " \t\n\x0b\f\r"
LEGAL = {"su", "ua", "au"}
#: Code points of a text that take part in the range partitioning; the sort takes all.
PREFIX = 64
#: Place of the turns that are inserted after the last row.
LAST = 1 << 62

#: What a state gives when user or assistant is put out: the role follows from the state.
_NEXT = {NOTHING: USER, SYSTEM: USER, ASSISTANT: USER, USER: ASSISTANT}
_ROLE = {USER: "user", ASSISTANT: "assistant"}
#: Inserted turns that end a conversation.
_ENDING = {NOTHING: "", SYSTEM: "II", USER: "I", ASSISTANT: ""}
#: _HANDICAP[x][y]: what a survivor in x pays at most to do whatever one in y can do.
_HANDICAP = {NOTHING: {SYSTEM: 0, USER: 2, ASSISTANT: 0}, SYSTEM: {NOTHING: 4, USER: 2, ASSISTANT: 4},
             USER: {NOTHING: 5, SYSTEM: 2, ASSISTANT: 2}, ASSISTANT: {NOTHING: 3, SYSTEM: 0, USER: 2}}


def emits(state: int, initial: str) -> int | None:
    """State after a turn with this initial; None if it may not come now."""
    if initial == "s":
        return SYSTEM if state == NOTHING else None
    if initial == "u":
        return USER if state != USER else None
    return ASSISTANT if initial == "a" and state == USER else None


@lru_cache(maxsize=None)
def options(state: int, initial: str, fault: int) -> tuple[tuple[int, int, str], ...]:
    """(state after, cost, edits) of each way to deal with a row: inserted turns, then the row.

    A turn inserted before a deleted row costs the same after it and reads later in ASCII.
    """
    out = [(state, COST[DELETE], DELETE)]
    if fault in (FINE, TRUNCATED):
        before, paid, extra = "", 0, TRUNCATED_COST * (fault == TRUNCATED)
        for _ in range(3):
            kept = emits(state, initial)
            if kept is not None:
                out.append((kept, paid + extra, before + KEEP))
            out.append((_NEXT[state], paid + extra + COST[REROLE], before + REROLE))
            state, paid, before = _NEXT[state], paid + COST[INSERT], before + INSERT
    return tuple(out)


@lru_cache(maxsize=100_000)
def advance(tips: tuple[tuple[int, int], ...], initial: str, fault: int):
    """One row further: the new survivors (state, cost less the least), the least, and of each
    survivor the one it comes from and its edits.  Survivors are listed in the order of their
    complete edits."""
    best: dict[int, tuple] = {}
    for i, (state, cost) in enumerate(tips):
        for to, paid, edits in options(state, initial, fault):
            way = (cost + paid, i, edits)
            if to not in best or way < best[to]:
                best[to] = way
    alive = {to: way for to, way in best.items()
             if not any(best[y][0] + _HANDICAP[y][to] < way[0] for y in best if y != to)}
    order = sorted(alive, key=lambda to: alive[to][1:])
    least = min(way[0] for way in alive.values())
    return (tuple((to, alive[to][0] - least) for to in order), least, tuple(alive[to][1:] for to in order))


def ending(tips) -> tuple[int, int]:
    """(survivor, cost with the turns that end the conversation) of the best one."""
    costs = [(cost + COST[INSERT] * len(_ENDING[state]), i) for i, (state, cost) in enumerate(tips)]
    cost, i = min(costs)
    return i, cost


class Node:
    """A row's edits on the way to some survivors: its parent, and how many need it."""

    __slots__ = ("parent", "edits", "kids", "held")

    def __init__(self, parent, edits):
        self.parent, self.edits, self.kids, self.held = parent, edits, [], 0

    def references(self) -> int:
        return len(self.kids) + self.held


class Survivors:
    """The search over one stretch of rows: ``step`` takes a row's initial and fault and gives
    the edits that are now final, a string for each row, oldest first."""

    def __init__(self, state: int = NOTHING):
        self.root = Node(None, "")
        self.root.held = 1
        self.tips, self.nodes = ((state, 0),), (self.root,)

    def step(self, initial: str, fault: int) -> list[str]:
        self.tips, _, ways = advance(self.tips, initial, fault)
        old, new = self.nodes, []
        for i, edits in ways:
            node = Node(old[i], edits)
            node.held = 1
            old[i].kids.append(node)
            new.append(node)
        self.nodes = tuple(new)
        for node in old:
            node.held -= 1
            self._free(node)
        return self._coalesced()

    def _free(self, node: Node) -> None:
        while node is not self.root and not node.references():
            parent = node.parent
            parent.kids.remove(node)
            node.parent, node = None, parent

    def _coalesced(self) -> list[str]:
        out = []
        while len(self.root.kids) == 1 and not self.root.held:
            self.root = self.root.kids[0]
            self.root.parent = None
            out.append(self.root.edits)
        return out

    def finish(self, state: int | None = None) -> list[str]:
        """Edits of the rows still open, for the survivor in ``state`` or else the best one;
        the turns that end the conversation come last."""
        i = ending(self.tips)[0] if state is None else next(i for i, t in enumerate(self.tips) if t[0] == state)
        node, out = self.nodes[i], []
        while node is not self.root:
            out.append(node.edits)
            node = node.parent
        out.reverse()
        return [*out, _ENDING[self.tips[i][0]] if state is None else ""]


# -- rows -------------------------------------------------------------------------------

_FIELDS = ("part int, at long, edit string, turn long, was string, role string, text string, fault int, "
           "entry int, exits array<int>, costs array<long>")
_EDIT = ["conv", "part", "at", "edit", "turn", "was", "role", "text", "fault"]
#: Rows put out together.
_TOGETHER = 512


class _Out:
    """Rows on their way out, as Arrow batches."""

    def __init__(self, kind: pa.DataType, part: int | None = None):
        self.part, self.rows = part, []
        self.schema = pa.schema([("conv", kind), ("part", pa.int32()), ("at", pa.int64()), ("edit", pa.string()),
                                 ("turn", pa.int64()), ("was", pa.string()), ("role", pa.string()), ("text", pa.string()),
                                 ("fault", pa.int32()), ("entry", pa.int32()), ("exits", pa.list_(pa.int32())),
                                 ("costs", pa.list_(pa.int64()))])

    def add(self, conv, at, edit=None, turn=None, was=None, role=None, text=None, fault=None, entry=None,
            exits=None, costs=None, part=None):
        self.rows.append((conv, self.part if part is None else part, at, edit, turn, was, role, text, fault, entry, exits, costs))

    def batches(self, least: int = _TOGETHER):
        if len(self.rows) >= least and self.rows:
            rows, self.rows = self.rows, []
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), self.schema.types, strict=True)], schema=self.schema)


class _Stretch:
    """Rows of one conversation that a task sees, in order, from a known state on."""

    def __init__(self, out: _Out, conv, state: int = NOTHING, part: int | None = None):
        self.out, self.conv, self.state, self.part = out, conv, state, part
        self.search, self.waiting = Survivors(state), deque()

    def row(self, at: int, turn, role: str, text: str, fault: int) -> None:
        self.waiting.append((at, turn, role, text, fault))
        for edits in self.search.step(role[:1], fault):
            self._put(edits)

    def _insert(self, at: int) -> None:
        self.state = _NEXT[self.state]
        self.out.add(self.conv, at, INSERT, None, None, _ROLE[self.state], "", part=self.part)

    def _put(self, edits: str) -> None:
        at, turn, role, text, fault = self.waiting.popleft()
        for k in range(len(edits) - 1):
            self._insert(8 * at + k)
        edit, now = edits[-1], role
        if edit == DELETE:
            now = None
        elif edit == KEEP:
            self.state = emits(self.state, role[:1])
        else:
            self.state = _NEXT[self.state]
            now = _ROLE[self.state]
        self.out.add(self.conv, 8 * at + 7, edit, turn, role, now, None if now is None else text, fault, part=self.part)

    def end(self, state: int | None = None) -> None:
        *edits, last = self.search.finish(state)
        for e in edits:
            self._put(e)
        self.close(last)

    def close(self, inserted: str) -> None:
        for k in range(len(inserted)):
            self._insert(LAST + k)

    def leave_open(self) -> None:
        """Hand on the rows that are not decided, and what they cost from the common ancestor on."""
        for at, turn, role, text, fault in self.waiting:
            self.out.add(self.conv, 8 * at + 7, None, turn, role, None, text, fault)
        self.out.add(self.conv, -1, entry=self.state, exits=[t for t, _ in self.search.tips], costs=[c for _, c in self.search.tips])


class _Unknown:
    """Rows of the conversation that a task begins with: it may have begun earlier, in any state."""

    def __init__(self, out: _Out, conv):
        self.out, self.conv = out, conv
        self.tips = {state: (((state, 0),), 0) for state in range(4)}
        self.rows = 0

    def row(self, at: int, turn, role: str, text: str, fault: int) -> None:
        self.rows += 1
        self.out.add(self.conv, 8 * at + 7, None, turn, role, None, text, fault)
        for state, (tips, paid) in self.tips.items():
            new, least, _ = advance(tips, role[:1], fault)
            self.tips[state] = new, paid + least

    def leave_open(self) -> None:
        if self.rows:
            for state, (tips, paid) in self.tips.items():
                self.out.add(self.conv, -1, entry=state, exits=[t for t, _ in tips], costs=[paid + c for _, c in tips])

    end = leave_open


def _search(batches):
    """Sorted rows of a task: edits as they become final, open rows and summaries for the rest."""
    out, now, at, before = None, None, 0, None
    for batch in batches:
        out = out or _Out(batch.schema.field(0).type, TaskContext.get().partitionId())
        for conv, turn, role, text, fault in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if now is None:
                now = _Unknown(out, conv)
            elif conv != now.conv:
                now.end()
                now, before = _Stretch(out, conv), None
            if fault == GONE:
                out.add(conv, 8 * at, "")
            else:
                if before == (turn, role, text) and fault != BLANK:
                    fault = DUPLICATE
                now.row(at, turn, role, text, fault)
                before = turn, role, text
            at += 1
            yield from out.batches()
    if out:
        now.leave_open()
        yield from out.batches(1)


def compose(parts: list[dict[int, list[tuple[int, int]]]]) -> tuple[list[tuple[int, int]], str]:
    """(first state, last state) of each stretch on the cheapest, ASCII-least way through all, and
    the turns inserted at the end.  A stretch is {first state: [(last state, cost), ...] in order}."""
    first = next(iter(parts[0])) if len(parts[0]) == 1 else NOTHING
    tips, back = [(first, 0)], []
    for part in parts:
        best: dict[int, tuple] = {}
        for i, (state, cost) in enumerate(tips):
            for k, (to, paid) in enumerate(part.get(state, ())):
                way = (cost + paid, i, k)
                if to not in best or way < best[to]:
                    best[to] = way
        order = sorted(best, key=lambda to: best[to][1:])
        back.append([(best[to][1], to) for to in order])
        tips = [(to, best[to][0]) for to in order]
    i, _ = ending(tips)
    states, last = [], tips[i][0]
    for links in reversed(back):
        i, state = links[i]
        states.append(state)
    states = [*reversed(states)]
    return list(zip([first, *states[:-1]], states, strict=True)), _ENDING[last]


def _compose(summaries: pa.Table) -> pa.Table:
    """Summaries of one conversation: a row for each stretch, with its states and its inserted turns."""
    parts: dict[int, dict] = {}
    for part, entry, exits, costs in zip(*(summaries.column(c).to_pylist() for c in ("part", "entry", "exits", "costs")), strict=True):
        parts.setdefault(part, {})[entry] = list(zip(exits, costs, strict=True))
    order = sorted(parts)
    states, inserted = compose([parts[p] for p in order])
    out = _Out(summaries.schema.field("conv").type)
    conv = summaries.column("conv")[0].as_py()
    for p, (first, last) in zip(order, states, strict=True):
        out.add(conv, -1, inserted if p == order[-1] else "", entry=first, exits=[last], part=p)
    return pa.Table.from_batches(out.batches(1), out.schema)


def _settle(batches):
    """Open rows behind the row that tells the first and last state of their stretch: their edits."""
    out = now = None
    last = inserted = None

    def end():
        now.end(last)
        now.close(inserted)

    for batch in batches:
        out = out or _Out(batch.schema.field(0).type)
        for conv, part, at, edit, turn, was, _, text, fault, entry, exits, _ in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if at == -1:
                if now is not None:
                    end()
                now, last, inserted = _Stretch(out, conv, entry, part), exits[0], edit
            else:
                now.row(at // 8, turn, was, text, fault)
            yield from out.batches()
    if now is not None:
        end()
        yield from out.batches(1)


def repair(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
           text_col: str = "text", present=None) -> DataFrame:
    """conv, part, at, edit, turn, was, role, text, fault: the cheapest edits, one row each.

    Order by conv, part and at.  ``edit`` is K, R, D or I; ``was`` is the role before, ``role``
    and ``text`` the repaired turn (null if deleted).  Rows that the column ``present`` calls
    absent are no turns: they only name their conversation, with an empty edit.  Null roles
    and texts count as one blank; null turns come first, and so does the null conversation;
    rows of one turn go by role, then text.  Repeated rows are turns of their own, duplicates
    after the first; a turn without a role cannot stay as it is.  Texts of any length and conversations of any number of turns are taken
    whole; an empty table gives an empty result; other columns play no part.
    """
    text, role = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in (text_col, role_col))
    there = F.lit(True) if present is None else present
    turns = rows.select(F.col(conv_col).alias("conv"), F.col(turn_col).cast("long").alias("turn"),
                        F.when(there, role).alias("role"), F.when(there, text).alias("text"), there.alias("there"))
    body = F.rtrim(F.col("text"), F.lit(BLANKS))
    fault = (F.when(~F.col("there"), GONE).when(body == "", BLANK)
             .when(F.right(body, F.lit(1)).isin(".", "!", "?"), FINE).otherwise(TRUNCATED))
    digest = F.md5(F.concat_ws(":", F.length("role"), "role", "text"))
    judged = turns.withColumns({"fault": fault, "digest": digest, "when": F.struct(F.col("turn").isNotNull().alias("known"), "turn")})
    # the same role and text in several turns: where they come first
    real = judged.where(F.col("fault").isin(FINE, TRUNCATED))
    again = (real.groupBy("conv", "digest").agg(F.min("when").alias("first"), F.max("when").alias("last"))
             .where("first != last").select(F.col("conv").alias("of"), F.col("digest").alias("same"), "first"))
    seen = judged.join(again, F.col("conv").eqNullSafe(F.col("of")) & (F.col("digest") == F.col("same")), "left")
    seen = seen.select("conv", "turn", "role", "text", F.when(
        F.col("fault").isin(FINE, TRUNCATED) & (F.col("when") > F.col("first")), DUPLICATE).otherwise(F.col("fault")).alias("fault"))
    prefix = F.substring("text", 1, PREFIX)
    ordered = seen.repartitionByRange("conv", "turn", "role", prefix).sortWithinPartitions("conv", "turn", "role", "text")
    kind = ordered.schema["conv"].dataType.simpleString()
    found = materialise(ordered.mapInArrow(_search, f"conv {kind}, {_FIELDS}"), "edits")

    plans = found.where("entry is not null").groupBy("conv").applyInArrow(_compose, found.schema)
    left = found.where("edit is null and entry is null").unionByName(plans)
    settled = left.repartition("part", "conv").sortWithinPartitions("part", "conv", "at").mapInArrow(_settle, found.schema)
    return found.where("edit is not null").unionByName(settled).select(*_EDIT)


# -- report -----------------------------------------------------------------------------

_REPORT = ("gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, "
           "repaired_sha256 string")


class _Tally:
    """Counts and digests of one conversation, taken from its edits in order."""

    def __init__(self):
        self.least = self.turn = None
        self.turns = self.illegal = self.cost = self.rows = 0
        self.faults, self.audit, self.initial = [0] * 5, [], None
        self.digest = hashlib.sha256()

    def edit(self, edit, turn, was, role, text, fault):
        if not edit:
            return
        self.audit.append(edit)
        self.cost += COST[edit]
        if edit != INSERT:
            self.faults[fault] += 1
            if fault == TRUNCATED and edit != DELETE:
                self.cost += TRUNCATED_COST
            if turn is not None and turn != self.turn:
                self.least = turn if self.least is None else self.least
                self.turn, self.turns = turn, self.turns + 1
            if self.initial is not None and self.initial + was[:1] not in LEGAL:
                self.illegal += 1
            self.initial = was[:1]
        if edit != DELETE:
            self.digest.update(f"{chr(10) if self.rows else ''}{role}:{text}".encode())
            self.rows += 1

    def row(self):
        gaps = 0 if self.least is None else self.turn - self.least + 1 - self.turns
        return (gaps, self.faults[BLANK], self.faults[DUPLICATE], self.faults[TRUNCATED], self.illegal, self.cost,
                "".join(self.audit), self.digest.hexdigest())


def _report(batches):
    conv, tally, out, kind = None, None, [], None
    types = [pa.int64()] * 6 + [pa.string()] * 2

    def flush():
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), [kind, *types], strict=True)],
                                          ["conv_id", *(f.split()[0] for f in _REPORT.split(", "))])

    for batch in batches:
        kind = batch.schema.field(0).type
        for own, *edit in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if tally is None or own != conv:
                if tally is not None:
                    out.append((conv, *tally.row()))
                conv, tally = own, _Tally()
            tally.edit(*edit)
            if len(out) >= _TOGETHER:
                yield flush()
                out.clear()
    if tally is not None:
        out.append((conv, *tally.row()))
        yield flush()


def report(edits: DataFrame) -> DataFrame:
    """conv_id, counts of faults, cost, audit and SHA-256 of the repaired turns, by conversation.

    The digest of a conversation needs its turns one after another: they stream through one
    task, which holds one batch and the audit.
    """
    kind = edits.schema["conv"].dataType.simpleString()
    ordered = edits.repartition("conv").sortWithinPartitions("conv", "part", "at")
    return ordered.select("conv", "edit", "turn", "was", "role", "text", "fault").mapInArrow(_report, f"conv_id {kind}, {_REPORT}")


def damage(conversations: DataFrame) -> DataFrame:
    """Every conversation's turns with planted faults; ``present`` is false for dropped ones.

    The fault of a turn follows from crc32(``conv_id:turn``) % 20: 0 drops it, 1 empties its
    text, 2 takes its ``.!?`` away, 3 repeats it, 4 makes it a user's.  Nulls are one blank.
    """
    blank = {c: F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn", "role", "text")}
    hit = F.crc32(F.concat_ws(":", blank["conv_id"], blank["turn"])) % 20
    text = F.when(hit == 1, "").when(hit == 2, F.regexp_replace(blank["text"], "[.!?]", "")).otherwise(blank["text"])
    rows = conversations.select("conv_id", "turn", F.when(hit == 4, "user").otherwise(blank["role"]).alias("role"),
                                text.alias("text"), (hit != 0).alias("present"),
                                F.explode(F.array_repeat(F.lit(0), F.when(hit == 3, 2).otherwise(1))).alias("copy"))
    return rows.drop("copy")
