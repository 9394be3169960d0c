"""Repair of conversation structure: the cheapest edits, found by a Viterbi search that emits as soon as it can.

A conversation's rows are read in order.  Each is kept, given the role of user or
assistant, or deleted, and empty turns may be inserted anywhere; what remains has
to read system (perhaps), user, assistant, user, assistant ..., or be empty.  The
search has four states, by what was written last: nothing, system, user,
assistant.  Each keeps one survivor, the cheapest edits that lead to it and of
equally cheap ones the string of edits that is least in ASCII order.

*Survivor coalescence.*  Survivors are leaves of a tree of backpointers whose nodes
count their references.  A survivor that is not continued is released, and with it
every ancestor nothing else refers to.  Once the oldest node has a single
successor, all survivors share that successor: its edits are final, are emitted,
and their texts dropped.  A survivor that costs more than another plus the dearest
detour from that one can't win any more and is released too; without this rule
"delete everything" would survive for ever.  So memory follows the unresolved
suffix, not the conversation.

*Ties.*  After every row survivors are ranked by their whole unresolved strings of
edits.  Strings of the same number of rows that all end with a row's edit are never
prefixes of each other, so rank of the predecessor, then own edits, orders their
continuations as comparing whole strings would.

*Duplicates* are found by Spark: a text that occurs at several turns of a
conversation is marked by an aggregate of 128-bit digests that combines map-side
and is joined back, so no task holds what a conversation has said so far.  The rows
of one conversation then pass one task in order, streamed from a sorted shuffle: the
hash asked for covers the whole repaired text and can't be put together from parts.

Defined cases: a null role or text is one blank; null turns come first; rows of one
turn are taken by role, then text; null ids are one conversation; a conversation
whose rows are all gone is returned with zeros, an empty audit and the hash of an
empty text; repeated rows are duplicates; further columns are ignored, whatever
their names; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re
from collections import deque
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

RELABEL, DELETE, INSERT, OPEN_END = 1, 2, 5, 5

NOTHING, SYSTEM, USER, ASSISTANT = range(4)
_NEXT = {NOTHING: {"s": SYSTEM, "u": USER}, SYSTEM: {"u": USER}, USER: {"a": ASSISTANT}, ASSISTANT: {"u": USER}}
_NAMES = {"u": "user", "a": "assistant"}
_LEGAL = frozenset(("su", "ua", "au"))
_INK = re.compile(r"[^\x20\x09-\x0D]")

# an edit as (initial, role written or None for the row's own, whether it writes the row's text)
_Edit = tuple[str, str | None]


def _inserts(state: int, stop: int | None = None) -> Iterator[tuple[int, int, tuple[_Edit, ...]]]:
    """(state, cost, edits) after no, one or two inserted turns; more only come back to a state passed before."""
    cost, edits = 0, ()
    for _ in range(3):
        yield state, cost, edits
        letter = "a" if state == USER else "u"
        state, cost, edits = _NEXT[state][letter], cost + INSERT, (*edits, ("I", _NAMES[letter]))


def _audit(edits: tuple[_Edit, ...]) -> str:
    return "".join(e[0] for e in edits)


def _steps(initial: str, must_go: bool, open_end: bool) -> list[list[tuple[int, int, tuple[_Edit, ...], str]]]:
    """For each state after a row of this kind, the best way from each state before it: (before, cost, edits, audit)."""
    best: dict[tuple[int, int], tuple[int, str, tuple[_Edit, ...]]] = {}
    for before in _NEXT:
        for state, cost, edits in _inserts(before):
            ways = [(state, DELETE, ("D", None))]
            if not must_go:
                extra = OPEN_END if open_end else 0
                if initial in _NEXT[state]:
                    ways.append((_NEXT[state][initial], extra, ("K", None)))
                letter = "a" if state == USER else "u"
                ways.append((_NEXT[state][letter], RELABEL + extra, ("R", _NAMES[letter])))
            for after, more, edit in ways:
                whole = (*edits, edit)
                found = (cost + more, _audit(whole), whole)
                if (before, after) not in best or found < best[before, after]:
                    best[before, after] = found
    return [[(b, *(best[b, after][i] for i in (0, 2, 1))) for b in _NEXT if (b, after) in best] for after in _NEXT]


_KINDS = {(i, gone, ends): _steps(i, gone, ends) for i in ("s", "u", "a", "") for gone in (False, True) for ends in (False, True)}
# the ways to an end that may stand: nothing, or an answer
_ENDS = [min(((c, _audit(e), e) for s, c, e in _inserts(b) if s in (NOTHING, ASSISTANT))) for b in _NEXT]

# What any continuation of the first state costs more, at most, if it is made from the second instead: turns are
# inserted to get to where the continuation can go on, and a system turn it would keep is deleted.
_DETOUR = {
    (NOTHING, SYSTEM): 2 * INSERT, (NOTHING, USER): INSERT + DELETE, (NOTHING, ASSISTANT): DELETE,
    (SYSTEM, NOTHING): 0, (SYSTEM, USER): INSERT, (SYSTEM, ASSISTANT): 0,
    (USER, NOTHING): INSERT, (USER, SYSTEM): INSERT, (USER, ASSISTANT): INSERT,
    (ASSISTANT, NOTHING): 0, (ASSISTANT, SYSTEM): 2 * INSERT, (ASSISTANT, USER): INSERT,
}


class _Node:
    __slots__ = ("edits", "parent", "refs", "role", "text")

    def __init__(self, parent: _Node | None, edits: tuple[_Edit, ...], role: str, text: str) -> None:
        self.parent, self.edits, self.role, self.text, self.refs = parent, edits, role, text, 0
        if parent is not None:
            parent.refs += 1


class Repair:
    """Rows in, final edits out: ``emit`` gets (initial, role, text), role None for a deletion, in order."""

    def __init__(self, emit) -> None:
        self.emit = emit
        self.root = _Node(None, (), "", "")
        self.root.refs = 1
        self.live: list[tuple[int, int, _Node] | None] = [(0, 0, self.root), None, None, None]  # cost, rank, node
        self.open: deque[list[_Node]] = deque()  # the nodes of each row whose edits aren't final yet

    def row(self, role: str, text: str, must_go: bool, open_end: bool) -> None:
        initial = role[:1]
        kind = _KINDS[initial if initial in ("s", "u", "a") else "", must_go, open_end]
        live, chosen = self.live, []
        for after, ways in enumerate(kind):
            best = None
            for before, cost, edits, audit in ways:
                old = live[before]
                if old is not None:
                    found = (old[0] + cost, old[1], audit)
                    if best is None or found < best[0]:
                        best = found, old[2], edits
            if best is not None:
                chosen.append((best[0][1], best[0][2], best[0][0], after, best[1], best[2]))
        # who costs more than a detour from another survivor can't win, not even by a tie
        costs = [(c[3], c[2]) for c in chosen]
        chosen = [c for c in chosen if all(c[3] == y or c[2] <= cost + _DETOUR[c[3], y] for y, cost in costs)]
        chosen.sort(key=lambda c: c[:2])
        new: list[tuple[int, int, _Node] | None] = [None] * 4
        for rank, (_, _, cost, after, parent, edits) in enumerate(chosen):
            new[after] = (cost, rank, _Node(parent, edits, role, text))
            new[after][2].refs = 1
        self.open.append([x[2] for x in new if x is not None])
        for old in live:
            if old is not None:
                self._release(old[2])
        self.live = new
        self._settle()

    def _release(self, node: _Node | None) -> None:
        while node is not None:
            node.refs -= 1
            if node.refs:
                return
            above, node.parent = node.parent, None
            node = above

    def _settle(self) -> None:
        """Emit while only one node of the oldest open row is still referred to."""
        while self.open:
            left = [node for node in self.open[0] if node.refs]
            if len(left) > 1:
                return
            self.root = left[0]
            self.root.parent = None
            self._write(self.root)
            self.open.popleft()

    def _write(self, node: _Node) -> None:
        for initial, role in node.edits:
            if initial == "D":
                self.emit("D", None, None)
            elif initial == "I":
                self.emit("I", role, "")
            else:
                self.emit(initial, node.role if role is None else role, node.text)

    def finish(self) -> int:
        """Emit the rest; returns the cost."""
        ends = [(x[0] + _ENDS[s][0], x[1], s) for s, x in enumerate(self.live) if x is not None]
        cost, _, state = min(ends)
        line, node = [], self.live[state][2]
        while node is not self.root:
            line.append(node)
            node = node.parent
        for node in reversed(line):
            self._write(node)
        for initial, role in _ENDS[state][2]:
            self.emit(initial, role, "")
        return cost


def damage(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, gone: faults put in by a checksum of conversation and turn.

    A row that is dropped stays as one marked ``gone``, so that its conversation isn't forgotten.
    """
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fault = F.crc32(F.concat(blank("conv_id"), F.lit(":"), blank("turn")).cast("binary")) % 20
    marked = rows.select("conv_id", F.col("turn").cast("long").alias("turn"), blank("role").alias("role"), blank("text").alias("text"), fault.alias("f"))
    text = F.when(F.col("f").isin(0, 1), "").when(F.col("f") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    copies = F.sequence(F.lit(1), F.when(F.col("f") == 3, 2).otherwise(1))
    return marked.select(
        "conv_id", "turn", F.when(F.col("f") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"),
        (F.col("f") == 0).alias("gone"), F.explode(copies).alias("copy")).drop("copy")


def _marked(rows: DataFrame) -> DataFrame:
    """Rows with ``again``: whether role and text were seen at an earlier turn of the conversation."""
    digest = F.unhex(F.md5(F.concat_ws("\0", "role", "text").cast("binary")))
    rows = rows.withColumn("digest", F.when(~F.col("gone") & F.col("text").rlike(r"[^\x20\x09-\x0D]"), digest))
    turns = rows.where(F.col("digest").isNotNull()).groupBy("conv_id", "digest").agg(
        F.min("turn").alias("low"), F.max("turn").alias("high"), F.max(F.col("turn").isNull()).alias("null_first"))
    several = turns.where("low <> high or (null_first and low is not null)").select(
        F.col("conv_id").alias("c"), F.col("digest").alias("d"), F.when(~F.col("null_first"), F.col("low")).alias("low"), F.lit(True).alias("several"))
    same = F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("digest") == F.col("d"))
    again = F.col("several").isNotNull() & F.col("turn").isNotNull() & (F.col("low").isNull() | (F.col("turn") > F.col("low")))
    return rows.join(several, same, "left").select("conv_id", "turn", "role", "text", "gone", again.alias("again"))


class _Conversation:
    def __init__(self, name, keep_rows: bool) -> None:
        self.name = name
        self.low = self.high = self.last = self.before = None
        self.turns = self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.audit: list[str] = []
        self.hash, self.lines = hashlib.sha256(), 0
        self.rows: list[tuple] | None = [] if keep_rows else None
        self.step = 0
        self.search = Repair(self._emit)

    def _emit(self, initial: str, role: str | None, text: str | None) -> None:
        if self.rows is not None:
            self.step += 1
            self.rows.append((self.name, self.step, initial, role, text))
            return
        self.audit.append(initial)
        if role is not None:
            self.hash.update(f"{chr(10) if self.lines else ''}{role}:{text}".encode())
            self.lines += 1

    def row(self, turn: int | None, role: str, text: str, again: bool) -> None:
        if turn is not None and turn != self.high:
            self.turns += 1
            self.low = turn if self.low is None else self.low
            self.high = turn
        this = (turn, role, text)
        if self.last is not None and self.before + role[:1] not in _LEGAL:
            self.illegal += 1
        ink = _INK.search(text) is not None
        copied = ink and (again or this == self.last)
        body = text.rstrip("\x20\t\n\x0b\x0c\r")
        cut = ink and not copied and body[-1] not in ".!?"
        self.blank += not ink
        self.duplicate += copied
        self.truncated += cut
        self.last, self.before = this, role[:1]
        self.search.row(role, text, not ink or copied, cut)

    def summary(self) -> tuple:
        cost = self.search.finish()
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        return (self.name, gaps, self.blank, self.duplicate, self.truncated, self.illegal, cost, "".join(self.audit), self.hash.hexdigest())


def _stream(rows: DataFrame, schema: str, keep_rows: bool) -> DataFrame:
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: _Conversation | None = None
        done: list[tuple] = []

        def flush(kind: pa.Schema) -> pa.RecordBatch:
            columns = list(zip(*done, strict=True)) if done else [[] for _ in kind]
            done.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, kind, strict=True)], schema=kind)

        kind = None
        for batch in parts:
            if kind is None:
                fixed = (
                    [("step", pa.int64()), ("edit", pa.string()), ("role", pa.string()), ("text", pa.string())] if keep_rows else
                    [*((n, pa.int64()) for n in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")), ("audit", pa.string()),
                     ("repaired_sha256", pa.string())])
                kind = pa.schema([("conv_id", batch.schema.field(0).type), *fixed])
            for name, turn, role, text, gone, again in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if now is None or now.name != name:
                    if now is not None:
                        _close(now, done)
                    now = _Conversation(name, keep_rows)
                if not gone:
                    now.row(turn, role, text, again)
            if now is not None and now.rows:
                done += now.rows
                now.rows.clear()
            yield flush(kind)
        if now is not None:
            _close(now, done)
            yield flush(kind)

    keyed = _marked(rows).repartition("conv_id")
    ordered = keyed.sortWithinPartitions("conv_id", F.col("turn").asc_nulls_first(), "role", "text", "gone")
    return ordered.mapInArrow(run, schema)


def _close(now: _Conversation, done: list[tuple]) -> None:
    if now.rows is None:
        done.append(now.summary())
    else:
        now.search.finish()
        done += now.rows


def repair(rows: DataFrame) -> DataFrame:
    """One row per conversation: faults counted, cost, audit (an initial per edit) and hash of the repaired text.

    ``rows`` has conv_id, turn, role, text, gone, as ``damage`` returns them.
    """
    name = rows.schema["conv_id"].dataType.simpleString()
    return _stream(
        rows, f"conv_id {name}, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, "
        "audit string, repaired_sha256 string", False)


def edits(rows: DataFrame) -> DataFrame:
    """One row per edit, numbered within its conversation: K(eep), R(ole), I(nsert) with the turn written, D(elete) without."""
    name = rows.schema["conv_id"].dataType.simpleString()
    return _stream(rows, f"conv_id {name}, step bigint, edit string, role string, text string", True)
