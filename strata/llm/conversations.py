"""Conversation structure repair by Wagner-Fischer target alignment (operator 12).

A conversation's roles should read ``(s?(ua)+)?``: an optional system turn,
then user and assistant in turn.  For every feasible length of that string an
alignment table (Wagner and Fischer 1974) gives the cheapest edits of the
turns; one table, filled from the end, serves all lengths with the same last
letter.  Only cells within Ukkonen's band are filled: each letter off the
diagonal costs a deletion or an insertion, so the cost of the best repair found
so far bounds the band, which widens until that cost proves itself.  The
backtraces of all targets of least cost are compared and the ASCII-least audit
stays.

Rows are dealt out by conversation and sorted; a task streams through them in
blocks of BLOCK turns.  A block is aligned from each state in which it can
begin (BEGIN, after the system turn, after a user, after an assistant) to each
in which it can end, and the least (cost, audit) of each state is carried on
with a running hash of its repaired text, so a conversation of any length takes
memory for a block, its audit and four hashes.  (The hash of one conversation's
repaired text is sequential by its nature, hence one task reads it in order.)

Defined results: null conv_id, turn, role and text count as one space in the
damage's key, role and text; a null conv_id is a conversation of its own; null
turns come first and don't count as gaps; rows of equal turn are ordered by role
and text, so that repeated rows are adjacent; an empty table has no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import shuffle_width

#: Fixed values of the contract: edit costs, and the classes of the damage.
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
DROPPED, EMPTIED, UNSTOPPED, REPEATED, USER = range(5)
CLASSES = 20
#: Turns that are aligned at once.
BLOCK = 64
#: States between turns: nothing yet, after ``s``, after ``u``, after ``a``.
BEGIN, SYSTEM, OPEN, CLOSED = range(4)
_NEVER = 1 << 40
_ROLE = {"u": "user", "a": "assistant"}
#: Rows sent to and from Python at once.
_ROWS = 2_048

RESULT = ("conv_id {id}, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, "
          "audit string, repaired_sha256 string")


def damaged(conversations: DataFrame) -> DataFrame:
    """The damage, by crc32 of ``conv_id:turn``; dropped rows stay, marked, so that no conversation is lost."""
    def spaced(c: str):
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))

    key = F.concat(spaced("conv_id"), F.lit(":"), spaced("turn"))
    rows = conversations.select("conv_id", "turn", spaced("role").alias("role"), spaced("text").alias("text"),
                                (F.crc32(F.encode(key, "UTF-8")) % CLASSES).alias("kind"))
    kind = F.col("kind")
    text = (F.when(kind.isin(DROPPED, EMPTIED), "")
            .when(kind == UNSTOPPED, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")))
    role = F.when(kind == USER, "user").otherwise(F.col("role"))
    rows = rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), (kind == DROPPED).alias("dropped"),
                       F.explode(F.when(kind == REPEATED, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
                       .alias("copy"))
    return rows.drop("copy")


def faults(rows: DataFrame) -> DataFrame:
    """``rows(conv_id, turn, role, text, dropped)`` in order, with each row's first fault (``fault``).

    The result is partitioned by conversation and sorted within partitions.
    """
    dealt = rows.repartition(shuffle_width(rows.sparkSession), "conv_id")
    same = Window.partitionBy("conv_id", "role", "text", "dropped").orderBy(F.col("turn").asc_nulls_first())
    seen = dealt.withColumn("seen", F.row_number().over(same) > 1)
    fault = (F.when(F.col("dropped"), "dropped")
             .when(~F.col("text").rlike(r"[^\x20\x09-\x0D]"), "blank")
             .when(F.col("seen"), "duplicate")
             .when(~F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z"), "truncated").otherwise(""))
    # of two equal rows the one that counts as seen comes second
    return (seen.sortWithinPartitions("conv_id", F.col("turn").asc_nulls_first(), "role", "text", "seen")
            .select("conv_id", "turn", "role", "text", fault.alias("fault")))


def _other(letter: str) -> str:
    return "a" if letter == "u" else "u"


class _Block:
    """Banded alignment tables of a run of turns, given as (initial, fault)."""

    def __init__(self, turns: list[tuple[str, str]]):
        self.turns = turns
        self.forced = [fault in ("blank", "duplicate") for _, fault in turns]
        self.late = [TRUNCATED if fault == "truncated" else 0 for _, fault in turns]
        n = len(turns)
        #: turns from here on that may stay
        self.free = [0] * (n + 1)
        for i in range(n - 1, -1, -1):
            self.free[i] = self.free[i + 1] + (not self.forced[i])
        #: no repair is cheaper: forced deletions, and each truncated turn is deleted at least
        self.base = DELETE * (n - self.free[0]) + DELETE * sum(x > 0 for x in self.late)
        self.spare = sum(x > 0 for x in self.late)
        self._tables: dict[tuple[str, int], list[dict[int, int]]] = {}

    def table(self, last: str, extra: int) -> list[dict[int, int]]:
        """Cost from turn i on with r letters left, the last of them ``last``, in the band of ``extra`` cost."""
        if (last, extra) in self._tables:
            return self._tables[last, extra]
        n = len(self.turns)
        below, above = self.spare + extra // DELETE, extra // INSERT
        cells: list[dict[int, int]] = [{} for _ in range(n + 1)]
        for i in range(n, -1, -1):
            row, under = cells[i], cells[i + 1] if i < n else {}
            for r in range(max(0, self.free[i] - below), self.free[i] + above + 1):
                best = _NEVER if i < n or r else 0
                if r and r - 1 in row:
                    best = min(best, row[r - 1] + INSERT)
                if i < n:
                    best = min(best, under.get(r, _NEVER) + DELETE)
                    if r and not self.forced[i]:
                        letter = last if r % 2 else _other(last)
                        best = min(best, under.get(r - 1, _NEVER) + self.late[i]
                                   + (0 if self.turns[i][0] == letter else REROLE))
                row[r] = best
        self._tables[last, extra] = cells
        return cells

    def trace(self, cells: list[dict[int, int]], last: str, i: int, r: int) -> str:
        """The ASCII-least edits (D, I, K, R) of least cost from turn i on with r letters left."""
        out, n = [], len(self.turns)
        while i < n or r:
            cost = cells[i][r]
            if i < n and cells[i + 1].get(r, _NEVER) + DELETE == cost:
                out.append("D")
                i += 1
            elif r and cells[i].get(r - 1, _NEVER) + INSERT == cost:
                out.append("I")
                r -= 1
            else:
                letter = last if r % 2 else _other(last)
                out.append("K" if self.turns[i][0] == letter else "R")
                i, r = i + 1, r - 1
        return "".join(out)

    def best(self, start: int, end: int) -> tuple[int, str] | None:
        """Least (cost, audit) from state ``start`` to state ``end``, or None where no edits lead there."""
        if end in (BEGIN, SYSTEM) and start == end:  # no letter: every turn goes
            return DELETE * len(self.turns), "D" * len(self.turns)
        if end == BEGIN or (end == SYSTEM and (start != BEGIN or not self._system_turns())):
            return None
        extra = DELETE
        while True:
            found = self._within(start, end, extra)
            if found and found[0] - self.base <= extra:
                return found
            if found:
                extra = found[0] - self.base  # the incumbent's cost is the last band's
            else:
                extra *= 2

    def _system_turns(self) -> list[int]:
        return [k for k, (initial, _) in enumerate(self.turns) if initial == "s" and not self.forced[k]]

    def _within(self, start: int, end: int, extra: int) -> tuple[int, str] | None:
        n = len(self.turns)
        options: list[tuple[int, int, int, str, list]] = []  # cost, first turn, letters, edits before, table
        if start == end:
            options.append((DELETE * n, n, 0, "D" * n, [{0: 0}] * (n + 1)))
        last = "u" if end == OPEN else "a"
        cells = self.table(last, extra)
        if end in (OPEN, CLOSED):
            first = "a" if start == OPEN else "u"
            options += [(cost, 0, r, "", cells) for r, cost in cells[0].items()
                        if r and (last if r % 2 else _other(last)) == first]
        if start == BEGIN and end != BEGIN:  # the turn k stays as the system turn, all before it go
            for k in self._system_turns():
                before = DELETE * k + self.late[k]
                options += [(before + cost, k + 1, r, "D" * k + "K", cells) for r, cost in cells[k + 1].items()
                            if ((last if r % 2 else _other(last)) == "u" if r else end == SYSTEM)
                            and (r == 0) == (end == SYSTEM)]
        least = min((o[0] for o in options), default=_NEVER)
        if least >= _NEVER:
            return None
        return least, min(edits + self.trace(table, last, i, r)
                          for cost, i, r, edits, table in options if cost == least)


def _lines(state: int, audit: str, rows: list[tuple[str, str]]) -> Iterator[tuple[int, str | None, str, str]]:
    """(state after, edit, role, text) of each edit of ``audit``."""
    i = 0
    for edit in audit:
        role, text = ("", "") if edit == "I" else rows[i]
        i += edit != "I"
        if edit == "D":
            yield state, edit, role, text
            continue
        if edit == "K" and state == BEGIN and role[:1] == "s":
            state = SYSTEM
        else:
            letter = "a" if state == OPEN else "u"
            state = OPEN if letter == "u" else CLOSED
            role = role if edit == "K" else _ROLE[letter]
        yield state, edit, role, text


class _Conversation:
    """One conversation, block by block."""

    def __init__(self):
        self.rows: list[tuple[str, str, str]] = []  # role, text, fault
        self.count = dict.fromkeys(("blank", "duplicate", "truncated"), 0)
        self.illegal = self.turns = 0
        self.before: str | None = None
        self.least_turn = self.most_turn = None
        self.states = {BEGIN: (0, "", hashlib.sha256())}

    def add(self, turn: int | None, role: str, text: str, fault: str) -> None:
        if fault == "dropped":
            return
        if len(self.rows) == BLOCK:
            self._align(final=False)
        if turn is not None and turn != self.most_turn:  # sorted: distinct turns are changes
            self.turns += 1
            self.least_turn = turn if self.least_turn is None else self.least_turn
            self.most_turn = turn
        if fault:
            self.count[fault] += 1
        if self.before is not None and self.before + role[:1] not in ("su", "ua", "au"):
            self.illegal += 1
        self.before = role[:1]
        self.rows.append((role, text, fault))

    def _align(self, final: bool) -> None:
        block = _Block([(role[:1], fault) for role, _, fault in self.rows])
        texts = [(role, text) for role, text, _ in self.rows]
        best: dict[int, tuple[int, str, int, str]] = {}
        for start, (cost, audit, _) in self.states.items():
            for end in ((BEGIN, CLOSED) if final else range(4)):
                found = block.best(start, end)
                if found:
                    option = (cost + found[0], audit + found[1], start, found[1])
                    best[end] = min(best.get(end, option), option)
        if final:  # only the cheapest end is needed
            end = min(best, key=lambda e: best[e][:2])
            best = {end: best[end]}
        after = {}
        for end, (cost, audit, start, piece) in best.items():
            running = self.states[start][2].copy()
            state = start
            for now, edit, role, text in _lines(start, piece, texts):
                if edit != "D":
                    running.update((f"\n{role}:{text}" if state != BEGIN else f"{role}:{text}").encode())
                state = now
            after[end] = (cost, audit, running)
        self.states, self.rows = after, []

    def result(self, conv_id) -> tuple:
        self._align(final=True)
        ((cost, audit, running),) = self.states.values()
        gaps = 0 if self.least_turn is None else self.most_turn - self.least_turn + 1 - self.turns
        return (conv_id, gaps, self.count["blank"], self.count["duplicate"], self.count["truncated"], self.illegal,
                cost, audit, running.hexdigest())


def repaired(rows: DataFrame) -> DataFrame:
    """Counts, cost, audit and hash of every conversation of ``rows`` (see ``faults``)."""
    kind = rows.schema["conv_id"].dataType.simpleString()
    names = [f.split()[0] for f in RESULT.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, conv_id, done, id_type = None, None, [], None

        def out() -> pa.RecordBatch:
            columns = list(zip(*done)) or [()] * len(names)
            done.clear()
            types = [id_type, *[pa.int64()] * 6, pa.string(), pa.string()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)

        for batch in batches:
            id_type = batch.schema.field("conv_id").type
            for at in range(0, batch.num_rows, _ROWS):
                piece = batch.slice(at, _ROWS).to_pydict()
                for conv, *row in zip(*(piece[c] for c in ("conv_id", "turn", "role", "text", "fault"))):
                    if now is None or conv != conv_id:
                        if now is not None:
                            done.append(now.result(conv_id))
                        now, conv_id = _Conversation(), conv
                    now.add(*row)
                if len(done) >= _ROWS:
                    yield out()
        if now is not None:
            done.append(now.result(conv_id))
            yield out()

    ordered = rows.select("conv_id", "turn", "role", "text", "fault")
    return ordered.mapInArrow(run, RESULT.format(id=kind))


def repair(conversations: DataFrame) -> DataFrame:
    """Damage ``conversations(conv_id, turn, role, text, ...)`` and repair them: one row a conversation."""
    return repaired(faults(damaged(conversations)))
