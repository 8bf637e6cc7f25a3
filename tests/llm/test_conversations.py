"""Conversation repair against exhaustive edits and a state-by-state minimum."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from strata.llm import conversations as conv

SCHEMA = "conv_id long, turn long, role string, text string, audit string, cost long, fault string, dropped boolean"
SPACE = " \t\n\x0b\x0c\r"


def states_minimum(rows):
    """Least (cost, audit, lines) by following all edits from state to state; any number of insertions."""
    def inserted(now):
        again = True
        while again:
            again = False
            for st, (cost, audit, lines) in list(now.items()):
                to, line = (3, "assistant:") if st == 2 else (2, "user:")
                new = (cost + 5, audit + "I", lines + [line])
                if to not in now or new < now[to]:
                    now[to], again = new, True
        return now

    now = inserted({0: (0, "", [])})
    for role, text, fault in rows:
        after = {}

        def put(st, value):
            after[st] = min(after.get(st, value), value)

        for st, (cost, audit, lines) in now.items():
            put(st, (cost + 2, audit + "D", lines))
            if fault in ("blank", "duplicate"):
                continue
            late = 5 if fault == "truncated" else 0
            if st == 0 and role[:1] == "s":
                put(1, (cost + late, audit + "K", lines + [f"{role}:{text}"]))
            letter, to, name = ("a", 3, "assistant") if st == 2 else ("u", 2, "user")
            if role[:1] == letter:
                put(to, (cost + late, audit + "K", lines + [f"{role}:{text}"]))
            put(to, (cost + late + 1, audit + "R", lines + [f"{name}:{text}"]))
        now = inserted(after)
    return min(v for st, v in now.items() if st in (0, 3))


def expected(rows):
    """The contract, row by row: (conv_id, turn, role, text, ...) to {conv_id: result}."""
    groups = defaultdict(list)
    for conv_id, turn, role, text, *_ in rows:
        groups[conv_id]
        name = " " if conv_id is None else conv_id
        kind = zlib.crc32(f"{name}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if kind == 1 else "".join(c for c in text if c not in ".!?") if kind == 2 else text
        groups[conv_id] += [(turn, "user" if kind == 4 else role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    out = {}
    for conv_id, turns in groups.items():
        turns.sort(key=lambda t: (t[0] is not None, t[0] or 0, t[1].encode(), t[2].encode()))
        seen, marked = set(), []
        for _, role, text in turns:
            bare = text.strip(SPACE)
            fault = ("blank" if not bare else "duplicate" if (role, text) in seen
                     else "truncated" if bare[-1] not in ".!?" else "")
            seen.add((role, text))
            marked.append((role, text, fault))
        known = [t[0] for t in turns if t[0] is not None]
        cost, audit, lines = states_minimum(marked)
        out[conv_id] = (
            max(known) - min(known) + 1 - len(set(known)) if known else 0,
            *[sum(f == kind for _, _, f in marked) for kind in ("blank", "duplicate", "truncated")],
            sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(marked, marked[1:])),
            cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def check(spark, rows):
    df = spark.createDataFrame([(*r, "x", 1, "f", False) for r in rows], SCHEMA)
    found = conv.repair(df).collect()
    assert {r[0]: tuple(r[1:]) for r in found} == expected(rows)
    assert len(found) == len({r[0] for r in rows})


def random_rows(n, seed):
    rng = random.Random(seed)
    roles = ["system", "user", "user", "assistant", "assistant", "tool", "", None, "User"]
    texts = ["Yes.", "No", "", " \t", None, "why?", "Go on!", "é.\n", "a. b"]
    rows = []
    for conv_id in [*range(n), None]:
        for turn in range(rng.randrange(0, 14)):
            rows.append((conv_id, rng.choice([turn, turn, turn, turn + 3, None]), rng.choice(roles), rng.choice(texts)))
    return rows + rows[:5]


def test_nulls_ties_repeats_and_odd_roles(spark):
    check(spark, random_rows(250, 1))


def test_long_text_and_long_conversation(spark):
    rng = random.Random(2)
    long = [(7, t, rng.choice(["user", "assistant"]), f"turn {t}" + rng.choice([".", ".", ""])) for t in range(700)]
    check(spark, [*long, (8, 0, "user", "x" * 300_000 + "."), (8, 1, "assistant", " " * 50_000)])


def test_empty_table(spark):
    assert conv.repair(spark.createDataFrame([], SCHEMA)).count() == 0


@pytest.mark.parametrize("block", [1, 3, 1000])
def test_blocks_chain_to_the_same_audit(monkeypatch, block):
    monkeypatch.setattr(conv, "BLOCK", block)
    rng = random.Random(block)
    for _ in range(250):
        rows = [(rng.choice(["system", "user", "assistant", "x"]), str(i),
                 rng.choice(["", "", "", "truncated", "blank", "duplicate"])) for i in range(rng.randrange(0, 24))]
        one = conv._Conversation()
        for i, row in enumerate(rows):
            one.add(i, *row)
        cost, audit, lines = states_minimum(rows)
        assert one.result(1)[6:] == (cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())
