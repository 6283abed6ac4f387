import hashlib
import random
import re
import zlib
from itertools import product

import pytest

from chunkwise.llm.conversations import _START, cheapest, costs_of, damaged, repair, symbol, unroll

SHAPE = re.compile("(s?(ua)+)?")


def faults_of(rows):
    seen, out = set(), []
    for role, text in rows:
        visible = text.strip(" \t\n\x0b\x0c\r")
        fault = "blank" if not visible else "duplicate" if (role, text) in seen else "truncated" if visible[-1] not in ".!?" else ""
        seen.add((role, text))
        out.append(fault)
    return out


def plain_repair(rows):
    """(cost, audit, repaired rows): least cost, then least audit, by a walk over all prefixes."""
    faults = faults_of(rows)
    best = {(0, ""): (0, "", ())}  # roles' initials so far are told by the last one and whether there is any
    step = {"": "u", "s": "u", "u": "a", "a": "u"}
    layer = {"": (0, "", ())}

    def insert(layer):
        todo = dict(layer)
        for _ in range(3):
            for last, (cost, audit, out) in list(todo.items()):
                to = step[last]
                new = (cost + 5, audit + "I", (*out, ("user" if to == "u" else "assistant", "")))
                if to not in todo or new[:2] < todo[to][:2]:
                    todo[to] = new
        return todo

    del best
    for (role, text), fault in zip(rows, faults):
        new = {}

        def put(last, value, new=new):
            if last not in new or value[:2] < new[last][:2]:
                new[last] = value

        for last, (cost, audit, out) in insert(layer).items():
            put(last, (cost + 2, audit + "D", out))
            if fault in ("blank", "duplicate"):
                continue
            extra = 5 * (fault == "truncated")
            r = role[:1]
            if r and (r == "s" and last == "" or r == step[last]):
                put(r, (cost + extra, audit + "K", (*out, (role, text))))
            to = step[last]
            put(to, (cost + 1 + extra, audit + "R", (*out, ("user" if to == "u" else "assistant", text))))
        layer = new
    ends = [v for last, v in insert(layer).items() if last in ("", "a")]
    return min(ends, key=lambda v: v[:2])


def exhaustive(rows):
    """The same from every sequence of edits, judged by the pattern of the contract alone."""
    faults, best = faults_of(rows), None
    gap = [p for k in range(3) for p in product("ua", repeat=k)]
    for choice in product("DKua", repeat=len(rows)):
        for inserts in product(gap, repeat=len(rows) + 1):
            cost, audit, roles = 0, "", ""
            for k in range(len(rows) + 1):
                cost, audit, roles = cost + 5 * len(inserts[k]), audit + "I" * len(inserts[k]), roles + "".join(inserts[k])
                if k == len(rows):
                    break
                edit = choice[k]
                if edit == "D":
                    cost, audit = cost + 2, audit + "D"
                    continue
                if faults[k] in ("blank", "duplicate"):
                    cost = 1 << 30
                cost += 5 * (faults[k] == "truncated") + (edit in "ua")
                audit, roles = audit + ("K" if edit == "K" else "R"), roles + (rows[k][0][:1] or "?" if edit == "K" else edit)
            if SHAPE.fullmatch(roles) and (best is None or (cost, audit) < best):
                best = (cost, audit)
    return best


def some_rows(rng, n):
    roles = ["user", "user", "assistant", "assistant", "system", "tool", "", " "]
    texts = ["Yes.", "No!", "why", "", " \n", "Is it?", "go. \t"]
    return [(rng.choice(roles), rng.choice(texts)) for _ in range(n)]


def runs_of(rows):
    runs = []
    for (role, _), fault in zip(rows, faults_of(rows)):
        sym = symbol(role, fault == "truncated", fault in ("blank", "duplicate"))
        runs = [*runs[:-1], (sym, runs[-1][1] + 1)] if runs and runs[-1][0] == sym else [*runs, (sym, 1)]
    return runs


def test_every_sequence_of_edits():
    rng = random.Random(1)
    for n in (0, 1, 1, 1, 2, 2, 2, 2, 2, 2, 2, 2):
        rows = some_rows(rng, n)
        assert cheapest(tuple(runs_of(rows))) == exhaustive(rows) == plain_repair(rows)[:2]


def test_runs_against_the_plain_walk():
    rng = random.Random(2)
    for _ in range(3000):
        rows = some_rows(rng, rng.randint(0, 12))
        assert cheapest(tuple(runs_of(rows))) == plain_repair(rows)[:2], rows


def test_long_runs_by_powers():
    for sym in range(9):
        for n in (1, 2, 7, 64, 1000):
            cost = costs_of([(sym, n)])[_START]
            assert cost == costs_of([(sym, 1)] * n)[_START]
            assert unroll([(sym, n)], _START, (0, 10, 5, 0)) == unroll([(sym, 1)] * n, _START, (0, 10, 5, 0))


def plain_table(rows):
    """The contract, conversation by conversation. Rows of one turn go by role and text hash."""
    found = {}
    for conv, turn, role, text in rows:
        own = found.setdefault(conv, [])
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(key.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        role = "user" if kind == 4 else role
        own += [(turn, role, text)] * {0: 0, 3: 2}.get(kind, 1)
    out = {}
    for conv, own in found.items():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).digest()))
        pairs = [r[1:] for r in own]
        faults, (cost, audit, repaired) = faults_of(pairs), plain_repair(pairs)
        turns = [r[0] for r in own if r[0] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(pairs, pairs[1:]))
        digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in repaired).encode()).hexdigest()
        out[conv] = (gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit, digest)
    return out


COLUMNS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def check(spark, rows, **options):
    table = spark.createDataFrame([(*r, 1) for r in rows], "conv_id long, turn long, role string, text string, cost int")
    got = {r["conv_id"]: tuple(r[c] for c in COLUMNS) for r in repair(damaged(table), **options).collect()}
    want = plain_table(rows)
    assert got.keys() == want.keys()
    for conv in want:
        assert got[conv] == want[conv], conv


def test_a_table(spark):
    rng = random.Random(3)
    rows = []
    for conv in range(120):
        rows += [(conv, t, *r) for t, r in enumerate(some_rows(rng, rng.randint(1, 9)))]
    rows += [(None, t, *r) for t, r in enumerate(some_rows(rng, 6))] + [(500, None, *r) for r in some_rows(rng, 4)]
    rows += [(501, 3, "user", "Hi."), (501, 3, "user", "Hi."), (501, 9, None, None), (501, None, "assistant", None)]
    check(spark, rows)
    assert repair(damaged(spark.createDataFrame([], "conv_id long, turn long, role string, text string"))).count() == 0


@pytest.mark.parametrize("block_rows", [3, 4096])
def test_a_conversation_over_many_tasks(spark, block_rows):
    rng = random.Random(4)
    rows = [(7, t, *r) for t, r in enumerate([(a, f"{b} {rng.randint(0, 200)}{rng.choice('.?x')}") for a, b in some_rows(rng, 900)])]
    rows += [(7, t, "user", "The same.") for t in range(2000, 2300)] + [(8, None, "user", "again.")] * 200
    rows += [(c, t, *r) for c in (1, 9, 10) for t, r in enumerate(some_rows(rng, 5))]
    check(spark, rows, block_rows=block_rows)
    # a conversation that loses every row: its only turn's key hashes to a drop
    lost = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    check(spark, [(lost, 0, "user", "Hi.")])
