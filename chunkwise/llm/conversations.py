"""Repair of the turn structure of conversations (operator 11).

A row of a conversation is one of nine symbols: its role's initial (s, u, a or
another) with or without a truncated text, or "must go" (blank, or role and text
seen earlier). The cheapest edits that give ``(s?(ua)+)?`` are a walk over four
states (start, after s, after u, after a); one row's costs are a 4 x 4 min-plus
matrix. Equal consecutive symbols are collapsed to runs, and a run of n rows is
passed by the binary powers of its matrix, which are kept. The cost to the end is
then known at the border of every run, and the audit is unrolled from the front:
each edit letter leads to one state, so taking the first letter in ASCII order
that stays on a cheapest walk gives the least audit of all.

On Spark: equal rows (conversation, turn, role, text) are counted and the first
occurrence of each text is found by aggregates, so a hot text is one row; later
repeats carry no text. The rows are range-partitioned on conversation and order,
so a hot conversation lies in many tasks. A conversation inside one task is
finished there. One that crosses a border, or is long, is written as blocks of at
most ``_BLOCK`` rows, each with its min-plus matrix and the ASCII order of its
best audits for each way through. Short heads of the blocks meet by conversation
and choose the way; every block is then unrolled on its own. Only the last step,
whose results are one audit and one hash, reads a conversation's blocks in turn,
as a stream.

Defined results: null roles and texts are one space, nulls in the damage key
too; null conversation ids are one conversation; null turns come first; rows of
one turn follow by role, then by the text's hash. A role whose first letter isn't
s, u or a, or which is empty, can't be kept. Repeated rows are duplicates. A
conversation that lost all rows gives zeros, an empty audit and the hash of the
empty string. An empty table gives an empty result. Extra columns are never read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chunkwise.config import materialize

from .common import short_batches

# Fixed values of the task: costs of edits, the roles that edits give, ASCII order of edits.
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
USER, ASSISTANT = "user", "assistant"
_BLANKS = " \t\n\x0b\x0c\r"

_START, _S, _U, _A = range(4)
_NEXT = (_U, _U, _A, _U)  # where an inserted or re-roled row leads
_END = (0, 2 * INSERT, INSERT, 0)  # cost of inserts after the last row
_FAR = 1 << 60
_MUST_GO = 8
_BLOCK = 4096  # rows of a block
_BLOCK_CHARS = 4 << 20  # characters of a block, but for its last row

Vector = tuple[int, ...]
Matrix = tuple[Vector, ...]


def symbol(role: str, truncated: bool, must_go: bool) -> int:
    return _MUST_GO if must_go else "sua".find(role[0]) % 4 + 4 * truncated if role else 3 + 4 * truncated


def _edits(sym: int) -> tuple[dict[str, tuple[int, int]], ...]:
    """For each state: letter -> (cost, next state) of the edits that use up the row."""
    out = []
    for state in range(4):
        ways = {"D": (DELETE, state)}
        if sym != _MUST_GO:
            role, extra = sym % 4, TRUNCATED * (sym >= 4)
            kept = {0: _S if state == _START else None, 1: _U if state != _U else None, 2: _A if state == _U else None}.get(role)
            if kept is not None:
                ways["K"] = (extra, kept)
            ways["R"] = (REROLE + extra, _NEXT[state])
        out.append(ways)
    return tuple(out)


_EDITS = tuple(_edits(s) for s in range(9))


def _times(a: Matrix, b: Matrix) -> Matrix:
    return tuple(tuple(min(_FAR, *(a[x][k] + b[k][y] for k in range(4))) for y in range(4)) for x in range(4))


def _apply(a: Matrix, v: Vector) -> Vector:
    return tuple(min(a[x][y] + v[y] for y in range(4)) for x in range(4))


def _row_matrix(sym: int) -> Matrix:
    """Costs of one row, with inserts before it."""
    rows = []
    for state in range(4):
        costs, at = [_FAR] * 4, state
        for inserts in range(3):
            for cost, to in _EDITS[sym][at].values():
                costs[to] = min(costs[to], cost + INSERT * inserts)
            at = _NEXT[at]
        rows.append(tuple(costs))
    return tuple(rows)


@lru_cache(maxsize=None)  # 9 symbols and at most 63 powers
def _power(sym: int, j: int) -> Matrix:
    return _row_matrix(sym) if j == 0 else _times(_power(sym, j - 1), _power(sym, j - 1))


def _before(sym: int, n: int, v: Vector) -> Vector:
    """Costs to the end before a run of ``n`` rows, given those after it."""
    for j in range(n.bit_length()):
        if n >> j & 1:
            v = _apply(_power(sym, j), v)
    return tuple(min(x, _FAR) for x in v)


def _unroll_run(sym: int, n: int, state: int, after: Vector) -> tuple[str, int]:
    """The least cheapest audit of a run from ``state``, and the state behind it."""
    if sym == _MUST_GO:  # an insert before such a row costs as much behind it
        return "D" * n, state
    return (_short_run if n <= 16 else _short_run.__wrapped__)(sym, n, state, after)


@lru_cache(maxsize=20_000)
def _short_run(sym: int, n: int, state: int, after: Vector) -> tuple[str, int]:
    costs = [after]
    for _ in range(n - 1):
        costs.append(_apply(_power(sym, 0), costs[-1]))
    letters = []
    for v in reversed(costs):  # v: costs to the end after the row
        ways = _EDITS[sym]
        left = _apply(_power(sym, 0), v)
        while True:
            found = [(letter, to) for letter, (cost, to) in ways[state].items() if cost + v[to] == left[state]]
            if INSERT + left[_NEXT[state]] == left[state]:
                found.append(("I", _NEXT[state]))
            letter, state = min(found)
            letters.append(letter)
            if letter != "I":
                break
    return "".join(letters), state


Runs = list[tuple[int, int]]


def unroll(runs: Runs, state: int, end: Vector) -> tuple[str, int]:
    """Audit of the runs from ``state`` (without inserts after the last row), and the last state."""
    after = [end]
    for sym, n in reversed(runs[1:]):
        after.append(_before(sym, n, after[-1]))
    parts = []
    for (sym, n), v in zip(runs, reversed(after), strict=True) if runs else ():
        least = min(v)
        part, state = _unroll_run(sym, n, state, tuple(min(x - least, _FAR) for x in v))
        parts.append(part)
    return "".join(parts), state


def costs_of(runs: Runs, end: Vector = _END) -> Vector:
    for sym, n in reversed(runs):
        end = _before(sym, n, end)
    return end


def trailing(state: int) -> str:
    return "I" * (_END[state] // INSERT)


@lru_cache(maxsize=50_000)
def cheapest(runs: tuple[tuple[int, int], ...]) -> tuple[int, str]:
    """Cost and least audit of a whole conversation."""
    audit, state = unroll(list(runs), _START, _END)
    return costs_of(list(runs))[_START], audit + trailing(state)


def block_ways(runs: Runs) -> tuple[list[int], list[int]]:
    """For a block: the cost from each state to each (16 numbers), and for each pair of
    states the rank of its best audit among those from the same state (-1: no way)."""
    costs, ranks = [[0] * 4 for _ in range(4)], [[-1] * 4 for _ in range(4)]
    audits: list[list[tuple[str, int]]] = [[] for _ in range(4)]
    for to in range(4):
        end = tuple(0 if s == to else _FAR for s in range(4))
        cost = costs_of(runs, end)
        for start in range(4):
            costs[start][to] = cost[start]
            if cost[start] < _FAR:
                audits[start].append((unroll(runs, start, end)[0], to))
    for start in range(4):
        for rank, (_, to) in enumerate(sorted(audits[start])):
            ranks[start][to] = rank
    return sum(costs, []), sum(ranks, [])


def lines_of(audit: str, state: int, kept: Iterator[tuple[str, str]], must_go: Iterator[bool]) -> Iterator[str]:
    """The repaired ``role:text`` lines. ``kept``: role and text of rows that needn't go."""
    for letter in audit:
        if letter == "I":
            state = _NEXT[state]
            yield f"{USER if state == _U else ASSISTANT}:"
            continue
        if next(must_go):
            continue
        role, text = next(kept)
        if letter == "K":
            state = "sua".find(role[0]) + 1
            yield f"{role}:{text}"
        elif letter == "R":
            state = _NEXT[state]
            yield f"{USER if state == _U else ASSISTANT}:{text}"


class Block:
    """Consecutive rows of one conversation, in order."""

    def __init__(self):
        self.symbols: list[int] = []
        self.counts: list[int] = []
        self.roles: list[str] = []
        self.texts: list[str] = []
        self.rows = self.chars = self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.first_role: str | None = None
        self.last_role: str | None = None
        self.first_turn: int | None = None
        self.last_turn: int | None = None

    def add(self, turn: int | None, role: str, n: int, first: bool, blank: bool, truncated: bool, text: str | None) -> None:
        """``n`` equal rows; ``first``: their role and text weren't seen earlier."""
        must_go = n if blank else n - first
        self.blank += n * blank
        self.duplicate += must_go * (not blank)
        if must_go < n:
            self.truncated += truncated
            self._symbol(symbol(role, truncated, False), 1)
            self.roles.append(role)
            self.texts.append(text)
            self.chars += len(text)
        if must_go:
            self._symbol(_MUST_GO, must_go)
        if self.rows:
            self.illegal += not legal(self.last_role, role)
        else:
            self.first_role = role[:1]
        self.illegal += (n - 1) * (not legal(role[:1], role))
        self.last_role = role[:1]
        self.rows += n
        if turn is not None:
            self.turns += turn != self.last_turn
            self.first_turn = turn if self.first_turn is None else self.first_turn
            self.last_turn = turn

    def _symbol(self, sym: int, n: int) -> None:
        if self.symbols and self.symbols[-1] == sym:
            self.counts[-1] += n
        else:
            self.symbols.append(sym)
            self.counts.append(n)

    @property
    def runs(self) -> Runs:
        return list(zip(self.symbols, self.counts, strict=True))


def legal(before: str, role: str) -> bool:
    return before + role[:1] in ("su", "ua", "au")


def must_go_of(runs: Iterable[tuple[int, int]]) -> Iterator[bool]:
    for sym, n in runs:
        for _ in range(n):
            yield sym == _MUST_GO


_RESULT = "gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint"
_HEAD = "`rows` bigint, turns bigint, first_role string, last_role string, first_turn bigint, last_turn bigint, costs array<bigint>, ranks array<int>"
_BODY = "symbols array<int>, counts array<bigint>, roles array<string>, texts array<string>"
_NUMBERS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def _arrow(name: str, kind: str) -> pa.Field:
    types = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string(), "boolean": pa.bool_()}
    return pa.field(name, pa.list_(types[kind[6:-1]]) if kind.startswith("array") else types[kind])


def _schema(ddl: str, id_type: pa.DataType) -> pa.Schema:
    return pa.schema([pa.field("conv_id", id_type), *(_arrow(*f.strip().replace("`", "").split(" ")) for f in ddl.split(",") if f.strip())])


def _whole_row(conv: object, b: Block) -> dict:
    cost, audit = cheapest(tuple(b.runs))
    lines = "\n".join(lines_of(audit, _START, zip(b.roles, b.texts, strict=True), must_go_of(b.runs)))
    gaps = 0 if b.first_turn is None else b.last_turn - b.first_turn + 1 - b.turns
    numbers = dict(zip(_NUMBERS, (gaps, b.blank, b.duplicate, b.truncated, b.illegal, cost), strict=True))
    return {"conv_id": conv, "whole": True, **numbers, "audit": audit, "repaired_sha256": hashlib.sha256(lines.encode()).hexdigest()}


def _block_row(conv: object, part: int, seq: int, b: Block) -> dict:
    costs, ranks = block_ways(b.runs)
    own = {c: getattr(b, c) for c in ("blank", "duplicate", "truncated", "illegal", "rows", "turns", "first_role", "last_role", "first_turn", "last_turn", "symbols", "counts", "roles", "texts")}
    return {"conv_id": conv, "whole": False, "part": part, "seq": seq, **own, "costs": costs, "ranks": ranks}


def _walk(batches: Iterable[pa.RecordBatch], block_rows: int) -> Iterator[tuple[pa.DataType, dict]]:
    """Rows of one task, in order, to whole conversations and blocks of open ones. The first
    and the last conversation of a task are open: their other rows may lie elsewhere."""
    current = first = object()
    block, open_, seq, part, text_of, id_type = Block(), True, 0, 0, None, pa.null()
    for batch in batches:
        id_type = batch.schema.field("conv_id").type
        columns = (batch.column(c).to_pylist() for c in ("conv_id", "turn", "role", "digest", "kind", "n", "blank", "truncated", "text", "part"))
        for conv, turn, role, digest, kind, n, blank, truncated, text, part in zip(*columns, strict=True):  # one part a task
            if current is first or conv != current:
                if current is not first:
                    yield id_type, (_block_row(current, part, seq, block) if open_ else _whole_row(current, block))
                    seq += 1
                    open_ = False
                block, current, text_of = Block(), conv, None
            if kind == 0:
                text_of = (turn, role, digest), text
                continue
            if n:
                is_first = text_of is not None and text_of[0] == (turn, role, digest)
                block.add(turn, role, n, is_first, blank, truncated, text_of[1] if is_first else None)
                text_of = None
            if max(len(block.symbols), len(block.roles)) >= block_rows or block.chars >= _BLOCK_CHARS:
                yield id_type, _block_row(conv, part, seq, block)
                block, open_ = Block(), True
                seq += 1
    if current is not first:
        yield id_type, _block_row(current, part, seq, block)


def _batched(rows: Iterator[tuple[pa.DataType, dict]], ddl: str, most: int = 500) -> Iterator[pa.RecordBatch]:
    kept, kind, size = [], pa.null(), 0
    for kind, row in rows:
        kept.append(row)
        size += 1 + len(row.get("texts") or ()) // 64
        if size >= most:
            yield pa.RecordBatch.from_pylist(kept, _schema(ddl, kind))
            kept, size = [], 0
    if kept:
        yield pa.RecordBatch.from_pylist(kept, _schema(ddl, kind))


def damaged(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, copies): the planted damage; a dropped row has 0 copies."""
    text_of = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(text_of("conv_id"), F.lit(":"), text_of("turn")).cast("binary")) % 20
    text = F.when(kind == 1, F.lit("")).when(kind == 2, F.translate(text_of("text"), ".!?", "")).otherwise(text_of("text"))
    role = F.when(kind == 4, F.lit(USER)).otherwise(text_of("role"))
    copies = F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1)
    return rows.select("conv_id", F.col("turn").cast("bigint").alias("turn"), role.alias("role"), text.alias("text"), copies.alias("copies"))


def _in_order(rows: DataFrame) -> DataFrame:
    """The rows, counted and marked, in order over range partitions. ``kind`` 0 holds the text
    of a first occurrence, ``kind`` 1 the number of equal rows."""
    seen = F.rtrim("text", F.lit(_BLANKS))
    marked = rows.withColumns(
        {"digest": F.unhex(F.sha2(F.col("text").cast("binary"), 256)), "blank": seen == "", "truncated": ~F.substring(seen, -1, 1).isin(".", "!", "?")}
    )
    counted = marked.groupBy("conv_id", "turn", "role", "digest", "blank", "truncated").agg(F.sum("copies").alias("n"))
    counted = counted.select("conv_id", "turn", "role", "digest", F.lit(1).alias("kind"), "n", "blank", "truncated", F.lit(None).cast("string").alias("text"))
    # a blank row must go: its text is never needed
    firsts = marked.where((F.col("copies") > 0) & ~F.col("blank")).groupBy("conv_id", "role", "digest", "text")
    firsts = firsts.agg(F.min(F.struct(F.col("turn").isNotNull().alias("later"), F.col("turn").alias("turn"))).alias("m"))
    none = F.lit(None)
    firsts = firsts.select("conv_id", "m.turn", "role", "digest", F.lit(0).alias("kind"), none.cast("bigint").alias("n"), none.cast("boolean").alias("blank"), none.cast("boolean").alias("truncated"), "text")
    keys = ["conv_id", "turn", "role", "digest", "kind"]
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = counted.unionByName(firsts).repartitionByRange(parts, *keys[:-1]).sortWithinPartitions(*keys)
    return order.withColumn("part", F.spark_partition_id())


def _choose_ways(heads: pa.Table) -> pa.Table:
    """One conversation's heads to the states before and after each block, and its numbers."""
    rows = sorted(heads.to_pylist(), key=lambda r: (r["part"], r["seq"]))
    after = [_END]
    for r in reversed(rows):
        matrix = tuple(tuple(r["costs"][4 * x : 4 * x + 4]) for x in range(4))
        after.append(tuple(min(c, _FAR) for c in _apply(matrix, after[-1])))
    after.reverse()
    state, out = _START, []
    for r, here, there in zip(rows, after[:-1], after[1:], strict=True):
        ways = [(r["ranks"][4 * state + to], to) for to in range(4) if r["ranks"][4 * state + to] >= 0 and r["costs"][4 * state + to] + there[to] == here[state]]
        to = min(ways)[1]
        out.append({"conv_id": r["conv_id"], "part": r["part"], "seq": r["seq"], "enter": state, "leave": to, "tail": ""})
        state = to
    full = [r for r in rows if r["rows"]]
    if full:
        out[-1]["tail"] = trailing(state)
    turned = [r for r in full if r["turns"]]
    turns = sum(r["turns"] for r in turned) - sum(a["last_turn"] == b["first_turn"] for a, b in zip(turned, turned[1:]))
    numbers = {c: sum(r[c] for r in full) for c in ("blank", "duplicate", "truncated", "illegal")}
    numbers["illegal"] += sum(not legal(a["last_role"], b["first_role"]) for a, b in zip(full, full[1:]))
    numbers |= {"gaps": turned[-1]["last_turn"] - turned[0]["first_turn"] + 1 - turns if turned else 0, "cost": after[0][_START] if full else 0}
    schema = _schema(f"part int, seq bigint, enter int, leave int, tail string, {_RESULT}", heads.schema.field("conv_id").type)
    return pa.Table.from_pylist([o | numbers for o in out], schema)


def _unroll_blocks(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each block's piece of the audit and its lines."""
    for batch in batches:
        schema = _schema(f"part int, seq bigint, piece string, lines array<string>, {_RESULT}", batch.schema.field("conv_id").type)
        out = []
        for r in batch.to_pylist():
            runs = list(zip(r["symbols"], r["counts"], strict=True))
            end = tuple(0 if s == r["leave"] else _FAR for s in range(4))
            piece = unroll(runs, r["enter"], end)[0] + r["tail"]
            lines = list(lines_of(piece, r["enter"], zip(r["roles"], r["texts"], strict=True), must_go_of(runs)))
            out.append({c: r[c] for c in ("conv_id", "part", "seq", *_NUMBERS)} | {"piece": piece, "lines": lines})
        yield pa.RecordBatch.from_pylist(out, schema)


def _join_blocks(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks in order, as a stream, to one row a conversation."""

    def rows() -> Iterator[tuple[pa.DataType, dict]]:
        for batch in batches:
            kind = batch.schema.field("conv_id").type
            for k in range(batch.num_rows):
                yield kind, batch.slice(k, 1).to_pylist()[0]

    def joined() -> Iterator[tuple[pa.DataType, dict]]:
        for conv, blocks in groupby(rows(), key=lambda x: x[1]["conv_id"]):
            digest, any_line, pieces = hashlib.sha256(), False, []
            for kind, r in blocks:  # noqa: B007
                pieces.append(r["piece"])
                for line in r["lines"]:
                    digest.update(("\n" * any_line + line).encode())
                    any_line = True
            yield kind, {"conv_id": conv, **{c: r[c] for c in _NUMBERS}, "audit": "".join(pieces), "repaired_sha256": digest.hexdigest()}

    yield from _batched(joined(), f"{_RESULT}, audit string, repaired_sha256 string")


def repair(rows: DataFrame, block_rows: int = _BLOCK) -> DataFrame:
    """Per conversation of (conv_id, turn, role, text, copies): conv_id, gaps, blank, duplicate,
    truncated, illegal, cost, audit, repaired_sha256."""
    short_batches(rows.sparkSession)
    kind = rows.schema["conv_id"].dataType.simpleString()
    walked = f"whole boolean, part int, seq bigint, {_RESULT}, audit string, repaired_sha256 string, {_HEAD}, {_BODY}"

    def walk(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _batched(_walk(batches, block_rows), walked)

    found = materialize(_in_order(rows).mapInArrow(walk, f"conv_id {kind}, {walked}"), "conversations")
    result = ["conv_id", *_NUMBERS, "audit", "repaired_sha256"]
    blocks = found.where(~F.col("whole"))
    heads = blocks.drop("symbols", "counts", "roles", "texts", "audit", "repaired_sha256", "whole", "gaps", "cost")
    ways = heads.groupBy("conv_id").applyInArrow(_choose_ways, f"conv_id {kind}, part int, seq bigint, enter int, leave int, tail string, {_RESULT}")
    body = blocks.select("part", "seq", "symbols", "counts", "roles", "texts").join(ways, ["part", "seq"])
    pieces = body.mapInArrow(_unroll_blocks, f"conv_id {kind}, part int, seq bigint, piece string, lines array<string>, {_RESULT}")
    pieces = pieces.repartition(F.col("conv_id")).sortWithinPartitions("conv_id", "part", "seq")
    joined = pieces.mapInArrow(_join_blocks, f"conv_id {kind}, {_RESULT}, audit string, repaired_sha256 string")
    return found.where("whole").select(result).unionByName(joined.select(result))
