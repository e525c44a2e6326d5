"""Conversation structure repair: the cheapest edits after which roles read (system? (user assistant)+)?.

A row is kept (0), given another role (2) or deleted (3); a turn with empty text is inserted
before any row or at the end (2).  Blank rows and repeats can only be deleted, and a truncated
row that stays adds 1.  An automaton of four states (nothing, system, user, assistant yet)
reads the repaired roles, so that an audit, the edits' initials in order, says all: what an
insertion or a new role is follows from the state.

Hirschberg's divide and conquer finds the least audit (in ASCII order) of the cheapest in
space linear in the rows: costs from the front and costs to the end, vectors of four states,
meet at the middle row, the audit-least optimal state there is fixed, and both halves are
solved likewise.  Two audits that reach the middle row in different states differ before
either ends, so a rank for each state carries their order along with the costs, and no audit
is stored until a leaf of LEAF rows writes its part.

Rows become one byte each for that: whether a row is blank or truncated comes from its text,
whether it repeats an earlier one from an aggregation by role and digest.  Texts aren't held:
they are streamed once more, sorted, behind their conversation's audit, into the digest.  A
conversation's digest is sequential, so one conversation is one task's stream.

Cases: null role or text is a space, a null conv_id is a conversation of its own and reads as a
space in the damage's key, as does a null turn; rows go by turn (nulls first), then role, then
the SHA-256 of their text; an empty role has no initial, and like a role with an initial beside
s, u and a it can't be kept; repeated rows are rows; no rows give no conversations; further
columns are ignored.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterator, Sequence
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import _io

RENAME, REMOVE, ADD, CUT = 2, 3, 2, 1  # costs; CUT is of a truncated row that stays
NAMES = {"u": "user", "a": "assistant"}
LEAF = 32
FAR = 1 << 60

#: State after a role initial is read: 0 nothing, 1 s, 2 u, 3 a.
STEP = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
#: Cheapest letters, by state, that end an accepted sequence.
TAIL = ((0, ""), (2 * ADD, "II"), (ADD, "I"), (0, ""))
MUST_GO = 0


def code_of(initial: str, truncated: bool, must_go: bool) -> int:
    """A row as a byte: 0 has to go, else its initial and whether it is truncated."""
    return MUST_GO if must_go else 1 + 2 * ("sua".find(initial) if initial and initial in "sua" else 3) + truncated


def made(state: int) -> str:
    """What an insertion or a new role is in this state."""
    return "a" if state == 2 else "u"


def _row_edits(code: int) -> list[tuple[int, int, int, str]]:
    """(from, to, cost, letters) of a row with the insertions before it, the best for each two states."""
    best: dict[tuple[int, int], tuple[int, str]] = {}
    for start in range(4):
        state, cost, letters = start, 0, ""
        for _ in range(3):
            ways = [(state, REMOVE, "D")]
            if code != MUST_GO:
                initial, cut = "sua-"[(code - 1) // 2], CUT * ((code - 1) % 2)
                ways.append((STEP[state][made(state)], RENAME + cut, "R"))
                if initial in STEP[state]:
                    ways.append((STEP[state][initial], cut, "K"))
            for end, more, letter in ways:
                found = (cost + more, letters + letter)
                best[start, end] = min(best.get((start, end), found), found)
            state, cost, letters = STEP[state][made(state)], cost + ADD, letters + "I"
    return [(p, q, c, w) for (p, q), (c, w) in sorted(best.items())]


EDITS = [_row_edits(code) for code in range(9)]
_LETTERS = [{(p, q): w for p, q, _, w in edits} for edits in EDITS]

Front = tuple[list[int], list[int]]  # costs and ranks by state


def forward(codes: Sequence[int], low: int, high: int, state: int, back: list | None = None) -> Front:
    """Costs from state at low to each state at high, and the order of their audits; back gets what each row came from."""
    cost, rank = [FAR] * 4, [0] * 4
    cost[state] = 0
    for i in range(low, high):
        best: list[tuple | None] = [None] * 4
        for p, q, c, w in EDITS[codes[i]]:
            if cost[p] < FAR:
                found = (cost[p] + c, rank[p], w, p)
                if best[q] is None or found < best[q]:
                    best[q] = found
        order = sorted((b[1], b[2], q) for q, b in enumerate(best) if b)
        rank = [0] * 4
        for k, (_, _, q) in enumerate(order):
            rank[q] = k
        cost = [b[0] if b else FAR for b in best]
        if back is not None:
            back.append([b[3] if b else -1 for b in best])
    return cost, rank


def backward(codes: Sequence[int], low: int, high: int, state: int) -> list[int]:
    """Costs from each state at low to state at high."""
    cost = [FAR] * 4
    cost[state] = 0
    for i in range(high - 1, low - 1, -1):
        new = [FAR] * 4
        for p, q, c, _ in EDITS[codes[i]]:
            if cost[q] + c < new[p]:
                new[p] = cost[q] + c
        cost = new
    return cost


def _leaf(codes: Sequence[int], low: int, high: int, start: int, end: int) -> str:
    back: list[list[int]] = []
    forward(codes, low, high, start, back)
    out, q = [], end
    for i in range(high - 1, low - 1, -1):
        p = back[i - low][q]
        out.append(_LETTERS[codes[i]][p, q])
        q = p
    return "".join(reversed(out))


def _audit(codes: Sequence[int]) -> tuple[int, str]:
    cost, rank = forward(codes, 0, len(codes), 0)
    total, _, end = min((cost[q] + TAIL[q][0], rank[q], q) for q in range(4))
    out, todo = [], [(0, len(codes), 0, end)]
    while todo:
        low, high, start, to = todo.pop()
        if high - low <= LEAF:
            out.append(_leaf(codes, low, high, start, to))
            continue
        middle = (low + high) // 2
        front, ranks = forward(codes, low, middle, start)
        rear = backward(codes, middle, high, to)
        _, _, crossing = min((front[q] + rear[q], ranks[q], q) for q in range(4))
        todo += [(middle, high, crossing, to), (low, middle, start, crossing)]
    return total, "".join(out) + TAIL[end][1]


_short = lru_cache(maxsize=1 << 16)(lambda codes: _audit(codes))


def least_audit(codes: Sequence[int]) -> tuple[int, str]:
    """(cost, audit) of the cheapest edits, the audit-least among them."""
    return (0, "") if not len(codes) else _short(bytes(codes)) if len(codes) <= LEAF else _audit(codes)


def damage(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, times: rows as a hash of their place damages them; times is how often a row stands (0, 1 or 2)."""
    c = _io.keyed(conversations, "conv_id", "turn", "role", "text").select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"), F.coalesce(F.col("text").cast("string"), F.lit(" ")).alias("text"))
    name = lambda k: F.coalesce(F.col(k).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(name("conv_id"), F.lit(":"), name("turn")).cast("binary")) % 20
    text = F.when(kind == 1, F.lit("")).when(kind == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(kind == 4, F.lit("user")).otherwise(F.col("role"))
    return c.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).alias("times"))


def _digest(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


_FOUND = pa.schema([(k, pa.int64()) for k in ("conv_id", "n_rows", "gaps", "blank", "duplicate", "truncated", "illegal", "cost")] + [("audit", pa.string())])
COUNTS = _FOUND.names[1:-1]


def audit_conversations(rows: DataFrame) -> DataFrame:
    """conv_id, n_rows, gaps, blank, duplicate, truncated, illegal, cost, audit of each conversation; rows as damage returns them."""
    blank = ~F.col("text").rlike(r"[^\x20\x09-\x0D]")
    truncated = F.col("text").rlike(r"[^\x20\x09-\x0D.!?][\x20\x09-\x0D]*\z")
    thin = rows.select("conv_id", "turn", "role", _digest(F.col("text")).alias("d"), blank.alias("blank"), truncated.alias("cut"), "times")
    groups = thin.groupBy("conv_id", "turn", "role", "d", "blank", "cut").agg(F.sum("times").alias("n"))
    at = F.struct(F.col("turn").isNotNull(), F.col("turn"))
    first = groups.filter("n > 0").groupBy(F.col("conv_id").alias("_c"), F.col("role").alias("_r"), F.col("d").alias("_d")).agg(F.min(at).alias("_first"))
    own = groups.join(first, F.col("conv_id").eqNullSafe(F.col("_c")) & (F.col("role") == F.col("_r")) & (F.col("d") == F.col("_d")), "left")
    own = own.select("conv_id", "turn", "role", "d", "blank", "cut", "n", F.coalesce(at == F.col("_first"), F.lit(False)).alias("fresh"))
    fields = ["conv_id", "turn", "role", "blank", "cut", "n", "fresh"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own: list | None = None  # conv_id, codes, faults, illegal, turns (least, last, distinct), last initial
        out: list[tuple] = []

        def close() -> None:
            conv, codes, faults, illegal, (least, last, distinct), _ = own
            cost, audit = least_audit(codes)
            out.append((conv, len(codes), last - least + 1 - distinct if distinct else 0, *faults, illegal, cost, audit))

        for batch in batches:
            for conv, turn, role, is_blank, is_cut, n, fresh in zip(*(batch.column(k).to_pylist() for k in fields), strict=True):
                if own is None or own[0] != conv:
                    if own is not None:
                        close()
                    own = [conv, array("B"), [0, 0, 0], 0, (0, 0, 0), None]
                if not n:
                    continue
                initial, (least, last, distinct) = role[:1], own[4]
                if turn is not None:
                    own[4] = (turn, turn, 1) if not distinct else (least, turn, distinct + (turn != last))
                repeats = n if is_blank else n - fresh
                stays = n - repeats
                own[1].extend([code_of(initial, is_cut, False)] * stays)
                own[1].frombytes(bytes([MUST_GO]) * repeats)
                own[2][0 if is_blank else 1] += repeats
                own[2][2] += stays * is_cut
                own[3] += (own[5] is not None and own[5] + initial not in ("su", "ua", "au")) + (n - 1)  # no initial may follow itself
                own[5] = initial
            if len(out) >= 4096:
                yield _io.batch(_FOUND, *(list(c) for c in zip(*out, strict=True)))
                out = []
        if own is not None:
            close()
        if out:
            yield _io.batch(_FOUND, *(list(c) for c in zip(*out, strict=True)))

    return own.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "d").select(*fields).mapInArrow(run, _io.ddl(_FOUND))


def repaired(rows: Iterator[tuple[str, str]], audit: str) -> Iterator[tuple[str, str]]:
    """The rows (role, text) after an audit's edits."""
    state = 0
    for letter in audit:
        if letter == "I":
            role, text = NAMES[made(state)], ""
        else:
            role, text = next(rows)
            if letter == "D":
                continue
            if letter == "R":
                role = NAMES[made(state)]
        state = STEP[state][role[:1]]
        yield role, text


_REPAIRED = pa.schema([*_FOUND, pa.field("repaired_sha256", pa.string())])


def repair_conversations(rows: DataFrame) -> DataFrame:
    """audit_conversations with repaired_sha256, of the repaired role:text lines."""
    found = audit_conversations(rows)
    none = lambda kind: F.lit(None).cast(kind)
    heads = found.select("*", F.lit(0).alias("part"), none("long").alias("turn"), none("string").alias("role"), none("string").alias("text"), none("binary").alias("d"), F.lit(1).alias("times"))
    lines = rows.filter("times > 0").select("conv_id", *[none("long").alias(k) for k in COUNTS], none("string").alias("audit"), F.lit(1).alias("part"), "turn", "role", "text", _digest(F.col("text")).alias("d"), "times")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def entries() -> Iterator[tuple]:
            for batch in batches:
                yield from zip(*(batch.column(k).to_pylist() for k in [*_FOUND.names, "part", "role", "text", "times"]), strict=True)

        stream = entries()
        ahead, out = next(stream, None), []

        def own_rows() -> Iterator[tuple[str, str]]:
            nonlocal ahead
            while ahead is not None and ahead[-4]:
                role, text, times = ahead[-3:]
                ahead = next(stream, None)
                for _ in range(times):
                    yield role, text

        while ahead is not None:
            head = ahead[: len(_FOUND)]
            ahead = next(stream, None)
            digest, between, lines = hashlib.sha256(), b"", own_rows()
            for role, text in repaired(lines, head[-1]):
                digest.update(between + role.encode() + b":" + text.encode())
                between = b"\n"
            if next(lines, None) is not None:
                raise ValueError("an audit leaves rows")
            out.append((*head, digest.hexdigest()))
            if len(out) >= 4096:
                yield _io.batch(_REPAIRED, *(list(c) for c in zip(*out, strict=True)))
                out = []
        if out:
            yield _io.batch(_REPAIRED, *(list(c) for c in zip(*out, strict=True)))

    stream = heads.unionByName(lines).repartition("conv_id").sortWithinPartitions("conv_id", "part", "turn", "role", "d")
    return stream.select(*_FOUND.names, "part", "role", "text", "times").mapInArrow(run, _io.ddl(_REPAIRED))
