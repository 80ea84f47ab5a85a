"""Repair of conversation structure: the cheapest edits by a run-length dynamic program over role and fault symbols."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import drop_kept

BLANKS = " \t\n\x0b\x0c\r"
DELETE, INSERT, REROLE, TRUNCATED = 4, 3, 3, 3
#: States of what has been given out: nothing, s, (s)(ua)*u, (s)(ua)+. Nothing and the last may end.
START, SYSTEM, USER, WHOLE = range(4)
NEVER = 1 << 60
END = (0, NEVER, NEVER, 0)
#: The state after a user or assistant turn, given out by insertion or a new role, and its role.
TURN = {START: (USER, "user"), SYSTEM: (USER, "user"), USER: (WHOLE, "assistant"), WHOLE: (USER, "user")}
#: The state after a kept turn, by its role's initial.
KEEP = {"s": {START: SYSTEM}, "u": {START: USER, SYSTEM: USER, WHOLE: USER}, "a": {USER: WHOLE}}

Vector = tuple[int, int, int, int]
Matrix = tuple[Vector, Vector, Vector, Vector]


def times(a: Matrix, b: Matrix) -> Matrix:
    """The min-plus product."""
    return tuple(tuple(min(NEVER, *(r[k] + b[k][j] for k in range(4))) for j in range(4)) for r in a)


def applied(a: Matrix, v: Vector) -> Vector:
    return tuple(min(NEVER, r[0] + v[0], r[1] + v[1], r[2] + v[2], r[3] + v[3]) for r in a)


def inserts() -> Matrix:
    """The least cost from state to state by insertions alone; three are as many as it ever takes."""
    one = tuple(tuple(0 if i == j else INSERT if TURN[i][0] == j else NEVER for j in range(4)) for i in range(4))
    return times(one, times(one, one))


INSERTS = inserts()


@cache
def power(symbol: str, j: int) -> Matrix:
    """The transition of 2**j equal rows: insertions before a row, then its deletion, keeping or new role.

    A symbol is the role's initial (o for others) and the fault: - none, t truncated, x blank or duplicate."""
    if j:
        half = power(symbol, j - 1)
        return times(half, half)
    role, fault = symbol
    more = TRUNCATED if fault == "t" else 0
    row = [[DELETE if i == k else NEVER for k in range(4)] for i in range(4)]
    if fault != "x":
        for i in range(4):
            to = TURN[i][0]
            row[i][to] = min(row[i][to], REROLE + more)
            if (to := KEEP.get(role, {}).get(i)) is not None:
                row[i][to] = min(row[i][to], more)
    return times(INSERTS, tuple(map(tuple, row)))


def before(symbol: str, n: int, after: Vector) -> Vector:
    """Costs to go before n equal rows, from those after them."""
    j = 0
    while n:
        if n & 1:
            after = applied(power(symbol, j), after)
        n, j = n >> 1, j + 1
    return after


def least_edits(runs: list[tuple[str, int]]) -> tuple[int, str]:
    """(cost, audit): the cheapest edits of a conversation given as runs (symbol, rows); of those the least in ASCII.

    Backwards over runs by powers of their transitions; then forwards, in each state and row the first of D, I, K, R
    that is on a cheapest way. A row's edit depends only on costs to go, so the choice of the first letter is final."""
    after = [applied(INSERTS, END)]
    for symbol, n in reversed(runs):
        after.append(before(symbol, n, after[-1]))
    after.reverse()
    state, out = START, []
    for k, (symbol, n) in enumerate(runs):
        state = unroll(symbol, n, after[k + 1], state, out)
    while state not in (START, WHOLE):
        out.append("I")
        state = TURN[state][0]
    return after[0][START], "".join(out)


def unroll(symbol: str, n: int, after: Vector, state: int, out: list[str]) -> int:
    """Append the letters of n equal rows and return the state behind them. Long runs are halved by powers, so that few
    vectors are held at a time."""
    if n > 32:
        state = unroll(symbol, n - n // 2, before(symbol, n // 2, after), state, out)
        return unroll(symbol, n // 2, after, state, out)
    to_go = [after]
    for _ in range(n):
        to_go.append(applied(power(symbol, 0), to_go[-1]))
    role, fault = symbol
    more = TRUNCATED if fault == "t" else 0
    for left in range(n, 0, -1):
        rest = to_go[left - 1]
        while True:
            here, (turned, _) = to_go[left][state], TURN[state]
            if DELETE + rest[state] == here:
                out.append("D")
            elif INSERT + to_go[left][turned] == here:
                out.append("I")
                state = turned
                continue
            elif fault != "x" and (kept := KEEP.get(role, {}).get(state)) is not None and more + rest[kept] == here:
                out.append("K")
                state = kept
            else:
                out.append("R")
                state = turned
            break
    return state


# --- conversations -----------------------------------------------------------------------------------------------


def with_symbols(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, h1, h2, initial, fault) of rows (conv_id, turn, role, text) without their texts."""
    blank = F.rtrim("text", F.lit(BLANKS)) == ""
    cut = ~F.right(F.rtrim("text", F.lit(BLANKS)), F.lit(1)).isin(".", "!", "?")
    initial = F.left("role", F.lit(1))
    fault = F.when(blank, "b").when(cut, "t").otherwise("-")
    return rows.select("conv_id", "turn", "role", *digest(), initial.alias("initial"), fault.alias("fault"))


def digest(role: str = "role", text: str = "text") -> list[Column]:
    """128 bits of a turn's role and text, as h1 and h2."""
    return [F.xxhash64(role, text).alias("h1"), F.xxhash64(F.lit(11), role, text).alias("h2")]


#: Rows of a conversation in order: the head of the conversation first; ties of a turn by role and digest.
ORDER = ["conv_id", "kind", "turn", "role", "h1", "h2"]
FOUND = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"


class Conversation:
    """What is held of a conversation while its rows are streamed: runs of symbols, counts, digests seen."""

    def __init__(self, conv_id: int | None):
        self.conv_id, self.runs, self.seen = conv_id, [], set()
        self.faults = {"b": 0, "d": 0, "t": 0, "-": 0}
        self.illegal, self.initial, self.low, self.high, self.turns = 0, None, None, None, 0

    def add(self, turn: int | None, key: tuple[int, int], initial: str, fault: str) -> None:
        if fault != "b" and key in self.seen:
            fault = "d"
        self.seen.add(key)
        self.faults[fault] += 1
        self.illegal += self.initial is not None and self.initial + initial not in ("su", "ua", "au")
        self.initial = initial
        if turn is not None and turn != self.high:
            self.low, self.high, self.turns = turn if self.low is None else self.low, turn, self.turns + 1
        symbol = (initial if initial in ("s", "u", "a") else "o") + {"b": "x", "d": "x"}.get(fault, fault)
        if self.runs and self.runs[-1][0] == symbol:
            self.runs[-1][1] += 1
        else:
            self.runs.append([symbol, 1])

    def result(self) -> dict:
        cost, audit = least_edits(self.runs)
        gaps = self.high - self.low + 1 - self.turns if self.turns else 0
        f = self.faults
        return {"conv_id": self.conv_id, "gaps": gaps, "blank": f["b"], "duplicate": f["d"], "truncated": f["t"], "illegal": self.illegal, "cost": cost, "audit": audit}


def with_heads(rows: DataFrame, heads: DataFrame) -> DataFrame:
    """Rows of a conversation together and in order behind a head row (kind 0) for it, which comes even without rows."""
    both = heads.withColumn("kind", F.lit(0)).unionByName(rows.withColumn("kind", F.lit(1)), allowMissingColumns=True)
    return both.repartition("conv_id").sortWithinPartitions(*ORDER)


def judge_conversations(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit for each conv_id of ids (one row each).

    rows: conv_id, turn, role, text, none null but conv_id and turn. In a conversation rows go by turn (null first),
    then role, then digest. A row's first fault counts: blank, duplicate (the same role and text before), truncated.
    audit has the edits' initials. Rows of conversations that ids doesn't have are left out; a null conv_id is one
    conversation. Conversations without rows: zeros, empty audit. Texts aren't moved; a conversation's rows are
    streamed, of which runs, counts and 16 bytes a row are held, and its audit, a letter an edit."""

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_kept()
        now: Conversation | None = None
        schema = pa.schema([(n, pa.string() if n == "audit" else pa.int64()) for n in (x.split()[0] for x in FOUND.split(", "))])
        for b in batches:
            done = []
            for conv, kind, turn, h1, h2, initial, fault in zip(*(b[n].to_pylist() for n in ("conv_id", "kind", "turn", "h1", "h2", "initial", "fault")), strict=True):
                if kind == 0:
                    done += [now.result()] if now else []
                    now = Conversation(conv)
                elif now and now.conv_id == conv:
                    now.add(turn, (h1, h2), initial, fault)
            yield pa.RecordBatch.from_pylist(done, schema)
        if now:
            yield pa.RecordBatch.from_pylist([now.result()], schema)

    return with_heads(with_symbols(rows), ids.select("conv_id").distinct()).mapInArrow(stream, FOUND)


def repaired_turns(rows: DataFrame, judged: DataFrame, digest_only: bool = False) -> DataFrame:
    """(conv_id, at, edit, role, text): the repaired turns of each conversation, numbered from 0, with the edit that
    made them (K, R or I); deleted rows are left out.

    With digest_only one row per conversation instead: conv_id, repaired_sha256 of its `role:text` joined by line
    feeds. Each audit goes ahead of its conversation's rows, which are streamed; no conversation is held whole. Give
    the rows that were judged."""
    held = rows.select("conv_id", "turn", "role", "text", *digest())

    def edited(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        """(conv_id, None, None, None) for a head, else (conv_id, edit, role, text)."""
        conv, audit, i, state, known = None, "", 0, START, False

        def inserted() -> Iterator[tuple]:
            nonlocal i, state
            while i < len(audit) and audit[i] == "I":
                state, role = TURN[state]
                i += 1
                yield conv, "I", role, ""

        for b in batches:
            for c, kind, role, text, edits in zip(*(b[n].to_pylist() for n in ("conv_id", "kind", "role", "text", "audit")), strict=True):
                if kind == 0:
                    yield from inserted()
                    conv, audit, i, state, known = c, edits, 0, START, True
                    yield conv, None, None, None
                elif known and c == conv:
                    yield from inserted()
                    edit, i = audit[i], i + 1
                    if edit == "K":
                        state = KEEP[role[0]][state]
                    elif edit == "R":
                        state, role = TURN[state]
                    if edit != "D":
                        yield c, edit, role, text
        yield from inserted()

    def turns(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_kept()
        out, at, size = [], 0, 0
        schema = pa.schema([("conv_id", pa.int64()), ("at", pa.int64()), ("edit", pa.string()), ("role", pa.string()), ("text", pa.string())])
        for conv, edit, role, text in edited(batches):
            if edit is None:
                at = 0
                continue
            out.append({"conv_id": conv, "at": at, "edit": edit, "role": role, "text": text})
            at, size = at + 1, size + len(text)
            if len(out) >= 1000 or size > 1 << 20:
                yield pa.RecordBatch.from_pylist(out, schema)
                out, size = [], 0
        yield pa.RecordBatch.from_pylist(out, schema)

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_kept()
        out, conv, sha, first = [], None, None, True
        schema = pa.schema([("conv_id", pa.int64()), ("repaired_sha256", pa.string())])
        for c, edit, role, text in edited(batches):
            if edit is None:
                out += [{"conv_id": conv, "repaired_sha256": sha.hexdigest()}] if sha else []
                conv, sha, first = c, hashlib.sha256(), True
            else:
                sha.update(("" if first else "\n").encode() + f"{role}:{text}".encode())
                first = False
            if len(out) >= 10_000:
                yield pa.RecordBatch.from_pylist(out, schema)
                out = []
        yield pa.RecordBatch.from_pylist(out + ([{"conv_id": conv, "repaired_sha256": sha.hexdigest()}] if sha else []), schema)

    both = with_heads(held.withColumn("audit", F.lit(None).cast("string")), judged.select("conv_id", "audit"))
    if digest_only:
        return both.mapInArrow(digests, "conv_id long, repaired_sha256 string")
    return both.mapInArrow(turns, "conv_id long, at long, edit string, role string, text string")


def damaged(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text) with faults put in by the remainder of crc32("conv_id:turn") by 20: 0 drops a row, 1
    empties its text, 2 takes out its . ! ?, 3 repeats it, 4 makes it a user's. Nulls count as one space each (in the
    checksum too); a null turn or conv_id stays null."""
    space = F.lit(" ")
    named = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    k = F.crc32(named.cast("binary")) % 20
    role, text = F.coalesce("role", space), F.coalesce("text", space)
    out = rows.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text"), k.alias("_k")).where("_k <> 0")
    text = F.when(F.col("_k") == 1, "").when(F.col("_k") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(F.col("_k") == 4, "user").otherwise(F.col("role"))
    copies = F.when(F.col("_k") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return out.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(copies).alias("_copy")).drop("_copy")
