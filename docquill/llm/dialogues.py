"""Conversations repaired to the grammar (s?(ua)+)? of role initials at the least cost, with audits; Wagner-Fischer tables in bands.

Rows of a conversation are taken by turn (nulls first), then role, then text. A row's first fault counts: blank (no character but
[\\x20\\x09-\\x0D]), duplicate (role and text seen earlier in the conversation), truncated (last such character isn't [.!?]).
Edits: Keep 0, Rerole to user or assistant 2, Delete 3 (the only one for blank and duplicate rows), Insert an empty user or assistant
turn 2; a truncated row that stays adds 1. Of the cheapest edits those with the ASCII-least audit (their initials) count.

The grammar's strings of one ending are the endings of one endless alternating string, so one table holds the alignments with every
feasible length. A table is computed within the band that the incumbent cost leaves (each column off the diagonal costs 2 or 3);
the incumbent is doubled until the result is no dearer. The audit of each length that has the least cost is traced, and they are compared.
Rows that must go have no part in the tables.

Duplicates are found by `firsts.with_first` on hashes. Then rows are dealt by ranges of (conversation, turn, role, text), so a
conversation of any length is spread over tasks, where runs of its rows are cut into blocks. A conversation within one
task and one block is settled there, texts included. Other blocks are aligned by themselves for every state of the grammar
before and after (nothing yet, after s, after u, after a); audits of blocks end with a row's letter, so none is another's beginning and
the least whole audit is made of least parts. Per conversation only 16 costs and ranks of each block come together to choose
states. Blocks then write their repaired text, and a last pass streams these blocks in order into the conversation's hash: as a
SHA-256 can't be divided, one conversation's text passes through one task there, a block at a time.

Cases: null role or text is one space, a null conversation is one of its own, null turns come first and count in no gap; repeated rows
are duplicates; roles with other initials, empty ones too, can't be kept; very long texts are whole; an empty table gives no
rows; only the four named columns are read, so further columns never clash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import settled, small
from .firsts import with_first

SPACE = " \t\n\x0b\x0c\r"
#: Rows of a block, and bytes of text from which on it is closed.
BLOCK, BLOCK_BYTES = 1000, 4 << 20
#: Conversations of different marks that a task remembers.
KNOWN = 10_000
RESULT = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
NONE, START, USER, DONE = 0, 1, 2, 3
#: Letters that end a conversation in each state, and their cost.
CLOSE = {NONE: "", START: "II", USER: "I", DONE: ""}
FAR = 1 << 29


class Table:
    """Least costs R[i, k] of aligning the rows from i on with the last k letters of ...uaua (or ...uau), within a band.

    No letter follows the last row. Rows are letters of their role's initial, upper case for truncated ones.
    """

    def __init__(self, rows: str, end: int, most: int):
        n = len(rows)
        self.rows, self.end, self.n = rows, end, n
        self.low = most // 3
        width = self.low + most // 2 + 1
        at = np.arange(width)
        self.cells = np.full((n + 1, width), FAR, np.int32)
        if self.low < width:
            self.cells[n, self.low] = 0
        for i in range(n - 1, -1, -1):
            k = at + (n - i) - self.low
            row, late = rows[i].lower(), int(rows[i].isupper())
            turn = np.where((k + end) % 2 == 0, "a", "u")
            there = self.cells[i + 1]
            here = np.where(k >= 1, there + np.where(turn == row, late, late + 2), FAR)
            here[:-1] = np.minimum(here[:-1], np.where(k[:-1] >= 0, there[1:] + 3, FAR))
            self.cells[i] = np.minimum(np.minimum.accumulate(here - 2 * at) + 2 * at, FAR)

    def get(self, i: int, k: int) -> int:
        at = k - (self.n - i) + self.low
        return int(self.cells[i, at]) if 0 <= at < self.cells.shape[1] and k >= 0 else FAR

    def lengths(self, i: int) -> np.ndarray:
        """The k of a row's cells."""
        return np.arange(self.cells.shape[1]) + (self.n - i) - self.low

    def trace(self, i: int, k: int) -> str:
        """The least letters from a cell on: at each step the least one that keeps the cost."""
        out, cost = [], self.get(i, k)
        while i < self.n:
            if self.get(i + 1, k) + 3 == cost:
                out.append("D")
                i, cost = i + 1, cost - 3
            elif self.get(i, k - 1) + 2 == cost:
                out.append("I")
                k, cost = k - 1, cost - 2
            else:
                same = self.rows[i].lower() == ("a" if (k + self.end) % 2 == 0 else "u")
                out.append("K" if same else "R")
                i, k = i + 1, k - 1
                cost = self.get(i, k)
        return "".join(out)


def _least(table: Table, before: int) -> tuple[int, list[tuple[int, int, str]]]:
    """The least cost from a state, and the cells (i, k, letters so far) that have it."""
    found = []
    k = table.lengths(0)
    # Letters alternate, so the state before tells whether their number is even; one that may be left empty, only that state itself.
    odd = (table.end == USER) ^ (before == USER)
    fits = (k % 2 == odd) & ((k > 0) | ((k == 0) & (before == table.end)))
    row = np.where(fits, table.cells[0], FAR)
    found.append((int(row.min()), 0, k[row == row.min()].tolist(), ""))
    if before == NONE:
        for i, letter in enumerate(table.rows):
            if letter in "sS":
                k = table.lengths(i + 1)
                row = np.where((k > 0) & (k % 2 == (table.end == USER)), table.cells[i + 1], FAR)
                found.append((int(row.min()) + 3 * i + (letter == "S"), i + 1, k[row == row.min()].tolist(), "D" * i + "K"))
    best = min(f[0] for f in found)
    return best, [(i, k, head) for cost, i, ks, head in found if cost == best for k in ks] if best < FAR else []


def _deleted(rows: str, before: int, after: int) -> list[tuple[int, str]]:
    """Ways to the two states in which no user or assistant turn has been."""
    n = len(rows)
    ways = [(3 * n, "D" * n)] if before == after else []
    if (before, after) == (NONE, START):
        ways += [(3 * (n - 1) + (c == "S"), "D" * i + "K" + "D" * (n - 1 - i)) for i, c in enumerate(rows) if c in "sS"]
    return ways


def align(marks: str, starts: tuple[int, ...]) -> dict[tuple[int, int], tuple[int, str]]:
    """Cost and audit of a block's rows from each state before to each state after, where there is a way.

    marks: a letter per row: x for one that must go, else the role's initial (o for others), upper case if truncated.
    """
    rows = marks.replace("x", "")
    out = {}
    for p in starts:
        for q in (NONE, START):
            ways = _deleted(rows, p, q)
            if ways:
                out[p, q] = min(ways)
    for q in (USER, DONE):
        if not rows:
            if q in starts:
                out[q, q] = (0, "")
            continue
        most = 8
        while True:
            table = Table(rows, q, most)
            least = {p: _least(table, p) for p in starts}
            if max(cost for cost, _ in least.values()) <= most:
                break
            most *= 2
        for p, (cost, cells) in least.items():
            out[p, q] = (cost, min(head + table.trace(i, k) for i, k, head in cells))
    forced = marks.count("x")
    return {pq: (cost + 3 * forced, _with_forced(marks, audit)) for pq, (cost, audit) in out.items()}


def _with_forced(marks: str, audit: str) -> str:
    """The audit with a D for each row that must go, as early as it can stand."""
    out, letters = [], iter(audit)
    for mark in marks:
        if mark != "x":
            for letter in letters:
                out.append(letter)
                if letter != "I":
                    break
        else:
            out.append("D")
    return "".join(out)


def settle_whole(marks: str) -> tuple[int, str]:
    """Cost and audit of a whole conversation."""
    ways = align(marks, (NONE,))
    return min((cost + 2 * len(CLOSE[q]), audit + CLOSE[q]) for (_, q), (cost, audit) in ways.items())


def repaired(audit: str, state: int, roles: list[str], texts: list[str]) -> list[str]:
    """`role:text` of what the edits leave, from a state on."""
    out, at = [], 0
    for edit in audit:
        if edit == "D":
            at += 1
            continue
        role = "assistant" if state == USER else "user"
        kept = edit == "K"
        state = START if kept and roles[at][:1] == "s" else DONE if state == USER else USER
        out.append(f"{roles[at] if kept else role}:{'' if edit == 'I' else texts[at]}")
        at += edit != "I"
    return out


FAULTS = ("", "blank", "duplicate", "truncated")
PART = (
    "part int, seq int, whole boolean, marks string, n_turns long, low long, high long, first string, last string, illegal long, "
    "blank long, duplicate long, truncated long, roles array<string>, texts array<string>, cost long, audit string, repaired_sha256 string"
)


def _mark(role: str, fault: int) -> str:
    if fault in (1, 2):
        return "x"
    initial = role[:1] if role[:1] in ("s", "u", "a") else "o"
    return initial.upper() if fault == 3 else initial


def _illegal(initials: list[str]) -> int:
    return sum(a + b not in ("su", "ua", "au") for a, b in zip(initials[:-1], initials[1:], strict=True))


def _sha(parts: list[str]) -> str:
    return hashlib.sha256("\n".join(parts).encode()).hexdigest()


def _block(conv: object, part: int, seq: int, whole: bool, turns: list, roles: list[str], texts: list[str], faults: list[int], known: dict) -> dict:
    numbers = [t for t in turns if t is not None]
    marks = "".join(map(_mark, roles, faults))
    out = {
        "conv": conv,
        "part": part,
        "seq": seq,
        "whole": whole,
        "marks": marks,
        "n_turns": len(set(numbers)),
        "low": min(numbers, default=None),
        "high": max(numbers, default=None),
        "first": roles[0][:1],
        "last": roles[-1][:1],
        "illegal": _illegal([r[:1] for r in roles]),
        **{name: faults.count(k) for k, name in enumerate(FAULTS) if k},
    }
    if not whole:
        return out | {"roles": roles, "texts": texts, "cost": None, "audit": None, "repaired_sha256": None}
    if marks not in known:
        if len(known) >= KNOWN:
            known.clear()
        known[marks] = settle_whole(marks)
    cost, audit = known[marks]
    return out | {"roles": None, "texts": None, "cost": cost, "audit": audit, "repaired_sha256": _sha(repaired(audit, NONE, roles, texts))}


def _blocks(schema: pa.Schema, most: int):
    """Sorted rows to blocks. The first and the last conversation of a task may go on in another one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq, ready, held, size = TaskContext.get().partitionId(), 0, [], 0, 0
        lists: tuple[list, ...] = ([], [], [], [])
        conv, first, cut, known = None, True, False, {}

        def close(ends: bool) -> None:
            nonlocal lists, seq, cut, size
            if lists[0]:
                ready.append(_block(conv, part, seq, ends and not first and not cut, *lists, known))
                seq += 1
            lists, cut, size = ([], [], [], []), not ends, 0

        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("conv", "turn", "role", "text", "fault")]
            for own, *values in zip(*columns, strict=True):
                if own != conv and (lists[0] or cut):
                    close(True)
                    first = cut = False
                elif len(lists[0]) == most or size > BLOCK_BYTES:
                    close(False)
                conv = own
                for to, value in zip(lists, values, strict=True):
                    to.append(value)
                held, size = held + len(values[2]), size + len(values[2])
                if held > 1 << 20:
                    held = 0
                    yield pa.RecordBatch.from_pylist(ready, schema=schema)
                    ready = []
        close(False)
        yield pa.RecordBatch.from_pylist(ready, schema=schema)

    return run


def _ways(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each block: costs (-1: no way) and ranks of the audits from one state, as 16 numbers each, and the audits."""
    for batch in batches:
        out = {"costs": [], "ranks": [], "audits": []}
        for marks in batch.column("marks").to_pylist():
            ways = align(marks, (NONE, START, USER, DONE))
            audits = [ways.get((p, q), (-1, ""))[1] for p in range(4) for q in range(4)]
            out["costs"].append([ways.get((p, q), (-1, ""))[0] for p in range(4) for q in range(4)])
            out["ranks"].append([sorted(audits[4 * p : 4 * p + 4]).index(audits[4 * p + q]) for p in range(4) for q in range(4)])
            out["audits"].append(audits)
        kept = {c: batch.column(c) for c in batch.schema.names if c != "marks"}
        types = {"costs": pa.list_(pa.int64()), "ranks": pa.list_(pa.int64()), "audits": pa.list_(pa.string())}
        yield pa.RecordBatch.from_pydict(kept | {c: pa.array(v, types[c]) for c, v in out.items()})


CHOICE = "part int, seq int, before int, after int, close string"
_NARROW = ["part", "seq", "n_turns", "low", "high", "first", "last", "illegal", "blank", "duplicate", "truncated"]


def _choose(table: pa.Table, schema: pa.Schema) -> pa.Table:
    """One conversation's blocks: states before and after each, and on the last the conversation's numbers."""
    blocks = sorted(table.select([*_NARROW, "costs", "ranks"]).to_pylist(), key=lambda b: (b["part"], b["seq"]))
    ahead = [{q: 2 * len(CLOSE[q]) for q in range(4)}]
    for b in reversed(blocks):
        ahead.append({p: min((b["costs"][4 * p + q] + ahead[-1][q] for q in range(4) if b["costs"][4 * p + q] >= 0), default=FAR) for p in range(4)})
    ahead.reverse()
    state, rows = NONE, []
    for k, b in enumerate(blocks):
        ways = [(b["costs"][4 * state + q] + ahead[k + 1][q], b["ranks"][4 * state + q], q) for q in range(4) if b["costs"][4 * state + q] >= 0]
        after = min(ways)[2]
        rows.append({"part": b["part"], "seq": b["seq"], "before": state, "after": after, "close": ""})
        state = after
    rows[-1]["close"] = CLOSE[state]
    lows, highs = [b["low"] for b in blocks if b["low"] is not None], [b["high"] for b in blocks if b["high"] is not None]
    turns = sum(b["n_turns"] for b in blocks) - sum(x == y for x, y in zip(highs[:-1], lows[1:], strict=True)) if lows else 0
    across = sum(a["last"] + b["first"] not in ("su", "ua", "au") for a, b in zip(blocks[:-1], blocks[1:], strict=True))
    numbers = {c: sum(b[c] for b in blocks) for c in ("blank", "duplicate", "truncated", "illegal")}
    rows[-1] |= numbers | {"illegal": numbers["illegal"] + across, "gaps": max(highs) - min(lows) + 1 - turns if lows else 0, "cost": ahead[0][NONE]}
    conv = table.column("conv")[0].as_py()
    return pa.Table.from_pylist([{"conv": conv} | r for r in rows], schema=schema)


def _repair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = batch.to_pylist()
        out = []
        for r in rows:
            parts = repaired(r["audit"], r["before"], r["roles"], r["texts"])
            out.append("\n".join(parts) if parts else None)
        yield pa.RecordBatch.from_pydict({c: batch.column(c) for c in ("conv", "part", "seq", "audit")} | {"chunk": pa.array(out, pa.string())})


def _stream(schema: pa.Schema):
    """Blocks in order to one audit and hash for each conversation."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, audit, sha, begun, out = None, None, hashlib.sha256(), False, []
        for batch in batches:
            for own, letters, chunk in zip(*(batch.column(c).to_pylist() for c in ("conv", "audit", "chunk")), strict=True):
                if audit is None or own != conv:
                    if audit is not None:
                        out.append({"conv": conv, "audit": "".join(audit), "repaired_sha256": sha.hexdigest()})
                    conv, audit, sha, begun = own, [], hashlib.sha256(), False
                audit.append(letters)
                if chunk is not None:
                    sha.update((("\n" if begun else "") + chunk).encode())
                    begun = True
            yield pa.RecordBatch.from_pylist(out, schema=schema)
            out = []
        if audit is not None:
            yield pa.RecordBatch.from_pylist([{"conv": conv, "audit": "".join(audit), "repaired_sha256": sha.hexdigest()}], schema=schema)

    return run


def _arrow(conv_type: str, rest: str) -> tuple[str, pa.Schema]:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    ddl = f"conv {conv_type}, {rest}"
    return ddl, to_arrow_schema(_parse_datatype_string(ddl))


def marked(turns: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """conv, turn, role, text and fault (0 none, 1 blank, 2 duplicate, 3 truncated) of every row."""
    full: dict[str, Column] = {"role": F.coalesce(role, F.lit(" ")), "text": F.coalesce(text, F.lit(" "))}
    rows = turns.select(F.col(conv).alias("conv"), F.col(turn).cast("long").alias("turn"), full["role"].alias("role"), full["text"].alias("text"))
    same = F.md5(F.to_json(F.struct("conv", "role", "text")).cast("binary"))
    rows = settled(rows.withColumns({"row": F.monotonically_increasing_id(), "hash": F.unhex(same)}), "turns")
    own = F.rtrim("text", F.lit(SPACE))
    place = F.struct(F.col("turn").isNotNull().alias("known"), "turn", "row")
    narrow = settled(rows.where(own != "").select("hash", place.alias("place")), "places")
    again = with_first(narrow).where(F.col("place.row") != F.col("first.row")).select(F.col("place.row").alias("row"), F.lit(True).alias("again"))
    told = rows.join(small(settled(again, "again")), "row", "left")
    ended = F.substring(own, -1, 1).isin(".", "!", "?")
    fault = F.when(own == "", 1).when(F.col("again"), 2).when(~ended, 3).otherwise(0)
    return told.select("conv", "turn", "role", "text", "row", fault.alias("fault"))


def repair(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", block: int | None = None) -> DataFrame:
    """Per conversation: conv, gaps, blank, duplicate, truncated, illegal, cost, audit and repaired_sha256."""
    conv_type = turns.schema[conv].dataType.simpleString()
    order = ["conv", F.col("turn").isNotNull(), "turn", "role", "text", "row"]
    rows = marked(turns, conv, turn, role, text).repartitionByRange(*order).sortWithinPartitions(*order)
    ddl, schema = _arrow(conv_type, PART)
    blocks = settled(rows.select("conv", "turn", "role", "text", "fault").mapInArrow(_blocks(schema, block or BLOCK), ddl), "blocks")
    gaps = F.coalesce(F.col("high") - F.col("low") + 1 - F.col("n_turns"), F.lit(0)).alias("gaps")
    whole = blocks.where("whole").select("conv", gaps, "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
    parts = blocks.where("not whole")
    ddl, _ = _arrow(conv_type, ", ".join(c for c in PART.split(", ") if c.split()[0] in _NARROW) + ", costs array<long>, ranks array<long>, audits array<string>")
    ways = settled(parts.select("conv", *_NARROW, "marks").mapInArrow(_ways, ddl), "ways")
    ddl, schema = _arrow(conv_type, CHOICE + ", " + ", ".join(f"{c} long" for c in RESULT))
    chosen = settled(ways.drop("audits").groupBy("conv").applyInArrow(lambda t: _choose(t, schema), ddl), "chosen")
    at = ["part", "seq"]
    audit = F.concat(F.get("audits", F.col("before") * 4 + F.col("after")), "close").alias("audit")
    edits = ways.select(*at, "audits").join(chosen.select(*at, "before", "after", "close"), at).select(*at, "before", audit)
    told = parts.select("conv", *at, "roles", "texts").join(small(settled(edits, "edits")), at)
    ddl, _ = _arrow(conv_type, "part int, seq int, audit string, chunk string")
    chunks = told.mapInArrow(_repair, ddl).repartition("conv").sortWithinPartitions("conv", *at)
    ddl, schema = _arrow(conv_type, "audit string, repaired_sha256 string")
    long = chunks.mapInArrow(_stream(schema), ddl).alias("l")
    numbers = chosen.where("cost is not null").alias("r")
    long = long.join(numbers, F.col("l.conv").eqNullSafe(F.col("r.conv"))).select("l.conv", *RESULT, "audit", "repaired_sha256")
    return whole.unionByName(long)
