import hashlib
import random
from itertools import product

import duckdb
import pyarrow as pa
import pytest

from docquill.llm import catalog, dialogues, sql

SPACE = " \t\n\x0b\x0c\r"


def cheapest(rows, states=4):
    """Cost and audit of rows (initial, forced, late) by trying every string of edits, state by state."""
    best = {0: (0, "")}
    close = {0: "", 1: "II", 2: "I", 3: ""}

    def put(to, state, cost, audit):
        if state not in to or (cost, audit) < to[state]:
            to[state] = (cost, audit)

    def inserted(at):
        out = dict(at)
        for p, (cost, audit) in at.items():
            for n in (1, 2):
                state = p
                for _ in range(n):
                    state = 3 if state == 2 else 2
                put(out, state, cost + 2 * n, audit + "I" * n)
        return out

    for initial, forced, late in rows:
        new = {}
        # Different ways to a state are all tried: with and without letters before the row.
        for p0, (c0, a0) in best.items():
            for n in range(3):
                p = p0
                for _ in range(n):
                    p = 3 if p == 2 else 2
                cost, audit = c0 + 2 * n, a0 + "I" * n
                put(new, p, cost + 3, audit + "D")
                if forced:
                    continue
                if initial == "s" and p == 0:
                    put(new, 1, cost + late, audit + "K")
                want = "a" if p == 2 else "u"
                put(new, 3 if p == 2 else 2, cost + late + (0 if initial == want else 2), audit + ("K" if initial == want else "R"))
        best = new
    return min((cost + 2 * len(close[p]), audit + close[p]) for p, (cost, audit) in best.items())


def exhaustive(rows):
    """All edits of a few rows, with up to two letters inserted before each row and at the end."""
    found = []
    for edits in product("DKR", repeat=len(rows)):
        for gaps in product(range(3), repeat=len(rows) + 1):
            cost, audit, roles = 0, "", ""
            for k, (initial, forced, late) in enumerate(rows):
                audit += "I" * gaps[k] + edits[k]
                roles += "?" * gaps[k] + {"D": "", "K": initial, "R": "?"}[edits[k]]
                cost += 2 * gaps[k] + {"D": 3, "K": late, "R": 2 + late}[edits[k]] + (1000 if forced and edits[k] != "D" else 0)
            audit, roles, cost = audit + "I" * gaps[-1], roles + "?" * gaps[-1], cost + 2 * gaps[-1]
            body = roles[1:] if roles[:1] == "s" else roles
            if (body or not roles) and len(body) % 2 == 0 and all(c in ("?", "ua"[i % 2]) for i, c in enumerate(body)):
                found.append((cost, audit))
    return min(found)


def marks_of(rows):
    return "".join("x" if f else (i if i in "sua" else "o").upper() if late else (i if i in "sua" else "o") for i, f, late in rows)


def some(rng, n):
    return [(rng.choice("suaauo"), rng.random() < 0.15, rng.random() < 0.2) for _ in range(n)]


def test_tables_against_all_edits():
    rng = random.Random(5)
    for _ in range(60):
        rows = some(rng, rng.randint(0, 3))
        assert dialogues.settle_whole(marks_of(rows)) == exhaustive(rows) == cheapest(rows), rows


def test_bands_against_states_on_long_conversations():
    rng = random.Random(6)
    for n in [5, 9, 30, 80, 200]:
        for _ in range(8):
            rows = some(rng, n)
            assert dialogues.settle_whole(marks_of(rows)) == cheapest(rows), rows
    for rows in ([("a", False, False)] * 120, [("s", False, True)] * 50, [("u", True, False)] * 40, [("u", False, False), ("a", False, False)] * 100):
        assert dialogues.settle_whole(marks_of(rows)) == cheapest(rows)


def turns(spark):
    rng = random.Random(7)
    rows = []
    for conv in range(25):
        for turn in range(rng.choice([0, 1, 4, 7, 60]) if conv else 400):
            if rng.random() < 0.9:
                role = rng.choice(["user", "assistant", "assistant", "system", "user", "tool", "", None, "agent", "User"])
                text = rng.choice([f"Words {rng.randint(0, 30)}.", "No end", "", " \t\n", None, "End! \r\n", "Ünd?", "\x85", f"t{turn} is said.", f"t{turn}."])
                rows.append((conv, turn if rng.random() < 0.95 else None, role, text))
    rows += [(None, 1, "user", "Hi."), (None, 2, "assistant", "Ho."), (None, None, "user", "Hi.")] + [(99, 5, "user", "x" * 50_000 + ".")] + [(98, 3, "user", "Same.")] * 3
    return rows, spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")


@pytest.mark.parametrize(("block", "parts"), [(1000, 3), (7, 9), (1, 4)])
def test_against_sql_whatever_the_blocks(spark, monkeypatch, block, parts):
    rows, df = turns(spark)
    monkeypatch.setattr(dialogues, "BLOCK", block)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    try:
        found = [tuple(r) for r in dialogues.repair(catalog.damaged(df.repartition(parts))).collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    con = duckdb.connect()
    conversations = pa.Table.from_pylist([dict(zip(("conv_id", "turn", "role", "text"), r, strict=True)) for r in rows])  # noqa: F841
    con.register("conversations", conversations)
    want = [r for r in con.execute(sql.OP11).fetchall()]
    have = {r[0] for r in found}
    assert sorted(found, key=str) == sorted((r for r in want if r[0] in have), key=str)
    assert all(r[7] == "" and r[8] == hashlib.sha256(b"").hexdigest() for r in want if r[0] not in have)


def test_other_names_types_and_an_empty_table(spark):
    df = spark.createDataFrame([("c", 2, "assistant", "B.", 1), ("c", 1, "user", "A.", 2)], "name string, at int, role string, said string, conv int")
    [row] = dialogues.repair(df, "name", "at", "role", "said").collect()
    assert (row.conv, row.gaps, row.cost, row.audit, row.repaired_sha256) == ("c", 0, 0, "KK", hashlib.sha256(b"user:A.\nassistant:B.").hexdigest())
    assert dialogues.repair(df.limit(0), "name", "at", "role", "said").count() == 0
