import hashlib
import re

import numpy as np
import pytest

from docquill.llm import exact


def brute(rows):
    """doc_id, keep_id, copies, kept of (doc_id, text) rows; of rows repeated as a whole one is kept."""
    bare = [re.sub(r"[\x20\x09-\x0D]", "", t or "") for _, t in rows]
    out, taken = [], set()
    for (i, t), b in zip(rows, bare, strict=True):
        group = [(-len(u or ""), j is None, j or 0, j) for (j, u), c in zip(rows, bare, strict=True) if c == b]
        best = min(group)
        wins = best[3] == i and len(t or "") == -best[0] and b not in taken
        if wins:
            taken.add(b)
        out.append((i, best[3], len(group), wins))
    return out


ROWS = [(1, "a b"), (2, "ab"), (3, "a  b"), (4, "ab\n  "), (5, None), (6, ""), (7, " \t"), (8, "x" * 100_000), (9, "é"), (9, "é"), (None, "q"), (10, "q"), (None, "z"), (None, "z"), (11, "a b")]


def shown(df):
    return sorted(((r.id, r.keep_id, r.copies, r.kept) for r in df.collect()), key=str)


@pytest.mark.parametrize(("keys", "most"), [(100_000, 200_000), (2, 1)])
def test_against_brute_force_in_one_shard_and_in_many(spark, monkeypatch, keys, most):
    monkeypatch.setattr(exact.build_history, "__defaults__", (keys,))
    monkeypatch.setattr(exact.look_up, "__defaults__", (most,))
    df = spark.createDataFrame([(i, t, 0) for i, t in ROWS], "doc_id long, text string, digest int")
    assert shown(exact.decide(exact.digests(df))) == sorted(brute(ROWS), key=str)
    kept = exact.keep_first(df)
    assert kept.columns == df.columns
    want = sorted(((i, t) for (i, t), b in zip(ROWS, brute(ROWS), strict=True) if b[3]), key=str)
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=str) == want


def test_history_of_earlier_rows_removes_repeats(spark):
    schema = "doc_id long, text string"
    old = exact.digests(spark.createDataFrame([(1, "ab"), (2, "a b"), (3, "cd")], schema))
    new = exact.digests(spark.createDataFrame([(11, "a  b"), (12, "new"), (13, "ne w"), (14, "c d")], schema))
    got = shown(exact.decide(new, exact.build_history(old)))
    assert got == [(11, 2, 2, False), (12, 13, 2, False), (13, 13, 2, True), (14, 3, 1, False)]


def test_perfect_hash_is_one_to_one_and_minimal():
    keys = np.random.default_rng(1).integers(0, 2**63, (5000, 2)).astype(np.uint64)
    found = exact.PerfectHash.build(keys)
    assert sorted(found.slot(keys).tolist()) == list(range(5000))
    assert exact.PerfectHash.build(keys[:0]).slot(keys[:3]).tolist() == [-1] * 3


def test_digest_and_empty_table(spark):
    df = spark.createDataFrame([(1, " é\x0bß ")], "doc_id long, text string")
    assert exact.digests(df).first().digest == bytearray(hashlib.sha256("éß".encode()).digest())
    assert exact.decide(exact.digests(df.limit(0))).count() == 0
    assert exact.keep_first(df.limit(0)).count() == 0


def test_columns_with_the_operators_own_names_are_kept(spark):
    df = spark.createDataFrame([(1, "a b", "x", 7, "d", 1.5), (2, "ab", "y", 8, "e", 2.5), (3, "c", "z", 9, "f", 3.5)], "doc_id long, text string, _id string, _chars int, _digest string, `_row` double")
    assert sorted(tuple(r) for r in exact.keep_first(df).collect()) == [(1, "a b", "x", 7, "d", 1.5), (3, "c", "z", 9, "f", 3.5)]
    assert exact.keep_first(df).columns == df.columns


@pytest.mark.parametrize("keys", [100_000, 2])
def test_parts_agree_with_all_rows_at_once(spark, monkeypatch, keys):
    from pyspark.sql import functions as F

    monkeypatch.setattr(exact.build_history, "__defaults__", (keys,))
    df = spark.createDataFrame(ROWS, "doc_id long, text string")
    rows = exact.digests(df)
    for earlier in (F.coalesce(F.col("id") <= 5, F.lit(False)), F.coalesce(F.col("id") > 3, F.lit(True)), F.lit(True), F.lit(False)):
        assert shown(exact.decide_in_parts(rows, earlier)) == sorted(brute(ROWS), key=str)
