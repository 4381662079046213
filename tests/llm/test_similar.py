import random

import numpy as np
import pytest

from docquill.llm import similar
from docquill.llm.components import components


def brute(rows):
    """(n_shingles, component) by position."""
    sets = []
    for _, t in rows:
        w = (t or "").encode().lower().split()
        sets.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    own = list(range(len(rows)))

    def top(i):
        while own[i] != i:
            i = own[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            same = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * same >= 80 * len(sets[i] | sets[j]):
                own[top(i)] = top(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        least.setdefault(top(i), []).append(d)
    ids = {k: min((d for d in v if d is not None), default=None) for k, v in least.items()}
    return [(len(s), ids[top(i)]) for i, s in enumerate(sets)]


def corpus(seed, n):
    """Documents with copies changed to the edge of linking, shared passages, chains, short and odd texts."""
    rnd = random.Random(seed)
    word = lambda: f"w{rnd.randrange(4000)}"
    shared = [[word() for _ in range(rnd.randrange(10, 60))] for _ in range(4)]
    texts = []
    while len(texts) < n:
        own = [word() for _ in range(rnd.choice([1, 3, 5, 8, 20, 68, 69, 130, 300]))]
        for _ in range(rnd.randrange(3)):
            at = rnd.randrange(len(own) + 1)
            own[at:at] = rnd.choice(shared)
        texts.append(" ".join(own))
        for _ in range(rnd.choice([0, 0, 1, 6])):
            own = list(own)
            for _ in range(rnd.choice([0, 1, max(1, len(own) // 45), max(1, len(own) // 60)])):
                own[rnd.randrange(len(own))] = word()
            texts.append("\n".join(own) if rnd.random() < 0.5 else " ".join(own).upper())
    return texts[:n] + [None, "", " \t\n", "One two", "one  TWO", "É é", "x " * 3000, "y " * 3001]


@pytest.mark.parametrize(("seed", "bucket", "heavy", "group"), [(1, 1_000_000, 8, 200), (2, 300, 2, 2), (3, 2000, 3, 1)])
def test_components_against_brute_force(spark, monkeypatch, seed, bucket, heavy, group):
    monkeypatch.setattr(similar, "BUCKET", bucket)
    monkeypatch.setattr(similar, "HEAVY", heavy)
    monkeypatch.setattr(similar, "GROUP", group)
    rows = list(enumerate(corpus(seed, 350)))
    rows += [(None, rows[0][1]), rows[1], rows[1], (None, "nobody else says so")]
    df = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, n int").repartition(5)
    got = sorted(((r.id, r.n_shingles, r.component_id) for r in similar.similar_groups(df).collect()), key=str)
    want = brute(rows)
    assert len({c for _, c in want}) < len(rows) - 30
    assert got == sorted(((d, *w) for (d, _), w in zip(rows, want, strict=True)), key=str)


def test_sketch_bound_holds():
    rnd = random.Random(5)
    seen = similar._Hashes()
    for n in (70, 200, 1000):
        own = [str(rnd.randrange(10**6)) for _ in range(n)]
        other = list(own)
        for i in rnd.sample(range(n), n // 60):
            other[i] = "x"
        a, b = (similar.shingles(" ".join(x).encode(), seen) for x in (own, other))
        different = len(set(a.tolist()) ^ set(b.tolist()))
        for hi in set(similar.bands(len(a))) & set(similar.bands(len(b))):
            x, y = (set(similar.words_of(s, hi).tolist()) for s in (a, b))
            assert max(len(x - y), len(y - x)) <= different
            x, y = (similar.bits_of(s, hi).view(np.uint64) for s in (a, b))
            assert np.bitwise_count(x ^ y).sum() <= different


def test_empty_table(spark):
    assert similar.similar_groups(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, j) for j in range(101, 140)] + [(139, 200), (7, 7), (300, 301), (301, 300)]
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**dict.fromkeys(range(41), 0), **dict.fromkeys(range(100, 140), 100), 200: 100, 300: 300, 301: 300}


def test_one_of_each_group_stays(spark):
    long = " ".join(f"w{i}" for i in range(100))
    rows = [(5, long), (3, long + " x"), (3, long + " x"), (9, "other words that are all alone here"), (1, None), (2, ""), (None, long), (4, "One two"), (6, "one two")]
    df = spark.createDataFrame([(*r, 0) for r in rows], "doc_id long, text string, n int")
    kept = similar.keep_one(df)
    assert kept.columns == df.columns
    assert sorted((r.doc_id, r.text) for r in kept.collect()) == [(1, None), (2, ""), (3, long + " x"), (4, "One two"), (9, "other words that are all alone here")]
    nameless = spark.createDataFrame([(None, long), (None, long + " x"), (None, "a b")], "doc_id long, text string")
    assert similar.keep_one(nameless).count() == 2


def test_columns_with_the_operators_own_names_are_kept(spark):
    text = " ".join(f"w{i}" for i in range(30))
    df = spark.createDataFrame([(1, text, "x", 7), (2, text, "y", 8), (3, "c", "z", 9)], "doc_id long, text string, _id string, _mark int")
    assert sorted((r.doc_id, r._id, r._mark) for r in similar.keep_one(df).collect()) == [(1, "x", 7), (3, "z", 9)]
