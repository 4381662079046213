import random
import re

import numpy as np

from docquill.llm import decontamination as dc

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain_words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(texts, items, width):
    out = []
    for text in texts:
        w, hit, named = plain_words(text), set(), set()
        for item, body in items:
            v = plain_words(body)
            n = min(width, len(v))
            for i in range(max(1, len(v) - width + 1) if v else 0):
                for j in range(len(w) - n + 1):
                    if w[j : j + n] == v[i : i + n]:
                        hit.update(range(j, j + n))
                        named.update([str(item)] if item is not None else [])
        out.append((len(w), hit, sorted(named)))
    return out


def case(seed):
    rnd = random.Random(seed)
    word = lambda: rnd.choice(["a", "B", "c", "Éa", "d1"])
    say = lambda n: rnd.choice([" ", "-", "\n"]).join(word() for _ in range(n))
    items = [(rnd.choice([1, 2, 10, None]), say(rnd.randrange(0, 9))) for _ in range(6)] + [(7, None), (8, "zz yy xx")]
    texts = [say(rnd.randrange(0, 60)) for _ in range(12)] + [None, "", "zz, YY! xx", "q " * 500]
    return texts, items


def test_against_brute_force_in_one_block_and_in_many(spark):
    for seed, block in ((1, 1 << 20), (2, 1 << 20), (3, 90)):
        texts, items = case(seed)
        docs = spark.createDataFrame([(i, t, 0) for i, t in enumerate(texts)], "doc_id int, text string, _n int")
        found = dc.find_overlaps(docs, spark.createDataFrame(items, "item_id int, text string"), keep=["doc_id"], width=5, block_bytes=block)
        rows = {r.doc_id: r for r in found.withColumn("hits", dc.words_hit()).collect()}
        for i, (n, hit, named) in enumerate(brute(texts, items, 5)):
            r = rows[i]
            got = {p for a, b in zip(r.spans[::2], r.spans[1::2], strict=True) for p in range(a, b)}
            assert (r.n_words, got, r.hits, sorted(r["items"])) == (n, hit, len(hit), named), (seed, i)


def test_index_finds_every_place():
    rnd = np.random.default_rng(4)
    seq = np.concatenate([[0], rnd.integers(1, 4, 300), [0], rnd.integers(1, 4, 200)])
    index = dc.FMIndex(seq, 3)
    assert sorted(index.locate(np.arange(len(seq))[index.first[1] :]).tolist()) == np.flatnonzero(seq).tolist()
    lo, hi = index.search(np.array([[1, 2, 3], [0, 2, 2]]), np.array([3, 2]))
    for a, b, want in zip(lo, hi, ([1, 2, 3], [2, 2]), strict=True):
        places = [i for i in range(len(seq)) if seq[i : i + len(want)].tolist() == want]
        assert sorted(index.locate(np.arange(a, b)).tolist()) == places


def test_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id int, text string")
    items = spark.createDataFrame([(1, "a b")], "item_id int, text string")
    assert dc.find_overlaps(docs, items).count() == 0
    assert dc.find_overlaps(items, items.limit(0), keep=["item_id"]).first().spans == []


def test_cut_spans():
    assert dc.cut_spans("One, two three. Four!", [1, 3]) == "One, . Four!"
    assert dc.cut_spans("é a", [0, 1]) == " a" and dc.cut_spans("x", []) == "x"
