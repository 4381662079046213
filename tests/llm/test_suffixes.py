import hashlib
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from docquill.llm import catalog, suffixes
from tests.conftest import SF_SMALL


def brute(texts, length):
    """(n_bytes, n_removed, n_spans, kept_sha256) of each text."""
    raws = [(t or "").encode() for t in texts]
    seen = Counter(r[i : i + length] for r in raws for i in range(len(r) - length + 1))
    out = []
    for r in raws:
        gone = bytearray(len(r))
        for i in range(len(r) - length + 1):
            if seen[r[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        kept = bytes(c for c, g in zip(r, gone, strict=True) if not g)
        out.append((len(r), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def corpus(seed):
    """Random texts with shared passages, edits, copies, runs and periods."""
    rnd = random.Random(seed)
    say = lambda n, a="abcdefghé\n ": "".join(rnd.choice(a) for _ in range(n))
    shared = [say(rnd.randrange(15, 120)) for _ in range(5)]
    texts = []
    for _ in range(60):
        t = say(rnd.randrange(0, 60))
        for _ in range(rnd.randrange(4)):
            s = rnd.choice(shared)
            a = rnd.randrange(len(s))
            t += s[a : a + rnd.randrange(len(s))] + say(rnd.randrange(6))
        texts.append(t)
    texts += [rnd.choice(texts) for _ in range(8)]
    texts += ["a" * 90, "a" * 30 + "b" * 30, "abc" * 30, "xyabcabcabcabcabcabcabcab", say(70, "ab"), say(200, "ab"), say(19), None, "", "q" * 19, "q" * 20, "r" * 21, "é" * 40]
    return texts


def rows(df):
    return sorted((r.id if r.id is not None else -1, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in df.collect())


@pytest.mark.parametrize(("seed", "bucket", "group", "heavy", "stretch"), [(1, 500_000, 4 << 20, 64, 1 << 22), (2, 3, 100, 3, 50), (3, 40, 2000, 2, 1 << 22), (4, 500_000, 4 << 20, 1000, 64)])
def test_against_brute_force(spark, monkeypatch, seed, bucket, group, heavy, stretch):
    for name, value in (("BUCKET", bucket), ("GROUP_BYTES", group), ("HEAVY", heavy), ("_STRETCH", stretch)):
        monkeypatch.setattr(suffixes, name, value)
    texts = corpus(seed)
    ids = [*range(len(texts) - 2), None, 3]
    df = spark.createDataFrame([(i, t, 0) for i, t in zip(ids, texts, strict=True)], "doc_id long, text string, place int").repartition(4)
    got = rows(suffixes.cut_repeats(df, length=20, gram=6))
    want = sorted((i if i is not None else -1, *w) for i, w in zip(ids, brute(texts, 20), strict=True))
    assert got == want
    assert sum(w[2] > 0 for w in want) > 30


def spread(n):
    """A passage in n different surroundings."""
    rnd = random.Random(5)
    say = lambda k: "".join(rnd.choice("abcdefgh ") for _ in range(k))
    shared = say(260)
    return [say(220) + shared + say(220) for _ in range(n)]


def test_passage_with_few_surroundings_per_batch_is_heavy():
    texts = [t.encode() for t in spread(suffixes.TOGETHER)]
    sent = [
        b
        for a in range(0, len(texts), 32)
        for b in suffixes._anchor_rows(texts[a : a + 32], np.arange(a, a + 32), 1, suffixes.LENGTH, suffixes.GRAM)
    ]
    sent = pa.Table.from_batches(sent)
    judged = suffixes._judge(sent.filter(pa.compute.greater_equal(sent.column("bucket"), 0))).to_pylist()
    light = Counter(r["gram"] for r in judged if r["state"] in (suffixes.ONE, suffixes.PARTNER))
    assert all(n < suffixes.TOGETHER for n in light.values())
    assert sum(r["state"] == suffixes.HEAVY_ONE for r in judged) >= suffixes.TOGETHER


def test_passage_spread_over_batches_against_brute_force(spark):
    texts = spread(suffixes.TOGETHER + 76)
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(40)
    got = rows(suffixes.cut_repeats(df))
    assert got == [(i, *w) for i, w in enumerate(brute(texts, suffixes.LENGTH))]
    assert all(r[2] >= 260 for r in got)


def test_ends_of_many_documents_match_nothing():
    n = (1 << 16) - 256 + 1
    contexts = [i.to_bytes(2) + b"ab" + i.to_bytes(2) for i in range(n)]
    lefts = [2] * n
    contexts[0], contexts[-1], lefts[-1] = b"\0\0ab\xff\xff", b"ab\xff\xfe", 0
    found = suffixes.extents(contexts, lefts, 4, 2)
    assert found[0] == found[-1] == (0, 0)


def test_suffix_order_and_common_prefixes():
    for seed in range(300):
        rnd = random.Random(seed)
        text = [rnd.randrange(1, rnd.randrange(2, 6)) for _ in range(rnd.randrange(1, 50))] + [0]
        order = suffixes.suffix_array(text)
        assert order == sorted(range(len(text)), key=lambda i: text[i:])
        for a, b, n in zip(order, order[1:], suffixes.common_prefixes(text, order)[1:], strict=False):
            assert text[a : a + n] == text[b : b + n] and text[a + n : a + n + 1] != text[b + n : b + n + 1]


def test_empty_table(spark):
    assert suffixes.cut_repeats(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_query(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in catalog.QUERIES["op7_linear_suffix_dedup"](spark, SF_SMALL).collect()}
    assert got == dict(zip(texts, brute(texts.values(), 200), strict=True))
