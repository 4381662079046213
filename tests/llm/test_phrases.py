import random
import re
from collections import Counter

import pytest

from docquill.llm import phrases

LOWER = {c: c + 32 for c in range(65, 91)}


def brute(rows, least=10, top=2000):
    counts, totals = {}, Counter()
    for lang, text in rows:
        own = counts.setdefault(lang or "und", Counter())
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            ws = re.findall(r"[^\x20\x09]+", piece)
            totals[lang or "und"] += len(ws)
            for size in (1, 2, 3):
                own.update(tuple(ws[i : i + size]) for i in range(len(ws) - size + 1))
    out = []
    for lang, f in counts.items():
        kept = []
        for p, a in f.items():
            if len(p) < 2 or a < least:
                continue
            if any(len(q) > len(p) and b >= least and 100 * b >= 50 * a and p in (q[:2], q[1:]) for q, b in (f.items() if len(p) == 2 else ())):
                continue
            s, _, left, right = min((10**6 * a * a // (f[p[:k]] * f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
            kept.append((-s, -a, " ".join(p).encode(), left, right))
        for rank, (s, a, p, left, right) in enumerate(sorted(kept)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, totals[lang], -s))
    return sorted(out)


def some_rows(n=300):
    rng = random.Random(3)
    vocabulary = ["Le", "le", "grand", "lac", "é", "É", "x" * 30, "a", "b", "c", "d", "ça"]
    rows = []
    for k in range(n):
        ws = rng.choices(vocabulary, [9, 9, 3, 3, 2, 2, 1, 5, 4, 3, 2, 1], k=rng.randint(0, 30))
        text = "".join(w + rng.choice([" ", " ", " ", "\t", ". ", "\n", " ,", ";"]) for w in ws)
        rows.append((["en", "de", None][k % 3], text))
    return [*rows, ("en", None), (None, ""), ("fr", "..\n,"), ("it", "one two three " * 20), ("it", "nul\u0000byte nul\u0000byte"), ("en", rows[0][1]), ("en", rows[0][1])]


def shown(df):
    return sorted(tuple(r) for r in df.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


@pytest.mark.parametrize(("sample", "block"), [(10**6, 1 << 20), (600, 1 << 20), (0, 7)])
def test_against_brute_force_whatever_sample_and_block(spark, sample, block):
    rows = some_rows()
    df = spark.createDataFrame([(a, t, 1) for a, t in rows], "lang string, text string, words int").repartition(5)
    assert shown(phrases.collocations(df, sample_words=sample, block=block)) == brute(rows)


def test_border_failures_are_counted_by_further_passes(spark):
    df = spark.createDataFrame(some_rows(), "lang string, text string")
    assert phrases.frequent(df)[3] == [0]
    failures = phrases.frequent(df, sample_words=0)[3]
    assert len(failures) == 2 and failures[0] > 0 and failures[1] == 0


def test_first_places_and_large_sides(spark, monkeypatch):
    monkeypatch.setattr(phrases, "size_of", lambda _: 1 << 40)
    monkeypatch.setattr(phrases, "HOT", 3)
    rows = some_rows()
    df = spark.createDataFrame(rows, "lang string, text string")
    assert shown(phrases.collocations(df, top=4)) == brute(rows, top=4)


def test_words_with_one_hash_are_told_apart(spark, monkeypatch):
    rows = [("en", "one two. three four. " * 12)]
    df = spark.createDataFrame(rows, "lang string, text string")
    encode = phrases.encode

    def colliding(docs, text, lang, seed, block):
        from pyspark.sql import functions as F

        done = encode(docs, text, lang, seed, block)
        return done if seed else done.withColumn("hashes", F.transform("hashes", lambda h: F.lit(5).cast("long")))

    monkeypatch.setattr(phrases, "encode", colliding)
    assert shown(phrases.collocations(df)) == brute(rows)


def test_scores_beyond_64_bits(spark):
    from pyspark.sql import functions as F

    numbers = [(10**14 + 7, 10**15 - 1, 10**14 + 9), (3_037_000_500, 3_037_000_501, 3_037_000_502)]
    df = spark.createDataFrame(numbers, "a long, l long, r long")
    got = [x.s for x in df.select(phrases.score(F.col("a"), F.col("l"), F.col("r")).alias("s")).collect()]
    assert got == [10**6 * a * a // (x * y) for a, x, y in numbers]


def test_empty_table(spark):
    assert phrases.collocations(spark.createDataFrame([], "lang string, text string")).count() == 0


def test_blocks_are_in_memory_one_at_a_time(spark):
    import pyarrow.parquet as pq

    df = spark.createDataFrame([("en", f"one two w{k}") for k in range(50)], "lang string, text string").coalesce(1)
    encoded = phrases.encode(df, block=7)
    files = [pq.ParquetFile(f.removeprefix("file://")).metadata for f in encoded.inputFiles()]
    groups = [m.row_group(k).num_rows for m in files for k in range(m.num_row_groups)]
    assert sum(groups) == encoded.count() > 10 and max(groups) == 1


@pytest.mark.parametrize(("before", "inside"), [("1k", 32 << 20), ("16m", 32 << 20), ("134217728b", 128 << 20), ("134217728", 128 << 20), ("1GB", 1 << 30)])
def test_blocks_of_a_file_are_read_by_one_task(spark, before, inside):
    from docquill.llm.common import whole_files

    name = "spark.sql.files.maxPartitionBytes"
    kept = spark.conf.get(name)
    spark.conf.set(name, before)
    try:
        with whole_files(spark):
            assert int(spark.conf.get(name)) == inside
        assert spark.conf.get(name) == before
    finally:
        spark.conf.set(name, kept)
