import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from docquill.operators import cells, lexical, retrieval


def vectors(spark, data, name):
    return spark.createDataFrame(
        [(i, [float(x) for x in v]) for i, v in enumerate(data)], f"{name} long, embedding array<float>"
    ).repartition(3)


def nearest(q, c, k):
    """Brute force over all pairs."""
    out = set()
    for i, a in enumerate(q):
        d2 = ((a[None, :] - c) ** 2).sum(1)
        order = sorted(range(len(c)), key=lambda j: (-round(1 / (1 + d2[j]), 9), j))[:k]
        out |= {(i, j, r + 1, round(1 / (1 + d2[j]), 6)) for r, j in enumerate(order)}
    return out


def found(df):
    return {(r.query_id, r.chunk_id, r.rank, round(r.score, 6)) for r in df.collect()}


@pytest.mark.parametrize(("group", "part"), [(2048, 2048), (3, 7)])
def test_dense(spark, group, part, monkeypatch):
    monkeypatch.setattr(lexical, "GROUP_ROWS", group)
    monkeypatch.setattr(cells, "PART_ROWS", part)
    rng = np.random.default_rng(0)
    q = rng.normal(size=(8, 5)).astype(np.float32).astype(np.float64)
    c = rng.normal(size=(90, 5)).astype(np.float32).astype(np.float64)
    c[30:60] = c[0]  # a third of the rows are copies
    c[60] = 0.0
    q[0] = c[0]
    for k in (1, 4, 200):
        got = retrieval.dense_topk(vectors(spark, q, "query_id"), vectors(spark, c, "chunk_id"), k)
        assert found(got) == nearest(q, c, k)


def test_questions_come_in_groups_of_bounded_size(spark, monkeypatch):
    rows = vectors(spark, np.eye(50), "query_id")
    assert len(list(lexical.question_groups(rows, "query_id", F.size("embedding") * 8))) == 1
    monkeypatch.setattr(lexical, "GROUP_BYTES", 10_000)
    groups = list(lexical.question_groups(rows, "query_id", F.size("embedding") * 8))
    assert len(groups) == 2 and sum(g.count() for g in groups) == 50


def test_cells_that_hold_no_hit_are_not_read(spark):
    rng = np.random.default_rng(1)
    middles = rng.normal(size=(10, 6)) * 50
    c = np.concatenate([m + rng.normal(size=(40, 6)) for m in middles])
    index = cells.build_vector_index(vectors(spark, c, "chunk_id"))
    q = middles + 0.5
    read, every = cells.cells_read(index, vectors(spark, q, "query_id"), 3)
    assert every == 10 * int((index.sizes > 0).sum()) and read < every / 4
    assert found(cells.dense_index_topk(index, vectors(spark, q, "query_id"), 3)) == nearest(q.astype(np.float32).astype(float), c.astype(np.float32).astype(float), 3)


def test_blocks_below_the_floor_are_skipped(spark, monkeypatch):
    texts = [f"common word number {i}" for i in range(300)] + ["rare jewel"] + [f"common jewel {i}" for i in range(5)]
    docs = spark.createDataFrame(list(enumerate(texts)), "chunk_id long, text string")
    index = lexical.build_text_index(docs, block_rows=10)
    assert index.blocks == 31 and index.postings.where("term = 'common'").count() > 20
    asked = spark.createDataFrame([(0, "rare jewel"), (1, "common")], "query_id long, question string")
    sent = []
    score = lexical._score
    monkeypatch.setattr(lexical, "_score", lambda i, a, r, pairs, *rest: (sent.append(pairs.count()), score(i, a, r, pairs, *rest))[1])
    got = found(lexical.lexical_topk(index, asked, 1))
    assert {x[:2] for x in got} == {(0, 300), (1, min(r.chunk_id for r in docs.where("text like 'common jewel%'").collect()))}
    assert sent[0] == 2 and sent[1] < 31


def test_dense_empty_sides(spark):
    some, none = vectors(spark, np.eye(3), "chunk_id"), spark.createDataFrame([], "chunk_id long, embedding array<float>")
    q = vectors(spark, np.eye(3), "query_id")
    assert retrieval.dense_topk(q, none, 2).count() == 0
    assert retrieval.dense_topk(q.limit(0), some, 2).count() == 0


DOCS = ["the cat sat on the mat", "the dog", "cat cat cat dog", "", "nothing here", "THE CAT, the cat!", "a mat on a mat"]
ASKED = ["the cat", "mat dog mat", "unknown words", "", "on the mat"]


def bm25(k):
    docs = [d.lower().replace(",", " ").replace("!", " ").split() for d in DOCS]
    mean = sum(map(len, docs)) / len(docs)
    df = Counter(t for d in docs for t in set(d))
    out = set()
    for q, text in enumerate(ASKED):
        scores = {}
        for i, d in enumerate(docs):
            for t in set(text.split()) & set(d):
                idf = math.log(1 + (len(docs) - df[t] + 0.5) / (df[t] + 0.5))
                tf = d.count(t)
                scores[i] = scores.get(i, 0) + idf * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(d) / mean))
        best = sorted(scores, key=lambda i: (-round(scores[i], 9), i))[:k]
        out |= {(q, i, r + 1, round(scores[i], 6)) for r, i in enumerate(best)}
    return out


@pytest.mark.parametrize(("group", "block"), [(2048, 1024), (2, 3)])
def test_bm25(spark, group, block, monkeypatch):
    monkeypatch.setattr(lexical, "GROUP_ROWS", group)
    monkeypatch.setattr(lexical, "BLOCK_ROWS", block)
    queries = spark.createDataFrame(list(enumerate(ASKED)), "query_id long, question string")
    docs = spark.createDataFrame(list(enumerate(DOCS)) + [(99, None)], "chunk_id long, text string")
    for k in (1, 3, 10):
        got = retrieval.bm25_topk(queries, docs, k, carry=["text"])
        assert found(got) == bm25(k)
        assert all(r.text == DOCS[r.chunk_id] for r in got.collect())


def test_text_ids(spark):
    q = vectors(spark, np.eye(2), "query_id").withColumn("query_id", F.concat(F.lit("q"), "query_id"))
    c = vectors(spark, np.eye(2), "chunk_id").withColumn("chunk_id", F.concat(F.lit("c"), "chunk_id"))
    got = {(r.query_id, r.chunk_id, r.rank) for r in retrieval.dense_topk(q, c, 1).collect()}
    assert got == {("q0", "c0", 1), ("q1", "c1", 1)}


def test_fusion(spark):
    a = spark.createDataFrame([(0, 1, 1), (0, 2, 2)], "query_id long, chunk_id long, rank int")
    b = spark.createDataFrame([(0, 1, 1), (0, 3, 2)], "query_id long, chunk_id long, rank int")
    got = [(r.chunk_id, r["rank"], r.score) for r in retrieval.fuse_ranks(a, b, k=3).orderBy("rank").collect()]
    assert [g[:2] for g in got] == [(1, 1), (2, 2), (3, 3)]
    assert got[0][2] == 1.0 and got[1][2] == got[2][2] == pytest.approx(61 / 124)


@pytest.mark.parametrize(("group", "block"), [(2048, 1024), (2, 70)])
def test_hybrid_counts_places_of_any_depth(spark, group, block, monkeypatch):
    monkeypatch.setattr(lexical, "GROUP_ROWS", group)
    monkeypatch.setattr(lexical, "BLOCK_ROWS", block)
    rng = np.random.default_rng(4)
    n, k, words = 400, 5, np.array("cat dog mat sat tree hill moon sun".split())
    texts = [" ".join(rng.choice(words, rng.integers(1, 12))) for _ in range(n)]
    asked = ["cat dog sun", "tree", "moon mat"]
    v, c = rng.normal(size=(3, 4)).round(1), rng.normal(size=(n, 4)).round(1)
    queries = vectors(spark, v, "query_id").join(spark.createDataFrame(list(enumerate(asked)), "query_id long, question string"), "query_id")
    corpus = vectors(spark, c, "chunk_id").join(spark.createDataFrame(list(enumerate(texts)), "chunk_id long, text string"), "chunk_id")
    want, deep = set(), 0
    every = [{(r.query_id, r.chunk_id): r["rank"] for r in top.collect()} for top in (
        retrieval.dense_topk(queries, corpus, n), retrieval.bm25_topk(queries, corpus, n))]
    for q in range(3):
        score = {i: round(sum(1 / (60 + e[q, i]) for e in every if (q, i) in e) * 30.5, 9) for i in range(n)}
        best = sorted(score, key=lambda i: (-score[i], i))[:k]
        want |= {(q, i, at + 1, round(score[i], 6)) for at, i in enumerate(best)}
        deep += sum(any(e.get((q, i), 0) > 2 * k + 60 for e in every) for i in best)
    assert deep
    assert found(retrieval.hybrid_topk(queries, corpus, k)) == want


def test_cut_is_strict(spark):
    rows = spark.createDataFrame([(0.35,), (0.36,)], "score double")
    assert [r.score for r in retrieval.score_cut(rows).collect()] == [0.36]


def test_routes(spark):
    texts = {
        "What fines have companies received?": (False, False, True),
        "What does Article 17 say?": (False, True, False),
        "How long do we retain customer data?": (True, False, False),
        "Right to be forgotten requirements and penalties": (True, True, True),
        "Hello there": (False, False, False),
    }
    rows = spark.createDataFrame([(t,) for t in texts], "question string")
    for r in retrieval.route_sources(rows).collect():
        assert (r.query_policy, r.query_legislation, r.query_fines) == texts[r.question]


@pytest.fixture()
def small_indexes(spark):
    def index(items):
        return spark.createDataFrame(items, "chunk_id long, label string, text string, embedding array<float>")

    return {
        "policy": index([(1, "s1", "keep seven years", [1.0, 0.0]), (2, "s2", "far", [-9.0, 0.0])]),
        "legislation": index([(1, "a17", "erasure", [1.0, 0.1])]),
        "fines": index([(1, None, "airline fined", [0.9, 0.0])]),
    }


def asked(spark):
    rows = spark.createDataFrame(
        [(0, "How long do we retain fines?", [1.0, 0.0]), (1, "Hello", [1.0, 0.0])],
        "query_id long, question string, embedding array<float>",
    )
    return retrieval.route_sources(rows.withColumn("original_question", F.col("question")))


def test_contexts(spark, small_indexes):
    got = {r.query_id: r for r in retrieval.multi_source_retrieve(asked(spark), small_indexes).collect()}
    assert got[0].retrieved_context == (
        "[SOURCE: Internal Retail Policy | Section: s1]\nContent: keep seven years"
        "\n\n---\n\n[SOURCE: Enforcement History & Fines Precedent]\nContent: airline fined"
    )
    assert got[0].sources_queried == ["policy", "fines"]
    assert (got[1].retrieved_context, got[1].sources_queried, got[1].retrieval_loop_count) == ("", [], 1)


def test_expansion(spark, small_indexes):
    state = retrieval.multi_source_retrieve(asked(spark), small_indexes)
    got = {r.query_id: r for r in retrieval.expand_sources(state, small_indexes).collect()}
    assert got[0].sources_queried == ["policy", "fines", "legislation"]
    assert got[0].retrieved_context.endswith("\n\n---\n\n[SOURCE: GDPR Legislation | Article: a17]\nContent: erasure")
    assert got[1].retrieved_context.startswith("[SOURCE: Internal Retail Policy | Section: s1]")
    assert got[1].sources_queried == ["policy", "legislation", "fines"]
    assert got[1].expanded_search_used and got[1].retrieval_loop_count == 2


def test_rounds(spark, small_indexes):
    def search(rows):
        return retrieval.multi_source_retrieve(rows, small_indexes)

    got = {r.query_id: r for r in retrieval.retrieval_rounds(asked(spark), search).collect()}
    assert (got[0].retrieval_loop_count, got[0].question) == (1, "How long do we retain fines?")
    assert (got[1].retrieval_loop_count, got[1].question, got[1].has_context) == (3, "hello", False)
    none = retrieval.retrieval_rounds(asked(spark).filter("query_id = 0"), search)
    assert none.count() == 1


def test_state_checks(spark):
    long_answer = "word " * 25
    rows = spark.createDataFrame(
        [
            (0, "How to handle this?", "short", "x" * 300, 0, 0, False),
            (1, "What?", "short", "x", 1, 3, False),
            (2, "Approach?", long_answer + "The context does NOT say", "SOURCE: Enforcement x", 2, 0, False),
            (3, "respond to", long_answer, "  ", 3, 0, True),
            (4, "What?", None, None, 0, 0, None),
        ],
        "id int, original_question string, generated_answer string, retrieved_context string, "
        "retrieval_loop_count int, generation_loop_count int, expanded_search_used boolean",
    )
    rows = retrieval.groundedness(retrieval.source_coverage(retrieval.answer_completeness(rows)))
    got = {r.id: r for r in retrieval.next_step(rows).collect()}
    assert [got[i].is_answer_complete for i in range(5)] == [True, False, False, True, False]
    assert [got[i].needs_example_expansion for i in range(5)] == [True, False, False, True, False]
    assert [got[i].after_retrieval for i in range(5)] == ["generate_response"] * 4 + ["rewrite_query"]
    assert [got[i].after_source_check for i in range(5)] == ["expand_all_sources"] + ["check_completeness"] * 4
    assert [got[i].after_completeness for i in range(5)] == [
        "verify_output", "expand_all_sources", "verify_output", "verify_output", "expand_all_sources",
    ]
    assert [got[i].after_verification for i in range(5)] == [
        "regenerate_strict", "return_fallback", "regenerate_strict", "regenerate_strict", "end",
    ]
    assert got[0].returned_answer.startswith("**GROUNDEDNESS WARNING**") and got[0].returned_answer.endswith("short")


def test_groundedness_share(spark):
    rows = spark.createDataFrame([("A b a c", "b x C")], "generated_answer string, retrieved_context string")
    assert retrieval.groundedness(rows).first().support == pytest.approx(2 / 3)


def test_query_keywords(spark):
    rows = spark.createDataFrame([("Which records should erasure, cover records portability",)], "q string")
    assert rows.select(retrieval.query_keywords(F.col("q"))).first()[0] == "records cover portability"


def test_postings_are_written_by_more_tasks_the_more_blocks(spark, monkeypatch):
    monkeypatch.setattr(lexical, "BLOCK_ROWS", 2)
    docs = spark.range(400).select(F.col("id").alias("chunk_id"), F.concat(F.lit("same words "), F.col("id").cast("string")).alias("text"))
    index = lexical.build_text_index(docs)
    sizes = [r.n for r in index.postings.groupBy(F.input_file_name()).agg(F.count("*").alias("n")).collect()]
    assert index.blocks == 200 and sum(sizes) >= 400
    # Twice as many files as there were folders, and no file with more than a small part.
    assert len(sizes) > 10 and max(sizes) < sum(sizes) / 5


def test_sources_are_searched_without_joining_them_again(spark, sf):
    from docquill.plans import testbed

    for rows in (testbed.passages(spark, sf), testbed.indexes(spark, sf)["fines"]):
        plan = rows._jdf.queryExecution().optimizedPlan().toString()
        assert "Join" not in plan and "parquet" in plan


def test_expansion_finds_the_context_so_far_once(spark, small_indexes):
    seen = spark.sparkContext.accumulator(0)

    def count(x):
        seen.add(1)
        return x

    mark = F.udf(count, "long").asNondeterministic()
    state = retrieval.multi_source_retrieve(asked(spark), small_indexes).withColumn("n", mark("query_id"))
    assert retrieval.expand_sources(state, small_indexes).count() == 2
    assert seen.value == 2


def counted(spark):
    """A column function that returns its argument, and the number of rows it was computed for so far."""
    seen = spark.sparkContext.accumulator(0)

    def mark(kind):
        def count(x):
            seen.add(1)
            return x

        return F.udf(count, kind).asNondeterministic()

    return mark, seen


WORDS = [f"{a} {b} number {i}" for i, (a, b) in enumerate([("cat", "tree"), ("dog", "moon"), ("mat", "sun")] * 20)]


def test_postings_are_read_once_however_many_groups_ask(spark, monkeypatch):
    monkeypatch.setattr(lexical, "GROUP_ROWS", 2)
    docs = spark.createDataFrame(list(enumerate(WORDS)), "chunk_id long, text string")
    queries = spark.createDataFrame(list(enumerate(["cat moon", "dog", "sun tree 7", "number"])), "query_id long, question string")
    index = lexical.build_text_index(docs, block_rows=10)
    rows, whole = index.postings.count(), found(lexical.lexical_topk(index, queries, 3))
    mark, seen = counted(spark)
    postings = lexical.TextIndex.postings.fget
    monkeypatch.setattr(lexical.TextIndex, "postings", property(lambda self: postings(self).withColumn("term", mark("string")("term"))))
    assert len(list(lexical.question_groups(queries, "query_id", F.lit(1)))) == 2
    assert found(lexical.lexical_topk(index, queries, 3)) == whole
    assert seen.value == rows


def test_questions_are_run_once(spark):
    mark, seen = counted(spark)
    docs = spark.createDataFrame(list(enumerate(WORDS)), "chunk_id long, text string")
    queries = spark.createDataFrame(list(enumerate(["cat moon", "dog", "unknown"])), "query_id long, question string")
    assert found(retrieval.bm25_topk(queries.withColumn("question", mark("string")("question")), docs, 3)) == found(retrieval.bm25_topk(queries, docs, 3))
    assert seen.value == 3


def test_a_block_is_written_by_the_task_that_packs_it(spark):
    docs = spark.createDataFrame(list(enumerate(WORDS)), "chunk_id long, text string")
    index = lexical.build_text_index(docs, block_rows=2)
    files = index.postings.select("block", F.input_file_name().alias("file")).groupBy("block").agg(F.countDistinct("file").alias("n")).agg(F.max("n"), F.count("*")).first()
    assert files[0] == 1 and files[1] > 10
    assert index.mean == 4.0 and index.texts == 60
    empty = lexical.build_text_index(docs.limit(0))
    assert (empty.mean, empty.texts, empty.postings.count()) == (0.0, 0, 0)


ODD_DOCS = [(0, "cat tree"), (0, "cat tree"), (1, None), (2, ""), (3, "tree tree"), (4, "...")]
ODD_ASKED = [(0, "cat tree"), (0, "cat tree"), (1, None), (2, ""), (3, "moon"), (None, "tree")]
#: A question that comes twice has its terms twice, and one without an id has none.
ODD_HITS = [(0, 0, 2.222731, 1), (0, 3, 1.248202, 2)]


def test_odd_rows_are_searched_as_before(spark):
    docs = spark.createDataFrame(ODD_DOCS, "chunk_id long, text string")
    queries = spark.createDataFrame(ODD_ASKED, "query_id long, question string")
    got = sorted((r.query_id, r.chunk_id, round(r.score, 6), r["rank"]) for r in retrieval.bm25_topk(queries, docs, 3).collect())
    assert got == ODD_HITS
    assert retrieval.bm25_topk(queries.limit(0), docs, 3).count() == 0
    assert retrieval.bm25_topk(queries, docs.limit(0), 3).count() == 0


def test_vectors_are_read_twice_for_an_index(spark):
    mark, seen = counted(spark)
    rows = vectors(spark, np.random.default_rng(2).normal(size=(90, 4)), "chunk_id")
    index = cells.build_vector_index(rows.withColumn("embedding", mark("array<float>")("embedding")))
    assert seen.value == 2 * 90
    assert int(index.sizes.sum()) == 90 and len(index.centres) == 9
    assert index.packed.agg(F.sum(F.size("ids"))).first()[0] == 90


def test_texts_are_read_for_hits_over_the_cut_only(spark, small_indexes, monkeypatch):
    kept = []
    carried = retrieval.add_carried
    monkeypatch.setattr(retrieval, "add_carried", lambda hits, *rest: (kept.append(hits.count()) if rest[-1] else None, carried(hits, *rest))[1])
    got = {r.query_id: r for r in retrieval.multi_source_retrieve(asked(spark), small_indexes).collect()}
    # Of two policies and one fine, the far policy is under the cut.
    assert kept == [1, 0, 1]
    assert got[0].sources_queried == ["policy", "fines"] and "far" not in got[0].retrieved_context


def test_a_search_that_nobody_asks_for_reads_no_index(spark, monkeypatch):
    docs = spark.createDataFrame([(i, t, [float(i), 1.0]) for i, t in enumerate(WORDS)], "chunk_id long, text string, embedding array<float>")
    nobody = spark.createDataFrame([], "query_id long, question string, embedding array<float>")
    index = lexical.build_text_index(docs, vector="embedding")
    want = [(f.name, f.dataType) for f in retrieval.hybrid_topk(nobody.union(spark.createDataFrame([(0, "cat", [1.0, 1.0])], nobody.schema)), docs, 2, index=index).schema]
    monkeypatch.setattr(lexical.TextIndex, "postings", property(lambda self: pytest.fail("postings are read")))
    monkeypatch.setattr(lexical.TextIndex, "packed_vectors", property(lambda self: pytest.fail("vectors are read")))
    got = retrieval.hybrid_topk(nobody, docs, 2, carry=["text"], index=index)
    assert got.count() == 0 and [(f.name, f.dataType) for f in got.schema][:4] == want
    assert retrieval.bm25_topk(nobody, docs, 2, index=index).count() == 0
    assert retrieval.dense_topk(nobody, docs, 2).count() == 0
