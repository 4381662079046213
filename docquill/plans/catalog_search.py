"""Queries over questions and passages."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import answering, retrieval
from . import testbed
from .testbed import table


def _scores(df):
    return df.withColumn("score", F.round("score", 6))


def _centres(s, d):
    """The mean vector of each label."""
    vectors = table(s, d, "embeddings")
    means = vectors.select("label", F.posexplode("embedding").alias("at", "x")).groupBy("label", "at").agg(
        F.avg("x").alias("x")
    )
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("at", "x"))), lambda e: e["x"])
    return means.groupBy(F.col("label").alias("query_id")).agg(ordered.alias("embedding"))


def _vectors(s, d):
    return table(s, d, "embeddings").select(F.col("vec_id").alias("chunk_id"), "embedding")


def _docs(s, d):
    return table(s, d, "documents").select(F.col("doc_id").alias("chunk_id"), "lang", "text")


def _dense(s, d):
    return retrieval.dense_topk(testbed.queries(s, d), _vectors(s, d), 3)


def _centre_hits(s, d):
    return retrieval.dense_topk(_centres(s, d), _vectors(s, d), 10)


def _bm25(s, d):
    return retrieval.bm25_topk(testbed.queries(s, d), _docs(s, d), 5, carry=["lang"])


def _hybrid(s, d):
    return retrieval.hybrid_topk(testbed.queries(s, d), testbed.passages(s, d), 5)


def _routed(s, d):
    return retrieval.route_sources(testbed.routed(s, d))


def _retrieved(s, d):
    return retrieval.multi_source_retrieve(_routed(s, d), testbed.indexes(s, d))


def _contexts(df, *more):
    return df.select(
        "query_id",
        "retrieved_context",
        F.array_join("sources_queried", ",").alias("sources_queried"),
        "retrieval_loop_count",
        *more,
    )


def _expanded(s, d):
    sources = retrieval.open_sources(testbed.indexes(s, d))
    state = retrieval.multi_source_retrieve(_routed(s, d), sources)
    return _contexts(retrieval.expand_sources(state, sources), "expanded_search_used")


def _rounds(s, d):
    indexes = retrieval.open_sources(testbed.indexes(s, d))

    def search(rows):
        return retrieval.multi_source_retrieve(rows, indexes)

    out = retrieval.retrieval_rounds(_routed(s, d), search)
    return _contexts(out, "has_context", "question")


def _answers(s, d):
    sources = retrieval.open_sources(testbed.indexes(s, d))
    out = answering.answer_questions(
        testbed.asked(s, d),
        lambda rows: retrieval.multi_source_retrieve(retrieval.route_sources(rows), sources),
        lambda rows: retrieval.expand_sources(rows, sources),
        testbed.write_answer,
        testbed.write_strictly,
    )
    path = F.array_join("path", ">").alias("path")
    return _contexts(out, "generation_loop_count", "expanded_search_used", "generated_answer", path)


def _state(s, d):
    return testbed.states(table(s, d, "events"))


def _next_step(s, d):
    rows = retrieval.source_coverage(retrieval.answer_completeness(_state(s, d)))
    steps = retrieval.next_step(retrieval.groundedness(rows))
    return steps.select(
        "request_id", "after_retrieval", "after_source_check", "after_completeness", "after_verification"
    )


QUERIES = {
    "dense_topk": lambda s, d: _scores(_dense(s, d)),
    "dense_topk_centres": lambda s, d: _scores(_centre_hits(s, d)),
    "bm25_topk": lambda s, d: _scores(_bm25(s, d)),
    "hybrid_topk": lambda s, d: _scores(_hybrid(s, d)),
    "score_cut": lambda s, d: _scores(retrieval.score_cut(_dense(s, d), 0.42)),
    "route_sources": lambda s, d: retrieval.route_sources(testbed.requests(table(s, d, "events"))).select(
        "request_id", "query_policy", "query_legislation", "query_fines"
    ),
    "multi_source_retrieve": lambda s, d: _contexts(_retrieved(s, d)),
    "expand_sources": _expanded,
    "context_relevance": lambda s, d: retrieval.context_relevance(_state(s, d)).select("request_id", "has_context"),
    "answer_completeness": lambda s, d: retrieval.answer_completeness(_state(s, d)).select(
        "request_id", "is_answer_complete"
    ),
    "source_coverage": lambda s, d: retrieval.source_coverage(_state(s, d)).select(
        "request_id", "needs_example_expansion"
    ),
    "next_step": _next_step,
    "retrieval_rounds": _rounds,
    "answer_questions": _answers,
    "query_keywords": lambda s, d: table(s, d, "documents").select(
        "doc_id", retrieval.query_keywords(F.col("text")).alias("keywords")
    ),
    "groundedness": lambda s, d: retrieval.groundedness(_state(s, d)).select(
        "request_id", F.round("support", 6).alias("support"), "is_grounded", "returned_answer"
    ),
}
