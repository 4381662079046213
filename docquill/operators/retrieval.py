"""Ranked passages for a batch of questions: dense, lexical, fused, from several sources."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import contains_any, is_blank, ratio, strip, tokens, word_count
from ..session import shared_dir
from .cells import VectorIndex, build_vector_index, dense_index_topk
from .drift import is_keyword
from .lexical import TextIndex, build_text_index, fused_topk, lexical_topk
from .sizes import settle

# The rank fusion constant, the score a passage must exceed.
FUSION_OFFSET = 60
SCORE_CUT = 0.35


def add_carried(hits: DataFrame, corpus: DataFrame, qid: str, cid: str, carry: list[str] | None) -> DataFrame:
    """Hits with columns of their rows; broadcast if they are measured and few."""
    if not carry:
        return hits
    return corpus.select(cid, *carry).join(settle(hits), cid).select(qid, cid, "score", "rank", *carry)


def dense_topk(
    queries: DataFrame,
    corpus: DataFrame,
    k: int = 3,
    qid: str = "query_id",
    cid: str = "chunk_id",
    vector: str = "embedding",
    carry: list[str] | None = None,
    index: VectorIndex | None = None,
) -> DataFrame:
    """The k nearest rows per query vector; score is 1 / (1 + squared distance). Exact, over an index of the corpus."""
    index = index or build_vector_index(corpus, cid, vector)
    return add_carried(dense_index_topk(index, queries, k, qid, vector), corpus, qid, cid, carry)


def bm25_topk(
    queries: DataFrame,
    corpus: DataFrame,
    k: int = 3,
    qid: str = "query_id",
    cid: str = "chunk_id",
    qtext: str = "question",
    ctext: str = "text",
    carry: list[str] | None = None,
    index: TextIndex | None = None,
) -> DataFrame:
    """The k best rows per question by BM25; rows without any of its terms are no hits. Exact, over an index of the corpus."""
    index = index or build_text_index(corpus, cid, ctext)
    # A search reads its questions several times; what they come from is run once.
    shared_dir(queries.sparkSession)
    queries = queries.select(qid, qtext).checkpoint()
    return add_carried(lexical_topk(index, queries, k, qid, qtext), corpus, qid, cid, carry)


def hybrid_topk(
    queries: DataFrame,
    corpus: DataFrame,
    k: int = 3,
    qid: str = "query_id",
    cid: str = "chunk_id",
    vector: str = "embedding",
    qtext: str = "question",
    ctext: str = "text",
    carry: list[str] | None = None,
    index: TextIndex | None = None,
) -> DataFrame:
    """The k best rows by the whole dense and lexical rankings, fused; first place in both scores 1."""
    index = index or build_text_index(corpus, cid, ctext, vector)
    return add_carried(fused_topk(index, queries, k, FUSION_OFFSET, qid, qtext, vector), corpus, qid, cid, carry)


def fuse_ranks(*rankings: DataFrame, k: int, qid: str = "query_id", cid: str = "chunk_id") -> DataFrame:
    """Reciprocal rank fusion of rankings at hand, scaled so that first place in two of them scores 1."""
    rows = rankings[0].select(qid, cid, "rank")
    for other in rankings[1:]:
        rows = rows.unionByName(other.select(qid, cid, "rank"))
    share = F.round(F.sum(F.lit(1.0) / (F.col("rank") + FUSION_OFFSET)) * ((FUSION_OFFSET + 1) / 2.0), 9)
    order = Window.partitionBy(qid).orderBy(F.desc("score"), cid)
    fused = rows.groupBy(qid, cid).agg(share.alias("score"))
    return fused.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


@dataclass(frozen=True)
class Source:
    """The passages of a source and the index that it is searched by, built once for any number of rounds."""

    rows: DataFrame
    index: TextIndex | VectorIndex


def open_sources(indexes: Mapping[str, DataFrame | Source]) -> dict[str, Source]:
    """Every source with its index: postings and vectors for fused search, cells for search by vectors only.

    Rows are read when the index is built and by every search, for the hits' texts: give tables, not joins.
    """
    return {
        name: rows if isinstance(rows, Source)
        else Source(rows, build_text_index(rows, vector="embedding") if name in HYBRID_SOURCES else build_vector_index(rows))
        for name, rows in indexes.items()
    }


def score_cut(hits: DataFrame, cut: float = SCORE_CUT) -> DataFrame:
    """Hits with a score over the cut; applied after ranking."""
    return hits.filter(F.col("score") > cut)


# Routing: one pattern per source, after the descriptions of the three sources.
ROUTES: dict[str, str] = {
    "policy": r"\b(?:polic(?:y|ies)|procedures?|retain(?:ed)?|retention|how long|internal|guidelines?|operational|forgotten|erasure)\b",
    "legislation": r"\b(?:articles?|regulations?|laws?|legal|legislation|statut(?:e|es|ory)|requirements?|rights?)\b",
    "fines": r"\b(?:fines?|fined|penalt(?:y|ies)|enforcement|sanctions?|companies)\b",
}


def route_sources(df: DataFrame, question: str = "question") -> DataFrame:
    """Add query_policy, query_legislation and query_fines."""
    text = F.coalesce(F.lower(question), F.lit(""))
    return df.withColumns({f"query_{s}": text.rlike(p) for s, p in ROUTES.items()})


# How a passage is quoted, and what stands between passages.
QUOTES: dict[str, tuple[str, bool]] = {
    "policy": ("[SOURCE: Internal Retail Policy | Section: ", True),
    "legislation": ("[SOURCE: GDPR Legislation | Article: ", True),
    "fines": ("[SOURCE: Enforcement History & Fines Precedent", False),
}
SEPARATOR = "\n\n---\n\n"
HYBRID_SOURCES = ("fines",)


def _quote(source: str) -> Column:
    head, labelled = QUOTES[source]
    label = [F.coalesce(F.col("label"), F.lit(""))] if labelled else []
    return F.concat(F.lit(head), *label, F.lit("]\nContent: "), F.coalesce(F.col("text"), F.lit("")))


def _search_sources(
    asked: Mapping[str, DataFrame],
    indexes: Mapping[str, DataFrame | Source],
    k: int,
    cut: float,
    qid: str,
    query: str,
) -> DataFrame:
    """(qid, found): the quoted passages of all sources, policy first, best first."""
    parts = []
    sources = open_sources(indexes)
    for number, source in enumerate(QUOTES):
        if source not in sources:
            continue
        queries, own = asked[source], sources[source]
        if source in HYBRID_SOURCES:
            hits = hybrid_topk(queries, own.rows, k, qid=qid, qtext=query, index=own.index)
        else:
            hits = dense_topk(queries, own.rows, k, qid=qid, index=own.index)
        # Texts are read for hits over the cut only, and not at all if there are none.
        hits = add_carried(score_cut(hits, cut), own.rows, qid, "chunk_id", ["label", "text"])
        parts.append(
            hits.select(qid, F.struct(F.lit(number).alias("source"), "rank", _quote(source).alias("quote")).alias("hit"))
        )
    hits = parts[0]
    for part in parts[1:]:
        hits = hits.unionByName(part)
    # At most k passages per source and question come together here.
    return hits.groupBy(qid).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list("hit")), lambda h: h["quote"]), SEPARATOR).alias("found")
    )


def multi_source_retrieve(
    questions: DataFrame,
    indexes: Mapping[str, DataFrame | Source],
    k: int = 3,
    cut: float = SCORE_CUT,
    qid: str = "query_id",
    query: str = "question",
) -> DataFrame:
    """Search the routed sources and assemble the context.

    `questions` has the query_* flags, the text and the embedding; each index
    has chunk_id, label, text and embedding, or is a `Source` opened before.
    """
    # Every source's search reads its questions several times.
    shared_dir(questions.sparkSession)
    questions = questions.checkpoint()
    asked = {s: questions.filter(f"query_{s}") for s in QUOTES}
    found = _search_sources(asked, indexes, k, cut, qid, query)
    queried = F.filter(
        F.array(*[F.when(F.col(f"query_{s}"), s) for s in QUOTES]), lambda s: s.isNotNull()
    )
    loops = F.col("retrieval_loop_count") if "retrieval_loop_count" in questions.columns else F.lit(0)
    return (
        questions.join(found, qid, "left")
        .withColumns(
            {
                "retrieved_context": F.coalesce("found", F.lit("")),
                "sources_queried": queried,
                "retrieval_loop_count": loops + 1,
            }
        )
        .drop("found")
    )


def expand_sources(
    state: DataFrame,
    indexes: Mapping[str, DataFrame | Source],
    k: int = 5,
    cut: float = SCORE_CUT,
    qid: str = "query_id",
    query: str = "question",
) -> DataFrame:
    """Search the sources not queried so far and append what they give to the context."""
    # Every source's search reads its questions several times; what found the context so far is run once.
    shared_dir(state.sparkSession)
    state = state.checkpoint()
    asked = {s: state.filter(~F.array_contains("sources_queried", s)) for s in QUOTES}
    found = _search_sources(asked, indexes, k, cut, qid, query)
    old, new = F.coalesce("retrieved_context", F.lit("")), F.coalesce("found", F.lit(""))
    combined = (
        F.when(is_blank(new), old).when(is_blank(old), new).otherwise(strip(F.concat(old, F.lit(SEPARATOR), new)))
    )
    rest = F.filter(
        F.array(*[F.lit(s) for s in QUOTES]), lambda s: ~F.array_contains(F.col("sources_queried"), s)
    )
    return (
        state.join(found, qid, "left")
        .withColumns(
            {
                "retrieved_context": combined,
                "sources_queried": F.concat("sources_queried", rest),
                "retrieval_loop_count": F.col("retrieval_loop_count") + 1,
                "expanded_search_used": F.lit(True),
            }
        )
        .drop("found")
    )


def context_relevance(df: DataFrame, context: str = "retrieved_context") -> DataFrame:
    """Add has_context: the context is more than whitespace."""
    return df.withColumn("has_context", ~is_blank(F.col(context)))


# Phrases of incomplete answers, verbs that ask for examples, limits.
INCOMPLETE_PHRASES = [
    "does not specify",
    "unclear from the context",
    "not provided in",
    "no information",
    "context does not",
    "insufficient information",
    "does not contain",
    "not mentioned",
    "no details",
]
EXAMPLE_PHRASES = ["handle", "approach", "deal with", "respond to"]
EXAMPLE_MARK = "SOURCE: Enforcement"
SHORT_ANSWER_WORDS = 20
WEAK_CONTEXT_CHARS = 200


def answer_completeness(df: DataFrame, answer: str = "generated_answer", context: str = "retrieved_context") -> DataFrame:
    """Add is_answer_complete: no phrase of doubt, and not both short and weakly supported."""
    text, ctx = F.coalesce(answer, F.lit("")), F.coalesce(context, F.lit(""))
    doubtful = contains_any(F.lower(text), INCOMPLETE_PHRASES)
    thin = (word_count(text) < SHORT_ANSWER_WORDS) & (F.length(ctx) < WEAK_CONTEXT_CHARS)
    return df.withColumn("is_answer_complete", ~(doubtful | thin))


def source_coverage(df: DataFrame, question: str = "original_question", context: str = "retrieved_context") -> DataFrame:
    """Add needs_example_expansion: examples are asked for and the context has none."""
    wants = contains_any(F.lower(question), EXAMPLE_PHRASES)
    has = F.contains(F.coalesce(context, F.lit("")), F.lit(EXAMPLE_MARK))
    return df.withColumn("needs_example_expansion", wants & ~has)


MAX_RETRIEVALS = 3
MAX_GENERATIONS = 3
MAX_RETRIES = 2


def next_step(df: DataFrame, grounded: str = "is_grounded") -> DataFrame:
    """Add the four routing decisions for a table of states."""
    used = F.coalesce("expanded_search_used", F.lit(False))
    has_context = ~is_blank(F.col("retrieved_context"))
    return df.withColumns(
        {
            "after_retrieval": F.when(
                (F.col("retrieval_loop_count") >= MAX_RETRIEVALS) | has_context, "generate_response"
            ).otherwise("rewrite_query"),
            "after_source_check": F.when(
                ~used & F.coalesce("needs_example_expansion", F.lit(False)), "expand_all_sources"
            ).otherwise("check_completeness"),
            "after_completeness": F.when(
                (F.col("retrieval_loop_count") >= MAX_RETRIES) | used | F.coalesce("is_answer_complete", F.lit(True)),
                "verify_output",
            ).otherwise("expand_all_sources"),
            "after_verification": F.when(F.col("generation_loop_count") >= MAX_GENERATIONS, "return_fallback")
            .when(F.col(grounded), "end")
            .otherwise("regenerate_strict"),
        }
    )


def query_keywords(question: Column) -> Column:
    """A question as its distinct keywords, in order."""
    return F.array_join(F.array_distinct(F.filter(F.split(F.lower(question), " "), is_keyword)), " ")


# Fixed value: what precedes an answer that is not grounded.
WARNING = """**GROUNDEDNESS WARNING**: This answer may contain information not fully supported by the retrieved documents. The system attempted multiple times to generate a fully grounded response but was unable to do so. Please verify critical details with a GDPR compliance expert before taking action.

    ---

    """
GROUNDED_SHARE = 0.5


def groundedness(
    df: DataFrame,
    answer: str = "generated_answer",
    context: str = "retrieved_context",
    share: float = GROUNDED_SHARE,
) -> DataFrame:
    """Add support (share of distinct answer tokens in the context), is_grounded and the answer to return."""
    said = F.array_distinct(tokens(F.coalesce(answer, F.lit(""))))
    known = tokens(F.coalesce(context, F.lit("")))
    support = F.coalesce(ratio(F.size(F.array_intersect(said, known)), F.size(said)), F.lit(1.0))
    return df.withColumn("support", support).withColumns(
        {
            "is_grounded": F.col("support") >= share,
            "returned_answer": F.when(F.col("support") >= share, F.col(answer)).otherwise(
                F.concat(F.lit(WARNING), F.col(answer))
            ),
        }
    )


def retrieval_rounds(
    questions: DataFrame,
    search: Callable[[DataFrame], DataFrame],
    qid: str = "query_id",
    original: str = "original_question",
    current: str = "question",
    rounds: int = MAX_RETRIEVALS,
) -> DataFrame:
    """Search, rewrite the questions left without context, and search again.

    `search` adds retrieved_context and retrieval_loop_count. Each round is
    checkpointed, so plans do not grow and a lost executor costs one round.
    """
    shared_dir(questions.sparkSession)
    pending = questions.withColumn("retrieval_loop_count", F.lit(0))
    finished: list[DataFrame] = []
    for number in range(1, rounds + 1):
        found = context_relevance(search(pending)).checkpoint()
        last = number == rounds
        finished.append(found if last else found.filter("has_context"))
        if last:
            break
        pending = found.filter("NOT has_context").withColumn(current, query_keywords(F.col(original)))
        if pending.isEmpty():
            break
        pending = pending.drop("retrieved_context", "sources_queried", "has_context")
    out = finished[0]
    for part in finished[1:]:
        out = out.unionByName(part)
    return out
