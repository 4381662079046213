"""DuckDB SQL for the queries over questions and passages."""

from __future__ import annotations

from .oracle_log import sql_str, with_raw
from .oracle_values import EXAMPLE_PHRASES, INCOMPLETE_PHRASES, OPENINGS, QUOTES, ROUTES, STOP_WORDS, WARNING

QUESTIONS = """q AS (
  SELECT b.item_id AS query_id, b.text AS question, CAST(e.embedding AS DOUBLE[]) AS v
  FROM benchmark b JOIN embeddings e ON b.item_id = e.vec_id)"""
VECTORS = "c AS (SELECT vec_id AS chunk_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings)"
CENTRES = """means AS (
  SELECT label, pos, avg(x) AS x FROM (
    SELECT label, unnest(CAST(embedding AS DOUBLE[])) AS x, unnest(range(1, len(embedding) + 1)) AS pos FROM embeddings)
  GROUP BY label, pos),
q AS (SELECT label AS query_id, list(x ORDER BY pos) AS v FROM means GROUP BY label)"""
PASSAGES = """p AS (
  SELECT d.doc_id AS chunk_id, d.lang AS label, d.text, CAST(e.embedding AS DOUBLE[]) AS v,
    CASE e.label % 3 WHEN 0 THEN 'policy' WHEN 1 THEN 'legislation' ELSE 'fines' END AS source
  FROM documents d JOIN embeddings e ON d.doc_id % (SELECT count(*) FROM embeddings) = e.vec_id)"""


def toks(x: str) -> str:
    return f"list_filter(regexp_split_to_array(lower({x}), '[^\\p{{L}}\\p{{N}}]+'), lambda w: w <> '')"


def dense(q: str, c: str, k: int, out: str) -> str:
    return f"""{out}_s AS (
  SELECT query_id, chunk_id, round(1 / (1 + list_distance({q}.v, {c}.v) ** 2), 9) AS score FROM {q}, {c}),
{out} AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, chunk_id) AS rank
    FROM {out}_s) WHERE rank <= {k})"""


def bm25(q: str, c: str, k: int, out: str) -> str:
    return f"""{out}_t AS (SELECT chunk_id, {toks("text")} AS ts FROM {c}),
{out}_n AS (SELECT count(*) AS n, avg(len(ts)) AS mean FROM {out}_t),
{out}_tf AS (
  SELECT chunk_id, dl, term, count(*) AS tf
  FROM (SELECT chunk_id, len(ts) AS dl, unnest(ts) AS term FROM {out}_t) GROUP BY ALL),
{out}_df AS (SELECT term, count(*) AS df FROM {out}_tf GROUP BY term),
{out}_q AS (SELECT DISTINCT query_id, unnest({toks("question")}) AS term FROM {q}),
{out}_s AS (
  SELECT query_id, chunk_id, round(sum(ln(1 + (n - df + 0.5::DOUBLE) / (df + 0.5::DOUBLE))
    * (tf * 2.2::DOUBLE / (tf + 1.2::DOUBLE * (0.25::DOUBLE + 0.75::DOUBLE * dl / mean)))), 9) AS score
  FROM {out}_q JOIN {out}_tf USING (term) JOIN {out}_df USING (term), {out}_n GROUP BY query_id, chunk_id),
{out} AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, chunk_id) AS rank
    FROM {out}_s) WHERE rank <= {k})"""


def hybrid(q: str, c: str, k: int, out: str) -> str:
    return f"""{dense(q, c, 10**9, out + "_d")},
{bm25(q, c, 10**9, out + "_l")},
{out}_f AS (
  SELECT query_id, chunk_id, round(sum(1.0::DOUBLE / (60 + rank)) * 30.5::DOUBLE, 9) AS score
  FROM (SELECT query_id, chunk_id, rank FROM {out}_d UNION ALL SELECT query_id, chunk_id, rank FROM {out}_l)
  GROUP BY query_id, chunk_id),
{out} AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, chunk_id) AS rank
    FROM {out}_f) WHERE rank <= {k})"""


_opening = "CASE query_id % 5 " + " ".join(f"WHEN {i} THEN {sql_str(x)}" for i, x in enumerate(OPENINGS)) + " END"
ROUTED = f"""{QUESTIONS},
{PASSAGES},
rq0 AS (SELECT query_id, v, {_opening} || question AS question FROM q),
rq AS (SELECT *, {", ".join(f"regexp_matches(lower(question), {sql_str(p)}) AS query_{s}" for s, p in ROUTES.items())} FROM rq0)"""
SEP = "chr(10) || chr(10) || '---' || chr(10) || chr(10)"


def search(tag: str, asked: str, k: int) -> str:
    """CTEs that end in `<tag>found`; `asked` is a condition with {s} for the source."""
    ctes, union = [], []
    for i, (source, (head, labelled)) in enumerate(QUOTES.items()):
        q, c, out = f"{tag}q{i}", f"{tag}c{i}", f"{tag}h{i}"
        ctes.append(f"{q} AS (SELECT * FROM {tag}base WHERE {asked.format(s=source)})")
        ctes.append(f"{c} AS (SELECT * FROM p WHERE source = '{source}')")
        ctes.append((hybrid if source == "fines" else dense)(q, c, k, out))
        label = "|| label" if labelled else ""
        union.append(
            f"""SELECT query_id, {i} AS sno, rank, {sql_str(head)} {label} || ']' || chr(10) || 'Content: ' || text AS quote
  FROM {out} JOIN {c} USING (chunk_id) WHERE score > 0.35"""
        )
    ctes.append(f"{tag}hits AS ({' UNION ALL '.join(union)})")
    ctes.append(
        f"{tag}found AS (SELECT query_id, string_agg(quote, {SEP} ORDER BY sno, rank) AS found FROM {tag}hits GROUP BY query_id)"
    )
    return ",\n".join(ctes)


_flags = ", ".join(f"CASE WHEN query_{s} THEN '{s}' END" for s in QUOTES)
RETRIEVED = f"""{ROUTED},
abase AS (SELECT * FROM rq),
{search("a", "query_{s}", 3)},
got AS (
  SELECT rq.*, coalesce(found, '') AS retrieved_context, concat_ws(',', {_flags}) AS sources_queried,
    1 AS retrieval_loop_count FROM rq LEFT JOIN afound USING (query_id))"""
_rest = ", ".join(f"CASE WHEN NOT query_{s} THEN '{s}' END" for s in QUOTES)
EXPANDED = f"""{RETRIEVED},
bbase AS (SELECT * FROM got),
{search("b", "NOT query_{s}", 5)},
more AS (
  SELECT query_id, CASE WHEN coalesce(found, '') = '' THEN retrieved_context WHEN retrieved_context = '' THEN found
    ELSE regexp_replace(retrieved_context || {SEP} || found, '^\\s+|\\s+$', '', 'g') END AS retrieved_context,
    concat_ws(',', nullif(sources_queried, ''), nullif(concat_ws(',', {_rest}), '')) AS sources_queried,
    2 AS retrieval_loop_count, true AS expanded_search_used FROM got LEFT JOIN bfound USING (query_id))"""

_stop = ", ".join(sql_str(w) for w in STOP_WORDS)


def keywords(source: str, key: str, text: str) -> str:
    return f"""kw0 AS (
  SELECT {key}, unnest(string_split(lower({text}), ' ')) AS w,
    unnest(range(len(string_split(lower({text}), ' ')))) AS pos FROM {source}),
kw1 AS (
  SELECT {key}, w, min(pos) AS pos FROM kw0
  WHERE length(w) > 4 AND NOT regexp_matches(w, '[^a-z]') AND w NOT IN ({_stop}) GROUP BY {key}, w),
kw AS (SELECT {key}, string_agg(w, ' ' ORDER BY pos) AS keywords FROM kw1 GROUP BY {key})"""


def any_of(x: str, phrases: list[str]) -> str:
    return "(" + " OR ".join(f"contains({x}, {sql_str(p)})" for p in phrases) + ")"


ANSWERS = f"""{QUESTIONS},
{PASSAGES},
an0 AS (SELECT query_id, v, CASE WHEN query_id % 3 = 0 AND query_id % 5 <> 4 THEN 'How should we handle it? ' ELSE '' END
  || {_opening} || question AS question FROM q),
an1 AS (SELECT *, {", ".join(f"regexp_matches(lower(question), {sql_str(p)}) AS query_{s}" for s, p in ROUTES.items())} FROM an0),
abase AS (SELECT * FROM an1),
{search("a", "query_{s}", 3)},
{keywords("an1", "query_id", "question")},
r1 AS (
  SELECT an1.* EXCLUDE (question), question AS original, coalesce(found, '') AS ctx,
    CASE WHEN coalesce(found, '') = '' THEN coalesce(keywords, '') ELSE question END AS question,
    CASE WHEN coalesce(found, '') = '' THEN 3 ELSE 1 END AS loops,
    CASE WHEN coalesce(found, '') = '' THEN 'retrieve>rewrite_query>retrieve>rewrite_query>retrieve' ELSE 'retrieve' END AS path,
    concat_ws(',', {_flags}) AS sources
  FROM an1 LEFT JOIN afound USING (query_id) LEFT JOIN kw USING (query_id)),
{{first}},
g1c AS (
  SELECT *, {any_of("lower(original)", EXAMPLE_PHRASES)} AND NOT contains(ctx, 'SOURCE: Enforcement') AS wants,
    NOT ({any_of("lower(answer)", INCOMPLETE_PHRASES)}
      OR (len(list_filter(regexp_split_to_array(answer, '\\s+'), lambda w: w <> '')) < 20 AND length(ctx) < 200)) AS complete
  FROM g1),
e1 AS (SELECT *, wants OR (loops < 2 AND NOT complete) AS expands FROM g1c),
bbase AS (SELECT * FROM e1 WHERE expands),
{search("b", "NOT query_{s}", 5)},
e2 AS (
  SELECT e1.* EXCLUDE (ctx, loops, sources, path, answer), 1 + CAST(expands AS INT) AS gens, answer AS answer1,
    CASE WHEN coalesce(found, '') = '' THEN ctx WHEN ctx = '' THEN found
      ELSE regexp_replace(ctx || {SEP} || found, '^\\s+|\\s+$', '', 'g') END AS ctx,
    loops + CAST(expands AS INT) AS loops,
    CASE WHEN expands THEN concat_ws(',', nullif(sources, ''), nullif(concat_ws(',', {_rest}), '')) ELSE sources END AS sources,
    path || '>generate_response' || CASE WHEN expands THEN '>expand_all_sources>generate_response' ELSE '' END AS path
  FROM e1 LEFT JOIN bfound USING (query_id)),
{{second}}"""


def _grounded(answer: str) -> str:
    said = f"list_distinct({toks(answer)})"
    return f"coalesce(CAST(len(list_intersect({said}, {toks('ctx')})) AS DOUBLE) / nullif(len({said}), 0), 1.0) >= 0.5"


def _quote_words(n: int) -> str:
    return f"array_to_string(string_split(ctx, ' ')[1:{n}], ' ')"


_answer = f"""CASE query_id % 4 WHEN 0 THEN {_quote_words(40)} WHEN 1 THEN 'The context does not specify ' || original
    ELSE 'Unrelated words only: zebra quartz violin number ' || query_id END"""
_strict = f"CASE query_id % 4 WHEN 3 THEN 'Still zebra quartz violin number ' || query_id ELSE {_quote_words(30)} END"
ANSWERS = ANSWERS.replace("{first}", f"g1 AS (SELECT *, {_answer} AS answer FROM r1)").replace(
    "{second}",
    f"""a1 AS (SELECT *, {_answer} AS answer FROM e2),
a2 AS (SELECT *, {_strict} AS strict, {_grounded("answer")} AS good FROM a1),
a3 AS (SELECT *, {_grounded("strict")} AS strict_good FROM a2)
SELECT query_id, ctx AS retrieved_context, sources AS sources_queried, loops AS retrieval_loop_count,
  CASE WHEN good THEN gens WHEN gens = 1 AND strict_good THEN 2 ELSE 3 END AS generation_loop_count,
  expands AS expanded_search_used,
  CASE WHEN good THEN answer WHEN gens = 1 AND strict_good THEN strict ELSE {sql_str(WARNING)} || strict END AS generated_answer,
  path || CASE WHEN good THEN '' WHEN gens = 1 AND strict_good THEN '>regenerate_strict'
    WHEN gens = 1 THEN '>regenerate_strict>regenerate_strict>return_fallback'
    ELSE '>regenerate_strict>return_fallback' END AS path
FROM a3""",
)

STATE = f"""st AS (
  SELECT request_id, question AS original_question, answer AS generated_answer, context AS retrieved_context,
    event_id % 4 AS retrieval_loop_count, (event_id // 4) % 4 AS generation_loop_count,
    (event_id // 16) % 2 = 1 AS expanded_search_used, coalesce(answer, '') AS a, coalesce(context, '') AS x FROM raw),
st1 AS (
  SELECT *, regexp_matches(x, '\\S') AS has_context,
    NOT ({any_of("lower(a)", INCOMPLETE_PHRASES)}
      OR (len(list_filter(regexp_split_to_array(a, '\\s+'), lambda w: w <> '')) < 20 AND length(x) < 200))
      AS is_answer_complete,
    {any_of("lower(original_question)", EXAMPLE_PHRASES)} AND NOT contains(x, 'SOURCE: Enforcement')
      AS needs_example_expansion,
    list_distinct({toks("a")}) AS said, {toks("x")} AS known FROM st),
st2 AS (
  SELECT *, coalesce(CAST(len(list_intersect(said, known)) AS DOUBLE) / nullif(len(said), 0), 1.0) AS support
  FROM st1)"""

SQL: dict[str, str] = {
    "dense_topk": f"""WITH {QUESTIONS}, {VECTORS}, {dense("q", "c", 3, "h")}
  SELECT query_id, chunk_id, round(score, 6) AS score, rank FROM h""",
    "dense_topk_centres": f"""WITH {CENTRES}, {VECTORS}, {dense("q", "c", 10, "h")}
  SELECT query_id, chunk_id, round(score, 6) AS score, rank FROM h""",
    "score_cut": f"""WITH {QUESTIONS}, {VECTORS}, {dense("q", "c", 3, "h")}
  SELECT query_id, chunk_id, round(score, 6) AS score, rank FROM h WHERE score > 0.42""",
    "bm25_topk": f"""WITH {QUESTIONS}, c AS (SELECT doc_id AS chunk_id, lang, text FROM documents),
  {bm25("q", "c", 5, "h")}
  SELECT query_id, chunk_id, round(score, 6) AS score, rank, lang FROM h JOIN c USING (chunk_id)""",
    "hybrid_topk": f"""WITH {QUESTIONS}, {PASSAGES}, {hybrid("q", "p", 5, "h")}
  SELECT query_id, chunk_id, round(score, 6) AS score, rank FROM h""",
    "route_sources": with_raw(
        "SELECT request_id, "
        + ", ".join(f"regexp_matches(lower(question), {sql_str(p)}) AS query_{s}" for s, p in ROUTES.items())
        + " FROM raw"
    ),
    "multi_source_retrieve": f"""WITH {RETRIEVED}
  SELECT query_id, retrieved_context, sources_queried, retrieval_loop_count FROM got""",
    "expand_sources": f"""WITH {EXPANDED}
  SELECT query_id, retrieved_context, sources_queried, retrieval_loop_count, expanded_search_used FROM more""",
    "retrieval_rounds": f"""WITH {RETRIEVED}, {keywords("got", "query_id", "question")}
  SELECT query_id, retrieved_context, sources_queried,
    CASE WHEN retrieved_context = '' THEN 3 ELSE 1 END AS retrieval_loop_count,
    retrieved_context <> '' AS has_context,
    CASE WHEN retrieved_context = '' THEN coalesce(keywords, '') ELSE question END AS question
  FROM got LEFT JOIN kw USING (query_id)""",
    "answer_questions": f"WITH {ANSWERS}",
    "context_relevance": with_raw("SELECT request_id, has_context FROM st2", STATE),
    "answer_completeness": with_raw("SELECT request_id, is_answer_complete FROM st2", STATE),
    "source_coverage": with_raw("SELECT request_id, needs_example_expansion FROM st2", STATE),
    "next_step": with_raw(
        """SELECT request_id,
  CASE WHEN retrieval_loop_count >= 3 OR has_context THEN 'generate_response' ELSE 'rewrite_query' END AS after_retrieval,
  CASE WHEN expanded_search_used THEN 'check_completeness' WHEN needs_example_expansion THEN 'expand_all_sources'
       ELSE 'check_completeness' END AS after_source_check,
  CASE WHEN retrieval_loop_count >= 2 OR expanded_search_used THEN 'verify_output'
       WHEN NOT is_answer_complete THEN 'expand_all_sources' ELSE 'verify_output' END AS after_completeness,
  CASE WHEN generation_loop_count >= 3 THEN 'return_fallback' WHEN support >= 0.5 THEN 'end'
       ELSE 'regenerate_strict' END AS after_verification FROM st2""",
        STATE,
    ),
    "query_keywords": f"""WITH {keywords("documents", "doc_id", "text")}
  SELECT doc_id, coalesce(keywords, '') AS keywords FROM documents LEFT JOIN kw USING (doc_id)""",
    "groundedness": with_raw(
        f"""SELECT request_id, round(support, 6) AS support, support >= 0.5 AS is_grounded,
  CASE WHEN support >= 0.5 THEN generated_answer ELSE {sql_str(WARNING)} || generated_answer END AS returned_answer
  FROM st2""",
        STATE,
    ),
}
