"""DuckDB SQL for evaluation, quality, the monitoring report, stages and streams."""

from __future__ import annotations

from .oracle_docs import ARTICLES, NL, POLICIES, SNAP
from .oracle_log import SQL as LOG_SQL
from .oracle_log import DRIFT, PERF, cost, errors, refusal, since, sql_str, with_log, with_raw
from .oracle_values import FALLBACK_ARTICLE, FALLBACK_MULTI, FALLBACK_POLICY, FIRST_FINES_CONCEPT, METRICS, MULTI_SUFFIX, SCORES

WORDS = "list_filter(regexp_split_to_array(text, '\\s+'), lambda w: w <> '')"
CASES = f"""cases AS (
  SELECT doc_id, 'case_' || doc_id AS id, lang AS category, source,
    list_filter([{WORDS}[1], {WORDS}[20]], lambda x: x IS NOT NULL) AS articles,
    list_filter([{WORDS}[60]], lambda x: x IS NOT NULL) AS included FROM documents)"""


def results(name: str, ahead: int) -> str:
    missing = "list_sort(list_distinct(list_filter(items, lambda x: NOT contains(txt, lower(x)))))"
    return f"""{name}_r AS (
  SELECT 'case_' || d.doc_id AS id, n.text AS answer,
    CASE WHEN d.lang IN ('en', 'de') THEN d.source || ' ' || d.lang ELSE d.lang END AS context
  FROM documents d JOIN documents n ON n.doc_id = d.doc_id + {ahead}),
{name}_j AS (
  SELECT c.*, lower(coalesce(context, '')) AS ctx,
    lower(coalesce(answer, '') || ' ' || coalesce(context, '')) AS txt, list_concat(articles, included) AS items
  FROM cases c LEFT JOIN {name}_r r ON c.id = r.id),
{name}_s AS (
  SELECT *, CASE WHEN contains(ctx, lower(source)) THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS source_correct,
    len(list_filter(items, lambda x: contains(txt, lower(x)))) AS n_found,
    CASE WHEN len(items) = 0 THEN 1.0::DOUBLE ELSE CAST(n_found AS DOUBLE) / len(items) END AS content_match
  FROM {name}_j),
{name} AS (
  SELECT id AS case_id, category, (source_correct + content_match) / 2 >= 0.7 AS passed,
    (source_correct + content_match) / 2 AS score, source_correct, content_match,
    concat_ws(' | ',
      CASE WHEN source_correct = 1 THEN 'PASS: Retrieved from expected sources: [''' || source || ''']'
           ELSE 'FAIL: Expected sources [''' || source || '''] not found' END,
      CASE WHEN len(items) = 0 THEN NULL
           WHEN content_match >= 0.7 THEN 'PASS: Found ' || n_found || '/' || len(items) || ' expected items'
           ELSE 'FAIL: Missing ' || len({missing}) || ' items: {{'
             || array_to_string(list_transform({missing}, lambda x: '''' || x || ''''), ', ') || '}}' END) AS feedback
  FROM {name}_s)"""


def metrics(source: str, name: str) -> str:
    return f"""{name} AS (
  SELECT count(*) AS total_cases, count(*) FILTER (passed) AS passed, count(*) FILTER (NOT passed) AS failed,
    CAST(count(*) FILTER (passed) AS DOUBLE) / count(*) AS pass_rate, avg(score) AS avg_score,
    avg(source_correct) AS source_accuracy, avg(content_match) AS content_match FROM {source})"""


RUN = f"{CASES},\n{results('res', 1)},\n{metrics('res', 'met')}"
CATEGORY = """cat AS (
  SELECT category, count(*) FILTER (passed) AS passed, count(*) AS total, round(avg(score), 3) AS avg_score,
    round(stddev_samp(score), 3) AS std_dev,
    round(CAST(count(*) FILTER (score >= 0.7) AS DOUBLE) / count(*), 6) AS pass_rate,
    count(*) FILTER (passed) || '/' || count(*) AS pass_total FROM res GROUP BY category)"""


def metric_rows(source: str, value: str) -> str:
    return " UNION ALL ".join(f"SELECT '{m}' AS metric, CAST({m} AS DOUBLE) AS {value} FROM {source}" for m in METRICS)


RULE, DASH = "'" + "=" * 80 + "'", "'" + "-" * 80 + "'"


def block(section: int, key: str, lines: list[str], source: str) -> str:
    listed = ", ".join(lines)
    return f"""SELECT {section} AS section, {key} AS sort_key, unnest(range(0, {len(lines)})) AS line_no,
  unnest([{listed}]) AS line FROM {source}"""


REPORT = " UNION ALL ".join(
    [
        block(
            0,
            "''",
            [
                RULE,
                "'Evaluation Report'",
                RULE,
                "'Generated: 2024-01-30 12:00:00'",
                "''",
                "'OVERALL METRICS'",
                DASH,
                "'Total Test Cases: ' || total_cases",
                "'Passed: ' || passed || format(' ({:.1f}%)', pass_rate * 100)",
                "'Failed: ' || failed",
                "format('Average Score: {:.3f}', avg_score)",
                "''",
                "'CATEGORY BREAKDOWN'",
                DASH,
            ],
            "met",
        ),
        block(
            1,
            "category",
            ["category || ': ' || passed || '/' || total || format(' passed (avg score: {:.3f})', avg_score)"],
            "cat",
        ),
        block(2, "''", ["''", DASH, "'FAILED CASES (' || failed || ')'", DASH], "met WHERE failed > 0"),
        block(
            3,
            "format('{:.9f} ', score) || case_id",
            ["'• ' || case_id || format(' | Score: {:.2f} | ', score) || category", "'  ' || feedback", "''"],
            "res WHERE NOT passed",
        ),
        block(4, "''", [RULE], "met"),
    ]
)

NAMES = ["google", "british airways", "nicht", "avec", "the", "meta", "uber", "und"]
_mention = " UNION ALL ".join(
    f"SELECT '{' '.join(w.capitalize() for w in n.split(' '))}' AS concept WHERE EXISTS "
    f"(SELECT 1 FROM documents WHERE contains(lower(text), '{n}'))"
    for n in NAMES
)
_before, _after = FALLBACK_ARTICLE.split("{ctx}")
CONCEPTS = f"""legc AS (SELECT DISTINCT article_title AS concept FROM ({ARTICLES})),
polc AS (SELECT DISTINCT section_title AS concept FROM ({POLICIES})),
finc AS ({_mention}),
mix AS (
  SELECT * FROM (VALUES
    (0, 700, 0, 'statute', 'the statutes', 'legislation', 'single'),
    (1, 40, 700, 'decision', 'the regulators'' decisions', 'fines', 'single'),
    (2, 300, 740, 'handbook', 'our handbook', 'policy', 'single'),
    (3, 160, 1040, 'decision_by_statute', 'statutes and decisions', 'fines,legislation', 'multi'))
  AS t(m, n, before, category, ctx, src, kind)),
slots AS (SELECT *, unnest(range(0, n)) AS idx FROM mix),
allc AS (
  SELECT 0 AS m, * FROM legc UNION ALL SELECT 1, * FROM finc UNION ALL SELECT 2, * FROM polc
  UNION ALL SELECT 3, * FROM legc),
numc AS (
  SELECT m, concept, row_number() OVER (PARTITION BY m ORDER BY concept) - 1 AS no,
    count(*) OVER (PARTITION BY m) AS total FROM allc),
picked AS (
  SELECT s.*, CASE WHEN s.m = 1 AND idx = 0 THEN {sql_str(FIRST_FINES_CONCEPT)}
                   WHEN s.m = 3 THEN concept || {sql_str(MULTI_SUFFIX)} ELSE concept END AS concept,
    before + idx + 1 AS number, concept AS plain
  FROM slots s JOIN numc c ON s.m = c.m AND idx % total = no)"""


def built(form: str) -> str:
    """Cases with the JSON of their expected behaviour."""
    golden = form == "golden"
    keywords = "to_json([lower(concept), 'fine'])"
    if golden:
        keywords = f"""CASE WHEN idx = 0 THEN '["fine","€","company"]' ELSE {keywords} END"""
        checks = """',"legislation_check":{"must_retrieve_from_articles":' || to_json([plain])
      || '},"fines_check":{"must_retrieve_keywords":["fine","breach"]}'"""
    else:
        checks = """',"legislation_check":' || to_json([plain]) || ',"fines_check":["fine","breach"]'"""
    included = """ || ',"must_include_in_answer":' || to_json(included)""" if golden else ""
    return f"""WITH {CONCEPTS}, named AS (
  SELECT *, 'case_' || printf('%03d', number) AS id, CASE WHEN number % 2 = 0 THEN 'medium' ELSE 'easy' END AS difficulty,
    CASE m WHEN 0 THEN [concept] WHEN 1 THEN [concept, 'fine'] WHEN 2 THEN ['policy'] ELSE [plain, 'fine'] END AS included,
    CASE WHEN kind <> 'single' THEN {sql_str(FALLBACK_MULTI)}
         WHEN contains(concept, 'Article') OR contains(concept, 'Context')
           THEN {sql_str(_before)} || ctx || {sql_str(_after)}
         ELSE {sql_str(FALLBACK_POLICY)} END AS question FROM picked),
bare AS (
  SELECT id, category, concept, difficulty, src AS expected_sources, question, '{{"sources":' || to_json(string_split(src, ','))
    || CASE m WHEN 0 THEN ',"must_retrieve_from_articles":' || to_json([concept])
         WHEN 1 THEN ',"must_retrieve_keywords":' || {keywords}
         WHEN 2 THEN ',"must_retrieve_from_sections":' || to_json([concept])
         ELSE {checks} END{included} || '}}' AS expected_behavior
  FROM named)"""


_quoted = "chr(39) || array_to_string({}, chr(39) || ', ' || chr(39)) || chr(39)"
BUILT_SCORES = (
    built("golden")
    + f""", items AS (
  SELECT id, category, string_split(src, ',') AS sources, CASE WHEN m = 0 THEN list_concat([concept], included) ELSE included END AS items,
    lower(CASE WHEN difficulty = 'easy' THEN array_to_string(included, ' ') ELSE question END || ' ' || replace(src, ',', ' ')) AS txt
  FROM named),
found AS (
  SELECT *, len(list_filter(items, lambda x: contains(txt, lower(x)))) AS n_found,
    list_sort(list_distinct(list_filter(items, lambda x: NOT contains(txt, lower(x))))) AS missing FROM items)
SELECT id AS case_id, category, (1 + n_found / len(items)) / 2 >= 0.7 AS passed, round((1 + n_found / len(items)) / 2, 6) AS score,
  1.0::DOUBLE AS source_correct, round(n_found / len(items), 6) AS content_match,
  'PASS: Retrieved from expected sources: [' || {_quoted.format("sources")} || '] | '
    || CASE WHEN n_found / len(items) >= 0.7 THEN 'PASS: Found ' || n_found || '/' || len(items) || ' expected items'
       ELSE 'FAIL: Missing ' || len(missing) || ' items: {{' || {_quoted.format("missing")} || '}}' END AS feedback
FROM found"""
)

_fields = [*SCORES, "explanation"]


def reply_text() -> str:
    parts = " || ".join(
        f"'\"{f}\": ' || (event_id % 5 + 1) || ', '" for f in SCORES if f != "clarity"
    )
    clarity = "CASE WHEN event_id % 9 = 0 THEN '' ELSE '\"clarity\": ' || (event_id % 5 + 1) || ', ' END"
    return f"'{{' || {parts} || {clarity} || '\"explanation\": \"ok\"}}'"


_missing = ", ".join(f"CASE WHEN json_extract(js, '$.{f}') IS NULL THEN '{f}' END" for f in _fields)
_judged = ", ".join(
    f"CASE WHEN good THEN CAST(json_extract(js, '$.{s}') AS DOUBLE) ELSE 0.0::DOUBLE END AS {s}" for s in SCORES
)
REPLIES = f"""rep0 AS (
  SELECT CAST(event_id AS VARCHAR) AS request_id,
    CASE WHEN event_id % 13 = 0 THEN 'no JSON' ELSE {reply_text()} END AS reply FROM events),
rep1 AS (SELECT *, CASE WHEN json_valid(reply) THEN CAST(reply AS JSON) END AS js FROM rep0),
rep2 AS (SELECT *, concat_ws(', ', {_missing}) AS missing FROM rep1),
rep3 AS (SELECT *, js IS NOT NULL AND missing = '' AS good FROM rep2),
judged AS (
  SELECT request_id, {_judged},
    CASE WHEN good THEN json_extract_string(js, '$.explanation') WHEN js IS NULL THEN 'Error: JSON parsing error'
         ELSE 'Error: Missing required fields: ' || missing END AS explanation FROM rep3)"""
QUALITY = f"""{REPLIES},
qual AS (
  SELECT TIMESTAMP '2024-01-30 12:00:00' AS evaluation_date, l.date AS query_date, j.*
  FROM log l JOIN judged j ON l.request_id = j.request_id WHERE is_valid_answer)"""
QSUM = (
    "qsum AS (SELECT "
    + ", ".join(f"avg({s}) AS avg_{s}" for s in SCORES)
    + ", count(*) AS evaluated_queries FROM qual WHERE evaluation_date >= DATE '2024-01-30' - 7)"
)


def long(section: str, source: str, columns: dict[str, str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{section}' AS section, '{m}' AS metric, CAST({e} AS DOUBLE) AS value FROM {source}"
        for m, e in columns.items()
    )


_same = lambda *names: {n: n for n in names}
REPORT_CTES = [
    QUALITY,
    QSUM,
    PERF,
    errors(7),
    refusal(7),
    cost(7),
    DRIFT,
    "summary AS ("
    + " UNION ALL ".join(
        [
            long(
                "performance",
                "perf",
                {
                    "total_requests": "sum(total_requests)",
                    "avg_daily_requests": "avg(total_requests)",
                    "avg_latency_seconds": "avg(avg_latency_seconds)",
                    "max_latency_seconds": "max(max_latency_seconds)",
                    "avg_success_rate": "avg(success_rate_pct)",
                },
            ),
            long("refusal", "ref", _same("total_queries", "refusal_count", "refusal_rate")),
            long("error", "esum", _same("total_requests", "total_errors", "error_rate", "days_with_errors")),
            long(
                "cost",
                "cost",
                {
                    "total_cost_usd": "sum(estimated_cost_usd)",
                    "avg_daily_cost_usd": "avg(estimated_cost_usd)",
                    "projected_monthly_cost": "avg(estimated_cost_usd) * 30",
                },
            ),
            long(
                "drift",
                "drift",
                {
                    **_same("drift_score", "new_query_rate", "disappeared_query_rate"),
                    "drift_detected": "CAST(drift_score > 0.3 OR new_query_rate > 0.3 AS INTEGER)",
                },
            ),
            long("quality", "qsum", _same(*[f"avg_{s}" for s in SCORES], "evaluated_queries")),
        ]
    )
    + ")",
]

SQL: dict[str, str] = {
    "scan_golden_set": f"""WITH a AS (SELECT *, string_split(text, {NL}) AS ls FROM documents),
  b AS (SELECT doc_id, lang, source, unnest(ls) AS question, unnest(range(0, len(ls))) AS pos FROM a)
  SELECT pos, 'case_' || doc_id || '_' || pos AS id, question, lang AS category,
    CASE WHEN pos % 2 = 0 THEN 'medium' ELSE 'easy' END AS difficulty, source AS sources FROM b""",
    "score_cases": f"""WITH {RUN} SELECT case_id, category, passed, round(score, 6) AS score, source_correct,
  round(content_match, 6) AS content_match, feedback FROM res""",
    "eval_metrics": f"""WITH {RUN} SELECT total_cases, passed, failed, round(pass_rate, 6) AS pass_rate,
  round(avg_score, 6) AS avg_score, round(source_accuracy, 6) AS source_accuracy,
  round(content_match, 6) AS content_match FROM met""",
    "category_breakdown": f"WITH {RUN}, {CATEGORY} SELECT * FROM cat",
    "failed_cases": f"WITH {RUN} SELECT case_id, category, round(score, 6) AS score FROM res WHERE NOT passed",
    "compare_runs": f"""WITH {RUN}, {results('res2', 2)}, {metrics('res2', 'met2')},
  a AS ({metric_rows('met', 'run_1')}), b AS ({metric_rows('met2', 'run_2')})
  SELECT metric, round(run_1, 6) AS run_1, round(run_2, 6) AS run_2, round(run_2 - run_1, 6) AS delta
  FROM a JOIN b USING (metric)""",
    "gate": f"""WITH {RUN} SELECT round(pass_rate, 6) AS pass_rate, 0.9::DOUBLE AS minimum,
  pass_rate >= 0.9 AS gate_passed FROM met""",
    "eval_report": f"WITH {RUN}, {CATEGORY} {REPORT}",
    "write_report": f"WITH {RUN}, {CATEGORY} SELECT category, passed, total, pass_total FROM cat",
    "case_mix": "SELECT lang AS category, count(*) AS cases FROM documents GROUP BY lang",
    "validate_cases": "SELECT 'case_' || doc_id AS id, 'question' AS missing_fields FROM documents WHERE lang = 'de'",
    "profile_concepts": f"SELECT DISTINCT article_title AS concept FROM ({ARTICLES})",
    "profile_mentions": _mention,
    "build_cases": built("golden") + " SELECT * FROM bare",
    "build_pool": built("pool") + " SELECT * FROM bare",
    "built_scores": BUILT_SCORES,
    "sample_questions": """SELECT doc_id AS question_id, lang, source FROM documents
  ORDER BY md5(doc_id || ':0'), doc_id LIMIT 30""",
    "quality_sample": with_log(
        f"""SELECT date, request_id, "timestamp", question, answer, context FROM log
  WHERE status = 'success' AND is_valid_answer AND {since(7)} ORDER BY md5(request_id || ':0'), request_id
  LIMIT (SELECT greatest(CAST(floor(count(*) * 0.1) AS BIGINT), 1) FROM log
         WHERE status = 'success' AND is_valid_answer AND {since(7)})"""
    ),
    "validate_scores": f"WITH {REPLIES} SELECT * FROM judged",
    "quality_scores": with_log("SELECT * FROM qual", QUALITY),
    "quality_summary": with_log(
        "SELECT " + ", ".join(f"round(avg_{s}, 6) AS avg_{s}" for s in SCORES) + ", evaluated_queries FROM qsum",
        QUALITY,
        QSUM,
    ),
    "monitoring_report": with_log("SELECT section, metric, round(value, 6) AS value FROM summary", *REPORT_CTES),
    "critical_alerts": with_log(
        """SELECT alert, round(value, 6) AS value, threshold FROM summary JOIN (VALUES
    ('quality', 'avg_overall', 3.0::DOUBLE, true, 'Low quality score'),
    ('performance', 'avg_success_rate', 95.0, true, 'Low success rate'),
    ('performance', 'avg_latency_seconds', 10.0, false, 'High latency'),
    ('error', 'total_errors', 5.0, false, 'High error count'),
    ('drift', 'drift_detected', 0.5, false, 'Query distribution drift detected'))
    AS t(section, metric, threshold, above, alert) USING (section, metric)
  WHERE CASE WHEN above THEN value < threshold ELSE value > threshold END""",
        *REPORT_CTES,
    ),
    "ingest_stages": f"""WITH leg AS (SELECT count(*) AS n FROM ({ARTICLES})), pol AS (SELECT count(*) AS n FROM ({POLICIES})),
  enf AS (SELECT count(*) AS n FROM documents),
  counts AS (SELECT 'legislation' AS source, n FROM leg UNION ALL SELECT 'policy', n FROM pol
             UNION ALL SELECT 'enforcement', n FROM enf),
  stages AS (SELECT unnest(['ingest', 'translate', 'embed', 'sync', 'status']) AS stage)
  SELECT stage, source,
    CASE WHEN stage = 'translate' AND source <> 'enforcement' THEN 'skipped' ELSE 'success' END AS status,
    CASE WHEN stage = 'translate' AND source <> 'enforcement' THEN NULL ELSE n END AS rows,
    CAST(NULL AS VARCHAR) AS error FROM counts, stages""",
    "stream_log": with_log(
        """SELECT request_id, date, status, response_classification, refusal_type, classification_reason,
  is_valid_answer FROM log"""
    ),
    "stream_daily": with_raw(
        """SELECT date, count(*) AS total_requests, count(DISTINCT question) AS unique_questions,
  round(avg(latency_ms / 1000.0), 6) AS avg_latency_seconds, round(max(latency_ms / 1000.0), 6) AS max_latency_seconds,
  round(min(latency_ms / 1000.0), 6) AS min_latency_seconds,
  round(CAST(count(*) FILTER (status = 'success') AS DOUBLE) / count(*) * 100, 6) AS success_rate_pct
  FROM raw WHERE CAST(date AS TIMESTAMP) + INTERVAL 1 DAY <= (SELECT max("timestamp") FROM raw) - INTERVAL 1 DAY GROUP BY date"""
    ),
    "stream_sync": f"WITH {SNAP} SELECT doc_id, record_hash, lang, source, n_chars, seen FROM news",
}


def _numbered(section: str, source: str, item: str, value: str, order: str, where: str = "true") -> str:
    return f"""SELECT * FROM (SELECT '{section}' AS section, row_number() OVER (ORDER BY {order}) AS place,
  {item} AS item, round(CAST({value} AS DOUBLE), 6) AS value FROM ({LOG_SQL[source]}) WHERE {where}) WHERE place <= 10"""


SQL["monitoring_details"] = " UNION ALL ".join(
    [
        _numbered("refusal_alerts", "refusal_alerts", "message", "actual", "metric"),
        _numbered("error_alerts", "error_alerts", "message", "actual", "metric"),
        _numbered(
            "error_patterns", "error_patterns", "concat_ws(': ', question, error_message)", "occurrence_count", "occurrence_count DESC, question, error_message"
        ),
        _numbered("cost_anomalies", "cost_anomalies", "CAST(date AS VARCHAR)", "estimated_cost_usd", "date", "deviation_from_mean > 2"),
        _numbered("top_questions", "top_queries", "question", "frequency", "frequency DESC, question"),
        _numbered("keywords", "keyword_distribution", "keyword", "frequency", "frequency DESC, keyword"),
        "SELECT 'quality', 0, 'failed', NULL",
    ]
)
SQL["validate_thresholds"] = """WITH ranges AS (
  SELECT * FROM (VALUES (1, 'min_quality_score', 0, 5, '0-5'), (2, 'min_success_rate', 0, 100, '0-100'),
    (3, 'max_avg_latency', 0, NULL, '>= 0'), (4, 'max_refusal_rate', 0, 1, '0-1'), (5, 'lookback_days', 1, NULL, '>= 1'),
    (6, 'sample_size', 1, NULL, '>= 1')) AS t(no, name, low, high, bounds)),
limits AS (SELECT event_id, event_id % 7 + 1 AS no, round(value, 2) * 10 AS value FROM events)
SELECT event_id, name, round(value, 6) AS value, name || ' must be ' || bounds AS problem
FROM limits JOIN ranges USING (no) WHERE value < low OR value > high"""
