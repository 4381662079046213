"""DuckDB SQL for the log and the reports over it."""

from __future__ import annotations

from .oracle_values import REFUSAL_PATTERNS, STOP_WORDS, VAGUE_PATTERNS


def sql_str(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def classify_cte(source: str, name: str, wanted: str = "true") -> str:
    """CTE `name`: `source` with the three class columns."""
    groups = {n: sql_str("|".join(p)) for n, p in REFUSAL_PATTERNS.items()}
    whens = {n: f"regexp_matches(answer, {p}, 'i')" for n, p in groups.items()}
    blank = "(answer IS NULL OR NOT regexp_matches(answer, '\\S'))"
    clean = "regexp_replace(answer, '^\\s+|\\s+$', '', 'g')"
    vague = sql_str("|".join(VAGUE_PATTERNS))
    kind = " ".join(f"WHEN {w} THEN 'refusal'" for w in whens.values())
    rtype = " ".join(f"WHEN {w} THEN '{n}'" for n, w in whens.items())
    reason = " ".join(
        f"WHEN {w} THEN 'Contains {n.replace('_', ' ')} pattern: ''' "
        f"|| regexp_extract(answer, {groups[n]}, 0, 'i') || ''''"
        for n, w in whens.items()
    )
    return f"""{name} AS (
  SELECT *,
    CASE WHEN NOT coalesce({wanted}, false) THEN NULL WHEN {blank} THEN 'empty' {kind}
         WHEN length({clean}) < 20 THEN 'vague' ELSE 'answer' END AS response_classification,
    CASE WHEN NOT coalesce({wanted}, false) THEN NULL WHEN {blank} THEN NULL {rtype} END AS refusal_type,
    CASE WHEN NOT coalesce({wanted}, false) THEN NULL
         WHEN {blank} THEN 'Response is empty or whitespace' {reason}
         WHEN length({clean}) < 20 AND regexp_matches(answer, {vague}, 'i')
           THEN 'Too short and vague: ''' || {clean} || ''''
         WHEN length({clean}) < 20 THEN 'Response too short (' || length({clean}) || ' chars)'
         END AS classification_reason
  FROM {source})"""


RAW = """e0 AS (
  SELECT *, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events),
e1 AS (
  SELECT *, CASE WHEN event_type <> 'error' THEN 'success' WHEN k % 4 <> 0 THEN 'error'
                 WHEN k % 8 = 0 THEN 'exception' ELSE 'timeout' END AS status FROM e0),
raw AS (
  SELECT event_id, ts AS "timestamp", CAST(ts AS DATE) AS date, CAST(event_id AS VARCHAR) AS request_id,
    'how should we handle ' || event_type || ' records under article ' || k || ' clause ' || (user_id % 10)
      AS question,
    round(value * 100, 2) AS latency_ms, status,
    CASE WHEN status IN ('error', 'exception') THEN NULL
         WHEN status = 'timeout' THEN 'Error: upstream timed out'
         ELSE CASE event_id % 12 WHEN 0 THEN '' WHEN 1 THEN '   ' WHEN 2 THEN 'No.'
           WHEN 3 THEN 'Seven years.' WHEN 4 THEN 'There is not enough information in the records.'
           WHEN 5 THEN 'Could you clarify which records you mean?'
           WHEN 6 THEN 'That is outside my scope, sorry.'
           WHEN 7 THEN 'I am unable to retrieve live records.'
           WHEN 8 THEN 'This is about GDPR Article 17 and the right to erasure.'
           ELSE 'Article ' || k || ' requires the controller to keep ' || event_type
                || ' records for seven years.' END END AS answer,
    CASE WHEN status = 'success'
         THEN 'SOURCE legislation: Article ' || k || ' covers ' || event_type || ' records.' END AS context,
    CASE status WHEN 'error' THEN 'HTTP 500' WHEN 'exception' THEN 'connection reset'
                WHEN 'timeout' THEN 'timed out' END AS error_message
  FROM e1)"""

LOG = (
    f"{RAW},\n"
    + classify_cte("raw", "classed", "answer <> '' AND status = 'success'")
    + """,
log AS (SELECT *, coalesce(response_classification = 'answer', false) AS is_valid_answer FROM classed)"""
)


def with_log(body: str, *ctes: str) -> str:
    return "WITH " + ",\n".join([LOG, *ctes]) + "\n" + body


def with_raw(body: str, *ctes: str) -> str:
    return "WITH " + ",\n".join([RAW, *ctes]) + "\n" + body


def since(days: int) -> str:
    return f"date >= DATE '2024-01-30' - {days}"


PERF = f"""perf AS (
  SELECT date, count(*) AS total_requests, count(DISTINCT question) AS unique_questions,
    avg(latency_ms / 1000.0) AS avg_latency_seconds, max(latency_ms / 1000.0) AS max_latency_seconds,
    min(latency_ms / 1000.0) AS min_latency_seconds,
    CAST(count(*) FILTER (status = 'success') AS DOUBLE) / count(*) * 100 AS success_rate_pct
  FROM raw WHERE {since(7)} GROUP BY date)"""


def errors(days: int) -> str:
    return f"""errs AS (
  SELECT *, CASE status WHEN 'error' THEN 'HTTP_ERROR' WHEN 'exception' THEN 'AGENT_EXCEPTION'
                        ELSE 'OTHER' END AS kind
  FROM raw WHERE {since(days)} AND status <> 'success'),
esum AS (
  SELECT (SELECT count(*) FROM raw WHERE {since(days)}) AS total_requests,
    count(*) FILTER (kind = 'HTTP_ERROR') AS http_errors,
    count(*) FILTER (kind = 'AGENT_EXCEPTION') AS agent_exceptions,
    count(*) FILTER (kind = 'OTHER') AS other_errors,
    coalesce((SELECT max(d) FROM (SELECT count(DISTINCT date) AS d FROM errs GROUP BY kind)), 0)
      AS days_with_errors,
    count(*) AS total_errors,
    coalesce(CAST(count(*) AS DOUBLE) / nullif((SELECT count(*) FROM raw WHERE {since(days)}), 0) * 100, 0.0)
      AS error_rate
  FROM errs)"""


def cost(days: int) -> str:
    return f"""c0 AS (
  SELECT date, count(*) AS request_count, avg(length(question)) AS avg_question_length,
    avg(length(answer)) AS avg_answer_length, CAST(sum(length(question)) AS BIGINT) AS total_question_chars,
    CAST(sum(length(coalesce(answer, ''))) AS BIGINT) AS total_answer_chars
  FROM raw WHERE {since(days)} AND status = 'success' GROUP BY date),
c1 AS (
  SELECT *, total_question_chars // 4 + request_count * 650 AS estimated_input_tokens,
    total_answer_chars // 4 AS estimated_output_tokens FROM c0),
c2 AS (
  SELECT *, CAST(estimated_input_tokens AS DOUBLE) / 1e6 * 0.15::DOUBLE
          + CAST(estimated_output_tokens AS DOUBLE) / 1e6 * 0.60::DOUBLE AS estimated_cost_usd FROM c1),
cost AS (SELECT *, estimated_cost_usd / request_count AS cost_per_request FROM c2)"""


COST_COLS = """date, request_count, round(avg_question_length, 6) AS avg_question_length,
  round(avg_answer_length, 6) AS avg_answer_length, total_question_chars, total_answer_chars,
  CAST(estimated_input_tokens AS BIGINT) AS estimated_input_tokens,
  CAST(estimated_output_tokens AS BIGINT) AS estimated_output_tokens,
  round(estimated_cost_usd, 9) AS estimated_cost_usd, round(cost_per_request, 9) AS cost_per_request"""

_stop = ", ".join(sql_str(w) for w in STOP_WORDS)
KEYWORDS = f"""words AS (
  SELECT date, unnest(string_split(lower(question), ' ')) AS keyword FROM raw WHERE {since(7)}),
kw AS (
  SELECT keyword, count(*) AS frequency, count(DISTINCT date) AS days_appeared FROM words
  WHERE length(keyword) > 4 AND NOT regexp_matches(keyword, '[^a-z]') AND keyword NOT IN ({_stop})
  GROUP BY keyword)"""

DRIFT = """b AS (
  SELECT question, count(*) AS n FROM raw
  WHERE date >= DATE '2024-01-30' - 30 AND date < DATE '2024-01-30' - 7 GROUP BY question),
r AS (SELECT question, count(*) AS n FROM raw WHERE date >= DATE '2024-01-30' - 7 GROUP BY question),
bp AS (SELECT question, n, CAST(n AS DOUBLE) / (SELECT sum(n) FROM b) AS p FROM b),
rp AS (SELECT question, n, CAST(n AS DOUBLE) / (SELECT sum(n) FROM r) AS p FROM r),
joined AS (
  SELECT coalesce(bp.question, rp.question) AS question, bp.n AS bn, rp.n AS rn,
    coalesce(bp.p, 1e-10) AS pb, coalesce(rp.p, 1e-10) AS pr
  FROM bp FULL OUTER JOIN rp ON bp.question = rp.question),
drift AS (
  SELECT sum(pr * ln(pr / pb)) AS drift_score, CAST(0.3 AS DOUBLE) AS drift_threshold,
    count(*) FILTER (bn IS NULL) AS new_query_count,
    CAST(count(*) FILTER (bn IS NULL) AS DOUBLE) / count(rn) AS new_query_rate,
    count(*) FILTER (rn IS NULL) AS disappeared_query_count,
    CAST(count(*) FILTER (rn IS NULL) AS DOUBLE) / count(bn) AS disappeared_query_rate,
    count(bn) AS baseline_unique_queries, count(rn) AS recent_unique_queries
  FROM joined)"""
DRIFT_COLS = """round(drift_score, 6) AS drift_score, drift_threshold, new_query_count,
  round(new_query_rate, 6) AS new_query_rate, disappeared_query_count,
  round(disappeared_query_rate, 6) AS disappeared_query_rate, baseline_unique_queries,
  recent_unique_queries, drift_score > 0.3 OR new_query_rate > 0.3 AS drift_detected,
  format('KL divergence: {:.3f}, New queries: {:d}, Disappeared: {:d}', drift_score, new_query_count,
         disappeared_query_count) AS message"""


def class_counts(source: str, column: str = "response_classification") -> str:
    parts = ["count(*) AS total"]
    for c in ("answer", "refusal", "vague", "empty"):
        n = f"count(*) FILTER ({column} = '{c}')"
        parts.append(f"{n} AS {c}_count")
        parts.append(f"round(coalesce(CAST({n} AS DOUBLE) / nullif(count(*), 0), 0.0), 6) AS {c}_rate")
    return f"SELECT {', '.join(parts)} FROM {source}"


REFUSED = "log WHERE status = 'success' AND answer IS NOT NULL AND " + since(7)


def refusal(days: int) -> str:
    return f"""ref AS (
  SELECT count(*) AS total_queries, count(*) FILTER (response_classification = 'refusal') AS refusal_count,
    count(*) FILTER (refusal_type = 'insufficient_context') AS insufficient_context,
    CAST(count(*) FILTER (response_classification = 'refusal') AS DOUBLE) / count(*) AS refusal_rate
  FROM log WHERE status = 'success' AND answer IS NOT NULL AND {since(days)} HAVING count(*) > 0)"""


SQL: dict[str, str] = {
    "daily_performance": with_raw(
        """SELECT date, total_requests, unique_questions, round(avg_latency_seconds, 6) AS avg_latency_seconds,
  round(max_latency_seconds, 6) AS max_latency_seconds, round(min_latency_seconds, 6) AS min_latency_seconds,
  round(success_rate_pct, 6) AS success_rate_pct FROM perf""",
        PERF,
    ),
    "performance_summary": with_raw(
        """SELECT CAST(sum(total_requests) AS BIGINT) AS total_requests,
  round(avg(total_requests), 6) AS avg_daily_requests, round(avg(avg_latency_seconds), 6) AS avg_latency_seconds,
  round(max(max_latency_seconds), 6) AS max_latency_seconds,
  round(avg(success_rate_pct), 6) AS avg_success_rate, count(*) AS days_monitored FROM perf""",
        PERF,
    ),
    "success_rate": with_raw(
        """SELECT event_type_day AS date, round(CAST(ok AS DOUBLE) / n * 100, 6) AS success_rate FROM
  (SELECT date AS event_type_day, count(*) AS n, count(*) FILTER (status = 'success') AS ok FROM raw GROUP BY date)"""
    ),
    "summary_stats": """SELECT round(avg(value), 6) AS mean, round(quantile_cont(value, 0.5), 6) AS median,
  min(value) AS min, max(value) AS max, count(value) AS count FROM events""",
    "error_rows": with_raw(
        f"""SELECT "timestamp", request_id, question, answer, latency_ms, status, error_message, date,
  CASE WHEN status = 'error' THEN 'HTTP_ERROR' WHEN status = 'exception' THEN 'AGENT_EXCEPTION'
       WHEN answer LIKE '%Error%' THEN 'AGENT_ERROR' ELSE 'UNKNOWN' END AS error_type
  FROM raw WHERE status <> 'success' AND {since(7)}"""
    ),
    "errors_by_type": with_raw(
        "SELECT kind AS error_type, count(*) AS error_count, count(DISTINCT date) AS days_with_errors FROM errs GROUP BY kind",
        errors(7),
    ),
    "error_summary": with_raw(
        """SELECT total_requests, http_errors, agent_exceptions, other_errors, days_with_errors, total_errors,
  round(error_rate, 6) AS error_rate FROM esum""",
        errors(7),
    ),
    "error_patterns": with_raw(
        f"""SELECT question, error_message, count(*) AS occurrence_count, max(date) AS last_occurrence
  FROM raw WHERE status <> 'success' AND {since(7)} GROUP BY question, error_message
  ORDER BY occurrence_count DESC, question, error_message LIMIT 10"""
    ),
    "error_log": with_raw(
        f"""SELECT "timestamp", request_id, question, answer, latency_ms, status, error_message, date,
  CASE WHEN status = 'error' THEN 'HTTP_ERROR' WHEN status = 'exception' THEN 'AGENT_EXCEPTION'
       WHEN answer LIKE '%Error%' THEN 'AGENT_ERROR' ELSE 'UNKNOWN' END AS error_type,
  TIMESTAMP '2024-01-30 12:00:00' AS logged_at
  FROM raw WHERE status <> 'success' AND {since(7)}"""
    ),
    "error_alerts": with_raw(
        """SELECT 'HIGH' AS severity, 'daily_error_count' AS metric, CAST(5 AS DOUBLE) AS threshold,
  CAST(total_errors AS DOUBLE) AS actual,
  'Daily error count (' || total_errors || ') exceeds threshold (5)' AS message FROM esum WHERE total_errors > 5
UNION ALL
SELECT 'HIGH', 'error_rate', CAST(5 AS DOUBLE), round(error_rate, 6),
  format('Error rate ({:.1f}%) is too high', error_rate) FROM esum WHERE error_rate > 5""",
        errors(1),
    ),
    "refusal_summary": with_log(
        "SELECT total_queries, refusal_count, insufficient_context, round(refusal_rate, 6) AS refusal_rate FROM ref",
        refusal(7),
    ),
    "refusals_by_type": with_log(
        f"SELECT refusal_type, count(*) AS refusals FROM {REFUSED} AND response_classification = 'refusal' GROUP BY 1"
    ),
    "refusal_alerts": with_log(
        """SELECT 'HIGH' AS severity, 'refusal_rate' AS metric, CAST(0.15 AS DOUBLE) AS threshold,
  round(refusal_rate, 6) AS actual,
  format('Refusal rate ({:.1f}%) exceeds threshold (15.0%)', refusal_rate * 100) AS message
  FROM ref WHERE refusal_rate > 0.15
UNION ALL
SELECT 'MEDIUM', 'insufficient_context', CAST(10 AS DOUBLE), CAST(insufficient_context AS DOUBLE),
  'Insufficient context refusals (' || insufficient_context || ') indicate retrieval issues'
  FROM ref WHERE insufficient_context > 10""",
        refusal(1),
    ),
    "estimate_tokens": "SELECT doc_id, CAST(length(text) // 4 AS BIGINT) AS tokens FROM documents",
    "estimate_cost": """SELECT doc_id, round(CAST(length(text) // 4 AS DOUBLE) / 1e6 * 0.15::DOUBLE
  + CAST(n_chars // 4 AS DOUBLE) / 1e6 * 0.60::DOUBLE, 9) AS cost_usd FROM documents""",
    "daily_cost": with_raw(f"SELECT {COST_COLS} FROM cost", cost(30)),
    "cost_summary": with_raw(
        """SELECT round(sum(estimated_cost_usd), 9) AS total_cost_usd,
  round(avg(estimated_cost_usd), 9) AS avg_daily_cost_usd,
  round(sum(estimated_cost_usd) / sum(request_count), 9) AS avg_cost_per_request,
  CAST(sum(request_count) AS BIGINT) AS total_requests,
  round(avg(estimated_cost_usd) * 30, 9) AS projected_monthly_cost, count(*) AS days_analyzed,
  CAST(sum(estimated_input_tokens) AS BIGINT) AS total_input_tokens,
  CAST(sum(estimated_output_tokens) AS BIGINT) AS total_output_tokens FROM cost""",
        cost(30),
    ),
    "cost_trend": with_raw(
        f"""SELECT {COST_COLS},
  round(avg(estimated_cost_usd) OVER w, 9) AS rolling_7d_cost,
  round(avg(request_count) OVER w, 6) AS rolling_7d_requests
  FROM cost WINDOW w AS (ORDER BY date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)""",
        cost(30),
    ),
    "cost_anomalies": with_raw(
        """SELECT date, request_count, round(estimated_cost_usd, 9) AS estimated_cost_usd,
  round(cost_per_request, 9) AS cost_per_request, round((estimated_cost_usd - m) / s, 6) AS deviation_from_mean
  FROM cost, (SELECT avg(estimated_cost_usd) AS m, stddev_samp(estimated_cost_usd) AS s, count(*) AS d FROM cost)
  WHERE d >= 3 AND estimated_cost_usd > m + 1.5 * s""",
        cost(30),
    ),
    "cost_log": with_raw(
        f"SELECT {COST_COLS}, TIMESTAMP '2024-01-30 12:00:00' AS calculated_at, 'gpt-4o-mini' AS model_used FROM cost",
        cost(1),
    ),
    "query_distribution": with_raw(
        f"""SELECT question, count(*) AS frequency, min(date) AS first_seen, max(date) AS last_seen
  FROM raw WHERE {since(7)} GROUP BY question"""
    ),
    "top_queries": with_raw(
        f"""SELECT question, count(*) AS frequency,
  round(CAST(count(*) AS DOUBLE) * 100 / (SELECT count(*) FROM raw WHERE {since(7)}), 6) AS percentage
  FROM raw WHERE {since(7)} GROUP BY question ORDER BY frequency DESC, question LIMIT 20"""
    ),
    "keyword_distribution": with_raw("SELECT * FROM kw ORDER BY frequency DESC, keyword LIMIT 30", KEYWORDS),
    "distribution_drift": with_raw(f"SELECT {DRIFT_COLS} FROM drift", DRIFT),
    "drift_log": with_raw(
        f"SELECT {DRIFT_COLS}, TIMESTAMP '2024-01-30 12:00:00' AS measured_at FROM drift", DRIFT
    ),
    "new_queries": with_raw(
        "SELECT question, n AS frequency FROM r WHERE question NOT IN (SELECT question FROM b)", DRIFT
    ),
    "disappeared_queries": with_raw(
        "SELECT question, n AS frequency FROM b WHERE question NOT IN (SELECT question FROM r)", DRIFT
    ),
    "query_length_stats": with_raw(
        f"""SELECT round(avg(length(question)), 6) AS avg_length, min(length(question)) AS min_length,
  max(length(question)) AS max_length, round(stddev_samp(length(question)), 6) AS std_length,
  CAST(quantile_cont(length(question), 0.5) AS DOUBLE) AS median_length FROM raw WHERE {since(30)}"""
    ),
    "temporal_pattern": with_raw(
        f"""SELECT date, hour("timestamp") AS hour_of_day, dayofweek(date) + 1 AS day_of_week,
  count(*) AS request_count FROM raw WHERE {since(30)} GROUP BY ALL"""
    ),
    "classify_response": with_raw(
        "SELECT request_id, response_classification, refusal_type, classification_reason FROM classed0",
        classify_cte("raw", "classed0"),
    ),
    "is_valid_answer": with_raw(
        """SELECT request_id, response_classification = 'answer' AS is_valid_answer,
  response_classification <> 'answer' AS is_refusal FROM classed0""",
        classify_cte("raw", "classed0"),
    ),
    "refusal_type": with_raw("SELECT request_id, refusal_type FROM classed0", classify_cte("raw", "classed0")),
    "classification_stats": with_raw(class_counts("classed0"), classify_cte("raw", "classed0")),
    "log_stats": with_log(
        """SELECT count(*) AS total, count(*) FILTER (is_valid_answer) AS valid_answer_count,
  count(*) FILTER (response_classification = 'refusal') AS refusal_count,
  count(*) FILTER (response_classification = 'vague') AS vague_count,
  round(CAST(count(*) FILTER (is_valid_answer) AS DOUBLE) / count(*), 6) AS valid_answer_rate,
  round(CAST(count(*) FILTER (response_classification = 'refusal') AS DOUBLE) / count(*), 6) AS refusal_rate
  FROM log HAVING count(*) > 0"""
    ),
    "build_log_rows": with_log(
        """SELECT "timestamp", request_id, question, answer, context, latency_ms, status, error_message, date,
  response_classification, refusal_type, classification_reason, is_valid_answer FROM log"""
    ),
    "normalise_requests": """SELECT event_id, event_type AS question,
  CASE WHEN event_type = 'error' THEN 'error' ELSE 'success' END AS status,
  CASE WHEN event_type = 'error' THEN props END AS error_message,
  CASE WHEN event_type = 'error' THEN 'Error: ' || props ELSE '' END AS answer FROM events""",
}
