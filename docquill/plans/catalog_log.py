"""Queries over the request log."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import money
from ..operators import cost, drift, errors, logs, performance, refusals
from .testbed import AS_OF, log, requests, table

NOON = dt.datetime(2024, 1, 30, 12, tzinfo=dt.timezone.utc)


def rounded(df: DataFrame, places: int, *names: str) -> DataFrame:
    return df.withColumns({n: F.round(n, places) for n in names})


MONEY = ["estimated_cost_usd", "cost_per_request"]
SIZES = ["avg_question_length", "avg_answer_length"]


def _days(df: DataFrame) -> DataFrame:
    return rounded(rounded(df, 9, *MONEY), 6, *SIZES)


def _drift(df: DataFrame) -> DataFrame:
    return rounded(df, 6, "drift_score", "new_query_rate", "disappeared_query_rate")


def _stats(df: DataFrame) -> DataFrame:
    return rounded(df, 6, *[f"{c}_rate" for c in logs.CLASSES])


def _success_rate(s, d):
    days = log(s, d).groupBy("date").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("status") == "success").alias("ok")
    )
    return days.select("date", F.round(money.success_rate(F.col("n"), F.col("ok")), 6).alias("success_rate"))


def _normalise(s, d):
    raw = table(s, d, "events").select(
        "event_id",
        F.col("event_type").alias("question"),
        F.when(F.col("event_type") == "error", F.col("props")).alias("error"),
    )
    return logs.normalise_requests(raw).select("event_id", "question", "status", "error_message", "answer")


def _cost(s, d):
    docs = table(s, d, "documents")
    tokens_in = money.estimate_tokens(F.col("text"))
    tokens_out = F.floor(F.col("n_chars") / 4)
    return docs.select("doc_id", F.round(money.estimate_cost(tokens_in, tokens_out), 9).alias("cost_usd"))


def _classified(s, d):
    return requests(table(s, d, "events"))


QUERIES = {
    "daily_performance": lambda s, d: rounded(
        performance.daily_performance(log(s, d), 7, AS_OF),
        6,
        "avg_latency_seconds",
        "max_latency_seconds",
        "min_latency_seconds",
        "success_rate_pct",
    ),
    "performance_summary": lambda s, d: rounded(
        performance.performance_summary(log(s, d), 7, AS_OF),
        6,
        "avg_daily_requests",
        "avg_latency_seconds",
        "max_latency_seconds",
        "avg_success_rate",
    ),
    "success_rate": _success_rate,
    "summary_stats": lambda s, d: rounded(
        performance.summary_stats(table(s, d, "events"), "value"), 6, "mean", "median"
    ),
    "error_rows": lambda s, d: errors.error_rows(log(s, d), 7, AS_OF),
    "errors_by_type": lambda s, d: errors.errors_by_type(log(s, d), 7, AS_OF),
    "error_summary": lambda s, d: rounded(errors.error_summary(log(s, d), 7, AS_OF), 6, "error_rate"),
    "error_patterns": lambda s, d: errors.error_patterns(log(s, d), 7, 10, AS_OF),
    "error_log": lambda s, d: errors.error_log(log(s, d), 7, AS_OF, NOON),
    "error_alerts": lambda s, d: rounded(errors.error_alerts(log(s, d), 1, AS_OF), 6, "actual"),
    "refusal_summary": lambda s, d: rounded(refusals.refusal_summary(log(s, d), 7, AS_OF), 6, "refusal_rate"),
    "refusals_by_type": lambda s, d: refusals.refusals_by_type(log(s, d), 7, AS_OF),
    "refusal_alerts": lambda s, d: rounded(refusals.refusal_alerts(log(s, d), 1, AS_OF), 6, "actual"),
    "estimate_tokens": lambda s, d: table(s, d, "documents").select(
        "doc_id", money.estimate_tokens(F.col("text")).alias("tokens")
    ),
    "estimate_cost": _cost,
    "daily_cost": lambda s, d: _days(cost.daily_cost(log(s, d), 30, AS_OF)),
    "cost_summary": lambda s, d: rounded(
        cost.cost_summary(log(s, d), 30, AS_OF),
        9,
        "total_cost_usd",
        "avg_daily_cost_usd",
        "avg_cost_per_request",
        "projected_monthly_cost",
    ),
    "cost_trend": lambda s, d: rounded(
        rounded(_days(cost.cost_trend(log(s, d), 30, AS_OF)), 9, "rolling_7d_cost"), 6, "rolling_7d_requests"
    ),
    "cost_anomalies": lambda s, d: rounded(
        rounded(cost.cost_anomalies(log(s, d), 30, 1.5, AS_OF), 9, *MONEY), 6, "deviation_from_mean"
    ),
    "cost_log": lambda s, d: _days(cost.cost_log(log(s, d), 1, AS_OF, NOON)),
    "query_distribution": lambda s, d: drift.query_distribution(log(s, d), 7, AS_OF),
    "top_queries": lambda s, d: rounded(drift.top_queries(log(s, d), 7, 20, AS_OF), 6, "percentage"),
    "keyword_distribution": lambda s, d: drift.keyword_distribution(log(s, d), 7, 30, AS_OF),
    "distribution_drift": lambda s, d: _drift(drift.distribution_drift(log(s, d), as_of=AS_OF)),
    "drift_log": lambda s, d: _drift(drift.drift_log(log(s, d), as_of=AS_OF, measured_at=NOON)),
    "new_queries": lambda s, d: drift.new_queries(log(s, d), as_of=AS_OF),
    "disappeared_queries": lambda s, d: drift.disappeared_queries(log(s, d), as_of=AS_OF),
    "query_length_stats": lambda s, d: rounded(
        drift.query_length_stats(log(s, d), 30, AS_OF), 6, "avg_length", "std_length"
    ),
    "temporal_pattern": lambda s, d: drift.temporal_pattern(log(s, d), 30, AS_OF),
    "classify_response": lambda s, d: logs.classify_response(_classified(s, d)).select(
        "request_id", "response_classification", "refusal_type", "classification_reason"
    ),
    "is_valid_answer": lambda s, d: logs.answer_flags(_classified(s, d)).select(
        "request_id", "is_valid_answer", "is_refusal"
    ),
    "refusal_type": lambda s, d: logs.answer_flags(_classified(s, d)).select("request_id", "refusal_type"),
    "classification_stats": lambda s, d: _stats(
        logs.classification_stats(logs.classify_response(_classified(s, d)))
    ),
    "log_stats": lambda s, d: rounded(logs.log_stats(log(s, d)), 6, "valid_answer_rate", "refusal_rate"),
    "build_log_rows": log,
    "normalise_requests": _normalise,
}
