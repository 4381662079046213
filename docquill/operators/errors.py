"""Failed requests: rows, rates, patterns, alerts."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import fixed, ratio
from .logs import lookback

# Alert limits.
MAX_ERRORS_PER_DAY = 5
MIN_SUCCESS_RATE = 95.0

FAILED = "status != 'success'"


def error_rows(log: DataFrame, days: int = 7, as_of: dt.date | None = None) -> DataFrame:
    """Failed requests with their kind, newest first."""
    kind = (
        F.when(F.col("status") == "error", "HTTP_ERROR")
        .when(F.col("status") == "exception", "AGENT_EXCEPTION")
        .when(F.contains(F.col("answer"), F.lit("Error")), "AGENT_ERROR")
        .otherwise("UNKNOWN")
    )
    return (
        lookback(log, days, as_of)
        .filter(FAILED)
        .select(
            "timestamp",
            "request_id",
            "question",
            "answer",
            "latency_ms",
            "status",
            "error_message",
            "date",
            kind.alias("error_type"),
        )
        .orderBy(F.desc("timestamp"), "request_id")
    )


def errors_by_type(log: DataFrame, days: int = 7, as_of: dt.date | None = None) -> DataFrame:
    """Count and distinct days of each kind of failure; the third kind is OTHER here."""
    kind = (
        F.when(F.col("status") == "error", "HTTP_ERROR")
        .when(F.col("status") == "exception", "AGENT_EXCEPTION")
        .otherwise("OTHER")
    )
    per_day = (
        lookback(log, days, as_of)
        .filter(FAILED)
        .groupBy(kind.alias("error_type"), "date")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return per_day.groupBy("error_type").agg(
        F.sum("n").alias("error_count"), F.count("date").alias("days_with_errors")
    )


def error_summary(log: DataFrame, days: int = 7, as_of: dt.date | None = None) -> DataFrame:
    """One row. days_with_errors is the largest count of days over the kinds, not their union."""
    status = F.col("status")
    per_day = (
        lookback(log, days, as_of)
        .groupBy("date")
        .agg(
            F.count(F.lit(1)).alias("requests"),
            F.count_if(status == "error").alias("http"),
            F.count_if(status == "exception").alias("agent"),
            F.count_if(~status.isin("success", "error", "exception")).alias("other"),
        )
    )
    kinds = ["http", "agent", "other"]

    def total(name: str) -> Column:
        return F.coalesce(F.sum(name), F.lit(0))

    sums = per_day.agg(
        total("requests").alias("total_requests"),
        total("http").alias("http_errors"),
        total("agent").alias("agent_exceptions"),
        total("other").alias("other_errors"),
        F.greatest(*[F.count_if(F.col(k) > 0) for k in kinds]).alias("days_with_errors"),
    )
    all_errors = F.col("http_errors") + F.col("agent_exceptions") + F.col("other_errors")
    return sums.withColumn("total_errors", all_errors).withColumn(
        "error_rate", F.coalesce(ratio(F.col("total_errors"), F.col("total_requests")) * 100, F.lit(0.0))
    )


def error_patterns(log: DataFrame, days: int = 7, top_n: int = 10, as_of: dt.date | None = None) -> DataFrame:
    """The most frequent (question, error_message) pairs."""
    return (
        lookback(log, days, as_of)
        .filter(FAILED)
        .groupBy("question", "error_message")
        .agg(F.count(F.lit(1)).alias("occurrence_count"), F.max("date").alias("last_occurrence"))
        .orderBy(F.desc("occurrence_count"), "question", "error_message")
        .limit(top_n)
    )


def error_log(
    log: DataFrame, days: int = 7, as_of: dt.date | None = None, logged_at: dt.datetime | None = None
) -> DataFrame:
    """The rows to append to the error table."""
    now = F.current_timestamp() if logged_at is None else F.lit(logged_at)
    return error_rows(log, days, as_of).withColumn("logged_at", now)


ALERT_COLUMNS = ["severity", "metric", "threshold", "actual", "message"]


def alert(when: Column, severity: str, metric: str, limit: float, actual: Column, message: Column) -> Column:
    """One alert, or NULL when the limit holds."""
    return F.when(
        when,
        F.struct(
            F.lit(severity).alias("severity"),
            F.lit(metric).alias("metric"),
            F.lit(float(limit)).alias("threshold"),
            actual.cast("double").alias("actual"),
            message.alias("message"),
        ),
    )


def alert_rows(summary: DataFrame, *alerts: Column) -> DataFrame:
    """A one-row summary to its alerts."""
    return (
        summary.select(F.explode(F.array(*alerts)).alias("a"))
        .filter("a IS NOT NULL")
        .select(*[f"a.{c}" for c in ALERT_COLUMNS])
    )


def error_alerts(
    log: DataFrame,
    days: int = 1,
    as_of: dt.date | None = None,
    max_errors: int = MAX_ERRORS_PER_DAY,
    min_success: float = MIN_SUCCESS_RATE,
) -> DataFrame:
    total, rate = F.col("total_errors"), F.col("error_rate")
    return alert_rows(
        error_summary(log, days, as_of),
        alert(
            total > max_errors,
            "HIGH",
            "daily_error_count",
            max_errors,
            total,
            F.format_string(f"Daily error count (%d) exceeds threshold ({max_errors})", total),
        ),
        alert(
            rate > 100 - min_success,
            "HIGH",
            "error_rate",
            100 - min_success,
            rate,
            F.concat(F.lit("Error rate ("), fixed(rate, 1), F.lit("%) is too high")),
        ),
    )
