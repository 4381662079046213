"""The monitoring report: all summaries, their alerts, the limits they use."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.money import REQUEST_OVERHEAD_TOKENS, estimate_cost
from ..functions.text import ratio
from ..operators.cost import cost_anomalies
from ..operators.drift import distribution_drift, keyword_distribution, top_queries
from ..operators.errors import error_alerts, error_patterns
from ..operators.logs import lookback
from ..operators.quality import quality_summary
from ..operators.refusals import refusal_alerts

# Alert limits.
THRESHOLDS: dict[str, float] = {
    "min_quality_score": 3.0,
    "min_success_rate": 95.0,
    "max_avg_latency": 10.0,
    "max_errors_per_day": 5.0,
    "max_refusal_rate": 0.15,
    "max_insufficient_context_per_day": 10.0,
}
RANGES: dict[str, tuple[float, float | None]] = {
    "min_quality_score": (0.0, 5.0),
    "min_success_rate": (0.0, 100.0),
    "max_avg_latency": (0.0, None),
    "max_refusal_rate": (0.0, 1.0),
    "lookback_days": (1.0, None),
    "sample_size": (1.0, None),
}


def validate_thresholds(values: Mapping[str, float]) -> list[str]:
    """What is wrong with a set of limits; empty when nothing is."""
    problems = []
    for name, value in values.items():
        low, high = RANGES.get(name, (None, None))
        if low is not None and (value < low or (high is not None and value > high)):
            bounds = f">= {low:g}" if high is None else f"{low:g}-{high:g}"
            problems.append(f"{name} must be {bounds} (got {value:g})")
    return problems


def threshold_violations(thresholds: DataFrame) -> DataFrame:
    """Rows (name, value) of a thresholds table that lie outside their range, with the problem; unknown names have no range."""
    rows = [(n, low, high, f"{n} must be " + (f">= {low:g}" if high is None else f"{low:g}-{high:g}")) for n, (low, high) in RANGES.items()]
    ranges = thresholds.sparkSession.createDataFrame(rows, "name string, low double, high double, problem string")
    # One row per known limit: a broadcast of a fixed size.
    joined = thresholds.join(F.broadcast(ranges), "name")
    outside = (F.col("value") < F.col("low")) | (F.col("value") > F.col("high")) | F.isnan("value")
    return joined.filter(outside).select(*thresholds.columns, "problem")


def thresholds_table(like: DataFrame, values: Mapping[str, float] = THRESHOLDS) -> DataFrame:
    return like.sparkSession.createDataFrame([(k, float(v)) for k, v in values.items()], "name string, value double")


def daily_rollup(log: DataFrame, days: int, as_of: dt.date | None) -> DataFrame:
    """All a report needs to know of the log, one row per date, from one scan."""
    ok = F.col("status") == "success"
    answered = ok & F.col("answer").isNotNull()
    refused = answered & (F.col("response_classification") == "refusal")
    length = F.length(F.coalesce("answer", F.lit("")))
    return (
        lookback(log, days, as_of)
        .groupBy("date")
        .agg(
            F.count(F.lit(1)).alias("requests"),
            F.count_if(ok).alias("ok"),
            F.avg(F.col("latency_ms") / 1000.0).alias("latency"),
            F.max(F.col("latency_ms") / 1000.0).alias("max_latency"),
            F.count_if(F.col("status") == "error").alias("http"),
            F.count_if(F.col("status") == "exception").alias("agent"),
            F.count_if(~F.col("status").isin("success", "error", "exception")).alias("other"),
            F.count_if(answered).alias("answered"),
            F.count_if(refused).alias("refused"),
            F.coalesce(F.sum(F.when(ok, F.length("question"))), F.lit(0)).alias("question_chars"),
            F.coalesce(F.sum(F.when(ok, length)), F.lit(0)).alias("answer_chars"),
        )
    )


def monitoring_summary(
    log: DataFrame, quality: DataFrame, days: int = 7, as_of: dt.date | None = None
) -> DataFrame:
    """(section, metric, value): the summaries of all monitors in long form.

    Performance, errors, refusals and cost come from one pass over the log,
    drift from a second one. A section without data has no rows.
    """
    daily = daily_rollup(log, days, as_of)
    tokens_in = F.floor(F.col("question_chars") / 4) + F.col("ok") * REQUEST_OVERHEAD_TOKENS
    tokens_out = F.floor(F.col("answer_chars") / 4)
    priced = daily.withColumns(
        {
            "cost": F.when(F.col("ok") > 0, estimate_cost(tokens_in, tokens_out)),
            "success_pct": ratio(F.col("ok"), F.col("requests")) * 100,
            "failed": F.col("requests") - F.col("ok"),
        }
    )
    days_with = F.greatest(*[F.count_if(F.col(c) > 0) for c in ("http", "agent", "other")])
    wide = priced.agg(
        F.sum("requests").alias("performance.total_requests"),
        F.avg("requests").alias("performance.avg_daily_requests"),
        F.avg("latency").alias("performance.avg_latency_seconds"),
        F.max("max_latency").alias("performance.max_latency_seconds"),
        F.avg("success_pct").alias("performance.avg_success_rate"),
        F.when(F.sum("answered") > 0, F.sum("answered")).alias("refusal.total_queries"),
        F.when(F.sum("answered") > 0, F.sum("refused")).alias("refusal.refusal_count"),
        ratio(F.sum("refused"), F.sum("answered")).alias("refusal.refusal_rate"),
        F.coalesce(F.sum("requests"), F.lit(0)).alias("error.total_requests"),
        F.coalesce(F.sum("failed"), F.lit(0)).alias("error.total_errors"),
        F.coalesce(ratio(F.sum("failed"), F.sum("requests")) * 100, F.lit(0.0)).alias("error.error_rate"),
        days_with.alias("error.days_with_errors"),
        F.coalesce(F.sum("cost"), F.lit(0.0)).alias("cost.total_cost_usd"),
        F.coalesce(F.avg("cost"), F.lit(0.0)).alias("cost.avg_daily_cost_usd"),
        F.coalesce(F.avg("cost") * 30, F.lit(0.0)).alias("cost.projected_monthly_cost"),
    )
    drift = distribution_drift(log, as_of=as_of).select(
        F.col("drift_score").alias("drift.drift_score"),
        F.col("new_query_rate").alias("drift.new_query_rate"),
        F.col("disappeared_query_rate").alias("drift.disappeared_query_rate"),
        F.col("drift_detected").cast("double").alias("drift.drift_detected"),
    )
    judged = quality_summary(quality, days, as_of)
    judged = judged.filter("evaluated_queries > 0").select(
        *[F.col(c).alias(f"quality.{c}") for c in judged.columns]
    )
    parts = [_long(wide), _long(drift), _long(judged)]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def _long(row: DataFrame) -> DataFrame:
    doubles = row.select(*[F.col(f"`{c}`").cast("double").alias(c) for c in row.columns])
    name = F.split("name", r"\.")
    long = doubles.unpivot([], [f"`{c}`" for c in row.columns], "name", "value")
    return long.select(name[0].alias("section"), name[1].alias("metric"), "value").filter("value IS NOT NULL")


DETAIL = "section string, place int, item string, value double"


def _listed(rows: DataFrame, section: str, item: Column, value: Column, *order: Column) -> DataFrame:
    """Rows of a short list, numbered in their order."""
    place = F.row_number().over(Window.orderBy(*order))
    return rows.select(F.lit(section).alias("section"), place.alias("place"), item.alias("item"), value.cast("double").alias("value"))


def isolated(section: str, build: Callable[[], DataFrame], like: DataFrame) -> DataFrame:
    """A part of a report, or one row that says why it can't be made, such as a missing table or column.

    A part is put together when the report is, so what fails later, on the rows themselves, fails the report.
    """
    try:
        return build().select("section", "place", "item", "value")
    except (AnalysisException, KeyError, ValueError) as problem:
        return like.sparkSession.createDataFrame([(section, 0, f"failed: {problem}", None)], DETAIL)


def monitoring_details(
    log: DataFrame, quality: Callable[[], DataFrame], days: int = 7, as_of: dt.date | None = None, top_n: int = 10
) -> DataFrame:
    """(section, place, item, value): alerts, error patterns, cost anomalies, top questions, keywords, judged quality.

    Every part stands alone; one that can't be made is a row with place 0. `quality` gives the quality table, which may be missing.
    """

    def alerts(rows: DataFrame, section: str) -> DataFrame:
        return _listed(rows, section, F.col("message"), F.col("actual"), F.col("metric"))

    def scores() -> DataFrame:
        return _listed(quality_summary(quality(), days, as_of), "quality", F.lit("avg_overall"), F.col("avg_overall"), F.lit(0))

    error = F.concat_ws(": ", "question", "error_message")
    parts: dict[str, Callable[[], DataFrame]] = {
        "refusal_alerts": lambda: alerts(refusal_alerts(log, 1, as_of), "refusal_alerts"),
        "error_alerts": lambda: alerts(error_alerts(log, 1, as_of), "error_alerts"),
        "error_patterns": lambda: _listed(
            error_patterns(log, days, top_n, as_of), "error_patterns", error, F.col("occurrence_count"), F.desc("occurrence_count"), F.col("question"), F.col("error_message")
        ),
        "cost_anomalies": lambda: _listed(
            cost_anomalies(log, 30, as_of=as_of), "cost_anomalies", F.col("date").cast("string"), F.col("estimated_cost_usd"), F.col("date")
        ),
        "top_questions": lambda: _listed(top_queries(log, days, top_n, as_of), "top_questions", F.col("question"), F.col("frequency"), F.desc("frequency"), F.col("question")),
        "keywords": lambda: _listed(keyword_distribution(log, days, top_n, as_of), "keywords", F.col("keyword"), F.col("frequency"), F.desc("frequency"), F.col("keyword")),
        "quality": scores,
    }
    made = [isolated(section, build, log) for section, build in parts.items()]
    return reduce(DataFrame.unionByName, made)


# section, metric, limit, whether the value must stay above it, alert
CRITICAL = [
    ("quality", "avg_overall", "min_quality_score", True, "Low quality score"),
    ("performance", "avg_success_rate", "min_success_rate", True, "Low success rate"),
    ("performance", "avg_latency_seconds", "max_avg_latency", False, "High latency"),
    ("error", "total_errors", "max_errors_per_day", False, "High error count"),
    ("drift", "drift_detected", "drift", False, "Query distribution drift detected"),
]


def critical_alerts(summary: DataFrame, thresholds: Mapping[str, float] = THRESHOLDS) -> DataFrame:
    """(alert, value, threshold) for each breached limit; a missing section never alerts.

    The errors of the whole look-back are held against the limit per day.
    """
    limits = {**thresholds, "drift": 0.5}
    rules = summary.sparkSession.createDataFrame(
        [(s, m, float(limits[t]), above, text) for s, m, t, above, text in CRITICAL],
        "section string, metric string, threshold double, above boolean, alert string",
    )
    breached = F.when(F.col("above"), F.col("value") < F.col("threshold")).otherwise(
        F.col("value") > F.col("threshold")
    )
    # Five rules, so the join is a broadcast of a fixed size.
    return summary.join(F.broadcast(rules), ["section", "metric"]).filter(breached).select("alert", "value", "threshold")
