"""Refused answers among successful requests."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import fixed, ratio
from .errors import alert, alert_rows
from .logs import lookback

# Alert limits.
MAX_REFUSAL_RATE = 0.15
MAX_INSUFFICIENT_CONTEXT_PER_DAY = 10


def _answered(log: DataFrame, days: int, as_of: dt.date | None) -> DataFrame:
    return lookback(log, days, as_of).filter("status = 'success' AND answer IS NOT NULL")


def refusal_summary(log: DataFrame, days: int = 7, as_of: dt.date | None = None) -> DataFrame:
    """Total, refusals, their rate and the insufficient-context ones; no row without requests."""
    refused = F.col("response_classification") == "refusal"
    short = refused & (F.col("refusal_type") == "insufficient_context")
    return (
        _answered(log, days, as_of)
        .agg(
            F.count(F.lit(1)).alias("total_queries"),
            F.count_if(refused).alias("refusal_count"),
            F.count_if(short).alias("insufficient_context"),
        )
        .withColumn("refusal_rate", ratio(F.col("refusal_count"), F.col("total_queries")))
        .filter("total_queries > 0")
    )


def refusals_by_type(log: DataFrame, days: int = 7, as_of: dt.date | None = None) -> DataFrame:
    return (
        _answered(log, days, as_of)
        .filter("response_classification = 'refusal'")
        .groupBy("refusal_type")
        .agg(F.count(F.lit(1)).alias("refusals"))
        .orderBy(F.desc("refusals"), "refusal_type")
    )


def refusal_alerts(
    log: DataFrame,
    days: int = 1,
    as_of: dt.date | None = None,
    max_rate: float = MAX_REFUSAL_RATE,
    max_insufficient: int = MAX_INSUFFICIENT_CONTEXT_PER_DAY,
) -> DataFrame:
    rate, short = F.col("refusal_rate"), F.col("insufficient_context")
    return alert_rows(
        refusal_summary(log, days, as_of),
        alert(
            rate > max_rate,
            "HIGH",
            "refusal_rate",
            max_rate,
            rate,
            F.concat(
                F.lit("Refusal rate ("), fixed(rate * 100, 1), F.lit(f"%) exceeds threshold ({max_rate * 100:.1f}%)")
            ),
        ),
        alert(
            short > max_insufficient,
            "MEDIUM",
            "insufficient_context",
            max_insufficient,
            short,
            F.format_string("Insufficient context refusals (%d) indicate retrieval issues", short),
        ),
    )
