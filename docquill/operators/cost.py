"""Estimated daily cost, its trend and its outliers.

Everything after daily_cost works on one row per day, so its unpartitioned
windows stay small whatever the size of the log.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.money import REQUEST_OVERHEAD_TOKENS, estimate_cost
from ..functions.text import ratio
from .logs import lookback


def daily_cost(log: DataFrame, days: int = 30, as_of: dt.date | None = None) -> DataFrame:
    """Successful requests per date with token and cost estimates, newest first."""
    per_day = (
        lookback(log, days, as_of)
        .filter("status = 'success'")
        .groupBy("date")
        .agg(
            F.count(F.lit(1)).alias("request_count"),
            F.avg(F.length("question")).alias("avg_question_length"),
            F.avg(F.length("answer")).alias("avg_answer_length"),
            F.sum(F.length("question")).alias("total_question_chars"),
            F.sum(F.length(F.coalesce("answer", F.lit("")))).alias("total_answer_chars"),
        )
    )
    return price_days(per_day).orderBy(F.desc("date"))


def price_days(per_day: DataFrame) -> DataFrame:
    """Tokens come from the characters of the whole day, rounded down once."""
    tokens_in = F.floor(F.col("total_question_chars") / 4) + F.col("request_count") * REQUEST_OVERHEAD_TOKENS
    tokens_out = F.floor(F.col("total_answer_chars") / 4)
    return (
        per_day.withColumn("estimated_input_tokens", tokens_in.cast("bigint"))
        .withColumn("estimated_output_tokens", tokens_out.cast("bigint"))
        .withColumn(
            "estimated_cost_usd",
            estimate_cost(F.col("estimated_input_tokens"), F.col("estimated_output_tokens")),
        )
        .withColumn("cost_per_request", ratio(F.col("estimated_cost_usd"), F.col("request_count")))
    )


def cost_summary(log: DataFrame, days: int = 30, as_of: dt.date | None = None) -> DataFrame:
    """One row of totals, means and the projection to 30 days; zeros without data."""
    daily = daily_cost(log, days, as_of)
    zero, none = F.lit(0), F.lit(0.0)
    sums = daily.agg(
        F.coalesce(F.sum("estimated_cost_usd"), none).alias("total_cost_usd"),
        F.coalesce(F.avg("estimated_cost_usd"), none).alias("avg_daily_cost_usd"),
        F.coalesce(F.sum("request_count"), zero).alias("total_requests"),
        F.count("estimated_cost_usd").alias("days_analyzed"),
        F.coalesce(F.sum("estimated_input_tokens"), zero).alias("total_input_tokens"),
        F.coalesce(F.sum("estimated_output_tokens"), zero).alias("total_output_tokens"),
    )
    return sums.withColumns(
        {
            "avg_cost_per_request": F.coalesce(ratio(F.col("total_cost_usd"), F.col("total_requests")), none),
            "projected_monthly_cost": F.col("avg_daily_cost_usd") * 30,
        }
    )


def cost_trend(log: DataFrame, days: int = 30, as_of: dt.date | None = None) -> DataFrame:
    """Daily rows, oldest first, with means over the last seven rows present."""
    week = Window.orderBy("date").rowsBetween(-6, 0)
    return (
        daily_cost(log, days, as_of)
        .withColumns(
            {
                "rolling_7d_cost": F.avg("estimated_cost_usd").over(week),
                "rolling_7d_requests": F.avg("request_count").over(week),
            }
        )
        .orderBy("date")
    )


def cost_anomalies(
    log: DataFrame, days: int = 30, std_threshold: float = 2.0, as_of: dt.date | None = None
) -> DataFrame:
    """Days whose cost lies more than std_threshold deviations over the mean; needs three days."""
    everything = Window.partitionBy()
    cost = F.col("estimated_cost_usd")
    return (
        daily_cost(log, days, as_of)
        .withColumns(
            {
                "_mean": F.avg(cost).over(everything),
                "_std": F.stddev_samp(cost).over(everything),
                "_days": F.count(F.lit(1)).over(everything),
            }
        )
        .filter((F.col("_days") >= 3) & (cost > F.col("_mean") + std_threshold * F.col("_std")))
        .select(
            "date",
            "request_count",
            "estimated_cost_usd",
            "cost_per_request",
            F.try_divide(cost - F.col("_mean"), F.col("_std")).alias("deviation_from_mean"),
        )
        .filter("deviation_from_mean IS NOT NULL")
        .orderBy("date")
    )


def cost_log(
    log: DataFrame,
    days: int = 1,
    as_of: dt.date | None = None,
    calculated_at: dt.datetime | None = None,
    model: str = "gpt-4o-mini",
) -> DataFrame:
    """The rows to append to the cost table."""
    now = F.current_timestamp() if calculated_at is None else F.lit(calculated_at)
    return daily_cost(log, days, as_of).withColumns({"calculated_at": now, "model_used": F.lit(model)})
