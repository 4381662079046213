"""Request volume, latency and success."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import ratio
from ..session import shared_dir
from .logs import lookback


def daily_performance(log: DataFrame, days: int = 7, as_of: dt.date | None = None) -> DataFrame:
    """One row per date, newest first.

    The rows are first reduced to one per (date, question), so a busy day is
    spread over all tasks; a date then has only partial results to merge.
    """
    seconds = F.col("latency_ms") / 1000.0
    per_question = (
        lookback(log, days, as_of)
        .groupBy("date", "question")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.sum(seconds).alias("s"),
            F.count("latency_ms").alias("ns"),
            F.max(seconds).alias("hi"),
            F.min(seconds).alias("lo"),
            F.count_if(F.col("status") == "success").alias("ok"),
        )
    )
    return (
        per_question.groupBy("date")
        .agg(
            F.sum("n").alias("total_requests"),
            F.count("question").alias("unique_questions"),
            ratio(F.sum("s"), F.sum("ns")).alias("avg_latency_seconds"),
            F.max("hi").alias("max_latency_seconds"),
            F.min("lo").alias("min_latency_seconds"),
            (ratio(F.sum("ok"), F.sum("n")) * 100).alias("success_rate_pct"),
        )
        .orderBy(F.desc("date"))
    )


def performance_summary(log: DataFrame, days: int = 7, as_of: dt.date | None = None) -> DataFrame:
    """One row over the daily rows, none without data; means are unweighted means of daily values."""
    daily = daily_performance(log, days, as_of)
    return daily.agg(
        F.sum("total_requests").alias("total_requests"),
        F.avg("total_requests").alias("avg_daily_requests"),
        F.avg("avg_latency_seconds").alias("avg_latency_seconds"),
        F.max("max_latency_seconds").alias("max_latency_seconds"),
        F.avg("success_rate_pct").alias("avg_success_rate"),
        F.count(F.lit(1)).alias("days_monitored"),
    ).filter("days_monitored > 0")


def exact_median(df: DataFrame, value: str) -> DataFrame:
    """One row (median, n_values): the exact median of a double column; NaN ranks highest.

    Equal values are counted first, so a value that dominates is one row. The counts are dealt out by
    ranges of values and written; one row per range tells in which ranges the two middle ranks lie, and only
    those are ranked, each in a task of its own.
    """
    v = F.col("v")
    values = df.select(F.col(value).cast("double").alias("v")).filter(v.isNotNull())
    counts = values.groupBy("v").agg(F.count(F.lit(1)).alias("n"))
    shared_dir(df.sparkSession)
    ranges = counts.repartitionByRange("v").withColumn("part", F.spark_partition_id()).checkpoint()
    # One row per range.
    parts = ranges.groupBy("part").agg(F.sum("n").alias("size"), F.min("v").alias("least"))
    parts = parts.withColumn("before", F.sum("size").over(Window.orderBy("least")) - F.col("size"))
    total = parts.agg(F.coalesce(F.sum("size"), F.lit(0)).alias("total"))
    low, high = F.floor((F.col("total") - 1) / 2), F.floor(F.col("total") / 2)
    middle = parts.crossJoin(F.broadcast(total)).filter((F.col("before") <= high) & (F.col("before") + F.col("size") > low))
    upto = F.sum("n").over(Window.partitionBy("part").orderBy("v")) + F.col("before")
    ranked = ranges.join(F.broadcast(middle), "part").withColumn("upto", upto)

    def at(rank: Column) -> Column:
        return F.max(F.when((F.col("upto") - F.col("n") <= rank) & (F.col("upto") > rank), v))

    found = ranked.agg(((at(low) + at(high)) / 2).alias("median"))
    return found.crossJoin(F.broadcast(total)).select("median", F.col("total").alias("n_values"))


def summary_stats(df: DataFrame, value: str) -> DataFrame:
    """Mean, median, min, max and count of a column; zeros when it is empty."""
    c = F.col(value).cast("double")
    basic = df.agg(
        F.coalesce(F.avg(c), F.lit(0.0)).alias("mean"),
        F.coalesce(F.min(c), F.lit(0.0)).alias("min"),
        F.coalesce(F.max(c), F.lit(0.0)).alias("max"),
        F.count(c).alias("count"),
    )
    median = F.coalesce(exact_median(df, value).select("median").scalar(), F.lit(0.0))
    return basic.select("mean", median.alias("median"), "min", "max", "count")
