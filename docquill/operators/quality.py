"""Judged quality: samples, scores, summary."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .logs import lookback, since

SCORES = ["relevance", "accuracy", "completeness", "citation", "clarity", "overall"]
# Fixed value: the sampled share.
SAMPLE_SHARE = 0.1
#: Hex digits of the hash that make a cell; 65,536 cells are counted, whatever the log's size.
CELL_DIGITS = 4


def quality_sample(
    log: DataFrame,
    days: int = 7,
    share: float = SAMPLE_SHARE,
    cap: int | None = None,
    seed: int = 0,
    as_of: dt.date | None = None,
) -> DataFrame:
    """A share of the valid answers, at least one and at most `cap` if that is given, first in hash order.

    Answers are counted by the first digits of their hash. Whole cells are taken without sorting; only the rows of the
    cell where the sample ends are put in order.
    """
    valid = lookback(log, days, as_of).filter("status = 'success' AND is_valid_answer")
    place = F.md5(F.concat(F.col("request_id"), F.lit(f":{seed}")))
    rows = valid.withColumn("_place", place).withColumn("_cell", F.substring("_place", 1, CELL_DIGITS))
    counts = rows.groupBy("_cell").agg(F.count(F.lit(1)).alias("_n"))
    upto = counts.withColumn("_upto", F.sum("_n").over(Window.orderBy("_cell")))
    total = counts.agg(F.coalesce(F.sum("_n"), F.lit(0))).first()[0]
    size = max(1, int(total * share))
    size = size if cap is None else min(size, cap)
    last = upto.filter(F.col("_upto") >= min(size, total)).orderBy("_cell").first()
    names = ["date", "request_id", "timestamp", "question", "answer", "context"]
    if last is None:
        return rows.select(*names).limit(0)
    whole = rows.filter(F.col("_cell") < last["_cell"])
    rest = rows.filter(F.col("_cell") == last["_cell"]).orderBy("_place", "request_id")
    return whole.select(*names).unionByName(rest.limit(size - (last["_upto"] - last["_n"])).select(*names))


def validate_scores(df: DataFrame, reply: str = "reply") -> DataFrame:
    """A judge's JSON reply to score columns; zeros and an error when it is unusable."""
    fields = [*SCORES, "explanation"]
    rows = df.withColumn("_reply", F.try_parse_json(reply))
    value = F.col("_reply")
    missing = F.array_compact(
        F.array(*[F.when(F.try_variant_get(value, f"$.{f}", "variant").isNull(), f) for f in fields])
    )
    rows = rows.withColumn("_missing", missing)
    good = value.isNotNull() & (F.size("_missing") == 0)

    def score(name: str) -> Column:
        return F.when(good, F.try_variant_get(value, f"$.{name}", "double")).otherwise(0.0)

    problem = F.when(value.isNull(), "JSON parsing error").otherwise(
        F.concat(F.lit("Missing required fields: "), F.array_join("_missing", ", "))
    )
    explanation = F.when(good, F.try_variant_get(value, "$.explanation", "string")).otherwise(
        F.concat(F.lit("Error: "), problem)
    )
    return rows.withColumns({**{s: score(s) for s in SCORES}, "explanation": explanation}).drop("_reply", "_missing")


def quality_scores(
    sample: DataFrame, replies: DataFrame, key: str = "request_id", evaluated_at: dt.datetime | None = None
) -> DataFrame:
    """Rows for the quality table: the sample with its judged replies; rows without a reply are left out."""
    now = F.current_timestamp() if evaluated_at is None else F.lit(evaluated_at)
    scored = validate_scores(sample.join(replies.select(key, "reply"), key))
    return scored.select(
        now.alias("evaluation_date"),
        F.col("date").alias("query_date"),
        "request_id",
        "question",
        "answer",
        *SCORES,
        "explanation",
    )


def quality_summary(metrics: DataFrame, days: int = 7, as_of: dt.date | None = None) -> DataFrame:
    """Mean scores and the number of judged requests; zeros when there are none."""
    rows = metrics.filter(F.col("evaluation_date") >= since(as_of, days).cast("timestamp"))
    return rows.agg(
        *[F.coalesce(F.avg(s), F.lit(0.0)).alias(f"avg_{s}") for s in SCORES],
        F.count(F.lit(1)).alias("evaluated_queries"),
    )
