"""What is asked, how that changes."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import fixed, ratio
from .logs import lookback, since

# Words that never count as keywords, smoothing, limits.
STOP_WORDS = [
    "what", "when", "where", "which", "should", "would", "could", "does", "have", "about",
    "under", "their", "there", "these", "those", "with", "from", "into", "that", "this",
]
SMOOTHING = 1e-10
DRIFT_THRESHOLD = 0.3
NEW_QUERY_LIMIT = 0.3
INSUFFICIENT = "Insufficient data for drift detection"


def query_distribution(log: DataFrame, days: int = 7, as_of: dt.date | None = None) -> DataFrame:
    return (
        lookback(log, days, as_of)
        .groupBy("question")
        .agg(
            F.count(F.lit(1)).alias("frequency"),
            F.min("date").alias("first_seen"),
            F.max("date").alias("last_seen"),
        )
        .orderBy(F.desc("frequency"), "question")
    )


def top_queries(log: DataFrame, days: int = 7, top_n: int = 20, as_of: dt.date | None = None) -> DataFrame:
    """The most frequent questions with their share of all requests in range."""
    rows = lookback(log, days, as_of)
    total = rows.agg(F.count(F.lit(1))).scalar()
    return (
        rows.groupBy("question")
        .agg(F.count(F.lit(1)).alias("frequency"))
        .orderBy(F.desc("frequency"), "question")
        .limit(top_n)
        .withColumn("percentage", F.col("frequency") * F.lit(100.0) / total)
    )


def is_keyword(word: Column) -> Column:
    return (F.length(word) > 4) & ~word.rlike("[^a-z]") & ~word.isin(STOP_WORDS)


def keyword_distribution(
    log: DataFrame, days: int = 7, top_n: int = 30, as_of: dt.date | None = None
) -> DataFrame:
    """The most frequent words of the questions. Words with punctuation do not count.

    Counted per (word, date) first: a word in every question is one row per
    date and task before it is shuffled.
    """
    found = F.filter(F.split(F.lower("question"), " "), is_keyword)
    per_day = (
        lookback(log, days, as_of)
        .select("date", F.explode(found).alias("keyword"))
        .groupBy("keyword", "date")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return (
        per_day.groupBy("keyword")
        .agg(F.sum("n").alias("frequency"), F.count("date").alias("days_appeared"))
        .orderBy(F.desc("frequency"), "keyword")
        .limit(top_n)
    )


def question_counts(
    log: DataFrame, baseline_days: int = 30, recent_days: int = 7, as_of: dt.date | None = None
) -> DataFrame:
    """Requests per question in the baseline and in the recent range, in one scan."""
    recent = F.col("date") >= since(as_of, recent_days)
    return (
        lookback(log, max(baseline_days, recent_days), as_of)
        .withColumn("_recent", recent)
        .groupBy("question")
        .agg(
            F.count_if(~F.col("_recent") & (F.col("date") >= since(as_of, baseline_days))).alias("baseline"),
            F.count_if(F.col("_recent")).alias("recent"),
        )
    )


def distribution_drift(
    log: DataFrame,
    baseline_days: int = 30,
    recent_days: int = 7,
    threshold: float = DRIFT_THRESHOLD,
    as_of: dt.date | None = None,
) -> DataFrame:
    """One row: KL divergence of recent from baseline questions, new and gone questions.

    With r of R recent and b of B baseline requests for a question, the sum of
    (r/R) ln((r/R)/(b/B)) splits into terms that need R and B only at the end,
    so one aggregate over the questions is enough.
    """
    b, r = F.col("baseline").cast("double"), F.col("recent").cast("double")
    both, new, gone = (b > 0) & (r > 0), (r > 0) & (b == 0), (b > 0) & (r == 0)

    def total(when: Column, value: Column) -> Column:
        return F.coalesce(F.sum(F.when(when, value)), F.lit(0.0))

    sums = question_counts(log, baseline_days, recent_days, as_of).agg(
        total(b > 0, b).alias("B"),
        total(r > 0, r).alias("R"),
        F.count_if(b > 0).alias("baseline_unique_queries"),
        F.count_if(r > 0).alias("recent_unique_queries"),
        F.count_if(new).alias("n_new"),
        F.count_if(gone).alias("n_gone"),
        total(both, r * (F.ln(r) - F.ln(b))).alias("both_terms"),
        total(both, r).alias("both_r"),
        total(new, r * F.ln(r)).alias("new_terms"),
        total(new, r).alias("new_r"),
        total(gone, F.ln(b)).alias("gone_terms"),
    )
    big_b, big_r, eps = F.col("B"), F.col("R"), F.lit(SMOOTHING)
    kl = (
        (F.col("both_terms") + F.col("both_r") * (F.ln(big_b) - F.ln(big_r))) / big_r
        + (F.col("new_terms") - F.col("new_r") * (F.ln(big_r) + F.ln(eps))) / big_r
        + eps * (F.col("n_gone") * (F.ln(eps) + F.ln(big_b)) - F.col("gone_terms"))
    )
    enough = (big_b > 0) & (big_r > 0)

    def known(c: Column, otherwise: Column) -> Column:
        return F.when(enough, c).otherwise(otherwise)

    out = sums.select(
        known(kl, F.lit(0.0)).alias("drift_score"),
        F.lit(float(threshold)).alias("drift_threshold"),
        known(F.col("n_new"), F.lit(0)).alias("new_query_count"),
        known(ratio(F.col("n_new"), F.col("recent_unique_queries")), F.lit(0.0)).alias("new_query_rate"),
        known(F.col("n_gone"), F.lit(0)).alias("disappeared_query_count"),
        known(ratio(F.col("n_gone"), F.col("baseline_unique_queries")), F.lit(0.0)).alias(
            "disappeared_query_rate"
        ),
        "baseline_unique_queries",
        "recent_unique_queries",
        enough.alias("_enough"),
    )
    message = F.when(
        F.col("_enough"),
        F.format_string(
            "KL divergence: %s, New queries: %d, Disappeared: %d",
            fixed(F.col("drift_score"), 3),
            F.col("new_query_count"),
            F.col("disappeared_query_count"),
        ),
    ).otherwise(INSUFFICIENT)
    drifted = (F.col("drift_score") > threshold) | (F.col("new_query_rate") > NEW_QUERY_LIMIT)
    return out.withColumns({"drift_detected": F.col("_enough") & drifted, "message": message}).drop("_enough")


def new_queries(
    log: DataFrame, baseline_days: int = 30, recent_days: int = 7, as_of: dt.date | None = None
) -> DataFrame:
    """Recent questions that the baseline lacks."""
    return (
        question_counts(log, baseline_days, recent_days, as_of)
        .filter("recent > 0 AND baseline = 0")
        .select("question", F.col("recent").alias("frequency"))
    )


def disappeared_queries(
    log: DataFrame, baseline_days: int = 30, recent_days: int = 7, as_of: dt.date | None = None
) -> DataFrame:
    """Baseline questions not asked recently."""
    return (
        question_counts(log, baseline_days, recent_days, as_of)
        .filter("recent = 0 AND baseline > 0")
        .select("question", F.col("baseline").alias("frequency"))
    )


def query_length_stats(log: DataFrame, days: int = 30, as_of: dt.date | None = None) -> DataFrame:
    """Mean, min, max, sample deviation and exact median of question lengths; zeros when empty.

    Works on the counts per length, of which there are at most as many as the
    longest question has characters.
    """
    hist = (
        lookback(log, days, as_of)
        .groupBy(F.length("question").alias("len"))
        .agg(F.count("question").alias("n"))
        .filter("len IS NOT NULL")
    )
    size, n = F.col("len").cast("double"), F.col("n")
    mean = F.sum(size * n) / F.sum(n)
    moments = hist.agg(
        mean.alias("avg_length"),
        F.min("len").alias("min_length"),
        F.max("len").alias("max_length"),
        F.sum(n).alias("total"),
        F.sum(size * n).alias("s1"),
        F.sum(size * size * n).alias("s2"),
        F.percentile("len", F.lit(0.5), n).alias("median_length"),
    )
    spread = F.greatest(F.col("s2") - F.col("s1") * F.col("s1") / F.col("total"), F.lit(0.0))
    std = F.sqrt(F.try_divide(spread, F.col("total") - 1))
    zero = F.lit(0.0)
    return moments.select(
        F.coalesce("avg_length", zero).alias("avg_length"),
        F.coalesce("min_length", F.lit(0)).alias("min_length"),
        F.coalesce("max_length", F.lit(0)).alias("max_length"),
        F.coalesce(std, zero).alias("std_length"),
        F.coalesce("median_length", zero).alias("median_length"),
    )


def temporal_pattern(log: DataFrame, days: int = 30, as_of: dt.date | None = None) -> DataFrame:
    """Requests per date, hour and day of week (1 is Sunday)."""
    return (
        lookback(log, days, as_of)
        .groupBy(
            "date", F.hour("timestamp").alias("hour_of_day"), F.dayofweek("date").alias("day_of_week")
        )
        .agg(F.count(F.lit(1)).alias("request_count"))
        .orderBy(F.desc("date"), "hour_of_day")
    )


def drift_log(
    log: DataFrame,
    baseline_days: int = 30,
    recent_days: int = 7,
    threshold: float = DRIFT_THRESHOLD,
    as_of: dt.date | None = None,
    measured_at: dt.datetime | None = None,
) -> DataFrame:
    """The row to append to the drift table; none when data was insufficient."""
    now = F.current_timestamp() if measured_at is None else F.lit(measured_at)
    return (
        distribution_drift(log, baseline_days, recent_days, threshold, as_of)
        .filter(F.col("message") != INSUFFICIENT)
        .withColumn("measured_at", now)
    )
