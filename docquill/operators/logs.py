"""The request log: rows, look-back, classes."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.classify import MIN_ANSWER_LENGTH, classify_response
from ..functions.text import ratio

LOG_SCHEMA = T.StructType(
    [
        T.StructField("timestamp", T.TimestampType(), False),
        T.StructField("request_id", T.StringType(), False),
        T.StructField("question", T.StringType(), False),
        T.StructField("answer", T.StringType()),
        T.StructField("context", T.StringType()),
        T.StructField("latency_ms", T.DoubleType()),
        T.StructField("status", T.StringType(), False),
        T.StructField("error_message", T.StringType()),
        T.StructField("date", T.DateType(), False),
        T.StructField("response_classification", T.StringType()),
        T.StructField("refusal_type", T.StringType()),
        T.StructField("classification_reason", T.StringType()),
        T.StructField("is_valid_answer", T.BooleanType()),
    ]
)


def since(as_of: dt.date | None, days: int) -> Column:
    """First date of a look-back of `days`; the as-of day itself comes on top."""
    end = F.current_date() if as_of is None else F.lit(as_of)
    return F.date_sub(end, days)


def lookback(log: DataFrame, days: int, as_of: dt.date | None = None, column: str = "date") -> DataFrame:
    """Rows dated `days` before as_of or later, without an upper bound.

    On a log partitioned by date this prunes whole partitions. The date of a
    log row is that of its timestamp; the same bound on the timestamp reaches
    the scan of raw requests.
    """
    first = since(as_of, days)
    rows = log.filter(F.col(column) >= first)
    if column == "date" and "timestamp" in log.columns:
        rows = rows.filter(F.col("timestamp") >= first.cast("timestamp"))
    return rows


def normalise_requests(df: DataFrame, question: str = "question", error: str = "error") -> DataFrame:
    """Give raw calls an id, a status and an answer; a failed call answers with its error."""
    cols = df.columns
    failed = F.col(error).isNotNull() if error in cols else F.lit(False)
    err = F.col(error) if error in cols else F.lit(None).cast("string")
    given = F.col("answer") if "answer" in cols else F.lit(None).cast("string")
    new = {
        question: F.coalesce(F.col(question).cast("string"), F.lit("")),
        "status": F.when(failed, "error").otherwise("success"),
        "error_message": err,
        "answer": F.when(failed, F.concat(F.lit("Error: "), err)).otherwise(F.coalesce(given, F.lit(""))),
    }
    if "request_id" not in cols:
        new["request_id"] = F.uuid()
    if "latency_ms" not in cols:
        new["latency_ms"] = F.lit(0.0)
    return df.withColumns(new)


def build_log_rows(
    requests: DataFrame, min_length: int = MIN_ANSWER_LENGTH, max_error: int | None = None
) -> DataFrame:
    """Requests to log rows. Only non-empty answers of successful requests get a class.

    max_error cuts messages to so many characters.
    """
    cols = requests.columns

    def opt(name: str, kind: str) -> Column:
        return F.col(name) if name in cols else F.lit(None).cast(kind)

    message = opt("error_message", "string")
    if max_error is not None:
        message = F.substring(message, 1, max_error)
    base = requests.select(
        (F.col("timestamp") if "timestamp" in cols else F.current_timestamp()).alias("timestamp"),
        F.col("request_id").cast("string").alias("request_id"),
        F.col("question"),
        opt("answer", "string").alias("answer"),
        opt("context", "string").alias("context"),
        F.coalesce(opt("latency_ms", "double"), F.lit(0.0)).alias("latency_ms"),
        F.col("status"),
        message.alias("error_message"),
    ).withColumn("date", F.to_date("timestamp"))
    scored = classify_response(
        base, "answer", min_length, only=(F.col("answer") != "") & (F.col("status") == "success")
    )
    return scored.withColumn(
        "is_valid_answer", F.coalesce(F.col("response_classification") == "answer", F.lit(False))
    ).select(*LOG_SCHEMA.names)


def answer_flags(df: DataFrame, answer: str = "answer") -> DataFrame:
    """Classes with is_valid_answer and is_refusal (refusal, vague or empty)."""
    kind = F.col("response_classification")
    return classify_response(df, answer).withColumns(
        {"is_valid_answer": kind == "answer", "is_refusal": kind.isin("refusal", "vague", "empty")}
    )


CLASSES = ["answer", "refusal", "vague", "empty"]


def classification_stats(df: DataFrame, column: str = "response_classification") -> DataFrame:
    """One row: count and rate of each class, zeros when there are no rows."""
    counts = df.agg(
        F.count(F.lit(1)).alias("total"),
        *[F.count_if(F.col(column) == c).alias(f"{c}_count") for c in CLASSES],
    )
    return counts.withColumns(
        {f"{c}_rate": F.coalesce(ratio(F.col(f"{c}_count"), F.col("total")), F.lit(0.0)) for c in CLASSES}
    )


def log_stats(log: DataFrame) -> DataFrame:
    """One row over log rows, with unclassified ones in the total; none when the log is empty."""
    kind = F.col("response_classification")
    counts = log.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col("is_valid_answer")).alias("valid_answer_count"),
        F.count_if(kind == "refusal").alias("refusal_count"),
        F.count_if(kind == "vague").alias("vague_count"),
    ).filter("total > 0")
    return counts.withColumns(
        {
            "valid_answer_rate": ratio(F.col("valid_answer_count"), F.col("total")),
            "refusal_rate": ratio(F.col("refusal_count"), F.col("total")),
        }
    )
