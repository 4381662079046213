import datetime as dt
import math
import statistics

import pytest
from pyspark.sql import functions as F

from docquill.functions import money
from docquill.operators import cost, drift, errors, performance, quality, refusals
from docquill.operators.logs import LOG_SCHEMA, lookback
from docquill.plans import monitoring, testbed
from docquill.plans.testbed import AS_OF

DAY = dt.date(2024, 1, 30)


def make(spark, rows):
    """Log rows from (days before DAY, question, answer, status, latency, refusal_type)."""
    out = []
    for i, (back, question, answer, status, latency, refusal) in enumerate(rows):
        date = DAY - dt.timedelta(days=back)
        stamp = dt.datetime(date.year, date.month, date.day, 10, tzinfo=dt.timezone.utc)
        kind = "refusal" if refusal else ("answer" if status == "success" else None)
        out.append((stamp, str(i), question, answer, None, latency, status, None, date, kind, refusal, None, kind == "answer"))
    return spark.createDataFrame(out, LOG_SCHEMA)


def ok(back, question="q", answer="a" * 40, latency=1000.0):
    return (back, question, answer, "success", latency, None)


def test_lookback_spans_one_day_more(spark):
    log = make(spark, [ok(i) for i in range(12)])
    assert lookback(log, 7, DAY).count() == 8


def test_empty_log(spark):
    log = make(spark, [])
    assert performance.daily_performance(log, 7, DAY).count() == 0
    assert performance.performance_summary(log, 7, DAY).count() == 0
    assert cost.cost_summary(log, 30, DAY).first().total_cost_usd == 0.0
    assert cost.cost_trend(log, 30, DAY).count() == 0
    assert cost.cost_anomalies(log, 30, as_of=DAY).count() == 0
    row = errors.error_summary(log, 7, DAY).first()
    assert (row.total_requests, row.total_errors, row.error_rate) == (0, 0, 0.0)
    assert errors.error_alerts(log, 1, DAY).count() == 0
    assert refusals.refusal_summary(log, 7, DAY).count() == 0
    assert refusals.refusal_alerts(log, 7, DAY).count() == 0
    assert drift.distribution_drift(log, as_of=DAY).first().message == drift.INSUFFICIENT
    assert drift.drift_log(log, as_of=DAY).count() == 0
    assert drift.query_length_stats(log, 30, DAY).first().avg_length == 0.0
    assert quality.quality_sample(log, 7, as_of=DAY).count() == 0


def test_equal_costs_have_no_outlier(spark):
    log = make(spark, [ok(i) for i in range(5)])
    assert cost.cost_anomalies(log, 30, 0.0, DAY).count() == 0


def test_outlier_needs_three_days(spark):
    spike = [ok(0, answer="a" * 100000)]
    assert cost.cost_anomalies(make(spark, spike + [ok(1)]), 30, 0.5, DAY).count() == 0
    got = cost.cost_anomalies(make(spark, spike + [ok(i) for i in range(1, 6)]), 30, 1.5, DAY).collect()
    assert [str(r.date) for r in got] == ["2024-01-30"]


def test_cost_floors_the_day_and_skips_null_answers(spark):
    log = make(spark, [ok(0, "abc", "ab"), ok(0, "abc", None), (0, "q", "x", "error", 1.0, None)])
    row = cost.daily_cost(log, 30, DAY).first()
    assert (row.request_count, row.total_question_chars, row.total_answer_chars) == (2, 6, 2)
    assert (row.avg_answer_length, row.estimated_input_tokens, row.estimated_output_tokens) == (2.0, 1 + 1300, 0)


def test_trend_uses_rows_present(spark):
    log = make(spark, [ok(i) for i in (0, 3, 9, 10, 11, 12, 13, 14, 20)] + [ok(20)])
    got = cost.cost_trend(log, 30, DAY).collect()
    assert got[0].rolling_7d_requests == 2.0
    assert got[6].rolling_7d_requests == pytest.approx(8 / 7)
    assert got[8].rolling_7d_requests == 1.0


def test_days_with_errors_is_the_largest_kind(spark):
    log = make(
        spark,
        [(0, "q", None, "error", 1.0, None), (1, "q", None, "error", 1.0, None), (2, "q", None, "exception", 1.0, None), ok(0)],
    )
    row = errors.error_summary(log, 7, DAY).first()
    assert (row.total_errors, row.days_with_errors, row.error_rate) == (3, 2, 75.0)
    kinds = {r.error_type: (r.error_count, r.days_with_errors) for r in errors.errors_by_type(log, 7, DAY).collect()}
    assert kinds == {"HTTP_ERROR": (2, 2), "AGENT_EXCEPTION": (1, 1)}


def test_error_kinds_differ_between_rows_and_summary(spark):
    log = make(spark, [(0, "q", "Error: x", "odd", 1.0, None), (0, "q", None, "odd", 1.0, None)])
    assert sorted(r.error_type for r in errors.error_rows(log, 7, DAY).collect()) == ["AGENT_ERROR", "UNKNOWN"]
    assert [r.error_type for r in errors.errors_by_type(log, 7, DAY).collect()] == ["OTHER"]


def test_refusal_alerts(spark):
    log = make(spark, [(0, "q", "no", "success", 1.0, "insufficient_context")] * 11 + [ok(0)] * 50)
    got = {r.metric: (r.severity, r.message) for r in refusals.refusal_alerts(log, 1, DAY).collect()}
    assert got["refusal_rate"] == ("HIGH", "Refusal rate (18.0%) exceeds threshold (15.0%)")
    assert got["insufficient_context"][0] == "MEDIUM"


def test_drift_cases(spark):
    same = make(spark, [ok(20, "a"), ok(20, "b"), ok(1, "a"), ok(1, "b")])
    row = drift.distribution_drift(same, as_of=DAY).first()
    assert row.drift_score == pytest.approx(0.0, abs=1e-9) and not row.drift_detected
    no_recent = drift.distribution_drift(make(spark, [ok(20, "a")]), as_of=DAY).first()
    assert (no_recent.message, no_recent.baseline_unique_queries, no_recent.drift_detected) == (drift.INSUFFICIENT, 1, False)
    changed = drift.distribution_drift(make(spark, [ok(20, "a"), ok(20, "g"), ok(1, "a"), ok(1, "n")]), as_of=DAY).first()
    assert (changed.new_query_count, changed.disappeared_query_count, changed.new_query_rate) == (1, 1, 0.5)
    assert changed.drift_detected


def test_keywords_drop_words_with_punctuation(spark):
    log = make(spark, [ok(0, "What about records,  records RECORDS should erasure?"), ok(1, "records")])
    got = {r.keyword: (r.frequency, r.days_appeared) for r in drift.keyword_distribution(log, 7, 30, DAY).collect()}
    assert got == {"records": (3, 2)}


@pytest.mark.parametrize("values", [[1.0], [3.0, 1.0], [5.0, 1.0, 3.0], [1e300, -1e300, 0.0, 7.0, 7.0], list(range(1000)), [2.5] * 9 + [1e9], [math.inf, -math.inf, 1.0]])
def test_exact_median(spark, values):
    rows = spark.createDataFrame([(float(v),) for v in values] + [(None,)], "x double")
    row = performance.exact_median(rows, "x").first()
    assert row.median == pytest.approx(statistics.median(values)) and row.n_values == len(values)


def test_median_with_nan_and_one_dominant_value(spark):
    rows = spark.createDataFrame([(math.nan,)] * 3 + [(5.0,)] * 900 + [(float(i),) for i in range(800)], "x double")
    row = performance.exact_median(rows, "x").first()
    assert (row.median, row.n_values) == (5.0, 1703)
    assert math.isnan(performance.exact_median(rows.limit(3), "x").first().median)


def test_stats_of_nothing(spark):
    assert set(performance.summary_stats(spark.createDataFrame([], "x double"), "x").first()) == {0, 0.0}


def test_money(spark):
    row = spark.range(1).select(
        money.estimate_tokens(F.lit("abcdefghi")).alias("a"),
        money.estimate_tokens(F.lit(None).cast("string")).alias("b"),
        money.estimate_cost(F.lit(-1), F.lit(5)).alias("c"),
        money.success_rate(F.lit(0), F.lit(0)).alias("d"),
        money.success_rate(F.lit(4), F.lit(5)).alias("e"),
        money.success_rate(F.lit(4), F.lit(-1)).alias("f"),
        money.success_rate(F.lit(4), F.lit(3)).alias("g"),
    ).first()
    assert tuple(row) == (2, 0, 0.0, 0.0, 100.0, 0.0, 75.0)


def test_fixed_decimals_are_those_of_python(spark):
    from docquill.functions.text import fixed

    values = [0.125, 0.375, 0.625, 0.875, 0.5, 1.0, 0.0, 2 / 3, 6.25, 6.75, 0.3, 1e9 + 0.125, -0.625, 80.392572]
    rows = spark.createDataFrame([(v,) for v in values], "v double")
    v = F.col("v")
    for r in rows.select("v", fixed(v, 1).alias("a"), fixed(v, 2).alias("b"), fixed(v, 3).alias("c")).collect():
        assert (r.a, r.b, r.c) == (f"{r.v:.1f}", f"{r.v:.2f}", f"{r.v:.3f}")


def test_thresholds():
    assert monitoring.validate_thresholds(monitoring.THRESHOLDS) == []
    bad = {**monitoring.THRESHOLDS, "max_refusal_rate": 1.5, "max_avg_latency": -1.0, "lookback_days": 0}
    assert len(monitoring.validate_thresholds(bad)) == 3


def test_known_values_at_small_scale(spark, sf):
    """Values measured once with two engines on the same data."""
    log = testbed.log(spark, sf).cache()
    assert {r.status: r["count"] for r in log.groupBy("status").count().collect()} == {
        "success": 7986, "error": 1510, "exception": 282, "timeout": 222,
    }
    kinds = log.groupBy(F.coalesce("refusal_type", "response_classification").alias("k")).count().collect()
    assert {r.k: r["count"] for r in kinds} == {
        "answer": 2001, "out_of_scope": 1324, "vague": 1322, "empty": 679, "ambiguous_question": 675,
        "insufficient_context": 666, "capability_limitation": 659, None: 2674,
    }
    perf = performance.performance_summary(log, 7, AS_OF).first()
    assert perf.total_requests == 2665 and perf.max_latency_seconds == pytest.approx(49.002)
    assert perf.avg_latency_seconds == pytest.approx(4.887624, abs=1e-6)
    assert perf.avg_success_rate == pytest.approx(80.392572, abs=1e-6)
    total = cost.cost_summary(log, 30, AS_OF).first()
    assert total.total_cost_usd == pytest.approx(0.8418255) and total.days_analyzed == 30
    row = drift.distribution_drift(log, as_of=AS_OF).first()
    assert row.drift_score == pytest.approx(4.254326, abs=1e-6)
    assert (row.baseline_unique_queries, row.recent_unique_queries) == (3832, 2055)
    assert (row.new_query_count, row.disappeared_query_count, row.drift_detected) == (483, 2260, True)
    log.unpersist()


def test_report_goes_on_without_a_part(spark):
    log = make(spark, [ok(0, "What about records?")])

    def missing():
        return spark.read.parquet("/no/such/table")

    rows = monitoring.monitoring_details(log, missing, as_of=DAY).collect()
    by = {r.section: r for r in rows}
    assert by["quality"].place == 0 and "failed" in by["quality"].item
    assert by["top_questions"].item == "What about records?" and by["top_questions"].value == 1.0


def test_threshold_violations(spark):
    rows = [("min_quality_score", 6.0), ("min_quality_score", 5.0), ("lookback_days", 0.0), ("other", -1.0), ("max_refusal_rate", math.nan), ("sample_size", None)]
    found = monitoring.threshold_violations(spark.createDataFrame(rows, "name string, value double")).collect()
    assert sorted(r.problem for r in found) == ["lookback_days must be >= 1", "max_refusal_rate must be 0-1", "min_quality_score must be 0-5"]
