"""Scoring answers against expected behaviour, comparing runs, building cases."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Mapping
from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import fixed, ratio
from ..session import work_path
from ..sources.files import write_report, write_text
from .mentions import names_in

# The score of a passed case, the pass rate of a good run.
PASS_MARK = 0.7
GATE = 0.90


def _list(c: Column) -> Column:
    return F.coalesce(c, F.array().cast("array<string>"))


def _as_text(df: DataFrame, name: str) -> Column:
    """A string column, or a list column joined by spaces; NULL is empty."""
    kind = df.schema[name].dataType.typeName()
    c = F.array_join(name, " ") if kind == "array" else F.col(name).cast("string")
    return F.coalesce(c, F.lit(""))


def _python_list(c: Column, opening: str = "[", closing: str = "]") -> Column:
    quoted = F.transform(c, lambda x: F.concat(F.lit("'"), x, F.lit("'")))
    return F.concat(F.lit(opening), F.array_join(quoted, ", "), F.lit(closing))


def score_cases(cases: DataFrame, responses: DataFrame) -> DataFrame:
    """Cases joined with the responses to them; a case without one scores as empty.

    `cases` has id, category and expected_behavior with sources,
    must_retrieve_from_articles and must_include_in_answer, as far as it has them. `responses` has id,
    answer and context (text or a list). Missing items are listed in order.
    """
    given = responses.select("id", _as_text(responses, "answer").alias("answer"), _as_text(responses, "context").alias("context"))
    blank = F.lit("")
    expected = F.col("expected_behavior")
    known = cases.schema["expected_behavior"].dataType.names

    def items(name: str) -> Column:
        return _list(expected[name]) if name in known else F.array().cast("array<string>")

    rows = cases.join(given, "id", "left").select(
        F.col("id").alias("case_id"),
        "category",
        F.lower(F.coalesce("context", blank)).alias("ctx"),
        F.lower(F.concat(F.coalesce("answer", blank), F.lit(" "), F.coalesce("context", blank))).alias("both"),
        items("sources").alias("sources"),
        F.concat(items("must_retrieve_from_articles"), items("must_include_in_answer")).alias("items"),
    )
    rows = rows.withColumns(
        {
            "source_found": (F.size("sources") == 0) | F.exists("sources", lambda x: F.contains(F.col("ctx"), F.lower(x))),
            "found": F.filter("items", lambda x: F.contains(F.col("both"), F.lower(x))),
        }
    )
    scored = rows.withColumns(
        {
            "source_correct": F.col("source_found").cast("double"),
            "content_match": F.when(F.size("items") == 0, 1.0).otherwise(ratio(F.size("found"), F.size("items"))),
        }
    )
    total = (F.col("source_correct") + F.col("content_match")) / 2
    missing = F.array_sort(F.array_distinct(F.array_except("items", "found")))
    source_note = (
        F.when(F.size("sources") == 0, None)
        .when(F.col("source_found"), F.concat(F.lit("PASS: Retrieved from expected sources: "), _python_list(F.col("sources"))))
        .otherwise(F.concat(F.lit("FAIL: Expected sources "), _python_list(F.col("sources")), F.lit(" not found")))
    )
    content_note = (
        F.when(F.size("items") == 0, None)
        .when(
            F.col("content_match") >= PASS_MARK,
            F.format_string("PASS: Found %d/%d expected items", F.size("found"), F.size("items")),
        )
        .otherwise(
            F.concat(
                F.format_string("FAIL: Missing %d items: ", F.size(missing)), _python_list(missing, "{", "}")
            )
        )
    )
    return scored.select(
        "case_id",
        "category",
        (total >= PASS_MARK).alias("passed"),
        total.alias("score"),
        "source_correct",
        "content_match",
        F.concat_ws(" | ", source_note, content_note).alias("feedback"),
    )


METRICS = ["total_cases", "passed", "failed", "pass_rate", "avg_score", "source_accuracy", "content_match"]


def eval_metrics(results: DataFrame) -> DataFrame:
    """One row of totals and means."""
    passed = F.count_if(F.col("passed"))
    return results.agg(
        F.count(F.lit(1)).alias("total_cases"),
        passed.alias("passed"),
        F.count_if(~F.col("passed")).alias("failed"),
        ratio(passed, F.count(F.lit(1))).alias("pass_rate"),
        F.avg("score").alias("avg_score"),
        F.avg("source_correct").alias("source_accuracy"),
        F.avg("content_match").alias("content_match"),
    )


def category_breakdown(results: DataFrame) -> DataFrame:
    """Per category: passed, total, their text, mean and sample deviation of the score, share of passes."""
    return (
        results.groupBy("category")
        .agg(
            F.count_if(F.col("passed")).alias("passed"),
            F.count(F.lit(1)).alias("total"),
            F.round(F.avg("score"), 3).alias("avg_score"),
            F.round(F.stddev_samp("score"), 3).alias("std_dev"),
            ratio(F.count_if(F.col("score") >= PASS_MARK), F.count(F.lit(1))).alias("pass_rate"),
        )
        .withColumn("pass_total", F.concat_ws("/", F.col("passed").cast("string"), F.col("total").cast("string")))
        .orderBy("category")
    )


def failed_cases(results: DataFrame) -> DataFrame:
    """Cases that did not pass, lowest score first."""
    return results.filter(~F.col("passed")).orderBy("score", "case_id")


def metric_rows(results: DataFrame, value: str) -> DataFrame:
    """eval_metrics as (metric, value) rows."""
    return eval_metrics(results).select(*[F.col(m).cast("double").alias(m) for m in METRICS]).unpivot(
        [], METRICS, "metric", value
    )


def compare_runs(first: DataFrame, second: DataFrame) -> DataFrame:
    """Per metric: both runs and run 2 minus run 1."""
    joined = metric_rows(first, "run_1").join(metric_rows(second, "run_2"), "metric", "full_outer")
    return joined.withColumn("delta", F.col("run_2") - F.col("run_1"))


def gate(results: DataFrame, minimum: float = GATE) -> DataFrame:
    """One row: pass rate, the minimum, and whether the run is good enough."""
    return eval_metrics(results).select(
        "pass_rate",
        F.lit(float(minimum)).alias("minimum"),
        F.coalesce(F.col("pass_rate") >= minimum, F.lit(False)).alias("gate_passed"),
    )


REPORT_ORDER = ["section", "sort_key", "line_no"]


def eval_report(results: DataFrame, generated: dt.datetime | None = None) -> DataFrame:
    """The text report as ordered lines (section, sort_key, line_no, line).

    The report lists every failed case, so it stays distributed rows and is
    never one string: write it sorted by the first three columns.
    """
    now = F.current_timestamp() if generated is None else F.lit(generated)
    rule, dash = "=" * 80, "-" * 80

    def block(df: DataFrame, section: int, key: Column, *text: Column) -> DataFrame:
        return df.select(
            F.lit(section).alias("section"), key.cast("string").alias("sort_key"), F.posexplode(F.array(*text)).alias("line_no", "line")
        )

    stamp = F.date_format(now, "yyyy-MM-dd HH:mm:ss")
    head = block(
        eval_metrics(results),
        0,
        F.lit(""),
        F.lit(rule),
        F.lit("Evaluation Report"),
        F.lit(rule),
        F.concat(F.lit("Generated: "), stamp),
        F.lit(""),
        F.lit("OVERALL METRICS"),
        F.lit(dash),
        F.format_string("Total Test Cases: %d", "total_cases"),
        F.format_string("Passed: %d (%s%%)", F.col("passed"), fixed(F.col("pass_rate") * 100, 1)),
        F.format_string("Failed: %d", "failed"),
        F.concat(F.lit("Average Score: "), fixed(F.col("avg_score"), 3)),
        F.lit(""),
        F.lit("CATEGORY BREAKDOWN"),
        F.lit(dash),
    )
    categories = block(
        category_breakdown(results),
        1,
        F.col("category"),
        F.format_string(
            "%s: %d/%d passed (avg score: %s)", "category", "passed", "total", fixed(F.col("avg_score"), 3)
        ),
    )
    failed_head = block(
        eval_metrics(results).filter("failed > 0"),
        2,
        F.lit(""),
        F.lit(""),
        F.lit(dash),
        F.format_string("FAILED CASES (%d)", "failed"),
        F.lit(dash),
    )
    failed = block(
        results.filter(~F.col("passed")),
        3,
        F.concat(F.format_string("%.9f ", "score"), F.col("case_id")),
        F.format_string("• %s | Score: %s | %s", F.col("case_id"), fixed(F.col("score"), 2), F.col("category")),
        F.concat(F.lit("  "), F.coalesce("feedback", F.lit("No feedback"))),
        F.lit(""),
    )
    foot = block(eval_metrics(results), 4, F.lit(""), F.lit(rule))
    out = head
    for part in (categories, failed_head, failed, foot):
        out = out.unionByName(part)
    return out.orderBy(*REPORT_ORDER)


def write_run(results: DataFrame, folder: str, single_file: bool = False) -> dict[str, str]:
    """Results and failed cases as CSV and the report as text; returns the paths."""
    # Scored once: the report alone reads its input five times.
    path = work_path(results.sparkSession, "scored")
    results.write.parquet(path)
    results = results.sparkSession.read.schema(results.schema).parquet(path)
    failed = failed_cases(results)
    return {
        "results": write_report(results, f"{folder}/evaluation_results", single_file),
        "failed": write_report(failed, f"{folder}/failed_cases", single_file),
        "report": write_text(eval_report(results), f"{folder}/report", REPORT_ORDER, single_file=single_file),
    }


def case_mix(pool: DataFrame) -> DataFrame:
    return pool.groupBy("category").agg(F.count(F.lit(1)).alias("cases")).orderBy(F.desc("cases"), "category")


REQUIRED_FIELDS = ["id", "question", "category", "expected_behavior"]


def validate_cases(cases: DataFrame) -> DataFrame:
    """The cases that lack a required field, with the fields they lack."""
    lacking = F.filter(
        F.array(
            *[
                F.when(F.col(f).isNull() if f in cases.columns else F.lit(True), f)
                for f in REQUIRED_FIELDS
            ]
        ),
        lambda f: f.isNotNull(),
    )
    keep = [F.col("id")] if "id" in cases.columns else []
    return cases.select(*keep, lacking.alias("missing_fields")).filter(F.size("missing_fields") > 0)


def profile_titles(df: DataFrame, title: str) -> DataFrame:
    """The distinct non-empty titles."""
    return df.filter(F.col(title).isNotNull() & (F.col(title) != "")).select(F.col(title).alias("concept")).distinct()


def profile_mentions(df: DataFrame, text: str, names: Iterable[str] | DataFrame) -> DataFrame:
    """Which of the names occur in any text, letter case aside, in title case. Names may be a table with a column name."""
    if not isinstance(names, DataFrame):
        names = df.sparkSession.createDataFrame([(n,) for n in names], "name string")
    return names_in(df, text, names).select(F.initcap("name").alias("concept"))


# The questions used when none was written for a case.
FALLBACK_ARTICLE = (
    "What are our baseline transparent communication obligations when handling requests for access to "
    "personal information details under {ctx}?"
)
FALLBACK_FINES = "What major financial penalties have European regulators issued for compliance tracking failures?"
FALLBACK_POLICY = "What is our company baseline position on retention timelines for standard behavioral tracking data?"
FALLBACK_MULTI = (
    "What are the strict operational notification limits for security incidents, and what fines have been "
    "levied for late reports?"
)
FIRST_FINES_CONCEPT = "largest GDPR fines"
MULTI_SUFFIX = " compliance alignment"


# The concepts used where a source has none.
DEFAULT_CONCEPTS = {
    "legislation": ["General Modalities Context", "Right of access"],
    "fines": ["Facebook", "Google"],
    "policy": ["Global Policy Overview", "Customer Identity Profile"],
}


def fallback_question(concept: Column, context: Column, kind: Column) -> Column:
    before, after = FALLBACK_ARTICLE.split("{ctx}")
    return (
        F.when(kind != "single", FALLBACK_MULTI)
        .when(
            F.contains(concept, F.lit("Article")) | F.contains(concept, F.lit("Context")),
            F.concat(F.lit(before), context, F.lit(after)),
        )
        .when(context == "fines", FALLBACK_FINES)
        .otherwise(FALLBACK_POLICY)
    )


_STRINGS = "array<string>"


def expected_behavior(sources: list[str], concept: Column, first: Column, form: str = "golden") -> Column:
    """What an answer must retrieve and include, as one struct for all categories; fields that don't apply are NULL.

    form: "golden" for test sets, with items that the answer must include and checks per source; "pool" for question
    pools, where the checks are plain lists. `first` marks the case that asks for the largest fines.
    """
    golden = form == "golden"
    several = len(sources) > 1
    main = sources[-1]
    words = F.array(F.lower(concept), F.lit("fine"))
    keywords = F.when(first, F.array(F.lit("fine"), F.lit("€"), F.lit("company"))).otherwise(words) if golden else words
    articles, breaches = F.array(concept), F.array(F.lit("fine"), F.lit("breach"))
    included = {"policy": F.array(F.lit("policy")), "legislation": F.array(concept)}.get(main, F.array(concept, F.lit("fine")))
    if several:
        included = F.array(concept, F.lit("fine"))

    def given(value: Column, when: bool, kind: str = _STRINGS) -> Column:
        return (value if when else F.lit(None)).cast(kind)

    def check(value: Column, name: str) -> Column:
        inner = F.struct(value.alias(name)) if golden else value
        return given(inner, several, f"struct<{name}:{_STRINGS}>" if golden else _STRINGS)

    fields = [
        F.array(*[F.lit(s) for s in sources]).alias("sources"),
        given(articles, main == "legislation" and not several).alias("must_retrieve_from_articles"),
        given(keywords, main == "fines" and not several).alias("must_retrieve_keywords"),
        given(articles, main == "policy" and not several).alias("must_retrieve_from_sections"),
        check(articles, "must_retrieve_from_articles").alias("legislation_check"),
        check(breaches, "must_retrieve_keywords").alias("fines_check"),
    ]
    return F.struct(*fields, *([included.alias("must_include_in_answer")] if golden else []))


def build_cases(
    mix: list[Mapping[str, Any]],
    concepts: Mapping[str, DataFrame],
    prefix: str = "case_",
    digits: int = 3,
    medium_every: int = 2,
    questions: DataFrame | None = None,
    text: str = "question",
    defaults: Mapping[str, list[str]] = DEFAULT_CONCEPTS,
    form: str = "golden",
) -> DataFrame:
    """Cases by a mix of categories, going round the concepts of each, with what an answer to each must show.

    `mix` rows have category, number, about, sources (list) and kind; `concepts` maps the
    first source of a category to a DataFrame with a concept column. A written
    question (concept, question) that quotes its concept is replaced by the
    fallback. Only the first `count` concepts by name are ever needed. A source
    without any concept uses the default ones.
    """
    spark = next(iter(concepts.values())).sparkSession
    parts = []
    first_id = 1
    for entry in mix:
        category, count, main = entry["category"], int(entry["number"]), entry["sources"][-1]
        known = concepts[main].select("concept").distinct()
        if defaults.get(main):
            spare = spark.createDataFrame([(c,) for c in defaults[main]], "concept string")
            known = known.unionByName(spare.filter(known.agg(F.count(F.lit(1))).scalar() == 0))
        total = known.agg(F.count(F.lit(1))).scalar()
        numbered = known.orderBy("concept").limit(count).withColumn(
            "no", F.row_number().over(Window.orderBy("concept")) - 1
        )
        slots = spark.range(count).select(F.col("id").alias("idx"), (F.col("id") + first_id).alias("number"))
        rows = slots.withColumn("no", F.pmod("idx", F.greatest(total, F.lit(1)))).join(F.broadcast(numbered), "no")
        concept = F.col("concept")
        if main == "fines" and len(entry["sources"]) == 1:
            concept = F.when(F.col("idx") == 0, FIRST_FINES_CONCEPT).otherwise(concept)
        expected = expected_behavior(entry["sources"], concept, F.col("idx") == 0, form)
        if len(entry["sources"]) > 1:
            concept = F.concat(concept, F.lit(MULTI_SUFFIX))
        parts.append(
            rows.select(
                "number",
                F.lit(category).alias("category"),
                F.lit(entry["about"]).alias("context"),
                F.lit(entry["kind"]).alias("kind"),
                F.array(*[F.lit(s) for s in entry["sources"]]).alias("expected_sources"),
                concept.alias("concept"),
                expected.alias("expected_behavior"),
            )
        )
        first_id += count
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    if questions is not None:
        out = out.join(questions.select("concept", F.col(text).alias("_written")), "concept", "left")
    else:
        out = out.withColumn("_written", F.lit(None).cast("string"))
    leaks = F.contains(F.lower("_written"), F.lower("concept"))
    fallback = fallback_question(F.col("concept"), F.col("context"), F.col("kind"))
    return out.select(
        F.format_string(f"{prefix.replace('%', '%%')}%0{digits}d", "number").alias("id"),
        F.when(F.col("_written").isNull() | leaks, fallback).otherwise(F.col("_written")).alias("question"),
        "category",
        "concept",
        F.when(F.col("number") % medium_every == 0, "medium").otherwise("easy").alias("difficulty"),
        "expected_sources",
        "expected_behavior",
    )


def sample_questions(pool: DataFrame, n: int, key: str = "question_id", seed: int = 0) -> DataFrame:
    """n rows in the order of a hash of key and seed: random, yet the same on every run."""
    return pool.orderBy(F.md5(F.concat(F.col(key).cast("string"), F.lit(f":{seed}"))), key).limit(n)
