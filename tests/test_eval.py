import datetime as dt

import pytest

from docquill.operators import evaluation as ev
from docquill.operators import quality

EXPECTED = (
    "id string, question string, category string, expected_behavior struct<sources array<string>, "
    "must_retrieve_from_articles array<string>, must_include_in_answer array<string>>"
)


def score(spark, cases, responses, context="string"):
    rows = spark.createDataFrame([(i, "q", c, e) for i, c, e in cases], EXPECTED)
    given = spark.createDataFrame(responses, f"id string, answer string, context {context}")
    return ev.score_cases(rows, given)


def test_scores(spark):
    cases = [
        ("1", "a", (["Law"], ["Article 5"], ["free", "Copy"])),
        ("2", "a", (["law"], ["x", "x"], ["y"])),
        ("3", "b", ([], None, [])),
        ("4", "b", (["law"], ["x"], None)),
        ("5", "b", None),
    ]
    responses = [("1", "It is FREE, see article 5", "the law"), ("2", "y", "nothing"), ("3", "a", "b")]
    got = {r.case_id: r for r in score(spark, cases, responses).collect()}
    assert (got["1"].source_correct, got["1"].passed) == (1.0, True)
    assert got["1"].content_match == pytest.approx(2 / 3)
    assert got["1"].feedback == "PASS: Retrieved from expected sources: ['Law'] | FAIL: Missing 1 items: {'Copy'}"
    assert got["2"].content_match == pytest.approx(1 / 3) and not got["2"].passed
    assert got["2"].feedback == "FAIL: Expected sources ['law'] not found | FAIL: Missing 1 items: {'x'}"
    assert (got["3"].score, got["3"].feedback) == (1.0, "")
    assert (got["4"].score, got["4"].passed) == (0.0, False)
    assert got["5"].score == 1.0


def test_list_context(spark):
    got = score(spark, [("1", "a", (["law"], ["z w"], []))], [("1", None, ["the LAW z", "w"])], "array<string>").first()
    assert got.score == 1.0


def results(spark, rows):
    return spark.createDataFrame(
        rows,
        "case_id string, category string, passed boolean, score double, source_correct double, content_match double, feedback string",
    )


RUN = [("c1", "a", True, 1.0, 1.0, 1.0, "fine"), ("c2", "a", False, 0.25, 0.0, 0.5, "bad"), ("c3", "b", True, 0.75, 1.0, 0.5, "")]


def test_metrics(spark):
    run = results(spark, RUN)
    m = ev.eval_metrics(run).first()
    assert (m.total_cases, m.passed, m.failed) == (3, 2, 1) and m.avg_score == pytest.approx(2 / 3)
    parts = {r.category: r for r in ev.category_breakdown(run).collect()}
    assert (parts["a"].pass_total, parts["a"].avg_score, parts["a"].std_dev) == ("1/2", 0.625, 0.53)
    assert parts["b"].std_dev is None
    assert [r.case_id for r in ev.failed_cases(run).collect()] == ["c2"]
    assert not ev.gate(run).first().gate_passed and ev.gate(run, 0.6).first().gate_passed


def test_no_results(spark):
    none = results(spark, [])
    assert ev.eval_metrics(none).first().total_cases == 0
    assert not ev.gate(none).first().gate_passed
    delta = {r.metric: r.delta for r in ev.compare_runs(results(spark, RUN), none).collect()}
    assert delta["avg_score"] is None and delta["total_cases"] == -3.0


def test_report(spark):
    lines = [r.line for r in ev.eval_report(results(spark, RUN), dt.datetime(2024, 1, 1)).collect()]
    assert lines[0] == lines[-1] == "=" * 80
    at = lines.index("CATEGORY BREAKDOWN")
    assert lines[at + 2 : at + 9] == [
        "a: 1/2 passed (avg score: 0.625)",
        "b: 1/1 passed (avg score: 0.750)",
        "",
        "-" * 80,
        "FAILED CASES (1)",
        "-" * 80,
        "• c2 | Score: 0.25 | a",
    ]
    clean = [r.line for r in ev.eval_report(results(spark, RUN[:1]), dt.datetime(2024, 1, 1)).collect()]
    assert not any(x.startswith("FAILED") for x in clean)


def test_written_run(spark, tmp_path):
    paths = ev.write_run(results(spark, RUN), str(tmp_path / "run"), single_file=True)
    back = spark.read.option("header", True).csv(paths["results"])
    assert back.count() == 3 and set(back.columns) == {*results(spark, RUN).columns}
    assert [r.case_id for r in spark.read.option("header", True).csv(paths["failed"]).collect()] == ["c2"]
    lines = [r.value for r in spark.read.text(paths["report"]).collect()]
    assert lines[1] == "Evaluation Report" and lines[-1] == "=" * 80


def test_validate(spark):
    rows = spark.createDataFrame([("1", "q", None), (None, "q", "c")], "id string, question string, category string")
    got = {r.id: r.missing_fields for r in ev.validate_cases(rows).collect()}
    assert got == {"1": ["category", "expected_behavior"], None: ["id", "expected_behavior"]}


MIX = [
    {"category": "law", "number": 3, "about": "statutes", "sources": ["legislation"], "kind": "single"},
    {"category": "cases", "number": 2, "about": "decisions", "sources": ["fines"], "kind": "single"},
    {"category": "both", "number": 1, "about": "x", "sources": ["fines", "legislation"], "kind": "multi"},
]


def test_many_cases_have_ids_of_their_own(spark):
    tables = {"legislation": spark.createDataFrame([("A",)], "concept string")}
    mix = [{"category": "law", "number": 1200, "about": "x", "sources": ["legislation"], "kind": "single"}]
    ids = {r.id for r in ev.build_cases(mix, tables).collect()}
    assert len(ids) == 1200 and {"case_001", "case_100", "case_1000"} <= ids


def test_build_cases(spark):
    def concepts(*names):
        return spark.createDataFrame([(n,) for n in names], "concept string")

    written = spark.createDataFrame(
        [("Erasure", "How does erasure work?"), ("Access", "Who may see what?")], "concept string, question string"
    )
    tables = {"legislation": concepts("Erasure", "Access"), "fines": concepts()}
    got = sorted(tuple(r) for r in ev.build_cases(MIX, tables, questions=written).collect())
    assert [g[0] for g in got] == [f"case_00{i}" for i in range(1, 7)]
    assert [g[3] for g in got] == [
        "Access", "Erasure", "Access", "largest GDPR fines", "Google", "Access compliance alignment",
    ]
    assert got[0][1] == "Who may see what?"
    assert got[1][1] == ev.FALLBACK_POLICY  # the written question quotes its concept
    assert got[5][1] == ev.FALLBACK_MULTI
    assert [g[4] for g in got] == ["easy", "medium"] * 3


def test_profiles(spark):
    rows = spark.createDataFrame([("Google and METAL",), (None,), ("",)], "t string")
    assert {r.concept for r in ev.profile_mentions(rows, "t", ["google", "meta", "uber", "british airways"]).collect()} == {
        "Google", "Meta",
    }
    assert [r.concept for r in ev.profile_titles(rows, "t").collect()] == ["Google and METAL"]


def test_sample_is_repeatable(spark):
    pool = spark.range(100).withColumnRenamed("id", "question_id")
    one = [r.question_id for r in ev.sample_questions(pool, 5).collect()]
    assert one == [r.question_id for r in ev.sample_questions(pool.repartition(7), 5).collect()]
    assert one != [r.question_id for r in ev.sample_questions(pool, 5, seed=1).collect()]


def test_judge_replies(spark):
    good = '{"relevance": 5, "accuracy": 4.5, "completeness": 3, "citation": 2, "clarity": 1, "overall": 4, "explanation": "ok"}'
    rows = spark.createDataFrame([(0, good), (1, "{"), (2, '{"overall": 3}'), (3, None)], "i int, reply string")
    got = {r.i: r for r in quality.validate_scores(rows).collect()}
    assert (got[0].accuracy, got[0].overall, got[0].explanation) == (4.5, 4.0, "ok")
    assert got[1].overall == 0.0 and got[1].explanation == "Error: JSON parsing error"
    assert got[2].explanation.startswith("Error: Missing required fields: relevance, accuracy")
    assert got[3].explanation == "Error: JSON parsing error"
