import re

from pyspark.sql import functions as F

from docquill.functions.classify import REFUSAL_PATTERNS, VAGUE_PATTERNS, classify_response
from docquill.operators import logs

TEXTS = [
    None, "", "   ", "\n\t", "\u00a0", "no\u00a0enough context here", "\x1c\x1f", "No.", "no", "MAYBE.", "I don't know", "not sure.", "Seven years.",
    "There is not enough information in the records.", "Could you clarify which records you mean?",
    "That is outside my scope, sorry.", "I am unable to retrieve live records.",
    "This is about GDPR Article 17 and the right to erasure.", "It doesn’t say anything in the context here.",
    "The context doesn't contain it.", "Based on the provided context, I cannot answer that at all.",
    "please be\nmore specific about that", "Article 17 grants the right to erasure to all data subjects.",
    "twenty characters ok", "nineteen characters", "  padded yes.  ", "yes.\n", "😀", "INSUFFICIENT DATA was given to me",
    "That is outside my \u017fcope and much more", "I cannot a\u017fsi\u017ft with that thing, really", "as\u212aing what",
    "The question is unclear and the context is incomplete", "beyond the scope of this long answer",
]


def expected(text):
    """The class by Python's re, one group after the other."""
    if text is None or not text.strip():
        return "empty", None, "Response is empty or whitespace"
    for name, patterns in REFUSAL_PATTERNS.items():
        hit = re.search("|".join(patterns), text, re.IGNORECASE)
        if hit:
            return "refusal", name, f"Contains {name.replace('_', ' ')} pattern: '{hit[0]}'"
    clean = text.strip()
    if len(clean) >= 20:
        return "answer", None, None
    if re.search("|".join(VAGUE_PATTERNS), text, re.IGNORECASE):
        return "vague", None, f"Too short and vague: '{clean}'"
    return "vague", None, f"Response too short ({len(clean)} chars)"


def test_same_as_python(spark):
    rows = spark.createDataFrame(list(enumerate(TEXTS)), "i int, answer string")
    got = {r.i: tuple(r)[2:] for r in classify_response(rows).collect()}
    for i, text in enumerate(TEXTS):
        assert got[i] == expected(text), text


def spell(pattern):
    """Ways to write out a pattern."""
    pattern = re.sub(r"\\s\+", " ", pattern)
    pattern = re.sub(r"\(\?:((?:(?!\(\?:)[^()])*)\)\?", "", pattern).replace(",?", "")
    group = re.search(r"\(\?:([^()]*)\)", pattern)
    if not group:
        return [pattern]
    return [
        full
        for choice in group[1].split("|")
        for full in spell(pattern[: group.start()] + choice + pattern[group.end() :])
    ]


def test_case_variants_of_every_pattern(spark):
    """Dotted and dotless i and the long s match in any case, as in Python."""
    texts = ["INSUFFİCİENT INFORMATİON was given", "there was insufficient ınformatıon", "please clarıfy what", "I am only desıgned for that"]
    for patterns in REFUSAL_PATTERNS.values():
        for pattern in patterns:
            for text in spell(pattern)[:3]:
                texts += [text, text.upper(), text.replace("i", "İ"), text.replace("i", "ı"), text.replace("s", "ſ")]
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, answer string")
    got = {r.i: tuple(r)[2:] for r in classify_response(rows).collect()}
    assert [got[i] for i in range(len(texts))] == [expected(t) for t in texts]


def test_flags(spark):
    rows = spark.createDataFrame(list(enumerate(TEXTS)), "i int, answer string")
    for r in logs.answer_flags(rows).collect():
        assert r.is_valid_answer == (expected(r.answer)[0] == "answer")
        assert r.is_refusal is not r.is_valid_answer


def test_stats_of_nothing_are_zero(spark):
    none = spark.createDataFrame([], "response_classification string, is_valid_answer boolean")
    assert set(logs.classification_stats(none).first()) == {0, 0.0}
    assert logs.log_stats(none).count() == 0


def test_log_rows(spark):
    rows = spark.createDataFrame(
        [
            ("1", "q", "", "success", None, 1.0),
            ("2", "q", "  ", "success", None, None),
            ("3", "q", "Error: There is not enough information", "error", "x" * 700, 2.0),
            ("4", "q", "Article 17 grants the right to erasure.", "success", None, 2.0),
            ("5", "q", None, "success", None, 2.0),
        ],
        "request_id string, question string, answer string, status string, error_message string, latency_ms double",
    ).withColumn("timestamp", F.timestamp_seconds(F.lit(1706659199)))
    got = {r.request_id: r for r in logs.build_log_rows(rows).collect()}
    assert [got[i].response_classification for i in "12345"] == [None, "empty", None, "answer", None]
    assert [got[i].is_valid_answer for i in "12345"] == [False, False, False, True, False]
    assert len(got["3"].error_message) == 700
    cut = logs.build_log_rows(rows, max_error=500).filter("request_id = '3'").first()
    assert len(cut.error_message) == 500
    assert got["2"].latency_ms == 0.0
    assert str(got["1"].date) == "2024-01-30"
    assert logs.build_log_rows(rows).columns == logs.LOG_SCHEMA.names


def test_normalise(spark):
    rows = spark.createDataFrame([(None, "ok", None), ("q", None, "boom")], "question string, answer string, error string")
    a, b = sorted(logs.normalise_requests(rows).collect(), key=lambda r: r.question)
    assert (a.question, a.status, a.answer, a.error_message) == ("", "success", "ok", None)
    assert (b.status, b.answer, b.error_message) == ("error", "Error: boom", "boom")
    assert a.request_id and a.request_id != b.request_id
