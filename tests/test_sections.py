import datetime as dt

from docquill.operators import sections
from docquill.sources import files


def articles(spark, text):
    rows = spark.createDataFrame([(text,)], "text string")
    return [(r.chunk_id, r.article_id, r.article_title, r.text_content) for r in sections.section_articles(rows).collect()]


def policies(spark, text):
    rows = spark.createDataFrame([(text,)], "text string")
    return [(r.chunk_id, r.section_id, r.section_title) for r in sections.section_policies(rows).collect()]


def test_articles(spark):
    got = articles(spark, "Intro\n\n## Article 15\n### Right of access\nbody 15\n## Article 17\n\n  ### Erasure  \nbody")
    assert got == [
        ("GDPR-CH3-CHAPTER_III_PREAMBLE", "CHAPTER_III_PREAMBLE", "General Modalities Context", "Intro"),
        ("GDPR-CH3-ARTICLE-15", "Article-15", "Right of access", "## Article 15\n### Right of access\nbody 15"),
        ("GDPR-CH3-ARTICLE-17", "Article-17", "Erasure", "## Article 17\n\n  ### Erasure  \nbody"),
    ]


def test_article_edges(spark):
    assert articles(spark, "") == [] and articles(spark, " \n\t\n") == []
    assert [x[0] for x in articles(spark, "no header")] == ["GDPR-CH3-CHAPTER_III_PREAMBLE"]
    # On the first line a header is no split point but is still read as one.
    assert [x[1] for x in articles(spark, "## Article 1\nT\n## Article 2\nU")] == ["Article-1", "Article-2"]
    # Two spaces split, but the label is that of a preamble.
    assert [x[1] for x in articles(spark, "a\n##  Article 5\nT")] == ["CHAPTER_III_PREAMBLE"] * 2
    assert articles(spark, "\n## Article 9")[0][2] == "Statutory Rights"
    assert articles(spark, "\n## Article 9 (2)\n###  A ### B ")[0][1:3] == ("Article-9-(2)", "A  B")


def test_policies(spark):
    got = policies(spark, "Top\n## Section 1: Data\nx\n## Section 2: A: B\n## Section 3\ny")
    assert got == [
        ("RETAIL-POLICY-POLICY_PREAMBLE", "policy_preamble", "Global Policy Overview"),
        ("RETAIL-POLICY-SECTION_1", "section_1", "Data"),
        ("RETAIL-POLICY-SECTION_2", "section_2", "A"),
        ("RETAIL-POLICY-SECTION_3", "section_3", "Section 3"),
    ]


def test_flatten(spark):
    rows = spark.createDataFrame(
        [
            ("/v/a.pdf", '{"document":{"metadata":{"page_count":7},"elements":[{"page_number":1,"content":"x"},{"page_number":2,"content":"y"}]}}'),
            ("/v/b.pdf", '{"document":{"elements":[{"page_number":3,"content":"x"},{"page_number":2,"content":null}]}}'),
            ("/v/c.pdf", '{"document":{"metadata":{}}}'),
            ("/v/d.pdf", '{"document":{"elements":[]}}'),
        ],
        "path string, content string",
    )
    got = sorted(tuple(r) for r in sections.flatten_elements(rows).collect())
    assert got == [("a.pdf", 7, "x\n\ny"), ("b.pdf", 3, "x"), ("c.pdf", 1, ""), ("d.pdf", 1, "")]


def test_lineage(spark):
    rows = spark.createDataFrame([(None, "a"), ("a", None), ("a", "a")], "x string, y string")
    first = sections.add_lineage(rows, dt.datetime(2024, 1, 1)).collect()
    later = sections.add_lineage(rows, dt.datetime(2025, 1, 1)).collect()
    hashes = [r.record_hash for r in first]
    assert hashes[0] == hashes[1] != hashes[2]
    assert hashes == [r.record_hash for r in later]


def test_whole_files(spark, tmp_path):
    (tmp_path / "a.md").write_text("one\ntwo\n")
    (tmp_path / "b.txt").write_text("three")
    whole = {r.path.rsplit("/", 1)[1]: r.text for r in files.scan_whole_text(spark, str(tmp_path)).collect()}
    assert whole == {"a.md": "one\ntwo\n", "b.txt": "three"}
    assert files.scan_files(spark, str(tmp_path), pattern="*.md").count() == 1
    assert files.scan_files(spark, str(tmp_path), "text", "*.txt").count() == 1


def test_golden_set_file(spark, tmp_path):
    (tmp_path / "set.json").write_text(
        """{
  "metadata": {"version": "3.0", "total_cases": 2},
  "test_cases": [
    {"id": "c1", "question": "q1", "category": "a", "difficulty": "easy",
     "expected_behavior": {"sources": ["x"], "must_include_in_answer": ["y", "z"]}},
    {"id": "c2", "question": "q2", "category": "b", "difficulty": "easy",
     "expected_behavior": {"sources": [], "fines_check": {"must_retrieve_keywords": ["k"]}}}
  ]
}"""
    )
    rows = files.scan_golden_set(spark, str(tmp_path / "set.json")).orderBy("pos").collect()
    assert [r.id for r in rows] == ["c1", "c2"]
    assert rows[0].expected_behavior.must_include_in_answer == ["y", "z"]
    assert rows[1].expected_behavior.fines_check.must_retrieve_keywords == ["k"]
    assert files.scan_golden_set(spark, str(tmp_path / "set.json"), limit=1).count() == 1
