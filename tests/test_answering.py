from pyspark.sql import functions as F

from docquill.operators import answering, evaluation, mentions, retrieval


def test_every_branch_of_the_loop(spark):
    good = "word " * 50
    rows = spark.createDataFrame(
        [
            (0, "plain question", good),
            (1, "never finds policies anything", ""),
            (2, "how to handle it", good),
            (3, "incomplete", good),
            (4, "strict helps", good),
            (5, "nothing helps", good),
        ],
        "query_id long, original_question string, has string",
    ).withColumn("question", F.col("original_question"))
    answers = {3: "The context does not specify", 4: "zebra quartz", 5: "zebra quartz"}
    strict = {5: "violin"}
    told = F.create_map(*[F.lit(x) for kv in answers.items() for x in kv])
    again = F.create_map(*[F.lit(x) for kv in strict.items() for x in kv])

    def search(df):
        return df.withColumns({"retrieved_context": F.col("has"), "sources_queried": F.array(F.lit("policy")), "retrieval_loop_count": F.col("retrieval_loop_count") + 1})

    def expand(df):
        more = F.concat_ws(" ", "retrieved_context", F.lit("SOURCE: Enforcement zebra"))
        return df.withColumns({"retrieved_context": more, "expanded_search_used": F.lit(True), "retrieval_loop_count": F.col("retrieval_loop_count") + 1})

    def model(table):
        return lambda df: df.withColumn("generated_answer", F.coalesce(table[F.col("query_id").cast("int")], F.col("retrieved_context")))

    out = answering.answer_questions(rows, search, expand, model(told), model(again))
    got = {r.query_id: r for r in out.collect()}
    path = {i: ">".join(r.path) for i, r in got.items()}
    rewritten = "retrieve>rewrite_query>retrieve>rewrite_query>retrieve"
    assert path[0] == "retrieve>generate_response"
    assert path[1] == f"{rewritten}>generate_response" and got[1].question == "never finds policies anything"
    assert path[2] == "retrieve>generate_response>expand_all_sources>generate_response"
    assert path[3] == "retrieve>generate_response>expand_all_sources>generate_response>regenerate_strict>return_fallback"
    assert path[4] == "retrieve>generate_response>regenerate_strict"
    assert path[5] == "retrieve>generate_response>regenerate_strict>regenerate_strict>return_fallback"
    assert got[5].generated_answer == retrieval.WARNING + "violin" and got[4].generated_answer == good
    assert {i: r.generation_loop_count for i, r in got.items()} == {0: 1, 1: 1, 2: 2, 3: 3, 4: 2, 5: 3}
    assert got[1].retrieval_loop_count == 3 and got[2].expanded_search_used
    assert answering.answer_questions(rows.limit(0), search, expand, model(told), model(again)).count() == 0


def test_names_by_an_automaton_in_blocks(spark, monkeypatch):
    texts = ["The Acme Corporation paid", "acm e", None, "", "ürün und Zoë", "x" * 10_000 + "tail"]
    names = ["acme", "ACME corporation", "corp", "zoë", "missing", "", None, "xtail", "m"]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    listed = spark.createDataFrame([(n,) for n in names], "name string")
    want = {n.lower() for n in names if n and any(n.lower() in (t or "").lower() for t in texts)}
    assert {r.name for r in mentions.names_in(df, "text", listed).collect()} == want
    monkeypatch.setattr(mentions, "BLOCK_NAMES", 2)
    assert {r.name for r in mentions.names_in(df, "text", listed).collect()} == want
    assert mentions.names_in(df, "text", listed.limit(0)).count() == 0


def test_many_names(spark):
    listed = spark.range(100_000).select(F.concat(F.lit("name "), F.col("id").cast("string"), F.lit("!")).alias("name"))
    df = spark.createDataFrame([("a name 77! and NAME 99999! but not name 5",)] * 3, "text string")
    assert {r.concept for r in evaluation.profile_mentions(df, "text", listed).collect()} == {"Name 77!", "Name 99999!"}


def test_built_cases_have_no_violation_and_can_be_scored(spark):
    mix = [
        {"category": "a", "number": 3, "about": "law", "sources": ["legislation"], "kind": "single"},
        {"category": "b", "number": 3, "about": "fines", "sources": ["fines"], "kind": "single"},
        {"category": "c", "number": 2, "about": "policy", "sources": ["policy"], "kind": "single"},
        {"category": "d", "number": 2, "about": "both", "sources": ["fines", "legislation"], "kind": "multi"},
    ]
    concepts = {s: spark.createDataFrame([(f"{s} {i}",) for i in "AB"], "concept string") for s in ("legislation", "fines", "policy")}
    built = evaluation.build_cases(mix, concepts)
    assert evaluation.validate_cases(built).count() == 0
    got = {r.id: r.expected_behavior.asDict(True) for r in built.collect()}
    assert got["case_001"]["must_retrieve_from_articles"] == got["case_001"]["must_include_in_answer"] == ["legislation A"]
    assert got["case_004"]["must_retrieve_keywords"] == ["fine", "€", "company"]
    assert got["case_005"]["must_retrieve_keywords"] == ["fines b", "fine"] and got["case_005"]["must_include_in_answer"] == ["fines B", "fine"]
    assert got["case_007"]["must_retrieve_from_sections"] == ["policy A"] and got["case_007"]["must_include_in_answer"] == ["policy"]
    assert got["case_009"]["legislation_check"] == {"must_retrieve_from_articles": ["legislation A"]}
    assert got["case_009"]["fines_check"] == {"must_retrieve_keywords": ["fine", "breach"]}
    pool = {r.id: r.expected_behavior.asDict(True) for r in evaluation.build_cases(mix, concepts, form="pool").collect()}
    assert "must_include_in_answer" not in pool["case_001"] and pool["case_004"]["must_retrieve_keywords"] == ["largest gdpr fines", "fine"]
    assert pool["case_009"]["legislation_check"] == ["legislation A"] and pool["case_009"]["fines_check"] == ["fine", "breach"]
    answers = built.select("id", F.array_join("expected_behavior.must_include_in_answer", " ").alias("answer"), F.array_join("expected_sources", " ").alias("context"))
    assert evaluation.score_cases(built, answers).where("passed").count() == 10
