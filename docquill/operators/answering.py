"""Questions answered in rounds: a table of states, moved on until every question has its answer.

A state is a row with the columns of `START` and the step that it stands before. A round does every step's work for the
rows that stand before it: retrieval, rewriting, generation, search in the other sources, stricter generation, fallback. Then the
next step of each row follows from its columns (`retrieval.next_step`). Rows are written after every round; finished ones are
set aside and only the rest goes on, so plans don't grow and a lost executor costs one round. Limits on retrievals and
generations bound the rounds, whatever the rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import work_path
from . import retrieval

Step = Callable[[DataFrame], DataFrame]

RETRIEVE, REWRITE, GENERATE = "retrieve", "rewrite_query", "generate_response"
EXPAND, STRICT, FALLBACK, END = "expand_all_sources", "regenerate_strict", "return_fallback", "end"
#: Retrieval and rewriting take five rounds at most, generation, expansion and generation three, verification three.
MOST_ROUNDS = 2 * retrieval.MAX_RETRIEVALS + retrieval.MAX_GENERATIONS + 4
#: Columns that the loop adds to the questions, with the values that they start from.
START = {
    "retrieved_context": "''",
    "sources_queried": "cast(array() as array<string>)",
    "retrieval_loop_count": "0",
    "generation_loop_count": "0",
    "expanded_search_used": "false",
    "generated_answer": "cast(null as string)",
    "path": "cast(array() as array<string>)",
    "step": f"'{RETRIEVE}'",
}


def after_generation(rows: DataFrame) -> Column:
    """The step after an answer: source check, then completeness, then verification."""
    verified = F.col("after_verification")
    complete = F.when(F.col("after_completeness") == EXPAND, EXPAND).otherwise(verified)
    return F.when(F.col("after_source_check") == EXPAND, EXPAND).otherwise(complete)


def _judged(rows: DataFrame) -> DataFrame:
    """The rows with the four routing decisions, for whatever step they have done."""
    rows = retrieval.source_coverage(retrieval.answer_completeness(rows))
    return retrieval.next_step(retrieval.groundedness(rows))


def _moved(rows: DataFrame) -> DataFrame:
    """The rows with the step that follows the one they have done."""
    columns = rows.columns
    judged = _judged(rows)
    done = F.col("step")
    following = (
        F.when(done == RETRIEVE, F.col("after_retrieval"))
        .when(done == REWRITE, RETRIEVE)
        .when(done == GENERATE, after_generation(judged))
        .when(done == EXPAND, GENERATE)
        .when(done == STRICT, F.col("after_verification"))
        .otherwise(END)
    )
    return judged.withColumns({"path": F.array_append("path", done), "step": following}).select(columns)


def answer_questions(
    questions: DataFrame,
    search: Step,
    expand: Step,
    generate: Step,
    regenerate: Step,
    original: str = "original_question",
    current: str = "question",
) -> DataFrame:
    """The questions with the columns of `START`: answers, contexts, counters and the path of steps that led there.

    search: routes and searches rows, sets retrieved_context and sources_queried and counts the retrieval.
    expand: searches the sources not queried so far. generate, regenerate: set generated_answer.
    Columns of the questions named like those of the loop are replaced.
    """
    spark = questions.sparkSession
    names = [c for c in questions.columns if c not in START]
    columns = [*names, *START]
    frontier = questions.select(*names).withColumns({c: F.expr(value) for c, value in START.items()}).select(columns)

    def counted(rows: DataFrame) -> DataFrame:
        return rows.withColumn("generation_loop_count", F.col("generation_loop_count") + 1)

    works: dict[str, Step] = {
        RETRIEVE: lambda rows: search(rows.drop("retrieved_context", "sources_queried")),
        REWRITE: lambda rows: rows.withColumn(current, retrieval.query_keywords(F.col(original))),
        GENERATE: lambda rows: counted(generate(rows)),
        EXPAND: expand,
        STRICT: lambda rows: counted(regenerate(rows)),
        FALLBACK: lambda rows: rows.withColumn("generated_answer", F.concat(F.lit(retrieval.WARNING), F.coalesce("generated_answer", F.lit("")))),
    }
    finished = None
    steps = {RETRIEVE}
    for _ in range(MOST_ROUNDS):
        parts = [works[step](frontier.where(F.col("step") == step)).select(columns) for step in works if step in steps]
        rows = parts[0]
        for part in parts[1:]:
            rows = rows.unionByName(part)
        # A round's rows in the shared folder, finished ones in a part of their own.
        path = work_path(spark, "answers")
        rows = _moved(rows).withColumn("done", (F.col("step") == END).cast("int"))
        rows.write.partitionBy("done").parquet(path)
        written = spark.read.schema(rows.schema).parquet(path)
        ended, frontier = written.where("done = 1").select(columns), written.where("done = 0").select(columns)
        finished = ended if finished is None else finished.unionByName(ended)
        # As many rows as there are steps.
        steps = {r.step for r in frontier.select("step").distinct().collect()}
        if not steps:
            return finished.drop("step")
    raise RuntimeError(f"questions left after {MOST_ROUNDS} rounds before {sorted(steps)}")
