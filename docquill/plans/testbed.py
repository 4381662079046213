"""The library's tables derived from the given parquet tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import words
from ..operators.logs import build_log_rows
from ..session import work_path

AS_OF = dt.date(2024, 1, 30)
QUALITY_FIELDS = ["relevance", "accuracy", "completeness", "citation", "clarity", "overall"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def requests(events: DataFrame) -> DataFrame:
    """Raw requests from events: status, answer and message follow from the event."""
    k = F.get_json_object("props", "$.k").cast("int")
    kind = F.col("event_id") % 12
    rows = events.select(
        F.col("event_id"),
        F.col("ts").cast("timestamp").alias("timestamp"),
        F.col("event_id").cast("string").alias("request_id"),
        F.col("event_type"),
        k.alias("k"),
        F.concat(
            F.lit("how should we handle "),
            F.col("event_type"),
            F.lit(" records under article "),
            k.cast("string"),
            F.lit(" clause "),
            (F.col("user_id") % 10).cast("string"),
        ).alias("question"),
        F.round(F.col("value") * 100, 2).alias("latency_ms"),
        F.when(F.col("event_type") != "error", "success")
        .when(k % 4 != 0, "error")
        .when(k % 8 == 0, "exception")
        .otherwise("timeout")
        .alias("status"),
        kind.alias("kind"),
    )
    status, kind, k = F.col("status"), F.col("kind"), F.col("k").cast("string")
    answer = (
        F.when(status.isin("error", "exception"), None)
        .when(status == "timeout", "Error: upstream timed out")
        .when(kind == 0, "")
        .when(kind == 1, "   ")
        .when(kind == 2, "No.")
        .when(kind == 3, "Seven years.")
        .when(kind == 4, "There is not enough information in the records.")
        .when(kind == 5, "Could you clarify which records you mean?")
        .when(kind == 6, "That is outside my scope, sorry.")
        .when(kind == 7, "I am unable to retrieve live records.")
        .when(kind == 8, "This is about GDPR Article 17 and the right to erasure.")
        .otherwise(
            F.concat(
                F.lit("Article "),
                k,
                F.lit(" requires the controller to keep "),
                F.col("event_type"),
                F.lit(" records for seven years."),
            )
        )
    )
    context = F.when(
        status == "success",
        F.concat(
            F.lit("SOURCE legislation: Article "), k, F.lit(" covers "), F.col("event_type"), F.lit(" records.")
        ),
    )
    message = (
        F.when(status == "error", "HTTP 500")
        .when(status == "exception", "connection reset")
        .when(status == "timeout", "timed out")
    )
    return rows.select(
        "event_id",
        "timestamp",
        "request_id",
        "question",
        answer.alias("answer"),
        context.alias("context"),
        "latency_ms",
        "status",
        message.alias("error_message"),
    )


def log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_log_rows(requests(table(spark, sf_dir, "events")))


def articles(documents: DataFrame) -> DataFrame:
    """A markdown text per document: a preamble, then an article per line."""
    return _markdown(
        documents,
        lambda x, i: F.concat(
            F.lit("\n## Article "), (i + 1).cast("string"), F.lit("\n### Title "), F.col("lang"), F.lit("\n"), x
        ),
    )


def policies(documents: DataFrame) -> DataFrame:
    """A markdown text per document: a preamble, then a section per line."""
    return _markdown(
        documents,
        lambda x, i: F.concat(
            F.lit("\n## Section "), (i + 1).cast("string"), F.lit(": "), F.col("lang"), F.lit(" notes\n"), x
        ),
    )


def _markdown(documents: DataFrame, section) -> DataFrame:
    body = F.array_join(F.transform(F.split("text", "\n"), section), "")
    return documents.select(
        F.concat(F.lit("doc_"), F.col("doc_id").cast("string"), F.lit(".md")).alias("source_file_name"),
        F.concat(F.lit("Notes on "), F.col("source"), body).alias("text"),
    )


def parsed(documents: DataFrame) -> DataFrame:
    """A parsed document (JSON) per document: an element per line, ten to a page."""
    elements = F.transform(
        F.split("text", "\n"),
        lambda x, i: F.struct(
            (F.floor(i / 10) + 1).cast("int").alias("page_number"), F.lit("text").alias("type"), x.alias("content")
        ),
    )
    pages = F.when(F.col("lang") == "en", F.floor(F.length("text") / 3000).cast("int") + 1)
    doc = F.struct(F.struct(pages.alias("page_count")).alias("metadata"), elements.alias("elements"))
    return documents.select(
        F.concat(F.lit("/vol/doc_"), F.col("doc_id").cast("string"), F.lit(".pdf")).alias("path"),
        F.to_json(F.struct(doc.alias("document"))).alias("content"),
    )


def paragraphs(documents: DataFrame) -> DataFrame:
    """Documents with a blank line after each line that ends a sentence."""
    return documents.select("doc_id", F.replace("text", F.lit(".\n"), F.lit(".\n\n")).alias("text"))


def drop_vowels(texts: list[str]) -> list[str]:
    """A stand-in for a translator that shortens texts by an amount of their own."""
    return [t.translate(str.maketrans("", "", "aeiou")) for t in texts]


def snapshots(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Two states of the documents: labelled ones before, good or unlabelled ones after.

    Good documents labelled toxic have changed text, short good ones a time of their own.
    """
    docs = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels")
    joined = docs.join(labels, "doc_id", "left")
    # Seen at a microsecond of its own; a good document of few characters was seen one microsecond later the second time.
    seen = F.timestamp_micros(F.lit(1_700_000_000_000_000) + F.col("doc_id") * 1000 + 123)
    old = joined.filter("quality IS NOT NULL").select(*docs.columns, seen.alias("seen"))
    kept = joined.filter("quality IS NULL OR quality = 1")
    later = (F.col("quality") == 1) & (F.col("n_chars") < 1000)
    again = F.timestamp_micros(F.unix_micros(seen) + F.when(later, 1).otherwise(0)).alias("seen")
    changed = F.when(F.col("toxic") == 1, F.concat("text", F.lit(" (revised)"))).otherwise(F.col("text"))
    return old, kept.withColumn("text", changed).select(*docs.columns, again)


def queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Questions with a vector: each benchmark text and the embedding of the same number."""
    items = table(spark, sf_dir, "benchmark")
    vectors = table(spark, sf_dir, "embeddings")
    return items.join(vectors, F.col("item_id") == F.col("vec_id")).select(
        F.col("item_id").alias("query_id"), F.col("text").alias("question"), "embedding"
    )


def passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, from three sources, with the embeddings going round."""
    docs = table(spark, sf_dir, "documents")
    vectors = table(spark, sf_dir, "embeddings")
    known = F.lit(vectors.count())
    source = F.element_at(
        F.array(F.lit("policy"), F.lit("legislation"), F.lit("fines")), (F.col("label") % 3 + 1).cast("int")
    )
    rows = docs.join(vectors, F.pmod("doc_id", known) == F.col("vec_id")).select(
        F.col("doc_id").alias("chunk_id"), F.col("lang").alias("label"), "text", "embedding", source.alias("source")
    )
    # Indexes and searches read them many times; the join moves every text once, when they are written.
    path = work_path(spark, "passages")
    rows.write.partitionBy("source").parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def indexes(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    rows = passages(spark, sf_dir)
    return {
        s: rows.filter(F.col("source") == s).select("chunk_id", "label", "text", "embedding")
        for s in ("policy", "legislation", "fines")
    }


OPENINGS = [
    "What fines have companies received? ",
    "What does Article 17 say? ",
    "How long do we retain customer data? ",
    "Right to be forgotten requirements and penalties: ",
    "",
]


def routed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The questions with an opening sentence per kind; the last kind fits no source."""
    opening = F.element_at(F.array(*[F.lit(x) for x in OPENINGS]), (F.col("query_id") % 5 + 1).cast("int"))
    text = F.concat(opening, F.col("question"))
    return queries(spark, sf_dir).withColumns({"question": text, "original_question": text})


ASKING = "How should we handle it? "
DOUBT, CLAIM, AGAIN = "The context does not specify ", "Unrelated words only: zebra quartz violin number ", "Still zebra quartz violin number "


def asked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The questions, every third of those that fit a source asking for a way to act."""
    n = F.col("query_id")
    text = F.when((n % 3 == 0) & (n % 5 != 4), F.concat(F.lit(ASKING), F.col("question"))).otherwise(F.col("question"))
    return routed(spark, sf_dir).withColumns({"question": text, "original_question": text})


def _first_words(n: int):
    return F.array_join(F.slice(F.split("retrieved_context", " "), 1, n), " ")


def write_answer(rows: DataFrame) -> DataFrame:
    """A stand-in for a model: quotes the context, doubts it, or claims what isn't there."""
    kind, name = F.col("query_id") % 4, F.col("query_id").cast("string")
    answer = F.when(kind == 1, F.concat(F.lit(DOUBT), F.col("original_question"))).when(kind >= 2, F.concat(F.lit(CLAIM), name))
    return rows.withColumn("generated_answer", answer.otherwise(_first_words(40)))


def write_strictly(rows: DataFrame) -> DataFrame:
    """A stand-in for a stricter model, which still claims too much for some."""
    kind, name = F.col("query_id") % 4, F.col("query_id").cast("string")
    return rows.withColumn("generated_answer", F.when(kind == 3, F.concat(F.lit(AGAIN), name)).otherwise(_first_words(30)))


def states(events: DataFrame) -> DataFrame:
    """Rows of question-answering state with counters that follow from the event."""
    n = F.col("event_id")
    return requests(events).select(
        F.col("request_id"),
        F.col("question").alias("original_question"),
        F.col("answer").alias("generated_answer"),
        F.col("context").alias("retrieved_context"),
        (n % 4).cast("int").alias("retrieval_loop_count"),
        (F.floor(n / 4) % 4).cast("int").alias("generation_loop_count"),
        (F.floor(n / 16) % 2 == 1).alias("expanded_search_used"),
    )


def cases(documents: DataFrame) -> DataFrame:
    """A test case per document: its source, and words 1, 20 and 60 of its text."""

    def word(*places: int):
        return F.array_compact(F.array(*[F.get("words", F.lit(n - 1)) for n in places]))

    expected = F.struct(
        F.array("source").alias("sources"),
        word(1, 20).alias("must_retrieve_from_articles"),
        word(60).alias("must_include_in_answer"),
    )
    return documents.withColumn("words", words(F.col("text"))).select(
        F.concat(F.lit("case_"), F.col("doc_id").cast("string")).alias("id"),
        F.concat(F.lit("What does "), F.col("source"), F.lit(" say?")).alias("question"),
        F.col("lang").alias("category"),
        expected.alias("expected_behavior"),
    )


def responses(spark: SparkSession, sf_dir: str, ahead: int = 1) -> DataFrame:
    """Answers to the cases: the text of a later document.

    The context names the source for documents in two of the languages. Documents without a later one have no answer.
    """
    docs = table(spark, sf_dir, "documents")
    later = docs.select((F.col("doc_id") - ahead).alias("doc_id"), F.col("text").alias("answer"))
    asked = docs.select("doc_id", "lang", "source")
    named = F.when(F.col("lang").isin("en", "de"), F.concat("source", F.lit(" "), "lang")).otherwise(F.col("lang"))
    return asked.join(later, "doc_id").select(
        F.concat(F.lit("case_"), F.col("doc_id").cast("string")).alias("id"), "answer", named.alias("context")
    )


def replies(events: DataFrame) -> DataFrame:
    """A judge's reply per event: some lack a score, some are not JSON."""
    n = F.col("event_id")
    score = (n % 5 + 1).cast("string")
    fields = ["relevance", "accuracy", "completeness", "citation", "clarity", "overall"]
    parts = [F.concat(F.lit(f'"{f}": '), score, F.lit(", ")) for f in fields if f != "clarity"]
    clarity = F.when(n % 9 == 0, "").otherwise(F.concat(F.lit('"clarity": '), score, F.lit(", ")))
    text = F.concat(F.lit("{"), *parts, clarity, F.lit('"explanation": "ok"}'))
    return events.select(
        n.cast("string").alias("request_id"), F.when(n % 13 == 0, "no JSON").otherwise(text).alias("reply")
    )


def golden_files(spark: SparkSession, sf_dir: str, path: str) -> None:
    """Golden-set files: per document one set with a case per line."""
    docs = table(spark, sf_dir, "documents")
    case = F.transform(
        F.split("text", "\n"),
        lambda x, i: F.struct(
            F.concat(F.lit("case_"), F.col("doc_id").cast("string"), F.lit("_"), i.cast("string")).alias("id"),
            x.alias("question"),
            F.col("lang").alias("category"),
            F.when(i % 2 == 0, "medium").otherwise("easy").alias("difficulty"),
            F.struct(F.array("source").alias("sources")).alias("expected_behavior"),
        ),
    )
    docs.select(case.alias("test_cases")).write.json(path)
