"""From raw documents to token ids, stage by stage.

Every stage but the last returns the columns of its input, whatever further ones it has, and any rows that it keeps
unchanged. Null and empty texts have no language and go in the first stage; what the operators say on other odd cases holds.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docquill.llm import bpe, decontamination, exact, language, similar
from docquill.llm.common import held_out
from docquill.session import work_path

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


#: Bytes of an Arrow batch: a batch of many long texts would else take much of an executor.
BATCH_BYTES = 8 << 20


def _bounded(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def _apart(docs: DataFrame) -> DataFrame:
    """All columns but the text in one, so that none of theirs clashes with an operator's, and the text."""
    rest = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "text"])
    return docs.select(F.struct(rest.alias("own"), F.col("text").isNull().alias("none")).alias("_row"), F.col("text").alias("_read"))


def _together(rows: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of docs from `_row` and `_text`."""
    text = F.when(~F.col("_row.none"), F.col("_text")).alias("text")
    return rows.select(*[text if c == "text" else F.col("_row.own")[c].alias(c) for c in docs.columns])


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language of the collection; those too far from all of them go."""
    _bounded(spark)
    model = language.fit(docs.where(~held_out()))
    return _together(language.identify(_apart(docs), model, text="_read", keep=["_row"], with_text=True).where("not rejected"), docs)


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts: the longest, then that with the smallest id."""
    return exact.keep_first(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that similarity links: that with the smallest id."""
    _bounded(spark)
    return similar.keep_one(docs)


def clean_of_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of the benchmark."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    _bounded(spark)
    found = decontamination.find_overlaps(_apart(docs), benchmark, text="_read", keep=["_row"], with_text=True)
    return _together(found.where(F.size("spans") == 0), docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every text, and the text that they decode to."""
    _bounded(spark)
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    own = ["doc_id", "lang", "source"]
    coded = bpe.encode(docs.select(*own, "text"), path, public_tokenizers.PATTERN, keep=own)
    back = bpe.decode(coded, path, keep=[*own, "ids"])
    return back.select(*own, F.size("ids").cast("long").alias("n_tokens"), "ids", bpe.decode_text("decoded").alias("text"))


STAGES: list[tuple[str, Stage]] = [
    ("language", known_language),
    ("exact_copies", exact_copies),
    ("near_copies", near_copies),
    ("decontamination", clean_of_benchmark),
    ("byte_bpe", tokens),
]

#: The stages learn models and search whole texts, which SQL can't express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; what a stage returns is written, then read by the next one."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = work_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
