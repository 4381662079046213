"""The registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, decontamination, dialogues, exact, language, lines, phrases, pii, secrets, similar, sql, suffixes, toxicity, warc
from ..session import work_path
from .common import held_out

Query = Callable[[SparkSession, str], DataFrame]


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every whole text, their digest, and the digest of what they decode to."""
    import public_tokenizers as files

    path = files.path("byte_bpe_multi_50k.tiktoken")
    coded = bpe.encode(_documents(spark, sf_dir), path, files.PATTERN, keep=["doc_id"])
    digests = coded.select(
        "doc_id",
        "ids",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
    )
    back = bpe.decode(digests, path, keep=["doc_id", "n_tokens", "ids_sha256"])
    return back.select("doc_id", "n_tokens", "ids_sha256", F.sha2("decoded", 256).alias("decoded_sha256"))


def _joined(spans: Column) -> Column:
    """kind:start:end of each span, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def _number(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def op1_capture_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's record, written to archives, found through their index by the pages' URLs and read back by range."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    folder = warc.write_archive(pages, work_path(spark, "archive"))
    index = warc.build_index(warc.scan_archive(spark, folder))
    found = warc.read_records(warc.look_up(index, warc.keys_of(pages)))
    return found.select(
        warc.page_of("id").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        F.col("type").alias("record_type"),
        warc.page_of("refers_to").alias("refers_to"),
    )


def op2_parity_sketch_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose 5-word shingle sets have a Jaccard similarity of 0.8 or more."""
    groups = similar.similar_groups(_documents(spark, sf_dir))
    return groups.select(F.col("id").alias("doc_id"), "n_shingles", "component_id")


def op3_deobfuscated_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of every whole text, plain and disguised."""
    base = F.filter("found", lambda s: ~s["added"])
    return pii.find_pii(_documents(spark, sf_dir), keep=["doc_id"]).select(
        "doc_id",
        *[_number(base, kind).alias(f"n_{kind}") for kind in pii.KINDS],
        F.sha2(_joined(base).cast("binary"), 256).alias("base_sha256"),
        _joined(F.col("found")).alias("spans"),
        *[_number(F.filter("found", lambda s: s["added"]), kind).alias(f"added_{kind}") for kind in pii.KINDS],
    )


def op4_perfect_hash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The row that stays for every document: a history of the earlier half of the ids, by which the later half is judged."""
    rows = exact.digests(_documents(spark, sf_dir))
    middle = rows.agg(F.percentile_approx("id", 0.5)).first()[0]
    decided = exact.decide_in_parts(rows, F.coalesce(F.col("id") <= middle, F.lit(False)))
    return decided.select(
        F.col("id").alias("doc_id"),
        "keep_id",
        F.col("copies").alias("group_size"),
        "kept",
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def op5_language_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every whole text, learned from four folds of five."""
    docs = _documents(spark, sf_dir)
    model = language.fit(docs.where(~held_out()))
    return language.identify(docs, model, keep=["doc_id", held_out().alias("held_out")])


def op6_subword_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every whole text, learned from four folds of five."""
    docs = _documents(spark, sf_dir)
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet").where(~held_out()))
    scored = toxicity.score(docs, model, keep=["doc_id", held_out().alias("held_out")])
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def op7_linear_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of every whole text inside 200-byte strings that start anywhere else too."""
    cut = suffixes.cut_repeats(_documents(spark, sf_dir))
    return cut.select(F.col("id").alias("doc_id"), "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op8_secret_ownership(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every whole text; wider candidates count where few owners have them."""
    found = secrets.scan(_documents(spark, sf_dir))
    return found.select(
        "doc_id",
        *[_number(F.col("base"), kind).alias(f"n_{kind}") for kind in secrets.BASE],
        F.sha2(_joined(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        _joined(F.array_sort(F.concat("base", "added"))).alias("spans"),
        "n_live",
        "n_example",
    )


def op9_fm_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every whole text inside windows of the benchmark, and the items found."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = decontamination.find_overlaps(_documents(spark, sf_dir), benchmark, keep=["doc_id"])
    n_hit = decontamination.words_hit("spans")
    return found.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


def damaged(turns: DataFrame) -> DataFrame:
    """The turns of op11's contract: dropped, emptied, without sentence ends, told twice or given to the user, by a checksum."""
    blank = F.lit(" ")
    name = F.concat(F.coalesce(F.col("conv_id").cast("string"), blank), F.lit(":"), F.coalesce(F.col("turn").cast("string"), blank))
    kind, role, text = F.crc32(name.cast("binary")) % 20, F.coalesce("role", blank), F.coalesce("text", blank)
    rows = turns.where(kind != 0).select(
        "conv_id",
        "turn",
        F.when(kind == 4, "user").otherwise(role).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        F.explode(F.array_repeat(F.lit(0), F.when(kind == 3, 2).otherwise(1))).alias("copy"),
    )
    return rows.drop("copy")


def op11_dialogue_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation's faults, cheapest edits and repaired text."""
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    found = dialogues.repair(damaged(turns)).alias("r")
    all_ids = turns.select("conv_id").distinct().alias("l")
    return all_ids.join(found, F.col("l.conv_id").eqNullSafe(F.col("r.conv")), "left").select(
        "l.conv_id",
        *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in dialogues.RESULT],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"),
    )


def op12_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole text without the lines that a document with a smaller id holds too."""
    kept = lines.drop_repeated_lines(_documents(spark, sf_dir))
    return kept.select(F.col("id").alias("doc_id"), "n_lines", "n_dropped", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


def op13_phrase_mining(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each language's first 2,000 phrases of two and three words, from exact counts over every whole text."""
    return phrases.collocations(_documents(spark, sf_dir))


QUERIES: dict[str, Query] = {
    "op1_capture_index": op1_capture_index,
    "op2_parity_sketch_join": op2_parity_sketch_join,
    "op3_deobfuscated_pii": op3_deobfuscated_pii,
    "op4_perfect_hash_dedup": op4_perfect_hash_dedup,
    "op5_language_centroids": op5_language_centroids,
    "op6_subword_toxicity": op6_subword_toxicity,
    "op7_linear_suffix_dedup": op7_linear_suffix_dedup,
    "op8_secret_ownership": op8_secret_ownership,
    "op9_fm_decontamination": op9_fm_decontamination,
    "op10_byte_bpe": op10_byte_bpe,
    "op11_dialogue_repair": op11_dialogue_repair,
    "op12_line_dedup": op12_line_dedup,
    "op13_phrase_mining": op13_phrase_mining,
}

#: DuckDB SQL of the queries that SQL can express.
SQL: dict[str, str] = sql.SQL
