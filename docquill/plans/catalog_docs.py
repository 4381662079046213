"""Queries over documents: sources, sections, chunks, model columns, tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ..functions.text import lines
from ..operators import changes, chunks, inference, sections, snapshots
from ..session import work_path
from ..sources import files, tables
from . import testbed
from .testbed import table

NOON = dt.datetime(2024, 1, 30, 12, tzinfo=dt.timezone.utc)
DOC = ["doc_id"]


def _docs(s, d):
    return table(s, d, "documents")


def _text_files(s, d) -> str:
    path = work_path(s, "texts")
    _docs(s, d).select("text").write.option("maxRecordsPerFile", 100).text(path)
    return path


def _scan_whole_text(s, d):
    whole = files.scan_whole_text(s, _text_files(s, d))
    return (
        whole.select(F.explode(F.split("text", "\n")).alias("line"))
        .filter("line <> ''")
        .groupBy("line")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def _scan_files(s, d):
    found = files.scan_files(s, _text_files(s, d), "binaryFile", "*.txt")
    return found.agg(F.sum("length").alias("bytes"), F.sum(F.length("content")).alias("content_bytes"))


def _scan_table(s, d):
    orders = tables.scan_table(s, f"{d}/orders.parquet")
    return orders.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"))


def _list_sections(s, d):
    rows = sections.section_articles(testbed.articles(_docs(s, d)), keep=("source_file_name",))
    return sections.list_sections(rows, "chunk_id", ["source_file_name", "article_title"], "text_content")


def _lineage(s, d):
    return sections.add_lineage(_docs(s, d), NOON).select("doc_id", "ingestion_timestamp", "record_hash")


def _sentence_chunks(s, d):
    return chunks.sentence_chunks(_docs(s, d), "text", DOC)


def _paragraph_chunks(s, d):
    return chunks.paragraph_chunks(testbed.paragraphs(_docs(s, d)), "text", DOC, 100)


def _file_chunks(s, d):
    flat = sections.flatten_elements(testbed.parsed(_docs(s, d)))
    return chunks.sentence_chunks(flat, "full_document_text", ["source_file_name", "source_page_count"])


def _translated(s, d):
    return inference.apply_model(_file_chunks(s, d), "chunk_text", "translated_text", testbed.drop_vowels)


def _apply_model(s, d):
    return inference.apply_model(_sentence_chunks(s, d), "chunk_text", "translated_text", testbed.drop_vowels).drop(
        "chunk_text"
    )


def _reassembled(s, d):
    return chunks.reassemble(
        _translated(s, d),
        ["source_file_name", "source_page_count"],
        "chunk_index",
        {"translated_text": "full_document_text_translated", "chunk_text": "full_document_text_original"},
    )


def _join_documents(s, d):
    raw = sections.flatten_elements(testbed.parsed(_docs(s, d)))
    final = _reassembled(s, d).select("source_file_name", "full_document_text_translated")
    return chunks.join_documents(raw, final).select(
        "source_file_name",
        "source_page_count",
        F.md5("full_document_text").alias("raw_md5"),
        F.md5("full_document_text_translated").alias("translated_md5"),
    )


def _document_quality(s, d):
    rows = chunks.document_quality(
        _reassembled(s, d), "full_document_text_original", "full_document_text_translated"
    )
    return rows.select(
        "source_file_name", F.round("translation_ratio", 6).alias("translation_ratio"), "target_language", "low_quality"
    )


def _chunk_quality(s, d):
    return chunks.chunk_quality(_translated(s, d)).select(
        "source_file_name", "chunk_index", "original_len", "translated_len", F.round("ratio", 6).alias("ratio"), "band"
    )


def _quality_overview(s, d):
    rows = chunks.quality_overview(chunks.chunk_quality(_translated(s, d)))
    return rows.withColumns({c: F.round(c, 6) for c in ("min_ratio", "avg_ratio", "max_ratio")})


def _preview(s, d):
    return sections.preview_sample(
        _translated(s, d), ["source_file_name", "chunk_index"], {"original": "chunk_text", "translated": "translated_text"}
    )


def _first_children(s, d):
    rows = sections.first_children(_paragraph_chunks(s, d))
    return rows.select("doc_id", "chunk_tokens", F.md5("chunk_text").alias("text_md5"))


def _hash_embed(s, d):
    rows = inference.embed_documents(_docs(s, d), "text", "text", use_translated=False, kind="double")
    norm = F.sqrt(F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x * x))
    values = F.array_join(F.transform("embedding", lambda x: F.round(x * 1_000_000).cast("long").cast("string")), ",")
    return rows.select(
        "doc_id",
        "text_length",
        "embedding_model",
        "is_translated",
        F.size("embedding").alias("dim"),
        F.round(norm, 5).alias("norm"),
        F.md5(values.cast("binary")).alias("values_md5"),
    )


def _render_prompt(s, d):
    return testbed.requests(table(s, d, "events")).select(
        "request_id", F.md5(inference.judge_prompt()).alias("prompt_md5")
    )


def _resume(s, d):
    return chunks.resume_batch(_docs(s, d), table(s, d, "labels"), "doc_id", 50).select("doc_id", "lang", "n_chars")


def _progress(s, d):
    return chunks.batch_progress(_docs(s, d), table(s, d, "labels"), "doc_id", 50)


def _hashed(s, d):
    old, new = testbed.snapshots(s, d)
    return tuple(sections.add_lineage(x, NOON, ["doc_id", "text", "lang", "source", "n_chars"]) for x in (old, new))


def _told(feed):
    return feed.select("doc_id", "record_hash", "lang", "n_chars", F.unix_micros("seen").alias("seen"), "_change_type")


def _change_feed(s, d):
    old, new = _hashed(s, d)
    return _told(changes.change_feed(old, new, "doc_id"))


def _range_changes(s, d):
    """The feed of two written snapshots, by the ranges in which their digest trees differ."""
    old, new = _hashed(s, d)
    paths = [work_path(s, name) for name in ("snapshot-old", "snapshot-new")]
    for rows, path in zip((old, new), paths, strict=True):
        snapshots.write_snapshot(rows, path, "doc_id")
    return _told(snapshots.snapshot_changes(s, *paths, "doc_id", new.schema))


def _clustered(s, d):
    """A table ordered by two columns at once, as it is read back."""
    path = work_path(s, "clustered")
    tables.cluster_table(_docs(s, d), ["doc_id", "n_chars"], 16).write.parquet(path)
    return s.read.parquet(path).select("doc_id", F.md5(F.col("text").cast("binary")).alias("text_md5"), "lang", "source", "n_chars")


def _skipping(s, d):
    """Per column of the order: whether a filter on one value in the middle leaves out at least half the files."""
    path = work_path(s, "clustered")
    tables.cluster_table(_docs(s, d).select("doc_id", "n_chars"), ["doc_id", "n_chars"], 16).write.parquet(path)
    rows = s.read.parquet(path)
    parts = []
    for column in ("doc_id", "n_chars"):
        middle = rows.agg(F.percentile(column, 0.5)).first()[0]
        spans = rows.groupBy(F.input_file_name()).agg(F.min(column).alias("lo"), F.max(column).alias("hi"))
        touched = F.count_if((F.col("lo") <= middle) & (F.col("hi") >= middle))
        parts.append(spans.agg(F.lit(column).alias("column_name"), (2 * touched <= F.count(F.lit(1))).alias("skips")))
    return parts[0].unionByName(parts[1])


def _index_sync(s, d):
    old, new = _hashed(s, d)
    synced = changes.index_sync(old, new, "doc_id", ["lang", "source", "n_chars", "seen"])
    return synced.withColumn("seen", F.unix_micros("seen"))


def _index_status(s, d):
    old, new = _hashed(s, d)
    return changes.index_status(old, new, "doc_id", "documents")


def _write_table(s, d):
    path = work_path(s, "log")
    tables.write_table(testbed.log(s, d), path, partition_by=["date"])
    back = tables.scan_table(s, path)
    return back.groupBy("date", "status").agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("question")).alias("chars"))


def _append_rows(s, d):
    from ..operators.logs import LOG_SCHEMA

    path = work_path(s, "log")
    log = testbed.log(s, d)
    tables.append_rows(log.filter("status = 'success'"), path, LOG_SCHEMA)
    tables.append_rows(log.filter("status <> 'success'"), path, LOG_SCHEMA)
    back = tables.scan_table(s, path)
    return back.groupBy("status", "response_classification").agg(F.count(F.lit(1)).alias("n"))


def _compact(s, d):
    path = work_path(s, "compact")
    tables.write_table(tables.compact_table(_docs(s, d), ["source", "lang"], 8), path)
    return tables.scan_table(s, path).select("doc_id", F.md5("text").alias("text_md5"), "lang", "source", "n_chars")


def _catalog_info(s, d):
    names = [f"{d}/{n}.parquet" for n in ("events", "documents", "orders", "no_such_table")]
    info = tables.catalog_info(s, names)
    return info.select(
        F.regexp_extract("table_name", r"([a-z_]+)\.parquet$", 1).alias("table_name"), "table_exists", "row_count"
    )


def _query_sql(s, d):
    table(s, d, "events").createOrReplaceTempView("docquill_events")
    return tables.query_sql(
        s,
        "SELECT event_type, count(*) AS n FROM docquill_events WHERE value > :low GROUP BY event_type",
        low=10.0,
    )


def _columns(s, d):
    docs = table(s, d, "documents")
    tables.validate_columns(docs, ["doc_id", "text", "lang"])
    return docs.select("doc_id", "lang", F.length("text").alias("chars"))


QUERIES = {
    "validate_columns": _columns,
    "scan_whole_text": _scan_whole_text,
    "scan_files": _scan_files,
    "scan_table": _scan_table,
    "query_sql": _query_sql,
    "catalog_info": _catalog_info,
    "section_articles": lambda s, d: sections.section_articles(
        testbed.articles(_docs(s, d)), keep=("source_file_name",)
    ),
    "section_policies": lambda s, d: sections.section_policies(
        testbed.policies(_docs(s, d)), keep=("source_file_name",)
    ),
    "list_sections": _list_sections,
    "flatten_elements": lambda s, d: sections.flatten_elements(testbed.parsed(_docs(s, d))),
    "add_lineage": _lineage,
    "chunk_sentences": _sentence_chunks,
    "chunk_paragraphs": _paragraph_chunks,
    "explode_chunks": lambda s, d: chunks.explode_chunks(_docs(s, d), lines(F.col("text")), DOC),
    "chunk_key": lambda s, d: chunks.chunk_key(_file_chunks(s, d)).select("chunk_id", F.length("chunk_text").alias("n")),
    "apply_model": _apply_model,
    "hash_embed": _hash_embed,
    "reassemble": lambda s, d: _reassembled(s, d),
    "join_documents": _join_documents,
    "translation_quality": _document_quality,
    "chunk_quality": _chunk_quality,
    "quality_overview": _quality_overview,
    "preview_sample": _preview,
    "first_children": _first_children,
    "render_prompt": _render_prompt,
    "resume_batch": _resume,
    "batch_progress": _progress,
    "change_feed": _change_feed,
    "index_sync": _index_sync,
    "range_changes": _range_changes,
    "cluster_table": _clustered,
    "cluster_skipping": _skipping,
    "index_status": _index_status,
    "write_table": _write_table,
    "append_rows": _append_rows,
    "compact_table": _compact,
}
