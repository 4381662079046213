"""Documents to sections: markdown headers, parsed elements, lineage, listings."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import is_blank, lines, strip


@dataclass(frozen=True)
class Layout:
    """How the sections of a kind of document are found and labelled."""

    word: str
    id_column: str
    title_column: str
    chunk_prefix: str
    preamble_id: str
    preamble_title: str
    constants: tuple[tuple[str, str], ...]


# Labels of the two kinds of document.
ARTICLES = Layout(
    word="Article",
    id_column="article_id",
    title_column="article_title",
    chunk_prefix="GDPR-CH3-",
    preamble_id="CHAPTER_III_PREAMBLE",
    preamble_title="General Modalities Context",
    constants=(
        ("legislation_source", "EU GDPR Official 2016/679"),
        ("scope_boundary", "Chapter 3 - Rights of the Data Subject"),
    ),
)
POLICIES = Layout(
    word="Section",
    id_column="section_id",
    title_column="section_title",
    chunk_prefix="RETAIL-POLICY-",
    preamble_id="policy_preamble",
    preamble_title="Global Policy Overview",
    constants=(
        ("corporate_owner", "Global Retail E-Commerce Corp"),
        ("document_type", "Internal Data Processing Matrix"),
    ),
)
DEFAULT_ARTICLE_TITLE = "Statutory Rights"


def _article_labels(header: Column, section_lines: Column) -> tuple[Column, Column]:
    label = F.replace(strip(F.replace(header, F.lit("##"), F.lit(""))), F.lit(" "), F.lit("-"))
    second = strip(F.replace(F.get(section_lines, F.lit(1)), F.lit("###"), F.lit("")))
    return label, F.coalesce(second, F.lit(DEFAULT_ARTICLE_TITLE))


def _policy_labels(header: Column, section_lines: Column) -> tuple[Column, Column]:
    raw = strip(F.replace(header, F.lit("##"), F.lit("")))
    parts = F.split(raw, ":")
    label = F.lower(F.replace(parts[0], F.lit(" "), F.lit("_")))
    return label, F.coalesce(strip(F.get(parts, F.lit(1))), raw)


def _split_sections(df: DataFrame, text: str, keep: tuple[str, ...], layout: Layout, labels) -> DataFrame:
    """One row per non-blank section. Each document is split in its own row."""
    start = rf"(?U)(?=\n##\s+{layout.word}\s+\d+)"
    segments = df.select(*keep, F.posexplode(F.split(F.col(text), start)).alias("pos", "segment"))
    rows = segments.filter(~is_blank(F.col("segment"))).withColumn("lines", lines(F.col("segment")))
    header = F.get("lines", F.lit(0))
    is_section = F.startswith(header, F.lit(f"## {layout.word}"))
    label, title = labels(header, F.col("lines"))
    rows = rows.withColumns(
        {
            layout.id_column: F.when(is_section, label).otherwise(layout.preamble_id),
            layout.title_column: F.when(is_section, title).otherwise(layout.preamble_title),
        }
    )
    return rows.select(
        *keep,
        F.concat(F.lit(layout.chunk_prefix), F.upper(layout.id_column)).alias("chunk_id"),
        layout.id_column,
        layout.title_column,
        strip(F.col("segment")).alias("text_content"),
        *[F.lit(value).alias(name) for name, value in layout.constants],
    )


def section_articles(df: DataFrame, text: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """Markdown to its `## Article N` sections; the title is the line below the header."""
    return _split_sections(df, text, keep, ARTICLES, _article_labels)


def section_policies(df: DataFrame, text: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """Markdown to its `## Section N: Title` sections."""
    return _split_sections(df, text, keep, POLICIES, _policy_labels)


PARSED_SCHEMA = (
    "document struct<metadata: struct<page_count: int>, "
    "elements: array<struct<page_number: int, content: string>>>"
)


def flatten_elements(df: DataFrame, path: str = "path", content: str = "content") -> DataFrame:
    """Parsed documents (JSON) to file name, page count and the text of all elements."""
    doc = F.from_json(content, PARSED_SCHEMA)["document"]
    parsed = df.select(F.element_at(F.split(path, "/"), -1).alias("source_file_name"), doc.alias("doc"))
    elements = F.col("doc.elements")
    return parsed.select(
        "source_file_name",
        F.coalesce(
            F.col("doc.metadata.page_count"),
            F.array_max(F.transform(elements, lambda e: e["page_number"])),
            F.lit(1),
        ).alias("source_page_count"),
        F.concat_ws("\n\n", F.transform(elements, lambda e: e["content"])).alias("full_document_text"),
    )


def add_lineage(df: DataFrame, at: dt.datetime | None = None, columns: list[str] | None = None) -> DataFrame:
    """Add ingestion_timestamp and record_hash.

    The hash covers the given columns only, by default all. NULLs are left out of it, so rows
    that differ only in where a NULL stands share a hash.
    """
    now = F.current_timestamp() if at is None else F.lit(at)
    digest = F.sha2(F.concat_ws("||", *[F.col(c).cast("string") for c in columns or df.columns]), 256)
    return df.withColumns({"ingestion_timestamp": now, "record_hash": digest})


def list_sections(df: DataFrame, id_column: str, columns: list[str], text: str, chars: int = 200) -> DataFrame:
    """Sections in the order of their id, with the start of the text."""
    return df.select(
        id_column, *columns, F.substring(text, 1, chars).alias("preview"), F.length(text).alias("text_length")
    ).orderBy(id_column, *columns)


def preview_sample(df: DataFrame, order: list[str], texts: dict[str, str], chars: int = 150) -> DataFrame:
    """A listing in the given order with previews and lengths of text columns."""
    previews = []
    for name, column in texts.items():
        previews.append(F.substring(column, 1, chars).alias(f"{name}_preview"))
        previews.append(F.length(column).alias(f"{name}_length"))
    return df.select(*order, *previews).orderBy(*order)


def first_children(df: DataFrame, index: str = "chunk_index") -> DataFrame:
    """The first chunk of each document."""
    return df.filter(F.col(index) == 0)
