"""DuckDB SQL for the queries over documents."""

from __future__ import annotations

from .oracle_log import sql_str, with_log, with_raw
from .oracle_values import JUDGE_TEMPLATE

NL = "chr(10)"


def stripped(x: str) -> str:
    return f"regexp_replace({x}, '^\\s+|\\s+$', '', 'g')"


def clean_lines(x: str) -> str:
    each = stripped("x")
    return f"list_filter(list_transform(string_split({x}, {NL}), lambda x: {each}), lambda x: x <> '')"


def _sections(word: str, head: str, label: str, title: str, prefix: str, pre: tuple[str, str], consts: str, cols: tuple[str, str]) -> str:
    return f"""WITH md AS (
  SELECT 'doc_' || doc_id || '.md' AS source_file_name,
    'Notes on ' || source || array_to_string(list_transform(string_split(text, {NL}), lambda x, i: {head}), '') AS text
  FROM documents),
segs AS (
  SELECT source_file_name,
    unnest(string_split(regexp_replace(text, '(\\n##\\s+{word}\\s+\\d+)', chr(1) || '\\1', 'g'), chr(1))) AS seg FROM md),
parts AS (SELECT *, {clean_lines("seg")} AS ls FROM segs),
labelled AS (
  SELECT *, starts_with(ls[1], '## {word}') AS is_section, {stripped("replace(ls[1], '##', '')")} AS raw
  FROM parts WHERE len(ls) > 0),
named AS (
  SELECT *, CASE WHEN is_section THEN {label} ELSE '{pre[0]}' END AS sid,
    CASE WHEN is_section THEN {title} ELSE '{pre[1]}' END AS title FROM labelled)
SELECT source_file_name, '{prefix}' || upper(sid) AS chunk_id, sid AS {cols[0]}, title AS {cols[1]},
  {stripped("seg")} AS text_content, {consts} FROM named"""


SECOND_LINE = "replace(ls[2], '###', '')"
AFTER_COLON = "string_split(raw, ':')[2]"
ARTICLES = _sections(
    "Article",
    f"{NL} || '## Article ' || i || {NL} || '### Title ' || lang || {NL} || x",
    "replace(raw, ' ', '-')",
    f"coalesce({stripped(SECOND_LINE)}, 'Statutory Rights')",
    "GDPR-CH3-",
    ("CHAPTER_III_PREAMBLE", "General Modalities Context"),
    "'EU GDPR Official 2016/679' AS legislation_source, 'Chapter 3 - Rights of the Data Subject' AS scope_boundary",
    ("article_id", "article_title"),
)
POLICIES = _sections(
    "Section",
    f"{NL} || '## Section ' || i || ': ' || lang || ' notes' || {NL} || x",
    "lower(replace(string_split(raw, ':')[1], ' ', '_'))",
    f"coalesce({stripped(AFTER_COLON)}, raw)",
    "RETAIL-POLICY-",
    ("policy_preamble", "Global Policy Overview"),
    "'Global Retail E-Commerce Corp' AS corporate_owner, 'Internal Data Processing Matrix' AS document_type",
    ("section_id", "section_title"),
)

FLAT = f"""flat AS (
  SELECT doc_id, 'doc_' || doc_id || '.pdf' AS source_file_name,
    CASE WHEN lang = 'en' THEN length(text) // 3000 + 1
         ELSE (len(string_split(text, {NL})) - 1) // 10 + 1 END AS source_page_count,
    replace(text, {NL}, {NL} || {NL}) AS full_document_text FROM documents)"""


def chunked(source: str, text: str, keys: str) -> str:
    """CTEs that end in `chunked`: greedy packing of sentences as a fold over a list."""
    return f"""sents AS (
  SELECT {keys}, list_transform(
    string_split(regexp_replace({text}, '([.!?])\\s+', '\\1' || chr(1), 'g'), chr(1)),
    lambda x: {{'done': CAST([] AS VARCHAR[]), 'cur': x}}) AS xs FROM {source}),
folded AS (
  SELECT {keys}, list_reduce(xs, lambda s, x: CASE
    WHEN length(s.cur) + length(x.cur) + 1 > 3000 AND s.cur <> ''
      THEN {{'done': list_append(s.done, {stripped("s.cur")}), 'cur': x.cur}}
    WHEN s.cur = '' THEN {{'done': s.done, 'cur': x.cur}}
    ELSE {{'done': s.done, 'cur': s.cur || ' ' || x.cur}} END) AS r FROM sents),
arrays AS (
  SELECT {keys}, CASE WHEN r.cur <> '' THEN list_append(r.done, {stripped("r.cur")}) ELSE r.done END AS cs
  FROM folded),
chunked AS (
  SELECT {keys}, unnest(cs) AS chunk_text, unnest(range(1, len(cs) + 1)) AS chunk_index FROM arrays)"""


FILE_KEYS = "source_file_name, source_page_count"
FILE_CHUNKS = f"{FLAT},\n{chunked('flat', 'full_document_text', FILE_KEYS)}"
VOWELS = "regexp_replace(chunk_text, '[aeiou]', '', 'g')"
TRANSLATED = f"{FILE_CHUNKS},\ntranslated AS (SELECT *, {VOWELS} AS translated_text FROM chunked)"
JOINED = f"""{TRANSLATED},
docs AS (
  SELECT {FILE_KEYS},
    string_agg(translated_text, {NL} || {NL} ORDER BY chunk_index) AS full_document_text_translated,
    string_agg(chunk_text, {NL} || {NL} ORDER BY chunk_index) AS full_document_text_original
  FROM translated GROUP BY ALL)"""
CHUNK_Q = f"""{TRANSLATED},
cq AS (
  SELECT source_file_name, chunk_index, length(chunk_text) AS original_len, length(translated_text) AS translated_len,
    CAST(length(translated_text) AS DOUBLE) / length(chunk_text) AS ratio,
    CASE WHEN ratio < 0.5 THEN 'truncated' WHEN ratio < 0.7 THEN 'suspicious' ELSE 'ok' END AS band
  FROM translated)"""

_est = "CAST(floor(len(list_filter(regexp_split_to_array({0}, '\\s+'), lambda w: w <> '')) * 1.25) AS INTEGER)"


def est(x: str) -> str:
    return _est.format(x)


def paragraph_chunks(budget: int) -> str:
    """CTEs that end in `pchunks`: the same packing, one piece at a time."""
    piece = (
        "{{'done': CAST([] AS STRUCT(b VARCHAR, n INTEGER)[]), 'cur': CAST([] AS VARCHAR[]), 'n': 0, "
        "'txt': {0}, 't': {1}, 'is_line': {2}, 'first': {3}}}"
    )
    line_piece = piece.format("x", est("x"), "true", "i = 1")
    para_piece = piece.format("p", est("p"), "false", "false")
    start = piece.format("''", "0", "false", "false")

    def state(done: str, cur: str, n: str) -> str:
        return f"{{'done': {done}, 'cur': {cur}, 'n': {n}, 'txt': '', 't': 0, 'is_line': false, 'first': false}}"

    emit2 = f"list_append(s.done, {{'b': array_to_string(s.cur, {NL} || {NL}), 'n': s.n}})"
    emit1 = f"list_append(s.done, {{'b': array_to_string(s.cur, {NL}), 'n': s.n}})"
    return f"""ptexts AS (SELECT doc_id, replace(text, '.' || {NL}, '.' || {NL} || {NL}) AS text FROM documents),
pieces AS (
  SELECT doc_id, text, flatten(list_transform(
    list_filter(list_transform(regexp_split_to_array(text, '\\n\\n+'), lambda p: {stripped("p")}), lambda p: p <> ''),
    lambda p: CASE WHEN {est("p")} > {budget}
      THEN list_transform({clean_lines("p")}, lambda x, i: {line_piece})
      ELSE [{para_piece}] END)) AS ps FROM ptexts),
pfold AS (
  SELECT doc_id, text, list_reduce(list_prepend({start}, ps), lambda s, x: CASE
    WHEN x.first AND len(s.cur) > 0 THEN {state(emit2, "[x.txt]", "x.t")}
    WHEN s.n + x.t <= {budget} THEN {state("s.done", "list_append(s.cur, x.txt)", "s.n + x.t")}
    WHEN len(s.cur) = 0 THEN {state("s.done", "[x.txt]", "x.t")}
    WHEN x.is_line THEN {state(emit1, "[x.txt]", "x.t")}
    ELSE {state(emit2, "[x.txt]", "x.t")} END) AS r FROM pieces),
parrays AS (
  SELECT doc_id, CASE
    WHEN text = '' THEN []
    WHEN {est("text")} <= {budget} THEN [{{'b': text, 'n': {est("text")}}}]
    WHEN len(r.cur) > 0 THEN list_append(r.done, {{'b': array_to_string(r.cur, {NL} || {NL}), 'n': r.n}})
    ELSE r.done END AS cs FROM pfold),
pun AS (SELECT doc_id, unnest(cs) AS c, unnest(range(0, len(cs))) AS chunk_index FROM parrays),
pchunks AS (SELECT doc_id, chunk_index, c.b AS chunk_text, c.n AS chunk_tokens FROM pun)"""


SNAP = """snap AS (SELECT d.*, l.quality, l.toxic FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id),
old0 AS (SELECT doc_id, text, lang, source, n_chars, 1700000000000123 + doc_id * 1000 AS seen
  FROM snap WHERE quality IS NOT NULL),
new0 AS (
  SELECT doc_id, CASE WHEN toxic = 1 THEN text || ' (revised)' ELSE text END AS text, lang, source, n_chars,
    1700000000000123 + doc_id * 1000 + CASE WHEN quality = 1 AND n_chars < 1000 THEN 1 ELSE 0 END AS seen
  FROM snap WHERE quality IS NULL OR quality = 1),
olds AS (SELECT *, sha256(concat_ws('||', doc_id, text, lang, source, n_chars)) AS record_hash FROM old0),
news AS (SELECT *, sha256(concat_ws('||', doc_id, text, lang, source, n_chars)) AS record_hash FROM new0)"""

_prompt = JUDGE_TEMPLATE
for _name, _value in {
    "question": "question",
    "answer": "coalesce(answer, '')",
    "context": "CASE WHEN coalesce(context, '') = '' THEN 'Not provided' ELSE context END",
}.items():
    _prompt = _prompt.replace("{" + _name + "}", f"\x00{_value}\x00")
PROMPT = " || ".join(
    sql_str(p) if i % 2 == 0 else f"({p})" for i, p in enumerate(_prompt.split("\x00")) if p
)

SQL: dict[str, str] = {
    "validate_columns": "SELECT doc_id, lang, length(text) AS chars FROM documents",
    "scan_whole_text": f"""SELECT line, count(*) AS n FROM (SELECT unnest(string_split(text, {NL})) AS line FROM documents)
  WHERE line <> '' GROUP BY line""",
    "scan_files": """SELECT CAST(sum(strlen(text) + 1) AS BIGINT) AS bytes,
  CAST(sum(strlen(text) + 1) AS BIGINT) AS content_bytes FROM documents""",
    "scan_table": "SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY o_orderstatus",
    "query_sql": "SELECT event_type, count(*) AS n FROM events WHERE value > 10 GROUP BY event_type",
    "catalog_info": """SELECT 'events' AS table_name, true AS table_exists, count(*) AS row_count FROM events
  UNION ALL SELECT 'documents', true, count(*) FROM documents
  UNION ALL SELECT 'orders', true, count(*) FROM orders UNION ALL SELECT 'no_such_table', false, NULL""",
    "section_articles": ARTICLES,
    "section_policies": POLICIES,
    "list_sections": f"""SELECT chunk_id, source_file_name, article_title, substr(text_content, 1, 200) AS preview,
  length(text_content) AS text_length FROM ({ARTICLES})""",
    "flatten_elements": f"WITH {FLAT} SELECT source_file_name, source_page_count, full_document_text FROM flat",
    "add_lineage": """SELECT doc_id, TIMESTAMP '2024-01-30 12:00:00' AS ingestion_timestamp,
  sha256(concat_ws('||', doc_id, text, lang, source, n_chars)) AS record_hash FROM documents""",
    "chunk_sentences": f"WITH {chunked('documents', 'text', 'doc_id')} SELECT * FROM chunked",
    "chunk_paragraphs": f"WITH {paragraph_chunks(100)} SELECT * FROM pchunks",
    "explode_chunks": f"""WITH a AS (SELECT doc_id, {clean_lines("text")} AS ls FROM documents)
  SELECT doc_id, unnest(ls) AS chunk_text, unnest(range(0, len(ls))) AS chunk_index FROM a""",
    "chunk_key": f"""WITH {FILE_CHUNKS}
  SELECT source_file_name || '_' || chunk_index AS chunk_id, length(chunk_text) AS n FROM chunked""",
    "apply_model": f"""WITH {chunked('documents', 'text', 'doc_id')}
  SELECT doc_id, chunk_index, {VOWELS} AS translated_text FROM chunked""",
    "hash_embed": """WITH toks AS (
  SELECT doc_id, unnest(list_filter(regexp_split_to_array(lower(text), '[^\\p{L}\\p{N}]+'), lambda w: w <> '')) AS t FROM documents),
counts AS (
  SELECT doc_id, CAST('0x' || substr(md5(t), 1, 8) AS BIGINT) % 256 AS place, count(*) AS n FROM toks GROUP BY ALL),
norms AS (SELECT doc_id, sqrt(sum(n * n)) AS norm FROM counts GROUP BY doc_id),
cells AS (
  SELECT d.doc_id, p.place, coalesce(CAST(round(n / norm * 1000000) AS BIGINT), 0) AS x
  FROM documents d CROSS JOIN range(256) p(place) LEFT JOIN norms USING (doc_id)
  LEFT JOIN counts c ON c.doc_id = d.doc_id AND c.place = p.place),
joined AS (SELECT doc_id, md5(string_agg(x, ',' ORDER BY place)) AS values_md5 FROM cells GROUP BY doc_id)
SELECT doc_id, length(text) AS text_length, 'hashed-tokens' AS embedding_model, false AS is_translated, 256 AS dim,
  CAST(CASE WHEN norm IS NULL THEN 0 ELSE 1 END AS DOUBLE) AS norm, values_md5
FROM documents JOIN joined USING (doc_id) LEFT JOIN norms USING (doc_id)""",
    "reassemble": f"WITH {JOINED} SELECT * FROM docs",
    "join_documents": f"""WITH {JOINED}
  SELECT f.source_file_name, f.source_page_count, md5(full_document_text) AS raw_md5,
    md5(full_document_text_translated) AS translated_md5
  FROM flat f JOIN docs d ON f.source_file_name = d.source_file_name""",
    "translation_quality": f"""WITH {JOINED}
  SELECT source_file_name, round(r, 6) AS translation_ratio, 'English' AS target_language,
    coalesce(r < 0.6, false) AS low_quality
  FROM (SELECT *, CAST(length(full_document_text_translated) AS DOUBLE)
    / nullif(length(full_document_text_original), 0) AS r FROM docs)""",
    "chunk_quality": f"""WITH {CHUNK_Q}
  SELECT source_file_name, chunk_index, original_len, translated_len, round(ratio, 6) AS ratio, band FROM cq""",
    "quality_overview": f"""WITH {CHUNK_Q}
  SELECT count(*) AS total_chunks, round(min(ratio), 6) AS min_ratio, round(avg(ratio), 6) AS avg_ratio,
    round(max(ratio), 6) AS max_ratio, count(*) FILTER (band = 'truncated') AS truncated_chunks,
    count(*) FILTER (band = 'suspicious') AS suspicious_chunks FROM cq""",
    "preview_sample": f"""WITH {TRANSLATED}
  SELECT source_file_name, chunk_index, substr(chunk_text, 1, 150) AS original_preview,
    length(chunk_text) AS original_length, substr(translated_text, 1, 150) AS translated_preview,
    length(translated_text) AS translated_length FROM translated""",
    "first_children": f"""WITH {paragraph_chunks(100)}
  SELECT doc_id, chunk_tokens, md5(chunk_text) AS text_md5 FROM pchunks WHERE chunk_index = 0""",
    "render_prompt": with_raw(f"SELECT request_id, md5({PROMPT}) AS prompt_md5 FROM raw"),
    "resume_batch": """SELECT doc_id, lang, n_chars FROM documents
  WHERE doc_id NOT IN (SELECT doc_id FROM labels) ORDER BY doc_id LIMIT 50""",
    "batch_progress": """WITH c AS (
  SELECT count(*) AS total, count(*) FILTER (doc_id IN (SELECT doc_id FROM labels)) AS done FROM documents)
  SELECT total, done, total - done AS remaining, CAST(ceil((total - done) / 50.0) AS BIGINT) AS batches_left FROM c""",
    "change_feed": f"""WITH {SNAP}, j AS (
  SELECT o.doc_id AS od, n.doc_id AS nd, o.record_hash AS oh, n.record_hash AS nh, o.lang AS ol, n.lang AS nl,
    o.n_chars AS oc, n.n_chars AS nc, o.seen AS os, n.seen AS ns FROM olds o FULL OUTER JOIN news n ON o.doc_id = n.doc_id)
  SELECT od AS doc_id, oh AS record_hash, ol AS lang, oc AS n_chars, os AS seen,
    CASE WHEN nd IS NULL THEN 'delete' ELSE 'update_preimage' END AS _change_type
  FROM j WHERE od IS NOT NULL AND (nd IS NULL OR oh <> nh OR os <> ns)
  UNION ALL
  SELECT nd, nh, nl, nc, ns, CASE WHEN od IS NULL THEN 'insert' ELSE 'update_postimage' END
  FROM j WHERE nd IS NOT NULL AND (od IS NULL OR oh <> nh OR os <> ns)""",
    "cluster_skipping": "SELECT * FROM (VALUES ('doc_id', true), ('n_chars', true)) AS t(column_name, skips)",
    "index_sync": f"WITH {SNAP} SELECT doc_id, record_hash, lang, source, n_chars, seen FROM news",
    "index_status": f"""WITH {SNAP}, j AS (
  SELECT o.doc_id AS od, n.doc_id AS nd, o.record_hash AS oh, n.record_hash AS nh, o.seen AS os, n.seen AS ns
  FROM olds o FULL OUTER JOIN news n ON o.doc_id = n.doc_id)
  SELECT 'documents' AS index_name, count(nd) AS source_rows, count(od) AS indexed_rows,
    count(*) FILTER (od IS NULL) AS missing, count(*) FILTER (oh <> nh OR os <> ns) AS stale,
    count(*) FILTER (nd IS NULL) AS extra, false AS ready FROM j""",
    "write_table": with_log(
        "SELECT date, status, count(*) AS n, CAST(sum(length(question)) AS BIGINT) AS chars FROM log GROUP BY ALL"
    ),
    "append_rows": with_log("SELECT status, response_classification, count(*) AS n FROM log GROUP BY ALL"),
    "compact_table": "SELECT doc_id, md5(text) AS text_md5, lang, source, n_chars FROM documents",
}
SQL["range_changes"] = SQL["change_feed"]
SQL["cluster_table"] = SQL["compact_table"]
