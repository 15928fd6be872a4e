"""DuckDB SQL for the registered queries of the ingestion and retrieval operators."""

from __future__ import annotations

_N = "coalesce({0}::VARCHAR, 'None')"
_SPACE = r"[\s\x1c-\x1f\x85\p{Z}]"


def _hash(*fields: str) -> str:
    return "sha256(" + " || '|' || ".join(_N.format(f) for f in fields) + ")"


def _blank(c: str, default: str) -> str:
    return f"coalesce(nullif({c}::VARCHAR, ''), '{default}')"


def _words(c: str) -> str:
    return f"list_filter(regexp_split_to_array({c}, '{_SPACE}+'), lambda w: w <> '')"


def _windows(words: str, target: int, overlap: int) -> str:
    return f"list_transform(range(0, len({words}), {target - overlap}), lambda i: list_slice({words}, i + 1, i + {target}))"


_CARD = " || chr(10) || ".join(
    f"'{label}' || {_blank(c, default)}"
    for label, c, default in (
        ("Case: ", "source", "Unknown"),
        ("Year: ", "n_chars", "None"),
        ("Category: ", "lang", "Unspecified"),
        ("Decision date: ", "quality", "Awaited/unknown"),
        ("Neutral citation: ", "toxic", "None"),
        ("Other citation: ", "''", "None"),
        ("Supreme Court status: ", "NULL", "Not appealed to the Supreme Court"),
        ("Summary/remarks: ", "text", "None recorded"),
    )
)
_LABELLED = "documents LEFT JOIN labels USING (doc_id)"
_HARD = f"""SELECT doc_id, unnest(range(len(ch)))::INTEGER AS chunk_index, unnest(ch) AS ws FROM (
  SELECT doc_id, {_windows("w", 380, 60)} AS ch FROM (SELECT doc_id, {_words("text")} AS w FROM documents))"""
_OUTCOME = """SELECT *, CASE WHEN row_number() OVER w = 1 THEN 'inserted' WHEN lag(event_type) OVER w IS NOT DISTINCT FROM event_type THEN 'unchanged' ELSE 'updated' END AS outcome
  FROM events WINDOW w AS (PARTITION BY user_id ORDER BY event_id)"""
_SNAPSHOT = f"""SELECT user_id, arg_max(event_type, event_id) FILTER (WHERE outcome <> 'unchanged') AS event_type,
    arg_max(value, event_id) FILTER (WHERE outcome <> 'unchanged') AS value, arg_max(props, event_id) FILTER (WHERE props IS NOT NULL) AS path,
    arg_min(ts, event_id) AS first_seen_at, arg_max(ts, event_id) AS last_seen_at, arg_max(ts, event_id) FILTER (WHERE outcome <> 'unchanged') AS updated_at
  FROM ({_OUTCOME}) GROUP BY user_id"""
_FILENAME = r"""(SELECT page_id, CASE WHEN lower(n) LIKE '%.pdf' THEN n ELSE n || '.pdf' END AS filename FROM (
  SELECT page_id, left(regexp_replace(coalesce(nullif(regexp_extract(regexp_replace(regexp_replace(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*', ''), '[?#].*$', ''), '[^/]*$'), ''), 'unnamed.pdf'), '[\\/:*?"<>|]', '_', 'g'), 200) AS n FROM pages))"""
_ANCHORS = """SELECT page_id, url, unnest(range(1, len(h) + 1))::INTEGER AS position, unnest(h) AS href FROM (
  SELECT page_id, url, regexp_extract_all(html, '<a href="([^"]*)">', 1) AS h FROM pages)"""
_FILES = """SELECT doc_id, CASE WHEN quality IS NOT NULL THEN source || '/' || doc_id || CASE WHEN toxic = 1 THEN '' ELSE '.pdf' END END AS path,
    CASE WHEN lang = 'es' THEN NULL WHEN quality = 1 THEN '%PDF-1.4' || chr(10) || text ELSE text END AS content,
    CASE WHEN lang = 'en' THEN 'known' END AS sha FROM documents LEFT JOIN labels USING (doc_id)"""
#: The magic within the first 1024 bytes, of a text that begins with it or has it nowhere.
_MAGIC = "coalesce(position('%PDF-' IN left(content, 1024)) > 0, false)"
_ACTION = f"""CASE WHEN nullif(path, '') IS NULL THEN NULL WHEN content IS NULL OR content = '' THEN 'CLEAR (missing/empty file)'
    WHEN NOT {_MAGIC} THEN 'DELETE + CLEAR (not real PDF content)' WHEN NOT lower(path) LIKE '%.pdf' THEN 'RENAME to add .pdf extension -> ' || path || '.pdf'
    WHEN nullif(sha, '') IS NULL THEN 'BACKFILL missing sha256 (file was fine, checksum wasn''t recorded)' END"""
_STATES = f"""docs AS (SELECT *, {_hash("lang", "quality")} AS meta FROM {_LABELLED}),
records AS (SELECT doc_id, sha256(text) AS text_sha, meta AS meta_sha FROM docs),
state AS (SELECT doc_id, CASE WHEN quality = 1 THEN sha256(text) END AS s_text, CASE WHEN toxic = 1 THEN 'old' ELSE meta END AS s_meta, true AS known FROM docs WHERE quality IS NOT NULL)"""


_INGESTED = f"""records AS (SELECT doc_id::VARCHAR AS id, quality, n_chars, {_hash("lang", "quality")} AS c, CASE WHEN lang <> 'es' THEN sha256(text) END AS j, CASE WHEN toxic = 1 THEN sha256(source) END AS s,
    CASE WHEN quality IS NOT NULL THEN CASE WHEN toxic = 1 THEN 'old' ELSE {_hash("lang", "quality")} END END AS known_c, quality IS NOT NULL AS known FROM {_LABELLED}),
asked AS (SELECT *, CASE WHEN quality = 1 THEN j END AS known_j, c IS DISTINCT FROM known_c AS new_c, j IS NOT NULL AND quality IS DISTINCT FROM 1 AS ask_j, s IS NOT NULL AS ask_s FROM records),
run AS (SELECT *, ask_j AND n_chars % 2 = 0 AS new_j, ask_s AND n_chars % 2 = 0 AS new_s FROM asked)"""


def _knn(on: str) -> str:
    return f"""
WITH q AS (SELECT vec_id AS question_id, embedding::DOUBLE[] AS v, label AS l FROM embeddings WHERE vec_id % 50 = 0),
s AS (SELECT question_id, vec_id, round(list_cosine_similarity(embedding::DOUBLE[], v), 4) AS score FROM embeddings JOIN q ON {on})
SELECT *, row_number() OVER (PARTITION BY question_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM s QUALIFY rank <= 5"""


_SHOWN = "CASE WHEN o_orderstatus = 'P' THEN 'no total' ELSE 'Showing 1 to 25 OF ' || format('{:,}', floor(o_totalprice)::BIGINT) || ' Entries of 7 entries' END"
_PACK = f"""
WITH RECURSIVE docs AS (SELECT row_number() OVER () AS r, doc_id, text FROM documents),
lines AS (SELECT r, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS k FROM docs),
paras AS (SELECT r, w, len(w) AS n, row_number() OVER (PARTITION BY r ORDER BY k) AS i FROM (SELECT r, k, {_words("line")} AS w FROM lines) WHERE len(w) > 0),
fold AS (
  SELECT r, 0::BIGINT AS i, []::VARCHAR[] AS cur, []::VARCHAR[][] AS done FROM docs
  UNION ALL
  SELECT f.r, p.i,
    CASE WHEN p.n > 380 THEN [] WHEN len(cur) + p.n > 380 THEN list_concat(list_slice(cur, greatest(len(cur) - 59, 1), len(cur)), p.w) ELSE list_concat(cur, p.w) END,
    CASE WHEN p.n > 380 THEN list_concat(CASE WHEN len(cur) > 0 THEN [cur] ELSE [] END, {_windows("p.w", 380, 60)}) WHEN len(cur) + p.n > 380 AND len(cur) > 0 THEN [cur] ELSE [] END
  FROM fold f JOIN paras p ON p.r = f.r AND p.i = f.i + 1),
ends AS (SELECT r, i, done FROM fold UNION ALL SELECT r, arg_max(i, i) + 1, CASE WHEN len(arg_max(cur, i)) > 0 THEN [arg_max(cur, i)] ELSE [] END FROM fold GROUP BY r),
chunks AS (SELECT r, i, unnest(range(len(done))) AS k, unnest(done) AS ws FROM ends)
SELECT doc_id, (row_number() OVER (PARTITION BY r ORDER BY i, k) - 1)::INTEGER AS chunk_index, len(ws)::INTEGER AS n_words, sha256(array_to_string(ws, ' ')) AS chunk_hash
FROM chunks JOIN docs USING (r)"""

_HUNDREDS = _PACK.replace("FROM documents)", "FROM (SELECT doc_id // 100 AS doc_id, string_agg(text, chr(10) ORDER BY doc_id) AS text FROM documents GROUP BY 1))", 1).replace("paras AS (", "paras AS MATERIALIZED (", 1)

ORACLE_SQL: dict[str, str] = {
    "content_hash": f"SELECT doc_id, {_hash('text', 'lang', 'source', 'n_chars', 'quality', 'toxic')} AS content_hash FROM {_LABELLED}",
    "metadata_card": f"SELECT doc_id, {_CARD} AS card, sha256({_CARD}) AS chunk_hash FROM {_LABELLED}",
    "chunk_uuid": """SELECT doc_id, substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-5' || substr(h, 14, 3) || '-' || substr('89ab89ab89ab89ab', ('0x' || substr(h, 17, 1))::INTEGER + 1, 1) || substr(h, 18, 3) || '-' || substr(h, 21, 12) AS chunk_uuid
FROM (SELECT doc_id, sha1(unhex('6ba7b8109dad11d180b400c04fd430c8') || encode(doc_id || '::metadata')) AS h FROM documents)""",
    "chunk_hard_split": f"SELECT doc_id, chunk_index, len(ws)::INTEGER AS n_words, sha256(array_to_string(ws, ' ')) AS chunk_hash FROM ({_HARD})",
    "chunk_pack": _PACK,
    "snippet": "SELECT doc_id, CASE WHEN length(text) > 280 THEN left(text, 280) || '...' ELSE text END AS snippet FROM documents",
    "context_block": """WITH h AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY n_chars DESC, doc_id) AS rank FROM documents QUALIFY rank <= 3)
SELECT lang, string_agg('[' || rank || '] Record ' || doc_id || ' (' || source || ')' || chr(10) || text, chr(10) || chr(10) || '---' || chr(10) || chr(10) ORDER BY rank) AS context FROM h GROUP BY lang""",
    "upsert_outcomes": f"SELECT event_id, user_id, outcome FROM ({_OUTCOME})",
    "upsert_snapshot": _SNAPSHOT,
    "stream_ingest": _SNAPSHOT,
    "sorted_store": "SELECT o_orderkey, year(o_orderdate)::INTEGER AS year, row_number() OVER (ORDER BY year(o_orderdate), o_orderkey) AS rank FROM orders",
    "incremental_diff": f"""WITH {_STATES}
SELECT doc_id, text_sha IS DISTINCT FROM s_text AS text_sha_changed, meta_sha IS DISTINCT FROM s_meta AS meta_sha_changed, known IS NULL AS is_new FROM records LEFT JOIN state USING (doc_id)""",
    "store_versions": """WITH e AS (SELECT *, least((day(ts) - 1) // 10, 2)::INTEGER AS b FROM events),
s AS (SELECT batch, user_id, max(event_id) AS event_id, arg_max(event_type, event_id) AS event_type, arg_max(value, event_id) AS value FROM e JOIN (VALUES (0), (1), (2)) AS v(batch) ON b <= batch GROUP BY batch, user_id)
SELECT user_id, event_id, event_type, value, batch FROM s WHERE event_type <> 'logout'""",
    "maintained_totals": """WITH s AS (SELECT user_id, arg_max(event_type, event_id) AS event_type, arg_max(value, event_id) AS value FROM events GROUP BY user_id)
SELECT event_type, count(*) AS n, sum(round(value * 100)::BIGINT)::BIGINT AS sum_cents FROM s WHERE event_type <> 'logout' GROUP BY event_type""",
    "json_array": r"""SELECT event_id, user_id, event_type, props || ' }],[{ "\" é' AS props FROM events""",
    "converted_texts": "SELECT page_id::VARCHAR AS record_id, NULL::VARCHAR AS error, sha256(concat_ws(chr(10) || chr(10), nullif(trim(url, ' '), ''), nullif(trim(html, ' '), ''))) AS text_sha, false AS again FROM pages",
    "merkle_diff": """WITH a AS (SELECT doc_id, CASE WHEN doc_id % 1000 < 10 THEN text || '!' ELSE text END AS t FROM documents WHERE doc_id % 1000 NOT BETWEEN 20 AND 24
  UNION ALL SELECT -doc_id, text FROM documents WHERE doc_id % 1000 BETWEEN 30 AND 34)
SELECT coalesce(d.doc_id, a.doc_id) AS doc_id, CASE WHEN d.doc_id IS NULL THEN 'added' WHEN a.doc_id IS NULL THEN 'removed' ELSE 'changed' END AS change
FROM documents d FULL JOIN a ON d.doc_id = a.doc_id WHERE d.doc_id IS NULL OR a.doc_id IS NULL OR d.text <> t""",
    "shrink_delete": f"""WITH coarse AS (SELECT doc_id, len(range(0, len(w), 700)) AS n FROM (SELECT doc_id, {_words("text")} AS w FROM documents))
SELECT doc_id AS record_id, chunk_index, sha256(array_to_string(ws, ' ')) AS chunk_hash FROM ({_HARD}) JOIN coarse USING (doc_id) WHERE chunk_index >= n""",
    "run_summary": f"""WITH d AS (SELECT day(ts) AS day, count(*) AS parsed, count(*) FILTER (WHERE outcome = 'inserted') AS inserted, count(*) FILTER (WHERE outcome = 'updated') AS updated,
  count(*) FILTER (WHERE outcome = 'unchanged') AS unchanged FROM ({_OUTCOME}) GROUP BY 1)
SELECT sum(parsed)::BIGINT AS parsed, sum(inserted)::BIGINT AS inserted, sum(updated)::BIGINT AS updated, sum(unchanged)::BIGINT AS unchanged, coalesce(string_agg(day::VARCHAR, ',' ORDER BY day) FILTER (WHERE inserted = 0), '') AS failed FROM d""",
    "daily_counters": """SELECT ts::DATE::VARCHAR AS day, count(*) AS parsed, count(*) FILTER (WHERE event_type = 'click') AS click, count(*) FILTER (WHERE event_type = 'purchase') AS purchase,
  count(*) FILTER (WHERE event_type = 'view') AS view FROM events GROUP BY 1""",
    "content_cache": "SELECT doc_id, sha256(text) AS sha256, min(doc_id) OVER (PARTITION BY sha256(text)) AS owner_id, doc_id <> min(doc_id) OVER (PARTITION BY sha256(text)) AS cached FROM documents",
    "page_concat": f"""WITH p AS (SELECT doc_id // 5 AS record, doc_id % 5 AS page, CASE WHEN coalesce(quality, 1) = 1 THEN nullif(trim(text, ' '), '') END AS own, nullif(trim(source, ' '), '') AS ocr FROM {_LABELLED})
SELECT record, sha256(coalesce(string_agg(coalesce(own, ocr), chr(10) || chr(10) ORDER BY page), '')) AS text_sha, bool_or(own IS NULL AND ocr IS NOT NULL) AS any_ocr FROM p GROUP BY record""",
    "last_record": "SELECT user_id, max(event_id) AS event_id, arg_max(event_type, event_id) AS event_type, arg_max(value, event_id) AS value FROM events GROUP BY user_id",
    "index_upsert": f"""WITH d AS (SELECT doc_id, coalesce(quality, 0) = 1 AS fresh, {_words("text")} AS w FROM {_LABELLED}),
c AS (SELECT doc_id, CASE WHEN fresh THEN {_windows("w", 760, 60)} ELSE {_windows("w", 380, 60)} END AS ch FROM d),
r AS (SELECT doc_id, unnest(range(len(ch))) AS k, unnest(ch) AS ws FROM c)
SELECT doc_id || '::judgment_pdf::' || k AS chunk_id, sha256(array_to_string(ws, ' ')) AS chunk_hash FROM r""",
    "vanished_chunks": f"SELECT doc_id || '::judgment_pdf::' || chunk_index AS chunk_id FROM ({_HARD}) JOIN documents USING (doc_id) WHERE lang = 'es'",
    "chunk_filter": f"SELECT doc_id::VARCHAR AS record_id, 'judgment_pdf' AS chunk_type, chunk_index FROM ({_HARD}) LEFT JOIN labels USING (doc_id) WHERE toxic IS DISTINCT FROM 1",
    "stale_texts": """SELECT o_orderkey::VARCHAR AS record_id, 'judgment_pdf' AS kind FROM orders LEFT JOIN (SELECT l_orderkey, max(l_shipdate) - INTERVAL 60 DAY AS made FROM lineitem WHERE l_linenumber = 1 GROUP BY 1) ON o_orderkey = l_orderkey
WHERE o_orderkey % 10 > 0 AND (made IS NULL OR made < o_orderdate)""",
    "published_links": f"""WITH f AS (SELECT sha256(text) AS sha256, min(doc_id::VARCHAR || '.pdf') AS name, min(doc_id::VARCHAR || '.pdf') FILTER (WHERE quality = 1) AS known FROM {_LABELLED} GROUP BY 1)
SELECT sha256, CASE WHEN known IS NULL THEN left(sha256, 32) ELSE 'known' END AS file_id, CASE WHEN known IS NULL THEN 'https://files.example/' || sha256 ELSE 'https://old.example/x' END AS view_url, coalesce(known, name) AS name FROM f""",
    "extract_pages": """SELECT doc_id::VARCHAR AS path, unnest(range(1, len(l) + 1))::INTEGER AS page, sha256(unnest(l)) AS text_sha, NULL::VARCHAR AS error FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents WHERE contains(text, '.'))
UNION ALL SELECT doc_id::VARCHAR, 0, NULL, 'ValueError: broken' FROM documents WHERE NOT contains(text, '.')""",
    "pending_documents": f"""WITH {_INGESTED}
SELECT id AS record_id, 'judgment_pdf' AS kind, j AS sha256 FROM run WHERE ask_j UNION ALL SELECT id, 'sc_judgment_pdf', s FROM run WHERE ask_s""",
    "ingest_state": f"""WITH {_INGESTED}
SELECT id, CASE WHEN new_c THEN c ELSE known_c END AS content_hash, CASE WHEN new_j THEN j ELSE known_j END AS judgment_pdf_sha256, CASE WHEN new_s THEN s END AS sc_judgment_pdf_sha256,
  CASE WHEN new_j THEN n_chars::INTEGER WHEN quality = 1 THEN 9 END AS judgment_chunk_count, CASE WHEN new_s THEN n_chars::INTEGER END AS sc_judgment_chunk_count FROM run""",
    "ingest_counters": f"""WITH {_INGESTED}
SELECT count(*) AS records_seen, count(*) FILTER (WHERE new_c) AS metadata_ingested, count(*) FILTER (WHERE new_j) AS judgment_pdf_ingested, count(*) FILTER (WHERE new_s) AS sc_judgment_pdf_ingested,
  count(*) FILTER (WHERE quality = 0) AS gdrive_uploaded, count(*) FILTER (WHERE NOT (new_c OR new_j OR new_s) AND n_chars % 7 <> 0) AS unchanged, count(*) FILTER (WHERE n_chars % 7 = 0) AS errors FROM run""",
    "tracked_counts": "SELECT 'documents' AS store, count(*) AS n FROM documents UNION ALL SELECT 'embeddings', count(*) FROM embeddings UNION ALL SELECT 'labels', count(*) FROM labels",
    "cited_sources": f"""SELECT question_id, rank AS citation, vec_id AS record_id, 'judgment_pdf' AS chunk_type, source AS source_url, score, CASE WHEN length(text) > 280 THEN left(text, 280) || '...' ELSE text END AS snippet
FROM ({_knn("true")}) JOIN documents ON vec_id = doc_id""",
    "l2_normalize": """WITH l AS (SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE * (label + 2)) AS v FROM embeddings),
u AS (SELECT vec_id, list_transform(v, lambda x: (x / sqrt(list_sum(list_transform(v, lambda y: y * y))))::FLOAT) AS u FROM l)
SELECT vec_id, round(sqrt(list_sum(list_transform(u, lambda x: x::DOUBLE * x::DOUBLE))), 5) AS norm, u[1] AS first FROM u""",
    "page_shortfall": "SELECT o_custkey AS year, count(*) + o_custkey % 3 AS hint, count(*) AS parsed FROM orders GROUP BY o_custkey HAVING o_custkey % 3 > 0",
    "totals_gap": """WITH s AS (SELECT year(o_orderdate) AS year, count(*) * 4 AS t FROM orders GROUP BY 1), p AS (SELECT year(l_shipdate) AS year, count(*) AS n FROM lineitem GROUP BY 1)
SELECT sum(t)::BIGINT AS site_total, sum(coalesce(n, 0))::BIGINT AS parsed, sum(t - coalesce(n, 0))::BIGINT AS gap FROM s LEFT JOIN p USING (year) WHERE year % 3 <> 0""",
    "cleared_counts": f"SELECT count(*) FILTER (WHERE {_ACTION} LIKE 'CLEAR%' OR {_ACTION} LIKE 'DELETE%') AS n_cleared, count({_ACTION}) AS n_actions FROM ({_FILES})",
    "knn_topk": _knn("true"),
    "knn_filtered": _knn("label = l"),
    "html_anchors": f"SELECT page_id, position, href FROM ({_ANCHORS})",
    "url_resolve": f"SELECT page_id, position, regexp_extract(url, '^([a-z]+://[^/?#]*)', 1) || href AS resolved FROM ({_ANCHORS})",
    "listing_table": f"""WITH r AS (SELECT *, 'a bold remark' AS remarks, 'https://listing.example.org/app//files/' || o_orderkey || '.pdf' AS u, strftime(o_orderdate, '%Y-%m-%d') AS d FROM orders)
SELECT 'REC_' || o_custkey || '_' || o_orderkey AS id, o_orderkey::INTEGER AS serial_no, o_orderpriority AS case_info, remarks, 'n/a' AS neutral_citation, NULL::VARCHAR AS other_citation, d AS decision_date,
  o_orderstatus AS sc_status, u AS judgment_pdf_url, NULL::VARCHAR AS sc_judgment_pdf_url, {_hash("o_orderpriority", "remarks", "NULL", "'n/a'", "d", "o_orderstatus", "'Civil'", "u", "NULL")} AS content_hash FROM r""",
    "safe_filename": f"SELECT * FROM {_FILENAME}",
    "path_collision": f"""WITH f AS (SELECT *, min(page_id) OVER (PARTITION BY filename) AS owner_id FROM {_FILENAME})
SELECT page_id, owner_id, CASE WHEN owner_id = page_id THEN filename ELSE page_id || '__' || filename END AS destination FROM f""",
    "total_hint": f"SELECT o_orderkey, try_cast(nullif(replace(regexp_extract({_SHOWN}, '(?i)of\\s+([\\d,]+)\\s+entries', 1), ',', ''), '') AS BIGINT) AS hint FROM orders",
    "date_normalize": """SELECT o_orderkey, CASE WHEN o_orderpriority LIKE '5%' THEN CASE WHEN o_orderstatus = 'F' THEN NULL ELSE strftime(o_orderdate, '%Y') || ' term' END ELSE strftime(o_orderdate, '%Y-%m-%d') END AS iso,
  CASE WHEN o_orderpriority NOT LIKE '5%' THEN strftime(o_orderdate, '%Y-%m-%d') END AS day FROM orders""",
    "reconcile": """SELECT CASE WHEN d.doc_id IS NULL THEN 'orphan_text' WHEN l.doc_id IS NULL THEN 'missing_text' ELSE 'consistent' END AS status, count(*) AS n
FROM (SELECT DISTINCT doc_id FROM documents) d FULL JOIN (SELECT DISTINCT doc_id FROM labels WHERE quality = 1) l ON d.doc_id = l.doc_id GROUP BY 1""",
    "orphan_text": "SELECT doc_id, lang FROM documents ANTI JOIN labels USING (doc_id)",
    "totals_check": """WITH s AS (SELECT year(o_orderdate)::INTEGER AS year, count(*) * 4 AS site_total FROM orders GROUP BY 1), p AS (SELECT year(l_shipdate)::INTEGER AS year, count(*) AS n FROM lineitem GROUP BY 1)
SELECT year, site_total, coalesce(n, 0) AS parsed, site_total - coalesce(n, 0) AS gap, site_total - coalesce(n, 0) > 0 AS short FROM s LEFT JOIN p USING (year)""",
    "magic_check": f"SELECT doc_id, {_MAGIC} AS is_pdf FROM ({_FILES})",
    "audit_actions": f"SELECT doc_id, path, {_ACTION} AS action FROM ({_FILES}) WHERE {_ACTION} IS NOT NULL",
    "audit_repair": f"""SELECT doc_id, CASE WHEN a LIKE 'CLEAR%' OR a LIKE 'DELETE%' THEN NULL WHEN a LIKE 'RENAME%' THEN path || '.pdf' ELSE path END AS path,
  CASE WHEN a LIKE 'CLEAR%' OR a LIKE 'DELETE%' THEN NULL WHEN a IS NOT NULL THEN sha256(content) ELSE sha END AS sha FROM (SELECT *, {_ACTION} AS a FROM ({_FILES}))""",
    "set_field": """SELECT doc_id, lang, coalesce(p, source) AS source FROM documents LEFT JOIN (SELECT doc_id, max(CASE WHEN toxic = 1 THEN 'flagged' END) AS p FROM labels GROUP BY 1) USING (doc_id)""",
    "migrate_legacy": f"""WITH o AS (SELECT o_orderkey::VARCHAR AS id, o_orderpriority AS c, CASE WHEN o_orderstatus <> 'F' THEN 'https://x.example/' || o_orderkey || '.pdf' END AS u,
  CASE WHEN o_orderstatus <> 'P' THEN o_orderkey || '.pdf' END AS name FROM orders),
f AS (SELECT l_orderkey || '.pdf' AS f, sha256(l_orderkey::VARCHAR) AS sha FROM lineitem GROUP BY l_orderkey HAVING count(*) > 1)
SELECT id, u AS judgment_pdf_url, 'downloaded_pdfs/' || f AS judgment_local_pdf_path, sha AS judgment_pdf_sha256, {_hash("c", "NULL", "NULL", "NULL", "NULL", "NULL", "NULL", "u", "NULL")} AS content_hash,
  2 AS schema_version, CASE WHEN name IS NULL THEN 'no_path' WHEN f IS NULL THEN 'cleared' ELSE 'kept' END AS outcome FROM o LEFT JOIN f ON name = f""",
    "migration_counts": """WITH o AS (SELECT o_orderkey AS k, o_orderstatus <> 'P' AS named FROM orders), f AS (SELECT l_orderkey AS k FROM lineitem GROUP BY 1 HAVING count(*) > 1)
SELECT CASE WHEN NOT named THEN 'no_path' WHEN f.k IS NULL THEN 'cleared' ELSE 'kept' END AS outcome, count(*) AS n FROM o LEFT JOIN f USING (k) GROUP BY 1""",
    "inspect_ids": """SELECT doc_id, lang, n_chars, d.lang IS NOT NULL AS found, quality, toxic FROM (VALUES (0::BIGINT), (3), (17), (42), (999999999)) AS a(doc_id)
LEFT JOIN (SELECT doc_id, lang, n_chars FROM documents) d USING (doc_id) LEFT JOIN labels USING (doc_id)""",
}
ORACLE_SQL |= {"stream_outcomes": ORACLE_SQL["upsert_outcomes"], "chunk_pack_blocks": _HUNDREDS, "copartitioned_diff": ORACLE_SQL["incremental_diff"], "observed_counters": ORACLE_SQL["ingest_counters"], "knn_pruned": ORACLE_SQL["knn_topk"], "knn_coded": ORACLE_SQL["knn_topk"]}
