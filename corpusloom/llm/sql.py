"""DuckDB SQL for the training-data queries that SQL can express."""

from __future__ import annotations

from .quality_rules import BOILERPLATE, COPYRIGHT, MARKS, MENU, SEPARATORS

_WORDS = r"regexp_extract_all(coalesce({0}, ''), '[^\x20\x09-\x0D]+')"


def _times(text: str, chars: str) -> str:
    """How often any of the characters, or of the general category in braces, occurs."""
    if chars.startswith("{"):
        return f"length(regexp_replace({text}, '[^\\p{chars}]', '', 'g'))"
    return f"(length({text}) - length(regexp_replace({text}, '[{chars}]', '', 'g')))"


_ITEMS = rf"""len(list_filter(ws, lambda w: regexp_replace(lower(w), '^[^\p{{L}}]+|[^\p{{L}}]+$', '', 'g') IN ({", ".join(f"'{w}'" for w in MENU)})))"""
_OP1 = rf"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text, {_WORDS.format("text")} AS ws FROM documents),
lines AS (SELECT r, unnest(string_split(text, chr(10))) AS line FROM docs),
own AS (SELECT r, line, {_WORDS.format("line")} AS ws FROM lines),
judged AS (
  SELECT r, line, len(ws) AS n, list_sum(list_transform(ws, lambda w: length(w))) AS chars,
    ({_times("line", SEPARATORS)} >= 3 AND 100 * {_times("line", SEPARATORS)} >= 25 * len(ws))
    OR (len(ws) <= 12 AND {_ITEMS} >= 3 AND 2 * {_ITEMS} >= len(ws))
    OR ({_times("line", "#*$%&|<>")} >= 3 AND 100 * {_times("line", "#*$%&|<>")} > 50 * len(ws))
    OR ({_times("line", "!?")} >= 3 AND 100 * {_times("line", "!?")} > 50 * len(ws))
    OR (len(ws) >= 8 AND 4 * {_times("line", "{Lu}")} > len(ws) AND 100 * {_times("line", "{Lu}")} >= 80 * {_times("line", "{L}")})
    OR (len(ws) >= 60 AND NOT regexp_matches(line, '[{MARKS}]'))
    OR (NOT regexp_matches(line, '[\p{{L}}\p{{N}}]') AND list_sum(list_transform(ws, lambda w: length(w))) >= 3)
    OR (len(ws) <= 20 AND regexp_matches(lower(line), '{"|".join((*BOILERPLATE, COPYRIGHT))}') ) AS fails
  FROM own WHERE len(ws) > 0),
by_line AS (
  SELECT r, count(*) - count(DISTINCT line) AS n_dup_lines, count(*) FILTER (WHERE fails) AS n_lines_removed,
    coalesce(sum(chars) FILTER (WHERE fails), 0)::BIGINT AS removed_chars FROM judged GROUP BY r),
words AS (SELECT r, unnest(ws) AS w, generate_subscripts(ws, 1) AS i FROM docs),
grams AS (
  SELECT r, i, CASE WHEN lead(w, 4) OVER o IS NOT NULL THEN w || ' ' || lead(w) OVER o || ' ' || lead(w, 2) OVER o || ' ' || lead(w, 3) OVER o || ' ' || lead(w, 4) OVER o END AS g
  FROM words WINDOW o AS (PARTITION BY r ORDER BY i)),
found AS (SELECT r, i, g IS NOT NULL AND count(*) OVER (PARTITION BY r, g) > 1 AS again FROM grams),
covered AS (SELECT r, i, max(CASE WHEN again THEN 1 ELSE 0 END) OVER (PARTITION BY r ORDER BY i ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS c FROM found),
by_word AS (SELECT r, sum(c)::BIGINT AS n_repeat_words FROM covered GROUP BY r),
facts AS (
  SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(list_sum(list_transform(ws, lambda w: length(w))), 0)::BIGINT AS word_chars,
    {_times("text", "#*$%&|<>")}::BIGINT AS n_symbols, coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines,
    coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words, coalesce(n_lines_removed, 0)::BIGINT AS n_lines_removed,
    coalesce(removed_chars, 0)::BIGINT AS removed_chars
  FROM docs LEFT JOIN by_line USING (r) LEFT JOIN by_word USING (r))
SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
  NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AND 100 * removed_chars <= 50 * word_chars AS kept
FROM facts"""

_OP5 = rf"""
WITH docs AS (
  SELECT doc_id, source, len({_WORDS.format("text")})::BIGINT AS size,
    ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT AS h FROM documents),
sums AS (SELECT source, sum(size)::BIGINT AS source_size FROM docs GROUP BY source),
weighed AS (
  SELECT *, 2 * source_size AS cap, [3, 1, 2][1 + (row_number() OVER (ORDER BY source IS NULL, encode(source)) - 1) % 3] AS w,
    sum(source_size) OVER () AS total FROM sums),
levels AS (
  SELECT *, (1.5::DOUBLE * total - coalesce(sum(cap) OVER (ORDER BY cap::DOUBLE / w, source IS NULL, encode(source) ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
    / sum(w) OVER (ORDER BY cap::DOUBLE / w, source IS NULL, encode(source) ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM weighed),
goal AS (
  SELECT source, source_size, least(cap::DOUBLE, coalesce((SELECT arg_min(level, cap::DOUBLE / w) FROM levels WHERE level * w <= cap) * w, cap::DOUBLE)) AS target FROM levels),
placed AS (
  SELECT d.*, g.source_size, g.target,
    CASE WHEN g.source_size > 0 THEN floor(g.target / g.source_size)::BIGINT ELSE 0 END AS repeats,
    coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY h RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 0) AS upto,
    sum(size) OVER (PARTITION BY d.source, h) AS same
  FROM docs d JOIN goal g ON d.source IS NOT DISTINCT FROM g.source),
budget AS (SELECT *, floor(target)::BIGINT - repeats * source_size AS rest FROM placed)
SELECT doc_id, size, source_size, target,
  least(2 * size, repeats * size + CASE WHEN upto <= rest THEN size WHEN upto - same <= rest AND same > 0
    THEN floor(size * least(1.0::DOUBLE, (rest - (upto - same))::DOUBLE / same)) ELSE 0 END)::BIGINT AS taken
FROM budget"""

_OP9 = """
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, t, r, '</s>[INST] ok [/INST]' FROM (VALUES (0, 'user'), (1, 'assistant')) AS x(t, r)),
joined AS (
  SELECT conv_id, count(*)::BIGINT AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, encode(role), encode(text))) AS turns_sha256,
    coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, encode(role), encode(text)) FILTER (WHERE role = 'assistant'), '') AS loss,
    sum(26 + length(role) + length(text) + length(role || text) - length(regexp_replace(role || text, '[\\\\<\\[]', '', 'g')))::BIGINT AS formatted_chars
  FROM rows GROUP BY conv_id)
SELECT conv_id, n_turns, turns_sha256, length(loss)::BIGINT AS loss_chars, sha256(loss) AS loss_sha256, formatted_chars FROM joined"""

#: node → the least id that is reachable over links (a, b), for a table of nodes (doc): all pairs of a component are made, so for small tables.
_REACH = """
both_ways AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach AS (SELECT a, b FROM both_ways UNION SELECT r.a, l.b FROM reach r JOIN both_ways l ON r.b = l.a),
least AS (SELECT a, min(b) AS least FROM reach GROUP BY a)"""

_OP4 = rf"""
WITH RECURSIVE docs AS (SELECT doc_id, {_WORDS.format("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} AS ws FROM documents),
sets AS (SELECT doc_id, list_distinct(CASE WHEN len(ws) = 0 THEN []::VARCHAR[] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
  ELSE list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' ')) END) AS s FROM docs),
shingles AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM sets),
links AS (SELECT x.doc_id AS a, y.doc_id AS b FROM shingles x JOIN shingles y ON x.g = y.g AND x.doc_id < y.doc_id
  GROUP BY x.doc_id, y.doc_id, x.n, y.n HAVING 100 * count(*) >= 75 * (x.n + y.n - count(*))),
{_REACH.strip()}
SELECT doc_id, len(s)::BIGINT AS n_shingles, least(doc_id, coalesce(least, doc_id)) AS component_id FROM sets LEFT JOIN least ON doc_id = a"""

#: All pairs: exact, where the operator may miss a pair at the threshold (the README has its recall).
_OP7 = f"""
WITH RECURSIVE vectors AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings),
good AS (SELECT * FROM vectors WHERE len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(e, lambda x: x <> 0)) > 0),
links AS (SELECT x.vec_id AS a, y.vec_id AS b FROM good x JOIN good y ON x.vec_id < y.vec_id AND len(x.e) = len(y.e) WHERE list_cosine_similarity(x.e, y.e) >= 0.9),
{_REACH.strip()},
counts AS (SELECT a, count(*) AS n FROM both_ways GROUP BY a),
found AS (SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, least(vec_id, coalesce(least, vec_id)) AS component_id FROM vectors LEFT JOIN counts ON vec_id = counts.a LEFT JOIN least ON vec_id = least.a)
SELECT *, vec_id = component_id AS kept FROM found"""



def _crc_step(c: int) -> int:
    """crc32 (reflected polynomial 0xEDB88320) of one byte's value, without the inversions."""
    for _ in range(8):
        c = c >> 1 ^ (0xEDB88320 if c & 1 else 0)
    return c


_BYTES = "list_transform(range(1, length(hex(encode({0}))) // 2 + 1), lambda i: ('0x' || substr(hex(encode({0})), 2 * i - 1, 2))::UBIGINT)"
_CRC = f"xor(list_reduce([4294967295::UBIGINT] || {_BYTES}, lambda c, b: xor(c >> 8, ([{', '.join(str(_crc_step(i)) for i in range(256))}]::UBIGINT[])[(xor(c, b) & 255)::BIGINT + 1])), 4294967295::UBIGINT)"

#: Near words by the strings that are left without one code point; forms are followed to their ends.
_OP12 = rf"""
WITH RECURSIVE runs AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\x{{00C0}}-\x{{00FF}}]+')) AS run FROM documents),
own AS MATERIALIZED (SELECT coalesce(doc_id::VARCHAR, '') || ':' AS doc, run, count(*) AS n FROM runs GROUP BY ALL),
hashed AS (SELECT run, n, {_CRC.format("(doc || run)")} AS h FROM own),
edited AS (SELECT CASE WHEN h % 97 = 0 THEN substr(run, 1, (h % length(run))::BIGINT) || substr(run, (h % length(run))::BIGINT + 2) ELSE run END AS word, n FROM hashed),
words AS MATERIALIZED (SELECT word, sum(n)::BIGINT AS n FROM edited WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3),
places AS (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words),
without AS MATERIALIZED (SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS d FROM places),
near AS (
  SELECT DISTINCT a.word, b.word AS other, b.n AS m FROM without a JOIN without b ON a.d = b.d AND a.i = b.i AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM without a JOIN words b ON a.d = b.word
  UNION SELECT b.word, a.word, a.n FROM without a JOIN words b ON a.d = b.word),
best AS (SELECT word, count(*)::BIGINT AS n_near, max(m) AS m, min(struct_pack(m := -m, w := encode(other))) AS b FROM near GROUP BY word),
forms AS MATERIALIZED (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN m >= 2 * w.n THEN decode(b.w) END AS form, CASE WHEN m >= 2 * w.n THEN m END::BIGINT AS form_n
  FROM words w LEFT JOIN best USING (word)),
ends AS (SELECT word, word AS here, form AS ahead FROM forms UNION ALL SELECT e.word, f.word, f.form FROM ends e JOIN forms f ON e.ahead = f.word)
SELECT word, form, (SELECT e.here FROM ends e WHERE e.word = forms.word AND e.ahead IS NULL) AS root, n, n_near, form_n FROM forms"""


def _op13(rounds: int = 6) -> str:
    """Rounds of assignment and averaging, one pair of tables each."""
    apart = "list_sum(list_transform(list_zip(x, c), lambda t: (t[1] - t[2]) * (t[1] - t[2])))"
    steps = []
    for k in range(rounds + 1):
        steps.append(f"a{k} AS MATERIALIZED (SELECT r, p, min(struct_pack(d := {apart}, e := e)) AS b FROM parts JOIN b{k} USING (p) GROUP BY r, p)")
        if k < rounds:
            steps.append(f"""s{k} AS (SELECT p, b.e AS e, i, sum(x[i])::BIGINT AS s, count(*) AS n FROM a{k} JOIN parts USING (r, p), range(1, 1 + (SELECT w FROM width)) AS u(i) GROUP BY ALL),
m{k} AS (SELECT p, e, list((s - ((s % n) + n) % n) // n ORDER BY i) AS c FROM s{k} GROUP BY p, e),
b{k + 1} AS MATERIALIZED (SELECT p, e, coalesce(m.c, b.c) AS c FROM b{k} b LEFT JOIN m{k} m USING (p, e))""")
    body = ",\n".join(steps)
    return f"""
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id) AS r, vec_id, label, list_transform(embedding, lambda x: floor(4096 * x::DOUBLE)::BIGINT) AS v
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
width AS (SELECT max(len(v)) // 8 AS w FROM kept),
parts AS MATERIALIZED (SELECT r, p, v[p * w + 1:(p + 1) * w] AS x FROM kept, width, range(8) AS t(p)),
b0 AS MATERIALIZED (SELECT p, r - 1 AS e, x AS c FROM parts WHERE r <= 16),
{body},
coded AS (SELECT r, string_agg(lower(printf('%02x', b.e)), '' ORDER BY p) AS code, sum(b.d)::BIGINT AS error FROM a{rounds} GROUP BY r),
book AS (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM b{rounds})
SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error, codebooks_sha256 FROM coded JOIN kept USING (r), book"""


ORACLE_SQL: dict[str, str] = {
    "op1_quality_rules": _OP1,
    "op4_jaccard_join": _OP4,
    "op5_mixing": _OP5,
    "op7_lattice_dedup": _OP7,
    "op9_chat_format": _OP9,
    "op12_spelling_variants": _OP12,
    "op13_vector_codes": _op13(),
}
