"""The same results in plain SQL, written independently of the DataFrame code, for DuckDB."""

from __future__ import annotations

from html.entities import name2codepoint

# What counts as white space, and the terms of the country check.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
COUNTRY_TERMS = [
    "norway", "sweden", "france", "uk", "united kingdom", "germany", "italy", "spain", "ireland", "finland", "ukraine",
    "portugal", "australia", "denmark", "greece", "switzerland",
]

WS_CLASS = r"[\t\n\x0B\f\r\x1c-\x1f \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
WORD_CLASS = r"[\p{L}\p{N}_]"
AS_OF = "TIMESTAMP '2024-07-28 23:30:00'"

COUNTRY = """
country AS (
  SELECT n_nationkey AS country, r_name AS region FROM nation JOIN region ON n_regionkey = r_regionkey
)"""

ENTRIES = f"""{COUNTRY},
contest AS (
  SELECT o_orderkey AS orderkey, CAST(year(o_orderdate) AS INTEGER) AS year, c_nationkey AS host
  FROM orders JOIN customer ON o_custkey = c_custkey
),
song AS (
  SELECT l_orderkey AS orderkey, l_linenumber AS linenumber, l_partkey AS partkey,
         s_nationkey AS country, 'Order ' || l_orderkey || '/' || l_linenumber AS song_name,
         s_name AS artist_name, l_returnflag AS language, l_linestatus AS style,
         nullif(l_linenumber, 7) AS final_place
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
),
entries AS (
  SELECT s.*, c.year, c.host, h.region AS host_region, p.region AS participant_region
  FROM song s JOIN contest c USING (orderkey)
  JOIN country h ON c.host = h.country JOIN country p ON s.country = p.country
)"""

PROFILE = f"""{ENTRIES},
part_entries AS (
  SELECT e.*, p_name || ' ' || p_partkey AS entity FROM entries e JOIN part ON partkey = p_partkey
),
profile AS (
  SELECT entity, count(*) AS participations,
         CAST(count(*) FILTER (final_place = 1) AS BIGINT) AS wins,
         round_even(avg(final_place), 1) AS avg_place, min(final_place) AS best_place,
         first(participant_region ORDER BY year, participant_region NULLS FIRST) AS region,
         min(year) AS first_year, max(year) AS last_year,
         coalesce(string_agg(DISTINCT language, ',' ORDER BY language), '') AS languages,
         coalesce(string_agg(DISTINCT style, ',' ORDER BY style), '') AS styles
  FROM part_entries GROUP BY entity
),
winners AS (
  SELECT entity, count(*) AS n_winners, string_agg(
    '''' || song_name || ''' by ' || artist_name || ' (' || year || ', ' || language || ', ' || style || ')',
    ', ' ORDER BY year, song_name, artist_name, language, style) AS winners
  FROM part_entries WHERE final_place = 1 GROUP BY entity
)"""

SUMMARIES = f"""{PROFILE},
summaries AS (
  SELECT lower(replace(entity, ' ', '_')) AS chunk_id, CAST(0 AS BIGINT) AS part,
    entity || ' has participated in Eurovision' || participations || ' times (' || first_year || '–'
    || last_year || '), representing ' || region || '.'
    || CASE WHEN wins > 0 THEN ' They have won ' || wins || ' time(s): ' || winners || '.'
            ELSE ' They have never won.' END
    || ' ' || coalesce(' Their average placement is ' || avg_place || ',', '')
    || ' ' || coalesce(' with a best placement of ' || best_place || '.', '')
    || ' They have performed in: ' || replace(languages, ',', ', ') || '.'
    || ' Their musical styles include: ' || replace(styles, ',', ', ') || '.' AS text
  FROM profile LEFT JOIN winners USING (entity)
)"""


def _quote(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _pack(text: str, sep: str, size: int) -> str:
    s, w = _quote(sep), _quote(WHITESPACE)
    joined = f"trim(s.cur || {s} || e.cur, {w})"
    return f"""list_reduce(
      list_transform(string_split({text}, {s}), lambda p: {{'done': CAST([] AS VARCHAR[]), 'cur': p}}),
      lambda s, e: CASE WHEN s.cur = '' THEN {{'done': s.done, 'cur': e.cur}}
        WHEN length({joined}) <= {size} THEN {{'done': s.done, 'cur': {joined}}}
        ELSE {{'done': list_append(s.done, s.cur), 'cur': e.cur}} END,
      {{'done': CAST([] AS VARCHAR[]), 'cur': ''}})"""


def _chunks(text: str, size: int = 1000) -> str:
    def closed(sep: str) -> str:
        state = _pack(text, sep, size)
        return f"list_transform([{state}], lambda r: CASE WHEN r.cur <> '' THEN list_append(r.done, r.cur) ELSE r.done END)[1]"

    return f"""CASE WHEN length({text}) <= {size} THEN [{text}]
      WHEN contains({text}, '\n\n') THEN {closed(chr(10) * 2)}
      WHEN contains({text}, '. ') THEN {closed('. ')}
      WHEN contains({text}, ' ') THEN {closed(' ')}
      ELSE list_transform(range(0, CAST(ceil(length({text}) / {size}.0) AS BIGINT)),
                          lambda i: substring({text}, i * {size} + 1, {size})) END"""


DOCUMENT_CHUNKS = f"""
packed AS (SELECT doc_id, source, {_chunks('text')} AS pieces FROM documents),
document_chunks AS (
  SELECT doc_id, source, CAST(unnest(range(len(pieces))) AS INTEGER) AS chunk_idx, unnest(pieces) AS chunk
  FROM packed
)"""

TAG_END = r"(?:[ \t\n\f\r/][^>]*)?>"
BLOCK_TAGS = (
    "address|article|aside|blockquote|body|dd|div|dl|dt|fieldset|figcaption|figure|footer|form|header|hr|html|li|main|nav|ol|p"
    "|pre|section|table|tbody|td|tfoot|th|thead|tr|ul|h1|h2|h3|h4|h5|h6"
)
NAMED = ", ".join(f"{_quote(n)}: chr({c})" for n, c in sorted({**name2codepoint, "apos": 39}.items()))


def _decoded(text: str) -> str:
    name = "regexp_extract(p, '^(#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]*);', 1)"
    code = f"CASE WHEN {name}[2:2] IN ('x', 'X') THEN TRY_CAST('0x' || {name}[3:] AS INTEGER) ELSE TRY_CAST({name}[2:] AS INTEGER) END"
    sound = f"({code} BETWEEN 1 AND 55295 OR {code} BETWEEN 57344 AND 1114111)"
    char = f"""CASE WHEN {name} LIKE '#%' THEN CASE WHEN {sound} THEN chr({code}) END
      WHEN {name} <> '' THEN (MAP {{{NAMED}}})[{name}] END"""
    rest = f"coalesce({char} || substr(p, length({name}) + 2), '&' || p)"
    return f"(string_split({text}, '&')[1] || array_to_string(list_transform(string_split({text}, '&')[2:], lambda p: {rest}), ''))"


def _inline(markup: str) -> str:
    text = _decoded(f"regexp_replace({markup}, '<[/!?a-zA-Z][^>]*>', '', 'g')")
    return f"trim(regexp_replace({text}, '{WS_CLASS}+', ' ', 'g'), ' ')"


def _page_sections(pages: str) -> str:
    """CTEs up to ``section_chunks`` over a view (page_id, html)."""
    hidden = "|".join(f"<{t}{TAG_END}.*?</{t}{TAG_END}" for t in ("script", "style", "noscript", "template")) + "|<!--.*?-->"
    around = "|".join(f"<{t}{TAG_END}.*?</{t}{TAG_END}" for t in ("head", "nav", "header", "footer", "aside", "form"))
    return f"""
visible AS (SELECT page_id, regexp_replace(replace(html, chr(1), ''), '(?is){hidden}', '', 'g') AS page FROM {pages}),
content AS (
  SELECT page_id, CASE WHEN regexp_matches(page, '(?is)<article{TAG_END}.*?</article{TAG_END}')
    THEN array_to_string(regexp_extract_all(page, '(?is)<article{TAG_END}(.*?)</article{TAG_END}', 1), '<hr>')
    ELSE regexp_replace(page, '(?is){around}', '', 'g') END AS markup
  FROM visible
),
titled AS (SELECT page_id, markup, {_inline(f"regexp_extract(markup, '(?is)<h1{TAG_END}(.*?)</h1', 1)")} AS title FROM content),
split AS (
  SELECT page_id, title, unnest(parts) AS part, unnest(range(len(parts))) AS i
  FROM (SELECT page_id, title, string_split(regexp_replace(markup, '(?i)<h([1-6][ \\t\\n\\f\\r/>])', chr(1) || '<h\\1', 'g'), chr(1)) AS parts FROM titled)
),
headed AS (
  SELECT page_id, title, i, part, CASE WHEN i = 0 THEN 0 ELSE CAST(part[3:3] AS INTEGER) END AS level,
    CASE WHEN i = 0 THEN '' ELSE regexp_extract(part, '(?is)^(.*?</h[1-6][ \\t\\n\\f\\r]*>)', 1) END AS opening
  FROM split
),
parsed AS (
  SELECT page_id, title, i, level, {_inline(f"regexp_replace(opening, '(?is)^<h[1-6]{TAG_END}', '')")} AS own,
    array_to_string(list_filter(list_transform(
      string_split(regexp_replace(regexp_replace(part[length(opening) + 1:], '(?i)</?(?:{BLOCK_TAGS}){TAG_END}', chr(1), 'g'), '(?i)<br{TAG_END}', ' ', 'g'), chr(1)),
      lambda b: {_inline("b")}), lambda b: b <> ''), chr(10) || chr(10)) AS body
  FROM headed
),
parents AS (
  SELECT c.page_id, c.i, max(a.i) AS parent FROM parsed c
  LEFT JOIN parsed a ON a.page_id = c.page_id AND a.i < c.i AND a.level > 0 AND a.level < c.level GROUP BY c.page_id, c.i
),
climb AS (
  SELECT page_id, i, i AS step FROM parsed WHERE level > 0
  UNION ALL
  SELECT c.page_id, c.i, p.parent FROM climb c JOIN parents p ON p.page_id = c.page_id AND p.i = c.step WHERE p.parent IS NOT NULL
),
paths AS (
  SELECT c.page_id, c.i, string_agg(s.own, ' > ' ORDER BY s.i) AS path
  FROM climb c JOIN parsed s ON s.page_id = c.page_id AND s.i = c.step GROUP BY c.page_id, c.i
),
leads AS (
  SELECT page_id, split_part(arg_min(body, i), chr(10) || chr(10), 1) AS summary FROM parsed WHERE level <= 1 AND body <> '' GROUP BY page_id
),
sections AS (
  SELECT page_id, level, coalesce(path, '') AS path, CASE WHEN level = 0 THEN title ELSE own END AS section_title, title,
    coalesce(summary, '') AS summary, body AS section,
    CAST(row_number() OVER (PARTITION BY page_id ORDER BY i) - 1 AS INTEGER) AS section_idx
  FROM parsed LEFT JOIN paths USING (page_id, i) LEFT JOIN leads USING (page_id) WHERE body <> ''
),
packed_sections AS (SELECT *, {_chunks('section')} AS pieces FROM sections),
page_chunks AS (
  SELECT * EXCLUDE (section, pieces), CAST(unnest(range(len(pieces))) AS INTEGER) AS sub_chunk_idx, unnest(pieces) AS text
  FROM packed_sections
),
section_chunks AS (
  SELECT page_id, level, path, section_title, title, summary, section_idx, sub_chunk_idx,
         page_id || '_' || lower(replace(section_title, ' ', '_')) || '_' || sub_chunk_idx AS chunk_id, text
  FROM page_chunks
)"""


PAGE_SECTIONS = _page_sections("pages")

# Pages with headings of several levels, with a heading that nobody closes, two articles, one with attributes, or none.
RICH_PAGES = """
rich_pages AS (
  SELECT page_id, CASE page_id % 4
      WHEN 0 THEN replace(html, '<article>', '<article class="main" id=a>')
      WHEN 1 THEN replace(replace(html, '<article>', '<div>'), '</article>', '</div>')
      WHEN 2 THEN replace(html, '</h1>', '</h1></article><article>')
      ELSE replace(html, '</article>', '<h5>open</article>') END AS html
  FROM (SELECT page_id, replace(replace(replace(html, '<br>', '<h2 class="k">Part &#38; &eacute;<br/>two</h2>'),
    '.</p><p>', '.</p><h4>Deep</h4><p>'), ', ', ' &lt;&#x1F600;&nope;&#0; ') AS html FROM pages)
)"""

UNIFIED = f"""{SUMMARIES}, {DOCUMENT_CHUNKS}, {PAGE_SECTIONS},
unified AS (
  SELECT 'documents_' || doc_id || '_' || chunk_idx AS id, chunk AS text, 'documents' AS source
  FROM document_chunks
  UNION ALL SELECT 'pages_' || chunk_id, text, 'pages' FROM section_chunks
  UNION ALL SELECT 'summaries_' || chunk_id, text, 'summaries' FROM summaries
)"""

ELEMENTS = """
lines AS (
  SELECT doc_id, string_split(text, chr(10)) AS all_lines FROM documents
),
numbered AS (
  SELECT doc_id, unnest(range(len(all_lines))) AS i, unnest(all_lines) AS content FROM lines
),
elements AS (
  SELECT CAST(doc_id AS VARCHAR) AS doc_id, CAST(i AS VARCHAR) AS chunk_id, content
  FROM numbered WHERE length(content) >= 20
)"""

PAPERS = """
papers AS (
  SELECT CAST(doc_id AS VARCHAR) AS arxiv_id, source || ' ' || doc_id AS title,
         'quality ' || quality AS summary, source || ', ' || lang AS authors,
         make_timestamp((1577836800 + n_chars * 4321) * 1000000) AS published
  FROM documents JOIN labels USING (doc_id)
)"""


def _clean(text: str) -> str:
    joined = f"regexp_replace({text}, '({WORD_CLASS})-{WS_CLASS}*\\n{WS_CLASS}*({WORD_CLASS})', '\\1\\2', 'g')"
    flat = f"regexp_replace({joined}, '{WS_CLASS}*\\n{WS_CLASS}*', ' ', 'g')"
    return f"trim(regexp_replace({flat}, '{WS_CLASS}+', ' ', 'g'), ' ')"


SNAPSHOTS = """
old AS (SELECT doc_id, text FROM documents WHERE lang <> 'de'),
new AS (
  SELECT doc_id, CASE WHEN source = 'src3' THEN text || chr(10) || '(revised)' ELSE text END AS text
  FROM documents WHERE lang <> 'es'
)"""

SYNC = f"""
sources AS (
  SELECT event_type AS source_table FROM events UNION SELECT lang FROM documents
),
state AS (
  SELECT event_type AS source_table, max(ts) AS last_synced FROM events GROUP BY event_type
),
due AS (
  SELECT source_table, last_synced IS NULL
    OR (epoch_us({AS_OF}) - epoch_us(last_synced)) // 86400000000 >= 180 AS due
  FROM sources LEFT JOIN state USING (source_table)
)"""

SCOREBOARD = """
scoreboard AS (
  SELECT country, count(*) AS participations,
         CAST(sum(CASE WHEN final_place = 1 THEN 1 ELSE 0 END) AS BIGINT) AS wins,
         round(avg(final_place), 6) AS avg_place
  FROM entries WHERE final_place IS NOT NULL GROUP BY country HAVING count(*) >= 5
)"""

# Benchmark items carry the vector of their number.
QUERY_VECTORS = """
qv AS (
  SELECT item_id AS qid, CAST(embedding AS DOUBLE[]) AS q FROM benchmark JOIN embeddings ON item_id = vec_id
)"""


def _top(scored: str, k: int, id: str = "id") -> str:
    return f"""
  SELECT * FROM (
    SELECT *, CAST(row_number() OVER (PARTITION BY qid ORDER BY score DESC, {id}) AS INTEGER) AS rank
    FROM {scored}
  ) WHERE rank <= {k}"""


VECTOR_SCORES = f"""{QUERY_VECTORS},
vector_scores AS (
  SELECT qid, vec_id AS id, label,
         round(list_dot_product(q, CAST(embedding AS DOUBLE[])), 6) AS score FROM qv, embeddings
)"""

TERMS = r"list_filter(string_split_regex(lower(text), '[^\p{L}\p{N}]+'), lambda t: t <> '')"

BM25 = f"""
query_terms AS (SELECT DISTINCT item_id AS qid, unnest({TERMS}) AS term FROM benchmark),
words AS (SELECT doc_id, {TERMS} AS terms FROM documents),
totals AS (SELECT count(*) AS n, avg(len(terms)) AS avg_words FROM words),
tf AS (
  SELECT doc_id, n_words, term, count(*) AS tf
  FROM (SELECT doc_id, len(terms) AS n_words, unnest(terms) AS term FROM words)
  WHERE term IN (SELECT term FROM query_terms) GROUP BY ALL
),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
bm25 AS (
  SELECT qid, doc_id AS id, round(sum(
      ln(1 + (n - df + 0.5) / (df + 0.5)) * tf * 2.2
      / (tf + 1.2 * (0.25 + 0.75 * n_words / avg_words))), 6) AS score
  FROM tf JOIN df USING (term) JOIN query_terms USING (term) CROSS JOIN totals GROUP BY qid, doc_id
)"""

LOOKUP_ERROR = "json_object('error', 'No data found for country: ' || name || '.' || chr(10) || repeat(' ', 36) || 'Maybe they never qualified?')"


def statements() -> dict[str, str]:
    contains_term = " OR ".join(f"contains(lower(text), {_quote(t)})" for t in COUNTRY_TERMS)
    word_list = f"list_filter(string_split_regex(text, '{WS_CLASS}+'), lambda w: w <> '')"
    checks = f"""
checks AS (
  SELECT conv_id, turn, len({word_list}) < 400 AS word_count_check, {contains_term} AS mentions_countries
  FROM conversations WHERE role = 'assistant'
)"""
    return {
        "star_join": f"""WITH {ENTRIES}
SELECT orderkey, linenumber, host, host_region, country, participant_region FROM entries""",
        "dropped_dimension_keys": f"""WITH {ENTRIES},
known AS (SELECT country FROM country WHERE region <> 'EUROPE')
SELECT 'host' AS side, host AS key, count(*) AS n FROM contest
WHERE host NOT IN (SELECT country FROM known) GROUP BY host
UNION ALL
SELECT 'participant', country, count(*) FROM song
WHERE country NOT IN (SELECT country FROM known) GROUP BY country""",
        "entity_scoreboard": f"WITH {ENTRIES}, {SCOREBOARD} SELECT * FROM scoreboard",
        "entity_profile": f"""WITH {PROFILE},
per_year AS (SELECT entity, year, count(*) AS n FROM part_entries GROUP BY entity, year),
years AS (SELECT entity, string_agg(year || 'x' || n, ',' ORDER BY year) AS years FROM per_year GROUP BY entity)
SELECT entity, participations, wins, avg_place, best_place, region, years, languages, styles
FROM profile JOIN years USING (entity)""",
        "entity_winners": f"""WITH {PROFILE}
SELECT entity, CAST(0 AS BIGINT) AS part, n_winners, winners FROM winners""",
        "entity_summary": f"WITH {SUMMARIES} SELECT chunk_id, part, text FROM summaries",
        "chunk_documents": f"WITH {DOCUMENT_CHUNKS} SELECT doc_id, chunk_idx, chunk FROM document_chunks",
        "incremental_chunks": f"WITH {DOCUMENT_CHUNKS} SELECT doc_id, chunk_idx, chunk FROM document_chunks",
        "chunk_stats": f"""WITH {DOCUMENT_CHUNKS}
SELECT source, count(*) AS total_chunks, round(avg(length(chunk)), 6) AS avg_length,
       CAST(min(length(chunk)) AS BIGINT) AS min_length, CAST(max(length(chunk)) AS BIGINT) AS max_length,
       round(avg(length(chunk)) / 4, 6) AS est_tokens
FROM document_chunks GROUP BY source""",
        "page_sections": f"WITH RECURSIVE {PAGE_SECTIONS} SELECT * FROM section_chunks",
        "page_tree": f"WITH RECURSIVE {RICH_PAGES}, {_page_sections('rich_pages')} SELECT * FROM section_chunks",
        "fetch_pages": """SELECT page_id, url, regexp_extract(url, '[^/]*$') AS url_id,
  regexp_replace(regexp_extract(html, '<h1>(.*?)</h1>', 1, 's'), '<[^>]*>', '', 'g') AS title
FROM pages WHERE page_id IN (SELECT user_id FROM events)""",
        "clean_text": f"""SELECT doc_id, {_clean("replace(text, 'tion', 'ti-' || chr(10) || ' on')")} AS text
FROM documents""",
        "parse_elements": f"WITH {ELEMENTS} SELECT doc_id, chunk_id, content AS text FROM elements",
        "broken_documents": """SELECT event_id, '<' || props AS parsed_content
FROM events WHERE event_type = 'error'""",
        "props_extract": "SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events",
        "paper_chunks": f"""WITH {ELEMENTS}, {PAPERS}
SELECT doc_id AS arxiv_id, chunk_id, {_clean('content')} AS text, doc_id || '_' || chunk_id AS id,
  title, summary, authors, CAST(year(published) AS INTEGER) AS year,
  CAST(month(published) AS INTEGER) AS month, CAST(day(published) AS INTEGER) AS day
FROM elements LEFT JOIN papers ON doc_id = arxiv_id""",
        "unified_corpus": f"WITH RECURSIVE {UNIFIED} SELECT id, text, source FROM unified",
        "duplicate_ids": f"""WITH RECURSIVE {RICH_PAGES}, {_page_sections('rich_pages')}
SELECT 'pages_' || chunk_id AS id, count(*) AS n FROM section_chunks GROUP BY id HAVING count(*) > 1""",
        "new_keys_only": """SELECT doc_id, lang, source FROM documents d
WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)""",
        "merge_insert_only": """SELECT doc_id, quality, toxic, CAST(NULL AS VARCHAR) AS lang FROM labels
UNION ALL SELECT doc_id, NULL, NULL, lang FROM documents d
WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)""",
        "change_feed": f"""WITH {SNAPSHOTS}
SELECT new.doc_id, CASE WHEN old.doc_id IS NULL THEN 'insert' ELSE 'update_postimage' END AS change_type, new.text
FROM new LEFT JOIN old USING (doc_id) WHERE old.text IS DISTINCT FROM new.text
UNION ALL
SELECT old.doc_id, CASE WHEN new.doc_id IS NULL THEN 'delete' ELSE 'update_preimage' END, old.text
FROM old LEFT JOIN new USING (doc_id) WHERE old.text IS DISTINCT FROM new.text""",
        "change_feed_copies": f"""WITH {SNAPSHOTS},
versions AS (
  SELECT doc_id, text FROM old
  UNION SELECT doc_id, text || chr(10) || '(second)' FROM old WHERE doc_id % 5 = 0
),
touched AS (
  SELECT doc_id FROM (SELECT doc_id, text FROM versions EXCEPT SELECT doc_id, text FROM new)
  UNION SELECT doc_id FROM (SELECT doc_id, text FROM new EXCEPT SELECT doc_id, text FROM versions)
)
SELECT doc_id, CASE WHEN doc_id IN (SELECT doc_id FROM old) THEN 'update_postimage' ELSE 'insert' END AS change_type, text
FROM new WHERE doc_id IN (SELECT doc_id FROM touched)
UNION ALL
SELECT doc_id, CASE WHEN doc_id IN (SELECT doc_id FROM new) THEN 'update_preimage' ELSE 'delete' END, text
FROM versions v WHERE NOT EXISTS (SELECT 1 FROM new n WHERE n.doc_id = v.doc_id AND n.text = v.text)""",
        "change_feed_digests": f"""WITH {SNAPSHOTS}
SELECT new.doc_id, CASE WHEN old.doc_id IS NULL THEN 'insert' ELSE 'update_postimage' END AS change_type, new.text
FROM new LEFT JOIN old USING (doc_id) WHERE old.text IS DISTINCT FROM new.text
UNION ALL
SELECT old.doc_id, CASE WHEN new.doc_id IS NULL THEN 'delete' ELSE 'update_preimage' END, old.text
FROM old LEFT JOIN new USING (doc_id) WHERE old.text IS DISTINCT FROM new.text""",
        "index_sync_stream": f"WITH {SNAPSHOTS} SELECT doc_id, md5(text) AS text_hash FROM new",
        "index_sync": f"WITH {SNAPSHOTS} SELECT doc_id, md5(text) AS text_hash FROM new",
        "seed_state": f"""WITH {SYNC}
SELECT source_table, last_synced FROM state WHERE last_synced > {AS_OF}
UNION ALL SELECT source_table, NULL FROM sources
WHERE NOT EXISTS (SELECT 1 FROM state WHERE last_synced > {AS_OF})""",
        "refresh_due": f"""WITH {SYNC}
SELECT source_table, due FROM due UNION ALL SELECT NULL, bool_or(due) FROM due""",
        "stamp_sync": f"""WITH {SYNC}
SELECT source_table, CASE WHEN due THEN {AS_OF} ELSE last_synced END AS last_synced
FROM due LEFT JOIN state USING (source_table)""",
        "table_profile": """WITH merged AS (
  SELECT doc_id, quality, toxic, CAST(NULL AS VARCHAR) AS lang FROM labels
  UNION ALL SELECT doc_id, NULL, NULL, lang FROM documents d
  WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id))
SELECT 'doc_id' AS column, count(*) AS n, count(*) - count(doc_id) AS nulls FROM merged
UNION ALL SELECT 'quality', count(*), count(*) - count(quality) FROM merged
UNION ALL SELECT 'toxic', count(*), count(*) - count(toxic) FROM merged
UNION ALL SELECT 'lang', count(*), count(*) - count(lang) FROM merged""",
        "table_head": "SELECT doc_id, lang, source, n_chars FROM documents ORDER BY doc_id LIMIT 5",
        "markdown_rows": f"""WITH {ENTRIES}, {SCOREBOARD}
SELECT '| ' || country || ' | ' || participations || ' | ' || wins || ' |' AS line FROM scoreboard""",
        "vector_topk": f"""WITH {VECTOR_SCORES}
SELECT qid, id, score, rank FROM ({_top('vector_scores', 10)})""",
        "vector_topk_filtered": f"""WITH {VECTOR_SCORES},
allowed AS (SELECT * FROM vector_scores WHERE label = 3)
SELECT qid, id, score, rank FROM ({_top('allowed', 5)})""",
        "vector_index_topk": f"""WITH {VECTOR_SCORES}
SELECT qid, id, score, rank FROM ({_top('vector_scores', 10)})""",
        "vector_index_filtered": f"""WITH {VECTOR_SCORES},
allowed AS (SELECT * FROM vector_scores WHERE label = 3)
SELECT qid, id, score, rank FROM ({_top('allowed', 5)})""",
        "vector_topk_probed": f"""WITH {VECTOR_SCORES},
positions AS (
  SELECT label, unnest(range(len(embedding))) AS pos, CAST(unnest(embedding) AS DOUBLE) AS x FROM embeddings
),
means AS (SELECT label, pos, avg(x) AS x FROM positions GROUP BY label, pos),
cells AS (SELECT label AS cell, list(x ORDER BY pos) AS centre FROM means GROUP BY label),
placed AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v, cell, row_number() OVER (
    PARTITION BY vec_id ORDER BY round(list_dot_product(CAST(embedding AS DOUBLE[]), centre), 6) DESC, cell) AS r
  FROM embeddings, cells
),
visited AS (
  SELECT s.qid, s.id, s.score FROM vector_scores s
  JOIN placed c ON c.vec_id = s.id AND c.r = 1
  JOIN placed q ON q.vec_id = s.qid AND q.r <= 2 AND q.cell = c.cell
)
SELECT qid, id, score, rank FROM ({_top('visited', 10)})""",
        "keyword_topk": f"WITH {BM25} SELECT qid, id, score, rank FROM ({_top('bm25', 10)})",
        "keyword_topk_indexed": f"WITH {BM25} SELECT qid, id, score, rank FROM ({_top('bm25', 10)})",
        "hybrid_topk": f"""WITH {VECTOR_SCORES}, {BM25},
linked AS (SELECT s.* FROM vector_scores s JOIN documents ON doc_id = id),
votes AS (
  SELECT qid, id, rank FROM ({_top('linked', 50)}) UNION ALL SELECT qid, id, rank FROM ({_top('bm25', 50)})
),
fused AS (SELECT qid, id, round(sum(1 / (60.0::DOUBLE + rank)), 9) AS score FROM votes GROUP BY qid, id)
SELECT qid, doc_id, source, score, rank FROM ({_top('fused', 10)}) JOIN documents ON doc_id = id""",
        "hybrid_deep": f"""WITH {VECTOR_SCORES}, {BM25},
linked AS (SELECT s.* FROM vector_scores s JOIN documents ON doc_id = id),
votes AS (
  SELECT qid, id, rank FROM ({_top('linked', 80)}) UNION ALL SELECT qid, id, rank FROM ({_top('bm25', 80)})
),
fused AS (SELECT qid, id, round(sum(1 / (60.0::DOUBLE + rank)), 9) AS score FROM votes GROUP BY qid, id)
SELECT qid, doc_id, source, score, rank FROM ({_top('fused', 80)}) JOIN documents ON doc_id = id""",
        "hybrid_exact": f"""WITH {VECTOR_SCORES}, {BM25},
linked AS (SELECT s.* FROM vector_scores s JOIN documents ON doc_id = id),
votes AS (
  SELECT qid, id, row_number() OVER (PARTITION BY qid ORDER BY score DESC, id) AS rank FROM linked
  UNION ALL SELECT qid, id, row_number() OVER (PARTITION BY qid ORDER BY score DESC, id) FROM bm25
),
fused AS (SELECT qid, id, round(sum(1 / (60.0::DOUBLE + rank)), 9) AS score FROM votes GROUP BY qid, id)
SELECT qid, doc_id, source, score, rank FROM ({_top('fused', 10)}) JOIN documents ON doc_id = id""",
        "answer_checks": f"WITH {checks} SELECT * FROM checks",
        "tfidf_embed": f"""WITH words AS (SELECT doc_id, unnest({TERMS}) AS term FROM documents),
tf AS (SELECT doc_id, term, count(*) AS tf FROM words GROUP BY doc_id, term),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
total AS (SELECT count(*) AS n FROM documents),
entries AS (
  SELECT doc_id, CAST(CAST('0x' || md5(term)[1:8] AS BIGINT) % 256 AS INTEGER) AS position,
    sum(CASE WHEN CAST('0x' || md5(term)[9:9] AS BIGINT) % 2 = 0 THEN 1.0::DOUBLE ELSE -1.0::DOUBLE END
      * tf * (ln((n + 1)::DOUBLE / (df + 1)) + 1)) AS x
  FROM tf JOIN df USING (term) CROSS JOIN total GROUP BY ALL
),
unit AS (SELECT doc_id, position, round(x / sqrt(sum(x * x) OVER (PARTITION BY doc_id)), 6) AS value FROM entries)
SELECT * FROM unit WHERE value <> 0""",
        "mixed_answers": f"""WITH said AS (
  SELECT conv_id, turn, CASE conv_id % 6 WHEN 0 THEN text WHEN 1 THEN text WHEN 2 THEN '' WHEN 3 THEN '[]'
    WHEN 4 THEN '12.' || turn ELSE text END AS text
  FROM conversations WHERE role = 'assistant'
)
SELECT conv_id, turn, text AS said, len({word_list}) < 400 AS word_count_check, {contains_term} AS mentions_countries FROM said""",
        "evaluation_report": f"""WITH {checks}
SELECT 'word_count_check' AS scorer, count(*) AS n, round(avg(word_count_check::INT), 6) AS mean FROM checks
UNION ALL
SELECT 'mentions_countries', count(*), round(avg(mentions_countries::INT), 6) FROM checks""",
        "lookup_with_fallback": f"""WITH {SUMMARIES},
requests AS (
  SELECT p_name || ' ' || p_partkey AS key, '  ' || array_to_string(list_transform(
    string_split(p_name || ' ' || p_partkey, ' '), lambda w: upper(w[1]) || w[2:]), ' ') || chr(10) AS name
  FROM part
  UNION ALL SELECT s_name, s_name FROM supplier
)
SELECT name, text IS NOT NULL AS found, part,
  CAST(CASE WHEN text IS NULL THEN {LOOKUP_ERROR}
       ELSE json_object('country', name, 'stats', text) END AS VARCHAR) AS json
FROM requests LEFT JOIN summaries ON lower(replace(key, ' ', '_')) = chunk_id""",
        "history_json": f"""WITH {SUMMARIES},
sized AS (
  SELECT *, md5(chunk_id || '/' || part) AS digest,
    strlen(CAST(json_object('country', chunk_id, 'stat', text) AS VARCHAR)) + 1 AS bytes FROM summaries
),
dealt AS (
  SELECT *, CAST((sum(bytes) OVER (ORDER BY digest, chunk_id) - bytes) // 65536 AS BIGINT) AS document FROM sized
)
SELECT document, count(*) AS n, CAST(json_object('year', 2025, 'historical_data',
    to_json(list({{'country': chunk_id, 'stat': text}} ORDER BY chunk_id))) AS VARCHAR) AS json
FROM dealt GROUP BY document""",
        "tool_dispatch": f"""WITH {SUMMARIES},
requests AS (
  SELECT event_id AS request_id, event_type, p_name || ' ' || p_partkey AS name
  FROM events LEFT JOIN part ON CAST(json_extract_string(props, '$.k') AS BIGINT) = p_partkey
),
sized AS (SELECT strlen(CAST(json_object('country', chunk_id, 'stat', text) AS VARCHAR)) + 1 AS bytes FROM summaries),
lookups AS (
  SELECT * FROM requests WHERE event_type IN ('view', 'click') AND name IS NOT NULL
)
SELECT request_id, 'roast_country' AS tool, part,
  CAST(CASE WHEN text IS NULL THEN {LOOKUP_ERROR}
       ELSE json_object('country', name, 'stats', text) END AS VARCHAR) AS output
FROM lookups LEFT JOIN summaries ON lower(replace(name, ' ', '_')) = chunk_id
UNION ALL
SELECT request_id,
  CASE event_type WHEN 'purchase' THEN 'predict_winner' WHEN 'error' THEN 'error' ELSE 'roast_country' END,
  NULL,
  CASE event_type WHEN 'purchase' THEN (
      SELECT CAST(json_object('table', 'history_json', 'first', 0, 'last', CAST((sum(bytes) - 1) // 65536 AS BIGINT)) AS VARCHAR) FROM sized
    ) WHEN 'error' THEN 'Unknown tool: error'
    ELSE 'Tool error: roast_country() missing 1 required positional argument: ''country_name''' END
FROM requests WHERE NOT (event_type IN ('view', 'click') AND name IS NOT NULL)""",
        "assistant_messages": "SELECT conv_id, turn, text FROM conversations WHERE role = 'assistant'",
        "last_answers": """SELECT conv_id, max(turn) AS turn, arg_max(text, turn) AS text
FROM conversations WHERE role = 'assistant' GROUP BY conv_id""",
        "conversation_outcome": """SELECT conv_id, count(*) AS turns,
  CASE WHEN arg_max(role, turn) = 'assistant' THEN 'answered'
       WHEN count(*) >= 10 THEN 'max_iterations' ELSE 'open' END AS outcome
FROM conversations GROUP BY conv_id""",
        "binary_scan": "SELECT doc_id, lang, source, n_chars FROM documents",
        "stored_papers": "SELECT doc_id, quality, toxic, 202501010000 AS processed, TRUE AS there FROM labels",
        "output_messages": """SELECT conv_id, turn, text FROM conversations
WHERE role = 'assistant' AND turn % 4 <> 3""",
        "csv_load": """SELECT l_orderkey AS orderkey, nullif(l_linenumber, 7) AS final_place,
  'He said "hi", twice' || chr(10) || l_returnflag AS language, l_extendedprice AS price FROM lineitem""",
        "record_load": f"""WITH {PAPERS}
SELECT arxiv_id, title, summary, authors, CAST(strftime(published, '%Y%m%d%H%M') AS BIGINT) AS published
FROM papers""",
    }
