"""DuckDB SQL for the queries that SQL can express on whole tables. Written from the contracts, not from the code."""

from __future__ import annotations

WORD = r"[^\x20\x09-\x0D]+"


def components(links: str, nodes: str) -> str:
    """CTE ``components`` (id, component_id) over a view of links (a, b) and one of nodes (id)."""
    return f"""reach(id, other) AS (
  SELECT id, id FROM {nodes}
  UNION
  SELECT r.id, CASE WHEN l.a = r.other THEN l.b ELSE l.a END FROM reach r JOIN {links} l ON r.other IN (l.a, l.b)
),
components AS (SELECT id, min(other) AS component_id FROM reach GROUP BY id)"""


def near_documents() -> str:
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return f"""WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{upper.lower()}'), '{WORD}') AS w FROM documents
),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i+3], ' '))) END AS s
  FROM words
),
grams AS (SELECT doc_id, len(s) AS n, unnest(s) AS gram FROM sets),
pairs AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS both_, any_value(x.n) AS m, any_value(y.n) AS n
  FROM grams x JOIN grams y ON x.gram = y.gram AND x.doc_id < y.doc_id AND 100 * least(x.n, y.n) >= 80 * greatest(x.n, y.n)
  GROUP BY x.doc_id, y.doc_id
),
links AS (SELECT a, b FROM pairs WHERE 100 * both_ >= 80 * (m + n - both_)),
nodes AS (SELECT doc_id AS id FROM documents),
{components("links", "nodes")}
SELECT doc_id, len(s) AS n_shingles, component_id, doc_id = component_id AS kept
FROM sets JOIN components ON doc_id = id"""


def near_vectors() -> str:
    return f"""WITH RECURSIVE sound AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
),
links AS (
  SELECT x.vec_id AS a, y.vec_id AS b FROM sound x JOIN sound y ON x.vec_id < y.vec_id AND len(x.v) = len(y.v)
  WHERE list_cosine_similarity(x.v, y.v) >= 0.9
),
nodes AS (SELECT vec_id AS id FROM embeddings),
{components("links", "nodes")},
ends AS (SELECT id, count(*) AS n FROM (SELECT a AS id FROM links UNION ALL SELECT b FROM links) GROUP BY id)
SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM embeddings JOIN components c ON vec_id = c.id LEFT JOIN ends e ON vec_id = e.id"""


def archives() -> str:
    return """WITH payloads AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages
),
first AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first_id FROM payloads)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN first_id END AS refers_to, TRUE AS intact
FROM first"""


def repeats() -> str:
    return f"""WITH words AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{WORD}') AS w FROM documents),
windows AS (
  SELECT doc_id, i, array_to_string(w[i:i+19], ' ') AS gram
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS i FROM words)
),
again AS (SELECT doc_id, i FROM windows QUALIFY row_number() OVER (PARTITION BY gram ORDER BY doc_id, i) > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS j FROM again),
flat AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS j FROM words),
kept AS (
  SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY j) AS text FROM flat ANTI JOIN gone USING (doc_id, j)
  GROUP BY doc_id
)
SELECT doc_id, len(w) AS n_words, len(w) - coalesce(n, 0) AS n_removed, sha256(coalesce(text, '')) AS kept_sha256
FROM words LEFT JOIN kept USING (doc_id)"""


def spelling_variants() -> str:
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return f"""WITH RECURSIVE runs AS (
  SELECT DISTINCT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')), '{upper}', '{upper.lower()}') AS run FROM documents
),
bits AS (
  SELECT doc_id, run, CAST(encode(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run) AS BIT) AS b FROM runs WHERE length(run) >= 6
),
sums AS (
  SELECT doc_id, run, xor(4294967295, list_reduce(
    list_prepend(4294967295, list_transform(range(bit_length(b)), lambda i: CAST(get_bit(b, CAST(i // 8 * 8 + 7 - i % 8 AS INTEGER)) AS BIGINT))),
    lambda c, x: xor(c >> 1, 3988292384 * (xor(c, x) & 1)))) AS h
  FROM bits
),
changed AS (
  SELECT doc_id, run, CASE WHEN h % 199 = 0 THEN left(run, CAST(h % length(run) AS BIGINT)) || substr(run, CAST(h % length(run) AS BIGINT) + 2) ELSE run END AS word
  FROM sums
),
occurrences AS (
  SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')), '{upper}', '{upper.lower()}') AS run FROM documents
),
words AS (
  SELECT word, count(*) AS n FROM occurrences o JOIN changed c ON o.run = c.run AND o.doc_id IS NOT DISTINCT FROM c.doc_id
  WHERE length(word) >= 6 GROUP BY word HAVING count(*) >= 5
),
cuts AS (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words),
without AS (SELECT word, n, i, left(word, i - 1) || substr(word, i + 1) AS rest, length(word) AS size FROM cuts),
pairs AS (
  SELECT a.word, b.word AS near, b.n FROM without a JOIN without b ON a.rest = b.rest AND a.i = b.i AND a.size = b.size AND a.word <> b.word
  UNION
  SELECT a.word, b.word, b.n FROM without a JOIN words b ON a.rest = b.word
  UNION
  SELECT b.word, a.word, a.n FROM without a JOIN words b ON a.rest = b.word
),
best AS (
  SELECT word, near, n AS near_n, count(*) OVER (PARTITION BY word) AS n_near FROM pairs
  QUALIFY row_number() OVER (PARTITION BY word ORDER BY n DESC, near) = 1
),
forms AS (
  SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN near_n >= 5 * n THEN near END AS form,
    CASE WHEN near_n >= 5 * n THEN near_n END AS form_n
  FROM words LEFT JOIN best USING (word)
),
walk(word, stop) AS (
  SELECT word, word FROM forms
  UNION ALL
  SELECT w.word, f.form FROM walk w JOIN forms f ON f.word = w.stop WHERE f.form IS NOT NULL
)
SELECT f.word, f.form, w.stop AS root, f.n, f.n_near, f.form_n FROM forms f JOIN walk w ON f.word = w.word
JOIN forms last ON last.word = w.stop AND last.form IS NULL"""


def formatted_chats() -> str:
    marks = ["<|im_start|>", "<|im_end|>", "<|endoftext|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>"]
    escaped = "replace(text, chr(92), chr(92) || chr(92))"
    for mark in marks:
        escaped = f"replace({escaped}, '{mark}', '{mark[0]}' || chr(92) || '{mark[1:]}')"
    return f"""WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL
  SELECT -7, * FROM (VALUES (0, 'user', '</s>[INST] ok [/INST]'), (1, 'assistant', '</s>[INST] ok [/INST]')) AS t(turn, role, text)
),
learnt AS (SELECT *, CASE WHEN role = 'assistant' THEN text ELSE '' END AS loss FROM turns)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(sum(length(loss)) AS BIGINT) AS loss_chars,
  sha256(string_agg(loss, '' ORDER BY turn, role, text)) AS loss_sha256,
  CAST(sum(length(url_encode(role)) + 24 + length({escaped})) AS BIGINT) AS formatted_chars
FROM learnt GROUP BY conv_id"""


def statements() -> dict[str, str]:
    return {
        "op1_minhash_neardup": near_documents(),
        "op4_pq_neardup": near_vectors(),
        "op6_warc_chunks": archives(),
        "op9_relative_lz_substrings": repeats(),
        "op12_spelling_variants": spelling_variants(),
        "op13_chat_formatting": formatted_chats(),
    }
