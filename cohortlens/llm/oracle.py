"""DuckDB SQL for the operators whose results SQL can express.

The others have none: tokens (1, 7, 8) and a fitted labeller (6) are no SQL, the shards' order
(5) hangs on a hash that SQL lacks, the verdicts and added spans of 9 and 11 are those of their
methods, and a row per byte (10) takes SQL minutes where the tables have megabytes. Tests hold these against brute force, the libraries or their contracts.
"""

from __future__ import annotations

WORDS = r"[^\x20\x09-\x0D]+"
LETTERS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
#: Stands between the words of a window; no word holds it.
GAP = "' '"

NEAR_DEDUP = f"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all({LOWER}, '{WORDS}') AS w FROM documents),
shingles AS MATERIALIZED (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 2
    THEN [w[i] || {GAP} || w[i + 1] FOR i IN range(1, len(w))]
    WHEN len(w) = 1 THEN w ELSE [] END) AS shingle
  FROM words),
sizes AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM shingles GROUP BY 1),
common AS (
  SELECT a.doc_id AS one, b.doc_id AS other, count(*) AS shared
  FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS MATERIALIZED (
  SELECT one, other FROM common JOIN sizes x ON x.doc_id = one JOIN sizes y ON y.doc_id = other
  WHERE 100 * shared >= 80 * (x.n + y.n - shared)),
reached AS (
  SELECT doc_id AS doc, doc_id AS other FROM documents
  UNION SELECT doc, links.other FROM reached JOIN links ON links.one = reached.other),
components AS (SELECT doc AS doc_id, min(other) AS component_id FROM reached GROUP BY 1)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
FROM components LEFT JOIN sizes USING (doc_id)"""

DECONTAMINATION = f"""
WITH docs AS MATERIALIZED (
  SELECT doc_id, regexp_extract_all({LOWER}, '{LETTERS}') AS w FROM documents),
items AS (SELECT DISTINCT item_id, regexp_extract_all({LOWER}, '{LETTERS}') AS w FROM benchmark),
wanted AS MATERIALIZED (
  SELECT DISTINCT item_id, least(len(w), 10) AS size,
         unnest([array_to_string(w[i : i + 9], {GAP}) FOR i IN range(1, greatest(len(w) - 9, 1) + 1)]) AS passage
  FROM items WHERE len(w) > 0),
widths AS (SELECT DISTINCT size FROM wanted),
starts AS (
  SELECT doc_id, size, w, unnest(range(1, len(w) - size + 2)) AS start FROM docs, widths WHERE len(w) >= size),
found AS MATERIALIZED (
  SELECT doc_id, start, wanted.size AS size, item_id
  FROM starts JOIN wanted ON wanted.size = starts.size
    AND passage = array_to_string(w[start : start + starts.size - 1], {GAP})),
hits AS (
  SELECT doc_id, count(DISTINCT place) AS n FROM (
    SELECT doc_id, unnest(range(start, start + size)) AS place FROM found) GROUP BY 1),
named AS (
  SELECT doc_id, count(*) AS n, string_agg(item_id, ',' ORDER BY item_id) AS ids FROM (
    SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item_id FROM found WHERE item_id IS NOT NULL) GROUP BY 1)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(hits.n, 0) AS n_hit, coalesce(named.n, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, hits.n IS NOT NULL AS contaminated
FROM docs LEFT JOIN hits USING (doc_id) LEFT JOIN named USING (doc_id)"""


WINDOW_DEDUP = f"""
WITH docs AS MATERIALIZED (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{WORDS}') AS w FROM documents),
places AS MATERIALIZED (
  SELECT doc_id, place, w[place] AS piece, len(w) - place + 1 AS rest,
         array_to_string(w[place : place + 19], {GAP}) AS passage
  FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS place FROM docs)),
windows AS (
  SELECT doc_id, place, row_number() OVER (PARTITION BY passage ORDER BY doc_id, place) > 1 AS again
  FROM places WHERE rest >= 20),
covered AS (
  SELECT doc_id, place, piece, coalesce(max(CASE WHEN again THEN place END) OVER (
           PARTITION BY doc_id ORDER BY place ROWS UNBOUNDED PRECEDING) > place - 20, false) AS gone
  FROM places LEFT JOIN windows USING (doc_id, place)),
told AS (
  SELECT doc_id, count(*) FILTER (gone) AS n_removed,
         string_agg(piece, ' ' ORDER BY place) FILTER (NOT gone) AS kept FROM covered GROUP BY 1)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_removed, 0) AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM docs LEFT JOIN told USING (doc_id)"""

HARD_NEGATIVES = """
WITH vectors AS MATERIALIZED (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len([1 FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
scores AS MATERIALIZED (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other, a.label = b.label AS same,
         CAST(list_dot_product(a.v, b.v) AS BIGINT) AS score
  FROM vectors a, vectors b WHERE a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
positives AS (
  SELECT anchor_id, other AS positive_id, score AS positive_score FROM scores WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5),
ranked AS (
  SELECT anchor_id, positive_id, other AS negative_id, positive_score, score AS negative_score,
         row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other) AS rank
  FROM positives JOIN scores USING (anchor_id)
  WHERE NOT same AND 80 * positive_score <= 100 * score AND score <= positive_score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score
FROM ranked WHERE rank <= 5"""

CONVERSATION_TRIE = """
WITH turns AS (
  SELECT conv_id, turn, strlen(coalesce(text, '')) AS size,
         sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS told
  FROM conversations WHERE conv_id IS NOT NULL),
own AS MATERIALIZED (
  SELECT conv_id, list({t: told, s: size} ORDER BY turn NULLS FIRST, told) AS turns FROM turns GROUP BY 1),
checksums AS (
  SELECT conv_id, turns, xor(list_reduce(
           list_prepend(4294967295::BIGINT, [ord(c)::BIGINT FOR c IN string_split(conv_id::VARCHAR, '')]),
           lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), range(8)),
             lambda x, turn: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384::BIGINT) ELSE x // 2 END)),
         4294967295::BIGINT) % 9 AS h
  FROM own),
rebuilt AS MATERIALIZED (
  SELECT c.conv_id, coalesce(b.turns[1 : c.h], []) || c.turns[c.h + 1 :] AS path
  FROM checksums c LEFT JOIN own b ON b.conv_id = c.conv_id - c.conv_id % 5),
nodes AS MATERIALIZED (
  SELECT path[1 : depth] AS path, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
         string_agg(conv_id, ',' ORDER BY conv_id) FILTER (len(path) = depth) AS ends
  FROM (SELECT conv_id, path, unnest(range(0, len(path) + 1)) AS depth FROM rebuilt) GROUP BY 1, 2),
children AS (SELECT path[1 : depth - 1] AS path, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY 1),
own_sums AS (
  SELECT path, depth, CASE WHEN n IS NULL THEN 1 ELSE 0 END AS leaf,
         CASE WHEN depth = 0 THEN 0 ELSE (n_convs - 1) * path[depth].s END AS saved
  FROM nodes LEFT JOIN children USING (path)),
sums AS (
  SELECT path[1 : above] AS path, sum(leaf) AS n_leaves, sum(saved) AS saved_tokens
  FROM (SELECT path, leaf, saved, unnest(range(0, depth + 1)) AS above FROM own_sums) GROUP BY 1)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(c.n, 0) AS n_children,
       CAST(n_leaves AS BIGINT) AS n_leaves, CAST(saved_tokens AS BIGINT) AS saved_tokens,
       sha256(coalesce(n.ends, '')) AS ends_sha256
FROM nodes n JOIN sums ON sums.path = n.path LEFT JOIN children c ON c.path = n.path
LEFT JOIN nodes p ON n.depth > 0 AND p.path = n.path[1 : n.depth - 1]"""


def oracle_sql() -> dict[str, str]:
    return {
        "op2_near_dedup": NEAR_DEDUP,
        "op3_decontamination": DECONTAMINATION,
        "op4_window_dedup": WINDOW_DEDUP,
        "op12_hard_negatives": HARD_NEGATIVES,
        "op13_conversation_trie": CONVERSATION_TRIE,
    }
