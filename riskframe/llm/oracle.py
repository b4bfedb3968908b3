"""DuckDB SQL for the queries of this subpackage that SQL can express."""

from __future__ import annotations

_sql: dict[str, str] = {}


def all_oracles() -> dict[str, str]:
    return dict(_sql)


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _count(text: str, said: str) -> str:
    return f"(length({text}) - length(replace({text}, '{said}', ''))) // {len(said)}"


# What the template of chat records puts a backslash into.
_CONTROL = ["\\", "<|", "|>", "<s>", "</s>", "<<SYS>>", "<</SYS>>", "[INST]", "[/INST]"]


def _written(text: str) -> str:
    """Characters of a role or text as the template writes it."""
    return " + ".join([f"length({text})", *(_count(text, c) for c in _CONTROL)])


_sql["op3_chat_formatting"] = f"""
WITH turns AS (
  SELECT conv_id, CAST(turn AS BIGINT) AS turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
  sha256(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, '' ORDER BY turn, role, text)) AS loss_sha256,
  CAST(sum(23 + {_written('role')} + {_written('text')}) AS BIGINT) AS formatted_chars
FROM turns GROUP BY conv_id
"""


def _words(table: str, key: str) -> str:
    return f"""SELECT {key}, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'),
    '[0-9a-z\\x{{80}}-\\x{{10FFFF}}]+') AS w FROM {table}"""


_sql["op5_benchmark_decontamination"] = f"""
WITH dw AS ({_words('documents', 'doc_id')}),
iw AS ({_words('benchmark', 'item_id')}),
item_windows AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i : i + least(len(w), 10) - 1], ' ') AS said
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 10, 0) + 2)) AS i FROM iw WHERE len(w) > 0)
),
document_windows AS (
  SELECT doc_id, n, i, array_to_string(w[i : i + n - 1], ' ') AS said
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i
        FROM dw, (SELECT DISTINCT n FROM item_windows) WHERE len(w) >= n)
),
hits AS (
  SELECT d.doc_id, d.i, d.n, x.item_id FROM document_windows d JOIN item_windows x ON d.n = x.n AND d.said = x.said
),
marked AS (
  SELECT doc_id, count(DISTINCT spot) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + n)) AS spot FROM (SELECT DISTINCT doc_id, i, n FROM hits)) GROUP BY doc_id
),
listed AS (
  SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM hits WHERE item_id IS NOT NULL) GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM dw LEFT JOIN marked USING (doc_id) LEFT JOIN listed USING (doc_id)
"""

# Texts with equal sets are one class, and classes are compared by the shingles they share.
_sql["op6_minhash_near_dedup"] = f"""
WITH RECURSIVE dw AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'),
    '[^\\x20\\x09-\\x0D]+') AS w FROM documents
),
sets AS (
  SELECT doc_id, list_sort(list_distinct(list_transform(range(1, greatest(len(w) - 5, 0) + 2),
    lambda i: array_to_string(w[i : i + 4], ' ')))) AS s
  FROM dw WHERE len(w) > 0
),
classes AS (SELECT s, min(doc_id) AS rep, len(s) AS n FROM sets GROUP BY s),
shingles AS (SELECT rep, n, unnest(s) AS shingle FROM classes),
links AS (
  SELECT a.rep AS a, b.rep AS b FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.rep < b.rep
  GROUP BY a.rep, b.rep, a.n, b.n HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))
),
edges AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reached(rep, other) AS (
  SELECT a, b FROM edges
  UNION
  SELECT r.rep, e.b FROM reached r JOIN edges e ON r.other = e.a
),
least AS (SELECT rep, least(rep, min(other)) AS component FROM reached GROUP BY rep)
SELECT d.doc_id, coalesce(len(s.s), 0) AS n_shingles, coalesce(l.component, c.rep, d.doc_id) AS component_id,
  coalesce(l.component, c.rep, d.doc_id) = d.doc_id AS kept
FROM documents d LEFT JOIN sets s ON d.doc_id = s.doc_id LEFT JOIN classes c ON s.s = c.s LEFT JOIN least l ON c.rep = l.rep
"""

_sql["op8_warc"] = """
WITH bodies AS (SELECT page_id, encode(coalesce(html, '')) AS body FROM pages),
digests AS (SELECT page_id, CAST(octet_length(body) AS BIGINT) AS payload_bytes, sha1(body) AS payload_digest FROM bodies),
largest AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS top FROM digests)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= 1000 AND page_id < top THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 1000 AND page_id < top THEN top END AS refers_to
FROM largest
"""

_sql["op13_hard_negatives"] = """
WITH whole AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS DOUBLE)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same,
         CAST(list_dot_product(a.v, b.v) AS BIGINT) AS score
  FROM whole a JOIN whole b ON a.vec_id <> b.vec_id
  WHERE a.vec_id % 100 = 0
), positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
), ranked AS (
  SELECT p.anchor_id, p.positive_id, p.positive_score, s.vec_id AS negative_id, s.score AS negative_score,
         row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id) AS r
  FROM positives p JOIN scored s USING (anchor_id)
  WHERE NOT s.same AND 30 * p.positive_score <= 100 * s.score AND 100 * s.score <= 90 * p.positive_score
)
SELECT anchor_id, positive_id, CAST(r AS INTEGER) AS rank, negative_id, positive_score, negative_score
FROM ranked WHERE r <= 10
"""
