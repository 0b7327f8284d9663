"""DuckDB statements that give the rows of the queries, where SQL can express them on whole tables.

Left out, and held against brute force or held-out labels in tests/llm: op1
and op8 (trained models), op4, op5 and op7 (verdicts of the method), op10
(a tokenizer).
"""

from __future__ import annotations

URL_FILTER = r"""
WITH parts AS (
  SELECT page_id,
         translate(coalesce(regexp_extract(url, '^.*?://([^/?#]*)', 1, 's'), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         coalesce(regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1, 's'), '') AS path
  FROM pages),
rules(rule_host, rule_path, verdict) AS (
  VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')),
judged AS (
  SELECT host, path, arg_max(rule_host || rule_path, length(rule_host || rule_path)) AS rule,
         arg_max(verdict, length(rule_host || rule_path)) AS verdict
  FROM (SELECT DISTINCT host, path FROM parts)
  JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
  GROUP BY ALL)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict
FROM parts LEFT JOIN judged USING (host, path)
"""

JACCARD = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
places AS (
  SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, least(len(w), 1) + 1))) AS i FROM words),
entries AS (SELECT DISTINCT doc_id, hash(array_to_string(w[i : i + 4], ' ')) AS g FROM places),
sizes AS (SELECT doc_id, count(g) AS n FROM words LEFT JOIN entries USING (doc_id) GROUP BY doc_id),
shingles AS (SELECT * FROM entries SEMI JOIN (SELECT g FROM entries GROUP BY g HAVING count(*) > 1) USING (g)),
overlap AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS o
  FROM shingles a JOIN shingles b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (
  SELECT x, y FROM overlap JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y
  WHERE 100 * o >= 75 * (p.n + q.n - o)),
both_ways AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reach(doc_id, other) AS (
  SELECT doc_id, doc_id FROM sizes
  UNION
  SELECT r.doc_id, e.y FROM reach r JOIN both_ways e ON r.other = e.x)
SELECT doc_id, n AS n_shingles, min(other) AS component_id
FROM sizes JOIN reach USING (doc_id) GROUP BY ALL
"""

NEAREST = r"""
WITH v AS (
  SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0)
SELECT query_id, "rank", vec_id, score FROM (
  SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.e, c.e) AS score,
         row_number() OVER (PARTITION BY q.vec_id ORDER BY list_dot_product(q.e, c.e) DESC, c.vec_id)::INTEGER AS "rank"
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0)
WHERE "rank" <= 20
"""

SUBSTRING_DEDUP = r"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
windows AS (
  SELECT doc_id, unnest(range(1, len(w) - 18)) AS s, w FROM words WHERE len(w) >= 20),
hashed AS (SELECT doc_id, s, md5(array_to_string(w[s : s + 19], ' ')) AS h FROM windows),
repeats AS (
  SELECT doc_id, s FROM (SELECT doc_id, s, row_number() OVER (PARTITION BY h ORDER BY doc_id, s) AS k FROM hashed) WHERE k > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(s, s + 20)) AS i FROM repeats),
single AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM words),
kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS t, count(*) AS n
  FROM single ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, len(w) - coalesce(n, 0) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM words LEFT JOIN kept USING (doc_id)
"""


def _edit(way: str, cost: str, letter: str) -> str:
    """A way (nine digits of cost, then the audit) with one more edit; null stays null."""
    return f"lpad((left({way}, 9)::BIGINT + {cost})::VARCHAR, 9, '0') || substr({way}, 10) || '{letter}'"


def _least(*ways: str) -> str:
    return f"least({', '.join(ways)})"


#: Ways before a turn, insertions done: to a user turn, and to an assistant turn.
_USER = _least("w.u", *(_edit(x, "5", "I") for x in ("w.z", "w.s", "w.a")))
_ASSISTANT = _least("w.a", _edit("o.u", "5", "I"))

CONVERSATION_REPAIR = rf"""
WITH RECURSIVE dealt AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         xor(4294967295, list_reduce(
           list_prepend(4294967295::BIGINT, list_transform(string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''), lambda c: ord(c)::BIGINT)),
           lambda r, b: list_reduce(list_prepend(xor(r, b), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
             lambda h, z: xor(h >> 1, CASE WHEN h % 2 = 1 THEN 3988292384 ELSE 0 END)))) % 20 AS lot
  FROM conversations),
damaged AS (
  SELECT conv_id, turn, CASE WHEN lot = 4 THEN 'user' ELSE role END AS role,
         CASE lot WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text
  FROM (SELECT *, unnest(range(CASE lot WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) FROM dealt)),
placed AS (
  SELECT *, left(role, 1) AS initial, rtrim(text, E' 	

') AS shown,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, md5(length(role)::VARCHAR || ':' || role || text)) AS i
  FROM damaged),
turns AS (
  SELECT *, shown = '' AS blank, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS again,
         right(shown, 1) NOT IN ('.', '!', '?') AS cut, lag(initial) OVER (PARTITION BY conv_id ORDER BY i) AS before
  FROM placed),
todo AS (
  SELECT conv_id, i, initial, blank OR again AS must_go, CASE WHEN cut THEN 5 ELSE 0 END AS more FROM turns),
ways AS (
  SELECT DISTINCT conv_id, 0::BIGINT AS i, repeat('0', 9) AS z, NULL::VARCHAR AS s, NULL::VARCHAR AS u, NULL::VARCHAR AS a FROM conversations
  UNION ALL
  SELECT conv_id, i, {_edit("z", "2", "D")},
         least({_edit("s", "2", "D")}, CASE WHEN NOT must_go AND initial = 's' THEN {_edit("z", "more", "K")} END),
         least({_edit("u", "2", "D")},
               CASE WHEN NOT must_go THEN least({_edit("z", "1 + more", "R")}, {_edit("s", "1 + more", "R")}, {_edit("a", "1 + more", "R")}) END,
               CASE WHEN NOT must_go AND initial = 'u' THEN least({_edit("z", "more", "K")}, {_edit("s", "more", "K")}, {_edit("a", "more", "K")}) END),
         least({_edit("a", "2", "D")}, CASE WHEN NOT must_go THEN {_edit("u", "1 + more", "R")} END,
               CASE WHEN NOT must_go AND initial = 'a' THEN {_edit("u", "more", "K")} END)
  FROM (SELECT o.*, {_ASSISTANT.replace("w.a", "o.a0")} AS a
        FROM (SELECT t.*, w.z, w.s, w.a AS a0, {_USER} AS u
              FROM ways w JOIN todo t ON t.conv_id IS NOT DISTINCT FROM w.conv_id AND t.i = w.i + 1) o)),
ends AS (
  SELECT o.conv_id, least(o.z, {_ASSISTANT.replace("w.a", "o.a0")}) AS way
  FROM (SELECT w.conv_id, w.z, w.a AS a0, {_USER} AS u,
               row_number() OVER (PARTITION BY w.conv_id ORDER BY w.i DESC) AS k
        FROM ways w) o
  WHERE k = 1),
audits AS (SELECT conv_id, left(way, 9)::BIGINT AS cost, substr(way, 10) AS audit FROM ends),
letters AS (
  SELECT conv_id, j, letter, sum((letter <> 'I')::INT) OVER w AS i, sum((letter <> 'D')::INT) OVER w AS o
  FROM (SELECT conv_id, unnest(range(1, len(audit) + 1)) AS j, unnest(string_split(audit, '')) AS letter FROM audits WHERE audit <> '')
  WINDOW w AS (PARTITION BY conv_id ORDER BY j)),
left_over AS (
  SELECT l.conv_id, l.j, l.letter, l.o, t.role, CASE WHEN l.letter = 'I' THEN '' ELSE t.text END AS text,
         max((l.o = 1 AND l.letter = 'K' AND t.initial = 's')::INT) OVER (PARTITION BY l.conv_id) AS system
  FROM letters l LEFT JOIN turns t ON t.conv_id IS NOT DISTINCT FROM l.conv_id AND t.i = l.i
  WHERE l.letter <> 'D'),
repaired AS (
  SELECT conv_id, string_agg(CASE WHEN letter = 'K' THEN role WHEN (o - system) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || text, chr(10) ORDER BY j) AS lines
  FROM left_over GROUP BY conv_id),
counted AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count(*) FILTER (blank) AS blank, count(*) FILTER (again AND NOT blank) AS duplicate,
         count(*) FILTER (cut AND NOT again AND NOT blank) AS truncated,
         count(*) FILTER (before || initial NOT IN ('su', 'ua', 'au')) AS illegal
  FROM turns GROUP BY conv_id)
SELECT e.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, cost, audit, sha256(coalesce(lines, '')) AS repaired_sha256
FROM audits e LEFT JOIN counted c ON c.conv_id IS NOT DISTINCT FROM e.conv_id
LEFT JOIN repaired r ON r.conv_id IS NOT DISTINCT FROM e.conv_id
"""

HARD_NEGATIVES = r"""
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, list_dot_product(a.e, b.e)::BIGINT AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score
  FROM scored WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id,
       row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)::INTEGER AS "rank",
       vec_id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scored USING (anchor_id)
WHERE NOT same AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
QUALIFY row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) <= 5
"""

SUFFIX_DEDUP = r"""
WITH bytes AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
places AS (SELECT doc_id, h, unnest(range(0, len(h) // 2 - 49)) AS s FROM bytes WHERE len(h) >= 100),
strings AS (SELECT doc_id, s, md5_number(substr(h, 2 * s + 1, 100)) AS k FROM places),
firsts AS (SELECT k, min(doc_id) AS first FROM strings GROUP BY k),
repeats AS (SELECT doc_id, s FROM strings JOIN firsts USING (k) WHERE doc_id > first),
marked AS (
  SELECT doc_id, s, coalesce(s > lag(s) OVER w + 50, true) AS new, least(50, coalesce(lead(s) OVER w - s, 50)) AS own
  FROM repeats WINDOW w AS (PARTITION BY doc_id ORDER BY s)),
runs AS (
  SELECT doc_id, run, min(s) AS a, max(s) + 50 AS b, sum(own) AS n
  FROM (SELECT *, sum(new::INT) OVER (PARTITION BY doc_id ORDER BY s) AS run FROM marked) GROUP BY doc_id, run),
removed AS (SELECT doc_id, sum(n)::BIGINT AS n_removed, count(*) AS n_spans FROM runs GROUP BY doc_id),
pieces AS (
  SELECT doc_id, a, substr(h, 2 * coalesce(lag(b) OVER w, 0) + 1, 2 * (a - coalesce(lag(b) OVER w, 0))) AS piece
  FROM (SELECT doc_id, h, a, b FROM bytes JOIN runs USING (doc_id) UNION ALL SELECT doc_id, h, len(h) // 2, len(h) // 2 + 1 FROM bytes)
  WINDOW w AS (PARTITION BY doc_id ORDER BY a, b)),
kept AS (SELECT doc_id, string_agg(piece, '' ORDER BY a) AS k FROM pieces GROUP BY doc_id)
SELECT doc_id, len(h) // 2 AS n_bytes, coalesce(n_removed, 0) AS n_removed,
       coalesce(n_spans, 0) AS n_spans, sha256(unhex(k)) AS kept_sha256
FROM bytes LEFT JOIN removed USING (doc_id) JOIN kept USING (doc_id)
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op2_url_filter": URL_FILTER,
        "op3_ngram_jaccard": JACCARD,
        "op6_block_ann": NEAREST,
        "op9_substring_dedup": SUBSTRING_DEDUP,
        "op11_conversation_repair": CONVERSATION_REPAIR,
        "op12_hard_negatives": HARD_NEGATIVES,
        "op13_suffix_dedup": SUFFIX_DEDUP,
    }
