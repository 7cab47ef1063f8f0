"""DuckDB SQL for those queries of this subpackage that SQL can say whole, over the same tables."""

_GROUPS = ", ".join(f"('0x' || substr(d, {5 * i + 1}, 5))::BIGINT" for i in range(8))

OP4 = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w
  FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
                      ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS s
  FROM words),
shingles AS (SELECT doc_id, len(s) AS n, unnest(s) AS x FROM sets),
pairs AS (
  SELECT a.doc_id AS a, b.doc_id AS b, any_value(a.n) AS na, any_value(b.n) AS nb, count(*) AS m
  FROM shingles a JOIN shingles b ON a.x = b.x AND a.doc_id < b.doc_id
  GROUP BY a.doc_id, b.doc_id),
links AS (SELECT a, b FROM pairs WHERE 100 * m >= 85 * (na + nb - m)),
ways AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach AS (SELECT a AS x, a AS y FROM ways UNION SELECT r.x, w.b FROM reach r JOIN ways w ON w.a = r.y),
least AS (SELECT x, min(y) AS c FROM reach GROUP BY x)
SELECT s.doc_id, len(s.s)::BIGINT AS n_shingles, coalesce(l.c, s.doc_id) AS component_id,
       coalesce(l.c, s.doc_id) = s.doc_id AS kept
FROM sets s LEFT JOIN least l ON l.x = s.doc_id
"""

OP9 = f"""
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, '')))::BIGINT AS payload_bytes, sha1(coalesce(html, '')) AS d FROM pages),
g AS (SELECT *, [{_GROUPS}] AS five, max(page_id) OVER (PARTITION BY d, payload_bytes) AS last FROM p)
SELECT page_id, payload_bytes,
       array_to_string(list_transform(five, lambda v:
         substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (v // 32768 + 1)::INT, 1)
         || substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((v // 1024) % 32 + 1)::INT, 1)
         || substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((v // 32) % 32 + 1)::INT, 1)
         || substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (v % 32 + 1)::INT, 1)), '') AS payload_digest,
       CASE WHEN page_id = last THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = last THEN NULL ELSE last END AS refers_to
FROM g
"""

OP13 = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
words AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
totals AS (SELECT lang, sum(len(w))::BIGINT AS n FROM words GROUP BY lang),
grams AS (
  SELECT lang, m, unnest(list_transform(range(1, len(w) - m + 2), lambda i: w[i:i + m - 1])) AS g
  FROM words, (SELECT unnest([1, 2, 3, 4]) AS m) WHERE len(w) >= m),
f AS (SELECT lang, m, g, count(*)::HUGEINT AS a FROM grams GROUP BY lang, m, g HAVING count(*) >= 30),
wider AS (
  SELECT lang, g, max(a) AS a FROM (
    SELECT lang, g[1:m - 1] AS g, a FROM f WHERE m > 2 UNION ALL SELECT lang, g[2:m] AS g, a FROM f WHERE m > 2)
  GROUP BY lang, g),
kept AS (
  SELECT f.lang, f.m, f.g, f.a FROM f LEFT JOIN wider w ON w.lang = f.lang AND w.g = f.g
  WHERE f.m > 1 AND (w.a IS NULL OR 100 * w.a < 80 * f.a)),
cuts AS (
  SELECT c.lang, c.m, c.g, c.a, k, l.a AS l, r.a AS r, (2000000 * c.a) // (l.a + r.a) AS score
  FROM (SELECT *, unnest(range(1, m)) AS k FROM kept) c
  JOIN f l ON l.lang = c.lang AND l.g = c.g[1:c.k] JOIN f r ON r.lang = c.lang AND r.g = c.g[c.k + 1:c.m]),
worst AS (SELECT *, row_number() OVER (PARTITION BY lang, g ORDER BY score, k) AS i FROM cuts),
ranked AS (
  SELECT lang, array_to_string(g, ' ') AS phrase, a, l, r, score,
         row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, array_to_string(g, ' ')) AS rank
  FROM worst WHERE i = 1)
SELECT ranked.lang, rank::BIGINT AS rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, totals.n, score::BIGINT AS score
FROM ranked JOIN totals ON totals.lang = ranked.lang WHERE rank <= 2000
"""

ORACLES = {"op4_near_duplicates": OP4, "op9_warc": OP9, "op13_collocations": OP13}
