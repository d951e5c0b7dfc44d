"""DuckDB SQL that repeats the corpus queries which SQL can express, over whole tables."""

PHRASES = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
), words AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces
), totals AS (
  SELECT lang, sum(len(w))::BIGINT AS n FROM words GROUP BY lang
), starts AS (
  SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM words
), phrases AS (
  SELECT lang, w[i:i + k - 1] AS p, k FROM (SELECT lang, w, i, unnest(range(1, least(5, len(w) - i + 1) + 1)) AS k FROM starts)
), f AS (
  SELECT lang, p, k, count(*) AS f FROM phrases GROUP BY ALL HAVING count(*) >= 100
), cuts AS (
  SELECT lang, p, k, f AS a, unnest(range(1, k)) AS cut FROM f WHERE k >= 2
), rated AS (
  SELECT c.lang, c.p, c.k, c.a, c.cut, x.f AS l, y.f AS r, t.n,
    ((1000::HUGEINT * c.a * t.n) // (x.f::HUGEINT * y.f))::BIGINT AS score
  FROM cuts c JOIN f x ON x.lang = c.lang AND x.p = c.p[1:c.cut] JOIN f y ON y.lang = c.lang AND y.p = c.p[c.cut + 1:c.k]
  JOIN totals t ON t.lang = c.lang
), best AS (
  SELECT * FROM rated QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, cut) = 1
), inner_parts AS (
  SELECT lang, f, k AS longer, p[i:j] AS p FROM (
    SELECT lang, p, k, f, i, unnest(range(i + 1, k + 1)) AS j FROM (SELECT lang, p, k, f, unnest(range(1, k)) AS i FROM f WHERE k >= 3)
  ) WHERE j - i + 1 < k
), covered AS (
  SELECT lang, p, max(f) AS f FROM inner_parts GROUP BY ALL
)
SELECT b.lang, row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, a DESC, array_to_string(b.p, ' ')) AS rank,
  array_to_string(b.p, ' ') AS phrase, a, l, r, n, score
FROM best b LEFT JOIN covered c ON c.lang = b.lang AND c.p = b.p
WHERE c.f IS NULL OR c.f < b.a
QUALIFY rank <= 2000
"""

# crc32 by its usual table: entry i is i divided eight times by the polynomial.
TRIE = """
WITH RECURSIVE divided(i, step, v) AS (
  SELECT i, 0, i::BIGINT FROM range(256) t(i)
  UNION ALL
  SELECT i, step + 1, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384::BIGINT) ELSE v >> 1 END FROM divided WHERE step < 8
), crc_table AS (
  SELECT list(v ORDER BY i) AS t FROM divided WHERE step = 8
), own AS (
  SELECT conv_id, list({'r': coalesce(role, ''), 't': coalesce(text, '')} ORDER BY turn NULLS FIRST) AS s
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id
), shared AS (
  SELECT conv_id, s, xor(list_reduce(
    list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT),
    lambda crc, b: xor(crc >> 8, t[(xor(crc, b) & 255) + 1]), 4294967295::BIGINT), 4294967295::BIGINT) % 9 AS h
  FROM own, crc_table
), rebuilt AS (
  SELECT a.conv_id, list_concat(coalesce(b.s[1:a.h], a.s[1:0]), a.s[a.h + 1:]) AS s
  FROM shared a LEFT JOIN own b ON b.conv_id = a.conv_id - a.conv_id % 5
), prefixes AS (
  SELECT conv_id, d AS depth, sha256(CASE WHEN d = 0 THEN '' ELSE s[1:d]::VARCHAR END) AS node, d = len(s) AS ends,
    CASE WHEN d = 0 THEN 0 ELSE octet_length(encode(s[d].t)) END AS size
  FROM (SELECT conv_id, s, unnest(range(0, len(s) + 1)) AS d FROM rebuilt)
), nodes AS (
  SELECT node, min(conv_id) AS conv_id, any_value(depth) AS depth, any_value(size) AS size, count(*) AS n_convs,
    sha256(coalesce(string_agg(CASE WHEN ends THEN conv_id::VARCHAR END, ',' ORDER BY conv_id), '')) AS ends_sha256
  FROM prefixes GROUP BY node
), linked AS (
  SELECT n.*, p.node AS parent FROM nodes n LEFT JOIN prefixes p ON p.conv_id = n.conv_id AND p.depth = n.depth - 1
), children AS (
  SELECT parent AS node, count(*) AS n_children FROM linked WHERE parent IS NOT NULL GROUP BY parent
), valued AS (
  SELECT l.*, coalesce(c.n_children, 0) AS n_children FROM linked l LEFT JOIN children c ON c.node = l.node
), subtrees AS (
  SELECT p.node, count(*) FILTER (v.n_children = 0) AS n_leaves, sum((v.n_convs - 1) * v.size)::BIGINT AS saved_tokens
  FROM valued v JOIN prefixes p ON p.conv_id = v.conv_id AND p.depth <= v.depth GROUP BY p.node
)
SELECT v.conv_id, v.depth, u.conv_id AS parent_conv_id, v.n_convs, v.n_children, s.n_leaves, s.saved_tokens, v.ends_sha256
FROM valued v JOIN subtrees s ON s.node = v.node LEFT JOIN nodes u ON u.node = v.parent
"""

ARCHIVE = """
WITH payloads AS (
  SELECT page_id, coalesce(html, '') AS payload, max(page_id) OVER (PARTITION BY coalesce(html, '')) AS response FROM pages
), digests AS (
  SELECT page_id, octet_length(encode(payload)) AS payload_bytes, sha1(payload) AS digest, response FROM payloads
)
SELECT page_id, payload_bytes, array_to_string(list_transform(range(0, 32), lambda i: substr(
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    ((('0x' || substr(digest, 10 * (i // 8) + 1, 10))::BIGINT >> (35 - 5 * (i % 8))) & 31)::INT + 1, 1)), '') AS payload_digest,
  CASE WHEN page_id = response THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> response THEN response END AS refers_to
FROM digests
"""
