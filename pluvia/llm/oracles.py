"""DuckDB SQL of the queries that SQL can express."""

COLLOCATIONS = r"""WITH d AS (
  SELECT coalesce(lang, 'und') AS lang,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
p AS (SELECT lang, unnest(string_split_regex(t, '[.,;:!?\x0A-\x0D]')) AS piece FROM d),
w AS (SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda x: x <> '') AS ws FROM p),
total AS (SELECT lang, CAST(sum(len(ws)) AS BIGINT) AS n FROM w GROUP BY lang),
g AS (SELECT lang, k, unnest(list_transform(range(1, len(ws) - k + 2), lambda i: array_to_string(ws[i:i + k - 1], ' '))) AS phrase
  FROM w, (SELECT unnest(range(1, 6)) AS k) s WHERE len(ws) >= k),
f AS (SELECT lang, k, phrase, CAST(count(*) AS BIGINT) AS f FROM g GROUP BY ALL HAVING count(*) >= 100),
c AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS ws FROM f WHERE k >= 2),
cut AS (SELECT lang, k, phrase, a, ws, unnest(range(1, k)) AS j FROM c),
scored AS (
  SELECT cut.lang, cut.k, cut.phrase, a, j, l.f AS l, r.f AS r, n,
    (1000 * CAST(a AS HUGEINT) * n) // (CAST(l.f AS HUGEINT) * r.f) AS score
  FROM cut JOIN f l ON l.lang = cut.lang AND l.phrase = array_to_string(ws[1:j], ' ')
  JOIN f r ON r.lang = cut.lang AND r.phrase = array_to_string(ws[j + 1:], ' ') JOIN total ON total.lang = cut.lang),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1),
kept AS (SELECT * FROM best b WHERE NOT EXISTS (
  SELECT 1 FROM c q WHERE q.lang = b.lang AND q.k > b.k AND 100 * q.a >= 100 * b.a
    AND contains(' ' || q.phrase || ' ', ' ' || b.phrase || ' ')))
SELECT lang, CAST(row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS BIGINT) AS rank,
  phrase, a, l, r, n, CAST(score AS BIGINT) AS score
FROM kept QUALIFY rank <= 2000"""

# The checksum of a conversation's id is computed byte by byte, with its table of 256 entries
# made from the polynomial.
PREFIX_TRIE = r"""WITH RECURSIVE bits(i, v, s) AS (
  SELECT i, i, 0 FROM range(256) t(i)
  UNION ALL SELECT i, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END, s + 1 FROM bits WHERE s < 8),
tab AS (SELECT i, v FROM bits WHERE s = 8),
crc(conv_id, txt, p, c) AS (
  SELECT DISTINCT conv_id, CAST(conv_id AS VARCHAR), 1, CAST(4294967295 AS BIGINT) FROM conversations WHERE conv_id IS NOT NULL
  UNION ALL SELECT conv_id, txt, p + 1, xor(c >> 8, v) FROM crc JOIN tab ON tab.i = xor(c & 255, ascii(substr(txt, p, 1)))
  WHERE p <= length(txt)),
h AS (SELECT conv_id, xor(c, 4294967295) % 4 AS h FROM crc WHERE p = length(txt) + 1),
t AS (SELECT conv_id, turn, sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS id,
  len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS words FROM conversations WHERE conv_id IS NOT NULL),
own AS (SELECT conv_id, list({'id': id, 'w': words} ORDER BY turn NULLS FIRST, id) AS ts FROM t GROUP BY conv_id),
full_ AS (SELECT o.conv_id, list_concat(coalesce(b.ts, o.ts[1:0])[1:h], o.ts[h + 1:]) AS ts
  FROM own o JOIN h USING (conv_id) LEFT JOIN own b ON b.conv_id = o.conv_id - o.conv_id % 20),
ids AS (SELECT conv_id, ts, list_transform(ts, lambda x: x.id) AS ids FROM full_),
pre AS (SELECT conv_id, d, ids[1:d] AS node, CASE WHEN d = 0 THEN 0 ELSE ts[d].w END AS w, d = len(ids) AS ends
  FROM (SELECT *, unnest(range(0, len(ids) + 1)) AS d FROM ids) x),
nodes AS (SELECT node, d, min(conv_id) AS conv_id, count(*) AS n_convs, max(w) AS w,
  string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE ends) AS e FROM pre GROUP BY node, d),
kids AS (SELECT node[1:d - 1] AS node, count(*) AS n_children FROM nodes WHERE d > 0 GROUP BY 1),
flagged AS (SELECT nodes.*, coalesce(n_children, 0) AS n_children FROM nodes LEFT JOIN kids USING (node)),
up AS (SELECT node[1:a] AS node, sum((n_convs - 1) * w) AS saved, count(*) FILTER (WHERE n_children = 0) AS n_leaves
  FROM (SELECT *, unnest(range(0, d + 1)) AS a FROM flagged) x GROUP BY 1)
SELECT f.conv_id, f.d AS depth, parent.conv_id AS parent_conv_id, f.n_convs, f.n_children, up.n_leaves,
  CAST(up.saved AS BIGINT) AS saved_tokens, sha256(coalesce(f.e, '')) AS ends_sha256
FROM flagged f JOIN up USING (node) LEFT JOIN flagged parent ON f.d > 0 AND parent.node = f.node[1:f.d - 1]"""
