"""SQL statements (DuckDB) of the queries that SQL can express."""

from __future__ import annotations

_WS = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_KEY = (
    "translate(trim({0}, " + _WS + "), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
)

OP2 = f"""
WITH docs AS (
  SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents
), keyed AS (
  SELECT doc_id, lines, list_transform(lines, lambda l: {_KEY.format('l')}) AS keys FROM docs
), found AS (
  SELECT DISTINCT doc_id, key
  FROM (SELECT doc_id, unnest(keys) AS key FROM keyed) WHERE length(key) >= 40
), repeated AS (
  SELECT key, max(doc_id) AS keeper FROM found GROUP BY key HAVING count(*) >= 5
), dropped AS (
  SELECT found.doc_id, list(key) AS gone
  FROM found JOIN repeated USING (key) WHERE found.doc_id <> keeper GROUP BY found.doc_id
), kept AS (
  SELECT doc_id, len(lines) AS n_lines,
    list_filter(lines, lambda l: NOT coalesce(list_contains(gone, {_KEY.format('l')}), false)) AS stay
  FROM keyed LEFT JOIN dropped USING (doc_id)
)
SELECT doc_id, n_lines::BIGINT AS n_lines, (n_lines - len(stay))::BIGINT AS n_dropped,
  sha256(array_to_string(stay, chr(10))) AS kept_sha256
FROM kept
"""

OP7 = r"""
WITH RECURSIVE docs AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS w
  FROM documents
), shingled AS (
  -- Words hold no blank, so words put together with blanks are one shingle only.
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN []
    WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) END) AS t
  FROM docs
), sizes AS (
  SELECT docs.doc_id, count(t)::BIGINT AS n
  FROM docs LEFT JOIN shingled ON docs.doc_id = shingled.doc_id GROUP BY docs.doc_id
), numbered AS (
  SELECT doc_id, t FROM shingled
), linked AS (
  SELECT x.doc_id AS a, y.doc_id AS b
  FROM numbered x JOIN numbered y ON x.t = y.t AND x.doc_id < y.doc_id
  JOIN sizes m ON m.doc_id = x.doc_id JOIN sizes n ON n.doc_id = y.doc_id
  GROUP BY ALL HAVING 100 * count(*) >= 90 * (max(m.n) + max(n.n) - count(*))
), both_ways AS (
  SELECT a, b FROM linked UNION ALL SELECT b, a FROM linked
), reached(doc_id, other) AS (
  SELECT doc_id, doc_id FROM sizes
  UNION
  SELECT reached.doc_id, b FROM reached JOIN both_ways ON other = a
)
SELECT doc_id, any_value(n) AS n_shingles, min(other) AS component_id
FROM reached JOIN sizes USING (doc_id) GROUP BY doc_id
"""

OP9 = r"""
WITH docs AS (
  SELECT doc_id, source,
    len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
    md5('mix' || coalesce(doc_id::VARCHAR, '')) AS place
  FROM documents
), sizes AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM docs GROUP BY source
), weighed AS (
  SELECT *, 3 * source_size AS full_size,
    (row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % 3 + 1 AS weight
  FROM sizes
), ordered AS (
  SELECT *,
    (sum(source_size) OVER ())::DOUBLE - coalesce(sum(full_size) OVER before, 0)::DOUBLE AS words_left,
    (sum(weight) OVER ())::DOUBLE - coalesce(sum(weight) OVER before, 0)::DOUBLE AS weight_left
  FROM weighed
  WINDOW before AS (ORDER BY full_size / weight, encode(source) NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), judged AS (
  SELECT *, full_size <= words_left * weight / weight_left AS fills,
    row_number() OVER (ORDER BY full_size / weight, encode(source) NULLS LAST) AS nth
  FROM ordered
), first_open AS (
  SELECT min(nth) AS nth FROM judged WHERE NOT fills
), remains AS (
  SELECT words_left, weight_left FROM judged WHERE nth = (SELECT nth FROM first_open)
), targets AS (
  SELECT source, source_size,
    CASE WHEN nth < coalesce((SELECT nth FROM first_open), 9e9) THEN full_size::DOUBLE
      ELSE (SELECT words_left FROM remains) * weight / (SELECT weight_left FROM remains) END AS target
  FROM judged
), placed AS (
  SELECT d.doc_id, d.size, t.source_size, t.target, round_even(t.target, 0)::BIGINT AS quota,
    (sum(d.size) OVER (PARTITION BY d.source ORDER BY place, d.doc_id, d.size
       ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))::BIGINT AS reached
  FROM docs d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target,
  (size * (quota // greatest(source_size, 1))
    + greatest(0, least(size, quota % greatest(source_size, 1) - (reached - size))))::BIGINT AS taken
FROM placed
"""

OP11 = r"""
WITH ids AS (
  SELECT DISTINCT conv_id FROM conversations WHERE conv_id IS NOT NULL
), hashed AS (
  SELECT conv_id, xor(list_reduce(
    list_prepend(4294967295, list_transform(string_split(conv_id::VARCHAR, ''), lambda s: ascii(s)::BIGINT)),
    lambda crc, c: list_reduce(list_prepend(xor(crc, c), range(8)),
      lambda v, k: CASE WHEN v % 2 = 1 THEN xor(v // 2, 3988292384) ELSE v // 2 END)), 4294967295) % 4 AS h
  FROM ids
), known AS (
  SELECT conv_id, turn, md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS id,
    len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS words
  FROM conversations WHERE conv_id IS NOT NULL
), own AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, id) AS nth FROM known
), taken AS (
  SELECT h.conv_id, nth, id, words FROM hashed h JOIN own o ON o.conv_id = h.conv_id - h.conv_id % 20 AND nth <= h
  UNION ALL
  SELECT conv_id, nth, id, words FROM own JOIN hashed USING (conv_id) WHERE nth > h
), whole AS (
  SELECT ids.conv_id, coalesce(list(id ORDER BY nth) FILTER (id IS NOT NULL), []) AS line,
    coalesce(list(words ORDER BY nth) FILTER (id IS NOT NULL), []) AS words
  FROM ids LEFT JOIN taken USING (conv_id) GROUP BY ids.conv_id
), members AS (
  SELECT conv_id, d, array_to_string(line[1:d], ',') AS node,
    CASE WHEN d > 0 THEN array_to_string(line[1:d - 1], ',') END AS parent,
    CASE WHEN d > 0 THEN words[d] ELSE 0 END AS words, d = len(line) AS ends
  FROM (SELECT conv_id, line, words, unnest(range(len(line) + 1)) AS d FROM whole)
), nodes AS (
  SELECT node, d, any_value(parent) AS parent, min(conv_id) AS conv_id, count(*) AS n_convs,
    (count(*) - 1) * any_value(words) AS saved,
    sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256
  FROM members GROUP BY node, d
), children AS (
  SELECT parent AS node, count(*) AS n FROM nodes WHERE parent IS NOT NULL GROUP BY parent
), pairs AS (
  SELECT DISTINCT x.node AS top, y.node FROM members x JOIN members y ON x.conv_id = y.conv_id AND y.d >= x.d
), below AS (
  SELECT top, count(*) FILTER (children.n IS NULL) AS n_leaves, sum(saved)::BIGINT AS saved_tokens
  FROM pairs JOIN nodes USING (node) LEFT JOIN children USING (node) GROUP BY top
)
SELECT nodes.conv_id, nodes.d AS depth, p.conv_id AS parent_conv_id, nodes.n_convs,
  coalesce(children.n, 0) AS n_children, n_leaves, saved_tokens, nodes.ends_sha256
FROM nodes JOIN below ON below.top = nodes.node
LEFT JOIN children ON children.node = nodes.node LEFT JOIN nodes p ON p.node = nodes.parent
"""

OP12 = (
    OP7.replace("len(w) < 3", "len(w) < 5")
    .replace(
        "range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]",
        "range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')",
    )
    .replace(">= 90 *", ">= 85 *")
    .replace("min(other) AS component_id\n", "min(other) AS component_id, doc_id = min(other) AS kept\n")
)

OP13 = r"""
WITH docs AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents
), found AS (
  SELECT r, lang, source, unnest(terms) AS term FROM docs
), counts AS (
  SELECT lang, source, term, count(*) AS n, count(DISTINCT r) AS d FROM found GROUP BY ALL
), kept AS (
  SELECT lang, term, sum(n) AS total FROM counts GROUP BY lang, term HAVING sum(d) >= 30
), langs AS (
  SELECT lang, count(*) AS v, sum(total) AS n FROM kept GROUP BY lang
), parts AS (
  SELECT DISTINCT lang, source FROM docs
), sizes AS (
  SELECT p.lang, p.source, coalesce(sum(c.n), 0) AS n
  FROM parts p LEFT JOIN (SELECT * FROM counts SEMI JOIN kept USING (lang, term)) c USING (lang, source)
  GROUP BY p.lang, p.source
), shares AS (
  SELECT lang, source, term, coalesce(c.n, 0) AS n,
    1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 5)) // (s.n + 5 * l.v)::HUGEINT AS p,
    1 + (1000000000::HUGEINT * (total + 5)) // (l.n + 5 * l.v)::HUGEINT AS q
  FROM sizes s JOIN langs l USING (lang) JOIN kept USING (lang) LEFT JOIN counts c USING (lang, source, term)
), apart AS (
  SELECT lang, x.source, y.source AS item, sum(abs(x.p - y.p)) AS value
  FROM shares x JOIN shares y USING (lang, term) WHERE x.source <> y.source GROUP BY ALL
), pairs AS (
  SELECT x.lang, x.source, y.source AS item, coalesce(value, 0)::BIGINT AS value
  FROM parts x JOIN parts y ON x.lang = y.lang LEFT JOIN apart a
    ON a.lang = x.lang AND a.source = x.source AND a.item = y.source
  WHERE x.source <> y.source
), terms AS (
  SELECT lang, source, term AS item, (p - q)::BIGINT AS value FROM shares WHERE n > 0 AND p > q
), ranked AS (
  SELECT lang, source, 'pair' AS part, item, value FROM pairs
  UNION ALL
  SELECT lang, source, 'term', item, value FROM terms
)
SELECT *, (row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item)))::INTEGER AS rank
FROM ranked QUALIFY part = 'pair' OR rank <= 50
"""
