"""DuckDB SQL of the registered queries that SQL can express."""

from __future__ import annotations

#: A-Z to a-z only, as the queries do.
_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = "regexp_extract_all(coalesce(" + _LOWER.format("text") + r", ''), '[^\x20\x09-\x0D]+')"

OP3 = f"""
WITH RECURSIVE w AS (
  SELECT doc_id, {_WORDS} AS w FROM documents
), s AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN []
    WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i+4], ' '))) END AS s
  FROM w
), n AS (
  SELECT doc_id, len(s) AS n FROM s
), u AS (
  SELECT doc_id, unnest(s) AS g FROM s
), hit AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS k
  FROM u x JOIN u y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY 1, 2
), link AS (
  SELECT a, b FROM hit JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b
  WHERE 100 * k >= 75 * (na.n + nb.n - k)
), reach AS (
  SELECT doc_id AS a, doc_id AS b FROM documents
  UNION
  SELECT reach.a, link.b FROM reach JOIN link ON reach.b = link.a
)
SELECT n.doc_id, CAST(n.n AS BIGINT) AS n_shingles, min(reach.b) AS component_id
FROM n JOIN reach ON reach.a = n.doc_id GROUP BY 1, 2
"""

OP2 = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(length('<turn role="">' || '</turn>' || chr(10)) + length(role) + length(replace(replace(text, '\', '\\'), '<', '\l'))
    + length(role) - length(replace(replace(replace(role, '\', ''), '<', ''), '"', ''))) AS BIGINT) AS formatted_chars
FROM c GROUP BY conv_id
"""

OP9 = r"""
WITH l AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS li
  FROM documents WHERE text IS NOT NULL
), p AS (
  SELECT doc_id, li, line, coalesce(sum(length(line) + 1) OVER (PARTITION BY doc_id ORDER BY li
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS pos,
    regexp_extract_all(line, '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+') AS ws FROM l
), w AS (
  SELECT doc_id, li, pos, unnest(ws) AS raw, generate_subscripts(ws, 1) AS wi FROM p
), x AS (
  SELECT doc_id, li, wi, ltrim(raw, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS word,
    pos + sum(length(raw)) OVER (PARTITION BY doc_id, li ORDER BY wi) AS word_end FROM w
), y AS (
  SELECT *, coalesce(regexp_matches(lag(word) OVER d, '[.!?]$') OR lag(li) OVER d <> li, true) AS begins FROM x
  WINDOW d AS (PARTITION BY doc_id ORDER BY li, wi)
), z AS (
  SELECT *, sum(CAST(begins AS INTEGER)) OVER (PARTITION BY doc_id ORDER BY li, wi) AS u FROM y
), u AS (
  SELECT doc_id, u, count(*) AS n, min(word_end - length(word)) AS a,
    string_agg(translate(word, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), ' ' ORDER BY li, wi) AS norm
  FROM z GROUP BY 1, 2
), v AS (
  SELECT *, lead(norm) OVER d AS next_norm,
    coalesce(lead(a) OVER d, (SELECT length(text) FROM documents t WHERE t.doc_id = u.doc_id)) AS b
  FROM u WINDOW d AS (PARTITION BY doc_id ORDER BY u)
), f AS (
  SELECT *, next_norm IS NOT NULL AND min(doc_id) OVER (PARTITION BY norm, next_norm) < doc_id AS pair,
    n >= 40 AND min(doc_id) OVER (PARTITION BY norm) < doc_id AS alone FROM v
), g AS (
  SELECT *, coalesce(lag(pair) OVER d, false) AS after_pair FROM f WINDOW d AS (PARTITION BY doc_id ORDER BY u)
), h AS (
  SELECT *, sum(CASE WHEN after_pair THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id ORDER BY u) AS run FROM g
  WHERE pair OR after_pair OR alone
), r AS (
  SELECT doc_id, run, CAST(min(a) AS BIGINT) AS a, CAST(max(b) AS BIGINT) AS b FROM h GROUP BY 1, 2 HAVING sum(n) >= 40
), e AS (
  SELECT r.*, coalesce(lag(b) OVER (PARTITION BY r.doc_id ORDER BY a), 0) AS from_, text FROM r JOIN documents t ON t.doc_id = r.doc_id
), k AS (
  SELECT doc_id, count(*) AS n_removed, string_agg(a || '-' || b, ',' ORDER BY a) AS removed,
    string_agg(substr(text, from_ + 1, a - from_), '' ORDER BY a) || substr(any_value(text), CAST(max(b) AS BIGINT) + 1) AS kept
  FROM e GROUP BY doc_id
), o AS (
  SELECT d.doc_id, coalesce(n_removed, 0) AS n_removed, coalesce(removed, '') AS removed, CASE WHEN n_removed IS NULL THEN text ELSE kept END AS kept
  FROM documents d LEFT JOIN k ON k.doc_id = d.doc_id
)
SELECT doc_id, n_removed, removed, CAST(length(kept) AS BIGINT) AS kept_chars, sha256(kept) AS kept_sha256 FROM o
"""

OP6 = r"""
WITH d AS (
  SELECT doc_id, source, md5(concat('mix:', coalesce(CAST(doc_id AS VARCHAR), ''))) AS k,
    CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size
  FROM documents
), s AS (
  SELECT source, sum(size) AS source_size,
    1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS weight
  FROM d GROUP BY source
), r AS (
  SELECT *, CAST(source_size AS DOUBLE) / weight AS ratio,
    sum(source_size) OVER () AS all_size, sum(weight) OVER () AS all_weight
  FROM s
), c AS (
  SELECT *, all_size - coalesce(sum(3 * source_size) OVER b, 0) AS left_size,
    all_weight - coalesce(sum(weight) OVER b, 0) AS left_weight,
    row_number() OVER (ORDER BY ratio, source NULLS LAST) AS pos
  FROM r WINDOW b AS (ORDER BY ratio, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), f AS (
  SELECT pos, left_size, left_weight FROM c
  WHERE CAST(left_size AS DOUBLE) * weight / left_weight <= 3 * source_size ORDER BY pos LIMIT 1
), t AS (
  SELECT c.source, CAST(c.source_size AS BIGINT) AS source_size,
    CASE WHEN c.pos >= f.pos THEN CAST(f.left_size AS DOUBLE) * c.weight / f.left_weight
      ELSE CAST(3 * c.source_size AS DOUBLE) END AS target
  FROM c LEFT JOIN f ON true
), p AS (
  SELECT d.doc_id, d.size, t.source_size, t.target,
    CASE WHEN t.source_size = 0 THEN 0 ELSE CAST(floor(t.target) AS BIGINT) // t.source_size END AS epochs,
    coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.k, d.doc_id
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target,
  CAST(epochs * size + greatest(0, least(size, CAST(floor(target) AS BIGINT) - epochs * source_size - before)) AS BIGINT) AS taken
FROM p
"""

OP10 = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
    regexp_extract_all(coalesce(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), ''),
      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
), i AS (
  SELECT item_id, regexp_extract_all(coalesce(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), ''),
      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark
), iw AS (
  SELECT DISTINCT item_id, least(13, len(w)) AS n, array_to_string(w[j:j + least(13, len(w)) - 1], ' ') AS g
  FROM (SELECT item_id, w, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS j FROM i WHERE len(w) > 0)
), dw AS (
  SELECT r, x.n, p, array_to_string(w[p:p + x.n - 1], ' ') AS g
  FROM (SELECT r, w, n, unnest(range(1, CAST(len(w) - n + 2 AS BIGINT))) AS p
        FROM d, (SELECT DISTINCT n FROM iw) q WHERE len(w) >= n) x
), m AS (
  SELECT dw.r, dw.p, dw.n, iw.item_id FROM dw JOIN iw ON dw.g = iw.g AND dw.n = iw.n
), h AS (
  SELECT r, count(DISTINCT q) AS n_hit FROM (SELECT r, unnest(range(p, p + n)) AS q FROM m) GROUP BY r
), t AS (
  SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS item FROM m WHERE item_id IS NOT NULL) GROUP BY r
)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(h.n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(t.n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(t.items, '')) AS items_sha256,
  coalesce(h.n_hit, 0) > 0 AND 20 * coalesce(h.n_hit, 0) >= len(d.w) AS contaminated
FROM d LEFT JOIN h ON h.r = d.r LEFT JOIN t ON t.r = d.r
"""

OP11 = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w
  FROM documents
), u AS (
  SELECT r, lang, source, unnest(w) AS term FROM d
), k AS (
  SELECT lang, term, count(*) AS c FROM u GROUP BY 1, 2 HAVING count(DISTINCT r) >= 30
), t AS (
  SELECT lang, count(*) AS v, sum(c) AS n FROM k GROUP BY 1
), g AS (
  SELECT DISTINCT lang, source FROM d
), c AS (
  SELECT lang, source, term, count(*) AS c FROM u JOIN k USING (lang, term) GROUP BY 1, 2, 3
), n AS (
  SELECT g.lang, g.source, coalesce(sum(c), 0) AS n FROM g LEFT JOIN c USING (lang, source) GROUP BY 1, 2
), p AS (
  SELECT g.lang, g.source, k.term, coalesce(c.c, 0) AS c,
    1 + CAST(1000000000 AS HUGEINT) * (coalesce(c.c, 0) + 5) // (n.n + 5 * t.v) AS p,
    1 + CAST(1000000000 AS HUGEINT) * (k.c + 5) // (t.n + 5 * t.v) AS q
  FROM g JOIN k USING (lang) JOIN t USING (lang) JOIN n ON n.lang = g.lang AND n.source = g.source
  LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
), pair AS (
  SELECT a.lang, a.source, b.source AS item, coalesce(sum(abs(x.p - y.p)), 0) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN p x ON x.lang = a.lang AND x.source = a.source
  LEFT JOIN p y ON y.lang = b.lang AND y.source = b.source AND y.term = x.term
  GROUP BY 1, 2, 3
), f AS (
  SELECT lang, source, 'pair' AS part, item, value FROM pair
  UNION ALL SELECT lang, source, 'term', term, p - q FROM p WHERE c > 0 AND p > q
), r AS (
  SELECT lang, source, part, item, CAST(value AS BIGINT) AS value,
    CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
  FROM f
)
SELECT * FROM r WHERE part = 'pair' OR rank <= 50
"""

ORACLES = {
    "op2_chat_formatting": OP2,
    "op3_ngram_jaccard_join": OP3,
    "op6_source_mix": OP6,
    "op9_line_dedup": OP9,
    "op10_decontamination": OP10,
    "op11_source_divergence": OP11,
}
