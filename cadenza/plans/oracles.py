"""DuckDB SQL equal to each registered query (views: the driver tables)."""

from __future__ import annotations

from cadenza.fixed import FEED_RULES as RULE_ROWS
from cadenza.fixed import (DEFAULT_REQUEST, GENRE_LABELS, K_SWEEP, LINK_TERMS, PERMALINK_PREFIX,
                           TITLE_SEPARATOR, TRACK_LINK_PREFIX)
from cadenza.plans.standins import UNKNOWN_LABEL, FEED_SOURCES, FLAIR_BUCKETS, FLAIR_OTHER, RUN_DATE


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _sql_list(vals: list[str]) -> str:
    return "[" + ", ".join(_q(v) for v in vals) + "]" if vals else "CAST([] AS VARCHAR[])"


def rules_values(by_event_type: bool = True) -> str:
    """The feed rules as a VALUES CTE ``rules`` (keyed by the stand-in event type or by feed)."""
    key = {f: k for k, f in FEED_SOURCES.items()}
    rows = ",\n  ".join(
        f"({_q(key[feed] if by_event_type else feed)}, {o}, {_q(feed)}, "
        f"{_q(rule) if rule else 'NULL'}, {_sql_list(vals)}, {_sql_list(tags)}, "
        f"{_q(PERMALINK_PREFIX.format(feed=feed))})"
        for o, feed, rule, vals, tags in RULE_ROWS)
    return f"rules(source, ord, feed, flair_rule, flair_values, tags, prefix) AS (VALUES\n  {rows})"


def link_pred(col: str) -> str:
    return "(" + " OR ".join(f"contains({col}, {_q(t)})" for t in LINK_TERMS) + ")"


def link_term_case(col: str) -> str:
    return "CASE " + " ".join(f"WHEN contains({col}, {_q(t)}) THEN {_q(t)}" for t in LINK_TERMS) + " END"


def flair_case(k: str) -> str:
    whens = " ".join(f"WHEN {k} < {hi} THEN {_q(v) if v is not None else 'NULL'}" for hi, v in FLAIR_BUCKETS)
    return f"CASE {whens} ELSE {_q(FLAIR_OTHER)} END"


def labels_values() -> str:
    rows = ", ".join(f"({i}, {_q(x)})" for i, x in enumerate(GENRE_LABELS))
    return f"genre_vocab(ord, label) AS (VALUES {rows})"


def ratio_ctes(pairs_sql: str, name: str = "sim") -> str:
    """CTEs computing Ratcliff/Obershelp ratio(a, b) for the pairs of ``pairs_sql``.

    Recursion: each open range (alo, ahi, blo, bhi) finds its longest common
    block (longest, then earliest in a, then earliest in b) and opens the
    ranges left and right of it.  Exact for strings with len(b) < 200.
    Defines ``{name}(a, b, ratio)``; must sit inside ``WITH RECURSIVE``.
    """
    return f"""
{name}_src AS (
  SELECT row_number() OVER () AS pid, a, b FROM ({pairs_sql}) p
),
{name}_blk(pid, alo, ahi, blo, bhi, m, done) AS (
  SELECT pid, 0, length(a), 0, length(b), 0, false FROM {name}_src
  UNION ALL
  SELECT u.c.pid, u.c.alo, u.c.ahi, u.c.blo, u.c.bhi, u.c.m, u.c.done
  FROM (
    SELECT unnest(CASE WHEN q.best.nk = 0 THEN []
      ELSE [ {{'pid': q.pid, 'alo': q.alo, 'ahi': q.best.i, 'blo': q.blo, 'bhi': q.best.j, 'm': 0, 'done': false}},
             {{'pid': q.pid, 'alo': q.best.i - q.best.nk, 'ahi': q.ahi, 'blo': q.best.j - q.best.nk, 'bhi': q.bhi, 'm': 0, 'done': false}},
             {{'pid': q.pid, 'alo': 0, 'ahi': 0, 'blo': 0, 'bhi': 0, 'm': -q.best.nk, 'done': true}} ] END) AS c
    FROM (
      SELECT k.pid, k.alo, k.ahi, k.blo, k.bhi,
        list_min(list_transform(range(k.alo, k.ahi), lambda i:
          list_min(list_transform(range(k.blo, k.bhi), lambda j:
            {{'nk': -coalesce(list_position(list_transform(range(0, least(k.ahi - i, k.bhi - j)),
                        lambda t: substr(s.a, i + 1 + t, 1) = substr(s.b, j + 1 + t, 1)), false) - 1,
                      least(k.ahi - i, k.bhi - j)),
              'i': i, 'j': j}})))) AS best
      FROM {name}_blk k JOIN {name}_src s USING (pid)
      WHERE NOT k.done AND k.alo < k.ahi AND k.blo < k.bhi
    ) q
  ) u
),
{name} AS (
  SELECT s.a, s.b,
    CASE WHEN length(s.a) + length(s.b) = 0 THEN CAST(1.0 AS DOUBLE)
         ELSE CAST(2.0 AS DOUBLE) * coalesce(sum(k.m), 0) / (length(s.a) + length(s.b)) END AS ratio
  FROM {name}_src s LEFT JOIN {name}_blk k ON k.pid = s.pid AND k.done
  GROUP BY s.pid, s.a, s.b
)"""


def label_ctes(lists_sql: str) -> str:
    """CTEs giving ``list_label(genres, major_genre)`` for the distinct lists of ``lists_sql``."""
    return f"""{labels_values()},
lists AS (SELECT DISTINCT genres FROM ({lists_sql}) x WHERE genres IS NOT NULL),
toks AS (
  SELECT genres, t.pos, replace(t.tok, ' ', '') AS tok
  FROM (SELECT genres, unnest(list_transform(string_split(genres, ', '),
                 lambda x, i: {{'tok': x, 'pos': i}})) AS t FROM lists)
),
label_pairs AS (SELECT DISTINCT v.label AS a, t.tok AS b FROM toks t, genre_vocab v),
{ratio_ctes("SELECT a, b FROM label_pairs", "lsim")},
list_scores AS (
  SELECT t.genres, v.ord, v.label, sum(s.ratio) AS score
  FROM toks t JOIN genre_vocab v ON true JOIN lsim s ON s.a = v.label AND s.b = t.tok
  GROUP BY t.genres, v.ord, v.label
),
list_label AS (
  SELECT genres, label AS major_genre FROM (
    SELECT *, row_number() OVER (PARTITION BY genres ORDER BY score DESC, ord) AS rn
    FROM list_scores) WHERE rn = 1
)"""


#: A part's genre list; parts of size 46 or more have none.
_GENRES = "CASE WHEN p_size < 46 THEN replace(p_name, ' ', ', ') END"

LAKE_ROWS = f"""
  SELECT CAST(l_partkey AS VARCHAR) AS track_id, {_GENRES} AS genres,
         CAST(l_quantity AS INTEGER) AS track_popularity, l_discount AS danceability,
         l_tax AS energy, 1.0 - l_discount AS valence, -l_quantity / 5.0 AS loudness
  FROM lineitem JOIN part ON l_partkey = p_partkey"""

_Y, _M, _D = RUN_DATE[:4], RUN_DATE[5:7], RUN_DATE[8:10]

GENRE_REPORT = f"""
WITH RECURSIVE lake AS ({LAKE_ROWS}),
{label_ctes("SELECT genres FROM lake")}
SELECT b.major_genre AS Genre, COUNT(*) AS NumberOfSongs,
       CAST(FLOOR(AVG(track_popularity)) AS BIGINT) AS Popularity,
       ROUND(AVG(danceability), 3) AS Danceability, ROUND(AVG(energy), 3) AS Energy,
       ROUND(AVG(valence), 3) AS Valence, ROUND(AVG(loudness), 3) AS Loudness,
       '{_Y}' AS year, '{_M}' AS month, '{_D}' AS day
FROM lake l LEFT JOIN list_label b ON l.genres = b.genres
GROUP BY b.major_genre"""

LABEL_CLASSIFY = f"""
WITH RECURSIVE p AS (SELECT p_partkey, {_GENRES} AS genres FROM part),
{label_ctes("SELECT genres FROM p")}
SELECT p.p_partkey, p.genres, b.major_genre FROM p LEFT JOIN list_label b ON p.genres = b.genres"""

SIMILARITY_RATIO = f"""
WITH RECURSIVE {labels_values()},
pairs AS (SELECT v.label AS a, n.p_name AS b FROM genre_vocab v, (SELECT DISTINCT p_name FROM part) n),
{ratio_ctes("SELECT a, b FROM pairs")}
SELECT a, b, ratio FROM sim"""


TITLE_CLEAN = r"""
WITH t AS (
  SELECT p_partkey, p_name || ' - ' || p_brand || ' [' || p_type || '] (' || CAST(p_size AS VARCHAR) || ')' AS title
  FROM part),
c AS (
  SELECT p_partkey, title, position(' - ' IN title) AS s, position('(' IN title) AS p1,
         position('[' IN title) AS p2
  FROM t WHERE contains(title, ' - ')),
d AS (
  SELECT p_partkey, title,
    CASE WHEN least(CASE WHEN p1 > s THEN p1 END, CASE WHEN p2 > s THEN p2 END) IS NULL THEN title
         ELSE substr(title, 1, least(CASE WHEN p1 > s THEN p1 END, CASE WHEN p2 > s THEN p2 END) - 1)
    END AS truncated
  FROM c)
SELECT p_partkey, title, truncated,
  trim(string_split(truncated, ' - ')[1]) AS part0,
  trim(string_split(truncated, ' - ')[2]) AS part1,
  regexp_replace(truncated, '[^\p{L}\p{N}]+', ' ', 'g') AS search_text
FROM d"""

# '&amp;' is parked on a placeholder first so its output is never read again;
# entity names that HTML5 also accepts without ';' are then resolved in that form.
HTML_UNESCAPE = """
SELECT page_id,
  replace(replace(replace(replace(replace(
    replace(replace(replace(replace(html, '&amp;', chr(1)),
      '&middot;', chr(183)), '&copy;', chr(169)), '&quot;', '"'),
    '&middot', chr(183)), '&copy', chr(169)), '&quot', '"'), '&amp', '&'), chr(1), '&') AS text
FROM pages"""

LINK_FILTER = f"""
SELECT page_id, url, coalesce({link_pred("url")}, false) AS is_media_link,
  {link_term_case("url")} AS link_term
FROM pages"""

FEED_RULES_VALUES = rules_values(by_event_type=True)

FEED_POSTS = f"""posts AS (
  SELECT event_type AS source, CAST(event_id AS VARCHAR) AS post_id, event_id, ts,
    strftime(ts, '%Y-%m-%d %H:%M:%S') AS created_utc,
    date_trunc('second', ts) AS created,
    {flair_case("k")} AS flair
  FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events)
  WHERE event_type IN ({", ".join(_q(x) for x in FEED_SOURCES)}))"""

FLAIR_PASSES = """(CASE WHEN r.flair_rule IS NULL THEN true
       WHEN r.flair_rule = 'ne' THEN p.flair IS DISTINCT FROM r.flair_values[1]
       WHEN r.flair_rule = 'in' THEN coalesce(list_contains(r.flair_values, p.flair), false)
       WHEN r.flair_rule = 'nin' THEN NOT coalesce(list_contains(r.flair_values, p.flair), false)
       ELSE false END)"""

FEED_RULES = f"""
WITH {FEED_RULES_VALUES}, {FEED_POSTS}
SELECT p.post_id, r.feed, p.flair, r.prefix || p.post_id AS post_url
FROM posts p JOIN rules r ON p.source = r.source
WHERE {FLAIR_PASSES}"""

HISTORY = f"""history AS (
  SELECT event_type AS source, date_trunc('day', ts) - INTERVAL 3 DAY AS last_time, ts AS committed_at
  FROM events WHERE event_type IN ({", ".join(_q(k) for k, f in FEED_SOURCES.items() if f != "electronicmusic")}))"""

LATEST = """latest AS (
  SELECT source, last_time, committed_at FROM (
    SELECT *, row_number() OVER (PARTITION BY source ORDER BY last_time DESC, committed_at DESC) AS rn
    FROM history) WHERE rn = 1)"""

MARKS = f"""marks AS (
  SELECT r.source, coalesce(l.last_time, TIMESTAMP '{RUN_DATE} 00:00:00') AS last_time
  FROM rules r LEFT JOIN latest l ON r.source = l.source)"""

NEWER = """newer AS (
  SELECT * FROM (
    SELECT p.*, m.last_time,
      min(CASE WHEN p.created > m.last_time THEN 1 ELSE 0 END) OVER (
        PARTITION BY p.source ORDER BY p.ts DESC, p.event_id
        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS ok
    FROM posts p JOIN marks m ON p.source = m.source) WHERE ok = 1)"""

FEED_TAKEWHILE = f"""
WITH {FEED_RULES_VALUES}, {FEED_POSTS}, {HISTORY}, {LATEST}, {MARKS}, {NEWER}
SELECT source, post_id, created_utc FROM newer"""

FEED_NEWEST = f"""
WITH {FEED_POSTS}
SELECT source, post_id, created_utc FROM (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY created DESC, post_id) AS rn FROM posts)
WHERE rn <= 100"""

WATERMARK_ADVANCE = f"""
WITH {FEED_RULES_VALUES}, {FEED_POSTS}, {HISTORY}, {LATEST}, {MARKS}, {NEWER},
accepted AS (SELECT p.* FROM newer p JOIN rules r ON p.source = r.source WHERE {FLAIR_PASSES}),
firsts AS (
  SELECT source, created AS new_time FROM (
    SELECT *, row_number() OVER (PARTITION BY source ORDER BY ts DESC, event_id) AS rn FROM accepted)
  WHERE rn = 1)
SELECT m.source, m.last_time, coalesce(f.new_time, m.last_time) AS new_time
FROM marks m LEFT JOIN firsts f ON m.source = f.source"""

RUN_STATE_LATEST = f"""
WITH {HISTORY}, {LATEST}
SELECT source, last_time, committed_at FROM latest"""


def clean_sql(src: str) -> str:
    """Title cleaning (F6, N3, N4, N5) over ``src`` with a ``title`` column."""
    return f"""(
  SELECT *, trim(string_split(truncated, ' - ')[1]) AS part0,
         trim(string_split(truncated, ' - ')[2]) AS part1,
         regexp_replace(truncated, '[^\\p{{L}}\\p{{N}}]+', ' ', 'g') AS search_text
  FROM (
    SELECT *, CASE WHEN cut IS NULL THEN title ELSE substr(title, 1, cut - 1) END AS truncated
    FROM (
      SELECT *, least(CASE WHEN position('(' IN title) > position(' - ' IN title) THEN position('(' IN title) END,
                      CASE WHEN position('[' IN title) > position(' - ' IN title) THEN position('[' IN title) END) AS cut
      FROM ({src}) WHERE contains(title, ' - '))))"""


PART_POSTS = """
  SELECT p_partkey AS post_id, p_name || ' - ' || p_brand || ' (' || p_type || ')' AS title,
    CASE p_type WHEN 'ECONOMY' THEN 1 WHEN 'PROMO' THEN 1 WHEN 'SMALL' THEN 2 WHEN 'MEDIUM' THEN 2
                WHEN 'STANDARD' THEN 3 WHEN 'LARGE' THEN 4 END AS ord, p_partkey AS pos
  FROM part"""

TITLE_DEDUP_KEYS = f"""
WITH c AS {clean_sql(PART_POSTS)},
t AS (SELECT *, row_number() OVER (PARTITION BY title ORDER BY ord, pos) AS occ FROM c),
r AS (SELECT *, (ord > 1 AND occ > 1) AS is_repeat FROM t),
n AS (SELECT post_id, row_number() OVER (ORDER BY ord, pos) AS n FROM r WHERE is_repeat)
SELECT r.post_id, r.title, r.ord, r.is_repeat, coalesce(n.n, 0) AS repeat_no
FROM r LEFT JOIN n ON r.post_id = n.post_id"""

ENTITY_MATCH = f"""
WITH RECURSIVE c AS {clean_sql(PART_POSTS)},
v AS (SELECT title, part0, part1 FROM (
        SELECT *, row_number() OVER (PARTITION BY title ORDER BY ord, pos) AS rn FROM c) WHERE rn = 1),
posts AS (SELECT c.post_id, c.title, c.part1 AS block, v.part0, v.part1 FROM c JOIN v ON c.title = v.title),
cat AS (SELECT p_partkey AS track_id, p_name AS track_name, p_brand AS artists_name, p_brand AS block FROM part),
names AS (SELECT DISTINCT block, track_name, unnest(regexp_extract_all(lower(track_name), '[^ ]+')) AS token FROM cat),
asked AS (SELECT DISTINCT block, part0, unnest(regexp_extract_all(lower(part0), '[^ ]+')) AS token FROM posts),
near AS (SELECT asked.block, part0, track_name, count(*) AS shared
         FROM asked JOIN names ON asked.block = names.block AND asked.token = names.token GROUP BY ALL),
ranked AS (SELECT near.block, part0, near.track_name, track_id, artists_name,
             row_number() OVER (PARTITION BY near.block, part0 ORDER BY shared DESC,
               len(list_distinct(regexp_extract_all(lower(near.track_name), '[^ ]+'))), track_id) AS cand_rank
           FROM near JOIN cat ON cat.block = near.block AND cat.track_name = near.track_name),
cands AS (SELECT p.*, s.track_id, s.track_name, s.artists_name, s.cand_rank
          FROM posts p JOIN ranked s ON p.block = s.block AND p.part0 = s.part0 WHERE s.cand_rank <= 10),
pairs AS (
  SELECT DISTINCT a, b FROM (
    SELECT track_name AS a, part0 AS b FROM cands UNION ALL SELECT track_name, part1 FROM cands
    UNION ALL SELECT artists_name, part0 FROM cands UNION ALL SELECT artists_name, part1 FROM cands)
  WHERE a IS NOT NULL AND b IS NOT NULL),
{ratio_ctes("SELECT a, b FROM pairs")},
scored AS (
  SELECT c.*,
    CASE WHEN t1.ratio > 0.7 THEN t1.ratio WHEN t0.ratio > 0.7 THEN t0.ratio ELSE 0.0 END AS track_score,
    CASE WHEN a1.ratio > 0.7 THEN a1.ratio WHEN a0.ratio > 0.7 THEN a0.ratio ELSE 0.0 END AS artist_score
  FROM cands c
  LEFT JOIN sim t0 ON t0.a = c.track_name AND t0.b = c.part0
  LEFT JOIN sim t1 ON t1.a = c.track_name AND t1.b = c.part1
  LEFT JOIN sim a0 ON a0.a = c.artists_name AND a0.b = c.part0
  LEFT JOIN sim a1 ON a1.a = c.artists_name AND a1.b = c.part1)
SELECT post_id, title, track_id, track_name, artists_name, CAST(cand_rank AS INTEGER) AS cand_rank,
       track_score, artist_score FROM (
  SELECT *, row_number() OVER (PARTITION BY post_id ORDER BY cand_rank) AS rn
  FROM scored WHERE track_score + artist_score >= 1.4) WHERE rn = 1"""

LAKE_MANY_DAYS = """
SELECT o_orderkey, o_custkey, o_orderdate, CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month,
  CAST(1 AS INTEGER) AS day
FROM orders WHERE date_trunc('month', o_orderdate) >= DATE '1996-01-01' AND date_trunc('month', o_orderdate) < DATE '1996-07-01'"""

QUARTILES_FROM_SKETCHES = """
SELECT l_returnflag, feature, CAST(i AS INTEGER) AS quartile, count(*) AS n, true AS within_error
FROM lineitem, (SELECT unnest(['danceability', 'energy', 'loudness', 'instrumentalness', 'valence']) AS feature),
  (SELECT unnest(range(5)) AS i)
GROUP BY ALL"""

LANDED_QUARANTINE = """
SELECT event_id AS line, CASE WHEN event_type = 'error' OR value < 1 THEN 'bad' ELSE 'good' END AS status,
  CASE WHEN value < 1 THEN 'row: not a JSON object' WHEN event_type = 'error' THEN 'value: not double: "n/a"' END AS reason,
  CASE WHEN event_type <> 'error' AND value >= 1 THEN event_type END AS event_type,
  CASE WHEN event_type <> 'error' AND value >= 1 THEN value END AS amount,
  CASE WHEN event_type = 'click' AND value >= 1 THEN 'props' END AS unknown
FROM events"""

HANDOVER_QUARANTINE = """
SELECT s_suppkey, CASE WHEN s_acctbal < 0 OR s_nationkey IN (3, 4) THEN 'bad' ELSE 'good' END AS status,
  CASE WHEN s_nationkey IN (3, 4) THEN 'row: not 4 fields' WHEN s_acctbal < 0 THEN 's_acctbal: not double: debt' END AS reason,
  CASE WHEN s_acctbal >= 0 AND s_nationkey NOT IN (3, 4) THEN s_acctbal END AS s_acctbal
FROM supplier"""

REPORT_INCREMENTAL = f"""
WITH RECURSIVE lake AS (
  SELECT CASE l_returnflag WHEN 'A' THEN '13' WHEN 'N' THEN '14' ELSE '15' END AS day, {_GENRES} AS genres,
         CAST(l_quantity AS INTEGER) AS track_popularity, l_discount AS danceability,
         l_tax AS energy, 1.0 - l_discount AS valence, -l_quantity / 5.0 AS loudness
  FROM lineitem JOIN part ON l_partkey = p_partkey),
{label_ctes("SELECT genres FROM lake")}
SELECT b.major_genre AS Genre, COUNT(*) AS NumberOfSongs, CAST(FLOOR(AVG(track_popularity)) AS BIGINT) AS Popularity,
       ROUND(ROUND(AVG(danceability), 9), 3) AS Danceability, ROUND(ROUND(AVG(energy), 9), 3) AS Energy,
       ROUND(ROUND(AVG(valence), 9), 3) AS Valence, ROUND(ROUND(AVG(loudness), 9), 3) AS Loudness, '2024' AS year, '01' AS month, day
FROM lake l LEFT JOIN list_label b ON l.genres = b.genres
GROUP BY b.major_genre, day"""

STREAM_TAKEWHILE = f"""
WITH {FEED_RULES_VALUES}, {FEED_POSTS}, {HISTORY}, {LATEST}, {MARKS}
SELECT source, post_id, created_utc FROM (
  SELECT p.*, min(CASE WHEN p.created > m.last_time THEN 1 ELSE 0 END) OVER (
    PARTITION BY p.source, p.event_id // 100 ORDER BY md5(p.post_id), p.event_id
    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS ok
  FROM posts p JOIN marks m ON p.source = m.source) WHERE ok = 1"""

#: A part name as a listener misspells it: the third character goes, the fifth is doubled, blanks become dashes.
MISSPELT = "replace(substr(p_name, 1, 2) || substr(p_name, 4, 2) || substr(p_name, 5), ' ', '-')"

FUZZY_CANDIDATES = f"""
WITH t AS (SELECT DISTINCT p_brand AS block, lower({MISSPELT}) AS asked FROM part),
n AS (SELECT DISTINCT p_brand AS block, lower(p_name) AS track_name FROM part),
d AS (SELECT block, asked, track_name, levenshtein(asked, track_name) AS distance FROM t JOIN n USING (block))
SELECT block, asked, track_name, CAST(distance AS INTEGER) AS distance FROM d
WHERE distance <= CAST(floor(0.3 * greatest(length(asked), length(track_name)) + 1e-9) AS INTEGER)"""

ARTIST_GENRES = """
WITH a AS (
  SELECT s_suppkey, s_name, [lower(n_name), lower(r_name)] AS genres
  FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
ta AS (SELECT l_orderkey AS track_id, l_linenumber AS pos, l_suppkey AS artist_id FROM lineitem)
SELECT track_id,
  string_agg(CAST(artist_id AS VARCHAR), ', ' ORDER BY pos, artist_id) AS artists_id,
  string_agg(replace(s_name, ',', ' '), ', ' ORDER BY pos, artist_id) AS artists_name,
  array_to_string(flatten(list(coalesce(genres, []) ORDER BY pos, artist_id)), ', ') AS genres
FROM ta LEFT JOIN a ON artist_id = s_suppkey
GROUP BY track_id"""

ENRICH_DEDUPE = """
SELECT c_custkey, c_name, s_suppkey, s_acctbal FROM (
  SELECT c.c_custkey, c.c_name, s.s_suppkey, s.s_acctbal,
         row_number() OVER (PARTITION BY c.c_custkey ORDER BY s.s_suppkey) AS rn
  FROM customer c LEFT JOIN supplier s
    ON c.c_nationkey = s.s_nationkey) WHERE rn = 1"""


CSV_ROUNDTRIP = """
SELECT s_suppkey, s_name, CAST(s_nationkey AS VARCHAR) AS s_nationkey, s_acctbal,
  ' ' || s_name || ' - "B, C"' || chr(10) || chr(92) || ' x ' AS s_title FROM supplier"""

LAKE_PARTITION_ROUNDTRIP = """
SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate,
       CAST(1996 AS INTEGER) AS year, CAST(1 AS INTEGER) AS month, CAST(1 AS INTEGER) AS day
FROM orders WHERE date_trunc('month', o_orderdate) = TIMESTAMP '1996-01-01'"""

NA_DROP = """
SELECT event_id, ts, event_type, value FROM (
  SELECT event_id, ts, nullif(event_type, 'error') AS event_type,
         CASE WHEN value < 1 THEN CAST('NaN' AS DOUBLE) ELSE value END AS value FROM events)
WHERE event_id IS NOT NULL AND ts IS NOT NULL AND event_type IS NOT NULL
  AND value IS NOT NULL AND NOT isnan(value)"""


LI_FEATURES = """li AS (
  SELECT l_orderkey, l_linenumber, l_returnflag, l_discount AS danceability, l_tax AS energy,
         -l_quantity / 5.0 AS loudness, l_discount * l_tax AS instrumentalness,
         1.0 - l_discount AS valence FROM lineitem)"""

_F = ["danceability", "energy", "loudness", "instrumentalness", "valence"]

SCALED_FEATURES = f"""
WITH {LI_FEATURES},
sd AS (SELECT {", ".join(f"stddev_samp({f}) AS sd_{f}" for f in _F)} FROM li)
SELECT l_orderkey, l_linenumber,
  {", ".join(f"round({f} * (1.0 / sd_{f}), 6) AS s_{f}" for f in _F)}
FROM li, sd"""

EMB = """e AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
u AS (SELECT vec_id, label, unnest(range(1, len(v) + 1)) AS i, unnest(v) AS x FROM e),
cen AS (SELECT label AS ci, i, avg(x) AS m FROM u GROUP BY label, i)"""

CLUSTER_ASSIGN = f"""
WITH {EMB},
d AS (SELECT u.vec_id, u.label, c.ci, sum((u.x - c.m) * (u.x - c.m)) AS dist
      FROM u JOIN cen c ON u.i = c.i GROUP BY u.vec_id, u.label, c.ci)
SELECT vec_id, label, ci AS cluster, round(dist, 6) AS distance FROM (
  SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY dist, ci) AS rn FROM d) WHERE rn = 1"""

SILHOUETTE = """
WITH e AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
n AS (SELECT label, count(*) AS cnt FROM e GROUP BY label),
d AS (
  SELECT a.vec_id, a.label AS la, b.label AS lb,
         list_sum(list_transform(range(1, len(a.v) + 1), lambda k: (a.v[k] - b.v[k]) * (a.v[k] - b.v[k]))) AS dist
  FROM e a JOIN e b ON a.vec_id <> b.vec_id),
per AS (
  SELECT d.vec_id, d.la, d.lb, sum(dist) AS s FROM d GROUP BY d.vec_id, d.la, d.lb),
ab AS (
  SELECT p.vec_id, p.la, na.cnt AS n_own,
    max(CASE WHEN p.lb = p.la THEN p.s / (na.cnt - 1) END) AS a,
    min(CASE WHEN p.lb <> p.la THEN p.s / nb.cnt END) AS b
  FROM per p JOIN n na ON na.label = p.la JOIN n nb ON nb.label = p.lb
  GROUP BY p.vec_id, p.la, na.cnt),
s AS (SELECT CASE WHEN n_own = 1 OR a IS NULL THEN 0.0 WHEN a < b THEN 1 - a / b
                  WHEN a > b THEN b / a - 1 ELSE 0.0 END AS s FROM ab)
SELECT round(avg(s), 9) AS silhouette FROM s"""

ELBOW_COST = f"""
WITH {EMB}
SELECT round(sum((u.x - c.m) * (u.x - c.m)), 4) AS cost FROM u JOIN cen c ON u.i = c.i AND u.label = c.ci"""

CLUSTER_QUARTILES = f"""
WITH {LI_FEATURES}
SELECT l_returnflag,
  {", ".join(f"round(min({f}), 9) AS {f}_min, round(quantile_cont({f}, 0.25), 9) AS {f}_q1, "
             f"round(quantile_cont({f}, 0.5), 9) AS {f}_median, "
             f"round(quantile_cont({f}, 0.75), 9) AS {f}_q3, round(max({f}), 9) AS {f}_max" for f in _F)}
FROM li GROUP BY l_returnflag"""


def _pref_sql() -> str:
    from cadenza.fixed import PREFERENCE_BUCKETS
    cols = ["c_custkey AS request_id"]
    vals = []
    for i, (dim, buckets) in enumerate(PREFERENCE_BUCKETS.items()):
        names = [b[0] for b in buckets] + ["", UNKNOWN_LABEL]
        lst = "[" + ", ".join(_q(x) for x in names) + "]"
        cols.append(f"{lst}[((c_custkey * {2 * i + 3} + c_nationkey) % {len(names)}) + 1] AS {dim}_label")
        case = " ".join(f"WHEN {dim}_label = {_q(n)} THEN CAST({(lo + hi) / 2.0!r} AS DOUBLE)"
                        for n, lo, hi in buckets)
        vals.append(f"CASE WHEN {dim}_label = '' THEN CAST(0.5 AS DOUBLE) {case} END AS {dim}")
    return (f"(SELECT *, {', '.join(vals)} FROM (SELECT {', '.join(cols)} FROM customer))")


PREFERENCE_BUCKETS_SQL = f"SELECT * FROM {_pref_sql()}"


def _uniform_sql(seed: int) -> str:
    from cadenza.fixed import PREFERENCE_BUCKETS
    vals = []
    for i, (dim, buckets) in enumerate(PREFERENCE_BUCKETS.items()):
        draw = f"(('0x' || substr(md5('{seed + i}|{dim}|' || request_id), 1, 13))::BIGINT::DOUBLE / {1 << 52}.0)"
        case = " ".join(f"WHEN {dim}_label = {_q(n)} THEN {lo!r}::DOUBLE + {draw} * {hi - lo!r}::DOUBLE" for n, lo, hi in buckets)
        vals.append(f"round(CASE WHEN {dim}_label = '' THEN 0.5::DOUBLE {case} END, 9) AS {dim}")
    return f"SELECT request_id, {', '.join(vals)} FROM {_pref_sql()}"


# What must hold of the fitted models, whatever their centres.
KMEANS_FIT_CHECKS = """
SELECT 5 AS k, count(*) AS n_rows, 5::BIGINT AS clusters_used, count(*) AS rows_at_nearest, true AS cost_not_above_training
FROM embeddings"""

K_SWEEP_CHECKS = f"""
WITH e AS (SELECT CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
u AS (SELECT unnest(range(1, len(v) + 1)) AS i, unnest(v) AS x FROM e),
m AS (SELECT i, avg(x) AS m FROM u GROUP BY i),
t AS (SELECT round(sum((x - m) * (x - m)), 4) AS total_cost FROM u JOIN m USING (i))
SELECT unnest({list(K_SWEEP)!r})::INTEGER AS k, total_cost, true AS silhouette_in_range, true AS cost_below_total FROM t"""

RECOMMEND_KMEANS_CHECKS = """
SELECT c_custkey AS request_id, 5::BIGINT AS picks, 5::BIGINT AS of_own_cluster, 5::BIGINT AS in_top, true AS in_order
FROM customer"""

_TRACKS = f"""tracks AS (
  SELECT p_partkey AS track_id, p_name AS track_name, p_brand AS artists_name,
    CAST(2000 + p_size AS VARCHAR) AS release_date, {_GENRES} AS genres,
    p_size AS track_popularity,
    CAST(trunc(p_retailprice * 100) AS INTEGER) AS duration_ms, p_type,
    p_size / 50.0 AS danceability, (p_retailprice - 900.0) / 1100.0 AS energy,
    CAST(-length(p_name) AS DOUBLE) AS loudness, length(p_type) / 10.0 AS instrumentalness,
    1.0 - (p_retailprice - 900.0) / 1100.0 AS valence FROM part)"""

_DIST = " + ".join(f"(x.s_{f} - c.c_{f}) * (x.s_{f} - c.c_{f})" for f in _F)

RECOMMEND_TOPN = f"""
WITH RECURSIVE {_TRACKS},
{label_ctes("SELECT genres FROM tracks")},
sd AS (SELECT {", ".join(f"stddev_samp({f}) AS sd_{f}" for f in _F)} FROM tracks),
st AS (SELECT t.*, {", ".join(f"{f} * (1.0 / sd_{f}) AS s_{f}" for f in _F)} FROM tracks t, sd),
cen AS (SELECT row_number() OVER (ORDER BY p_type) - 1 AS ci,
          {", ".join(f"avg(s_{f}) AS c_{f}" for f in _F)} FROM st GROUP BY p_type),
tc AS (SELECT * FROM (SELECT x.*, c.ci AS prediction,
          row_number() OVER (PARTITION BY x.track_id ORDER BY {_DIST}, c.ci) AS rn
        FROM st x, cen c) WHERE rn = 1),
req AS (SELECT r.request_id, {", ".join(f"coalesce(r.{f}, {DEFAULT_REQUEST[f]!r}) * (1.0 / sd_{f}) AS s_{f}" for f in _F)}
        FROM {_pref_sql()} r, sd),
rc AS (SELECT * FROM (SELECT x.request_id, c.ci AS prediction,
          row_number() OVER (PARTITION BY x.request_id ORDER BY {_DIST}, c.ci) AS rn
        FROM req x, cen c) WHERE rn = 1),
top AS (SELECT * FROM (SELECT tc.*, row_number() OVER (PARTITION BY prediction
          ORDER BY track_popularity DESC, track_id) AS cluster_rank FROM tc) WHERE cluster_rank <= 10),
pick AS (SELECT * FROM (
          SELECT rc.request_id, t.*, row_number() OVER (PARTITION BY rc.request_id
            ORDER BY md5(CAST(rc.request_id AS VARCHAR) || '|' || CAST(t.track_id AS VARCHAR)), t.track_id) AS k
          FROM rc JOIN top t ON rc.prediction = t.prediction) WHERE k <= 5)
SELECT request_id,
  CAST(row_number() OVER (PARTITION BY request_id ORDER BY track_popularity DESC, track_id) AS INTEGER) AS position,
  artists_name, track_id, track_name, release_date, g.major_genre, track_popularity,
  duration_ms / 1000 AS duration_s,
  {_q(TRACK_LINK_PREFIX)} || CAST(track_id AS VARCHAR) AS track_url
FROM pick LEFT JOIN list_label g ON pick.genres = g.genres"""


EXTRACT_TO_LAKE = f"""
WITH RECURSIVE {rules_values(by_event_type=False)},
parts AS (
  SELECT *, CASE p_type WHEN 'ECONOMY' THEN 1 WHEN 'PROMO' THEN 1 WHEN 'SMALL' THEN 2 WHEN 'MEDIUM' THEN 2
                        WHEN 'STANDARD' THEN 3 WHEN 'LARGE' THEN 4 END AS ord FROM part),
raw AS (
  SELECT CASE ord WHEN 1 THEN 'Music' WHEN 2 THEN 'indieheads' WHEN 3 THEN 'popheads' ELSE 'electronicmusic' END AS source,
    ord, p_partkey, p_brand, 'p' || CAST(p_partkey AS VARCHAR) AS post_id,
    CASE WHEN ord = 2 THEN '[FRESH] ' || nm || sep || p_brand || ' [' || p_type || ']'
         ELSE nm || sep || p_brand || ' (' || p_type || ')' END AS raw_title,
    CASE WHEN p_size <= 40 THEN 'https://youtu.be/' ELSE 'https://example.com/' END || 'p' || CAST(p_partkey AS VARCHAR) AS url,
    TIMESTAMP '{RUN_DATE} 00:00:00' + to_seconds((p_size - 25) * 3600 + p_partkey) AS created,
    CASE WHEN p_size = 1 THEN 'i made this' WHEN p_size <= 30 THEN '[FRESH]' WHEN p_size <= 32 THEN 'Discussion' END AS flair
  FROM (SELECT *, CASE WHEN ord = 1 THEN replace(p_name, ' ', ' &amp; ') ELSE p_name END AS nm,
               CASE WHEN p_size = 50 THEN ' ' ELSE ' - ' END AS sep FROM parts)),
acc AS (
  SELECT p.*, r.tags, r.prefix, replace(p.raw_title, '&amp;', '&') AS post_title
  FROM raw p JOIN rules r ON p.source = r.source
  WHERE p.created > TIMESTAMP '{RUN_DATE} 00:00:00' AND {FLAIR_PASSES} AND {link_pred("p.url")}),
tagged AS (
  SELECT *, list_reduce(list_prepend(post_title, tags), lambda acc, t: replace(acc, t, '')) AS title
  FROM acc WHERE contains(post_title, {_q(TITLE_SEPARATOR)})),
c AS {clean_sql("SELECT * FROM tagged")},
v AS (SELECT post_title, part0 AS v0, part1 AS v1 FROM (
        SELECT *, row_number() OVER (PARTITION BY post_title ORDER BY ord, created DESC, post_id) AS rn FROM c)
      WHERE rn = 1),
posts AS (SELECT c.*, v.v0, v.v1 FROM c JOIN v ON c.post_title = v.post_title),
bwords AS (SELECT p_brand, string_agg(DISTINCT w, ', ' ORDER BY w) AS bg
           FROM (SELECT p_brand, unnest(string_split(p_name, ' ')) AS w FROM part) GROUP BY p_brand),
short AS (
  SELECT * FROM (
    SELECT p.p_brand, 't' || CAST(p.p_partkey AS VARCHAR) AS track_id, p.p_name AS track_name,
      p.p_size AS track_popularity, CAST(1990 + p.p_size AS VARCHAR) AS release_date,
      'a-' || p.p_brand || CASE WHEN p.p_size > 45 THEN ', a-guest' ELSE '' END AS artists_id,
      p.p_brand || CASE WHEN p.p_size > 45 THEN ', Guest  Jr' ELSE '' END AS artists_name,
      b.bg || CASE WHEN p.p_size > 45 THEN ', indie rock' ELSE '' END AS genres,
      row_number() OVER (PARTITION BY p.p_brand ORDER BY p.p_partkey) AS cand_rank
    FROM part p JOIN bwords b ON p.p_brand = b.p_brand) WHERE cand_rank <= 10),
cands AS (SELECT p.*, s.track_id, s.track_name, s.track_popularity, s.release_date, s.artists_id,
                 s.artists_name, s.genres, s.cand_rank
          FROM posts p JOIN short s ON p.p_brand = s.p_brand),
pairs AS (
  SELECT DISTINCT a, b FROM (
    SELECT track_name AS a, v0 AS b FROM cands UNION ALL SELECT track_name, v1 FROM cands
    UNION ALL SELECT artists_name, v0 FROM cands UNION ALL SELECT artists_name, v1 FROM cands)
  WHERE a IS NOT NULL AND b IS NOT NULL),
{ratio_ctes("SELECT a, b FROM pairs")},
scored AS (
  SELECT c.*,
    CASE WHEN t1.ratio > 0.7 THEN t1.ratio WHEN t0.ratio > 0.7 THEN t0.ratio ELSE 0.0 END AS ts,
    CASE WHEN a1.ratio > 0.7 THEN a1.ratio WHEN a0.ratio > 0.7 THEN a0.ratio ELSE 0.0 END AS ars
  FROM cands c
  LEFT JOIN sim t0 ON t0.a = c.track_name AND t0.b = c.v0
  LEFT JOIN sim t1 ON t1.a = c.track_name AND t1.b = c.v1
  LEFT JOIN sim a0 ON a0.a = c.artists_name AND a0.b = c.v0
  LEFT JOIN sim a1 ON a1.a = c.artists_name AND a1.b = c.v1),
best AS (SELECT * FROM (
  SELECT *, row_number() OVER (PARTITION BY post_id ORDER BY cand_rank) AS rn2
  FROM scored WHERE ts + ars >= 1.4) WHERE rn2 = 1),
feat AS (
  SELECT 't' || CAST(p_partkey AS VARCHAR) AS track_id,
    CAST(p_size / 50.0 AS FLOAT) AS danceability, CAST((p_retailprice - 900.0) / 1100.0 AS FLOAT) AS energy,
    CAST(p_size // 5 AS INTEGER) AS key, CAST(-length(p_name) AS FLOAT) AS loudness,
    CASE WHEN p_size > 25 THEN '1' ELSE '0' END AS mode, CAST(0.05 AS FLOAT) AS speechiness,
    CAST(p_size / 100.0 AS FLOAT) AS acousticness, CAST(length(p_type) / 10.0 AS FLOAT) AS instrumentalness,
    CAST(0.1 AS FLOAT) AS liveness, CAST(1.0 - p_size / 50.0 AS FLOAT) AS valence,
    CAST(100.0 + p_size AS FLOAT) AS tempo, CAST(trunc(p_retailprice * 100) AS INTEGER) AS duration_ms,
    4 AS time_signature
  FROM part WHERE p_size <= 40)
SELECT b.post_id, strftime(b.created, '%Y-%m-%d %H:%M:%S') AS post_created_utc, b.post_title,
  b.prefix || b.post_id AS post_url,
  b.artists_id, b.artists_name, b.track_id, b.track_name, b.release_date, b.genres,
  CAST(b.track_popularity AS INTEGER) AS track_popularity,
  f.danceability, f.energy, f.key, f.mode, f.loudness, f.speechiness, f.acousticness,
  f.instrumentalness, f.liveness, f.valence, f.tempo, f.duration_ms, f.time_signature,
  {int(RUN_DATE[:4])} AS year, {int(RUN_DATE[5:7])} AS month, {int(RUN_DATE[8:10])} AS day
FROM best b LEFT JOIN feat f ON b.track_id = f.track_id"""


STREAM_ACCEPTED_POSTS = f"""
WITH {FEED_RULES_VALUES}, {FEED_POSTS}, {HISTORY}, {LATEST}, {MARKS},
land AS (
  SELECT p.*, 'user ' || CAST(e.user_id AS VARCHAR) || ' - ' || e.event_type AS title,
    CASE WHEN e.value < 50 THEN 'https://youtu.be/' ELSE 'https://example.com/p/' END
      || CAST(e.event_id AS VARCHAR) AS url
  FROM posts p JOIN events e ON p.event_id = e.event_id),
acc AS (
  SELECT p.*, r.tags, r.prefix, p.title AS post_title
  FROM land p JOIN rules r ON p.source = r.source JOIN marks m ON p.source = m.source
  WHERE p.created > m.last_time AND {FLAIR_PASSES} AND {link_pred("p.url")}
    AND contains(p.title, {_q(TITLE_SEPARATOR)})),
tagged AS (SELECT * EXCLUDE (title),
             list_reduce(list_prepend(post_title, tags), lambda a, t: replace(a, t, '')) AS title FROM acc),
c AS {clean_sql("SELECT * FROM tagged")}
SELECT source, post_id, created_utc, post_title, part0, part1, search_text AS searching_context,
       prefix || post_id AS post_url
FROM c"""


ORACLES = {
    "fuzzy_candidates": FUZZY_CANDIDATES,
    "lake_many_days": LAKE_MANY_DAYS,
    "report_sql_client": GENRE_REPORT,
    "quartiles_from_sketches": QUARTILES_FROM_SKETCHES,
    "landed_quarantine": LANDED_QUARANTINE,
    "handover_quarantine": HANDOVER_QUARANTINE,
    "label_dictionary": LABEL_CLASSIFY,
    "report_incremental": REPORT_INCREMENTAL,
    "stream_takewhile": STREAM_TAKEWHILE,
    "genre_report": GENRE_REPORT,
    "label_classify": LABEL_CLASSIFY,
    "similarity_ratio": SIMILARITY_RATIO,
    "title_clean": TITLE_CLEAN,
    "html_unescape": HTML_UNESCAPE,
    "link_filter": LINK_FILTER,
    "feed_rules": FEED_RULES,
    "feed_takewhile": FEED_TAKEWHILE,
    "watermark_advance": WATERMARK_ADVANCE,
    "run_state_latest": RUN_STATE_LATEST,
    "title_dedup_keys": TITLE_DEDUP_KEYS,
    "entity_match": ENTITY_MATCH,
    "artist_genres": ARTIST_GENRES,
    "enrich_dedupe": ENRICH_DEDUPE,
    "enrich_inner": """
SELECT doc_id, lang, source, quality, toxic FROM documents JOIN (
  SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY quality, toxic) AS rn FROM labels) USING (doc_id)
WHERE rn = 1""",
    "feed_newest": FEED_NEWEST,
    "csv_roundtrip": CSV_ROUNDTRIP,
    "lake_partition_roundtrip": LAKE_PARTITION_ROUNDTRIP,
    "lake_read_all": """
SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate,
       CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month,
       CAST(1 AS INTEGER) AS day
FROM orders""",
    "report_table": GENRE_REPORT,
    "na_drop": NA_DROP,
    "scaled_features": SCALED_FEATURES,
    "cluster_assign": CLUSTER_ASSIGN,
    "kmeans_fit_checks": KMEANS_FIT_CHECKS,
    "k_sweep_checks": K_SWEEP_CHECKS,
    "silhouette": SILHOUETTE,
    "elbow_cost": ELBOW_COST,
    "cluster_quartiles": CLUSTER_QUARTILES,
    "preference_buckets": PREFERENCE_BUCKETS_SQL,
    "preference_uniform": _uniform_sql(1),
    "recommend_kmeans_checks": RECOMMEND_KMEANS_CHECKS,
    "recommend_topn": RECOMMEND_TOPN,
    "stream_feed_load": FEED_TAKEWHILE,
    "stream_accepted_posts": STREAM_ACCEPTED_POSTS,
    "extract_to_lake": EXTRACT_TO_LAKE,
    "stream_extract_to_lake": EXTRACT_TO_LAKE,
}
