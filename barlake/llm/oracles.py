"""DuckDB counterparts of the queries that SQL can express."""

from __future__ import annotations

PIVOT_TOPK = """
WITH v AS (
  SELECT vec_id, rowid_ AS r, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS DOUBLE)) AS e
  FROM (SELECT *, row_number() OVER () AS rowid_ FROM embeddings)
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, v.vec_id, CAST(list_dot_product(q.e, v.e) AS BIGINT) AS score, q.r
  FROM v q JOIN v ON q.vec_id % 20 = 0 AND q.r <> v.r
)
SELECT query_id, CAST(row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM s QUALIFY rank <= 20
"""

def _rule(host: str, path: str) -> str:
    rules = ("www.example.com/en/", "example.com/en/", "net/es/", "net/fr/", "com/")
    cases = [
        f"WHEN ({host} = '{h}' OR {host} LIKE '%.{h}') AND {path} LIKE '{h_path}%' THEN '{rule}'"
        for rule in rules
        for h, h_path in [(rule.partition("/")[0], "/" + rule.partition("/")[2])]
    ]
    return f"CASE {' '.join(cases)} END"


#: Aliases are what blocked urls reach over the links in both directions.
URL_FILTER = rf"""
WITH RECURSIVE tags AS (
  SELECT url, regexp_extract(html, '(?is)<link\b[^>]*\brel\s*=\s*["'']?canonical\b[^>]*>', 0) AS tag,
         true AS canonical FROM pages
  UNION ALL
  SELECT url, regexp_extract(html, '(?is)<meta\b[^>]*\bhttp-equiv\s*=\s*["'']?refresh\b[^>]*>', 0), false FROM pages
), links AS (
  SELECT url, replace(CASE WHEN canonical THEN regexp_extract(tag, '(?is)\bhref\s*=\s*["'']?\s*([^"''\s>]+)', 1)
    ELSE regexp_extract(tag, '(?is)\bcontent\s*=\s*["'']?\s*[\d.]*\s*[;,]?\s*url\s*=\s*["'']?\s*([^"''\s>]+)', 1) END,
    '&amp;', '&') AS link
  FROM tags WHERE url LIKE '%://%' AND tag <> ''
), targets AS (
  SELECT url, CASE
    WHEN regexp_matches(link, '^[A-Za-z][A-Za-z0-9+.-]*://') THEN link
    WHEN link LIKE '//%' THEN regexp_extract(url, '^([^:]*):', 1) || ':' || link
    WHEN link LIKE '/%' THEN regexp_extract(url, '^([^:]*://[^/?#]*)', 1) || link
    ELSE rtrim(regexp_extract(regexp_replace(url, '[?#].*$', ''), '^([^:]*://[^/]*(?:/.*/|/)?)', 1), '/') || '/' || link
    END AS target
  FROM links WHERE link <> ''
), plain AS (
  SELECT url, regexp_replace(url, '#.*$', '') AS p
  FROM (SELECT url FROM pages UNION SELECT target FROM targets) WHERE url LIKE '%://%'
), parts AS (
  SELECT url, substr(p, 1, strpos(p, '://') - 1) AS scheme, substr(p, strpos(p, '://') + 3) AS rest FROM plain
), nodes AS (
  SELECT url, translate(scheme, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') || '://' || host
         || CASE WHEN tail = '' THEN '/' ELSE tail END AS node, host,
         CASE WHEN tail = '' THEN '/' ELSE regexp_extract(tail, '^[^?#]*', 0) END AS path
  FROM (SELECT *, translate(regexp_extract(rest, '^[^/?#]*', 0), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
          regexp_extract(rest, '(?s)^[^/?#]*(.*)$', 1) AS tail FROM parts)
), edges AS (
  SELECT a.node AS a, b.node AS b FROM targets t JOIN nodes a ON t.url = a.url JOIN nodes b ON t.target = b.url
  WHERE a.node <> b.node
), reached(node) AS (
  SELECT node FROM nodes WHERE {_rule('host', 'path')} IN ('example.com/en/', 'net/es/', 'net/fr/')
    AND node IN (SELECT a FROM edges UNION SELECT b FROM edges)
  UNION
  SELECT CASE WHEN e.a = r.node THEN e.b ELSE e.a END FROM reached r JOIN edges e ON r.node IN (e.a, e.b)
), own AS (
  SELECT page_id, url, translate(regexp_extract(rest, '^[^/?#]*', 0), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM (SELECT page_id, url, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
        FROM pages)
), ruled AS (SELECT *, {_rule('host', 'path')} AS rule FROM own)
SELECT page_id, host, path, rule, CASE
  WHEN rule IN ('example.com/en/', 'net/es/', 'net/fr/') THEN 'block'
  WHEN rule IS NOT NULL THEN 'allow'
  WHEN url IN (SELECT n.url FROM nodes n JOIN reached r USING (node)) THEN 'block' ELSE 'allow' END AS verdict
FROM ruled
"""

EXACT_DEDUP = r"""
WITH k AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS h
  FROM documents
), g AS (SELECT h, min(doc_id) AS keep_id, count(*) AS group_size FROM k GROUP BY h)
SELECT k.doc_id, g.keep_id, g.group_size, k.doc_id = g.keep_id AS kept, k.h AS text_sha256
FROM k JOIN g USING (h)
"""

#: Targets by the same rounds of clamping; the sample in hash order, nearest to the target.
MIXING = r"""
WITH RECURSIVE sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
         md5('7:' || coalesce(CAST(doc_id AS VARCHAR), 'null')) AS key
  FROM documents
), src AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, CAST(sum(size) AS DOUBLE) * 2 AS cap,
         [5, 2, 1][CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS INT) + 1] AS weight
  FROM sized GROUP BY source
), lev(k, level) AS (
  SELECT 0, CAST(0 AS DOUBLE)
  UNION ALL
  SELECT k + 1, (
    SELECT CASE WHEN sum(CASE WHEN weight * level > cap THEN 0 ELSE weight END) = 0 THEN level
      ELSE (1.5 * sum(source_size) - sum(CASE WHEN weight * level > cap THEN cap ELSE 0 END))
           / sum(CASE WHEN weight * level > cap THEN 0 ELSE weight END) END FROM src)
  FROM lev WHERE k < 60
), tgt AS (
  SELECT source, source_size, least(cap, weight * (SELECT max_by(level, k) FROM lev)) AS target FROM src
), cut AS (
  SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS whole
  FROM tgt
), run AS (
  SELECT d.*, c.source_size, c.target, c.whole, c.target - c.whole * c.source_size AS part,
         sum(size) OVER (PARTITION BY d.source ORDER BY key) AS through,
         sum(size) OVER (PARTITION BY d.source, key) AS own
  FROM sized d JOIN cut c ON d.source IS NOT DISTINCT FROM c.source
)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target,
  CAST(size * (whole + CASE WHEN through <= part
      OR (through - own <= part AND through - part < part - (through - own)) THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM run
"""


#: Counts of failure masks by part and label, then every order walked step by step.
FILTER_AUDIT = r"""
WITH RECURSIVE told AS (
  SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id
), d AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
         min(doc_id) OVER (PARTITION BY coalesce(text, '')) AS least
  FROM documents
), failed AS (
  SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic, [
    len(words) < 200,
    100 * len(list_distinct(words)) < 50 * len(words),
    100 * len(regexp_replace(t, '[^A-Z]', '', 'g')) > 3 * length(t),
    regexp_matches(t, '[#$%&*|]'),
    coalesce(doc_id > least, false)] AS fails
  FROM d LEFT JOIN told USING (doc_id)
), grouped AS (
  SELECT part, good, toxic, fails, count(*) AS n FROM failed GROUP BY ALL
), orders(filter_order) AS (
  SELECT ''
  UNION ALL
  SELECT filter_order || l FROM orders, (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS l) AS letters
  WHERE strpos(filter_order, l) = 0
), steps AS (
  SELECT filter_order, step, ascii(filter_order[step]) - 64 AS f,
         list_transform(string_split(filter_order[:step - 1], ''), lambda c: ascii(c) - 64) AS earlier
  FROM (SELECT * FROM orders WHERE length(filter_order) = 5), (SELECT unnest([1, 2, 3, 4, 5]) AS step) AS numbers
), judged AS (
  SELECT part, filter_order, step, f, n, good, toxic, fails[f] AS fails_here,
         step > 1 AND len(list_filter(earlier, lambda e: e > 0 AND fails[e])) > 0 AS gone,
         len(list_filter(fails, lambda x: x)) AS failures
  FROM grouped, steps
), counted AS (
  SELECT part, filter_order, step, f,
    sum(n) FILTER (NOT gone AND NOT fails_here) AS kept, sum(n) FILTER (NOT gone AND fails_here) AS removed,
    sum(n) FILTER (gone AND fails_here) AS redundant, sum(n) FILTER (fails_here AND failures = 1) AS unique_fails,
    sum(n) FILTER (NOT gone AND fails_here AND good) AS good_lost,
    sum(n) FILTER (NOT gone AND fails_here AND toxic) AS toxic_lost
  FROM judged GROUP BY ALL
)
SELECT part, filter_order, CAST(step AS INTEGER) AS step,
  CAST(coalesce(kept, 0) AS BIGINT) AS kept, CAST(coalesce(removed, 0) AS BIGINT) AS removed,
  CAST(coalesce(redundant, 0) AS BIGINT) AS redundant, CAST(coalesce(unique_fails, 0) AS BIGINT) AS unique_fails,
  CAST(coalesce(good_lost, 0) AS BIGINT) AS good_lost, CAST(coalesce(toxic_lost, 0) AS BIGINT) AS toxic_lost,
  CAST(sum(coalesce(removed, 0)) OVER (PARTITION BY part, f) AS BIGINT) AS shapley
FROM counted
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op1_pivot_topk": PIVOT_TOPK,
        "op2_url_filter": URL_FILTER,
        "op3_exact_dedup": EXACT_DEDUP,
        "op10_mixing": MIXING,
        "op13_filter_audit": FILTER_AUDIT,
    }
