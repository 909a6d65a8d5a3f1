"""DuckDB SQL for the queries that SQL can say. Written from the contracts, not from the Spark code."""

from __future__ import annotations

_AZ = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"

OP1 = """
WITH usable AS (
    SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS q
    FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
    SELECT a.r, a.vec_id AS query_id, b.vec_id,
           CAST(list_sum(list_transform(list_zip(a.q, b.q), lambda p: p[1] * p[2])) AS BIGINT) AS score
    FROM usable a JOIN usable b ON a.r <> b.r
    WHERE a.vec_id % 100 = 0),
ranked AS (
    SELECT query_id, CAST(row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
           vec_id, score
    FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10
"""

OP3 = r"""
WITH lines AS (
    SELECT doc_id, source, unnest(range(len(string_split(text, chr(10))))) AS place,
           unnest(string_split(text, chr(10))) AS line
    FROM documents WHERE text IS NOT NULL),
normal AS (
    SELECT doc_id, source, place, trim(regexp_replace(lower(line), '[\x20\x09-\x0D]+', ' ', 'g'), ' ') AS line FROM lines),
boilerplate AS (
    SELECT line, min(struct_pack(d := doc_id, p := place)) AS earliest
    FROM normal WHERE len(string_split(line, ' ')) >= 3
    GROUP BY line HAVING count(DISTINCT source) >= 5),
gone AS (
    SELECT n.doc_id, list(n.place) AS places
    FROM normal n JOIN boilerplate b ON n.line = b.line
    WHERE NOT (n.doc_id = b.earliest.d AND n.place = b.earliest.p)
    GROUP BY n.doc_id),
cleaned AS (
    SELECT d.doc_id, d.text AS old, len(g.places) AS n,
           CASE WHEN g.places IS NULL THEN d.text ELSE array_to_string(list_filter(
               string_split(d.text, chr(10)), lambda line, k: NOT list_contains(g.places, k - 1)), chr(10)) END AS text
    FROM documents d LEFT JOIN gone g ON d.doc_id = g.doc_id)
SELECT doc_id, CAST(CASE WHEN old IS NULL THEN 0 ELSE len(string_split(old, chr(10))) END AS INTEGER) AS n_lines,
       CAST(coalesce(n, 0) AS INTEGER) AS n_removed, CAST(length(text) AS INTEGER) AS n_chars, sha256(text) AS text_sha256
FROM cleaned
"""

OP6 = rf"""
WITH RECURSIVE words AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), {_AZ}), '[^\x20\x09-\x0D]+') AS w FROM documents),
sets AS (
    SELECT doc_id, CASE WHEN len(w) >= 5
        THEN list_distinct(list_transform(range(1, len(w) - 3), lambda k: array_to_string(list_slice(w, k, k + 4), ' ')))
        WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END AS s
    FROM words),
sizes AS (SELECT doc_id, len(s) AS n FROM sets),
members AS (SELECT doc_id, unnest(s) AS shingle FROM sets),
common AS (
    SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n
    FROM members a JOIN members b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (
    SELECT c.a, c.b FROM common c JOIN sizes x ON x.doc_id = c.a JOIN sizes y ON y.doc_id = c.b
    WHERE 100 * c.n >= 75 * (x.n + y.n - c.n)),
reach AS (
    SELECT doc_id, doc_id AS other FROM sizes
    UNION SELECT r.doc_id, l.b FROM reach r JOIN links l ON r.other = l.a),
least AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id)
SELECT s.doc_id, s.n AS n_shingles, l.component_id, s.doc_id = l.component_id AS kept
FROM sizes s JOIN least l ON s.doc_id = l.doc_id
"""

OP8 = rf"""
WITH RECURSIVE rules(verdict, rule, host, path) AS (VALUES
    ('allow', 'com/', 'com', '/'), ('block', 'example.com/en/', 'example.com', '/en/'),
    ('allow', 'www.example.com/en/', 'www.example.com', '/en/'),
    ('block', 'net/es/', 'net', '/es/'), ('block', 'net/fr/', 'net', '/fr/')),
parted AS (
    SELECT page_id, html,
           translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), {_AZ}) AS host,
           regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path,
           regexp_extract(coalesce(url, ''), '(?s)^.*?://[^?#]*(\?[^#]*)', 1) AS query
    FROM pages),
named AS (SELECT page_id, html, host, path, host || path || query AS address FROM parted),
tags AS (
    SELECT address, host, path, unnest(regexp_extract_all(coalesce(html, ''), '(?i)<(?:link|meta)\b[^>]*>')) AS tag
    FROM named WHERE address <> ''),
targets AS (
    SELECT address, host, path, unnest(CASE
        WHEN regexp_matches(tag, '(?i)^<link\b.*\brel\s*=\s*["'']?canonical\b')
            THEN regexp_extract_all(tag, '(?i)\bhref\s*=\s*["'']?([^"''\s>]+)', 1)
        WHEN regexp_matches(tag, '(?i)^<meta\b.*\bhttp-equiv\s*=\s*["'']?refresh\b')
            THEN regexp_extract_all(tag, '(?i)\burl\s*=\s*["'']?([^"''\s>;]+)', 1)
        ELSE [] END) AS link
    FROM tags),
decoded AS (
    SELECT address, host, path, regexp_extract(regexp_replace(link, '&(?:amp|#38|#x26);', '&', 'gi'), '^[^#]*') AS link
    FROM targets),
-- Relative links as if they were absolute, by the page's host and folder.
spelled AS (
    SELECT address, host, link, CASE
        WHEN regexp_matches(link, '^[A-Za-z][A-Za-z0-9+.-]*://') THEN NULL
        WHEN starts_with(link, '//') THEN NULL
        WHEN starts_with(link, '/') THEN regexp_extract(link, '^[^?]*')
        WHEN starts_with(link, '?') THEN NULL
        ELSE CASE WHEN regexp_replace(path, '[^/]*$', '') = '' THEN '/' ELSE regexp_replace(path, '[^/]*$', '') END
             || regexp_extract(link, '^[^?]*') END AS raw,
        CASE WHEN starts_with(link, '?') THEN path END AS same
    FROM decoded
    WHERE link <> '' AND (NOT regexp_matches(link, '^[A-Za-z][A-Za-z0-9+.-]*:') OR regexp_matches(link, '^[A-Za-z][A-Za-z0-9+.-]*://'))),
one_way AS (
    SELECT address AS a, CASE
        WHEN raw IS NOT NULL THEN host || CASE WHEN regexp_matches(raw, '/\.\.?(/|$)') THEN
            list_reduce(list_concat([''], string_split(raw, '/')[2:]), lambda done, part: CASE
                WHEN part = '..' THEN regexp_replace(done, '/[^/]*$', '') WHEN part = '.' THEN done ELSE done || '/' || part END)
            || CASE WHEN regexp_matches(raw, '/\.\.?$') THEN '/' ELSE '' END ELSE raw END || regexp_extract(link, '\?.*$')
        WHEN same IS NOT NULL THEN host || same || link
        ELSE translate(regexp_extract(link, '^(?:[^/?#]*?:)?//([^/?#]*)', 1), {_AZ})
            || regexp_extract(link, '^(?:[^/?#]*?:)?//[^/?#]*([^#]*)', 1) END AS b
    FROM spelled),
links AS (SELECT a, b FROM one_way WHERE b <> '' UNION SELECT b, a FROM one_way WHERE b <> ''),
reach AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
places AS (
    SELECT DISTINCT b AS address, regexp_extract(b, '^[^/?#]*') AS host, regexp_extract(b, '^[^/?#]*([^?#]*)', 1) AS path
    FROM reach),
place_rule AS (
    SELECT p.address, arg_max(r.verdict, length(r.rule)) AS verdict
    FROM places p JOIN rules r ON (p.host = r.host OR suffix(p.host, '.' || r.host)) AND starts_with(p.path, r.path)
    GROUP BY p.address),
around AS (
    SELECT r.a AS address, coalesce(bool_or(v.verdict = 'block'), false) AS blocks,
           coalesce(bool_or(v.verdict = 'allow'), false) AS allows
    FROM reach r LEFT JOIN place_rule v ON v.address = r.b GROUP BY r.a),
own AS (
    SELECT n.page_id, n.host, n.path, n.address,
           (SELECT arg_max(r.rule, length(r.rule)) FROM rules r
            WHERE (n.host = r.host OR suffix(n.host, '.' || r.host)) AND starts_with(n.path, r.path)) AS rule
    FROM named n)
SELECT o.page_id, o.host, o.path, o.rule,
       coalesce((SELECT verdict FROM rules r WHERE r.rule = o.rule),
                CASE WHEN a.blocks AND NOT a.allows THEN 'block' ELSE 'allow' END) AS verdict,
       a.address IS NOT NULL AS aliased
FROM own o LEFT JOIN around a ON a.address = o.address AND o.address <> ''
"""



def _op11(rounds: int = 5, clusters: int = 40) -> str:
    """Each round as two steps: assign (a), then move (c)."""

    def assign(at: int) -> str:
        apart = "list_sum(list_transform(list_zip(v.q, c.q), lambda p: CAST((p[1] - p[2]) * (p[1] - p[2]) AS HUGEINT)))"
        return f"""a{at} AS (
    SELECT r, arg_min(cluster, (d, cluster)) AS cluster, min(d) AS d
    FROM (SELECT v.r, c.cluster, {apart} AS d FROM kept v, c{at} c) GROUP BY r)"""

    def move(at: int) -> str:
        return f"""c{at + 1} AS (
    SELECT c.cluster, coalesce(m.q, c.q) AS q
    FROM c{at} c LEFT JOIN (
        SELECT cluster, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY place) AS q
        FROM (SELECT a.cluster, place, sum(v.q[place]) AS s, count(*) AS n
              FROM a{at} a JOIN kept v ON a.r = v.r, range(1, 65) t(place) GROUP BY a.cluster, place)
        GROUP BY cluster) m ON m.cluster = c.cluster)"""

    steps = [step for at in range(rounds) for step in (assign(at), move(at))] + [assign(rounds)]
    return f"""
WITH kept AS (
    SELECT row_number() OVER () AS r, vec_id,
           list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS q
    FROM embeddings
    WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
c0 AS (
    SELECT row_number() OVER (ORDER BY sha256('2:' || vec_id)) - 1 AS cluster, q
    FROM kept WHERE vec_id IS NOT NULL ORDER BY sha256('2:' || vec_id) LIMIT {clusters}),
{", ".join(steps)},
inertia AS (SELECT cluster, sum(d) AS one FROM a{rounds} GROUP BY cluster)
SELECT v.vec_id, CAST(a.cluster AS INTEGER) AS cluster, CAST(a.d AS BIGINT) AS distance,
       CAST(i.one AS BIGINT) AS cluster_inertia, CAST((SELECT sum(one) FROM inertia) AS BIGINT) AS inertia,
       sha256(array_to_string(list_transform(c.q, lambda x: CAST(x AS VARCHAR)), ',')) AS centroid_sha256
FROM a{rounds} a JOIN kept v ON v.r = a.r JOIN inertia i ON i.cluster = a.cluster JOIN c{rounds} c ON c.cluster = a.cluster
"""


ORACLE_SQL = {
    "op1_top_k": OP1,
    "op3_line_dedup": OP3,
    "op6_near_dups": OP6,
    "op8_url_filters": OP8,
    "op11_centroids": _op11(),
}
