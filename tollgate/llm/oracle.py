"""SQL for the queries that SQL can express; the others are tested against brute force."""

from __future__ import annotations

from tollgate.llm import secrets
from tollgate.llm.common import LOWER, SPACE, UPPER

WARC = """
WITH p AS (
  SELECT page_id, sha256(coalesce(html, '')) AS digest, strlen(coalesce(html, '')) AS bytes FROM pages
), f AS (SELECT digest, min(page_id) AS first_id FROM p GROUP BY digest)
SELECT p.page_id, CAST(p.bytes AS BIGINT) AS payload_bytes, p.digest AS payload_digest,
       CASE WHEN p.bytes >= 100 AND p.page_id IS DISTINCT FROM f.first_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN p.bytes >= 100 AND p.page_id IS DISTINCT FROM f.first_id THEN f.first_id END AS refers_to
FROM p JOIN f USING (digest)
"""

JACCARD = f"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{SPACE}'), lambda x: x <> '') AS ws
  FROM documents
), s AS (
  SELECT doc_id, CASE WHEN len(ws) = 0 THEN CAST([] AS VARCHAR[]) WHEN len(ws) < 4 THEN [array_to_string(ws, ' ')]
    ELSE list_distinct(list_transform(range(1, len(ws) - 2), lambda i: array_to_string(ws[i:i + 3], ' '))) END AS sh FROM w
), t AS (SELECT doc_id, len(sh) AS n, unnest(sh) AS token FROM s),
shared AS (
  SELECT a.doc_id AS x, b.doc_id AS y, a.n AS nx, b.n AS ny, count(*) AS c
  FROM t a JOIN t b ON a.token = b.token AND a.doc_id <> b.doc_id GROUP BY ALL
), links AS MATERIALIZED (SELECT x, y FROM shared WHERE 100 * c >= 85 * (nx + ny - c)),
reach AS (SELECT x, y FROM links UNION SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x)
SELECT s.doc_id, CAST(len(sh) AS BIGINT) AS n_shingles, least(s.doc_id, coalesce(min(r.y), s.doc_id)) AS component_id
FROM s LEFT JOIN reach r ON r.x = s.doc_id GROUP BY s.doc_id, len(sh)
"""


def _secret_rules() -> str:
    rows = []
    for rank, rule in enumerate(secrets.RULES):
        # Whole runs of hexadecimal digits: a run is long enough or it is not.
        pattern = "[0-9a-f]{32,}" if rule.kind == "hex" else rule.pattern
        rows.append(f"""
  SELECT doc_id, {rank} AS rank, '{rule.kind}' AS kind, found, gaps, {rule.group} AS grp,
    list_filter(range(1, len(found) + 1), lambda i: length(regexp_extract(found[i], '{pattern.replace("'", "''")}', {rule.group})) >= {rule.least}) AS long
  FROM (SELECT doc_id, regexp_extract_all(t, '{pattern.replace("'", "''")}') AS found,
          string_split_regex(t, '{pattern.replace("'", "''")}') AS gaps FROM d)""")
    return " UNION ALL ".join(rows)


SECRETS = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents), m AS ({_secret_rules()}), spans AS (
  SELECT doc_id, rank, kind,
    list_sum(list_transform(gaps[1:i], lambda g: length(g))) + coalesce(list_sum(list_transform(found[1:i - 1], lambda g: length(g))), 0) AS start,
    length(found[i]) AS size
  FROM (SELECT *, unnest(long) AS i FROM m)
), named AS (
  SELECT doc_id, rank, start, kind, kind || ':' || CAST(CAST(start AS BIGINT) AS VARCHAR) || ':' || CAST(CAST(start + size AS BIGINT) AS VARCHAR) AS span
  FROM spans
)
SELECT d.doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
  count(*) FILTER (kind = 'hex') AS n_hex,
  sha256(coalesce(string_agg(span, ',' ORDER BY start, rank) FILTER (rank < 3), '')) AS base_sha256,
  coalesce(string_agg(span, ',' ORDER BY start, rank), '') AS spans
FROM d LEFT JOIN named ON d.doc_id = named.doc_id GROUP BY d.doc_id
"""

TRIE = """
WITH bits AS (SELECT range(0, 8) AS eight), ids AS (SELECT DISTINCT conv_id FROM conversations WHERE conv_id IS NOT NULL), sums AS (
  SELECT conv_id, CAST(xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda c: CAST(ord(c) AS BIGINT))),
    lambda s, c: list_reduce(list_prepend(xor(s, c), CAST(eight AS BIGINT[])), lambda x, b: CASE WHEN x % 2 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)), 4294967295) % 9 AS BIGINT) AS h
  FROM ids, bits
), t AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) - 1 AS pos,
    coalesce(role, '') AS role, coalesce(text, '') AS text
  FROM conversations WHERE conv_id IS NOT NULL
), kinds AS (SELECT role, text, row_number() OVER (ORDER BY role, text) AS kind, strlen(text) AS bytes FROM (SELECT DISTINCT role, text FROM t)),
own AS (
  SELECT s.conv_id, s.h, coalesce(list(k.kind ORDER BY t.pos), []) AS kinds FROM sums s JOIN t USING (conv_id) JOIN kinds k USING (role, text) GROUP BY ALL
), rebuilt AS (
  SELECT o.conv_id, list_concat(coalesce(b.kinds, [])[1:o.h], o.kinds[o.h + 1:]) AS p FROM own o LEFT JOIN own b ON b.conv_id = o.conv_id - o.conv_id % 5
), nodes AS (
  SELECT p[1:d] AS node, d, min(conv_id) AS conv_id, count(*) AS n, coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (len(p) = d), '') AS ends
  FROM (SELECT conv_id, p, unnest(range(0, len(p) + 1)) AS d FROM rebuilt) GROUP BY ALL
), sized AS (
  SELECT n.*, n.node[1:d - 1] AS up, coalesce(k.bytes, 0) AS bytes FROM nodes n LEFT JOIN kinds k ON k.kind = n.node[d]
), kids AS (SELECT up, count(*) AS c FROM sized WHERE d > 0 GROUP BY up), below AS (
  SELECT node[1:a] AS node, sum((n - 1) * bytes) AS saved, count(*) FILTER (kids.up IS NULL) AS leaves
  FROM (SELECT *, unnest(range(0, d + 1)) AS a FROM sized) s LEFT JOIN kids ON kids.up = s.node GROUP BY ALL
)
SELECT s.conv_id, CAST(s.d AS BIGINT) AS depth, p.conv_id AS parent_conv_id, CAST(s.n AS BIGINT) AS n_convs, CAST(coalesce(kids.c, 0) AS BIGINT) AS n_children,
  CAST(b.leaves AS BIGINT) AS n_leaves, CAST(b.saved AS BIGINT) AS saved_tokens, sha256(s.ends) AS ends_sha256
FROM sized s JOIN below b ON b.node = s.node LEFT JOIN sized p ON p.node = s.up AND s.d > 0 LEFT JOIN kids ON kids.up = s.node
"""

SQL = {"op11_prefix_trie": TRIE, "op6_jaccard_join": JACCARD, "op7_warc_archive": WARC, "op9_secret_scan": SECRETS}
