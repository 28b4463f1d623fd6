"""SQL for the operators that SQL can express.

The others are models, random rounding, hashes or patterns with offsets that SQL has
no functions for; ``tests/llm`` holds them against brute force.
"""

from __future__ import annotations

# Every start of 200 bytes, as hexadecimal text, counted by its digest. Texts are cut
# into pieces of 1,024 starts first, as taking a part of a long text costs its length.
_REPEATED_BYTES = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
p AS (SELECT doc_id, base, substr(h, 2 * base + 1, 2 * (1024 + 199)) AS part
      FROM d, unnest(range(0, greatest(length(h) // 2 - 199, 0), 1024)) AS r(base)),
w AS (SELECT doc_id, base + s AS s, md5(substr(part, 2 * s + 1, 400)) AS k
      FROM p, unnest(range(0, length(part) // 2 - 199)) AS r(s)),
again AS (SELECT doc_id, s FROM (SELECT *, count(*) OVER (PARTITION BY k) AS n FROM w) WHERE n > 1),
marked AS (SELECT *, CASE WHEN s > lag(s) OVER (PARTITION BY doc_id ORDER BY s) + 200 THEN 1 ELSE 0 END AS fresh FROM again),
numbered AS (SELECT *, sum(fresh) OVER (PARTITION BY doc_id ORDER BY s ROWS UNBOUNDED PRECEDING) AS span FROM marked),
spans AS (SELECT doc_id, span, min(s) AS a, max(s) + 200 AS b FROM numbered GROUP BY doc_id, span),
before AS (SELECT *, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS last FROM spans),
kept AS (SELECT doc_id, count(*) AS n_spans, sum(b - a) AS n_removed,
                string_agg(substr(h, 2 * last + 1, 2 * (a - last)), '' ORDER BY a) || substr(any_value(h), 2 * max(b) + 1) AS h
         FROM before JOIN d USING (doc_id) GROUP BY doc_id)
SELECT d.doc_id, CAST(length(d.h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans, sha256(unhex(coalesce(kept.h, d.h))) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)"""

# All pairs of a label, and the smallest id that links lead to.
_NEAR_VECTORS = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
near AS MATERIALIZED (
  SELECT a.vec_id AS x, b.vec_id AS y FROM v a JOIN v b ON a.label = b.label AND len(a.e) = len(b.e) AND a.vec_id <> b.vec_id
  WHERE list_dot_product(a.e, b.e) / (sqrt(list_dot_product(a.e, a.e)) * sqrt(list_dot_product(b.e, b.e))) >= 0.98),
reached(x, y) AS (SELECT x, y FROM near UNION SELECT r.x, n.y FROM reached r JOIN near n ON r.y = n.x),
least AS (SELECT x, min(y) AS y FROM reached GROUP BY x),
counted AS (SELECT x, count(*) AS n FROM near GROUP BY x)
SELECT vec_id, CAST(coalesce(n, 0) AS BIGINT) AS n_links, least(vec_id, coalesce(l.y, vec_id)) AS component_id,
       vec_id <= coalesce(l.y, vec_id) AS kept
FROM embeddings LEFT JOIN least l ON l.x = vec_id LEFT JOIN counted c ON c.x = vec_id"""

# crc32 of the decimal id bit by bit, then every prefix by the digests of its turns.
_PREFIX_TRIE = """
WITH given AS (SELECT conv_id AS conv, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
turns AS (SELECT conv, row_number() OVER (PARTITION BY conv ORDER BY turn NULLS FIRST, role, text) - 1 AS pos,
                 md5(strlen(role) || ':' || role || text) AS name, strlen(text) AS bytes FROM given),
ids AS (SELECT DISTINCT conv, CAST(conv AS VARCHAR) AS s FROM turns),
sums AS (SELECT conv, xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(range(1, strlen(s) + 1), lambda i: CAST(ascii(s[i]) AS BIGINT))),
           lambda c, b: list_reduce(list_prepend(xor(c, b), CAST(range(0, 8) AS BIGINT[])),
             lambda x, i: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END))) % 9 AS h FROM ids),
bases AS (SELECT s.conv, s.h, least(s.h, coalesce(t.n, 0)) AS kept FROM sums s
          LEFT JOIN (SELECT conv, count(*) AS n FROM turns GROUP BY conv) t ON t.conv = s.conv - s.conv % 5),
rebuilt AS (SELECT b.conv, t.pos, t.name, t.bytes FROM bases b JOIN turns t ON t.conv = b.conv - b.conv % 5 AND t.pos < b.h
            UNION ALL SELECT b.conv, b.kept + t.pos - b.h, t.name, t.bytes FROM bases b JOIN turns t ON t.conv = b.conv AND t.pos >= b.h),
paths AS (SELECT conv, pos + 1 AS depth, bytes, string_agg(name, '') OVER (PARTITION BY conv ORDER BY pos ROWS UNBOUNDED PRECEDING) AS node FROM rebuilt
          UNION ALL SELECT conv, 0, 0, '' FROM bases),
ends AS (SELECT conv, max(depth) AS depth FROM paths GROUP BY conv),
ended AS (SELECT p.node, sha256(string_agg(CAST(p.conv AS VARCHAR), ',' ORDER BY p.conv)) AS sha FROM paths p JOIN ends USING (conv, depth) GROUP BY p.node),
nodes AS (SELECT node, depth, min(conv) AS conv_id, count(*) AS n_convs, any_value(bytes) AS bytes FROM paths GROUP BY node, depth),
kids AS (SELECT left(node, strlen(node) - 32) AS node, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY 1),
own AS (SELECT n.*, coalesce(k.n, 0) AS n_children FROM nodes n LEFT JOIN kids k USING (node)),
sub AS (SELECT left(node, 32 * d) AS node, count_if(n_children = 0) AS n_leaves, sum((n_convs - 1) * bytes) AS saved
        FROM (SELECT *, unnest(range(0, depth + 1)) AS d FROM own) GROUP BY 1)
SELECT o.conv_id, CAST(o.depth AS BIGINT) AS depth, p.conv_id AS parent_conv_id, CAST(o.n_convs AS BIGINT) AS n_convs, CAST(o.n_children AS BIGINT) AS n_children,
       CAST(s.n_leaves AS BIGINT) AS n_leaves, CAST(s.saved AS BIGINT) AS saved_tokens, coalesce(e.sha, sha256('')) AS ends_sha256
FROM own o JOIN sub s USING (node) LEFT JOIN ended e USING (node) LEFT JOIN nodes p ON o.depth > 0 AND p.node = left(o.node, strlen(o.node) - 32)"""


def llm_oracle_sql() -> dict[str, str]:
    return {"op4_repeated_bytes": _REPEATED_BYTES, "op9_near_vectors": _NEAR_VECTORS, "op12_prefix_trie": _PREFIX_TRIE}
