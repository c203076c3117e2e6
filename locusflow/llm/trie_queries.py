"""Query of the conversation trie, with its SQL."""

from __future__ import annotations

from locusflow.llm import trie
from locusflow.llm.registry import query, table

# The checksum of zlib, bit by bit: DuckDB has no function for it.
_CRC = """xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
    lambda a, b: list_reduce(list_prepend(xor(a, b), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
        lambda r, z: CASE WHEN r % 2 = 1 THEN xor(r // 2, 3988292384::BIGINT) ELSE r // 2 END)), 4294967295::BIGINT)"""

_SQL = f"""
WITH own AS (SELECT conv_id AS c, coalesce(role, '') AS r, coalesce(text, '') AS x,
                    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS p
             FROM conversations WHERE conv_id IS NOT NULL),
sizes AS (SELECT conv_id AS c, {_CRC} % 4 AS h, n FROM (SELECT conv_id, count(*) AS n FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id)),
convs AS (SELECT a.c, a.h, a.n, CASE WHEN b.n IS NULL THEN 0 ELSE least(a.h, b.n) END AS k FROM sizes a LEFT JOIN sizes b ON b.c = a.c - a.c % 20),
turns AS (SELECT o.c, o.p - v.h + v.k AS p, o.r, o.x FROM own o JOIN convs v ON o.c = v.c WHERE o.p > v.h
          UNION ALL SELECT v.c, o.p, o.r, o.x FROM convs v JOIN own o ON o.c = v.c - v.c % 20 AND o.p <= v.h),
paths AS (SELECT c, p, list({{'r': r, 'x': x}}) OVER (PARTITION BY c ORDER BY p) AS path, len(regexp_extract_all(x, '[^\\x20\\x09-\\x0D]+')) AS words FROM turns
          UNION ALL SELECT c, 0, []::STRUCT(r VARCHAR, x VARCHAR)[], 0 FROM convs),
last AS (SELECT c, max(p) AS p FROM paths GROUP BY c),
nodes AS (SELECT path, a.p AS depth, min(a.c) AS conv_id, count(*) AS n_convs, any_value(words) AS words,
                 sha256(coalesce(string_agg(a.c::VARCHAR, ',' ORDER BY a.c) FILTER (WHERE a.p = l.p), '')) AS ends_sha256
          FROM paths a JOIN last l USING (c) GROUP BY path, a.p),
kids AS (SELECT path[1:depth - 1] AS path, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY ALL),
full_nodes AS (SELECT n.*, coalesce(k.n_children, 0) AS n_children FROM nodes n LEFT JOIN kids k ON n.path = k.path),
sums AS (SELECT a.path, sum((n.n_convs - 1) * n.words) AS saved_tokens, count(*) FILTER (WHERE n.n_children = 0) AS n_leaves
         FROM full_nodes n JOIN paths a ON a.c = n.conv_id AND a.p <= n.depth GROUP BY a.path)
SELECT n.conv_id, n.depth, q.conv_id AS parent_conv_id, n.n_convs, n.n_children, s.n_leaves, s.saved_tokens::BIGINT AS saved_tokens, n.ends_sha256
FROM full_nodes n JOIN sums s ON n.path = s.path LEFT JOIN full_nodes q ON n.depth > 0 AND q.depth = n.depth - 1 AND q.path = n.path[1:n.depth - 1]
"""


@query("op13_conversation_trie", _SQL)
def op13_conversation_trie(spark, sf_dir):
    """Which openings do the rebuilt conversations share, and how many tokens does sharing save?"""
    return trie.conversation_trie(table(spark, sf_dir, "conversations")).drop("k1", "k2")
