"""The prefix trie of conversations over the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from . import prefix_trie
from .registry import query, table

HEAD = 9  # heads have fewer turns


@query(
    f"""
    WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
    t AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, sha256(strlen(role) || ':' || role || text)) AS pos,
                 sha256(strlen(role) || ':' || role || text) AS token, strlen(text) AS bytes FROM c),
    ids AS (SELECT DISTINCT conv_id, xor(4294967295, list_reduce(list_prepend(4294967295, flatten([[ascii(x), 0, 0, 0, 0, 0, 0, 0]
                     FOR x IN string_split(conv_id::VARCHAR, '')])::BIGINT[]), lambda a, b: CASE WHEN xor(a, b) & 1 = 1
                     THEN xor(xor(a, b) >> 1, 3988292384) ELSE xor(a, b) >> 1 END)) % {HEAD} AS h FROM t),
    s AS (SELECT i.conv_id, 0 AS own, pos, token, bytes FROM ids i JOIN t ON t.conv_id = i.conv_id - i.conv_id % 5 WHERE pos <= h
          UNION ALL SELECT conv_id, 1, pos, token, bytes FROM t JOIN ids USING (conv_id) WHERE pos > h),
    l AS (SELECT conv_id, coalesce(list(token ORDER BY own, pos) FILTER (pos IS NOT NULL), []) AS tokens,
                 coalesce(list(bytes ORDER BY own, pos) FILTER (pos IS NOT NULL), []) AS sizes FROM ids LEFT JOIN s USING (conv_id) GROUP BY conv_id),
    p AS (SELECT conv_id, unnest(range(0, len(tokens) + 1)) AS depth, tokens, sizes FROM l),
    n AS (SELECT depth, sha256(array_to_string(tokens[1:depth], '')) AS name, any_value(CASE WHEN depth > 0 THEN sha256(array_to_string(tokens[1:depth - 1], '')) END) AS up,
                 any_value(CASE WHEN depth > 0 THEN sizes[depth] ELSE 0 END) AS bytes, any_value(tokens[1:depth]) AS tokens, min(conv_id) AS conv_id, count(*) AS n_convs,
                 coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (depth = len(tokens)), '') AS ends FROM p GROUP BY depth, sha256(array_to_string(tokens[1:depth], ''))),
    k AS (SELECT up AS name, count(*) AS n_children FROM n WHERE up IS NOT NULL GROUP BY up),
    w AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM n LEFT JOIN k USING (name)),
    above AS (SELECT w.*, unnest(range(0, depth + 1)) AS d FROM w),
    totals AS (SELECT sha256(array_to_string(tokens[1:d], '')) AS name, sum(CASE WHEN n_children = 0 THEN 1 ELSE 0 END)::BIGINT AS n_leaves,
                      sum((n_convs - 1) * bytes)::BIGINT AS saved_tokens FROM above GROUP BY 1)
    SELECT w.conv_id, w.depth, u.conv_id AS parent_conv_id, w.n_convs, w.n_children, n_leaves, saved_tokens, sha256(w.ends) AS ends_sha256
    FROM w JOIN totals USING (name) LEFT JOIN w u ON u.name = w.up
    """
)
def op11_prefix_trie(spark, sf_dir):
    turns = prefix_trie.number_turns(table(spark, sf_dir, "conversations"), "conv_id", "turn", "role", "text")
    conv = F.col("conv")
    head = F.crc32(conv.cast("string").cast("binary")) % HEAD
    members, turns = prefix_trie.rebuild(turns, conv - conv % 5, head, HEAD - 1)
    return prefix_trie.prefix_trie(members, turns).drop("name", "parent", "token")
