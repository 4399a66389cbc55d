"""op13: the prefix trie of all rebuilt conversations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from kerbside.llm import prefix_trie
from kerbside.llm.sql_text import CRC32, crc32_of
from kerbside.llm.tables import table


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text"))


QUERIES = {"op13_prefix_trie": op13_prefix_trie}
ORACLE = {
    "op13_prefix_trie": CRC32
    + """
, turns AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS p
  FROM conversations WHERE conv_id IS NOT NULL
), convs AS (
  SELECT conv_id, conv_id - conv_id % 100 AS base, """
    + crc32_of("conv_id::VARCHAR")
    + """ % 6 AS h FROM (SELECT DISTINCT conv_id FROM turns), crc_table
), rebuilt AS (
  SELECT c.conv_id, 0 AS part, t.p, t.role, t.text FROM convs c JOIN turns t ON t.conv_id = c.base AND t.p <= c.h
  UNION ALL
  SELECT c.conv_id, 1, t.p, t.role, t.text FROM convs c JOIN turns t ON t.conv_id = c.conv_id AND t.p > c.h
), placed AS (
  SELECT conv_id, text, sha256(sha256(role) || sha256(text)) AS turn, row_number() OVER (PARTITION BY conv_id ORDER BY part, p) AS depth FROM rebuilt
), members AS (
  SELECT conv_id, depth, sha256(string_agg(turn, ',') OVER (PARTITION BY conv_id ORDER BY depth)) AS node, length(text) AS chars FROM placed
  UNION ALL
  SELECT conv_id, 0, 'root', 0 FROM convs
), totals AS (
  SELECT conv_id, max(depth) AS total FROM members GROUP BY conv_id
), nodes AS (
  SELECT node, depth, min(conv_id) AS conv_id, count(*) AS n_convs, max(chars) AS chars,
    sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (depth = total), '')) AS ends_sha256
  FROM members JOIN totals USING (conv_id) GROUP BY node, depth
), parents AS (
  SELECT n.node, m.node AS parent FROM nodes n JOIN members m ON m.conv_id = n.conv_id AND m.depth = n.depth - 1
), children AS (
  SELECT parent AS node, count(*) AS n_children FROM parents GROUP BY parent
), below AS (
  SELECT m.node, count(*) FILTER (c.node IS NULL) AS n_leaves, sum((n.n_convs - 1) * n.chars) AS saved_tokens
  FROM nodes n LEFT JOIN children c ON c.node = n.node JOIN members m ON m.conv_id = n.conv_id AND m.depth <= n.depth GROUP BY m.node
)
SELECT n.conv_id, n.depth::BIGINT AS depth, u.conv_id AS parent_conv_id, n.n_convs, coalesce(c.n_children, 0) AS n_children, b.n_leaves, b.saved_tokens::BIGINT AS saved_tokens, n.ends_sha256
FROM nodes n JOIN below b USING (node) LEFT JOIN children c USING (node) LEFT JOIN parents p USING (node) LEFT JOIN nodes u ON u.node = p.parent
"""
}
